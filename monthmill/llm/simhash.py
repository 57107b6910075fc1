"""SimHash near-dedup by anchor-point covering.

A fingerprint has 64 bits. Two fingerprints within ``max_bits`` differing bits have, among ``max_bits // 2 + 1`` (two at least) equal
parts of the word, one part in which they differ in at most one bit. In each part the anchors are the words of a covering
code of radius 1: a perfect Hamming code on the first 2**r - 1 bits of the part, and every pattern of the bits left over.
A fingerprint's home is the nearest anchor; it is replicated to every anchor within covering radius plus threshold, that is
2 bits. Whoever lies within one bit of it in that part has its home among those anchors, so comparing homes with
replicas at each anchor finds every link. For ``max_bits`` 3 a part has 2**26 anchors a bit pattern and a fingerprint gets
at most 17 replicas in it, whatever the size of the corpus.

Equal fingerprints are one node. At an anchor only a spanning forest of the links is kept, at most one edge a replica, so a
large group of near copies does not become all its pairs. An anchor with more than ``cell_rows`` replicas is dealt into
cells: homes by one hash, replicas by another, each pair of them compared in one cell.

Where near copies are to be similar in their shingles (:func:`one_of_each`), the fingerprint is a 128-bit sketch of the
shingles' least hashes, covered in six parts of 21 bits and compared whole at the anchor: sketches within 11 bits have a part in
which at most one bit differs, wherever in the text the edits are. There the forest takes the closest pairs first, and every
pair of it is decided by the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, require, text_slices
from .components import components

#: Replicas at an anchor beyond which it is dealt into cells.
CELL_ROWS = 20_000
#: One of so many fingerprints, by hash, is looked at to find such anchors; only the dealing depends on it, no result.
PROBE = 16
HOME, REPLICA = 1, 2
SKETCH = ["sketch_a", "sketch_b"]
SKETCH_BITS = 128
#: Parts of each of a sketch's two words.
SKETCH_PARTS = 3
#: Standard errors of a sketch's similarity by which a pair may fall short and still be looked at.
SPREAD = 2.7
#: Sketches, of 16 bytes each, up to which they are broadcast.
BROADCAST_NODES = 200_000


def shingle_hashes(words: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words joined by a space (of all words, if fewer), as rows of 8 bytes, high first."""
    from xxhash import xxh64_digest

    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.fromiter(map(len, words), np.int64, len(words))
    np.cumsum(ends + 1, out=ends)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    return np.frombuffer(b"".join([xxh64_digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)]), np.uint8).reshape(n, 8)


def fingerprint(text: str, shingle: int, seed: int = 42) -> int:
    """A-Z lower-cased, words of ``[^\\x20\\x09-\\x0D]+``, XXH64 of each run of ``shingle`` words (of all, if fewer), repeats
    included; a bit is set where over half of the hashes have it. No words: 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = shingle_hashes(words, shingle, seed)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[at : at + 8192], axis=1).sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: a bijection of 64-bit words that looks random."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_RANGES = np.arange(SKETCH_BITS, dtype=np.uint64)
_SALTS = mixed((_RANGES + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def sketch(text: str, shingle: int, seed: int = 42) -> tuple[int, int]:
    """128 bits of which two texts agree in a share of (1 + J) / 2, about, for the Jaccard similarity J of their shingles: the
    low bit of the least hash in each of 128 ranges; an empty range hashes all of the text's hashes anew and takes the least of
    them, so that the bits of a short text are as independent as those of a long one. No words: 0."""
    words = text.encode().lower().split()
    if not words:
        return 0, 0
    hashes = np.sort(shingle_hashes(words, shingle, seed).view(">u8").ravel().astype(np.uint64))
    least = hashes[np.minimum(np.searchsorted(hashes, _RANGES << np.uint64(57)), len(hashes) - 1)]
    empty = np.flatnonzero(least >> np.uint64(57) != _RANGES)
    if len(empty):
        distinct = hashes[np.r_[True, hashes[1:] != hashes[:-1]]]
        anew = np.full(len(empty), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(distinct), 1024):
            np.minimum(anew, mixed(distinct[None, at : at + 1024] ^ _SALTS[empty, None]).min(axis=1), out=anew)
        least[empty] = anew
    high, low = np.packbits((least & np.uint64(1)).astype(np.uint8)).view(">i8").tolist()
    return high, low


def _per_text(df: DataFrame, text_col: str, keep: Sequence[str], names: Sequence[str], make: Callable[[str], tuple[int, ...]]) -> DataFrame:
    """The ``keep`` columns and the 64-bit words that make gives for every whole text, as longs of these names; null is ''."""
    require(df, text_col, *keep)
    if clash := {k.lower() for k in keep} & set(names):
        raise ValueError(f"kept columns named as results: {', '.join(sorted(clash))}")
    keep = list(keep)
    schema = T.StructType([*(df.schema[k] for k in keep), *(T.StructField(n, T.LongType(), False) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            made = np.array([make(t or "") for t in batch.column(len(keep)).to_pylist()], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(m, pa.int64()) for m in made.T)], names=[*keep, *names])

    return df.select(*keep, text_col).mapInArrow(run, schema)


def simhash(df: DataFrame, shingle: int, text_col: str = "text", keep: Sequence[str] = ("doc_id",), seed: int = 42) -> DataFrame:
    """The ``keep`` columns and ``fingerprint`` (long, the bits of :func:`fingerprint`) of every whole text; null is ''."""
    return _per_text(df, text_col, keep, ["fingerprint"], lambda t: ((f := fingerprint(t, shingle, seed)) - (f >> 63 << 64),))


def sketches(df: DataFrame, shingle: int, text_col: str = "text", keep: Sequence[str] = ("doc_id",), seed: int = 42) -> DataFrame:
    """The ``keep`` columns, ``sketch_a`` and ``sketch_b`` (longs, the bits of :func:`sketch`) of every whole text; null is ''."""
    return _per_text(df, text_col, keep, SKETCH, lambda t: sketch(t, shingle, seed))


@lru_cache(maxsize=8)
def part_code(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For a part of so many bits: masks[s], the error patterns of at most 2 bits that lead from a word of syndrome s to an
    anchor, first the home's (at most 1 bit), filled up with -1; and the parity masks whose parities make the syndrome."""
    r = 1
    while 2 ** (r + 1) - 1 <= bits:
        r += 1
    n = 2**r - 1
    free = range(n, bits)
    parity = np.array([sum(1 << (i - 1) for i in range(1, n + 1) if i >> j & 1) for j in range(r)], np.int64)
    rows = []
    for s in range(n + 1):
        near = 1 << (s - 1) if s else 0
        pairs = [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, n + 1) if s and i < i ^ s]
        one_free = [near | 1 << f for f in free]
        two_free = [1 << f | 1 << g for f in free for g in free if f < g] if not s else []
        rows.append([near, *pairs, *one_free, *two_free])
    width = max(map(len, rows))
    return np.array([row + [-1] * (width - len(row)) for row in rows], np.int64), parity


def parts_of(max_bits: int) -> int:
    parts = max(2, max_bits // 2 + 1)
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be 0 to 7: beyond, a part has too few bits to tell fingerprints apart")
    return parts


def anchors(fps: np.ndarray, part: int, parts: int, word_no: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (index of the fingerprint, anchor, role) of one part of uint64 fingerprints, or of a sketch's words
    with this number."""
    bits = 64 // parts
    masks, parity = part_code(bits)
    word = ((fps >> np.uint64(part * bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)
    syndrome = np.zeros(len(fps), np.int64)
    for j, p in enumerate(parity):
        syndrome |= (np.bitwise_count(word & p) & 1).astype(np.int64) << j
    error = masks[syndrome]
    row, column = np.nonzero(error >= 0)
    anchor = word[row] ^ error[row, column] | word_no * parts + part << 40
    return row, anchor, np.where(column == 0, HOME | REPLICA, REPLICA).astype(np.int32)


def replicas(nodes: DataFrame, max_bits: int, key: Sequence[str]) -> DataFrame:
    """Rows (anchor, role, key...) of every node, at the anchors of each word of its key."""
    parts, names = parts_of(max_bits) if len(key) == 1 else SKETCH_PARTS, ["anchor", "role", *key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 4096):
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for word_no, part in product(range(len(key)), range(parts)):
                row, anchor, role = anchors(columns[word_no].view(np.uint64), part, parts, word_no)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(role), *(pa.array(c[row]) for c in columns)], names=names)

    return nodes.select(*key).mapInArrow(run, "anchor bigint, role int, " + ", ".join(f"{k} bigint" for k in key))


def forest(groups: np.ndarray, roles: np.ndarray, words: Sequence[np.ndarray], limits: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (row, row) that span the links within each group; groups are numbers in ascending order. Rows are linked
    where their words (a fingerprint, or the two of a sketch) differ in at most the last limit's bits in all; pairs within a
    smaller limit are taken first."""
    n = len(groups)
    place = label = np.arange(n)
    label = label.copy()
    home = (roles & HOME) > 0
    made: list[tuple[np.ndarray, np.ndarray]] = []

    def bits(i, j):
        return sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int64) for w in words)

    def join(i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            high, low = np.maximum(a, b), np.minimum(a, b)
            order = np.lexsort((low, high))
            first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
            label[high[first]] = low[first]
            made.append((i[first], j[first]))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up

    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, n])
    size_of = np.repeat(sizes, sizes)
    small = size_of <= 64
    near: list[tuple[np.ndarray, np.ndarray]] = []
    for lag in range(1, min(64, int(size_of[small].max(initial=1)))):
        i = place[:-lag][small[:-lag] & (groups[:-lag] == groups[lag:]) & (home[:-lag] | home[lag:])]
        d = bits(i, i + lag)
        i, d = i[d <= limits[-1]], d[d <= limits[-1]]
        for turn, limit in enumerate(limits):
            mine = i[(d <= limit) & (d > (limits[turn - 1] if turn else -1))]
            near.append((mine, mine + lag)) if turn else join(mine, mine + lag)
    large = [(a, a + n) for a, n in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True)]
    for turn, limit in enumerate(limits):
        for i, j in near[turn - 1 :: len(limits) - 1] if turn else []:
            join(i, j)
        for start, stop in large:
            inside = place[start:stop]
            for at in range(start, stop, 256):
                mine = place[at : min(at + 256, stop)]
                mine = mine[home[mine]]
                d = sum(np.bitwise_count(w[mine][:, None] ^ w[inside][None, :]).astype(np.int16) for w in words)
                x, y = np.nonzero((d <= limit) & (label[mine][:, None] != label[inside][None, :]))
                join(mine[x], inside[y])
    return (np.concatenate([i for i, _ in made]), np.concatenate([j for _, j in made])) if made else (place[:0], place[:0])


def node(key: Sequence[str], prefix: str = "") -> Column:
    """The key as one column: the fingerprint, or a struct of the sketch's words."""
    return F.col(prefix + key[0]).alias("node") if len(key) == 1 else F.struct(*[F.col(prefix + k).alias(k) for k in key]).alias("node")


def links(nodes: DataFrame, max_bits: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) between nodes that connect all that are linked at an anchor (nodes: distinct fingerprints, or distinct
    sketches)."""
    key = ["fingerprint"] if "fingerprint" in nodes.columns else SKETCH
    rows = replicas(nodes, max_bits, key)
    probe = replicas(nodes.where(F.pmod(F.xxhash64(*key), F.lit(PROBE)) == 0), max_bits, key)
    hot, hot_path = materialise(probe.groupBy("anchor").agg((F.count("*") * PROBE).alias("n")).where(F.col("n") > cell_rows).select("anchor", F.ceil(F.col("n") / cell_rows).cast("int").alias("cells")), "hot-anchors")
    if hot.isEmpty():
        cells = rows.withColumn("cell", F.lit(0))
        discard(nodes.sparkSession, hot_path)
    else:
        dealt = rows.join(hot, "anchor", "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
        mine = F.pmod(F.xxhash64(*key), F.col("cells")).cast("int")
        other = F.sequence(F.lit(0), F.col("cells") - 1)
        split = F.col("cells") > 1
        as_home = F.when((F.col("role").bitwiseAND(HOME) > 0) & split, F.transform(other, lambda o: F.struct((mine * F.col("cells") + o).alias("cell"), F.lit(HOME).alias("role"))))
        as_replica = F.when(split, F.transform(other, lambda o: F.struct((o * F.col("cells") + mine).alias("cell"), F.lit(REPLICA).alias("role"))))
        whole = F.when(~split, F.array(F.struct(F.lit(0).alias("cell"), F.col("role"))))
        none = F.array().cast("array<struct<cell:int,role:int>>")
        placed = F.explode(F.concat(*[F.coalesce(x, none) for x in (whole, as_home, as_replica)])).alias("p")
        cells = dealt.select("anchor", *key, placed).select("anchor", *key, "p.role", "p.cell")

    made = [f"{side}_{k}" for side in "ab" for k in key]
    limits = [max_bits] if len(key) == 1 else sorted({max_bits // 4, max_bits // 2, max_bits * 3 // 4, max_bits})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows_held = 0

        def settle(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows_held
            anchor, cell, role, *words = (np.concatenate(x) for x in zip(*held, strict=True))
            turn = np.flatnonzero((anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])) + 1
            cut = len(anchor) if final else int(turn[-1]) if len(turn) else 0
            group = np.zeros(len(anchor), np.int64)
            group[turn] = 1
            group = np.cumsum(group)
            held, rows_held = [(anchor[cut:], cell[cut:], role[cut:], *(w[cut:] for w in words))], len(anchor) - cut
            if cut:
                a, b = forest(group[:cut], role[:cut], [w[:cut].view(np.uint64) for w in words], limits)
                # each pair one way round, so that anchors that find the same one agree
                turned = np.lexsort(np.stack([np.r_[w[a], w[b]] for w in reversed(words)]))
                place = np.empty(len(turned), np.int64)
                place[turned] = np.arange(len(turned))
                swap = place[: len(a)] > place[len(a) :]
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                yield pa.RecordBatch.from_arrays([pa.array(w[side]) for side in (a, b) for w in words], names=made)

        limit = 200_000
        for batch in batches:
            if batch.num_rows:
                held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3 + len(key))))
                rows_held += batch.num_rows
                if rows_held >= limit:
                    yield from settle(False)
                    limit = max(200_000, 2 * rows_held)
        if rows_held:
            yield from settle(True)

    dealt_out = cells.select("anchor", "cell", "role", *key).repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")
    edges = dealt_out.mapInArrow(run, ", ".join(f"{m} bigint" for m in made)).distinct()
    return edges.select(node(key, "a_").alias("a"), node(key, "b_").alias("b"))


def near_components(fps: DataFrame, id_col: str = "doc_id", max_bits: int = 3, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, list[str]]:
    """Rows of fps (any columns, among them id_col and ``fingerprint``) with ``component_id``: the least id reachable over
    links of at most max_bits differing bits, the row's own included; null ids count only where a component has no other.
    fps is read twice, so give it as a written table. Also the scratch tables that the rows are still read from."""
    key = ["fingerprint"]
    require(fps, id_col, *key)
    nodes, nodes_path = materialise(fps.groupBy(*key).agg(F.min(id_col).alias("least")), "nodes")
    roots, roots_path = materialise(components(links(nodes, max_bits, cell_rows)), "roots")
    named = nodes.select(node(key), *key, "least")
    linked = named.join(roots, "node").select(*key, "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("least"))
    labels = linked.drop("least").join(least, "root").select(*key, F.col("least").alias("component_id"))
    alone = named.join(roots, "node", "left_anti").select(*key, F.col("least").alias("component_id"))
    return fps.join(labels.unionByName(alone), key), [nodes_path, roots_path]


def simhash_components(df: DataFrame, shingle: int = 3, max_bits: int = 3, text_col: str = "text", id_col: str = "doc_id", cell_rows: int = CELL_ROWS) -> DataFrame:
    """id_col, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row, as a written table.

    Null and empty texts have fingerprint 0 and link like any other; repeated rows come back each; rows with a null id get
    their component's least id, null if it has none; an empty table gives no rows; other columns are ignored.
    """
    fps, path = materialise(simhash(df, shingle, text_col, [id_col]), "fingerprints")
    rows, paths = near_components(fps, id_col, max_bits, cell_rows)
    out, _ = materialise(rows.select(id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"), "simhash")
    discard(df.sparkSession, path, *paths)
    return out


def shingle_sets(texts: DataFrame, shingle: int, seed: int = 42) -> DataFrame:
    """The sketch's words and ``shingles``: the distinct 32-bit hashes, ascending, of the runs of words of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            cut = [(t or "").encode().lower().split() for t in batch.column(2).to_pylist()]
            made = [np.unique(shingle_hashes(w, shingle, seed)[:, :4].copy().view(np.uint32)).tobytes() if w else b"" for w in cut]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, pa.binary())], names=[*SKETCH, "shingles"])

    return texts.select(*SKETCH, "text").mapInArrow(run, "sketch_a bigint, sketch_b bigint, shingles binary")


def alike(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> tuple[DataFrame, list[str]]:
    """Of pairs (a, b: sketches) those whose texts (sketch_a, sketch_b, text: one a sketch) have a Jaccard similarity of runs of
    words of at least ``similarity``, and the scratch tables that they are read from."""
    ends, ends_path = materialise(pairs.select("a.*").unionByName(pairs.select("b.*")).distinct(), "near-ends")
    few = ends.count() <= BROADCAST_NODES  # then texts stay where they are; else both sides are dealt by sketch
    sets, sets_path = materialise(shingle_sets(texts.join(F.broadcast(ends) if few else ends, SKETCH, "left_semi"), shingle), "near-sets")
    side = lambda s: sets.select(node(SKETCH).alias(s), F.col("shingles").alias(f"{s}_shingles"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a.*", F.col("b.sketch_a").alias("other_a"), F.col("b.sketch_b").alias("other_b"), "a_shingles", "b_shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yes = []
            for x, y in zip(batch.column(4), batch.column(5), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32)
                both = len(np.intersect1d(x, y, assume_unique=True))
                yes.append(both > 0 and both / (len(x) + len(y) - both) >= similarity)
            yield batch.select([0, 1, 2, 3]).filter(pa.array(yes, pa.bool_()))

    kept = joined.mapInArrow(run, "sketch_a bigint, sketch_b bigint, other_a bigint, other_b bigint")
    other = F.struct(F.col("other_a").alias("sketch_a"), F.col("other_b").alias("sketch_b"))
    return kept.select(node(SKETCH).alias("a"), other.alias("b")), [ends_path, sets_path]


def one_of_each(df: DataFrame, shingle: int = 5, similarity: float = 0.8, text_col: str = "text", id_col: str = "doc_id", cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row, all its columns, of each group of near copies: that with the least id (null last), ties to the least hash of
    the text. Texts are near copies where their runs of ``shingle`` words have a Jaccard similarity of at least
    ``similarity``, and groups are what such links connect.

    Sketches propose pairs, up to ``SPREAD`` standard errors beyond the similarity, whatever was edited, and where; every
    pair is then decided by the texts' own runs. Texts of one sketch are one from the start (at a similarity of 0.8 its 128
    bits agree by chance in one pair of a million); null and empty texts have the same; an empty table gives no rows. Rows
    travel as structs, so other columns may have any names. The first choice, of each sketch, is an aggregate, so a group of
    any size is narrowed down where its rows are read.
    """
    names = df.columns
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text_col).alias("text"))
    row_id = F.col(f"row.`{id_col}`")
    order = F.struct(row_id.isNull().alias("none"), row_id.alias("id"), F.xxhash64(F.col(f"row.`{text_col}`")).alias("h"))
    first = sketches(packed, shingle, "text", ["row"]).groupBy(*SKETCH).agg(F.min_by("row", order).alias("row"))
    firsts, _ = materialise(first, "near-firsts")
    share = (1 - similarity) / 2  # of bits that differ, at the similarity
    most = int(SKETCH_BITS * share + SPREAD * (SKETCH_BITS * share * (1 - share)) ** 0.5)
    pairs, pairs_path = materialise(links(firsts.select(*SKETCH), most, cell_rows), "near-pairs")
    linked, paths = alike(pairs, firsts.select(*SKETCH, F.col(f"row.`{text_col}`").alias("text")), shingle, similarity)
    roots, roots_path = materialise(components(linked), "near-roots")
    placed = firsts.select(node(SKETCH), order.alias("order")).join(roots, "node")
    best = placed.groupBy("root").agg(F.min(F.struct("order", "node")).alias("best"))
    gone, _ = materialise(placed.join(best, "root").where(F.col("node") != F.col("best.node")).select("node.*"), "near-gone")
    discard(df.sparkSession, pairs_path, roots_path, *paths)
    return firsts.join(gone, SKETCH, "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in names])
