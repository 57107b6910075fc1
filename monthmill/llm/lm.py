"""Language-model scoring by prediction by partial matching over bytes.

A text's symbols are the bytes of its words (A-Z lower-cased, joined by one space) and an end mark; the context of a symbol
is the ``ORDER`` bytes before it, filled up with a start mark. The model is a byte-context trie counted over the training
texts. A symbol is coded in the longest context that has been seen; a context of total count C with d different symbols
gives a symbol of count c the share (2c-1)/2C and keeps d/2C for escaping to the next shorter context, in which the
symbols of the longer one are excluded from both counts. Below order 0 all 256 values that remain are alike. The model is
pretrained, so a text's code length is a sum over its (context, symbol) grams.

A gram is a long: the context's bytes, nearest first, then the symbol. In that order all grams of a context stand together,
and so do those of each shorter one: a sorted array of grams is the trie. Sorted arrays are what moves, one row a piece:

1. Texts are read where they lie and cut into blocks that hold at most about ``BLOCK_KEYS`` distinct grams and words; a
   block's texts and its counts are written once. A text over ``PIECE_BYTES`` goes on in further pieces, in any block.
2. Counts are dealt by a hash of the nearest three context bytes (words: of the word), and added up block by block; where
   there are many blocks, first over some of them.
3. With the counts of orders 0 to 2, a broadcast that cannot exceed 2**24 entries, each dealing holds all that the prices of
   its grams need.
4. Prices meet the blocks' grams in the same dealing, the prices first, so that blocks stream past them, and go back to
   their blocks, past which the texts stream.

A task thus holds the distinct keys of one block or of one dealing. Dealings grow in number with the text, without a limit,
so on average one has at most 4 M distinct grams or words, whatever the text. A dealing has at least one context of three
bytes whole, which has at most 2**24 grams at order 5, far fewer in text; so a block has no more rows of grams than it has
such contexts, however many dealings there are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, require, text_slices

#: Bytes of context.
ORDER = 5
#: Distinct grams and words of a block, about, at most; bounds what a task holds.
BLOCK_KEYS = 3_000_000
#: Bytes of text that a task reads, about; larger blocks share more.
TASK_BYTES = 32_000_000
#: Bytes of a text beyond which it goes on in a further piece, from the next space on.
PIECE_BYTES = 4_000_000
#: Bytes that are turned into grams at once.
CHUNK = 1_000_000
#: Bytes of text for each dealing of keys, so that a dealing has no more distinct grams than these bytes, whatever the corpus.
BUCKET_BYTES = 4_000_000
#: Blocks whose counts are added up in one task.
MERGED_BLOCKS = 1000
#: Values that no UTF-8 text has: before the first byte, and after the last.
START, END = 0xFE, 0xFF
GRAM, WORD, TEXT = 0, 1, 2
#: A block's number: its task's, shifted by so many bits, and its place in that task.
BLOCK_SHIFT = 24


def pieces(text: str, order: int = ORDER, limit: int = PIECE_BYTES) -> Iterator[tuple[bytes, bool]]:
    """A text's symbols in pieces of about so many bytes that end before a space, each behind its context; is it the last?"""
    body = b" ".join(text.encode().lower().split())
    at, context = 0, bytes([START]) * order
    while len(body) - at > limit:
        end = body.find(b" ", at + limit)
        if end < 0:
            break
        yield context + body[at:end], False
        context, at = body[end - order : end], end
    yield context + body[at:] + bytes([END]), True


def grams(parts: Sequence[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The grams of pieces, in order, and how many each piece has."""
    size = np.fromiter(map(len, parts), np.int64, len(parts)) - order
    raw = np.frombuffer(b"".join(parts), np.uint8)
    n = len(raw) - order
    if n <= 0:
        return np.zeros(0, np.int64), size
    packed = raw[order - 1 : order - 1 + n].astype(np.int64)
    for k in [*range(order - 2, -1, -1), order]:
        packed <<= 8
        packed |= raw[k : k + n]
    # windows that straddle two pieces are those that end on a context
    keep = np.ones(len(raw), bool)
    at = np.cumsum(size + order) - size - order
    for k in range(order):
        keep[at + k] = False
    return packed[keep[order:]], size


def shorter(keys: np.ndarray, by: int) -> np.ndarray:
    """Grams with the farthest ``by`` bytes of their context taken off."""
    return keys >> 8 * (by + 1) << 8 | keys & 0xFF


def runs(values: np.ndarray) -> np.ndarray:
    """Where each stretch of equal values begins."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = runs(keys)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


class Tally:
    """Counts by key in sorted runs, of which the last two are merged while they are of like size."""

    def __init__(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return sum(len(k) for k, _ in self.runs)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.runs.append((keys, counts))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 2 * len(self.runs[-1][0]):
            self._merge()

    def _merge(self) -> None:
        b, a = self.runs.pop(), self.runs.pop()
        self.runs.append(summed(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])))

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All counts; none are left."""
        while len(self.runs) > 1:
            self._merge()
        return self.runs.pop() if self.runs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def to_bytes(values: np.ndarray) -> bytes:
    """Longs as the bytes of their differences, highest bytes together, which compress well where values ascend."""
    return np.diff(values, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel())


def word_hashes(words: Iterable[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(w) for w in words], np.uint64).view(np.int64)


def buckets_of(kind: int, keys: np.ndarray, buckets: int, order: int) -> np.ndarray:
    """The dealing of each key: all grams whose contexts share their nearest three bytes have the same."""
    near = (keys >> 8 * (order - 2) if kind == GRAM else keys).view(np.uint64)
    return ((near * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int16 if buckets <= 1 << 15 else np.int32)


def count_chunk(parts: Sequence[bytes], train: np.ndarray, order: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By kind, the distinct keys of pieces and how often they are in the training ones."""
    keys, size = grams(parts, order)
    keys <<= 1
    keys |= np.repeat(train.astype(np.int64), size)
    keys.sort()
    flag = keys & 1
    keys >>= 1
    at = runs(keys)
    words: Counter = Counter()
    others: set[bytes] = set()
    for part, flagged in zip(parts, train.tolist(), strict=True):
        (words if flagged else others).update(part[order:].rstrip(b"\xff").split())
    others.difference_update(words)
    counts = np.r_[np.fromiter(words.values(), np.int64, len(words)), np.zeros(len(others), np.int64)]
    return {GRAM: (keys[at], np.add.reduceat(flag, at) if len(at) else flag), WORD: summed(word_hashes([*words, *others]), counts)}


def prices(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray, order: int, low: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 probability of each wanted gram. keys: distinct training grams with their counts, at least all those whose
    contexts share the nearest three bytes with a wanted one's; low: grams of orders 0 to 2 and their counts over everything."""
    grams_of = dict(low)
    seen = counts > 0
    grams_of[order] = keys[seen], counts[seen]
    for k in range(order - 1, 2, -1):
        longer, n = grams_of[k + 1]
        grams_of[k] = summed(shorter(longer, 1), n)
    contexts, total, kinds, shadow = {}, {}, {}, {}
    for k in range(order + 1):
        g, n = grams_of[k]
        at = runs(g >> 8)
        contexts[k] = g[at] >> 8
        total[k] = np.add.reduceat(n, at) if len(at) else n
        kinds[k] = np.diff(np.r_[at, len(g)])
        if k:  # what the symbols of this context count in the next shorter one
            below = look_up(*grams_of[k - 1], shorter(g, 1))
            shadow[k] = np.add.reduceat(below, at) if len(at) else below
    log = np.zeros(len(wanted))
    open_ = np.ones(len(wanted), bool)  # not coded yet
    out_n, out_kinds = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)  # excluded: count, different symbols
    for k in range(order, -1, -1):
        gram = shorter(wanted, order - k)
        all_n, all_kinds = look_up(contexts[k], total[k], gram >> 8), look_up(contexts[k], kinds[k], gram >> 8)
        n, d = all_n - out_n, all_kinds - out_kinds
        c = look_up(*grams_of[k], gram)
        live = open_ & (d > 0)
        hit, miss = live & (c > 0), live & (c == 0)
        log[hit] += np.log10((2 * c[hit] - 1) / (2 * n[hit]))
        log[miss] += np.log10(d[miss] / (2 * n[miss]))
        open_ &= ~hit
        if k:
            out_n, out_kinds = look_up(contexts[k], shadow[k], gram >> 8), all_kinds
    log[open_] -= np.log10(max(1, 256 - len(grams_of[0][0])))
    return log


def look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of wanted keys, 0 where they are not there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def low_orders(keys: np.ndarray, counts: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Grams of orders 0 to 2 from those of order 2."""
    out = {2: summed(keys, counts)}
    for k in (1, 0):
        out[k] = summed(shorter(out[k + 1][0], 1), out[k + 1][1])
    return out


def code_lengths(parts: Sequence[bytes], keys: np.ndarray, values: np.ndarray, order: int) -> np.ndarray:
    """The sum of each piece's prices; at most 2**16 pieces of order 5, 2**8 of order 6. Grams are sorted together with
    their piece's number, so that each distinct one is looked up once, in ascending order."""
    g, size = grams(parts, order)
    bits = np.uint64(64 - 8 * (order + 1))
    tagged = g.view(np.uint64) << bits | np.repeat(np.arange(len(parts), dtype=np.uint64), size)
    tagged.sort()
    piece = (tagged & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)
    tagged >>= bits
    at = runs(tagged)
    price = values[np.searchsorted(keys, tagged[at].view(np.int64))]
    return np.bincount(piece, np.repeat(price, np.diff(np.r_[at, len(tagged)])), len(parts))


def train_fold(id_col: Column) -> Column:
    """Rows that a model may learn from: crc32 of the id as text, modulo 7, is not 2 (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(7)) != 2


def _cut(docs: DataFrame, order: int, buckets: int, block_keys: int, piece_bytes: int) -> DataFrame:
    """Rows of three kinds from docs (ids, body, train): pieces of texts, and the counts of grams and words of each block."""
    names = ["kind", "block", "bucket", "keys", "counts", "row", "ids", "train", "last", "part"]
    kinds = [T.ByteType(), T.LongType(), T.IntegerType(), T.BinaryType(), T.BinaryType(), T.LongType(), docs.schema["ids"].dataType, T.BooleanType(), T.BooleanType(), T.BinaryType()]
    arrow = [pa.int8(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), None, pa.bool_(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId()
        block, row, tally, ids_type = first << BLOCK_SHIFT, first << 36, {GRAM: Tally(), WORD: Tally()}, None

        def rows(n: int, **columns) -> pa.RecordBatch:
            full = {"block": pa.array([block] * n, pa.int64())} | columns
            return pa.RecordBatch.from_arrays([full[c] if c in full else pa.nulls(n, t or ids_type) for c, t in zip(names, arrow, strict=True)], names=names)

        def close() -> Iterator[pa.RecordBatch]:
            for kind in (GRAM, WORD):
                keys, counts = tally[kind].take()
                deal = buckets_of(kind, keys, buckets, order)
                by = np.argsort(deal, kind="stable")
                deal, keys, counts = deal[by], keys[by], counts[by]
                ends = np.r_[runs(deal), len(deal)].tolist()
                cuts = [(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                if cuts:
                    yield rows(len(cuts), kind=pa.array([kind] * len(cuts), pa.int8()), bucket=pa.array(deal[ends[:-1]], pa.int32()), keys=pa.array([to_bytes(keys[a:b]) for a, b in cuts], pa.binary()), counts=pa.array([to_bytes(counts[a:b]) for a, b in cuts], pa.binary()))

        def settle(batch: pa.RecordBatch, train: list[bool], held: list[tuple[int, int, bool, bytes]]) -> Iterator[pa.RecordBatch]:
            nonlocal block
            at, row_of, last, parts = (list(c) for c in zip(*held, strict=True))
            flags = np.array([train[i] for i in at], bool)
            for kind, counted in count_chunk(parts, flags, order).items():
                tally[kind].add(*counted)
            yield rows(len(at), kind=pa.array([TEXT] * len(at), pa.int8()), row=pa.array(row_of, pa.int64()), ids=batch.column(0).take(pa.array(at)), train=pa.array(flags), last=pa.array(last), part=pa.array(parts, pa.binary()))
            if len(tally[GRAM]) + len(tally[WORD]) >= block_keys:
                yield from close()
                block += 1

        for batch in text_slices(batches):
            ids_type = batch.column(0).type
            train = batch.column(2).to_pylist()
            held: list[tuple[int, int, bool, bytes]] = []
            size = 0
            for i, text in enumerate(batch.column(1)):
                for part, last in pieces(text.as_py(), order, piece_bytes):
                    held.append((i, row, last, part))
                    size += len(part)
                    if size >= CHUNK:
                        yield from settle(batch, train, held)
                        held, size = [], 0
                row += 1
            if held:
                yield from settle(batch, train, held)
        yield from close()

    return docs.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


def _added_up(packs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts of each group's rows added up: one row (by, keys, counts) for each."""
    by = list(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, now = Tally(), None

        def settle() -> pa.RecordBatch:
            keys, counts = tally.take()
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in now), pa.array([to_bytes(keys)], pa.binary()), pa.array([to_bytes(counts)], pa.binary())], names=[*by, "keys", "counts"])

        for batch in batches:
            groups = list(zip(*(c.to_pylist() for c in batch.columns[: len(by)]), strict=True))
            for i, group in enumerate(groups):
                if group != now:
                    if now is not None:
                        yield settle()
                    now = group
                tally.add(from_bytes(batch.column(len(by))[i].as_py()), from_bytes(batch.column(len(by) + 1)[i].as_py()))
        if now is not None:
            yield settle()

    dealt = packs.select(*[F.col(c).cast("bigint").alias(c) for c in by], "keys", "counts").repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, ", ".join(f"{c} bigint" for c in by) + ", keys binary, counts binary")


def _low(totals: DataFrame, order: int) -> pa.Table:
    """Grams of order 2 with their counts: at most 2**24 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, counts = summed(shorter(from_bytes(batch.column(0)[i].as_py()), order - 2), from_bytes(batch.column(1)[i].as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(keys[counts > 0]), pa.array(counts[counts > 0])], names=["key", "n"])

    return totals.where(F.col("kind") == GRAM).select("keys", "counts").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()


def _priced(totals: DataFrame, low, order: int) -> DataFrame:
    """(kind, bucket, keys, prices, seen, tokens): log10 probabilities of grams; of words, log10(count + 1). seen: keys that
    training has, tokens: how often in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                kind, bucket, raw, n = (batch.column(c)[i].as_py() for c in range(4))
                keys, counts = from_bytes(raw), from_bytes(n)
                value = prices(keys, counts, keys, order, low.value) if kind == GRAM else np.log10(counts + 1.0)
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int64()), pa.array([bucket], pa.int64()), pa.array([raw], pa.binary()), pa.array([value.tobytes()], pa.binary()), pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())])], names=["kind", "bucket", "keys", "prices", "seen", "tokens"])

    return totals.select("kind", "bucket", "keys", "counts").mapInArrow(run, "kind bigint, bucket bigint, keys binary, prices binary, seen bigint, tokens bigint")


def _handed_out(priced: DataFrame, packs: DataFrame, salts: int) -> DataFrame:
    """(block, kind, keys, prices): what the keys of each block cost. A dealing's prices come first, its blocks stream past."""
    by = ["kind", "bucket", "salt"]
    known = priced.select("kind", "bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(-1).cast("bigint").alias("block"), "keys", "prices")
    asked = packs.select(F.col("kind").cast("bigint").alias("kind"), F.col("bucket").cast("bigint").alias("bucket"), F.pmod("block", F.lit(salts)).cast("int").alias("salt"), "block", "keys", F.lit(None).cast("binary").alias("prices"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = values = np.zeros(0)
        for batch in batches:
            out: list[tuple] = []
            for i, (kind, block) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                raw = batch.column(4)[i].as_py()
                if block < 0:
                    keys, values = from_bytes(raw), np.frombuffer(batch.column(5)[i].as_py())
                else:
                    out.append((block, kind, raw, values[np.searchsorted(keys, from_bytes(raw))].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int8(), pa.binary(), pa.binary()), strict=True)], names=["block", "kind", "keys", "prices"])

    dealt = known.unionByName(asked).repartition(*by).sortWithinPartitions(*by, "block")
    return dealt.mapInArrow(run, "block bigint, kind tinyint, keys binary, prices binary")


def _scored(texts: DataFrame, answers: DataFrame, order: int, tasks: int) -> DataFrame:
    """(row, ids, train, words, known, base, code) of each piece; a block's prices come first, its texts stream past. Blocks
    are dealt evenly to so many tasks by the numbers they are made of."""
    none = lambda kind: F.lit(None).cast(kind)
    ids_type = texts.schema["ids"].dataType
    left = answers.select("block", "kind", "keys", "prices", none("bigint").alias("row"), none(ids_type).alias("ids"), none("boolean").alias("train"), none("binary").alias("part"))
    right = texts.select("block", "kind", none("binary").alias("keys"), none("binary").alias("prices"), "row", "ids", "train", "part")
    most = 1 << min(16, 64 - 8 * (order + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, ready = None, {}, {}

        def measured(batch: pa.RecordBatch, at: list[int], parts: list[bytes]) -> pa.RecordBatch:
            code = code_lengths(parts, *ready[GRAM], order)
            cut = [p[order:].rstrip(b"\xff").split() for p in parts]
            names = list(set().union(*cut))
            keys, values = ready[WORD]
            gain = dict(zip(names, values[np.searchsorted(keys, word_hashes(names))].tolist(), strict=True)) if names else {}
            gains = [[gain[w] for w in words] for words in cut]
            took = batch.take(pa.array(at))
            made = [pa.array([len(x) for x in gains], pa.int64()), pa.array([len(x) - x.count(0.0) for x in gains], pa.int64()), pa.array([math.fsum(x) for x in gains], pa.float64()), pa.array(code)]
            return pa.RecordBatch.from_arrays([took.column(4), took.column(5), took.column(6), *made], names=["row", "ids", "train", "words", "known", "base", "code"])

        for batch in text_slices(batches, 4096):
            blocks, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at: list[int] = []
            parts: list[bytes] = []
            size = 0
            for i, (block, kind) in enumerate(zip(blocks, kinds, strict=True)):
                if parts and (block != now or size >= CHUNK or len(parts) == most):
                    yield measured(batch, at, parts)
                    at, parts, size = [], [], 0
                if block != now:
                    now, known, ready = block, {GRAM: [], WORD: []}, {}
                if kind != TEXT:
                    known[kind].append((from_bytes(batch.column(2)[i].as_py()), np.frombuffer(batch.column(3)[i].as_py())))
                    continue
                if not ready:
                    for what, found in known.items():
                        keys, values = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, kind) for c, kind in ((0, np.int64), (1, np.float64)))
                        order_of = np.argsort(keys, kind="stable")
                        ready[what] = keys[order_of], values[order_of]
                    known = {}
                at.append(i)
                parts.append(batch.column(7)[i].as_py())
                size += len(parts[-1])
            if parts:
                yield measured(batch, at, parts)

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("ids", ids_type), T.StructField("train", T.BooleanType()), T.StructField("words", T.LongType()), T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("code", T.DoubleType())])
    turn = F.pmod(F.shiftright("block", BLOCK_SHIFT) + F.col("block").bitwiseAND((1 << BLOCK_SHIFT) - 1), F.lit(tasks)).cast("int")
    return left.unionByName(right).repartitionById(tasks, turn).sortWithinPartitions("block", "kind").mapInArrow(run, schema)


def score_texts(
    docs: DataFrame, train: Column, text_col: str = "text", keep: Sequence[str] = ("doc_id",), order: int = ORDER, block_keys: int = BLOCK_KEYS, task_bytes: int = TASK_BYTES, piece_bytes: int = PIECE_BYTES, merged_blocks: int = MERGED_BLOCKS
) -> DataFrame:
    """Code length of every whole text under the model of the rows where ``train`` holds.

    Returns the ``keep`` columns and ``held_out`` boolean, ``n_tokens`` long (words and one end), ``n_known`` long (tokens
    seen in training), ``train_tokens`` long, ``base_score`` double (add-one unigram of words) and ``score`` double (log10
    probability of the text under the model, end included). Null texts are ''; such a text is its end alone. Repeated rows
    count, and come back, each. Without training rows all symbols are alike; an empty table gives no rows; other columns are
    ignored. Words are told apart by 64-bit hashes. The result is a written table.
    """
    require(docs, text_col, *keep)
    if not 3 <= order <= 6:
        raise ValueError("order must be 3 to 6: a gram has at most 7 bytes in a long, and order 2 is the broadcast one")
    if piece_bytes <= order:
        raise ValueError("piece_bytes must be larger than the order")
    spark, keep = docs.sparkSession, list(keep)
    if clash := {k.lower() for k in keep} & {"held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}:
        raise ValueError(f"kept columns named as results: {', '.join(sorted(clash))}")
    body = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(body).cast("long"))).first()[0] or 0
    buckets = size // BUCKET_BYTES + 1
    tasks = max(spark.sparkContext.defaultParallelism, size // task_bytes + 1)
    ids = F.struct(*[F.col(f"`{k}`") for k in keep]).alias("ids")
    dealt = docs.select(ids, body.alias("body"), F.coalesce(train, F.lit(False)).alias("train")).coalesce(tasks)
    cut, cut_path = materialise(_cut(dealt, order, buckets, block_keys, piece_bytes), "lm-blocks")
    packs, texts = cut.where(F.col("kind") != TEXT), cut.where(F.col("kind") == TEXT)
    salts = -(-max(1, texts.select("block").distinct().count()) // merged_blocks)
    counts = packs.withColumn("salt", F.pmod("block", F.lit(salts)))
    totals, totals_path = materialise(_added_up(_added_up(counts, ["kind", "bucket", "salt"]) if salts > 1 else counts, ["kind", "bucket"]), "lm-totals")
    low = _low(totals, order)
    sent = spark.sparkContext.broadcast(low_orders(low.column("key").to_numpy(), low.column("n").to_numpy()))
    priced, priced_path = materialise(_priced(totals, sent, order), "lm-prices")
    seen, counted = priced.where(F.col("kind") == WORD).agg(F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    ends = texts.where(F.col("last") & F.col("train")).count()
    distinct, tokens = seen + (ends > 0), counted + ends
    answers = _handed_out(priced, packs.select("kind", "bucket", "block", "keys"), salts)
    parts = _scored(texts, answers, order, tasks)
    one = parts.groupBy("row").agg(F.first("ids").alias("ids"), F.first("train").alias("train"), *[F.sum(c).alias(c) for c in ("words", "known", "base", "code")])
    n = F.col("words") + 1
    out, _ = materialise(
        one.select(
            *[F.col(f"ids.`{k}`").alias(k) for k in keep],
            (~F.col("train")).alias("held_out"),
            n.alias("n_tokens"),
            (F.col("known") + int(ends > 0)).alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (F.col("base") + math.log10(ends + 1) - n * math.log10(tokens + distinct + 1)).alias("base_score"),
            F.col("code").alias("score"),
        ),
        "lm-scores",
    )
    discard(spark, cut_path, totals_path, priced_path)
    return out
