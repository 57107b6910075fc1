"""Conversation prefix trie: ternary search trees a block of range-sorted conversations, merged at the blocks' edges.

1. A turn becomes three longs, two hashes of (role, text) and the text's code points, where it is read; a conversation is the
   array of its turns' longs in order. Texts do not move.
2. Conversations are sorted by that array, then by id, over ranges, so that equal and alike ones stand together; the id splits
   a sequence of which there are very many over several ranges.
3. A task cuts its range into blocks of about ``BLOCK_TURNS`` turns. In a block the turns are dictionary-encoded, and the
   distinct sequences inserted into a ternary search tree, the median first, then those of either half, which balances the
   search among a node's children. One iterative traversal adds up each node's members, leaves and lengths.
4. A node away from its block's first and last path is complete. Those on the two paths may go on in the blocks beside it:
   their sums are added up over blocks, and what the blocks on either side of an edge both have counted, the path that they
   share, is taken off once (:func:`seams`).

A node's saving is a sum over its subtree of (members - 1) times length, that is what its members' turns have together less
what its distinct nodes have: two sums, so parts of a subtree add up. The ids of the conversations that end at a node are
hashed in order; those of a complete node where its block is, others in one more pass that streams them sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, require

#: Turns of a block, about; one conversation is never cut.
BLOCK_TURNS = 200_000
#: Ids of ends that stand in one row.
END_IDS = 10_000
#: Longs of a turn: two hashes and a length.
LANES = 3
NODE = "kind int, part int, block int, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, total bigint, own bigint, ends_sha256 string, ids array<bigint>, path array<bigint>"
INNER, EDGE, ENDS, BOUND = range(4)
ROOT = hashlib.blake2b(b"root", digest_size=16).digest()


def shared_turns(conv_id: Column) -> Column:
    """How many turns of its first neighbour a conversation begins with."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and the longs of each conversation's turns, as they are stored: by turn, null first, then role and hash."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", role.alias("role"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("turn"), text, role).alias("b"), F.length(text).cast("long").alias("n"))
    grouped = conversations.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return grouped.select("conv_id", F.flatten(F.transform("t", lambda t: F.array(t["a"], t["b"], t["n"]))).alias("seq"))


def rebuilt(conversations: DataFrame, share: int = 100) -> DataFrame:
    """Every conversation with the first turns of conversation c - c % share in place of its own first ones."""
    own, _ = materialise(sequences(conversations), "turns")
    head = own.where(F.col("conv_id") % share == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, 5 * LANES).alias("head"))
    h = shared_turns(F.col("conv_id")) * LANES
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % share).join(head, "base", "left")
    first = F.slice(F.coalesce("head", F.array().cast("array<bigint>")), F.lit(1), h)
    rest = F.slice("seq", h + 1, F.greatest(F.size("seq") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(first, rest).alias("seq"))


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, the median first, then those of either half."""
    todo = [(0, n)]
    while todo:
        low, high = todo.pop()
        if low < high:
            mid = (low + high) // 2
            yield mid
            todo += [(mid + 1, high), (low, mid)]


class TernaryTree:
    """A ternary search tree over sequences of numbers: nodes with a symbol, the nodes of smaller and larger symbols at the same
    place, and the first node of the place after it. Node 0 is the root, which has no symbol."""

    def __init__(self) -> None:
        self.symbol, self.low, self.high, self.after = [-1], [0], [0], [0]

    def insert(self, sequence: Sequence[int]) -> list[int]:
        """The nodes along the sequence, the root not among them."""
        symbol, low, high, after = self.symbol, self.low, self.high, self.after
        at, path = 0, []
        for s in sequence:
            link, node = after, at
            child = after[at]
            while child and symbol[child] != s:
                link, node = (low, child) if s < symbol[child] else (high, child)
                child = link[child]
            if not child:
                child = len(symbol)
                link[node] = child
                symbol.append(s)
                low.append(0)
                high.append(0)
                after.append(0)
            at = child
            path.append(at)
        return path

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """Nodes in order, parents before children and children by symbol, with each one's parent and depth."""
        order, parent, depth = [0], [-1] * len(self.symbol), [0] * len(self.symbol)
        todo = [(self.after[0], 0, False)]
        while todo:
            node, above, looked = todo.pop()
            if not node:
                continue
            if not looked:
                todo += [(self.high[node], above, False), (node, above, True), (self.low[node], above, False)]
            else:
                order.append(node)
                parent[node], depth[node] = above, depth[above] + 1
                todo.append((self.after[node], node, False))
        return order, parent, depth


def child_key(key: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(key + turn, digest_size=16).digest()


def block_nodes(ids: list[int], turns: list[np.ndarray], part: int, block: int) -> Iterator[dict]:
    """Rows of one block of conversations sorted by turns (arrays of LANES columns), then id."""
    flat = np.concatenate(turns)
    # the dictionary: turns numbered in the order that sequences are sorted by
    distinct, number = np.unique(flat, axis=0, return_inverse=True)
    number = number.ravel().tolist()
    lengths = distinct[:, 2].tolist()
    raw = [distinct[i].tobytes() for i in range(len(distinct))]
    at = np.r_[0, np.cumsum([len(t) for t in turns])].tolist()
    encoded = [number[at[i] : at[i + 1]] for i in range(len(ids))]
    new = [0] + [i for i in range(1, len(ids)) if encoded[i] != encoded[i - 1]]
    tree = TernaryTree()
    ends: dict[int, tuple[int, int]] = {}
    first_path: list[int] = []
    last_path: list[int] = []
    for k in median_order(len(new)):
        i = new[k]
        path = tree.insert(encoded[i])
        ends[path[-1] if path else 0] = (i, new[k + 1] if k + 1 < len(new) else len(ids))
        if k == 0:
            first_path = path
        if k == len(new) - 1:
            last_path = path
    order, parent, depth = tree.walk()
    size = len(tree.symbol)
    members, least, children, leaves, total, own = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size, [0] * size
    key: list[bytes] = [ROOT] * size
    length = [0] + [lengths[s] for s in tree.symbol[1:]]
    for node in order[1:]:
        key[node] = child_key(key[parent[node]], raw[tree.symbol[node]])
    for node in reversed(order):
        if node in ends:
            a, b = ends[node]
            members[node] += b - a
            least[node] = ids[a] if least[node] is None else min(ids[a], least[node])
        if not children[node]:
            leaves[node] = 1
        total[node] += members[node] * length[node]
        own[node] += length[node]
        if node:
            above = parent[node]
            members[above] += members[node]
            least[above] = least[node] if least[above] is None else min(least[above], least[node])
            children[above] += 1
            leaves[above] += leaves[node]
            total[above] += total[node]
            own[above] += own[node]
    edge = {0, *first_path, *last_path}
    for node in order:
        a, b = ends.get(node, (0, 0))
        above = parent[node]
        row = dict(kind=EDGE if node in edge else INNER, part=part, block=block, key=key[node], parent_key=key[above] if node else None, conv_id=least[node], depth=depth[node], n_convs=members[node], n_children=children[node], n_leaves=leaves[node], total=total[node], own=own[node])
        if node not in edge:
            row["ends_sha256"] = hashlib.sha256(",".join(map(str, ids[a:b])).encode()).hexdigest()
            if above not in edge:
                row["parent_conv_id"] = least[above]
        yield row
        if node in edge:
            for k in range(a, b, END_IDS):
                yield dict(kind=ENDS, key=key[node], conv_id=ids[k], ids=ids[k : min(b, k + END_IDS)])
    yield dict(kind=BOUND, part=part, block=block, n_children=0, path=turns[0].ravel(), key=b"first")
    yield dict(kind=BOUND, part=part, block=block, n_children=1, path=turns[-1].ravel(), key=b"last")


def nodes_of_blocks(rebuilt_rows: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Rows of all blocks: complete nodes, parts of nodes on an edge, ids that end on an edge, and the blocks' outer paths."""
    schema = [(f.split(" ", 1)[0]) for f in NODE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held = TaskContext.get().partitionId(), 0, []
        types = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("block", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), *[(c, pa.int64()) for c in schema[5:13]], ("ends_sha256", pa.string()), ("ids", pa.list_(pa.int64())), ("path", pa.list_(pa.int64()))])

        def out(ids, turns):
            rows = []
            for row in block_nodes(ids, turns, part, block):
                rows.append(row)
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_pylist(rows, types)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, types)

        ids: list[int] = []
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            offsets = batch.column("seq").offsets.to_numpy()
            values = batch.column("seq").values.to_numpy()
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                turns = values[offsets[i] : offsets[i + 1]].reshape(-1, LANES)
                if ids and size + len(turns) + 1 > block_turns:
                    yield from out(ids, held)
                    block, ids, held, size = block + 1, [], [], 0
                ids.append(conv)
                held.append(turns.copy())
                size += len(turns) + 1
        if ids:
            yield from out(ids, held)

    ordered = rebuilt_rows.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    return ordered.mapInArrow(run, NODE)


def seams(bounds: DataFrame) -> DataFrame:
    """For each edge between two blocks, what both have counted of the path that they share, negative, for each node on it:
    key, n_children, n_leaves, own; from the blocks' outer paths, two rows a block."""
    place = F.struct("part", "block")
    paths = bounds.groupBy("part", "block").agg(F.max(F.when(F.col("n_children") == 0, F.col("path"))).alias("head"), F.max(F.when(F.col("n_children") == 1, F.col("path"))).alias("tail"))
    w = Window.orderBy(place)  # a row a block
    pairs = paths.select(F.lag("tail").over(w).alias("tail"), "head").where(F.col("tail").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, children, leaves, own = [], [], [], []
            for tail, head in zip(*(batch.column(c) for c in ("tail", "head")), strict=True):
                a, b = (x.values.to_numpy().reshape(-1, LANES) for x in (tail, head))
                n = min(len(a), len(b))
                differ = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
                p = int(differ[0]) if len(differ) else n
                beyond = np.r_[np.cumsum(a[:p, 2][::-1])[::-1], 0]
                # the path of the block before ends where they part: it was a leaf there, and goes on in the next block
                ended = len(a) == p
                key = ROOT
                for depth in range(p + 1):
                    keys.append(key)
                    children.append(-1 if depth < p else 0)
                    leaves.append(-1 if ended else 0)
                    # a node's own length was counted twice as well as those below it
                    own.append(-int(beyond[depth] + (a[depth - 1, 2] if depth else 0)))
                    if depth < p:
                        key = child_key(key, np.ascontiguousarray(a[depth]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *[pa.array(x, pa.int64()) for x in (children, leaves, own)]], names=["key", "n_children", "n_leaves", "own"])

    return pairs.mapInArrow(run, "key binary, n_children bigint, n_leaves bigint, own bigint")


def hashed_ends(ends: DataFrame) -> DataFrame:
    """Of each key the digest of its ids, in ascending order, comma-joined; a key's rows stream past one state of the hash,
    which no two tasks can share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, digests = [], []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids"), strict=True):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        digests.append(state.hexdigest())
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(",".join(map(str, ids.values.to_pylist())).encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row a node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    conversations: conv_id, turn, role, text; other columns are ignored, whatever their names. Rows of a null conv_id belong to
    no conversation. Null roles and texts are empty; turns of one number stand by role, then by a hash; repeated rows are turns
    of their own. A conversation without turns ends at the root. An empty table has no members, and so no root: no rows.
    A conversation is one array of 24 bytes a turn; a node's turns are told apart by 128 bits of hashes.
    """
    require(conversations, "conv_id", "turn", "role", "text")
    if block_turns < 1:
        raise ValueError("block_turns must be at least 1")
    rows, _ = materialise(nodes_of_blocks(rebuilt(conversations), block_turns), "trie-blocks")
    of = lambda kind: rows.where(F.col("kind") == kind)
    parts = of(EDGE).select("key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "total", "own")
    fixed = parts.unionByName(seams(of(BOUND)), allowMissingColumns=True)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "total", "own")]
    edge, _ = materialise(fixed.groupBy("key").agg(F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums), "trie-edges")
    ends = edge.join(hashed_ends(of(ENDS)), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    columns = ["parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "total", "own", "ends_sha256"]
    above = edge.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    # few nodes are on edges, but very many may have one of them above: their join is split where a parent is hot
    inner = of(INNER).select(*columns)
    all_nodes = inner.unionByName(ends.withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*columns)).join(above, "parent_key", "left")
    return all_nodes.select("conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", (F.col("total") - F.col("own")).alias("saved_tokens"), "ends_sha256")
