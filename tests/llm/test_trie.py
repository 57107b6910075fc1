import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from monthmill.llm import trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """Nodes by prefix, each member looked at on its own."""
    stored = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            stored[c].append(((turn is not None, turn or 0), role or "", text or ""))
    stored = {c: [x[1:] for x in sorted(t, key=lambda x: x[:2])] for c, t in stored.items()}
    member, ends = defaultdict(set), defaultdict(list)
    for c, t in stored.items():
        h = zlib.crc32(str(c).encode()) % 6
        s = tuple(stored.get(c - c % 100, [])[:h] + t[h:])
        for d in range(len(s) + 1):
            member[s[:d]].add(c)
        ends[s].append(c)
    children = defaultdict(set)
    for p in member:
        if p:
            children[p[:-1]].add(p)
    below = defaultdict(lambda: [0, 0])
    for p in member:
        saved = (len(member[p]) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][0] += p not in children
            below[p[:d]][1] += saved
    return sorted((min(m), len(p), min(member[p[:-1]]) if p else -1, len(m), len(children[p]), *below[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in member.items())


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def conversations(seed, convs=150):
    """Few different turns, so that paths are shared; very many of one sequence; ids of several hundreds, some bases absent."""
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = rng.randrange(0, 900)
        same = rng.random() < 0.4
        for turn in range(3 if same else rng.randrange(1, 9)):
            rows.append((c * 1000 + rng.randrange(10**6) if same else c, turn, "user" if turn % 2 == 0 else rng.choice(["assistant", None]), f"same {turn}" if same else rng.choice(["ä", "bb", "ccc", "", None])))
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.mark.parametrize("block", [1, 7, 60, 10**6])
def test_against_brute_force(spark, block):
    rows = conversations(block)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(T.prefix_trie(df, block)) == plain(rows)


def test_edges(spark):
    assert T.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = [(None, 1, "user", "nobody's"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, None, None), (105, 1, "user", "x" * 1_000_000), (7, 3, "", ""), (200, 1, "user", "base"), (201, 9, "a", "b"), (-3, 1, "user", "below"), (-100, 1, "user", "base below")]
    clash = spark.createDataFrame([(*r, 1, b"k") for r in odd], SCHEMA + ", depth int, key binary")
    assert got(T.prefix_trie(clash, 2)) == plain_truncated(odd)
    # conversations that only have turns to give up end at the root
    lone = [(c, 0, "user", "only") for c in range(1, 60)]
    rows = got(T.prefix_trie(spark.createDataFrame(lone, SCHEMA), 5))
    assert rows == plain(lone) and rows[0][1:4] == (0, -1, 59)


def plain_truncated(rows):
    """The brute force for negative ids, whose remainder is negative in SQL."""
    shift = {r[0]: r[0] for r in rows}
    assert shift
    real = divmod

    class Id(int):
        def __mod__(self, n):
            return int(self) - int(int(self) / n) * n if n == 100 else real(int(self), n)[1]

    return plain([(None if r[0] is None else Id(r[0]), *r[1:]) for r in rows])


def test_a_hot_sequence_spans_blocks(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(3000, 4000) for t in range(6)] + [(3000 + c, 6, "user", f"more {c % 7}") for c in range(0, 1000, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(T.prefix_trie(df, 50)) == plain(rows)
    blocks = T.nodes_of_blocks(T.rebuilt(df), 50).where("kind = 3").select("part", "block").distinct()
    assert blocks.count() > 20


def test_tree_is_balanced_and_walked_in_order():
    words = sorted({tuple(random.Random(i).randrange(40) for _ in range(1 + i % 4)) for i in range(2000)})
    assert sorted(T.median_order(len(words))) == list(range(len(words)))
    tree = T.TernaryTree()
    paths = {words[k]: tree.insert(words[k]) for k in T.median_order(len(words))}
    order, parent, depth = tree.walk()
    assert len(order) == len(tree.symbol) == len({w[:d] for w in words for d in range(len(w) + 1)})
    assert all(depth[p] == d + 1 and (d == 0 or parent[p] == path[d - 1]) for path in paths.values() for d, p in enumerate(path))

    def levels(node):
        return 1 + max(levels(tree.low[node]), levels(tree.high[node])) if node else 0

    assert levels(tree.after[0]) <= 12  # 40 symbols, inserted in order they would be 40 deep
    long = T.TernaryTree()
    long.insert(range(200_000))
    assert len(long.walk()[0]) == 200_001


def test_a_long_conversation(spark):
    rows = [(400, t, "user", f"t{t % 3}") for t in range(3000)] + [(401, t, "user", f"t{t % 3}") for t in range(2500)]
    out = T.prefix_trie(spark.createDataFrame(rows, SCHEMA)).agg(F.max("depth"), F.count("*")).first()
    assert out[0] == 3000 and out[1] >= 3001
