import random

import numpy as np
import pytest
import xxhash

from monthmill.llm import simhash as S
from monthmill.llm.components import components


def plain_fingerprint(text, size):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(fps, ids, bits):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(fps)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least[find(i)] for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", "one", "one two", "One TWO three", "a b c d e f g a b c", "é   x\x1cy z", "w " * 70_000])
def test_fingerprint(text):
    assert S.fingerprint(text, 3) == plain_fingerprint(text, 3)


@pytest.mark.parametrize("bits", [16, 21, 32])
def test_covering(bits):
    """Every word has a home within one bit, and whoever is one bit away lists that home."""
    masks, parity = S.part_code(bits)
    rng = np.random.default_rng(bits)
    words = rng.integers(0, 1 << bits, 400).tolist()

    def around(w):
        s = sum(((w & int(p)).bit_count() & 1) << j for j, p in enumerate(parity))
        return [w ^ int(m) for m in masks[s] if m >= 0]

    for w in words:
        home = around(w)[0]
        assert (home ^ w).bit_count() <= 1 and around(home)[0] == home
        for b in range(bits):
            assert home in around(w ^ 1 << b)


def cluster(rnd, centre, n, flips):
    return [centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, flips + 1))) for _ in range(n)]


@pytest.mark.parametrize(("bits", "cell_rows"), [(3, 20_000), (3, 40), (5, 20_000), (1, 20_000), (0, 20_000)])
def test_components_of_fingerprints(spark, bits, cell_rows):
    rnd = random.Random(bits)
    fps = [0, 0, (1 << 64) - 1] + [rnd.getrandbits(64) for _ in range(100)]
    for _ in range(4):
        fps += cluster(rnd, rnd.getrandbits(64), 60, 4)
    chain = rnd.getrandbits(64)
    fps += [chain := chain ^ sum(1 << b for b in rnd.sample(range(64), max(1, bits))) for _ in range(20)]
    ids = rnd.sample(range(10_000), len(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame(list(zip(ids, signed, strict=True)), "doc_id bigint, fingerprint bigint")
    got = {r.doc_id: r.component_id for r in S.near_components(df, max_bits=bits, cell_rows=cell_rows)[0].collect()}
    want = plain_components(fps, ids, bits)
    assert [got[i] for i in ids] == want


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fps = [plain_fingerprint(d.text or "", 3) for d in docs]
    want = plain_components(fps, [d.doc_id for d in docs], 3)
    got = {r.doc_id: r for r in S.simhash_components(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    for d, f, c in zip(docs, fps, want, strict=True):
        assert (got[d.doc_id].fingerprint, got[d.doc_id].component_id) == (f"{f:016x}", c)


def test_edges(spark, odd_docs, no_docs):
    out = S.simhash_components(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = {r.doc_id: r for r in out}
    assert by[1].fingerprint == "0" * 16 and by[1].component_id == by[2].component_id == by[3].component_id == 1
    assert S.simhash_components(no_docs).count() == 0
    one = S.one_of_each(odd_docs)
    assert one.columns == odd_docs.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in one.collect()) == sorted([(False, i) for i in (1, 4, 5, 7, 8, 9)] + [(True, 0)])
    assert S.one_of_each(no_docs).count() == 0
    with pytest.raises(ValueError):
        S.parts_of(8)


def test_ids_that_repeat_do_not_merge_components(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h"), (1, "totally other words in this text here"), (None, "x y z"), (None, "p q r s")], "doc_id bigint, text string")
    assert S.one_of_each(df).count() == 4


def test_components_of_a_path(spark):
    n = 300
    rows = [(i, i + 1) for i in range(n)] + [(1000, 1000), (None, 5), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def jaccard(a, b, size=5):
    x, y = ({" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def edited(rnd, words, kind):
    """A copy of similarity 0.88 to 0.92, about, with a passage appended, the end cut off, or words swapped."""
    n = max(1, round(0.11 * len(words)))
    if kind == "appended":
        return words + [f"new{rnd.randrange(10**6)}" for _ in range(n)]
    if kind == "cut":
        return words[: len(words) - round(0.1 * len(words))]
    out = list(words)
    for i in rnd.sample(range(5, len(words) - 5), max(1, round(0.011 * len(words)))):
        out[i] = f"new{rnd.randrange(10**6)}"
    return out


@pytest.mark.parametrize("kind", ["appended", "cut", "scattered"])
def test_near_copies_of_every_kind_of_edit(spark, kind):
    rnd = random.Random(kind)
    rows = []
    for i in range(150):
        # words of their own for each text, and many of them twice, as in prose
        words = [f"w{i}x{int(rnd.random() ** 2 * 200)}" for _ in range(rnd.choice([120, 240, 400]))]
        copy = edited(rnd, words, kind)
        assert 0.84 < jaccard(" ".join(words), " ".join(copy)) < 0.96
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
    kept = {r.doc_id for r in S.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {2 * i for i in range(150)} <= kept
    assert sum(2 * i + 1 not in kept for i in range(150)) >= 0.95 * 150


@pytest.mark.parametrize("words", [1, 6, 30, 100, 300])
def test_sketches_tell_short_texts_apart(words):
    rnd = random.Random(words)
    a = [[f"w{rnd.randrange(10**9)}" for _ in range(words)] for _ in range(200)]
    made = [S.sketch(" ".join(w), 5) for w in a]
    bits = [sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(made[i], made[i + 1], strict=True)) for i in range(199)]
    assert min(bits) > 30 and abs(np.mean(bits) - 64) < 4


def test_recall_at_the_threshold_and_nothing_below_it(spark):
    """Pairs of texts at known similarities on both sides of 0.8, edited in every way."""
    rnd = random.Random(8)
    rows, above, below = [], [], []
    for i in range(500):
        n = rnd.choice([60, 150, 400])
        words = [f"w{i}x{int(rnd.random() ** 2 * 300)}" for _ in range(n)]
        kind, share = rnd.choice(["appended", "cut", "scattered"]), rnd.uniform(0.1, 0.4)
        if kind == "appended":
            copy = words + [f"new{rnd.randrange(10**6)}" for _ in range(round(share * n))]
        elif kind == "cut":
            copy = words[: n - round(share * n * 0.8)]
        else:
            copy = list(words)
            for at in rnd.sample(range(5, n - 5), max(1, round(share * n / 10))):
                copy[at] = f"new{rnd.randrange(10**6)}"
        a, b = " ".join(words), " ".join(copy)
        (above if jaccard(a, b) >= 0.8 else below).append(2 * i + 1)
        rows += [(2 * i, a), (2 * i + 1, b)]
    kept = {r.doc_id for r in S.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(above) > 100 and len(below) > 100
    assert {2 * i for i in range(500)} | set(below) <= kept
    assert sum(i not in kept for i in above) >= 0.9 * len(above)


def test_one_of_each_against_brute_force(spark, sf):
    """On the given documents: rows left are no near copies of one another, and no row goes without a link at 0.8."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kept = {r.doc_id for r in S.one_of_each(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    sets = {i: S.shingle_hashes(t.encode().lower().split(), 5, 42).view(">u8").ravel().tolist() if t.split() else [] for i, t in docs.items()}
    ids, linked = sorted(docs), set()
    for x, a in enumerate(ids):
        for b in ids[:x]:
            one, two = set(sets[a]), set(sets[b])
            if one == two or len(one & two) >= 0.8 * len(one | two):
                linked.add((a, b))
    near = [p for p in linked if p[0] in kept and p[1] in kept]
    assert len(near) <= 0.05 * len(linked)
    assert all(any(i in p for p in linked) for i in ids if i not in kept)


@pytest.mark.parametrize("size", [5, 64, 65, 700])
def test_forest_spans_links_with_linked_pairs(size):
    rng = np.random.default_rng(size)
    groups = np.repeat([3, 9], size)
    words = [rng.integers(0, 1 << 12, 2 * size).astype(np.uint64), rng.integers(0, 1 << 3, 2 * size).astype(np.uint64)]
    i, j = S.forest(groups, np.full(2 * size, S.HOME | S.REPLICA), words, [1, 2])
    bits = lambda a, b: sum(int(w[a] ^ w[b]).bit_count() for w in words)
    assert all(bits(a, b) <= 2 and groups[a] == groups[b] for a, b in zip(i, j, strict=True))
    parts = [list(range(2 * size)), list(range(2 * size))]

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        assert find(parts[0], a) != find(parts[0], b)
        parts[0][find(parts[0], a)] = find(parts[0], b)
    for a in range(2 * size):
        for b in range(a):
            if groups[a] == groups[b] and bits(a, b) <= 2:
                parts[1][find(parts[1], a)] = find(parts[1], b)
    assert len({find(parts[0], x) for x in range(2 * size)}) == len({find(parts[1], x) for x in range(2 * size)})
