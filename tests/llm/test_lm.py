import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.llm import lm
from monthmill.llm.queries import op10_lm


class Trie:
    """A plain byte-context model with escapes and exclusion."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [defaultdict(Counter) for _ in range(order + 1)]
        for text in texts:
            s = self.symbols(text)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.counts[k][s[i - k : i]][s[i]] += 1

    def symbols(self, text):
        return bytes([lm.START]) * self.order + b" ".join(text.encode().lower().split()) + bytes([lm.END])

    def score(self, text):
        s, total = self.symbols(text), 0.0
        for i in range(self.order, len(s)):
            excluded = set()
            for k in range(self.order, -1, -1):
                seen = {x: c for x, c in self.counts[k].get(s[i - k : i], {}).items() if x not in excluded}
                if not seen:
                    continue
                n, d = sum(seen.values()), len(seen)
                if s[i] in seen:
                    total += math.log10((2 * seen[s[i]] - 1) / (2 * n))
                    break
                total += math.log10(d / (2 * n))
                excluded |= set(seen)
            else:
                total -= math.log10(256 - len(excluded))
        return total


def base(train, text):
    c = Counter(w for t in train for w in [*t.encode().lower().split(), None])
    n, v = sum(c.values()), len(c)
    tokens = [*text.encode().lower().split(), None]
    return len(tokens), sum(c[t] > 0 for t in tokens), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens)


def held(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7 == 2


def compare(rows, got, order):
    train = [t or "" for i, t in rows if not held(i)]
    trie = Trie(train, order)
    for i, t in rows:
        r = got[i]
        want = base(train, t or "")
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (*want[:3], held(i))
        assert r.base_score == pytest.approx(want[3], rel=1e-9)
        assert r.score == pytest.approx(trie.score(t or ""), rel=1e-9)


CUTS = [{"block_keys": 150, "task_bytes": 300, "piece_bytes": 20, "merged_blocks": 2}, {}]


@pytest.mark.parametrize("order", [3, 5, 6])
@pytest.mark.parametrize("cuts", CUTS)
def test_against_a_plain_trie(spark, order, cuts):
    words = ["Banana", "bandana", "ananas", "é", "日本", "a", "nab", "cabana", "xyz"]
    rows = [(i, " ".join(words[(i * j + j) % (9 if i % 3 else 8)] for j in range(i % 17))) for i in range(60)] + [(100, None), (101, "  \n"), (102, "never seen before qqq")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in lm.score_texts(df, fold7(), order=order, **cuts).collect()}
    compare(rows, got, order)


def fold7():
    from monthmill.llm.sampling import fold

    return fold(F.col("doc_id"), 7) != 2


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op10_lm(spark, sf).collect()}
    assert len(got) == len(rows)
    train = [t for i, t in rows if not held(i)]
    trie = Trie(train, lm.ORDER)
    for i, t in rows[::20]:
        assert got[i].score == pytest.approx(trie.score(t), rel=1e-9)


def test_probabilities_add_up():
    import numpy as np

    g, _ = lm.grams([p for t in ("abra cadabra", "abc") for p, _ in lm.pieces(t, 3)], 3)
    keys, n = lm.summed(g, np.ones(len(g), np.int64))
    low = lm.low_orders(lm.shorter(keys, 1), n)
    for context in (b"abr", b"zzz", b"\xfe\xfe\xfe", b" ca"):
        wanted = (int.from_bytes(context[::-1], "big") << 8) + np.arange(256)
        assert np.sum(10 ** lm.prices(keys, n, wanted, 3, low)) == pytest.approx(1)


def test_pieces_are_the_whole_text():
    text = "One two  three\tfour " * 50 + "x" * 90
    for limit in (6, 17, 10**6):
        made = list(lm.pieces(text, 5, limit))
        body = b" ".join(text.encode().lower().split()) + bytes([lm.END])
        assert b"".join(p[5:] for p, _ in made) == body and [last for _, last in made] == [False] * (len(made) - 1) + [True]
        assert lm.grams([p for p, _ in made], 5)[0].tolist() == lm.grams([bytes([lm.START]) * 5 + body], 5)[0].tolist()


def test_tally_and_bytes():
    import numpy as np

    rng = np.random.default_rng(0)
    tally, want = lm.Tally(), Counter()
    for _ in range(30):
        keys, n = np.unique(rng.integers(-(2**62), 2**62, 50) // 2**56, return_counts=True)
        tally.add(keys, n)
        want.update(dict(zip(keys.tolist(), n.tolist(), strict=True)))
    keys, n = tally.take()
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == want and (np.diff(keys) > 0).all() and not len(tally)
    for x in (keys, n, np.array([-(2**63), 2**63 - 1]), np.zeros(0, np.int64)):
        assert lm.from_bytes(lm.to_bytes(x)).tolist() == x.tolist()


def test_model_beats_the_unigram_base_on_held_out_texts(spark):
    """The base knows words and pays little for unknown ones; the model needs the texts of the largest table to pass it."""
    rows = [r for r in op10_lm(spark, "/root/testdata/sf0.1").collect() if r.held_out and r.n_tokens > 1]
    assert sum(r.score for r in rows) > 0.97 * sum(r.base_score for r in rows)
    assert sum(r.score > r.base_score for r in rows) > 0.8 * len(rows)


def test_edges(spark, odd_docs, no_docs):
    out = lm.score_texts(odd_docs, F.col("doc_id") < 5).collect()
    assert len(out) == odd_docs.count() and all(r.score < 0 for r in out)
    assert lm.score_texts(no_docs, F.lit(True)).count() == 0
    untrained = lm.score_texts(odd_docs.select("doc_id", "text").where("doc_id = 1"), F.lit(False)).first()
    assert (untrained.n_tokens, untrained.n_known, untrained.train_tokens) == (1, 0, 0) and untrained.score == pytest.approx(-math.log10(256)) and untrained.base_score == 0
    with pytest.raises(ValueError):
        lm.score_texts(odd_docs, F.lit(True), keep=["score"])


def test_dealings_grow_without_a_limit(spark, monkeypatch):
    """Over 2**15 dealings, and one, give the same scores; no dealing's number wraps."""
    rows = [(i, " ".join(f"w{(i * k) % 97} {k * 7919 % 1009}" for k in range(60)), i % 7 != 2) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, train boolean")

    def scores():
        return {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score_texts(docs, F.col("train")).collect()}

    one = scores()
    size = sum(len(t) for _, t, _ in rows)
    monkeypatch.setattr(lm, "BUCKET_BYTES", max(1, size // 50_000))
    assert size // lm.BUCKET_BYTES > 1 << 15
    assert scores() == one
    dealt = lm.buckets_of(lm.WORD, np.arange(100_000, dtype=np.int64) * 7919, 1 << 20, lm.ORDER)
    assert dealt.min() >= 0 and dealt.max() > 1 << 19
