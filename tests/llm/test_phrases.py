import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.llm import phrases as P


def plain(rows, least, top):
    """The contract, phrase by phrase."""
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {key: f for key, f in counts.items() if f >= least and len(key[1]) > 1}
    inside = set()
    for (lang, w), f in found.items():
        inside.update((lang, w[i : i + k]) for k in range(2, len(w)) for i in range(len(w) - k + 1) if f >= found[lang, w[i : i + k]])
    out = []
    for lang in n:
        scored = []
        for (own, w), a in found.items():
            if own == lang and (own, w) not in inside:
                score, k = min((1000 * a * n[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
                scored.append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def texts(seed, rows=60):
    rng = random.Random(seed)
    words = ["a", "B", "ü", "cd", "e-f", " ", "Ä", "x" * 30]
    passage = " ".join(rng.choice(words) for _ in range(60))
    out = []
    for _ in range(rows):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", " ! ", "\x0b"]) for _ in range(rng.randrange(0, 60)))
        out.append((rng.choice(["", ". "]) + t + rng.choice(["", passage]), rng.choice(["en", "en", None, "de"])))
    return [*out, *out[:5], ("", "en"), (None, None), (" \t.\n", "fr"), ("one", "xx")]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("period", "most"), [(1, 4), (3, 7), (32, 4096), (10**9, 4)])
def test_against_brute_force(spark, period, most):
    rows = texts(period)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    for least, top in ((3, 2000), (6, 7)):
        expected = plain(rows, least, top)
        assert len(expected) > 10 and got(P.collocations(df, min_count=least, top=top, period=period, most=most)) == expected


def test_parse_is_whole_and_cut_by_content():
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randrange(500)}" for _ in range(2000))
    for text in (passage, "x. y " + passage, "w1, " * 3000):
        of, leads, parts = P.parse([text])
        chunks = list(zip(leads.tolist(), parts, strict=True))
        assert chunks[0][0] and not any(first for first, _ in chunks[1:]) and not of.any()
        tokens = lambda b: re.findall(rb"\n|[^ \n]+", b)
        joined = [t for i, (_, c) in enumerate(chunks) for t in tokens(c)[0 if i == 0 else P.OVERLAP :]]
        assert joined == tokens(P.normalised([text])[0].tobytes())
        assert max(len(tokens(c)) for _, c in chunks) <= P.MOST_TOKENS + P.OVERLAP
    of, leads, parts = P.parse(["", passage, " .", "Something else, before it " + passage + " and after", "\n"])
    assert set(of.tolist()) == {1, 3} and leads.sum() == 2
    one, other = ({c for c, o in zip(parts, of.tolist(), strict=True) if o == k} for k in (1, 3))
    assert len(one & other) >= len(one) - 2  # all but the ends
    assert P.parse(["", " "])[2] == P.parse([])[2] == []


def test_copies_are_counted_once_in_the_dictionary(spark):
    text = " ".join(f"w{i % 700}" for i in range(3000))
    one = P.dictionary(spark.createDataFrame([(text, "en")], "text string, lang string"))
    many = P.dictionary(spark.createDataFrame([(text, "en")] * 40, "text string, lang string"))
    assert one.count() == many.count() > 10
    assert many.agg(F.sum("n")).first()[0] == 40 * one.agg(F.sum("n")).first()[0]


def test_scores_are_exact(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        r = rng.randrange(1, 10**13)
        rows.append((rng.randrange(1, r + 1), rng.randrange(r, 10**14), rng.randrange(10**5, 10**13), r))
    rows.append((10**13, 10**14, 10**13, 10**13))
    out = spark.createDataFrame(rows, "a bigint, n bigint, l bigint, r bigint").select("*", P.exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(x.s == Fraction(1000 * x.a * x.n, x.l * x.r).__floor__() for x in out) and len(out) == 301


def test_a_full_filter_only_lets_more_be_counted(spark, monkeypatch):
    monkeypatch.setattr(P, "FILTER_BITS", 8)
    full = P.bitmap(P.hashed_words(spark.createDataFrame([("en", f"w{i}") for i in range(99)], "lang string, phrase string")))
    assert full.tolist() == [255] and P.has_bit(full, P.bit_of(np.arange(5, dtype=np.uint64))).all()
    monkeypatch.undo()
    chunks = P.dictionary(spark.createDataFrame(texts(9), "text string, lang string"))
    everything = np.full(P.FILTER_BITS // 8, 255, np.uint8)
    rows = lambda df: sorted(map(tuple, df.where("f >= 4").collect()))
    pairs = P.bitmap(P.frequent_pairs(chunks, everything, 4))
    assert rows(P.gram_counts(chunks, range(2, 6), pairs)) == rows(P.gram_counts(chunks, range(2, 6), everything)) == rows(P.gram_counts(chunks, range(2, 6)))


def test_edges(spark, odd_docs, no_docs):
    assert P.collocations(no_docs).count() == 0
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    assert got(P.collocations(odd_docs, min_count=2)) == plain(rows, 2, 2000)
    long = [("z" * 300_000 + " q " + "r s " * 100_000, "en")]
    assert got(P.collocations(spark.createDataFrame(long, "text string, lang string"))) == plain(long, 100, 2000)
    with pytest.raises(ValueError):
        P.collocations(odd_docs, most=3)
