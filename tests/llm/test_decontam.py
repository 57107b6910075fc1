import pytest

from monthmill.llm import decontam as D

WORDS = [f"w{i}" for i in range(40)]


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [("a", " ".join(WORDS[:20])), ("b", "Short item, here!"), ("c", None), ("d", ""), (None, "no id at all"), ("e", " ".join(WORDS[:20])), ("e", " ".join(WORDS[5:20]))]
    return spark.createDataFrame(rows, "item_id string, text string")


def brute(text, items, size=10):
    words = D.normal_words(text or "")
    hit, found = set(), set()
    for item, body in items:
        for w in D.windows(D.normal_words(body or ""), size) if item is not None else []:
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


TEXTS = [" ".join(WORDS[:9]), "x " + " ".join(WORDS[2:14]) + " y", "SHORT\titem -- HERE", "short item herewith", " ".join(WORDS[:20] + ["z"] + WORDS[:10]), "(" + "; ".join(WORDS[10:20]).upper() + ")", "short item here short item here", None, "", "..."]


@pytest.mark.parametrize("max_chars", [4_000_000, 900])
def test_against_brute_force(spark, benchmark, max_chars):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    items = [tuple(r) for r in benchmark.collect()]
    got = {r.doc_id: r for r in D.decontaminate(docs, benchmark, max_chars=max_chars).collect()}
    for i, t in enumerate(TEXTS):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute(t, items), t
        spans = [t[s.start : s.end] for s in got[i].hit_spans]
        assert sum(len(D.normal_words(s)) for s in spans) == got[i].n_hit
    assert TEXTS[2][got[2].hit_spans[0].start : got[2].hit_spans[0].end] == "SHORT\titem -- HERE"


def test_edges(spark, odd_docs, no_docs, benchmark):
    out = D.decontaminate(odd_docs, benchmark, spans=False)
    assert out.count() == odd_docs.count() and out.where("n_hit > 0").isEmpty()
    assert D.decontaminate(no_docs, benchmark).count() == 0
    assert D.decontaminate(odd_docs, benchmark.limit(0)).where("n_hit > 0").isEmpty()
    kept = D.drop_contaminated(odd_docs, spark.createDataFrame([(1, "ONE two")], "item_id int, text string"))
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count() - 2
    with pytest.raises(ValueError):
        D.decontaminate(odd_docs, benchmark, keep=["n_words"])
