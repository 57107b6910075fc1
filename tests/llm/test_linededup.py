from collections import Counter

import pytest
from pyspark.sql import functions as F

from monthmill.llm import linededup as L


def brute(texts, least):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    n = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    return ["\n".join(x for x in (t or "").split("\n") if n[key(x)] < least) for t in texts]


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2), (4, 4)])
def test_against_brute_force(spark, batches, fanout):
    texts = [f"Shared LINE \n unique {i}\n\n{'often' if i % 2 else 'Often '}\nÄ Ö " for i in range(12)] + ["shared line", "\tSHARED line\r", None, "", "x\nx\nx"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = L.drop_common_lines(df, min_docs=10, batches=batches, fanout=fanout).orderBy("i").collect()
    assert [r.kept_text for r in got] == brute(texts, 10)
    assert all(r.n_lines == len((t or "").split("\n")) and r.n_lines - r.n_dropped == (len(r.kept_text.split("\n")) if r.n_dropped < r.n_lines else 0) for r, t in zip(got, texts, strict=True))


def test_repeated_rows_count_each(spark):
    df = spark.createDataFrame([(1, "same\nown")] * 3, "i int, text string")
    assert [r.kept_text for r in L.drop_common_lines(df, min_docs=3).collect()] == [""] * 3
    assert [r.kept_text for r in L.drop_common_lines(df, min_docs=4).collect()] == ["same\nown"] * 3


def test_levels_are_compacted_and_settled_keys_left_out(spark):
    runs = L.LineRuns(spark, min_docs=2, fanout=2)
    sizes = []
    for i in range(5):
        runs.add(spark.createDataFrame([(f"common\nrow {i}",), ("common",)], "text string"))
        sizes.append([len(x) for x in runs.levels])
    assert all(n < 2 for s in sizes for n in s) and len(runs.levels) == 3
    assert runs.common().count() == 1
    stored = sum(runs.read(p).agg(F.sum("n")).first()[0] for p in runs.runs())
    assert stored == 2 + 5  # the first batch's count of the common line, and each row's own
    with pytest.raises(ValueError):
        L.LineRuns(spark, fanout=1)


def test_edges(spark, odd_docs, no_docs):
    out = L.drop_common_lines(odd_docs, min_docs=2)
    assert out.count() == odd_docs.count()
    assert set(odd_docs.columns) - {"kept_text"} <= set(out.columns)
    assert {r.kept_text for r in out.where("doc_id = 5").collect()} == {""}
    assert L.drop_common_lines(no_docs).count() == 0
