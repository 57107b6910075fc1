import hashlib

import pytest
from pyspark.sql import functions as F

from monthmill.llm import warc as W

FAKE = "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:666>\r\nContent-Length: {n}\r\n\r\nxx"
SCHEMA = "page_id bigint, url string, html string, record_type string, mm_key string"


def page(i, text, url="http://x/"):
    return (i, url, text, "clash", "clash")


@pytest.fixture(scope="module")
def pages(spark):
    same, short = "é" * 600, "s" * 999
    rows = [page(1, same), page(5, same), page(3, same), page(2, short), page(4, short), page(6, None, None), page(7, ""), page(8, "a\r\nb: c", "http://x/\r\nEvil: 1"), page(9, FAKE.format(n=2) + "tail"), page(10, FAKE.format(n=100000)), page(11, ("line\n" * 50 + FAKE.format(n=2) + "\r\n\r\n") * 20), page(12, "WARC/1.0\r\n" * 3), page(13, "\x00\x01\r\n\r\n"), page(14, "x" * 50_000), page(15, "ends\r\n\r\nWARC/1.0\r\n")]
    return spark.createDataFrame(rows, SCHEMA)


def written(pages, path, **options):
    W.write_warc(W.with_record_types(pages), path, **options)


@pytest.mark.parametrize("split", ["128m", "701b", "97b"])
def test_round_trip(spark, pages, tmp_path, split):
    path = str(tmp_path / "w")
    written(pages.coalesce(2), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {int(r.record_id): r for r in W.read_warc(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    source = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert set(got) == set(source)
    for i, body in source.items():
        r = got[i]
        if r.record_type == "revisit":
            assert (i, r.refers_to, bytes(r.payload)) in ((1, "5", b""), (3, "5", b""))
        else:
            assert bytes(r.payload) == body and r.stored_digest == hashlib.sha1(body).hexdigest() and r.refers_to is None
        assert (r.declared_bytes, r.declared_digest) == (len(body), hashlib.sha1(body).hexdigest())
    assert got[8].target_uri == "http://x/ Evil: 1" and got[6].target_uri is None


def test_false_records_cannot_join_the_chain(spark, tmp_path):
    """Magic in a payload whose own length leads back onto a true record must not bring itself in."""
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:666>\r\nContent-Length: 4\r\n\r\nabcd"
    body = "p\r\n\r\n" + inner
    rows = spark.createDataFrame([(i, "u", body) for i in range(30)], "page_id bigint, url string, html string")
    path = str(tmp_path / "w")
    written(rows.coalesce(1), path)
    got = W.read_warc(spark, path)
    assert sorted(int(r.record_id) for r in got.collect()) == list(range(30))
    assert {bytes(r.payload).decode() for r in got.collect()} == {body}


def test_broken_files(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc").write_bytes(b"junk before WARC/1.0\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    (tmp_path / "f" / "b.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\ncontent-length:  3 \r\n\r\n\xff\xfe\xfd\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nxyz\r\n\r\n")
    (tmp_path / "f" / "c.warc").write_bytes(b"")
    got = W.read_warc(spark, str(tmp_path / "f")).collect()
    assert [(r.offset, bytes(r.payload)) for r in got] == [(0, b"\xff\xfe\xfd")]


def test_edges(spark, pages, tmp_path):
    assert W.with_record_types(pages.limit(0)).count() == 0
    written(pages.limit(0), str(tmp_path / "none"))
    assert W.read_warc(spark, str(tmp_path / "none")).count() == 0
    big = "b" * 2000
    rows = spark.createDataFrame([(None, "u", big), (None, "u", big), (1, "u", big), (1, "u", big)], "page_id bigint, url string, html string")
    got = sorted((r.page_id is None, r.record_type, r.refers_to) for r in W.with_record_types(rows).collect())
    assert got == [(False, "response", None), (False, "response", None), (True, "revisit", 1), (True, "revisit", 1)]
    nobody = W.with_record_types(rows.where("page_id is null"))
    assert {r.record_type for r in nobody.collect()} == {"response"}


ENDS = ["tail\r\n\r\nWARC/1.0", "tail\n\r\nWARC/1.0\r", "\r\n\r\nWARC/1.0", "WARC/1.0", "\r\nWARC/1.0\r\nx", "\r\n\r\nWARC/1.0\r\n\r\nWARC/1.0\r\n\r\nWARC/1.0", "\n\r\nWARC/1.0\r\n", "\r", "\n", "\r\n\r"]


@pytest.mark.parametrize("split", ["128m", "97b", "41b"])
def test_payloads_that_end_or_begin_in_magic_hide_no_record(spark, tmp_path, split):
    """The separator must not take a payload's end together with the gap, nor the header's blank line."""
    bodies = [b for e in ENDS for b in (e, "plain", e)]
    rows = spark.createDataFrame([(i, "http://x/WARC/1.0", b) for i, b in enumerate(bodies)], "page_id bigint, url string, html string")
    path = str(tmp_path / "w")
    written(rows.coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {int(r.record_id): bytes(r.payload).decode() for r in W.read_warc(spark, path, strict=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(enumerate(bodies))


def test_strict_reading_raises_where_a_chain_breaks_off(spark, tmp_path):
    (tmp_path / "f").mkdir()
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "f" / "a.warc").write_bytes(record * 2)
    assert W.read_warc(spark, str(tmp_path / "f"), strict=True).count() == 2
    (tmp_path / "f" / "b.warc").write_bytes(record + record.replace(b": 3", b": x") + record)
    assert W.read_warc(spark, str(tmp_path / "f")).count() == 3
    with pytest.raises(ValueError, match="b.warc"):
        W.read_warc(spark, str(tmp_path / "f"), strict=True)


def test_clashing_columns_come_back(pages):
    out = W.with_record_types(pages)
    assert set(out.columns) == {*pages.columns, "payload_bytes", "payload_digest", "refers_to"}
    assert {r.mm_key for r in out.collect()} == {"clash"} and {r.record_type for r in out.collect()} == {"response", "revisit"}


TAILS = ["x", "\r", "\n", "\r\n", "\r\n\r\n", "\r\n\r", "\n\r\nWARC/1.0"]


def test_many_small_records_at_all_offsets(spark, tmp_path):
    """Records of 0 to 138 bytes, so that gaps and magic lie across every read buffer's edge."""
    n = 60_000
    tail = F.element_at(F.array(*[F.lit(t) for t in TAILS]), (F.floor(F.col("page_id") / 20_000 * 7) % 7 + 1).cast("int"))
    rows = spark.range(n, numPartitions=3).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.repeat(F.lit("p"), (F.pmod(F.xxhash64("id"), F.lit(131))).cast("int")), F.lit("")).alias("body"))
    rows = rows.select("page_id", "url", F.concat("body", tail).alias("html")).persist()
    path = str(tmp_path / "w")
    W.write_warc(W.with_record_types(rows), path)
    got = W.read_warc(spark, path, strict=True).select(F.col("record_id").cast("long").alias("page_id"), F.col("payload").cast("string").alias("html"))
    assert got.count() == n and got.join(rows, ["page_id", "html"]).count() == n
    rows.unpersist()
