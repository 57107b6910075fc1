"""WARC archives written and read as Spark text files, with boundary-chain verification.

Writing: a record is one row of text, ended by the blank lines that end a WARC record, so Spark's own writer makes the
archives, part by part, committed and retried like any table.

Reading: the files are split at ``\\nWARC/1.0\\r``. Its first byte comes once in it and is not its last, so two occurrences
cannot overlap and no payload's end hides the record behind it. Each piece is a candidate record: its offset is the running
sum of the pieces' bytes within its file split plus the bytes of the splits before, and its header tells where its successor
begins. Magic inside a payload makes candidates too. Candidates are told from records by pointer jumping from the start of
each file: pointers are doubled round by round, and only what the start reaches is a record. Before that, stretches in
which each candidate points to the very next one, and into which no other pointer leads, are contracted to one pointer, so
the rounds grow with the logarithm of the splits and false candidates of a file, not of its records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, fresh, materialise

MAGIC = "WARC/1.0\r\n"
GAP = "\r\n\r\n"
#: What the files are split at: the last byte of a gap and all of magic but its last byte.
SEPARATOR = GAP[-1] + MAGIC[:-1]
#: Payloads of fewer bytes are always stored.
LEAST_REVISIT = 1000
#: Records in an archive file, at most.
FILE_RECORDS = 20_000
#: Groups of equal payloads, of about 100 bytes each, up to which they are broadcast.
BROADCAST_GROUPS = 50_000
#: Rounds of doubling after which a chain is longer than any file.
MAX_ROUNDS = 64
DATE = "2026-01-01T00:00:00Z"


def with_record_types(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """pages with ``payload_bytes``, ``payload_digest`` (SHA-1, hexadecimal), ``record_type`` and ``refers_to``.

    Of rows with equal payloads of at least ``least`` bytes, that with the largest id is a response and the others revisit
    it; rows that repeat its id are responses too. A null payload is empty; rows with a null id are never referred to, and a
    group of only such rows is all responses. Payloads are compared by SHA-256, counted before they are joined, and only
    groups of several rows are joined back, broadcast if there are few. All columns of pages come back, but those named as
    results, which are replaced.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    key, first = fresh(pages, "mm_key"), fresh(pages, "mm_first")
    known = pages.withColumns({"payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": F.sha1(payload), key: F.sha2(payload, 256)})
    groups = known.where(F.col("payload_bytes") >= least).groupBy(key).agg(F.max(id_col).alias(first), F.count("*").alias("n"))
    groups = groups.where((F.col("n") > 1) & F.col(first).isNotNull()).drop("n")
    revisit = F.col(first).isNotNull() & ~F.col(id_col).eqNullSafe(F.col(first))
    groups, _ = materialise(groups, "warc-groups")
    few = groups.count() <= BROADCAST_GROUPS  # then payloads stay where they are; else both sides are dealt by key
    out = known.join(F.broadcast(groups) if few else groups, key, "left")
    return out.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col(first))}).drop(key, first)


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), F.regexp_replace(value.cast("string"), "[\\r\\n]+", " "), F.lit("\r\n"))).otherwise(F.lit(""))


def write_warc(records: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", file_records: int = FILE_RECORDS) -> None:
    """Write rows of :func:`with_record_types` as archives under path. A revisit has no body; its header keeps the full
    payload's digest and length. Line breaks in a header value become spaces; null values have no header line."""
    body = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.coalesce(F.col(payload_col), F.lit("")))
    head = F.concat(
        F.lit(MAGIC),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:record:"), F.col(id_col).cast("string"), F.lit(">"))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.col(url_col)),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("X-Payload-Length", F.col("payload_bytes")),
        _field("WARC-Refers-To", F.concat(F.lit("<urn:record:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _field("Content-Length", F.octet_length(body)),
        F.lit("\r\n"),
    )
    records.select(F.concat(head, body).alias("value")).write.option("lineSep", GAP).option("compression", "none").option("maxRecordsPerFile", file_records).text(path)


def _header(name: str) -> Column:
    return F.nullif(F.regexp_extract(F.concat(F.lit("\r\n"), F.col("head"), F.lit("\r\n")), f"(?i)\\r\\n{name}:[ \\t]*([^\\r\\n]*?)[ \\t]*\\r\\n", 1), F.lit(""))


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The pieces between separators with their place: file, block (the split's offset), seq (ascending in a split)."""
    text = spark.read.option("lineSep", SEPARATOR).text(path)
    return text.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))


def candidates(spark: SparkSession, path: str, payload: bool) -> DataFrame:
    """One row for each piece: its place, its header and its payload's digest; raw where the record may go on in the next."""
    rows = scan(spark, path)
    first = (F.col("block") == 0) & F.col("value").startswith(MAGIC)
    # magic's last byte, if it is magic, is still there
    lead = F.when(first, len(MAGIC)).when(F.col("value").startswith(MAGIC[-1]), 1)
    rows = rows.withColumns({"piece": F.octet_length("value").cast("long"), "opens": first, "lead": lead, "head": F.substring_index("value", GAP, 1)})
    # where a payload begins with magic, the separator has taken the last byte of the header's blank line
    cut = F.octet_length("head") == F.col("piece")
    rows = rows.withColumns({"cut": cut, "head": F.when(cut, F.regexp_replace("head", "\\r\\n\\r\\z", "")).otherwise(F.col("head"))})
    rows = rows.withColumn("head", F.substring("head", F.coalesce("lead", F.lit(0)) + 1, F.lit(2147483647))).withColumn("head_bytes", (F.octet_length("head") + len(GAP)).cast("long"))
    size = _header("Content-Length").try_cast("long")
    there = F.col("piece") - F.col("lead") - F.col("head_bytes")
    rows = rows.withColumn("size", F.when((~F.col("cut") | (there == -1)) & (size >= 0) & F.col("lead").isNotNull(), size)).withColumn("there", there)
    # a record has the gap but its last byte behind it, the last one of a file the whole gap, or nothing
    whole = F.coalesce((F.col("there") - F.col("size")).isin(0, len(GAP) - 1, len(GAP)), F.lit(False))
    content = F.when(whole, F.substring(F.col("value").cast("binary"), (F.col("lead") + F.col("head_bytes") + 1).cast("int"), F.col("size").cast("int")))
    rows = rows.withColumns({"whole": whole, "content": content}).withColumn("digest", F.sha1("content"))
    return rows.select("file", "file_path", "block", "seq", "piece", "opens", "head", "head_bytes", "size", "whole", "digest", *(["content"] if payload else []), F.when(~F.col("whole"), F.col("value").cast("binary")).alias("raw"))


def with_offsets(pieces: DataFrame) -> DataFrame:
    """Offsets from the lengths of pieces: a running sum within a file split, and the sums of the splits before it."""
    sep = len(SEPARATOR)
    inside = Window.partitionBy("file", "block").orderBy("seq")
    blocks = pieces.groupBy("file", "block").agg(F.sum(F.col("piece") + sep).alias("bytes"))
    base = blocks.withColumn("base", F.coalesce(F.sum("bytes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("bytes")
    before = F.coalesce(F.sum(F.col("piece") + sep).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.withColumn("before", before).join(base, ["file", "block"])
    at = F.col("base") + F.col("before")
    placed = placed.withColumn("start", F.when(F.col("opens") & (at == 0), at).otherwise(at - (len(MAGIC) - 1))).drop("before", "base")
    return placed.withColumn("successor", F.col("start") + len(MAGIC) + F.col("head_bytes") + F.col("size") + len(GAP))


def reachable(pieces: DataFrame) -> DataFrame:
    """The (file, start) of pieces that the chain from offset 0 of their file reaches; pieces: a written table."""
    spark = pieces.sparkSession
    narrow = pieces.select("file", "block", "seq", "start", "successor")
    inside = Window.partitionBy("file", "block").orderBy("seq")
    near = narrow.withColumns({"previous": F.lag("successor").over(inside), "next": F.lead("start").over(inside)})
    targets = near.where(F.col("successor").isNotNull() & ~F.col("successor").eqNullSafe(F.col("next"))).select("file", F.col("successor").alias("start")).distinct().withColumn("aimed", F.lit(True))
    marked = near.join(targets, ["file", "start"], "left")
    head = F.col("aimed").isNotNull() | ~F.col("previous").eqNullSafe(F.col("start"))
    runs = marked.withColumn("run", F.sum(head.cast("int")).over(inside)).select("file", "block", "start", "successor", "run")
    runs, runs_path = materialise(runs, "warc-runs")
    jumps = runs.groupBy("file", "block", "run").agg(F.min("start").alias("at"), F.max_by(F.struct("successor"), "start").alias("to"))
    jumps, path = materialise(jumps.select("file", "block", "run", "at", F.col("to.successor").alias("to"), (F.col("at") == 0).alias("reached")), "warc-jumps")
    seen = -1
    for _ in range(MAX_ROUNDS):
        now = jumps.where("reached").count()
        if now == seen:
            break
        seen = now
        ahead = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        hit = jumps.where(F.col("reached") & F.col("to").isNotNull()).select("file", F.col("to").alias("at")).distinct().withColumn("hit", F.lit(True))
        after = jumps.join(ahead, ["file", "to"], "left").join(hit, ["file", "at"], "left")
        after, after_path = materialise(after.select("file", "block", "run", "at", F.col("further").alias("to"), (F.col("reached") | F.col("hit").isNotNull()).alias("reached")), "warc-jumps")
        discard(spark, path)
        jumps, path = after, after_path
    else:
        raise RuntimeError(f"chains did not end in {MAX_ROUNDS} rounds")
    return runs.join(jumps.where("reached").select("file", "block", "run"), ["file", "block", "run"], "left_semi").select("file", "start")


def read_warc(spark: SparkSession, path: str, payload: bool = True, strict: bool = False) -> DataFrame:
    """Records of all archives under path: file, offset, record_type, record_id, target_uri, refers_to, declared_digest,
    declared_bytes, stored_bytes, stored_digest and, with ``payload``, payload (binary).

    A file that does not begin with a record has none; a chain ends where a header is broken, and what follows is not read;
    ``strict`` raises ValueError where a file's chain does not end at its end.
    Bytes are kept as they are. A record whose payload holds magic is put together from its pieces.
    """
    pieces, _ = materialise(with_offsets(candidates(spark, path, payload)), "warc-pieces")
    chain, _ = materialise(reachable(pieces).withColumn("linked", F.lit(True)), "warc-chain")
    known = pieces.join(chain, ["file", "start"], "left").withColumn("linked", F.col("linked").isNotNull() & F.col("size").isNotNull())
    if strict:
        sep = len(SEPARATOR)
        ends = known.groupBy("file").agg(F.first("file_path").alias("file_path"), (F.sum(F.col("piece") + sep) - sep).alias("bytes"), F.max(F.when(F.col("linked"), F.col("successor"))).alias("end"))
        if (bad := ends.where(~F.col("end").eqNullSafe(F.col("bytes"))).first()) is not None:
            raise ValueError(f"{bad.file_path}: the records end at byte {bad.end} of {bad.bytes}")
    broken = known.where(~F.col("linked") | ~F.col("whole"))
    # pieces of a payload that look like whole records were not kept; there are few, and the files are read again for them
    lost = known.where(~F.col("linked") & F.col("whole")).select("file", "block", "seq", F.col("piece").alias("bytes"))
    if not lost.isEmpty():
        again = scan(spark, path).join(lost, ["file", "block", "seq"])
        same = F.when(F.octet_length("value") == F.col("bytes"), F.col("value").cast("binary")).otherwise(F.raise_error(F.lit("the archives were split anew")).cast("binary"))
        broken = broken.join(again.select("file", "block", "seq", same.alias("again")), ["file", "block", "seq"], "left").withColumn("raw", F.coalesce("raw", "again"))
    owner = F.last(F.when(F.col("linked"), F.col("start")), ignorenulls=True).over(Window.partitionBy("file").orderBy("start"))
    parts = broken.withColumn("owner", owner).where(F.col("owner").isNotNull()).groupBy("file", F.col("owner").alias("start")).agg(F.sort_array(F.collect_list(F.struct("start", "raw"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["raw"].cast("string")), SEPARATOR).cast("binary")
    parts = parts.select("file", "start", joined.alias("joined"))
    records = known.where("linked").join(parts, ["file", "start"], "left")
    skip = F.when(F.col("opens"), len(MAGIC)).otherwise(1) + F.col("head_bytes") + 1
    mended = F.substring("joined", skip.cast("int"), F.col("size").cast("int"))
    records = records.withColumn("mended", F.when(~F.col("whole"), mended))
    name = lambda c: F.regexp_extract(_header(c), "^<urn:record:(.*)>$", 1)
    return records.select(
        F.col("file_path").alias("file"),
        F.col("start").alias("offset"),
        _header("WARC-Type").alias("record_type"),
        F.nullif(name("WARC-Record-ID"), F.lit("")).alias("record_id"),
        _header("WARC-Target-URI").alias("target_uri"),
        F.nullif(name("WARC-Refers-To"), F.lit("")).alias("refers_to"),
        F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        _header("X-Payload-Length").try_cast("long").alias("declared_bytes"),
        F.col("size").alias("stored_bytes"),
        F.coalesce(F.col("digest"), F.sha1("mended")).alias("stored_digest"),
        *([F.coalesce(F.col("content"), F.col("mended")).alias("payload")] if payload else []),
    )
