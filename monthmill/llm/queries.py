"""The registered queries of the operators in this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .common import scratch_path, table
from .decontam import decontaminate
from .htmltext import extract_main_text
from .linededup import drop_common_lines
from .lm import score_texts
from .phrases import collocations
from .quality import fit_quality, score_quality
from .sampling import fold
from .secretscan import fit_secrets, rule_findings, scan_secrets
from .simhash import simhash_components
from .topk import top_inner_products
from .toxicity import fit_toxicity, score_toxicity
from .trie import prefix_trie
from .warc import read_warc, with_record_types, write_warc


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    from public_tokenizers import path

    return str(path(name))


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of a benchmark item."""
    hits = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spans=False)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written and read back."""
    path = scratch_path(spark, "archives")
    write_warc(with_record_types(table(spark, sf_dir, "pages").select("page_id", "url", "html")), path)
    records = read_warc(spark, path, payload=False, strict=True)
    stored = F.col("record_type") == "response"
    return records.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.when(stored, F.col("stored_bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(stored, F.col("stored_digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the rows whose crc32 of the id is no multiple of 5."""
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), fold(F.col("id"), 5) != 0)
    return score_toxicity(docs, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document over 3-word shingles, linked at 3 or fewer bits."""
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every 50th vector with all others."""
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose key is in at least 10 documents."""
    kept = drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of every document through the byte-level BPE of 50k tokens."""
    return bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the rows whose crc32 of the id modulo 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), fold(F.col("id"), 4) != 2)
    return score_quality(docs, model).select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code length of every document, learnt from the rows whose crc32 of the id modulo 7 is not 2."""
    return score_texts(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) != 2)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules find in every document, with what a network trained on their findings adds."""
    docs = table(spark, sf_dir, "documents")
    found = scan_secrets(docs, fit_secrets(rule_findings(docs)))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's phrases that stick together most, of those that occur 100 times or more."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"), min_count=100, top=2000)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_main_text, op2_decontamination, op3_warc, op4_toxicity, op5_simhash, op6_topk, op7_line_dedup, op8_bpe, op9_quality, op10_lm, op11_secrets, op12_phrases, op13_prefix_trie)}


#: DuckDB's form of the blanks that a line key loses at both ends.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + 9), ' ') AS body
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
runs AS (
  SELECT r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS body
  FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM words, sizes WHERE len(w) >= k)),
hits AS (SELECT r, i, k, item FROM runs JOIN windows USING (k, body)),
found AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS place FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN found USING (r) LEFT JOIN named USING (r)
"""

OP7_SQL = f"""
WITH lines AS (
  SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
  FROM (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)),
keyed AS (SELECT r, doc_id, line, pos, {_FOLD.format(f"trim(line, {_BLANKS})")} AS key FROM lines),
common AS (SELECT key, true AS bad FROM keyed WHERE length(key) > 0 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE bad) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY r
"""


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT body, max(page_id) AS first FROM p WHERE octet_length(encode(body)) >= 1000 GROUP BY body)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN g USING (body)
"""

OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


OP12_SQL = f"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_FOLD.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM pieces, generate_series(1, 5) AS s(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
cut AS (
  SELECT g.lang, g.phrase, g.f AS a, k, unnest(generate_series(1, k - 1)) AS c, string_split(g.phrase, ' ') AS w FROM grams g WHERE k > 1),
scored AS (
  SELECT cut.lang, cut.phrase, a, c, x.f AS l, y.f AS r, n, CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cut JOIN n USING (lang)
  JOIN grams x ON x.lang = cut.lang AND x.phrase = array_to_string(list_slice(w, 1, c), ' ')
  JOIN grams y ON y.lang = cut.lang AND y.phrase = array_to_string(list_slice(w, c + 1, len(w)), ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(generate_series(1, k - m + 1)) AS i FROM (SELECT lang, k, f, string_split(phrase, ' ') AS w, unnest(generate_series(2, k - 1)) AS m FROM grams WHERE k > 2)) GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM kept QUALIFY rank <= 2000
"""


#: crc32 of a decimal number, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda v, b: list_reduce(list_prepend(xor(v, b), [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP13_SQL = f"""
WITH stored AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT c, t, CAST({_CRC} % 6 AS BIGINT) AS h FROM stored),
rebuilt AS (SELECT cut.c, list_concat(coalesce(list_slice(b.t, 1, h), []), coalesce(list_slice(cut.t, h + 1, len(cut.t)), [])) AS s FROM cut LEFT JOIN stored b ON b.c = cut.c - cut.c % 100),
member AS (SELECT c, d, list_slice(s, 1, d) AS p, d = len(s) AS ends FROM (SELECT c, s, unnest(generate_series(0, len(s))) AS d FROM rebuilt)),
node AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256,
    CASE WHEN d > 0 THEN list_slice(p, 1, d - 1) END AS above FROM member GROUP BY p, d),
child AS (SELECT above AS p, count(*) AS n FROM node WHERE above IS NOT NULL GROUP BY above),
told AS (SELECT node.*, coalesce(child.n, 0) AS n_children, CASE WHEN node.d > 0 THEN (n_convs - 1) * length(node.p[node.d].text) ELSE 0 END AS saved FROM node LEFT JOIN child USING (p)),
sums AS (SELECT list_slice(p, 1, j) AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM (SELECT *, unnest(generate_series(0, d)) AS j FROM told) GROUP BY 1)
SELECT t.conv_id, t.d AS depth, a.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, t.ends_sha256
FROM told t JOIN sums USING (p) LEFT JOIN node a ON a.p = t.above
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op3_warc": OP3_SQL, "op6_topk": OP6_SQL, "op7_line_dedup": OP7_SQL, "op12_phrases": OP12_SQL, "op13_prefix_trie": OP13_SQL}
