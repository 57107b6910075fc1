"""Documents to training tokens: quality, line dedup, near-dedup, decontamination, tokens; each stage works on all that the
one before kept.

In every stage a null text is an empty one, rows that repeat are rows of their own but where the stage is there to choose among
them, an empty table gives an empty one, and further columns, whatever their names, travel along; the last stage returns
doc_id, lang and source beside its own results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm.bpe import bpe_round_trip
from monthmill.llm.common import materialise, table
from monthmill.llm.decontam import drop_contaminated
from monthmill.llm.linededup import drop_common_lines
from monthmill.llm.quality import fit_quality, keep_good
from monthmill.llm.queries import tokenizer_path
from monthmill.llm.sampling import fold
from monthmill.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled rows of the corpus outside one fold, does not reject; all of them
    where there are no labelled rows of both kinds. Empty texts get the score that texts without tokens have; equal texts,
    null ids or not, get equal scores."""
    model = fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(F.col("id"), 4) != 2)
    return keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that 10 or more of them share; n_chars follows the text. No document goes: one that has lost
    all its lines, or had none, has the text ''. Lines of blanks are never dropped; repeated rows count each."""
    kept = drop_common_lines(docs, min_docs=10)
    return kept.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8. It is the one with the least doc_id,
    null last, and of equal ids that with the least hash of its text; of rows that repeat one stays, and of empty texts one."""
    return one_of_each(docs, shingle=5, similarity=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item, or a whole item of fewer words. Documents without words stay;
    items with a null id or text are none."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, with the digest of what they decode to; an empty text has no tokens."""
    return bpe_round_trip(docs, tokenizer_path(), keep=("doc_id", "lang", "source"), outputs=("n_tokens", "token_ids", "decoded_sha256"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("tokenize", tokenize)]

#: Trained scores, fingerprints and tokens are not SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
