"""Bounded samples to fit classifiers on, and the folds that keep rows out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def fold(id_col: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(of))


def drawn(df: DataFrame, id_col: str, rows: int, salt: str, total: int | None = None) -> DataFrame:
    """About ``rows`` of df at most, chosen by a hash of the id, so that the same rows come again; all, if there are fewer."""
    n = df.count() if total is None else total
    if n <= rows:
        return df
    # all 64 bits of the hash count, so that the share may be as small as it gets
    return df.where(F.xxhash64(F.lit(salt), F.col(id_col)) < F.lit(-(2**63) + 2**64 * rows // n))


def labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One row (id, label 0 or 1) for each labelled id; where an id has several labels the larger counts; nulls are none."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    return known.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("label"))
