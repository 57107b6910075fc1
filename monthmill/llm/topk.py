"""Exact top-k inner products over vectors sorted by length.

Vectors are dealt by descending length (ties by a hash of the id) into slabs of about ``slab_rows``, sorted in each; queries
into blocks. Each (slab, block of queries) is one group. Both sides are rotated by the singular vectors of a sample, so that
the first coordinates carry most of the length: for a chunk of a slab, the partial sum over ``HEAD`` rotated coordinates plus
the product of the residual lengths bounds the inner product (Cauchy-Schwarz), and the product of the lengths bounds it
before that. What cannot reach a query's k-th score so far is pruned; the rest is computed in full. The slab of the longest
vectors runs first, and its k-th scores are the other slabs' start; a query is not even sent to a slab whose longest vector
cannot reach its score, nor a slab to a block of which no query asks for it. The rotation prunes; results never depend on it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, require
from .sampling import drawn

#: Vectors in a slab and queries in a block: a group holds both, about 25 MB at 64 dimensions.
SLAB_ROWS, BLOCK_ROWS = 20_000, 2_000
#: Vectors of a slab that are looked at together, and rotated coordinates of the partial sums.
CHUNK, HEAD = 1024, 24
#: Vectors, about, that the rotation is fitted on, at most.
SAMPLE_ROWS = 10_000
#: Largest product of lengths for which doubles hold every inner product of integers exactly.
EXACT = 2.0**53


def integer_vector(x: Column) -> Column:
    """floor(256 * x) of each component, in doubles; null where the vector is null, empty or holds null, NaN or infinity."""
    whole = F.transform(x, lambda v: F.floor(F.lit(256.0) * v.cast("double")))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == F.lit(float("inf"))))
    return F.when(x.isNotNull() & (F.size(x) > 0) & ~bad, whole)


def rotation(sample: np.ndarray) -> np.ndarray:
    """Singular vectors of a sample, strongest first; orthonormal, whatever the sample."""
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1].copy()


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query: higher scores first, ties to smaller ids."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    begin = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(begin, np.diff(np.r_[begin, len(query)]))
    keep = rank < k
    return query[keep], ids[keep], score[keep]


def match(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best candidates of each query among those that reach its floor. x sorted by
    descending length; a candidate with the query's id is no candidate."""
    head = min(HEAD, x.shape[1])
    length, q_length = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
    rx, rq = x @ basis[:, :head], q @ basis[:, :head]
    left = np.sqrt(np.maximum((x * x).sum(axis=1) - (rx * rx).sum(axis=1), 0))
    q_left = np.sqrt(np.maximum((q * q).sum(axis=1) - (rq * rq).sum(axis=1), 0))
    floor = floor.copy()
    exact = len(x) == 0 or len(q) == 0 or length.max() * q_length.max() < EXACT
    xi, qi = (x, q) if exact else (x.astype(np.int64), q.astype(np.int64))
    best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, xi.dtype)
    for at in range(0, len(x), CHUNK):
        end = min(at + CHUNK, len(x))
        slack = 1e-9 * (1 + q_length * length[at])
        live = np.flatnonzero(q_length * length[at] + slack >= floor)
        if not len(live):
            break
        bound = rq[live] @ rx[at:end].T + np.outer(q_left[live], left[at:end])
        row, col = np.nonzero(bound + slack[live][:, None] >= floor[live][:, None])
        if len(row) > 0.1 * bound.size and exact:
            score = (qi[live] @ xi[at:end].T)[row, col]
        else:
            score = np.concatenate([np.einsum("ij,ij->i", qi[live[row[i : i + 65536]]], xi[at + col[i : i + 65536]]) for i in range(0, len(row), 65536)] or [np.zeros(0, xi.dtype)])
        row, col = live[row], at + col
        good = (score >= floor[row]) & (ids[col] != q_ids[row])
        best = _best(np.r_[best[0], row[good]], np.r_[best[1], ids[col[good]]], np.r_[best[2], score[good]], k)
        count = np.bincount(best[0], minlength=len(q))
        last = np.cumsum(count) - 1
        full = count >= k
        floor[full] = np.maximum(floor[full], best[2][last[full]].astype(float))
    return best


def _stack(vectors: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", slab_rows: int = SLAB_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), id_col and score (long) of the k highest integer inner products of each query.

    Queries are the rows where ``is_query`` holds, one for each id (of several, the least vector); candidates are all rows
    whose id is not the query's, repeated rows each. Rows with a null id, or a vector that is null, empty or not finite,
    take no part. Where lengths of vectors differ, missing components count as 0. Ties go to smaller ids. Components times
    256, and scores, must fit in a long: larger finite ones are taken as the largest long. The result is a written table.
    """
    require(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), integer_vector(F.col(vector_col)).alias("v"), is_query.alias("q")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    valid = valid.select("id", F.transform("v", lambda x: x.cast("double")).alias("v"), "q").withColumn("length", length)
    total, dim = valid.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    out = "query_id bigint, id bigint, score bigint"
    if not total:
        return spark.createDataFrame([], f"query_id bigint, rank int, {id_col} bigint, score bigint")
    slabs = max(1, -(-total // slab_rows))
    dealt = valid.repartitionByRange(slabs, F.desc("length"), F.xxhash64("id")).withColumn("slab", F.spark_partition_id()) if slabs > 1 else valid.withColumn("slab", F.lit(0))
    rows, rows_path = materialise(dealt, "vectors")
    sample = drawn(rows, "id", SAMPLE_ROWS, "rotation", total).select("v").toArrow().column("v").to_pylist()
    basis = rotation(_stack(sample, dim)) if sample else np.eye(dim)
    sent = spark.sparkContext.broadcast(basis)
    # one row a slab, and one of all of them
    bounds = rows.groupBy("slab").agg(F.max("length").alias("most"))
    first = bounds.orderBy(F.desc("most"), "slab").first().slab
    reach = F.broadcast(bounds.where(F.col("slab") != first).agg(F.collect_list(F.struct("slab", "most")).alias("reach")))
    queries = rows.where("q").groupBy("id").agg(F.min("v").alias("v")).withColumn("length", length)
    blocks = max(1, -(-queries.count() // block_rows))
    queries, queries_path = materialise(queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), "queries")

    def compare(slab: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(slab) or not len(block):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        order = np.lexsort((slab["id"].to_numpy(), -slab["length"].to_numpy()))
        slab = slab.iloc[order]
        q_ids = block["id"].to_numpy()
        row, ids, score = match(slab["id"].to_numpy(), _stack(slab["v"], dim), q_ids, _stack(block["v"], dim), block["floor"].to_numpy(), k, sent.value)
        return pd.DataFrame({"query_id": q_ids[row], "id": ids, "score": score.astype(np.int64)})

    def grid(asked: DataFrame) -> DataFrame:
        """The best candidates of (slab, query) rows; a slab goes to the blocks that ask for it, and to no other."""
        asking = asked.groupBy("slab").agg(F.collect_set("block").alias("blocks"))
        left = rows.join(asking, "slab").withColumn("block", F.explode("blocks")).select("slab", "block", "id", "v", "length")
        return left.groupBy("slab", "block").cogroup(asked.select("slab", "block", "id", "v", "floor").groupBy("slab", "block")).applyInPandas(compare, out)

    none = F.lit(float("-inf"))
    start, start_path = materialise(grid(queries.withColumns({"slab": F.lit(first), "floor": none})), "top-first")
    floors = start.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score").cast("double")).otherwise(none).alias("floor"))
    asked = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", none)).crossJoin(reach)
    within = F.filter("reach", lambda s: F.col("length") * s["most"] * (1 + 1e-9) + 1e-6 >= F.col("floor"))
    asked = asked.withColumn("slab", F.explode(F.transform(within, lambda s: s["slab"]))).drop("reach")
    found = start.unionByName(grid(asked)) if slabs > 1 else start
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    result, _ = materialise(ranked.select("query_id", "rank", F.col("id").alias(id_col), "score"), "top")
    discard(spark, rows_path, queries_path, start_path)
    return result
