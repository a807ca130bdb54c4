"""Exact top-k by inner product, with elimination by a pivot table.

The table holds each vector's distance to ``PIVOTS`` pivots.  For a query q and a row x every
pivot p gives |d(q, p) - d(x, p)| <= d(q, x); the largest of these lower bounds turns into an
upper bound of the score, (|q|^2 + |x|^2 - bound^2) / 2.  Rows of a block are scored in falling
order of that bound, and a query is done with a block as soon as the next bound is below its
k-th score so far (a tie of bound and score is still scored, for the smaller id).

Rows are dealt into ``GRID`` blocks, into more only where a block would hold over ``BLOCK`` vectors,
each with its row of the pivot table, and queries into blocks of ``QUERIES``.  The stated query set
meets all rows, a pair of blocks a unit of work, and what the units find is ranked once more.  So a
row is sent once for each block of queries, and a query once for each of the few blocks of rows.  The pivots are picked, far apart, from a
bounded sample of rows (the ``SAMPLE`` smallest hashes); they only affect speed.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part;
vectors of different lengths are not compared; rows that repeat are candidates each, and with
equal scores and ids in any order; a query's own row is left out by its id, so other rows with
that id are no candidates either, and rows that share a query id answer together; a null id takes
no part; scores that pass 52 bits are computed with whole numbers of any size, and one of the best
that does not fit in a long is an error.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retalia.llm.common import stored, table

PIVOTS = 32
SAMPLE = 1024
GRID = 16  # blocks of rows, while they are no larger than BLOCK
LEAST = 256  # rows of a block, if there are so many
BLOCK = 32_768
QUERIES = 8192
CHUNK = 256  # rows scored between two looks at the bounds


def quantized(x: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component, as doubles if these are exact, else as whole numbers of any size."""
    scaled = np.floor(x * 256.0)
    if np.abs(scaled).max(initial=0) < 2.0**52:
        return scaled
    return np.array([[int(256 * Fraction(c) // 1) for c in row] for row in x.tolist()], object).reshape(x.shape)


def valid(embedding: Column) -> Column:
    """Neither null nor empty, and all components finite."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(embedding) > 0) & fine, F.lit(False))


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the row farthest from those before it."""
    picked, near = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < min(count, len(sample)):
        picked.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[picked[-1]], axis=1))
    return sample[picked]


def distances(v: Column, dim: Column, pivots: dict[int, np.ndarray]) -> Column:
    """A row's part of the pivot table."""

    @F.pandas_udf("array<double>")
    def udf(vs: pd.Series, dims: pd.Series) -> pd.Series:
        own = (quantized(np.asarray(x, float)[None, :]).astype(float) for x in vs)
        return pd.Series([np.linalg.norm(pivots[d] - x, axis=1) for x, d in zip(own, dims)], dtype=object)

    return udf(v, dim)


def _products(x: np.ndarray, q: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of rows with a query; ``most`` bounds their size."""
    if most < 2.0**52:
        return (x @ q).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(row, q)) for row in x], object)


def _search(ids, x, far, q_ids, q, q_far, best: dict, k: int) -> None:
    """Updates ``best`` (query id: scores and ids, best first) with a block of rows."""
    xf, qf = x.astype(float), q.astype(float)
    norms = np.square(xf).sum(axis=1)
    most = np.abs(xf).max(initial=0) * np.abs(qf).max(initial=0) * x.shape[1]
    for start in range(0, len(q), 64):
        some = slice(start, start + 64)
        bound = np.zeros((len(q[some]), len(x)))
        for p in range(len(far)):
            np.maximum(bound, np.abs(q_far[p][some, None] - far[p][None, :]), out=bound)
        q_norm = np.square(qf[some]).sum(axis=1)
        upper = (q_norm[:, None] + norms[None, :] - np.square(bound)) / 2
        upper += 1e-9 * (q_norm[:, None] + norms[None, :]) + 1e-6  # rounding of the distances
        upper[~np.isfinite(upper)] = np.inf  # beyond doubles nothing is ruled out
        for row, i in enumerate(range(start, start + len(bound))):
            own = int(q_ids[i])
            score, who = best.get(own, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            open_ = np.flatnonzero(upper[row] >= (score[-1] if len(score) == k else -np.inf))
            order = open_[np.argsort(-upper[row][open_], kind="stable")]
            for at in range(0, len(order), CHUNK):
                part = order[at : at + CHUNK]
                if len(score) == k and upper[row][part[0]] < score[-1]:
                    break
                got = _products(x[part], q[i], most)
                other = ids[part] != own
                score, who = np.r_[score, got[other]], np.r_[who, ids[part][other]]
                if score.dtype == object:
                    top = np.array(sorted(range(len(score)), key=lambda j: (-score[j], who[j]))[:k], np.int64)
                else:
                    top = np.lexsort((who, -score))[:k]
                score, who = score[top], who[top]
            best[own] = (score, who)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the largest integer inner products."""

    def prepared(df: DataFrame) -> DataFrame:
        df = df.filter(F.col(id_col).isNotNull() & valid(F.col(vec_col)))
        v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
        return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim"))

    rows = stored(prepared(vectors), "topk-rows")
    asked = prepared(queries).distinct()
    dims = [r["dim"] for r in rows.select("dim").distinct().collect()]
    pivots = {}
    for dim in dims:
        sample = rows.filter(F.col("dim") == dim).orderBy(F.xxhash64("v"), "id").limit(SAMPLE)
        sample = np.array([r["v"] for r in sample.select("v").collect()], float).reshape(-1, dim)
        pivots[dim] = _pivots(quantized(sample).astype(float), PIVOTS)
    far = distances(F.col("v"), F.col("dim"), pivots)
    asked = stored(asked.filter(F.col("dim").isin(dims)).withColumn("far", far), "topk-queries")
    rows = stored(rows.withColumn("far", far), "topk-pivot-table")
    # A unit of work is one block of queries against one block of rows, both by hash.
    count = rows.count()
    blocks = max(1, min(GRID, count // LEAST), -(-count // BLOCK))
    asked_blocks = max(1, -(-asked.count() // QUERIES))
    place = F.xxhash64("v", "id")
    left = rows.withColumn("b", F.pmod(place, F.lit(blocks))).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))))
    right = asked.withColumn("q", F.pmod(place, F.lit(asked_blocks)).cast("int"))
    right = right.withColumn("b", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        best: dict[int, tuple] = {}
        if len(rows) and len(asked):
            parts = []
            for side in (rows, asked):
                v = quantized(np.stack(side["v"].to_numpy()).astype(float))
                parts += [side["id"].to_numpy(), v, np.stack(side["far"].to_numpy()).T]
            _search(*parts, best, k)
        own = np.repeat(np.array(list(best), np.int64), [len(s) for s, _ in best.values()])
        score = np.concatenate([s.astype(np.int64) for s, _ in best.values()] or [np.zeros(0, np.int64)])  # or OverflowError
        who = np.concatenate([w for _, w in best.values()] or [np.zeros(0, np.int64)])
        return pd.DataFrame({"query_id": own, "vec_id": who, "score": score})

    unit = ["dim", "q", "b"]
    found = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
