"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors become one class with a count.  The second moments of all unit vectors are summed
by Spark; their eigenvectors, by falling eigenvalue, are the order of dimensions in which
products are accumulated.  Classes stand in tiles by ranges of the first principal component:
vectors with a cosine of t or more differ there by at most sqrt(2 - 2t), so tiles farther
apart never meet.  There are about ``GRID`` tiles, more only where a tile would hold over ``TILE``
vectors: a vector is sent once for each tile it meets, so few large tiles are sent least.  A range
with too many members is cut by hash, so no tile grows beyond that with the data.

A unit of work is a pair of tiles.  It adds products over the leading dimensions first, bounds
what is left by the product of the suffix norms, drops rows and columns in which no pair can
reach the threshold, and stops when none is left.  What survives is checked with the exact
cosine in double precision.  A unit returns the number of links of each class and a spanning
forest, never all pairs.

Edge cases: vectors that are null, empty or zero, or hold null or non-finite components link
with nothing, not even with copies (0 links, a component of their own); vectors of different
lengths don't link; rows that repeat are linked vectors; a null id is never a component's id
unless all ids of the component are null; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalia.llm.bits import unite
from retalia.llm.common import stored, table
from retalia.llm.components import components
from retalia.llm.topk import valid

GRID = 8  # tiles, while they are no larger than TILE
LEAST = 256  # classes of a tile, if there are so many
TILE = 32_768
BLOCK = 512  # rows of a tile compared at a time
STEP = 8  # dimensions between two looks at the bounds


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow on the way; zero rows stay zero."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), np.finfo(float).tiny)


def moments(classes: DataFrame) -> dict[int, np.ndarray]:
    """Sum of u u' over the unit vectors u of each length; a row of numbers a dimension is collected."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for dim, own in pdf.groupby("dim")["v"]:
                u = unit_rows(np.stack(own.to_numpy()).astype(float))
                total[dim] = total.get(dim, 0) + u.T @ u
        for dim, m in total.items():
            yield pd.DataFrame({"dim": dim, "i": np.repeat(np.arange(dim), dim), "j": np.tile(np.arange(dim), dim), "m": m.ravel()})

    summed = classes.select("dim", "v").mapInPandas(sums, "dim int, i int, j int, m double")
    out: dict[int, np.ndarray] = {}
    for r in summed.groupBy("dim", "i", "j").agg(F.sum("m").alias("m")).collect():
        out.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["i"], r["j"]] = r["m"]
    return out


def rotations(second: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Eigenvectors as columns, by falling eigenvalue."""
    return {dim: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for dim, m in second.items()}


def first_component(v: Column, dim: Column, rotation: dict[int, np.ndarray]) -> Column:
    leading = {d: r[:, 0].copy() for d, r in rotation.items()}

    @F.pandas_udf("double")
    def udf(vs: pd.Series, dims: pd.Series) -> pd.Series:
        out = np.zeros(len(vs))
        for d in dims.unique():
            own = (dims == d).to_numpy()
            out[own] = unit_rows(np.stack(vs[own].to_numpy()).astype(float)) @ leading[d]
        return pd.Series(out)

    return udf(v, dim)


def near_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of x and y (unit vectors in principal order) that may reach the threshold."""
    slack = threshold - 1e-9
    tails = [np.sqrt(np.maximum(np.cumsum(np.square(z)[:, ::-1], axis=1)[:, ::-1], 0)) for z in (x, y)]
    a, b = np.arange(len(x)), np.arange(len(y))
    products = np.zeros((len(x), len(y)))
    dims = x.shape[1]
    for start in range(0, dims, STEP):
        stop = min(start + STEP, dims)
        products += x[a, start:stop] @ y[b, start:stop].T
        if stop < dims:
            bound = products + np.outer(tails[0][a, stop], tails[1][b, stop])
        else:
            bound = products
        open_ = bound >= slack
        rows, cols = open_.any(axis=1), open_.any(axis=0)
        if not rows.any():
            return a[:0], b[:0]
        if stop == dims or open_.sum() <= 2 * (len(a) + len(b)):
            i, j = np.nonzero(open_)
            return a[i], b[j]
        if not (rows.all() and cols.all()):
            a, b, products = a[rows], b[cols], products[np.ix_(rows, cols)]
    return a[:0], b[:0]


def compare(left: pd.DataFrame, right: pd.DataFrame, rotation: np.ndarray, threshold: float, same: bool) -> pd.DataFrame:
    """node, links, root for the classes of two tiles, or of one with itself."""
    sides = [left] if same else [left, right]
    node = np.concatenate([s["node"].to_numpy() for s in sides])
    copies = np.concatenate([s["n"].to_numpy() for s in sides])
    raw = np.concatenate([np.stack(s["v"].to_numpy()).astype(float) for s in sides])
    units = unit_rows(raw)
    turned = units @ rotation
    links, label = np.zeros(len(node), np.int64), np.arange(len(node))
    middle = len(left)
    starts = [(i, j) for i in range(0, middle, BLOCK) for j in (range(i, middle, BLOCK) if same else range(middle, len(node), BLOCK))]
    for i, j in starts:
        i_end, j_end = min(i + BLOCK, middle), min(j + BLOCK, len(node))
        a, b = near_pairs(turned[i:i_end], turned[j:j_end], threshold)
        a, b = a + i, b + j
        if i == j:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), 65536):
            p, q = a[at : at + 65536], b[at : at + 65536]
            linked = np.einsum("ij,ij->i", units[p], units[q]) >= threshold
            p, q = p[linked], q[linked]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            unite(label, p, q)
    some = links > 0
    return pd.DataFrame({"node": node[some], "links": links[some], "root": node[label[some]]})


def _by_id(name: str) -> Column:
    """An id with null ids behind all others."""
    return F.struct(F.col(name).isNull().alias("none"), F.col(name).alias("id"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for every row of ``vectors``."""
    v = F.col(vec_col)
    fine = valid(v) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(fine, v).alias("v"))
    ids = stored(rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "embed-rows")
    classes = ids.filter("v IS NOT NULL").groupBy("node", "v").agg(F.min(_by_id("id")).alias("rep"), F.count("*").alias("n"))
    classes = stored(classes.withColumn("dim", F.size("v")), "embed-classes")
    rotation = rotations(moments(classes))
    first = classes.select("dim", "node", "v", "n", first_component(F.col("v"), F.col("dim"), rotation).alias("pc"))
    first = stored(first, "embed-components")
    # Tiles: ranges of the first component with about as many classes each.
    count = first.count()
    tile = min(TILE, max(LEAST, -(-count // GRID)))
    shares = [i * tile / count for i in range(1, -(-count // tile))] if count else []
    cuts = np.unique(first.approxQuantile("pc", shares, min(0.01, tile / count / 8))) if shares else np.zeros(0)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    lows = np.r_[-np.inf, cuts]
    last = np.searchsorted(lows, np.r_[cuts, np.inf] + reach, side="right") - 1  # last range that a range can reach

    @F.pandas_udf("range int, last int")
    def ranged(pc: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(cuts, pc.to_numpy(), side="right")
        return pd.DataFrame({"range": at.astype(np.int32), "last": last[at].astype(np.int32)})

    placed = first.withColumn("r", ranged("pc")).select("dim", "node", "v", "n", "r.range", "r.last")
    parts = placed.groupBy("range").agg(F.ceil(F.count("*") / (2 * tile)).cast("int").alias("parts"))
    parts = stored(parts, "embed-ranges")
    placed = placed.join(parts, "range").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
    placed = stored(placed.drop("parts"), "embed-tiles")
    # Each tile meets itself and the tiles after it, up to its reach.
    tiles = placed.select("range", "last", "part").distinct()
    other = parts.select(F.col("range").alias("range2"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part2"))
    met = tiles.withColumn("range2", F.explode(F.sequence("range", "last"))).join(other, "range2").drop("last")
    met = stored(met.filter("range2 > range OR part2 >= part"), "embed-pairs")
    left = placed.drop("last").join(met, ["range", "part"])
    right = placed.select("dim", "node", "v", "n", F.col("range").alias("range2"), F.col("part").alias("part2"))
    right = right.join(met.filter("range <> range2 OR part <> part2"), ["range2", "part2"])
    unit = ["dim", "range", "part", "range2", "part2"]
    right = right.select(*[F.col(c).alias(c) for c in (*unit, "node", "v", "n")])  # columns of its own

    def work(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        dim, r, p, r2, p2 = key
        same = (r, p) == (r2, p2)
        if not len(a) or not (same or len(b)):
            return pd.DataFrame({"node": [], "links": [], "root": []}).astype(np.int64)
        return compare(a, b, rotation[int(dim)], threshold, same)

    found = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInPandas(work, "node long, links long, root long")
    found = stored(found, "embed-links")
    roots = components(found, "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    members = classes.select("node", "rep", "n").join(roots, "node", "left").join(links, "node", "left")
    members = members.select("node", "rep", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    members = stored(members, "embed-members")
    least = stored(members.groupBy("root").agg(F.min("rep").alias("component_id")), "embed-roots")
    named = stored(members.join(least, "root").select("node", "n_links", "component_id"), "embed-named")
    out = ids.select("id", "node").join(named, "node", "left")
    own = F.col("id")
    component = F.when(F.col("component_id").isNotNull(), F.col("component_id.id")).otherwise(own)
    return out.select(
        own.alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        own.eqNullSafe(component).alias("kept"),
    )


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), component AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT c.vec_id, (SELECT count(*) FROM links l WHERE l.a = c.vec_id) AS n_links, c.component_id,
       c.vec_id = c.component_id AS kept
FROM component c
"""
