"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints are grouped first, so copies cost nothing.  Two fingerprints that differ in at
most r bits agree wholly in some blocks of bits, so they share a bucket:

* ``agreeing_blocks``: the bits are cut into r + 2 blocks (64 bits, r = 4: six); at least two
  of them agree.  Every pair of blocks is a table of buckets: no pair is missed.
* ``bands``: for radii too wide for that, many tables of 16 bits each; a pair is missed only
  if all tables split it (at 15 % of differing bits, 32 tables: 8 %; at 10 %: 0.3 %).

Buckets with several fingerprints go to tasks; one with more than ``CHUNK`` is cut into
chunks whose pairs are separate units of work, so no bucket is held whole.  In a task the
bits stand as vertical planes; distances are counted by carry-save counters for 64 pairs at
a time, and blocks are left once all their pairs are beyond the radius (``llm/bits.py``).  A
unit returns a spanning forest of its links, never all pairs; ``components`` joins them.

Edge cases: a text without words (null, empty, blanks) has fingerprint zero and is linked
like any other; a text shorter than a shingle is one shingle; rows that repeat are copies;
a null id is never a component's id unless all ids of the component are null; an empty table
gives no rows; columns other than id and text play no part, and ``keep_first`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalia.llm import bits
from retalia.llm.common import handing_back, stored, table, words
from retalia.llm.components import components

CHUNK = 1024  # fingerprints of a bucket that meet in one unit of work
SMALL = 48  # groups up to this size are compared together
SEED = 42
_SPREAD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: odd multiplier that derives more hashes from one


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 of every k-word shingle of the text, in order, repeats included."""
    w = words(text)
    if len(w) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), SEED)] if w else [], np.uint64)
    joined = b" ".join(w)
    size = np.fromiter(map(len, w), np.int64, len(w))
    end = np.cumsum(size + 1) - 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[i:j], SEED) for i, j in zip((end - size)[: len(w) - k + 1].tolist(), end[k - 1 :].tolist())], np.uint64)


def fingerprint(text: str | None, k: int, count: int) -> np.ndarray:
    """``count`` 64-bit words; a bit is set if it is set in over half of the hashes."""
    h = shingle_hashes(text, k)
    out = np.zeros(count, np.uint64)
    if len(h):
        for i in range(count):
            if i:
                h = (h ^ (h >> np.uint64(29))) * _SPREAD
                h ^= h >> np.uint64(32)
            ones = np.zeros(64, np.int64)
            for at in range(0, len(h), 4096):
                part = np.ascontiguousarray(h[at : at + 4096])
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]
    return out


def fingerprint_column(text: Column, k: int, count: int) -> Column:
    @F.pandas_udf("array<long>")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, k, count).view(np.int64) for t in texts], dtype=object)

    return udf(text)


def _bits(fp: Column, start: int, width: int) -> Column:
    """``width`` bits from bit ``start`` on; they don't cross a word."""
    return F.shiftrightunsigned(F.element_at(fp, start // 64 + 1), start % 64).bitwiseAND(F.lit((1 << width) - 1))


def agreeing_blocks(fp: Column, radius: int) -> list[Column]:
    """A key for each pair of the radius + 2 blocks of a 64-bit fingerprint."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [_bits(fp, a, b - a) for a, b in zip(edges, edges[1:])]
    return [F.shiftleft(x, 32).bitwiseOR(y) for x, y in combinations(blocks, 2)]


def bands(fp: Column, count: int) -> list[Column]:
    return [_bits(fp, 16 * i, 16) for i in range(4 * count)]


def _link(batches: Iterator[pd.DataFrame], count: int, radius: int) -> Iterator[pd.DataFrame]:
    """Forests of the groups of a partition that is sorted by ``gid``."""

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        group, side, node = (pdf[c].to_numpy() for c in ("gid", "side", "node"))
        fps = np.stack([pdf[f"w{i}"].to_numpy() for i in range(count)], axis=1).view(np.uint64)
        label = np.arange(len(group))
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[starts, len(group)])
        small = np.repeat(sizes <= SMALL, sizes)
        if small.any():
            at = np.flatnonzero(small)
            part = np.arange(len(at))
            bits.link_neighbours(fps[at], group[at], int(sizes[sizes <= SMALL].max()), radius, part)
            label[at] = at[part]
        for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
            rows = np.arange(start, start + size)
            one, other = rows[side[rows] < 2], rows[side[rows] != 1]
            if len(one) and len(other):
                bits.link_blocks(one, other, fps, radius, label)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": node[linked], "b": node[label[linked]]})

    rest = None
    for pdf in batches:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        last = pdf["gid"].to_numpy() == pdf["gid"].iloc[-1] if len(pdf) else np.zeros(0, bool)
        rest, whole = pdf[last], pdf[~last]
        if len(whole):
            yield forest(whole.reset_index(drop=True))
    if rest is not None and len(rest):
        yield forest(rest.reset_index(drop=True))


def links(classes: DataFrame, count: int, radius: int) -> DataFrame:
    """Spanning forests (a, b) over ``classes`` (node, fp) at ``radius`` or fewer differing bits."""
    fp = F.col("fp")
    keys = agreeing_blocks(fp, radius) if count == 1 else bands(fp, count)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), k.alias("key")) for t, k in enumerate(keys)])
    rows = classes.select("node", "fp", F.explode(tables).alias("b")).select("node", "fp", "b.t", "b.key")
    shared = classes.select(F.explode(tables).alias("b")).groupBy("b.t", "b.key").agg(F.count("*").alias("n"))
    shared = stored(shared.filter("n > 1"), "simhash-buckets")
    met = rows.join(shared, ["t", "key"])
    # A bucket of c chunks makes c * (c + 1) / 2 units; a row goes to the c units of its chunk.
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    met = met.withColumns({"chunks": chunks, "chunk": F.pmod(F.xxhash64("node", "t"), chunks).cast("int")})
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    unit = F.xxhash64("t", "key", F.least("chunk", "other"), F.greatest("chunk", "other"))
    side = F.when(F.col("chunk") == F.col("other"), 0).when(F.col("chunk") < F.col("other"), 1).otherwise(2)
    units = met.select(
        unit.alias("gid"), side.cast("byte").alias("side"), "node", *[F.element_at("fp", i + 1).alias(f"w{i}") for i in range(count)]
    )
    return units.repartition("gid").sortWithinPartitions("gid").mapInPandas(handing_back(lambda it: _link(it, count, radius)), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    words64: int = 1,
    radius: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id``, ``text_hash``, ``fp`` (64-bit words), ``first_id``, ``first_hash``.

    The last two name the first document (by id, then by hash of the text) of the component;
    null ids come behind all others.
    """
    ident = F.col(id_col).cast("long").alias("id")
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")
    ids = docs.select(ident, text_hash, fingerprint_column(F.col(text_col), shingle, words64).alias("fp"))
    ids = stored(ids, "simhash-rows")
    node = F.element_at("fp", 1) if words64 == 1 else F.xxhash64("fp")
    classes = ids.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("rep"))
    classes = stored(classes.select(node.alias("node"), "fp", "rep"), "simhash-classes")
    roots = components(stored(links(classes, words64, radius), "simhash-links"))
    members = classes.select("node", "rep").join(roots, "node", "left")
    members = stored(members.select("node", "rep", F.coalesce("root", "node").alias("root")), "simhash-members")
    first = stored(members.groupBy("root").agg(F.min("rep").alias("first")), "simhash-firsts")
    named = members.join(first, "root").select("node", F.col("first.id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    named = stored(named, "simhash-named")
    return ids.withColumn("node", node).join(named, "node").drop("node")


def keep_first(docs: DataFrame, shingle: int = 5, words64: int = 8, radius: int = 82) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the first by id.

    With 512 bits, which measure the angle between shingle sets, 0.8 Jaccard similarity is an
    angle of 27 degrees, 78 bits; ``radius`` is one standard deviation (8) above half a bit of
    it.  The pipeline takes the fingerprints of ``op1_simhash`` instead.  Rows that agree in id
    and text are one document.
    """
    found = near_duplicates(docs.select("doc_id", "text"), shingle, words64, radius)
    first = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    kept = found.filter(first).select(F.col("id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    kept = stored(kept, "simhash-kept")
    ident = F.col("doc_id").cast("long").alias("id")
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash")
    rows = docs.select(F.struct("*").alias("row"), ident, text_hash)
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "text_hash"]).select("row.*")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.lpad(F.lower(F.hex(F.element_at("fp", 1))), 16, "0")
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("first_id").alias("component_id"))
