"""Sharding by histogram sort: exact bytes below candidate boundaries, one exchange.

Rows are ordered by (hash of the text, doc_id), so equal texts stand together and a
group of copies is cut only where a boundary falls into it.  The splitters of that order
are found without sorting (ids by their bits, so that any longs will do): every round counts the exact bytes below 4096 evenly spaced
candidate boundaries inside the interval of each splitter that is still open, and keeps
the candidate interval that holds the wanted byte position.  When all splitters are
within tolerance the rows are exchanged once, for their final shard and slot.

Only DataFrame functions; a round brings at most ``shards * 4096`` sums to the driver.

Edge cases: a null text counts as empty (size 1: every document has one byte more than
its text); null ids count as -1 in the order; rows that agree in id and text share a
shard, except that their slots differ; an empty table gives no rows; other columns are
passed through, and columns called ``size``, ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retalia.llm.common import set_aside, stored, table

BITS = 12  # a round looks at 2**BITS candidate boundaries for each splitter
HASH_BITS = 60
SLOT_ROWS = 50_000  # rows whose slots are dealt by one window


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _hash(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - HASH_BITS)


@dataclass
class _Splitter:
    """Search for the key with ``target`` bytes below: ``below`` bytes come before the interval."""

    target: float
    below: int = 0
    hash_from: int = 0
    hash_bits: int = HASH_BITS  # the interval covers hash_from .. hash_from + 2**hash_bits - 1
    id_from: int = 0  # ids from the smallest long on, as unsigned numbers
    id_bits: int = -1  # set once the interval is a single hash
    found: tuple[int, int] | None = None


_LEAST = 1 << 63


def _bits_of(id_: Column) -> Column:
    """The id as an unsigned number from the smallest long on, in the bits of a long."""
    return id_.bitwiseXOR(F.lit(-_LEAST))


def _long(unsigned: int) -> int:
    return unsigned - (1 << 64) if unsigned >= _LEAST else unsigned


def _inside(s: _Splitter) -> Column:
    here = F.shiftrightunsigned("_h", s.hash_bits) == F.lit(s.hash_from >> s.hash_bits)
    if 0 <= s.id_bits < 64:
        here = here & (F.shiftrightunsigned("_i", s.id_bits) == F.lit(_long(s.id_from >> s.id_bits)))
    return here


def _probe(keys: DataFrame, open_: list[tuple[int, _Splitter]]) -> list:
    """Bytes in each candidate interval of each open splitter, with the hash's range there."""
    inside, parts = F.lit(False), []
    for j, s in open_:
        here = _inside(s)
        inside = inside | here
        column, bits = ("_i", s.id_bits) if s.id_bits >= 0 else ("_h", s.hash_bits)
        digit = F.shiftrightunsigned(column, max(0, bits - BITS))
        parts.append(F.when(here, F.struct(F.lit(j).alias("j"), digit.alias("digit"))))
    rows = keys.filter(inside).select(
        F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("p"), "_h", "_size"
    )
    return (
        rows.groupBy("p")
        .agg(F.sum("_size").alias("bytes"), F.min("_h").alias("h0"), F.max("_h").alias("h1"))
        .select("p.j", "p.digit", "bytes", "h0", "h1")
        .collect()
    )


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """First (hash, id) of each shard but the first.  ``keys``: ``_h``, ``_i`` (bits of the id), ``_size``."""
    # The search among ids starts below the leading bits that all of them share.
    total, low, high = keys.agg(F.sum("_size"), F.min(_bits_of(F.col("_i"))), F.max(_bits_of(F.col("_i")))).first()
    if not total:
        return []
    low, high = low + _LEAST, high + _LEAST
    id_span = max(1, (low ^ high).bit_length())
    id_start = low >> id_span << id_span
    allowed = tolerance * total / shards
    state = [_Splitter(total * j / shards) for j in range(1, shards)]
    while open_ := [(j, s) for j, s in enumerate(state) if s.found is None]:
        counted: dict[int, list] = {}
        for row in _probe(keys, open_):
            counted.setdefault(row.j, []).append(row)
        for j, s in open_:
            by_id, bits = s.id_bits >= 0, s.id_bits if s.id_bits >= 0 else s.hash_bits
            step = max(0, bits - BITS)
            below = s.below
            for row in sorted(counted[j], key=lambda r: r.digit % (1 << 64)):
                if below + row.bytes >= s.target:
                    break
                below += row.bytes
            start, s.below = row.digit % (1 << 64) << step, below
            if row.bytes <= allowed or (by_id and step == 0):
                # within tolerance, or a single key: cut at the nearer end of the interval
                if s.target - below > below + row.bytes - s.target:
                    start += 1 << step
                s.found = (s.hash_from, start) if by_id else (start, 0)
            elif by_id:
                s.id_from, s.id_bits = start, step
            elif row.h0 == row.h1:  # one text alone: go on among the ids of its copies
                s.hash_from, s.hash_bits, s.id_from, s.id_bits = row.h0, 0, id_start, id_span
            else:
                s.hash_from, s.hash_bits = start, step
    # Behind the largest id comes the next hash; ids as longs again.
    ends = [(h, i) if i < 1 << 64 else (h + 1, 0) for h, i in (s.found for s in state)]
    return [(h, i - _LEAST) for h, i in ends]


def shard_documents(
    docs: DataFrame,
    shards: int = 8,
    tolerance: float = 1e-4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``.

    Shards get near equal bytes: every splitter is within ``tolerance`` of a shard's bytes
    (or within one document) of its exact place.  ``slot`` counts from 0 in each shard.
    """
    docs, back = set_aside(docs)
    rows = docs.withColumns({"size": size_of(F.col(text_col)), "_h": _hash(F.col(text_col)), "_id": F.coalesce(F.col(id_col).cast("long"), F.lit(-1))})
    rows = rows.withColumn("_i", _bits_of(F.col("_id")))
    keys = stored(rows.select("_h", "_i", F.col("size").alias("_size")), "shard-keys")
    bounds = splitters(keys, shards, tolerance)
    shard = F.lit(0)
    for h, i in bounds:
        shard = shard + F.when((F.col("_h") > h) | ((F.col("_h") == h) & (F.col("_id") >= i)), 1).otherwise(0)
    # Slots: rows are dealt over many parts of a shard, and the parts' sizes give their offsets.
    parts = max(256, -(-keys.count() // (shards * SLOT_ROWS)))
    part = F.pmod(F.xxhash64("_h", "_i"), F.lit(parts))
    counts = keys.withColumn("_id", _bits_of(F.col("_i"))).groupBy(shard.alias("shard"), part.alias("_part")).count()
    ahead = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_from"))
    within = Window.partitionBy("shard", "_part").orderBy("_h", "_id")
    dealt = rows.drop("shard", "slot").withColumns({"shard": shard, "_part": part})
    dealt = dealt.withColumn("slot", F.row_number().over(within).cast("long") - 1)
    out = dealt.join(offsets, ["shard", "_part"]).withColumn("slot", F.col("slot") + F.col("_from"))
    return out.drop("_h", "_id", "_i", "_part", "_from").withColumnsRenamed(back)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    out = shard_documents(docs.withColumn("text_crc32", crc), shards=8)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
