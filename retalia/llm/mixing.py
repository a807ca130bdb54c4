"""Mixing sources to target weights by entropy balancing.

Every source gets a token target: all tokens are shared out by weight, no source gets more
than ``cap`` times its own tokens, and what a capped source cannot take is reshared.  The
rates r of a source's documents are those closest to "every document once" in relative
entropy, ``min sum(r ln r - r)``, with ``sum(r * tokens) = target`` and ``r <= cap``.  The
convex dual has one multiplier a source, and its solution is an exponential tilt,
``r = min(cap, exp(lambda * tokens / mean tokens))``.  Newton steps, kept inside a bracket,
run for all sources at once; each is one distributed sum over (source, size) counts.

Rates become whole copies: ``floor(r)``, and one more where a hash of the row falls below
the fraction.  A common shift of that threshold, found from distributed histograms, brings
each source within about one document of its target.  Nothing is random: reruns agree.

Only DataFrame functions.  The state is a table with a row for each source.

Edge cases: a null text has size 0; a null source is a source of its own and comes last;
a source without tokens has target 0 and its documents rate 1; rows that agree in id and
text get the same number of copies; an empty table gives no rows; other columns pass
through, and columns named as the added ones are replaced.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retalia.llm.common import set_aside, stored, table

CLOSE = 1e-6  # a source's dual is solved when its tokens are this close to its target
ROUNDS = 60
BINS = 1024


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``sizes`` (_source, source_size) with the target of each source.

    Weights repeat over the sources in code point order.  The level (tokens a weight) is the
    first one, by rising cap a weight, at which all sources from there on stay below their caps.
    """
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    ranked = sizes.withColumn("_w", weight.cast("double")).withColumn("_room", cap * F.col("source_size") / F.col("_w"))
    rise = Window.orderBy("_room", F.col("_source").asc_nulls_last())
    before, rest = rise.rowsBetween(Window.unboundedPreceding, -1), rise.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("_w").over(rest)
    found = ranked.withColumn("_level", level)
    found = found.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_room"), F.struct(F.col("_room"), F.col("_level").alias("x")))).over(everything)["x"])
    target = F.least(cap * F.col("source_size"), F.col("_level") * F.col("_w"))
    return found.select("_source", "source_size", F.coalesce(target, F.lit(0.0)).cast("double").alias("target"))


def _rate(cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(F.col("_lambda") * F.col("_x"), F.lit(50.0))))


def _by_source(left: DataFrame, state: DataFrame) -> DataFrame:
    """The state is small unless there are very many sources; Catalyst goes by its measured size."""
    return left.join(state, left["_source"].eqNullSafe(state["_source"])).drop(state["_source"])


def solve(cells: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """``_lambda`` for each source.  ``cells``: _source, _size, _n; ``state``: targets with ``_mean``."""
    solved_at_cap = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = state.withColumns({
        "_lambda": F.when(solved_at_cap, F.lit(1e18)).otherwise(F.lit(0.0)),
        "_lo": F.lit(-1e6), "_hi": F.lit(1e6),
        "_done": solved_at_cap | (F.col("source_size") == 0),
    })
    state = stored(state, "mix-state")
    for _ in range(ROUNDS):
        open_ = state.filter(~F.col("_done"))
        x = F.col("_size") / F.col("_mean")
        at = _by_source(cells, open_).withColumn("_x", x).withColumn("_r", _rate(cap))
        tokens = F.col("_n") * F.col("_size")
        sums = at.groupBy("_source").agg(
            F.sum(tokens * F.col("_r")).alias("_g"),
            F.sum(F.when(F.col("_r") < cap, tokens * F.col("_r") * F.col("_x")).otherwise(0.0)).alias("_slope"),
        )
        both = state.join(sums, state["_source"].eqNullSafe(sums["_source"]), "left").drop(sums["_source"])
        gap = F.col("_g") - F.col("target")
        lo = F.when(gap < 0, F.col("_lambda")).otherwise(F.col("_lo"))
        hi = F.when(gap > 0, F.col("_lambda")).otherwise(F.col("_hi"))
        both = both.withColumns({"_lo": lo, "_hi": hi, "_new": F.col("_lambda") - gap / F.when(F.col("_slope") > 0, F.col("_slope"))})
        wide = F.col("_hi") - F.col("_lo") > 1e5  # no bracket yet: go out by doubling
        half = F.when(wide, 2 * F.col("_lambda") - F.signum(gap)).otherwise((F.col("_lo") + F.col("_hi")) / 2)
        inside = (F.col("_new") > F.col("_lo")) & (F.col("_new") < F.col("_hi"))
        new = F.when(F.coalesce(inside, F.lit(False)), F.col("_new")).otherwise(half)
        done = F.col("_done") | (F.abs(gap) <= CLOSE * F.col("target")) | ((hi - lo) < 1e-12)
        keep = [c for c in state.columns if c not in ("_lambda", "_done")]
        state = stored(
            both.select(*keep, F.when(done, F.col("_lambda")).otherwise(new).alias("_lambda"), done.alias("_done")),
            "mix-state",
        )
        if state.filter(~F.col("_done")).isEmpty():
            break
    return state.select("_source", "source_size", "target", "_mean", F.round("_lambda", 12).alias("_lambda"))


def _whole(cap: float) -> tuple[Column, Column]:
    """Whole copies of a rate, and where the row stands against the threshold of one more (-1 to 1)."""
    whole = F.floor(_rate(cap) + 1e-9)
    place = F.when(whole + 1 <= cap, F.col("_u") - F.greatest(_rate(cap) - whole, F.lit(0.0)))
    return whole, place


def thresholds(rows: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """State with ``_theta``: rows placed below it get one more copy."""
    whole, place = _whole(cap)
    at = _by_source(rows, state).withColumn("_x", F.col("_size") / F.col("_mean"))
    at = at.select("_source", "_size", whole.alias("_whole"), place.alias("_place"))
    at = stored(at, "mix-places")
    fixed = at.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_whole")).alias("_fixed"))
    state = _by_source(fixed, state).withColumns({"_lo": F.lit(-1.0), "_width": F.lit(2.0), "_below": F.lit(0).cast("long")})
    state = stored(state, "mix-state")
    for _ in range(3):
        step = F.col("_width") / BINS
        small = state.select("_source", "_lo", "_width")
        inside = (F.col("_place") >= F.col("_lo")) & (F.col("_place") < F.col("_lo") + F.col("_width"))
        bins = _by_source(at, small).filter(inside)
        bins = bins.groupBy("_source", F.floor((F.col("_place") - F.col("_lo")) / step).alias("_bin")).agg(F.sum("_size").alias("_in"))
        up = Window.partitionBy("_source").orderBy("_bin")
        bins = bins.withColumn("_upto", F.sum("_in").over(up)).withColumnRenamed("_source", "_s")
        want = F.col("target") - F.col("_fixed") - F.col("_below")
        hit = (
            state.join(bins, F.col("_s").eqNullSafe(state["_source"]))
            .filter(F.col("_upto") <= want)
            .groupBy("_s")
            .agg(F.max(F.struct("_bin", "_upto")).alias("_last"))
        )
        # The bin after the last one that fits whole holds the threshold.
        nxt = F.coalesce(F.col("_last._bin") + 1, F.lit(0))
        both = state.join(hit, F.col("_s").eqNullSafe(state["_source"]), "left")
        state = stored(
            both.select(
                "_source", "source_size", "target", "_mean", "_lambda", "_fixed",
                (F.col("_lo") + nxt * step).alias("_lo"), step.alias("_width"),
                (F.col("_below") + F.coalesce(F.col("_last._upto"), F.lit(0))).alias("_below"),
            ),
            "mix-state",
        )
    # The last bin is narrower than 1e-8: take it or leave it, whichever comes nearer.
    inside = (F.col("_place") >= F.col("_lo")) & (F.col("_place") < F.col("_lo") + F.col("_width"))
    last = _by_source(at, state.select("_source", "_lo", "_width")).filter(inside)
    last = last.groupBy("_source").agg(F.sum("_size").alias("_in")).withColumnRenamed("_source", "_s")
    both = state.join(last, F.col("_s").eqNullSafe(state["_source"]), "left")
    missing = F.col("target") - F.col("_fixed") - F.col("_below")
    take = F.coalesce(F.col("_in") - missing < missing, F.lit(False))
    theta = F.when(take, F.col("_lo") + F.col("_width")).otherwise(F.col("_lo"))
    return stored(both.select("_source", "source_size", "target", "_mean", "_lambda", theta.alias("_theta")), "mix-state")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    cap: float = 3.0,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` (0 to ``cap``)."""
    docs, back = set_aside(docs)
    u = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col(id_col), F.col(text_col)), 12) / F.lit(float(1 << 52))
    added = ["size", "source_size", "target", "rate", "copies"]
    rows = docs.drop(*added).withColumns({"_source": F.col(source_col).cast("string"), "_size": token_count(F.col(text_col)), "_u": u})
    compact = stored(rows.select("_source", "_size", "_u"), "mix-rows")
    cells = stored(compact.groupBy("_source", "_size").agg(F.count("*").alias("_n")), "mix-cells")
    sizes = cells.groupBy("_source").agg(
        F.sum(F.col("_size") * F.col("_n")).alias("source_size"),
        (F.sum(F.col("_size") * F.col("_n")) / F.sum("_n")).alias("_mean"),
    )
    sizes = stored(sizes, "mix-sources")
    aim = targets(sizes.select("_source", "source_size"), weights, cap)
    mean = F.when(F.col("_mean") > 0, F.col("_mean")).otherwise(1.0)
    state = _by_source(aim, sizes.select("_source", mean.alias("_mean")))
    state = thresholds(compact, solve(cells, state, cap), cap)
    out = _by_source(rows, state).withColumn("_x", F.col("_size") / F.col("_mean"))
    whole, place = _whole(cap)
    copies = whole + F.when(F.coalesce(place < F.col("_theta"), F.lit(False)), 1).otherwise(0)
    out = out.withColumns({"size": F.col("_size"), "rate": _rate(cap), "copies": copies.cast("int")})
    return out.select(*[c for c in docs.columns if c not in added], *added).withColumnsRenamed(back)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken, "copies", "rate")


__all__ = ["mix", "op9_mixing", "solve", "targets", "thresholds"]
