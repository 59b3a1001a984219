"""Exact interpolated quantiles by distributed selection.

Each wanted rank lies in a bracket of values whose size and offset are known by count. A pass cuts every bracket that
is still too large by a histogram of fixed size and keeps the bin with the rank; the last pass sorts what is left. No
task ever sorts more than a constant number of values, whatever the column's or a group's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.tables import materialise

#: Values that one task may sort.
MOST = 100_000
#: Bins of a pass's histogram.
BINS = 4096
LARGEST = 1.7976931348623157e308


def _place(v: Column, lo: Column, hi: Column, bins: int, logarithmic: bool) -> Column:
    """Bin of a value between ``lo`` and ``hi``: the ends fall in different bins and no larger value in a smaller bin."""

    def scale(x: Column) -> Column:
        x = F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST)) * 0.5
        return F.signum(x) * F.log1p(F.abs(x)) if logarithmic else x

    low, high = scale(lo), scale(hi)
    share = F.when(high > low, (scale(v) - low) / (high - low)).otherwise(0.5)
    inner = F.least(F.floor(share * (bins - 2)), F.lit(bins - 3)) + 1
    return F.when(v == lo, 0).when(v == hi, bins - 1).otherwise(inner).cast("int")


def _held(rank: Column, part: Column) -> Column:
    return (rank >= part["before"]) & (rank < part["before"] + part["held"])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), most: int = MOST, bins: int = BINS, stored: bool = False) -> DataFrame:
    """One row per (by..., metric) with ``n``, ``low``, ``high`` and ``q``: the quantiles in the order of ``probs``.

    Linear interpolation between order statistics. Null values and null group keys are left out; NaN counts as largest.
    Values are read once for the counts, once a pass while a bracket holds more than ``most`` values that differ, and
    once at the end; a pass cuts a bracket to about one part in ``bins``. They must be the same each time, which sums
    of doubles are not, so they are written first, unless ``df`` is ``stored``: columns of a table as they are. The last
    pass fails where it does not find the values that were counted.
    """
    keys = [*by, "metric"]
    cells = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols]
    )
    long = df.select(*by, F.inline(cells)).where(F.col("value").isNotNull()).dropna(subset=list(by) or None)
    if not stored:
        long = materialise(long, "values")
    stats = long.groupBy(*keys).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    spots = F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in probs])
    ranks = F.array_distinct(F.concat(F.transform(spots, lambda s: F.floor(s)), F.transform(spots, lambda s: F.ceil(s))))
    whole = F.struct(F.col("low").alias("lo"), F.col("high").alias("hi"), F.lit(0).cast("long").alias("before"), F.col("n").alias("held"))
    state = _settled(stats.select("*", ranks.alias("ranks")).withColumn("brackets", F.transform("ranks", lambda r: whole)), by)

    def large(b: Column) -> Column:
        return (b["held"] > most) & (b["lo"] < b["hi"])

    def inside(side: DataFrame, brackets: Column) -> DataFrame:
        """Values that lie in one of their group's brackets, which are disjoint or the same."""
        side = side.select(*keys, F.array_distinct(brackets).alias("_b"))
        hit = F.get(F.filter("_b", lambda b: (F.col("value") >= b["lo"]) & (F.col("value") <= b["hi"])), F.lit(0))
        joined = long.join(side if by else F.broadcast(side), keys)  # without groups: one row per listed column
        return joined.select(*keys, "value", hit.alias("b")).where("b is not null")

    turn = 0
    while not (todo := state.where(F.exists("brackets", large))).isEmpty():
        bin_ = _place(F.col("value"), F.col("b.lo"), F.col("b.hi"), bins, turn % 2 == 1)
        cut = inside(todo, F.filter("brackets", large)).groupBy(*keys, F.col("b.before").alias("start"), bin_.alias("bin"))
        cut = cut.agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("held"))
        # At most ``bins`` rows a bracket: counts add up to the offset of each bin.
        ahead = F.sum("held").over(W.partitionBy(*keys, "start").orderBy("bin")) - F.col("held")
        part = F.struct("lo", "hi", (F.col("start") + ahead).alias("before"), "held")
        parts = cut.select(*keys, part.alias("p")).join(todo.select(*keys, "ranks"), keys)
        parts = parts.where(F.exists("ranks", lambda r: _held(r, F.col("p")))).groupBy(*keys).agg(F.collect_list("p").alias("parts"))

        def narrower(r: Column, b: Column) -> Column:
            return F.when(large(b), F.get(F.filter("parts", lambda p: _held(r, p)), F.lit(0))).otherwise(b)

        state = _settled(state.join(parts, keys, "left").withColumn("brackets", F.zip_with("ranks", "brackets", narrower)).drop("parts"), by)
        turn += 1

    ends = inside(state, F.filter("brackets", lambda b: b["lo"] < b["hi"])).groupBy(*keys, F.col("b.before").alias("before"))
    ends = ends.agg(F.sort_array(F.collect_list("value")).alias("values"))
    ends = ends.groupBy(*keys).agg(F.collect_list(F.struct("before", "values")).alias("ends"))

    def at(r: Column) -> Column:
        b = F.get(F.filter(F.arrays_zip("ranks", "brackets"), lambda x: x["ranks"] == r), F.lit(0))["brackets"]
        values = F.get(F.filter("ends", lambda e: e["before"] == b["before"]), F.lit(0))["values"]
        found = F.when(F.size(values) == b["held"], F.get(values, (r - b["before"]).cast("int"))).otherwise(F.raise_error(F.lit("values changed between passes")))
        return F.when(b["lo"] < b["hi"], found).otherwise(b["lo"])

    def between(spot: Column) -> Column:
        a, b = at(F.floor(spot)), at(F.ceil(spot))
        return F.when(a == b, a).otherwise(a + (b - a) * (spot - F.floor(spot)))

    done = state.join(ends, keys, "left")
    return done.select(*keys, F.transform(spots, between).alias("q"), "n", "low", "high")


def _settled(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """One small row a group: written where there are groups, else (a row per listed column) kept in the plan."""
    if by:
        return materialise(state, "brackets")
    return state.sparkSession.createDataFrame(state.collect(), state.schema)


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float], stored: bool = False) -> DataFrame:
    """One row; column ``<col>_q`` holds the array of quantiles of each listed column."""
    q = exact_quantiles(df, cols, probs, stored=stored)
    return q.groupBy().agg(*[F.max(F.when(F.col("metric") == c, F.col("q"))).alias(f"{c}_q") for c in cols])


def quantile_scalars(df: DataFrame, cols: Sequence[str], probs: Sequence[float], stored: bool = False) -> Column:
    """The same as a scalar subquery: a struct column with one array field per listed column."""
    row = quantile_row(df, cols, probs, stored)
    return row.select(F.struct(*[F.col(f"{c}_q") for c in cols]).alias("s")).scalar()


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5, stored: bool = False) -> dict[str, tuple[Column, Column]]:
    """Lower and upper fence per column, both taken from the whole frame."""
    s = quantile_scalars(df, cols, [0.25, 0.75], stored)
    fences = {}
    for c in cols:
        q = s.getField(f"{c}_q")
        spread = (q[1] - q[0]) * F.lit(float(k))
        fences[c] = (q[0] - spread, q[1] + spread)
    return fences
