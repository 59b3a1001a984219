"""Cleaning, validation and profiling of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import clip
from ledgerline.operators.quantiles import iqr_fences, quantile_scalars
from ledgerline.tables import materialise


def snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().replace(" ", "_").replace("-", "_").lower() for c in df.columns])


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast; what does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def null_profile(df: DataFrame) -> DataFrame:
    """(column, type, nulls, percent) from one pass over all columns."""
    kinds = dict(df.dtypes)
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(kinds[c]).alias("type"),
                F.col(f"`{c}`").alias("nulls"),
                F.try_divide(F.lit(100.0) * F.col(f"`{c}`"), F.col("_n")).alias("percent"),
            )
            for c in df.columns
        ]
    )
    return row.select(F.inline(cells))


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop the columns that hold no value at all. One pass; the answer is one small row."""
    known = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if known[c] > 0])


def impute(df: DataFrame, how: Mapping[str, object], stored: bool = False) -> DataFrame:
    """Fill nulls with ``"median"``, ``"mean"`` or a constant. Statistics join in as scalar subqueries."""
    medians = [c for c, h in how.items() if h == "median"]
    means = [c for c, h in how.items() if h == "mean"]
    fill: dict[str, Column] = {c: F.lit(h) for c, h in how.items() if h not in ("median", "mean")}
    if medians:
        q = quantile_scalars(df, medians, [0.5], stored)
        fill |= {c: q.getField(f"{c}_q")[0] for c in medians}
    if means:
        m = df.agg(F.struct(*[F.avg(c).alias(c) for c in means]).alias("s")).scalar()
        fill |= {c: m.getField(c) for c in means}
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in fill.items()})


def invalidate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Null out the values for which the rule (a condition of being wrong) holds."""
    return df.withColumns({c: F.when(~F.coalesce(bad, F.lit(False)), F.col(c)) for c, bad in rules.items()})


def valid_range(df: DataFrame, bounds: Mapping[str, tuple[object, object]]) -> DataFrame:
    for c, (lo, hi) in bounds.items():
        df = df.where(F.col(c).between(lo, hi))
    return df


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys repeat and how many rows are surplus."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per.agg(
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
        F.count("*").alias("distinct_keys"),
    )


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) for every rule, from one pass; a rule that is unknown counts as broken."""
    row = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    cells = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
    return row.select(F.inline(cells))


def require(df: DataFrame, columns: Sequence[str], rules: Mapping[str, Column] | None = None) -> DataFrame:
    """The frame itself, or an error naming missing columns or the rules that are broken."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if rules:
        broken = [r["rule"] for r in validate(df, rules).where(F.col("violations") > 0).collect()]  # one row per rule
        if broken:
            raise ValueError(f"broken rules: {broken}")
    return df


def clip_iqr(df: DataFrame, col: str, k: float = 1.5, stored: bool = False) -> DataFrame:
    lo, hi = iqr_fences(df, [col], k, stored)[col]
    return df.withColumn(col, clip(F.col(col), lo, hi))


def drop_iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, stored: bool = False) -> DataFrame:
    """Keep rows inside every column's fences; all fences come from the unfiltered frame."""
    for c, (lo, hi) in iqr_fences(df, cols, k, stored).items():
        df = df.where(F.col(c).between(lo, hi))
    return df


def label_iqr_outliers(df: DataFrame, a: str, b: str, k: float = 1.5, stored: bool = False) -> DataFrame:
    """``outlier``: -1 only b, -2 only a, -3 both, 0 neither."""
    fences = iqr_fences(df, [a, b], k, stored)
    out = {c: ~F.col(c).between(*fences[c]) for c in (a, b)}
    label = F.when(out[a] & out[b], -3).when(out[a], -2).when(out[b], -1).otherwise(0)
    return df.withColumn("outlier", label)


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each step, applied in order, and their share of the start: one pass."""
    passed = F.lit(True)
    sums = [F.count("*").alias("start")]
    for name, ok in steps.items():
        passed = passed & F.coalesce(ok, F.lit(False))
        sums.append(F.count_if(passed).alias(name))
    row = df.agg(*sums)
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"`{n}`").alias("rows"),
                     F.try_divide(F.col(f"`{n}`"), F.col("start")).alias("kept"))
            for i, n in enumerate(["start", *steps])
        ]
    )
    return row.select(F.inline(cells))


def unique_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) for every distinct value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct()


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """(bin, low, n, density) over equal bins; the top edge belongs to the last bin, empty bins are kept."""
    edges = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("t")).alias("e")).scalar()
    lo, hi = edges.getField("lo"), edges.getField("hi")
    place = F.least(F.floor((F.col(col) - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return axis.join(counts, "bin", "left").fillna({"n": 0}).select(
        "bin",
        (lo + F.col("bin") * (hi - lo) / bins).alias("low"),
        "n",
        (F.col("n") / edges.getField("t") / ((hi - lo) / bins)).alias("density"),
    )


def histogram_by(df: DataFrame, col: str, by: str, bins: int) -> DataFrame:
    """(by, bin, low, n, share) over equal bins of the whole column, the same for every class; empty bins are kept.

    ``share`` is of the class's rows. Rows without a value or a class are left out.
    """
    known = df.where(F.col(col).isNotNull() & F.col(by).isNotNull())
    edges = known.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).alias("e")).scalar()
    lo, hi = edges.getField("lo"), edges.getField("hi")
    at = F.coalesce(F.floor(F.try_divide(F.col(col) - lo, hi - lo) * bins), F.lit(0))  # one value only: the first bin
    place = F.least(at, F.lit(bins - 1)).cast("int")
    counts = known.groupBy(by, place.alias("bin")).agg(F.count("*").alias("n"))
    # One row a class: its counts as a map, unfolded over all bins.
    held = counts.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"), F.sum("n").alias("t"))
    every = held.select(by, "m", "t", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    n = F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0).cast("long"))
    return every.select(by, "bin", (lo + F.col("bin") * (hi - lo) / bins).alias("low"), n.alias("n"), (n / F.col("t")).alias("share"))


def drop_zscore(df: DataFrame, col: str, limit: float, by: Sequence[str]) -> DataFrame:
    """Drop rows more than ``limit`` population deviations from their group's mean; nulls stay out of both."""
    # Written first, so that the planner sees the true size of the group table.
    stats = materialise(df.groupBy(*by).agg(F.avg(col).alias("_m"), F.stddev_pop(col).alias("_s")), "zscore")
    z = F.try_divide(F.col(col) - F.col("_m"), F.col("_s"))
    return df.join(stats, list(by)).where(z.isNull() | (F.abs(z) <= limit)).drop("_m", "_s")
