"""Forecast errors, classifier metrics and tests, all as aggregates."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.calendar import is_holiday
from ledgerline.functions.scalars import flag
from ledgerline.operators.ordered import running_totals
from ledgerline.tables import materialise


# Hours counted as rush hours on working days.
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)


def time_parts(df: DataFrame, ts: str) -> DataFrame:
    hour, dow = F.hour(ts), F.weekday(ts)
    return df.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": dow,
            "is_weekend": flag(dow >= 5),
            "is_rush_hour": flag(hour.isin(*RUSH_HOURS) & (dow < 5)),
            "is_holiday": is_holiday(F.to_date(ts)),
        }
    )


def forecast_errors(grid: DataFrame, key: str, ts: str, col: str) -> DataFrame:
    predicted = F.lag(col, 1).over(W.partitionBy(key).orderBy(ts))
    table = (
        grid.withColumn("predicted", predicted)
        .where(F.col("predicted").isNotNull())
        .withColumn("actual", F.col(col))
        .withColumn("signed", F.col("actual") - F.col("predicted"))
        .withColumn("abs_error", F.abs("signed"))
    )
    return time_parts(table, ts).drop(col)


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = a - p
    both = F.abs(a) + F.abs(p)
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(a) * F.count(a))).alias("r2"),
        (F.lit(100.0) * F.avg(F.when(a != 0, F.abs(e / a)))).alias("mape"),
        (F.lit(100.0) * F.avg(F.when(both != 0, F.lit(2.0) * F.abs(e) / both))).alias("smape"),
    )


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(label, predicted).agg(F.count("*").alias("n"))


def binary_counts(df: DataFrame, label: Column, predicted: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count_if((label == 1) & (predicted == 1)).alias("tp"),
        F.count_if((label == 0) & (predicted == 1)).alias("fp"),
        F.count_if((label == 1) & (predicted == 0)).alias("fn"),
        F.count_if((label == 0) & (predicted == 0)).alias("tn"),
    )


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 per class from the confusion counts, plus macro and weighted rows."""
    cells = confusion(df, label, predicted)
    both = cells.select(
        F.inline(
            F.array(
                F.struct(F.col(label).cast("string").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"),
                         F.when(F.col(label) == F.col(predicted), F.col("n")).otherwise(F.lit(0)).alias("hit")),
                F.struct(F.col(predicted).cast("string").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"),
                         F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    per = both.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("called")), zero)
    recall = F.coalesce(F.try_divide(F.col("hit"), F.col("support")), zero)
    per = per.withColumn("precision", precision).withColumn("recall", recall)
    per = per.withColumn(
        "f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero)
    )
    scores = ["precision", "recall", "f1"]
    n = F.sum("support")
    means = per.agg(
        n.alias("support"),
        *[F.avg(s).alias(f"m_{s}") for s in scores],
        *[(F.sum(F.col(s) * F.col("support")) / n).alias(f"w_{s}") for s in scores],
        (F.sum("hit") / n).alias("acc"),
    )
    rows = means.select(
        F.inline(
            F.array(
                F.struct(F.lit("macro avg").alias("cls"), "support", *[F.col(f"m_{s}").alias(s) for s in scores]),
                F.struct(F.lit("weighted avg").alias("cls"), "support", *[F.col(f"w_{s}").alias(s) for s in scores]),
                F.struct(F.lit("accuracy").alias("cls"), "support", *[F.col("acc").alias(s) for s in scores]),
            )
        )
    )
    return per.select("cls", "support", *scores).unionByName(rows)


def score_curve(df: DataFrame, label: str, score: str, buckets: int = 200) -> DataFrame:
    """One row per distinct score: positives and negatives at it, below it, and in all."""
    counts = df.groupBy(F.col(score).alias("score")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) == 0).cast("long")).alias("neg")
    )
    return running_totals(counts, "score", ["pos", "neg"], buckets)


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    c = score_curve(df, label, score)
    tp = F.col("all_pos") - F.col("before_pos")
    fp = F.col("all_neg") - F.col("before_neg")
    return c.select(
        "score",
        F.try_divide(tp, F.col("all_pos")).alias("tpr"),
        F.try_divide(fp, F.col("all_neg")).alias("fpr"),
        F.try_divide(tp, tp + fp).alias("precision"),
        "pos",
        "all_pos",
    )


def ranking_quality(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC AUC by rank sums (ties count half) and average precision."""
    c = score_curve(df, label, score)
    pairs = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)
    tp = F.col("all_pos") - F.col("before_pos")
    fp = F.col("all_neg") - F.col("before_neg")
    return c.agg(
        F.try_divide(F.sum(pairs), F.max(F.col("all_pos") * F.col("all_neg").cast("double"))).alias("roc_auc"),
        F.sum(F.col("pos") / F.col("all_pos") * F.try_divide(tp, tp + fp)).alias("pr_auc"),
    )


def threshold_sweep(df: DataFrame, label: str, score: str, step: float, low: float = 0.1, high: float = 1.0) -> DataFrame:
    """Counts at every cut of a fixed grid from one histogram: no scores x cuts product."""
    n = int(round((high - low) / step))
    # How many cuts the score clears.
    cleared = sum((flag(F.col(score) >= F.lit(round(low + i * step, 6))) for i in range(n)), F.lit(0))
    hist = df.groupBy(cleared.alias("b")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("p"), F.sum((F.col(label) == 0).cast("long")).alias("q")
    )
    # At most n + 1 rows from here on.
    cuts = hist.where(F.col("b") > 0).select(F.explode(F.sequence(F.lit(1), F.col("b"))).alias("i"), "p", "q")
    at = cuts.groupBy("i").agg(F.sum("p").alias("tp"), F.sum("q").alias("fp"))
    axis = df.sparkSession.range(1, n + 1).select(F.col("id").cast("int").alias("i"))
    positives = hist.agg(F.sum("p").alias("t")).scalar()
    return axis.join(at, "i", "left").fillna({"tp": 0, "fp": 0}).select(
        F.round(F.lit(low) + (F.col("i") - 1) * F.lit(step), 6).alias("threshold"),
        "tp",
        "fp",
        F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.try_divide(F.col("tp"), positives).alias("recall"),
    )


def best_threshold(sweep: DataFrame, floor: float, default: float = 0.5) -> DataFrame:
    """The lowest cut with the best recall among those precise enough; the default when none is."""
    ok = F.when(F.col("precision") >= floor, F.struct("recall", (-F.col("threshold")).alias("t")))
    return sweep.agg(F.coalesce(-F.max(ok)["t"], F.lit(default)).alias("threshold"))


def chi_square(df: DataFrame, a: str, b: str, yates: bool = True) -> DataFrame:
    """Independence of two categories from their contingency counts; Yates correction on 2 x 2 tables.

    Rows without either category are left out. Empty cells are never made: each adds its expected count, and together
    that is what the expected counts of the other cells leave of the total. In a 2 x 2 table all gaps are equal, so the
    correction scales the whole sum.
    """
    # The facts are read once; everything after works on the written contingency counts.
    cells = materialise(df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count("*").alias("n")), "cells")
    rows = cells.groupBy(a).agg(F.sum("n").alias("rn"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("cn"))
    total = cells.agg(F.sum("n").alias("t")).scalar()
    expected = F.col("rn") * F.col("cn") / total
    gap = F.abs(F.col("n") - expected)
    sums = cells.join(rows, a).join(cols, b).agg(F.sum(gap * gap / expected).alias("s"), F.sum(expected).alias("seen"), F.max(gap).alias("g"))
    sized = sums.select("s", "seen", "g", total.alias("t"), rows.agg(F.count("*").alias("r")).scalar().alias("r"), cols.agg(F.count("*").alias("c")).scalar().alias("c"))
    plain = F.col("s") + F.col("t") - F.col("seen")
    shrink = F.coalesce(F.try_divide(F.col("g") - F.least(F.lit(0.5), F.col("g")), F.col("g")), F.lit(0.0))
    corrected = F.when(F.lit(yates) & (F.col("r") == 2) & (F.col("c") == 2), plain * shrink * shrink).otherwise(plain)
    return sized.select(corrected.alias("statistic"), ((F.col("r") - 1) * (F.col("c") - 1)).cast("int").alias("dof"))


def pooled_t(df: DataFrame, value: str, group: str, first, second) -> DataFrame:
    """Two-sample t statistic with pooled variance, from moments in one pass."""
    g = F.col(group)
    x = F.col(value).cast("double")

    def part(v):
        return F.when(g == v, x)

    m = df.agg(
        F.count(part(first)).alias("n1"), F.avg(part(first)).alias("m1"), F.var_samp(part(first)).alias("v1"),
        F.count(part(second)).alias("n2"), F.avg(part(second)).alias("m2"), F.var_samp(part(second)).alias("v2"),
    )
    dof = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / dof
    return m.select(
        "m1", "m2", dof.alias("dof"), ((F.col("m1") - F.col("m2")) / F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2")))).alias("t")
    )


def group_parity(df: DataFrame, label: str, predicted: str, group: str) -> DataFrame:
    """Positive rate and true-positive rate of a flag by group."""
    hit = F.count_if((F.col(label) == 1) & (F.col(predicted) == 1))
    return df.groupBy(group).agg(
        F.count("*").alias("n"), F.avg(predicted).alias("positive_rate"), F.try_divide(hit, F.count_if(F.col(label) == 1)).alias("tpr")
    )


def blend_by_regime(df: DataFrame, actual: str, first: str, second: str, regime: str) -> DataFrame:
    """Two forecasts weighted by 1 / MAE inside each regime, and the error of the blend."""
    gap = {c: F.avg(F.abs(F.col(actual) - F.col(c))) for c in (first, second)}
    weights = df.groupBy(regime).agg(gap[first].alias("_a"), gap[second].alias("_b"))
    # 1/a over (1/a + 1/b) is b over (a + b); one row per regime.
    weights = weights.select(regime, (F.col("_b") / (F.col("_a") + F.col("_b"))).alias("weight_1")).withColumn("weight_2", 1 - F.col("weight_1"))
    blend = F.col("weight_1") * F.col(first) + F.col("weight_2") * F.col(second)
    return df.join(weights, regime).groupBy(regime, "weight_1", "weight_2").agg(F.avg(F.abs(F.col(actual) - blend)).alias("mae"))


def rolling_origin(df: DataFrame, ts: str, initial: int, period: int, horizon: int) -> DataFrame:
    """(cutoff, part, row...) for cutoffs every ``period`` days back from the last possible one.

    Each row lists the cutoffs it takes part in; train is up to the cutoff, valid the ``horizon`` days after.
    """
    span = df.agg(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi")).alias("s")).scalar()
    last = F.date_sub(span.getField("hi"), horizon)
    room = F.floor(F.datediff(last, F.date_add(span.getField("lo"), initial)) / F.lit(period)).cast("int")
    first = F.date_sub(last, room * period)
    cutoffs = F.when(room >= 0, F.sequence(first, last, F.expr(f"interval {period} days")))
    rows = df.withColumn("cutoff", F.explode(cutoffs)).where(F.col(ts) <= F.date_add("cutoff", horizon))
    return rows.withColumn("part", F.when(F.col(ts) <= F.col("cutoff"), "train").otherwise("valid"))


def chi_square_tail(x: float, dof: int) -> float:
    """P(X >= x) of a chi-square variable: the regularised incomplete gamma function, scaled in logarithms."""
    a, half = dof / 2, x / 2
    if half <= 0:
        return 1.0
    scale = math.exp(a * math.log(half) - half - math.lgamma(a))
    if half < a + 1:  # the series of the lower part converges fast here
        term = total = 1 / a
        k = a
        while abs(term) > 1e-17 * total:
            k += 1
            term *= half / k
            total += term
        return max(0.0, 1 - scale * total)
    return scale * continued_fraction(lambda i: (1.0, half + 1 - a) if i == 0 else (-i * (i - a), half + 2 * i + 1 - a))


def student_tail(t: float, dof: int) -> float:
    """Two-sided P(|T| >= |t|): the regularised incomplete beta function at dof / (dof + t^2)."""
    a, b, x = dof / 2, 0.5, dof / (dof + t * t)
    if t == 0:
        return 1.0
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))

    def fraction(a: float, b: float, x: float) -> float:
        def term(i: int) -> tuple[float, float]:
            m = i // 2
            if i == 0:
                return 1.0, 1.0
            if i % 2 == 0:
                return m * (b - m) * x / ((a + i - 1) * (a + i)), 1.0
            return -(a + m) * (a + b + m) * x / ((a + i - 1) * (a + i)), 1.0

        return continued_fraction(term) / a

    # The fraction converges fast below the mean; above it the other tail is taken.
    return scale * fraction(a, b, x) if x < (a + 1) / (a + b + 2) else 1 - scale * fraction(b, a, 1 - x)


def continued_fraction(term: Callable[[int], tuple[float, float]]) -> float:
    """a0 / (b0 + a1 / (b1 + ...)) for (a, b) = term(i), evaluated front to back until it settles."""
    tiny = 1e-300
    value, top, bottom = tiny, tiny, 0.0
    for i in range(100_000):
        a, b = term(i)
        bottom = 1 / ((b + a * bottom) or tiny)
        top = (b + a / top) or tiny
        value *= top * bottom
        if abs(top * bottom - 1) < 1e-16:
            break
    return value


def with_p_value(test: DataFrame, statistic: str, tail: Callable[[float, int], float]) -> DataFrame:
    """Adds the p-value to a one-row test result."""

    @F.pandas_udf("double")
    def p(stat: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([tail(float(s), int(d)) for s, d in zip(stat, dof)])

    return test.withColumn("p_value", p(statistic, "dof"))
