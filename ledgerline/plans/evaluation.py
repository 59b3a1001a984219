"""Validation and evaluation: M-16, M-18, M-22 .. M-28, M-31 .. M-33, M-36."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import flag
from ledgerline.operators import evaluation as E
from ledgerline.operators.relational import attach
from ledgerline.operators.series import expanding_folds, lags
from ledgerline.plans.common import DAILY, ERRORS, GRID, baseline_errors, brand_days, events_grid
from ledgerline.plans.series import GW, METRIC_COLS, METRICS_SQL
from ledgerline.registry import query
from ledgerline.tables import table

# A score with ties that leans towards the label, made from the key's hash.
SCORED = """scored as (select l.doc_id, toxic as label, quality, source, ((('0x' || substr(md5(l.doc_id::varchar), 1, 3))::int % 100) // 2 + 30 * toxic)::double / 100 as score
  from labels l join documents d on d.doc_id = l.doc_id)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    h = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 3), 16, 10).cast("int") % 100
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "doc_id", F.col("toxic").alias("label"), "quality", "source", ((F.floor(h / 2) + 30 * F.col("toxic")) / 100).alias("score")
    )


@query(
    "m16_expanding_folds",
    f"""with {GRID}, t as (select hr, row_number() over (order by hr) - 1 as i, count(*) over () as n from (select distinct hr from grid)),
b as (select hr, case when i < n - 5 * (n // 6) then 0 else (i - (n - 5 * (n // 6))) // (n // 6) + 1 end as b from t)
select f::int as fold, case when b = f then 'valid' else 'train' end as part, count(*) as n, min(hr) as first, max(hr) as last from grid join b using (hr) cross join range(1, 6) r(f) where b <= f group by all""",
)
def m16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expanding_folds(events_grid(spark, sf_dir), "hr", 5).groupBy("fold", "part").agg(F.count("*").alias("n"), F.min("hr").alias("first"), F.max("hr").alias("last"))


@query(
    "m18_weighted_average",
    f"""with {GRID}, l as (select hr, n, lag(n, 1) {GW} as p1, lag(n, 24) {GW} as p2, (hour(hr) = 0) as at_midnight from grid), e as (select * from l where p2 is not null),
w as (select at_midnight, avg(abs(n - p1)) as m1, avg(abs(n - p2)) as m2 from e group by 1), x as (select at_midnight, (1 / m1) / (1 / m1 + 1 / m2) as w1 from w)
select at_midnight, round(any_value(w1), 6) as weight_1, round(1 - any_value(w1), 6) as weight_2, round(avg(abs(n - (w1 * p1 + (1 - w1) * p2))), 6) as mae from e join x using (at_midnight) group by 1""",
)
def m18(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = lags(events_grid(spark, sf_dir), "event_type", "hr", "n", [1, 24]).where(F.col("lag_24").isNotNull()).withColumn("at_midnight", F.hour("hr") == 0)
    return E.blend_by_regime(both, "n", "lag_1", "lag_24", "at_midnight").select("at_midnight", *[F.round(c, 6).alias(c) for c in ("weight_1", "weight_2", "mae")])


@query(
    "m22_rolling_origin_folds",
    f"""with {DAILY}, s as (select min(d) as lo, max(d) as hi from daily), c as (select unnest(generate_series(0, (hi - 30 - (lo + 730)) // 30)) as k, lo, hi from s), cut as (select k, (hi - 30 - (30 * k)::int)::date as cutoff from c)
select cutoff, brand, count(*) filter (d <= cutoff) as n_train, count(*) filter (d > cutoff and d <= cutoff + 30) as n_valid, round(sum(sales) filter (d > cutoff and d <= cutoff + 30), 2) as actual
from daily cross join cut group by all""",
)
def m22(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = E.rolling_origin(brand_days(spark, sf_dir), "d", 730, 30, 30)
    return folds.groupBy("cutoff", "brand").agg(
        F.count_if(F.col("part") == "train").alias("n_train"), F.count_if(F.col("part") == "valid").alias("n_valid"),
        F.round(F.sum(F.when(F.col("part") == "valid", F.col("sales"))), 2).alias("actual"),
    )


@query("m23_regression_metrics", f"with {ERRORS}, s as (select actual as a, predicted as p from err) select {METRICS_SQL} from s")
def m23(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = E.regression_metrics(baseline_errors(spark, sf_dir), "actual", "predicted")
    return m.select("n", *[F.round(c, 6).alias(c) for c in METRIC_COLS])


@query(
    "m24_class_report",
    f"""with {SCORED}, p as (select label, (score >= 0.5)::int as pred from scored), k as (select unnest([0, 1]) as cls),
c as (select cls, count(*) filter (label = cls) as support, count(*) filter (pred = cls) as called, count(*) filter (label = cls and pred = cls) as hit from p, k group by 1),
m as (select cls, support, hit, coalesce(hit / nullif(called, 0), 0) as pr, coalesce(hit / nullif(support, 0), 0) as re from c), f as (select *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) as f1 from m)
select cls::varchar as cls, support, round(pr, 6) as precision, round(re, 6) as recall, round(f1, 6) as f1 from f
union all select 'macro avg', sum(support)::bigint, round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6) from f
union all select 'weighted avg', sum(support)::bigint, round(sum(pr * support) / sum(support), 6), round(sum(re * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6) from f
union all select 'accuracy', sum(support)::bigint, round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6) from f""",
)
def m24(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = scored(spark, sf_dir).withColumn("pred", flag(F.col("score") >= 0.5))
    return E.class_report(p, "label", "pred").select("cls", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("m25_confusion", f"with {SCORED} select label, (score >= 0.5)::int as pred, count(*) as n from scored group by all")
def m25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confusion(scored(spark, sf_dir).withColumn("pred", flag(F.col("score") >= 0.5)), "label", "pred")


CURVE = f"""{SCORED}, g as (select score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg from scored group by 1),
cv as (select *, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp, sum(pos) over () as ap, sum(neg) over () as an from g)"""


@query("m26_roc_points", f"with {CURVE} select score, round(tp / ap, 6) as tpr, round(fp / an, 6) as fpr, round(tp / (tp + fp), 6) as precision from cv")
def m26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.roc_points(scored(spark, sf_dir), "label", "score").select("score", *[F.round(c, 6).alias(c) for c in ("tpr", "fpr", "precision")])


@query(
    "m26_auc",
    f"with {CURVE} select round(sum(pos * (an - fp + neg / 2)) / max(ap * an), 6) as roc_auc, round(sum(pos / ap * tp / (tp + fp)), 6) as pr_auc from cv",
)
def m26_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ranking_quality(scored(spark, sf_dir), "label", "score").select(F.round("roc_auc", 6).alias("roc_auc"), F.round("pr_auc", 6).alias("pr_auc"))


# Three classes with one score each, from the hash of the key.
THREE = """three as (select doc_id, (n_chars % 3)::int as cls, """ + ", ".join(
    f"(('0x' || substr(md5(doc_id::varchar), {3 * k + 1}, 3))::int % 200)::double / 200 + (case when n_chars % 3 = {k} then 0.2 else 0 end)::double as s{k}" for k in range(3)
) + " from documents)"


@query(
    "m26_one_vs_rest_auc",
    f"with {THREE} " + " union all ".join(
        f"""select {k} as cls, round(sum(pos * (before_neg + neg / 2)) / (max(ap) * max(an)), 6) as auc from (select pos, neg, sum(neg) over (order by s) - neg as before_neg, sum(pos) over () as ap, sum(neg) over () as an
  from (select s{k} as s, count(*) filter (cls = {k}) as pos, count(*) filter (cls <> {k}) as neg from three group by 1))"""
        for k in range(3)
    ),
)
def m26_ovr(spark: SparkSession, sf_dir: str) -> DataFrame:
    cls = (F.col("n_chars") % 3).cast("int")
    parts = [
        (F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 3 * k + 1, 3), 16, 10).cast("int") % 200).cast("double") / 200
        + F.when(cls == k, F.lit(0.2)).otherwise(F.lit(0.0))
        for k in range(3)
    ]
    three = table(spark, sf_dir, "documents").select(cls.alias("cls"), *[s.alias(f"s{k}") for k, s in enumerate(parts)])
    out = None
    for k in range(3):
        one = E.ranking_quality(three.select((F.col("cls") == k).cast("int").alias("label"), F.col(f"s{k}").alias("score")), "label", "score")
        row = one.select(F.lit(k).alias("cls"), F.round("roc_auc", 6).alias("auc"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "m27_threshold_sweep",
    f"""with {SCORED}, t as (select round(0.1 + i * 0.05, 6)::double as threshold from range(18) r(i))
select threshold, count(*) filter (label = 1 and score >= threshold) as tp, count(*) filter (label = 0 and score >= threshold) as fp,
  round(coalesce(count(*) filter (label = 1 and score >= threshold) / nullif(count(*) filter (score >= threshold), 0), 0), 6) as precision,
  round(count(*) filter (label = 1 and score >= threshold) / count(*) filter (label = 1), 6) as recall from scored cross join t group by 1""",
)
def m27(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = E.threshold_sweep(scored(spark, sf_dir), "label", "score", 0.05)
    return s.select("threshold", "tp", "fp", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query(
    "m27_best_threshold",
    f"""with {SCORED}, t as (select round(0.1 + i * 0.05, 6)::double as threshold from range(18) r(i)),
s as (select threshold, count(*) filter (label = 1 and score >= threshold) / nullif(count(*) filter (score >= threshold), 0) as p, count(*) filter (label = 1 and score >= threshold) / count(*) filter (label = 1) as r from scored cross join t group by 1)
select coalesce((select threshold from s where p >= 0.95 order by r desc, threshold limit 1), 0.5)::double as threshold""",
)
def m27_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.best_threshold(E.threshold_sweep(scored(spark, sf_dir), "label", "score", 0.05), 0.95)


ACTIVE = """act as (select c_custkey, c_mktsegment, (c_acctbal > 5000)::int as pred, (c_custkey in (select o_custkey from orders where o_orderdate >= timestamp '2001-01-01'))::int as label from customer)"""


@query(
    "m28_group_parity",
    f"with {ACTIVE} select c_mktsegment, count(*) as n, round(avg(pred), 6) as positive_rate, round(count(*) filter (pred = 1 and label = 1) / nullif(count(*) filter (label = 1), 0), 6) as tpr from act group by 1",
)
def m28(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = table(spark, sf_dir, "orders").where("o_orderdate >= timestamp_ntz'2001-01-01'").groupBy("o_custkey").agg(F.lit(1).alias("label"))
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", flag(F.col("c_acctbal") > 5000).alias("pred"))
    judged = attach(people, recent, "c_custkey", "o_custkey", ["label"]).fillna({"label": 0})
    return E.group_parity(judged, "label", "pred", "c_mktsegment").select("c_mktsegment", "n", F.round("positive_rate", 6).alias("positive_rate"), F.round("tpr", 6).alias("tpr"))


@query("m31_large_residuals", f"with {ERRORS} select hr, event_type, actual, predicted, signed as residual from err where abs_error > 3")
def m31(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_errors(spark, sf_dir).where(F.col("abs_error") > 3).select("hr", "event_type", "actual", "predicted", F.col("signed").alias("residual"))


@query("m31_residuals_by_hour", f"with {ERRORS} select hour_of_day, round(avg(signed), 6) as mean_residual, round(stddev_samp(signed), 6) as std_residual, count(*) as n from err group by 1")
def m31_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_errors(spark, sf_dir).groupBy("hour_of_day").agg(F.round(F.avg("signed"), 6).alias("mean_residual"), F.round(F.stddev_samp("signed"), 6).alias("std_residual"), F.count("*").alias("n"))


def chi_sql(a: str, b: str, t: str, yates: bool) -> str:
    gap = "abs(n - e) - least(0.5, abs(n - e))" if yates else "abs(n - e)"
    return f"""with r as (select {a}, count(*) as rn from {t} group by 1), c as (select {b}, count(*) as cn from {t} group by 1), k as (select {a}, {b}, count(*) as n from {t} group by 1, 2),
x as (select coalesce(n, 0) as n, rn * cn / (select count(*) from {t}) as e from r cross join c left join k using ({a}, {b}))
select round(sum(({gap}) * ({gap}) / e), 6) as statistic, ((select count(*) from r) - 1)::int * ((select count(*) from c) - 1)::int as dof from x"""


@query("m32_chi_square", chi_sql("quality", "toxic", "labels", True))
def m32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.chi_square(table(spark, sf_dir, "labels"), "quality", "toxic").withColumn("statistic", F.round("statistic", 6))


@query("m32_chi_square_wide", chi_sql("o_orderstatus", "o_orderpriority", "orders", False))
def m32_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.chi_square(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority").withColumn("statistic", F.round("statistic", 6))


# The tail of an even dof is a finite sum, so the SQL needs no special function.
EVEN_TAIL = "exp(-statistic / 2) * list_sum(list_transform(range(0, (dof / 2)::bigint), lambda i: pow(statistic / 2, i) / factorial(i::int)::double))"


@query("m32_chi_square_test", f"select statistic, dof, round({EVEN_TAIL}, 6) as p_value from ({chi_sql('o_orderstatus', 'o_orderpriority', 'orders', False)})")
def m32_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = E.with_p_value(E.chi_square(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority"), "statistic", E.chi_square_tail)
    return test.select(F.round("statistic", 6).alias("statistic"), "dof", F.round("p_value", 6).alias("p_value"))


@query("m33_t_test")
def m33_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    return E.with_p_value(E.pooled_t(sized, "n_chars", "quality", 0, 1), "t", E.student_tail)


@query(
    "m33_pooled_t",
    """with s as (select count(*) filter (quality = 0) as n1, avg(n_chars) filter (quality = 0) as m1, var_samp(n_chars) filter (quality = 0) as v1, count(*) filter (quality = 1) as n2,
  avg(n_chars) filter (quality = 1) as m2, var_samp(n_chars) filter (quality = 1) as v2 from labels join documents using (doc_id))
select round(m1, 6) as m1, round(m2, 6) as m2, n1 + n2 - 2 as dof, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)), 6) as t from s""",
)
def m33(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    t = E.pooled_t(sized, "n_chars", "quality", 0, 1)
    return t.select(F.round("m1", 6).alias("m1"), F.round("m2", 6).alias("m2"), "dof", F.round("t", 6).alias("t"))


@query(
    "m36_compare_flags",
    f"with {SCORED} select (score >= 0.5)::int as model_a, (score >= 0.6 or quality = 0)::int as model_b, count(*) as n, round(count(*) / (select count(*) from scored), 6) as share from scored group by all",
)
def m36(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir).withColumns({"model_a": flag(F.col("score") >= 0.5), "model_b": flag((F.col("score") >= 0.6) | (F.col("quality") == 0))})
    total = s.agg(F.count("*").alias("t")).scalar()
    return s.groupBy("model_a", "model_b").agg(F.count("*").alias("n")).withColumn("share", F.round(F.col("n") / total, 6))
