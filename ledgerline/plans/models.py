"""Models M-01 .. M-15, M-19 .. M-21, M-29, M-30, M-34, M-35, scoring T-18, report Q-17, and the UDF surface."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions import text as X
from ledgerline.operators import evaluation as E
from ledgerline.operators import features as P
from ledgerline.operators import forecast as FC
from ledgerline.operators import models as M
from ledgerline.operators.ordered import hashed_position
from ledgerline.operators.relational import top_k
from ledgerline.operators.series import lags
from ledgerline.plans.aggregates import a28
from ledgerline.plans.cleaning import LABELLED
from ledgerline.plans.common import DAILY, GRID, brand_days, events_grid
from ledgerline.plans.preparation import RFM_COLS, combined_frame
from ledgerline.plans.series import GW, mart
from ledgerline.plans.text import norm_sql
from ledgerline.registry import query
from ledgerline.tables import fresh_path, in_pieces, materialise, table

MART_FEATURES = (
    "hour_of_day", "day_of_week", "is_weekend", "is_rush_hour", "is_holiday", "is_downtown", "temperature", "humidity", "rain",
    "lag_1", "lag_2", "lag_3", "lag_6", "lag_12", "lag_24", "rolling_mean_3h", "rolling_mean_24h",
)
CUT = "timestamp_ntz'2024-01-22'"


def split_mart(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of the mart, written once because learners read them many times."""
    rows = materialise(mart(spark, sf_dir), "mart")
    return rows.where(f"hr < {CUT}"), rows.where(f"hr >= {CUT}")


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("m01_previous_step", f"with {GRID} select hr, event_type, n, lag(n) {GW}::double as prediction from grid")
def m01(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = lags(events_grid(spark, sf_dir), "event_type", "hr", "n", [1])
    return M.PreviousStep(inputCol="lag_1", outputCol="prediction").transform(known).drop("lag_1")


LINE_FEATURES = ("l_quantity", "l_discount", "l_tax")


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_FEATURES, "l_extendedprice")


def key_split(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Four fifths by the hash of the key: no ranking needed where the share may vary a little."""
    side = F.substring(F.md5(F.col(key).cast("string")), 1, 2) < "cc"
    return df.where(side), df.where(~side)


@query(
    "m02_linear_one",
    "select round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept from lineitem",
)
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = M.fit(M.linear("l_extendedprice", solver="normal"), line_rows(spark, sf_dir), ["l_quantity"]).stages[-1]
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept")
    )


@query("m02_linear_coefficients")
def m02_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_rows(spark, sf_dir)
    model = M.fit(M.linear("l_extendedprice", solver="normal"), rows, LINE_FEATURES).stages[-1]
    return M.named_values(rows, [*LINE_FEATURES, "intercept"], [*model.coefficients, model.intercept], "coefficient")


@query("m03_regularised_grid")
def m03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge, lasso and elastic net: cross-validated RMSE of every (alpha, share of L1)."""
    train, _ = key_split(line_rows(spark, sf_dir), "l_orderkey")
    data = materialise(M.assemble(train, LINE_FEATURES).select("features", "l_extendedprice"), "lines")
    grid = [{"regParam": a, "elasticNetParam": share} for a in (0.1, 1.0, 10.0) for share in (0.0, 0.5, 1.0)]
    errors = M.linear_grid_cv(data, "l_extendedprice", grid, folds=10, seed=42)
    rows = [(p["regParam"], p["elasticNetParam"], e) for p, e in zip(grid, errors, strict=True)]
    return spark.createDataFrame(rows, "alpha double, l1_share double, cv_rmse double")


@query("m04_polynomial_regression")
def m04(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = key_split(line_rows(spark, sf_dir), "l_orderkey")
    kinds = {"plain": {"solver": "normal"}, "ridge": {"regParam": 1.0, "elasticNetParam": 0.0}, "lasso": {"regParam": 1.0, "elasticNetParam": 1.0}}
    return M.stack_rows([M.error_row(M.polynomial(M.linear("l_extendedprice", **kw), train, LINE_FEATURES), test, "l_extendedprice", kind=k) for k, kw in kinds.items()])


@query("m05_tree_depth_sweep")
def m05(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split_mart(spark, sf_dir)
    parts = []
    for depth in (2, 4, 6, 8, 12):
        model = M.fit(DecisionTreeRegressor(labelCol="target", maxDepth=depth, seed=42), train, MART_FEATURES)
        parts += [M.error_row(model, train, "target", depth=depth, part="train"), M.error_row(model, test, "target", depth=depth, part="test")]
    return M.stack_rows(parts)


@query("m06_random_forest")
def m06(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split_mart(spark, sf_dir)
    model = M.fit(RandomForestRegressor(labelCol="target", numTrees=20, maxDepth=6, seed=42), train, MART_FEATURES)
    return M.error_row(model, test, "target", model="forest")


def boosted(**params) -> GBTRegressor:
    return GBTRegressor(labelCol="target", lossType="absolute", seed=42, maxIter=params.pop("maxIter", 5), **params)


@query("m07_boosted_two_step")
def m07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learning rate first, then depth at the best rate; the last row is the final model's test error."""
    train, test = split_mart(spark, sf_dir)
    first = materialise(M.expanding_cv(boosted, [{"stepSize": s, "maxDepth": 4} for s in (0.05, 0.2)], train, "hr", MART_FEATURES, "target", 2), "runs")
    rate = M.best_point(first, ["stepSize"])["stepSize"]
    second = materialise(M.expanding_cv(boosted, [{"stepSize": rate, "maxDepth": d} for d in (3, 5)], train, "hr", MART_FEATURES, "target", 2), "runs")
    depth = M.best_point(second, ["maxDepth"])["maxDepth"]
    final = M.error_row(M.fit(boosted(stepSize=rate, maxDepth=depth, maxIter=20), train, MART_FEATURES), test, "target", stage="final", stepSize=rate, maxDepth=depth)
    runs = first.select(F.lit("rate").alias("stage"), "*").unionByName(second.select(F.lit("depth").alias("stage"), "*"))
    return runs.unionByName(final.select("stage", "stepSize", "maxDepth", F.col("mae").alias("cv_mae")))


def labelled_frame(spark: SparkSession, sf_dir: str, size: int = 5000) -> DataFrame:
    """doc_id, vector, both labels and a balancing weight, written once and read in pieces of about 2000 rows."""
    marks = table(spark, sf_dir, "labels")
    share = marks.agg((F.count_if(F.col("toxic") == 0) / F.count_if(F.col("toxic") == 1)).alias("w")).scalar()
    rows = combined_frame(spark, sf_dir, size, only=marks).join(marks, "doc_id").withColumns(
        {
            "label": F.col("toxic").cast("double"),
            "weight": F.when(F.col("toxic") == 1, share).otherwise(F.lit(1.0)),
            "holdout": F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) >= "c",
        }
    )
    return in_pieces(materialise(rows, "labelled"), 2000, "doc_id")


def class_row(model, test: DataFrame, name: str) -> DataFrame:
    # Written first: each use of a prediction in a later expression would run the model again.
    scored = materialise(M.probability(model.transform(test)).select("label", "prediction", "p"), "scored")
    c = E.binary_counts(scored, F.col("label"), F.col("prediction"))
    quality = E.ranking_quality(scored, "label", "p").select("roc_auc")
    return c.select(
        F.lit(name).alias("model"), (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.lit(quality.scalar()).alias("roc_auc"),
    )


def fit_on(spark: SparkSession, sf_dir: str, estimator, name: str) -> DataFrame:
    rows = labelled_frame(spark, sf_dir)
    model = estimator.fit(rows.where(~F.col("holdout")))
    return class_row(model, rows.where("holdout"), name)


@query("m08_logistic_weighted")
def m08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_on(spark, sf_dir, M.logistic("label", "weight", maxIter=30, regParam=0.01), "logistic")


@query("m09_forest_classifier")
def m09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_on(spark, sf_dir, RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=300, maxDepth=6, seed=42), "forest")


@query("m10_boosted_classifier")
def m10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops early when the error on the marked validation rows no longer falls."""
    rows = labelled_frame(spark, sf_dir)
    train = rows.where(~F.col("holdout")).withColumn("valid", F.substring(F.md5(F.col("doc_id").cast("string")), 2, 1) >= "d")
    gbt = GBTClassifier(labelCol="label", weightCol="weight", validationIndicatorCol="valid", maxIter=15, maxDepth=3, seed=42)
    return class_row(gbt.fit(train), rows.where("holdout"), "boosted")


@query("m11_feed_forward")
def m11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled_frame(spark, sf_dir)
    width = rows.select("features").first()["features"].size
    scale = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)  # fitted on the training rows only
    net = MultilayerPerceptronClassifier(featuresCol="scaled", labelCol="label", layers=[width, 20, 10, 2], maxIter=30, seed=42)
    return class_row(Pipeline(stages=[scale, net]).fit(rows.where(~F.col("holdout"))), rows.where("holdout"), "network")


@query("m12_per_source_classifier")
def m12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model per source, each fitted by the whole cluster; accuracy on the source's held-out rows."""
    sources = table(spark, sf_dir, "documents").select("doc_id", "source")
    rows = materialise(labelled_frame(spark, sf_dir).join(sources, "doc_id"), "by-source")
    parts = []
    for name in P.levels(rows, "source"):
        mine = rows.where(F.col("source") == name)
        model = M.logistic("label", maxIter=30, regParam=0.1).fit(mine.where(~F.col("holdout")))
        parts.append(model.transform(mine.where("holdout")).agg(F.count("*").alias("n"), F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy")).select(F.lit(name).alias("source"), "*"))
    return M.stack_rows(parts)


def beats_chance(row: DataFrame) -> DataFrame:
    return row.select("model", "n", (F.col("roc_auc") > 0.5).alias("beats_chance"))


HELD_OUT = "select '{model}' as model, count(*) as n, true as beats_chance from labels join documents using (doc_id) where substr(md5(doc_id::varchar), 1, 1) >= 'c'"


@query("m08_beats_chance", HELD_OUT.format(model="logistic"))
def m08_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return beats_chance(m08(spark, sf_dir))


@query("m09_beats_chance", HELD_OUT.format(model="forest"))
def m09_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return beats_chance(m09(spark, sf_dir))


@query("m10_beats_chance", HELD_OUT.format(model="boosted"))
def m10_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return beats_chance(m10(spark, sf_dir))


@query("m11_beats_chance", HELD_OUT.format(model="network"))
def m11_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return beats_chance(m11(spark, sf_dir))


# The invented targets hold next to no signal, so these bounds only say that a learner does not stray from the mean.
@query("m04_keeps_to_the_mean", "select unnest(['plain', 'ridge', 'lasso']) as kind, true as keeps")
def m04_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m04(spark, sf_dir).select("kind", (F.col("r2") > -0.2).alias("keeps"))


@query("m05_train_error_falls_with_depth", "select unnest([4, 6, 8, 12])::int as depth, true as fits_closer")
def m05_falls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deeper tree never fits its own training rows worse."""
    errors = m05(spark, sf_dir).where("part = 'train'").select("depth", "rmse")
    before = F.lag("rmse").over(W.orderBy("depth"))  # one row a depth
    return errors.withColumn("before", before).where("before is not null").select("depth", (F.col("rmse") <= F.col("before") + 1e-9).alias("fits_closer"))


@query("m06_keeps_to_the_mean", "select 'forest' as model, true as keeps")
def m06_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m06(spark, sf_dir).select("model", (F.col("r2") > -0.2).alias("keeps"))


@query("m19_stack_keeps_to_its_parts", "select true as keeps")
def m19_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stack's error on the test rows is at most a tenth above that of its worse part."""
    errors = m19(spark, sf_dir)
    worst, stack = (F.max(F.when(hit, F.col("rmse"))) for hit in (F.col("model") != "stacked", F.col("model") == "stacked"))
    return errors.agg((stack <= 1.1 * worst).alias("keeps"))


def scaled_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(P.standard_scale(a28(spark, sf_dir), RFM_COLS), "rfm-scaled")


@query("m13_kmeans")
def m13(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = M.segment(scaled_rfm(spark, sf_dir), RFM_COLS, 4)
    return rows.select("o_custkey", "segment", *RFM_COLS)


@query("m13_outlier_segments", f"with {LABELLED} select o_custkey, outlier, true as in_range from labelled")
def m13_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outliers first, clusters of the rest; the stored pipeline is loaded again and labels every customer."""
    customers, path = materialise(a28(spark, sf_dir), "rfm"), fresh_path(spark, "segments")
    M.segment_inliers(customers, RFM_COLS, ["frequency", "monetary"], 4).write().save(path)
    rows = PipelineModel.load(path).transform(customers)
    usual = F.col("segment").between(0, 3) & (F.col("outlier") == 0)
    return rows.select("o_custkey", "outlier", (usual | ((F.col("segment") == F.col("outlier")) & F.col("outlier").between(-3, -1))).alias("in_range"))


@query("m14_elbow_silhouette")
def m14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.segment_sweep(scaled_rfm(spark, sf_dir), RFM_COLS, range(2, 11))
    return spark.createDataFrame(rows, "k int, cost double, silhouette double")


@query("m15_random_search")
def m15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded draw of grid points, scored by AUC over three folds."""
    import random

    rows = labelled_frame(spark, sf_dir)
    lr = M.logistic("label", "weight", maxIter=10)
    every = ParamGridBuilder().addGrid(lr.regParam, [0.001, 0.01, 0.1, 1.0]).addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build()
    drawn = random.Random(42).sample(every, 5)
    cv = CrossValidator(estimator=lr, estimatorParamMaps=drawn, evaluator=BinaryClassificationEvaluator(labelCol="label"), numFolds=3, seed=42, parallelism=4).fit(rows)
    out = [(float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(m)) for p, m in zip(drawn, cv.avgMetrics)]
    return spark.createDataFrame(out, "alpha double, l1_share double, cv_auc double")


@query("m19_stacking")
def m19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold predictions of two learners feed a linear one; error of each on the test rows."""
    train, test = split_mart(spark, sf_dir)
    makers = {"tree": lambda: DecisionTreeRegressor(labelCol="target", maxDepth=5, seed=42), "line": lambda: M.linear("target", regParam=0.1)}
    folded = materialise(M.assemble(train, MART_FEATURES).withColumn("fold", F.pmod(F.xxhash64("hr"), F.lit(5)).cast("int")), "folded")
    oof = folded.select("hr", "event_type", "target")
    for name, make in makers.items():
        one = M.out_of_fold(make, folded, "fold", 5).select("hr", "event_type", F.col("prediction").alias(name))
        oof = oof.join(one, ["hr", "event_type"])
    meta = M.fit(M.linear("target"), materialise(oof, "oof"), list(makers))
    scored = test
    for name, make in makers.items():
        scored = M.fit(make(), train, MART_FEATURES).transform(scored).withColumnRenamed("prediction", name).drop("features")
    scored = meta.transform(scored).withColumnRenamed("prediction", "stacked")
    return M.stack_rows([E.regression_metrics(scored, "target", c).select(F.lit(c).alias("model"), "n", "mae", "rmse") for c in (*makers, "stacked")])


@query(
    "m17_out_of_fold",
    """with r as (select doc_id, toxic, row_number() over (partition by toxic order by md5(doc_id::varchar), doc_id) as pos from labels)
select ((pos - 1) % 5)::int as fold, count(*) as n, count(distinct doc_id) as ids, true as ranks_toxic_higher from r join documents using (doc_id) group by 1""",
)
def m17_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each labelled text scored once by a model that has not seen it; toxic texts score higher on average."""
    rows = labelled_frame(spark, sf_dir)
    folds = hashed_position(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", ["toxic"])
    folded = materialise(rows.join(folds.select("doc_id", ((F.col("pos") - 1) % 5).cast("int").alias("fold")), "doc_id"), "folded")
    scored = materialise(M.probability(M.out_of_fold(lambda: M.logistic("label", "weight", maxIter=20, regParam=0.05), folded, "fold", 5)).select("doc_id", "fold", "label", "p"), "scored")
    toxic, clean = (F.avg(F.when(F.col("label") == y, F.col("p"))) for y in (1, 0))
    higher = scored.agg((toxic > clean).alias("h")).scalar()
    return scored.groupBy("fold").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).withColumn("ranks_toxic_higher", higher)


@query("m20_recursive_forecast")
def m20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FC.recursive_forecast(brand_days(spark, sf_dir), "brand", "d", "sales", 30)


@query("m21_forecast")
def m21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FC.forecast(brand_days(spark, sf_dir), "brand", "d", "sales", 30)


@query("m21_forecast_validated")
def m21_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = FC.forecast(brand_days(spark, sf_dir), "brand", "d", "sales", 30, validate=True)
    inside = F.avg(F.col("actual").between(F.col("low"), F.col("high")).cast("int"))
    return E.regression_metrics(out, "actual", "yhat", ["brand"]).join(out.groupBy("brand").agg(inside.alias("coverage")), "brand")


@query("m22_backtest")
def m22_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FC.backtest(brand_days(spark, sf_dir), "brand", "d", "sales", 730, 30, 30)


CUTOFFS = f"""{DAILY}, span as (select max(d) as hi, min(d) as lo from cal), cuts as (select unnest(generate_series(0, 1000)) as i, span.* from span),
counted as (select count(*) as cutoffs from cuts where hi - (30 + 90 * i)::int >= lo + 730)"""


@query("m22_tuning", f"with {CUTOFFS} select brand, 10 as points, cutoffs * 10 as fits, true as best_is_least from (select distinct brand from daily), counted")
def m22_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten drawn parameter points per series, each back-tested at every cutoff; the best point is refitted."""
    scores, _ = tuned(spark, sf_dir)
    least = F.min_by("chosen", F.struct("smape", "point"))
    return scores.groupBy("brand").agg(F.count("*").cast("int").alias("points"), F.sum("cutoffs").alias("fits"), (least & (F.count_if("chosen") == 1)).alias("best_is_least"))


@query("m22_tuned_forecast")
def m22_tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuned(spark, sf_dir)[1]


def tuned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return FC.tune(brand_days(spark, sf_dir), "brand", "d", "sales", 730, 90, 30)


@query("m29_feature_importance")
def m29(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = split_mart(spark, sf_dir)
    model = M.fit(boosted(maxDepth=4), train, MART_FEATURES).stages[-1]
    named = M.named_values(train, MART_FEATURES, model.featureImportances.toArray(), "importance")
    return top_k(named, 10, [F.col("importance").desc()], ["feature"])


@query("m30_linear_attributions")
def m30(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_rows(spark, sf_dir)
    model = M.fit(M.linear("l_extendedprice", solver="normal"), rows, LINE_FEATURES).stages[-1]
    return M.linear_attributions(rows, dict(zip(LINE_FEATURES, model.coefficients)))


@query("m34_unit_root")
def m34(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FC.unit_root(brand_days(spark, sf_dir), "brand", "d", "sales")


@query("m35_batch_scoring")
def m35(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save a fitted model, load it, refuse rows with missing features, score, round, write, read back."""
    train, test = split_mart(spark, sf_dir)
    path = fresh_path(spark, "model")
    M.fit(M.linear("target", regParam=0.1), train, MART_FEATURES).write().save(path)
    return M.score_batch(PipelineModel.load(path), test, MART_FEATURES, ["hr", "event_type"])


@query("t18_scored_text")
def t18(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled_frame(spark, sf_dir)
    model = M.logistic("label", "weight", maxIter=20, regParam=0.05).fit(rows)
    every = M.probability(model.transform(combined_frame(spark, sf_dir, 5000, carry=["text"])))
    threshold = 0.6
    return every.select(
        "doc_id", "text", F.when(F.col("p") >= threshold, "positive").otherwise("negative").alias("sentiment"),
        F.round("p", 6).alias("probability_positive"), F.lit(threshold).alias("threshold"),
    )


@query("q17_training_report")
def q17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three classifiers on the same split, with recall, precision and AUC of each."""
    rows = labelled_frame(spark, sf_dir)
    train, test = rows.where(~F.col("holdout")), rows.where("holdout")
    makers = {
        "logistic": M.logistic("label", "weight", maxIter=20, regParam=0.01),
        "forest": RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=10, maxDepth=5, seed=42),
        "boosted": GBTClassifier(labelCol="label", weightCol="weight", maxIter=8, maxDepth=3, seed=42),
    }
    return M.stack_rows([class_row(e.fit(train), test, name) for name, e in makers.items()])


# ---- UDF surface ---------------------------------------------------------------------------------


@query("ud01_builtin_apply", "select doc_id, length(trim(text))::int as size from documents")
def ud01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.length(F.trim("text")).alias("size"))


@query("ud02_user_cleaner", f"select doc_id, {norm_sql('text')} as clean from documents")
def ud02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own pandas cleaner, sent in Arrow batches; the built-in one is ``normalize_text``."""

    def bare(texts: pd.Series) -> pd.Series:
        known = texts.replace("", X.NO_TEXT).fillna(X.NO_TEXT).str.replace(r"http\S+|www\S+|[\U0001F600-\U0001F64F]", "", regex=True)
        return known.str.lower().str.replace(r"[^a-z \t\n\r\f\v]", "", regex=True)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Every step copies its texts, so a batch is cleaned in small pieces.
        for texts in batches:
            for at in range(0, len(texts), 200):
                yield bare(texts.iloc[at : at + 200])

    return table(spark, sf_dir, "documents").select("doc_id", clean("text").alias("clean"))


@query(
    "ud03_user_aggregate",
    """with g as (select brand, sales, d from (with """ + DAILY + """ select * from daily)) select brand, round(max(sales) - min(sales), 2) as sales_range from g group by 1""",
)
def ud03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own aggregate over one series (a day per row, so its size is the calendar's)."""

    @F.pandas_udf("double")
    def spread(values: pd.Series) -> float:
        return float(values.max() - values.min())

    return brand_days(spark, sf_dir).groupBy("brand").agg(spread("sales").alias("r")).select("brand", F.round("r", 2).alias("sales_range"))


@query("ud04_group_metric", "select event_type, round(avg(abs(value - 10)), 6) as mean_gap from events group by 1")
def ud04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.avg(F.abs(F.col("value") - 10)), 6).alias("mean_gap"))


@query("ud07_table_function", "select doc_id, i::int as piece, substr(source, i + 1, 2) as body from (select doc_id, source, unnest(range(0, length(source), 2)) as i from documents)")
def ud07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own row-to-rows function through a lateral join."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="piece int, body string", useArrow=True)
    class Pieces:
        def eval(self, text: str):
            for i in range(0, len(text), 2):
                yield i, text[i : i + 2]

    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.lateralJoin(Pieces(F.col("source").outer())).select("doc_id", "piece", "body")


@query("ud05_per_series_model")
def ud05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model function per series through ``applyInPandas``; the group is a day per row."""
    return FC.forecast(brand_days(spark, sf_dir), "brand", "d", "sales", 7, level=0.9)


@query("ud06_custom_transformer", f"with {GRID} select hr, event_type, n, lag(n, 24) {GW}::double as prediction from grid")
def ud06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persistable transformer as a seasonal baseline: the value a day ago."""
    known = lags(events_grid(spark, sf_dir), "event_type", "hr", "n", [24])
    return M.PreviousStep(inputCol="lag_24").transform(known).drop("lag_24")
