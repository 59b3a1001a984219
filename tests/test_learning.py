from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.sql import functions as F

from ledgerline.operators import corpus as K
from ledgerline.operators import evaluation as E
from ledgerline.operators import features as P
from ledgerline.operators import forecast as FC
from ledgerline.operators import models as M


@pytest.fixture(scope="module")
def judged():
    rng = np.random.default_rng(9)
    y = (rng.random(3000) < 0.2).astype(int)
    return pd.DataFrame({"y": y, "s": np.clip(np.round(0.3 * y + rng.random(3000) * 0.7, 2), 0, 1)})


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_auc_with_ties_and_monotone_scores(spark, judged):
    df = spark.createDataFrame(judged)
    a = E.ranking_quality(df, "y", "s").first()["roc_auc"]
    assert np.isclose(a, brute_auc(judged["y"].to_numpy(), judged["s"].to_numpy()))
    assert np.isclose(a, E.ranking_quality(df.withColumn("s", F.exp(F.col("s") * 5)), "y", "s").first()["roc_auc"])
    # Nearly all rows on one score: still exact.
    lump = judged.assign(s=judged["s"].where(judged.index % 10 == 0, 0.5))
    b = E.ranking_quality(spark.createDataFrame(lump), "y", "s").first()["roc_auc"]
    assert np.isclose(b, brute_auc(lump["y"].to_numpy(), lump["s"].to_numpy()))


def test_sweep_equals_brute_force(spark, judged):
    rows = E.threshold_sweep(spark.createDataFrame(judged), "y", "s", 0.05).orderBy("threshold").collect()
    assert len(rows) == 18
    for r in rows:
        called = judged["s"] >= r["threshold"]
        assert (r["tp"], r["fp"]) == ((called & (judged.y == 1)).sum(), (called & (judged.y == 0)).sum())


def test_best_threshold_falls_back(spark, judged):
    sweep = E.threshold_sweep(spark.createDataFrame(judged), "y", "s", 0.05)
    assert E.best_threshold(sweep, 2.0).first()["threshold"] == 0.5


def test_chi_square_and_t_by_hand(spark):
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 5
    got = E.chi_square(spark.createDataFrame(rows, "g string, v int"), "g", "v").first()
    obs = np.array([[10, 20], [30, 5]])
    exp = obs.sum(1, keepdims=True) * obs.sum(0) / obs.sum()
    assert np.isclose(got["statistic"], ((np.abs(obs - exp) - 0.5) ** 2 / exp).sum()) and got["dof"] == 1
    # An empty cell, a row without a category, and more than two levels.
    sparse = spark.createDataFrame([("a", 0)] * 4 + [("b", 1)] * 5 + [("c", 0), ("c", 1), ("c", None)], "g string, v int")
    obs = np.array([[4, 0], [0, 5], [1, 1]])
    exp = obs.sum(1, keepdims=True) * obs.sum(0) / obs.sum()
    got = E.chi_square(sparse, "g", "v").first()
    assert np.isclose(got["statistic"], ((obs - exp) ** 2 / exp).sum()) and got["dof"] == 2
    t = E.pooled_t(spark.createDataFrame([(0, 1.0), (0, 2.0), (0, 3.0), (1, 2.0), (1, 4.0), (1, 6.0)], "g int, x double"), "x", "g", 0, 1).first()
    assert np.isclose(t["t"], -2.0 / np.sqrt(2.5 * 2 / 3)) and t["dof"] == 4


# Upper-tail points from printed tables.
@pytest.mark.parametrize("x,dof,p", [(3.841, 1, 0.05), (5.991, 2, 0.05), (11.345, 3, 0.01), (18.307, 10, 0.05), (24.996, 15, 0.05)])
def test_chi_square_tail(x, dof, p):
    assert abs(E.chi_square_tail(x, dof) - p) < 2e-5


@pytest.mark.parametrize("t,dof,p", [(12.706, 1, 0.05), (4.303, 2, 0.05), (3.182, 3, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (1.9600, 10**7, 0.05)])
def test_student_tail(t, dof, p):
    assert abs(E.student_tail(-t, dof) - p) < 2e-5
    assert abs(E.student_tail(1.7, 5000) - E.student_tail(1.7, 5001)) < 1e-6


def test_class_report_handles_a_class_never_called(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "y int, p int")
    rows = {r["cls"]: r for r in E.class_report(df, "y", "p").collect()}
    assert rows["1"]["precision"] == 0 and rows["1"]["f1"] == 0
    assert np.isclose(rows["accuracy"]["f1"], 0.75) and np.isclose(rows["0"]["precision"], 2 / 3)


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    rows = P.standard_scale(df, ["a", "c"]).orderBy("a").collect()
    assert [(r["a"], r["c"]) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]
    stats = P.min_max_stats(df, ["a"])
    assert [r["a"] for r in P.min_max_inverse(P.min_max_scale(df, ["a"], stats), ["a"], stats).collect()] == [1.0, 3.0]


def test_encoding_and_alignment(spark):
    train = spark.createDataFrame([("x",), ("y",), ("z",)], "c string")
    known = P.levels(train, "c")
    new = spark.createDataFrame([("y",), ("q",)], "c string")
    hot = P.align(P.one_hot(new, "c", known), ["c_z", "c_y", "missing"])
    assert [tuple(r) for r in hot.collect()] == [(0, 1, 0), (0, 0, 0)]


def test_split_shares_are_exact_and_disjoint(spark):
    df = spark.range(1000).withColumn("s", (F.col("id") < 900).cast("int"))
    rows = P.stratified_split(df, "id", ["s"], {"train": 0.6, "valid": 0.2, "test": 0.2}).toPandas()
    assert rows["id"].is_unique
    sizes = rows.groupby(["s", "part"]).size()
    assert (sizes[1, "train"], sizes[1, "valid"], sizes[0, "test"]) == (540, 180, 20)


@pytest.mark.parametrize("block", [2000, 20])
def test_oversampling_fills_up_and_stays_between_neighbours(spark, block):
    rng = np.random.default_rng(10)
    few = rng.normal(size=(60, 4)).tolist()
    few += [few[0]] * 30  # a third of the minority are copies of one row
    rows = [(i, v, 1) for i, v in enumerate(few)] + [(1000 + i, rng.normal(size=4).tolist(), 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    made = P.oversample_interpolated(df, "id", "v", "y", 1, 0.7, block_rows=block).toPandas()
    assert len(made) == 280 - 90 and not made.duplicated(["origin", "copy"]).any()
    assert set(made["origin"]) == set(range(90))
    x = np.array(few)
    points = np.arange(60)  # the copies of row 0 are one point
    ranks = []
    for origin, near, v in zip(made["origin"], made["near"], made["v"], strict=True):
        line, step = x[near] - x[origin], np.array(v) - x[origin]
        u = step @ line / (line @ line)
        assert 0 < u < 1 and np.allclose(step, u * line) and not np.allclose(v, x[origin], atol=0, rtol=0)
        dist = ((x[points] - x[origin]) ** 2).sum(1)
        ranks.append((dist < dist[near] - 1e-9).sum())
    # The five nearest, whatever the blocks; the row itself comes before them.
    assert max(ranks) <= 5


def test_neighbours_of_many_points_equal_brute_force(spark):
    """20,000 points of 64 dimensions, half of them in ten clusters: distances and keys as by brute force."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(10, 64)) * 3
    x = np.round(np.concatenate([rng.normal(size=(10_000, 64)), centres[rng.integers(0, 10, 10_000)] + 0.3 * rng.normal(size=(10_000, 64))]), 3)
    x[7] = x[3] + 0.001
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id bigint, v array<double>").repartition(8)
    got = P.near_neighbours(df, "id", 5).select("id", F.transform("near", lambda s: s["near"]).alias("near"), F.transform("near", lambda s: s["dist"]).alias("dist")).toPandas()
    assert sorted(got["id"]) == list(range(len(x)))
    norms = (x * x).sum(1)
    for at in range(0, len(got), 500):
        ids = got["id"].to_numpy()[at : at + 500]
        d = norms[ids][:, None] + norms[None, :] - 2 * x[ids] @ x.T
        d[np.arange(len(ids)), ids] = np.inf
        close = np.argpartition(d, 12, axis=1)[:, :12]
        for i, c, near, dist in zip(ids, close, got["near"][at : at + 500], got["dist"][at : at + 500], strict=True):
            exact = np.round(((x[c] - x[i]) ** 2).sum(1), 9)
            order = np.lexsort((c, exact))[:5]
            assert list(near) == c[order].tolist()
            assert np.allclose(dist, exact[order], rtol=0, atol=2e-9)


def test_oversampling_without_neighbours_or_vectors(spark):
    schema = "id bigint, v array<double>, y int"
    rest = [(100 + i, [float(i)], 0) for i in range(20)]
    for few in ([], [(1, [1.0], 1)], [(i, [1.0], 1) for i in range(5)], [(1, None, 1)]):
        assert P.oversample_interpolated(spark.createDataFrame(few + rest, schema), "id", "v", "y", 1, 0.7).count() == 0


def test_linear_coefficients_equal_normal_equations(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=500) * 0.1
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y}))
    model = M.fit(M.linear("y", solver="normal"), df, ["a", "b", "c"]).stages[-1]
    beta, *_ = np.linalg.lstsq(np.column_stack([x, np.ones(500)]), y, rcond=None)
    assert np.allclose([*model.coefficients, model.intercept], beta)
    got = {r["feature"]: r["attribution"] for r in M.linear_attributions(df, dict(zip("abc", model.coefficients))).collect()}
    assert np.allclose([got[c] for c in "abc"], np.abs(beta[:3] * (x - x.mean(0))).mean(0))


def test_segments_repeat_with_the_seed(spark):
    rng = np.random.default_rng(12)
    pts = np.concatenate([rng.normal(c, 0.1, (50, 2)) for c in (0, 5, 10)])
    df = spark.createDataFrame(pd.DataFrame({"a": pts[:, 0], "b": pts[:, 1]}))
    _, one = M.segment(df, ["a", "b"], 3)
    _, two = M.segment(df, ["a", "b"], 3)
    assert one.toPandas().equals(two.toPandas()) and one.select("segment").distinct().count() == 3
    sweep = M.segment_sweep(df, ["a", "b"], [2, 3])
    assert sweep[1][1] < sweep[0][1] and sweep[1][2] > 0.9


def test_baseline_can_be_saved(spark, tmp_path):
    M.PreviousStep(inputCol="lag_1").write().overwrite().save(str(tmp_path / "m"))
    back = M.PreviousStep.load(str(tmp_path / "m"))
    assert back.transform(spark.createDataFrame([(2,)], "lag_1 int")).first()["prediction"] == 2.0


def test_scoring_refuses_missing_features(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "x double, y double")
    model = M.fit(M.linear("y"), df, ["x"])
    with pytest.raises(ValueError, match="missing feature"):
        M.score_batch(model, spark.createDataFrame([(None,)], "x double"), ["x"], ["x"])


def words_of(spark, texts):
    return spark.createDataFrame([(k, t.split()) for k, t in texts.items()], "k int, words array<string>")


def test_encoding_pads_and_keeps_the_tail(spark):
    rows = words_of(spark, {1: "a b a c zz", 2: "a", 3: "zz", 4: ""})
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "token string, rank int")
    got = {r["k"]: (r["ids"], r["n_known"]) for r in K.encode(rows, vocab, ["k"], 3).collect()}
    assert got == {1: ([2, 1, 3], 4), 2: ([1, 0, 0], 1), 3: ([0, 0, 0], 0), 4: ([0, 0, 0], 0)}
    assert sorted(tuple(r) for r in K.bag_of_words(rows, vocab, ["k"]).collect()) == [(1, 1, 2), (1, 2, 1), (1, 3, 1), (2, 1, 1)]


def test_documents_in_are_documents_out(spark):
    rows = words_of(spark, {1: "cats sit", 2: "", 3: "zz not_good good", 4: "bad"}).unionByName(spark.createDataFrame([(5, None)], "k int, words array<string>"))
    rows = K.word_rows(rows, ["k"], F.col("words"))
    lemmas = spark.createDataFrame([("cats", "cat")], "form string, lemma string")
    assert {r["k"]: r["lemmas"] for r in K.lookup_lemmas(rows, lemmas, ["k"]).collect()} == {1: "cat sit", 2: "", 3: "zz not_good good", 4: "bad", 5: ""}
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -1.0)], "token string, valence double")
    got = {r["k"]: (r["pos"], r["neg"], round(r["compound"], 6)) for r in K.lexicon_scores(rows, lexicon, ["k"], ["not"]).collect()}
    assert got == {1: (0, 0, 0), 2: (0, 0, 0), 3: (1 / 3, 1 / 3, 0), 4: (0, 1, -0.25), 5: (0, 0, 0)}
    vectors = spark.createDataFrame([("cats", [1.0, -2.0]), ("sit", [0.5, 3.0])], "token string, vector array<double>")
    assert {r["k"]: r["pooled"] for r in K.max_pool(rows, vectors, ["k"], 2).collect()} == {1: [1.0, 3.0], 2: None, 3: None, 4: None, 5: None}
    texts = spark.createDataFrame([(1, "One two. Two three! Four."), (2, ""), (3, None), (4, "  ")], "k int, text string")
    for how in ("map_reduce", "refine", "stuff"):
        summaries = {r["k"]: r["summary"] for r in K.summarise(texts, "k", "text", how).collect()}
        assert set(summaries) == {1, 2, 3, 4}
        assert [summaries[k] for k in (2, 3, 4)] == ["", "", ""]
    with pytest.raises(ValueError, match="more than 1 entries"):
        K.looked_up(rows, "words", lexicon, "v", most=1)


def test_refining_does_not_repeat_itself(spark):
    """The best sentence comes in two chunks: map-reduce takes it twice, refine takes what is new instead."""
    text = "Red fox runs. Blue. Red fox runs. Green owl. Red fox sleeps. Tail."
    df = spark.createDataFrame([(1, text)], "k int, text string")
    got = {how: K.summarise(df, "k", "text", how, chunk=2, per_chunk=2, n=2).first()["summary"] for how in ("map_reduce", "refine")}
    assert got == {"map_reduce": "Red fox runs. Red fox runs.", "refine": "Red fox runs. Blue."}


def test_no_exchange_carries_texts_or_words(spark, sf_dir):
    from ledgerline.plans import text as X

    for name in (X.t06, X.t09_bag, X.t11, X.t12_pool):
        plan = name(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        after = [line for line in plan.split("\n") if "Exchange" in line and "RoundRobin" not in line]  # one file is dealt to all cores first
        assert not after, plan


class Memory(Estimator):
    """Knows the labels of the rows it was fitted on, and answers -1 for any other."""

    def _fit(self, dataset):
        known = {r["id"]: r["y"] for r in dataset.select("id", "y").collect()}
        return Recall(known)


class Recall(Model):
    def __init__(self, known):
        super().__init__()
        self.known = known

    def _transform(self, dataset):
        answers = F.create_map(*[F.lit(x) for k, v in self.known.items() for x in (k, v)])
        return dataset.withColumn("prediction", F.coalesce(answers[F.col("id")], F.lit(-1.0)))


def test_a_memorising_learner_gains_nothing_out_of_fold(spark):
    df = spark.createDataFrame([(i, float(i % 7), i % 5) for i in range(60)], "id int, y double, fold int")
    got = M.out_of_fold(Memory, df, "fold", 5).collect()
    assert sorted(r["id"] for r in got) == list(range(60))
    assert {r["prediction"] for r in got} == {-1.0}
    assert {r["prediction"] for r in Memory().fit(df).transform(df).collect()} == set(map(float, range(7)))


def test_outliers_are_labelled_and_never_clustered(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.normal(10 * (i % 4), 1)), float(rng.normal(5 * (i % 2), 1)), 1.0) for i in range(200)] + [(900, 500.0, 2.0, 1.0), (901, 5.0, 900.0, 1.0), (902, 700.0, 900.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    M.segment_inliers(df, ["a", "b", "c"], ["a", "b"], 4).write().save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    new = spark.createDataFrame([(1, 1e9, 0.0, 1.0), (2, 0.0, 0.0, 1.0)], df.schema)
    got = {r["id"]: r["segment"] for r in model.transform(df).collect()}
    assert (got.pop(900), got.pop(901), got.pop(902)) == (-2, -1, -3)
    assert set(got.values()) == {0, 1, 2, 3}
    assert [r["segment"] < 0 for r in model.transform(new).orderBy("id").collect()] == [True, False]


def test_tuning_scores_and_choice(spark):
    """Scores of one series against a plain loop; two series draw their own points and the least score is refitted."""
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(500)]
    rng = np.random.default_rng(4)
    rows = [(k, d, float(20 + 3 * np.sin(2 * np.pi * i / 7) + i / 50 + rng.normal(0, 0.3))) for k in ("a", "b") for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "k string, d date, y double")
    scores, ahead = FC.tune(df, "k", "d", "y", 365, 30, 20, draws=4)
    got = scores.toPandas()
    near = FC.calendar_columns(df.where("k = 'a'"), "d").orderBy("d").toPandas()["near"].to_numpy(float)
    assert got.groupby("k").size().tolist() == [4, 4]
    y = np.array([r[2] for r in rows if r[0] == "a"])
    day, cuts = np.arange(500.0), list(range(499 - 20, 364, -30))
    for r in got[got["k"] == "a"].to_dict("records"):
        losses = []
        for cut in cuts:
            hold = np.arange(cut + 1, cut + 21)
            yhat = FC._ridge(day, near, y, cut, hold, r)
            losses.append(100 * np.mean(2 * np.abs(y[hold] - yhat) / (np.abs(y[hold]) + np.abs(yhat))))
        assert r["cutoffs"] == len(cuts)
        assert np.isclose(r["smape"], np.mean(losses))
    for k, part in got.groupby("k"):
        assert part.loc[part["chosen"], "smape"].tolist() == [part["smape"].min()]
        mine = ahead.where(F.col("k") == k).orderBy("d").toPandas()
        assert mine["d"].tolist() == [days[-1] + dt.timedelta(days=i) for i in range(1, 21)]
        assert set(mine["point"]) == set(part.loc[part["chosen"], "point"])
        assert np.abs(mine["yhat"] - (20 + 3 * np.sin(2 * np.pi * np.arange(500, 520) / 7) + np.arange(500, 520) / 50)).max() < 3


def test_classifier_scores_each_row_once(spark):
    from ledgerline.plans.models import class_row
    from pyspark.ml.functions import array_to_vector

    runs = spark.sparkContext.accumulator(0)

    class Model:
        def transform(self, df):
            def chance(x: float) -> float:
                runs.add(1)
                return x

            p = F.udf(chance, "double").asNondeterministic()("x")
            return df.withColumn("c", p).withColumn("probability", array_to_vector(F.array(1 - F.col("c"), "c"))).withColumn("prediction", (F.col("c") > 0.5).cast("double"))

    test = spark.createDataFrame([(i / 40, float(i % 2)) for i in range(40)], "x double, label double")
    row = class_row(Model(), test, "m").first()
    assert row.n == 40 and runs.value == 40


def test_stored_rows_in_pieces(spark):
    from ledgerline.tables import in_pieces

    rows = spark.range(1000).coalesce(1)
    cut = in_pieces(rows, 100, "id")
    assert cut.rdd.getNumPartitions() == 10 and sorted(r.id for r in cut.collect()) == list(range(1000))
    assert in_pieces(rows, 1000, "id").rdd.getNumPartitions() == 1


def test_bags_are_counted_in_pieces(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([["a"] * 3, None, ["b"] * 9, ["c"]])], names=["k", "words"])
    assert [p.num_rows for p in K.word_pieces(batch, 1, most=4)] == [2, 1, 1]
    rows = spark.createDataFrame([(k, ["a", "b", "z", "a"] * 70_000 if k == 1 else ["b"]) for k in range(4)], "k long, words array<string>").coalesce(1)
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, rank int")
    assert sorted(map(tuple, K.bag_of_words(rows, vocab, ["k"]).collect())) == [(0, 2, 1), (1, 1, 140_000), (1, 2, 70_000), (2, 2, 1), (3, 2, 1)]


def test_words_are_counted_before_the_join(spark, sf_dir):
    from ledgerline.plans.preparation import combined_frame

    plan = combined_frame(spark, sf_dir, 50)._jdf.queryExecution().optimizedPlan().toString()
    join = next(i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line)
    assert not any("tokens" in line for line in plan.splitlines()[:join])


def test_cleaner_works_in_small_pieces(spark, tmp_path, monkeypatch):
    from ledgerline.functions import text as X
    from ledgerline.plans import models

    texts = [None, "", "Go http://x.y Now!"] * 301
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.clean for r in models.ud02(spark, str(tmp_path)).collect()}
    none = "".join(c for c in X.NO_TEXT if c.isalpha())
    assert [got[i] for i in range(len(texts))] == [none, none, "go  now"] * 301


def test_sales_levels_hold_nulls_and_double_orders(spark, tmp_path):
    from ledgerline.plans.series import level_sums

    cells = [{"s": 1.0, "c": 1, "d": "x"}, {"s": None, "c": 2, "d": "x"}, {"s": None, "c": 1, "d": None}]
    row = spark.createDataFrame([(cells,)], "cells array<struct<s:double,c:bigint,d:string>>")
    got = {(r.dimension, r.level, r.s, r.c) for r in row.select(F.inline(level_sums("cells", "d"))).collect()}
    assert got == {("d", "x", 1.0, 3), ("d", None, None, 1)}


def test_number_of_batches_is_bounded(spark, tmp_path):
    from ledgerline.plans import streams

    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(600)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seen = []
        run = streams.J.drain_batches(streams.arriving(spark, str(tmp_path), 2), lambda batch, i: seen.append(batch.count()), "append")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert run.exception() is None and len(seen) <= streams.MOST_BATCHES and sum(seen) == 600


def test_linear_grid_equals_cross_validation_on_the_rows(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from ledgerline.tables import materialise

    rnd = np.random.default_rng(5)
    x = rnd.uniform(0, [50, 0.1, 1], (400, 3))
    rows = [(*map(float, r), float(900 * r[0] + 3000 * r[1] + 500 * rnd.normal())) for r in x]
    data = materialise(M.assemble(spark.createDataFrame(rows, "a double, b double, c double, y double"), ["a", "b", "c"]).select("features", "y"), "lines")
    lr = M.linear("y")
    points = ParamGridBuilder().addGrid(lr.regParam, [1.0, 100.0]).addGrid(lr.elasticNetParam, [0.0, 1.0]).build()
    want = CrossValidator(estimator=lr, estimatorParamMaps=points, evaluator=RegressionEvaluator(labelCol="y"), numFolds=3, seed=42).fit(data).avgMetrics
    got = M.linear_grid_cv(data, "y", [{k.name: v for k, v in p.items()} for p in points], 3)
    assert got == pytest.approx(want, rel=1e-6)
    with pytest.raises(ValueError, match="without y"):
        M.linear_grid_cv(data.withColumn("y", F.when(F.rand(1) < 0.9, F.col("y"))), "y", [{}], 3)
