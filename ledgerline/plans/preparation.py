"""Feature preparation P-01 .. P-11 (the marts P-12 and P-13 sit with the series)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import text as X
from ledgerline.operators import corpus as K
from ledgerline.operators import features as P
from ledgerline.operators.ordered import hashed_position
from ledgerline.plans.aggregates import RFM_SQL, a28
from ledgerline.plans.common import GRID, events_grid
from ledgerline.plans.text import DOC_TOKENS, VOCAB, docs
from ledgerline.registry import query
from ledgerline.tables import place, spread, table

RFM_COLS = ("recency", "frequency", "monetary")


@query("p01_standard_scale", f"with {RFM_SQL} select o_custkey, " + ", ".join(f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) + 0.0 as {c}" for c in RFM_COLS) + " from rfm")
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.standard_scale(a28(spark, sf_dir), RFM_COLS).select("o_custkey", *[(F.round(c, 6) + 0.0).alias(c) for c in RFM_COLS])


@query(
    "p02_min_max_scale",
    f"with {GRID}, m as (select min(n) as lo, max(n) as hi from grid) select hr, event_type, round((n - lo) / (hi - lo), 6) as n, n::double as back from grid, m",
)
def p02(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = events_grid(spark, sf_dir)
    stats = P.min_max_stats(grid, ["n"])
    scaled = P.min_max_scale(grid, ["n"], stats).withColumn("scaled", F.col("n"))
    back = P.min_max_inverse(scaled, ["n"], stats)
    return back.select("hr", "event_type", F.round("scaled", 6).alias("n"), F.round("n", 6).alias("back"))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def hot_sql(levels) -> str:
    return ", ".join(f"(c_mktsegment = '{s}')::int as \"c_mktsegment_{s}\"" for s in levels)


@query("p03_one_hot", f"select c_custkey, {hot_sql(SEGMENTS)} from customer")
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return P.one_hot(c, "c_mktsegment", P.levels(c, "c_mktsegment")).drop("c_mktsegment")


@query("p03_one_hot_drop_first", f"select c_custkey, {hot_sql(SEGMENTS[1:])} from customer")
def p03_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return P.one_hot(c, "c_mktsegment", P.levels(c, "c_mktsegment"), drop_first=True).drop("c_mktsegment")


@query("p04_label_encode", "select c_custkey, c_mktsegment, (dense_rank() over (order by c_mktsegment) - 1)::int as code from customer")
def p04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.label_encode(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "code")


@query("p05_align_columns", "select c_acctbal, 0 as c_mktsegment_AEROSPACE, (c_mktsegment = 'BUILDING')::int as \"c_mktsegment_BUILDING\", c_custkey from customer")
def p05(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    hot = P.one_hot(c, "c_mktsegment", P.levels(c, "c_mktsegment"))
    return P.align(hot, ["c_acctbal", "c_mktsegment_AEROSPACE", "c_mktsegment_BUILDING", "c_custkey"])


POLY = ("l_quantity", "l_discount", "l_tax")


@query(
    "p06_polynomial",
    "select l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"round({a} * {b}, 6) as {a}_x_{b}" for i, a in enumerate(POLY) for b in POLY[i:]) + " from lineitem",
)
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = [f"{a}_x_{b}" for i, a in enumerate(POLY) for b in POLY[i:]]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *POLY)
    return P.polynomial2(lines, POLY).select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(c, 6).alias(c) for c in made])


def combined_frame(spark: SparkSession, sf_dir: str, size: int = 5000, only: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id and one vector: numbers, language flags, embedding, word counts.

    ``only``: rows with a doc_id of this frame, picked before any vector is built; the vocabulary is that of all texts.
    ``carry``: columns of the documents that go along, so that nobody has to join them back.
    """
    tokens = X.token_table(docs(spark, sf_dir), ["doc_id"], "text")
    words = [r["token"] for r in K.vocabulary(tokens, size).orderBy("rank").collect()]  # at most ``size`` words
    raw = table(spark, sf_dir, "documents")
    picked = raw if only is None else raw.join(only.select("doc_id").distinct(), "doc_id", "left_semi")
    base = spread(picked.select("doc_id", "lang", F.col("n_chars").cast("double"), "text")).withColumn("tokens", X.tokenize(X.normalize_text(F.col("text"))))
    base = base if "text" in carry else base.drop("text")
    base = P.one_hot(base, "lang", P.levels(raw, "lang")).withColumn("n_words", F.size("tokens").cast("double"))
    # Words are counted before the join: a bag moves, not the words.
    counted = CountVectorizerModel.from_vocabulary(words, inputCol="tokens", outputCol="bag").transform(base).drop("tokens")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("e"))
    wide = counted.join(vectors, "doc_id", "left").withColumn("e", F.coalesce("e", F.array_repeat(F.lit(0.0), 64)))
    counted = wide.withColumn("dense", array_to_vector("e"))
    langs = [c for c in counted.columns if c.startswith("lang_")]
    return VectorAssembler(inputCols=["n_chars", "n_words", *langs, "dense", "bag"], outputCol="features").transform(counted).select("doc_id", "features", *carry)


@query(
    "p07_combined_frame",
    f"""with {DOC_TOKENS}, {VOCAB}, b as (select doc_id, count(*) as n from tok join vocab using (token) group by 1),
t as (select doc_id, len(toks) as w from dt)
select doc_id, 2 + 4 + 64 + (select count(*) from vocab) as width, round(n_chars + w + 1 + coalesce(list_sum(list_transform(embedding, lambda x: x::double)), 0) + coalesce(n, 0), 4) as total
from documents join t using (doc_id) left join b using (doc_id) left join embeddings on vec_id = doc_id""",
)
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = combined_frame(spark, sf_dir).withColumn("a", vector_to_array("features"))
    return v.select("doc_id", F.size("a").alias("width"), F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query(
    "p08_stratified_split",
    """with r as (select doc_id, toxic, row_number() over (partition by toxic order by md5(doc_id::varchar), doc_id) as pos, count(*) over (partition by toxic) as size from labels)
select doc_id, toxic, case when pos <= floor(size * 0.6::double) then 'train' when pos <= floor(size * 0.8::double) then 'valid' else 'test' end as part from r""",
)
def p08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stratified_split(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", ["toxic"], {"train": 0.6, "valid": 0.2, "test": 0.2})


@query(
    "p08_random_split",
    """with r as (select o_orderkey, row_number() over (order by md5(o_orderkey::varchar), o_orderkey) as pos, count(*) over () as size from orders)
select o_orderkey, case when pos <= floor(size * 0.8::double) then 'train' else 'test' end as part from r""",
)
def p08_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stratified_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", [], {"train": 0.8, "test": 0.2})


@query("p09_temporal_split", f"with {GRID} select hr, event_type, n, case when hr < timestamp '2024-01-22' then 'train' else 'test' end as part from grid")
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_grid(spark, sf_dir).withColumn("part", F.when(F.col("hr") < F.expr("timestamp_ntz'2024-01-22'"), "train").otherwise("test"))


@query(
    "p10_oversample_interpolated",
    """with known as (select vec_id, embedding::double[] as v, label from embeddings where embedding is not null),
size as (select count(*) filter (label = 0) as few, greatest(ceil(count(*) filter (label <> 0) * 0.7::double) - count(*) filter (label = 0), 0)::bigint as wanted from known),
ranked as (select vec_id, v, row_number() over (order by md5(vec_id::varchar), vec_id) as pos from known where label = 0),
pts as (select v, min(vec_id) as point from ranked group by v),
near as (select a.v, b.point, b.v as nv, round(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))), 9) as dist from pts a join pts b on a.point <> b.point),
best as (select v, list({'point': point, 'nv': nv} order by dist, point)[1:5] as l from near group by v),
made as (select vec_id as origin, unnest(range(1, wanted // few + (pos <= wanted % few)::bigint + 1)) as copy, v, l from ranked join best using (v), size),
drawn as (select *, md5(origin::varchar || ':' || copy::varchar) as h from made),
picked as (select origin, copy, v, l[1 + ('0x' || substr(h, 1, 8))::bigint % len(l)] as n, (('0x' || substr(h, 9, 8))::bigint + 0.5::double) / 4294967296::double as u from drawn)
select origin, copy, n.point as near, list_transform(range(1, len(v) + 1), lambda i: round(v[i] + u * (n.nv[i] - v[i]), 6) + 0.0::double) as v, 0 as label from picked""",
)
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = P.oversample_interpolated(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0, 0.7)
    return made.withColumn("v", F.transform("v", lambda x: F.round(x, 6) + 0.0))


@query(
    "p11_oversample_augmented",
    f"""with {DOC_TOKENS}, {VOCAB}, syn as (select a.token, b.token as other from vocab a join vocab b on b.rank = a.rank + 1 where a.rank % 2 = 1),
few as (select doc_id from labels where quality = 0),
orig as (select doc_id, 0 as copy, string_agg(token, ' ' order by pos) as body from tok join labels using (doc_id) group by 1),
aug as (select doc_id, 1 as copy, string_agg(case when substr(md5(doc_id::varchar || ':' || pos::varchar), 1, 2) < '4d' then coalesce(other, tok.token) else tok.token end, ' ' order by pos) as body
  from tok join few using (doc_id) left join syn on syn.token = tok.token group by 1)
select * from orig union all select * from aug""",
)
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = K.vocabulary(X.token_table(docs(spark, sf_dir), ["doc_id"], "text"), 5000)
    nxt = vocab.select((F.col("rank") - 1).alias("rank"), F.col("token").alias("other"))
    synonyms = vocab.where("rank % 2 = 1").join(nxt, "rank").select("token", "other")
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = place(table(spark, sf_dir, "documents").select("doc_id", "text").join(marks, "doc_id"), "doc_id")
    return P.oversample_augmented(labelled, "doc_id", "text", F.col("quality") == 0, F.broadcast(synonyms))  # at most 2500 pairs


@query(
    "m17_stratified_folds",
    """with r as (select doc_id, toxic, row_number() over (partition by toxic order by md5(doc_id::varchar), doc_id) as pos from labels) select doc_id, toxic, ((pos - 1) % 5)::int as fold from r""",
)
def m17(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = hashed_position(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", ["toxic"])
    return ranked.select("doc_id", "toxic", ((F.col("pos") - 1) % 5).cast("int").alias("fold"))
