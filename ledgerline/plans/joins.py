"""Joins J-01 .. J-12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import round_hour
from ledgerline.operators.ordered import as_of
from ledgerline.operators.relational import attach, cooccurring_pairs, item_blocks, rows_missing, rows_of, top_k
from ledgerline.operators.series import hourly_counts
from ledgerline.plans.common import GRID, events_grid
from ledgerline.plans.reports import BRIDGE, bridge
from ledgerline.registry import query
from ledgerline.tables import table


@query("j01_left_dim", "select o_orderkey, o_totalprice, c_name, c_mktsegment from orders left join customer on o_custkey = c_custkey")
def j01(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return attach(facts, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", ["c_name", "c_mktsegment"]).drop("o_custkey")


@query(
    "j02_star_bridge",
    f"""with {BRIDGE} select brand, o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total
from orders join bridge using (o_orderkey) group by all""",
)
def j02(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return facts.join(bridge(spark, sf_dir), "o_orderkey").groupBy("brand", "o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "j03_cooccurring_pairs",
    f"""with {BRIDGE} select a.brand as item_a, b.brand as item_b, count(*) as pair_count
from bridge a join bridge b on a.o_orderkey = b.o_orderkey and a.brand < b.brand group by all""",
)
def j03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurring_pairs(bridge(spark, sf_dir), "o_orderkey", "brand", item_blocks(table(spark, sf_dir, "part"), "p_brand"))


@query(
    "j03_pairs_with_support",
    f"""with {BRIDGE} select a.brand as item_a, b.brand as item_b, count(*) as pair_count
from bridge a join bridge b on a.o_orderkey = b.o_orderkey and a.brand < b.brand group by all having count(*) >= (select count(distinct o_orderkey) from bridge) / 60""",
)
def j03_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs held by at least one order in sixty: the bound is known before any pair is made."""
    sold = bridge(spark, sf_dir)
    least = -(-sold.agg(F.count_distinct("o_orderkey")).first()[0] // 60)
    return cooccurring_pairs(sold, "o_orderkey", "brand", item_blocks(table(spark, sf_dir, "part"), "p_brand"), least)



@query(
    "j04_semi_top_list",
    """with best as (select o_custkey, count(*) as n from orders group by 1 order by n desc, o_custkey limit 10)
select o_orderkey, o_custkey, o_totalprice from orders where o_custkey in (select o_custkey from best)""",
)
def j04(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    best = top_k(orders.groupBy("o_custkey").agg(F.count("*").alias("n")), 10, [F.col("n").desc()], ["o_custkey"])
    return rows_of(orders, F.broadcast(best), ["o_custkey"])  # ten keys


@query(
    "j05_anti_missing",
    """select c_custkey, c_name from customer where c_custkey not in
(select o_custkey from orders where o_orderdate >= timestamp '1996-07-01' and o_orderdate < timestamp '1996-08-01')""",
)
def j05(spark: SparkSession, sf_dir: str) -> DataFrame:
    july = table(spark, sf_dir, "orders").where("o_orderdate >= timestamp_ntz'1996-07-01' and o_orderdate < timestamp_ntz'1996-08-01'")
    seen = july.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return rows_missing(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), seen, ["c_custkey"])


@query("j06_densify_grid", f"with {GRID} select hr, event_type, n from grid")
def j06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_grid(spark, sf_dir)


# A small hourly weather table made by rule from the hour itself: the reference's file is not shipped.
WEATHER = """weather as (select hr, round(10 + (hour(hr) * 7 + day(hr) * 3) % 17 - 5, 2)::double as temperature,
  (40 + (hour(hr) * 5 + day(hr)) % 50)::double as humidity,
  case when (hour(hr) + day(hr)) % 5 = 0 then 'Trace of precipitation'
       when (hour(hr) * day(hr)) % 7 = 0 then ((hour(hr) % 4) * 0.5)::varchar else 'none' end as precipitation
  from spine where (hour(hr) + 2 * day(hr)) % 11 <> 0)"""


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather over the span of the events; some hours are missing on purpose."""
    ev = table(spark, sf_dir, "events")
    span = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    hours = span.select(F.explode(F.sequence(round_hour(F.col("lo")), round_hour(F.col("hi")), F.expr("interval 1 hour"))).alias("hr"))
    h, d = F.hour("hr"), F.dayofmonth("hr")
    return hours.where((h + 2 * d) % 11 != 0).select(
        "hr",
        (F.lit(10) + (h * 7 + d * 3) % 17 - 5).cast("double").alias("temperature"),
        (F.lit(40) + (h * 5 + d) % 50).cast("double").alias("humidity"),
        F.when((h + d) % 5 == 0, F.lit("Trace of precipitation"))
        .when((h * d) % 7 == 0, (h % 4 * F.lit(0.5)).cast("decimal(3,1)").cast("string"))
        .otherwise(F.lit("none")).alias("precipitation"),
    )


@query(
    "j07_hourly_enrichment",
    f"""with {GRID}, {WEATHER} select event_type, month(g.hr)::int as month, day(g.hr)::int as day, hour(g.hr)::int as hour,
  g.n, w.temperature, w.humidity from cnt g left join weather w on g.hr = w.hr""",
)
def j07(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = hourly_counts(table(spark, sf_dir, "events"), "ts", "event_type")
    w = weather(spark, sf_dir).select("hr", "temperature", "humidity")
    # One weather row per calendar hour: bounded by the calendar, not by the events.
    return counts.join(F.broadcast(w), "hr", "left").select(
        "event_type", F.month("hr").alias("month"), F.dayofmonth("hr").alias("day"), F.hour("hr").alias("hour"), "n", "temperature", "humidity"
    )


@query(
    "j08_lookup_default",
    f"""with {GRID}, last as (select event_type, n from cnt where hr = (select max(hr) from cnt))
select k.event_type, coalesce(l.n, 0)::double as lag_1 from (select distinct event_type from cnt) k left join last l using (event_type)""",
)
def j08(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("ts", "event_type")
    newest = ev.agg(round_hour(F.max("ts")).alias("v")).scalar()
    # Only rows of the last rounded hour can count; the plain time bound reaches the scan.
    recent = ev.where(F.col("ts") >= newest - F.expr("interval 1 hour"))
    last = hourly_counts(recent, "ts", "event_type").where(F.col("hr") == newest)
    keys = ev.select("event_type").distinct()
    return keys.join(last, "event_type", "left").select("event_type", F.coalesce("n", F.lit(0)).cast("double").alias("lag_1"))


@query(
    "j09_as_of",
    """select f.event_id, f.user_id, f.ts, s.value as last_purchase
from (select * from events where event_type <> 'purchase') f
asof left join (select user_id, ts, value from events where event_type = 'purchase'
  qualify row_number() over (partition by user_id, ts order by event_id desc) = 1) s
  on f.user_id = s.user_id and f.ts >= s.ts""",
)
def j09(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    facts = ev.where(F.col("event_type") != "purchase").select("event_id", "user_id", "ts")
    buys = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    return as_of(facts, buys, "user_id", "ts", "value", "last_purchase", "event_id")


@query(
    "j10_glue_columns",
    """select vec_id, label, quality, toxic, round(embedding[1]::double, 6) as x0, len(embedding)::int as width
from embeddings left join labels on vec_id = doc_id""",
)
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "vec_id")
    return table(spark, sf_dir, "embeddings").join(marks, "vec_id", "left").select(
        "vec_id", "label", "quality", "toxic",
        F.round(F.col("embedding")[0].cast("double"), 6).alias("x0"), F.size("embedding").alias("width"),
    )


@query(
    "j11_predictions_to_actuals",
    f"""with {GRID}, pred as (select hr + interval 1 hour as hr, event_type, n as predicted from grid)
select p.hr, p.event_type, p.predicted, coalesce(c.n, 0)::bigint as actual, abs(p.predicted - coalesce(c.n, 0))::bigint as abs_error
from pred p left join cnt c using (hr, event_type)""",
)
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = events_grid(spark, sf_dir)
    predicted = grid.select((F.col("hr") + F.expr("interval 1 hour")).alias("hr"), "event_type", F.col("n").alias("predicted"))
    actual = hourly_counts(table(spark, sf_dir, "events"), "ts", "event_type", "actual")
    return predicted.join(actual, ["hr", "event_type"], "left").fillna({"actual": 0}).withColumn(
        "abs_error", F.abs(F.col("predicted") - F.col("actual"))
    )


@query(
    "j12_top_then_bridge",
    f"""with top as (select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100), {BRIDGE}
select o_orderkey, o_totalprice, brand from top join bridge using (o_orderkey)""",
)
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_k(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 100, [F.col("o_totalprice").desc()], ["o_orderkey"])
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    found = lines.join(F.broadcast(top), "o_orderkey")  # 100 rows by construction
    brands = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand")
    return attach(found, brands, "l_partkey", "p_partkey", ["brand"], "inner").select("o_orderkey", "o_totalprice", "brand").distinct()
