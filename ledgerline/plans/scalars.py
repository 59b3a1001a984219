"""Scalar functions F-01 .. F-18."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions import scalars as S
from ledgerline.operators.features import DOWNTOWN, NIGHTLIFE, interactions, rain_amount, time_flags, zone_flags
from ledgerline.plans.common import GRID, HOLIDAYS, RH, events_grid
from ledgerline.plans.joins import WEATHER, weather
from ledgerline.registry import query
from ledgerline.tables import table


@query("f01_strings", "select p_partkey, lower(trim('  ' || upper(p_name) || ' ')) as clean, replace(p_name, ' ', '_') as code, p_brand || ' / ' || p_type as label from part")
def f01(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.lower(F.trim(messy)).alias("clean"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("code"), F.concat_ws(" / ", "p_brand", "p_type").alias("label")
    )


@query("f02_lengths", "select doc_id, length(text)::int as n_text, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+'))::int as n_words from documents")
def f02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n_text"), F.regexp_count("text", F.lit(r"[^ \t\n\r\f\x0B]+")).alias("n_words"))


@query("f03_regex", "select p_partkey, regexp_replace(p_brand, '[0-9]', '', 'g') as letters, regexp_replace(p_brand, '[^0-9]', '', 'g') as digits, regexp_extract(p_name, '^[a-z]+') as first_word from part")
def f03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.regexp_replace("p_brand", "[0-9]", "").alias("letters"), F.regexp_replace("p_brand", "[^0-9]", "").alias("digits"), F.regexp_extract("p_name", "^[a-z]+", 0).alias("first_word")
    )


@query("f04_parse_timestamps", "select o_orderkey, case when o_orderkey % 5 = 4 then null else o_orderdate end as parsed from orders")
def f04(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 5
    text = (
        F.when(k == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(k == 1, F.date_format("o_orderdate", "dd.MM.yyyy HH:mm"))
        .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(k == 3, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(".000000000")))
        .otherwise(F.lit("unknown"))
    )
    formats = ["dd/MM/yyyy", "dd.MM.yyyy HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"]
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t")).select("o_orderkey", S.parse_timestamp(F.col("t"), formats).alias("parsed"))


@query(
    "f05_date_parts",
    """select event_id, hour(ts)::int as hour, (isodow(ts) - 1)::int as weekday, day(ts)::int as day, month(ts)::int as month, quarter(ts)::int as quarter,
year(ts)::int as year, week(ts)::int as week, dayofyear(ts)::int as day_of_year from events""",
)
def f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday"), F.dayofmonth("ts").alias("day"), F.month("ts").alias("month"),
        F.quarter("ts").alias("quarter"), F.year("ts").alias("year"), F.weekofyear("ts").alias("week"), F.dayofyear("ts").alias("day_of_year"),
    )


@query("f06_round_hour", f"select event_id, {RH} as hr from events")
def f06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", S.round_hour(F.col("ts")).alias("hr"))


@query(
    "f07_date_arithmetic",
    """select o_orderkey, o_orderdate + interval 1 day as next_day, o_orderdate - interval 36 hour as earlier, last_day(o_orderdate) as month_end,
len(generate_series(date_trunc('month', o_orderdate), last_day(o_orderdate)::timestamp, interval 1 day))::int as month_days from orders""",
)
def f07(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (d + F.expr("interval 1 day")).alias("next_day"), (d - F.expr("interval 36 hours")).alias("earlier"), F.last_day(d).alias("month_end"),
        F.size(F.sequence(F.trunc(d, "month"), F.last_day(d), F.expr("interval 1 day"))).alias("month_days"),
    )


@query(
    "f08_cyclic",
    "select event_id, " + ", ".join(f"round({fn}({v} * 2.0::double * pi() / {p}), 6) + 0.0 as {n}_{fn}" for n, v, p in (("hour", "hour(ts)", 24), ("weekday", "(isodow(ts) - 1)", 7), ("month", "month(ts)", 12)) for fn in ("sin", "cos")) + " from events",
)
def f08(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"hour": (F.hour("ts"), 24), "weekday": (F.weekday("ts"), 7), "month": (F.month("ts"), 12)}
    cols = []
    for name, (value, period) in parts.items():
        s, c = S.cyclic(value, period)
        cols += [(F.round(s, 6) + 0.0).alias(f"{name}_sin"), (F.round(c, 6) + 0.0).alias(f"{name}_cos")]
    return table(spark, sf_dir, "events").select("event_id", *cols)


@query(
    "f09_holidays",
    f"""with {HOLIDAYS} select o_orderkey, (cast(o_orderdate as date) in (select hd from hol))::int as is_holiday,
(cast(o_orderdate as date) in (select hd from hol) or (o_orderdate + interval 1 day)::date in (select hd from hol) or (o_orderdate - interval 1 day)::date in (select hd from hol))::int as near_holiday from orders""",
)
def f09(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", cal.is_holiday(d).alias("is_holiday"), cal.near_holiday(d).alias("near_holiday"))


@query("f10_safe_ratio", "select l_orderkey, l_linenumber, l_partkey, round(l_tax / nullif(l_discount, 0), 6) as ratio, round(l_tax / (case when l_discount = 0 then 1 else l_discount end), 6) as ratio_or_same from lineitem")
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, d = F.col("l_tax"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(S.safe_ratio(t, d), 6).alias("ratio"), F.round(S.ratio_or_same(t, d), 6).alias("ratio_or_same"))


@query(
    "f11_row_mean",
    """select l_orderkey, l_linenumber, l_partkey, round((l_quantity + l_discount + l_tax) / 3, 6) as plain_mean,
round(list_avg([l_quantity, case when l_linenumber % 2 = 0 then null else l_discount end, l_tax]), 6) as known_mean from lineitem""",
)
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    holed = F.when(F.col("l_linenumber") % 2 != 0, d)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round((q + d + t) / 3, 6).alias("plain_mean"), F.round(S.row_mean(q, holed, t), 6).alias("known_mean"))


FLAGS_SQL = """(hour(hr) in (7, 8, 9, 16, 17, 18, 19) and isodow(hr) < 6)::int as is_rush_hour, (isodow(hr) >= 6)::int as is_weekend, (event_type in ('error', 'purchase'))::int as is_downtown"""


@query(
    "f12_interactions",
    f"""with {GRID}, f as (select hr, event_type, hour(hr)::int as h, {FLAGS_SQL} from grid)
select hr, event_type, is_weekend * h as is_weekend_hour, is_rush_hour * is_downtown as is_rush_hour_downtown, is_downtown * h as is_downtown_hour from f""",
)
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = zone_flags(time_flags(events_grid(spark, sf_dir), "hr"), "event_type", DOWNTOWN, NIGHTLIFE)
    return interactions(g).select("hr", "event_type", "is_weekend_hour", "is_rush_hour_downtown", "is_downtown_hour")


@query("f13_least_greatest", "select l_orderkey, l_linenumber, l_partkey, least(l_partkey, l_suppkey) as lo, greatest(l_partkey, l_suppkey) as hi, abs(l_quantity - 25) as gap, round(l_extendedprice, 0)::bigint as whole from lineitem")
def f13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.least("l_partkey", "l_suppkey").alias("lo"), F.greatest("l_partkey", "l_suppkey").alias("hi"),
        F.abs(F.col("l_quantity") - 25).alias("gap"), F.round("l_extendedprice", 0).cast("long").alias("whole"),
    )


@query(
    "f14_time_flags",
    """select event_id, (isodow(ts) >= 6)::int as is_weekend, (hour(ts) in (7, 8, 9, 16, 17, 18, 19) and isodow(ts) < 6)::int as is_rush_hour,
(hour(ts) in (16, 17, 18, 19) and isodow(ts) < 6)::int as is_evening_rush, (hour(ts) in (18, 19, 20, 21, 22, 23) and isodow(ts) >= 6)::int as is_event_time,
(hour(ts) between 12 and 18)::int as is_peak_hour, (month(ts) in (6, 7, 8))::int as is_summer, (month(ts) in (12, 1, 2))::int as is_winter,
(event_type in ('error', 'purchase'))::int as is_downtown, (event_type = 'click')::int as is_nightlife from events""",
)
def f14(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = zone_flags(time_flags(table(spark, sf_dir, "events"), "ts"), "event_type", DOWNTOWN, NIGHTLIFE)
    return flagged.select(
        "event_id", "is_weekend", "is_rush_hour", "is_evening_rush", "is_event_time", "is_peak_hour", "is_summer", "is_winter", "is_downtown", "is_nightlife"
    )


@query(
    "f15_rain",
    f"""with {GRID}, {WEATHER}, p as (select hr, coalesce(try_cast(case when precipitation = 'Trace of precipitation' then '0.1' else precipitation end as double), 0) as rain from weather)
select hr, rain, (rain > 0)::int as is_raining from p""",
)
def f15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather(spark, sf_dir).select("hr", rain_amount(F.col("precipitation")).alias("rain")).withColumn("is_raining", S.flag(F.col("rain") > 0))


@query(
    "f16_nested_json",
    "select event_id, (props->>'k')::double as k, coalesce((props->'rain'->>'1h')::double, 0.0::double) as rain_1h from events",
)
def f16(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k double, rain struct<`1h`: double>")
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("p")).select("event_id", "p.k", F.coalesce(F.col("p.rain.1h"), F.lit(0.0)).alias("rain_1h"))


@query("f17_array_explode", "select vec_id, (i - 1)::int as pos, round(embedding[i]::double, 6) as x from embeddings cross join range(1, 65) r(i)")
def f17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v")).select("vec_id", "pos", F.round(F.col("v").cast("double"), 6).alias("x"))


@query("f18_composite_label", "select o_orderkey, o_orderstatus || ' + ' || o_orderpriority as label, round(o_totalprice / 1000, 6) as price_k from orders")
def f18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(" + ", "o_orderstatus", "o_orderpriority").alias("label"), F.round(F.col("o_totalprice") / 1000, 6).alias("price_k"))
