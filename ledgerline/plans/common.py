"""SQL fragments and small frames shared by the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.evaluation import forecast_errors
from ledgerline.operators.relational import attach
from ledgerline.operators.series import daily_series, hour_grid
from ledgerline.tables import table

RH = "make_timestamp((round_even(epoch_us(ts) / 3.6e9, 0) * 3600000000)::bigint)"

GRID = f"""cnt as (select {RH} as hr, event_type, count(*) as n from events group by all),
spine as (select unnest(generate_series((select min(hr) from cnt), (select max(hr) from cnt), interval 1 hour)) as hr),
grid as (select s.hr, k.event_type, coalesce(c.n, 0)::bigint as n
  from spine s cross join (select distinct event_type from cnt) k left join cnt c using (hr, event_type))"""

LINES = """sold as (select l_orderkey, l_partkey, l_quantity, l_extendedprice, p_brand as brand, p_type, o_orderdate, o_custkey
  from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey)"""

DAILY = """days as (select p_brand as brand, cast(l_shipdate as date) as d, sum(l_extendedprice) as s
  from lineitem join part on l_partkey = p_partkey group by all),
cal as (select unnest(generate_series((select min(cast(l_shipdate as date)) from lineitem), (select max(cast(l_shipdate as date)) from lineitem), interval 1 day))::date as d),
daily as (select b.brand, c.d, round(coalesce(s, 0), 2) as sales from cal c cross join (select distinct brand from days) b
  left join days using (brand, d))"""


def events_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_grid(table(spark, sf_dir, "events").select("ts", "event_type"), "ts", "event_type")


def brand_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with brand and type."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand")
    return attach(lines, parts, "l_partkey", "p_partkey", ["brand", "p_type"], "inner")


def brand_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales per brand on a dense calendar."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", F.col("l_extendedprice").alias("amount"))
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand")
    # The sums per (brand, day) merge right after the lookup, before anything else moves.
    branded = attach(lines, parts, "l_partkey", "p_partkey", ["brand"], "inner")
    return daily_series(branded, "brand", "l_shipdate", "amount").withColumn("sales", F.round("sales", 2)).select("brand", "d", "sales")


# Holidays the other way round: weekdays are counted inside each month of a generated calendar.
HOLIDAYS = """hcal as (select unnest(generate_series(date '1994-12-01', date '2025-02-01', interval 1 day))::date as hd),
hnum as (select hd, month(hd) as m, day(hd) as dd, isodow(hd) as wd, row_number() over (partition by year(hd), month(hd), isodow(hd) order by hd) as nth,
  row_number() over (partition by year(hd), month(hd), isodow(hd) order by hd desc) as back from hcal),
hfix as (select hd, wd from hnum where (m = 1 and dd = 1) or (m = 6 and dd = 19 and year(hd) >= 2021) or (m = 7 and dd = 4) or (m = 11 and dd = 11) or (m = 12 and dd = 25)),
hol as (select hd from hfix union select (hd - interval 1 day)::date from hfix where wd = 6 union select (hd + interval 1 day)::date from hfix where wd = 7
  union select hd from hnum where (m = 1 and wd = 1 and nth = 3) or (m = 2 and wd = 1 and nth = 3) or (m = 5 and wd = 1 and back = 1)
    or (m = 9 and wd = 1 and nth = 1) or (m = 10 and wd = 1 and nth = 2) or (m = 11 and wd = 4 and nth = 4))"""

# Error table of the previous-hour forecast.
ERRORS = f"""{GRID}, {HOLIDAYS},
lagged as (select hr, event_type, n, lag(n) over (partition by event_type order by hr) as predicted from grid),
err as (select hr, event_type, n as actual, predicted, n - predicted as signed, abs(n - predicted) as abs_error,
  hour(hr)::int as hour_of_day, (isodow(hr) - 1)::int as day_of_week, (isodow(hr) >= 6)::int as is_weekend,
  (hour(hr) in (7, 8, 9, 16, 17, 18, 19) and isodow(hr) < 6)::int as is_rush_hour, (cast(hr as date) in (select hd from hol))::int as is_holiday
  from lagged where predicted is not null)"""


def baseline_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous-hour forecast against what came: one row per (hour, type)."""
    return forecast_errors(events_grid(spark, sf_dir), "event_type", "hr", "n")
