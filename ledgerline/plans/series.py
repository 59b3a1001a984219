"""Window functions W-01 .. W-16, the feature marts P-12 and P-13, and the reports Q-13 .. Q-16."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import recode, round_hour
from ledgerline.operators import series as S
from ledgerline.operators.cleaning import label_iqr_outliers
from ledgerline.operators.evaluation import regression_metrics
from ledgerline.operators.features import demand_mart, next_hour_row, rain_amount, store_features
from ledgerline.operators.models import PreviousStep
from ledgerline.operators.ordered import previous_value
from ledgerline.operators.quantiles import quantile_scalars
from ledgerline.operators.relational import attach, newest
from ledgerline.plans.aggregates import a28
from ledgerline.plans.cleaning import LABELLED
from ledgerline.plans.common import DAILY, GRID, HOLIDAYS, RH, brand_days, events_grid
from ledgerline.plans.joins import WEATHER, weather
from ledgerline.registry import query
from ledgerline.tables import materialise, table

GW = "over (partition by event_type order by hr)"


def frame_sql(fn: str, lo: str, hi: str) -> str:
    return f"{fn} over (partition by event_type order by hr rows between {lo} and {hi})"


LAGS = (1, 2, 3, 6, 12, 24, 48, 168, 336)


@query("w01_lags", f"with {GRID} select hr, event_type, n, " + ", ".join(f"lag(n, {k}) {GW}::double as lag_{k}" for k in LAGS) + " from grid")
def w01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.lags(events_grid(spark, sf_dir), "event_type", "hr", "n", LAGS)


@query("w02_lead_target", f"with {GRID} select hr, event_type, n, lead(n) {GW}::double as target from grid")
def w02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.lead_target(events_grid(spark, sf_dir), "event_type", "hr", "n")


def whole(expr: str, lo: str, hi: str, size: int) -> str:
    return f"round(case when {frame_sql('count(n)', lo, hi)} = {size} then {frame_sql(expr, lo, hi)} end, 6)"


@query(
    "w03_rolling_mean_before",
    f"with {GRID} select hr, event_type, {whole('avg(n)', '3 preceding', '1 preceding', 3)} as rolling_mean_3h, {whole('avg(n)', '24 preceding', '1 preceding', 24)} as rolling_mean_24h from grid",
)
def w03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_grid(spark, sf_dir).select(
        "hr", "event_type", *[F.round(S.rolling_mean_before("event_type", "hr", "n", k), 6).alias(f"rolling_mean_{k}h") for k in (3, 24)]
    )


@query(
    "w04_rolling_mean_with",
    f"with {GRID} select hr, event_type, round({frame_sql('avg(n)', '2 preceding', 'current row')}, 6) as rolling_mean_3h, round({frame_sql('avg(n)', '23 preceding', 'current row')}, 6) as rolling_mean_24h from grid",
)
def w04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_grid(spark, sf_dir).select(
        "hr", "event_type", *[F.round(S.rolling_mean_with("event_type", "hr", "n", k), 6).alias(f"rolling_mean_{k}h") for k in (3, 24)]
    )


@query("w05_rolling_std", f"with {GRID} select hr, event_type, " + ", ".join(f"{whole('stddev_samp(n)', f'{k - 1} preceding', 'current row', k)} as rolling_std_{k}" for k in (7, 24, 48)) + " from grid")
def w05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_grid(spark, sf_dir).select(
        "hr", "event_type", *[F.round(S.rolling_std_with("event_type", "hr", "n", k), 6).alias(f"rolling_std_{k}") for k in (7, 24, 48)]
    )


@query("w06_lag_difference", f"with {GRID} select hr, event_type, (lag(n, 1) {GW} - lag(n, 2) {GW})::double as diff_lag1_lag2, (lag(n, 1) {GW} - lag(n, 24) {GW})::double as diff_lag1_lag24 from grid")
def w06(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = S.lags(events_grid(spark, sf_dir), "event_type", "hr", "n", [1, 2, 24])
    return g.select("hr", "event_type", (F.col("lag_1") - F.col("lag_2")).alias("diff_lag1_lag2"), (F.col("lag_1") - F.col("lag_24")).alias("diff_lag1_lag24"))


# Hourly peak value per type; silent hours and a fixed pattern of hours are unknown.
KNOWN = f"""{GRID}, hv as (select {RH} as hr, event_type, max(value) as v from events group by all),
gaps as (select hr, event_type, case when (hour(hr) + day(hr)) % 4 <> 0 then v end as v from grid left join hv using (hr, event_type))"""


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    peaks = ev.groupBy(round_hour(F.col("ts")).alias("hr"), "event_type").agg(F.max("value").alias("v"))
    grid = events_grid(spark, sf_dir).drop("n").join(peaks, ["hr", "event_type"], "left")
    return grid.withColumn("v", F.when((F.hour("hr") + F.dayofmonth("hr")) % 4 != 0, F.col("v")))


@query(
    "w07_fill_forward_back",
    f"""with {KNOWN} select hr, event_type, round(coalesce(last_value(v ignore nulls) over (partition by event_type order by hr rows between unbounded preceding and current row),
first_value(v ignore nulls) over (partition by event_type order by hr rows between current row and unbounded following)), 6) as v from gaps""",
)
def w07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.fill_forward_back(gaps(spark, sf_dir), "event_type", "hr", ["v"]).withColumn("v", F.round("v", 6))


@query(
    "w08_interpolate",
    f"""with {KNOWN}, s as (select *, last_value(case when v is not null then hr end ignore nulls) over b as pt, last_value(v ignore nulls) over b as pv,
  first_value(case when v is not null then hr end ignore nulls) over a as qt, first_value(v ignore nulls) over a as qv from gaps
  window b as (partition by event_type order by hr rows between unbounded preceding and current row), a as (partition by event_type order by hr rows between current row and unbounded following))
select hr, event_type, round(coalesce(v, pv + (qv - pv) * (epoch(hr) - epoch(pt)) / (epoch(qt) - epoch(pt)), pv), 6) as filled from s""",
)
def w08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.interpolate(gaps(spark, sf_dir), "event_type", "hr", "v", "filled").select("hr", "event_type", F.round("filled", 6).alias("filled"))


# Every fifth hour is missing from the series itself, so a step is one hour or two.
@query(
    "w08_interpolate_position",
    f"""with {KNOWN}, g as (select *, row_number() over (partition by event_type order by hr) as i from gaps where hour(hr) % 5 <> 3),
s as (select *, last_value(case when v is not null then i end ignore nulls) over b as pi, last_value(v ignore nulls) over b as pv,
  first_value(case when v is not null then i end ignore nulls) over a as qi, first_value(v ignore nulls) over a as qv from g
  window b as (partition by event_type order by hr rows between unbounded preceding and current row), a as (partition by event_type order by hr rows between current row and unbounded following))
select hr, event_type, round(coalesce(v, pv + (qv - pv) * (i - pi)::double / (qi - pi), pv), 6) as filled from s""",
)
def w08_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = gaps(spark, sf_dir).where(F.hour("hr") % 5 != 3)
    return S.interpolate(series, "event_type", "hr", "v", "filled", by="position").select("hr", "event_type", F.round("filled", 6).alias("filled"))



@query("w09_keep_newest", "select user_id, event_type, event_id, ts, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def w09(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return newest(ev, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "w10_gap_to_previous",
    "select o_orderkey, o_custkey, datediff('day', lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey), o_orderdate)::int as days_since from orders",
)
def w10(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    prev = previous_value(orders, "o_custkey", "o_orderdate", "o_orderkey", "o_orderdate", "_before")
    return prev.select("o_orderkey", "o_custkey", F.datediff("o_orderdate", "_before").alias("days_since"))


def day_frame(size: int) -> str:
    w = f"over (partition by brand order by d rows between {size - 1} preceding and current row)"
    return f"round(case when count(sales) {w} = {size} then avg(sales) {w} end, 4) as ma_{size}"


@query("w11_moving_average", f"with {DAILY} select brand, d, {day_frame(7)}, {day_frame(30)} from daily")
def w11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brand_days(spark, sf_dir).select("brand", "d", *[F.round(S.moving_average("brand", "d", "sales", k), 4).alias(f"ma_{k}") for k in (7, 30)])


@query(
    "w12_decompose_additive",
    f"""with {DAILY}, t as (select *, row_number() over (partition by brand order by d) - 1 as i,
  case when count(*) over f = 7 then avg(sales) over f end as trend from daily window f as (partition by brand order by d rows between 3 preceding and 3 following)),
r as (select brand, i % 7 as p, avg(sales - trend) as raw from t group by 1, 2), c as (select brand, avg(raw) as c from r group by 1)
select t.brand, d, round(trend, 4) as trend, round(raw - c, 4) as seasonal, round(sales - trend - (raw - c), 4) as resid from t join r on r.brand = t.brand and r.p = t.i % 7 join c on c.brand = t.brand""",
)
def w12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.decompose(brand_days(spark, sf_dir), "brand", "d", "sales", 7).select("brand", "d", *[F.round(c, 4).alias(c) for c in ("trend", "seasonal", "resid")])


@query(
    "w12_decompose_multiplicative",
    f"""with {DAILY}, t as (select *, row_number() over (partition by brand order by d) - 1 as i,
  case when count(*) over f = 31 then (sum(sales) over f - 0.5::double * (lag(sales, 15) over o + lead(sales, 15) over o)) / 30 end as trend from daily
  window f as (partition by brand order by d rows between 15 preceding and 15 following), o as (partition by brand order by d)),
r as (select brand, i % 30 as p, avg(sales / nullif(trend, 0)) as raw from t group by 1, 2), c as (select brand, avg(raw) as c from r group by 1)
select t.brand, d, round(trend, 4) as trend, round(raw / c, 4) as seasonal, round(sales / nullif(trend * raw / c, 0), 4) as resid from t join r on r.brand = t.brand and r.p = t.i % 30 join c on c.brand = t.brand""",
)
def w12_mult(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.decompose(brand_days(spark, sf_dir), "brand", "d", "sales", 30, "multiplicative")
    return out.select("brand", "d", *[F.round(c, 4).alias(c) for c in ("trend", "seasonal", "resid")])


@query(
    "w13_sequences",
    f"with {GRID}, s as (select hr, event_type, n, list(n) over (partition by event_type order by hr rows between 6 preceding and 1 preceding) as past from grid) select hr, event_type, past, n as label from s where len(past) = 6",
)
def w13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sequences(events_grid(spark, sf_dir), "event_type", "hr", "n", 6).select("hr", "event_type", "past", "label")


@query("w14_first_rows", f"with {GRID} select hr, event_type, n from grid qualify row_number() {GW} <= 168")
def w14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.first_rows(events_grid(spark, sf_dir), "event_type", "hr", 168)


@query("w15_last_rows_holdout", f"with {DAILY} select brand, d, sales, case when row_number() over (partition by brand order by d desc) <= 30 then 'test' else 'train' end as part from daily")
def w15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.mark_last(brand_days(spark, sf_dir), "brand", "d", 30)


@query(
    "w16_position_split",
    f"with {DAILY} select brand, d, sales, case when row_number() over (partition by brand order by d) <= floor(0.8::double * count(*) over (partition by brand)) then 'train' else 'test' end as part from daily",
)
def w16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.mark_share(brand_days(spark, sf_dir), "brand", "d", 0.8)


# ---- feature marts -------------------------------------------------------------------------------

RAIN = """wx as (select hr, temperature, humidity, coalesce(try_cast(case when precipitation = 'Trace of precipitation' then '0.1' else precipitation end as double), 0) as rain from weather),
wspan as (select unnest(generate_series((select min(hr) from wx), (select max(hr) from wx), interval 1 hour)) as hr),
wet as (select hr, last_value(temperature ignore nulls) over k as temperature, last_value(humidity ignore nulls) over k as humidity, last_value(rain ignore nulls) over k as rain
  from wspan left join wx using (hr) window k as (order by hr rows between unbounded preceding and current row))"""

MART = f"""{GRID}, {WEATHER}, {RAIN}, {HOLIDAYS},
base as (select g.*, hour(g.hr)::int as hour_of_day, (isodow(g.hr) - 1)::int as day_of_week, day(g.hr)::int as day_of_month, (isodow(g.hr) >= 6)::int as is_weekend,
  (hour(g.hr) in (7, 8, 9, 16, 17, 18, 19) and isodow(g.hr) < 6)::int as is_rush_hour, (hour(g.hr) in (16, 17, 18, 19) and isodow(g.hr) < 6)::int as is_evening_rush,
  (cast(g.hr as date) in (select hd from hol))::int as is_holiday, (event_type in ('error', 'purchase'))::int as is_downtown,
  coalesce(temperature, 0) as temperature, coalesce(humidity, 0) as humidity, coalesce(rain, 0) as rain from grid g left join wet on wet.hr = g.hr),
mart as (select *, is_weekend * hour_of_day as is_weekend_hour, is_rush_hour * is_downtown as is_rush_hour_downtown, is_downtown * hour_of_day as is_downtown_hour, (rain > 0)::int as is_raining,
  (rain > 0)::int * is_downtown as is_raining_downtown, {", ".join(f"lag(n, {k}) {GW}::double as lag_{k}" for k in (1, 2, 3, 6, 12, 24))},
  {whole('avg(n)', '3 preceding', '1 preceding', 3)} as rolling_mean_3h, {whole('avg(n)', '24 preceding', '1 preceding', 24)} as rolling_mean_24h, lead(n) {GW}::double as target from base),
ready as (select * from mart where target is not null and lag_24 is not null and rolling_mean_24h is not null)"""

MART_COLS = (
    "hr event_type n hour_of_day day_of_week day_of_month is_weekend is_rush_hour is_evening_rush is_holiday is_downtown temperature humidity rain is_weekend_hour "
    "is_rush_hour_downtown is_downtown_hour is_raining is_raining_downtown lag_1 lag_2 lag_3 lag_6 lag_12 lag_24 rolling_mean_3h rolling_mean_24h target"
).split()


def numeric_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather(spark, sf_dir).select("hr", "temperature", "humidity", rain_amount(F.col("precipitation")).alias("rain"))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = demand_mart(events_grid(spark, sf_dir), numeric_weather(spark, sf_dir), "event_type", "hr", "n")
    return out.withColumns({c: F.round(c, 6) for c in ("rolling_mean_3h", "rolling_mean_24h")}).select(*MART_COLS)


@query("p12_demand_mart", f"with {MART} select {', '.join(MART_COLS)} from ready")
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir)


# Cloud cover in words and its share of the sky in percent.
CLOUDS = {"clear": 0, "few": 25, "scattered": 50, "overcast": 100}

FULL_WEATHER = "temperature humidity rain wind cloud".split()
WET_SQL = f"""sky as (select hr, temperature, humidity, coalesce(try_cast(case when precipitation = 'Trace of precipitation' then '0.1' else precipitation end as double), 0) as rain,
  ((hour(hr) * 3 + day(hr)) % 12)::double as wind, [{", ".join(f"{v}.0" for v in CLOUDS.values())}][1 + (hour(hr) + day(hr)) % 4]::double as cloud from weather where hour(hr) <> 0 or day(hr) <> 1),
filled as (select g.hr, g.event_type, {", ".join(f"coalesce(last_value({c} ignore nulls) over before, first_value({c} ignore nulls) over after, 0) as {c}" for c in FULL_WEATHER)}
  from grid g left join sky on sky.hr = g.hr window before as (partition by g.event_type order by g.hr rows between unbounded preceding and current row), after as (partition by g.event_type order by g.hr rows between current row and unbounded following))"""


@query(
    "p12_mart_weather_per_key",
    f"""with {MART}, {WET_SQL} select {", ".join("f." + c if c in FULL_WEATHER else "(f.rain > 0)::int as is_raining" if c == "is_raining" else "(f.rain > 0)::int * is_downtown as is_raining_downtown" if c == "is_raining_downtown" else "r." + c for c in MART_COLS)}, f.wind, f.cloud
from ready r join filled f on f.hr = r.hr and f.event_type = r.event_type""",
)
def p12_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart with wind and cloud cover; missing hours are filled within each key, forwards, then backwards."""
    h, d = F.hour("hr"), F.dayofmonth("hr")
    words = F.element_at(F.array(*map(F.lit, CLOUDS)), (h + d) % 4 + 1)
    sky = weather(spark, sf_dir).where((h != 0) | (d != 1)).select(
        "hr", "temperature", "humidity", rain_amount(F.col("precipitation")).alias("rain"), ((h * 3 + d) % 12).cast("double").alias("wind"), recode(words, CLOUDS).cast("double").alias("cloud")
    )
    out = demand_mart(events_grid(spark, sf_dir), sky, "event_type", "hr", "n", FULL_WEATHER, per_key=True)
    return out.withColumns({c: F.round(c, 6) for c in ("rolling_mean_3h", "rolling_mean_24h")}).select(*MART_COLS, "wind", "cloud")


@query(
    "p13_next_hour_features",
    f"""with {GRID}, {WEATHER}, {RAIN}, {HOLIDAYS}, st as (select *, avg(n) over (partition by event_type order by hr rows between 2 preceding and current row) as r3,
  avg(n) over (partition by event_type order by hr rows between 23 preceding and current row) as r24 from grid), t as (select max(hr) + interval 1 hour as t from grid)
select t as hr, event_type, coalesce(max(n) filter (hr = t - interval 1 hour), 0)::double as lag_1, coalesce(max(n) filter (hr = t - interval 2 hour), 0)::double as lag_2,
  coalesce(max(n) filter (hr = t - interval 24 hour), 0)::double as lag_24, coalesce(max(n) filter (hr = t - interval 168 hour), 0)::double as lag_168,
  round(max(r3) filter (hr = t - interval 1 hour), 6) as rolling_mean_3h, round(max(r24) filter (hr = t - interval 1 hour), 6) as rolling_mean_24h,
  hour(t)::int as hour_of_day, (isodow(t) - 1)::int as day_of_week, (isodow(t) >= 6)::int as is_weekend, (cast(t as date) in (select hd from hol))::int as is_holiday,
  (select avg(temperature) from wx where hr = (select max(hr) from wx)) as temperature from st, t group by t, event_type""",
)
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The feature store is a written table; so is the weather it is read with.
    store = materialise(store_features(events_grid(spark, sf_dir), "event_type", "hr", "n"), "store")
    row = next_hour_row(store, materialise(numeric_weather(spark, sf_dir), "weather"), "event_type", "hr", "n")
    return row.select(
        "hr", "event_type", "lag_1", "lag_2", "lag_24", "lag_168", F.round("rolling_mean_3h", 6).alias("rolling_mean_3h"), F.round("rolling_mean_24h", 6).alias("rolling_mean_24h"),
        "hour_of_day", "day_of_week", "is_weekend", "is_holiday", "temperature",
    )


# ---- reports -------------------------------------------------------------------------------------

# Names of the customer segments by label.
SEGMENT_NAMES = {0: "RETAIN", 1: "RE-ENGAGE", 2: "NURTURE", 3: "REWARD", -1: "PAMPER", -2: "UPSELL", -3: "DELIGHT"}


@query(
    "q13_segmentation_report",
    f"""with {LABELLED}, inner_q as (select quantile_cont(monetary, 0.33) as lo, quantile_cont(monetary, 0.66) as hi, quantile_cont(recency::double, 0.5) as r from labelled where outlier = 0),
s as (select l.*, case when outlier <> 0 then outlier when monetary > hi and recency <= r then 3 when monetary > lo then 0 when recency > r then 1 else 2 end as segment from labelled l, inner_q)
select case segment when 0 then 'RETAIN' when 1 then 'RE-ENGAGE' when 2 then 'NURTURE' when 3 then 'REWARD' when -1 then 'PAMPER' when -2 then 'UPSELL' else 'DELIGHT' end as segment,
  count(*) as customers, round(avg(recency), 4) as recency, round(avg(frequency), 4) as frequency, round(avg(monetary) / 100, 4) as monetary_100 from s group by 1""",
)
def q13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by segment: outliers by their own labels, the rest by spend and recency tiers."""
    # Read many times below, so the customer-level tables are written once each.
    customers = materialise(a28(spark, sf_dir), "rfm")
    r = materialise(label_iqr_outliers(customers, "frequency", "monetary", stored=True), "rfm-labelled")
    usual = r.where(F.col("outlier") == 0)
    q = quantile_scalars(usual, ["monetary", "recency"], [0.33, 0.5, 0.66], stored=True)
    low, high = q.getField("monetary_q")[0], q.getField("monetary_q")[2]
    middle = q.getField("recency_q")[1]
    segment = (
        F.when(F.col("outlier") != 0, F.col("outlier"))
        .when((F.col("monetary") > high) & (F.col("recency") <= middle), 3)
        .when(F.col("monetary") > low, 0)
        .when(F.col("recency") > middle, 1)
        .otherwise(2)
    )
    return r.groupBy(recode(segment, SEGMENT_NAMES).alias("segment")).agg(
        F.count("*").alias("customers"), F.round(F.avg("recency"), 4).alias("recency"), F.round(F.avg("frequency"), 4).alias("frequency"),
        F.round(F.avg("monetary") / 100, 4).alias("monetary_100"),
    )


SALES_DIMS = ("segment", "nation", "p_type", "brand", "year")


def level_sums(cells: str, dim: str) -> Column:
    """Array of (dimension, level, s, c): the sums of a row's cells by level of ``dim``; null cells do not count."""

    def total(of: Column, name: str, kind: str) -> Column:
        return F.aggregate(of, F.lit(None).cast(kind), lambda t, x: F.coalesce(t + x[name], t, x[name]))

    def row(level: Column) -> Column:
        of = F.filter(cells, lambda x: x[dim].eqNullSafe(level))
        return F.struct(F.lit(dim).alias("dimension"), level.alias("level"), total(of, "s", "double").alias("s"), total(of, "c", "bigint").alias("c"))

    return F.transform(F.array_distinct(F.transform(cells, lambda x: x[dim])), row)


@query(
    "q14_sales_overview",
    """with s as (select l_orderkey, l_extendedprice, p_type, p_brand as brand, c_mktsegment as segment, n_name as nation, year(o_orderdate)::varchar as year, o_custkey
  from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey) """
    + " union all ".join(
        f"select '{d}' as dimension, {d} as level, round(sum(l_extendedprice), 2) as sales, count(*) as lines, count(distinct l_orderkey) as orders, round(sum(l_extendedprice) / count(distinct l_orderkey), 4) as asp from s group by {d}"
        for d in SALES_DIMS
    ),
)
def q14(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = attach(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"),
        table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand"), "l_partkey", "p_partkey", ["brand", "p_type"], "inner",
    )
    # One row per (order, type, brand) before the order's attributes join in.
    leaf = lines.groupBy("l_orderkey", "p_type", "brand").agg(F.sum("l_extendedprice").alias("s"), F.count("*").alias("c"))
    people = attach(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment")),
        table(spark, sf_dir, "nation").withColumnRenamed("n_name", "nation"), "c_nationkey", "n_nationkey", ["nation"], "inner",
    )
    orders = attach(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("string").alias("year")), people, "o_custkey", "c_custkey", ["segment", "nation"], "inner")
    rich = attach(leaf, orders, "l_orderkey", "o_orderkey", ["segment", "nation", "year"], "inner")
    # An order's cells (one per type and brand) stand in one row: its levels are summed there, no group per order and level is kept.
    per = rich.groupBy("l_orderkey").agg(F.collect_list(F.struct("s", "c", *SALES_DIMS)).alias("cells"))
    per_order = per.select(F.inline(F.concat(*[level_sums("cells", d) for d in SALES_DIMS])))
    return per_order.groupBy("dimension", "level").agg(
        F.round(F.sum("s"), 2).alias("sales"), F.sum("c").alias("lines"), F.count("*").alias("orders"), F.round(F.sum("s") / F.count("*"), 4).alias("asp")
    )


@query(
    "q15_event_rate_profile",
    """with e as (select event_type, hour(ts)::varchar as h, (isodow(ts) - 1)::varchar as w, case when isodow(ts) >= 6 then 'weekend' else 'weekday' end as we, user_id from events), t as (select count(*) as t from e),
u as (select user_id, count(*) as n from e group by 1)
select 'type' as block, event_type as level, round(100.0::double * count(*) / any_value(t), 6) as value from e, t group by all
union all select 'hour', h, round(100.0::double * count(*) / any_value(t), 6) from e, t group by h
union all select 'weekday', w, round(100.0::double * count(*) / any_value(t), 6) from e, t group by w
union all select 'weekend', we, round(100.0::double * count(*) / any_value(t), 6) from e, t group by we
union all select 'users', 'busy', round(avg((n >= 60)::int), 6) from u union all select 'users', 'quiet', round(avg((n < 60)::int), 6) from u""",
)
def q15(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_type", "ts", "user_id")
    base = ev.groupBy("event_type", F.hour("ts").cast("string").alias("h"), F.weekday("ts").alias("w")).agg(F.count("*").alias("c"))
    total = ev.agg(F.count("*").alias("t")).scalar()
    cells = F.array(
        F.struct(F.lit("type").alias("block"), F.col("event_type").alias("level")),
        F.struct(F.lit("hour").alias("block"), F.col("h").alias("level")),
        F.struct(F.lit("weekday").alias("block"), F.col("w").cast("string").alias("level")),
        F.struct(F.lit("weekend").alias("block"), F.when(F.col("w") >= 5, "weekend").otherwise("weekday").alias("level")),
    )
    shares = base.select("c", F.inline(cells)).groupBy("block", "level").agg(F.round(100.0 * F.sum("c") / total, 6).alias("value"))
    busy = ev.groupBy("user_id").agg((F.count("*") >= 60).cast("int").alias("b")).agg(F.avg("b").alias("b"), F.avg(1 - F.col("b")).alias("q"))
    users = busy.select(F.inline(F.array(
        F.struct(F.lit("users").alias("block"), F.lit("busy").alias("level"), F.round("b", 6).alias("value")),
        F.struct(F.lit("users").alias("block"), F.lit("quiet").alias("level"), F.round("q", 6).alias("value")),
    )))
    return shares.unionByName(users)


METRICS_SQL = """count(*) as n, round(avg(abs(a - p)), 6) as mae, round(avg((a - p) * (a - p)), 6) as mse, round(sqrt(avg((a - p) * (a - p))), 6) as rmse,
  round(1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)), 6) as r2, round(100 * avg(abs((a - p) / a)) filter (a <> 0), 6) as mape,
  round(100 * avg(2 * abs(a - p) / (abs(a) + abs(p))) filter (abs(a) + abs(p) <> 0), 6) as smape"""

METRIC_COLS = ("mae", "mse", "rmse", "r2", "mape", "smape")


@query(
    "q16_baseline_report",
    f"""with {MART}, s as (select event_type, target as a, lag_1 as p from ready where hr >= timestamp '2024-01-22')
select event_type, {METRICS_SQL} from s group by 1""",
)
def q16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mart to held-out error per key for the previous-step baseline."""
    test = mart(spark, sf_dir).where("hr >= timestamp_ntz'2024-01-22'")
    scored = PreviousStep(inputCol="lag_1", outputCol="prediction").transform(test)
    m = regression_metrics(scored, "target", "prediction", ["event_type"])
    return m.select("event_type", "n", *[F.round(c, 6).alias(c) for c in METRIC_COLS])
