"""Streaming jobs ST-01 .. ST-12, each drained to the end and compared with its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import flag
from ledgerline.operators import models as M
from ledgerline.operators.series import lags
from ledgerline.plans.common import ERRORS, GRID, events_grid
from ledgerline.plans.joins import WEATHER, weather
from ledgerline.plans.models import MART_FEATURES, split_mart
from ledgerline.registry import query
from ledgerline.sources.stores import KeyedStore
from ledgerline.streaming import jobs as J
from ledgerline.tables import fresh_path, table

# Rows arrive in this many stretches of time, one after the other; a row may be as late as one stretch is long.
WAVES = 6
DELAY = "6 days"
# Each batch reports the state of every shuffle partition to the driver, so their number must not grow with the input.
MOST_BATCHES = 12


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def arriving(spark: SparkSession, sf_dir: str, files_per_batch: int = 1000) -> DataFrame:
    """The events as a file stream; more files a batch where there would be more than ``MOST_BATCHES``."""
    ev = events(spark, sf_dir)
    path = J.land(ev, "ts", waves=WAVES)
    return J.read_stream(spark, path, ev.schema, max(files_per_batch, -(-J.landed(spark, path) // MOST_BATCHES)))


@query("st01_file_stream", "select * from events")
def st01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.drain(arriving(spark, sf_dir, 2))


def arriving_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files in one batch, whatever their order."""
    ev = events(spark, sf_dir)
    return J.read_stream(spark, J.land(ev, "ts"), ev.schema, 1_000_000)


def clean(df: DataFrame) -> DataFrame:
    """The same rules for batch and stream."""
    typed = df.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
    return typed.where(F.col("event_type").isin("click", "view", "purchase", "signup") & F.col("value").between(0, 20) & F.col("k").isNotNull()).select(
        "event_id", "ts", "event_type", F.col("value").cast("float").cast("double").alias("value"), "k"
    )


@query(
    "st02_stream_cleaning",
    """select event_id, ts, event_type, value::float::double as value, (props->>'k')::int as k from events
where event_type in ('click', 'view', 'purchase', 'signup') and value between 0 and 20 and (props->>'k') is not null""",
)
def st02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.drain(clean(arriving(spark, sf_dir)))


@query("st03_hourly_counts", "select date_trunc('hour', ts) as hr, event_type, count(*) as n from events group by all")
def st03(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = J.BatchStore(spark, ["hr", "event_type"])
    J.drain_batches(J.hourly_counts(J.event_time(arriving(spark, sf_dir, 2), "ts"), "ts", "event_type", DELAY), store.write)
    return J.local_time(store.read(), "hr")


LATE = """with w as (select event_id, ts, event_type, value, (event_id % 10 = 0 and ts < timestamp '2024-01-25') as second from events),
m as (select max(ts) - interval 2 day as mark from w where not second), r as (select w.*, second and date_trunc('milliseconds', ts) <= date_trunc('milliseconds', mark) as late from w, m)"""


def late_rows(spark: SparkSession, sf_dir: str) -> tuple[KeyedStore, KeyedStore]:
    """A tenth of the rows arrive in a second wave; those behind the watermark go to a table of their own."""
    ev = events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    second = (F.col("event_id") % 10 == 0) & (F.col("ts") < F.expr("timestamp_ntz'2024-01-25'"))
    path, progress = J.land(ev.where(~second), "ts"), fresh_path(spark, "progress")
    on_time, late = (KeyedStore(spark, fresh_path(spark, n), ["event_id"], ["ts"], "date_format(ts, 'yyyy-MM-dd')") for n in ("on-time", "late"))
    for wave in (None, ev.where(second)):
        if wave is not None:
            J.land(wave, "ts", path)
        J.route_late(spark, path, ev.schema, "ts", "event_id", "2 days", on_time, late, progress, 1000)
    return on_time, late


@query("st04_late_rows", f"{LATE} select date_trunc('hour', ts) as hr, event_type, count(*) filter (not late) as on_time, count(*) filter (late) as late from r group by all")
def st04(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_time, late = late_rows(spark, sf_dir)
    both = on_time.read().withColumn("late", F.lit(False)).unionByName(late.read().withColumn("late", F.lit(True)))
    return both.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hr"), "event_type").agg(F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late"))


@query("st04_late_table", f"{LATE} select event_id, ts, event_type, value from r where late")
def st04_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_rows(spark, sf_dir)[1].read()


@query("st05_stream_dedupe", "select event_id, ts, event_type, value from events")
def st05(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    path = J.land(ev, "ts")
    J.land(ev, "ts", path)
    stream = J.event_time(J.read_stream(spark, path, ev.schema), "ts")
    return J.local_time(J.drain(J.dedupe(stream, "ts", ["event_id"], DELAY)), "ts")


@query(
    "st06_stream_static_join",
    f"with {GRID}, {WEATHER} select event_id, e.ts, event_type, temperature, humidity from events e left join weather w on date_trunc('hour', e.ts) = w.hr",
)
def st06(spark: SparkSession, sf_dir: str) -> DataFrame:
    wet = weather(spark, sf_dir).select("hr", "temperature", "humidity")
    stream = arriving(spark, sf_dir).withColumn("hr", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    # One weather row per calendar hour.
    return J.drain(stream.join(F.broadcast(wet), "hr", "left").select("event_id", "ts", "event_type", "temperature", "humidity"))


@query("st07_stream_upsert", "select date_trunc('hour', ts) as hr, event_type, event_id, ts, value from events qualify row_number() over (partition by date_trunc('hour', ts), event_type order by ts desc, event_id desc) = 1")
def st07(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = arriving(spark, sf_dir, 2).select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hr"), "event_type", "event_id", "ts", "value")
    store = J.BatchStore(spark, ["hr", "event_type"], ["ts", "event_id"], part="date_format(hr, 'yyyy-MM-dd')")
    J.drain_batches(stream, store.write, "append")
    return store.read()


SLIDING = """with s as (select unnest(list_transform(range(1, {hours} + 1), lambda h: date_trunc('hour', ts) + h * interval 1 hour)) as until, event_type, value from events)
select until, event_type, round(count(*) / {hours}.0::double, 6) as hourly_mean, {value} from s group by all"""


def sliding_means(spark: SparkSession, sf_dir: str, hours: int) -> DataFrame:
    store = J.BatchStore(spark, ["until", "event_type"], part="date_format(until, 'yyyy-MM-dd')")
    stream = J.event_time(arriving(spark, sf_dir, 1000), "ts")
    J.drain_batches(J.sliding_counts(stream, "ts", "event_type", f"{hours} hours", "1 hour", DELAY), store.write)
    return J.local_time(store.read(), "until").withColumn("hourly_mean", F.round(F.col("n") / float(hours), 6))


@query("st08_sliding_means", SLIDING.format(hours=3, value="round(avg(value), 6) as mean_value"))
def st08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_means(spark, sf_dir, 3).select("until", "event_type", "hourly_mean", F.round(F.col("total") / F.col("n"), 6).alias("mean_value"))


@query("st08_sliding_means_24h", SLIDING.format(hours=24, value="round(sum(value), 4) as total"))
def st08_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_means(spark, sf_dir, 24).select("until", "event_type", "hourly_mean", F.round("total", 4).alias("total"))


@query(
    "st09_stateful_lags",
    """with c as (select date_trunc('hour', ts) as hr, event_type, count(*) as n from events group by all), r as (select event_type, min(hr) as lo from c group by 1),
g as (select event_type, unnest(generate_series(lo, (select max(hr) - interval 3 hour from c), interval 1 hour)) as hr from r), d as (select g.hr, g.event_type, coalesce(n, 0)::bigint as n from g left join c using (hr, event_type))
select hr, event_type, n, lag(n, 1) over w::double as lag_1, lag(n, 2) over w::double as lag_2, lag(n, 24) over w::double as lag_24 from d window w as (partition by event_type order by hr)""",
)
def st09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events in, lags out. An hour is emitted once the watermark, two hours behind the newest event, has passed it."""
    stream = J.event_time(arriving_at_once(spark, sf_dir), "ts")
    with J.rocks_state(spark):
        out = J.drain(J.hour_lags(stream, "ts", "event_type", [1, 2, 24], "2 hours"))
    return J.local_time(out, "hr")


@query("st10_stream_scoring")
def st10(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split_mart(spark, sf_dir)
    model = M.fit(M.linear("target", regParam=0.1), train, MART_FEATURES)
    stream = J.read_stream(spark, J.land(test, "hr"), test.schema)
    return J.drain(model.transform(stream).select("hr", "event_type", F.round(F.greatest("prediction", F.lit(0.0)), 0).cast("int").alias("predicted")))


@query(
    "st11_online_error_alarm",
    f"""with {ERRORS}, o as (select avg(abs_error) as offline from err where hr < timestamp '2024-01-15'), h as (select hr, avg(abs_error) as mae from err where hr >= timestamp '2024-01-15' group by 1)
select hr, round(mae, 6) as mae, mae > 1.2 * offline as alarm from h, o""",
)
def st11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts and counts arrive as two streams and meet by hour; errors are compared with the offline error."""
    grid = lags(events_grid(spark, sf_dir), "event_type", "hr", "n", [1]).where(F.col("lag_1").isNotNull())
    forecasts = grid.select(F.col("hr").cast("timestamp"), "event_type", F.col("lag_1").alias("predicted"))
    actuals = grid.select(F.col("hr").cast("timestamp").alias("at"), "event_type", F.col("n").alias("actual"))
    p = J.read_stream(spark, J.land(forecasts, "hr"), forecasts.schema)
    a = J.read_stream(spark, J.land(actuals, "at"), actuals.schema)
    err = J.local_time(J.drain(J.match_actuals(p, a, "event_type", DELAY)), "hr")
    cut = F.expr("timestamp_ntz'2024-01-15'")
    offline = err.where(F.col("hr") < cut).agg(F.avg("abs_error").alias("v")).scalar()
    per = err.where(F.col("hr") >= cut).groupBy("hr").agg(F.avg("abs_error").alias("m"))
    return per.select("hr", F.round("m", 6).alias("mae"), (F.col("m") > 1.2 * offline).alias("alarm"))


@query(
    "st12_incremental_drift",
    """with e as (select ts < timestamp '2024-01-08' as base, value, (props->>'k')::double as k from events),
m as (select 'value' as metric, avg(value) filter (base) as mb, avg(value) filter (not base) as mn, stddev_samp(value) filter (base) as sb, stddev_samp(value) filter (not base) as sn, count(*) filter (not base) as n from e
  union all select 'k', avg(k) filter (base), avg(k) filter (not base), stddev_samp(k) filter (base), stddev_samp(k) filter (not base), count(k) filter (not base) from e)
select metric, n, round(abs(mn - mb) / abs(mb), 6) as mean_shift, round(abs(sn - sb) / sb, 6) as std_shift, (abs(mn - mb) / abs(mb) > 0.1 or abs(sn - sb) / sb > 0.1)::int as drifted from m""",
)
def st12(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = "ts < timestamp_ntz'2024-01-08'"
    k = F.get_json_object("props", "$.k").try_cast("double").alias("k")
    store = J.BatchStore(spark, ["metric"])
    now = arriving(spark, sf_dir, 2).where(f"not ({base})").select("value", k)
    J.drain_batches(J.running_moments(now, ["value", "k"]), store.write)
    before = J.running_moments(events(spark, sf_dir).where(base).select("value", k), ["value", "k"]).select("metric", F.col("mean").alias("mb"), F.col("std").alias("sb"))
    both = store.read().join(before, "metric")
    mean_shift = F.abs(F.col("mean") - F.col("mb")) / F.abs("mb")
    std_shift = F.abs(F.col("std") - F.col("sb")) / F.col("sb")
    return both.select(
        "metric", "n", F.round(mean_shift, 6).alias("mean_shift"), F.round(std_shift, 6).alias("std_shift"), flag((mean_shift > 0.1) | (std_shift > 0.1)).alias("drifted")
    )
