"""Sources and sinks IO-01 .. IO-14 and the model registry M-37. Files go to the shared folder."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import flag
from ledgerline.operators.corpus import summarise
from ledgerline.operators.series import lags
from ledgerline.operators.features import levels
from ledgerline.plans.common import ERRORS, GRID, baseline_errors, events_grid
from ledgerline.plans.series import GW
from ledgerline.plans.text import SENT, SUMMARY, docs
from ledgerline.registry import query
from ledgerline.sources import readers as R
from ledgerline.sources import writers as Wr
from ledgerline.sources.stores import KeyedStore
from ledgerline.tables import fresh_path, table

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


@query("io01_read_csv", "select * from orders")
def io01(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "orders-csv")
    Wr.write_csv(table(spark, sf_dir, "orders"), path)
    return R.read_csv(spark, path, ORDERS)


@query("io02_read_tsv_sources", "select '\"' || p_name as sentence, p_size as label, lower(p_type) as source from part")
def io02(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "tsv")
    parts = table(spark, sf_dir, "part")
    sources = {}
    for kind in levels(parts, "p_type"):
        sources[kind.lower()] = f"{root}/{kind.lower()}"
        rows = parts.where(F.col("p_type") == kind).select(F.concat_ws("\t", F.concat(F.lit('"'), F.col("p_name")), F.col("p_size").cast("string")))
        rows.write.text(sources[kind.lower()])
    return R.read_tsv_sources(spark, sources, "sentence string, label int")


@query("io03_read_parquet", "select event_id, ts, event_type from events where event_type = 'error'")
def io03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.read_parquet(spark, f"{sf_dir}/events.parquet", ["event_id", "ts", "event_type"]).where(F.col("event_type") == "error")


@query("io04_read_many", "select event_id, event_type, value, strftime(ts, '%Y-%m-%d') as file_day from events")
def io04(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "events-by-day")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    # Spread inside each day, so a day is not one task's work.
    ev.repartition("day", F.hour("ts")).write.partitionBy("day").parquet(root)
    return R.read_many(spark, f"{root}/day=*").select("event_id", "event_type", "value", F.regexp_extract("origin", r"day=([0-9-]+)", 1).alias("file_day"))


def archives(df: DataFrame) -> DataFrame:
    """(path, content): one zip with one CSV per Arrow batch of rows."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for i, pdf in enumerate(batches):
            body = io.BytesIO()
            with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("data/rows.csv", pdf.to_csv(index=False))
                z.writestr("readme.txt", "rows")
            yield pd.DataFrame({"path": [f"batch-{i}.zip"], "content": [body.getvalue()]})

    return df.mapInPandas(pack, "path string, content binary")


@query("io05_read_zip_members", "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders")
def io05(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    archives(table(spark, sf_dir, "orders")).write.parquet(path)
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    return R.unzip_csv(spark.read.parquet(path), "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string", cols)


@query(
    "io06_write_parquet",
    f"with {GRID} select hr, event_type, n::int as ride_count, (isodow(hr) >= 6)::tinyint as is_weekend, lag(n) {GW}::double as lag_1 from grid",
)
def io06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lags(events_grid(spark, sf_dir), "event_type", "hr", "n", [1]).withColumn("is_weekend", flag(F.weekday("hr") >= 5)).withColumnRenamed("n", "ride_count")
    path = fresh_path(spark, "features")
    Wr.write_parquet(rows, path, "hr timestamp_ntz, event_type string, ride_count int, is_weekend tinyint, lag_1 double")
    return spark.read.parquet(path)


@query("io07_write_csv_append", f"with {GRID} select hr, event_type, lag(n) {GW}::int as predicted, 'first' as run from grid union all select hr, event_type, lag(n) {GW}::int, 'second' from grid")
def io07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lags(events_grid(spark, sf_dir), "event_type", "hr", "n", [1]).select("hr", "event_type", F.col("lag_1").cast("int").alias("predicted"))
    path = fresh_path(spark, "predictions-csv")
    for run in ("first", "second"):
        Wr.write_csv(rows.withColumn("run", F.lit(run)), path)
    return R.read_csv(spark, path, "hr timestamp_ntz, event_type string, predicted int, run string")


@query("io08_write_json", f"with {SENT}, whole as (select * from ranked qualify row_number() over (partition by doc_id order by score desc, sent) <= 3) " + SUMMARY.format(t="whole"))
def io08(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "summaries-json")
    Wr.write_json(summarise(table(spark, sf_dir, "documents"), "doc_id", "text", "stuff"), path)
    return spark.read.schema("doc_id bigint, summary string").json(path)


@query("io09_monthly_partitions", "select o_orderkey, o_totalprice, '1996-03' as month from orders where strftime(o_orderdate, '%Y-%m') = '1996-03'")
def io09(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "orders-monthly")
    Wr.write_monthly(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", path)
    # Declared as text: a bare yyyy-MM folder name would otherwise be guessed to be a date.
    back = spark.read.schema("o_orderkey bigint, o_totalprice double, month string").parquet(path)
    return back.where(F.col("month") == "1996-03").select("o_orderkey", "o_totalprice", "month")


@query("io10_monthly_views", "select month(o_orderdate)::int as month, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1")
def io10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "orders-monthly")
    Wr.write_monthly(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", path)
    names = Wr.create_monthly_views(spark.read.schema("o_totalprice double, month string").parquet(path), "orders_month")
    return spark.sql(" union all ".join(f"select {i + 1} as month, count(*) as n, round(sum(o_totalprice), 2) as total from {v}" for i, v in enumerate(names)))


@query(
    "io11_upsert_keep_last",
    f"""with {GRID}, b as (select hr, event_type, n, 1 as version from grid where hr < timestamp '2024-01-20' union all select hr, event_type, n + 1, 2 from grid where hr >= timestamp '2024-01-10')
select * from b qualify row_number() over (partition by hr, event_type order by version desc) = 1""",
)
def io11(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = events_grid(spark, sf_dir)
    path = fresh_path(spark, "features")
    store = KeyedStore(spark, path, ["hr", "event_type"], ["version"], "date_format(hr, 'yyyy-MM-dd')")
    store.merge(grid.where("hr < timestamp_ntz'2024-01-20'").withColumn("version", F.lit(1)))
    late = grid.where("hr >= timestamp_ntz'2024-01-10'").withColumn("n", F.col("n") + 1).withColumn("version", F.lit(2))
    store.merge(late, 2)
    # Another process would open the store by its path; a batch that comes again changes nothing.
    again = KeyedStore(spark, path)
    again.merge(late, 2)
    return again.read()


RUNS = f"""{ERRORS}, runs as (select event_type as experiment, 'week' || week(hr)::varchar as run, avg(abs_error) as mae, sqrt(avg(signed * signed)) as rmse, count(*) as n from err group by 1, 2)"""


def run_files(spark: SparkSession, sf_dir: str) -> str:
    """A run tree on disk: one experiment per event type, one run per week, one small file per number."""
    err = baseline_errors(spark, sf_dir)
    runs = err.groupBy(F.col("event_type").alias("exp"), F.concat(F.lit("week"), F.weekofyear("hr").cast("string")).alias("run")).agg(
        F.avg("abs_error").alias("mae"), F.sqrt(F.avg(F.col("signed") * F.col("signed"))).alias("rmse"), F.count("*").alias("n")
    )

    def metric(name: str):
        return F.struct(F.lit("metrics").alias("kind"), F.lit(name).alias("name"), F.concat(F.lit("1700000000000 "), F.col(name).cast("string"), F.lit(" 0")).alias("value"))

    cells = F.array(metric("mae"), metric("rmse"), F.struct(F.lit("params").alias("kind"), F.lit("n_rows").alias("name"), F.col("n").cast("string").alias("value")))
    root = fresh_path(spark, "runs")
    runs.select("exp", "run", F.inline(cells)).repartition(4, "exp", "run").write.partitionBy("exp", "run", "kind", "name").text(root)
    return root


@query("io12_read_run_logs", f"with {RUNS} select experiment, run, round(mae, 6) as mae, round(rmse, 6) as rmse, n::varchar as n_rows from runs")
def io12(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = R.wide_runs(R.read_run_logs(spark, run_files(spark, sf_dir)), ["mae", "rmse"], ["n_rows"])
    return wide.select("experiment", "run", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"), "n_rows")


@query(
    "m37_registry_best_run",
    f"""with {RUNS} select experiment, run, round(mae, 6) as mae, 'model-' || experiment || '-v2' as latest_model from runs qualify row_number() over (partition by experiment order by mae, run) = 1""",
)
def m37(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best run per experiment, next to the newest model registered for it."""
    best = R.best_run(R.wide_runs(R.read_run_logs(spark, run_files(spark, sf_dir)), ["mae", "rmse"], ["n_rows"]), "mae")
    path = fresh_path(spark, "registry")
    for version in (1, 2):
        rows = best.select("experiment", F.concat_ws("-", F.lit("model"), "experiment", F.lit(f"v{version}")).alias("model"), F.lit(version).alias("version"), F.to_json(F.struct("run", "mae")).alias("metadata"))
        rows.write.mode("append").parquet(path)
    latest = spark.read.parquet(path).groupBy("experiment").agg(F.max_by("model", "version").alias("latest_model"))
    return best.join(latest, "experiment").select("experiment", "run", F.round("mae", 6).alias("mae"), "latest_model")


@query("io13_fill_missing", "select doc_id, length(text)::int as size, case when doc_id % 3 = 0 then 'cached' else 'built' end as made from documents")
def io13(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(made: str):
        return lambda rows: rows.select("doc_id", F.length("text").alias("size"), F.lit(made).alias("made"))

    path = fresh_path(spark, "stage")
    build("cached")(docs(spark, sf_dir).where(F.col("doc_id") % 3 == 0)).write.parquet(path)
    return Wr.fill_missing(docs(spark, sf_dir), path, ["doc_id"], build("built"))


@query("io14_backfill_missing", "select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') as month, case when month(o_orderdate) % 2 = 0 then 'first' else 'backfill' end as run from orders")
def io14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))

    def job(run: str):
        return lambda df: df.select("o_orderkey", "o_totalprice", "month", F.lit(run).alias("run")).repartition("month", F.pmod("o_orderkey", F.lit(8)))

    path = fresh_path(spark, "months")
    job("first")(rows.where(F.month("o_orderdate") % 2 == 0)).write.partitionBy("month").parquet(path)
    Wr.backfill_missing(rows, "month", path, job("backfill"))
    return spark.read.schema("o_orderkey bigint, o_totalprice double, run string, month string").parquet(path)
