"""Structured Streaming forms of the batch jobs.

Sources are file streams with a declared schema, sinks are Parquet folders, and every run uses the
available-now trigger, so a job drains what has arrived and stops. Checkpoints and sinks live in the
shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.sources.stores import Files, KeyedStore
from ledgerline.tables import fresh_path, materialise

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def land(df: DataFrame, ts: str, path: str | None = None, waves: int = 1) -> str:
    """Write rows as arriving files, each holding one stretch of time.

    With ``waves``, that many equal stretches of time arrive one after the other, so that no row is later than a stretch.
    """
    path = path or fresh_path(df.sparkSession, "landing")
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first() if waves > 1 else None
    if span is None or span["lo"] is None:
        df.repartitionByRange(F.col(ts)).write.mode("append").parquet(path)
        return path
    step = (span["hi"] - span["lo"]) / waves
    for k in range(waves):
        rows = df.where(F.col(ts) >= F.lit(span["lo"] + k * step))
        rows = rows.where(F.col(ts) < F.lit(span["lo"] + (k + 1) * step)) if k < waves - 1 else rows
        rows.repartitionByRange(F.col(ts)).write.mode("append").parquet(path)
    return path


def landed(spark: SparkSession, path: str) -> int:
    """Number of files that have arrived."""
    return sum(n.endswith(".parquet") for n in Files(spark, path).names(path))


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks want an instant, the tables hold local time; sessions run in UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def local_time(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def drain(df: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run an append query to the end of the input and read its sink back."""
    spark = df.sparkSession
    path = path or fresh_path(spark, "sink")
    run = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint or fresh_path(spark, "progress"))
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def drain_batches(df: DataFrame, write: Callable[[DataFrame, int], None], mode: str = "update", checkpoint: str | None = None):
    """Run a query whose micro-batches are handed to ``write``; returns the finished query."""
    run = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint or fresh_path(df.sparkSession, "progress"))
    query = run.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class BatchStore:
    """Keyed results of micro-batches in a ``KeyedStore``: a batch that is replayed after a failure changes nothing.

    ``order`` says which row of a key is newest; without it that of the latest batch is.
    """

    def __init__(self, spark: SparkSession, keys: Sequence[str], order: Sequence[str] = ("batch",), path: str | None = None, part: str = "0") -> None:
        self.store = KeyedStore(spark, path or fresh_path(spark, "batches"), keys, order, part)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        self.store.merge(batch.withColumn("batch", F.lit(batch_id).cast("long")), batch_id, "stream")

    def read(self) -> DataFrame:
        return self.store.read().drop("batch")


def hourly_counts(df: DataFrame, ts: str, key: str, delay: str) -> DataFrame:
    """Tumbling hours per key."""
    w = F.window(ts, "1 hour")
    return df.withWatermark(ts, delay).groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("hr"), key, "n")


def sliding_counts(df: DataFrame, ts: str, key: str, size: str, step: str, delay: str) -> DataFrame:
    w = F.window(ts, size, step)
    return df.withWatermark(ts, delay).groupBy(w.alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("w.end").alias("until"), key, "n", "total"
    )


def dedupe(df: DataFrame, ts: str, keys: Sequence[str], delay: str) -> DataFrame:
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def watermarks(query: StreamingQuery) -> dict[int, tuple[datetime, int]]:
    """From the progress of a finished run: the watermark for late rows and the rows dropped by it, by source offset.

    A batch drops what lies at or before the watermark that the batch before it ran with. The first batch of a run
    follows the empty one that ended the run before, which ran with the watermark that the first one reports.
    """
    out: dict[int, tuple[datetime, int]] = {}
    before = None
    for p in query.recentProgress:
        now = datetime.fromisoformat(p.eventTime["watermark"].replace("Z", "+00:00")).replace(tzinfo=None)
        if p.numInputRows:
            out[int(re.search(r"\d+", str(p.sources[0].endOffset))[0])] = before or now, sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        before = now
    return out


def route_late(spark: SparkSession, path: str, schema: StructType, ts: str, key: str, delay: str, on_time: KeyedStore, late: KeyedStore, progress: str, files_per_batch: int) -> int:
    """Drain a landing folder: rows within ``delay`` to one store, rows behind the watermark to another, as they are.

    One query removes repeated keys within the watermark, which is where the engine drops late rows. A second one reads
    the same files in the same batches (it has no state, so its batches are the source's offsets) and keeps what lies
    behind the watermark of each batch, as the first one's progress tells it. Where it finds another number of rows than the engine dropped, it fails. Returns that number.
    """

    def stream() -> DataFrame:
        return event_time(read_stream(spark, path, schema, files_per_batch), ts)

    first = drain_batches(dedupe(stream(), ts, [key], delay), lambda rows, i: on_time.merge(local_time(rows, ts), i, "on time"), "append", f"{progress}/on-time")
    marks = watermarks(first)

    def keep(rows: DataFrame, i: int) -> None:
        mark, dropped = marks[i]
        behind = materialise(local_time(rows.where(F.col(ts) <= F.lit(mark)), ts), "late")
        if (found := behind.count()) != dropped:
            raise RuntimeError(f"batch {i}: the engine dropped {dropped} rows, {found} lie behind {mark}")
        late.merge(behind, i, "late")

    if marks:
        drain_batches(stream(), keep, "append", f"{progress}/late")
    return sum(n for _, n in marks.values())


HOUR_MS = 3_600_000


class HourLags(StatefulProcessor):
    """Lags of an hourly count per key; hours without a row count 0.

    A row comes in once its hour is closed. A timer at the end of the next hour emits every hour that the watermark has
    passed, silent ones included. State per key: the next hour to emit and, in a map, the counts of the hours that a
    lag can still reach; a step reads and writes single entries.
    """

    def __init__(self, key: str, lags: Sequence[int]):
        self.key, self.lags = key, tuple(lags)
        self.columns = ["hr", key, "n", *[f"lag_{k}" for k in self.lags]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.series = handle.getValueState("series", "first long, next long")
        self.counts = handle.getMapState("counts", "hour long", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, after = self.series.get() if self.series.exists() else (None, None)
        for pdf in rows:
            hours = (pd.to_datetime(pdf["hr"]) - pd.Timestamp("1970-01-01")) // pd.Timedelta(hours=1)
            for h, n in zip(hours.tolist(), pdf["n"].tolist(), strict=True):
                self.counts.updateValue((h,), (n,))
                if first is None or h < first:  # only before the first hour is emitted
                    first = after = h
        self.series.update((first, after))
        self.handle.registerTimer((after + 1) * HOUR_MS)
        yield pd.DataFrame(columns=self.columns)

    def _count(self, hour: int) -> int:
        return self.counts.getValue((hour,))[0] if self.counts.containsKey((hour,)) else 0

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (first, hour), settled, out = self.series.get(), timerValues.getCurrentWatermarkInMs(), []
        while (hour + 1) * HOUR_MS <= settled:
            past = [float(self._count(hour - k)) if hour - k >= first else None for k in self.lags]
            out.append((pd.Timestamp(hour * HOUR_MS, unit="ms"), key[0], self._count(hour), *past))
            if self.counts.containsKey((hour - max(self.lags),)):
                self.counts.removeKey((hour - max(self.lags),))
            hour += 1
        self.series.update((first, hour))
        self.handle.registerTimer((hour + 1) * HOUR_MS)
        yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


@contextmanager
def rocks_state(spark: SparkSession):
    """Arbitrary state needs the RocksDB store; the session gets its own setting back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def hour_lags(df: DataFrame, ts: str, key: str, lags: Sequence[int], delay: str) -> DataFrame:
    """Hourly counts of raw events and their lags, in one stream.

    Two stateful steps: the first counts events per hour and lets an hour go when the watermark has passed it; the
    watermark goes on to the second, which keeps one row an hour and key. No key's events meet in one task: the count
    merges before the shuffle.
    """
    w = F.window(ts, "1 hour")
    counts = df.withWatermark(ts, delay).groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("hr"), key, "n")
    schema = f"hr timestamp, {key} string, n long, " + ", ".join(f"lag_{k} double" for k in lags)
    return counts.groupBy(key).transformWithStateInPandas(HourLags(key, lags), outputStructType=schema, outputMode="Append", timeMode="EventTime")


def match_actuals(predictions: DataFrame, actuals: DataFrame, key: str, delay: str) -> DataFrame:
    """Stream-stream join of forecasts and what came, by hour and key."""
    p = predictions.withWatermark("hr", delay)
    a = actuals.withWatermark("at", delay).withColumnRenamed(key, "_k")
    joined = p.join(a, (F.col("hr") == F.col("at")) & (F.col(key) == F.col("_k")))
    return joined.select("hr", key, "predicted", "actual", F.abs(F.col("predicted") - F.col("actual")).alias("abs_error"))


def running_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and deviation of each column so far, as a streaming aggregate over (metric)."""
    cells: Column = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("x")) for c in cols])
    return df.select(F.inline(cells)).groupBy("metric").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.count("x").alias("n"))
