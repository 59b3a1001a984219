from __future__ import annotations

import datetime as dt
import random
import subprocess
import sys
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import readers as R
from ledgerline.sources import writers as Wr
from ledgerline.sources.stores import KeyedStore
from ledgerline.streaming import jobs as J
from ledgerline.tables import shared_folder


ROOT = Path(__file__).resolve().parents[1]


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_zip_needs_exactly_one_csv(spark, tmp_path):
    for i in range(2):
        with zipfile.ZipFile(tmp_path / f"good{i}.zip", "w") as z:
            z.writestr("d/rows.csv", f"a,b\n{i},x\n{i + 10},\n")
            z.writestr("notes.txt", "no")
    rows = R.unzip_csv(R.read_archives(spark, str(tmp_path)), "a int, b string", ["a", "b"]).collect()
    assert sorted((r["a"], r["b"]) for r in rows if r["b"]) == [(0, "x"), (1, "x")] and len(rows) == 4
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("one.csv", "a,b\n")
        z.writestr("two.csv", "a,b\n")
    with pytest.raises(Exception, match="expected one CSV, found 2"):
        R.unzip_csv(R.read_archives(spark, str(tmp_path)), "a int, b string", ["a", "b"]).collect()


def test_run_tree(spark, tmp_path):
    for run, mae in (("r1", 0.5), ("r2", 0.4)):
        for kind, name, body in (("metrics", "mae", f"1744700000 {mae} 0\n"), ("params", "depth", "7\n")):
            d = tmp_path / "exp1" / run / kind
            d.mkdir(parents=True, exist_ok=True)
            (d / name).write_text(body)
        (tmp_path / "exp1" / run / "meta.yaml").write_text("name: x\n")
    runs = R.wide_runs(R.read_run_logs(spark, str(tmp_path)), ["mae"], ["depth"])
    assert {(r["run"], r["mae"], r["depth"]) for r in runs.collect()} == {("r1", 0.5, "7"), ("r2", 0.4, "7")}
    assert R.best_run(runs, "mae").first()["run"] == "r2"


ROWS = "k int, v int, x string, day string"


def store_at(spark, path, **more):
    return KeyedStore(spark, str(path), ["k"], ["v"], "day", **more)


def sorted_rows(df):
    return sorted(tuple(r)[:3] for r in df.collect())


def test_merge_is_idempotent_and_newest_wins(spark, tmp_path):
    store = store_at(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.merge(spark.createDataFrame([(1, 1, "a", "mon"), (2, 1, "b", "tue")], ROWS), 1)
    second = spark.createDataFrame([(2, 2, "c", "tue"), (3, 1, "d", "a/b=c %"), (1, 0, "old", "mon")], ROWS)
    assert store.merge(second, 2)
    assert not store.merge(second, 2)
    assert sorted_rows(store.read()) == [(1, 1, "a"), (2, 2, "c"), (3, 1, "d")]
    assert sorted_rows(store.read(version=1)) == [(1, 1, "a"), (2, 1, "b")]
    assert sorted_rows(store.read(parts=["a/b=c %", "none"])) == [(3, 1, "d")]
    assert not store.merge(second.limit(0), 2)
    assert store.merge(second.limit(0), 3)
    assert sorted_rows(store.read()) == [(1, 1, "a"), (2, 2, "c"), (3, 1, "d")]
    with pytest.raises(ValueError, match="columns"):
        store.merge(second.drop("x"), 4)
    with pytest.raises(ValueError, match="keys"):
        KeyedStore(spark, str(tmp_path), ["v"], ["k"])
    with pytest.raises(FileNotFoundError):
        KeyedStore(spark, str(tmp_path / "nothing"))


def test_only_touched_partitions_change_and_compaction(spark, tmp_path):
    store = store_at(spark, tmp_path, most_pieces=3)
    store.merge(spark.createDataFrame([(i, 0, "x", f"d{i % 4}") for i in range(40)], ROWS))
    before = store.manifest()["parts"]
    for v in (1, 2):
        store.merge(spark.createDataFrame([(1, v, "y", "d1")], ROWS))
    after = store.manifest()["parts"]
    assert {p for p in after if after[p] != before[p]} == {"d1"}
    assert len(after["d1"]) == 3
    store.merge(spark.createDataFrame([(5, 9, "z", "d1")], ROWS))
    assert {p: len(x) for p, x in store.manifest()["parts"].items()} == {"d0": 1, "d1": 1, "d2": 1, "d3": 1}
    rows = {r["k"]: (r["v"], r["x"]) for r in store.read().collect()}
    assert len(rows) == 40
    assert (rows[1], rows[5], rows[9]) == ((2, "y"), (9, "z"), (0, "x"))


def test_death_before_the_manifest_leaves_the_old_version(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.merge(spark.createDataFrame([(1, 1, "a", "mon")], ROWS), 1)
    batch = spark.createDataFrame([(1, 2, "b", "mon"), (2, 1, "c", "tue")], ROWS)

    def die():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        store.merge(batch, 2, before_commit=die)
    assert sorted_rows(store_at(spark, tmp_path).read()) == [(1, 1, "a")]
    assert store_at(spark, tmp_path).merge(batch, 2)
    assert sorted_rows(store.read()) == [(1, 2, "b"), (2, 1, "c")]
    # A second writer that began from the same version is refused.
    with pytest.raises(RuntimeError, match="first"):
        store.merge(batch, 3, before_commit=lambda: store_at(spark, tmp_path).merge(batch, 3))
    assert store.manifest()["version"] == 3


def test_another_process_reads_merges_and_replays(spark, tmp_path):
    """A new Python process with a session of its own opens the store by its path alone."""
    store = store_at(spark, tmp_path)
    store.merge(spark.createDataFrame([(1, 1, "a", "mon"), (2, 1, "b", "tue")], ROWS), 1)
    code = f"""
import sys
sys.path[:0] = {[str(ROOT), str(ROOT / "tools")]!r}
from check import session
from ledgerline.sources.stores import KeyedStore
spark = session(2)
store = KeyedStore(spark, {str(tmp_path)!r})
assert sorted(tuple(r) for r in store.read().collect()) == [(1, 1, "a", "mon"), (2, 1, "b", "tue")]
batch = spark.createDataFrame([(2, 5, "new", "tue")], {ROWS!r})
assert not store.merge(batch, 1)
assert store.merge(batch, 2)
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    assert sorted_rows(store.read()) == [(1, 1, "a"), (2, 5, "new")]
    assert not store.merge(spark.createDataFrame([(2, 5, "new", "tue")], ROWS), 2)


def test_backfill_runs_only_what_is_missing(spark, tmp_path):
    df = spark.createDataFrame([(i, f"m{i % 3}") for i in range(9)], "id int, month string")
    path = str(tmp_path / "store")
    df.where("month = 'm1'").write.partitionBy("month").parquet(path)
    assert Wr.backfill_missing(df, "month", path, lambda d: d) == ["m0", "m2"]
    assert Wr.backfill_missing(df, "month", path, lambda d: d) == []
    assert spark.read.parquet(path).count() == 9


def test_fill_missing_builds_only_new_rows(spark, tmp_path):
    built = []

    def build(rows):
        built.append(rows.count())
        return rows.select("id", (F.col("id") * 2).alias("y"))

    path = str(tmp_path / "cache")
    build(spark.range(4)).write.parquet(path)
    out = Wr.fill_missing(spark.range(10), path, ["id"], build)
    assert built == [4, 6] and sorted(r["y"] for r in out.collect()) == [2 * i for i in range(10)]


def test_monthly_folders_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1 + i % 3, 15)) for i in range(9)], "id int, ts timestamp_ntz")
    Wr.write_monthly(df, "ts", str(tmp_path / "m"))
    one = spark.read.schema("id int, month string").parquet(str(tmp_path / "m")).where("month = '2024-02'")
    assert sorted(r["id"] for r in one.collect()) == [1, 4, 7]
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()


def test_pinned_schema(spark, tmp_path):
    Wr.write_parquet(spark.createDataFrame([(1, 2.0, "x")], "a long, b double, junk string"), str(tmp_path / "p"), "b float, a tinyint")
    assert spark.read.parquet(str(tmp_path / "p")).dtypes == [("b", "float"), ("a", "tinyint")]


def test_replayed_batch_changes_nothing(spark):
    store = J.BatchStore(spark, ["k"])
    a, b = spark.createDataFrame([(1, "old"), (2, "x")], "k int, v string"), spark.createDataFrame([(1, "new")], "k int, v string")
    store.write(a, 0)
    store.write(b, 1)
    store.write(a, 0)
    assert sorted(tuple(r) for r in store.read().collect()) == [(1, "new"), (2, "x")]


EVENTS = "id long, ts timestamp_ntz, v string"


def arrive(spark, path, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_late_rows_are_those_the_engine_drops(spark, tmp_path):
    """Eight files in two runs, one a batch: all rows are in one of the two tables, the late ones as they came."""
    r, start, path = random.Random(1), dt.datetime(2024, 1, 1), str(tmp_path / "landing")
    on_time, late = (KeyedStore(spark, str(tmp_path / n), ["id"], ["ts"]) for n in ("on-time", "late"))
    schema, rows, dropped = spark.createDataFrame([], EVENTS).schema, {}, []
    for run in range(2):
        for wave in range(4):
            new = [(len(rows) + i, start + dt.timedelta(hours=(run * 4 + wave) * 10 + r.uniform(0, 10) - (r.uniform(0, 60) if r.random() < 0.4 else 0)), f"v{i}") for i in range(50)]
            rows |= {x[0]: x for x in new}
            arrive(spark, path, new)
        dropped.append(J.route_late(spark, path, schema, "ts", "id", "5 hours", on_time, late, str(tmp_path / "progress"), 1))
    kept, gone = ({x["id"]: tuple(x) for x in s.read().collect()} for s in (on_time, late))
    assert min(dropped) > 0
    assert len(gone) == sum(dropped)
    assert kept | gone == rows
    assert not set(kept) & set(gone)


def test_state_expires_behind_the_watermark(spark, tmp_path):
    start, path = dt.datetime(2024, 1, 1), str(tmp_path / "landing")
    schema = spark.createDataFrame([], EVENTS).schema
    for day in range(6):
        arrive(spark, path, [(day * 24 + h, start + dt.timedelta(days=day, hours=h), "a") for h in range(24)])
    stream = J.event_time(J.read_stream(spark, path, schema, 1), "ts")
    store = J.BatchStore(spark, ["hr", "v"], path=str(tmp_path / "store"))
    query = J.drain_batches(J.hourly_counts(stream, "ts", "v", "6 hours"), store.write)
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress]
    assert max(held) <= 24 + 7 and held[-1] <= 7
    assert store.read().count() == 144


def test_lags_from_raw_events_in_any_order_within_the_delay(spark, tmp_path):
    """Files swapped within the delay and keys with silent hours: the same lags as on the dense batch grid."""
    r, start, path = random.Random(2), dt.datetime(2024, 1, 1), str(tmp_path / "landing")
    rows = [(i, start + dt.timedelta(hours=r.uniform(0, 72)), "a" if r.random() < 0.9 else "b") for i in range(400)] + [(1000, start + dt.timedelta(hours=76), "a")]
    for part in (1, 0, 3, 2, 5, 4, 6):
        arrive(spark, path, [x for x in rows if (x[1] - start) // dt.timedelta(hours=12) == part])
    stream = J.event_time(J.read_stream(spark, path, spark.createDataFrame([], EVENTS).schema, 1), "ts")
    with J.rocks_state(spark):
        got = J.local_time(J.drain(J.hour_lags(stream, "ts", "v", [1, 5], "25 hours")), "hr").collect()
    counts = {}
    for _, ts, v in rows:
        hour = (ts - start) // dt.timedelta(hours=1)
        counts[v, hour] = counts.get((v, hour), 0) + 1
    want, last = set(), 76 - 25
    for v in "ab":
        first = min(h for k, h in counts if k == v)
        for h in range(first, last):
            want.add((start + dt.timedelta(hours=h), v, counts.get((v, h), 0), *[float(counts.get((v, h - k), 0)) if h - k >= first else None for k in (1, 5)]))
    assert {tuple(x) for x in got} == want
