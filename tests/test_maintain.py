"""Chunked tables changed in place, late data repaired through the log, and the tables that streams write."""

import os
import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattline.operators import rollups as R
from wattline.plans import inputs as I
from wattline.sinks import maintain as M
from wattline.sinks import tables as K
from wattline.streaming import jobs as J

SF = "/root/testdata/sf0.001"
START = datetime(2023, 1, 5)  # first day of a chunk
READINGS = "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string"


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if not any(x.startswith("_") for x in p.relative_to(path).parts)}


def weekly(spark, weeks=5, meters=3):
    rows = [(START + timedelta(days=7 * w, hours=h), f"m{m}", float(w * 100 + h), h % 5 == 0, None if m == 0 else "s") for w in range(weeks) for h in range(30) for m in range(meters)]
    return spark.createDataFrame(rows, READINGS)


def content(df, columns=("time", "meter_id", "kwh", "is_anomaly", "source")):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "facts")
    K.write_readings(weekly(spark), path)
    return path


def test_replacing_a_slice_leaves_other_chunks_alone(spark, table):
    before, rows = files_of(table), weekly(spark)
    lo, hi = START + timedelta(days=7), START + timedelta(days=14, hours=3)
    stored = spark.read.parquet(table).filter((F.col("time") >= lo) & (F.col("time") < hi) & (F.col("source") == "s"))
    written = M.replace_in_place(spark, table, stored.withColumn("kwh", F.col("kwh") * 2), lo, hi, F.col("source") == "s")
    assert written == [date(2023, 1, 12), date(2023, 1, 19)]
    inside = (F.col("time") >= lo) & (F.col("time") < hi) & F.coalesce(F.col("source") == "s", F.lit(False))
    want = rows.withColumn("kwh", F.when(inside, F.col("kwh") * 2).otherwise(F.col("kwh")))
    assert content(spark.read.parquet(table)) == content(want)
    after = files_of(table)
    kept = {name: at for name, at in before.items() if not name.startswith(("time_chunk=2023-01-12", "time_chunk=2023-01-19"))}
    assert kept and kept.items() <= after.items()
    assert not [name for name in os.listdir(table) if name.startswith("_") and name != "_SUCCESS"]


def test_replacing_by_key_only_and_emptying_a_chunk(spark, table):
    gone = M.replace_in_place(spark, table, weekly(spark).limit(0), condition=F.col("time") >= START + timedelta(days=28))
    assert gone == [date(2023, 2, 2)] and date(2023, 2, 2) not in M.chunks_of(spark, table)
    M.replace_in_place(spark, table, weekly(spark).limit(0), condition=F.col("meter_id") == "m1")
    assert content(spark.read.parquet(table)) == content(weekly(spark, 4).filter("meter_id <> 'm1'"))
    assert M.replace_in_place(spark, table, weekly(spark).limit(0), condition=F.col("meter_id") == "never") == []


def test_replacing_into_an_empty_place(spark, tmp_path):
    path = str(tmp_path / "new")
    assert len(M.replace_in_place(spark, path, weekly(spark))) == 5
    assert content(spark.read.parquet(path)) == content(weekly(spark))


def test_columns_that_the_new_rows_lack_stay(spark, table):
    M.replace_in_place(spark, table, weekly(spark, 1).select("time", "meter_id", "kwh"), START, START + timedelta(days=2))
    got = spark.read.parquet(table)
    assert set(got.columns) == {"time", "meter_id", "kwh", "is_anomaly", "source", "time_chunk"}
    assert got.filter("source = 's'").count() > 200 and got.count() == 450


@pytest.mark.parametrize("step", ["write", "delete"])
def test_a_replacement_that_failed_is_ended(spark, table, monkeypatch, step):
    real_recover, real_delete = M.recover, M.delete

    def failing(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(M, "recover" if step == "write" else "delete", failing)
    if step == "write":
        monkeypatch.setattr(M, "recover", lambda spark, path: failing() if (Path(path) / M.NOTE).exists() else False)
    new = weekly(spark, 1).withColumn("kwh", F.lit(-1.0))
    condition = F.col("time") < START + timedelta(days=9)
    with pytest.raises(RuntimeError):
        M.replace_in_place(spark, table, new, condition=condition)
    monkeypatch.setattr(M, "recover", real_recover)
    monkeypatch.setattr(M, "delete", real_delete)
    assert (Path(table) / M.NOTE).exists()
    assert M.recover(spark, table) and not M.recover(spark, table)
    want = weekly(spark).filter(~condition).unionByName(new)
    assert content(spark.read.parquet(table)) == content(want)


def test_expired_chunks_go_as_folders(spark, table):
    before = files_of(table)
    gone = M.drop_expired(spark, table, 10, START + timedelta(days=24, hours=1))
    assert gone == [date(2023, 1, 5), date(2023, 1, 12)]
    assert files_of(table) == {name: at for name, at in before.items() if not name.startswith(("time_chunk=2023-01-05", "time_chunk=2023-01-12"))}
    assert M.drop_expired(spark, table, 10, START + timedelta(days=24, hours=1)) == []


def test_refresh_in_place_equals_the_refresh_of_a_frame(spark, tmp_path):
    raw = I.readings(spark, SF)
    full = R.rollup(raw, "1 hour")
    path = str(tmp_path / "hourly")
    stale = full.withColumn("kwh_total", F.lit(-1.0))
    K.write_fact(stale, path, ["meter_id"], time="bucket")
    before = files_of(path)
    lo, hi = datetime(2024, 1, 5, 0, 30), datetime(2024, 1, 9, 12, 30)
    written = M.refresh_in_place(spark, path, raw, "1 hour", lo, hi)
    assert content(spark.read.parquet(path), full.columns) == content(R.refresh_rollup(stale, raw, "1 hour", lo, hi), full.columns)
    kept = {n: at for n, at in before.items() if not any(n.startswith(f"time_chunk={c}") for c in written)}
    assert kept and kept.items() <= files_of(path).items()
    assert M.refresh_in_place(spark, path, raw, "1 hour", lo, lo + timedelta(minutes=40)) == []
    M.refresh_in_place(spark, path, raw, "1 hour")
    assert content(spark.read.parquet(path), full.columns) == content(full, full.columns)
    M.replace_in_place(spark, path, stale, time="bucket")
    now = datetime(2024, 1, 20, 12, 30)
    M.scheduled_refresh_in_place(spark, path, raw, "1 hour", now)
    assert content(spark.read.parquet(path), full.columns) == content(R.scheduled_refresh(stale, raw, "1 hour", now), full.columns)


@pytest.mark.parametrize(("lo", "first"), [(datetime(2024, 1, 5), datetime(2024, 1, 5)), (datetime(2024, 1, 5, 0, 0, 1), datetime(2024, 1, 6))])
def test_only_whole_buckets_are_covered(lo, first):
    assert M.covered_range("1 day", lo, lo) == (first, datetime(2024, 1, 5))
    assert M.covered_range("1 day", None, None) == (None, None)


def run_batches(spark, parts, out, logs=(), merge=64, run="run-a", first=0):
    write = J.ingest_writer(out, f"{out}-rejected", lambda spark: run, logs, merge)
    for i, part in enumerate(parts, first):
        write(K.to_messages(part).select("value"), i)


def test_refresh_of_touched_buckets_equals_batch_in_any_order_of_arrival(spark, tmp_path):
    out, hourly, daily = (str(tmp_path / n) for n in ("raw", "hourly", "daily"))
    logs = [f"{hourly}-log", f"{daily}-log"]
    rows = I.readings(spark, SF).collect()
    random.Random(4).shuffle(rows)
    parts = [spark.createDataFrame(rows[i::4], READINGS) for i in range(4)]
    for i, part in enumerate(parts):
        run_batches(spark, [part], out, logs, first=i)
        if i != 1:  # two batches are repaired by one refresh
            raw = spark.read.parquet(out)
            M.refresh_touched(spark, hourly, logs[0], raw, "1 hour")
            M.refresh_touched(spark, daily, logs[1], raw, "1 day", datetime(2024, 1, 20, 5))
    raw = I.readings(spark, SF)
    for path, width, bound in ((hourly, "1 hour", None), (daily, "1 day", "2024-01-20")):
        want = R.rollup(raw, width)
        want = want if bound is None else want.filter(F.col("bucket") < F.lit(bound).cast("timestamp"))
        near = [F.round(c, 6).alias(c) if c in ("kwh_total", "kwh_avg") else c for c in want.columns]
        assert content(spark.read.parquet(path), near) == content(want, near)
    # What was held back is still on the log, and nothing else.
    assert M.refresh_touched(spark, hourly, logs[0], spark.read.parquet(out), "1 hour") == []
    left = spark.read.parquet(*[f"{logs[1]}/{n}" for n in M.subfolders(spark, logs[1])])
    assert left.agg(F.min("touched")).first()[0] >= datetime(2024, 1, 20)
    M.refresh_touched(spark, daily, logs[1], spark.read.parquet(out), "1 day")
    assert spark.read.parquet(daily).count() == R.rollup(raw, "1 day").count()


def test_a_late_row_rereads_and_rewrites_its_own_chunk_only(spark, tmp_path):
    out, hourly = str(tmp_path / "raw"), str(tmp_path / "hourly")
    run_batches(spark, [weekly(spark)], out, [f"{hourly}-log"])
    M.refresh_touched(spark, hourly, f"{hourly}-log", spark.read.parquet(out), "1 hour")
    before = files_of(hourly)
    late = spark.createDataFrame([(START + timedelta(days=7, hours=2, minutes=7), "m0", 5.0, False, "s")], READINGS)
    run_batches(spark, [late], out, [f"{hourly}-log"], first=1)
    buckets = spark.createDataFrame([(START + timedelta(days=7, hours=2),)], "bucket timestamp")
    plan = M.touched_rows(spark.read.parquet(out), buckets, "1 hour")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2023-01-12" in plan
    assert "GreaterThanOrEqual(time,2023-01-12" in plan and "LessThan(time,2023-01-12" in plan
    assert M.refresh_touched(spark, hourly, f"{hourly}-log", spark.read.parquet(out), "1 hour") == [date(2023, 1, 12)]
    kept = {n: at for n, at in before.items() if not n.startswith("time_chunk=2023-01-12")}
    assert kept.items() <= files_of(hourly).items()
    assert spark.read.parquet(hourly).filter(F.col("bucket") == START + timedelta(days=7, hours=2)).agg(F.sum("reading_count")).first()[0] == 4


def test_a_new_checkpoint_on_an_old_table_loses_nothing(spark, tmp_path):
    out = str(tmp_path / "raw")
    rows = weekly(spark)
    run_batches(spark, [rows.filter("meter_id = 'm0'"), rows.filter("meter_id = 'm1'")], out)
    run_batches(spark, [rows.filter("meter_id <> 'm1'")], out, run="run-b")
    got = spark.read.parquet(out)
    assert content(got, ("time", "meter_id", "kwh")) == content(rows, ("time", "meter_id", "kwh"))
    assert [name for name in os.listdir(f"{out}-rejected")] == ["run=run-a", "run=run-b"] or len(os.listdir(f"{out}-rejected")) == 2


def test_small_batches_are_merged_and_repeats_add_nothing(spark, tmp_path):
    out = str(tmp_path / "raw")
    rows = [r for r in weekly(spark, 2).collect()]
    parts = [spark.createDataFrame(rows[i::12], READINGS) for i in range(12)]
    run_batches(spark, parts, out, merge=4)
    for chunk in M.chunks_of(spark, out):
        folders = [batch for run in M.subfolders(spark, f"{out}/time_chunk={chunk}") for batch in M.subfolders(spark, f"{out}/time_chunk={chunk}/{run}")]
        assert len(folders) <= 5
    run_batches(spark, parts[-1:], out, first=11, merge=4)  # the last batch again, after its rows were merged
    want = content(weekly(spark, 2), ("time", "meter_id", "kwh"))
    assert content(spark.read.parquet(out), ("time", "meter_id", "kwh")) == want


def test_dual_write_keeps_late_rows_and_drops_stored_ones(spark, tmp_path):
    out = str(tmp_path / "dual")
    rows = weekly(spark)
    write = J.dual_writer(out)
    write(rows.filter("meter_id <> 'm2'"), 0)
    write(rows.filter("meter_id <> 'm0' AND time >= '2023-01-20'"), 1)
    write(rows, 2)  # weeks late
    other = J.dual_writer(out, lambda spark: "run-1")
    other(rows, 0)
    for name in ("readings", "fact_meter_reading"):
        assert spark.read.parquet(f"{out}/{name}").count() == rows.count()
    meters = spark.read.parquet(f"{out}/dim_meter")
    assert meters.count() == meters.select("meter_key").distinct().count() == 3
    assert len(list(Path(f"{out}/dim_meter").glob("run=*/batch_id=*"))) == 2
