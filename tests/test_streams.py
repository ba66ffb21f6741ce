import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattline.operators import rollups as R
from wattline.operators import star as ST
from wattline.plans import inputs as I
from wattline.session import passing, scratch_path, settled
from wattline.sinks import tables as K
from wattline.sources import readings as SR
from wattline.streaming import jobs as J

SF = "/root/testdata/sf0.001"
START = datetime(2023, 1, 1)


def write_messages(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(m) if isinstance(m, dict) else m for m in messages) + "\n")


def message(hours, meter="m", kwh=1.0, **more):
    return {"timestamp": (START + timedelta(hours=hours)).isoformat() + "Z", "meter_id": meter, "kwh": kwh, **more}


def ingest(spark, tmp_path):
    stream = SR.read_messages(spark, folder=str(tmp_path / "in"))
    J.ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    return spark.read.parquet(str(tmp_path / "out"))


def test_ingest_defaults_duplicates_and_restart(spark, tmp_path):
    write_messages(tmp_path / "in", "1.txt", [message(0), message(0, kwh=1.0), message(1, is_anomaly=True, source="s"), "not json"])
    rows = ingest(spark, tmp_path).orderBy("time").collect()
    assert [(r["is_anomaly"], r["source"]) for r in rows] == [(False, "kafka_live_replay"), (True, "s")]
    # A later run only reads the new file, and still knows the readings of the first run.
    write_messages(tmp_path / "in", "2.txt", [message(1, kwh=1.0), message(2)])
    assert ingest(spark, tmp_path).count() == 3
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out-rejected")).select("value").collect()] == ["not json"]


def test_ingest_keeps_late_readings(spark, tmp_path):
    for name, days in (("1.txt", (0, 10)), ("2.txt", (5, 11, 10)), ("3.txt", (1,))):
        write_messages(tmp_path / "in", name, [message(24 * d) for d in days] + [{"meter_id": "m"}])
        rows = ingest(spark, tmp_path)
    assert rows.count() == rows.select("time", "meter_id").distinct().count() == 5
    assert spark.read.text(str(tmp_path / "out-rejected")).count() == 3


def test_late_rows_are_left_to_the_refresh(spark, tmp_path):
    def run():
        rows = SR.readings_from_messages(SR.read_messages(spark, folder=str(tmp_path / "in")))
        J.rollup_job(rows, "1 hour", str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
        return spark.read.parquet(str(tmp_path / "out"))

    write_messages(tmp_path / "in", "1.txt", [message(h) for h in range(12)])
    first = run()
    # Buckets ending at most three hours before the newest reading are closed.
    assert first.agg(F.max("bucket")).first()[0] == START + timedelta(hours=7) and first.count() == 8
    write_messages(tmp_path / "in", "2.txt", [message(2, kwh=9.0), message(20)])
    second = run()
    assert second.filter(F.col("bucket") == START + timedelta(hours=2)).first()["kwh_total"] == 1.0
    everything = SR.readings_from_messages(spark.read.text(str(tmp_path / "in")))
    fixed = R.refresh_rollup(second, everything, "1 hour", START, START + timedelta(hours=11))
    assert fixed.filter(F.col("bucket") == START + timedelta(hours=2)).first()["kwh_total"] == 10.0


def test_stream_equals_batch_on_closed_buckets(spark, tmp_path):
    J.rollup_job(I.readings_stream(spark, SF), "1 day", str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    got = spark.read.parquet(str(tmp_path / "out"))
    last = I.readings(spark, SF).agg(F.max("time")).first()[0]
    want = R.rollup(I.readings(spark, SF), "1 day").filter(F.col("bucket") + F.expr("INTERVAL 8 DAYS") <= last)
    key = ["bucket", "meter_id", F.round("kwh_total", 6), "kwh_peak", "anomaly_count"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))


def test_dual_write_is_repeatable(spark, tmp_path):
    out = str(tmp_path / "dual")
    rows = I.readings(spark, SF)
    early, late = rows.filter("time < '2024-01-10'"), rows.filter("time >= '2024-01-10'")
    write = J.dual_writer(out)
    write(early, 0)
    write(late, 1)
    write(late, 1)  # a batch that runs again replaces what it wrote
    old, facts, meters, sources = (spark.read.parquet(f"{out}/{t}") for t in ("readings", "fact_meter_reading", "dim_meter", "dim_source"))
    assert old.count() == facts.count() == 1000
    assert meters.count() == meters.select("meter_id").distinct().count() == meters.select("meter_key").distinct().count() == 50
    back = ST.legacy_readings(facts.drop("batch_id"), meters.drop("batch_id"), sources.drop("batch_id"))
    assert back.exceptAll(rows.select(*back.columns)).count() == 0


def test_batches_leave_no_scratch_tables(spark, tmp_path):
    base = Path(scratch_path(spark, "probe").removeprefix("file:")).parent
    there = lambda: set(base.iterdir()) if base.exists() else set()
    rows, before = I.readings(spark, SF), there()
    write = J.dual_writer(str(tmp_path / "star"))
    for batch_id, part in enumerate([rows.filter("time < '2024-01-10'"), rows.filter("time >= '2024-01-10'")]):
        write(part, batch_id)
        assert there() == before
    with pytest.raises(RuntimeError), passing(spark):
        assert settled(rows, "lost").count() == 1000 and there() != before
        raise RuntimeError
    assert there() == before


def test_detection_stream_reports_each_reading_once(spark, tmp_path):
    def run():
        rows = SR.readings_from_messages(SR.read_messages(spark, folder=str(tmp_path / "in")))
        J.detect_job(rows, predictions, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
        return J.detected_events(spark, str(tmp_path / "out"))

    minutes = [START + timedelta(minutes=m) for m in range(60)]
    predictions = spark.createDataFrame([("m", t, 1.0) for t in minutes], "meter_id string, time timestamp, kwh_pred double")
    calm = [message(m / 60, kwh=1.0 + (m % 3) / 100) for m in range(40)]
    write_messages(tmp_path / "in", "1.txt", [*calm, message(40 / 60, kwh=30.0)])
    found = run().collect()
    assert [(r["kwh_actual"], r["severity"]) for r in found] == [(30.0, "high")]
    write_messages(tmp_path / "in", "2.txt", [message(41 / 60)])
    assert run().count() == 1


def test_replay_vector(spark):
    rows = [(START, "M1", 1.0, False, "london"), (START + timedelta(hours=1), "M1", 2.0, False, "")]
    df = spark.createDataFrame(rows, "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string")
    out = J.replay(df, datetime(2026, 1, 1), 60, 1, 2.5).orderBy("time").collect()
    assert [(r["kwh"], r["is_anomaly"], r["source"]) for r in out] == [(1.0, False, "london"), (5.0, True, "live_replay")]
    assert out[1]["time"] == datetime(2026, 1, 1, 0, 1)
    assert J.replay(df, START, limit=1).count() == 1 and J.replay(df, START, anomaly_every=0).filter("is_anomaly").count() == 0


def test_publish_folder(spark, tmp_path):
    K.publish(I.readings(spark, SF), folder=str(tmp_path / "topic"))
    back = SR.readings_from_messages(spark.read.text(str(tmp_path / "topic")))
    assert back.exceptAll(I.readings(spark, SF).select(*back.columns)).count() == 0 and back.count() == 1000
