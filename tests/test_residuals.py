"""Stateful residual scores against the batch operator and plain slices."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import detect as D
from wattline.session import setting
from wattline.sinks import tables as K
from wattline.sources import readings as SR
from wattline.streaming import jobs as J
from wattline.streaming.residuals import advance, scores

START = datetime(2023, 1, 1)
READINGS = "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string"


def rows_of(n, seed=1, spikes=12):
    rng = random.Random(seed)
    at = rng.sample(range(n), spikes)
    return [(60_000_000 * i, 1 + rng.random() / 50 + (rng.uniform(3, 40) if i in at else 0), 1.0, False) for i in range(n)]


def by_hand(rows, window):
    residual = np.array([abs(r[1] - r[2]) for r in rows])
    frames = [residual[max(0, i - window + 1) : i + 1] for i in range(len(rows))]
    return np.array([f[-1] / (f.std(ddof=1) + 1e-8) if len(f) > 1 else np.nan for f in frames])


def reported(rows, window, threshold):
    z = by_hand(rows, window)
    return [(r[0], round(v, 8)) for r, v in zip(rows, z, strict=True) if v > threshold]


@pytest.mark.parametrize("window", [2, 5, 96])
def test_scores_equal_slices(window):
    rows = rows_of(300)
    want = by_hand(rows, window)
    for first in (0, 1, window - 1, 200):
        assert np.allclose(scores(rows, window, first), want[first:], equal_nan=True, rtol=1e-9)


@pytest.mark.parametrize("batches", [1, 3, 10, 150])
def test_batches_in_order_equal_one_pass(batches):
    rows, held, found = rows_of(600), [], []
    for part in np.array_split(np.arange(len(rows)), batches):
        held, new = advance(held, [rows[i] for i in reversed(part)], 96, 3.0)
        found += new
        assert len(held) <= 2 * 95
    assert [(row[0], round(z, 8)) for row, z in found] == reported(rows, 96, 3.0)


def test_a_row_that_is_a_little_late_is_put_in_its_place():
    rows = rows_of(400)
    held, found = advance([], rows[:300], 96, 3.0)
    late = [rows[i] for i in range(300, 400) if i != 320]
    held, more = advance(held, late, 96, 3.0)
    before = len(more)
    held, last = advance(held, [rows[320]], 96, 3.0)
    told = {row[0] for row, _ in found + more + last}
    assert {at for at, _ in reported(rows, 96, 3.0)} <= told and before
    assert [row[0] for row in held] == [row[0] for row in rows[-190:]]


def test_a_row_of_last_year_scores_its_own_hour_only():
    rows = rows_of(400)
    held, _ = advance([], rows, 96, 3.0)
    old = [(-500_000_000_000 + 60_000_000 * i, 1.0 + (i % 3) / 100 + (50 if i == 29 else 0), 1.0, False) for i in range(30)]
    again, found = advance(held, old, 96, 3.0)
    assert again == held and [row[0] for row, _ in found] == [old[29][0]]
    assert advance(held, [old[29]], 96, 3.0) == (held, [])


@pytest.mark.parametrize("files", [3])
def test_stream_equals_batch(spark, tmp_path, files):
    rng = random.Random(9)
    rows = []
    for meter in ("a", "b", "c"):
        spikes = rng.sample(range(20, 240), 8)
        rows += [(START + timedelta(minutes=5 * i), meter, 1 + rng.random() / 9 + 30 * (i in spikes), False, "s") for i in range(240)]
    rows.sort()
    frame = spark.createDataFrame(rows, READINGS)
    predictions = frame.select("meter_id", "time", F.lit(1.0).alias("kwh_pred"))
    for i, part in enumerate(np.array_split(np.arange(len(rows)), files)):
        K.publish(spark.createDataFrame([rows[j] for j in part], READINGS), folder=str(tmp_path / "in"))
        stream = SR.readings_from_messages(SR.read_messages(spark, folder=str(tmp_path / "in")))
        J.detect_job(stream, predictions, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    columns = ["meter_id", "reading_time", "kwh_actual", F.round("z_score", 6).alias("z"), "severity"]
    got = sorted(map(tuple, J.detected_events(spark, str(tmp_path / "out")).select(*columns).collect()))
    want = sorted(map(tuple, D.residual_zscore(frame, predictions).select(*columns).collect()))
    assert got == want and len(got) > 10
    with pytest.raises(ValueError, match="silence"):
        J.detect_job(stream, predictions, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True, silence="30 days")


def test_detection_starts_in_a_session_with_other_state(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"  # Spark's own default
    rows = [(START + timedelta(minutes=5 * i), "a", 1 + i % 7 / 100 + 30 * (i == 90), False, "s") for i in range(120)]
    frame = spark.createDataFrame(rows, READINGS)
    K.publish(frame, folder=str(tmp_path / "in"))
    stream = SR.readings_from_messages(SR.read_messages(spark, folder=str(tmp_path / "in")))
    with setting(spark, key, plain):
        J.detect_job(stream, frame.select("meter_id", "time", F.lit(1.0).alias("kwh_pred")), str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
        assert spark.conf.get(key) == plain
    assert [r["reading_time"] for r in J.detected_events(spark, str(tmp_path / "out")).collect()] == [rows[90][0]]
