import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattline.operators import detect as D
from wattline.operators import score as SC
from wattline.operators.detect import DetectorConfig
from wattline.operators.series import index_series

START = datetime(2023, 1, 1)
KINDS = ["", "point_spike", "contextual_day_night_swap", "trend_drift", "trend_drift+point_drop"]


def scored(spark, series):
    rows = [
        (g, START + timedelta(minutes=30 * i), i, len(truth), truth[i], pred[i], types[i])
        for g, (truth, pred, types) in series.items()
        for i in range(len(truth))
    ]
    return spark.createDataFrame(rows, "g string, time timestamp, pos long, n long, truth boolean, pred boolean, anomaly_type string")


def random_series(seed, size):
    rng = random.Random(seed)
    truth, pred, types = [], [], []
    while len(truth) < size:
        on, kind = rng.random() < 0.4, rng.choice(KINDS[1:])
        for _ in range(rng.randrange(1, 9)):
            truth.append(on)
            types.append(kind if on else "")
            pred.append(rng.random() < (0.7 if on else 0.35))
    return truth[:size], pred[:size], types[:size]


@pytest.fixture(scope="module")
def many():
    return {f"g{k}": random_series(k, size) for k, size in enumerate([120, 75, 33, 9])}


def event_rows(df, *settings):
    return {r["g"]: (r["tp"], r["fp"], r["fn"]) for r in SC.event_scores(df, "g", *settings).collect()}


def count_events(series):
    """Rising edges of the truth."""
    return {g: sum(on and not before for before, on in zip([False, *truth], truth)) for g, (truth, _, _) in series.items()}


@pytest.mark.parametrize("tol,min_flags,min_run", [(2, 5, 1), (0, 3, 2), (3, 2, 3)])
def test_event_scores_do_not_depend_on_blocks_or_direction(spark, many, tol, min_flags, min_run):
    whole = event_rows(scored(spark, many), tol, min_flags, min_run, 65536)
    assert event_rows(scored(spark, many), tol, min_flags, min_run, 8) == whole
    back = {g: tuple(part[::-1] for part in parts) for g, parts in many.items()}
    assert event_rows(scored(spark, back), tol, min_flags, min_run, 16) == whole
    events = count_events(many)
    assert {g: tp + fn for g, (tp, _, fn) in whole.items()} == events
    exact = {g: (truth, truth, types) for g, (truth, _, types) in many.items()}
    assert event_rows(scored(spark, exact), 0, 1, 1) == {g: (n, 0, 0) for g, n in events.items()}
    silent = {g: (truth, [False] * len(truth), types) for g, (truth, _, types) in many.items()}
    assert event_rows(scored(spark, silent), tol, min_flags, min_run) == {g: (0, 0, n) for g, n in events.items()}


def places(n, *on):
    return [i in on for i in range(n)]


def test_event_vectors(spark):
    """Worked by hand: (truth, flags) and the result for tolerance 0 or 1."""
    point, drift = ["point_spike"] * 14, ["trend_drift"] * 14
    series = {
        "outside": (places(14, 10), places(14, 8, 9, 10), point),  # three in a row, one of them in the window
        "inside": (places(14, 8, 9, 10), places(14, 8, 9, 10), drift),
        "broken": (places(14, 7, 8, 9, 10), places(14, 7, 8, 10), drift),
        "far": (places(14, 2), places(14, 9, 10, 11, 12), point),
    }
    got = event_rows(scored(spark, series), 0, 3, 3)
    assert got == {"outside": (0, 1, 1), "inside": (1, 0, 0), "broken": (0, 0, 1), "far": (0, 1, 1)}
    late = {"late": (places(14, 3, 4, 5), places(14, 5, 6), drift)}
    row = SC.event_scores(scored(spark, late), "g", 1, 2, 1).first()
    assert (row["tp"], row["fp"], row["fn"], row["avg_latency_samples"]) == (1, 0, 0, 2.0)


def test_event_scores_by_type(spark, many):
    """Labels split the events; where each event has one label, the counts add up to those of all."""
    single = {g: (truth, pred, ["trend_drift" if t else "" for t in truth]) for g, (truth, pred, _) in many.items()}
    by_label = SC.event_scores_by_type(scored(spark, single), "g", 2, 5, 1, 16).collect()
    assert {r["g"]: (r["tp"], r["fp"], r["fn"]) for r in by_label} == event_rows(scored(spark, single), 2, 5, 1)
    small = SC.event_scores_by_type(scored(spark, many), "g", 2, 5, 1, 16)
    large = SC.event_scores_by_type(scored(spark, many), "g", 2, 5, 1)
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)


def test_latency_vectors(spark, many):
    series = {"g": (places(12, 2, 3, 7, 10), places(12, 3, 9, 11), ["x"] * 12)}
    row = SC.latency(scored(spark, series), "g", 1, 4).first()
    # Windows 2-3, 7 and 10: found after one step, not found, found after one step.
    assert (row["windows"], row["missed_windows"], row["avg_latency_samples"], row["avg_latency_minutes"]) == (3, 1, 1.0, 30.0)
    got = {r["g"]: r["windows"] for r in SC.latency(scored(spark, many), "g", 2, 16).collect()}
    assert got == count_events(many)


def test_confusion_adds_up(spark, many):
    df = scored(spark, many)
    total = SC.confusion(df).first()
    assert total["tp"] + total["fp"] + total["fn"] + total["tn"] == df.count()
    by_type = SC.confusion_by_type(df, "g").collect()
    for r in by_type:
        truth, pred, types = many[r["g"]]
        mine = [t and r["label"] in k.split("+") for t, k in zip(truth, types)]
        assert r["tp"] == sum(m and p for m, p in zip(mine, pred)) and r["fp"] == sum(p and not m for m, p in zip(mine, pred))
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(truth)


def test_confirmed_flags_vector(spark):
    truth = [False] + [True] * 6 + [False]
    kinds = ["" if not t else "contextual_day_night_swap" for t in truth]
    weak, strong = [i == 1 for i in range(8)], [1 <= i <= 5 for i in range(8)]
    df = scored(spark, {"weak": (truth, weak, kinds), "strong": (truth, strong, kinds)})
    out = {r["g"]: r for r in SC.event_scores(df, "g", 0, 5, 1).collect()}
    assert out["weak"]["fn"] == 1 and out["strong"]["tp"] == 1


def test_residual_detection_end_to_end(spark):
    times = [START + timedelta(minutes=30 * i) for i in range(12)]
    readings = [(t, "M1", 10.0 if i == 8 else 1.0, i == 8, "demo", "point_spike" if i == 8 else "") for i, t in enumerate(times)]
    readings = spark.createDataFrame(readings, "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string, anomaly_type string")
    forecasts = [("demo", 1, i + 1, t, 1.0, 1.0, "seasonal_naive") for i, t in enumerate(times)]
    forecasts = spark.createDataFrame(forecasts, "group_key string, fold int, horizon_step int, time timestamp, actual double, forecast double, model_type string")
    cfg = DetectorConfig(window=4, mad_multiplier=3.0, min_abs_deviation=0.5)
    flagged = D.forecast_residual_flags(readings, forecasts, "source", cfg)
    df = flagged.withColumn("truth", F.col("is_anomaly")).withColumn("pred", F.col("flag"))
    tables = SC.evaluate(df, "source", tolerance=1)
    assert tables["rows_overall"].first()["tp"] >= 1
    assert [r["label"] for r in tables["rows_by_type"].collect()] == ["point_spike"]
    assert tables["latency"].first()["avg_latency_samples"] == 0
    assert tables["events"].first()["tp"] == 1


def test_smallest_horizon_wins(spark):
    forecasts = spark.createDataFrame(
        [("s", 1, 9, START, 0.0, 5.0, "x"), ("s", 3, 2, START, 0.0, 7.0, "x"), ("s", 2, 2, START, 0.0, 6.0, "x")],
        "group_key string, fold int, horizon_step int, time timestamp, actual double, forecast double, model_type string",
    )
    readings = spark.createDataFrame([(START, "s", 1.0), (START + timedelta(hours=1), "s", 1.0)], "time timestamp, source string, kwh double")
    out = D.attach_forecast(readings, forecasts, "source").orderBy("time").collect()
    assert (out[0]["forecast"], out[0]["covered"], out[1]["covered"]) == (6.0, True, False)


def test_thresholds_and_operating_points(spark):
    levels = SC.default_thresholds()
    assert levels[0] == 0.5 and levels[-1] == 5.0 and len(levels) == 46
    rows = [(1.0, 0.9, 1.0, 0.947), (2.0, 0.97, 0.8, 0.878)]
    df = spark.createDataFrame(rows, "mad_multiplier double, precision double, recall double, f1 double")
    assert SC.best_operating_point(df, 0.95).first()["mad_multiplier"] == 2.0
    assert SC.best_operating_point(df, 0.99).first()["mad_multiplier"] == 1.0


def test_sweep_equals_single_thresholds(spark):
    rng = random.Random(2)
    rows = [(rng.random() < 0.3, rng.choice([rng.uniform(0, 6), 0.5, 1.4, None]), rng.uniform(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "truth boolean, robust_z double, deviation double")
    swept = {r["mad_multiplier"]: r for r in SC.sweep(df).collect()}
    for level in (0.5, 1.4, 3.3, 5.0):
        hits = [z is not None and z > level and d >= 0.12 for _, z, d in rows]
        assert swept[level]["tp"] == sum(t and h for (t, _, _), h in zip(rows, hits))
        assert swept[level]["fp"] == sum(h and not t for (t, _, _), h in zip(rows, hits))


def test_align_checks_length(spark, many):
    df = scored(spark, many)
    out = SC.align(df.select("g", "time", "truth"), df.select("g", "time", "pred"), "g", ("time",))
    assert out.count() == df.count()
    with pytest.raises(PySparkException, match="length mismatch"):
        SC.align(df.select("g", "time", "truth"), df.filter("pos > 0").select("g", "time", "pred"), "g", ("time",)).collect()


def test_residual_zscore_window_sees_the_hour_only(spark):
    rng = random.Random(4)
    rows = [(START + timedelta(minutes=i), "m", rng.random(), False, "s") for i in range(120)]
    rows[-1] = (*rows[-1][:2], 50.0, *rows[-1][3:])
    readings = spark.createDataFrame(rows, "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string")
    predictions = readings.select("time", "meter_id", F.lit(0.5).alias("kwh_pred"))
    found = D.residual_zscore(readings, predictions, START + timedelta(hours=1), block=16 * 96).collect()
    assert [r["reading_time"] for r in found][-1] == START + timedelta(minutes=119) and found[-1]["severity"] == "high"
    late = D.residual_zscore(readings, predictions, START + timedelta(minutes=119)).collect()
    assert late == []  # a single row has no deviation, so it is not flagged
    assert len(D.residual_zscore(readings, predictions, START + timedelta(minutes=119), history=True).collect()) == 1


def test_index_after_filter_counts_covered_rows(spark, many):
    df = scored(spark, many).filter("pos % 2 = 0").drop("pos", "n")
    out = index_series(df, "g", ("time",)).filter("g = 'g1'").orderBy("time").collect()
    assert [r["pos"] for r in out] == list(range(38))
