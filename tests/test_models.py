import os
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import demo
from wattline.operators import forecast as FC
from wattline.operators import inject as J
from wattline.operators import score as SC
from wattline.operators.isolation import grow_forest, isolation_flags, isolation_scores
from wattline.operators.reconstruction import reconstruction_flags
from wattline.operators.series import index_series
from wattline.session import settled

ROOT = Path(__file__).resolve().parent.parent
START = datetime(2023, 1, 1)
READINGS = "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string"


@pytest.fixture(scope="module")
def series(spark):
    return index_series(demo.readings(spark), "source", ("time",), calendar_bound=True)


@pytest.fixture(scope="module")
def injected(series):
    return settled(J.inject(series, "source"), "injected")


def test_published_naive_errors(series):
    forecasts = FC.seasonal_naive(series, "source")
    overall = SC.wape(forecasts).first()
    assert overall["forecast_rows"] == 960
    assert round(overall["wape_1_step"], 4) == 0.0971 and round(overall["wape_horizon"], 4) == 0.1259
    groups = {r["group_key"].split("_")[0]: round(r["wape_horizon"], 5) for r in SC.wape(forecasts, "group_key").collect()}
    assert groups == {"london": 0.12328, "morocco": 0.12291, "nigeria": 0.12732, "uci": 0.14042}


def test_cutoffs(spark):
    one = spark.createDataFrame([(1008, 48, 48)], "n int, start int, horizon int")
    found = [r["cutoff"] for r in FC.cutoffs(one, 20).orderBy("fold").collect()]
    assert len(found) == 20 and found[0] == 48 and found[-1] == 960
    assert FC.cutoffs(spark.createDataFrame([(90, 48, 48)], "n int, start int, horizon int"), 5).count() == 0
    assert [r["cutoff"] for r in FC.cutoffs(one, 1).collect()] == [960]


def test_ramp(spark):
    rows = [(datetime(2023, 1, 1) + timedelta(hours=i), "m", 1 + (i % 24) / 24, False, "demo") for i in range(240)]
    ramp = index_series(spark.createDataFrame(rows, READINGS), "source", ("time",), calendar_bound=True)
    out = SC.wape(FC.seasonal_naive(ramp, "source", 24, 2)).first()
    assert out["forecast_rows"] == 48 and out["wape_horizon"] == 0.0
    # A horizon of two days: the plain rule looks past the cutoff, the other repeats the last known day.
    assert SC.wape(FC.seasonal_naive(ramp, "source", 48, 2, repeat_season=True)).first()["wape_horizon"] == 0.0


def test_wape_vector(spark):
    rows = [(i + 1, a, f) for i, (a, f) in enumerate(zip([10.0, 20.0, 30.0], [8.0, 22.0, 33.0]))]
    out = SC.wape(spark.createDataFrame(rows, "horizon_step int, actual double, forecast double")).first()
    assert abs(out["wape_horizon"] - 7 / 60) < 1e-12 and abs(out["wape_1_step"] - 0.2) < 1e-12


def test_models_beat_naive(series):
    forecasts, table = FC.benchmark(series, "source", (FC.NAIVE, FC.TUNED_MODEL, FC.LAG_MODEL))
    errors = {r["model_name"]: r for r in table.collect()}
    assert errors[FC.LAG_MODEL]["wape_horizon"] < 0.0707  # published for the tree baseline
    assert errors[FC.TUNED_MODEL]["wape_horizon"] < 0.1259 and errors[FC.TUNED_MODEL]["primary"]
    assert {r["forecast_rows"] for r in errors.values()} == {960}


def test_regression_blocks_agree_and_fall_back(series, spark):
    a = FC.seasonal_regression(series, "source", folds=2, ridge=1e-2)
    b = FC.seasonal_regression(series, "source", folds=2, ridge=1e-2, block=100)
    key = ["group_key", "fold", "horizon_step"]
    both = a.join(b.select(*key, F.col("forecast").alias("other")), key)
    assert both.count() == a.count() == 384
    assert both.agg(F.max(F.abs(F.col("forecast") - F.col("other")))).first()[0] < 1e-6
    assert a.filter("lower > forecast OR upper < forecast").count() == 0
    rows = [(datetime(2023, 1, 1) + timedelta(hours=i), "m", 1.0, False, "s") for i in range(60)]
    short = index_series(spark.createDataFrame(rows, READINGS), "source", ("time",), calendar_bound=True)
    first = FC.seasonal_regression(short, "source", folds=1)
    assert {r["model_type"] for r in first.collect()} <= {FC.FALLBACK, FC.SEASONAL_MODEL}
    assert FC.seasonal_regression(short.filter("pos < 50").withColumn("n", F.lit(50).cast("long")), "source", folds=1).first()["model_type"] == FC.FALLBACK


def test_sequence_statistics_add_up(series):
    whole = FC.sequence_statistics(series, "source", 48, 4, block=128)
    cut = 700
    old = series.filter(F.col("pos") < cut).withColumn("n", F.lit(cut).cast("long"))
    new = series.filter(F.col("pos") >= cut - 51).withColumn("pos", F.col("pos") - (cut - 51)).withColumn("n", F.col("n") - (cut - 51))
    merged = FC.update_statistics(FC.sequence_statistics(old, "source", 48, 4), FC.sequence_statistics(new, "source", 48, 4))
    both = whole.join(merged.withColumnRenamed("v", "w"), ["source", "i"])
    assert both.count() == whole.count() == 4 * 53 * 53
    assert both.agg(F.max(F.abs(F.col("v") - F.col("w")))).first()[0] < 1e-6
    out = FC.sequence_regression(series, "source", 48, 4)
    last = series.groupBy("source").agg(F.max_by("kwh", "pos").alias("last"))
    assert out.join(last, "source").filter("abs(forecast - last) > 0.3").count() == 0 and out.count() == 16


def test_injection_changes_only_labelled_rows(series, injected):
    both = injected.select("source", "pos", "kwh", "is_anomaly", "anomaly_type").join(
        series.select("source", "pos", F.col("kwh").alias("clean")), ["source", "pos"]
    )
    assert both.count() == 4032
    assert both.filter("NOT is_anomaly AND (kwh <> clean OR anomaly_type <> '')").count() == 0
    assert both.filter("is_anomaly AND anomaly_type = ''").count() == 0
    counts = {r["label"]: r["n"] for r in J.injection_report(injected, "source").groupBy("label").agg(F.sum("rows").alias("n")).collect()}
    assert counts["contextual_day_night_swap"] == 48 and counts["trend_drift"] == 24
    assert 0 < counts["point_drop"] + counts["point_spike"] <= 20
    last_quarter = both.filter("anomaly_type LIKE 'point%' AND pos < 756")
    assert last_quarter.count() == 0


def test_injection_on_flat_hourly_series(spark):
    rows = [(datetime(2023, 1, 1) + timedelta(hours=i), "M1", 1.0, False, "test") for i in range(504)]
    flat = index_series(spark.createDataFrame(rows, READINGS), "meter_id", ("time",), calendar_bound=True)
    out = J.inject(flat, "meter_id", seed=7, points=1, segment_steps=2, drift_steps=4, spike_k=8.0)
    marked = out.filter("is_anomaly").collect()
    assert marked and all(r["anomaly_type"] for r in marked)


def test_isolation(series):
    out = isolation_flags(series, "source", block=200)
    counts = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count_if("flag").alias("n")).collect()}
    assert all(0 < n <= 11 for n in counts.values())
    top = out.groupBy("source").agg(F.max_by("flag", "kwh").alias("top")).collect()
    assert all(r["top"] for r in top)
    short = series.filter("pos < 50").withColumn("n", F.lit(50).cast("long"))
    assert isolation_flags(short, "source").filter("flag").count() == 0


def test_forest_isolates_an_outlier():
    values = np.concatenate([np.random.default_rng(0).normal(0, 1, 500), [25.0]])
    rng = np.random.default_rng(1)
    edges, depths = grow_forest([rng.choice(values, 256, replace=False) for _ in range(100)], 1)
    depth = depths[np.searchsorted(edges, [0.0, 25.0])]
    assert depth[1] < depth[0] and len(depths) == len(edges) + 1


def test_isolation_draws_from_the_whole_group(spark):
    """Half of a group lies near 0, half near 10, and one row in 200 far off. Trees draw about one far row each, so
    that far rows stand out together; the halves are alike, whatever their positions."""
    n = 20_000
    far = F.pmod("id", F.lit(200)) == 77
    frame = spark.range(n).select(
        F.lit("g").alias("source"), F.col("id").alias("pos"), F.lit(n).cast("long").alias("n"),
        F.when(far, 1000.0 + F.rand(5) * 100).otherwise((F.col("id") % 2) * 10.0 + F.rand(3)).alias("kwh"),
    )
    scores = isolation_scores(frame, "source", block=3000)
    assert scores.count() == n
    part = F.when(F.col("pos") % 200 == 77, "far").when(F.col("pos") % 2 == 1, "high").otherwise("low")
    mean = {r["part"]: r["mean"] for r in scores.groupBy(part.alias("part")).agg(F.avg("score").alias("mean")).collect()}
    assert mean["far"] > max(mean["high"], mean["low"]) + 0.1
    assert abs(mean["high"] - mean["low"]) < 0.05


def test_reconstruction_blocks_agree(series, injected):
    a = reconstruction_flags(series, injected, "source")
    b = reconstruction_flags(series, injected, "source", block=100)
    both = a.join(b.select("source", "pos", F.col("score").alias("s2"), F.col("flag").alias("f2")), ["source", "pos"])
    assert both.count() == 4032 and both.filter("abs(score - s2) > 1e-6").count() == 0
    assert a.filter("flag AND pos < 47").count() == 0
    quality = SC.confusion(a.withColumn("truth", F.col("is_anomaly")).withColumn("pred", F.col("flag"))).first()
    assert quality["f1"] > 0.1933  # published for the sequence detector


def _fourier(times, origin):
    seconds = np.array([(t - datetime(1970, 1, 1)).total_seconds() for t in times])
    columns = [np.ones(len(times)), (seconds - (origin - datetime(1970, 1, 1)).total_seconds()) / (30 * 86400.0)]
    for period, order in ((1, 4), (7, 3)):
        for k in range(1, order + 1):
            angle = seconds / 86400.0 * 2 * np.pi * k / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.stack(columns, axis=1)


def test_regression_equals_least_squares(spark, series):
    times, values = demo.series(spark, "uci_household_power")
    values = np.array(values)
    got = FC.seasonal_regression(series.filter("source = 'uci_household_power'"), "source", folds=1, ridge=0.0)
    got = [r["forecast"] for r in got.orderBy("horizon_step").collect()]
    beta, *_ = np.linalg.lstsq(_fourier(times[:960], times[0]), values[:960], rcond=None)
    assert np.allclose(got, _fourier(times[960:], times[0]) @ beta, atol=1e-7)


def test_reconstruction_equals_plain_components(spark, series):
    from wattline.operators.blockwise import sliding

    values = np.array(demo.series(spark, "london_smart_meters")[1])
    z = (values - values.mean()) / values.std()
    x = sliding(z, 48)
    centred = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    errors = np.abs(centred - centred @ vt[:6].T @ vt[:6]).mean(axis=1)
    one = series.filter("source = 'london_smart_meters'")
    out = reconstruction_flags(one, one, "source", block=300).orderBy("pos").collect()
    assert np.allclose([r["score"] for r in out[47:]], errors, atol=1e-6)
    centre = np.median(errors)
    assert out[0]["threshold"] == pytest.approx(centre + 4 * np.median(np.abs(errors - centre)), abs=1e-6)


def test_sequence_model_equals_least_squares(spark, series):
    from wattline.operators.blockwise import sliding

    one = series.filter("source = 'nigeria_smart_meter'")
    values = np.array(demo.series(spark, "nigeria_smart_meter")[1])
    x = sliding(values, 28)
    design = np.hstack([np.ones((len(x), 1)), x[:, :24]])
    model = FC.sequence_model(FC.sequence_statistics(one, "source", 24, 4, block=200), 24, 4, ridge=0.0).first()
    weights, *_ = np.linalg.lstsq(design, x[:, 24:], rcond=None)
    fitted = design @ np.array(model["weights"]).reshape(4, 25).T
    assert np.allclose(fitted, design @ weights, atol=1e-4)


def test_isolation_scores_do_not_depend_on_blocks(series):
    a = isolation_scores(series, "source")
    b = isolation_scores(series, "source", block=77).withColumnRenamed("score", "other")
    both = a.join(b, ["source", "pos"])
    assert both.count() == 4032 and both.filter("abs(score - other) > 1e-12").count() == 0


def test_short_and_unnamed_groups_keep_their_rows(spark):
    rows = [(START + timedelta(hours=i), "m", float(i % 7), False, g) for g, n in (("long", 200), ("short", 50), ("tiny", 30), (None, 200)) for i in range(n)]
    frame = index_series(spark.createDataFrame(rows, READINGS), "source", ("time",))
    assert frame.count() == 480
    out = reconstruction_flags(frame, frame, "source")
    assert out.count() == 480
    assert out.filter("source IN ('short', 'tiny') AND (score != 0 OR flag)").count() == 0
    assert out.filter("source IS NULL").count() == 200


def test_unnamed_group_is_a_group(spark):
    from wattline.operators import profile as P
    from wattline.operators import windows as W
    from wattline.operators.quantiles import exact_quantiles

    rows = [(START + timedelta(hours=i), "m", float(i), False, "a" if i % 2 else None) for i in range(120)]
    frame = spark.createDataFrame(rows, READINGS)
    for calendar_bound in (False, True):
        placed = index_series(frame, "source", ("time",), calendar_bound=calendar_bound)
        assert placed.filter("source IS NULL").agg(F.max("pos"), F.max("n")).first() == (59, 60)
        assert W.znorm(placed, "source").count() == 120 and J.inject_drift(placed.withColumn("anomaly_type", F.lit("")), "source").count() == 120
    assert P.box_stats(frame).count() == 2
    assert exact_quantiles(frame, "source", "kwh", {"q": 0.5}).count() == 2


def test_workers_get_the_package(tmp_path):
    """Started elsewhere, with the package on the driver's path only, a query with Python functions runs."""
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys\nsys.path.insert(0, {str(ROOT)!r})\n"
        "from wattline.plans import REGISTRY\nfrom wattline.session import build_session, ship\n"
        "spark = build_session(master='local[2]', spark__ui__enabled='false', spark__sql__shuffle__partitions=2)\n"
        "ship(spark)\n"
        "print('rows', REGISTRY['isolation_flags'].job(spark, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 868" in done.stdout, done.stderr[-1500:]
