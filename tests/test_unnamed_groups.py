"""Rows of an unnamed group (null) fare as those of a group with a name: every group operator, against its named twin."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline.operators import detect as D
from wattline.operators import forecast as FC
from wattline.operators import inject as J
from wattline.operators import isolation, profile, quantiles, reconstruction
from wattline.operators import score as SC
from wattline.operators import series as S
from wattline.operators import windows as W

START = datetime(2023, 1, 1)
G = "source"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for name in (None, "b"):
        for i in range(24 * 16):
            value = 2 + (i % 24) / 8 + rng.random() / 4 + (9 if rng.random() < 0.02 else 0)
            out.append((START + timedelta(hours=i), f"m{name}", value, rng.random() < 0.05, name))
    return out


def indexed(spark, rows, name):
    named = [(*row[:4], name if row[4] is None else row[4]) for row in rows]
    df = spark.createDataFrame(named, "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string")
    df = df.withColumn("anomaly_type", F.when(F.col("is_anomaly"), F.when(F.hour("time") % 2 == 0, "x").otherwise("x+y")).otherwise(""))
    df = df.withColumn("truth", F.col("is_anomaly")).withColumn("pred", F.col("kwh") > 9)
    return S.index_series(df, G)


@pytest.fixture(scope="module")
def both(spark, rows):
    return indexed(spark, rows, None), indexed(spark, rows, "a")


def frames(result):
    return list(result.values()) if isinstance(result, dict) else list(result) if isinstance(result, tuple) else [result]


def content(df, key):
    columns = sorted(c for c in df.columns if c != key)
    rows = df.select(F.coalesce(F.col(key), F.lit("a")).alias(key), *columns) if key in df.columns else df.select(*columns)
    return sorted([tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in rows.collect()], key=repr)


def forecasts(df):
    return FC.seasonal_naive(df, G)


OPERATORS = {
    "rolling_std": lambda df: W.rolling_std(df, G, "kwh"),
    "rolling_median_mad": lambda df: W.rolling_median_mad(df, G, "kwh"),
    "seasons": lambda df: W.seasons(df, G, 24),
    "seasonal_residual": lambda df: W.seasonal_residual(df, G),
    "lag_features": lambda df: W.lag_features(df, G, 24, 48),
    "sequence_windows": lambda df: W.sequence_windows(df, G, 24, 4).select(G, "pos", F.concat_ws(",", F.transform("inputs", lambda x: F.round(x, 6).cast("string"))).alias("x")),
    "adaptive_window": lambda df: W.adaptive_window(df, G),
    "minmax_scale": lambda df: W.minmax_scale(df, G),
    "znorm": lambda df: W.znorm(df, G),
    "prefix_sums": lambda df: S.prefix_sums(df, G, {"s": F.col("kwh")}, 64),
    "next_positions": lambda df: S.next_positions(df, G, {"p": F.col("truth")}, 64),
    "true_runs": lambda df: S.true_runs(df, G, "truth"),
    "longest_run": lambda df: S.longest_run(df, G, "truth"),
    "cadence": lambda df: S.cadence(df, G),
    "mad_flags": lambda df: D.mad_flags(df, G),
    "seasonal_flags": lambda df: D.seasonal_flags(df, G),
    "detect": lambda df: D.detect(df, G, isolation=False),
    "attach_forecast": lambda df: D.attach_forecast(df, forecasts(df), G),
    "forecast_residual_flags": lambda df: D.forecast_residual_flags(df, forecasts(df), G),
    "reconstruction_flags": lambda df: reconstruction.reconstruction_flags(df, df, G, 24).select(G, "pos", "flag"),
    "fold_plan": lambda df: FC.fold_plan(df, G, 24, 5),
    "direct_features": lambda df: FC.direct_features(df, FC.fold_plan(df, G, 24, 5, {"days": 3}), G),
    "seasonal_naive": lambda df: forecasts(df),
    "seasonal_regression": lambda df: FC.seasonal_regression(df, G),
    "seasonal_outlook": lambda df: FC.seasonal_outlook(df, G, daily_order=2),
    "sequence_regression": lambda df: FC.sequence_regression(df, G, 12, 2),
    "inject_swap": lambda df: J.inject_swap(J.unlabelled(df), G),
    "inject_drift": lambda df: J.inject_drift(J.unlabelled(df), G),
    "injection_report": lambda df: J.injection_report(df, G),
    "confusion": lambda df: SC.confusion(df, G),
    "confusion_by_type": lambda df: SC.confusion_by_type(df, G),
    "latency": lambda df: SC.latency(df, G),
    "event_scores": lambda df: SC.event_scores(df, G, event_min_flags=1),
    "event_scores_by_type": lambda df: SC.event_scores_by_type(df, G, event_min_flags=1),
    "evaluate": lambda df: SC.evaluate(df, G, event_min_flags=1),
    "sweep": lambda df: SC.sweep(D.robust_score(df, G, "kwh"), [1.0, 2.0, 4.0], by=G),
    "best_operating_point": lambda df: SC.best_operating_point(SC.sweep(D.robust_score(df, G, "kwh"), [1.0, 4.0], by=G), 0.1, by=G),
    "align": lambda df: SC.align(df, df, G),
    "quantiles": lambda df: quantiles.exact_quantiles(df, G, "kwh", {"q": 0.3}),
    "median_mad": lambda df: quantiles.median_mad(df, G, "kwh"),
    "box_stats": lambda df: profile.box_stats(df, G),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_unnamed_group_equals_its_named_twin(both, name):
    unnamed, named = both
    for got, want in zip(frames(OPERATORS[name](unnamed)), frames(OPERATORS[name](named)), strict=True):
        key = "group_key" if "group_key" in want.columns else G
        assert content(got, key) == content(want, key)
        assert want.count() and (key not in got.columns or got.filter(F.col(key).isNull()).count())


def test_random_operators_reach_the_unnamed_group(both):
    unnamed, _ = both
    report = {r["label"]: r["rows"] for r in J.injection_report(J.inject(unnamed.drop("anomaly_type", "is_anomaly"), G), G).filter("source IS NULL").collect()}
    assert report["contextual_day_night_swap"] == 12 and report["trend_drift"] == 6
    assert 1 <= report.get("point_drop", 0) + report.get("point_spike", 0) <= 5
    flagged = D.detect(unnamed, G)
    assert flagged.count() == unnamed.count() == 768
    isolated = isolation.isolation_flags(unnamed, G)
    assert isolated.filter("source IS NULL AND flag").count() > 0
    ahead = FC.lag_regression(unnamed, G, folds=1, trees=3, max_depth=3)
    assert ahead.filter("group_key IS NULL").count() == ahead.filter("group_key = 'b'").count() == 24


def test_swap_across_midnight(spark):
    """Six steps of two hours from 14:00 end at 00:00 of the next day."""
    rows = [(START + timedelta(hours=2 * i), "m", float(i), False, "s") for i in range(12 * 6)]
    df = S.index_series(spark.createDataFrame(rows, "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string"), G)
    plan = {r["pos"]: r["new_kwh"] for r in J.swap_plan(df, G, 6).collect()}
    night, afternoon = [12 * 4 + 1 + i for i in range(6)], [12 * 4 + 7 + i for i in range(6)]
    assert plan == dict(zip(night, map(float, afternoon))) | dict(zip(afternoon, map(float, night)))


def test_swap_of_overlapping_segments_writes_the_afternoon_last(spark):
    """Six steps of three hours overlap: 14:00 is the fifth step of the night."""
    rows = [(START + timedelta(hours=2 + 3 * i), "m", float(i), False, "s") for i in range(8 * 6)]
    df = S.index_series(spark.createDataFrame(rows, "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string"), G)
    out = J.inject_swap(J.unlabelled(df), G, 6).orderBy("pos").collect()
    night = [8 * 4 + i for i in range(6)]
    afternoon = [p + 4 for p in night]
    want = {p: float(p) for p in range(48)} | dict(zip(night, map(float, afternoon))) | dict(zip(afternoon, map(float, night)))
    assert [r["kwh"] for r in out] == [want[p] for p in range(48)]
