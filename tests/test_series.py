import random
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattline.operators import quantiles as Q
from wattline.operators import series as S
from wattline.operators import windows as W

START = datetime(2023, 1, 1)


def frame(spark, data):
    """Indexed series from {group: values}."""
    rows = [(g, START + timedelta(minutes=30 * i), i, len(vs), v) for g, vs in data.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "g string, time timestamp, pos long, n long, kwh double")


@pytest.fixture(scope="module")
def noisy():
    rng = random.Random(3)
    return {g: [round(rng.uniform(0, 5), 2) for _ in range(size)] for g, size in (("a", 97), ("b", 40), ("c", 7))}


def by_group(df, column):
    out = {}
    for row in df.orderBy("g", "pos").collect():
        out.setdefault(row["g"], []).append(row[column])
    return out


def test_range_positions_equal_window_positions(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abcc"), START + timedelta(minutes=rng.randrange(50)), f"m{rng.randrange(3)}", rng.random()) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, time timestamp, meter_id string, kwh double")
    spread = S.index_series(df, "g", ("time", "meter_id", "kwh"))
    plain = S.index_series(df, "g", ("time", "meter_id", "kwh"), calendar_bound=True)
    key = ["g", "time", "meter_id", "kwh", "pos", "n"]
    assert sorted(map(tuple, spread.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))


def test_positions_of_copies(spark):
    df = spark.createDataFrame([("a", START, "m", 1.0)] * 300 + [("a", START + timedelta(hours=1), "m", 2.0)], "g string, time timestamp, meter_id string, kwh double")
    out = S.index_series(df, "g").orderBy("pos").collect()
    assert [r["pos"] for r in out] == list(range(301)) and out[-1]["kwh"] == 2.0 and {r["n"] for r in out} == {301}


def test_global_index(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("v"))
    assert S.global_index(df, ["v"]).filter("idx <> v").count() == 0


def loaded(values):
    rows = [(g, i, v) for g, vs in values.items() for i, v in enumerate(vs)]
    db = duckdb.connect()
    db.register("frame", pd.DataFrame(rows, columns=["g", "pos", "v"]))
    db.execute("CREATE TABLE s AS SELECT * FROM frame")
    return db


def mad_by_sql(values, window, factor, least):
    """The flags by joins of each row with its window."""
    near = f"s a JOIN s b ON a.g = b.g AND b.pos BETWEEN a.pos - {window} AND a.pos - 1"
    found = loaded(values).execute(f"""
        WITH centre AS (SELECT a.g, a.pos, a.v, median(b.v) AS m FROM {near} WHERE a.pos >= {window} GROUP BY ALL),
        spread AS (SELECT c.g, c.pos, c.v, c.m, median(abs(b.v - c.m)) AS d FROM centre c
                   JOIN s b ON c.g = b.g AND b.pos BETWEEN c.pos - {window} AND c.pos - 1 GROUP BY ALL)
        SELECT s.g, coalesce(abs(p.v - p.m) / coalesce(nullif(p.d, 0), 1e-9) > {factor} AND abs(p.v - p.m) >= {least}, false)
        FROM s LEFT JOIN spread p USING (g, pos) ORDER BY s.g, s.pos""").fetchall()
    out = {}
    for g, flag in found:
        out.setdefault(g, []).append(flag)
    return out


def runs_by_sql(flags):
    """Runs as islands: place minus rank is constant within one."""
    found = loaded(flags).execute("""
        SELECT g, min(pos), max(pos) FROM (SELECT *, pos - row_number() OVER (PARTITION BY g ORDER BY pos) AS island FROM s WHERE v)
        GROUP BY g, island ORDER BY 1, 2""").fetchall()
    out = {}
    for g, start, end in found:
        out.setdefault(g, []).append((start, end))
    return out


@pytest.mark.parametrize("block", [8, 64, 65536])
def test_rolling_mad_across_blocks(spark, noisy, block):
    from wattline.operators.detect import DetectorConfig, mad_flags

    cfg = DetectorConfig(window=5, mad_multiplier=2.0, min_abs_deviation=0.5)
    got = by_group(mad_flags(frame(spark, noisy), "g", "kwh", cfg, block), "flag")
    assert got == mad_by_sql(noisy, 5, 2.0, 0.5)


def test_short_series_vector(spark):
    from wattline.operators.detect import DetectorConfig, mad_flags

    values = [1.0, 1.1, 0.9, 1.0, 1.1, 0.9, 1.0, 8.0]
    got = by_group(mad_flags(frame(spark, {"g": values}), "g", "kwh", DetectorConfig(window=4, mad_multiplier=3.5)), "flag")
    assert got["g"] == [False] * 7 + [True]


@pytest.mark.parametrize("block", [4, 65536])
def test_runs_prefix_and_next(spark, noisy, block):
    df = frame(spark, noisy).withColumn("flag", F.col("kwh") > 2)
    flags = {g: [v > 2 for v in vs] for g, vs in noisy.items()}
    found = {}
    for row in S.true_runs(df, "g", "flag", block).orderBy("g", "run_start").collect():
        found.setdefault(row["g"], []).append((row["run_start"], row["run_end"]))
    assert found == runs_by_sql(flags)
    sums = by_group(S.prefix_sums(df, "g", {"total": F.col("flag").cast("long")}, block), "total")
    assert sums == {g: list(np.cumsum(f)) for g, f in flags.items()}
    ahead = by_group(S.next_positions(df, "g", {"next": F.col("flag")}, block), "next")
    assert ahead == {g: [next((j for j in range(i, len(f)) if f[j]), None) for i in range(len(f))] for g, f in flags.items()}


def test_run_over_many_blocks(spark):
    df = frame(spark, {"a": [1.0] * 50 + [0.0] + [1.0] * 9})
    got = S.true_runs(df, "g", F.col("kwh") > 0, 4).orderBy("run_start").collect()
    assert [(r["run_start"], r["run_end"]) for r in got] == [(0, 49), (51, 59)]
    assert S.longest_run(df, "g", F.col("kwh") > 0, 10, 40).first()["max_run"] == 31


def test_shifted_by_group_steps(spark, noisy):
    steps = F.when(F.col("g") == "a", 3).otherwise(5)
    got = by_group(S.shifted(frame(spark, noisy), "g", steps, {"past": "kwh"}), "past")
    want = {g: [v[i - s] if i >= s else None for i in range(len(v))] for g, v in noisy.items() for s in [3 if g == "a" else 5]}
    assert got == want


def test_cadence(spark, noisy):
    df = frame(spark, noisy)
    assert {r["cadence_minutes"] for r in S.cadence(df, "g").collect()} == {30}
    single = frame(spark, {"x": [1.0]})
    assert S.cadence(single, "g").first()["cadence_minutes"] == 60
    assert S.cadence(single, "g", None).first()["cadence_minutes"] is None


@pytest.mark.parametrize("block", [16, 65536])
def test_sequence_windows_and_std(spark, noisy, block):
    out = W.sequence_windows(frame(spark, noisy), "g", 4, 2, block=block).orderBy("g", "pos").collect()
    want = [(g, v[i : i + 4], v[i + 4 : i + 6]) for g, v in sorted(noisy.items()) for i in range(len(v) - 5)]
    assert [(r["g"], r["inputs"], r["targets"]) for r in out] == want
    stds = by_group(W.rolling_std(frame(spark, noisy), "g", "kwh", 6, block), "rolling_std")
    assert np.isclose(stds["a"][50], np.std(noisy["a"][45:51], ddof=1)) and stds["a"][0] is None


@pytest.mark.parametrize("accuracy", [20, 100_000])
def test_exact_quantiles_with_brackets(spark, accuracy):
    rng = random.Random(5)
    rows = [("big", round(rng.gauss(0, 1), 3)) for _ in range(4000)] + [("flat", 2.0)] * 500 + [("tiny", float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"q1": 0.25, "mid": 0.5, "q99": 0.99, "lo": 0.0, "hi": 1.0}
    # The bracket margin is proven for at least 5 ranks, so small accuracies are only valid on large groups.
    got = {r["g"]: r for r in Q.exact_quantiles(df, "g", "v", wanted, max(accuracy, 400)).collect()}
    for group in ("big", "flat", "tiny"):
        values = [v for g, v in rows if g == group]
        for name, q in wanted.items():
            assert np.isclose(got[group][name], np.quantile(values, q)), (group, name)
    whole = Q.exact_quantiles(df, [], "v", {"mid": 0.5}, 400).first()
    assert np.isclose(whole["mid"], np.median([v for _, v in rows])) and whole["n_values"] == len(rows)
    spread = {r["g"]: r for r in Q.median_mad(df, "g", "v").collect()}
    big = np.array([v for g, v in rows if g == "big"])
    assert np.isclose(spread["big"]["mad"], np.median(np.abs(big - np.median(big))))


def test_minmax_and_znorm_of_constant(spark):
    df = frame(spark, {"c": [2.0, 2.0], "d": [1.0, 3.0]})
    out = W.znorm(W.minmax_scale(df, "g"), "g").orderBy("g", "pos").collect()
    assert [(r["scaled"], r["z"]) for r in out] == [(0.0, 0.0), (0.0, 0.0), (0.0, -1.0), (1.0, 1.0)]


def test_adaptive_window(spark):
    calm, wild = [float(i % 2) for i in range(200)], [0.0] * 300 + [float(5 * (i % 2)) for i in range(96)]
    quiet = [float(9 * (i % 2)) for i in range(300)] + [0.1] * 96
    out = {r["g"]: r["window"] for r in W.adaptive_window(frame(spark, {"calm": calm, "wild": wild, "quiet": quiet}), "g").collect()}
    assert out == {"calm": 96, "wild": 192, "quiet": 48}
