"""Selection of quantiles, the merged as-of join and event scores on sparse rows, against plain Python."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import quantiles as Q
from wattline.operators import score as SC
from wattline.operators import star as ST

START = datetime(2023, 1, 1)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(6)
    inf = float("inf")
    return {
        "normal": [rng.gauss(0, 5) for _ in range(3000)],
        "scales": [10 ** rng.uniform(-300, 300) * rng.choice([-1, 1]) for _ in range(1500)],
        "ties": [rng.choice([1.0, 1.0, 2.0, 7.5]) for _ in range(2000)],
        "one": [4.0], "two": [1.0, 2.0], "same": [3.0] * 900,
        "endless": [-inf] * 40 + [float(i) for i in range(700)] + [inf] * 3,
        None: [float(i % 97) for i in range(1000)],
    }


@pytest.fixture(scope="module")
def frame(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values] + [("normal", None), ("normal", float("nan")), ("empty", None)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


WANTED = {"least": 0.0, "q": 0.3, "mid": 0.5, "high": 0.99, "most": 1.0}


def close(got, want):
    return got == want or (np.isnan(got) and np.isnan(want)) or got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize(("accuracy", "few", "margin"), [(10_000, 4096, None), (50, 3, 0.0), (10_000, 2, 1.0)])
def test_selection_equals_numpy(frame, groups, accuracy, few, margin):
    got = {r["g"]: r for r in Q.exact_quantiles(frame, "g", "v", WANTED, accuracy, few, margin).collect()}
    assert got.keys() == groups.keys()
    with np.errstate(invalid="ignore", over="ignore"):
        for g, values in groups.items():
            assert got[g]["n_values"] == len(values)
            for name, q in WANTED.items():
                below, above = sorted(values)[int(np.floor(q * (len(values) - 1)))], sorted(values)[int(np.ceil(q * (len(values) - 1)))]
                assert below <= got[g][name] <= above
                if g not in ("scales", "endless"):
                    assert close(got[g][name], np.quantile(values, q))


@pytest.mark.parametrize("margin", [None, 0.0])
def test_selection_without_groups(frame, groups, margin):
    values = [v for vs in groups.values() for v in vs]
    row = Q.exact_quantiles(frame, [], "v", {"mid": 0.5, "q": 0.123}, 30, 4, margin).first()
    assert row["n_values"] == len(values)
    assert close(row["mid"], np.quantile(values, 0.5)) and close(row["q"], np.quantile(values, 0.123))
    empty = Q.exact_quantiles(frame.limit(0), [], "v", {"mid": 0.5}).first()
    assert empty["n_values"] == 0 and empty["mid"] is None
    assert Q.exact_quantiles(frame.limit(0), "g", "v", {"mid": 0.5}).count() == 0


def test_a_bracket_without_its_rank_is_noticed(frame, monkeypatch):
    """Brackets that lie beside all values: every rank is missed and still found."""
    real = Q._brackets
    beside = lambda *args: real(*args).withColumns({c: F.lit(1e301) for c in ("_lo0", "_hi0")})
    want = Q.exact_quantiles(frame, "g", "v", {"q": 0.4}).collect()
    monkeypatch.setattr(Q, "_brackets", beside)
    assert sorted(map(repr, Q.exact_quantiles(frame, "g", "v", {"q": 0.4}, few=7).collect())) == sorted(map(repr, want))


def test_no_single_partition_in_the_plan(frame):
    plan = Q.exact_quantiles(frame, [], "v", {"q": 0.4})._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(0" not in plan


@pytest.mark.parametrize("few", [0, 10_000])
def test_as_of_join_equals_a_scan(spark, few):
    rng = random.Random(few)
    versions, by_meter = [], {}
    for meter in ("a", "b", "c"):
        at = START
        for i in range(200 if meter == "a" else 3):
            end = at + timedelta(hours=rng.randint(1, 9))
            versions.append((meter, at, None if meter == "b" and i == 2 else end, f"{meter}{i}", i))
            by_meter.setdefault(meter, []).append(versions[-1])
            at = end + timedelta(hours=rng.choice([0, 0, 2]))
    facts = [(rng.choice(["a", "a", "b", "c", "d", None]), START + timedelta(minutes=30 * rng.randint(-20, 2000)), i % 50) for i in range(3000)]
    facts += facts[:20]
    dim = spark.createDataFrame(versions, "meter_id string, valid_from timestamp, valid_to timestamp, profile string, size int")
    left = spark.createDataFrame(facts, "meter_id string, time timestamp, x int").repartition(6)
    got = sorted(map(repr, map(tuple, ST.as_of_join(left, dim, ["profile", "size"], few=few).collect())))

    def valid(meter, time):
        return next(((v[3], v[4]) for v in by_meter.get(meter, []) if v[1] <= time and (v[2] is None or time < v[2])), (None, None))

    assert got == sorted(repr((*f, *valid(f[0], f[1]))) for f in facts)


def events_by_hand(rows, tolerance, min_flags, min_run, label=None):
    """Counts of one series of (truth, pred, labels)."""

    def runs(flags):
        out, start = [], None
        for i, f in enumerate([*flags, False]):
            if f and start is None:
                start = i
            if not f and start is not None:
                out.append((start, i - 1))
                start = None
        return out

    n = len(rows)
    pred = [p for _, p, _ in rows]
    tp = fn = 0
    windows = []
    for s, e in runs([t and (label is None or label in names) for t, _, names in rows]):
        kind = label or "+".join(sorted({x for _, _, names in rows[s : e + 1] for x in names})) or "unknown"
        lo, hi = max(0, s - tolerance), min(n - 1, e + tolerance)
        need = 1 if kind.startswith("point_") else min_flags
        longest = max((b - a + 1 for a, b in runs(pred[lo : hi + 1])), default=0)
        hit = sum(pred[lo : hi + 1]) >= need and longest >= min_run
        tp, fn = tp + hit, fn + (not hit)
        if hit:
            windows.append((lo, hi))
    fp = sum(e - s + 1 >= min_flags and not any(lo <= e and hi >= s for lo, hi in windows) for s, e in runs(pred))
    return tp, fp, fn


@pytest.mark.parametrize(("tolerance", "min_flags", "min_run", "block"), [(2, 2, 1, 65_536), (0, 1, 1, 16), (2, 3, 2, 16), (5, 2, 4, 32)])
def test_event_scores_equal_a_scan(spark, tolerance, min_flags, min_run, block):
    rng = random.Random(tolerance + min_run)
    rows, series = [], {}
    for g in ("a", None, "quiet"):
        truth = pred = False
        names = []
        for i in range(260):
            if g != "quiet" and rng.random() < 0.15:
                truth, names = not truth, rng.sample(["point_x", "drift", "swap"], rng.randint(0, 2))
            if rng.random() < 0.25:
                pred = not pred
            own = names if truth else []
            series.setdefault(g, []).append((truth and g != "quiet", pred, own))
            rows.append((g, i, 260, series[g][-1][0], pred, "+".join(own)))
    df = spark.createDataFrame(rows, "g string, pos long, n long, truth boolean, pred boolean, anomaly_type string")
    got = {r["g"]: (r["tp"], r["fp"], r["fn"]) for r in SC.event_scores(df, "g", tolerance, min_flags, min_run, block).collect()}
    assert got == {g: events_by_hand(s, tolerance, min_flags, min_run) for g, s in series.items()}
    typed = {(r["g"], r["label"]): (r["tp"], r["fp"], r["fn"]) for r in SC.event_scores_by_type(df, "g", tolerance, min_flags, min_run, block).collect()}
    want = {(g, x): events_by_hand(s, tolerance, min_flags, min_run, x) for g, s in series.items() for x in {x for *_, names in s for x in names}}
    assert typed == want
