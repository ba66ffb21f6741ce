import json
import os
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattline import session
from wattline.functions import sql as sql_functions
from wattline.functions import text as X
from wattline.functions import time as C
from wattline.operators import profile as P
from wattline.operators import rollups as R
from wattline.operators import star as ST
from wattline.plans import inputs as I
from wattline.sinks import tables as K
from wattline.sources import feeds
from wattline.sources import readings as SR

SF = "/root/testdata/sf0.001"
READINGS = "time timestamp, meter_id string, kwh double, is_anomaly boolean, source string"
START = datetime(2023, 1, 1)


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(column).collect()]


def test_parse_time_layouts(spark):
    texts = ["2023-01-02 03:04:05", "2023-01-02T03:04:05", "2023-01-02T03:04:05Z", "2023-01-02T05:04:05+02:00", "2/1/2023 03:04:05", "2023-01-02 03-04-05", " 2023-01-02 03:04:05.5 "]
    got = one(spark, C.parse_time(F.col("v")), *texts)
    assert got[:6] == [datetime(2023, 1, 2, 3, 4, 5)] * 6 and got[6].microsecond == 500_000
    assert one(spark, C.parse_time(F.col("v")), "yesterday", "", None) == [None] * 3
    with pytest.raises(PySparkException, match="Unsupported timestamp format"):
        one(spark, C.parse_time(F.col("v"), strict=True), "yesterday")


def test_floor_bucket_restarts_each_day(spark):
    df = spark.createDataFrame([(datetime(2023, 1, 1, 23, 59, 30),), (datetime(2023, 1, 2, 0, 10),)], "t timestamp")
    got = [r[0] for r in df.select(C.floor_bucket(F.col("t"), 50)).collect()]
    assert got == [datetime(2023, 1, 1, 23, 20), datetime(2023, 1, 2)]


def test_names_and_labels(spark):
    assert feeds.find_column(["LCLid", "KWH"], feeds.METER_HEADERS) == "LCLid"
    assert one(spark, X.normalize_name(F.col("v")), " Zone 1.A ") == ["zone_1a"]
    assert one(spark, X.safe_name(F.col("v")), "_Éa b/c-") == ["éa_b_c"]
    assert one(spark, X.add_label(F.col("v"), "b"), "a", "b", "a+b", "", None) == ["a+b", "b", "a+b", "b", "b"]
    assert one(spark, X.parse_bool(F.col("v")), " Y ", "1", "no", None) == [True, True, False, False]
    assert one(spark, X.parse_bool(F.col("v"), X.TRUE_WORDS_PROFILE), "y", "Yes") == [False, True]


def test_csv_scan(spark, tmp_path):
    good = tmp_path / "city_meter_readings.csv"
    good.write_text("time,meter_id,kwh,is_anomaly,source\n2023-01-01 00:00:00, M1 ,1.5,Yes,\n2023-01-01T01:00:00Z,M2,2,false,named\n")
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    rows = SR.read_readings_csv(spark, str(tmp_path), glob=SR.READINGS_GLOB).orderBy("time").collect()
    assert [tuple(r) for r in rows] == [
        (START, "M1", 1.5, True, "city_meter_readings"),
        (START + timedelta(hours=1), "M2", 2.0, False, "named"),
    ]
    with pytest.raises(ValueError, match="missing columns"):
        SR.read_readings_csv(spark, str(tmp_path / "other.csv"))
    bad = tmp_path / "bad.csv"
    bad.write_text("time,meter_id,kwh,is_anomaly\nnever,M1,x,false\n2023-01-01,M1,3,false\n")
    assert SR.clean(SR.read_readings_csv(spark, str(bad), strict=False)).count() == 1


def test_minute_power_file(spark, tmp_path):
    path = tmp_path / "power.txt"
    path.write_bytes("Date;Time;Global_active_power\n16/12/2006;17:24:00;4.216\n16/12/2006;17:25:00;?\n1/1/2007;00:00:00;0.6\n".encode("latin-1"))
    rows = feeds.normalize_minute_power(feeds.read_minute_power(spark, str(path))).orderBy("time").collect()
    assert [(r["time"], r["kwh"]) for r in rows] == [(datetime(2006, 12, 16, 17, 24), 0.07026667), (datetime(2007, 1, 1), 0.01)]
    assert rows[0]["meter_id"] == feeds.MINUTE_POWER_METER
    assert feeds.normalize_minute_power(feeds.read_minute_power(spark, str(path)), max_rows=1).count() == 1


def test_series_lines(spark):
    lines = ["# note", "@attribute x", "@data", "", "M1:2012-10-12 00-30-00:1.0,?,,2.5", "broken line", "M2:2012-10-12 00-00-00:3"]
    rows = feeds.normalize_series_lines(spark.createDataFrame([(v,) for v in lines], "value string")).orderBy("meter_id", "time").collect()
    assert [(r["meter_id"], r["time"], r["kwh"]) for r in rows] == [
        ("M1", datetime(2012, 10, 12, 0, 30), 1.0),
        ("M1", datetime(2012, 10, 12, 2, 0), 2.5),
        ("M2", datetime(2012, 10, 12), 3.0),
    ]


def test_city_sheets(spark):
    sheet = spark.createDataFrame([(START, "10", "n/a"), (START + timedelta(minutes=20), None, "5")], "DateTime timestamp, `Zone 1` string, `Z.2` string")
    rows = feeds.unpivot_city(sheet, "laayoune", feeds.city_unit("laayoune")).orderBy("time").collect()
    assert [(r["meter_id"], r["kwh"]) for r in rows] == [("laayoune_zone_1", 0.69), ("laayoune_z2", 0.345)]
    rows = feeds.unpivot_city(sheet, "Marrakech_30T", feeds.city_unit("Marrakech_30T")).orderBy("time").collect()
    assert [r["kwh"] for r in rows] == [5.0, 2.5]
    assert [feeds.sheet_minutes(n) for n in ("a_10T", "b_30min", "c")] == [10, 30, 10]


def test_long_csv_without_known_headers(spark):
    assert feeds.normalize_long_csv(spark.createDataFrame([(1, 2)], "a int, b int")) is None


def test_rollup_refresh(spark):
    raw = I.readings(spark, SF)
    full = R.rollup(raw, "1 hour")
    rebuilt = R.refresh_rollup(full.limit(0), raw, "1 hour")
    assert rebuilt.exceptAll(full).count() == 0 and full.exceptAll(rebuilt).count() == 0
    lo, hi = datetime(2024, 1, 5, 0, 30), datetime(2024, 1, 9, 12, 30)
    stale = full.withColumn("kwh_total", F.lit(-1.0))
    mixed = R.refresh_rollup(stale, raw, "1 hour", lo, hi)
    inside = (F.col("bucket") >= datetime(2024, 1, 5, 1)) & (F.col("bucket") <= datetime(2024, 1, 9, 11))
    assert mixed.filter(inside & (F.col("kwh_total") == -1)).count() == 0
    assert mixed.filter(~inside & (F.col("kwh_total") != -1)).count() == 0 and mixed.count() == full.count()


def test_resample_keeps_the_total(spark):
    raw = I.readings(spark, SF)
    total = lambda df: df.agg(F.sum("kwh")).first()[0]
    assert total(R.resample(raw, 37)) == pytest.approx(total(raw))


def test_fact_storage_prunes_and_pushes(spark, tmp_path):
    path = str(tmp_path / "facts")
    K.write_readings(I.readings(spark, SF), path)
    kept = R.time_filter(spark.read.parquet(path), "time", datetime(2024, 1, 8), datetime(2024, 1, 9)).select("kwh")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(time_chunk" in plan and "GreaterThanOrEqual(time" in plan
    assert kept.count() == I.readings(spark, SF).filter("time BETWEEN '2024-01-08' AND '2024-01-09'").count()
    assert len([d for d in os.listdir(path) if d.startswith("time_chunk=")]) == 5


def test_replace_and_retention(spark):
    df = spark.createDataFrame([(START, "a", 1.0), (START + timedelta(days=500), None, 2.0)], "time timestamp, meter_id string, kwh double")
    assert K.replace_slice(df, df.limit(0), F.col("meter_id") == "a").count() == 1
    assert [r["kwh"] for r in K.apply_retention(df, 400, START + timedelta(days=600)).collect()] == [2.0]


def test_daily_totals_fill_gaps(spark):
    df = spark.createDataFrame([(START, "a", 1.0), (START + timedelta(days=2), "a", 2.0), (START, "b", 5.0)], "time timestamp, meter_id string, kwh double")
    got = {(r["meter_id"], r["day"]): r["daily_kwh"] for r in P.daily_totals(df).collect()}
    assert got == {("a", date(2023, 1, 1)): 1.0, ("a", date(2023, 1, 2)): 0.0, ("a", date(2023, 1, 3)): 2.0, ("b", date(2023, 1, 1)): 5.0}


def test_daily_totals_shuffle_no_empty_days(spark):
    rows = [(START, "a", 1.0), (START + timedelta(days=40), "a", None), (START, None, 3.0), (START + timedelta(days=1), None, 4.0), (None, "a", 9.0), (None, "c", 9.0)]
    df = spark.createDataFrame(rows, "time timestamp, meter_id string, kwh double")
    daily = P.daily_totals(df)
    got = daily.collect()
    assert sorted((r["meter_id"] or "", r["day"].toordinal(), r["daily_kwh"]) for r in got) == sorted(
        [("", START.toordinal() + i, 0.0) for i in range(2)] + [("a", START.toordinal() + i, 1.0 * (i == 0)) for i in range(41)]
    )
    plan = daily._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert {r["meter_id"] for r in R.keep_largest(daily, 1).collect()} == {"a"}


def test_keys_grow_and_stay(spark):
    first = ST.resolve_keys(None, spark.createDataFrame([("b",), ("a",), ("b",)], "code string"), ["code"], "key")
    assert {r["code"]: r["key"] for r in first.collect()} == {"a": 1, "b": 2}
    more = ST.resolve_keys(first, spark.createDataFrame([("c",), ("a",)], "code string"), ["code"], "key")
    assert {r["code"]: r["key"] for r in more.collect()} == {"a": 1, "b": 2, "c": 3}


def test_scd2(spark):
    versions = spark.createDataFrame([("m1", START, "x"), ("m2", START, "y")], "meter_id string, valid_from timestamp, profile string")
    dim = ST.scd2_history(versions)
    later = START + timedelta(days=10)
    updates = spark.createDataFrame([("m1", "z"), ("m2", "y"), ("m3", None)], "meter_id string, profile string")
    merged = ST.scd2_merge(dim, updates, ["profile"], F.lit(later).cast("timestamp"))
    rows = {(r["meter_id"], r["profile"]): r for r in merged.collect()}
    assert len(rows) == 4 and not rows["m1", "x"]["is_current"] and rows["m1", "x"]["valid_to"] == later
    assert rows["m1", "z"]["is_current"] and rows["m3", None]["is_current"] and rows["m2", "y"]["valid_to"] is None
    assert len({r["meter_key"] for r in rows.values()}) == 4
    again = ST.scd2_merge(merged, updates, ["profile"], F.lit(later).cast("timestamp"))
    assert again.count() == 4
    facts = spark.createDataFrame([("m1", START + timedelta(days=d)) for d in (-1, 1, 10)], "meter_id string, time timestamp")
    got = [r["profile"] for r in ST.as_of_join(facts, merged, ["profile"]).orderBy("time").collect()]
    assert got == [None, "x", "z"]


def test_legacy_views_and_sql_functions(spark):
    readings = I.readings(spark, SF)
    star = ST.build_star(readings, readings.select("meter_id").distinct())
    ST.create_legacy_views(star)
    assert spark.sql("SELECT count(*) FROM meter_readings").first()[0] == 1000
    assert spark.sql("SELECT sum(reading_count) FROM meter_hourly").first()[0] == 1000
    sql_functions.register(spark)
    row = spark.sql("SELECT date_key_of(TIMESTAMP'2024-02-29 10:00:00') k, season_of(TIMESTAMP'2024-02-29 10:00:00') s").first()
    assert (row["k"], row["s"]) == (20240229, "winter")
    days = ST.dim_date(spark)
    assert days.count() == 2191 and days.filter("day_of_week = 0 AND NOT is_weekend").count() == 0


def test_violations(spark):
    df = spark.createDataFrame([("a", 1, "low"), ("a", 1, "odd"), (None, 2, None)], "m string, t int, severity string")
    known = spark.createDataFrame([(1,)], "t int")
    got = {r["rule"]: r["n"] for r in ST.violations(df, ["m"], {"uq": ["m", "t"]}, {"fk": ("t", known, "t")}, {"severity": ["low"]}).collect()}
    assert got == {"not_null_m": 1, "domain_severity": 1, "uq": 1, "fk": 1}


def test_messages(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 0, 1), "M1", 5.0, True, "london")], READINGS)
    row = K.to_messages(df).first()
    assert row["key"] == "M1"
    assert json.loads(row["value"]) == {"timestamp": "2026-01-01T00:01:00Z", "meter_id": "M1", "kwh": 5.0, "is_anomaly": True, "source": "london"}


def test_scheduled_refresh(spark):
    raw = I.readings(spark, SF)
    stale = R.rollup(raw, "1 hour").withColumn("kwh_total", F.lit(-1.0))
    out = R.scheduled_refresh(stale, raw, "1 hour", datetime(2024, 1, 20, 12, 30))
    fresh = [r["bucket"] for r in out.filter("kwh_total <> -1").select("bucket").distinct().collect()]
    assert set(fresh) <= {datetime(2024, 1, 20, 10)} and out.count() == stale.count()


def test_contract_lists_match():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) >= 119


def test_entry_runs(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["total_kwh"] >= rows[-1]["total_kwh"]


def test_csv_files_with_different_headers(spark, tmp_path):
    from wattline.sources.readings import read_readings_csv

    (tmp_path / "a_meter_readings.csv").write_text("time,meter_id,kwh,is_anomaly\n2024-01-01 00:00:00,m1,1.5,true\n")
    (tmp_path / "b c_meter_readings.csv").write_text("meter_id,time,is_anomaly,kwh,source\nm2,2024-01-01 00:00:00,false,2.5,s\n")
    got = {r["meter_id"]: (r["kwh"], r["is_anomaly"], r["source"]) for r in read_readings_csv(spark, str(tmp_path)).collect()}
    assert got == {"m1": (1.5, True, "a_meter_readings"), "m2": (2.5, False, "s")}
    (tmp_path / "c_meter_readings.csv").write_text("time,meter_id,is_anomaly\n2024-01-01 00:00:00,m1,true\n")
    with pytest.raises(Exception, match="c_meter_readings"):
        read_readings_csv(spark, str(tmp_path))


def test_history_keeps_untracked_attributes(spark):
    from wattline.operators.star import scd2_merge

    dim = spark.sql(
        "SELECT 1 AS meter_key, 'm1' AS meter_id, 'x' AS profile, 'Paris' AS location, 7 AS source_key, "
        "timestamp'2024-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current"
    )
    updates = spark.createDataFrame([("m1", "z"), ("m2", "y")], "meter_id string, profile string")
    out = scd2_merge(dim, updates, ["profile"], F.lit("2024-02-01").cast("timestamp")).filter("is_current").orderBy("meter_id").collect()
    assert [(r["meter_id"], r["profile"], r["location"], r["source_key"]) for r in out] == [("m1", "z", "Paris", 7), ("m2", "y", None, None)]


def test_city_period_from_text_times(spark):
    from wattline.sources.feeds import sheet_minutes, unpivot_city

    sheet = spark.createDataFrame([("2024-01-01 00:00:00", "1"), ("2024-01-01 01:00:00", "1")], "DateTime string, zone1 string")
    assert sheet_minutes("city", sheet, "DateTime") == 60
    assert {r["kwh"] for r in unpivot_city(sheet, "city").collect()} == {0.207}


@pytest.mark.parametrize(("master", "alone"), [("local", True), ("local[*]", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_scratch_of_our_own_only_on_one_machine(master, alone, monkeypatch, tmp_path):
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    asked = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, other: other),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None),
    )
    if alone:
        assert session.shared_dir(asked) == str(tmp_path)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(asked)
