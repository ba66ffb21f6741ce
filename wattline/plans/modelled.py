"""Registered queries: joins, star schema, windows, detectors, forecasts, scoring, streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from wattline.functions import time as C
from wattline.operators import detect as D
from wattline.operators import forecast as FC
from wattline.operators import inject as J
from wattline.operators import isolation, reconstruction
from wattline.operators import score as SC
from wattline.operators import series as S
from wattline.operators import star as ST
from wattline.operators import windows as W
from wattline.plans import inputs as I
from wattline.plans.registry import ctes, query, rates
from wattline.schema import READING_COLUMNS
from wattline.session import scratch_path, settled
from wattline.sinks import maintain as M
from wattline.sinks import tables as K
from wattline.sources import readings as SR
from wattline.streaming import jobs as ST_JOBS


def r(column, digits: int = 9):
    return F.round(column, digits)


def rounded(df, *columns, digits: int = 9):
    return df.withColumns({c: r(c, digits) for c in columns})


# ---- joins and residual detection ----------------------------------------------------------------------


@query(
    "JOI1",
    ctes("mhourly predictions") + "SELECT time, meter_id, kwh AS kwh_actual, kwh_pred AS kwh_expected, round(abs(kwh - kwh_pred), 9) AS residual "
    "FROM mhourly JOIN predictions USING (meter_id, time)",
)
def actual_vs_forecast(spark, folder):
    series = I.meter_series(spark, folder)
    return rounded(D.actual_vs_forecast(series, I.meter_predictions(series)), "residual")


ZSCORE = (
    "z AS (SELECT *, residual / (stddev_samp(residual) OVER (PARTITION BY meter_id ORDER BY time, kwh_actual, kwh_expected "
    "ROWS BETWEEN 95 PRECEDING AND CURRENT ROW) + 1e-8) AS z_score FROM (SELECT time, meter_id, kwh AS kwh_actual, "
    "kwh_pred AS kwh_expected, abs(kwh - kwh_pred) AS residual FROM mhourly JOIN predictions USING (meter_id, time) {where})) "
    "SELECT meter_id, time AS reading_time, kwh_actual, kwh_expected, round(kwh_actual - kwh_expected, 9) AS deviation, round(z_score, 4) AS z_score, "
    "CASE WHEN z_score > 6 THEN 'high' WHEN z_score > 4.5 THEN 'medium' ELSE 'low' END AS severity FROM z WHERE z_score > 3.0 {more}"
)


@query(
    "DET2 WIN1 SCA10",
    ctes("mhourly predictions") + ", " + ZSCORE.format(where="WHERE time >= TIMESTAMP '2024-01-10 00:00:00'", more=""),
)
def residual_zscore(spark, folder):
    series = I.meter_series(spark, folder)
    out = D.residual_zscore(series.drop("pos", "n"), I.meter_predictions(series), datetime(2024, 1, 10), calendar_bound=True)
    return rounded(rounded(out, "deviation"), "z_score", digits=4)


@query(
    "DET2 WIN1",
    ctes("mhourly predictions") + ", " + ZSCORE.format(where="", more="AND time >= TIMESTAMP '2024-01-10 00:00:00'"),
)
def residual_zscore_history(spark, folder):
    series = I.meter_series(spark, folder)
    out = D.residual_zscore(series.drop("pos", "n"), I.meter_predictions(series), datetime(2024, 1, 10), history=True, calendar_bound=True)
    return rounded(rounded(out, "deviation"), "z_score", digits=4)


@query(
    "SNK6",
    ctes("forecasts") + "SELECT time, group_key AS meter_id, 'seasonal_naive' AS model, round(forecast, 9) AS kwh_pred, "
    "round(forecast * 0.9, 9) AS kwh_lower, round(forecast * 1.1, 9) AS kwh_upper FROM forecasts",
)
def predictions_from_forecasts(spark, folder):
    fc = FC.seasonal_naive(I.source_series(spark, folder), "source")
    return rounded(K.predictions_from_forecasts(fc), "kwh_pred", "kwh_lower", "kwh_upper")


@query(
    "JOI2",
    ctes("series bestfc") + "SELECT s.source, s.time, s.kwh, f.forecast, CAST(f.horizon_step AS INTEGER) AS horizon_step, "
    "f.forecast IS NOT NULL AS covered FROM series s LEFT JOIN bestfc f USING (source, time)",
)
def attach_forecast(spark, folder):
    series = I.source_series(spark, folder)
    out = D.attach_forecast(series, FC.seasonal_naive(series, "source"), "source")
    return out.select("source", "time", "kwh", "forecast", "horizon_step", "covered")


@query(
    "JOI5",
    ctes("oreadings customers") + "SELECT DISTINCT meter_id FROM oreadings WHERE meter_id NOT IN (SELECT meter_id FROM customers WHERE profile <> 'BUILDING')",
)
def missing_members(spark, folder):
    dim = I.meters(spark, folder).filter("profile <> 'BUILDING'")
    return ST.missing_members(I.order_readings(spark, folder), dim)


@query(
    "JOI6",
    ctes("oreadings") + "SELECT meter_id, arg_min(source, (time, source)) AS source FROM oreadings GROUP BY 1",
)
def first_source(spark, folder):
    return ST.first_source(I.order_readings(spark, folder))


@query(
    "JOI8",
    ctes("flagged") + "SELECT source, time, truth, pred FROM flagged",
)
def align_flags(spark, folder):
    flags = _flags(spark, folder)
    truth = flags.select("source", "time", "truth")
    out = SC.align(truth, flags.select("source", "time", "pred"), "source", ("time",), calendar_bound=True)
    return out.select("source", "time", "truth", "pred")


# ---- star schema ---------------------------------------------------------------------------------------


def _star(spark, folder):
    readings, meters = I.order_readings(spark, folder), I.meters(spark, folder)
    # Half of the meters are only known by their readings.
    return readings, ST.build_star(readings, meters.filter("profile <> 'BUILDING'"))


@query(
    "JOI3 JOI4 PRJ6 MOD4",
    ctes("ofacts") + "SELECT time, meter_id, kwh, is_anomaly, source FROM ofacts",
)
def legacy_readings(spark, folder):
    _, star = _star(spark, folder)
    return ST.legacy_readings(star["fact_meter_reading"], star["dim_meter"], star["dim_source"])


@query(
    "JOI4 SCA6",
    ctes("ofacts") + "SELECT CAST(year(time) * 10000 + month(time) * 100 + day(time) AS INTEGER) AS date_key, source AS source_code, "
    "count(*) AS facts, round(sum(kwh), 2) AS kwh FROM ofacts GROUP BY 1, 2",
)
def fact_readings_by_day(spark, folder):
    _, star = _star(spark, folder)
    facts = star["fact_meter_reading"].join(star["dim_source"].select("source_key", "source_code"), "source_key")
    return facts.groupBy("date_key", "source_code").agg(F.count(F.lit(1)).alias("facts"), r(F.sum("kwh"), 2).alias("kwh"))


@query(
    "AGG4",
    ctes("ofacts") + "SELECT date_trunc('hour', time) AS bucket, meter_id, round(sum(kwh), 2) AS kwh_total, round(avg(kwh), 4) AS kwh_avg, "
    "max(kwh) AS kwh_max, count(*) AS reading_count, count(*) FILTER (WHERE is_anomaly) AS anomaly_count FROM ofacts GROUP BY 1, 2",
)
def fact_reading_hourly(spark, folder):
    _, star = _star(spark, folder)
    named = star["fact_reading_hourly"].join(star["dim_meter"].select("meter_key", "meter_id"), "meter_key").drop("meter_key")
    return named.withColumn("kwh_total", r("kwh_total", 2)).withColumn("kwh_avg", r("kwh_avg", 4))


@query(
    "MOD1 MOD4 JOI5 JOI6",
    ctes("oreadings customers") + ", ids AS (SELECT meter_id FROM customers WHERE profile <> 'BUILDING' UNION SELECT meter_id FROM oreadings) "
    "SELECT i.meter_id, f.source AS source_code, c.profile, c.location, true AS is_current, true AS key_in_range FROM ids i "
    "LEFT JOIN (SELECT meter_id, arg_min(source, (time, source)) AS source FROM oreadings GROUP BY 1) f ON f.meter_id = i.meter_id "
    "LEFT JOIN (SELECT * FROM customers WHERE profile <> 'BUILDING') c ON c.meter_id = i.meter_id",
)
def meter_dimension(spark, folder):
    _, star = _star(spark, folder)
    dim = star["dim_meter"]
    size = dim.agg(F.count(F.lit(1)), F.count_distinct("meter_key")).first()
    named = dim.join(star["dim_source"].select("source_key", "source_code"), "source_key", "left")
    in_range = F.col("meter_key").between(1, size[0]) & F.lit(size[0] == size[1])
    return named.select("meter_id", "source_code", "profile", "location", "is_current", in_range.alias("key_in_range"))


@query(
    "MOD1",
    ctes("readings") + "SELECT DISTINCT source AS source_code, source IN ('click', 'view') AS old_key FROM readings",
)
def resolve_source_keys(spark, folder):
    """Sources of a first load keep their keys when the others arrive."""
    base = I.readings(spark, folder)
    first = ST.dim_source(base.filter(F.col("source").isin("click", "view")))
    both = ST.dim_source(base, first)
    return both.select("source_code", (F.col("source_key") <= 2).alias("old_key"))


@query(
    "MOD2 SCA6",
    ctes("readings") + "SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS day, CAST(year(d) AS INTEGER) AS year, "
    "CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week, "
    "dayofweek(d) IN (0, 6) AS is_weekend, CASE WHEN month(d) IN (12, 1, 2) THEN 'winter' WHEN month(d) <= 5 THEN 'spring' "
    "WHEN month(d) <= 8 THEN 'summer' ELSE 'autumn' END AS season, false AS is_holiday FROM "
    "(SELECT CAST(unnest(generate_series(date_trunc('day', min(o_orderdate)), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)",
)
def dim_date(spark, folder):
    """The calendar of the days that the orders span."""
    lo, hi = I.order_readings(spark, folder).agg(F.to_date(F.min("time")), F.to_date(F.max("time"))).first()
    return ST.dim_date(spark, lo, hi).drop("tariff_period")


def _meter_history(spark, folder):
    """Two versions for customers with a negative balance: their segment up to 1998, then a watch list."""
    base = I.table(spark, folder, "customer").select(
        F.concat(F.lit("CUST_"), F.col("c_custkey").cast("string")).alias("meter_id"),
        F.col("c_mktsegment").alias("profile"),
        "c_acctbal",
    )
    first = base.filter("profile <> 'BUILDING'").select("meter_id", F.lit(datetime(1992, 1, 1)).alias("valid_from"), "profile")
    dim = ST.scd2_history(first)
    watched = F.when(F.col("c_acctbal") < 2000, "WATCH").otherwise(F.col("profile"))
    updates = base.select("meter_id", watched.alias("profile"))
    return ST.scd2_merge(dim, updates, ["profile"], F.lit(datetime(1998, 1, 1)).cast("timestamp"))


HISTORY = (
    "c AS (SELECT 'CUST_' || c_custkey AS meter_id, c_mktsegment AS old, CASE WHEN c_acctbal < 2000 THEN 'WATCH' ELSE c_mktsegment END AS new FROM customer), "
    "h AS (SELECT meter_id, old AS profile, TIMESTAMP '1992-01-01' AS valid_from, CASE WHEN old <> new THEN TIMESTAMP '1998-01-01' END AS valid_to, old = new AS is_current FROM c WHERE old <> 'BUILDING' "
    "UNION ALL SELECT meter_id, new, TIMESTAMP '1998-01-01', CAST(NULL AS TIMESTAMP), true FROM c WHERE old = 'BUILDING' OR old <> new) "
)


@query("MOD3", "WITH " + HISTORY + "SELECT meter_id, profile, valid_from, valid_to, is_current FROM h")
def meter_history(spark, folder):
    return _meter_history(spark, folder).select("meter_id", "profile", "valid_from", "valid_to", "is_current")


@query(
    "MOD3",
    "WITH " + HISTORY + "SELECT o_orderkey, o_orderdate AS time, h.profile FROM orders LEFT JOIN h ON h.meter_id = 'CUST_' || o_custkey "
    "AND o_orderdate >= h.valid_from AND (h.valid_to IS NULL OR o_orderdate < h.valid_to)",
)
def profile_as_of(spark, folder):
    orders = I.table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("time"),
        F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")).alias("meter_id"),
    )
    return ST.as_of_join(orders, _meter_history(spark, folder), ["profile"]).select("o_orderkey", "time", "profile")


@query(
    "PRJ6 JOI3",
    ctes("predictions") + "SELECT time, meter_id, model, kwh_pred, round(kwh_pred * 0.9, 9) AS kwh_lower, round(kwh_pred * 1.1, 9) AS kwh_upper FROM predictions",
)
def legacy_predictions(spark, folder):
    series = I.meter_series(spark, folder)
    predictions = settled(I.meter_predictions(series), "predictions")
    sources = ST.dim_source(series)
    meters = ST.dim_meter(series.select("meter_id").distinct(), series, sources)
    models = ST.dim_model(predictions)
    facts = ST.build_fact_predictions(predictions, meters, models)
    return rounded(ST.legacy_predictions(facts, meters, models), "kwh_lower", "kwh_upper")


@query(
    "PRJ6 MOD4",
    ctes("readings") + "SELECT meter_id, time AS reading_time, kwh AS kwh_actual, round(kwh / 1.75, 9) AS kwh_expected, round(kwh - kwh / 1.75, 9) AS deviation, "
    "CASE WHEN kwh - kwh / 1.75 > 1.0 THEN 'high' ELSE 'medium' END AS severity FROM readings WHERE is_anomaly",
)
def legacy_events(spark, folder):
    base = I.readings(spark, folder)
    events = K.events_from_flags(base.withColumn("source", F.lit(None).cast("string")))
    meters = ST.dim_meter(base.select("meter_id").distinct(), base, ST.dim_source(base))
    return rounded(ST.legacy_events(ST.build_fact_events(events, meters), meters), "kwh_expected", "deviation")


@query(
    "MOD4 AGG8",
    ctes("oreadings ofacts") + "SELECT 'old_readings' AS item, count(*) AS n FROM (SELECT DISTINCT meter_id, time FROM oreadings) UNION ALL "
    "SELECT 'new_readings', count(*) FROM ofacts",
)
def star_parity(spark, folder):
    readings, star = _star(spark, folder)
    from wattline.operators.rollups import table_counts

    return table_counts({"old_readings": readings.select("meter_id", "time").distinct(), "new_readings": star["fact_meter_reading"]})


@query(
    "MOD5 PRJ1",
    ctes("ofacts") + "SELECT count(*) AS facts, round(sum(kwh), 2) AS kwh FROM ofacts WHERE time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-06-30'",
)
def stored_facts_in_range(spark, folder):
    """Facts written by chunk, then read back for half a year with chunk pruning."""
    from wattline.operators.rollups import time_filter

    _, star = _star(spark, folder)
    path = scratch_path(spark, "facts")
    K.write_fact(star["fact_meter_reading"], path, ["meter_key"])
    kept = time_filter(spark.read.parquet(path), "time", datetime(1996, 1, 1), datetime(1996, 6, 30))
    return kept.agg(F.count(F.lit(1)).alias("facts"), r(F.sum("kwh"), 2).alias("kwh"))


@query(
    "MOD6",
    ctes("oreadings") + "SELECT time, meter_id, kwh FROM oreadings WHERE time >= TIMESTAMP '2000-06-01' - INTERVAL 400 DAY",
)
def apply_retention(spark, folder):
    kept = K.apply_retention(I.order_readings(spark, folder), 400, datetime(2000, 6, 1))
    return kept.select("time", "meter_id", "kwh")


@query(
    "MOD8",
    ctes("copies customers") + "SELECT 'not_null_time' AS rule, count(*) FILTER (WHERE time IS NULL) AS n FROM copies UNION ALL "
    "SELECT 'not_null_kwh', count(*) FILTER (WHERE source = 'view') FROM copies UNION ALL "
    "SELECT 'domain_severity', count(*) FILTER (WHERE source = 'click') FROM copies UNION ALL "
    "SELECT 'unique_meter_time', CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM copies GROUP BY meter_id, time) UNION ALL "
    "SELECT 'fk_meter', count(*) FILTER (WHERE source <> 'view') FROM copies",
)
def violations(spark, folder):
    base = I.with_copies(I.readings(spark, folder))
    dirty = base.withColumn("kwh", F.when(F.col("source") != "view", F.col("kwh"))).withColumn(
        "severity", F.when(F.col("source") == "click", "extreme").when(F.col("source") == "error", "high")
    )
    known = base.filter(F.col("source") == "view").select("meter_id").distinct()
    return ST.violations(
        dirty,
        ["time", "kwh"],
        {"unique_meter_time": ["meter_id", "time"]},
        {"fk_meter": ("meter_id", known, "meter_id")},
        {"severity": ["low", "medium", "high"]},
    )


# ---- windows -------------------------------------------------------------------------------------------


@query(
    "WIN2 DET1",
    ctes("readings") + ", f AS (SELECT *, row_number() OVER o - 1 AS pos, median(kwh) OVER w AS med, mad(kwh) OVER w AS mad FROM readings "
    "WINDOW o AS (PARTITION BY meter_id ORDER BY time, kwh), w AS (PARTITION BY meter_id ORDER BY time, kwh ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)) "
    "SELECT meter_id, time, kwh, CASE WHEN pos >= 24 THEN round(med, 9) END AS rolling_median, CASE WHEN pos >= 24 THEN round(mad, 9) END AS rolling_mad, "
    "pos >= 24 AND abs(kwh - med) / CASE WHEN mad > 0 THEN mad ELSE 1e-9 END > 3.5 AS flag FROM f",
)
def mad_flags(spark, folder):
    """On raw readings per meter, where a meter may be of any size."""
    indexed = S.index_series(I.readings(spark, folder), "meter_id", ("time", "kwh"))
    out = D.mad_flags(indexed, "meter_id")
    return rounded(out.select("meter_id", "time", "kwh", "rolling_median", "rolling_mad", "flag"), "rolling_median", "rolling_mad")


SEASONAL = (
    "steps AS (SELECT source, n, greatest(1, 1440 // cadence) AS d, CASE WHEN n >= 7 * greatest(1, 1440 // cadence) + 24 "
    "THEN 7 * greatest(1, 1440 // cadence) ELSE greatest(1, 1440 // cadence) END AS lag FROM cad), "
    "res AS (SELECT s.*, t.lag, CASE WHEN s.pos >= t.lag THEN s.kwh - p.kwh ELSE 0 END AS residual FROM series s JOIN steps t USING (source) "
    "LEFT JOIN series p ON p.source = s.source AND p.pos = s.pos - t.lag), "
    "sflags AS (SELECT *, pos >= 24 AND pos >= lag AND n >= 48 AND coalesce(abs(residual - med) / CASE WHEN mad > 0 THEN mad ELSE 1e-9 END > 3.5, false) AS flag FROM ("
    "SELECT *, median(residual) OVER w AS med, mad(residual) OVER w AS mad FROM res "
    "WINDOW w AS (PARTITION BY source ORDER BY time ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))) "
)


@query("WIN3", ctes("series cad") + ", " + SEASONAL + "SELECT source, time, round(residual, 9) AS residual FROM res")
def seasonal_residual(spark, folder):
    out = W.seasonal_residual(I.source_series(spark, folder), "source")
    return rounded(out.select("source", "time", "residual"), "residual")


@query("DET3", ctes("series cad") + ", " + SEASONAL + "SELECT source, time, kwh, flag FROM sflags")
def seasonal_flags(spark, folder):
    return D.seasonal_flags(I.source_series(spark, folder), "source").select("source", "time", "kwh", "flag")


@query(
    "DET5",
    ctes("series cad") + ", " + SEASONAL + "SELECT source, count(*) AS samples, count(*) FILTER (WHERE flag) AS detected, "
    "count(*) FILTER (WHERE flag OR source = 'error') AS labelled FROM sflags GROUP BY 1",
)
def detect_seasonal_report(spark, folder):
    """Seasonal branch of the combined detector with old labels kept."""
    series = I.source_series(spark, folder).withColumn("is_anomaly", F.col("source") == "error")
    found = settled(D.detect(series, "source", preserve=True, isolation=False), "detected")
    labelled = found.groupBy("source").agg(F.count_if("is_anomaly").alias("labelled"))
    return D.detection_report(found, "source").join(labelled, "source")


@query("DET5 DET6")
def detect_combined(spark, folder):
    found = D.detect(I.source_series(spark, folder), "source")
    return found.select("source", "time", "kwh", "flag", "is_anomaly")


@query("DET6")
def isolation_flags(spark, folder):
    out = isolation.isolation_flags(I.source_series(spark, folder), "source")
    return out.select("source", "time", "kwh", "score", "flag")


@query("DET7")
def reconstruction_flags(spark, folder):
    series = I.source_series(spark, folder)
    injected = settled(J.inject(series, "source"), "injected")
    out = reconstruction.reconstruction_flags(series, injected, "source")
    return out.select("source", "time", "kwh", "score", "threshold", "flag")


@query(
    "WIN4",
    ctes("series") + "SELECT source, time, lag(kwh, 1) OVER w AS lag_1, lag(kwh, 2) OVER w AS lag_2, lag(kwh, 24) OVER w AS lag_day, "
    "lag(kwh, 48) OVER w AS lag_2day, lag(kwh, 48) OVER w AS lag_max, "
    "round(avg(kwh) OVER (PARTITION BY source ORDER BY time ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 6) AS mean_day, "
    "round(avg(kwh) OVER (PARTITION BY source ORDER BY time ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 6) AS mean_6 "
    "FROM series WINDOW w AS (PARTITION BY source ORDER BY time) QUALIFY pos >= 48",
)
def lag_features(spark, folder):
    out = W.lag_features(I.source_series(spark, folder), "source", 24, 48)
    columns = ["source", "time", "lag_1", "lag_2", "lag_day", "lag_2day", "lag_max", "mean_day", "mean_6"]
    return rounded(out.select(*columns), "mean_day", "mean_6", digits=6)


@query(
    "WIN5",
    ctes("series") + "SELECT source, time, array_to_string([CAST(CAST(round(v * 100) AS BIGINT) AS VARCHAR) for v in x[1:12]], ',') AS inputs, "
    "array_to_string([CAST(CAST(round(v * 100) AS BIGINT) AS VARCHAR) for v in x[13:16]], ',') AS targets FROM ("
    "SELECT source, time, pos, list(kwh) OVER (PARTITION BY source ORDER BY time ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) AS x FROM series) WHERE pos >= 15",
)
def sequence_windows(spark, folder):
    out = W.sequence_windows(I.source_series(spark, folder), "source", 12, 4)

    def text(column):
        return F.array_join(F.transform(column, lambda v: F.round(v * 100).cast("bigint").cast("string")), ",")

    return out.select("source", "time", text("inputs").alias("inputs"), text("targets").alias("targets"))


RUNS = (
    "runs AS (SELECT source, min(pos) AS run_start, max(pos) AS run_end FROM (SELECT source, pos, pos - row_number() OVER "
    "(PARTITION BY source ORDER BY pos) AS island FROM series WHERE kwh > 100) GROUP BY source, island) "
)


@query("WIN6", ctes("series") + ", " + RUNS + "SELECT * FROM runs")
def flag_runs(spark, folder):
    return S.true_runs(I.source_series(spark, folder), "source", F.col("kwh") > 100)


@query(
    "WIN7",
    ctes("series") + ", " + RUNS + "SELECT s.source, coalesce(max(run_end - run_start + 1), 0) AS max_run FROM (SELECT DISTINCT source FROM series) s "
    "LEFT JOIN runs r ON r.source = s.source GROUP BY 1",
)
def longest_run(spark, folder):
    return S.longest_run(I.source_series(spark, folder), "source", F.col("kwh") > 100)


@query(
    "WIN9",
    ctes("series") + "SELECT source, round(recent, 6) AS recent_std, round(total, 6) AS global_std, CAST(CASE WHEN recent / (total + 1e-8) > 1.5 THEN 192 "
    "WHEN recent / (total + 1e-8) < 0.5 THEN 48 ELSE 96 END AS INTEGER) AS \"window\" FROM (SELECT source, stddev_pop(kwh) FILTER (WHERE pos >= n - 96) AS recent, "
    "stddev_pop(kwh) AS total FROM series GROUP BY 1)",
)
def adaptive_window(spark, folder):
    return rounded(W.adaptive_window(I.source_series(spark, folder), "source"), "recent_std", "global_std", digits=6)


@query(
    "WIN10",
    ctes("series") + "SELECT source, time, round((kwh - min(kwh) OVER g) / (max(kwh) OVER g - min(kwh) OVER g), 9) AS scaled, "
    "round((kwh - avg(kwh) OVER g) / stddev_pop(kwh) OVER g, 6) + 0::DOUBLE AS z FROM series WINDOW g AS (PARTITION BY source)",
)
def scaled_series(spark, folder):
    series = I.source_series(spark, folder)
    both = W.znorm(W.minmax_scale(series, "source"), "source")
    return both.select("source", "time", r("scaled").alias("scaled"), (r("z", 6) + 0.0).alias("z"))


# ---- injection -----------------------------------------------------------------------------------------


@query(
    "INJ1 SCA11",
    ctes("points") + "SELECT source, time, round(kwh, 4) AS kwh, hit AS is_anomaly, array_to_string(label, '+') AS anomaly_type FROM points",
)
def inject_points(spark, folder):
    out = J.inject_points(J.unlabelled(I.source_series(spark, folder)), "source")
    return rounded(out.select("source", "time", "kwh", "is_anomaly", "anomaly_type"), "kwh", digits=4)


@query(
    "INJ2",
    ctes("series swaps").replace("FROM points", "FROM series") + "SELECT s.source, s.time, coalesce(w.new_kwh, s.kwh) AS kwh, "
    "w.new_kwh IS NOT NULL AS is_anomaly, CASE WHEN w.new_kwh IS NULL THEN '' ELSE 'contextual_day_night_swap' END AS anomaly_type "
    "FROM series s LEFT JOIN swaps w USING (source, pos)",
)
def inject_swap(spark, folder):
    out = J.inject_swap(J.unlabelled(I.source_series(spark, folder)), "source")
    return out.select("source", "time", "kwh", "is_anomaly", "anomaly_type")


@query(
    "INJ3",
    ctes("series") + "SELECT source, time, round(CASE WHEN pos >= n - 6 THEN kwh + avg(kwh) OVER (PARTITION BY source) * 0.5 * ((pos - n + 7) / 6) ELSE kwh END, 4) AS kwh, "
    "pos >= n - 6 AS is_anomaly, CASE WHEN pos >= n - 6 THEN 'trend_drift' ELSE '' END AS anomaly_type FROM series WHERE n >= 12",
)
def inject_drift(spark, folder):
    out = J.inject_drift(J.unlabelled(I.source_series(spark, folder)), "source")
    return rounded(out.select("source", "time", "kwh", "is_anomaly", "anomaly_type"), "kwh", digits=4)


def _injected(spark, folder):
    return settled(J.inject(I.source_series(spark, folder), "source"), "injected")


@query("INJ4", ctes("injected") + "SELECT source, time, round(kwh, 4) AS kwh, is_anomaly, anomaly_type FROM injected")
def inject_all(spark, folder):
    out = _injected(spark, folder)
    return rounded(out.select("source", "time", "kwh", "is_anomaly", "anomaly_type"), "kwh", digits=4)


@query(
    "INJ4",
    ctes("injected") + "SELECT source, label, count(*) AS rows FROM (SELECT source, unnest(string_split(anomaly_type, '+')) AS label "
    "FROM injected WHERE is_anomaly) GROUP BY 1, 2",
)
def injection_report(spark, folder):
    return J.injection_report(_injected(spark, folder), "source")


@query(
    "INJ4",
    ctes("series draws slots swapday") + ", places AS (SELECT source, CASE WHEN is_drop THEN 'point_drop' ELSE 'point_spike' END AS type, CAST(d AS VARCHAR) AS part, "
    "CAST(pos AS BIGINT) AS start_pos, CAST(pos AS BIGINT) AS end_pos, 1 AS steps FROM draws "
    "UNION ALL SELECT source, 'contextual_day_night_swap', CASE WHEN late THEN 'afternoon' ELSE 'night' END, min(pos), max(pos), 6 "
    "FROM slots JOIN swapday USING (source, day) GROUP BY source, late "
    "UNION ALL SELECT source, 'trend_drift', '', max(n) - 6, max(n) - 1, 6 FROM series GROUP BY source HAVING max(n) >= 12) "
    "SELECT p.source, p.type, p.part, p.start_pos, p.end_pos, a.time AS start_time, b.time AS end_time, p.steps FROM places p "
    "JOIN series a ON a.source = p.source AND a.pos = p.start_pos JOIN series b ON b.source = p.source AND b.pos = p.end_pos",
)
def injection_events(spark, folder):
    """Where every injected anomaly lies."""
    return J.injection_events(I.source_series(spark, folder), "source")


# ---- forecasts -----------------------------------------------------------------------------------------


@query(
    "FOR1 SCA13",
    ctes("folds") + "SELECT source, CAST(fold AS INTEGER) AS fold, CAST(cutoff AS BIGINT) AS cutoff, CAST(horizon AS INTEGER) AS horizon FROM folds",
)
def cutoffs(spark, folder):
    plan = FC.fold_plan(I.source_series(spark, folder), "source", 24, 5)
    return plan.select("source", "fold", "cutoff", "horizon")


@query(
    "FOR2",
    ctes("forecasts") + "SELECT group_key, CAST(fold AS INTEGER) AS fold, CAST(horizon_step AS INTEGER) AS horizon_step, time, actual, forecast, "
    "'seasonal_naive' AS model_type FROM forecasts",
)
def seasonal_naive(spark, folder):
    return FC.seasonal_naive(I.source_series(spark, folder), "source")


WAPE = (
    "SELECT {keys} count(*) AS forecast_rows, round(sum(abs(actual - forecast)) FILTER (WHERE horizon_step = 1) / "
    "greatest(sum(abs(actual)) FILTER (WHERE horizon_step = 1), 1e-9), 9) AS wape_1_step, "
    "round(sum(abs(actual - forecast)) / greatest(sum(abs(actual)), 1e-9), 9) AS wape_horizon FROM forecasts {group}"
)


@query("SCO1", ctes("forecasts") + WAPE.format(keys="group_key,", group="GROUP BY group_key"))
def wape_by_group(spark, folder):
    fc = FC.seasonal_naive(I.source_series(spark, folder), "source")
    return rounded(SC.wape(fc, "group_key"), "wape_1_step", "wape_horizon")


@query(
    "FOR6 SCO1",
    ctes("forecasts") + WAPE.format(keys="'seasonal_naive' AS model_name, 'completed' AS status, true AS \"primary\",", group=""),
)
def benchmark_naive(spark, folder):
    _, table = FC.benchmark(I.source_series(spark, folder), "source", (FC.NAIVE,))
    return rounded(table, "wape_1_step", "wape_horizon")


@query(
    "FOR6",
    ctes("folds") + "SELECT model_name, source AS group_key, max(n) AS samples, CAST(max(cadence) AS INTEGER) AS cadence_minutes, CAST(max(horizon) AS INTEGER) AS horizon_steps, "
    "5 AS folds_requested, CAST(count(DISTINCT fold) AS INTEGER) AS folds_used, 'completed' AS status FROM folds, "
    "(SELECT unnest(['seasonal_naive', 'seasonal_regression', 'seasonal_regression_tuned']) AS model_name) GROUP BY 1, 2",
)
def benchmark_status(spark, folder):
    """What each model did in each group; its errors and model types are not in SQL's reach."""
    models = {name: FC.MODELS[name] for name in (FC.NAIVE, FC.SEASONAL_MODEL, FC.TUNED_MODEL)}
    out = FC.benchmark_status(I.source_series(spark, folder), "source", models)
    return out.select(
        "model_name", "group_key", "samples", F.col("cadence_minutes").cast("int").alias("cadence_minutes"),
        F.col("horizon_steps").cast("int").alias("horizon_steps"), "folds_requested", "folds_used", "status",
    )


@query("FOR6 FOR3 FOR4")
def benchmark_models(spark, folder):
    _, table = FC.benchmark(I.source_series(spark, folder), "source")
    return table


@query("FOR3")
def lag_regression(spark, folder):
    return FC.lag_regression(I.source_series(spark, folder), "source")


@query("FOR4")
def seasonal_regression(spark, folder):
    return FC.seasonal_regression(I.source_series(spark, folder), "source")


@query("FOR4 AGG18")
def seasonal_outlook(spark, folder):
    from wattline.operators.rollups import daily_series

    daily = daily_series(I.readings(spark, folder)).select("source", F.col("ds").alias("time"), F.col("y").alias("kwh"))
    return FC.seasonal_outlook(S.index_series(daily, "source", ("time",), calendar_bound=True), "source")


@query("FOR5")
def sequence_regression(spark, folder):
    """Fit on all but the last day, update with the last day, then forecast."""
    series = I.source_series(spark, folder)
    last_day = F.col("pos") >= F.col("n") - 24 - 99  # a sequence of 96 values and 4 targets may begin before the day
    old = series.filter(F.col("pos") < F.col("n") - 24).withColumn("n", F.col("n") - 24)
    new = series.filter(last_day).withColumn("pos", F.col("pos") - (F.col("n") - 123)).withColumn("n", F.lit(123).cast("long"))
    stored = FC.sequence_statistics(old, "source")
    merged = FC.update_statistics(stored, FC.sequence_statistics(new, "source"))
    return FC.sequence_regression(series, "source", statistics=merged)


@query(
    "FOR4",
    ctes("forecasts") + "SELECT group_key, CAST(fold AS INTEGER) AS fold, CAST(horizon_step AS INTEGER) AS horizon_step, time, actual FROM forecasts",
)
def regression_targets(spark, folder):
    """Folds, steps and actual values of the regression are those of the naive forecast."""
    out = FC.seasonal_regression_tuned(I.source_series(spark, folder), "source")
    return out.filter("lower <= forecast AND forecast <= upper").select("group_key", "fold", "horizon_step", "time", "actual")


@query(
    "DET7 DET6",
    ctes("injected") + "SELECT source, count(*) AS rows, count(*) FILTER (WHERE pos >= 47) AS scored, true AS within_share FROM injected GROUP BY 1",
)
def detector_coverage(spark, folder):
    """Rows seen by the reconstruction and the isolation detector, and the share the latter may flag."""
    series = I.source_series(spark, folder)
    injected = _injected(spark, folder)
    rebuilt = reconstruction.reconstruction_flags(series, injected, "source")
    isolated = isolation.isolation_flags(injected, "source").groupBy("source").agg(
        (F.count_if("flag") <= 0.01 * F.count(F.lit(1)) + 1).alias("within_share")
    )
    counts = rebuilt.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("score") > 0).alias("scored"))
    return counts.join(isolated, "source")


# ---- scoring -------------------------------------------------------------------------------------------


def _scored(spark, folder):
    """Robust scores of the naive forecast's residuals on the injected series, covered rows only."""
    series = I.source_series(spark, folder)
    injected = settled(J.inject(series, "source"), "injected")
    forecasts = FC.seasonal_naive(series, "source")
    scored = D.forecast_residual_scores(injected, forecasts, "source", 24, ("time",), calendar_bound=True)
    return scored.filter("covered").withColumn("truth", F.col("is_anomaly"))


def _flags(spark, folder):
    flagged = _scored(spark, folder).withColumn("pred", D.exceeds(4.0, 0.12))
    return settled(flagged.select("source", "time", "pos", "n", "truth", "pred", "anomaly_type"), "flags")


@query("DET4", ctes("flagged") + "SELECT source, time, round(residual, 6) AS residual, pred AS flag FROM flagged")
def forecast_residual_flags(spark, folder):
    series = I.source_series(spark, folder)
    cfg = D.DetectorConfig(mad_multiplier=4.0, min_abs_deviation=0.12)
    injected = settled(J.inject(series, "source"), "injected")
    out = D.forecast_residual_flags(
        injected, FC.seasonal_naive(series, "source"), "source", cfg, order=("time",), calendar_bound=True
    )
    return rounded(out.filter("covered").select("source", "time", "residual", "flag"), "residual", digits=6)


CONFUSION = (
    "count(*) FILTER (WHERE truth AND pred) AS tp, count(*) FILTER (WHERE NOT truth AND pred) AS fp, "
    "count(*) FILTER (WHERE truth AND NOT pred) AS fn, count(*) FILTER (WHERE NOT truth AND NOT pred) AS tn"
)


@query("SCO2", ctes("flagged") + rates("source, tp, fp, fn, tn", f"(SELECT source, {CONFUSION} FROM flagged GROUP BY 1)"))
def confusion(spark, folder):
    return rounded(SC.confusion(_flags(spark, folder), "source"), "precision", "recall", "f1")


LABELLED = "(SELECT DISTINCT source, unnest(string_split(anomaly_type, '+')) AS label FROM flagged WHERE anomaly_type <> '')"


@query(
    "SCO3 SET3",
    ctes("flagged") + rates(
        "source, label, tp, fp, fn, tn",
        "(SELECT source, label, " + CONFUSION + " FROM (SELECT f.source, l.label, f.pred, f.truth AND list_contains(string_split(anomaly_type, '+'), l.label) AS truth "
        f"FROM flagged f JOIN {LABELLED} l USING (source)) GROUP BY 1, 2)",
    ),
)
def confusion_by_type(spark, folder):
    return rounded(SC.confusion_by_type(_flags(spark, folder), "source"), "precision", "recall", "f1")


@query("SET3", ctes("flagged") + f"SELECT source, label FROM {LABELLED}")
def anomaly_labels(spark, folder):
    return SC.labels(_flags(spark, folder), "source")


@query(
    "SCO4 WIN8",
    ctes("flagged truns") + ", d AS (SELECT t.source, t.s, min(f.pos) - t.s AS delay FROM truns t LEFT JOIN (SELECT source, pos FROM flagged WHERE pred) f "
    "ON f.source = t.source AND f.pos BETWEEN t.s AND t.e + 2 GROUP BY t.source, t.s), "
    "c AS (SELECT source, floor(median(gap) FILTER (WHERE gap > 0)) AS cadence FROM (SELECT source, floor((epoch(time) - epoch(lag(time) OVER "
    "(PARTITION BY source ORDER BY time))) / 60) AS gap FROM flagged) GROUP BY 1) "
    "SELECT c.source, count(d.s) AS windows, count(d.s) FILTER (WHERE d.delay IS NULL) AS missed_windows, round(avg(d.delay), 9) AS avg_latency_samples, "
    "round(avg(d.delay) * any_value(c.cadence), 6) AS avg_latency_minutes FROM c LEFT JOIN d USING (source) GROUP BY 1",
)
def detection_latency(spark, folder):
    out = SC.latency(_flags(spark, folder), "source")
    return out.withColumn("avg_latency_samples", r("avg_latency_samples")).withColumn("avg_latency_minutes", r("avg_latency_minutes", 6))


EVENTS = (
    "falses AS (SELECT p.source, count(*) AS fp FROM pruns p WHERE p.e - p.s + 1 >= 5 AND NOT EXISTS (SELECT 1 FROM evts v WHERE v.source = p.source "
    "AND v.detected AND p.e >= v.s - 2 AND p.s <= v.e + 2) GROUP BY 1), "
    "tallies AS (SELECT g.source, coalesce(sum(CAST(v.detected AS INTEGER)), 0)::BIGINT AS tp, coalesce(any_value(f.fp), 0)::BIGINT AS fp, "
    "coalesce(sum(CAST(NOT v.detected AS INTEGER)), 0)::BIGINT AS fn, count(v.s) AS events, "
    "round(avg(greatest(0, coalesce(v.first_after, v.first_any, v.s) - v.s)) FILTER (WHERE v.detected), 9) AS avg_latency_samples "
    "FROM (SELECT DISTINCT source FROM flagged) g LEFT JOIN evts v USING (source) LEFT JOIN falses f USING (source) GROUP BY 1) "
)


@query("SCO5", ctes("flagged evts pruns") + ", " + EVENTS + rates("source, tp, fp, fn, events, avg_latency_samples", "tallies"))
def event_scores(spark, folder):
    out = SC.event_scores(_flags(spark, folder), "source")
    return rounded(out, "precision", "recall", "f1", "avg_latency_samples")


@query(
    "SCO6 SCO5",
    ctes("flagged evts pruns") + ", " + EVENTS + rates(
        "tp, fp, fn, events",
        "(SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(events) AS BIGINT) AS events FROM tallies)",
    ),
)
def event_scores_overall(spark, folder):
    out = SC.evaluate(_flags(spark, folder), "source")["events_overall"]
    return rounded(out, "precision", "recall", "f1")


@query(
    "SCO6",
    ctes("flagged pruns") + f", lab AS {LABELLED}, typed AS (SELECT f.source, l.label, f.pos, f.pred, f.truth AND list_contains(string_split(anomaly_type, '+'), l.label) AS truth "
    "FROM flagged f JOIN lab l USING (source)), lruns AS (SELECT source, label, min(pos) AS s, max(pos) AS e FROM (SELECT *, pos - row_number() OVER "
    "(PARTITION BY source, label ORDER BY pos) AS island FROM typed WHERE truth) GROUP BY source, label, island), "
    "lev AS (SELECT t.source, t.label, t.s, t.e, count(f.pos) >= CASE WHEN t.label LIKE 'point_%' THEN 1 ELSE 5 END AS detected FROM lruns t "
    "LEFT JOIN (SELECT source, pos FROM flagged WHERE pred) f ON f.source = t.source AND f.pos BETWEEN t.s - 2 AND t.e + 2 GROUP BY t.source, t.label, t.s, t.e), "
    "lfp AS (SELECT l.source, l.label, count(*) AS fp FROM lab l JOIN pruns p USING (source) WHERE p.e - p.s + 1 >= 5 AND NOT EXISTS (SELECT 1 FROM lev v "
    "WHERE v.source = l.source AND v.label = l.label AND v.detected AND p.e >= v.s - 2 AND p.s <= v.e + 2) GROUP BY 1, 2) "
    + rates(
        "source, label, tp, fp, fn, events",
        "(SELECT l.source, l.label, coalesce(sum(CAST(v.detected AS INTEGER)), 0)::BIGINT AS tp, coalesce(any_value(f.fp), 0)::BIGINT AS fp, "
        "coalesce(sum(CAST(NOT v.detected AS INTEGER)), 0)::BIGINT AS fn, count(v.s) AS events FROM lab l LEFT JOIN lev v USING (source, label) "
        "LEFT JOIN lfp f USING (source, label) GROUP BY 1, 2)",
    ),
)
def event_scores_by_type(spark, folder):
    out = SC.event_scores_by_type(_flags(spark, folder), "source").drop("avg_latency_samples")
    return rounded(out, "precision", "recall", "f1")


@query("SCO7 JOI9", ctes("swept") + rates("mad_multiplier, tp, fp, fn, tn", "swept"))
def threshold_sweep(spark, folder):
    return rounded(SC.sweep(_scored(spark, folder)), "precision", "recall", "f1")


@query(
    "SCO7 TOP4",
    ctes("swept") + ", t AS (" + rates("mad_multiplier, tp, fp, fn, tn", "swept") + ") SELECT * FROM t "
    "ORDER BY (precision >= 0.60) DESC, recall DESC, f1 DESC, mad_multiplier LIMIT 1",
)
def best_operating_point(spark, folder):
    swept = rounded(SC.sweep(_scored(spark, folder)), "precision", "recall", "f1")
    return SC.best_operating_point(swept, 0.60)


SEASONAL_ON_INJECTED = (
    "lags AS (SELECT source, CASE WHEN n >= 7 * greatest(1, 1440 // cadence) + 24 THEN 7 * greatest(1, 1440 // cadence) ELSE greatest(1, 1440 // cadence) END AS lag FROM cad), "
    "ires AS (SELECT s.*, t.lag, CASE WHEN s.pos >= t.lag THEN s.kwh - p.kwh ELSE 0 END AS residual FROM injected s JOIN lags t USING (source) "
    "LEFT JOIN injected p ON p.source = s.source AND p.pos = s.pos - t.lag), "
    "iflags AS (SELECT source, time, pos >= 24 AND pos >= lag AND n >= 48 AND coalesce(abs(residual - med) / CASE WHEN mad > 0 THEN mad ELSE 1e-9 END > 3.5, false) AS pred FROM ("
    "SELECT *, median(residual) OVER w AS med, mad(residual) OVER w AS mad FROM ires "
    "WINDOW w AS (PARTITION BY source ORDER BY time ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))) "
)


@query(
    "SCO8 TOP5",
    ctes("flagged injected cad") + ", " + SEASONAL_ON_INJECTED + ", pair AS (SELECT 'forecast_residual_mad' AS detector, truth, pred FROM flagged UNION ALL "
    "SELECT 'seasonal_residual_mad', f.truth, i.pred FROM flagged f JOIN iflags i USING (source, time)), t AS ("
    + rates("detector, tp, fp, fn", f"(SELECT detector, {CONFUSION} FROM pair GROUP BY 1)")
    + ") SELECT * FROM t ORDER BY f1 DESC, recall DESC, precision DESC, detector DESC LIMIT 1",
)
def best_detector(spark, folder):
    """Row-level winner between the forecast-residual and the seasonal detector on the same rows."""
    series = I.source_series(spark, folder)
    injected = settled(J.inject(series, "source"), "injected")
    scored = D.forecast_residual_scores(injected, FC.seasonal_naive(series, "source"), "source", 24, ("time",), calendar_bound=True)
    scored = settled(scored.filter("covered"), "scored").withColumn("truth", F.col("is_anomaly"))
    residual = scored.withColumn("pred", D.exceeds(4.0, 0.12))
    seasonal = D.seasonal_flags(injected, "source").select("source", "time", F.col("flag").alias("pred"))
    seasonal = scored.select("source", "time", "truth").join(seasonal, ["source", "time"])
    rows = [
        SC.confusion(residual).withColumn("detector", F.lit("forecast_residual_mad")),
        SC.confusion(seasonal).withColumn("detector", F.lit("seasonal_residual_mad")),
    ]
    table = rounded(rows[0].unionByName(rows[1]).drop("tn"), "precision", "recall", "f1")
    return SC.best_detector(table).select("detector", "tp", "fp", "fn", "precision", "recall", "f1")


@query("SCO8 SCO6 DET7")
def detector_league(spark, folder):
    """Best detector on rows and on events, over the residuals of all forecast models and the reconstruction error."""
    series = I.source_series(spark, folder)
    injected = settled(J.inject(series, "source"), "injected")
    flagged = {}
    for name, model in FC.MODELS.items():
        forecasts = settled(model(series, "source").select(*FC.OUTPUT), "forecasts")
        scored = D.forecast_residual_scores(injected, forecasts, "source", 24, ("time",), calendar_bound=True)
        scored = settled(scored.filter("covered").withColumn("truth", F.col("is_anomaly")), "scored")
        best = SC.best_operating_point(SC.sweep(scored), 0.60).first()
        flagged[f"forecast_residual_mad__{name}"] = scored.withColumn("pred", D.exceeds(best["mad_multiplier"], 0.12))
    rebuilt = reconstruction.reconstruction_flags(series, injected, "source")
    flagged["reconstruction"] = rebuilt.withColumn("truth", F.col("is_anomaly")).withColumn("pred", F.col("flag"))
    rows = events = None
    for name, df in flagged.items():
        row = SC.confusion(df).withColumn("detector", F.lit(name))
        event = SC.overall(SC.event_scores(df, "source")).withColumn("detector", F.lit(name))
        rows = row if rows is None else rows.unionByName(row)
        events = event if events is None else events.unionByName(event)
    return SC.rank_detectors(rows, events)


# ---- streams -------------------------------------------------------------------------------------------


def _paths(spark, name):
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


@query(
    "STR1 SRC9 SNK3 STR4",
    ctes("readings") + "SELECT time, meter_id, kwh, source = 'error' AS is_anomaly, CASE WHEN source = 'view' THEN 'kafka_live_replay' ELSE source END AS source FROM readings",
)
def stream_ingest(spark, folder):
    """Every error reading arrives twice; views come without a source, others without a flag."""
    rows = I.readings_stream(spark, folder)
    rows = rows.withColumn("source", F.nullif(F.col("source"), F.lit("view"))).withColumn(
        "is_anomaly", F.when(F.col("is_anomaly"), F.lit(True))
    )
    copies = F.when(F.col("is_anomaly"), F.lit(2)).otherwise(F.lit(1))
    arrivals = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    out, checkpoint = _paths(spark, "ingest")
    ST_JOBS.ingest_stream(K.to_messages(arrivals), out, checkpoint, available_now=True)
    return spark.read.parquet(out).select(*READING_COLUMNS)


@query(
    "STR3 AGG19",
    ctes("readings") + "SELECT date_trunc('hour', time) AS bucket, meter_id, round(sum(kwh), 4) AS kwh_total, max(kwh) AS kwh_max, "
    "count(*) AS reading_count FROM readings GROUP BY 1, 2",
)
def late_refresh(spark, folder):
    """Readings arrive in three batches without any order; after each, the rollup's touched buckets are recomputed."""
    out, checkpoint = _paths(spark, "late")
    arrived, hourly, log = (f"{out}-{name}" for name in ("arrived", "hourly", "log"))
    rows = I.readings(spark, folder).withColumn("part", F.pmod(F.xxhash64("meter_id", "time"), F.lit(3)))
    for part in range(3):
        K.publish(rows.filter(F.col("part") == part), folder=arrived)
        ST_JOBS.ingest_stream(SR.read_messages(spark, folder=arrived), out, checkpoint, available_now=True, logs=[log])
        M.refresh_touched(spark, hourly, log, spark.read.parquet(out), "1 hour")
    return rounded(spark.read.parquet(hourly).select("bucket", "meter_id", "kwh_total", "kwh_max", "reading_count"), "kwh_total", digits=4)


CLOSED = (
    "SELECT bucket, meter_id, round(sum(kwh), 4) AS kwh_total, {columns} FROM (SELECT {bucket} AS bucket, * FROM readings) "
    "WHERE bucket + INTERVAL {width} <= (SELECT date_trunc('millisecond', max(time)) - INTERVAL {delay} FROM readings) GROUP BY 1, 2"
)


def _stream_rollup(spark, folder, width, columns):
    out, checkpoint = _paths(spark, "rollup")
    ST_JOBS.rollup_job(I.readings_stream(spark, folder), width, out, checkpoint, available_now=True)
    return spark.read.parquet(out).withColumn("kwh_total", r("kwh_total", 4)).select("bucket", "meter_id", "kwh_total", *columns)


@query(
    "STR2 STR3",
    ctes("readings") + CLOSED.format(bucket="time_bucket(INTERVAL 15 MINUTE, time)", width="15 MINUTE", delay="1 DAY", columns="max(kwh) AS kwh_max, count(*) AS reading_count"),
)
def stream_rollup_quarter_hour(spark, folder):
    return _stream_rollup(spark, folder, "15 minutes", ["kwh_max", "reading_count"])


@query(
    "STR2 STR3",
    ctes("readings") + CLOSED.format(bucket="date_trunc('hour', time)", width="1 HOUR", delay="3 HOUR", columns="max(kwh) AS kwh_max, count(*) AS reading_count"),
)
def stream_rollup_hourly(spark, folder):
    return _stream_rollup(spark, folder, "1 hour", ["kwh_max", "reading_count"])


@query(
    "STR2 STR3",
    ctes("readings") + CLOSED.format(bucket="date_trunc('day', time)::TIMESTAMP", width="1 DAY", delay="7 DAY", columns="max(kwh) AS kwh_peak, count(*) FILTER (WHERE is_anomaly) AS anomaly_count"),
)
def stream_rollup_daily(spark, folder):
    return _stream_rollup(spark, folder, "1 day", ["kwh_peak", "anomaly_count"])


@query(
    "STR5",
    ctes("readings mhourly predictions") + ", preds AS (SELECT meter_id, r.time, p.kwh_pred FROM readings r JOIN (SELECT meter_id, time, kwh_pred FROM predictions) p "
    "USING (meter_id) WHERE date_trunc('hour', r.time) = p.time), z AS (SELECT *, residual / (stddev_samp(residual) OVER (PARTITION BY meter_id "
    "ORDER BY time, kwh_actual, kwh_expected ROWS BETWEEN 95 PRECEDING AND CURRENT ROW) + 1e-8) AS z_score FROM (SELECT r.time, meter_id, kwh AS kwh_actual, kwh_pred AS kwh_expected, "
    "abs(kwh - kwh_pred) AS residual FROM readings r JOIN preds USING (meter_id, time))) "
    "SELECT meter_id, time AS reading_time, kwh_actual, kwh_expected, round(z_score, 4) AS z_score, CASE WHEN z_score > 6 THEN 'high' WHEN z_score > 4.5 THEN 'medium' ELSE 'low' END AS severity "
    "FROM z WHERE z_score > 3.0",
)
def stream_detect(spark, folder):
    """Readings streamed against a prediction for each of their times (the meter's previous hourly value)."""
    hourly = I.meter_predictions(I.meter_series(spark, folder)).withColumnRenamed("time", "hour")
    base = I.readings(spark, folder).select("meter_id", "time")
    predictions = base.withColumn("hour", C.time_bucket(F.col("time"), "1 hour")).join(hourly, ["meter_id", "hour"])
    out, checkpoint = _paths(spark, "detect")
    ST_JOBS.detect_job(I.readings_stream(spark, folder), settled(predictions), out, checkpoint, available_now=True)
    return rounded(ST_JOBS.detected_events(spark, out).drop("deviation"), "z_score", digits=4)


@query(
    "SNK8 STR4",
    ctes("readings") + "SELECT time, meter_id, kwh, is_anomaly, source, true AS in_both FROM readings",
)
def stream_dual_write(spark, folder):
    """Readings and facts written side by side, then compared through the legacy shape."""
    out, checkpoint = _paths(spark, "dual")
    ST_JOBS.dual_write_job(I.readings_stream(spark, folder), out, checkpoint, available_now=True)
    old = spark.read.parquet(f"{out}/readings")
    facts, meters, sources = (spark.read.parquet(f"{out}/{t}") for t in ("fact_meter_reading", "dim_meter", "dim_source"))
    new = ST.legacy_readings(facts, meters, sources)
    return new.join(old.select("time", "meter_id", F.lit(True).alias("in_both")), ["time", "meter_id"], "left")


@query(
    "STR6 SNK4",
    ctes("readings") + "SELECT TIMESTAMP '2026-01-01 00:00:00' + to_seconds(i * 60) AS time, meter_id, round(CASE WHEN i > 0 AND i % 17 = 0 THEN kwh * 2.5 ELSE kwh END, 6) AS kwh, "
    "(i > 0 AND i % 17 = 0) OR is_anomaly AS is_anomaly, source FROM (SELECT *, row_number() OVER (ORDER BY time, meter_id, kwh) - 1 AS i FROM readings)",
)
def replay(spark, folder):
    out = ST_JOBS.replay(I.readings(spark, folder), datetime(2026, 1, 1))
    return rounded(out, "kwh", digits=6)


