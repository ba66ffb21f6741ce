"""Registered queries: feeds, tables, rollups, profiles, scalar functions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wattline.functions import sql as sql_functions
from wattline.functions import text as X
from wattline.functions import time as C
from wattline.operators import profile as P
from wattline.operators import rollups as R
from wattline.operators import series as S
from wattline.plans import inputs as I
from wattline.plans.registry import ctes, query
from wattline.session import scratch_path
from wattline.sinks import maintain as M
from wattline.sinks import tables as K
from wattline.sources import feeds
from wattline.sources import readings as SR


LO, HI = datetime(2024, 1, 8), datetime(2024, 1, 20)


def r(column, digits: int = 4):
    return F.round(column, digits)


# ---- sources -------------------------------------------------------------------------------------------


@query("SRC1 SRC2 SCA3 SCA4", ctes("readings") + "SELECT time, meter_id, kwh, is_anomaly, source FROM readings")
def scan_readings_csv(spark, folder):
    path = scratch_path(spark, "csv")
    text = I.readings(spark, folder).withColumn("time", F.col("time").cast("string"))
    text.withColumn("is_anomaly", F.when(F.col("is_anomaly"), " YES ").otherwise("false")).write.csv(path, header=True)
    return SR.read_readings_csv(spark, path, glob="*.csv")


@query(
    "SRC3 SCA8",
    "SELECT date_trunc('second', ts) AS time, 'UCI_HOUSEHOLD_001' AS meter_id, round(value / 60, 6) AS kwh, "
    "false AS is_anomaly, 'uci_household_power' AS source FROM events WHERE event_type <> 'error'",
)
def normalize_minute_power(spark, folder):
    events = I.table(spark, folder, "events")
    stamp = F.col("ts").cast("timestamp")
    raw = events.select(
        F.date_format(stamp, "d/M/yyyy").alias("Date"),
        F.date_format(stamp, "H:m:s").alias("Time"),
        F.when(F.col("event_type") == "error", "?").otherwise(F.col("value").cast("string")).alias("Global_active_power"),
    )
    return feeds.normalize_minute_power(raw).withColumn("kwh", r("kwh", 6))


@query(
    "SRC4",
    ctes("mhourly") + "SELECT time, meter_id, kwh, false AS is_anomaly, 'london_smart_meters' AS source FROM mhourly",
)
def series_lines_round_trip(spark, folder):
    lines = feeds.series_lines(I.meter_hours(spark, folder), 60)
    return feeds.normalize_series_lines(lines, step_minutes=60)


@query(
    "SRC5 SCA5",
    ctes("readings") + "SELECT time, meter_id, kwh, false AS is_anomaly, 'london_smart_meters' AS source "
    "FROM readings WHERE source <> 'error'",
)
def normalize_long_csv(spark, folder):
    base = I.readings(spark, folder)
    value = F.when(F.col("source") == "error", " NaN ").otherwise(F.col("kwh").cast("string"))
    raw = base.select(
        F.col("meter_id").alias("LCLid"), F.col("time").cast("string").alias("Date Time"), value.alias("Energy KWH HalfHour")
    )
    return feeds.normalize_long_csv(raw)


@query(
    "SRC6",
    ctes("hourly") + "SELECT time, 'laayoune_10t_' || source AS meter_id, round(0.207 * kwh * (10 / 60), 6) AS kwh, "
    "false AS is_anomaly, 'morocco_high_resolution' AS source FROM hourly",
)
def unpivot_city(spark, folder):
    hourly = R.resample(I.readings(spark, folder), 60, ["source"])
    zones = [row[0] for row in hourly.select("source").distinct().orderBy("source").collect()]
    sheet = hourly.groupBy(F.col("time").alias("DateTime")).pivot("source", zones).agg(F.first("kwh"))
    out = feeds.unpivot_city(sheet, "laayoune_10t", feeds.city_unit("laayoune_10t"))
    return out.withColumn("kwh", r("kwh", 6))


@query(
    "SRC7",
    ctes("electric") + "SELECT timestamp AS time, CASE WHEN meter_id = '' THEN 'NIG_UNKNOWN' ELSE meter_id END AS meter_id, "
    "consumption_kwh AS kwh, false AS is_anomaly, 'nigeria_smart_meter' AS source FROM electric WHERE consumption_kwh IS NOT NULL",
)
def normalize_interval_kwh(spark, folder):
    return feeds.normalize_interval_kwh(I.electrical(spark, folder))


@query("SRC8", "SELECT least(1000, count(*) FILTER (WHERE l_linestatus = 'O')) AS rows FROM lineitem")
def capped_feed(spark, folder):
    capped = feeds.normalize_interval_kwh(I.electrical(spark, folder), max_rows=1000)
    return capped.agg(F.count(F.lit(1)).alias("rows"))


@query(
    "SRC10 PRJ2 PRJ3",
    ctes("readings") + "SELECT time, kwh FROM readings WHERE source = 'click' AND time >= TIMESTAMP '2024-01-25 12:00:00' - INTERVAL 10 DAY",
)
def source_since(spark, folder):
    return SR.series(I.readings(spark, folder), "click", "10 days", I.NOW)


@query(
    "SET1 TOP6",
    ctes("readings oreadings") + "SELECT * FROM readings UNION ALL SELECT * FROM oreadings",
)
def union_feeds(spark, folder):
    return SR.ordered(SR.union_feeds(I.readings(spark, folder), I.order_readings(spark, folder)))


# ---- sinks ---------------------------------------------------------------------------------------------


@query(
    "SNK1 MOD5",
    ctes("readings") + "SELECT CAST(DATE '1970-01-01' + CAST(floor((CAST(time AS DATE) - DATE '1970-01-01') / 7) AS INTEGER) * 7 AS DATE) AS time_chunk, "
    "count(*) AS rows, round(sum(kwh), 4) AS kwh FROM readings GROUP BY 1",
)
def write_readings(spark, folder):
    path = scratch_path(spark, "readings")
    K.write_readings(I.readings(spark, folder), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("time_chunk").agg(F.count(F.lit(1)).alias("rows"), r(F.sum("kwh")).alias("kwh"))


@query(
    "SNK2",
    ctes("readings") + "SELECT DISTINCT meter_id, CASE WHEN source IN ('click', 'view') THEN 'known' ELSE 'public_dataset' END AS profile FROM readings",
)
def insert_missing_meters(spark, folder):
    base = I.readings(spark, folder)
    known = base.filter(F.col("source").isin("click", "view")).select("meter_id", F.lit("known").alias("profile")).distinct()
    new = base.select("meter_id", F.lit("public_dataset").alias("profile"))
    return K.insert_missing(known, new, ["meter_id"])


@query(
    "SNK4 SCA12",
    ctes("readings") + "SELECT meter_id AS key, meter_id, kwh, is_anomaly, source, time FROM readings",
)
def message_round_trip(spark, folder):
    messages = K.to_messages(I.readings(spark, folder))
    body = X.decode_message(F.col("value"))
    return messages.select("key", body.alias("m")).select(
        "key",
        "m.meter_id",
        "m.kwh",
        "m.is_anomaly",
        "m.source",
        C.parse_time(F.col("m.timestamp")).alias("time"),
    )


@query(
    "SNK5",
    ctes("readings") + "SELECT time, meter_id, kwh, source FROM readings WHERE source NOT IN ('view', 'error') UNION ALL "
    "SELECT time, meter_id, kwh * 2 AS kwh, source FROM readings WHERE source = 'view'",
)
def replace_slice(spark, folder):
    base = I.readings(spark, folder).select("time", "meter_id", "kwh", "source")
    new = base.filter(F.col("source") == "view").withColumn("kwh", F.col("kwh") * 2)
    return K.replace_slice(base, new, F.col("source").isin("view", "error"))


@query(
    "SNK5 SNK1",
    ctes("readings") + "SELECT time, meter_id, kwh, source FROM readings WHERE source <> 'view' OR time < TIMESTAMP '2024-01-08' OR time >= TIMESTAMP '2024-01-20' "
    "UNION ALL SELECT time, meter_id, kwh * 2 AS kwh, source FROM readings WHERE source = 'view' AND time >= TIMESTAMP '2024-01-08' AND time < TIMESTAMP '2024-01-20'",
)
def replace_in_place(spark, folder):
    """A stored table whose views of twelve days are replaced by twice their value, computed from the table itself."""
    path = scratch_path(spark, "readings")
    K.write_readings(I.readings(spark, folder).select("time", "meter_id", "kwh", "source"), path)
    view = F.col("source") == "view"
    new = M.half_open(spark.read.parquet(path), "time", LO, HI).filter(view).withColumn("kwh", F.col("kwh") * 2)
    M.replace_in_place(spark, path, new, LO, HI, view)
    return spark.read.parquet(path).select("time", "meter_id", "kwh", "source")


@query(
    "MOD6",
    ctes("readings") + "SELECT time, meter_id, kwh FROM readings WHERE "
    "DATE '1970-01-01' + CAST(floor(date_diff('day', DATE '1970-01-01', CAST(time AS DATE)) / 7) * 7 + 7 AS INTEGER) > TIMESTAMP '2024-01-25 12:00:00' - INTERVAL 12 DAY",
)
def retention_in_place(spark, folder):
    """A stored table after its expired chunks are dropped."""
    path = scratch_path(spark, "readings")
    K.write_readings(I.readings(spark, folder), path)
    M.drop_expired(spark, path, 12, I.NOW)
    return spark.read.parquet(path).select("time", "meter_id", "kwh")


@query(
    "SNK7",
    ctes("readings") + "SELECT source AS meter_id, time AS reading_time, kwh AS kwh_actual, round(kwh / 1.75, 9) AS kwh_expected, "
    "round(kwh - kwh / 1.75, 9) AS deviation, CASE WHEN kwh - kwh / 1.75 > 1.0 THEN 'high' ELSE 'medium' END AS severity "
    "FROM readings WHERE is_anomaly",
)
def events_from_flags(spark, folder):
    out = K.events_from_flags(I.readings(spark, folder))
    return out.withColumn("kwh_expected", r("kwh_expected", 9)).withColumn("deviation", r("deviation", 9))


# ---- projections ---------------------------------------------------------------------------------------


@query(
    "PRJ1",
    ctes("readings") + "SELECT count(*) AS readings, round(sum(kwh), 4) AS kwh FROM readings "
    "WHERE time BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'",
)
def time_range_count(spark, folder):
    kept = R.time_filter(I.readings(spark, folder), "time", LO, HI)
    return kept.agg(F.count(F.lit(1)).alias("readings"), r(F.sum("kwh")).alias("kwh"))


@query(
    "PRJ4",
    ctes("readings") + "SELECT date_trunc('hour', time) AS bucket, round(sum(kwh), 4) AS kwh_total FROM readings "
    "WHERE meter_id = 'MTR_click_01' GROUP BY 1 HAVING date_trunc('hour', time) >= TIMESTAMP '2024-01-18 12:00:00'",
)
def load_curve(spark, folder):
    lo = I.NOW - timedelta(days=7)
    recent = I.readings(spark, folder).filter(F.col("time") >= F.lit(lo).cast("timestamp"))  # lo begins a bucket
    curve = R.load_curve(R.rollup(recent, "1 hour"), "MTR_click_01", lo)
    return curve.withColumn("kwh_total", r("kwh_total"))


@query(
    "PRJ5",
    ctes("readings") + "SELECT time, meter_id, kwh FROM readings WHERE source NOT IN ('error', 'view')",
)
def clean_rows(spark, folder):
    base = I.readings(spark, folder)
    dirty = base.select(
        F.when(F.col("source") == "error", "not a time").otherwise(F.col("time").cast("string")).alias("time"),
        "meter_id",
        F.when(F.col("source") == "view", "n/a").otherwise(F.col("kwh").cast("string")).alias("kwh"),
    )
    return SR.clean(dirty)


@query(
    "PRJ7",
    ctes("readings") + "SELECT reading_time AS time, meter_id, kwh_actual, round(kwh_actual / 1.75, 9) AS kwh_expected, "
    "CASE WHEN kwh_actual - kwh_actual / 1.75 > 1.0 THEN 'high' ELSE 'medium' END AS severity FROM ("
    "SELECT time AS reading_time, source AS meter_id, kwh AS kwh_actual FROM readings WHERE is_anomaly "
    "ORDER BY time DESC, source LIMIT 50)",
)
def latest_events(spark, folder):
    newest = R.latest_events(K.events_from_flags(I.readings(spark, folder)))
    return newest.withColumn("kwh_expected", r("kwh_expected", 9))


# ---- rollups -------------------------------------------------------------------------------------------


def rounded_rollup(df):
    return df.withColumns({c: r(c, 9 if c == "kwh_avg" else 4) for c in df.columns if c in ("kwh_total", "kwh_avg")})


@query(
    "AGG1 SCA2",
    ctes("readings") + "SELECT time_bucket(INTERVAL 15 MINUTE, time) AS bucket, meter_id, round(sum(kwh), 4) AS kwh_total, "
    "round(avg(kwh), 9) AS kwh_avg, max(kwh) AS kwh_max, count(*) AS reading_count FROM readings GROUP BY 1, 2",
)
def rollup_quarter_hour(spark, folder):
    return rounded_rollup(R.rollup(I.readings(spark, folder), "15 minutes"))


@query(
    "AGG2",
    ctes("readings") + "SELECT date_trunc('hour', time) AS bucket, meter_id, round(sum(kwh), 4) AS kwh_total, "
    "round(avg(kwh), 9) AS kwh_avg, max(kwh) AS kwh_max, count(*) AS reading_count FROM readings GROUP BY 1, 2",
)
def rollup_hourly(spark, folder):
    return rounded_rollup(R.rollup(I.readings(spark, folder), "1 hour"))


DAILY_SQL = (
    "SELECT date_trunc('day', time)::TIMESTAMP AS bucket, meter_id, round(sum(kwh), 4) AS kwh_total, "
    "round(avg(kwh), 9) AS kwh_avg, max(kwh) AS kwh_peak, count(*) FILTER (WHERE is_anomaly) AS anomaly_count "
    "FROM readings GROUP BY 1, 2"
)


@query("AGG3", ctes("readings") + DAILY_SQL)
def rollup_daily(spark, folder):
    return rounded_rollup(R.rollup(I.readings(spark, folder), "1 day"))


@query(
    "AGG3",
    ctes("oreadings") + "SELECT date_trunc('day', time)::TIMESTAMP AS bucket, source, round(sum(kwh), 2) AS kwh_total, "
    "max(kwh) AS kwh_peak, count(*) FILTER (WHERE is_anomaly) AS anomaly_count FROM oreadings GROUP BY 1, 2",
)
def rollup_daily_orders(spark, folder):
    daily = R.rollup(I.order_readings(spark, folder), "1 day", ["source"]).drop("kwh_avg")
    return daily.withColumn("kwh_total", r("kwh_total", 2))


@query(
    "AGG5 SCA1",
    ctes("readings") + "SELECT date_trunc('day', time)::TIMESTAMP + to_minutes(CAST((hour(time) * 60 + minute(time)) // 45 * 45 AS BIGINT)) AS time, "
    "meter_id, source, round(sum(kwh), 4) AS kwh, false AS is_anomaly FROM readings GROUP BY 1, 2, 3",
)
def resample_45_minutes(spark, folder):
    return R.resample(I.readings(spark, folder), 45).withColumn("kwh", r("kwh"))


@query(
    "AGG5",
    ctes("readings mhourly") + "SELECT (SELECT count(*) FROM readings) AS rows_in, (SELECT count(*) FROM mhourly) AS rows_out, "
    "count(DISTINCT meter_id) AS distinct_meters, min(time) AS start_timestamp, max(time) AS end_timestamp, "
    "60 AS target_frequency_minutes FROM readings",
)
def resample_meta(spark, folder):
    raw = I.readings(spark, folder)
    return R.resample_meta(raw, R.resample(raw, 60), 60)


@query(
    "AGG6",
    ctes("readings") + "SELECT date_trunc('hour', time) AS time, round(sum(kwh), 4) AS kwh FROM readings GROUP BY 1",
)
def total_load(spark, folder):
    out = R.total_load(R.rollup(I.readings(spark, folder), "1 hour"))
    return out.withColumn("kwh", r("kwh"))


@query(
    "AGG6",
    ctes("mhourly predictions") + "SELECT coalesce(a.time, p.time) AS time, a.actual, p.predicted FROM "
    "(SELECT time, round(sum(kwh), 4) AS actual FROM mhourly GROUP BY 1) a FULL JOIN "
    "(SELECT time, round(sum(kwh_pred), 4) AS predicted FROM predictions GROUP BY 1) p ON a.time = p.time",
)
def forecast_vs_actual(spark, folder):
    series = I.meter_series(spark, folder)
    out = R.forecast_vs_actual(series, I.meter_predictions(series))
    return out.withColumn("actual", r("actual")).withColumn("predicted", r("predicted"))


@query(
    "AGG7",
    ctes("readings") + "SELECT CASE WHEN source = 'view' THEN 'unknown' ELSE source END AS source, round(sum(kwh), 4) AS kwh FROM readings GROUP BY 1",
)
def by_source(spark, folder):
    base = I.readings(spark, folder).withColumn("source", F.nullif(F.col("source"), F.lit("view")))
    out = R.by_source(base)
    return out.withColumn("kwh", r("kwh"))


@query(
    "AGG8 SET2",
    ctes("readings mhourly") + "SELECT 'meter_readings' AS item, count(*) AS n FROM readings UNION ALL "
    "SELECT 'meter_hourly', count(*) FROM mhourly UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL "
    "SELECT 'meter_sources', count(DISTINCT source) FROM readings",
)
def table_counts(spark, folder):
    base = I.readings(spark, folder)
    tables = {"meter_readings": base, "meter_hourly": I.meter_hours(spark, folder), "orders": I.table(spark, folder, "orders")}
    return R.table_counts(tables, {"meter_sources": (base, "source")})


@query(
    "AGG9 PRJ2",
    ctes("readings") + "SELECT meter_id, count(*) AS anomaly_count FROM readings WHERE is_anomaly "
    "AND time >= TIMESTAMP '2024-01-25 12:00:00' - INTERVAL 14 DAY GROUP BY 1",
)
def anomaly_counts(spark, folder):
    events = I.readings(spark, folder).filter("is_anomaly").select("meter_id", F.col("time").alias("detected_at"))
    return R.anomaly_counts(events, "detected_at", "14 days", I.NOW)


@query(
    "AGG18",
    ctes("readings") + "SELECT date_trunc('day', time)::TIMESTAMP AS ds, source, round(sum(kwh), 4) AS y FROM readings GROUP BY 1, 2",
)
def daily_series(spark, folder):
    out = R.daily_series(I.readings(spark, folder))
    return out.withColumn("y", r("y"))


@query(
    "AGG19",
    ctes("readings") + "SELECT bucket, meter_id, round(sum(kwh), 4) AS kwh_total, round(avg(kwh), 9) AS kwh_avg, "
    "max(kwh) AS kwh_max, count(*) AS reading_count FROM (SELECT date_trunc('hour', time) AS bucket, * FROM readings) "
    "WHERE bucket < TIMESTAMP '2024-01-25 11:00:00' GROUP BY 1, 2",
)
def refresh_rollup(spark, folder):
    """A table built up to 8 January, then refreshed for the days after up to an hour before now."""
    raw = I.readings(spark, folder)
    old = R.rollup(raw.filter(F.col("time") < F.lit(datetime(2024, 1, 10))), "1 hour").withColumn(
        "kwh_total", F.when(F.col("bucket") >= F.lit(LO), F.lit(-1.0)).otherwise(F.col("kwh_total"))
    )
    hi = I.NOW - timedelta(hours=1)
    return rounded_rollup(R.refresh_rollup(old, raw, "1 hour", LO, hi))


@query(
    "AGG19",
    ctes("readings") + "SELECT bucket, meter_id, round(sum(kwh), 4) AS kwh_total, round(avg(kwh), 9) AS kwh_avg, "
    "max(kwh) AS kwh_max, count(*) AS reading_count FROM (SELECT date_trunc('hour', time) AS bucket, * FROM readings) "
    "WHERE bucket < TIMESTAMP '2024-01-25 11:00:00' GROUP BY 1, 2",
)
def refresh_in_place(spark, folder):
    """The same refresh of a stored rollup, whose chunks before the window are not touched."""
    raw = I.readings(spark, folder)
    old = R.rollup(raw.filter(F.col("time") < F.lit(datetime(2024, 1, 10))), "1 hour")
    stale = F.when(F.col("bucket") >= F.lit(LO), F.lit(-1.0)).otherwise(F.col("kwh_total"))
    path = scratch_path(spark, "hourly")
    K.write_fact(old.withColumn("kwh_total", stale), path, ["meter_id"], time="bucket")
    M.refresh_in_place(spark, path, raw, "1 hour", LO, I.NOW - timedelta(hours=1))
    return rounded_rollup(spark.read.parquet(path).drop("time_chunk"))


@query(
    "AGG19",
    ctes("readings") + "SELECT bucket, meter_id, CASE WHEN bucket >= TIMESTAMP '2024-01-18 12:00:00' AND bucket + INTERVAL 1 DAY <= TIMESTAMP '2024-01-24 12:00:00' "
    "THEN round(sum(kwh), 4) ELSE -1 END AS kwh_total, max(kwh) AS kwh_peak, count(*) FILTER (WHERE is_anomaly) AS anomaly_count "
    "FROM (SELECT date_trunc('day', time)::TIMESTAMP AS bucket, * FROM readings) GROUP BY 1, 2",
)
def scheduled_refresh(spark, folder):
    """A stale daily table after one policy run."""
    raw = I.readings(spark, folder)
    stale = R.rollup(raw, "1 day").withColumn("kwh_total", F.lit(-1.0))
    return R.scheduled_refresh(stale, raw, "1 day", I.NOW).drop("kwh_avg").withColumn("kwh_total", r("kwh_total"))


@query(
    "TOP1",
    ctes("readings") + "SELECT meter_id, round(sum(kwh), 4) AS total_kwh FROM readings "
    "WHERE date_trunc('day', time) = DATE '2024-01-15' GROUP BY 1 ORDER BY sum(kwh) DESC, meter_id LIMIT 10",
)
def top_meters(spark, folder):
    on_day = R.time_filter(I.readings(spark, folder), "time", I.DAY, I.DAY + timedelta(days=1, microseconds=-1))
    top = R.top_meters_on(R.rollup(on_day, "1 day"), I.DAY)
    return top.withColumn("total_kwh", r("total_kwh"))


@query(
    "TOP2",
    ctes("readings") + "SELECT meter_id, count(*) AS rows, round(avg(kwh), 9) AS mean_kwh, round(sum(kwh), 4) AS total_kwh, "
    "max(kwh) AS max_kwh FROM readings GROUP BY 1 ORDER BY sum(kwh) DESC, meter_id LIMIT 10",
)
def top_meter_stats(spark, folder):
    top = R.top_meter_stats(I.readings(spark, folder))
    return top.withColumn("mean_kwh", r("mean_kwh", 9)).withColumn("total_kwh", r("total_kwh"))


FILLED_DAYS = (
    "SELECT d.meter_id, d.day, coalesce(s.daily_kwh, 0) AS daily_kwh FROM (SELECT meter_id, "
    "CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM sums GROUP BY 1) d "
    "LEFT JOIN sums s ON s.meter_id = d.meter_id AND s.day = d.day"
)
DAY_SUMS = "sums AS (SELECT meter_id, CAST(time AS DATE) AS day, round(sum(kwh), 4) AS daily_kwh FROM oreadings GROUP BY 1, 2), "


@query(
    "TOP3 JOI7",
    ctes("oreadings") + ", " + DAY_SUMS + f"filled AS ({FILLED_DAYS}) SELECT * FROM filled WHERE meter_id IN "
    "(SELECT meter_id FROM filled GROUP BY 1 ORDER BY sum(daily_kwh) DESC, meter_id LIMIT 12)",
)
def keep_largest(spark, folder):
    daily = P.daily_totals(I.order_readings(spark, folder))
    out = R.keep_largest(daily)
    return out.withColumn("daily_kwh", r("daily_kwh"))


@query(
    "TOP7",
    ctes("readings") + "SELECT time, meter_id, kwh FROM (SELECT *, md5(meter_id || '|' || CAST(epoch_us(time) AS VARCHAR) || '|42') AS h "
    "FROM readings) ORDER BY h LIMIT 500",
)
def stable_sample(spark, folder):
    base = I.readings(spark, folder).withColumn("us", F.unix_micros("time"))
    return R.stable_sample(base, 500, ["meter_id", "us"]).select("time", "meter_id", "kwh")


# ---- profiles ------------------------------------------------------------------------------------------

SPIKES = (
    "SELECT c.*, c.kwh > q.q3 + 3 * (q.q3 - q.q1) AS candidate_spike FROM copies c JOIN (SELECT meter_id, "
    "quantile_cont(kwh, 0.25) AS q1, quantile_cont(kwh, 0.75) AS q3 FROM copies GROUP BY 1) q USING (meter_id)"
)


@query(
    "AGG10",
    ctes("copies") + f", spikes AS ({SPIKES}) SELECT count(*) AS rows, count(DISTINCT meter_id) AS meters, "
    "string_agg(DISTINCT source, ', ' ORDER BY source) AS sources, min(time) AS start_time, max(time) AS end_time, "
    "round((epoch_us(max(time)) - epoch_us(min(time))) / 86400000000, 9) AS duration_days, "
    "(SELECT CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM copies GROUP BY time, meter_id)) AS duplicate_rows, "
    "count(*) FILTER (WHERE kwh IS NULL) AS missing_kwh, round(avg(kwh), 9) AS mean_kwh, round(median(kwh), 9) AS median_kwh, "
    "round(stddev_samp(kwh), 9) AS std_kwh, min(kwh) AS min_kwh, max(kwh) AS max_kwh, "
    "(SELECT count(*) FROM spikes WHERE candidate_spike) AS candidate_spikes FROM copies",
)
def profile(spark, folder):
    out = P.profile(I.with_copies(I.readings(spark, folder)))
    return out.withColumns({c: r(c, 9) for c in ("duration_days", "mean_kwh", "median_kwh", "std_kwh")})


@query("AGG11", ctes("copies") + SPIKES)
def iqr_spikes(spark, folder):
    return P.iqr_spikes(I.with_copies(I.readings(spark, folder)))


CONVERSION = (
    "SELECT {key} AS disco, count(*) AS n, round(median(consumption_kwh / 1.0 / current_a), 6) AS median_implied, "
    "round(median(voltage_v * current_a * power_factor / 1000.0 / current_a), 9) AS median_electrical FROM "
    "(SELECT *  REPLACE (coalesce(consumption_kwh, 0) AS consumption_kwh) FROM electric) "
    "WHERE current_a > 0 AND voltage_v > 0 AND power_factor > 0 {group}"
)


@query(
    "AGG12 PRJ8",
    ctes("electric") + CONVERSION.format(key="CAST(NULL AS VARCHAR)", group="") + " UNION ALL "
    + CONVERSION.format(key="disco", group="GROUP BY disco"),
)
def conversion_factors(spark, folder):
    out = P.conversion_factors(I.electrical(spark, folder), 1.0)
    return out.withColumn("median_implied", r("median_implied", 6)).withColumn("median_electrical", r("median_electrical", 9))


@query(
    "AGG13",
    ctes("readings") + "SELECT source, CAST(hour(time) AS INTEGER) AS hour, round(avg(kwh), 9) AS kwh FROM readings GROUP BY 1, 2",
)
def hourly_profile(spark, folder):
    out = P.hourly_profile(I.readings(spark, folder))
    return out.withColumn("kwh", r("kwh", 9))


@query("AGG14", ctes("readings") + ", " + DAY_SUMS.rstrip(", ").replace("oreadings", "readings") + " " + FILLED_DAYS)
def daily_totals(spark, folder):
    out = P.daily_totals(I.readings(spark, folder))
    return out.withColumn("daily_kwh", r("daily_kwh"))


@query(
    "AGG15",
    ctes("readings") + ", b AS (SELECT min(kwh) AS lo, (max(kwh) - min(kwh)) / 80 AS w FROM readings) "
    "SELECT bin, round(lo + bin * w, 9) AS lo, round(lo + (bin + 1) * w, 9) AS hi, n FROM (SELECT "
    "CAST(least(floor((kwh - lo) / w), 79) AS INTEGER) AS bin, lo, w, count(*) AS n FROM readings, b GROUP BY 1, 2, 3)",
)
def histogram(spark, folder):
    out = P.histogram(I.readings(spark, folder))
    return out.withColumn("lo", r("lo", 9)).withColumn("hi", r("hi", 9))


@query(
    "AGG15",
    ctes("readings") + ", q AS (SELECT source, count(*) AS n_values, quantile_cont(kwh, 0.25) AS q1, median(kwh) AS median, "
    "quantile_cont(kwh, 0.75) AS q3 FROM readings GROUP BY 1) SELECT q.source, n_values, round(q1, 9) AS q1, round(median, 9) AS median, "
    "round(q3, 9) AS q3, min(kwh) FILTER (WHERE kwh >= q1 - (q3 - q1) * 1.5 AND kwh <= q3 + (q3 - q1) * 1.5) AS whisker_lo, "
    "max(kwh) FILTER (WHERE kwh >= q1 - (q3 - q1) * 1.5 AND kwh <= q3 + (q3 - q1) * 1.5) AS whisker_hi "
    "FROM q JOIN readings USING (source) GROUP BY ALL",
)
def box_stats(spark, folder):
    out = P.box_stats(I.readings(spark, folder))
    return out.withColumns({c: r(c, 9) for c in ("q1", "median", "q3")})


@query(
    "AGG16",
    ctes("cad") + "SELECT source, CAST(cadence AS INTEGER) AS cadence_minutes FROM cad",
)
def infer_cadence(spark, folder):
    return S.cadence(I.source_series(spark, folder), "source")


@query(
    "AGG17",
    ctes("readings") + "SELECT meter_id, CAST(floor((epoch_us(max(time)) - epoch_us(min(time))) / 60000000) AS INTEGER) AS sampling_minutes FROM "
    "(SELECT meter_id, time, row_number() OVER (PARTITION BY meter_id ORDER BY time) AS rn FROM readings) "
    "WHERE rn <= 2 GROUP BY 1 HAVING count(*) = 2",
)
def sampling_minutes(spark, folder):
    return P.sampling_minutes(I.readings(spark, folder))


@query(
    "AGG17",
    ctes("oreadings") + "SELECT meter_id, round(coalesce(median(gap) FILTER (WHERE gap > 0), 1.0), 6) AS sampling_hours FROM ("
    "SELECT meter_id, (epoch_us(time) - epoch_us(lag(time) OVER (PARTITION BY meter_id ORDER BY rn))) / 3600000000 AS gap FROM "
    "(SELECT meter_id, time, row_number() OVER (PARTITION BY meter_id ORDER BY time) AS rn FROM oreadings) WHERE rn <= 10) GROUP BY 1",
)
def sampling_hours(spark, folder):
    out = P.sampling_hours(I.order_readings(spark, folder))
    return out.withColumn("sampling_hours", r("sampling_hours", 6))


# ---- scalar functions ----------------------------------------------------------------------------------


@query(
    "SCA6 MOD7",
    "SELECT event_id, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date_key, CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' "
    "WHEN month(ts) IN (3, 4, 5) THEN 'spring' WHEN month(ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season, "
    "CASE WHEN value > 60 THEN 'high' WHEN value > 45 THEN 'medium' ELSE 'low' END AS severity FROM events",
)
def sql_helpers(spark, folder):
    I.table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp")).createOrReplaceTempView("wattline_events")
    sql_functions.register(spark)
    return spark.sql(
        "SELECT event_id, date_key_of(ts) AS date_key, season_of(ts) AS season, severity_of(value, 30.0D) AS severity FROM wattline_events"
    )


@query(
    "SCA7",
    ctes("readings") + "SELECT time, meter_id, round(sin(2 * pi() * (hour(time) + minute(time) / 60) / 24), 9) + 0::DOUBLE AS hour_sin, "
    "round(cos(2 * pi() * (hour(time) + minute(time) / 60) / 24), 9) + 0::DOUBLE AS hour_cos, "
    "round(sin(2 * pi() * (isodow(time) - 1) / 7), 9) + 0::DOUBLE AS dow_sin, round(cos(2 * pi() * (isodow(time) - 1) / 7), 9) + 0::DOUBLE AS dow_cos FROM readings",
)
def calendar_features(spark, folder):
    features = {name: r(c, 9) + 0.0 for name, c in C.calendar_features(F.col("time")).items()}
    return I.readings(spark, folder).select("time", "meter_id", *[c.alias(n) for n, c in features.items()])


@query(
    "SCA5 SCA8 SCA9 SCA13",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(greatest(0.01, abs(l_extendedprice - 20000.0) * (30 / 60)), 6) AS kwh, "
    "round(0.207 * l_quantity, 6) AS kw, lower(replace(replace(trim(l_returnflag || ' Zone. ' || l_linestatus), ' ', '_'), '.', '')) AS name, "
    "CAST(greatest(1, floor(24 * 60 / (l_quantity * 60))) AS INTEGER) AS steps FROM lineitem",
)
def unit_conversions(spark, folder):
    items = I.table(spark, folder, "lineitem")
    power = F.abs(F.col("l_extendedprice") - 20000.0)
    name = F.concat(F.col("l_returnflag"), F.lit(" Zone. "), F.col("l_linestatus"))
    return items.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        r(F.greatest(F.lit(0.01), X.kw_to_kwh(power, 30)), 6).alias("kwh"),
        r(X.amp_to_kw(F.col("l_quantity")), 6).alias("kw"),
        X.normalize_name(name).alias("name"),
        C.horizon_steps(24, F.col("l_quantity") * 60).alias("steps"),
    )


@query(
    "SCA4 SCA10 SCA11",
    "SELECT event_id, event_type IN ('click') AS flag, CASE WHEN value > 60 THEN 'high' WHEN value > 45 THEN 'medium' ELSE 'low' END AS severity, "
    "CASE WHEN event_type = 'click' THEN 'point_drop+' || event_type ELSE event_type || '+point_drop' END AS labels, "
    "event_type = 'view' AS has_view, CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 5 END AS INTEGER) AS needed FROM events",
)
def label_functions(spark, folder):
    events = I.table(spark, folder, "events")
    kind = F.col("event_type")
    start = F.when(kind == "click", F.lit("point_drop+click")).otherwise(kind)
    return events.select(
        "event_id",
        X.parse_bool(F.when(kind == "click", " Yes").otherwise("no")).alias("flag"),
        X.severity(F.col("value"), 30.0).alias("severity"),
        X.add_label(start, "point_drop").alias("labels"),
        X.has_label(start, "view").alias("has_view"),
        X.min_flags(start, 5).alias("needed"),
    )


