"""Star schema: dimensions, surrogate keys, facts, history, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.functions.time import date_key, day_of_week, is_weekend, season
from wattline.operators.series import global_index, matched
from wattline.session import settled, sized
from wattline.sinks.tables import first_per_key

UNKNOWN_SOURCE = "unknown"


def source_code(column: str = "source") -> Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN_SOURCE))


def resolve_keys(dim: DataFrame | None, members: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """The dimension with every member in it: new members get keys after the largest existing one.

    ``members`` may carry further attributes; the first in order wins for a natural key seen twice.
    """
    natural = list(natural)
    rest = [name for name in members.columns if name not in natural]
    fresh = first_per_key(members, natural, rest) if rest else members.select(*natural).distinct()
    start = 0
    if dim is not None:
        current = dim.filter("is_current") if "is_current" in dim.columns else dim
        fresh = fresh.join(current, natural, "left_anti")
        start = dim.agg(F.max(key)).first()[0] or 0
    keyed = global_index(fresh, natural, "_idx", unique=True).withColumn(key, (F.col("_idx") + 1 + start).cast("int")).drop("_idx")
    keyed = keyed.select(key, *natural, *rest)
    # A stored dimension has a known size, by which its joins are planned.
    return settled(keyed if dim is None else dim.unionByName(keyed, allowMissingColumns=True), "dimension")


def dim_source(readings: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """One row per source seen in the readings."""
    return resolve_keys(dim, readings.select(source_code().alias("source_code")), ["source_code"], "source_key")


def dim_model(predictions: DataFrame, dim: DataFrame | None = None, version: str = "v1") -> DataFrame:
    """One row per model name and version."""
    members = predictions.select(F.col("model").alias("model_name"), F.lit(version).alias("model_version"))
    return resolve_keys(dim, members, ["model_name", "model_version"], "model_key")


def first_source(readings: DataFrame) -> DataFrame:
    """The source of each meter's earliest reading."""
    earliest = F.min(F.struct("time", source_code().alias("source")))
    return readings.groupBy("meter_id").agg(earliest["source"].alias("source"))


def missing_members(readings: DataFrame, dim: DataFrame) -> DataFrame:
    """Meters seen in readings without a current dimension row."""
    current = dim.filter("is_current") if "is_current" in dim.columns else dim
    return readings.select("meter_id").distinct().join(current, "meter_id", "left_anti")


def dim_meter(meters: DataFrame, readings: DataFrame, sources: DataFrame) -> DataFrame:
    """Meter dimension seeded from the metadata table and from meters only known by their readings."""
    known = meters.join(first_source(readings), "meter_id", "full").withColumnRenamed("source", "source_code")
    with_source = known.join(sources.select("source_code", "source_key"), "source_code", "left")
    attributes = [c for c in ("profile", "location", "lat", "lon") if c in meters.columns]
    members = with_source.select("meter_id", "source_key", *attributes)
    return resolve_keys(None, members, ["meter_id"], "meter_key").withColumn("is_current", F.lit(True))


def dim_date(spark: SparkSession, lo: date = date(2022, 1, 1), hi: date = date(2027, 12, 31)) -> DataFrame:
    """Calendar dimension for a range of days."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("day"))
    return calendar_of(days)


def calendar_of(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``day`` column."""
    day = F.col("day")
    return days.select(
        date_key(day).alias("date_key"),
        "day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        day_of_week(day).alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
        season(day).alias("season"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("tariff_period"),
    )


def current_meters(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current") if "is_current" in dim.columns else dim


def build_fact_readings(readings: DataFrame, meters: DataFrame, sources: DataFrame) -> DataFrame:
    """Reading facts: surrogate keys looked up, one row per meter and time (lowest value, then source, wins).

    Join sides are left to AQE: the dimensions are broadcast when their measured size allows, otherwise a
    hot meter's partition is split.
    """
    once = first_per_key(
        readings.select(
            "time", "meter_id", "kwh", source_code().alias("source_code"), F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly")
        ),
        ["meter_id", "time"],
        ["kwh", "source_code"],
    )
    return (
        once.join(sources.select("source_code", "source_key"), "source_code")
        .join(current_meters(meters).select("meter_id", "meter_key"), "meter_id")
        .select("time", "meter_key", "source_key", date_key(F.col("time")).alias("date_key"), "kwh", "is_anomaly")
    )


def build_fact_predictions(predictions: DataFrame, meters: DataFrame, models: DataFrame) -> DataFrame:
    """Prediction facts, one row per meter, model, step and time."""
    steps = F.col("horizon_steps") if "horizon_steps" in predictions.columns else F.lit(1)
    keyed = (
        predictions.withColumn("horizon_steps", steps.cast("int"))
        .withColumnRenamed("model", "model_name")
        .join(models.select("model_name", "model_key"), "model_name")
        .join(current_meters(meters).select("meter_id", "meter_key"), "meter_id")
    )
    facts = keyed.select("time", "meter_key", "model_key", "horizon_steps", "kwh_pred", "kwh_lower", "kwh_upper")
    return first_per_key(facts, ["meter_key", "model_key", "horizon_steps", "time"], ["kwh_pred"])


def build_fact_events(events: DataFrame, meters: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """Anomaly-event facts; the model key is looked up where the event names a model."""
    out = events.join(current_meters(meters).select("meter_id", "meter_key"), "meter_id")
    if models is not None and "model" in events.columns:
        out = out.join(models.select(F.col("model_name").alias("model"), "model_key"), "model", "left")
    else:
        out = out.withColumn("model_key", F.lit(None).cast("int"))
    optional = [c for c in ("detected_at", "anomaly_type") if c in events.columns]
    return out.select(
        "reading_time", "meter_key", "model_key", *optional, "kwh_actual", "kwh_expected", "deviation", "severity"
    )


def fact_hourly(facts: DataFrame) -> DataFrame:
    """Hourly totals per meter key with reading and anomaly counts."""
    return facts.groupBy(F.date_trunc("hour", "time").alias("bucket"), "meter_key").agg(
        F.sum("kwh").alias("kwh_total"),
        F.avg("kwh").alias("kwh_avg"),
        F.max("kwh").alias("kwh_max"),
        F.count(F.lit(1)).alias("reading_count"),
        F.count_if("is_anomaly").alias("anomaly_count"),
    )


def build_star(readings: DataFrame, meters: DataFrame, predictions: DataFrame | None = None) -> dict[str, DataFrame]:
    """All dimensions and facts from the legacy tables, by name."""
    sources = dim_source(readings)
    meter_dim = dim_meter(meters, readings, sources)
    facts = build_fact_readings(readings, meter_dim, sources)
    star = {
        "dim_source": sources,
        "dim_meter": meter_dim,
        "dim_date": calendar_of(readings.select(F.to_date("time").alias("day")).distinct()),
        "fact_meter_reading": facts,
        "fact_reading_hourly": fact_hourly(facts),
    }
    if predictions is not None:
        star["dim_model"] = dim_model(predictions)
        star["fact_prediction"] = build_fact_predictions(predictions, meter_dim, star["dim_model"])
    return star


def legacy_readings(facts: DataFrame, meters: DataFrame, sources: DataFrame) -> DataFrame:
    """Reading facts in the shape of the readings table."""
    return (
        facts.join(meters.select("meter_key", "meter_id"), "meter_key")
        .join(sources.select("source_key", F.col("source_code").alias("source")), "source_key", "left")
        .select("time", "meter_id", "kwh", "is_anomaly", "source")
    )


def legacy_predictions(facts: DataFrame, meters: DataFrame, models: DataFrame) -> DataFrame:
    """Prediction facts in the shape of the predictions table."""
    return (
        facts.join(meters.select("meter_key", "meter_id"), "meter_key")
        .join(models.select("model_key", F.col("model_name").alias("model")), "model_key")
        .select("time", "meter_id", "model", "kwh_pred", "kwh_lower", "kwh_upper")
    )


def legacy_events(facts: DataFrame, meters: DataFrame) -> DataFrame:
    """Event facts in the shape of the events table."""
    detected = ["detected_at"] if "detected_at" in facts.columns else []
    return facts.join(meters.select("meter_key", "meter_id"), "meter_key").select(
        *detected, "meter_id", "reading_time", "kwh_actual", "kwh_expected", "deviation", "severity"
    )


def create_legacy_views(star: Mapping[str, DataFrame]) -> None:
    """Temporary views under the old table names over a star schema."""
    readings = legacy_readings(star["fact_meter_reading"], star["dim_meter"], star["dim_source"])
    readings.createOrReplaceTempView("meter_readings")
    if "fact_prediction" in star:
        predictions = legacy_predictions(star["fact_prediction"], star["dim_meter"], star["dim_model"])
        predictions.createOrReplaceTempView("meter_predictions")
    if "fact_anomaly_event" in star:
        legacy_events(star["fact_anomaly_event"], star["dim_meter"]).createOrReplaceTempView("anomaly_events")
    hourly = star["fact_reading_hourly"].join(star["dim_meter"].select("meter_key", "meter_id"), "meter_key")
    hourly.drop("meter_key").createOrReplaceTempView("meter_hourly")


def scd2_merge(dim: DataFrame, updates: DataFrame, tracked: Sequence[str], as_of: Column, key: str = "meter_key") -> DataFrame:
    """Close current rows whose tracked attributes changed and add their new versions, plus new members.

    ``updates`` has one row per ``meter_id``.  Keys of added rows follow the largest existing one.
    """
    current = dim.filter("is_current").select("meter_id", *[F.col(c).alias(f"_old_{c}") for c in tracked])
    same = F.lit(True)
    for column in tracked:
        same = same & F.col(column).eqNullSafe(F.col(f"_old_{column}"))
    compared = updates.select("meter_id", *tracked).join(
        current.withColumn("_known", F.lit(True)), "meter_id", "left"
    )
    fresh = compared.filter(F.col("_known").isNull() | ~same).select("meter_id", *tracked)
    # What is not tracked passes from the closed version to the new one.
    own = {"meter_id", key, "valid_from", "valid_to", "is_current", *tracked}
    carried = [c for c in dim.columns if c not in own]
    fresh = fresh.join(dim.filter("is_current").select("meter_id", *carried), "meter_id", "left")
    closed = dim.join(fresh.select("meter_id", F.lit(True).alias("_hit")), "meter_id", "left")
    ends = F.col("is_current") & F.coalesce("_hit", F.lit(False))
    closed = closed.withColumn("valid_to", F.when(ends, as_of).otherwise(F.col("valid_to"))).withColumn(
        "is_current", F.col("is_current") & ~ends
    )
    start = dim.agg(F.max(key)).first()[0] or 0
    opened = (
        global_index(fresh, ["meter_id"], "_idx", unique=True)
        .withColumn(key, (F.col("_idx") + 1 + start).cast("int"))
        .withColumn("valid_from", as_of)
        .withColumn("valid_to", F.lit(None).cast("timestamp"))
        .withColumn("is_current", F.lit(True))
    )
    return settled(closed.select(*dim.columns).unionByName(opened.drop("_idx"), allowMissingColumns=True), "dimension")


def scd2_history(versions: DataFrame, key: str = "meter_key") -> DataFrame:
    """Validity windows from dated versions ``(meter_id, valid_from, attributes)`` of the members."""
    by_member = Window.partitionBy("meter_id").orderBy("valid_from")
    closed = versions.withColumn("valid_to", F.lead("valid_from").over(by_member)).withColumn(
        "is_current", F.col("valid_to").isNull()
    )
    indexed = global_index(closed, ["meter_id", "valid_from"], "_idx")
    return settled(indexed.withColumn(key, (F.col("_idx") + 1).cast("int")).drop("_idx"), "dimension")


def as_of_join(facts: DataFrame, dim: DataFrame, columns: Sequence[str], time: str = "time", few: int = 64) -> DataFrame:
    """Attributes valid at the fact's time, null where there are none; at most one version matches.

    Where no meter has more than ``few`` versions, facts meet all versions of their meter: an equi-join that broadcasts a
    small dimension and lets AQE split a hot meter. Otherwise facts and versions are merged in order of time, so that the
    work does not grow with the versions of a meter.
    """
    versions = dim.filter("meter_id IS NOT NULL").select(F.col("meter_id").alias("_m"), "valid_from", "valid_to", *columns)
    most = versions.groupBy("_m").count().agg(F.max("count")).first()[0] or 0
    if most > few:
        return _merged_as_of(facts, versions, columns, time)
    valid = (
        (F.col("meter_id") == F.col("_m"))
        & (F.col(time) >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col(time) < F.col("valid_to")))
    )
    return facts.join(versions, valid, "left").drop("_m", "valid_from", "valid_to")


def _merged_as_of(facts: DataFrame, versions: DataFrame, columns: Sequence[str], time: str) -> DataFrame:
    """Versions and facts sorted together by meter and time; the last version before a fact is carried to it.

    The borders of the range sort cut through a large meter: a version that was last before a border is found in one row
    per meter and stretch.
    """
    version = F.struct("valid_to", *columns)
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    both = facts.select(
        F.col("meter_id").alias("_m"), F.col(time).alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(*[f"`{c}`" for c in facts.columns]).alias("_tie"), fact.alias("_fact")
    ).unionByName(versions.select("_m", F.col("valid_from").alias("_t"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), version.alias("_version")), allowMissingColumns=True)
    layout = ["_m", "_t", "_kind", "_tie"]
    placed = both.repartitionByRange(*layout).sortWithinPartitions(*layout)
    placed = settled(placed.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "merged")
    # One row per meter and stretch of the sort.
    last = placed.filter("_kind = 0").groupBy("_m", "_part").agg(F.max_by("_version", "_row").alias("_last"))
    stretches = matched(placed.select("_m", "_part").distinct(), last, ["_m", "_part"], "left")
    earlier = Window.partitionBy("_m").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = sized(stretches.select("_m", "_part", F.last("_last", ignorenulls=True).over(earlier).alias("_before")))
    inside = Window.partitionBy("_m", "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    carried = placed.withColumn("_here", F.last("_version", ignorenulls=True).over(inside)).filter("_kind = 1")
    found = matched(carried, stretches, ["_m", "_part"]).withColumn("_valid", F.coalesce("_here", "_before"))
    ends = F.col("_valid.valid_to")
    holds = F.col("_m").isNotNull() & (ends.isNull() | (F.col("_t") < ends))
    return found.select("_fact.*", *[F.when(holds, F.col(f"_valid.{c}")).alias(c) for c in columns])


def violations(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Mapping[str, Sequence[str]] | None = None,
    foreign: Mapping[str, tuple[str, DataFrame, str]] | None = None,
    domain: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows breaking each rule, as ``(rule, n)``.

    ``unique`` maps a rule name to its columns and counts surplus rows; ``foreign`` maps a rule name to
    ``(column, dimension, key)`` and counts non-null values absent from the dimension.
    """
    checks = {f"not_null_{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    for column, allowed in (domain or {}).items():
        checks[f"domain_{column}"] = F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
    parts = []
    if checks:
        one_pass = df.agg(*[expr.alias(name) for name, expr in checks.items()])
        parts.append(one_pass.unpivot([], [F.col(f"`{name}`") for name in checks], "rule", "n"))
    for name, columns in (unique or {}).items():
        copies = df.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("_extra"))
        parts.append(copies.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("n")).select(F.lit(name).alias("rule"), "n"))
    for name, (column, dim, key) in (foreign or {}).items():
        # Counting per value first leaves one row per distinct key for the lookup.
        used = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias("_c"))
        orphans = used.join(dim.select(key), key, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n")).select(F.lit(name).alias("rule"), "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
