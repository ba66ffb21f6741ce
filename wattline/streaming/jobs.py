"""Structured Streaming jobs: ingest, rollups, dual write, detection, replay.

Every job takes its input stream, output folder and checkpoint folder; ``available_now=True`` drains what is
there and stops, otherwise the job runs on until stopped.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.functions.text import severity
from wattline.operators.detect import actual_vs_forecast
from wattline.operators.rollups import REFRESH_POLICIES, rollup_columns
from wattline.operators.series import global_index
from wattline.operators.star import build_fact_readings, resolve_keys, source_code
from wattline.schema import READING_COLUMNS
from wattline.session import ROCKSDB, passing, setting, settled
from wattline.sinks.maintain import chunks_of, compact, log_touched, read_chunks, recover, subfolders
from wattline.sinks.tables import first_per_key, time_chunk
from wattline.sources.readings import readings_from_messages, unreadable_messages
from wattline.streaming.residuals import score_stream

EVENTS = (
    "meter_id string, reading_time timestamp, kwh_actual double, kwh_expected double, deviation double, z_score double, severity string"
)
# How long a duplicate filter on a stream remembers; the ingest itself does not forget.
DEDUP_DELAY = "1 day"


def _start(writer, available_now: bool) -> StreamingQuery:
    query = writer.trigger(availableNow=True).start() if available_now else writer.start()
    if available_now:
        query.awaitTermination()
    return query


def dedup_stream(readings: DataFrame, delay: str = DEDUP_DELAY) -> DataFrame:
    """First arrival per (meter, time) within the delay."""
    return readings.withWatermark("time", delay).dropDuplicatesWithinWatermark(["meter_id", "time"])


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run a checkpoint stands for: the query's lasting id. A new checkpoint starts a new run."""
    lines = spark.read.text(f"{checkpoint}/metadata").collect()  # one line, written by Spark when the query first starts
    return f"run-{json.loads(lines[0][0])['id']}"


def store_new(rows: DataFrame, out: str, run: str, batch_id: int, keys: Sequence[str] = ("meter_id", "time")) -> DataFrame:
    """Store those rows whose key is not stored yet, and return them as stored.

    The table lies by time chunk, run and batch. Only the chunks that the rows fall in are read, and a batch that is
    repeated overwrites what it wrote before; a batch of another run never does.
    """
    spark = rows.sparkSession
    layout = ["time_chunk", *keys]
    rows = settled(rows.withColumn("time_chunk", time_chunk(F.col("time"))), "arrived")
    chunks = {row[0] for row in rows.select("time_chunk").distinct().collect()}  # one per touched week
    own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
    known = sorted(chunks.intersection(chunks_of(spark, out)))
    if known:
        rows = rows.join(read_chunks(spark, out, known).filter(~own).select(*keys), list(keys), "left_anti")
    (
        rows.withColumn("run", F.lit(run))
        .withColumn("batch_id", F.lit(batch_id))
        .repartitionByRange(*layout)
        .sortWithinPartitions(*layout)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("time_chunk", "run", "batch_id")
        .parquet(out)
    )
    stored = sorted(chunks.intersection(chunks_of(spark, out)))
    return read_chunks(spark, out, stored).filter(own) if stored else rows.limit(0)


def ingest_writer(out: str, rejected: str, run: Callable[[SparkSession], str], logs: Sequence[str] = (), merge: int = 64) -> Callable[[DataFrame, int], None]:
    """Batch function storing new readings below ``out`` and unreadable messages below ``rejected``.

    However late, a reading is stored unless its (meter, time) is stored already. Every rollup's log gets the buckets that
    stored readings fall in. Chunks of more than ``merge`` batch folders are merged.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with passing(spark):
            recover(spark, out)
            name = run(spark)
            unreadable_messages(batch).write.mode("overwrite").text(_batch_path(f"{rejected}/run={name}", batch_id))
            rows = first_per_key(readings_from_messages(batch).select(*READING_COLUMNS), ["meter_id", "time"], ["kwh"])
            stored = store_new(rows, out, name, batch_id)
            log_touched(stored, logs, f"{name}-{batch_id}")
            if batch_id % merge == merge - 1:
                compact(spark, out, chunks_of(spark, out), most=merge)

    return write


def ingest_stream(
    messages: DataFrame, out: str, checkpoint: str, rejected: str | None = None, available_now: bool = False, logs: Sequence[str] = ()
) -> StreamingQuery:
    """Messages to the readings table: decode, fill defaults, insert what is new, keep unreadable messages aside.

    ``out`` lies by time chunk, run and batch; unreadable messages go to ``rejected`` (``<out>-rejected``). ``logs`` are
    the folders from which :func:`wattline.sinks.maintain.refresh_touched` learns what late readings changed.
    """
    name = lambda spark: run_of(spark, checkpoint)
    writer = messages.writeStream.foreachBatch(ingest_writer(out, rejected or f"{out.rstrip('/')}-rejected", name, logs))
    return _start(writer.option("checkpointLocation", checkpoint), available_now)


def stream_rollup(readings: DataFrame, width: str, watermark: str | None = None) -> DataFrame:
    """Tumbling aggregates of a readings stream; the watermark defaults to the rollup's refresh window.

    In append mode a bucket appears once it can no longer change; rows later than the watermark are left to a
    batch refresh.
    """
    delay = watermark or f"{int(REFRESH_POLICIES[width][0].total_seconds())} seconds"
    grouped = readings.withWatermark("time", delay).groupBy(F.window("time", width).alias("w"), "meter_id")
    columns = grouped.agg(*rollup_columns(width))
    return columns.withColumn("bucket", F.col("w.start")).drop("w")


def rollup_job(
    readings: DataFrame,
    width: str,
    out: str,
    checkpoint: str,
    watermark: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append closed buckets to a parquet table."""
    writer = stream_rollup(readings, width, watermark).writeStream.outputMode("append").format("parquet")
    return _start(writer.option("path", out).option("checkpointLocation", checkpoint), available_now)


def _batch_path(out: str, batch_id: int) -> str:
    return f"{out}/batch_id={batch_id}"


def _members(spark: SparkSession, path: str) -> DataFrame | None:
    """What batches have written to a dimension (None before the first)."""
    return spark.read.parquet(path) if subfolders(spark, path) else None


def dual_writer(out: str, run: Callable[[SparkSession], str] = lambda spark: "run-0") -> Callable[[DataFrame, int], None]:
    """Batch function writing readings and star-schema facts side by side.

    Readings are stored unless their (meter, time) is, however late. Each batch owns its folders and overwrites them when
    repeated; new meters and sources get their keys against the members of other batches only, so a repeat assigns the
    same ones. A batch without new members adds no folder to a dimension. Intermediate tables go with the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with passing(batch.sparkSession):
            store(batch, batch_id)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = run(spark)
        arrived = first_per_key(batch.select(*READING_COLUMNS), ["meter_id", "time"], ["kwh"])
        rows = store_new(arrived, f"{out}/readings", name, batch_id).select(*READING_COLUMNS)
        own = (F.col("run") == name) & (F.col("batch_id") == batch_id)
        dims = {}
        sources = rows.select(source_code().alias("source_code"))
        meters = rows.select("meter_id", source_code().alias("source_code"))
        for table, members, natural, key in (
            ("dim_source", sources, ["source_code"], "source_key"),
            ("dim_meter", meters, ["meter_id"], "meter_key"),
        ):
            path = f"{out}/{table}"
            held = _members(spark, path)
            known = None if held is None else held.filter(~own).drop("run", "batch_id")
            everyone = resolve_keys(known, members, natural, key)
            added = settled(everyone if known is None else everyone.join(known, key, "left_anti"), "members")
            if not added.isEmpty():
                added.write.mode("overwrite").parquet(_batch_path(f"{path}/run={name}", batch_id))
            dims[table] = added if known is None else known.unionByName(added)
        facts = build_fact_readings(rows, dims["dim_meter"], dims["dim_source"]).withColumn("time_chunk", time_chunk(F.col("time")))
        layout = ["time_chunk", "meter_key", "time"]
        (
            facts.withColumn("run", F.lit(name))
            .withColumn("batch_id", F.lit(batch_id))
            .repartitionByRange(*layout)
            .sortWithinPartitions(*layout)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("time_chunk", "run", "batch_id")
            .parquet(f"{out}/fact_meter_reading")
        )

    return write


def dual_write_job(readings: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Run :func:`dual_writer` on a readings stream."""
    write = dual_writer(out, lambda spark: run_of(spark, checkpoint))
    return _start(readings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now)


def detect_job(
    readings: DataFrame,
    predictions: DataFrame,
    out: str,
    checkpoint: str,
    threshold: float = 3.0,
    rows: int = 96,
    available_now: bool = False,
    silence: str | None = None,
) -> StreamingQuery:
    """Residual detection that keeps each meter's last residuals as state, see :mod:`wattline.streaming.residuals`.

    Each batch is joined with the predictions and scored against the state; no stored reading is read again. Events go to
    ``<out>/events``. With ``silence`` (such as ``30 days``) the state of a meter that sends nothing for so long goes; such a
    query watches the clock and does not end by itself.
    """
    if silence is not None and available_now:
        raise ValueError("a query with a silence limit never runs out of work: use it without available_now")
    scored = score_stream(actual_vs_forecast(readings, predictions), rows, threshold, silence)
    events = scored.select(
        "meter_id",
        F.col("time").alias("reading_time"),
        "kwh_actual",
        "kwh_expected",
        (F.col("kwh_actual") - F.col("kwh_expected")).alias("deviation"),
        "z_score",
        severity(F.col("z_score"), threshold).alias("severity"),
    )
    writer = events.writeStream.outputMode("append").format("parquet").option("path", f"{out}/events")
    # A query keeps the settings it was started with; only this store has the lists that the state consists of.
    with setting(readings.sparkSession, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
        return _start(writer.option("checkpointLocation", checkpoint), available_now)


def detected_events(spark: SparkSession, out: str) -> DataFrame:
    """Events found by :func:`detect_job`, each reading once."""
    return first_per_key(spark.read.schema(EVENTS).parquet(f"{out}/events"), ["meter_id", "reading_time"], ["z_score"])


def replay(
    df: DataFrame,
    start: datetime,
    cadence_seconds: int = 60,
    anomaly_every: int = 17,
    anomaly_factor: float = 2.5,
    limit: int | None = None,
    order: tuple[str, ...] = ("time", "meter_id", "kwh"),
) -> DataFrame:
    """Readings with fresh, evenly spaced times; every Nth is scaled and flagged."""
    rows = df.orderBy(*order).limit(limit) if limit is not None else df
    indexed = global_index(rows, order)
    micros = F.lit(cadence_seconds).cast("long") * 1_000_000 * F.col("idx")
    time = F.timestamp_micros(F.unix_micros(F.lit(start).cast("timestamp")) + micros)
    hit = F.lit(False)
    if anomaly_every > 0:
        hit = (F.col("idx") > 0) & (F.pmod("idx", F.lit(anomaly_every)) == 0)
    return indexed.select(
        time.alias("time"),
        "meter_id",
        F.round(F.when(hit, F.col("kwh") * anomaly_factor).otherwise(F.col("kwh")), 8).alias("kwh"),
        (hit | F.coalesce("is_anomaly", F.lit(False))).alias("is_anomaly"),
        F.coalesce(F.nullif("source", F.lit("")), F.lit("live_replay")).alias("source"),
    )
