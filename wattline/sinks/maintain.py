"""Tables stored by time chunk and changed in place: slices replaced, rollups refreshed, expired chunks dropped.

Only the chunk folders that a change touches are read and written. Their new content is stored beside the table first, so
it may be computed from the table itself, and then takes their place by a dynamic partition overwrite. A note in the
table's folder says what is being replaced by what; :func:`recover`, which every change runs first, repeats a replacement
that did not end. One change at a time may run on a table, and readers should not scan its touched chunks meanwhile.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.time import time_bucket
from wattline.operators.rollups import REFRESH_POLICIES, rollup
from wattline.session import settled, sized
from wattline.sinks.tables import CHUNK_DAYS, time_chunk

NOTE = "_replacing"
EPOCH = datetime(1970, 1, 1)
WIDTHS = {"15 minutes": timedelta(minutes=15), "1 hour": timedelta(hours=1), "1 day": timedelta(days=1)}
#: Width of the buckets on a log of touched times; every rollup's buckets are made of them.
LOG_WIDTH = "15 minutes"


# ---- folders -------------------------------------------------------------------------------------------


def _hadoop(spark: SparkSession, path: str):
    """The file system and the Hadoop path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones."""
    files, place = _hadoop(spark, path)
    if not files.exists(place):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(place)]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def delete(spark: SparkSession, path: str) -> None:
    files, place = _hadoop(spark, path)
    files.delete(place, True)


def chunks_of(spark: SparkSession, path: str) -> list[date]:
    """The first days of the stored chunks; there is one folder a week."""
    return [date.fromisoformat(name.split("=")[1]) for name in subfolders(spark, path) if name.startswith("time_chunk=")]


def read_chunks(spark: SparkSession, path: str, chunks: Iterable[date]) -> DataFrame:
    """The rows of some stored chunks, at least one; no other folder is listed."""
    return spark.read.option("basePath", path).parquet(*[f"{path}/time_chunk={chunk}" for chunk in chunks])


def stage(rows: DataFrame, path: str) -> tuple[str, DataFrame]:
    """Store rows out of sight in the table's folder: their path, and the rows as read from there."""
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    return staged, rows.sparkSession.read.schema(rows.schema).parquet(staged)


def swap(spark: SparkSession, path: str, staged: str, rows: DataFrame, by: Sequence[str], gone: Iterable[str], layout: Sequence[str]) -> None:
    """Put staged rows in the place of the partitions (by the columns ``by``) they fall in, and delete the folders ``gone``.

    What a failure interrupts is ended by :func:`recover`.
    """
    note = {"staged": staged, "schema": rows.schema.json(), "by": list(by), "gone": sorted(gone), "layout": list(layout)}
    files, place = _hadoop(spark, f"{path}/{NOTE}")
    stream = files.create(place, True)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> bool:
    """End a replacement that was begun; whether there was one. Every step may be repeated."""
    files, place = _hadoop(spark, f"{path}/{NOTE}")
    if not files.exists(place):
        return False
    stream = files.open(place)
    note = json.loads(bytes(stream.readAllBytes()).decode())
    stream.close()
    rows = spark.read.schema(T.StructType.fromJson(json.loads(note["schema"]))).parquet(note["staged"])
    layout = [*note["by"], *note["layout"]]
    (
        rows.repartitionByRange(*layout)
        .sortWithinPartitions(*layout)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*note["by"])
        .parquet(path)
    )
    for folder in note["gone"]:
        delete(spark, f"{path}/{folder}")
    files.delete(place, False)
    delete(spark, note["staged"])
    return True


# ---- slices --------------------------------------------------------------------------------------------


def half_open(df: DataFrame, column: str, lo: datetime | None, hi: datetime | None) -> DataFrame:
    """Rows with ``lo <= column < hi``, with the matching predicate on the chunk; None is no bound."""
    for bound, above in ((lo, True), (hi, False)):
        if bound is None:
            continue
        limit = F.lit(bound).cast("timestamp")
        df = df.filter(F.col(column) >= limit if above else F.col(column) < limit)
        if "time_chunk" in df.columns:
            df = df.filter(F.col("time_chunk") >= time_chunk(limit) if above else F.col("time_chunk") <= time_chunk(limit))
    return df


def replace_in_place(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    lo: datetime | None = None,
    hi: datetime | None = None,
    condition: Column | None = None,
    keys: Sequence[str] = ("meter_id",),
    time: str = "time",
    at: DataFrame | None = None,
) -> list[date]:
    """Delete the rows with ``lo <= time < hi`` and ``condition``, insert ``new``, and say which chunks were written.

    Only chunks that hold such rows, or receive new ones, are read whole and written. ``new`` may be computed from the
    table. A null condition does not hold. ``at`` narrows the slice to the times in its only column, which must be
    distinct. Rows of ``new`` outside the slice are inserted as well.
    """
    recover(spark, path)
    new = settled(new.drop("time_chunk").withColumn("time_chunk", time_chunk(F.col(time))), "new")
    touched = _chunks_in(new)
    there = chunks_of(spark, path)
    if at is not None:
        named = {row[0] for row in at.select(time_chunk(F.col(at.columns[0]))).distinct().collect()}  # one per touched week
        there = [chunk for chunk in there if chunk in named | touched]
    goes = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    rows = new
    if there:
        held = half_open(read_chunks(spark, path, there), time, lo, hi).filter(goes)
        touched |= _chunks_in(held if at is None else held.join(at, held[time] == at[at.columns[0]], "left_semi"))
        there = [chunk for chunk in there if chunk in touched]
    if there:
        old = read_chunks(spark, path, there)
        columns = old.columns
        if lo is not None:
            goes = goes & (F.col(time) >= F.lit(lo).cast("timestamp"))
        if hi is not None:
            goes = goes & (F.col(time) < F.lit(hi).cast("timestamp"))
        if at is not None:
            old = old.join(at.select(F.col(at.columns[0]).alias("_at")), F.col(time) == F.col("_at"), "left")
            goes = goes & F.col("_at").isNotNull()
        rows = old.filter(~F.coalesce(goes, F.lit(False))).select(*columns).unionByName(new, allowMissingColumns=True)
    if touched:
        staged, rows = stage(rows, path)
        gone = [f"time_chunk={chunk}" for chunk in touched - _chunks_in(rows)]
        swap(spark, path, staged, rows, ["time_chunk"], gone, [*keys, time])
    return sorted(touched)


def _chunks_in(df: DataFrame) -> set[date]:
    return {row[0] for row in df.select("time_chunk").distinct().collect()}  # one per touched week


def drop_expired(spark: SparkSession, path: str, days: int, now: datetime) -> list[date]:
    """Delete the folders of chunks that end at least ``days`` before ``now``; no data is read. Says which ones."""
    limit = now - timedelta(days=days)
    ends = {chunk: datetime(chunk.year, chunk.month, chunk.day) + timedelta(days=CHUNK_DAYS) for chunk in chunks_of(spark, path)}
    gone = [chunk for chunk, end in ends.items() if end <= limit]
    for chunk in gone:
        delete(spark, f"{path}/time_chunk={chunk}")
    return gone


def compact(spark: SparkSession, path: str, chunks: Iterable[date], keys: Sequence[str] = ("meter_id",), time: str = "time", most: int = 8) -> None:
    """Merge the batch folders of chunks that have more than ``most`` into one folder per chunk.

    For tables by chunk, run and batch, as the streams write them. A batch that is repeated afterwards finds its rows
    stored and writes nothing.
    """
    recover(spark, path)
    for chunk in chunks:
        home = f"time_chunk={chunk}"
        parts = [f"{home}/{run}/{batch}" for run in subfolders(spark, f"{path}/{home}") for batch in subfolders(spark, f"{path}/{home}/{run}")]
        if len(parts) > most:
            merged = read_chunks(spark, path, [chunk]).withColumns({"run": F.lit(f"merged-{uuid.uuid4().hex}"), "batch_id": F.lit(0)})
            staged, merged = stage(merged, path)
            swap(spark, path, staged, merged, ["time_chunk", "run", "batch_id"], parts, [*keys, time])


# ---- rollups -------------------------------------------------------------------------------------------


def covered_range(width: str, lo: datetime | None, hi: datetime | None) -> tuple[datetime | None, datetime | None]:
    """The buckets that lie fully inside ``[lo, hi)``: start of the first and end of the last."""
    step = WIDTHS[width]
    first = None if lo is None else EPOCH - (EPOCH - lo) // step * step
    last = None if hi is None else EPOCH + (hi - EPOCH) // step * step
    return first, last


def refresh_in_place(
    spark: SparkSession,
    path: str,
    raw: DataFrame,
    width: str,
    lo: datetime | None = None,
    hi: datetime | None = None,
    keys: Sequence[str] = ("meter_id",),
) -> list[date]:
    """Recompute the buckets of a stored rollup that lie fully inside ``[lo, hi)``; no bounds means a rebuild."""
    first, last = covered_range(width, lo, hi)
    if first is not None and last is not None and first >= last:
        return []
    fresh = rollup(half_open(raw, "time", first, last), width, keys)
    return replace_in_place(spark, path, fresh, first, last, keys=keys, time="bucket")


def scheduled_refresh_in_place(
    spark: SparkSession, path: str, raw: DataFrame, width: str, now: datetime, keys: Sequence[str] = ("meter_id",)
) -> list[date]:
    """What the rollup's policy does at ``now``: the recent window, without the still open buckets."""
    start, end = REFRESH_POLICIES[width]
    return refresh_in_place(spark, path, raw, width, now - start, now - end, keys)


# ---- late data -----------------------------------------------------------------------------------------


def log_touched(rows: DataFrame, logs: Iterable[str], name: str) -> None:
    """Note on every log which finest buckets some stored rows fall in; a repetition uses the same name."""
    if not (logs := list(logs)):
        return
    touched = sized(rows.select(time_bucket(F.col("time"), LOG_WIDTH).alias("touched")).distinct())
    for log in logs:
        touched.write.mode("overwrite").parquet(f"{log}/{name}")


def touched_rows(raw: DataFrame, buckets: DataFrame, width: str) -> DataFrame:
    """The raw rows of some buckets; only their chunks and the time between the first and the last are read."""
    n, first, last = buckets.agg(F.count(F.lit(1)), *[f("bucket").cast("timestamp_ntz") for f in (F.min, F.max)]).first()
    if not n:
        return raw.limit(0)
    if "time_chunk" in raw.columns:
        chunks = buckets.select(time_chunk(F.col("bucket"))).distinct().collect()  # one per touched week
        raw = raw.filter(F.col("time_chunk").isin([row[0] for row in chunks]))
    rows = half_open(raw, "time", first, last + WIDTHS[width])
    return rows.withColumn("bucket", time_bucket(F.col("time"), width)).join(buckets, "bucket", "left_semi").drop("bucket")


def refresh_touched(
    spark: SparkSession,
    path: str,
    log: str,
    raw: DataFrame,
    width: str,
    hi: datetime | None = None,
    keys: Sequence[str] = ("meter_id",),
) -> list[date]:
    """Recompute exactly the buckets of a stored rollup that its log names and take them off the log; the chunks written.

    Buckets that end after ``hi`` stay on the log. Entries that arrive meanwhile stay for the next refresh, and a refresh
    that fails midway can be run again. Every rollup has a log of its own.
    """
    entries = subfolders(spark, log)
    if not entries:
        return []
    named = spark.read.parquet(*[f"{log}/{entry}" for entry in entries])
    named = sized(named.select("touched", time_bucket(F.col("touched"), width).alias("bucket")).distinct())
    ends = F.col("bucket") + F.expr(f"INTERVAL {width}")
    closed = F.lit(True) if hi is None else ends <= F.lit(hi).cast("timestamp")
    buckets = sized(named.filter(closed).select("bucket").distinct())
    fresh = rollup(touched_rows(raw, buckets, width), width, keys)
    written = replace_in_place(spark, path, fresh, keys=keys, time="bucket", at=buckets)
    named.filter(~closed).select("touched").write.parquet(f"{log}/later-{uuid.uuid4().hex}")
    for entry in entries:
        delete(spark, f"{log}/{entry}")
    return written
