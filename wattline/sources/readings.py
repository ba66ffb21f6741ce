"""Canonical readings: CSV scans, series reads, message streams."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.text import TRUE_WORDS, decode_message, parse_bool
from wattline.functions.time import parse_time
from wattline.schema import READING_COLUMNS, require_columns

READABLE = "(time IS NOT NULL AND meter_id IS NOT NULL AND kwh IS NOT NULL)"
READINGS_GLOB = "*_meter_readings.csv"
#: Files whose header is read at the same time; each takes a small job.
HEADERS = 16


def read_readings_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    glob: str | None = None,
    strict: bool = True,
    true_words: Sequence[str] = TRUE_WORDS,
) -> DataFrame:
    """Typed readings from header CSV files; a missing source becomes the file's stem.

    ``glob`` limits a folder to matching names (``READINGS_GLOB`` finds the prepared feeds).  ``strict``
    raises on unreadable times and numbers, otherwise they become null for :func:`clean` to drop.
    Columns are found by name in every file: each header is read once, ``HEADERS`` files at a time, and files with the same
    one are scanned together.
    """
    reader = spark.read.option("header", True)
    listing = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    files = sorted(unquote(f) for f in listing.text(path).inputFiles())
    by_header: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADERS) as several:
        for file, columns in zip(files, several.map(lambda file: tuple(reader.csv(file).columns), files), strict=True):
            require_columns(columns, {"time", "meter_id", "kwh", "is_anomaly"}, file)
            by_header.setdefault(columns, []).append(file)
    if not by_header:  # an empty folder, or nothing that matches
        raise FileNotFoundError(f"no readings file in {path}")
    tables = [_typed(reader.csv(files), strict, true_words) for files in by_header.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _typed(raw: DataFrame, strict: bool, true_words: Sequence[str]) -> DataFrame:
    """Readings columns of files that share one header; further columns are kept."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    given = F.nullif(F.trim(F.col("source")), F.lit("")) if "source" in raw.columns else F.lit(None).cast("string")
    number = F.col("kwh").cast("double") if strict else F.col("kwh").try_cast("double")
    extra = [name for name in raw.columns if name not in READING_COLUMNS]
    return raw.select(
        parse_time(F.col("time"), strict=strict).alias("time"),
        F.trim("meter_id").alias("meter_id"),
        number.alias("kwh"),
        parse_bool(F.col("is_anomaly"), true_words).alias("is_anomaly"),
        F.coalesce(given, F.url_decode(stem)).alias("source"),
        *extra,
    )


def clean(df: DataFrame) -> DataFrame:
    """Coerce text times and numbers, then drop rows lacking time, meter or value."""
    types = dict(df.dtypes)
    if types["time"] == "string":
        df = df.withColumn("time", parse_time(F.col("time")))
    if types["kwh"] == "string":
        df = df.withColumn("kwh", F.col("kwh").try_cast("double"))
    return df.filter(~F.isnan("kwh")).dropna(subset=["time", "meter_id", "kwh"])


def series(df: DataFrame, source: str, since: str | None = None, now: datetime | None = None) -> DataFrame:
    """Times and values of one source, optionally no older than ``now - since`` (an interval such as ``90 days``)."""
    picked = df.filter(F.col("source") == source)
    if since is not None:
        picked = picked.filter(F.col("time") >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {since}"))
    return picked.select("time", "kwh")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All normalised feeds as one table."""
    out = feeds[0].select(*READING_COLUMNS)
    for feed in feeds[1:]:
        out = out.unionByName(feed.select(*READING_COLUMNS))
    return out


def read_messages(spark: SparkSession, options: dict[str, str] | None = None, folder: str | None = None) -> DataFrame:
    """Stream of raw messages as a ``value`` string: a broker topic from its start, or a folder of text files."""
    if folder is not None:
        return spark.readStream.text(folder)
    source = spark.readStream.format("kafka").option("startingOffsets", "earliest")
    return source.options(**(options or {})).load().select(F.col("value").cast("string").alias("value"))


def readings_from_messages(messages: DataFrame, default_source: str = "kafka_live_replay") -> DataFrame:
    """Decode messages, filling the anomaly flag and the source when absent; :func:`unreadable_messages` has the rest."""
    return _decoded(messages, default_source).filter(READABLE).drop("value")


def unreadable_messages(messages: DataFrame) -> DataFrame:
    """The messages, as they came, that lack a readable time, meter or value."""
    return _decoded(messages, "").filter(f"NOT coalesce({READABLE}, false)").select("value")


def _decoded(messages: DataFrame, default_source: str) -> DataFrame:
    body = messages.select("value", decode_message(F.col("value")).alias("m")).select("value", "m.*")
    return body.select(
        "value",
        parse_time(F.col("timestamp")).alias("time"),
        "meter_id",
        "kwh",
        F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"),
        F.coalesce("source", F.lit(default_source)).alias("source"),
    )


def ordered(df: DataFrame, keys: Iterable[str] = ("source", "meter_id", "time")) -> DataFrame:
    """Globally sorted output (a range sort, not a single partition)."""
    return df.orderBy(*keys)
