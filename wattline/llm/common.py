"""Shared helpers: reading tables, adding columns in Arrow batches, bounded label samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts handed to Python at once; bounds a worker's memory when texts are long.
SLICE = 256
#: Rows that Spark packs for Python at once. Texts are packed outside an executor's heap, twice and with room to grow.
PACKED = 1024

#: The six ASCII separators of words.
SEPARATORS = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], fields: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` for rows with texts: from now on the session packs at most ``PACKED`` rows at once.

    The setting is read when the result is computed, so it must outlast this call. A smaller one is left as it is.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= PACKED:
        conf.set(key, PACKED)
    return df.mapInArrow(run, fields)


def annotated(
    df: DataFrame, text: str, carry: list[str], fields: T.StructType, start: Callable[[], Callable[[list], list[list]]]
) -> DataFrame:
    """``carry`` columns of every row, in place, and ``fields`` computed from the column ``text``.

    ``start`` runs once per task and returns a function from a list of texts (None for null) to one list of
    values per field. A carried column named like a field (in any case) is left out: the new one wins.
    """
    taken = {f.name.lower() for f in fields}
    carry = [c for c in carry if c.lower() not in taken]
    schema = T.StructType([df.schema[c] for c in carry] + list(fields))
    names = schema.names
    inner = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.col(f"`{text}`").alias("t"))
    kinds = arrow_types(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = start()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                new = made(batch.column(batch.num_columns - 1).to_pylist())
                old = batch.columns[:-1]
                new = [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(new, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*old, *new], names=names)

    return in_batches(inner, run, schema)


def arrow_types(fields: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in fields]


def schema(spec: str) -> T.StructType:
    return T.StructType.fromDDL(spec)


def share(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the row's values alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def stratified(df: DataFrame, by: str, id_col: str, most: int) -> DataFrame:
    """About ``most`` rows of each value of ``by`` (never many more), chosen by a hash of the id.

    The counts are of all rows; null values of ``by`` are left out. Only for fitting classifiers.
    """
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).count()
    rate = counts.select(F.col(by).alias("_by"), (F.lit(float(most)) / F.col("count")).alias("_rate"))
    return df.join(F.broadcast(rate.limit(4096)), F.col(by) == F.col("_by")).filter(
        share(F.lit("sample"), F.col(id_col)) < F.col("_rate")
    ).drop("_by", "_rate")
