"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Streaming state on local disk instead of the executor heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "wattline", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library relies on; extra ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the time zone: buckets and days are cut in UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting inside the block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; needless where it is installed on all machines."""
    package = Path(__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='wattline-ship-')}/{package.name}"
    spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))


def one_machine(master: str) -> bool:
    """Whether a master runs everything in one process (``local-cluster`` does not)."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only where all executors are threads of this machine, a folder of our own stands in for an unset one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="wattline-")
        spark.sparkContext.setCheckpointDir(named)
    return named


#: Per thread, the paths handed out inside each open ``passing`` block.
_open = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in one subfolder per application."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark).rstrip('/')}/wattline-{app}/{name}-{uuid.uuid4().hex}"
    if blocks := getattr(_open, "blocks", None):
        blocks[-1].append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block, failed or not, what was stored inside it.

    For micro-batches: whatever is to last must be written elsewhere inside the block. A DataFrame over a deleted
    table cannot be used afterwards.
    """
    _open.blocks = [*getattr(_open, "blocks", []), []]
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for name in _open.blocks.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)


def sized(df: DataFrame) -> DataFrame:
    """Settle a per-group or per-chunk table before joining it to the rows it came from.

    Its size on disk is then known when the join is planned: Spark broadcasts it if it is below the
    broadcast threshold, which spares the shuffle of the large side, and otherwise joins by key.
    """
    return settled(df, "stats")


def settled(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Used where a table feeds several later steps: they scan the columns they need instead of computing it
    again, the lineage is cut, and nothing depends on executors that may be lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
