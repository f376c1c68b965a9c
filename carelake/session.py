"""Session set-up for local runs, and the one place that knows about checkpoints."""

from __future__ import annotations

import atexit
import contextlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "16g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("carelake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def task_count(spark: SparkSession) -> int:
    """Number of tasks a large step is cut into: the shuffle setting, at least one per core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


_written: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, for tables written between two jobs.
    ``release`` deletes all of them; it also runs when the program ends."""
    _ensure_checkpoint_dir(spark)
    if not _written:
        atexit.register(_release_at_exit)
    _written.append(f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}")
    return _written[-1]


def release(spark: SparkSession) -> None:
    """Deletes the tables written through ``shared_folder`` so far."""
    sc = spark.sparkContext
    while _written:
        path = sc._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def _release_at_exit() -> None:
    active = SparkSession.getActiveSession()
    if active is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            release(active)


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, a folder of the warehouse."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    sc.setCheckpointDir(shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that partition ids and row
    numbers taken from it stay the same however often later jobs read it. Spark deletes the files
    when the result is no longer referenced (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table as a local relation (no Python worker is started to read it)."""
    names = [part.split()[0] for part in schema.split(",")]
    types = [part.split()[1] for part in schema.split(",")]
    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}
    columns = [pa.array([row[i] for row in rows], arrow[t]) for i, t in enumerate(types)]
    return spark.createDataFrame(pa.table(dict(zip(names, columns))))


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, read as often as needed, and
    still there when an executor is lost."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.option("compression", "zstd").partitionBy(*(partition_by or [])).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
