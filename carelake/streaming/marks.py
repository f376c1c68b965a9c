"""Change detection on file streams.

The batch functions of ``operators.changes`` run on every micro-batch. The marks are kept in a store of
immutable folders: a base, cut into buckets by a hash of the key, and one delta per batch with the marks that the
batch moved. A batch reads the buckets its keys fall in, writes its delta, and lists the folders that
make up the marks after it. When the deltas hold as many bytes as the base, or there are ``most_deltas`` of them,
they are merged: small ones into one delta, grown ones with the base. So what a batch writes follows
its changes; a mark is rewritten a few times in all, however many batches there are.

A batch that is run again after a failure starts from the list of the batch before, whose folders are kept,
and overwrites its own. Folders that neither this list nor the one before names are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import advance_marks, changed_files


def file_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", glob: str = "*", files_per_batch: int = 10_000, **options: str
) -> DataFrame:
    """Every file of a folder once, in micro-batches of at most ``files_per_batch``; the stream
    checkpoint is the list of loaded files."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch)
    return reader.options(**options).load(path)


class MarkStore:
    """Marks (``keys``, ``time``) below ``root``, one state per version. ``like`` gives the types of the columns.

    The base has a folder per bucket, so a batch of few keys reads few of them; ``buckets`` is fixed for a store.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: Sequence[str], time: str, like: DataFrame, buckets: int = 64, most_deltas: int = 32
    ):
        self.spark, self.root, self.keys, self.time = spark, root, list(keys), time
        self.buckets, self.most_deltas = buckets, most_deltas
        self.schema = like.select(*keys, time).withColumn("bucket", F.lit(0)).schema

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def bytes_of(self, folder: str) -> int:
        path = self._path(folder)
        return self._files(path).getContentSummary(path).getLength()

    def state(self, version: int) -> dict:
        """The folders of a version: ``base`` (a name or null) and ``deltas``; an empty store before the first."""
        if version < 0:
            return {"base": None, "deltas": []}
        return json.loads(self.spark.read.text(f"{self.root}/state/version={version}", wholetext=True).first()[0])

    def _save_state(self, version: int, state: dict) -> None:
        line = self.spark.sql("SELECT :line AS value", {"line": json.dumps(state)})
        line.coalesce(1).write.mode("overwrite").text(f"{self.root}/state/version={version}")

    def read(self, state: dict, among: DataFrame | None = None) -> DataFrame:
        """The marks of a state, several per key where deltas moved one; of the buckets of ``among`` only, if given."""
        folders = [*([state["base"]] if state["base"] else []), *state["deltas"]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        # Every folder has the same layout, so that a filter on the bucket skips files of all of them.
        marks = None
        for folder in folders:
            one = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/{folder}").parquet(f"{self.root}/{folder}")
            marks = one if marks is None else marks.unionByName(one)
        if among is not None:  # ``buckets`` numbers at most
            met = [r[0] for r in among.select(self.bucket()).distinct().collect()]
            marks = marks.filter(F.col("bucket").isin(*met)) if len(met) < self.buckets else marks
        return marks

    def _write(self, marks: DataFrame, folder: str) -> str:
        bucketed = marks.select(*self.keys, self.time).withColumn("bucket", self.bucket())
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{folder}")
        return folder

    def _merged(self, folders: dict) -> DataFrame:
        marks = self.read(folders)
        return advance_marks(marks, marks.limit(0), self.keys, self.time)

    def advance(self, version: int, changed: DataFrame) -> dict:
        """Writes the state after ``changed`` (one row per key); running a version again gives the same state."""
        before = self.state(version - 1)
        state = {"base": before["base"], "deltas": list(before["deltas"])}
        if not changed.isEmpty():
            state["deltas"].append(self._write(changed, f"delta-{version}"))
        grown = sum(map(self.bytes_of, state["deltas"]))
        if state["deltas"] and (state["base"] is None or grown >= self.bytes_of(state["base"])):
            state = {"base": self._write(self._merged(state), f"base-{version}"), "deltas": []}
        elif len(state["deltas"]) > self.most_deltas:
            one = self._write(self._merged({"base": None, "deltas": state["deltas"]}), f"deltas-{version}")
            state["deltas"] = [one]
        self._save_state(version, state)
        self._sweep(version, before, state)
        return state

    def _sweep(self, version: int, before: dict, state: dict) -> None:
        """Deletes what neither this version nor the one before it names. Newer states are not touched:
        there are none while a version is written."""
        named = {"state", *before["deltas"], *state["deltas"], before["base"], state["base"]}
        root = self._path()
        files = self._files(root)
        for status in files.listStatus(root):
            if status.getPath().getName() not in named:
                files.delete(status.getPath(), True)
        old = self._path("state", f"version={version - 2}")
        files.delete(old, True)


def watch(
    stream: DataFrame, keys: Sequence[str], time: str, folder: str,
    on_change: Callable[[DataFrame, int], None] | None = None, first_marks: DataFrame | None = None, buckets: int = 64,
) -> StreamingQuery:
    """Runs the stream over everything available now. Changed rows of batch ``b`` go to
    ``folder/changes/version=b``; the marks are a ``MarkStore`` in ``folder/marks``, whose version ``b + 1`` is the one
    after batch ``b`` and whose version 0 holds ``first_marks``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = batch.select(*keys, time)
        store = MarkStore(spark, f"{folder}/marks", keys, time, seen, buckets)
        if batch_id == 0:
            first = seen.limit(0) if first_marks is None else first_marks.select(*keys, time)
            store.advance(0, advance_marks(first, first.limit(0), keys, time))
        marks = store.read(store.state(batch_id), seen)
        changes = f"{folder}/changes/version={batch_id}"
        changed_files(seen, marks, keys, time).write.mode("overwrite").parquet(changes)
        stored = spark.read.schema(seen.schema).parquet(changes)
        store.advance(batch_id + 1, stored)
        if on_change is not None:
            on_change(stored, batch_id)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def changes_of(spark: SparkSession, folder: str) -> DataFrame:
    """All changes found so far, with the batch that found them as ``version``."""
    return spark.read.parquet(f"{folder}/changes")


def load_new_files(
    stream: DataFrame, folder: str, out: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    partition: Sequence[str] = (),
) -> StreamingQuery:
    """Appends the rows of files not loaded before, each file exactly once."""
    writer = (
        transform(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", out).trigger(availableNow=True)
    )
    if partition:
        writer = writer.partitionBy(*partition)
    return writer.start()
