"""Row positions over a whole table without putting the table through one task.

A window with no partition key would sort everything in one task. Here the rows are range
partitioned on the full order, numbered inside each partition, and shifted by the row counts of
the partitions before. The numbered rows are written, because range bounds are sampled: the
counts and the rows must come from the same split. That is one shuffle; what a row needs of the
rows before it in its partition is added on the way to the file.

Range bounds cut between different rows only. Unless the caller says that the order is unique, the
order is therefore continued by a hash of the row and a tie-break number, so that a group of
copies of any size is cut like other rows. The numbers are given after a local sort by the
hash: whichever way the rows of a task arrive, copies get the same numbers, and a task that is run
again after a loss deals out the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import task_count, written

_PID_BITS = 33
Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _partitions(df: DataFrame, partitions: int | None) -> int:
    return partitions or task_count(df.sparkSession)


def _range_numbered(
    df: DataFrame, order: Sequence[Column], unique: bool, partitions: int | None, scan: Scan | None = None, added: str = ""
) -> DataFrame:
    """Written rows with their partition ``_pid`` and the place ``_idx`` among its rows. ``scan`` goes over the sorted
    rows of each partition, ``_mid`` last, and appends the columns ``added``."""
    names = df.columns
    if not unique:
        # Nulls are hashed as such, else rows that differ in the place of a null would share a hash.
        row = F.xxhash64(*[F.col(f"`{c}`") for c in names], *[F.col(f"`{c}`").isNull() for c in names])
        df = df.withColumn("_hash64", row).sortWithinPartitions("_hash64").withColumn("_tie64", F.monotonically_increasing_id())
        order = [*order, F.col("_hash64"), F.col("_tie64")]
    ranged = df.repartitionByRange(_partitions(df, partitions), *order).sortWithinPartitions(*order)
    numbered = ranged.select(*[f"`{c}`" for c in names], F.monotonically_increasing_id().alias("_mid"))
    if scan is not None:
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
        numbered = numbered.mapInArrow(scan, f"{kinds}, {added}")
    return written(numbered, "positions").withColumns(
        {
            "_pid": F.shiftright("_mid", _PID_BITS),
            "_idx": F.col("_mid").bitwiseAND(F.lit((1 << _PID_BITS) - 1)),
        }
    )


def _offsets(numbered: DataFrame) -> DataFrame:
    """Rows before each partition. One row per range partition, so the single-task window and
    the broadcast are bounded by the partition count."""
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def with_position(
    df: DataFrame, order: Sequence[Column], name: str = "position", unique: bool = False, partitions: int | None = None
) -> DataFrame:
    """1-based position of every row in the total order given by ``order``. Rows that are equal in
    the order but not elsewhere are placed by a hash of the row."""
    numbered = _range_numbered(df, order, unique, partitions)
    placed = numbered.join(F.broadcast(_offsets(numbered)), "_pid")
    return placed.withColumn(name, F.col("_offset") + F.col("_idx") + 1).select(*[f"`{c}`" for c in df.columns], name)


def _lag(cols: Sequence[str]) -> Scan:
    """Appends the values of ``cols`` in the row before, null in the first row of a partition."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = list(batch.columns)
            for c in cols:
                column = batch.column(batch.schema.get_field_index(c))
                before = pa.nulls(1, column.type) if last is None else last[c]
                out.append(pa.concat_arrays([before, column.slice(0, batch.num_rows - 1)]))
            last = {c: batch.column(batch.schema.get_field_index(c)).slice(batch.num_rows - 1) for c in cols}
            yield pa.record_batch(out, names=[*batch.schema.names, *[f"prev_{c}" for c in cols]])

    return scan


def with_previous(
    df: DataFrame, order: Sequence[Column], cols: Sequence[str], unique: bool = False, partitions: int | None = None
) -> DataFrame:
    """Adds ``prev_<col>`` from the preceding row of the whole ordered table.

    Inside a range partition the sorted rows are shifted by one on the way to the file; the first row of a
    partition takes the last row of the nearest non-empty partition before it, from a table with one row per
    partition.
    """
    added = ", ".join(f"`prev_{c}` {df.schema[c].dataType.simpleString()}" for c in cols)
    numbered = _range_numbered(df, order, unique, partitions, _lag(cols), added)
    last = numbered.groupBy("_pid").agg(F.max_by(F.struct(*[f"`{c}`" for c in cols]), "_idx").alias("_last"))
    edges = last.select("_pid", F.lag("_last").over(Window.orderBy("_pid")).alias("_edge"))
    joined = numbered.join(F.broadcast(edges), "_pid")
    return joined.select(
        *[f"`{c}`" for c in df.columns],
        *[F.when(F.col("_idx") == 0, F.col("_edge").getField(c)).otherwise(F.col(f"`prev_{c}`")).alias(f"prev_{c}") for c in cols],
    )


def batches(df: DataFrame, size: int, order: Sequence[Column], name: str = "batch", unique: bool = False) -> DataFrame:
    """Consecutive batches of ``size`` rows, numbered from 0."""
    placed = with_position(df, order, "_pos", unique)
    return placed.withColumn(name, F.floor((F.col("_pos") - 1) / F.lit(size))).drop("_pos")


def batches_n(df: DataFrame, n: int, order: Sequence[Column], name: str = "batch") -> DataFrame:
    """At most ``n`` batches of ``ceil(rows / n)`` rows."""
    placed = with_position(df, order, "_pos")
    total = placed.agg(F.max("_pos")).scalar()
    return placed.withColumn(name, F.floor((F.col("_pos") - 1) / F.ceil(total / F.lit(n)))).drop("_pos")


def range_split(df: DataFrame, size: int, max_parts: int, order: Sequence[Column], name: str = "part") -> DataFrame:
    """Contiguous index ranges of ``size`` rows for parts ``0 .. max_parts - 1``; rows past the
    last range get null, as no part would pick them up."""
    numbered = batches(df, size, order, "_part")
    return numbered.withColumn(name, F.when(F.col("_part") < max_parts, F.col("_part"))).drop("_part")


def _runs(key: str) -> Scan:
    """Appends ``_at``, the place of a row among the consecutive rows of its key in its partition, and ``_open``,
    whether these rows begin with the partition."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before, is_open = None, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column(batch.schema.get_field_index(key))
            joined = pa.concat_arrays([column.slice(0, 1) if last is None else last, column])
            code = joined.dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = np.diff(code) != 0
            starts = np.maximum.accumulate(np.where(new, np.arange(n), -before))
            at = np.arange(n) - starts
            opened = is_open & (np.cumsum(new) == 0)
            yield pa.record_batch([*batch.columns, pa.array(at), pa.array(opened)], names=[*batch.schema.names, "_at", "_open"])
            last, before, is_open = column.slice(n - 1), int(at[-1]) + 1, bool(opened[-1])

    return scan


def chunked_lists(
    df: DataFrame, key: str, value: str, size: int, order: Sequence[Column], name: str = "items"
) -> DataFrame:
    """Ordered lists per key, cut into chunks of at most ``size`` items. A key of any size is
    spread over many rows and tasks instead of one unbounded array, and no row is joined by its key: a run that
    goes on from earlier partitions takes their number of rows from a table with one row per partition."""
    pairs = df.select(key, value)
    numbered = _range_numbered(pairs, [F.col(key), *order], False, None, _runs(key), "_at bigint, _open boolean")
    ends = numbered.groupBy("_pid").agg(
        F.min_by(F.struct(key), "_idx").alias("_first"), F.max_by(F.struct(key, "_at", "_open"), "_idx").alias("_last")
    )
    # Rows of the last key so far: a run over whole partitions adds up.
    by_key = Window.partitionBy(f"_last.{key}").orderBy("_pid")
    so_far = ends.withColumn("_cum", F.sum(F.col("_last._at") + 1).over(by_key))
    line = Window.orderBy("_pid")
    goes_on = F.lag(f"_last.{key}").over(line).eqNullSafe(F.col(f"_first.{key}")) & F.lag("_cum").over(line).isNotNull()
    edges = so_far.select("_pid", F.when(goes_on, F.lag("_cum").over(line)).otherwise(F.lit(0)).alias("_carry"))
    place = F.col("_at") + F.when(F.col("_open"), F.col("_carry")).otherwise(F.lit(0))
    within = numbered.join(F.broadcast(edges), "_pid").withColumn("_i", place)
    return (
        within.withColumn("chunk", F.floor(F.col("_i") / F.lit(size)))
        .groupBy(key, "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("_i", value))).alias("_l"))
        .select(key, "chunk", F.transform("_l", lambda x: x[value]).alias(name))
    )
