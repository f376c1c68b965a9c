"""Sharding by a two-pass external shuffle, with built-in functions only.

Pass one scatters the records uniformly into memory-sized buckets by a seeded hash of their key.
Pass two runs a Fisher-Yates shuffle in each bucket and appends the buckets to the shards: record
``i`` of a bucket gets place ``offset + permutation[i]`` of the whole order, and shard ``s`` holds
the ``s``-th equal run of places. So shard sizes differ by one row at most, slots have no gaps,
and every bucket goes to the one or two shards it overlaps.

Nulls: a null text counts no bytes; null keys hash like any value. Repeated rows keep their number.
An empty table gives an empty result. Input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut, shared_folder


def shuffled(
    df: DataFrame, shards: int, seed: int = 20, key: Sequence[str] = ("doc_id",), text: str = "text",
    bucket_bytes: int = 32 << 20, least_buckets: int = 256,
) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, from 0 in each shard), in random order.

    ``key`` should name a record; records that share it land in one bucket. The number of buckets
    follows the bytes of ``text`` and nothing of the cluster, so equal input gives equal shards.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 1
    rows, total = df.agg(F.count(F.lit(1)), F.sum(size.cast("bigint"))).first()
    buckets = max(least_buckets, -(-(total or 0) // bucket_bytes))
    scattered = df.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(buckets)).cast("int"))

    # One row per bucket: its start in the whole order and its permutation. F.shuffle is the
    # Fisher-Yates shuffle; it draws row by row, so the rows are sorted and the outcome is kept.
    counts = scattered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    permuted = cut(
        placed.repartition(-(-buckets // 16), "_bucket")
        .sortWithinPartitions("_bucket")
        .withColumn("_perm", F.shuffle(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int")), F.lit(seed)))
        .select("_bucket", "_offset", "_perm")
    )

    within = Window.partitionBy("_bucket").orderBy(*key, F.col(text).asc_nulls_first())
    numbered = scattered.withColumn("_i", F.row_number().over(within))
    place = F.col("_offset") + F.element_at("_perm", F.col("_i"))
    n = max(rows, 1)
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    return (
        numbered.join(permuted, "_bucket")
        .select(*kept, place.alias("_place"))
        .withColumn("shard", F.expr(f"_place * {shards} div {n}").cast("int"))
        .withColumn("slot", F.expr(f"_place - (shard * {n}L + {shards - 1}) div {shards}"))
        .drop("_place")
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; the rows of a file are in slot order. Spark commits a task's files as a
    whole, so a lost executor leaves no half-written shard."""
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def sharded(df: DataFrame, shards: int, path: str | None = None, **options) -> DataFrame:
    """The shards written to ``path`` (a folder of the shared ones if none is given) and read back."""
    spark = df.sparkSession
    placed = shuffled(df, shards, **options)
    path = path or shared_folder(spark, "shards")
    write_shards(placed, path)
    return spark.read.schema(placed.schema).parquet(path)
