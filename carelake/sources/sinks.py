"""Ways to write results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def to_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, replacing what is there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def to_pipe_delimited(cols: Sequence[str]) -> Column:
    """One text of the columns joined by ``|``, nulls as empty."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def save_table(
    df: DataFrame, name: str, partition: Sequence[str] = (), bucket: str | None = None, buckets: int = 64,
    sort: str | None = None, fmt: str = "parquet",
) -> None:
    """Table with partition folders and, optionally, hash buckets sorted by a column, so that later
    joins on the bucket column need no shuffle. The first call creates the table; later ones replace
    the partitions present in ``df`` (all rows, if there are no partition columns) and keep the layout."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        writer = df.write.format(fmt)
        if partition:
            writer = writer.partitionBy(*partition)
        if bucket:
            writer = writer.bucketBy(buckets, bucket).sortBy(sort or bucket)
        writer.saveAsTable(name)
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # an insert takes it from the session only
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def save_partitions(df: DataFrame, path: str, partition: Sequence[str], fmt: str = "parquet") -> None:
    """Files under partition folders; a re-run replaces exactly the partitions it writes. Rows are
    gathered per folder and rebalanced, so a folder holding most of the rows gets many files of the
    advised size and a small one gets one."""
    (
        df.hint("rebalance", *[F.col(c) for c in partition])
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .save(path)
    )


def publish_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def copy_table(spark: SparkSession, source: str, target: str, fmt: str = "parquet", partition: Sequence[str] = ()) -> None:
    """Copy of a stored table with its schema, laid out by ``partition`` again."""
    spark.read.format(fmt).load(source).write.format(fmt).mode("overwrite").partitionBy(*partition).save(target)


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_rows: int = 1000,
                partitions: int | None = None) -> None:
    """Relational export in batches. ``partitions`` bounds the number of open connections, but not
    the tasks of the steps before."""
    out = df.repartition(partitions) if partitions else df
    out.write.option("batchsize", batch_rows).mode("append").jdbc(url, table, properties=properties)
