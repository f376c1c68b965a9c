from pyspark.sql import functions as F

from carelake.operators import position


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_positions_with_a_large_group_of_copies(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("v"))
    got = sorted((r.position, r.v) for r in position.with_position(df, [F.col("v")]).collect())
    assert [p for p, _ in got] == list(range(1, 3001))
    assert [v for _, v in got] == sorted(r.v for r in df.collect())


def test_copies_are_cut_over_partitions(spark):
    df = spark.range(4000).select(F.lit("same").alias("v"), F.when(F.col("id") % 2 == 0, 1).alias("w"))
    numbered = position._range_numbered(df, [F.col("v")], False, 8)
    sizes = [r["count"] for r in numbered.groupBy("_pid").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500 and sum(sizes) == 4000
    # What is left to run after the one range shuffle reads a file, without a shuffle of the rows or a window over a partition.
    plan = _plan(position.with_position(df, [F.col("v")], "p", partitions=8))
    assert "rangepartitioning" not in plan and "Window [sum(_n" in plan and plan.count("Window") <= 2 and "hashpartitioning(_pid" in plan
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning") == 1


def test_positions_of_odd_values(spark):
    """Nulls in either column, an empty table, one row, names with a dot."""
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("a", "a"), (None, "a")], "`x.y` string, z string")
    out = position.with_position(df, [F.col("`x.y`"), F.col("z")], "p", partitions=4).collect()
    assert [tuple(r)[:2] for r in sorted(out, key=lambda r: r.p)] == [(None, None), (None, "a"), (None, "a"), ("a", None), ("a", "a")]
    assert sorted(r.p for r in out) == [1, 2, 3, 4, 5]
    assert position.with_position(df.limit(0), [F.col("z")]).count() == 0
    assert [r.prev_z for r in position.with_previous(df.select("z").limit(1), [F.col("z")], ["z"]).collect()] == [None]


def test_previous_over_many_partitions(spark):
    values = [i % 97 * 3 for i in range(2000)]
    df = spark.createDataFrame([(v, None if v % 5 == 0 else f"t{v}") for v in values], "v int, t string").repartition(5)
    out = position.with_previous(df, [F.col("v")], ["v", "t"], partitions=9).collect()
    ordered = sorted(values)
    assert sorted((r.v, r.prev_v or -1) for r in out) == sorted((v, p) for v, p in zip(ordered, [-1, *[p or -1 for p in ordered]]))
    assert all(r.prev_t == (None if r.prev_v is None or r.prev_v % 5 == 0 else f"t{r.prev_v}") for r in out)


def test_previous_row(spark):
    df = spark.createDataFrame([(3,), (1,), (2,), (2,), (9,)], "v int")
    out = sorted((r.v, r.prev_v) for r in position.with_previous(df, [F.col("v")], ["v"], partitions=3).filter("prev_v is not null").collect())
    assert out == [(2, 1), (2, 2), (3, 2), (9, 3)]


def _lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.batch, []).append(r.v)
    return [sorted(out[k]) for k in sorted(out)]


def test_batches(spark):
    df = spark.range(1, 10).select(F.col("id").alias("v"))
    order = [F.col("v")]
    assert _lists(position.batches(df, 3, order)) == [[1, 2, 3], [4, 5, 6], [7, 8, 9]]
    assert _lists(position.batches(df, 4, order)) == [[1, 2, 3, 4], [5, 6, 7, 8], [9]]
    assert _lists(position.batches(df.limit(0), 4, order)) == []
    assert _lists(position.batches_n(df, 2, order)) == [[1, 2, 3, 4, 5], [6, 7, 8, 9]]


def test_chunked_lists(spark):
    df = spark.range(25).select(F.when(F.col("id") < 22, "hot").otherwise("cold").alias("k"), F.col("id").alias("v"))
    out = {(r.k, r.chunk): r["items"] for r in position.chunked_lists(df, "k", "v", 10, [F.col("v")]).collect()}
    assert out == {("hot", 0): list(range(10)), ("hot", 1): list(range(10, 20)), ("hot", 2): [20, 21], ("cold", 0): [22, 23, 24]}


def test_a_key_over_many_partitions_is_cut_without_a_join(spark):
    rows = [(None if i % 7 == 0 else "hot" if i % 7 < 5 else f"k{i % 11}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(6)
    out = {(r.k, r.chunk): r["items"] for r in position.chunked_lists(df, "k", "v", 40, [F.col("v")]).collect()}
    want = {}
    for k, v in sorted(rows, key=lambda r: r[1]):
        want.setdefault(k, []).append(v)
    assert out == {(k, i // 40): v[i : i + 40] for k, v in want.items() for i in range(0, len(v), 40)}
