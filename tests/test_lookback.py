import pytest

from carelake.operators import keys, lookback
from pyspark.sql import functions as F

VALUES = {"latest_known_admitted": "admitted", "latest_known_source": "source", "latest_known_id": "id"}
ROWS = [
    ("a", "2020-05-03 10:00:00", "s1", 1, "2020-05"),
    ("a", "2020-06-09 10:00:00", "s2", 2, "2020-06"),
    ("a", "2020-06-09 10:00:00", "s3", 3, "2020-06"),
    ("b", "1900-00-00 00:00:00", "s1", 4, "2020-06"),
    ("b", "2020-05-01 00:00:00", "s1", 5, "2020-05"),
    ("c", "2016-01-01 00:00:00", "old", 6, "2020-06"),
    ("d", "2020-06-01 00:00:00", "s1", 7, "2016-01"),
    ("HcDAT_HELP_REQUESTED", "2020-06-01 00:00:00", "s1", 8, "2020-06"),
    ("e", None, "s1", 9, "2020-06"),
]
SCHEMA = "accid string, admitted string, source string, id int, index_update string"


def test_full_uses_both_months_and_one_row(spark, rows_of):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = lookback.lookback_full(df, "2020-07-01", VALUES, tie="id")
    got = rows_of(out, "accid", "latest_known_source", "latest_known_id", "latest_index_update")
    assert got == [("HcDAT_HELP_REQUESTED", "s1", 8, "2020-06-01"), ("a", "s3", 3, "2020-06-01"), ("b", "s1", 5, "2020-05-01")]
    assert {r.ds for r in out.collect()} == {"2020-07-01"}


def test_full_feeds_a_step(spark, rows_of):
    """The row of the oldest month of the window survives the step."""
    df = spark.createDataFrame([("a", "2017-07-20 00:00:00", "s", 1, "2017-07"), ("b", "2017-06-20 00:00:00", "s", 2, "2017-06")], SCHEMA)
    full = lookback.lookback_full(df, "2020-06-01", VALUES, tie="id")
    step = lookback.lookback_step(full, df, "2020-07-01", VALUES, tie="id")
    assert full.count() == 2 and rows_of(step, "accid", "latest_index_update") == [("a", "2017-07-01")]


def test_window_start_in_mid_month(spark):
    assert lookback._window_start("2020-03-31", 1) == "2020-02-29"
    assert lookback._first_open_month("2017-07-15") == "2017-08"
    assert lookback._first_open_month("2017-12-02") == "2018-01"
    assert lookback._first_open_month("2017-07-01") == "2017-07"


def _fold(spark, df, months):
    empty = lookback.lookback_full(df, "2020-05-01", VALUES, tie="id").limit(0).withColumn(
        "latest_index_update", F.lit("x"))
    step = lambda prev, ds: lookback.lookback_step(prev, df, ds, VALUES, tie="id")
    return lookback.backfill(step, empty, months, lambda out, ds: out)


def test_step_fold_drops_sentinels_and_keeps_old_snapshot(spark, rows_of):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = _fold(spark, df, ["2020-05-01", "2020-06-01"])
    assert rows_of(out, "accid", "latest_known_id", "latest_index_update") == [
        ("a", 3, "2020-06-01"), ("b", 5, "2020-05-01")]


def test_step_expires_old_months(spark, rows_of):
    df = spark.createDataFrame([("a", "2020-05-03 10:00:00", "s", 1, "2020-05")], SCHEMA)
    first = _fold(spark, df, ["2020-05-01"])
    kept = lookback.lookback_step(first, df, "2023-05-01", VALUES, tie="id")
    gone = lookback.lookback_step(first, df, "2023-06-01", VALUES, tie="id")
    assert kept.count() == 1 and gone.count() == 0


def test_rows_need_both_months(spark, rows_of):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = lookback.lookback_rows(df, "2020-07-01", months=36)
    assert rows_of(out, "id", "partition_month") == [(1, "2020-05"), (2, "2020-06"), (3, "2020-06"), (5, "2020-05"), (8, "2020-06")]


def test_latest_known_ignores_null_order(spark, rows_of):
    df = spark.createDataFrame([("k", "x", None), ("k", "y", 1), ("z", "w", None)], "k string, v string, t int")
    out = keys.latest_known(df, ["k"], {"v": "v"}, ["t"])
    assert rows_of(out) == [("k", "y"), ("z", None)] or rows_of(out) == [("z", None), ("k", "y")]


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = keys.latest_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_all_snapshots_in_one_pass_equal_the_fold(spark, rows_of):
    """Late and missing events, sentinels, null keys, rows that expire by month or event, months without a load."""
    rows = []
    for i in range(600):
        load = f"20{10 + i * 7 % 9:02d}-{i * 5 % 12 + 1:02d}"
        event = [f"20{9 + i * 11 % 11:02d}-{i % 12 + 1:02d}-{i % 28 + 1:02d} 0{i % 10}:00:00", None, "1900-00-00 00:00:00"][0 if i % 9 else 1 + i % 2]
        rows.append(([f"k{i % 23}", None, "HcDAT_HELP_REQUESTED"][0 if i % 31 else 1 + i % 2], event, f"s{i}", i, load))
    rows.append((None, "2012-04-01 00:00:00", "no key", 900, "2012-04"))
    df = spark.createDataFrame(rows, SCHEMA)
    days = [f"{y}-{m:02d}-{1 + (y + m) % 28:02d}" for y in (2011, 2012, 2014) for m in (1, 4, 5, 11)]
    old = spark.createDataFrame(
        [("k1", "2010-12-01 00:00:00", "old", -1, "2010-12-01"), ("gone", "2008-01-01 00:00:00", "old", -2, "2008-02-01"),
         ("only", "2010-06-01 00:00:00", "old", -3, "2010-06-01"), ("k2", None, "old", -4, "2010-12-01")],
        "accid string, latest_known_admitted string, latest_known_source string, latest_known_id int, latest_index_update string",
    )
    steps, snapshot = [], old
    for ds in days:
        snapshot = lookback.lookback_step(snapshot, df, ds, VALUES, tie="id")
        snapshot = spark.createDataFrame(snapshot.collect(), snapshot.schema)
        steps.extend(tuple(r) for r in snapshot.select("accid", "latest_known_id", "latest_index_update", "ds").collect())
    cols = ("accid", "latest_known_id", "latest_index_update", "ds")
    got = lookback.backfill_snapshots(df, days, VALUES, tie="id", previous=old)
    assert rows_of(got, *cols) == sorted(steps, key=lambda t: tuple((x is not None, str(x)) for x in t))
    assert {"only", "k1", None} <= {r.accid for r in got.collect()} and "gone" not in {r.accid for r in got.collect()}
    late = old.withColumn("latest_index_update", F.lit("2011-02-01"))
    with pytest.raises(Exception, match="previous snapshot"):
        lookback.backfill_snapshots(df, days, VALUES, tie="id", previous=late).collect()
    with pytest.raises(ValueError):
        lookback.backfill_snapshots(df, ["2011-01-01", "2011-01-05"], VALUES)
    empty = lookback.backfill_snapshots(df.limit(0), days, VALUES, tie="id")
    assert empty.columns == got.columns and empty.count() == 0
