from pyspark.sql import functions as F

from carelake.functions import dates, predicates, text


def _one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_text(spark):
    assert _one(spark, text.trim_zeros(F.lit(12.5))) == "12.5"
    assert _one(spark, text.trim_zeros(F.lit(10.0))) == "10"
    assert _one(spark, text.whole_number_text(F.lit(1234567890.0))) == "1234567890"
    assert _one(spark, text.part_or_null(F.lit("a"), "/")) is None
    assert _one(spark, text.part_after(F.lit("a/b/c"), "/")) == "b"
    assert _one(spark, text.part_after(F.lit("abc"), "/")) == "abc"
    assert _one(spark, text.bracketed(F.lit("n[x][y]z"), 2)) == "y"
    assert _one(spark, text.decoded(F.lit("a%3Db"))) == "a=b"
    assert _one(spark, text.decoded(F.lit("100%"))) == "100%"
    assert _one(spark, text.table_name(F.lit("Air Flow (Client-B) #2"))) == "airflowclient_b2"
    assert _one(spark, text.nine_digit_ssn(F.lit("123-45-678901"))) == "123456789"


def test_dates(spark):
    assert _one(spark, dates.us_date_to_iso(F.lit("2/30/2020"))) is None
    assert _one(spark, dates.us_date_to_iso(F.lit("1/2/2020"))) == "2020-01-02"
    assert _one(spark, dates.hl7_date(F.lit("2020"))) is None
    assert str(_one(spark, dates.hl7_timestamp(F.lit("202001020304+0500")))) == "2020-01-02 03:04:00"
    assert _one(spark, dates.hl7_timestamp(F.lit("20201301"))) is None
    assert _one(spark, dates.hl7_timestamp(F.lit(""))) is None
    assert dates.month_text("2020-01-31", -1) == "2019-12"


def test_delimited_lists():
    assert predicates.split_delimited("a|b,c") == ["a", "b", "c"]
    assert predicates.split_delimited("") == []
