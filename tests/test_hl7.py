import pytest

from carelake.functions import dates
from carelake.operators import hl7v2
from carelake.plans import readers

HEAD = "MSH|^~\\&|LAB|SITE^x|RCV|FAC|20240102030405||ORU^R01|77|P|2.3"
PID = "PID|1||555^^^AUTH||DOE^JANE^Q~ALIAS^X||19800229|Female||W|1 St^Apt 2^TOWN^KS^66002^US||H1|B1|en|S^Single|R|{account}|444|||H"
FILE = "x[KS][FAC1]ptr[VAL]_20240102.hl7"


def _messages(spark, text, file=FILE):
    return hl7v2.hl7_messages(spark.createDataFrame([(file, text)], "file string, value string"))


def _text(*lines):
    return "\r".join(lines) + "\r"


def test_segments_and_fields(spark):
    df = spark.createDataFrame([(FILE, _text(HEAD, PID.format(account="A1")))], "file string, value string")
    assert [(r.seg_no, r.seg) for r in hl7v2.hl7_segments(df).collect()] == [(1, "MSH"), (2, "PID")]
    rows = {(r.seg, r.field_no, r.repetition, r.component): r.value for r in hl7v2.hl7_fields(df).collect()}
    assert rows[("MSH", 2, 1, 1)] == "^~\\&"
    assert rows[("MSH", 9, 1, 2)] == "R01"
    assert rows[("PID", 5, 2, 1)] == "ALIAS"


def test_other_delimiters_keep_standard_ones_as_data(spark):
    text = _text("MSH#@!\\&#LAB#SITE#RCV#FAC#20240102##ADT@A01#1#P#2.3", "PID#1##555##DO|E@JA^NE##19800229#F")
    row = hl7v2.hl7_person(_messages(spark, text)).first()
    assert (row.lastname, row.firstname, row.dob) == ("DO|E", "JA^NE", "1980-02-29")


@pytest.mark.parametrize("account,admitted,expected", [
    ("A1", "", "A1555FAC1"),
    ("", "19700101000100", "60555FAC1"),
    ("", "", None),
])
def test_visit_key(spark, account, admitted, expected):
    import hashlib

    pv1 = "PV1" + "|" * 44 + admitted
    row = _messages(spark, _text(HEAD, PID.format(account=account), pv1)).first()
    assert row.accid_ref == (expected or hashlib.sha1(FILE.encode()).hexdigest() + "FAC1")
    assert row.has_visit == (expected is not None)


def test_order_time_is_carried_and_short_orders_do_not_replace_it(spark):
    text = _text(HEAD, PID.format(account="A1"), "OBX|0|NM|X||1", "OBR|1|p||CBC^Blood|||20240101", "OBX|1|NM|A||1", "OBR|2|p||C",
                 "OBX|2|NM|B||2", "OBR|3|p||DDD|||", "OBX|3|NM|C||3")
    rows = hl7v2.hl7_lab_results(_messages(spark, text)).collect()
    assert [(r.accession_id, r.index_update_dt_tm) for r in rows] == [("0", None), ("1", "20240101"), ("2", "20240101"), ("3", "")]
    assert rows[1].lab_id == "RCV20240101P"
    tests = hl7v2.hl7_lab_tests(_messages(spark, text)).collect()
    assert [(r.name, r.description) for r in tests] == [("CBC", "Blood"), ("DDD", None)]


def test_route_only_for_the_first_medication_after_it(spark):
    rxo = "RXO|" + "|" * 8 + "|PO"
    text = _text(HEAD, PID.format(account="A1"), "RXE||M0", rxo, "RXE||M1", "RXE||M2")
    assert [(r.code, r.route) for r in hl7v2.hl7_medications(_messages(spark, text)).collect()] == [("M0", None), ("M1", "PO"), ("M2", None)]


def test_allergy_falls_back_to_iam(spark):
    text = _text(HEAD, PID.format(account="A1"), "IAM|1|DA^Drug|x^Pen", "AL1|1||y^", "AL1|2|FA^Food|z^Nut", "AL1||DA")
    rows = hl7v2.hl7_allergies(_messages(spark, text)).collect()
    assert [(r.code, r.code_type, r.description) for r in rows] == [("1", "DA", "Pen"), ("2", "FA", "Nut")]


def test_bad_message_goes_to_the_log(spark):
    messages = _messages(spark, "BAD|1\r", "plain.hl7")
    log = hl7v2.hl7_message_log(messages).first()
    assert log.status == hl7v2.NO_HEADER and log.f_facility is None
    assert hl7v2.hl7_person(messages).count() == 0


def test_birth_date_and_quotes(spark):
    text = _text(HEAD, 'PID|1||5||O"NEIL^AL||19801399|M')
    row = hl7v2.hl7_person(_messages(spark, text)).first()
    assert row.dob is None and row.lastname == "O-NEIL" and row.race is None


def test_providers_reuse_registered_keys(spark):
    text = _text(HEAD, PID.format(account="A1"), "PV1||I|U^1^B||||ATT^Smith^Al", "PD1||||PCP^Pat")
    messages = _messages(spark, text)
    known = spark.createDataFrame([("FAC1", "ATT", "Smith", "Al", "", "", "key-1")],
                                  "source string, provcode string, lname string, fname string, mname string, suffix string, vault_based_id string")
    rows = {r.status: r for r in hl7v2.hl7_providers(messages, known).collect()}
    assert set(rows) == {"attending", "pcp"}
    assert rows["attending"].vault_based_id == "key-1" and not rows["attending"].is_new
    assert rows["pcp"].is_new and rows["pcp"].vault_based_id.endswith("-PCP")
    visits = hl7v2.hl7_account(messages)
    assert visits.first().att_provider_id == rows["attending"].new_key
    linked = hl7v2.with_registered_provider(visits, hl7v2.hl7_providers(messages, known), "att_provider_id")
    assert linked.first().att_provider_id == "key-1"


def test_oids(spark, rows_of):
    good = ["1.2", "0.39.1", "2.999.0", "2.16.840.1.113883"]
    bad = ["", "1", "3.1", "1.40", "1.02", ".1.2", "1.2.", "1..2", "1.a", "2." + "1" * 130, None]
    df = spark.createDataFrame([(o,) for o in good + bad], "o string")
    assert {r.o for r in df.filter(hl7v2.valid_oid(df.o)).collect()} == set(good)
    texts = [("a", HEAD.replace("SITE^x", "2.16.1")), ("b", HEAD.replace("SITE^x", " SITE ^x")), ("c", HEAD.replace("SITE^x", "MN")),
             ("d", HEAD.replace("SITE^x", "?"))]
    messages = hl7v2.hl7_messages(spark.createDataFrame([(f, _text(t)) for f, t in texts], "file string, value string"))
    cross = spark.createDataFrame([("SITE", "MN0", "1.1"), ("Other", " MN ", "1.2")], "name string, mnemonic string, oid string")
    out = rows_of(hl7v2.resolve_msh4_oid(messages, cross), "file", "oid", "error")
    assert out[:3] == [("a", "2.16.1", None), ("b", "1.1", None), ("c", "1.2", None)]
    assert out[3][1] is None and "?" in out[3][2]


def test_two_messages_in_a_file_are_logged(spark, rows_of):
    one = "MSH|^~\\&|a|b|c|d|20200101||ADT^A01|1|P|2.3\rPID|1||1||Lee^Ann\r"
    df = spark.createDataFrame([("x", one), ("y", one + one), ("z", "PID|1")], "file string, value string")
    log = hl7v2.hl7_message_log(hl7v2.hl7_messages(df))
    assert [s.split(":")[0] + str(len(s)) for _, s in rows_of(log, "file", "status")] == [
        f"{s.split(':')[0]}{len(s)}" for s in (hl7v2.PARSED, hl7v2.SEVERAL, hl7v2.NO_HEADER)]


def test_single_segments_are_stored_whole_and_the_last_counts(spark, tmp_path):
    text = "MSH|^~\\&|A||\rPID|1||first\rPIDX|no\rPID|1||last||\rPV1"
    df = spark.createDataFrame([("m", text), ("none", "PV1")], "file string, value string")
    parsed = hl7v2.parse_hl7(df, str(tmp_path / "parsed"))
    kinds = dict(spark.read.parquet(str(tmp_path / "parsed")).dtypes)
    assert {kinds[f"_{n.lower()}"] for n in hl7v2.SINGLE_KINDS} == {"string"}
    for messages in (parsed, hl7v2.hl7_messages(df)):
        rows = {r.file: (r._msh, r._pid, r._pv1) for r in messages.select("file", "_msh", "_pid", "_pv1").collect()}
        assert rows == {"m": (["MSH", "^~\\&", "A", "", ""], ["PID", "1", "", "last", "", ""], None), "none": (None, None, None)}


def test_a_union_of_tables_reads_its_values_in_the_wide_projections(spark, tmp_path):
    """A projection of more than 100 columns is compiled in small methods; lists of fields made below it would be
    written and read again for each row."""
    df = spark.createDataFrame([(FILE, _text(HEAD, PID.format(account="A1"), "IN1|1|PL^Plan", "PR1|1|CPT|P1"))], "file string, value string")
    parsed = hl7v2.parse_hl7(df, str(tmp_path / "parsed"))
    union = readers._union(hl7v2.hl7_tables(parsed))
    spark.conf.set("spark.sql.debug.maxToStringFields", 2000)
    lines = union._jdf.queryExecution().optimizedPlan().toString().split("\n")
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    reading = [line for line in lines if "split(_s#" in line or "split(_pid" in line]
    assert len([line for line in reading if " AS of_table" in line]) >= 12
    assert not [line for line in reading if "Project [" in line and " AS of_table" not in line and " AS _f#" not in line and "_kept" not in line]
    rows = {r.of_table: r for r in union.collect()}
    assert (rows["insurance"].planid, rows["insurance"].plan_name, rows["insurance"].ssn) == ("PL", "Plan", None)
    assert (rows["person"].lastname, rows["person"].planid) == ("DOE", None)


@pytest.mark.parametrize("text,day,time", [
    ("19800229", "1980-02-29", "1980-02-29 00:00:00"), ("198002291", "1980-02-29", "1980-02-29 10:00:00"), ("19810229", None, None),
    ("20240131240000", "2024-01-31", None), ("20240131235960", "2024-01-31", None), ("2024013", None, None), (" 20240131", None, None),
    ("2024-1-1", None, None), ("20240131T10", "2024-01-31", "2024-01-31 00:00:00"), ("00000101", "0000-01-01", None), (None, None, None),
])
def test_dates_are_eight_digits_that_make_a_day(spark, text, day, time):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(dates.hl7_date(df.t).alias("d"), dates.hl7_timestamp(df.t).cast("string").alias("s")).first()
    assert row.d == day and (time is None and (row.s is None or day == "0000-01-01") or row.s == time)
