import pytest
from pyspark.sql import functions as F

from carelake.operators import identity, joins, optout, population, quality, residence

MASTER = "id bigint, lastname string, firstname string, dob string, sex string, ssn string"
NEW = "message_id bigint, lastname string, firstname string, dob string, sex string, ssn string"


def _master(spark):
    return spark.createDataFrame(
        [(7, "Doe", "Jo", "1980-01-01", "F", "1"), (9, "Doe", "Jo", "1980-01-01", "F", "2")], MASTER)


def test_resolve_matches_mints_and_rematches(spark, rows_of):
    new = spark.createDataFrame([
        (1, "Doe", "Jo", "1980-01-01", "F", "x"),
        (2, "Zed", "Al", "1990-01-01", "M", "first"),
        (3, "Zed", "Al", "1990-01-01", "M", "second"),
        (4, "Abe", "Bo", "1991-01-01", "M", None),
        (5, None, "Bo", "1991-01-01", "M", None),
        (6, "Abe", "", "1991-01-01", "M", None),
    ], NEW)
    resolved, master = identity.resolve_identities(new, _master(spark))
    assert rows_of(resolved, "message_id", "mpi") == [(1, 9), (2, 11), (3, 11), (4, 10), (5, 0), (6, 0)]
    added = rows_of(master.filter("id > 9"), "id", "lastname", "ssn")
    assert added == [(10, "Abe", None), (11, "Zed", "first")]
    again, same = identity.resolve_identities(new, master)
    assert rows_of(again, "message_id", "mpi") == rows_of(resolved, "message_id", "mpi")
    assert same.count() == master.count()
    assert quality.check_no_nulls(resolved, "mpi").first().passed


def test_match_can_ignore_case(spark):
    new = spark.createDataFrame([(1, "DOE", "jo", "1980-01-01", "f", "x")], NEW)
    assert identity.match_identities(new, _master(spark)).first().mpi is None
    assert identity.match_identities(new, _master(spark), case_insensitive=True).first().mpi == 9


def test_normalize_identity(spark, rows_of):
    df = spark.createDataFrame([("19800101", "Female"), ("1980", "M"), ("19801399", None)], "dob string, sex string")
    assert set(rows_of(identity.normalize_identity(df))) == {("1980-01-01", "F"), (None, "M"), (None, None)}


POP = "MPI bigint, first_name string, last_name string, dob string, sex string"


def test_collapse_modes(spark, rows_of):
    df = spark.createDataFrame([
        (1, "a", "b", "d", "F"), (2, "x", "y", "d", "F"), (3, "a", "b", "d", "F"), (4, "a", "b", "d", "F"), (5, None, "b", "d", "F"),
        (6, None, "b", "d", "F")], POP)
    assert [r[0] for r in rows_of(identity.collapse_duplicates(df), "MPI")] == [2, 4, 4, 4, 5, 6]
    assert [r[0] for r in rows_of(identity.collapse_duplicates(df, mode="adjacent"), "MPI")] == [1, 2, 3, 4, 5, 6]
    people = identity.representatives(df, "MPI", ["first_name", "last_name", "dob", "sex"])
    assert [r[0] for r in rows_of(people, "MPI")] == [2, 4, 5, 6]
    with pytest.raises(ValueError):
        identity.collapse_duplicates(df, mode="other")


def test_collapse_with_a_hot_identity(spark):
    df = spark.range(20000).select(
        F.col("id").alias("MPI"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("first_name"),
        F.lit("l").alias("last_name"), F.lit("d").alias("dob"), F.lit("F").alias("sex"))
    out = identity.collapse_duplicates(df)
    assert out.filter("first_name = 'same'").agg(F.count_distinct("MPI")).first()[0] == 1
    assert out.count() == 20000 and out.filter("MPI = 19998").count() == 6667


def test_hot_account_is_split(spark):
    """One account owns half of the registrations: several tasks share its join."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        registrations = spark.range(200000).repartition(16).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("ref"), F.sha1(F.col("id").cast("string")).alias("mpi"))
        accounts = spark.createDataFrame([("hot", 1)], "accid string, n int").unionByName(
            spark.range(20000).select(F.col("id").cast("string").alias("accid"), F.lit(2).alias("n")))
        out = joins.attach_mpi(accounts, registrations, "accid", "ref", "mpi")
        whole = out.select("*", F.spark_partition_id().alias("p")).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len({r.p for r in whole if r.accid == "hot"}) > 3 and len(whole) == 110000


def test_identities_whatever_the_case(spark, rows_of):
    master = spark.createDataFrame([(5, "SMITH", "ANN", "d", "F")], "id long, lastname string, firstname string, dob string, sex string")
    new = spark.createDataFrame(
        [(1, "Smith", "Ann", "d", "F", "s"), (2, "Roe", "Jo", "d", "M", "s"), (3, "ROE", "jo", "d", "m", "t")],
        "message_id long, lastname string, firstname string, dob string, sex string, ssn string")
    found, grown = identity.resolve_identities(new, master, case_insensitive=True)
    assert rows_of(found, "message_id", "mpi", "lastname") == [(1, 5, "Smith"), (2, 6, "Roe"), (3, 6, "ROE")]
    assert rows_of(grown, "id", "lastname", "firstname", "ssn") == [(5, "SMITH", "ANN", None), (6, "Roe", "Jo", "s")]
    found, grown = identity.resolve_identities(new, master)
    assert found.select("mpi").distinct().count() == 3 and grown.count() == 4


def test_suppress_drops_nulls_and_sentinels(spark, rows_of):
    pop = spark.createDataFrame([("1",), ("2",), (None,), ("nan",)], "MPI string")
    out = joins.suppress(pop, spark.createDataFrame([("2",), (None,)], "MPI string"), "MPI", ("nan",))
    assert rows_of(out) == [("1",)]


def test_exclude_listed_null_rules(spark, rows_of):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows_of(joins.exclude_listed(df, "c", spark.createDataFrame([("b",), (None,)], "m string"), "m")) == [("a",)]


def test_upsert_kinds(spark, rows_of):
    target = spark.createDataFrame([(1, "abc", "0"), (2, "def", "0"), (4, "ghi", "0")], "id int, name string, paused string")
    change = spark.createDataFrame([(1, "newname", "1"), (2, "", "1"), (3, "added", "0"), (4, "xy", "1"), (5, "", "1")],
                                   "id int, name string, paused string")
    out = joins.upsert(target, change, "id", ["name", "paused"], ["name"], ["paused"])
    assert rows_of(out) == [(1, "newname", "1"), (2, "def", "1"), (3, "added", "0"), (4, "ghi", "0"), (5, None, "1")]


OPT = ("id int, fname string, lname string, dob string, sex string, ssn string, opt_choice string, status string, last_update_php string")


def test_sanitize(spark, rows_of):
    raw = spark.createDataFrame([
        (1, "Al", "Smith", "1/2/1980", "M", "12-34", "out", "s", "u"),
        (2, "Al", "Smith", "1980-01-02", "M", "123456789", "out", "s", "u"),
        (3, "Al", "Smith", "Unknown", "M", None, "out", "s", "u"),
        (4, "Al", "Smith", "13/45/1980", "M", "1", "out", "s", "u"),
        (5, "Al", "Smith", "1/2/1980", "M", "1", "in", "s", "u"),
        (6, "Al", None, "1/2/1980", "M", "1", "out", "s", "u"),
        (7, "Al", "Smith", None, "M", "1", "out", "s", "u"),
        (8, "Al", "Smith", "1/2/1980", "M", "1", None, "s", "u"),
    ], OPT)
    out = rows_of(optout.sanitize_opt_outs(raw), "id", "dob", "ssn")
    assert out == [(1, "1980-01-02", "000001234"), (2, "1980-01-02", "123456789"), (3, "Unknown", None), (4, None, "000000001")]


def test_match_methods_and_unmatched(spark, rows_of):
    people = spark.createDataFrame([
        (10, "Smith", "Al", "1980-01-02", "M", "999991234"), (11, "Smithers", "Al", "1980-01-02", "M", "555551234"),
        (12, "Jones", "Bo", "1970-01-01", "F", "1")], MASTER)
    opt = spark.createDataFrame([
        (1, "Al", "Smith", "1980-01-02", "M", "000001234", "out", "s", "u"),
        (2, "Al", "Smith", "1980-01-02", "M", "000001234", "out", "s", "u"),
        (3, "No", "Body", "1980-01-02", "M", "000000000", "out", "s", "u")], OPT)
    out = rows_of(optout.match_opt_outs(opt, people), "mpi", "lname", "match_methods")
    assert set(out) == {(10, "Smith", "special1,standard"), (11, "Smith", "special1"), (None, "Body", "special1,standard")}
    assert len(out) == 3
    assert rows_of(optout.match_opt_outs(opt, people, keep_unmatched=False), "mpi") == [(10,), (11,)]
    assert rows_of(optout.opted_out_ids(opt, people)) == [(10,), (11,)]


def test_text_variant_adds_previous(spark, rows_of):
    raw = spark.createDataFrame([(1, "Al", "nan", "1/2/1980", "M", "1", "out", "s", "u"),
                                 (2, "Al", "X", "1980-01-02T00:00:00", "M", "1", "out", "s", "u")], OPT)
    old = spark.createDataFrame([(3, "Bo", "Y", "1", "M", "1", "in", "s", "u"), (4, "Bo", "Y", "1", "M", "1", "out", "s", "u")], OPT)
    assert rows_of(optout.sanitize_opt_outs_text(raw, old), "id", "dob") == [(2, "1980-01-02"), (4, "1")]


def test_population_drops_opt_outs_blank_sex_and_sentinels(spark, rows_of):
    visits = spark.createDataFrame([
        ("1", "f1", "2020-01-05"), ("2", "f1", "2020-01-05"), ("3", "f2", "2020-01-05"), ("4", "f1", "2010-01-05"),
        ("999999999999999", "f1", "2020-01-05"), ("<NA>", "f1", "2020-01-05"), ("5", "f1", "2020-01-05"), ("6", "f1", "bad"),
        ("nan", "f1", "2020-01-05"), ("8", "f1", "2020-01-05"), ("7", "f1", "2020-01-05")], "MPI string, unit_id string, admitted string")
    people = spark.createDataFrame([
        ("1", "A", "B", "d", "F"), ("2", "C", "D", "d", "F"), ("3", "E", "F", "d", "M"), ("5", "G", "H", "d", ""),
        ("7", "A", "B", "d", "F")], POP.replace("MPI bigint", "MPI string"))
    clients = spark.createDataFrame([("c1", "f1,f9"), ("c2", "f1|f2")], "client string, facility_ids string")
    opt = spark.createDataFrame([("2",)], "MPI string")
    out = population.build_population(visits, people, opt, clients, "2020-06-01")
    assert rows_of(out, "client", "MPI") == [("c1", "7"), ("c2", "3"), ("c2", "7")]


def test_panel_rules(spark):
    row = lambda **k: tuple({**{
        "Patient First Name": "Al", "Patient Last Name": "Bond", "DOB": "1920-11-11", "Gender": "M", "Attributed Provider NPI": "1"}, **k}.values())
    rows = [row(), row(**{"Patient First Name": "A1"}), row(DOB="1920/11/11"), row(**{"Attributed Provider NPI": "101.1"}),
            row(**{"Attributed Provider NPI": "test"}), row(Gender="Male"), row(**{"Patient Last Name": None})]
    names = ["Patient First Name", "Patient Last Name", "DOB", "Gender", "Attributed Provider NPI"]
    out = quality.validate_panel(spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))).collect()
    assert [r.errors for r in out] == [[], ["first_name"], ["date_of_birth"], [], ["npi"], ["gender"], ["last_name"]]
    assert out[3].npi == 101


PANEL = ("Patient First Name", "Patient Last Name", "DOB", "Gender", "Residential Address", "City", "State", "Zip Code", "Insurance ID",
         "CustomText1", "Attributed Facility Provider First Name", "Attributed Facility Provider Last Name", "Attributed Provider NPI")


def test_panel_population_and_attribution(spark, rows_of):
    panel = spark.createDataFrame([
        ("James", "Bond", "1920-11-11", "M", "1 Lane", "Town", "KS", "123", "101", "x", "pf", "pl", "1"),
        ("Jane", "Doe", "1930-01-01", "F", "1 Lane", "Town", "KS", "123", "101", "x", "pf", "pl", "1"),
        ("No", "Gender", "1930-01-01", None, "1 Lane", "Town", "KS", "123", "101", "x", "pf", "pl", "1"),
    ], ", ".join(f"`{c}` string" for c in PANEL))
    master = spark.createDataFrame([(1337, "Bond", "James", "1920-11-11", "M", ""), (5, "Doe", "Jane", "1930-01-01", "F", "")], MASTER)
    out = population.panel_population(panel, master)
    assert rows_of(out, "mpi", "dob", "client_identifier_2") == [(1337, "11/11/1920", "placeholder_id")]
    bad = panel.withColumn("DOB", F.lit("1920/11/11"))
    with pytest.raises(Exception, match="invalid panel row"):
        population.panel_population(bad, master).collect()
    assert population.panel_population(bad, master, skip_invalid=True).count() == 0
    file = population.attribution_file(panel.withColumn("mpi", F.lit(0)), "1.2", "Org", "pref")
    assert len(file.columns) == 25 and file.columns[0] == "Unique Patient ID"
    first = file.orderBy("`Patient First Name`").first()
    assert first["Patient Date of Birth"] == "11/11/1920" and first["Unique Patient ID"] == "" and first["Managing Organization OID"] == "1.2"


def test_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, v int")
    assert quality.check_unique(df, ["k"]).first().n == 2
    assert quality.check_cardinality(df, "k", "v").first().k == 1
    assert quality.check_columns(df, ["k", "x"]) == ["x"]
    empty = quality.check_no_nulls(df.limit(0), "k").first()
    assert empty.passed and empty.n_rows == 0


def test_states(spark, rows_of):
    events = spark.createDataFrame([
        ("p", "UNKNOWN", "2024-03"), ("p", "Kansas", "2024-02"), ("q", "Ohio", "2024-03"), ("r", "UNKNOWN", "2024-01")],
        "patient_id string, state string, index_update_dt_tm string")
    latest = residence.latest_state(events)
    assert rows_of(latest) == [
        ("p", "2024-03", "2024-02", "Kansas", "latest_update_not_unknown"),
        ("q", "2024-03", "2024-03", "Ohio", "latest_update"),
        ("r", "2024-01", None, None, "latest_update_not_unknown")]
    people = spark.createDataFrame([("p", None), ("q", None)], "accid_ref string, mpi string")
    assert residence.state_with_mpi(latest, people).count() == 2
    both = residence.person_state(residence.state_with_mpi(latest, people, keep_unmatched=True))
    assert rows_of(both, "mpi", "patient_id_used_for_assignment", "number_patient_ids") == [(None, "q", 3)]


def test_default_crosswalk(spark, rows_of):
    from carelake.functions.state_codes import state_crosswalk

    raw = ["KS", "ks", "20", "KS ", "kansas", "01", "1", "NL", "NJ", "QC", "quebec", "ZZ", "Dc", "CHIH", None]
    df = spark.createDataFrame([(r,) for r in raw], "raw_state string")
    out = {r.raw_state: r.state for r in residence.standardize(df, "raw_state", state_crosswalk(spark), "state").collect()}
    assert [out[r] for r in raw] == ["Kansas"] * 5 + ["Alabama"] * 2 + [
        "Canada", "New Jersey", "Canada", "Canada", "UNKNOWN", "District of Columbia", "Mexico", "UNKNOWN"]
    beside = {" CA": "California", "Ill": "Illinois", "KS - KANSAS": "Kansas", "MO 64106": "Missouri", "TX.": "Texas", "GE": "Georgia",
              "England": "England", "nA": "Namibia", "NA": "UNKNOWN", "uk": "United Kingdom", "UK": "UNKNOWN", "On": "Canada"}
    df = spark.createDataFrame([(r,) for r in beside], "raw_state string")
    out = {r.raw_state: r.state for r in residence.standardize(df, "raw_state", state_crosswalk(spark), "state").collect()}
    assert out == beside


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_spreads_a_key_that_is_heavy_on_both_sides(spark, how):
    """A third of both sides has one placeholder key; some of its rows are equal; null keys match nothing."""
    left = [("nobody" if i % 3 == 0 else f"p{i % 40}", i // 6) for i in range(600)] + [(None, 1), ("only left", 2)]
    right = [("nobody" if i % 3 == 0 else f"p{i % 50}", i // 9) for i in range(450)] + [(None, 3), ("only right", 4)]
    a = spark.createDataFrame(left, "k string, a int")
    b = spark.createDataFrame(right, "k string, b int")
    joined = joins.split_join(a, b, ["k"], how, pairs=900)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(joined) == rows(a.join(b, ["k"], how))
    assert rows(joins.heavy_keys(a, b, ["k"], 900)) == [("nobody", 200, 150)]
    tasks = joined.filter("k = 'nobody'").groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert sum(t["count"] for t in tasks) == 200 * 150 and len(tasks) > 3
