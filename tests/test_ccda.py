import pytest
from pyspark.sql import types as T

from carelake.operators import ccda
from carelake.plans import documents

HEAD = '<ClinicalDocument xmlns="urn:hl7-org:v3" xmlns:sdtc="urn:hl7-org:sdtc">'
ROLE = '<recordTarget><patientRole>{telecom}<patient><name><given>Ann</given><family>Lee</family></name><birthTime value="{born}"/>{more}</patient></patientRole></recordTarget>'


def _doc(spark, body="", telecom="", born="19800101", more="", file="dir/a.b.xml"):
    text = HEAD + ROLE.format(telecom=telecom, born=born, more=more) + f"<component><structuredBody>{body}</structuredBody></component></ClinicalDocument>"
    return spark.createDataFrame([(file, text)], "file string, value string")


def _section(code, entries, title="T", text=""):
    return f'<component><section><code code="{code}"/><title>{title}</title><text>{text}</text>{entries}</section></component>'


def test_telecom_rules(spark):
    telecom = ('<telecom value="tel:1"/><telecom use="HP" value="tel:2"/><telecom use="HP" value="tel:3"/><telecom nullFlavor="UNK" use="WP" value="tel:9"/>'
               '<telecom use="WP" value="tel:4"/><telecom value="mailto:a@b.c"/><telecom value="d@e.f"/><telecom use="MC" value="5"/>')
    row = ccda.ccda_demographics(_doc(spark, telecom=telecom)).first()
    assert (row.emails, row.home_phone_number_id, row.business_phone_number_id, row.cell_phone_number_id, row.other_phone_number_id) == (
        "a@b.c,d@e.f", "3", "4", "5", "1")
    assert ccda.ccda_demographics(_doc(spark, telecom=telecom), strict_reference=True).first().business_phone_number_id is None


def test_missing_parts_are_null_or_empty(spark):
    row = ccda.ccda_demographics(_doc(spark)).first()
    assert (row.given_name, row.middle_names, row.name_prefix, row.street1, row.city, row.deceased, row.emails) == ("Ann", "", None, "", None, False, "")


@pytest.mark.parametrize("born,expected", [("198001021200", "1980-01-02"), ("unknown", "1000-01-01"), ("", None)])
def test_registration_rows(spark, born, expected):
    row = ccda.ccda_rows(_doc(spark, born=born), "2024-01-01 00:00:00")["registration"].first()
    assert row.dob == expected and row.euid == "a.b" and row.firstname == "Ann" and row.deceased == "False"


def test_several_sections_give_an_error_and_no_rows(spark, rows_of):
    entry = '<entry><encounter classCode="ENC"><code code="1"/></encounter></entry>'
    df = _doc(spark, _section("46240-8", entry) + _section("46240-8", entry))
    assert ccda.ccda_encounters(df).count() == 0
    assert rows_of(ccda.ccda_errors(df)) == [("dir/a.b.xml", "encounters", "several sections")]
    assert ccda.ccda_labs(df).count() == 0


def test_event_of_another_kind(spark, rows_of):
    df = _doc(spark, _section("46240-8", '<entry><observation classCode="OBS"/></entry>'))
    assert ccda.ccda_encounters(df).count() == 0
    assert rows_of(ccda.ccda_errors(df), "error") == [("event of another kind",)]


def test_unreadable_document(spark, rows_of):
    df = spark.createDataFrame([("x.xml", "<ClinicalDocument><a></ClinicalDocument>")], "file string, value string")
    assert rows_of(ccda.ccda_errors(df), "section") == [("document",)]
    assert ccda.ccda_vitals(df).count() == 0


def test_own_phin_vads_code_and_center_time(spark):
    entry = ('<entry><encounter classCode="ENC"><code code="IMP" codeSystem="2.16.840.1.113883.5.4" displayName="in"/>'
             '<effectiveTime><center value="2020"/><high value="2021"/></effectiveTime></encounter></entry>')
    row = ccda.ccda_encounters(_doc(spark, _section("46240-8", entry))).first()
    assert (row.encounter_phin_vads_code, row.service_datetime_start, row.discharged_time) == ("IMP", "2020", "2021")


def test_care_team_without_performer_is_a_row_of_nulls(spark):
    entry = '<entry><organizer classCode="CLUSTER"><component><act classCode="PCPR"/></component></organizer></entry>'
    row = ccda.ccda_care_team(_doc(spark, _section("85847-2", entry))).first()
    assert row.attributed_npi is None and row.mname is None


def test_coverage_act_that_is_the_policy(spark):
    entry = ('<entry><act classCode="ACT"><templateId root="2.16.840.1.113883.10.20.22.4.60"/><id root="own"/><code code="C1"/>'
             '<entryRelationship><act classCode="ACT"><templateId root="2.16.840.1.113883.10.20.22.4.60"/><id root="inner"/></act></entryRelationship></act></entry>')
    row = ccda.ccda_insurance(_doc(spark, _section("48768-6", entry))).first()
    assert (row.grpid, row.plan_type, row.eff_date) == ("own", "C1", None)


def test_medication_without_code_and_second_time(spark):
    entry = ('<entry><substanceAdministration classCode="SBADM"><effectiveTime value="1"/><effectiveTime value="2"/><consumable><manufacturedProduct><manufacturedMaterial>'
             '<code nullFlavor="NA" codeSystem="9.9"/></manufacturedMaterial></manufacturedProduct></consumable></substanceAdministration></entry>')
    row = ccda.ccda_medications(_doc(spark, _section("10160-0", entry))).first()
    assert (row.normalized_code, row.normalized_codesystem, row.sig) == (None, "9.9", None)
    shot = ccda.ccda_immunizations(_doc(spark, _section("11369-6", entry))).first()
    assert shot.administered_date == "1"


def test_table_text(spark):
    cells = "<table><tr><td>Aspirin daily</td><td>RxNorm 1 2</td><td>oneword</td><td/><td ID='x'>more; text here</td></tr></table>"
    df = _doc(spark, _section("10160-0", "", "MEDICATIONS", cells))
    rows = {r.title: (r.field, r.code) for r in ccda.ccda_table_text(df).collect()}
    assert rows["Medications"] == ("Aspirin daily;  text here", "RxNorm 1 2")
    assert rows["Problems"] == ("NA", "NA") and len(rows) == 15


PERFORMER = '<performer><assignedEntity><id root="{0}"/></assignedEntity></performer>'
VADS = '<translation code="{0}" codeSystem="2.16.840.1.113883.5.4"/>'
ALLERGY = '<entry><act classCode="ACT"><entryRelationship><observation classCode="OBS">{0}</observation></entryRelationship></act></entry>'
CONSUMER = '<participant typeCode="CSM"><participantRole><playingEntity><code code="A"/></playingEntity></participantRole></participant>'
TEAM = '<entry><organizer classCode="CLUSTER"><component><act classCode="PCPR">{0}</act></component></organizer></entry>'


def _events(kind, bodies):
    return "".join(f'<entry><{kind} classCode="X">{b}</{kind}></entry>' for b in bodies)


@pytest.mark.parametrize("section,code,extract,body,kept,errors", [
    ("procedures", "47519-4", ccda.ccda_procedures,
     _events("procedure", [PERFORMER.format(1), PERFORMER.format(1) + PERFORMER.format(2), ""]), 2, ["several performers"]),
    ("immunizations", "11369-6", ccda.ccda_immunizations,
     _events("substanceAdministration", [PERFORMER.format(1) * 2, "", PERFORMER.format(1)]), 2, ["several performers"]),
    ("encounters", "46240-8", ccda.ccda_encounters,
     _events("encounter", [f"<code code='1'>{VADS.format('AMB')}{VADS.format('IMP')}</code>", f"<code code='2'>{VADS.format('AMB')}</code>",
                           f"<code code='3' codeSystem='2.16.840.1.113883.5.4'>{VADS.format('AMB')}{VADS.format('IMP')}</code>"]),
     2, ["several PHIN VADS codes"]),
    ("allergies", "48765-2", ccda.ccda_allergies,
     "".join(ALLERGY.format(b) for b in (f'<value code="v"/>{CONSUMER}', '<value code="v"/>', CONSUMER, f'<value code="v"/>{CONSUMER * 2}',
                                         '<value code="v"/><participant typeCode="CSM"/>')),
     1, ["no value", "not one participant", "not one participant", "participant without an entity"]),
    ("care_team", "85847-2", ccda.ccda_care_team, TEAM.format(PERFORMER.format(1) * 2), 0, ["several performers"]),
    ("care_team", "85847-2", ccda.ccda_care_team, TEAM.format(PERFORMER.format(1)) * 2, 0, ["several entries"]),
])
def test_every_item_is_extracted_or_listed(spark, rows_of, section, code, extract, body, kept, errors):
    df = _doc(spark, _section(code, body))
    assert extract(df).count() == kept
    assert rows_of(ccda.ccda_errors(df), "section", "error") == [(section, e) for e in errors]


def test_files_of_one_name_stay_apart(spark, rows_of):
    one = _doc(spark, _section("46240-8", ""), file="a/m.xml").unionByName(_doc(spark, _section("46240-8", ""), file="b/m.xml"))
    assert rows_of(ccda.ccda_sections(one)) == [("a/m.xml", "encounters", 1), ("b/m.xml", "encounters", 1)]
    assert ccda.ccda_errors(one).count() == 0


def test_stored_documents_give_the_same_rows(spark, tmp_path):
    """Odd documents: none at all, no section, two sections of a kind, entries of several kinds."""
    act = '<entry><act classCode="ACT"><entryRelationship><observation><templateId root="2.16.840.1.113883.10.20.22.4.4"/><value code="P"/></observation></entryRelationship></act>{more}</entry>'
    bodies = ["", _section("11450-4", act.format(more="")), _section("11450-4", act.format(more="<supply/>")), _section("11450-4", "") * 2,
              _section("11488-4", "", text="Seen &amp; well<br/>more"), _section("8716-3", "<entry><organizer/></entry>", title="Vital Signs", text="<td>a LOINC b</td>")]
    docs = None
    for i, body in enumerate(bodies):
        one = _doc(spark, body, file=f"d{i}")
        docs = one if docs is None else docs.union(one)
    docs = docs.union(spark.createDataFrame([("bad", "<ClinicalDocument><a></b>"), ("null", None)], "file string, value string"))
    parsed = ccda.parse_ccda(docs, str(tmp_path / "parsed"))
    key = lambda df: sorted(map(str, df.collect()))
    for name, extract in ccda.EXTRACTS.items():
        assert key(extract(parsed)) == key(extract(docs)), name


def test_an_extract_reads_its_own_columns(spark, tmp_path):
    parsed = ccda.parse_ccda(_doc(spark), str(tmp_path / "parsed"))
    whole = len(parsed.schema.simpleString())
    for name, extract in ccda.EXTRACTS.items():
        scan = extract(parsed)._jdf.queryExecution().executedPlan().collectLeaves().head()
        read = len(scan.requiredSchema().simpleString())
        assert read < whole / (2 if name == "errors" else 5), name


def _paths(kind: str) -> set[tuple[str, ...]]:
    """The fields of a type without fields of their own."""
    def below(t: T.DataType, path: tuple[str, ...]) -> set[tuple[str, ...]]:
        if isinstance(t, T.ArrayType):
            return below(t.elementType, path)
        return set().union(*(below(f.dataType, (*path, f.name)) for f in t)) if isinstance(t, T.StructType) else {path}

    return below(T.DataType.fromDDL(kind), ())


def test_nothing_is_parsed_that_no_extract_reads():
    for kind, event in ccda._EVENT.items():
        read = set().union(*(_paths(ccda._READ[name]) for name, k in ccda.EVENTS.items() if k == kind))
        assert _paths(event) - read <= {("_classCode",)}  # an act with nothing else is still an act


def test_parsed_documents_are_no_columns(spark):
    for extract in (ccda.ccda_labs, ccda.ccda_errors):
        assert "_sections" not in extract(_doc(spark))._jdf.queryExecution().optimizedPlan().toString()


def test_extracted_or_listed_parses_once(spark, tmp_path):
    rows = [(7, 3, 1.0, "BUILDING")]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    counted = documents.ccda_extracted_or_listed(spark, str(tmp_path))
    assert "from_xml" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert {r.section: (r.extracted, r.listed) for r in counted.collect()} == {
        name: (0, 1) if name == "encounters" else (documents.ROWS.get(name, 1), 0) for name in ccda.EVENTS}
