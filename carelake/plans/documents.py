"""C-CDA parsing: every customer becomes a document text, which is parsed back.

Documents of one nation hold two encounter sections, those of another two events in a problem entry,
and five more nations break a rule for one item each, so every kind of broken document occurs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import fill, handed_over, query, spread, table
from ..operators import ccda
from ..session import shared_folder

# {marks} are columns of the customer.
TEMPLATE = """<?xml version="1.0" encoding="UTF-8"?>
<ClinicalDocument xmlns="urn:hl7-org:v3" xmlns:sdtc="urn:hl7-org:sdtc" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
<id root="1.2.3" extension="{key}"/>
<recordTarget><patientRole><id root="1.2"/>
<addr><streetAddressLine>{key} Main St</streetAddressLine><streetAddressLine>Apt {n}</streetAddressLine><city>City {n}</city><state>KS</state><postalCode>{zip}</postalCode></addr>
<telecom use="HP" value="tel:555-{key}"/><telecom use="WP" value="tel:556-{key}"/><telecom value="mailto:p{key}@x.org"/><telecom nullFlavor="UNK"/><telecom value="tel:999-{n}"/>
<patient><name><prefix>Dr</prefix><given>{seg}</given><given>Mid</given><family>N{n}</family></name>
<administrativeGenderCode code="{sex}"/><birthTime value="{born}"/><sdtc:deceasedInd value="{deceased}"/><maritalStatusCode code="M"/>
<raceCode code="R{n}"/><sdtc:raceCode code="other"/><ethnicGroupCode code="E{n}"/><languageCommunication><languageCode code="en"/></languageCommunication></patient>
</patientRole></recordTarget>
<componentOf><encompassingEncounter><id root="9"/><effectiveTime><low value="2020{n2}01"/></effectiveTime><dischargeDispositionCode code="DD{n}"/></encompassingEncounter></componentOf>
<component><structuredBody>
<component><section><code code="46240-8"/><title>Encounters</title><text><table><tr><td>Office visit {n}</td><td>SNOMED-CT 123 {n}</td><td/></tr></table></text>
<entry><encounter classCode="ENC"><code code="99{n}" displayName="Visit {seg}"><translation code="{vads}" codeSystem="2.16.840.1.113883.5.4" displayName="V {vads}"/>{vads2}<translation code="zz" codeSystem="1.2"/></code>
<effectiveTime><low value="2021{n2}01"/><high value="2021{n2}05"/></effectiveTime><sdtc:dischargeDispositionCode code="01" displayName="Home"/>
<participant typeCode="DST"><participantRole><playingEntity><name>Rehab {n}</name></playingEntity></participantRole></participant></encounter></entry>
<entry><encounter classCode="ENC"><code code="second{key}"/><effectiveTime value="20220101"/></encounter></entry></section></component>
{extra}
<component><section><code code="48768-6"/><title>Payers</title><entry><act classCode="ACT"><templateId root="2.16.840.1.113883.10.20.22.4.61"/><participant typeCode="COV"><time><low value="2020"/><high value="2025"/></time></participant>
<entryRelationship typeCode="COMP"><act classCode="ACT"><templateId root="2.16.840.1.113883.10.20.22.4.60"/><id root="grp{key}"/><code code="PLAN{n}"/></act></entryRelationship></act></entry></section></component>
<component><section><code code="85847-2"/><title>Care Team</title><entry><organizer classCode="CLUSTER"><component><act classCode="OTHER"/></component><component><act classCode="PCPR"><performer><sdtc:functionCode code="ATT"/>
<assignedEntity><id root="1.1" extension="no"/><id root="2.16.840.1.113883.4.6" extension="55{key}"/><assignedPerson><name><given>Wilma</given><given>K</given><given qualifier="CL">Wil</given><family>Ortega {n}</family><suffix>DDS</suffix></name></assignedPerson></assignedEntity></performer></act></component></organizer></entry>{team2}</section></component>
<component><section><code code="11450-4"/><title>Problems</title>
<entry><act classCode="ACT"><entryRelationship typeCode="SUBJ"><observation classCode="OBS"><templateId root="2.16.840.1.113883.10.20.22.4.4"/><value code="P{n}" displayName="Problem {seg}"><originalText>orig {n}</originalText></value>
<author><time value="2019{n2}"/><assignedAuthor><id root="2.16.840.1.113883.4.6" extension="77{n}"/></assignedAuthor></author></observation></entryRelationship></act>{event}</entry>
<entry><act classCode="ACT"><entryRelationship typeCode="SUBJ"><observation classCode="OBS"><templateId root="2.16.840.1.113883.10.20.22.4.4"/><value code="Q{key}"/>
<entryRelationship typeCode="COMP"><act classCode="ACT"><templateId root="2.16.840.1.113883.10.20.22.4.502"/><effectiveTime value="2018{n2}"/></act></entryRelationship></observation></entryRelationship></act></entry></section></component>
<component><section><code code="47519-4"/><title>Procedures</title><entry><procedure classCode="PROC"><code code="PR{n}" displayName="Proc"><originalText>did {seg}</originalText></code><effectiveTime><low value="2017"/></effectiveTime>
<performer><assignedEntity><id root="2.16.840.1.113883.4.6" extension="88{n}"/></assignedEntity></performer>{proc2}</procedure></entry><entry><observation classCode="OBS"/></entry></section></component>
<component><section><code code="10160-0"/><title>Medications</title><entry><substanceAdministration classCode="SBADM"><effectiveTime><low value="2016"/></effectiveTime><effectiveTime/><routeCode displayName="Oral"/>
<consumable><manufacturedProduct><manufacturedMaterial><code code="RX{key}" codeSystem="2.16.840.1.113883.6.88" displayName="Drug {n}"/></manufacturedMaterial></manufacturedProduct></consumable>
<entryRelationship typeCode="SUBJ"><substanceAdministration classCode="SBADM"><code code="76662-6"/><text>take {n} daily</text></substanceAdministration></entryRelationship></substanceAdministration></entry></section></component>
<component><section><code code="48765-2"/><title>Allergies</title><entry><act classCode="ACT"><entryRelationship typeCode="SUBJ"><observation classCode="OBS"><effectiveTime><low value="2015"/></effectiveTime><value code="419" displayName="Drug allergy"/>
<author><time value="2015{n2}"/></author>{allergen}
<entryRelationship typeCode="MFST"><observation classCode="OBS"><value displayName="Hives {n}"/><entryRelationship typeCode="SUBJ"><observation classCode="OBS"><code code="SEV"/><value code="S{n}" displayName="Severe"/></observation></entryRelationship></observation></entryRelationship></observation></entryRelationship></act></entry></section></component>
<component><section><code code="11369-6"/><title>Immunizations</title><entry><substanceAdministration classCode="SBADM"><effectiveTime value="2014{n2}01"/><repeatNumber>1</repeatNumber><consumable><manufacturedProduct><manufacturedMaterial><code code="CVX{n}" displayName="Flu"/><lotNumberText>LOT{key}</lotNumberText></manufacturedMaterial></manufacturedProduct></consumable>
<performer><assignedEntity><id root="perf{n}"/></assignedEntity></performer>{shot2}</substanceAdministration></entry></section></component>
<component><section><code code="8716-3"/><title>Vital Signs</title><entry><organizer classCode="CLUSTER"><component><observation classCode="OBS"><code code="8302-2" codeSystem="2.16.840.1.113883.6.1" displayName="Height"/><effectiveTime value="2013{n2}"/></observation></component><component><observation classCode="OBS"><code code="w{key}"/><effectiveTime value="2013"/></observation></component></organizer></entry></section></component>
<component><section><code code="30954-2"/><title>LAB</title><entry><organizer classCode="BATTERY"><component><observation classCode="OBS"><code code="2345-7" codeSystem="2.16.840.1.113883.6.1"/><effectiveTime value="2012"/><value unit="mg/dL" value="{key}"/><interpretationCode code="N"/><interpretationCode code="{flag}"/></observation></component>
<component><observation classCode="OBS"><code code="local" codeSystem="9.9"/><effectiveTime value="2012{n2}"/><value value="{n}"/></observation></component></organizer></entry></section></component>
<component><section><code code="11488-4"/><title>Consult</title><text>Note for {seg} {key}<br/>more</text></section></component>
</structuredBody></component></ClinicalDocument>"""

PERFORMER = '<performer><assignedEntity><id root="another"/></assignedEntity></performer>'
ALLERGEN = ('<participant typeCode="CSM"><participantRole><playingEntity><code code="A{n}" displayName="Penicillin"><originalText>pen {n}</originalText></code>'
            '</playingEntity></participantRole></participant>')
EXTRA = """<component><section><code code="46240-8"/><title>Again</title></section></component>"""


def document_text(spark, sf_dir):
    """Columns ``file`` and ``value``, one row per customer."""
    c = spread(table(spark, sf_dir, "customer"), "c_custkey")
    n = F.col("c_nationkey")
    facts = c.select(
        F.col("c_custkey").alias("key"), n.alias("n"), F.lpad(((n % 12) + 1).cast("string"), 2, "0").alias("n2"),
        F.col("c_mktsegment").alias("seg"), F.lpad(n.cast("string"), 5, "0").alias("zip"),
        F.when(F.col("c_acctbal") < 0, "F").otherwise("M").alias("sex"),
        F.when(n == 4, "unknown").otherwise(F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), n * 100), "yyyyMMdd")).alias("born"),
        F.when(F.col("c_acctbal") < 0, "true").otherwise("false").alias("deceased"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "IMP").otherwise("AMB").alias("vads"),
        F.when(F.col("c_acctbal") > 5000, "HH").otherwise("X").alias("flag"),
        F.when(n == 3, EXTRA).otherwise("").alias("extra"),
        F.when(n == 5, '<act classCode="ACT"/>').otherwise("").alias("event"),
        F.when(n == 6, PERFORMER).otherwise("").alias("proc2"),
        F.when(n == 7, PERFORMER).otherwise("").alias("shot2"),
        F.when(n == 8, "").otherwise(fill(ALLERGEN, n=n)).alias("allergen"),
        F.when(n == 9, '<translation code="EMER" codeSystem="2.16.840.1.113883.5.4"/>').otherwise("").alias("vads2"),
        F.when(n == 10, '<entry><organizer classCode="CLUSTER"/></entry>').otherwise("").alias("team2"),
    )
    cols = {name: F.col(name) for name in facts.columns}
    return handed_over(facts.select(fill("doc{key}.xml", **cols).alias("file"), fill(TEMPLATE, **cols).alias("value")))


BASE = """(SELECT *, c_nationkey AS n, lpad(CAST(c_nationkey % 12 + 1 AS VARCHAR), 2, '0') AS n2, 'doc' || c_custkey || '.xml' AS file,
 c_mktsegment AS seg, CAST(c_custkey AS VARCHAR) AS key FROM customer)"""
BORN = "CASE WHEN n = 4 THEN 'unknown' ELSE strftime(DATE '1950-01-01' + n * 100, '%Y%m%d') END"
ISO = "CASE WHEN n = 4 THEN '1000-01-01' ELSE strftime(DATE '1950-01-01' + n * 100, '%Y-%m-%d') END"

DEMOGRAPHICS_SQL = f"""
SELECT file, 'Dr' AS name_prefix, seg || ' Mid' AS given_name, '' AS middle_names, 'N' || n AS family_name, NULL::VARCHAR AS name_suffix,
 {BORN} AS date_of_birth, CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'M' END AS sex, 'R' || n AS race, 'E' || n AS ethnicity, 'en' AS language,
 'M' AS marital_status, c_acctbal < 0 AS deceased, key || ' Main St' AS street1, 'Apt ' || n AS street2, 'City ' || n AS city, 'KS' AS state,
 lpad(CAST(n AS VARCHAR), 5, '0') AS postal_code, 'p' || key || '@x.org' AS emails, '555-' || key AS home_phone_number_id,
 '556-' || key AS business_phone_number_id, NULL::VARCHAR AS cell_phone_number_id, '999-' || n AS other_phone_number_id FROM {BASE}
"""


@query("ccda_demographics", DEMOGRAPHICS_SQL)
def ccda_demographics(spark, sf_dir):
    return ccda.ccda_demographics(document_text(spark, sf_dir))


@query("ccda_demographics_line", f"""
SELECT file, concat_ws('|', 'Dr', seg || ' Mid', '', 'N' || n, '') AS patient_name_extract,
 concat_ws('|', key || ' Main St', 'Apt ' || n, 'City ' || n, 'KS', lpad(CAST(n AS VARCHAR), 5, '0')) AS patient_address_extract FROM {BASE}
""")
def ccda_demographics_line(spark, sf_dir):
    from ..sources.sinks import to_pipe_delimited

    d = ccda.ccda_demographics(document_text(spark, sf_dir))
    name = ["name_prefix", "given_name", "middle_names", "family_name", "name_suffix"]
    address = ["street1", "street2", "city", "state", "postal_code"]
    return d.select("file", to_pipe_delimited(name).alias("patient_name_extract"), to_pipe_delimited(address).alias("patient_address_extract"))


@query("ccda_header", f"SELECT file, '2020' || n2 || '01' AS service_datetime, 'DD' || n AS discharge_disposition_code FROM {BASE}")
def ccda_header(spark, sf_dir):
    return ccda.ccda_header(document_text(spark, sf_dir))


@query("ccda_sections", f"""
SELECT file, section, CAST(CASE WHEN section = 'encounters' AND n = 3 THEN 2 ELSE 1 END AS BIGINT) AS n FROM {BASE},
 (SELECT unnest(['encounters','insurance','care_team','problems','procedures','medications','allergies','immunizations','vital_signs','labs','consult_note']) AS section)
""")
def ccda_sections(spark, sf_dir):
    return ccda.ccda_sections(document_text(spark, sf_dir))


@query("ccda_encounters", f"""
SELECT file, 1 AS event_no, '2021' || n2 || '01' AS service_datetime_start, '2021' || n2 || '05' AS service_datetime_end, '99' || n AS encounter_code,
 'Visit ' || seg AS encounter_code_display_name, v AS encounter_phin_vads_code, 'V ' || v AS encounter_phin_vads_code_display_name,
 CASE WHEN v = 'IMP' THEN '2021' || n2 || '05' END AS discharged_time, '01' AS discharge_disposition_code, 'Home' AS discharge_disposition_display_name, 'Rehab ' || n AS discharged_to
FROM (SELECT *, CASE WHEN seg = 'FURNITURE' THEN 'IMP' ELSE 'AMB' END AS v FROM {BASE}) WHERE n NOT IN (3, 9)
UNION ALL SELECT file, 2, '20220101', NULL, 'second' || key, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM {BASE} WHERE n <> 3
""")
def ccda_encounters(spark, sf_dir):
    return ccda.ccda_encounters(document_text(spark, sf_dir))


@query("ccda_insurance", f"SELECT file, 1 AS event_no, 'grp' || key AS grpid, '2020' AS eff_date, '2025' AS exp_date, 'PLAN' || n AS plan_type FROM {BASE}")
def ccda_insurance(spark, sf_dir):
    return ccda.ccda_insurance(document_text(spark, sf_dir))


@query("ccda_care_team", f"""
SELECT file, '55' || key AS attributed_npi, 'Wilma K' AS fname, 'Ortega ' || n AS lname, '' AS mname, 'DDS' AS suffix, 'ATT' AS prov_type FROM {BASE} WHERE n <> 10
""")
def ccda_care_team(spark, sf_dir):
    return ccda.ccda_care_team(document_text(spark, sf_dir))


@query("ccda_problems", f"""
SELECT file, 1 AS event_no, 'P' || n AS code, 'Problem ' || seg AS display_name, 'orig ' || n AS description, '77' || n AS provider_id, '2019' || n2 AS diagnosis_timestamp FROM {BASE} WHERE n <> 5
UNION ALL SELECT file, 2, 'Q' || key, NULL, NULL, NULL, '2018' || n2 FROM {BASE} WHERE n <> 5
""")
def ccda_problems(spark, sf_dir):
    return ccda.ccda_problems(document_text(spark, sf_dir))


@query("ccda_procedures", f"""
SELECT file, 1 AS event_no, 'PR' || n AS code, 'Proc' AS display_name, '88' || n AS provider_id, 'did ' || seg AS original_text, '2017' AS procedure_timestamp FROM {BASE} WHERE n <> 6
""")
def ccda_procedures(spark, sf_dir):
    return ccda.ccda_procedures(document_text(spark, sf_dir))


@query("ccda_medications", f"""
SELECT file, 1 AS event_no, 'RX' || key AS normalized_code, '2.16.840.1.113883.6.88' AS normalized_codesystem, 'Drug ' || n AS name, 'Oral' AS route, 'take ' || n || ' daily' AS sig FROM {BASE}
""")
def ccda_medications(spark, sf_dir):
    return ccda.ccda_medications(document_text(spark, sf_dir))


@query("ccda_allergies", f"""
SELECT file, 1 AS event_no, 'Penicillin' || chr(10) || 'pen ' || n AS description, 'A' || n AS code, 'Drug allergy' AS description_type, '419' AS code_type,
 '[{{"reaction":"Hives ' || n || '","severity":[{{"description_sev":"Severe","code_sev":"S' || n || '"}}]}}]' AS reaction, '2015' || n2 AS reported_date, '2015' AS onset_date FROM {BASE} WHERE n <> 8
""")
def ccda_allergies(spark, sf_dir):
    return ccda.ccda_allergies(document_text(spark, sf_dir)).withColumn("reaction", F.to_json("reaction"))


@query("ccda_immunizations", f"""
SELECT file, 1 AS event_no, 'perf' || n AS performing_provider_id, '1' AS series_number, '2014' || n2 || '01' AS administered_date, 'LOT' || key AS lot_number, 'Flu' AS long_name, 'CVX' || n AS code FROM {BASE} WHERE n <> 7
""")
def ccda_immunizations(spark, sf_dir):
    return ccda.ccda_immunizations(document_text(spark, sf_dir))


@query("ccda_vitals", f"""
SELECT file, 1 AS event_no, '8302-2' AS code, '2.16.840.1.113883.6.1' AS codesystem, 'Height' AS name, '2013' || n2 AS vital_timestamp FROM {BASE}
UNION ALL SELECT file, 1, 'w' || key, NULL, NULL, '2013' FROM {BASE}
""")
def ccda_vitals(spark, sf_dir):
    return ccda.ccda_vitals(document_text(spark, sf_dir))


@query("ccda_labs", f"""
SELECT file, 1 AS event_no, '2345-7' AS obx_3_3, 'mg/dL' AS unit, key AS value, c_acctbal > 5000 AS abnormal, '2012' AS time FROM {BASE}
UNION ALL SELECT file, 1, NULL, NULL, CAST(n AS VARCHAR), false, '2012' || n2 FROM {BASE}
""")
def ccda_labs(spark, sf_dir):
    return ccda.ccda_labs(document_text(spark, sf_dir))


@query("ccda_consult_note", f"SELECT file, 'Note for ' || seg || ' ' || key AS provider_notes FROM {BASE}")
def ccda_consult_note(spark, sf_dir):
    return ccda.ccda_consult_note(document_text(spark, sf_dir))


@query("ccda_errors", f"""
SELECT file, 'encounters' AS section, 'several sections' AS error FROM {BASE} WHERE n = 3
UNION ALL SELECT file, 'problems', 'several events in an entry' FROM {BASE} WHERE n = 5
UNION ALL SELECT file, 'procedures', 'several performers' FROM {BASE} WHERE n = 6
UNION ALL SELECT file, 'immunizations', 'several performers' FROM {BASE} WHERE n = 7
UNION ALL SELECT file, 'allergies', 'not one participant' FROM {BASE} WHERE n = 8
UNION ALL SELECT file, 'encounters', 'several PHIN VADS codes' FROM {BASE} WHERE n = 9
UNION ALL SELECT file, 'care_team', 'several entries' FROM {BASE} WHERE n = 10
""")
def ccda_errors(spark, sf_dir):
    return ccda.ccda_errors(document_text(spark, sf_dir))


#: The nation whose documents break a rule in a section, and the rows that its extract gives otherwise.
SPOILED = {"encounters": 9, "care_team": 10, "procedures": 6, "immunizations": 7, "allergies": 8, "problems": 5}
ROWS = {"encounters": 2, "problems": 2, "vital_signs": 2, "labs": 2}
_SECTION_ROWS = ", ".join(f"('{name}', {SPOILED.get(name, -1)}, {ROWS.get(name, 1)})" for name in ccda.EVENTS)


@query("ccda_extracted_or_listed", f"""
SELECT file, section, CAST(CASE WHEN section = 'encounters' AND n = 3 THEN 0 WHEN n <> spoiled THEN n_rows WHEN section = 'encounters' THEN 1 ELSE 0 END AS BIGINT) AS extracted,
 CAST(n = spoiled OR (section = 'encounters' AND n = 3) AS BIGINT) AS listed
FROM {BASE}, (VALUES {_SECTION_ROWS}) t(section, spoiled, n_rows)
""")
def ccda_extracted_or_listed(spark, sf_dir):
    """Rows of every extract and listed errors by file and section, from documents that were parsed once. (The
    two encounter sections of a document make one error, and so does a problem section with two events in an entry.)"""
    docs = ccda.parse_ccda(document_text(spark, sf_dir), shared_folder(spark, "ccda-parsed"))
    sections = {name: ccda.EXTRACTS[name] for name in ccda.EVENTS}
    rows = ccda.ccda_errors(docs).select("file", "section", F.lit(0).alias("e"), F.lit(1).alias("l"))
    for section, extract in sections.items():
        rows = rows.unionByName(extract(docs).select("file", F.lit(section).alias("section"), F.lit(1).alias("e"), F.lit(0).alias("l")))
    return rows.groupBy("file", "section").agg(F.sum("e").alias("extracted"), F.sum("l").alias("listed"))


@query("ccda_table_text", f"""
SELECT file, title, CASE WHEN title = 'Encounters' THEN 'Office visit ' || n ELSE 'NA' END AS field,
 CASE WHEN title = 'Encounters' THEN 'SNOMED-CT 123 ' || n ELSE 'NA' END AS code FROM {BASE},
 (SELECT unnest(['Encounters','Insurance','Providers','Problems','Procedures','Surgeries','Medications','Allergies','Allergies and Adverse Reactions',
  'Immunizations','Vital Signs','Lab','Diagnostic Results','Social History','Plan of Care']) AS title)
""")
def ccda_table_text(spark, sf_dir):
    return ccda.ccda_table_text(document_text(spark, sf_dir))


AT = "2024-02-01 00:00:00"


def _rows(spark, sf_dir, name):
    return ccda.ccda_rows(document_text(spark, sf_dir), AT)[name]


@query("ccda_registration_rows", f"""
SELECT '{AT}' AS index_update_dt_tm, '999999999' AS mrn, 'Dr' AS prefix, seg AS firstname, '' AS middlename, 'N' || n AS lastname, NULL::VARCHAR AS suffix,
 {ISO} AS dob, CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'M' END AS sex, 'R' || n AS race, 'E' || n AS ethnicity, 'en' AS language, 'M' AS marital_status,
 CASE WHEN c_acctbal < 0 THEN 'True' ELSE 'False' END AS deceased, '{AT}' AS event_timestamp, '1970-12-31 18:00:00' AS collect_registered, '-1' AS collect_cmp, 'doc' || key AS euid FROM {BASE}
""")
def ccda_registration_rows(spark, sf_dir):
    return _rows(spark, sf_dir, "registration")


@query("ccda_contact_rows", f"""
SELECT '{AT}' AS index_update_dt_tm, '9999' AS patient_id, key || ' Main St' AS street1, 'Apt ' || n AS street2, 'City ' || n AS city, 'KS' AS state,
 lpad(CAST(n AS VARCHAR), 5, '0') AS zip, 'p' || key || '@x.org' AS email, '{AT}' AS event_timestamp, '555-' || key AS home_phone_number_id,
 '556-' || key AS business_phone_number_id, 'doc' || key AS euid FROM {BASE}
""")
def ccda_contact_rows(spark, sf_dir):
    return _rows(spark, sf_dir, "contact")


@query("ccda_insurance_rows", f"""
SELECT '{AT}' AS index_update_dt_tm, '9999' AS accid, '0' AS seqnum, seg AS ins_fname, '' AS ins_mname, 'N' || n AS ins_lname, NULL::VARCHAR AS ins_suffix, {ISO} AS ins_dob,
 'M' AS relationship, key || ' Main St' AS ins_addr1, 'Apt ' || n AS ins_addr2, 'City ' || n AS ins_city, 'KS' AS ins_state, lpad(CAST(n AS VARCHAR), 5, '0') AS ins_zip,
 'p' || key || '@x.org' AS ins_email, '{AT}' AS event_timestamp, '555-' || key AS home_phone_number_id, '556-' || key AS business_phone_number_id, 'doc' || key AS euid FROM {BASE}
""")
def ccda_insurance_rows(spark, sf_dir):
    return _rows(spark, sf_dir, "insurance")
