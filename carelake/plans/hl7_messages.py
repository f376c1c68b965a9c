"""HL7 v2 parsing: every order becomes a message text, which is parsed back.

The expected rows come straight from the orders and customer columns, so a parse error shows as a
difference. Messages of one nation use other delimiters, and part of the orders have no header, no
account number or no admit time.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from .registry import ORACLES, fill, handed_over, query, spread, table
from ..operators import hl7v2


# One segment per line; {marks} are columns of the order.
TEMPLATE = r"""
MSH|^~\&|APP|{sender}|RCV{n}|FAC|{stamp}|SEC{n}|ADT^A01|{key}|P|{version}
EVN|A01|{stamp}
PID|1||{cust}^^^AUTH||{seg}^N{n}^MID^JR^DR~Alias^Other|MAIDEN|{born}|{sex}||R{n}|{cust} Main St^Apt 2^City {n}^KS^{zip}^US||555-{cust}|556-{cust}|en|M^Married|REL|{account}|{ssn}|||E{n}||||||||N
PD1||||PCP{n}^Primary^Pat
ROL||||ROL{n}^Role^Ray
NK1|1|KIN
PV1||I|U{n}^12^B^FAC^ST^TY^BL^FL^Ward||||ATT{n}^Attend^Ann^Q|||SVC||||ER||VIP|ADM{n}^Admit^Al|PT|{key}|FIN||||||||||||||||01|HOME||||ACT|||{admitted}|{day}2359
PV2|||CHEST^Chest pain
PR1|1|CPT|P{n}|Procedure one|{stamp}|T||||||PRC{n}^Prac^Pru||1
PR1|2|CPT|{seg}|Procedure two|notadate|T
DG1|1||D{n}^text|{seg}|{day}||||||||||1|DGN{n}^Diag^Di
RXO|order|||||||||PO
RXE|^2^^{stamp}^{stamp}|RX{n}^Drug^NDC||||||||{price}|BOX||ORD{n}^Order^Oz|
RXE|^1|RX2^Other^NDC||||||||5|BAG
IAM|1|||SV^Severe||||||GRP|{day}||{day}
AL1|1|DA^Drug|x^{seg}||Hives
AL1|2|FA^Food|y^Nuts|MI^Mild||{day}
AL1||skipped
RXA|0|1|{day}||CVX^Vaccine^CVX^{key}^V{n}|0.5|ML||00^given|RN{n}||||L^LOT{n}|||MVX^Maker
IN1|1|PL{n}^Plan||{seg}|1 Co St^^Town^KS^66002^US|Contact|800^^^a b.c||GNAME^^G{n}|EMP|Employer|{day}|20991231|AUTH|HMO|{seg}^Holder|SELF|19700101|2 In St^^Ville^KS^66003^US|||||||||||||||||POL{key}
OBR|1|PLC{key}||CBC^Blood count|||{stamp}
OBX|1|NM|WBC^White cells^LN^6690-2^WBC alt^L||{price}|K/uL|4-11|{flag}|||F|||{stamp}|||||||||LAB
OBX|2|ST|NOTE^Comment||say "ok"||||||F
OBR|2|PLC2||X|||{day}
OBX|1|NM|HGB^Hemoglobin||{key}|g/dL|||||P
""".strip().replace("\n", "\r")


def message_text(spark, sf_dir) -> DataFrame:
    """Columns ``file`` and ``value``, one row per order."""
    orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    o = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    n = F.col("c_nationkey")
    low = F.col("o_orderpriority") == "5-LOW"
    done = F.col("o_orderstatus") == "F"
    urgent = F.col("o_orderpriority") == "1-URGENT"
    stamp = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    facts = o.select(
        n.alias("n"),
        F.col("o_orderkey").alias("key"),
        F.col("o_custkey").alias("cust"),
        F.col("c_mktsegment").alias("seg"),
        stamp.alias("stamp"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.when(n == 3, "19501399")
        .otherwise(F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), n * 100), "yyyyMMdd"))
        .alias("born"),
        F.when(done, "Female").otherwise("Male").alias("sex"),
        F.lpad(n.cast("string"), 5, "0").alias("zip"),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("ssn"),
        F.when(low, "").otherwise(F.concat(F.lit("AC"), F.col("o_orderkey"))).alias("account"),
        F.when(low & done, "").otherwise(stamp).alias("admitted"),
        F.when(urgent, "2.5").otherwise("2.3").alias("version"),
        F.when(urgent, "H").otherwise("N").alias("flag"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.when(n < 8, F.concat(F.lit("2.16.840."), n)).otherwise(F.concat(F.lit("NATION_"), n, F.lit(" ^site"))).alias("sender"),
        F.when(F.col("o_orderstatus") == "P", "BAD").otherwise("").alias("start"),
    )
    cols = {name: F.col(name) for name in facts.columns}
    plain = facts.select(
        "n",
        fill("adt{key}[KS][FAC{n}]ptr[{seg}]_{day}.hl7", **cols).alias("file"),
        fill("{start}" + TEMPLATE, **cols).alias("_t"),
    )
    other = F.when(F.col("n") == 7, F.translate("_t", "|^~", "#@!")).when(
        F.col("n") == 9, F.replace("_t", F.lit("\r"), F.lit("\r\n"))
    )
    return handed_over(plain.select("file", F.coalesce(other, F.col("_t")).alias("value")))


def _messages(spark, sf_dir) -> DataFrame:
    return hl7v2.hl7_messages(message_text(spark, sf_dir))


# Columns every expected table is built from.
BASE = """
SELECT *, c_nationkey AS n, strftime(o_orderdate, '%Y%m%d%H%M%S') AS stamp, strftime(o_orderdate, '%Y%m%d') AS day_,
  'adt' || o_orderkey || '[KS][FAC' || c_nationkey || ']ptr[' || c_mktsegment || ']_' || strftime(o_orderdate, '%Y%m%d') || '.hl7' AS file,
  'FAC' || c_nationkey AS fac, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 'AC' || o_orderkey || o_custkey || 'FAC' || c_nationkey
       WHEN o_orderstatus <> 'F' THEN CAST(epoch(o_orderdate) AS BIGINT) || '' || o_custkey || 'FAC' || c_nationkey
       ELSE sha1('adt' || o_orderkey || '[KS][FAC' || c_nationkey || ']ptr[' || c_mktsegment || ']_' || strftime(o_orderdate, '%Y%m%d') || '.hl7') || 'FAC' || c_nationkey END AS accid,
  NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F') AS has_visit
FROM orders JOIN customer ON o_custkey = c_custkey
"""
PARSED = f"({BASE.strip()} WHERE o_orderstatus <> 'P')"

DOB = "CASE WHEN n = 3 THEN NULL ELSE strftime(DATE '1950-01-01' + n * 100, '%Y-%m-%d') END"
SEX = "CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'M' END"
VERSION = "CASE WHEN o_orderpriority = '1-URGENT' THEN '2.5' ELSE '2.3' END"
SSN = "lpad(CAST(o_custkey AS VARCHAR), 9, '0')"


def _provider(role: str, code: str, last: str, first: str, middle: str = "", prov_type: str = "") -> str:
    """SQL of the key of a new provider: digest of all nine parts, a dash, and the code."""
    return f"sha1({code} || '{last}{first}{middle}' || '{prov_type}{role}') || '-' || {code}"


def _segment_sql() -> str:
    """The text of every segment by its number, with the marks of the template put in."""
    marks = {
        "sender": "CASE WHEN n < 8 THEN '2.16.840.' || n ELSE 'NATION_' || n || ' ^site' END", "n": "n", "stamp": "stamp", "key": "o_orderkey",
        "version": VERSION, "cust": "o_custkey", "seg": "c_mktsegment",
        "born": "CASE WHEN n = 3 THEN '19501399' ELSE strftime(DATE '1950-01-01' + n * 100, '%Y%m%d') END",
        "sex": "CASE WHEN o_orderstatus = 'F' THEN 'Female' ELSE 'Male' END", "zip": "lpad(CAST(n AS VARCHAR), 5, '0')", "ssn": SSN, "day": "day_",
        "account": "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'AC' || o_orderkey END",
        "admitted": "CASE WHEN has_visit THEN stamp ELSE '' END", "price": "price", "flag": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'H' ELSE 'N' END",
    }
    lines = []
    for i, line in enumerate(TEMPLATE.replace('"', "-").split("\r")):
        parts = re.split(r"\{(\w+)\}", line)
        text = " || ".join(f"CAST({marks[p]} AS VARCHAR)" if k % 2 else "'" + p.replace("'", "''") + "'" for k, p in enumerate(parts))
        lines.append(f"SELECT file, {i + 1} AS seg_no, {text} AS line FROM base")
    return f"WITH base AS {PARSED} " + " UNION ALL ".join(lines)


@query("hl7_segments", f"""
SELECT file, CAST(seg_no AS INTEGER) AS seg_no, left(line, 3) AS seg, array_to_string(string_split(line, '|'), chr(31)) AS fields FROM ({_segment_sql()})
""")
def hl7_segments(spark, sf_dir):
    """Whole rows; the fields are joined by a sign of their own."""
    rows = hl7v2.hl7_segments(message_text(spark, sf_dir))
    plain = F.when(F.col("_swapped"), F.translate(F.array_join("fields", "\x1f"), hl7v2._HIDDEN, "|^~")).otherwise(F.array_join("fields", "\x1f"))
    return rows.select("file", "seg_no", "seg", plain.alias("fields"))


@query("hl7_fields", f"""
SELECT file, 'PID' AS seg, 5 AS field_no, rep AS repetition, c AS component, v AS value FROM {PARSED},
 LATERAL (VALUES (1, 1, c_mktsegment), (1, 2, 'N' || n), (1, 3, 'MID'), (1, 4, 'JR'), (1, 5, 'DR'), (2, 1, 'Alias'), (2, 2, 'Other')) t(rep, c, v)
UNION ALL SELECT file, 'MSH', 2, 1, 1, CASE WHEN n = 7 THEN '^~\\&' ELSE '^~\\&' END FROM {PARSED}
UNION ALL SELECT file, 'MSH', 9, 1, 1, 'ADT' FROM {PARSED}
UNION ALL SELECT file, 'MSH', 9, 1, 2, 'A01' FROM {PARSED}
""")
def hl7_fields(spark, sf_dir):
    rows = hl7v2.hl7_fields(message_text(spark, sf_dir))
    wanted = ((F.col("seg") == "PID") & (F.col("field_no") == 5)) | ((F.col("seg") == "MSH") & F.col("field_no").isin(2, 9))
    return rows.filter(wanted).drop("seg_no")


@query("hl7_filename", f"""
SELECT file, 'adt' || o_orderkey AS f_name, 'KS' AS f_state, fac AS f_facility, 'ptr' AS f_pointer,
       c_mktsegment AS f_pointer_value, day_ AS f_date FROM ({BASE})
""")
def hl7_filename(spark, sf_dir):
    return hl7v2.hl7_filename(message_text(spark, sf_dir)).drop("value")


@query("hl7_accid", f"SELECT file, accid AS accid_ref FROM ({BASE}) WHERE o_orderstatus <> 'P'")
def hl7_accid(spark, sf_dir):
    return _messages(spark, sf_dir).filter("has_header").select("file", "accid_ref")


@query("hl7_identity", f"""
SELECT file, c_mktsegment AS lastname, 'N' || n AS firstname, {SEX} AS sex, {DOB} AS dob, {SSN} AS ssn FROM {PARSED}
""")
def hl7_identity(spark, sf_dir):
    return hl7v2.hl7_identity(_messages(spark, sf_dir))


@query("hl7_person", f"""
SELECT fac AS source, 'hl7v2' AS source_type, {DOB} AS dob, 'E' || n AS ethnicity, o_orderdate AS event_timestamp,
 'N' || n AS firstname, 'en' AS language, c_mktsegment AS lastname, 'Married' AS marital_status, 'N' AS deceased,
 'MID' AS middlename, 'MAIDEN' AS mother_maiden_name, CAST(o_custkey AS VARCHAR) AS mrn, 'DR' AS prefix, 'R' || n AS race,
 'REL' AS religion, {SEX} AS sex, {SSN} AS ssn, 'JR' AS suffix, stamp AS updated, 'AUTH' AS assigning_authority, accid AS accid_ref
FROM {PARSED}
""")
def hl7_person(spark, sf_dir):
    return hl7v2.hl7_person(_messages(spark, sf_dir))


@query("hl7_account", f"""
SELECT o_orderdate AS index_update_dt_tm, fac AS source, 'hl7v2' AS source_type, accid, 'I' AS patient_type_id, 'SVC' AS service_area_id,
 o_orderdate AS admitted, 'ER' AS adm_type, 'CHEST : Chest pain :  : ' AS complaint, fac AS unit_id, 'B' AS bed_id,
 date_trunc('day', o_orderdate) + INTERVAL '23 hours 59 minutes' AS discharged, 'HOME' AS discharged_to, 'FIN' AS fin_class,
 'ACT' AS acc_status, 'VIP' AS vip_flag, o_orderdate AS event_timestamp,
 {_provider('admitting', "'ADM' || n", 'Admit', 'Al')} AS adm_provider_id,
 {_provider('attending', "'ATT' || n", 'Attend', 'Ann', 'Q')} AS att_provider_id,
 NULL::VARCHAR AS ref_provider_id, NULL::VARCHAR AS related_provider_id, '01' AS discharge_disposition, 'ER' AS admit_source,
 CAST(o_orderkey AS VARCHAR) AS visit_number, 'PT' AS pat_type
FROM {PARSED} WHERE has_visit
""")
def hl7_account(spark, sf_dir):
    return hl7v2.hl7_account(_messages(spark, sf_dir))


@query("hl7_contacts", f"""
SELECT fac AS source, 'hl7v2' AS source_type, accid AS patient_id, '556-' || o_custkey AS business_phone_number_id,
 '555-' || o_custkey AS cell_phone_number_id, '555-' || o_custkey AS home_phone_number_id, o_custkey || ' Main St' AS street1,
 'Apt 2' AS street2, 'City ' || n AS city, 'KS' AS state, lpad(CAST(n AS VARCHAR), 5, '0') AS zip, 'US' AS country,
 o_orderdate AS event_timestamp FROM {PARSED}
""")
def hl7_contacts(spark, sf_dir):
    return hl7v2.hl7_contacts(_messages(spark, sf_dir))


@query("hl7_locations", f"""
SELECT fac AS source, accid AS patient_account_id, 'SVC' AS code, 'U' || n AS point_of_care, '12' AS room, 'B' AS bed, 'FAC' AS facility,
 'ST' AS location_status, 'TY' AS person_location_type, 'BL' AS building, 'FL' AS floor, 'Ward' AS description, 'U' || n AS unitcode FROM {PARSED}
""")
def hl7_locations(spark, sf_dir):
    return hl7v2.hl7_locations(_messages(spark, sf_dir))


@query("hl7_units", f"SELECT DISTINCT fac AS source, 'U' || n AS unitcode, fac AS facilid FROM {PARSED}")
def hl7_units(spark, sf_dir):
    return hl7v2.hl7_units(hl7v2.hl7_locations(_messages(spark, sf_dir)))


@query("hl7_procedures", f"""
SELECT fac AS source, accid AS patient_account_id, 1 AS seq, 'P' || n AS code, {_provider('practitioner', "'PRC' || n", 'Prac', 'Pru')} AS provider_id,
 'CPT' AS coding_method, 'Procedure one' AS description, o_orderdate AS event_timestamp, '1' AS procedure_priority,
 o_orderdate AS procedure_timestamp, 'T' AS procedure_type FROM {PARSED}
UNION ALL
SELECT fac, accid, 2, c_mktsegment, NULL, 'CPT', 'Procedure two', o_orderdate, NULL, NULL, 'T' FROM {PARSED}
""")
def hl7_procedures(spark, sf_dir):
    return hl7v2.hl7_procedures(_messages(spark, sf_dir))


@query("hl7_diagnoses", f"""
SELECT fac AS source, accid AS patient_account_id, 1 AS seq, 'D' || n AS code, {_provider('diagnosing', "'DGN' || n", 'Diag', 'Di')} AS provider_id,
 c_mktsegment AS description, '1' AS diagnosis_priority, date_trunc('day', o_orderdate)::TIMESTAMP AS diagnosis_timestamp,
 o_orderdate AS event_timestamp FROM {PARSED}
""")
def hl7_diagnoses(spark, sf_dir):
    return hl7v2.hl7_diagnoses(_messages(spark, sf_dir))


@query("hl7_medications", f"""
SELECT fac AS source, accid AS patient_account_id, o_orderdate AS start_date, o_orderdate AS stop_date, 'RX' || n AS code, 'NDC' AS code_system,
 'Drug' AS name, {_provider('med_ord', "'ORD' || n", 'Order', 'Oz')} AS provider_id, 'PO' AS route, price AS strength, 'BOX' AS packaging, '2' AS dosage FROM {PARSED}
UNION ALL SELECT fac, accid, NULL, NULL, 'RX2', 'NDC', 'Other', NULL, NULL, '5', 'BAG', '1' FROM {PARSED}
""")
def hl7_medications(spark, sf_dir):
    return hl7v2.hl7_medications(_messages(spark, sf_dir))


@query("hl7_allergies", f"""
SELECT o_orderdate AS index_update_dt_tm, fac AS source, 'hl7v2' AS source_type, c_mktsegment AS description, '1' AS code, 'DA' AS code_type,
 'Drug' AS description_type, 'SV' AS code_sev, 'Severe' AS description_sev, 'Hives' AS reaction, day_ AS reported_date, day_ AS onset_date,
 '' AS onset_date_text, NULL::VARCHAR AS code_relationship, NULL::VARCHAR AS description_relationship, NULL::VARCHAR AS code_status,
 NULL::VARCHAR AS description_status, NULL::VARCHAR AS status_reporter, NULL::VARCHAR AS reporter_organization, NULL::VARCHAR AS status_date,
 'GRP' AS allergen_group, accid AS patient_account_id, 'SEC' || n AS event_timestamp FROM {PARSED}
UNION ALL SELECT o_orderdate, fac, 'hl7v2', 'Nuts', '2', 'FA', 'Food', 'MI', 'Mild', NULL, day_, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, accid, 'SEC' || n FROM {PARSED}
""")
def hl7_allergies(spark, sf_dir):
    return hl7v2.hl7_allergies(_messages(spark, sf_dir))


@query("hl7_immunizations", f"""
SELECT o_orderdate AS index_update_dt_tm, fac AS source, accid AS patient_account_id, 'RN' || n AS performing_provider_id, '1' AS series_number,
 day_ AS administered_date, 'CVX' AS administered_code_id, 'SEC' || n AS event_timestamp FROM {PARSED}
""")
def hl7_immunizations(spark, sf_dir):
    return hl7v2.hl7_immunizations(_messages(spark, sf_dir))


@query("hl7_vaccinations", f"""
SELECT o_orderdate AS index_update_dt_tm, fac AS source, CAST(o_orderkey AS VARCHAR) AS immunization_id, 'V' || n AS vaccine_id,
 'MVX' AS vaccine_manufacturer_id, 'LOT' || n AS lot_number, 'given' AS vaccination_status_id, 'Maker' AS manufacturer_text,
 '0.5' AS dosage, 'ML' AS measure_unit_id, accid FROM {PARSED}
""")
def hl7_vaccinations(spark, sf_dir):
    return hl7v2.hl7_vaccinations(_messages(spark, sf_dir))


@query("hl7_insurance", f"""
SELECT fac AS source, accid, 1 AS seqnum, 'PL' || n AS planid, 'Plan' AS plan_name, c_mktsegment AS insurer, '1 Co St' AS co_addr1, '' AS co_addr2,
 'Town' AS co_city, 'KS' AS co_state, '66002' AS co_zip, 'US' AS co_country, 'Contact' AS contact_name, '800' AS co_phone, 'G' || n AS grpid,
 'GNAME' AS grpname, 'EMP' AS emplid, 'Employer' AS emplname, 'AUTH' AS auth_info, 'HMO' AS plan_type, 'POL' || o_orderkey AS policy_id,
 NULL::VARCHAR AS ins_prefix, 'Holder' AS ins_fname, NULL::VARCHAR AS ins_mname, c_mktsegment AS ins_lname, NULL::VARCHAR AS ins_suffix,
 'SELF' AS relationship, '2 In St' AS ins_addr1, '' AS ins_addr2, 'Ville' AS ins_city, 'KS' AS ins_state, '66003' AS ins_zip, 'US' AS ins_country,
 'a b.c' AS ins_email, strftime(o_orderdate, '%Y-%m-%d') AS eff_date, '2099-12-31' AS exp_date, '1970-01-01' AS ins_dob, {SSN} AS ins_ssn,
 o_orderdate AS event_timestamp, '555-' || o_custkey AS home_phone_number_id, '556-' || o_custkey AS business_phone_number_id FROM {PARSED}
""")
def hl7_insurance(spark, sf_dir):
    return hl7v2.hl7_insurance(_messages(spark, sf_dir))


@query("hl7_lab_tests", f"""
SELECT stamp AS index_update_dt_tm, fac AS source, 'RCV' || n || stamp || 'P' AS vault_based_id, 'PLC' || o_orderkey AS hl7_code, 'CBC' AS name,
 'Blood count' AS description, 'CBC' AS category_id, '1' AS sequence, accid FROM {PARSED}
""")
def hl7_lab_tests(spark, sf_dir):
    return hl7v2.hl7_lab_tests(_messages(spark, sf_dir))


@query("hl7_lab_results", f"""
WITH r AS (
 SELECT *, stamp AS t, 'NM' AS ty, '1' AS i, 'WBC' AS c1, 'White cells' AS c2, 'LN' AS c3, '6690-2' AS c4, 'WBC alt' AS c5, 'L' AS c6, 'LAB' AS x23, 'K/uL' AS u,
  '4-11' AS rg, price AS v, CASE WHEN o_orderpriority = '1-URGENT' THEN 'H' ELSE 'N' END AS ab, 'F' AS st, o_orderdate AS tm FROM {PARSED}
 UNION ALL SELECT *, stamp, 'ST', '2', 'NOTE', 'Comment', NULL, NULL, NULL, NULL, NULL, '', '', 'say -ok-', '', 'F', NULL FROM {PARSED}
 UNION ALL SELECT *, day_, 'NM', '1', 'HGB', 'Hemoglobin', NULL, NULL, NULL, NULL, NULL, 'g/dL', '', CAST(o_orderkey AS VARCHAR), '', 'P', NULL FROM {PARSED})
SELECT t AS index_update_dt_tm, fac AS source, 'RCV' || n || t || 'P' AS lab_id, ty AS obx_2_1, i AS accession_id, c1 AS laboratory_id, c2 AS obx_3_2,
 c3 AS obx_3_3, c4 AS obx_3_4, c5 AS obx_3_5, c6 AS obx_3_6, x23 AS obx_23_1, u AS unit, rg AS range, v AS value, ab AS abnormal, st AS status, tm AS time, accid FROM r
""")
def hl7_lab_results(spark, sf_dir):
    return hl7v2.hl7_lab_results(_messages(spark, sf_dir))


REGISTRY_SQL = "SELECT DISTINCT 'FAC' || n_nationkey AS source, 'ATT' || n_nationkey AS provcode, 'known-' || n_nationkey AS vid FROM nation WHERE n_regionkey = 1"


@query("hl7_providers", f"""
WITH roles AS (
 SELECT fac, 'PRC' || n AS code, 'Prac' AS l, 'Pru' AS f, '' AS m, 'practitioner' AS role FROM {PARSED}
 UNION SELECT fac, 'DGN' || n, 'Diag', 'Di', '', 'diagnosing' FROM {PARSED}
 UNION SELECT fac, 'ORD' || n, 'Order', 'Oz', '', 'med_ord' FROM {PARSED}
 UNION SELECT fac, 'ADM' || n, 'Admit', 'Al', '', 'admitting' FROM {PARSED} WHERE has_visit
 UNION SELECT fac, 'ATT' || n, 'Attend', 'Ann', 'Q', 'attending' FROM {PARSED} WHERE has_visit
 UNION SELECT fac, 'ROL' || n, 'Role', 'Ray', '', 'pcp' FROM {PARSED} WHERE o_orderpriority = '1-URGENT'
 UNION SELECT fac, 'PCP' || n, 'Primary', 'Pat', '', 'pcp' FROM {PARSED} WHERE o_orderpriority <> '1-URGENT')
SELECT fac AS source, 'Ward' AS source_type, code AS provcode, l AS lname, f AS fname, m AS mname, '' AS unitname, '' AS service, '' AS prov_type,
 role AS status, '' AS suffix, sha1(code || l || f || m || role) || '-' || code AS new_key,
 coalesce(vid, sha1(code || l || f || m || role) || '-' || code) AS vault_based_id, vid IS NULL AS is_new
FROM roles LEFT JOIN ({REGISTRY_SQL}) g ON fac = g.source AND code = g.provcode
""")
def hl7_providers(spark, sf_dir):
    return hl7v2.hl7_providers(_messages(spark, sf_dir), provider_registry(spark, sf_dir))


def provider_registry(spark, sf_dir):
    """Attending providers of a region, who are known before."""
    known = table(spark, sf_dir, "nation").filter("n_regionkey = 1")
    n = F.col("n_nationkey")
    return known.select(
        F.concat(F.lit("FAC"), n).alias("source"), F.concat(F.lit("ATT"), n).alias("provcode"), F.lit("Attend").alias("lname"),
        F.lit("Ann").alias("fname"), F.lit("Q").alias("mname"), F.lit("").alias("suffix"), F.concat(F.lit("known-"), n).alias("vault_based_id"),
    )
@query("hl7_pcp", f"""
SELECT fac AS source, accid AS patient_id, CASE WHEN o_orderpriority = '1-URGENT' THEN {_provider('pcp', "'ROL' || n", 'Role', 'Ray')}
 ELSE {_provider('pcp', "'PCP' || n", 'Primary', 'Pat')} END AS provider_id, o_orderdate AS event_timestamp FROM {PARSED}
""")
def hl7_pcp(spark, sf_dir):
    return hl7v2.hl7_pcp(_messages(spark, sf_dir))


def _length_sql(spark_free_template: str) -> str:
    """Length of the text of a message: what the template holds beside its marks, and the marks' values."""
    values = {
        "sender": "CASE WHEN n < 8 THEN '2.16.840.' || n ELSE 'NATION_' || n || ' ^site' END", "n": "n", "stamp": "stamp", "key": "o_orderkey",
        "version": VERSION, "cust": "o_custkey", "seg": "c_mktsegment", "born": "'19500101'", "sex": "CASE WHEN o_orderstatus = 'F' THEN 'Female' ELSE 'Male' END",
        "zip": "'00000'", "account": "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'AC' || o_orderkey END", "ssn": SSN, "day": "day_",
        "admitted": "CASE WHEN has_visit THEN stamp ELSE '' END", "price": "price", "flag": "'N'",
    }
    parts = re.split(r"\{(\w+)\}", spark_free_template)
    uses = Counter(parts[1::2])
    lines = spark_free_template.count("\r")
    sizes = " + ".join(f"{k} * length(CAST({values[name]} AS VARCHAR))" for name, k in uses.items())
    start = "CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 0 END"
    return f"CAST({sum(map(len, parts[::2]))} + {sizes} + {start} + CASE WHEN n = 9 THEN {lines} ELSE 0 END AS INTEGER)"


# Without a header the delimiters of a message are not known, so those of nation 7 give no account.
@query("hl7_message_log", f"""
SELECT file, CASE WHEN o_orderstatus = 'P' THEN 'Error: HL7 msg missing MSH seg' ELSE 'Success: all fields parsed' END AS status,
 CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {VERSION} END AS hl7_version,
 CASE WHEN o_orderstatus <> 'P' THEN 'ADT' END AS message_type, CASE WHEN o_orderstatus <> 'P' THEN 'A01' END AS event_code,
 'adt' || o_orderkey AS f_name, 'KS' AS f_state, fac AS f_facility, 'ptr' AS f_pointer, c_mktsegment AS f_pointer_value, day_ AS f_date,
 {_length_sql(TEMPLATE)} AS file_length,
 CASE WHEN o_orderstatus = 'P' AND n = 7 THEN sha1(file) || fac ELSE accid END AS accid_ref FROM ({BASE})
""")
def hl7_message_log(spark, sf_dir):
    return hl7v2.hl7_message_log(_messages(spark, sf_dir))


@query("hl7_links", f"""
SELECT file, table_name, seq FROM {PARSED}, (VALUES ('_patient_procedure', 1), ('_patient_procedure', 2), ('_patient_diagnosis', 1),
 ('_medication', NULL), ('_medication', NULL), ('_patient_allergy', 1), ('_patient_allergy', 2), ('_immunization', 1), ('_vaccination', 1),
 ('_patient_insurance', 1), ('_lab_test', 1), ('_lab_result', 1), ('_lab_result', 2), ('_lab_result', 1)) t(table_name, seq)
""")
def hl7_links(spark, sf_dir):
    return hl7v2.hl7_links(_messages(spark, sf_dir))


@query("new_facilities", f"""
SELECT fac AS f_facility, min(c_mktsegment) AS code FROM ({BASE}) WHERE n NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) GROUP BY fac
""")
def new_facilities(spark, sf_dir):
    known = table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.concat(F.lit("FAC"), F.col("n_nationkey")).alias("facility"))
    return hl7v2.new_facilities(_messages(spark, sf_dir), known)


OID_SQL = f"""
SELECT file, msh4, oid, CASE WHEN oid IS NULL THEN 'no OID for facility ' || msh4 END AS error FROM (
 SELECT file, CASE WHEN n < 8 THEN '2.16.840.' || n ELSE 'NATION_' || n || ' ^site' END AS msh4,
  CASE WHEN n < 8 THEN '2.16.840.' || n WHEN n_regionkey IN (0, 1) THEN '1.3.' || n WHEN n_regionkey = 2 THEN '1.4.' || n END AS oid
 FROM {PARSED} JOIN nation ON n = n_nationkey)
"""


def _resolved_oids(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    n, region = F.col("n_nationkey"), F.col("n_regionkey")
    crosswalk = nation.filter(region < 3).select(
        F.when(region < 2, F.col("n_name")).alias("name"), F.when(region == 2, F.col("n_name")).alias("mnemonic"),
        F.concat(F.when(region < 2, "1.3.").otherwise("1.4."), n).alias("oid"),
    )
    return hl7v2.resolve_msh4_oid(_messages(spark, sf_dir), crosswalk)


@query("resolve_msh4_oid", OID_SQL)
def resolve_msh4_oid(spark, sf_dir):
    return _resolved_oids(spark, sf_dir)


@query("one_per_oid", f"SELECT oid, min(file) AS file FROM ({OID_SQL}) WHERE oid IS NOT NULL GROUP BY oid")
def one_per_oid(spark, sf_dir):
    return hl7v2.one_per_oid(_resolved_oids(spark, sf_dir))


#: SQL of every table that is read from stored messages.
TABLES_SQL = {name: ORACLES[f"hl7_{name}"] for name in hl7v2.TABLES}
