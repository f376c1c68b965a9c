"""HL7 v2 messages to relational tables.

A message is one row. Its text is cut with ``split`` into segments, fields, repetitions and
components, and every table below is a filter and a projection of that row, so nothing is
shuffled; only the provider and facility registries join.

Field numbers follow the standard (MSH-1 is the separator itself, MSH-9 the message type). Where a
field repeats, the first repetition is read. A field past the end of a segment is null, an empty
one is the empty text. Double quotes are read as dashes.

Values carried from an earlier segment of the message (order time for results, route for
medications) come from cutting the text in front of the carrying segments: each piece starts with
the segment its rows inherit from.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .joins import lookup_with_fallback
from ..functions.dates import epoch_seconds, hl7_date, hl7_timestamp
from ..functions.rows import keep, rows_of
from ..functions.text import after_last, base_name, before, bracketed

SOURCE_TYPE = "hl7v2"

# Results written to the message log.
PARSED = "Success: all fields parsed"
NO_HEADER = "Error: HL7 msg missing MSH seg"
SEVERAL = "Error: several messages in the file, the last one taken"

# Provider roles with the segment and field that hold each one.
PROVIDER_ROLES = (
    ("anesthesiologist", "PR1", 8),
    ("surgeon", "PR1", 11),
    ("practitioner", "PR1", 12),
    ("diagnosing", "DG1", 16),
    ("med_pharm", "RXE", 14),
    ("med_ord", "RXE", 13),
    ("admitting", "PV1", 17),
    ("attending", "PV1", 7),
    ("referring", "PV1", 8),
    ("related", "PV1", 4),
    ("pcp", "ROL", 4),
    ("pcp", "PD1", 4),
)

# Table a repeating segment is linked to in the message log.
LINKED_TABLES = (
    ("PR1", "_patient_procedure"),
    ("DG1", "_patient_diagnosis"),
    ("RXE", "_medication"),
    ("AL1", "_patient_allergy"),
    ("RXA", "_immunization"),
    ("RXA", "_vaccination"),
    ("IN1", "_patient_insurance"),
    ("OBR", "_lab_test"),
    ("OBX", "_lab_result"),
)

# Kinds of segments of which the last one of a message counts.
SINGLE_KINDS = ("MSH", "EVN", "PID", "PV1", "PV2", "ROL", "PD1")

_HIDDEN = "\ue001\ue002\ue003"


# -- text to segments ---------------------------------------------------------------------------

def _with_canonical(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_text``: CR line ends and the standard delimiters. Other delimiters are read from
    the header (``_swapped``); standard ones occurring as data in such a message are hidden until
    ``_table`` restores them.

    Each step is its own column, so the text is rewritten once and not once per use."""
    raw = F.col(text)
    lines = F.replace(F.replace(raw, F.lit("\n"), F.lit("\r")), F.lit('"'), F.lit("-"))
    cleaned = df.withColumns(
        {"_c": lines, "has_header": F.startswith(raw, F.lit("MSH")), "_own": F.substring(raw, 4, 3)}
    )
    own, c = F.col("_own"), F.col("_c")
    swap = F.col("has_header") & (own != "|^~")
    swapped = F.call_function("translate", c, F.concat(own, F.lit("|^~")), F.lit("|^~" + _HIDDEN))
    return cleaned.withColumns({"_swapped": swap, "_text": F.when(swap, swapped).otherwise(c)}).drop("_c", "_own")


def _plain(value: Column) -> Column:
    """Hidden delimiters put back."""
    return reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), zip(_HIDDEN, "|^~"), value)


def _headed(messages: DataFrame) -> DataFrame:
    return keep(messages, F.col("has_header"))


def _table(rows: DataFrame, *cols) -> DataFrame:
    """Selects ``cols`` and puts hidden delimiters back in the texts of messages that had any.

    Values are read and put back in one projection, which a projection of the whole table can take in."""
    values = [F.col(c) if isinstance(c, str) else c for c in cols]
    made = [
        (F.when(F.col("_swapped"), _plain(value)).otherwise(value) if kind == "string" else value).alias(name)
        for value, (name, kind) in zip(values, rows.select(*cols).dtypes, strict=True)
    ]
    return rows.select(*made)


def _fields(segment: Column) -> Column:
    return F.split(segment, "\\|")


def _whole(kind: str) -> str:
    """The column of the whole text of the last segment of a kind."""
    return f"_{kind.lower()}_whole"


def _single(kind: str) -> Column:
    """Fields of the last segment of a kind, split where they are read: a text goes through generators and
    between projections at a fraction of the cost of a list."""
    return _fields(F.col(_whole(kind)))


def field(fields: Column, n: int) -> Column:
    """Whole field ``n`` of a split segment (not the header segment)."""
    return F.try_element_at(fields, F.lit(n + 1))


def comp(fields: Column, n: int, c: int = 1) -> Column:
    """Component ``c`` of the first repetition of field ``n``."""
    first = F.substring_index(F.try_element_at(fields, F.lit(n + 1)), "~", 1)
    return F.substring_index(first, "^", 1) if c == 1 else F.try_element_at(F.split(first, "\\^"), F.lit(c))


def head(fields: Column, n: int, c: int = 1) -> Column:
    """Component of a header field in standard numbering (``n`` > 1)."""
    return comp(fields, n - 1, c)


def hl7_filename(df: DataFrame, file: str = "file") -> DataFrame:
    """Fields of a ``name[state]facility[ptr]value[..]_date.ext`` file name, which may stand behind
    folders; null for plain names."""
    name = base_name(F.col(file))
    structured = F.contains(name, F.lit("["))
    values = {
        "f_name": before(name, "["),
        "f_state": bracketed(name, 1),
        "f_facility": bracketed(name, 2),
        "f_pointer": after_last(F.substring_index(name, "[", 3), "]"),
        "f_pointer_value": F.left(bracketed(name, 3), F.lit(180)),
        "f_date": before(after_last(after_last(name, "]"), "_"), "."),
    }
    return df.withColumns({k: F.when(structured, v) for k, v in values.items()})


def hl7_messages(df: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """One row per message: file-name fields, canonical text, segments, and the split header and
    patient-level segments (the last of a kind). ``accid_ref`` is the visit key."""
    named = _with_canonical(hl7_filename(df, file), text)
    segments = F.filter(F.split("_text", "\r"), lambda s: F.length(s) > 0)
    cut = named.withColumn("_segments", segments)
    # The beginnings are cut once, not compared segment by segment for each kind.
    turned = cut.withColumns({"_back": F.reverse("_segments"), "_starts": F.transform(F.reverse("_segments"), lambda s: F.left(s, F.lit(4)))})

    def last(name: str) -> Column:
        return F.get("_back", (F.array_position("_starts", name + "|") - 1).cast("int"))

    whole = turned.withColumns({_whole(n): last(n) for n in SINGLE_KINDS}).drop("_back", "_starts")
    split = whole.withColumns({f"_{n.lower()}": _single(n) for n in SINGLE_KINDS})
    pid, pv1 = _single("PID"), _single("PV1")
    account, admitted = comp(pid, 18), comp(pv1, 44)
    keyed = F.coalesce(F.length(account) > 1, F.lit(False))
    timed = F.coalesce(F.length(admitted) > 0, F.lit(False))
    visit = F.concat(
        F.when(keyed, account).otherwise(epoch_seconds(hl7_timestamp(admitted)).cast("string")),
        comp(pid, 3),
        F.col("f_facility"),
    )
    hashed = F.concat(F.sha1(F.col(file)), F.col("f_facility"))
    return split.withColumns(
        {
            "accid_ref": F.when(keyed | timed, visit).otherwise(hashed),
            "has_visit": keyed | timed,
            "event_time": hl7_timestamp(comp(_single("EVN"), 2)),
        }
    )


def hl7_segments(df: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """Long table of segments: file, number in the message, name, fields (delimiters in the data
    of messages with other delimiters are still hidden; ``hl7_fields`` restores them)."""
    messages = _headed(_with_canonical(df, text))
    segments = F.filter(F.split("_text", "\r"), lambda s: F.length(s) > 0)
    lines = rows_of(messages.select(file, "_swapped", "_text"), segments, "_s", "_i")
    return lines.select(
        file, (F.col("_i") + 1).alias("seg_no"), F.left("_s", F.lit(3)).alias("seg"), _fields(F.col("_s")).alias("fields"),
        "_swapped",
    )


def hl7_fields(df: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """Long table of component values with field, repetition and component numbers."""
    rows = rows_of(hl7_segments(df, text, file), F.col("fields"), "_f", "_i").drop("fields")
    numbered = rows.filter("_i > 0").withColumn(
        "field_no", F.when(F.col("seg") == "MSH", F.col("_i") + 1).otherwise(F.col("_i"))
    )
    header = (F.col("seg") == "MSH") & (F.col("field_no") == 2)
    reps = rows_of(numbered, F.when(header, F.array("_f")).otherwise(F.split("_f", "~")), "_rep", "_r")
    header = (F.col("seg") == "MSH") & (F.col("field_no") == 2)
    parts = rows_of(reps, F.when(header, F.array("_rep")).otherwise(F.split("_rep", "\\^")), "value", "_c")
    return _table(
        parts,
        file, "seg_no", "seg", "field_no", (F.col("_r") + 1).alias("repetition"), (F.col("_c") + 1).alias("component"), "value",
    )


def _of_kinds(*kinds: str) -> Column:
    """The segments of these kinds, in order."""

    def is_one(segment: Column) -> Column:
        return reduce(Column.__or__, [F.startswith(segment, F.lit(kind + "|")) for kind in kinds])

    return F.filter("_segments", is_one)


def _kept(*kinds: str) -> str:
    """The column of these kinds in stored messages."""
    return "segments_" + "_".join(kind.lower() for kind in kinds)


def _lines(messages: DataFrame, *kinds: str) -> Column:
    """The segments of these kinds, from their own column where the messages are stored."""
    return F.col(_kept(*kinds)) if _kept(*kinds) in messages.columns else _of_kinds(*kinds)


def _repeating(messages: DataFrame, name: str) -> DataFrame:
    """One row per segment of a kind, the segment in ``_s``."""
    return rows_of(messages, _lines(messages, name), "_s")


def _after(messages: DataFrame, carrier: str, least_fields: int, name: str) -> DataFrame:
    """Like ``_repeating``, with the latest ``carrier`` segment in front of the segment as
    ``_carrier`` and the number of the segment since then as ``_since``. Carriers too
    short to hold the inherited field do not replace an earlier one."""
    mark = "(?=\r" + carrier + r"(?:\|[^|\r]*){" + str(least_fields) + "})"
    text = F.array_join(_lines(messages, carrier, name), "\r")
    pieces = rows_of(messages, F.split(F.concat(F.lit("\r"), text), mark), "_piece")
    lines = F.filter(F.split("_piece", "\r"), lambda s: F.length(s) > 0)
    cut = pieces.withColumn("_lines", lines)
    first = F.try_element_at("_lines", F.lit(1))
    carried = F.when(F.startswith(first, F.lit(carrier + "|")), first)
    wanted = F.filter("_lines", lambda s: F.startswith(s, F.lit(name + "|")))
    return rows_of(cut.withColumn("_carrier", carried), wanted, "_s", "_since")


def _number(value: Column) -> Column:
    """Leading whole number of a text."""
    return F.regexp_extract(value, r"^\s*(\d+)", 1).try_cast("int")


# -- message level ------------------------------------------------------------------------------

def hl7_identity(messages: DataFrame, file: str = "file") -> DataFrame:
    """Keys for identity resolution."""
    pid = _single("PID")
    return _table(
        _headed(messages),
        F.col(file), comp(pid, 5, 1).alias("lastname"), comp(pid, 5, 2).alias("firstname"),
        F.left(comp(pid, 8), F.lit(1)).alias("sex"), hl7_date(comp(pid, 7)).alias("dob"), comp(pid, 19).alias("ssn"),
    )


def hl7_person(messages: DataFrame) -> DataFrame:
    """Person registration rows. The birth date is null when PID-7 is no date."""
    pid = _single("PID")
    return _table(
        _headed(messages),
        F.col("f_facility").alias("source"),
        F.lit(SOURCE_TYPE).alias("source_type"),
        hl7_date(comp(pid, 7)).alias("dob"),
        comp(pid, 22).alias("ethnicity"),
        F.col("event_time").alias("event_timestamp"),
        comp(pid, 5, 2).alias("firstname"),
        comp(pid, 15).alias("language"),
        comp(pid, 5, 1).alias("lastname"),
        comp(pid, 16, 2).alias("marital_status"),
        comp(pid, 30).alias("deceased"),
        comp(pid, 5, 3).alias("middlename"),
        comp(pid, 6).alias("mother_maiden_name"),
        comp(pid, 3).alias("mrn"),
        comp(pid, 5, 5).alias("prefix"),
        comp(pid, 10).alias("race"),
        comp(pid, 17).alias("religion"),
        F.left(comp(pid, 8), F.lit(1)).alias("sex"),
        comp(pid, 19).alias("ssn"),
        comp(pid, 5, 4).alias("suffix"),
        comp(_single("EVN"), 2).alias("updated"),
        comp(pid, 3, 4).alias("assigning_authority"),
        "accid_ref",
    )


def hl7_account(messages: DataFrame) -> DataFrame:
    """Visit rows, only for messages with an account number or an admit time."""
    pv1, pv2 = _single("PV1"), _single("PV2")
    complaint = F.concat_ws(" : ", *[F.coalesce(comp(pv2, 3, i), F.lit("")) for i in range(1, 5)])
    provider = {r: provider_key(messages, r, pv1, n) for r, s, n in PROVIDER_ROLES if s == "PV1"}
    return _table(
        keep(_headed(messages), F.col("has_visit")),
        F.col("event_time").alias("index_update_dt_tm"),
        F.col("f_facility").alias("source"),
        F.lit(SOURCE_TYPE).alias("source_type"),
        F.col("accid_ref").alias("accid"),
        comp(pv1, 2).alias("patient_type_id"),
        comp(pv1, 10).alias("service_area_id"),
        hl7_timestamp(comp(pv1, 44)).alias("admitted"),
        comp(pv1, 14).alias("adm_type"),
        complaint.alias("complaint"),
        F.col("f_facility").alias("unit_id"),
        comp(pv1, 3, 3).alias("bed_id"),
        hl7_timestamp(comp(pv1, 45)).alias("discharged"),
        comp(pv1, 37).alias("discharged_to"),
        comp(pv1, 20).alias("fin_class"),
        comp(pv1, 41).alias("acc_status"),
        comp(pv1, 16).alias("vip_flag"),
        F.col("event_time").alias("event_timestamp"),
        provider["admitting"].alias("adm_provider_id"),
        provider["attending"].alias("att_provider_id"),
        provider["referring"].alias("ref_provider_id"),
        provider["related"].alias("related_provider_id"),
        comp(pv1, 36).alias("discharge_disposition"),
        comp(pv1, 14).alias("admit_source"),
        comp(pv1, 19).alias("visit_number"),
        comp(pv1, 18).alias("pat_type"),
    )


def hl7_contacts(messages: DataFrame) -> DataFrame:
    """Contact rows. The second street line is PID-11.2."""
    pid = _single("PID")
    return _table(
        _headed(messages),
        F.col("f_facility").alias("source"),
        F.lit(SOURCE_TYPE).alias("source_type"),
        F.col("accid_ref").alias("patient_id"),
        comp(pid, 14).alias("business_phone_number_id"),
        comp(pid, 13).alias("cell_phone_number_id"),
        comp(pid, 13).alias("home_phone_number_id"),
        comp(pid, 11, 1).alias("street1"),
        comp(pid, 11, 2).alias("street2"),
        comp(pid, 11, 3).alias("city"),
        comp(pid, 11, 4).alias("state"),
        comp(pid, 11, 5).alias("zip"),
        comp(pid, 11, 6).alias("country"),
        F.col("event_time").alias("event_timestamp"),
    )


def hl7_locations(messages: DataFrame) -> DataFrame:
    """Service-area rows; ``unitcode`` is also the key of the unit row."""
    pv1 = _single("PV1")
    parts = ("point_of_care", "room", "bed", "facility", "location_status", "person_location_type", "building", "floor", "description")
    return _table(
        _headed(messages),
        F.col("f_facility").alias("source"),
        F.col("accid_ref").alias("patient_account_id"),
        comp(pv1, 10).alias("code"),
        *[comp(pv1, 3, i + 1).alias(name) for i, name in enumerate(parts)],
        comp(pv1, 3, 1).alias("unitcode"),
    )


def hl7_units(locations: DataFrame) -> DataFrame:
    """Distinct unit rows of the service areas."""
    return locations.filter(F.col("unitcode").isNotNull()).select(
        "source", "unitcode", F.col("source").alias("facilid")
    ).distinct()


# -- repeating segments -------------------------------------------------------------------------

def hl7_procedures(messages: DataFrame) -> DataFrame:
    f = _fields(F.col("_s"))
    rows = _repeating(_headed(messages), "PR1")
    who = F.coalesce(*[provider_key(rows, r, f, n) for r, n in (("practitioner", 12), ("surgeon", 11), ("anesthesiologist", 8))])
    return _table(
        rows,
        F.col("f_facility").alias("source"), F.col("accid_ref").alias("patient_account_id"),
        _number(comp(f, 1)).alias("seq"), comp(f, 3).alias("code"), who.alias("provider_id"),
        comp(f, 2).alias("coding_method"), comp(f, 4).alias("description"),
        F.col("event_time").alias("event_timestamp"), comp(f, 14).alias("procedure_priority"),
        hl7_timestamp(comp(f, 5)).alias("procedure_timestamp"), comp(f, 6).alias("procedure_type"),
    )


def hl7_diagnoses(messages: DataFrame) -> DataFrame:
    f = _fields(F.col("_s"))
    rows = _repeating(_headed(messages), "DG1")
    return _table(
        rows,
        F.col("f_facility").alias("source"), F.col("accid_ref").alias("patient_account_id"),
        _number(comp(f, 1)).alias("seq"), comp(f, 3).alias("code"),
        provider_key(rows, "diagnosing", f, 16).alias("provider_id"), comp(f, 4).alias("description"),
        comp(f, 15).alias("diagnosis_priority"), hl7_timestamp(comp(f, 5)).alias("diagnosis_timestamp"),
        F.col("event_time").alias("event_timestamp"),
    )


def hl7_medications(messages: DataFrame) -> DataFrame:
    """The route comes from the RXO in front of the RXE, for the first RXE after it."""
    f = _fields(F.col("_s"))
    rows = _after(_headed(messages), "RXO", 10, "RXE")
    return _table(
        rows,
        F.col("f_facility").alias("source"), F.col("accid_ref").alias("patient_account_id"),
        hl7_timestamp(comp(f, 1, 4)).alias("start_date"), hl7_timestamp(comp(f, 1, 5)).alias("stop_date"),
        comp(f, 2, 1).alias("code"), comp(f, 2, 3).alias("code_system"), comp(f, 2, 2).alias("name"),
        provider_key(rows, "med_ord", f, 13).alias("provider_id"),
        F.when(F.col("_since") == 0, comp(_fields(F.col("_carrier")), 10)).alias("route"),
        comp(f, 10).alias("strength"), comp(f, 11).alias("packaging"), comp(f, 1, 2).alias("dosage"),
    )


def hl7_allergies(messages: DataFrame) -> DataFrame:
    """AL1 rows with a set id; empty fields fall back to the IAM segment in front."""
    f = _fields(F.col("_s"))
    rows = _after(_headed(messages), "IAM", 1, "AL1").filter(F.length(comp(f, 1)) > 0)
    iam = F.when(F.col("_since") == 0, _fields(F.col("_carrier")))

    def either(n: int, c: int, n2: int, c2: int) -> Column:
        return F.when(F.length(comp(f, n, c)) > 0, comp(f, n, c)).otherwise(comp(iam, n2, c2))

    reporter = F.concat(comp(iam, 14, 2), F.lit(", "), comp(iam, 14, 3), F.lit(" "), comp(iam, 14, 4))
    return _table(
        rows,
        F.col("event_time").alias("index_update_dt_tm"), F.col("f_facility").alias("source"),
        F.lit(SOURCE_TYPE).alias("source_type"), either(3, 2, 3, 2).alias("description"),
        comp(f, 1).alias("code"), either(2, 1, 2, 1).alias("code_type"), either(2, 2, 2, 2).alias("description_type"),
        either(4, 1, 4, 1).alias("code_sev"), either(4, 2, 4, 2).alias("description_sev"),
        either(5, 1, 5, 1).alias("reaction"), either(6, 1, 13, 1).alias("reported_date"),
        comp(iam, 11).alias("onset_date"), comp(iam, 12).alias("onset_date_text"),
        comp(iam, 15, 1).alias("code_relationship"), comp(iam, 15, 2).alias("description_relationship"),
        comp(iam, 17, 1).alias("code_status"), comp(iam, 17, 2).alias("description_status"),
        reporter.alias("status_reporter"), comp(iam, 19).alias("reporter_organization"),
        comp(iam, 20).alias("status_date"), comp(iam, 10).alias("allergen_group"),
        F.col("accid_ref").alias("patient_account_id"), head(_single("MSH"), 8).alias("event_timestamp"),
    )


def hl7_immunizations(messages: DataFrame) -> DataFrame:
    f = _fields(F.col("_s"))
    return _table(
        _repeating(_headed(messages), "RXA"),
        F.col("event_time").alias("index_update_dt_tm"), F.col("f_facility").alias("source"),
        F.col("accid_ref").alias("patient_account_id"), comp(f, 10).alias("performing_provider_id"),
        comp(f, 2).alias("series_number"), comp(f, 3).alias("administered_date"),
        comp(f, 5).alias("administered_code_id"), head(_single("MSH"), 8).alias("event_timestamp"),
    )


def hl7_vaccinations(messages: DataFrame) -> DataFrame:
    f = _fields(F.col("_s"))
    return _table(
        _repeating(_headed(messages), "RXA"),
        F.col("event_time").alias("index_update_dt_tm"), F.col("f_facility").alias("source"),
        comp(f, 5, 4).alias("immunization_id"), comp(f, 5, 5).alias("vaccine_id"),
        comp(f, 17, 1).alias("vaccine_manufacturer_id"), comp(f, 14, 2).alias("lot_number"),
        comp(f, 9, 2).alias("vaccination_status_id"), comp(f, 17, 2).alias("manufacturer_text"),
        comp(f, 6).alias("dosage"), comp(f, 7).alias("measure_unit_id"), F.col("accid_ref").alias("accid"),
    )


# Insurance columns with the IN1 field and component of each one.
INSURANCE_FIELDS = (
    ("planid", 2, 1), ("plan_name", 2, 2), ("insurer", 4, 1), ("co_addr1", 5, 1), ("co_addr2", 5, 2),
    ("co_city", 5, 3), ("co_state", 5, 4), ("co_zip", 5, 5), ("co_country", 5, 6), ("contact_name", 6, 1),
    ("co_phone", 7, 1), ("grpid", 9, 3), ("grpname", 9, 1), ("emplid", 10, 1), ("emplname", 11, 1),
    ("auth_info", 14, 1), ("plan_type", 15, 1), ("policy_id", 36, 1), ("ins_prefix", 16, 5),
    ("ins_fname", 16, 2), ("ins_mname", 16, 3), ("ins_lname", 16, 1), ("ins_suffix", 16, 4),
    ("relationship", 17, 1), ("ins_addr1", 19, 1), ("ins_addr2", 19, 2), ("ins_city", 19, 3),
    ("ins_state", 19, 4), ("ins_zip", 19, 5), ("ins_country", 19, 6), ("ins_email", 7, 4),
)


def hl7_insurance(messages: DataFrame) -> DataFrame:
    f, pid = _fields(F.col("_s")), _single("PID")
    return _table(
        _repeating(_headed(messages), "IN1"),
        F.col("f_facility").alias("source"), F.col("accid_ref").alias("accid"), _number(comp(f, 1)).alias("seqnum"),
        *[comp(f, n, c).alias(name) for name, n, c in INSURANCE_FIELDS],
        hl7_date(comp(f, 12)).alias("eff_date"), hl7_date(comp(f, 13)).alias("exp_date"),
        hl7_date(comp(f, 18)).alias("ins_dob"), comp(pid, 19).alias("ins_ssn"),
        F.col("event_time").alias("event_timestamp"), comp(pid, 13).alias("home_phone_number_id"),
        comp(pid, 14).alias("business_phone_number_id"),
    )


def _lab_id(order_time: Column) -> Column:
    return F.concat(head(_single("MSH"), 5), order_time, head(_single("MSH"), 11))


def hl7_lab_tests(messages: DataFrame) -> DataFrame:
    """Orders whose OBR-4.1 has more than one character."""
    f = _fields(F.col("_s"))
    return _table(
        _repeating(_headed(messages), "OBR").filter(F.length(comp(f, 4)) > 1),
        comp(f, 7).alias("index_update_dt_tm"), F.col("f_facility").alias("source"),
        _lab_id(comp(f, 7)).alias("vault_based_id"), comp(f, 2).alias("hl7_code"), comp(f, 4).alias("name"),
        comp(f, 4, 2).alias("description"), comp(f, 4).alias("category_id"), comp(f, 1).alias("sequence"),
        F.col("accid_ref").alias("accid"),
    )


def hl7_lab_results(messages: DataFrame) -> DataFrame:
    """Results with the time of the order in front of them."""
    f = _fields(F.col("_s"))
    order_time = comp(_fields(F.col("_carrier")), 7)
    return _table(
        _after(_headed(messages), "OBR", 7, "OBX"),
        order_time.alias("index_update_dt_tm"), F.col("f_facility").alias("source"),
        _lab_id(order_time).alias("lab_id"), comp(f, 2).alias("obx_2_1"), comp(f, 1).alias("accession_id"),
        comp(f, 3, 1).alias("laboratory_id"), comp(f, 3, 2).alias("obx_3_2"), comp(f, 3, 3).alias("obx_3_3"),
        comp(f, 3, 4).alias("obx_3_4"), comp(f, 3, 5).alias("obx_3_5"), comp(f, 3, 6).alias("obx_3_6"),
        comp(f, 23).alias("obx_23_1"), comp(f, 6).alias("unit"), comp(f, 7).alias("range"),
        comp(f, 5).alias("value"), comp(f, 8).alias("abnormal"), comp(f, 11).alias("status"),
        hl7_timestamp(comp(f, 14)).alias("time"), F.col("accid_ref").alias("accid"),
    )


# -- providers ----------------------------------------------------------------------------------

# Parts of the digest of a new provider, in order.
PROVIDER_KEY_PARTS = ("provcode", "lname", "fname", "mname", "unitname", "service", "prov_type", "status", "suffix")


def _provider_fields(role: str, fields: Column, n: int) -> dict[str, Column]:
    part = lambda c: F.trim(F.coalesce(comp(fields, n, c), F.lit("")))
    values = {
        "provcode": part(1), "lname": part(2), "fname": part(3), "mname": part(4), "prov_type": part(7),
        "suffix": part(5), "unitname": F.trim(F.coalesce(comp(_single("PV1"), 1), F.lit(""))),
        "service": F.lit(""), "status": F.lit(role),
    }
    return {name: values[name] for name in PROVIDER_KEY_PARTS}


def provider_key(messages: DataFrame, role: str, fields: Column, n: int) -> Column:
    """Key a provider gets when not registered before; null when code and names are all empty."""
    v = _provider_fields(role, fields, n)
    named = F.length(F.concat(v["provcode"], v["lname"], v["fname"], v["mname"], v["suffix"])) > 0
    return F.when(named, F.concat(F.sha1(_plain(F.concat(*v.values()))), F.lit("-"), v["provcode"]))


def hl7_providers(messages: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Distinct providers of all roles with their key, from one pass over the messages: every
    provider field of a message becomes a (role, text) pair, and the pairs are exploded.

    ``registry`` (source, provcode, lname, fname, mname, suffix, vault_based_id) gives the key of
    providers known before; the others keep their new key and ``is_new`` is set.
    """
    def pair(role: str, value: Column) -> Column:
        return F.struct(F.lit(role).alias("status"), value.alias("_text"))

    def pairs_of(segment: str) -> Column:
        mine = [(role, n) for role, s, n in PROVIDER_ROLES if s == segment]
        split = F.transform(_lines(messages, segment), _fields)
        return F.flatten(F.transform(split, lambda f: F.array(*[pair(role, field(f, n)) for role, n in mine])))

    is_25 = F.coalesce(head(_single("MSH"), 12) == "2.5", F.lit(False))
    single, repeated = [], [pairs_of(segment) for segment in ("PR1", "DG1", "RXE")]
    for role, segment, n in PROVIDER_ROLES:
        if segment in ("PR1", "DG1", "RXE"):
            continue
        value = field(_single(segment), n)
        if segment == "PV1":
            value = F.when(F.col("has_visit"), value)
        elif segment == "ROL":
            value = F.when(is_25, value)
        else:
            value = F.when(~is_25, value)
        single.append(pair(role, value))
    pairs = F.filter(F.concat(F.array(*single), *repeated), lambda p: F.length(p["_text"]) > 0)
    pv1 = _single("PV1")
    rows = _headed(messages).select(
        F.trim(F.coalesce("f_facility", F.lit(""))).alias("source"),
        F.trim(F.coalesce(comp(pv1, 3, 9), F.lit(""))).alias("source_type"),
        F.trim(F.coalesce(comp(pv1, 1), F.lit(""))).alias("unitname"),
        "_swapped",
        F.inline_outer(pairs),
    ).filter(F.col("_text").isNotNull()).distinct()
    parts = rows.withColumn("_p", F.split(F.substring_index("_text", "~", 1), "\\^"))
    part = lambda c: F.trim(F.coalesce(F.try_element_at("_p", F.lit(c)), F.lit("")))
    named = {"provcode": 1, "lname": 2, "fname": 3, "mname": 4, "prov_type": 7, "suffix": 5}
    split = _table(
        parts,
        "source", "source_type", "unitname", F.lit("").alias("service"), "status",
        *[part(c).alias(name) for name, c in named.items()],
    )
    nonempty = F.length(F.concat("provcode", "lname", "fname", "mname", "suffix")) > 0
    digest = F.sha1(F.concat(*PROVIDER_KEY_PARTS))
    found = (
        split.filter(nonempty)
        .withColumn("new_key", F.concat(digest, F.lit("-"), F.col("provcode")))
        .distinct()
    )
    keys = ["source", "provcode", "lname", "fname", "mname", "suffix"]
    if registry is None:
        return found.withColumns({"vault_based_id": F.col("new_key"), "is_new": F.lit(True)})
    known = registry.groupBy(*keys).agg(F.max("vault_based_id").alias("_known"))
    return found.join(known, keys, "left").withColumns(
        {"vault_based_id": F.coalesce("_known", "new_key"), "is_new": F.col("_known").isNull()}
    ).drop("_known")


def with_registered_provider(rows: DataFrame, providers: DataFrame, col: str = "provider_id") -> DataFrame:
    """Replaces new keys in ``rows`` by the registered ones."""
    keys = providers.groupBy("source", F.col("new_key").alias(col)).agg(F.max("vault_based_id").alias("_key"))
    return rows.join(keys, ["source", col], "left").withColumn(col, F.coalesce("_key", col)).drop("_key")


def hl7_pcp(messages: DataFrame) -> DataFrame:
    """Link from the patient to the primary care provider (ROL-4 in version 2.5, else PD1-4)."""
    rol, pd1 = _single("ROL"), _single("PD1")
    is_25 = F.coalesce(head(_single("MSH"), 12) == "2.5", F.lit(False))
    code = F.when(is_25, comp(rol, 4)).otherwise(comp(pd1, 4))
    key = F.when(is_25, provider_key(messages, "pcp", rol, 4)).otherwise(provider_key(messages, "pcp", pd1, 4))
    return _table(
        keep(_headed(messages), code.isNotNull()),
        F.col("f_facility").alias("source"), F.col("accid_ref").alias("patient_id"), key.alias("provider_id"),
        F.col("event_time").alias("event_timestamp"),
    )


# -- logs and registries ------------------------------------------------------------------------

def hl7_message_log(messages: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """One row per file with what became of it. A file is one message; the log tells of files that hold
    several, of which the last header and patient count."""
    msh = _single("MSH")
    stored = _LENGTH in messages.columns
    headers = F.col(_HEADERS) if stored else _count_of_headers()
    length = F.col(_LENGTH) if stored else F.length(text)
    status = F.when(~F.col("has_header"), NO_HEADER).when(headers > 1, SEVERAL).otherwise(PARSED)
    return _table(
        messages,
        F.col(file), status.alias("status"),
        head(msh, 12).alias("hl7_version"), head(msh, 9, 1).alias("message_type"), head(msh, 9, 2).alias("event_code"),
        "f_name", "f_state", "f_facility", "f_pointer", "f_pointer_value", "f_date",
        length.alias("file_length"), "accid_ref",
    )


def _count_of_headers() -> Column:
    return F.size(F.filter("_segments", lambda s: F.startswith(s, F.lit("MSH"))))


def _linked_heads() -> Column:
    """The beginnings, up to the fourth field, of the segments that are linked to a table."""
    kinds = list(dict.fromkeys(seg for seg, _ in LINKED_TABLES))
    mine = F.filter("_segments", lambda s: F.left(s, F.lit(3)).isin(*kinds))
    return F.transform(mine, lambda s: F.substring_index(s, "|", 5))


def hl7_links(messages: DataFrame, file: str = "file") -> DataFrame:
    """One row per repeating row written, with the table and the set id."""
    tables = F.create_map(*[
        x for seg in dict.fromkeys(s for s, _ in LINKED_TABLES)
        for x in (F.lit(seg), F.array(*[F.lit(t) for s, t in LINKED_TABLES if s == seg]))
    ])
    heads = F.col(_HEADS) if _HEADS in messages.columns else _linked_heads()
    rows = rows_of(_headed(messages).select(file, heads.alias("_heads")), F.col("_heads"), "_s").drop("_heads")
    split = rows.withColumns({"_seg": F.left("_s", F.lit(3)), "_f": _fields(F.col("_s"))})
    first = comp(F.col("_f"), 1)
    written = F.when(F.col("_seg") == "OBR", F.length(comp(F.col("_f"), 4)) > 1).when(
        F.col("_seg") == "AL1", F.length(first) > 0
    ).otherwise(F.lit(True))
    seq = F.when(F.col("_seg") == "RXE", F.lit(None)).when(F.col("_seg") == "RXA", _number(comp(F.col("_f"), 2))).otherwise(_number(first))
    return (
        split.filter(written)
        .select(file, F.explode(F.try_element_at(tables, F.col("_seg"))).alias("table_name"), seq.alias("seq"))
    )


def new_facilities(messages: DataFrame, facilities: DataFrame) -> DataFrame:
    """Facilities named in file names that are not registered yet, one row each."""
    seen = messages.filter(F.col("f_facility").isNotNull()).groupBy("f_facility").agg(F.min("f_pointer_value").alias("code"))
    return seen.join(facilities.select(F.col("facility").alias("f_facility")).distinct(), "f_facility", "left_anti")


def valid_oid(col: Column) -> Column:
    """Digits and dots, at least two nodes, no leading zeros, first node 0, 1 or 2, second node at
    most 39 below 0 and 1, at most 128 characters."""
    pattern = r"^(?:[01]\.(?:[0-9]|[123][0-9])|2\.(?:0|[1-9][0-9]*))(?:\.(?:0|[1-9][0-9]*))*$"
    return F.coalesce((F.length(col) <= 128) & F.rlike(col, F.lit(pattern)), F.lit(False))


def resolve_msh4_oid(messages: DataFrame, crosswalk: DataFrame, file: str = "file") -> DataFrame:
    """OID of the sending facility: MSH-4 itself when it is one, else by facility name, else by
    mnemonic. ``crosswalk`` has ``name``, ``mnemonic``, ``oid``. Unresolved rows carry an error."""
    msh4 = F.col("msh4")
    base = _table(_headed(messages), F.col(file), field(_single("MSH"), 3).alias("msh4"))
    key = F.trim(F.substring_index(msh4, "^", 1))
    names = crosswalk.select(F.trim("name").alias("key"), F.col("oid").alias("value"))
    mnemonics = crosswalk.select(F.trim("mnemonic").alias("key"), F.col("oid").alias("value"))
    found = lookup_with_fallback(base, key, names, mnemonics, "_oid")
    return found.select(
        file, "msh4",
        F.when(valid_oid(msh4), msh4).otherwise(F.col("_oid")).alias("oid"),
    ).withColumn(
        "error", F.when(F.col("oid").isNull(), F.concat(F.lit("no OID for facility "), F.coalesce("msh4", F.lit(""))))
    )


def one_per_oid(resolved: DataFrame, file: str = "file") -> DataFrame:
    """One message per distinct OID (the least file name)."""
    return resolved.filter(F.col("oid").isNotNull()).groupBy("oid").agg(F.min(file).alias(file))


# -- one pass for all tables ---------------------------------------------------------------------

#: Tables that are read from parsed messages alone.
TABLES = {
    "identity": hl7_identity, "person": hl7_person, "account": hl7_account, "contacts": hl7_contacts, "locations": hl7_locations,
    "procedures": hl7_procedures, "diagnoses": hl7_diagnoses, "medications": hl7_medications, "allergies": hl7_allergies,
    "immunizations": hl7_immunizations, "vaccinations": hl7_vaccinations, "insurance": hl7_insurance, "lab_tests": hl7_lab_tests,
    "lab_results": hl7_lab_results, "providers": hl7_providers, "pcp": hl7_pcp, "message_log": hl7_message_log, "links": hl7_links,
}


#: Kinds of segments that are stored together: each kind that a table repeats, and those that a table reads in
#: their common order.
STORED_KINDS = (("PR1",), ("DG1",), ("RXE",), ("RXA",), ("IN1",), ("OBR",), ("RXO", "RXE"), ("IAM", "AL1"), ("OBR", "OBX"))
_LENGTH, _HEADERS, _HEADS = "file_length", "n_headers", "linked_heads"


def parse_hl7(df: DataFrame, path: str, text: str = "value", file: str = "file") -> DataFrame:
    """Reads and splits every message once and stores it shredded: the columns of ``hl7_messages`` without
    the text, and a column for each kind of segments, so that a table reads its own columns. Split segments
    are stored whole and split again where they are read: a list of fields costs several times as much to write."""
    messages = hl7_messages(df, text, file)
    kinds = {_kept(*kinds): _of_kinds(*kinds) for kinds in STORED_KINDS}
    counts = {_LENGTH: F.length(text), _HEADERS: _count_of_headers(), _HEADS: _linked_heads()}
    whole = {f"_{n.lower()}": F.col(_whole(n)) for n in SINGLE_KINDS}
    lines = messages.withColumns(kinds | counts | whole).drop(text, "_text", "_segments", *map(_whole, SINGLE_KINDS))
    lines.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    named = stored.withColumns({_whole(n): F.col(f"_{n.lower()}") for n in SINGLE_KINDS})
    return named.withColumns({f"_{n.lower()}": _single(n) for n in SINGLE_KINDS})


def hl7_tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """All tables of parsed messages."""
    return {name: extract(parsed) for name, extract in TABLES.items()}
