"""C-CDA documents to extracts.

A document is parsed once per extract with ``from_xml`` and a schema that names only what the
extract reads; the rest is array functions inside the row, so nothing is shuffled. Nested entries
are read to a fixed depth (entry, entry relationship, inner entry relationship).

``parse_ccda`` parses once for all extracts and stores the documents shredded: a column for the patient,
one for the encounter around the document, and one for each kind of section, which holds only the
events that its extract reads and as much of them as it reads. An extract of stored documents scans its
own column.

A document that breaks an expectation (two sections of one kind, two events in an entry, an event
of another kind) gives no rows for that extract and is listed by ``ccda_errors``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.rows import keep, rows_of
from ..functions.text import base_name, before

# Section codes of the extracts.
SECTIONS = {
    "encounters": "46240-8",
    "insurance": "48768-6",
    "care_team": "85847-2",
    "problems": "11450-4",
    "procedures": "47519-4",
    "medications": "10160-0",
    "allergies": "48765-2",
    "immunizations": "11369-6",
    "vital_signs": "8716-3",
    "labs": "30954-2",
    "consult_note": "11488-4",
}

# The event kind of a section's entries.
EVENTS = {
    "encounters": "encounter",
    "insurance": "act",
    "care_team": "organizer",
    "problems": "act",
    "procedures": "procedure",
    "medications": "substanceAdministration",
    "allergies": "act",
    "immunizations": "substanceAdministration",
    "vital_signs": "organizer",
    "labs": "organizer",
}

# Code systems, template roots and codes the rules look for.
PHIN_VADS = "2.16.840.1.113883.5.4"
LOINC = "2.16.840.1.113883.6.1"
NPI_ROOT = "2.16.840.1.113883.4.6"
POLICY_ACTIVITY = "2.16.840.1.113883.10.20.22.4.60"
PROBLEM_OBSERVATION = "2.16.840.1.113883.10.20.22.4.4"
DATE_OF_DIAGNOSIS = "2.16.840.1.113883.10.20.22.4.502"
MEDICATION_INSTRUCTIONS = "76662-6"
ABNORMAL = ("A", "LL", "L", "H", "HH")

# Titles of the scraped tables with the code-system mark of their code cells.
TABLE_TITLES = {
    "Encounters": "SNOMED-CT",
    "Insurance": " ",
    "Providers": " ",
    "Problems": "SNOMED-CT",
    "Procedures": " ",
    "Surgeries": "SNOMED-CT",
    "Medications": "RxNorm",
    "Allergies": " ",
    "Allergies and Adverse Reactions": "SNOMED-CT",
    "Immunizations": "SNOMED-CT",
    "Vital Signs": "LOINC",
    "Lab": " ",
    "Diagnostic Results": "LOINC",
    "Social History": " ",
    "Plan of Care": "SNOMED-CT",
}

KINDS = ("act", "encounter", "observation", "procedure", "organizer", "substanceAdministration", "supply")
_OPTIONS = {"rowTag": "ClinicalDocument", "ignoreNamespace": "true", "mode": "PERMISSIVE", "ignoreSurroundingSpaces": "true", "valueTag": "_content"}


# -- schemas --------------------------------------------------------------------------------------

def _struct(**fields: str) -> str:
    return "struct<" + ",".join(f"{name}:{kind}" for name, kind in fields.items()) + ">"


def _array(kind: str) -> str:
    return f"array<{kind}>"


_TEXT = _struct(_content="string", text="string")
_SAID = _struct(_content="string")
_ID = _struct(_root="string", _extension="string")
_ROOT = _struct(_root="string")
_POINT = _struct(_value="string")
_STARTED = _struct(_value="string", low=_POINT, center=_POINT)
_TIME = _struct(_value="string", low=_POINT, center=_POINT, high=_POINT)
_PERIOD = _struct(low=_POINT, high=_POINT)
_TOKEN = _struct(_content="string", _qualifier="string")
_NAME = _struct(**{k: _array(_TOKEN) for k in ("prefix", "given", "family", "suffix")})


def _code(*attributes: str, original: bool = False, **more: str) -> str:
    """A code with these attributes, and its original text where that is read."""
    return _struct(**{f"_{a}": "string" for a in attributes}, **({"originalText": _TEXT} if original else {}), **more)


# The cost of parsing an element grows with the fields its type names, so each type names what an extract reads there.
# An element without children counts as missing if its type names none of its attributes: where extracts tell missing
# elements from empty ones (values, acts), all attributes are named.
_CODED = _code("code")
_TOLD = _code("code", "displayName")
_SYSTEM = _code("code", "codeSystem", "displayName")
_VALUE = _struct(_value="string", _code="string", _unit="string", _displayName="string", originalText=_TEXT)
_PERFORMER = _struct(functionCode=_CODED, assignedEntity=_struct(id=_array(_ID), assignedPerson=_struct(name=_array(_NAME))))
_PERFORMING = _array(_struct(assignedEntity=_struct(id=_array(_ID))))
_AUTHOR = _struct(time=_STARTED, assignedAuthor=_struct(id=_array(_ID)))


def _inner(**event: str) -> str:
    """Entry relationships with one kind of event."""
    ((kind, read),) = event.items()
    return _array(_struct(**{kind: _array(read)}))


def _product(**material: str) -> str:
    return _struct(manufacturedProduct=_struct(manufacturedMaterial=_struct(**material)))


_POLICY = _struct(templateId=_array(_ROOT), id=_array(_ROOT), code=_CODED)
_DATED = _struct(templateId=_array(_ROOT), effectiveTime=_STARTED)
_SEVERITY = _struct(code=_CODED, value=_TOLD)
_REACTION = _struct(value=_code("displayName"), entryRelationship=_inner(observation=_SEVERITY))
_COVERED = _struct(_typeCode="string", time=_PERIOD)
_ALLERGEN = _struct(participantRole=_struct(playingEntity=_struct(code=_code("code", "displayName", original=True), name="string")))
_INSTRUCTION = _struct(code=_CODED, text=_SAID)

#: What the extract of a section reads of its events: parts of the types in ``_EVENT``, of the same field names.
_READ = {
    "encounters": _struct(
        code=_code("code", "codeSystem", "displayName", translation=_array(_SYSTEM)), effectiveTime=_TIME, dischargeDispositionCode=_TOLD,
        participant=_array(_struct(_typeCode="string", participantRole=_struct(playingEntity=_struct(name="string")))),
    ),
    "insurance": _struct(templateId=_array(_ROOT), id=_array(_ROOT), code=_CODED, participant=_array(_COVERED), entryRelationship=_inner(act=_POLICY)),
    "care_team": _struct(component=_array(_struct(act=_array(_struct(_classCode="string", performer=_array(_PERFORMER)))))),
    "problems": _struct(entryRelationship=_inner(observation=_struct(
        templateId=_array(_ROOT), value=_VALUE, author=_array(_AUTHOR), entryRelationship=_inner(act=_DATED)))),
    "procedures": _struct(code=_code("code", "displayName", original=True), effectiveTime=_STARTED, performer=_PERFORMING),
    "medications": _struct(
        routeCode=_code("displayName"), consumable=_product(code=_SYSTEM), entryRelationship=_inner(substanceAdministration=_INSTRUCTION)
    ),
    "allergies": _struct(entryRelationship=_inner(observation=_struct(
        effectiveTime=_STARTED, value=_VALUE, author=_array(_struct(time=_STARTED)), participant=_array(_ALLERGEN),
        entryRelationship=_array(_struct(_typeCode="string", observation=_array(_REACTION)))))),
    "immunizations": _struct(
        performer=_PERFORMING, repeatNumber=_struct(_content="string", _value="string"), effectiveTime=_array(_POINT),
        consumable=_product(code=_TOLD, lotNumberText=_struct(_content="string", _value="string")),
    ),
    "vital_signs": _struct(component=_array(_struct(observation=_array(_struct(code=_SYSTEM, effectiveTime=_POINT))))),
    "labs": _struct(component=_array(_struct(observation=_array(_struct(
        code=_code("code", "codeSystem"), effectiveTime=_POINT, value=_struct(_value="string", _unit="string"),
        interpretationCode=_array(_CODED)))))),
}

#: What is read of each kind of event by all sections together.
_EVENT = {
    "act": _struct(
        _classCode="string", templateId=_array(_ROOT), id=_array(_ROOT), code=_CODED, participant=_array(_COVERED),
        entryRelationship=_array(_struct(
            act=_array(_POLICY),
            observation=_array(_struct(
                templateId=_array(_ROOT), effectiveTime=_STARTED, value=_VALUE, author=_array(_AUTHOR), participant=_array(_ALLERGEN),
                entryRelationship=_array(_struct(_typeCode="string", observation=_array(_REACTION), act=_array(_DATED))),
            )),
        )),
    ),
    "encounter": _READ["encounters"],
    "organizer": _struct(component=_array(_struct(
        act=_array(_struct(_classCode="string", performer=_array(_PERFORMER))),
        observation=_array(_struct(
            code=_SYSTEM, effectiveTime=_POINT, value=_struct(_value="string", _unit="string"), interpretationCode=_array(_CODED))),
    ))),
    "procedure": _READ["procedures"],
    "substanceAdministration": _struct(
        effectiveTime=_array(_POINT), routeCode=_code("displayName"), repeatNumber=_struct(_content="string", _value="string"),
        consumable=_product(code=_SYSTEM, lotNumberText=_struct(_content="string", _value="string")),
        performer=_PERFORMING, entryRelationship=_inner(substanceAdministration=_INSTRUCTION),
    ),
}
_SEEN = _struct(_classCode="string")


def _section_schema(events: Mapping[str, str], entries: bool = True, texts: bool = False) -> str:
    """Sections with their events of the given kinds as far as these types go, and only the presence of others."""
    fields = {"code": _struct(_code="string")}
    if texts:
        fields |= {"title": "string", "text": "string"}
    if entries:
        fields["entry"] = _array(_struct(**{k: _array(events.get(k, _SEEN)) for k in KINDS}))
    return _struct(**fields)


def _body_schema(section: str) -> str:
    body = _struct(component=_array(_struct(section=_array(section))))
    return _struct(component=_array(_struct(structuredBody=body)))


_HEADER = _struct(
    recordTarget=_struct(patientRole=_struct(
        addr=_array(_struct(streetAddressLine=_array("string"), city="string", state="string", postalCode="string")),
        telecom=_array(_struct(_value="string", _use="string", _nullFlavor="string")),
        patient=_struct(
            name=_array(_struct(**{k: _array(_SAID) for k in ("prefix", "given", "family", "suffix")})), administrativeGenderCode=_CODED,
            birthTime=_POINT, deceasedInd=_struct(_value="string", _content="string"), maritalStatusCode=_CODED,
            raceCode=_array(_CODED), ethnicGroupCode=_array(_CODED), languageCommunication=_array(_struct(languageCode=_CODED)),
        ),
    )),
    componentOf=_struct(encompassingEncounter=_struct(effectiveTime=_struct(low=_POINT), dischargeDispositionCode=_CODED)),
)


# -- shredded documents -----------------------------------------------------------------------------

_PATIENT, _ENCOUNTER, _READABLE, _TITLED = "patient_role", "encompassing_encounter", "readable", "titled_texts"
_NOTE = "consult_note"


def _column(section: str) -> str:
    """The stored column of a section: the entries (the text, for a note) of the first of its kind."""
    return f"section_{section}"


def _number(section: str) -> str:
    """The stored column with the number of sections of a kind."""
    return f"n_{section}"


def _broken_of(section: str) -> str:
    """The stored column with the broken rules of a section's items."""
    return f"broken_{section}"


def _narrowed(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of the type ``have`` with no more than the fields of ``want``."""
    if have == want:
        return value
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda item: _narrowed(item, have.elementType, want.elementType))
    fields = [_narrowed(value[f.name], have[f.name].dataType, f.dataType).alias(f.name) for f in want]
    return F.when(value.isNotNull(), F.struct(*fields))


def _shredded_entry(section: str, have: str, want: str):
    """An entry as the events of its section's kind, their number and the number of other events."""
    kind = EVENTS[section]

    def shredded(entry: Column) -> Column:
        others = [_n(entry[k]) for k in KINDS if k != kind]
        counts = [_n(entry[kind]).alias("own"), sum(others[1:], others[0]).alias("others")]
        if not want:
            return F.struct(*counts)
        return F.struct(_narrowed(entry[kind], T.DataType.fromDDL(_array(have)), T.DataType.fromDDL(_array(want))).alias("events"), *counts)

    return shredded


def _shredded(
    df: DataFrame, file: str, doc: Column, parsed: Mapping[str, str], read: Mapping[str, str | None], texts: bool, rules: bool,
    header: Mapping[str, tuple[str, ...]] = {},
) -> DataFrame:
    """The columns of shredded documents from parsed ones (``doc``). ``parsed`` has the types of the events as
    parsed, ``read`` what is kept for a section: its events of a type, their numbers (an empty text), or the
    number of sections alone (None). ``texts`` adds the note and the titled texts, ``rules`` the broken rules.

    Whole documents and sections are values inside one expression and never columns: rows of such wide types,
    written out and read again between two steps, cost as much as the parsing."""

    def shredded(d: Column, sections: Column, codes: Column) -> Column:
        number = lambda name: (F.size(codes) - F.size(F.array_remove(codes, SECTIONS[name]))).alias(_number(name))
        first = lambda name: F.get(sections, (F.array_position(codes, SECTIONS[name]) - 1).cast("int"))
        columns = [reduce(lambda value, part: value[part], path, d).alias(name) for name, path in header.items()]
        columns.append(sections.isNotNull().alias(_READABLE))
        for name, want in read.items():
            columns.append(number(name))
            if want is not None:
                entry = _shredded_entry(name, parsed.get(EVENTS[name], _SEEN), want)
                columns.append(F.transform(first(name)["entry"], entry).alias(_column(name)))
            if rules and name in RULES:
                columns.append(_broken_items(name, F.transform(first(name)["entry"], lambda e: e[EVENTS[name]])).alias(_broken_of(name)))
        columns.append(number(_NOTE))
        if texts:
            titles = [t for title in TABLE_TITLES for t in (title, title.upper())]
            titled = F.filter(sections, lambda s: s["title"].isin(*titles))
            columns.append(F.transform(titled, lambda s: F.struct(s["title"].alias("title"), s["text"].alias("text"))).alias(_TITLED))
            columns.append(first(_NOTE)["text"].alias(_column(_NOTE)))
        return F.struct(*columns)

    def sections_of(d: Column) -> Column:
        bodies = F.transform(d["component"], lambda c: F.flatten(F.transform(c["structuredBody"]["component"], lambda b: b["section"])))
        return F.filter(F.flatten(F.filter(bodies, lambda b: b.isNotNull())), lambda s: s.isNotNull())

    rows = _once(doc, lambda d: _once(sections_of(d), lambda s: _once(s["code"]["_code"], lambda codes: shredded(d, s, codes))))
    return df.select(file, F.inline_outer(F.array(rows)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _header_of(df: DataFrame, file: str, text: str, column: str) -> DataFrame:
    """The patient or the encounter around the document as ``_h``."""
    if column in df.columns:
        return df.select(F.col(file), F.col(column).alias("_h"))
    doc = df.select(F.col(file), F.from_xml(F.col(text), _HEADER, _OPTIONS).alias("_d"))
    return doc.select(file, reduce(lambda value, part: value[part], _HEADER_PATHS[column], F.col("_d")).alias("_h"))


_HEADER_PATHS = {_PATIENT: ("recordTarget", "patientRole"), _ENCOUNTER: ("componentOf", "encompassingEncounter")}


def _sections(df: DataFrame, file: str, text: str, read: Mapping[str, str | None], texts: bool = False, rules: bool = False) -> DataFrame:
    """Shredded documents with the sections in ``read`` (see ``_shredded``), with ``rules`` the broken rules instead of
    the events. Stored ones are taken as they are."""
    if _READABLE in df.columns:
        entries = [_column(name) for name, kind in read.items() if kind is not None]
        broken = [_broken_of(name) for name in read if rules and name in RULES]
        return df.select(F.col(file), _READABLE, *map(_number, (*read, _NOTE)), *entries, *broken, *([_TITLED, _column(_NOTE)] if texts else []))
    events = {name: kind for name, kind in read.items() if kind}
    parse = {EVENTS[name]: kind if len(events) == 1 else _EVENT[EVENTS[name]] for name, kind in events.items()}
    entries = any(kind is not None for kind in read.values())
    doc = F.from_xml(F.col(text), _body_schema(_section_schema(parse, entries, texts)), _OPTIONS)
    kept = {name: "" if rules and kind else kind for name, kind in read.items()}
    return _shredded(df, file, doc, parse, kept, texts, rules)


# -- small rules ------------------------------------------------------------------------------------

def _first(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def _start(time: Column) -> Column:
    """Best known start of a time: low, else center, else the plain value."""
    return F.coalesce(time["low"]["_value"], time["center"]["_value"], time["_value"])


def _any_root(ids: Column, root: str) -> Column:
    return F.coalesce(F.exists(ids, lambda i: i["_root"] == root), F.lit(False))


def _npi(ids: Column) -> Column:
    return _first(F.filter(ids, lambda i: i["_root"] == NPI_ROOT))["_extension"]


def _original(text: Column) -> Column:
    return F.coalesce(text["text"], text["_content"])


def _joined(tokens: Column, unqualified: bool = False) -> Column:
    """Token texts joined by blanks; null when there are none."""
    wanted = F.filter(tokens, lambda t: t["_qualifier"].isNull()) if unqualified else tokens
    return F.when(F.size(wanted) > 0, F.array_join(F.transform(wanted, lambda t: t["_content"]), " "))


# -- header extracts ----------------------------------------------------------------------------------

def ccda_demographics(df: DataFrame, file: str = "file", text: str = "value", strict_reference: bool = False) -> DataFrame:
    """Name, demographics, address and telecom of the patient, one row per document.

    All given names make up ``given_name`` and ``middle_names`` is empty, as in the source, where
    both read the same element. Business phone reads use ``WP``; with ``strict_reference`` it is
    null, since the source stores ``WP`` numbers but looks up another use.
    """
    doc = _header_of(df, file, text, _PATIENT)
    role = doc.select(
        file, F.col("_h.patient").alias("_p"), _first(F.col("_h.patient.name")).alias("_n"), _first(F.col("_h.addr")).alias("_a"),
        F.filter("_h.telecom", lambda t: t["_nullFlavor"].isNull() & t["_value"].isNotNull()).alias("_t"),
    )

    def is_mail(t: Column) -> Column:
        return F.startswith(t["_value"], F.lit("mailto:")) | (F.locate("@", t["_value"]) > 1)

    known = role.withColumns(
        {
            "_mail": F.filter("_t", lambda t: is_mail(t)),
            "_phone": F.filter("_t", lambda t: ~is_mail(t)),
        }
    )
    number = lambda t: F.substring_index(t["_value"], "tel:", -1)

    def phone(use: str) -> Column:
        found = F.filter("_phone", lambda t: t["_use"] == use)
        return number(F.try_element_at(found, F.lit(-1)))

    other = F.filter("_phone", lambda t: ~F.coalesce(t["_use"].isin("HP", "WP", "MC"), F.lit(False)))
    line = lambda i: F.coalesce(F.try_element_at("_a.streetAddressLine", F.lit(i)), F.lit(""))
    mails = F.transform("_mail", lambda t: F.regexp_replace(t["_value"], "^mailto:", ""))
    patient = F.col("_p")
    return known.select(
        F.col(file),
        _joined(F.col("_n.prefix")).alias("name_prefix"),
        _joined(F.col("_n.given")).alias("given_name"),
        F.lit("").alias("middle_names"),
        _joined(F.col("_n.family")).alias("family_name"),
        _joined(F.col("_n.suffix")).alias("name_suffix"),
        patient["birthTime"]["_value"].alias("date_of_birth"),
        patient["administrativeGenderCode"]["_code"].alias("sex"),
        _first(patient["raceCode"])["_code"].alias("race"),
        _first(patient["ethnicGroupCode"])["_code"].alias("ethnicity"),
        _first(patient["languageCommunication"])["languageCode"]["_code"].alias("language"),
        patient["maritalStatusCode"]["_code"].alias("marital_status"),
        F.coalesce(F.coalesce(patient["deceasedInd"]["_value"], patient["deceasedInd"]["_content"]) == "true", F.lit(False)).alias("deceased"),
        line(1).alias("street1"),
        line(2).alias("street2"),
        F.col("_a.city").alias("city"),
        F.col("_a.state").alias("state"),
        F.col("_a.postalCode").alias("postal_code"),
        F.coalesce(F.array_join(mails, ","), F.lit("")).alias("emails"),
        phone("HP").alias("home_phone_number_id"),
        (F.lit(None).cast("string") if strict_reference else phone("WP")).alias("business_phone_number_id"),
        phone("MC").alias("cell_phone_number_id"),
        number(F.try_element_at(other, F.lit(-1))).alias("other_phone_number_id"),
    )


def ccda_header(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Service time and discharge code of the encompassing encounter."""
    encounter = F.col("_h")
    return _header_of(df, file, text, _ENCOUNTER).select(
        F.col(file),
        encounter["effectiveTime"]["low"]["_value"].alias("service_datetime"),
        encounter["dischargeDispositionCode"]["_code"].alias("discharge_disposition_code"),
    )


# -- sections -----------------------------------------------------------------------------------------

def ccda_sections(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Number of sections of each known kind per document; more than one is an error."""
    doc = _sections(df, file, text, {name: None for name in EVENTS})
    count = lambda kind: F.struct(F.lit(kind).alias("section"), F.col(_number(kind)).cast("bigint").alias("n"))
    counts = F.array(*[count(kind) for kind in SECTIONS])
    return rows_of(doc.select(file, counts.alias("_counts")), F.filter("_counts", lambda c: c["n"] > 0), "_c").select(F.col(file), "_c.section", "_c.n")


def _entries(df: DataFrame, file: str, text: str, section: str) -> DataFrame:
    """``_entries`` of the one section of a kind; null when there is none or more than one."""
    doc = _sections(df, file, text, {section: _READ[section]})
    return doc.select(file, F.when(F.col(_number(section)) == 1, F.col(_column(section))).alias("_entries"))


def _n_events(entry: Column) -> Column:
    return entry["own"] + entry["others"]


def _events(
    df: DataFrame, file: str, text: str, section: str, single: bool = True, others: bool = False, entries: int | None = None
) -> DataFrame:
    """One row per event of the section's kind. ``single``: entries hold one event each;
    ``others``: events of other kinds are skipped instead of spoiling the document; ``entries``: the
    most entries a section may hold."""
    doc = _entries(df, file, text, section)
    ok = F.lit(True)
    if single:
        ok = ok & F.forall("_entries", lambda e: _n_events(e) <= 1)
    if not others:
        ok = ok & F.forall("_entries", lambda e: e["others"] == 0)
    if entries is not None:
        ok = ok & (F.size("_entries") <= entries)
    events = _flat(F.transform("_entries", lambda e: e["events"]))
    return rows_of(doc, F.when(ok, events), "_e", "_no").withColumn("event_no", F.col("_no") + 1).drop("_entries", "_no")


def _n(items: Column) -> Column:
    return F.coalesce(F.greatest(F.size(items), F.lit(0)), F.lit(0))


def _flat(arrays: Column) -> Column:
    return F.flatten(F.filter(arrays, lambda x: x.isNotNull()))


def _vads(code: Column) -> Column:
    """Translations to the PHIN VADS system, where the code itself is of another."""
    own = F.coalesce(code["_codeSystem"] == PHIN_VADS, F.lit(False))
    return F.when(~own, F.filter(code["translation"], lambda t: t["_codeSystem"] == PHIN_VADS))


def _allergen(observation: Column) -> Column:
    return _first(observation["participant"])["participantRole"]["playingEntity"]


def _care_act(organizer: Column) -> Column:
    acts = _flat(F.transform(organizer["component"], lambda c: c["act"]))
    return _first(F.filter(acts, lambda a: a["_classCode"] == "PCPR"))


#: What an item of a section (an event, or an observation in it) must not be. An item that breaks a
#: rule is left out of its extract and listed by ``ccda_errors``; both read this table.
RULES = {
    "encounters": {"several PHIN VADS codes": lambda e: _n(_vads(e["code"])) > 1},
    "care_team": {"several performers": lambda e: _n(_care_act(e)["performer"]) > 1},
    "procedures": {"several performers": lambda e: _n(e["performer"]) > 1},
    "immunizations": {"several performers": lambda e: _n(e["performer"]) > 1},
    "allergies": {
        "not one participant": lambda o: _n(o["participant"]) != 1,
        "participant without an entity": lambda o: (_n(o["participant"]) == 1) & _allergen(o).isNull(),
        "no value": lambda o: o["value"].isNull(),
    },
}


def _broken(section: str, item: Column) -> Column:
    return F.array_compact(F.array(*[F.when(rule(item), F.lit(name)) for name, rule in RULES[section].items()]))


def _broken_items(section: str, events: Column) -> Column:
    """The first broken rule of each item of a section that breaks one; ``events`` are those of each entry."""
    items = _flat(events)
    if section == "allergies":
        items = _flat(F.transform(items, lambda e: _flat(F.transform(e["entryRelationship"], lambda r: r["observation"]))))
    return _flat(F.transform(items, lambda item: F.slice(_broken(section, item), 1, 1)))


def _sound(rows: DataFrame, section: str, item: str) -> DataFrame:
    return keep(rows, F.size(_broken(section, F.col(item))) == 0)


def _with_type(participants: Column, type_code: str) -> Column:
    return F.filter(participants, lambda p: p["_typeCode"] == type_code)


def ccda_encounters(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Encounter rows. The PHIN VADS code is the code itself or its one translation of that system;
    an encounter with several is left out and listed as an error."""
    e = F.col("_e")
    rows = _sound(_events(df, file, text, "encounters"), "encounters", "_e")
    code, time = e["code"], e["effectiveTime"]
    vads = _vads(code)
    own = F.coalesce(code["_codeSystem"] == PHIN_VADS, F.lit(False))
    picked = rows.withColumns(
        {
            "_vads": F.when(own, F.struct(code["_code"].alias("c"), code["_displayName"].alias("d"))).otherwise(
                F.when(_n(vads) == 1, F.struct(_first(vads)["_code"].alias("c"), _first(vads)["_displayName"].alias("d")))
            ),
            "_to": _with_type(e["participant"], "DST"),
        }
    )
    end = time["high"]["_value"]
    return picked.select(
        F.col(file), "event_no",
        _start(time).alias("service_datetime_start"), end.alias("service_datetime_end"),
        code["_code"].alias("encounter_code"), code["_displayName"].alias("encounter_code_display_name"),
        F.col("_vads.c").alias("encounter_phin_vads_code"), F.col("_vads.d").alias("encounter_phin_vads_code_display_name"),
        F.when(F.col("_vads.c") == "IMP", end).alias("discharged_time"),
        e["dischargeDispositionCode"]["_code"].alias("discharge_disposition_code"),
        e["dischargeDispositionCode"]["_displayName"].alias("discharge_disposition_display_name"),
        _first(F.col("_to"))["participantRole"]["playingEntity"]["name"].alias("discharged_to"),
    )


def ccda_insurance(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Coverage rows: group id and plan type of the policy activity (the act itself or the first
    related act of that template), dates of the covered party."""
    e = F.col("_e")
    rows = _events(df, file, text, "insurance", single=False)
    inner = F.flatten(F.filter(F.transform(e["entryRelationship"], lambda r: r["act"]), lambda a: a.isNotNull()))
    own = F.struct(_first(e["id"]).alias("id"), e["code"]["_code"].alias("code"))
    related = _first(F.filter(inner, lambda a: _any_root(a["templateId"], POLICY_ACTIVITY)))
    theirs = F.when(related.isNotNull(), F.struct(_first(related["id"]).alias("id"), related["code"]["_code"].alias("code")))
    picked = rows.withColumns(
        {
            "_policy": F.when(_any_root(e["templateId"], POLICY_ACTIVITY), own).otherwise(theirs),
            "_cov": _first(_with_type(e["participant"], "COV")),
        }
    )
    return picked.select(
        F.col(file), "event_no", F.col("_policy.id._root").alias("grpid"),
        F.col("_cov.time.low._value").alias("eff_date"), F.col("_cov.time.high._value").alias("exp_date"),
        F.col("_policy.code").alias("plan_type"),
    )


def ccda_care_team(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Primary care performer of the first PCPR act; a team without one gives a row of nulls. A
    document with several entries, and a team with several performers, are listed as errors."""
    rows = _sound(_events(df, file, text, "care_team", entries=1), "care_team", "_e")
    picked = rows.select(file, _care_act(F.col("_e"))["performer"].alias("_performers"))
    one = picked.select(file, F.when(F.size("_performers") == 1, _first(F.col("_performers"))).alias("_f"))
    name = _first(F.col("_f.assignedEntity.assignedPerson.name"))
    words = lambda part: F.coalesce(_joined(part, unqualified=True), F.lit(""))
    named = one.withColumn("_n", name)
    has = F.col("_n").isNotNull()
    return named.select(
        F.col(file), _npi(F.col("_f.assignedEntity.id")).alias("attributed_npi"),
        F.when(has, words(F.col("_n.given"))).alias("fname"), F.when(has, words(F.col("_n.family"))).alias("lname"),
        F.when(has, F.lit("")).alias("mname"), F.when(has, words(F.col("_n.suffix"))).alias("suffix"),
        F.col("_f.functionCode._code").alias("prov_type"),
    )


def _inner_observations(rows: DataFrame) -> DataFrame:
    inner = F.flatten(F.filter(F.transform(F.col("_e")["entryRelationship"], lambda r: r["observation"]), lambda o: o.isNotNull()))
    return rows_of(rows, inner, "_o").drop("_e")


def ccda_problems(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Problem observations of each act. The diagnosis time is the author's, else that of a
    date-of-diagnosis act (a fallback the source means to take but never reaches)."""
    rows = _inner_observations(_events(df, file, text, "problems"))
    o = F.col("_o")
    acts = F.flatten(F.filter(F.transform(o["entryRelationship"], lambda r: r["act"]), lambda a: a.isNotNull()))
    dated = _first(F.filter(acts, lambda a: _any_root(a["templateId"], DATE_OF_DIAGNOSIS)))["effectiveTime"]
    author = _first(o["author"])
    return rows.filter(_any_root(o["templateId"], PROBLEM_OBSERVATION)).select(
        F.col(file), "event_no", o["value"]["_code"].alias("code"), o["value"]["_displayName"].alias("display_name"),
        _original(o["value"]["originalText"]).alias("description"),
        _npi(author["assignedAuthor"]["id"]).alias("provider_id"),
        F.coalesce(_start(author["time"]), _start(dated)).alias("diagnosis_timestamp"),
    )


def ccda_procedures(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    e = F.col("_e")
    rows = _events(df, file, text, "procedures", others=True)
    return _sound(rows, "procedures", "_e").select(
        F.col(file), "event_no", e["code"]["_code"].alias("code"), e["code"]["_displayName"].alias("display_name"),
        _npi(_first(e["performer"])["assignedEntity"]["id"]).alias("provider_id"),
        _original(e["code"]["originalText"]).alias("original_text"), _start(e["effectiveTime"]).alias("procedure_timestamp"),
    )


def ccda_medications(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    e = F.col("_e")
    inner = F.flatten(F.filter(
        F.transform(e["entryRelationship"], lambda r: r["substanceAdministration"]), lambda s: s.isNotNull()))
    instructions = _first(F.filter(inner, lambda s: s["code"]["_code"] == MEDICATION_INSTRUCTIONS))
    code = e["consumable"]["manufacturedProduct"]["manufacturedMaterial"]["code"]
    return _events(df, file, text, "medications").select(
        F.col(file), "event_no", code["_code"].alias("normalized_code"), code["_codeSystem"].alias("normalized_codesystem"),
        code["_displayName"].alias("name"), e["routeCode"]["_displayName"].alias("route"),
        instructions["text"]["_content"].alias("sig"),
    )


def ccda_allergies(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Allergy observations with their reactions as ``reaction`` array of (reaction, severities)."""
    rows = _inner_observations(_events(df, file, text, "allergies"))
    o = F.col("_o")
    code = _allergen(o)["code"]
    original = code["originalText"]
    described = F.when(
        original.isNotNull(),
        F.concat(F.coalesce(code["_displayName"], F.lit("")), F.lit("\n"), F.coalesce(_original(original), F.lit(""))),
    ).otherwise(code["_displayName"])
    manifest = F.filter(o["entryRelationship"], lambda r: r["_typeCode"] == "MFST")
    reactions = F.flatten(F.filter(F.transform(manifest, lambda r: r["observation"]), lambda x: x.isNotNull()))

    def severities(reaction: Column) -> Column:
        inner = F.flatten(F.filter(F.transform(reaction["entryRelationship"], lambda r: r["observation"]), lambda x: x.isNotNull()))
        graded = F.filter(inner, lambda s: s["code"]["_code"] == "SEV")
        return F.transform(graded, lambda s: F.struct(
            s["value"]["_displayName"].alias("description_sev"), s["value"]["_code"].alias("code_sev")))

    return _sound(rows, "allergies", "_o").select(
        F.col(file), "event_no", described.alias("description"), code["_code"].alias("code"),
        o["value"]["_displayName"].alias("description_type"), o["value"]["_code"].alias("code_type"),
        F.transform(reactions, lambda r: F.struct(r["value"]["_displayName"].alias("reaction"), severities(r).alias("severity"))).alias("reaction"),
        _start(_first(o["author"])["time"]).alias("reported_date"), _start(o["effectiveTime"]).alias("onset_date"),
    )


def ccda_immunizations(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    e = F.col("_e")
    material = e["consumable"]["manufacturedProduct"]["manufacturedMaterial"]
    rows = _sound(_events(df, file, text, "immunizations"), "immunizations", "_e")
    return rows.select(
        F.col(file), "event_no", _first(_first(e["performer"])["assignedEntity"]["id"])["_root"].alias("performing_provider_id"),
        F.coalesce(e["repeatNumber"]["_content"], e["repeatNumber"]["_value"]).alias("series_number"),
        _first(e["effectiveTime"])["_value"].alias("administered_date"),
        F.coalesce(material["lotNumberText"]["_value"], material["lotNumberText"]["_content"]).alias("lot_number"),
        material["code"]["_displayName"].alias("long_name"), material["code"]["_code"].alias("code"),
    )


def _component_observations(rows: DataFrame) -> DataFrame:
    found = F.flatten(F.filter(F.transform(F.col("_e")["component"], lambda c: c["observation"]), lambda o: o.isNotNull()))
    return rows_of(rows, found, "_o").drop("_e")


def ccda_vitals(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    o = F.col("_o")
    return _component_observations(_events(df, file, text, "vital_signs")).select(
        F.col(file), "event_no", o["code"]["_code"].alias("code"), o["code"]["_codeSystem"].alias("codesystem"),
        o["code"]["_displayName"].alias("name"), o["effectiveTime"]["_value"].alias("vital_timestamp"),
    )


def ccda_labs(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Lab results; the LOINC column is filled only for codes of that system."""
    o = F.col("_o")
    abnormal = F.exists(o["interpretationCode"], lambda c: c["_code"].isin(*ABNORMAL))
    return _component_observations(_events(df, file, text, "labs")).select(
        F.col(file), "event_no", F.when(o["code"]["_codeSystem"] == LOINC, o["code"]["_code"]).alias("obx_3_3"),
        o["value"]["_unit"].alias("unit"), o["value"]["_value"].alias("value"),
        F.coalesce(abnormal, F.lit(False)).alias("abnormal"), o["effectiveTime"]["_value"].alias("time"),
    )


def ccda_consult_note(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Leading text of the consult note section."""
    doc = keep(_sections(df, file, text, {}, texts=True), F.col(_number(_NOTE)) == 1)
    return doc.select(F.col(file), F.trim(before(F.col(_column(_NOTE)), "<")).alias("provider_notes"))


# -- errors -------------------------------------------------------------------------------------------

def ccda_errors(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Broken expectations per document: (file, section, error). An error of an item comes once for
    each item, so what is extracted and what is listed add up."""
    read = {section: _READ[section] if section in RULES else "" for section in EVENTS}
    doc = _sections(df, file, text, read, rules=True)
    none = F.array().cast("array<struct<section:string,error:string>>")
    problems = [
        F.when(~F.col(_READABLE), F.array(F.struct(F.lit("document").alias("section"), F.lit("not readable").alias("error"))))
    ]
    one_event = ("encounters", "care_team", "problems", "procedures", "medications", "allergies", "immunizations", "vital_signs", "labs")
    for section in SECTIONS:
        row = lambda message, section=section: F.struct(F.lit(section).alias("section"), message.alias("error"))
        at_once = lambda condition, message, row=row: F.when(condition, F.array(row(F.lit(message))))
        several = F.col(_number(section)) > 1
        problems.append(at_once(several, "several sections"))
        spoiled = several
        entries = F.col(_column(section))
        if section == "care_team":
            problems.append(at_once(_n(entries) > 1, "several entries"))
            spoiled = spoiled | (_n(entries) > 1)
        if section in one_event:
            # Fields of the whole array, not of each entry, so that the scan reads the two numbers alone.
            numbers = F.zip_with(entries["own"], entries["others"], lambda own, others: own + others)
            crowded = F.coalesce(F.exists(numbers, lambda n: n > 1), F.lit(False))
            problems.append(at_once(crowded, "several events in an entry"))
            spoiled = spoiled | crowded
        if section in EVENTS and section != "procedures":
            other = F.coalesce(F.exists(entries["others"], lambda n: n > 0), F.lit(False))
            problems.append(at_once(other, "event of another kind"))
            spoiled = spoiled | other
        if section in RULES:
            problems.append(F.when(~spoiled, F.transform(_broken_of(section), lambda message: row(message))))
    return rows_of(doc, F.flatten(F.array(*[F.coalesce(p, none) for p in problems])), "_p").select(F.col(file), "_p.section", "_p.error")


# -- table text and row forms ---------------------------------------------------------------------------

def ccda_table_text(df: DataFrame, file: str = "file", text: str = "value") -> DataFrame:
    """Cells of the titled section tables, split into coded cells and others, one row per document
    and title; ``NA`` where there is nothing. Only cells with a blank in them count."""
    doc = _sections(df, file, text, {}, texts=True)
    titles = F.array(*[F.struct(F.lit(t).alias("title"), F.lit(m).alias("mark")) for t, m in TABLE_TITLES.items()])
    rows = rows_of(doc, titles, "_t")
    titled = F.filter(
        _TITLED, lambda s: (s["title"] == F.col("_t.title")) | (s["title"] == F.upper(F.col("_t.title")))
    )
    cells = F.regexp_extract_all(_first(titled)["text"], F.lit(r"<td[^>]*?(?:/>|>([^<]*))"), F.lit(1))
    cleaned = F.transform(cells, lambda c: F.when(F.length(c) == 0, "NA").otherwise(c))
    parts = F.filter(F.split(F.array_join(cleaned, ";"), ";"), lambda c: F.contains(c, F.lit(" ")))
    ready = rows.select(file, "_t", parts.alias("_cells"))
    coded = F.filter("_cells", lambda c: F.contains(c, F.col("_t.mark")))
    plain = F.filter("_cells", lambda c: ~F.contains(c, F.col("_t.mark")))
    listed = lambda a: F.when(F.size(a) > 0, F.array_join(a, "; ")).otherwise("NA")
    return ready.select(F.col(file), F.col("_t.title").alias("title"), listed(plain).alias("field"), listed(coded).alias("code"))


def ccda_rows(df: DataFrame, processed_at: str, file: str = "file", text: str = "value") -> dict[str, DataFrame]:
    """Registration, contact and insurance rows in the stored table layout (filled columns only).
    The first name is the first given word; a birth date that is no ``YYYYMMDD`` is 1000-01-01."""
    d = ccda_demographics(df, file, text)
    born = F.col("date_of_birth")
    iso = F.concat_ws("-", F.substring(born, 1, 4), F.substring(born, 5, 2), F.substring(born, 7, 2))
    dob = F.when(F.length(born) > 0, F.when(born.rlike(r"^\d{8}"), iso).otherwise("1000-01-01"))
    first = F.when(F.length("given_name") > 0, F.try_element_at(F.split(F.trim("given_name"), r"\s+"), F.lit(1)))
    euid = F.regexp_replace(base_name(F.col(file)), r"\.[^.]*$", "")
    base = d.withColumns({"dob": dob, "firstname": first, "euid": euid, "event_timestamp": F.lit(processed_at),
                          "index_update_dt_tm": F.lit(processed_at)})
    person = base.select(
        "index_update_dt_tm", F.lit("999999999").alias("mrn"), F.col("name_prefix").alias("prefix"), "firstname",
        F.col("middle_names").alias("middlename"), F.col("family_name").alias("lastname"), F.col("name_suffix").alias("suffix"),
        "dob", "sex", "race", "ethnicity", "language", "marital_status", F.initcap(F.col("deceased").cast("string")).alias("deceased"),
        "event_timestamp", F.lit("1970-12-31 18:00:00").alias("collect_registered"), F.lit("-1").alias("collect_cmp"), "euid",
    )
    contact = base.select(
        "index_update_dt_tm", F.lit("9999").alias("patient_id"), "street1", "street2", "city", "state",
        F.col("postal_code").alias("zip"), F.col("emails").alias("email"), "event_timestamp", "home_phone_number_id",
        "business_phone_number_id", "euid",
    )
    insurance = base.select(
        "index_update_dt_tm", F.lit("9999").alias("accid"), F.lit("0").alias("seqnum"), F.col("firstname").alias("ins_fname"),
        F.col("middle_names").alias("ins_mname"), F.col("family_name").alias("ins_lname"), F.col("name_suffix").alias("ins_suffix"),
        F.col("dob").alias("ins_dob"), F.col("marital_status").alias("relationship"), F.col("street1").alias("ins_addr1"),
        F.col("street2").alias("ins_addr2"), F.col("city").alias("ins_city"), F.col("state").alias("ins_state"),
        F.col("postal_code").alias("ins_zip"), F.col("emails").alias("ins_email"), "event_timestamp", "home_phone_number_id",
        "business_phone_number_id", "euid",
    )
    return {"registration": person, "contact": contact, "insurance": insurance}


# -- one pass for all extracts ---------------------------------------------------------------------

EXTRACTS = {
    "demographics": ccda_demographics, "header": ccda_header, "sections": ccda_sections, "encounters": ccda_encounters,
    "insurance": ccda_insurance, "care_team": ccda_care_team, "problems": ccda_problems, "procedures": ccda_procedures,
    "medications": ccda_medications, "allergies": ccda_allergies, "immunizations": ccda_immunizations, "vital_signs": ccda_vitals,
    "labs": ccda_labs, "consult_note": ccda_consult_note, "errors": ccda_errors, "table_text": ccda_table_text,
}


def parse_ccda(df: DataFrame, path: str, file: str = "file", text: str = "value") -> DataFrame:
    """Parses every document once and stores it shredded, so that each extract reads its own column.
    Every function here takes the rows."""
    body = _body_schema(_section_schema(_EVENT, texts=True))
    schema = _HEADER.removesuffix(">") + "," + body.removeprefix("struct<")
    doc = F.from_xml(F.col(text), schema, _OPTIONS)
    _shredded(df, file, doc, _EVENT, _READ, texts=True, rules=True, header=_HEADER_PATHS).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def ccda_extracts(parsed: DataFrame) -> dict[str, DataFrame]:
    """All extracts of parsed documents."""
    return {name: extract(parsed) for name, extract in EXTRACTS.items()}
