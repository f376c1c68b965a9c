"""Support tickets: shaping, impact score, nested boards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rows import rows_of

# Colour of a risk label; project id prefixes; name columns of a ticket, in order.
RISK_COLOURS = {"Critical": "crimson", "High": "red", "Medium": "orange", "Low": "lime"}
PROJECT_PREFIXES = ("L-", "S-", "C-")
CLIENT_NAME_COLUMNS = (
    "ehx__ssi_payor_client_name",
    "L_10__hl7v2_client_name",
    "L_69__emr_client_name",
    "L_69__participant_client_name",
    "L_68__participant_client_name",
    "L_68__client_folder_name",
    "client_legal_name",
    "L_87__participant_client_name",
    "L_87__client_folder_name",
    "L_102__hl7v2_client_name",
)


def _text(df: DataFrame, name: str) -> Column:
    """Column as text, empty when null or when the ticket form lacks it."""
    if name not in df.columns:
        return F.lit("")
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def ticket_priority(df: DataFrame, option: str = "escalation_option") -> DataFrame:
    """Risk label, impact ``ceil((a + b) / 2)`` of a ``"Label - a-b"`` text, and colour.

    An option without a dash means no escalation: impact -1 and an empty label. An option with a
    dash but no readable range gives a null impact and ``parse_error``.
    """
    raw = F.coalesce(F.col(option), F.lit("null"))
    text = F.when(F.contains(raw, F.lit("-")), raw).otherwise("null")
    pattern = r"(\S+) . (\d+)-(\d+)"
    none = text == "null"
    readable = F.rlike(text, F.lit(pattern))
    number = lambda i: F.regexp_extract(text, pattern, i).try_cast("int")
    risk = F.when(none, "").when(readable, F.regexp_extract(text, pattern, 1))
    impact = F.when(none, -1).when(readable, F.ceil((number(2) + number(3)) / 2).cast("int"))
    colour = F.lit("")
    for label, value in RISK_COLOURS.items():
        colour = F.when(F.col("risk") == label, value).otherwise(colour)
    return (
        df.withColumns({"risk": risk, "impact": impact})
        .withColumn("colour", colour)
        .withColumn("parse_error", ~none & ~readable)
    )


def shape_tickets(support: DataFrame, projects: DataFrame, reasons: DataFrame, descriptions: DataFrame | None = None,
                  attachment_base: str = "") -> DataFrame:
    """Cards from support rows.

    ``reasons`` has columns ``text``, ``reason_id``, ``category`` and ``subscribers`` (array). A row
    whose reason is not listed has a null ``reason_id``. ``descriptions`` (``category``,
    ``template``) overrides the description; ``{description}`` in a template is replaced.
    """
    t = {c: _text(support, c) for c in (
        "ticket_reason", "ticket_reference_other_system", "project_ids", "data_extract_description",
        "ticket_reason_extended", "client_legal_name", "requestor_info", "behalf_of_email", "attachment",
        "escalation_option",
    )}
    names = F.concat_ws("|", *[_text(support, c) for c in CLIENT_NAME_COLUMNS])
    plain = F.concat(t["data_extract_description"], F.lit(" Description: "), t["ticket_reason_extended"])
    wanted = F.filter(
        F.array_distinct(F.array(t["project_ids"], t["ticket_reference_other_system"])),
        lambda v: F.startswith(v, F.lit(PROJECT_PREFIXES[0]))
        | F.startswith(v, F.lit(PROJECT_PREFIXES[1]))
        | F.startswith(v, F.lit(PROJECT_PREFIXES[2])),
    )
    base = support.select(
        "id",
        t["ticket_reason"].alias("ticket_reason"),
        F.when(F.contains(t["escalation_option"], F.lit("-")), t["escalation_option"]).otherwise("null").alias("escalation_option"),
        names.alias("client_or_participant_name"),
        t["client_legal_name"].alias("client_legal_name"),
        F.when(F.length(t["ticket_reference_other_system"]) >= 2, t["ticket_reference_other_system"]).otherwise("").alias("external_ref"),
        plain.alias("_plain"),
        t["requestor_info"].alias("requestor_info"),
        t["behalf_of_email"].alias("on_behalf_of"),
        t["attachment"].alias("_attachment"),
        wanted.alias("_projects"),
    )
    first = F.min(F.struct("reason_id", "category", "subscribers"))
    known = (
        reasons.groupBy(F.col("text").alias("ticket_reason"))
        .agg(first.alias("_r"))
        .select("ticket_reason", "_r.reason_id", "_r.category", F.col("_r.subscribers").alias("_subscribers"))
    )
    shaped = base.join(known, "ticket_reason", "left")
    if descriptions is not None:
        shaped = shaped.join(descriptions.select("category", F.col("template").alias("_template")), "category", "left")
    else:
        shaped = shaped.withColumn("_template", F.lit(None).cast("string"))
    description = F.coalesce(F.replace(F.col("_template"), F.lit("{description}"), F.col("_plain")), F.col("_plain"))
    shaped = shaped.withColumn("_description", description)

    # A ticket names at most two projects; the first listed project of either wins.
    ranked = projects.filter(F.col("ProjectId").isNotNull()).groupBy(F.col("ProjectId").alias("_pid")).agg(
        F.min_by(F.struct("position", "Priority"), "position").alias("_p")
    )
    pairs = shaped.select("id", F.explode("_projects").alias("_pid")).join(ranked, "_pid")
    priority = pairs.groupBy("id").agg(F.min("_p").alias("_first"))
    joined = shaped.join(priority, "id", "left")

    def part(label: str, value: Column, test: Column) -> Column:
        return F.when(F.length(test) > 1, F.concat(F.lit(label), value)).otherwise("")

    d = F.col("_description")
    title = F.concat(
        F.lit("GID:SUP-"), F.col("id").cast("string"), F.lit(" "), F.col("ticket_reason"),
        F.lit(" Client/Participant Name: "), F.col("client_or_participant_name"),
        part(" - ", F.col("client_legal_name"), F.col("client_legal_name")),
        part(" - ", F.col("external_ref"), F.col("external_ref")),
        part(" - ", F.concat(F.left(F.trim(d), F.lit(100)), F.lit("...")), d),
        F.lit(" - Requestor: "), F.trim(F.left(F.col("requestor_info"), F.lit(50))),
        part(" - On Behalf of: ", F.trim(F.col("on_behalf_of")), F.col("on_behalf_of")),
    )
    file_name = F.replace(F.regexp_extract("_attachment", r'name":"(.*?)","link', 1), F.lit(" "), F.lit("%20"))
    appendix = F.when(
        F.length("_attachment") > 1,
        F.concat(
            F.lit(" | Link: " + attachment_base), file_name,
            F.lit(" | <br><br><br><br><br> Full Attachment Reference: "), F.col("_attachment"),
        ),
    ).otherwise("")
    return joined.select(
        "id", "ticket_reason", "reason_id", "category", "escalation_option", "client_or_participant_name",
        "client_legal_name", "external_ref", "requestor_info", "on_behalf_of",
        F.concat(d, appendix).alias("description"),
        F.coalesce(F.col("_first.Priority"), F.lit(0)).alias("priority"),
        F.coalesce(F.array_contains("_subscribers", F.col("requestor_info")), F.lit(False)).alias("subscribed"),
        title.alias("card_title"),
    )


def flatten_boards(boards: DataFrame, board: str = "board", swimlanes: str = "swimlanes") -> DataFrame:
    """One row per checklist of nested boards: swimlanes -> cards -> checklists. Boards, lanes and
    cards without children give no rows. Everything stays inside the row, so nothing is shuffled."""
    lanes = rows_of(boards.select(board, swimlanes), F.col(swimlanes), "_lane", "lane_no").drop(swimlanes)
    cards = rows_of(lanes, F.col("_lane.cards"), "_card", "card_no").drop("_lane")
    lists = rows_of(cards, F.col("_card.checklists"), "checklist", "checklist_no")
    return lists.select(board, "lane_no", "card_no", F.col("_card.id").alias("card"), "checklist_no", "checklist")


def find_card(boards: DataFrame, card_id, board: str = "board", swimlanes: str = "swimlanes") -> DataFrame:
    """Board and lane of a card."""
    lanes = rows_of(boards.select(board, swimlanes), F.col(swimlanes), "_lane", "lane_no").drop(swimlanes)
    cards = rows_of(lanes, F.col("_lane.cards"), "_card")
    return cards.select(board, "lane_no", F.col("_card.id").alias("card")).filter(F.col("card") == card_id)
