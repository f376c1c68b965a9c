"""Client populations, security groupings, crosswalks and panels.

All clients are built in one job: the client is a column, and the facility lists of the clients
are exploded and joined instead of looping over clients."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from .identity import collapse_duplicates, match_identities, representatives
from .joins import enrich, suppress
from .quality import validate_panel
from ..functions.predicates import MPI_SENTINELS, TEXT_NULL, join_delimited, longer_than

DEMOGRAPHICS = ("first_name", "last_name", "dob", "sex")

# Columns of the attribution file, in order, with the panel column each one takes
# (no column: blank).
ATTRIBUTION = (
    ("Unique Patient ID", "mpi"),
    ("Secondary Client ID", None),
    ("Patient First Name", "Patient First Name"),
    ("Patient Middle Initial", None),
    ("Patient Last Name", "Patient Last Name"),
    ("Patient Name Suffix", None),
    ("Patient Date of Birth", "DOB"),
    ("Gender", "Gender"),
    ("SSN - Last 4", None),
    ("Patient Address 1", "Residential Address"),
    ("Patient Address 2", None),
    ("Patient City", "City"),
    ("Patient State", "State"),
    ("Patient Zip", "Zip Code"),
    ("Patient Phone - Mobile", None),
    ("Patient Phone - Home", None),
    ("Attributed Physician NPI", "Attributed Provider NPI"),
    ("Attributed Physician First Name", "Attributed Facility Provider First Name"),
    ("Attributed Physician Last Name", "Attributed Facility Provider Last Name"),
    ("Attributed Practice Unit OID", None),
    ("Attributed Practice Unit Name", None),
    ("Managing Organization OID", "organization_oid"),
    ("Managing Organization Name", "organization_name"),
    ("Service Delivery Preferences", "delivery_preference"),
    ("Common Key", None),
)


def months_before(as_of: str, months: int) -> str:
    d = date.fromisoformat(as_of)
    year, month = divmod(d.year * 12 + d.month - 1 - months, 12)
    length = (date(year + (month == 11), (month + 1) % 12 + 1, 1) - date(year, month + 1, 1)).days
    return date(year, month + 1, min(d.day, length)).isoformat()


def candidates(
    visits: DataFrame, clients: DataFrame, as_of: str, months: int = 18, mpi: str = "MPI", unit: str = "unit_id",
    admitted: str = "admitted", client: str = "client", facilities: str = "facility_ids",
) -> DataFrame:
    """Distinct (client, person) with a visit to one of the client's facilities in the window."""
    recent = visits.filter(
        (F.col(admitted).try_cast("timestamp_ntz") > F.lit(months_before(as_of, months)).cast("timestamp_ntz"))
        & ~F.col(mpi).cast("string").isin(*MPI_SENTINELS)
    ).select(F.col(mpi), F.col(unit)).distinct()
    return join_delimited(recent, unit, clients, facilities, [client]).select(client, mpi).distinct()


def build_population(
    visits: DataFrame, people: DataFrame, opt_outs: DataFrame, clients: DataFrame, as_of: str, months: int = 18,
    mode: str = "identity", **names: str,
) -> DataFrame:
    """Facility visits, then opt-out removal, demographics, duplicate collapse, and people without
    a sex dropped. One row per client and person."""
    client, mpi = names.get("client", "client"), names.get("mpi", "MPI")
    wanted = candidates(visits, clients, as_of, months, **names)
    cleared = suppress(wanted, opt_outs, mpi, (TEXT_NULL, *MPI_SENTINELS))
    described = enrich(cleared, people, mpi, DEMOGRAPHICS)
    if mode == "identity":
        result = representatives(described, mpi, DEMOGRAPHICS, by=[client])
    else:
        result = collapse_duplicates(described, mpi, DEMOGRAPHICS, mode).distinct()
    return result.filter(F.col("sex") != "").select(client, mpi, *DEMOGRAPHICS)


def groupings(population: DataFrame, servers: DataFrame, client: str = "client", mpi: str = "MPI") -> DataFrame:
    """Security groupings: distinct people per client with the client's server id."""
    return population.select(client, mpi).distinct().join(servers, client).select(client, mpi, "server_id")


def crosswalk(population: DataFrame, servers: DataFrame, client: str = "client", mpi: str = "MPI",
              identifiers: Sequence[str] = ()) -> DataFrame:
    """Identifier crosswalk: people whose id has more than one character."""
    return (
        population.filter(F.col(mpi).isNotNull() & longer_than(F.col(mpi), 1))
        .join(servers, client)
        .select(client, mpi, "server_id", F.lit("").alias("visit_reference_accid"), *identifiers)
    )


def running_counts(grouped: DataFrame, client: str = "client", mpi: str = "MPI") -> DataFrame:
    return grouped.groupBy(client, "server_id").agg(F.count_distinct(mpi).alias("count_distinct_mpi"))


def replace_client_slice(table: DataFrame, fresh: DataFrame, client: str = "client") -> DataFrame:
    """The table with the rows of the rebuilt clients replaced."""
    return table.join(fresh.select(client).distinct(), client, "left_anti").unionByName(fresh)


def target_suffixes(frequency: str) -> list[str]:
    """Tables to fill for a request state: approved requests also fill the approved copy."""
    return ["", "_approved"] if frequency == "Approved" else [""]


def reset_requests(clients: DataFrame) -> DataFrame:
    """Requests that were served are blanked; other states stay."""
    served = F.col("frequency").isin("Approved", "Revised")
    return clients.withColumn("frequency", F.when(served, "").otherwise(F.col("frequency")))


def panel_population(
    panel: DataFrame, master: DataFrame, least_mpi: int = 10, skip_invalid: bool = False, case_insensitive: bool = False
) -> DataFrame:
    """People of a client panel: rows with a gender are validated, matched to the master by name,
    birth date and sex, and kept when the id is at least ``least_mpi``. ``case_insensitive`` matches
    whatever the letter case.

    With ``skip_invalid`` bad rows are left out (they are listed by ``validate_panel``); otherwise
    any bad row fails the job while it runs, as the source stops at the first one.
    """
    checked = validate_panel(panel.filter(F.col("Gender").isNotNull()))
    bad = F.size("errors") > 0
    if skip_invalid:
        checked = checked.filter(~bad)
    else:
        message = F.concat(F.lit("invalid panel row: "), F.array_join("errors", ", "))
        checked = checked.withColumn("Gender", F.when(bad, F.raise_error(message)).otherwise(F.col("Gender")))
    keyed = checked.withColumns(
        {
            "firstname": F.col("Patient First Name"),
            "lastname": F.col("Patient Last Name"),
            "dob": F.col("DOB"),
            "sex": F.left("Gender", F.lit(1)),
        }
    )
    keys = ["lastname", "firstname", "dob", "sex"]
    ids = match_identities(keyed, master, keys, case_insensitive)
    folded = [f"_key_{k}" for k in keys]
    fold = F.lower if case_insensitive else F.col
    return (
        keyed.withColumns({f: fold(k) for f, k in zip(folded, keys)})
        .join(ids.withColumnsRenamed(dict(zip(keys, folded))), folded)
        .filter(F.col("mpi") >= least_mpi)
        .select(
            F.col("mpi"),
            F.col("firstname").alias("first_name"),
            F.col("lastname").alias("last_name"),
            F.date_format(F.try_to_date("dob", "yyyy-MM-dd"), "MM/dd/yyyy").alias("dob"),
            F.col("sex"),
            F.col("Residential Address").alias("street1"),
            "City",
            "State",
            F.col("Zip Code").alias("zip"),
            F.col("Insurance ID").alias("ins_member_id"),
            F.col("CustomText1").alias("client_identifier"),
            F.col("Attributed Facility Provider First Name").alias("provider_first_name"),
            F.lit("placeholder_id").alias("client_identifier_2"),
        )
    )


def panel_plus_visits(panel: DataFrame, visits: DataFrame) -> DataFrame:
    """Panel people and visit people together, each once."""
    return panel.select("mpi").unionByName(visits.select("mpi")).distinct()


def attribution_file(panel: DataFrame, organization_oid: str, organization_name: str, preference: str) -> DataFrame:
    """Attribution file: 25 text columns in fixed order; id 0 is blank, birth date ``MM/dd/yyyy``."""
    constants = {
        "organization_oid": F.lit(organization_oid),
        "organization_name": F.lit(organization_name),
        "delivery_preference": F.lit(preference),
    }
    ready = panel.filter(F.col("Gender").isNotNull() & F.col("mpi").isNotNull()).withColumns(
        {
            "mpi": F.when(F.col("mpi") == 0, "").otherwise(F.col("mpi").cast("string")),
            "DOB": F.date_format(F.try_to_date("DOB", "yyyy-MM-dd"), "MM/dd/yyyy"),
        }
    )

    def value(source: str | None):
        if source is None:
            return F.lit(None).cast("string")
        return constants.get(source, F.col(f"`{source}`").cast("string"))

    return ready.select(*[value(source).alias(out) for out, source in ATTRIBUTION])
