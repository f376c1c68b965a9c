"""Default crosswalk from raw state text to a standard name.

The spellings of a state follow a rule (FIPS number with and without its leading zero, postal
code in any letter case and with a trailing blank, the name as is, lower and upper case), so only
the base table is stored. Spellings beside the rule are listed as they are written. Users with another
code list pass their own crosswalk DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import literal_rows

# FIPS number, postal code, name.
US_STATES = [
    ("01", "AL", "Alabama"),
    ("02", "AK", "Alaska"),
    ("04", "AZ", "Arizona"),
    ("05", "AR", "Arkansas"),
    ("06", "CA", "California"),
    ("08", "CO", "Colorado"),
    ("09", "CT", "Connecticut"),
    ("10", "DE", "Delaware"),
    ("11", "DC", "District of Columbia"),
    ("12", "FL", "Florida"),
    ("13", "GA", "Georgia"),
    ("66", "GU", "Guam"),
    ("15", "HI", "Hawaii"),
    ("16", "ID", "Idaho"),
    ("17", "IL", "Illinois"),
    ("18", "IN", "Indiana"),
    ("19", "IA", "Iowa"),
    ("20", "KS", "Kansas"),
    ("21", "KY", "Kentucky"),
    ("22", "LA", "Louisiana"),
    ("23", "ME", "Maine"),
    ("24", "MD", "Maryland"),
    ("25", "MA", "Massachusetts"),
    ("26", "MI", "Michigan"),
    ("27", "MN", "Minnesota"),
    ("28", "MS", "Mississippi"),
    ("29", "MO", "Missouri"),
    ("30", "MT", "Montana"),
    ("31", "NE", "Nebraska"),
    ("32", "NV", "Nevada"),
    ("33", "NH", "New Hampshire"),
    ("34", "NJ", "New Jersey"),
    ("35", "NM", "New Mexico"),
    ("36", "NY", "New York"),
    ("37", "NC", "North Carolina"),
    ("38", "ND", "North Dakota"),
    ("39", "OH", "Ohio"),
    ("40", "OK", "Oklahoma"),
    ("41", "OR", "Oregon"),
    ("42", "PA", "Pennsylvania"),
    ("44", "RI", "Rhode Island"),
    ("45", "SC", "South Carolina"),
    ("46", "SD", "South Dakota"),
    ("47", "TN", "Tennessee"),
    ("48", "TX", "Texas"),
    ("49", "UT", "Utah"),
    ("50", "VT", "Vermont"),
    ("78", "VI", "Virgin Islands"),
    ("51", "VA", "Virginia"),
    ("53", "WA", "Washington"),
    ("54", "WV", "West Virginia"),
    ("55", "WI", "Wisconsin"),
    ("56", "WY", "Wyoming"),
]

# Codes and names read as Canada.
CANADA = [
    "AB", "Alberta", "B.C.", "BC", "British Columbia", "BRITISHCOLUMBIA", "CAN", "Canada", "Manitoba", "MB",
    "NB", "NL", "Northwest Territories", "Nova Scotia", "NOVASCOTIA", "NS", "ON", "ONT", "Ontario", "PE",
    "PQ", "QC", "Quebec", "Saskatchewan", "SK",
]

# Other spellings by what they stand for, matched exactly as written.
OTHER = {
    "Afghanistan": ["AF"],
    "Algeria": ["AG"],
    "American Samoa": ["AMERICANSAMOA", "AS"],
    "Arizona": ["Ari"],
    "Arkansas": ["ARK", "Ark"],
    "Armed Forces": ["AA", "aa", "AE", "AP", "AP ", "ARMEDFORCESOTHER", "ARMFORCAMEREXCPTCAN"],
    "Australia": ["Au", "AU"],
    "Austria": ["OS"],
    "Bahamas": ["BS"],
    "Barbados": ["BB"],
    "Belarus": ["BY"],
    "Bosnia and Herzegovina": ["BA"],
    "Brazil": ["BR"],
    "British Indian Ocean Territory": ["IO", "io"],
    "Bulgaria": ["Bulgaria"],
    "Burkina Faso": ["UV"],
    "California": ["95403", "95404", "95476", " CA"],
    "Canada": ["On"],
    "Chile": ["CL"],
    "China": ["CN", "CHINA"],
    "Christmas Island": ["KT"],
    "Clipperton Island": ["CP"],
    "Connecticut": ["06114", "06278", "06810"],
    "Costa Rica": ["CR"],
    "Cote dIvoire": ["CI"],
    "Czech Republic": ["Czechia", "CZ"],
    "Denmark": ["DK"],
    "Dominican Republic": ["DR", "DO"],
    "Egypt": ["EG"],
    "El Salvador": ["SV"],
    "England": ["England", "england", "ENGLAND"],
    "Etorofu, Habomai, Kunashiri, and Shikotan Islands": ["PJ"],
    "Faroe Islands": ["FO", "Fo"],
    "Federated States of Micronesia": ["FEDSTATESMICRONESIA", "FM"],
    "France": ["France", "FR"],
    "French Southern Territories": ["JC"],
    "Fujairah": ["XF"],
    "Gambia": ["GM"],
    "Georgia": ["Ga ", "GE"],
    "Germany": ["Germany", "GERMANY", "germany"],
    "Great Britain": ["GB"],
    "Greece": ["GR"],
    "Guatamala": ["GT"],
    "Hondurus": ["HO"],
    "Iceland": ["IS"],
    "Illinois": ["Ilinois", "Ill", "ill"],
    "Ireland": ["Ireland", "IE"],
    "Italy": ["IT"],
    "Jamaica": ["Jamaica", "JM"],
    "Japan": ["JA", "JP"],
    "Kaduna": ["KD", "Kd"],
    "Kansas": ["Ka", "Kan", "kANSAS", "Kasnas", "ks ", "KS - KANSAS", "KSks"],
    "Kazakhstan": ["KZ"],
    "Kenya": ["KE"],
    "Lesotho": ["LS"],
    "Louisiana": ["71082"],
    "Madagascar": ["MG"],
    "Malaysia": ["mY"],
    "Malta": ["LM"],
    "Marshall Islands": ["MH"],
    "Mayotte": ["YT"],
    "Mexico": ["ESTADODEMEXICO", "Jalisco", "JALISCO", "NAY", "NAYARIT", "CHIH", "DF", "DG"],
    "Michigan": ["MICH"],
    "Minnesota": ["Min"],
    "Missouri": ["Mis", "MO 64106", "MO64030"],
    "Montana": ["Mon"],
    "Montenegro": ["MJ"],
    "Myanmar": ["MM"],
    "Namibia": ["nA"],
    "Nepal": ["NP"],
    "Netherlands": ["N.L."],
    "Netherlands Antilles": ["NT"],
    "New South Wales": ["NSW"],
    "New Zealand": ["NZ"],
    "Nicaragua": ["NI"],
    "Nigeria": ["NG"],
    "Northern Mariana Islands": ["NW", "MP"],
    "Oceania": ["QT"],
    "Oklahoma": ["Okl"],
    "Oman": ["OO", "oo"],
    "Palestine": ["PS"],
    "Pitcairn Islands": ["PN"],
    "Polynesia": ["QU"],
    "Portugal": ["PO"],
    "Puerto Rico": ["PR", "PUE"],
    "Qatar": ["QA"],
    "Romania": ["RO"],
    "Russia": ["RUSSIA", "RU"],
    "Rwanda": ["RW"],
    "Saint Barthélemy": ["BL"],
    "Samoa": ["WS"],
    "Serbia and Montenegro": ["CS"],
    "Sierra Leone": ["SL"],
    "Slovakia": ["LO"],
    "Somalia": ["SO", "So"],
    "South Africa": ["SF"],
    "South Australia": ["SA", "sa"],
    "Spain": ["SP", "Sp", "ES"],
    "Sweden": ["SW", "Sweden", "SE"],
    "Switzerland": ["Switzerlan", "CH"],
    "Texas": ["Tex", "TX."],
    "Thailand": ["TH"],
    "Timor-Leste": ["TL"],
    "Turkmenistan": ["TM"],
    "Turks and Caicos": ["TC"],
    "Union of Soviet Socialist Republics": ["UR"],
    "United Kingdom": ["uk"],
    "United States Minor Outlying Islands": ["UM"],
    "Venezuela": ["ve"],
    "Zhejiang Province": ["ZJ"],
}


def state_crosswalk(spark: SparkSession) -> DataFrame:
    """Columns ``raw``, ``standard``, ``rank``; the least rank wins for a raw value."""
    states = literal_rows(spark, US_STATES, "fips string, code string, name string")
    code, name, fips = F.col("code"), F.col("name"), F.col("fips")
    cased = [
        F.upper(code),
        F.lower(code),
        F.initcap(code),
        F.concat(F.lower(F.left(code, F.lit(1))), F.upper(F.right(code, F.lit(1)))),
    ]
    spellings = F.array(
        fips, F.ltrim(fips, F.lit("0")), *cased, F.concat(code, F.lit(" ")), name, F.lower(name), F.upper(name)
    )
    usa = states.select(F.explode(F.array_distinct(spellings)).alias("raw"), name.alias("standard"), F.lit(1).alias("rank"))
    canada = (
        literal_rows(spark, [(c,) for c in CANADA], "c string")
        .select(F.explode(F.array("c", F.upper("c"), F.lower("c"))).alias("raw"))
        .distinct()
        .select("raw", F.lit("Canada").alias("standard"), F.lit(2).alias("rank"))
    )
    other = literal_rows(
        spark, [(raw, name) for name, spellings in OTHER.items() for raw in spellings], "raw string, standard string"
    ).withColumn("rank", F.lit(3))
    return usa.unionByName(canada).unionByName(other)
