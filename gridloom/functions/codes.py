"""Geographic code expressions: parse, compose, pad and look up.

All lookups here are literal maps (``create_map``) evaluated inside
whole-stage codegen: no join, no broadcast, no Python.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the published census codes the source data
# uses; they are reference data, not logic.
# ---------------------------------------------------------------------------

# Two-digit state FIPS code -> postal abbreviation, for the 50 states, DC,
# Puerto Rico and the Virgin Islands (53 entries).
FIPS_TO_STATE: dict[str, str] = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA",
    "08": "CO", "09": "CT", "10": "DE", "11": "DC", "12": "FL",
    "13": "GA", "15": "HI", "16": "ID", "17": "IL", "18": "IN",
    "19": "IA", "20": "KS", "21": "KY", "22": "LA", "23": "ME",
    "24": "MD", "25": "MA", "26": "MI", "27": "MN", "28": "MS",
    "29": "MO", "30": "MT", "31": "NE", "32": "NV", "33": "NH",
    "34": "NJ", "35": "NM", "36": "NY", "37": "NC", "38": "ND",
    "39": "OH", "40": "OK", "41": "OR", "42": "PA", "44": "RI",
    "45": "SC", "46": "SD", "47": "TN", "48": "TX", "49": "UT",
    "50": "VT", "51": "VA", "53": "WA", "54": "WV", "55": "WI",
    "56": "WY", "72": "PR", "78": "VI",
}

# Postal abbreviation -> FIPS for the 50 states and DC (51 entries): the
# domain of the county reference filter and of the sample tables.
STATE_TO_FIPS: dict[str, str] = {
    "AL": "01", "AK": "02", "AZ": "04", "AR": "05", "CA": "06", "CO": "08",
    "CT": "09", "DE": "10", "DC": "11", "FL": "12", "GA": "13", "HI": "15",
    "ID": "16", "IL": "17", "IN": "18", "IA": "19", "KS": "20", "KY": "21",
    "LA": "22", "ME": "23", "MD": "24", "MA": "25", "MI": "26", "MN": "27",
    "MS": "28", "MO": "29", "MT": "30", "NE": "31", "NV": "32", "NH": "33",
    "NJ": "34", "NM": "35", "NY": "36", "NC": "37", "ND": "38", "OH": "39",
    "OK": "40", "OR": "41", "PA": "42", "RI": "44", "SC": "45", "SD": "46",
    "TN": "47", "TX": "48", "UT": "49", "VT": "50", "VA": "51", "WA": "53",
    "WV": "54", "WI": "55", "WY": "56",
}

# Sample tables spell Alaska and Hawaii counties as "<ST>, <name>" instead
# of a code; these are their five-digit county FIPS codes.
AK_NAME_TO_FIPS: dict[str, str] = {
    "AK, Aleutians East Borough": "02013",
    "AK, Aleutians West Census Area": "02016",
    "AK, Anchorage Municipality": "02020",
    "AK, Bethel Census Area": "02050",
    "AK, Bristol Bay Borough": "02060",
    "AK, Denali Borough": "02068",
    "AK, Dillingham Census Area": "02070",
    "AK, Fairbanks North Star Borough": "02090",
    "AK, Haines Borough": "02100",
    "AK, Hoonah-Angoon Census Area": "02105",
    "AK, Juneau City and Borough": "02110",
    "AK, Kenai Peninsula Borough": "02122",
    "AK, Ketchikan Gateway Borough": "02130",
    "AK, Kodiak Island Borough": "02150",
    "AK, Kusilvak Census Area": "02158",
    "AK, Lake and Peninsula Borough": "02164",
    "AK, Matanuska-Susitna Borough": "02170",
    "AK, Nome Census Area": "02180",
    "AK, North Slope Borough": "02185",
    "AK, Northwest Arctic Borough": "02188",
    "AK, Petersburg Borough": "02195",
    "AK, Sitka City and Borough": "02220",
    "AK, Skagway Municipality": "02230",
    "AK, Southeast Fairbanks Census Area": "02240",
    "AK, Valdez-Cordova Census Area": "02261",
    "AK, Wrangell City and Borough": "02275",
    "AK, Yakutat City and Borough": "02282",
    "AK, Yukon-Koyukuk Census Area": "02290",
}

HI_NAME_TO_FIPS: dict[str, str] = {
    "HI, Hawaii County": "15001",
    "HI, Honolulu County": "15003",
    "HI, Kalawao County": "15005",
    "HI, Kauai County": "15007",
    "HI, Maui County": "15009",
}

# County-code pattern "G" + 2-digit state + 4-digit county + "0".
GISJOIN_COUNTY_PATTERN = r"^G(\d{2})(\d{4})0$"

# ---------------------------------------------------------------------------


def literal_map(mapping: dict[str, str]) -> Column:
    """A map literal; lookups with ``element_at`` return null on a miss."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """``mapping.get(key)`` as a codegen expression (null key -> null)."""
    return F.try_element_at(literal_map(mapping), key)


def zfill(col: Column | str, width: int) -> Column:
    """Python ``str.zfill`` for digit strings: left-pad with zeros to
    ``width`` and never truncate (``lpad`` alone cuts longer strings)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def extract_or_null(col: Column | str, pattern: str, idx: int) -> Column:
    """``regexp_extract`` that yields null, not '', when nothing matches."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.regexp_extract(c, pattern, idx), F.lit(""))


def county_code_to_state(code: Column | str) -> Column:
    """State abbreviation of a ``G``-prefixed county code (chars 2-3 are the
    state FIPS); null for anything else or an unknown state."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(
        (F.length(c) >= 3) & c.startswith("G"),
        lookup(FIPS_TO_STATE, F.substring(c, 2, 2)),
    )


def county_fips5(code: Column | str) -> Column:
    """Five-digit county FIPS from a sample-table county value.

    ``G0100010`` -> ``01001`` (state + last three digits of the county
    part); ``AK, <name>`` / ``HI, <name>`` through the name tables; anything
    else null.  The result is zero-filled to five characters without
    truncation.
    """
    c = F.col(code) if isinstance(code, str) else code
    state = extract_or_null(c, GISJOIN_COUNTY_PATTERN, 1)
    county4 = extract_or_null(c, GISJOIN_COUNTY_PATTERN, 2)
    parsed = F.concat(state, F.substring(county4, -3, 3))
    named = (
        F.when(c.startswith("AK, "), lookup(AK_NAME_TO_FIPS, c))
        .when(c.startswith("HI, "), lookup(HI_NAME_TO_FIPS, c))
    )
    return zfill(F.coalesce(parsed, named), 5)


def gisjoin_county(statefp: Column | str, countyfp: Column | str) -> Column:
    """``G`` + state FIPS + county FIPS + ``0`` (the county code of the
    sample tables) from census reference columns."""
    s = F.col(statefp) if isinstance(statefp, str) else statefp
    c = F.col(countyfp) if isinstance(countyfp, str) else countyfp
    return F.concat(F.lit("G"), s, c, F.lit("0"))


def gisjoin_puma(statefp: Column | str, puma: Column | str) -> Column:
    """``G`` + state FIPS + area code zero-filled to six."""
    s = F.col(statefp) if isinstance(statefp, str) else statefp
    return F.concat(F.lit("G"), s, zfill(puma, 6))


def state_fips_prefix(code: Column | str) -> Column:
    """State part of a county code for prefix filters: chars 2-3 of a
    ``G`` code, '' for any other code."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c.startswith("G"), F.substring(c, 2, 2)).otherwise(F.lit(""))
