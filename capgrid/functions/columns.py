"""Column expressions for standardising facility trackers (B*, C*).

Every function returns a `Column` built from Spark built-ins, so the work
stays inside whole-stage codegen.  Maps are passed as Python dicts and become
`map` literals (they are small, fixed vocabularies).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(mapping: Mapping[str, object]) -> Column:
    """A `map<string, ?>` literal from a Python dict."""
    items = []
    for key, value in mapping.items():
        items.extend([F.lit(key), F.lit(value)])
    return F.create_map(*items)


# B1 -----------------------------------------------------------------------
def combined_text(cols: Sequence[ColumnLike], sep: str = "-", prefix: str = "", suffix: str = "") -> Column:
    """`prefix + c1 + sep + c2 ... + suffix`; a null part is written `nan`."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("nan")) for c in cols]
    return F.concat(F.lit(prefix), F.concat_ws(sep, *parts), F.lit(suffix))


# B2 -----------------------------------------------------------------------
def coerce_number(c: ColumnLike) -> Column:
    """Numeric value or null for text that is not a number."""
    return _col(c).try_cast("double")


coerce_year = coerce_number


# B3 -----------------------------------------------------------------------
def map_status(c: ColumnLike, mapping: Mapping[str, str], keep_unmapped: bool = False) -> Column:
    """Status look-up; unmapped -> null (or the text itself for replace-style maps)."""
    looked_up = F.try_element_at(map_literal(mapping), _col(c))
    return F.coalesce(looked_up, _col(c)) if keep_unmapped else looked_up


# B4 -----------------------------------------------------------------------
def clean_technology_key(c: ColumnLike) -> Column:
    """null -> `unknown`, `unknown type` -> `unknown`, strip `/CCS`, trim."""
    filled = F.coalesce(_col(c), F.lit("unknown"))
    filled = F.when(filled == "unknown type", F.lit("unknown")).otherwise(filled)
    return F.trim(F.replace(filled, F.lit("/CCS"), F.lit("")))


def map_technology(c: ColumnLike, mapping: Mapping[str, str], strict: bool = True) -> Column:
    """Technology look-up on the cleaned key; a missing key fails the job when strict."""
    key = clean_technology_key(c)
    value = F.try_element_at(map_literal(mapping), key)
    if not strict:
        return value
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit("technology without an entry in its map: "), key))
    )


def map_plain(c: ColumnLike, mapping: Mapping[str, str], default: str | None = None, strict: bool = True) -> Column:
    """Look-up without cleaning (hydropower plant types, wind installation types)."""
    key = F.coalesce(_col(c), F.lit(default)) if default is not None else _col(c)
    value = F.try_element_at(map_literal(mapping), key)
    if not strict:
        return value
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit("value without an entry in its map: "), F.coalesce(key, F.lit("null"))))
    )


# B5 -----------------------------------------------------------------------
def capacity_rating(c: ColumnLike, default_rating: str = "AC") -> Column:
    """`MWac` -> AC, `MWp/dc` -> DC, null/`unknown` -> default; other text kept (invalid)."""
    filled = F.coalesce(_col(c), F.lit("unknown"))
    filled = F.when(filled == "unknown", F.lit(default_rating)).otherwise(filled)
    return F.when(filled == "MWac", F.lit("AC")).when(filled == "MWp/dc", F.lit("DC")).otherwise(filled)


def ac_capacity(capacity: ColumnLike, rating: ColumnLike, dc_ac_ratio: float, default_rating: str = "AC") -> Column:
    """AC capacity; DC capacity is divided by the ratio; an invalid rating fails the job."""
    r = capacity_rating(rating, default_rating)
    cap = _col(capacity)
    return (
        F.when(r == "AC", cap)
        .when(r == "DC", cap / F.lit(float(dc_ac_ratio)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown capacity rating: "), r)))
    )


# B6 / B7 ------------------------------------------------------------------
def first_present_number(preferred: ColumnLike, fallback: ColumnLike) -> Column:
    """Parse `preferred` when it is present (even if unparsable), else `fallback`."""
    return F.when(_col(preferred).isNotNull(), coerce_number(preferred)).otherwise(coerce_number(fallback))


# B8 -----------------------------------------------------------------------
#: Date layouts tried in order for free-text dates.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM", "yyyy", "MMMM yyyy", "MMM yyyy", "MM/yyyy", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss"]


def year_of_mixed_date(c: ColumnLike, formats: Sequence[str] = tuple(DATE_FORMATS), on_error: str = "null") -> Column:
    """Year of a date written in one of several layouts.

    When none parses: null, or with `on_error="raise"` the job fails and names
    the text.  Nulls and blank texts are null either way.
    """
    if on_error not in ("null", "raise"):
        raise ValueError(f"on_error is 'null' or 'raise', not {on_error!r}")
    text = F.trim(_col(c).cast("string"))
    year = F.year(F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])).cast("double")
    if on_error == "null":
        return year
    return F.when(year.isNull() & (text != ""), F.raise_error(F.concat(F.lit("Date in no known layout: "), text)).cast("double")).otherwise(year)


# B9 -----------------------------------------------------------------------
def midpoint_year(after: ColumnLike, before: ColumnLike) -> Column:
    """Year of the midpoint of a detection window."""
    a = F.unix_micros(_col(after).cast("timestamp"))
    b = F.unix_micros(_col(before).cast("timestamp"))
    mid = a + F.floor((b - a) / F.lit(2))
    return F.year(F.timestamp_micros(mid)).cast("double")


# B10 ----------------------------------------------------------------------
def contains_flag(*cols: ColumnLike, token: str = "CCS") -> Column:
    """True if any column contains `token` (nulls count as empty)."""
    out = F.lit(False)
    for c in cols:
        out = out | F.coalesce(_col(c).contains(token), F.lit(False))
    return out


def yes_flag(c: ColumnLike) -> Column:
    """`== 'yes'`, null -> False."""
    return F.coalesce(_col(c) == F.lit("yes"), F.lit(False))


# B11 ----------------------------------------------------------------------
def coal_fuel_text(coal_type: ColumnLike, alternate_fuel: ColumnLike) -> Column:
    """`coal: <type>` (without `with CCS`; null -> unknown) plus the alternate fuel."""
    ctype = F.concat(F.lit("coal: "), F.coalesce(F.replace(_col(coal_type), F.lit("with CCS"), F.lit("")), F.lit("unknown")))
    alt = F.replace(_col(alternate_fuel), F.lit(" - "), F.lit(": "))
    return F.when(alt.isNotNull(), F.concat(F.trim(ctype), F.lit(", "), F.trim(alt))).otherwise(ctype)


# B12 ----------------------------------------------------------------------
def kw_to_mw(c: ColumnLike) -> Column:
    return _col(c).cast("double") * F.lit(1.0 / 1000.0)


# B13 ----------------------------------------------------------------------
def first_year_in_text(c: ColumnLike) -> Column:
    """First run of four digits in a text, as a number."""
    found = F.regexp_extract(_col(c).cast("string"), r"(\d{4})", 1)
    return F.nullif(found, F.lit("")).try_cast("double")


# B14 ----------------------------------------------------------------------
def offshore_flag(c: ColumnLike) -> Column:
    """`offshore` when the lower-cased text contains `yes`, else `onshore`."""
    text = F.lower(F.coalesce(_col(c).cast("string"), F.lit("nan")))
    return F.when(text.contains("yes"), F.lit("offshore")).otherwise(F.lit("onshore"))


# B16 ----------------------------------------------------------------------
def non_negative_or_null(c: ColumnLike) -> Column:
    return F.when(_col(c) >= 0, _col(c))


# B17 ----------------------------------------------------------------------
def valid_lonlat(lon: ColumnLike, lat: ColumnLike) -> Column:
    """Predicate: a usable geographic point."""
    return _col(lon).between(-180, 180) & _col(lat).between(-90, 90)


# B18 ----------------------------------------------------------------------
def solar_type(c: ColumnLike) -> Column:
    return F.coalesce(_col(c), F.lit("Assumed PV"))


PV_TYPES = ["Assumed PV", "PV"]
CSP_TYPE = "Solar Thermal"


# B19 ----------------------------------------------------------------------
def with_prefix(prefix: str, c: ColumnLike) -> Column:
    """Prefix and id; a missing id is written as `nan`, as in combined texts."""
    return F.concat(F.lit(prefix), F.coalesce(_col(c).cast("string"), F.lit("nan")))


# C1 -----------------------------------------------------------------------
def year_predicate(year: int, how: str, start: ColumnLike = "start_year", end: ColumnLike = "end_year") -> Column:
    """operating: start <= y < end; future: start > y; past: y >= end."""
    s, e, y = _col(start), _col(end), F.lit(year)
    if how == "operating":
        return (s <= y) & (y < e)
    if how == "future":
        return s > y
    if how == "past":
        return y >= e
    raise ValueError(f"how is 'operating', 'future' or 'past', not {how!r}")


# C4 -----------------------------------------------------------------------
def stats_category_predicate(year: int, categories: Sequence[str]) -> Column:
    return (F.col("year") == F.lit(year)) & F.col("category").isin(list(categories))
