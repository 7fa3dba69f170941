"""Column expressions for names, codes, addresses and numbers.

All of them are built-in Spark expressions (whole-stage codegen, no Python
worker).  Fixed values that must equal the source system's behaviour are
listed together below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must match the source pipelines) -----------------------
# campus suffix: optional leading quote, shortest name, then " - " (spaces
# around the hyphen may be any whitespace run); only names LIKE '% - %' are
# rewritten.
CAMPUS_PATTERN = r'^"?(.+?)\s+-\s+'
CAMPUS_LIKE = "% - %"
ADDRESS_SEP = ","
DISPLAY_SEP = " - "
CODE_LABEL_SEP = ":"
NULL_TEXT = "None"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_campus_suffix(name) -> Column:
    return _c(name).like(CAMPUS_LIKE)


def campus_base_name(name) -> Column:
    """``'"St Mary - North - Upper'`` -> ``'St Mary'`` (text before the first ' - ')."""
    return F.trim(F.regexp_extract(_c(name), CAMPUS_PATTERN, 1))


def campus_qualified_name(name, campus) -> Column:
    """``name-campus`` when the campus differs from the name (case/space-insensitive)."""
    n, c = _c(name), _c(campus)
    return F.when(F.trim(F.lower(n)) != F.trim(F.lower(c)),
                  F.concat(n, F.lit("-"), c)).otherwise(n)


def code_label_part(value, index: int = 1) -> Column:
    """``'1: New South Wales'`` -> ``'New South Wales'`` for index 1.

    ``get`` yields null when the part is absent (a bare ``[1]`` throws under
    ANSI).
    """
    return F.trim(F.get(F.split(_c(value), CODE_LABEL_SEP), index))


def safe_int(value) -> Column:
    """String -> int; anything that is not an integer literal becomes null."""
    return _c(value).try_cast("int")


def truncating_int(value) -> Column:
    """String -> int the way a non-ANSI cast reads it: ``'12.7'`` -> 12.

    Integer or decimal literals (surrounding spaces allowed) keep their
    integer part; everything else, and values beyond 32 bits, become null.
    """
    whole = F.regexp_extract(F.trim(_c(value).cast("string")), r"^([+-]?[0-9]+)(\.[0-9]*)?$", 1)
    return whole.try_cast("int")


def postcode_prefix(region, width: int = 4) -> Column:
    """Leading ``width`` characters as an int: ``'2000, NSW'`` -> 2000, ``'0800'`` -> 800."""
    return F.substring(_c(region), 1, width).try_cast("int")


def address(*parts) -> Column:
    """Comma-joined address; null parts are skipped, numbers printed as text."""
    return F.concat_ws(ADDRESS_SEP, *[_c(p) for p in parts])


def display_name(name, suburb, postcode, sep: str = DISPLAY_SEP) -> Column:
    """``name - suburb postcode`` (null parts skipped)."""
    return F.concat_ws(sep, _c(name), F.concat_ws(" ", _c(suburb), _c(postcode)))


def strip_leading_zeros(value) -> Column:
    return F.regexp_replace(_c(value), r"^0+", "")


def none_text(value) -> Column:
    """Value as text, null -> ``'None'`` (the serving layer's convention)."""
    return F.coalesce(_c(value).cast("string"), F.lit(NULL_TEXT))
