"""Text helpers for the wide delimited input.

All of these are compositions of built-in Spark functions, so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware whitespace except TAB: tabs are field separators and are
# never stripped, so an empty first or last field keeps its position.
_EDGE_SPACE = r"(?U)^[\s&&[^\t]]+|[\s&&[^\t]]+$"
_BLANK = r"(?U)^\s*$"


def strip_line(value: Column) -> Column:
    """Trim leading/trailing whitespace (all Unicode spaces, not just ' ')."""
    return F.regexp_replace(value, _EDGE_SPACE, "")


def is_blank(value: Column) -> Column:
    return value.rlike(_BLANK)


def split_fields(value: Column, sep: str = "\t") -> Column:
    """Split on a literal separator, keeping trailing empty fields."""
    return F.split(value, _regex_quote(sep), -1)


def split_list(value: Column, sep: str = ";") -> Column:
    """Split a packed list field; '' gives [''] like Python's str.split."""
    return F.split(value, _regex_quote(sep), -1)


def list_size(value: Column, sep: str = ";") -> Column:
    """The number of elements of a packed list, without splitting it."""
    return F.length(value) - F.length(F.replace(value, F.lit(sep), F.lit(""))) + 1


def list_chunks(value: Column, size: int, sep: str = ";") -> Column:
    """A packed list cut into packed lists of ``size`` elements, the last one shorter."""
    one = f"[^{_regex_quote(sep)}]*+{_regex_quote(sep)}"
    cut = F.regexp_extract_all(F.concat(value, F.lit(sep)), F.lit(f"(?:{one}){{1,{size}}}"), F.lit(0))
    return F.transform(cut, lambda c: F.substring(c, F.lit(1), F.length(c) - 1))


def first_token(name: Column) -> Column:
    """First whitespace-separated token of a name ('' when there is none)."""
    parts = F.split(F.trim(F.regexp_replace(name, r"(?U)\s+", " ")), " ", 2)
    return F.coalesce(F.get(parts, 0), F.lit(""))


def rest_tokens(name: Column) -> Column:
    """Remaining tokens re-joined by single spaces ('' for one token)."""
    parts = F.split(F.trim(F.regexp_replace(name, r"(?U)\s+", " ")), " ", 2)
    return F.coalesce(F.get(parts, 1), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """FirstName || ' ' || LastName (kept even when LastName is '')."""
    return F.concat(first, F.lit(" "), last)


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
