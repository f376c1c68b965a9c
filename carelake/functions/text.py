"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def nine_digit_ssn(col: Column) -> Column:
    return F.lpad(F.replace(col, F.lit("-"), F.lit("")), 9, "0")


def part_after(col: Column, sep: str, index: int = 1) -> Column:
    """``index``-th part (0-based) when the separator occurs, otherwise the whole text."""
    parts = F.split(col, "\\Q" + sep + "\\E")
    return F.when(F.contains(col, F.lit(sep)), F.try_element_at(parts, F.lit(index + 1))).otherwise(col)


def part_or_null(col: Column, sep: str, index: int = 1) -> Column:
    parts = F.split(col, "\\Q" + sep + "\\E")
    return F.try_element_at(parts, F.lit(index + 1))


def bracketed(col: Column, n: int) -> Column:
    """Text inside the ``n``-th pair of square brackets."""
    return F.substring_index(F.substring_index(col, "]", n), "[", -1)


def before(col: Column, sep: str) -> Column:
    return F.substring_index(col, sep, 1)


def after_last(col: Column, sep: str) -> Column:
    return F.substring_index(col, sep, -1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def whole_number_text(col: Column) -> Column:
    """``%.0f`` of a number (halves go to the even neighbour)."""
    return F.bround(col.cast("double"), 0).cast("decimal(38,0)").cast("string")


def trim_zeros(col: Column) -> Column:
    """Decimal text without trailing zeros or a trailing point."""
    fixed = F.format_string("%.6f", col.cast("double"))
    return F.regexp_replace(fixed, r"\.?0+$", "")


def table_name(col: Column) -> Column:
    """A name usable as a table name: spaces, brackets and ``#`` removed, ``-`` to ``_``, lower case."""
    return F.lower(F.translate(col, "- ()#", "_"))


def join_present(tokens: Column, sep: str = " ") -> Column:
    return F.array_join(F.filter(tokens, lambda t: t.isNotNull()), sep)


def clean_session_id(col: Column) -> Column:
    return F.translate(F.trim(col), " -:", "_")


def digest(*cols: Column) -> Column:
    """SHA-1 of the concatenated text, null parts read as empty."""
    return F.sha1(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def name_digest(col: Column) -> Column:
    return F.md5(col.cast("binary"))


def decoded(col: Column) -> Column:
    """URL-decoded text, or the text itself when it is not valid URL encoding."""
    return F.coalesce(F.try_url_decode(col), col)
