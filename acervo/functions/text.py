"""Cleaning, splitting and naming of short texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo import fixed_values as fixed

# Unicode white space, plus the four separator controls Java's class leaves out.
_SPACE = r"\s\x1c-\x1f"
#: All runs of it but a single blank, which is what each becomes.
_SPACES = rf"(?U)[{_SPACE}&&[^ ]][{_SPACE}]*| [{_SPACE}]+"


def clean_text(c: Column) -> Column:
    """Upper case, outer blanks off, Portuguese accents off (tabs and Ñ stay).

    A text with as many bytes as characters has no accents and skips the slow translation.
    """
    upper = F.btrim(F.upper(c))
    plain = F.translate(upper, fixed.ACCENTED_LETTERS, fixed.PLAIN_LETTERS)
    return F.when(F.octet_length(c) == F.length(c), upper).otherwise(plain)


def drop_right(c: Column, n: int) -> Column:
    """The text without its last ``n`` characters."""
    return F.left(c, F.length(c) - F.lit(n))


def strip_roman_suffix(c: Column) -> Column:
    """Course level I..IV off the end of an already cleaned discipline."""
    out = c
    for suffix in (" IV", " III", " II", " I"):
        out = F.when(F.endswith(c, F.lit(suffix)), drop_right(c, len(suffix))).otherwise(out)
    return out


def split_discipline(c: Column, part: int) -> Column:
    """Part ``part`` of a discipline whose parts are joined by ``' E '``, ``':'`` or ``','``."""
    unified = c
    for delimiter in (" E ", ":", ","):
        unified = F.replace(unified, F.lit(delimiter), F.lit("/"))
    return F.btrim(F.split_part(unified, F.lit("/"), F.lit(part)))


def citation_name(c: Column) -> Column:
    """``GIVEN NAMES SURNAME`` -> ``SURNAME, GIVEN NAMES``; single names stay."""
    spaced = F.regexp_replace(F.trim(c), r"\s+", " ")
    return F.regexp_replace(spaced, r"^(.*) (\S+)$", "$2, $1")


def cents_to_units(c: Column) -> Column:
    return F.round(c / 100, 2)


def two_decimals(c: Column) -> Column:
    return F.format_string("%.2f", c)


def null_flag(c: Column) -> Column:
    """0 where the value is NULL, else 1."""
    return F.when(c.isNull(), 0).otherwise(1)


def equals_flag(c: Column, value) -> Column:
    """1 where equal, else 0 (NULL gives 0)."""
    return F.when(c == F.lit(value), 1).otherwise(0)


def _decoder(times: int, many: bool = False):
    """Entity decoding, whole Arrow batches at a time.

    The functions are local, so executors get them by value and need no copy of this package.
    """

    def decode(texts: pd.Series) -> pd.Series:
        import html

        for _ in range(times):
            texts = texts.map(html.unescape, na_action="ignore")
        return texts

    def decode_arrays(rows: pd.Series) -> pd.Series:
        return rows.map(lambda row: list(decode(pd.Series(row, dtype="object"))), na_action="ignore")

    return F.pandas_udf(decode_arrays if many else decode, "array<string>" if many else "string")


def unescape(c: Column, times: int = 1) -> Column:
    """HTML entities decoded. All rows go through Python; texts without an ampersand go as NULL."""
    return F.coalesce(_decoder(times)(F.when(c.contains("&"), c)), c)


def unescape_all(c: Column, times: int = 1) -> Column:
    """``unescape`` for an array of texts."""
    return F.coalesce(_decoder(times, many=True)(F.when(F.exists(c, lambda t: t.contains("&")), c)), c)


def squeeze(c: Column) -> Column:
    """Runs of any white space become one blank, outer ones go; NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, _SPACES, " ")), F.lit(""))


def clean_cell(c: Column, times: int = 1) -> Column:
    """Entities decoded, white space squeezed."""
    return squeeze(unescape(c, times))


def label(c: Column) -> Column:
    """A squeezed label without its trailing colons."""
    return F.trim(F.regexp_replace(squeeze(c), r":+$", ""))


def joined_or_list(values: Column) -> Column:
    """One value as it is; several as JSON text, the way a multi-valued label is stored."""
    return F.when(F.size(values) == 1, F.try_element_at(values, F.lit(1))).otherwise(F.to_json(values))
