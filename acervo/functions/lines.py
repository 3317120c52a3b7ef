"""Rules about single lines of extracted page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.functions.text import squeeze

# Java reads \v as any vertical space, so the vertical tab is spelled \x0B.
_BLANK_RUN = r"[ \t\r\f\x0B]+"
LINE_BREAK = r"[\n\x1c\x1d\x1e\x85\u2028\u2029]"


def _plain_symbols(c: Column) -> Column:
    """NUL and BOM to blanks, ellipsis and middle dot to dots."""
    # Translating goes letter by letter, so texts without these symbols skip it.
    odd = c.contains("\x00") | c.contains("\ufeff") | c.contains("·")
    return F.replace(F.when(odd, F.translate(c, "\x00\ufeff·", "  .")).otherwise(c), F.lit("…"), F.lit("..."))


def normalise_page(c: Column) -> Column:
    """A page's text with single blanks, no blank lines and no outer white space."""
    out = F.regexp_replace(_plain_symbols(c), _BLANK_RUN, " ")
    out = F.regexp_replace(out, r"(?U)\n\s*\n+", "\n")
    out = F.regexp_replace(out, r" *\n *", "\n")
    return F.regexp_replace(out, r"(?U)^\s+|\s+$", "")


def line_chars(c: Column) -> Column:
    """Characters a line adds to its normalised page, 0 for a blank line."""
    line = F.trim(F.regexp_replace(_plain_symbols(c), _BLANK_RUN, " "))
    return F.when(line.rlike(r"(?U)\S"), F.length(line)).otherwise(0)


def normalise_line(c: Column) -> Column:
    """A single line, single-spaced."""
    return squeeze(_plain_symbols(c))


def is_marker(line: Column, pattern: str = fixed.SECTION_MARKER) -> Column:
    """Whether a normalised line is exactly the section title."""
    return line.rlike(pattern)


def is_noise(line: Column) -> Column:
    """Empty lines, lone roman numbers and lone page numbers."""
    return (
        (line == "") | F.lower(line).rlike(fixed.ROMAN_NUMBER_LINE) | line.rlike(fixed.PAGE_NUMBER_LINE)
    )


def has_leader(line: Column) -> Column:
    return line.rlike(fixed.LEADERS)


def has_trailing_number(line: Column) -> Column:
    return line.rlike(fixed.TRAILING_PAGE_NUMBER)


def is_contents_entry(line: Column) -> Column:
    """Whether a normalised line reads like an entry of a table of contents."""
    upper = F.upper(line)
    has_term = upper.rlike("|".join(fixed.CONTENTS_TERMS))
    entry = has_leader(line) | has_trailing_number(line) | has_term | line.rlike(fixed.NUMBERED_HEADING)
    return ~is_noise(line) & entry


def without_leaders(line: Column) -> Column:
    """Leaders become a blank; the page number stays."""
    return squeeze(F.regexp_replace(line, fixed.LEADERS, " "))
