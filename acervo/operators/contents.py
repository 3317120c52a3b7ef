"""Table-of-contents sections from lines of extracted page text.

Lines are ``(doc_id, page_no, line_no, text)`` with whole line numbers, gaps allowed. Counts are
pre-aggregated per page, the section is decided on page rows, and only then are the lines of the
chosen pages read. A page of more than ``LINES_PER_PART`` lines is sorted in parts. All pages count
unless the caller passes ``max_pages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.functions import lines as rules
from acervo.operators.relations import drop_consecutive_repeats
from acervo.session import stored


LINES_PER_PART = 500_000


def scanned_pages(rows: DataFrame, max_pages: int | None) -> DataFrame:
    """The scan cap: rows of the first ``max_pages`` pages; all rows for None."""
    return rows if max_pages is None else rows.where(F.col("page_no") <= max_pages)


def page_lines(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Lines of document pages ``(doc_id, page_no, text)``; pages without text are skipped.

    A page limit is applied before anything is split.
    """
    scanned = scanned_pages(pages, max_pages).where(F.col("text").isNotNull())
    split = F.split(rules.normalise_page(F.col("text")), rules.LINE_BREAK)
    return scanned.select("doc_id", "page_no", F.posexplode(split).alias("line_no", "text"))


def normalised(lines: DataFrame) -> DataFrame:
    """Adds ``line`` (normalised) and ``noise``."""
    return lines.withColumn("line", rules.normalise_line(F.col("text"))).withColumn(
        "noise", rules.is_noise(F.col("line"))
    )


def classified(lines: DataFrame, marker: str = fixed.SECTION_MARKER) -> DataFrame:
    """Adds the line tests: noise, is_marker, is_entry, has_leader, has_number."""
    line = F.col("line")
    return normalised(lines).withColumns(
        {
            "is_marker": rules.is_marker(line, marker) & ~F.col("noise"),
            "is_entry": rules.is_contents_entry(line),
            "has_leader": rules.has_leader(line) & ~F.col("noise"),
            "has_number": rules.has_trailing_number(line) & ~F.col("noise"),
        }
    )


def page_stats(
    lines: DataFrame, marker: str = fixed.SECTION_MARKER, max_pages: int | None = None
) -> DataFrame:
    """Counts per page and whether the page looks like a table of contents."""
    counted = classified(scanned_pages(lines, max_pages), marker).withColumn("chars", rules.line_chars(F.col("text")))
    stats = counted.groupBy("doc_id", "page_no").agg(
        F.count_if(~F.col("noise")).alias("n_lines"),
        F.count_if("is_entry").alias("n_entries"),
        F.count_if("has_number").alias("n_numbers"),
        F.count_if("has_leader").alias("n_leaders"),
        # Line breaks between the non-blank lines count as characters of the page.
        F.coalesce(
            F.sum(F.when(F.col("chars") > 0, F.col("chars") + 1)) - 1, F.lit(0)
        ).alias("n_chars"),
        F.min(F.when(F.col("is_marker"), F.col("line_no"))).alias("marker_line"),
        F.min("line_no").alias("first_line"),
        F.max("line_no").alias("last_line"),
    )
    looks = (
        (F.col("n_entries") >= fixed.MIN_ENTRIES)
        | (F.col("n_numbers") >= fixed.MIN_TRAILING_NUMBERS)
        | (F.col("n_leaders") >= fixed.MIN_LEADERS)
        | F.coalesce(F.try_divide("n_entries", "n_lines") >= fixed.MIN_ENTRY_RATIO, F.lit(False))
    )
    return stats.withColumn("looks_like_contents", looks)


def _with_bounds(stats: DataFrame) -> DataFrame:
    """Marker page and ending page of the document on each of its page rows.

    Two aggregates, so that a document's pages never meet in one task.
    """
    first = F.min("page_no")
    started = stats.where(F.col("marker_line").isNotNull()).groupBy("doc_id").agg(first.alias("marker_page"))
    after = stats.join(started, "doc_id").where((F.col("page_no") > F.col("marker_page")) & ~F.col("looks_like_contents"))
    ended = after.groupBy("doc_id").agg(first.alias("end_page"))
    return stats.join(started.join(ended, "doc_id", "left"), "doc_id", "left")


def section_pages(stats: DataFrame) -> DataFrame:
    """Pages of each document's section: from the marker page to before the first other page."""
    inside = (F.col("page_no") >= F.col("marker_page")) & (
        F.col("end_page").isNull() | (F.col("page_no") < F.col("end_page"))
    )
    from_line = F.when(F.col("page_no") == F.col("marker_page"), F.col("marker_line"))
    parts = F.ceil(F.col("n_lines") / LINES_PER_PART)
    span = F.col("last_line") - F.col("first_line") + 1
    return _with_bounds(stats).where(inside).select(
        "doc_id",
        "page_no",
        from_line.alias("from_line"),
        "first_line",
        F.ceil(span / F.greatest(parts, F.lit(1))).alias("part_width"),
    )


def section_lines(
    lines: DataFrame, stats: DataFrame | None = None, max_pages: int | None = None
) -> DataFrame:
    """Lines of the section, noise off, marker line kept: doc_id, page_no, part, line_no, line.

    Only the lines of the chosen pages are normalised. ``part`` cuts an oversized page, it is 0
    on any other. ``stats`` may hand in a stored ``page_stats``.
    """
    pages = section_pages(page_stats(lines, max_pages=max_pages) if stats is None else stats)
    chosen = (
        scanned_pages(lines, max_pages)
        .join(pages, ["doc_id", "page_no"])
        .where(F.col("from_line").isNull() | (F.col("line_no") >= F.col("from_line")))
    )
    part = F.floor((F.col("line_no") - F.col("first_line")) / F.col("part_width")).cast("int")
    return (
        normalised(chosen)
        .where(~F.col("noise"))
        .select("doc_id", "page_no", part.alias("part"), "line_no", "line")
    )


def clean_section(section: DataFrame) -> DataFrame:
    """Leaders off, then consecutive repeats off."""
    plain = section.withColumn("line", rules.without_leaders(F.col("line")))
    return drop_consecutive_repeats(plain, ["doc_id"], ["page_no", "part"], ["line_no"], "line")


def section_sizes(cleaned: DataFrame) -> DataFrame:
    """Characters of each section's text, counted without building it."""
    last = F.max_by("line", F.struct("page_no", "line_no"))
    return cleaned.groupBy("doc_id").agg(
        (F.sum(F.length("line") + 1) - 1 - F.when(last == "", 1).otherwise(0)).alias("section_chars")
    )


def section_texts(cleaned: DataFrame) -> DataFrame:
    """The section as text, as it is stored: doc_id, section, one row per document of any size.

    Lines are joined per part of a page first and parts per document then.
    """
    by_part = cleaned.groupBy("doc_id", "page_no", "part").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("lines")
    )
    joined = by_part.withColumn("text", F.array_join(F.transform("lines", lambda e: e["line"]), "\n"))
    parts = joined.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "part", "text"))).alias("parts"))
    whole = F.array_join(F.transform("parts", lambda e: e["text"]), "\n")
    return parts.select("doc_id", F.regexp_replace(whole, r"\n+$", "").alias("section"))


def _documents_seen(stats: DataFrame) -> DataFrame:
    """Per document: characters of the scanned pages and whether a marker was found."""
    scanned = F.col("end_page").isNull() | (F.col("page_no") <= F.col("end_page"))
    return _with_bounds(stats).groupBy("doc_id").agg(
        F.sum(F.when(scanned, F.col("n_chars")).otherwise(0)).alias("text_chars"),
        F.max(F.col("marker_page").isNotNull()).alias("has_marker"),
    )


def _with_status(documents: DataFrame) -> DataFrame:
    """Adds status and message from text_chars, has_marker and section_chars."""
    message = (
        F.when(F.col("text_chars") < fixed.MIN_EXTRACTED_TEXT_CHARS, fixed.NOT_ENOUGH_TEXT)
        .when(~F.col("has_marker"), fixed.MARKER_NOT_FOUND)
        .when(F.col("section_chars") < fixed.MIN_SECTION_CHARS, fixed.SECTION_TOO_SHORT)
    )
    return documents.withColumn("message", message).withColumn(
        "status", F.when(F.col("message").isNull(), 200).otherwise(422)
    )


def section_status(
    lines: DataFrame, marker: str = fixed.SECTION_MARKER, max_pages: int | None = None
) -> DataFrame:
    """Outcome per document: doc_id, text_chars, section_chars, status, message (NULL for 200)."""
    stats = stored(page_stats(lines, marker, max_pages), "page-stats")  # read twice below
    sizes = section_sizes(clean_section(section_lines(lines, stats, max_pages)))
    sized = (
        _documents_seen(stats)
        .join(sizes, "doc_id", "left")
        .withColumn("section_chars", F.coalesce("section_chars", F.lit(0)))
    )
    return _with_status(sized).select("doc_id", "text_chars", "section_chars", "status", "message")


def contents_documents(
    lines: DataFrame, marker: str = fixed.SECTION_MARKER, max_pages: int | None = None
) -> DataFrame:
    """Stored form of the sections: doc_id, document (JSON, NULL unless status is 200), status, message."""
    stats = stored(page_stats(lines, marker, max_pages), "page-stats")
    texts = section_texts(clean_section(section_lines(lines, stats, max_pages)))
    sized = (
        _documents_seen(stats)
        .join(texts, "doc_id", "left")
        .withColumn("section_chars", F.coalesce(F.length("section"), F.lit(0)))
    )
    body = F.to_json(
        F.struct(F.col("doc_id").cast("string").alias("paper_id"), F.col("section").alias("tableOfContent"))
    )
    return _with_status(sized).select(
        "doc_id", F.when(F.col("status") == 200, body).alias("document"), "status", "message"
    )


def split_by_status(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows)."""
    return results.where(F.col("status") == 200), results.where(F.col("status") != 200)


def pdf_status(objects: DataFrame) -> DataFrame:
    """Gate for stored objects ``(path, length)``, from their listing only: path, status, message."""
    message = F.when(
        ~F.lower("path").endswith(".pdf"),
        F.concat(F.lit(fixed.NOT_A_PDF), F.col("path")),
    ).when(F.col("length") < fixed.MIN_PDF_BYTES, F.format_string(fixed.PDF_TOO_SMALL, F.col("length")))
    return objects.select(
        "path",
        "length",
        F.when(message.isNull(), 200).otherwise(422).alias("status"),
        message.alias("message"),
    )
