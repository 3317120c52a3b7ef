"""Metadata records and PDF links from the table cells of item pages.

Everything is decided inside the page's row, on the nested tables of ``page_tables``; no page meets another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.functions import text, urls
from acervo.operators.markup import let, page_tables, page_title
from acervo.session import stored


def _contains_any(c: Column, terms) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | c.contains(term)
    return found


def _row_facts(cells: Column) -> Column:
    """A table row with what its first cell and its texts say."""
    label = text.label(cells[0]["text"])
    words = F.transform(cells, lambda c: F.lower(F.concat_ws(" ", c["text"], c["links"]["href"], c["links"]["text"])))

    def told(r: Column) -> Column:
        by_class = F.lower(r["cells"][0]["cell_class"]).contains(fixed.METADATA_LABEL_CLASS)
        known = by_class | _contains_any(F.lower(r["label"]), fixed.METADATA_TERMS)
        says = lambda *terms: F.exists(r["words"], lambda w: _contains_any(w, terms))
        return F.struct(
            r["cells"].alias("cells"),
            r["label"].alias("label"),
            ((F.size(r["cells"]) >= 2) & (r["label"] != "") & known).alias("is_metadata_row"),
            says("arquivo").alias("says_file"),
            says("formato").alias("says_format"),
            says("pdf", "bitstream").alias("says_pdf"),
        )

    return let(F.struct(cells.alias("cells"), label.alias("label"), words.alias("words")), told)


def table_facts(tables: Column) -> Column:
    """The tables of a page with their files-table and metadata-table tests."""

    def told(t: Column, place: Column) -> Column:
        some = lambda name: F.exists(t["rows"], lambda r: r[name])
        by_words = some("says_file") & some("says_format") & some("says_pdf")
        is_files_table = (
            _contains_any(F.lower(t["heading"]), fixed.FILES_HEADINGS)
            | _contains_any(text.squeeze(F.lower(t["summary"])), fixed.FILES_SUMMARIES)
            | by_words
        )
        metadata_rows = F.size(F.filter(t["rows"], lambda r: r["is_metadata_row"]))
        return F.struct(
            (place + 1).alias("table_no"),
            t["rows"].alias("rows"),
            is_files_table.alias("is_files_table"),
            metadata_rows.alias("metadata_rows"),
            (metadata_rows * 10 + F.size(t["rows"])).cast("long").alias("score"),
        )

    with_rows = F.transform(
        tables,
        lambda t: F.struct(t["heading"].alias("heading"), t["summary"].alias("summary"), F.transform(t["rows"], _row_facts).alias("rows")),
    )
    return F.transform(with_rows, told)


def _metadata_table(facts: Column) -> Column:
    """The page's metadata table, NULL without one: of the highest score, the first of equal ones."""
    candidates = F.filter(facts, lambda t: ~t["is_files_table"] & (t["metadata_rows"] >= 2))
    ranked = F.transform(candidates, lambda t: F.struct(t["score"].alias("score"), (-t["table_no"]).alias("first")))
    return let(F.array_max(ranked), lambda best: F.when(best.isNotNull(), F.try_element_at(facts, -best["first"])))


def metadata_tables(tables: DataFrame) -> DataFrame:
    """The metadata table of each page that has one, from ``page_tables``: page_id, table_no, score."""
    chosen = F.array_compact(F.array(let(table_facts(F.col("tables")), _metadata_table)))
    found = tables.select("page_key", F.inline(chosen)).select("page_key", "table_no", "score")
    return found.dropDuplicates(["page_key"]).select("page_key.page_id", "table_no", "score")


def _row_value(cells: Column) -> Column:
    """Texts of the cells after the label, and link texts not seen before, joined by ``' | '``."""

    def add_link(parts: Column, link: Column) -> Column:
        new = (link["text"] != "") & ~F.array_contains(parts, link["text"])
        return F.when(new, F.concat(parts, F.array(link["text"]))).otherwise(parts)

    def add_cell(parts: Column, cell: Column) -> Column:
        with_text = F.when(cell["text"] != "", F.concat(parts, F.array(cell["text"]))).otherwise(parts)
        return F.aggregate(cell["links"], with_text, add_link)

    parts = F.aggregate(F.slice(cells, 2, F.size(cells)), F.array().cast("array<string>"), add_cell)
    return F.array_join(parts, " | ")


def _first_pdf(cells: Column) -> Column:
    """First link of a row that names a PDF or a bitstream, NULL without one."""
    hrefs = F.flatten(F.transform(cells, lambda c: F.transform(c["links"], lambda link: link["href"])))
    wanted = F.filter(hrefs, lambda h: F.lower(h).contains(".pdf") | F.lower(h).contains("/bitstream/"))
    return F.try_element_at(wanted, F.lit(1))


def _fields(entries: Column) -> Column:
    """Map of label -> its distinct values, both in first-seen order."""
    labels = F.array_distinct(F.transform(entries, lambda e: e["label"]))
    values = F.transform(
        labels,
        lambda k: F.array_distinct(
            F.transform(F.filter(entries, lambda e: e["label"] == k), lambda e: e["value"])
        ),
    )
    return F.map_from_arrays(labels, values)


def _parsed(tables: Column) -> Column:
    """Of a page's tables: how many there are, label and value of the record's rows, the PDF link."""

    def told(facts: Column) -> Column:
        rows = F.filter(
            F.coalesce(_metadata_table(facts)["rows"], F.slice(F.flatten(F.transform(facts, lambda t: t["rows"])), 1, 0)),
            lambda r: (F.size(r["cells"]) >= 2)
            & (r["label"] != "")
            & ~F.btrim(F.lower(r["label"]), F.lit(":")).isin(*fixed.SKIPPED_LABELS),
        )
        has_files_table = F.exists(facts, lambda t: t["is_files_table"])
        searched = F.filter(facts, lambda t: t["is_files_table"] | ~has_files_table)
        links = F.flatten(F.transform(searched, lambda t: F.transform(t["rows"], lambda r: _first_pdf(r["cells"]))))
        return F.struct(
            F.size(facts).alias("tables_found"),
            F.transform(rows, lambda r: F.struct(r["label"].alias("label"), _row_value(r["cells"]).alias("value"))).alias("rows"),
            F.try_element_at(F.filter(links, lambda h: h.isNotNull()), F.lit(1)).alias("pdf"),
        )

    return let(table_facts(tables), told)


def _with_fields(parsed: DataFrame) -> DataFrame:
    """``fields``: the record's labels and their distinct values, from ``rows``.

    Stored texts are decoded thrice more than cell texts; what is left to decode is rare.
    """
    n = F.size("rows")
    texts = F.concat(F.transform("rows", lambda e: e["label"]), F.transform("rows", lambda e: e["value"]))
    decoded = parsed.withColumn("coded", texts).withColumn("texts", text.unescape_all(F.col("coded"), times=3))
    pairs = F.arrays_zip(F.slice("texts", 1, n).alias("label"), F.slice("texts", n + 1, n).alias("value"))
    entries = F.transform(
        pairs, lambda e: F.struct(text.label(e["label"]).alias("label"), text.squeeze(e["value"]).alias("value"))
    )
    kept = F.filter(entries, lambda e: (e["label"] != "") & (e["value"] != ""))
    return decoded.withColumn("entries", kept).withColumn("fields", _fields(F.col("entries"))).drop("coded", "texts", "rows", "entries")


def html_pdf_url(html: Column, url: Column) -> Column:
    """First bitstream link anywhere in the markup, NULL without one."""
    href = F.regexp_extract(html, fixed.BITSTREAM_HREF, 1)
    return F.when(href != "", urls.resolve_url(url, text.unescape(href)))


def parse_pages(pages: DataFrame) -> DataFrame:
    """One row per item page: page_id, url, page_title, tables_found, fields, pdf_url.

    One scan of the markup and no shuffle: title, tables and links are found in the page's row.
    """
    html = F.col("html")
    tables = page_tables(pages, page_title(html).alias("page_title"), html_pdf_url(html, F.col("url")).alias("html_pdf_url"))
    # One row each, as a generator's row: what is made once is not made again for each use of it.
    own = tables.select("page_id", "url", "page_title", "html_pdf_url", F.inline(F.array(_parsed(F.col("tables")))))
    empty = F.create_map().cast("map<string,array<string>>")
    return _with_fields(own).select(
        "page_id",
        "url",
        "page_title",
        F.coalesce("tables_found", F.lit(0)).alias("tables_found"),
        F.coalesce("fields", empty).alias("fields"),
        F.coalesce("pdf", "html_pdf_url").alias("pdf_url"),
    )


def with_fallback(parsed: DataFrame, parsed_full: DataFrame) -> DataFrame:
    """Records of the default pages, taken from the full-record pages where those gave no fields.

    ``parsed_full`` holds the full-record variant under the same page_id. The PDF link of the
    default page wins; the title of the full page wins where it has one.
    """
    full = parsed_full.select(
        "page_id",
        F.col("page_title").alias("full_title"),
        F.col("tables_found").alias("full_tables"),
        F.col("fields").alias("full_fields"),
        F.col("pdf_url").alias("full_pdf"),
    )
    use_full = F.size("fields") == 0
    pick = lambda theirs, ours: F.when(use_full, F.coalesce(theirs, ours)).otherwise(ours)
    return parsed.join(full, "page_id", "left").select(
        "page_id",
        "url",
        pick(F.nullif(F.col("full_title"), F.lit("")), F.col("page_title")).alias("page_title"),
        pick(F.col("full_tables"), F.col("tables_found")).alias("tables_found"),
        pick(F.col("full_fields"), F.col("fields")).alias("fields"),
        F.when(use_full, F.coalesce("pdf_url", "full_pdf")).otherwise(F.col("pdf_url")).alias("pdf_url"),
        F.when(use_full, "show_full").otherwise("default").alias("source_used"),
    )


def records_with_fallback(pages: DataFrame, full_pages: DataFrame) -> DataFrame:
    """Records of ``pages``; only where they have no fields is the full-record page parsed.

    The default records are stored in between, so no page is parsed twice.
    """
    default = stored(parse_pages(pages), "records")
    missing = default.where(F.size("fields") == 0).select("page_id")
    return with_fallback(default, parse_pages(full_pages.join(missing, "page_id", "left_semi")))


def non_system_labels(fields: Column) -> Column:
    """How many labels do not start with an underscore."""
    return F.size(F.filter(F.map_keys(fields), lambda k: ~k.startswith("_")))


def parser_warning(fields: Column) -> Column:
    """The warning of a record without metadata fields, else NULL."""
    return F.when(non_system_labels(fields) == 0, F.lit(fixed.PARSER_WARNING))


def field(name: str) -> Column:
    """A field as it is at rest: one value as text, several as JSON text, NULL without any."""
    return text.joined_or_list(F.try_element_at("fields", F.lit(name)))


def _quoted(c: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def documents(records: DataFrame) -> DataFrame:
    """Stored form of the records: item_id and the JSON document with its system keys.

    A single value is a JSON string, several are a list. Pages whose address has no item id are
    left out; ``rejected_documents`` lists them.
    """
    item = urls.last_segment(F.col("url"))
    system = {
        "_id": item,
        "_source_url": F.col("url"),
        "_pdf_url": F.col("pdf_url"),
        "_parser_warning": parser_warning(F.col("fields")),
    }
    own = F.transform(
        F.map_entries(F.map_filter("fields", lambda k, v: ~k.isin(*system))),
        lambda e: F.concat(
            _quoted(e["key"]),
            F.lit(":"),
            F.when(F.size(e["value"]) == 1, _quoted(e["value"][0])).otherwise(F.to_json(e["value"])),
        ),
    )
    pairs = F.array_compact(F.array(*[F.when(v.isNotNull(), F.concat(F.lit(f'"{k}":'), _quoted(v))) for k, v in system.items()]))
    document = F.concat(F.lit("{"), F.array_join(F.concat(own, pairs), ","), F.lit("}"))
    return records.where(item.isNotNull()).select(item.alias("item_id"), document.alias("document"))


def rejected_documents(records: DataFrame) -> DataFrame:
    """Pages without an item id in their address, with the reason."""
    return records.where(urls.last_segment(F.col("url")).isNull()).select(
        "url", F.lit(500).alias("status"), F.lit(fixed.NO_PAPER_ID).alias("message")
    )
