"""HTML pages as links, titles and table cells.

Input is ``(page_id, url, html)`` with one row per page, so every array and group below is one page and
no larger than one input record. Tables and the links of a container are read inside the page's row: a fold
over its tags keeps what is open. Links are shuffled once, by ``page_key``, to drop repeated pages. The key is made of the page's id, address and markup, so pages without an id, or with
the same one, stay apart; a row that is repeated in all three counts as one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.functions import text, urls

# Comments and script or style elements, whose content is no markup.
_SKIPPED = r"(?is)<!--.*?-->|<(script|style)\b[^>]*+>.*?</\1\s*>"


def _tag_pattern(names: str) -> str:
    """Tags of the given names; quoted values may hold '>'.

    Possessive repeats keep the matcher iterative on long pages.
    """
    return rf"""</?(?:{names})(?=[\s/>])(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+>"""


# Skipped elements, tags, declarations, texts and stray '<'.
_TOKEN = _SKIPPED + "|" + _tag_pattern(r"[a-z][^\s/>]*+") + r"|<[!?/][^>]*+>|[^<]++|<"


# An attribute with a value; a quoted value may hold anything, other attributes' names included.
_ATTRIBUTE = r"""(?is)[^\s"'<>/=]++\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in the text of a start tag, '' where absent; the last of repeated ones.

    The tag is cut into its attributes from the left, so a name inside a quoted value is not met.
    """
    named = rf"(?is)^{name}\s*="
    found = F.filter(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(0)), lambda a: a.rlike(named))
    value = F.regexp_extract(F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit("")), r"(?s)=\s*(.*)$", 1)
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")


def page_key() -> Column:
    """What tells pages apart: the id, and hashes of address and markup."""
    return F.struct("page_id", F.xxhash64("url", "html").alias("h"), F.hash("url", "html").alias("g"))


_TAG_NAME = r"^</?([A-Za-z][^\s/>]*)"


def _named(pattern: str) -> Column:
    """The markup's tokens as an array: pos, tok, tag (lower case, '' for text)."""
    return F.transform(
        F.regexp_extract_all("html", F.lit(pattern), F.lit(0)),
        lambda tok, pos: F.struct(
            pos.alias("pos"), tok.alias("tok"), F.lower(F.regexp_extract(tok, _TAG_NAME, 1)).alias("tag")
        ),
    )


def _container_spans(tags: Column) -> Column:
    """Where wanted containers are open: array of (from, to), from the containers' tags in page order.

    A closing tag closes the last open tag of any container; without one it closes nothing.
    """
    span = "array<struct<from:int,to:int>>"
    last = F.lit(2**31 - 1)
    start = F.struct(
        F.array().cast("array<boolean>").alias("open"), F.lit(0).alias("inside"), F.lit(-1).alias("from"), F.array().cast(span).alias("spans")
    )

    def state(opened: Column, inside: Column, start: Column, spans: Column) -> Column:
        return F.struct(opened.alias("open"), inside.cast("int").alias("inside"), start.cast("int").alias("from"), spans.cast(span).alias("spans"))

    def with_span(s: Column, to: Column) -> Column:
        return F.concat(s["spans"], F.array(F.struct(s["from"].alias("from"), to.cast("int").alias("to"))).cast(span))

    def step(s: Column, t: Column) -> Column:
        closed = F.coalesce(F.try_element_at(s["open"], F.lit(-1)), F.lit(False))
        left = F.slice(s["open"], 1, F.greatest(F.size(s["open"]) - 1, F.lit(0)))
        ends = closed & (s["inside"] == 1)
        closing = state(left, s["inside"] - closed.cast("int"), s["from"], F.when(ends, with_span(s, t["pos"])).otherwise(s["spans"]))
        begins = t["target"] & (s["inside"] == 0)
        opening = state(
            F.concat(s["open"], F.array(t["target"])), s["inside"] + t["target"].cast("int"),
            F.when(begins, t["pos"]).otherwise(s["from"]), s["spans"],
        )
        return F.when(t["closing"], closing).otherwise(opening)

    return F.aggregate(tags, start, step, lambda s: F.when(s["inside"] > 0, with_span(s, last)).otherwise(s["spans"]))


def container_links(
    pages: DataFrame,
    container: str = "table",
    summary: str | None = fixed.SEARCH_TABLE_SUMMARY,
) -> DataFrame:
    """Links inside a container element, resolved, in document order: page_key, page_id, url, pos, link.

    The container is any ``container`` element whose ``summary`` attribute equals ``summary``
    (any such element for None). Nested containers belong to the outer one; a self-closed one is none.
    """
    with_container = pages.where(F.lower("html").contains(f"<{container}"))
    wanted = lambda t: (t["tag"] == "a") | ((t["tag"] == container) & ~t["tok"].endswith("/>"))
    is_target = lambda t: F.lit(True) if summary is None else F.btrim(attribute(t["tok"], "summary"), F.lit(" \t\r\n\f")) == summary

    def read(t: Column) -> Column:
        closing = t["tok"].startswith("</")
        is_container = t["tag"] == container
        return F.struct(
            t["pos"].alias("pos"),
            is_container.alias("is_container"),
            closing.alias("closing"),
            (is_container & ~closing & is_target(t)).alias("target"),
            F.when((t["tag"] == "a") & ~closing, attribute(t["tok"], "href")).alias("coded"),
        )

    tags = F.filter(_named(_SKIPPED + "|" + _tag_pattern(f"{container}|a")), wanted)
    cut = with_container.select(page_key().alias("page_key"), "page_id", "url", F.transform(tags, read).alias("tags"))
    spans = _container_spans(F.filter("tags", lambda t: t["is_container"]))
    inside = lambda t: lambda span: (t["pos"] > span["from"]) & (t["pos"] < span["to"])
    linked = let(
        spans,
        lambda found: F.filter("tags", lambda t: (t["coded"] != "") & F.exists(found, inside(t))),
    )
    # Only a page's links go on, once for all copies of the page.
    kept = cut.select("page_key", "page_id", "url", linked.alias("linked"))
    each = kept.dropDuplicates(["page_key"]).withColumn("coded", F.transform("linked", lambda t: t["coded"]))
    decoded = each.withColumn("decoded", text.unescape_all(F.col("coded")))
    hrefs = F.zip_with("linked", "decoded", lambda t, href: F.struct(t["pos"].alias("pos"), href.alias("href")))
    rows = decoded.select("page_key", "page_id", "url", F.inline(F.filter(hrefs, lambda h: h["href"] != "")))
    return rows.select("page_key", "page_id", "url", "pos", urls.resolve_url(F.col("url"), F.col("href")).alias("link"))


def item_links(links: DataFrame, pattern: str = fixed.ITEM_PATH) -> DataFrame:
    """Item links of each page, each once, with the position it was first seen at."""
    kept = links.where(urls.is_item_link(F.col("link"), pattern))
    firsts = kept.groupBy("page_key", "link").agg(F.min("pos").alias("first_pos"))
    return firsts.select("page_key", "page_key.page_id", "link", "first_pos")


def _element_text(markup: Column) -> Column:
    """Text of an element's inner markup: tags to blanks, entities decoded, squeezed."""
    return text.clean_cell(F.regexp_replace(markup, r"<[^>]*>", " "), times=2)


def page_title(html: Column) -> Column:
    """Cleaned text of the last title element."""
    visible = F.regexp_replace(html, _SKIPPED, "")
    return _element_text(F.regexp_extract(visible, r"(?is)^.*<title\b[^>]*>(.*?)</title\s*>", 1))


def first_heading(html: Column) -> Column:
    """Cleaned text of the first main heading."""
    visible = F.regexp_replace(html, _SKIPPED, "")
    return _element_text(F.regexp_extract(visible, r"(?is)<h1\b[^>]*>(.*?)</h[1-6]\s*>", 1))


def page_titles(pages: DataFrame) -> DataFrame:
    """Title and main heading of each page; per row, no shuffle."""
    html = F.col("html")
    return pages.select(
        "page_id", page_title(html).alias("page_title"), first_heading(html).alias("first_heading")
    )


_TABLE_TAGS = ["table", "tr", "td", "th", "a", "h1", "h2", "h3", "h4", "h5", "h6"]
_CELL = "struct<open:int,close:int>"
# What the fold over a page's tags keeps: how deep in tables it is and where the outermost one opened,
# whether in a row, where the open cell began; the cells of the row, the rows of the table, the tables.
_STATE = {
    "depth": "int",
    "top": "int",
    "in_row": "boolean",
    "cell": "int",
    "row": f"array<{_CELL}>",
    "rows": f"array<array<{_CELL}>>",
    "tables": f"array<struct<top:int,rows:array<array<{_CELL}>>>>",
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used in it."""
    return F.transform(F.array(value), body)[0]


def _events(html: Column) -> Column:
    """Tags of tables, links and headings and all texts: tag ('' for text), closing, coded.

    ``coded`` is the text of a text, the href, class or summary of a tag. Element bodies and attributes
    are decoded once and texts twice, so the former are escaped before all take the same way.
    """
    raw = lambda t: t["tag"].isin("script", "style")
    blank = r"(?U)^[^\S<]*+(?:[^\s<]|<(?![!?/]))"
    wanted = lambda t: (
        raw(t) | (t["tag"].isin(*_TABLE_TAGS) & ~t["tok"].endswith("/>")) | ((t["tag"] == "") & t["tok"].rlike(blank))
    )

    def event(t: Column) -> Column:
        escaped = lambda c: F.replace(c, F.lit("&"), F.lit("&amp;"))
        closing = t["tok"].startswith("</")
        value = (
            F.when(t["tag"] == "", t["tok"])
            .when(raw(t), escaped(F.regexp_extract(t["tok"], r"(?is)^<(?:script|style)[^>]*>(.*)</", 1)))
            .when(closing, "")
            .when(t["tag"] == "a", escaped(attribute(t["tok"], "href")))
            .when(t["tag"].isin("td", "th"), escaped(attribute(t["tok"], "class")))
            .when(t["tag"] == "table", escaped(attribute(t["tok"], "summary")))
            .otherwise("")
        )
        closes = (t["tag"] != "") & ~raw(t) & closing
        return F.struct(F.when(raw(t), "").otherwise(t["tag"]).alias("tag"), closes.alias("closing"), value.alias("coded"))

    with_tables = F.lower(html).contains("<table")
    return F.when(with_tables, F.transform(F.filter(_named(_TOKEN), wanted), event))


def _table_spans(events: Column) -> Column:
    """Outermost tables with their complete rows and cells, as places in ``events``: top, rows of (open, close).

    A nested table's rows count as rows of the table around it, and a closing tag outside any table is
    ignored. A cell runs to the next cell tag and counts if that closes it, while a row is open. A row
    counts if it is closed before another one opens, a table if it is closed.
    """
    tags = F.transform(events, lambda e, i: F.struct(i.alias("at"), e["tag"].alias("tag"), e["closing"].alias("closing")))
    tags = F.filter(tags, lambda e: e["tag"].isin("table", "tr", "td", "th"))
    none = {name: F.lit(None).cast(kind) for name, kind in _STATE.items()}
    empty = lambda name: F.array().cast(_STATE[name])
    start = none | {"depth": F.lit(0), "in_row": F.lit(False), "cell": F.lit(-1)} | {n: empty(n) for n in ("row", "rows", "tables")}

    def state(s: Column, **changed: Column) -> Column:
        return F.struct(*[changed.get(name, s[name]).cast(kind).alias(name) for name, kind in _STATE.items()])

    def added(array: Column, item: Column, name: str) -> Column:
        return F.concat(array, F.array(item).cast(_STATE[name]))

    def table_tag(s: Column, e: Column) -> Column:
        opened = state(s, depth=s["depth"] + 1, top=F.when(s["depth"] == 0, e["at"]).otherwise(s["top"]))
        whole = F.struct(s["top"].alias("top"), s["rows"].alias("rows"))
        done = F.when(F.size(s["rows"]) > 0, added(s["tables"], whole, "tables")).otherwise(s["tables"])
        left = state(s, depth=F.lit(0), row=empty("row"), rows=empty("rows"), tables=done)
        return F.when(~e["closing"], opened).when(s["depth"] <= 1, left).otherwise(state(s, depth=s["depth"] - 1))

    def row_tag(s: Column, e: Column) -> Column:
        rows = F.when(F.size(s["row"]) > 0, added(s["rows"], s["row"], "rows")).otherwise(s["rows"])
        closed = state(s, in_row=F.lit(False), row=empty("row"), rows=rows)
        return F.when(e["closing"], closed).otherwise(state(s, in_row=F.lit(True), row=empty("row")))

    def cell_tag(s: Column, e: Column) -> Column:
        cell = F.struct(s["cell"].alias("open"), e["at"].alias("close"))
        row = F.when((s["cell"] >= 0) & s["in_row"], added(s["row"], cell, "row")).otherwise(s["row"])
        return F.when(e["closing"], state(s, cell=F.lit(-1), row=row)).otherwise(state(s, cell=e["at"]))

    def step(s: Column, e: Column) -> Column:
        inside = s["depth"] > 0
        return (
            F.when(e["tag"] == "table", table_tag(s, e))
            .when(inside & (e["tag"] == "tr"), row_tag(s, e))
            .when(inside & (e["tag"] != "tr"), cell_tag(s, e))
            .otherwise(s)
        )

    initial = F.struct(*[start[name].cast(kind).alias(name) for name, kind in _STATE.items()])
    return F.aggregate(tags, initial, step, lambda s: s["tables"])


def _between(events: Column, opened: Column, closed: Column) -> Column:
    """The events between two places."""
    return F.slice(events, opened + 2, closed - opened - 1)


def _said(events: Column) -> Column:
    """The texts among events, joined and squeezed."""
    texts = F.transform(F.filter(events, lambda e: e["tag"] == ""), lambda e: e["value"])
    return text.squeeze(F.array_join(texts, " "))


def _pairs(array: Column) -> Column:
    """Each element with the next one: one, next."""
    return F.zip_with(
        F.slice(array, 1, F.greatest(F.size(array) - 1, F.lit(0))),
        F.slice(array, 2, F.greatest(F.size(array) - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("one"), b.alias("next")),
    )


def _placed(events: Column, wanted) -> Column:
    """The wanted events with their places."""
    placed = F.transform(events, lambda e, i: F.struct(i.alias("at"), e["tag"].alias("tag"), e["closing"].alias("closing"), e["value"].alias("value")))
    return F.filter(placed, wanted)


def _links(inner: Column, url: Column) -> Column:
    """Links of a cell: an opening tag with an address counts when the next link tag closes it."""
    tags = _placed(inner, lambda e: (e["tag"] == "a") & (e["closing"] | (e["value"] != "")))
    closed = F.filter(_pairs(tags), lambda p: ~p["one"]["closing"] & p["next"]["closing"])
    return F.transform(
        closed,
        lambda p: F.struct(
            urls.resolve_url(url, p["one"]["value"]).alias("href"),
            _said(_between(inner, p["one"]["at"], p["next"]["at"])).alias("text"),
        ),
    )


def _headings(events: Column) -> Column:
    """Headings that are not empty: at (where it closes), text."""
    tags = _placed(events, lambda e: e["tag"].rlike("^h[1-6]$"))
    closed = F.filter(_pairs(tags), lambda p: ~p["one"]["closing"] & p["next"]["closing"])
    found = F.transform(
        closed,
        lambda p: F.struct(p["next"]["at"].alias("at"), _said(_between(events, p["one"]["at"], p["next"]["at"])).alias("text")),
    )
    return F.filter(found, lambda h: h["text"] != "")


def _filled_tables(events: Column, spans: Column, url: Column) -> Column:
    """The tables with their contents, without empty cells, rows and tables: heading, summary, rows of cells."""

    def cell(c: Column) -> Column:
        content = lambda inner: F.struct(
            _said(inner).alias("text"), events[c["open"]]["value"].alias("cell_class"), _links(inner, url).alias("links")
        )
        return let(_between(events, c["open"], c["close"]), content)

    def row(cells: Column) -> Column:
        return F.filter(F.transform(cells, cell), lambda c: (c["text"] != "") | (F.size(c["links"]) > 0))

    def table(headings: Column):
        def of_span(s: Column) -> Column:
            before = F.filter(headings, lambda h: h["at"] < s["top"])
            return F.struct(
                F.coalesce(F.try_element_at(before, F.lit(-1))["text"], F.lit("")).alias("heading"),
                events[s["top"]]["value"].alias("summary"),
                F.filter(F.transform(s["rows"], row), lambda r: F.size(r) > 0).alias("rows"),
            )

        return of_span

    tables = let(_headings(events), lambda headings: F.transform(spans, table(headings)))
    return F.filter(tables, lambda t: F.size(t["rows"]) > 0)


def page_tables(pages: DataFrame, *carried: Column) -> DataFrame:
    """A row per page row: page_key, page_id, url, what is ``carried``, and its outermost tables.

    ``tables``: array of heading (the last one before the table), summary and rows, arrays of cells with
    text, cell_class and links ``array<struct<href,text>>``. Empty cells, rows without a closing tag,
    empty rows and tables without rows are left out. Nothing is shuffled.
    """
    cut = pages.select(page_key().alias("page_key"), "page_id", "url", *carried, _events(F.col("html")).alias("events"))
    coded = cut.withColumn("coded", F.transform("events", lambda e: e["coded"]))
    decoded = coded.withColumn("decoded", text.unescape_all(F.col("coded"), times=2))
    told = F.zip_with(
        "events", "decoded", lambda e, v: F.struct(e["tag"].alias("tag"), e["closing"].alias("closing"), v.alias("value"))
    )
    tables = let(told, lambda events: _filled_tables(events, _table_spans(events), F.col("url")))
    return decoded.withColumn("tables", tables).drop("events", "coded", "decoded")


def table_cells(pages: DataFrame) -> DataFrame:
    """Non-empty cells of the outermost tables, in flat form; a repeated page row counts once.

    Columns: page_key, page_id, url, table_no, row_no, cell_no (all from 1), text, cell_class,
    links ``array<struct<href,text>>``, heading (last one before the table), summary.
    """
    each = page_tables(pages).dropDuplicates(["page_key"])
    tables = each.select("page_key", "page_id", "url", F.posexplode("tables").alias("t", "table"))
    rows = tables.select("*", F.posexplode("table.rows").alias("r", "cells"))
    cells = rows.select("*", F.posexplode("cells").alias("c", "cell"))
    return cells.select(
        "page_key",
        "page_id",
        "url",
        (F.col("t") + 1).alias("table_no"),
        (F.col("r") + 1).alias("row_no"),
        (F.col("c") + 1).alias("cell_no"),
        "cell.text",
        "cell.cell_class",
        "cell.links",
        "table.heading",
        "table.summary",
    )
