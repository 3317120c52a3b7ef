from __future__ import annotations

import json

from pyspark.sql import functions as F

from acervo.operators import markup, records
from tables import rows

URL = "https://h.example/handle/p/7"
SEARCH = "This table browses all dspace content"


def _pages(spark, *htmls, url=URL):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string")


def _links(spark, html):
    got = markup.container_links(_pages(spark, html)).orderBy("pos").collect()
    return [r["link"] for r in got]


def test_links_of_the_search_table(spark):
    html = f"""<a href="/handle/p/1">before</a></table>
      <table summary="other"><tr><td><a href="/handle/p/2">x</a></td></tr></table>
      <TABLE class=a summary=" {SEARCH} "><tr><td><A HREF='/handle/p/3'>x</A>
        <table><tr><td><a href="/handle/p/4?a=1&amp;b=2#f">nested</a></td></tr></table>
        <!-- <table> <a href="/handle/p/5"> --><script>var t="</table>";</script>
        <a href="/handle/p/3">again</a><a name="anchor">none</a><a href="">empty</a><a href="/about">about</a>
        <a title="a > b" href="/handle/p/6">quoted</a></td></tr></table>
      <a href="/handle/p/8">after</a>"""
    host = "https://h.example"
    assert _links(spark, html) == [
        f"{host}/handle/p/3",
        f"{host}/handle/p/4?a=1&b=2",
        f"{host}/handle/p/3",
        f"{host}/about",
        f"{host}/handle/p/6",
    ]
    items = markup.item_links(markup.container_links(_pages(spark, html))).orderBy("first_pos")
    assert [r["link"] for r in items.collect()] == [f"{host}/handle/p/3", f"{host}/handle/p/4?a=1&b=2", f"{host}/handle/p/6"]


def test_attributes_are_cut_from_the_left(spark):
    html = f"""<table summary='{SEARCH}'><a title='see href=/handle/9/9' href='/handle/1/2'>x</a><a href=/a href = "/b">y</a>
      <table/><a data-href="/no" href=c>z</a></table><a href="/after">w</a>"""
    host = "https://h.example"
    assert _links(spark, html) == [f"{host}/handle/1/2", f"{host}/b", f"{host}/handle/p/c"]


def test_pages_without_an_id_or_with_the_same_one(spark):
    table = _table(("Título", "{}"), ("Autor", "{}"))
    data = [(None, URL, table.format("a", "b")), (None, URL + "1", table.format("c", "d")), (3, URL, table.format("e", "f")), (3, URL, table.format("g", "h"))]
    df = spark.createDataFrame([*data, data[3]], "page_id bigint, url string, html string")
    got = records.parse_pages(df).select("page_id", "tables_found", records.field("Título"))
    assert rows(got) == [(3, 1, "e"), (3, 1, "g"), (3, 1, "g"), (None, 1, "a"), (None, 1, "c")]


def test_unclosed_search_table_runs_to_the_end(spark):
    assert _links(spark, f'<table summary="{SEARCH}"><a href="/x">x</a><table></table><a href="/y">y</a>') == [
        "https://h.example/x",
        "https://h.example/y",
    ]


def test_titles(spark):
    html = '<title>One</title><script>"<title>no</title>"</script><title> T&amp;amp;w <b>o</b>\n</title><h1>a<br>b</h1><h1>c</h1>'
    assert rows(markup.page_titles(_pages(spark, html, "<p>none</p>"))) == [(0, "T&w o", "a b"), (1, "", "")]


def _cells(spark, html):
    got = markup.table_cells(_pages(spark, html)).select("table_no", "row_no", "cell_no", "text")
    return [tuple(r) for r in got.orderBy("table_no", "row_no", "cell_no").collect()]


def test_cells(spark):
    html = """<table><tr><th>A<br>1</th><td> b  <i>c</i>&nbsp;d </td></tr><tr><td> </td></tr><tr></tr>
      <tr><td></td><td>x</td></tr></table><table><tr><td> </td></tr></table><table><tr><td>last</td></tr></table>"""
    assert _cells(spark, html) == [(1, 1, 1, "A 1"), (1, 1, 2, "b c d"), (1, 2, 1, "x"), (2, 1, 1, "last")]


def test_malformed_tables(spark):
    # The first cell of the row never closes, the third row never closes, the last table never closes.
    html = """</table><tr><td>outside</td></tr><table><tr><td>lost<td>kept</td></td></tr>
      <tr><td>row without end</td><tr><td>next</td></tr></table><table><tr><td>open table</td></tr>"""
    assert _cells(spark, html) == [(1, 1, 1, "kept"), (1, 2, 1, "next")]


def test_nested_rows_belong_to_the_outer_table(spark):
    html = "<table><tr><td>outer <table><tr><td>k</td><td>v</td></tr></table> rest</td></tr><tr><td>z</td></tr></table>"
    assert _cells(spark, html) == [(1, 1, 1, "k"), (1, 1, 2, "v"), (1, 2, 1, "z")]


def test_links_headings_and_summaries_of_cells(spark):
    html = """<h1>First</h1><h2> </h2><table summary="S &amp; T"><tr><td class="C"><a href="../x#f">a <b>b</b></a>,
      <a href="y">unclosed <a href="z">c</a><a>no href</a></td></tr></table><h3>Second</h3><table><tr><td>1</td></tr></table>"""
    got = markup.table_cells(_pages(spark, html)).orderBy("table_no").collect()
    assert [(r["heading"], r["summary"], r["cell_class"], r["text"]) for r in got] == [
        ("First", "S & T", "C", "a b , unclosed c no href"),
        ("Second", "", "", "1"),
    ]
    assert [tuple(link) for link in got[0]["links"]] == [("https://h.example/handle/x", "a b"), ("https://h.example/handle/p/z", "c")]


def _table(*pairs, css=""):
    return "<table>" + "".join(f'<tr><td class="{css}">{k}</td><td>{v}</td></tr>' for k, v in pairs) + "</table>"


def test_metadata_table_choice(spark):
    by_class = _table(("Foo", "1"), ("Bar", "2"), css="MetadataFieldLabel")
    tied = _table(("Título", "1"), ("Autor", "2"))
    one_row = _table(("Título", "1"))
    files = "<h2>Files in this item</h2>" + _table(("Title", "a"), ("Date", "b"), ("Type", "c"))
    got = records.metadata_tables(
        markup.page_tables(_pages(spark, by_class + tied, one_row + tied, one_row, files, tied + by_class + tied))
    )
    assert rows(got) == [(0, 1, 22), (1, 2, 22), (4, 1, 22)]


def _parsed(spark, *htmls):
    return {r["page_id"]: r for r in records.parse_pages(_pages(spark, *htmls)).collect()}


def test_record(spark):
    html = "<title>T</title>" + _table(
        ("Título: :", "Um"),
        ("Autor(es)", "Silva"),
        ("Autor(es):", "Souza"),
        ("Autor(es)", "Silva"),
        ("Descrição", "skipped"),
        ("Vazio", " "),
        ("URI", 'x <a href="/l">l</a> <a href="/m">x <i>l</i></a>'),
        ("Data", "1</td><td>2"),
        ("Nota", "&amp;amp;lt;b&amp;amp;gt;"),
    )
    got = _parsed(spark, html)[0]
    # A link text counts as seen only when it equals a whole part.
    assert got["fields"] == {
        "Título": ["Um"], "Autor(es)": ["Silva", "Souza"], "URI": ["x l x l | l | x l"], "Data": ["1 | 2"], "Nota": ["<b>"],
    }
    at_rest = records.parse_pages(_pages(spark, html)).select(
        *[records.field(name) for name in ("Título", "Autor(es)", "none")]
    )
    assert rows(at_rest) == [("Um", '["Silva","Souza"]', None)]
    stored = records.documents(records.parse_pages(_pages(spark, html))).first()["document"]
    assert json.loads(stored) == {
        "Título": "Um", "Autor(es)": ["Silva", "Souza"], "URI": "x l x l | l | x l", "Data": "1 | 2", "Nota": "<b>",
        "_id": "7", "_source_url": URL,
    }
    assert (got["page_title"], got["tables_found"], got["pdf_url"]) == ("T", 1, None)


def test_pdf_link_preference(spark):
    meta = '<table><tr><td>Título</td><td><a href="/in/meta.pdf">m</a></td></tr><tr><td>Autor</td><td>b</td></tr></table>'
    link = '<table summary="{s}"><tr><td>{w}</td><td><a href="{h}">f</a></td></tr></table>'
    host = "https://h.example"
    cases = {
        meta: f"{host}/in/meta.pdf",
        meta + "<h2>Arquivos associados a este item:</h2>" + link.format(s="", w="", h="/bitstream/p/1/x"): f"{host}/bitstream/p/1/x",
        meta + link.format(s="Files associated", w="", h="/A.PDF?x=1"): f"{host}/A.PDF?x=1",
        meta + link.format(s="", w="Arquivo Formato PDF", h="/f.pdf"): f"{host}/f.pdf",
        # A files table without a usable link hides the other tables, not the rest of the page.
        meta + link.format(s="Files associated", w="", h="/none"): None,
        meta + link.format(s="Files associated", w="", h="/none") + "<a href='/bitstream/p/2/y?a=1&amp;b=2#z'>": f"{host}/bitstream/p/2/y?a=1&b=2",
        "<p>no table</p><a HREF='/bitstream/p/3/y'>": f"{host}/bitstream/p/3/y",
        "<p>nothing</p>": None,
    }
    got = _parsed(spark, *cases)
    assert [got[i]["pdf_url"] for i in range(len(cases))] == list(cases.values())


def test_fallback_warning_and_documents(spark):
    full_table = _table(("Título", "Um"), ("Autor", "B"))
    default = _pages(spark, "<title>D</title>" + full_table, "<title>D</title>", "<title>D</title>")
    full = _pages(spark, "<title>F</title>", "<title>F</title>" + full_table + "<a href='/bitstream/p/9/f'>", "")
    merged = records.records_with_fallback(default, full)
    got = {r["page_id"]: r for r in merged.withColumn("w", records.parser_warning(F.col("fields"))).collect()}
    assert [(got[i]["page_title"], got[i]["source_used"], got[i]["w"] is None) for i in range(3)] == [
        ("D", "default", True),
        ("F", "show_full", True),
        ("D", "show_full", False),
    ]
    assert got[1]["fields"] == {"Título": ["Um"], "Autor": ["B"]}
    assert got[1]["pdf_url"] == "https://h.example/bitstream/p/9/f"
    stored = [json.loads(r["document"]) for r in records.documents(merged).collect()]
    by_title = sorted(stored, key=lambda d: (d.get("_parser_warning") or "", d.get("_pdf_url") or ""))
    assert by_title[0] == {"Título": "Um", "Autor": "B", "_id": "7", "_source_url": URL}
    assert by_title[2] == {
        "_id": "7", "_source_url": URL,
        "_parser_warning": "No metadata fields were found in default page or show=full page.",
    }
    rootless = records.parse_pages(_pages(spark, "<p></p>", url="https://h.example/"))
    assert records.documents(rootless).count() == 0
    assert rows(records.rejected_documents(rootless), "status") == [(500,)]


def test_state_is_kept_within_the_page(spark):
    pages = _pages(spark, "<table></table>")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(markup.table_cells(pages)).count("Exchange hashpartitioning") == 1  # repeated page rows
    parsed = plan(records.parse_pages(pages))
    assert all(name not in parsed for name in ("Exchange", "Window", "Join")) and parsed.count("regexp_extract_all(html") == 1


def test_what_stays_open_over_table_ends(spark):
    # A row and a cell left open go on in the next table; a table inside a cell ends the cell.
    html = """<table><tr><td>a</table><p>b<table><caption>c</caption>d</td><td>e</td></tr><tr><td>f</td></tr></table>
      <table><tr><td>g<td>h</td>i</tr></tr><td>j</td><tr><td>k</td></table></table><h2>H<h3>L</h3> x</h2>
      <table summary=s><td>l</td><tr><td>m</td></tr></table>"""
    assert _cells(spark, html) == [(1, 1, 1, "a b c d"), (1, 1, 2, "e"), (1, 2, 1, "f"), (2, 1, 1, "h"), (3, 1, 1, "m")]
    got = markup.table_cells(_pages(spark, html, html)).where("text = 'm'").collect()
    assert [(r["page_id"], r["heading"], r["summary"]) for r in sorted(got)] == [(0, "L", "s"), (1, "L", "s")]
    repeated = markup.table_cells(_pages(spark, html).union(_pages(spark, html)))
    assert repeated.count() == 5


def test_very_long_tables(spark):
    html = "<table>" + "".join(f"<tr><td>k{i}</td><td>v <b>{i}</b></td></tr>" for i in range(4000)) + "</table>" + "<table><tr><td>x</td></tr></table>" * 500
    got = markup.table_cells(_pages(spark, html))
    assert got.agg(F.max("table_no"), F.max("row_no"), F.count("*")).first()[:] == (501, 4000, 8500)
    assert got.where("table_no = 1 and row_no = 3999 and cell_no = 2").first()["text"] == "v 3998"
