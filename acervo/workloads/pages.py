"""Links, titles, table cells and metadata records of HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.operators import markup, records
from acervo.plans import ingest
from acervo.session import spread
from acervo.workloads import inputs

QUERIES, ORACLES = {}, {}
HOST = inputs.HOST

# --- the given pages ----------------------------------------------------------------


def q_search_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item links of rendered search pages: in the search table only, nested tables included."""
    html = f"""concat('<table summary="other"><tr><td><a href="/handle/p/1">no</a></td></tr></table>',
      '<TABLE summary=" {fixed.SEARCH_TABLE_SUMMARY} "><tr><td><a title="see href=/handle/p/2" href="/handle/p/', c_custkey, '">a</a>',
      '<table><tr><td><A HREF=''/handle/p/', c_custkey + 1, '?x=1&amp;y=2#f''>b</A></td></tr></table><table/>',
      '<a href="/handle/p/3" href="/handle/p/', c_custkey + 2, '">c</a><a href="/about">d</a><a href="/handle/p/', c_custkey,
      '">again</a><!-- <a href="/handle/p/4">e</a> --></td></tr></table><a href="/handle/p/5">after</a>')"""
    customers = spread(inputs.load(spark, sf_dir, "customer").select("c_custkey"))
    found = ingest.item_requests(
        customers.selectExpr("nullif(c_custkey, 5) AS page_id", f"concat('{HOST}/simple-search?p=', c_custkey) AS url", f"{html} AS html")
    )
    in_page = Window.partitionBy("page_key").orderBy("first_pos")
    return found.select("page_id", F.row_number().over(in_page).alias("item_no"), "link")


ORACLES["q_search_items"] = f"""
WITH l AS (SELECT nullif(c_custkey, 5) AS page_id, unnest([1, 2, 3]) AS item_no, unnest([CAST(c_custkey AS VARCHAR),
  (c_custkey + 1) || '?x=1&y=2', CAST(c_custkey + 2 AS VARCHAR)]) AS tail FROM customer)
SELECT page_id, CAST(item_no AS INTEGER) AS item_no, '{HOST}/handle/p/' || tail AS link FROM l"""


def q_record_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of several cells and links; pages without an id, pages that share one, misleading attributes."""
    html = """concat('<table><tr><td class="metadataFieldLabel" title="class=x">Nota</td><td>', c_mktsegment, '</td><td>b <a title="href=/no" href="/l">L',
      c_custkey, '</a></td></tr><tr><td>Autor</td><td>x</td><td><a href="/no" href="/m.pdf?k=', c_custkey, '">x</a></td></tr></table>')"""
    customers = spread(inputs.load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    pages = customers.selectExpr("nullif(c_custkey % 50, 0) AS page_id", f"concat('{HOST}/handle/p/', c_custkey) AS url", f"{html} AS html")
    parsed = records.parse_pages(pages)
    return parsed.select("page_id", "url", "tables_found", "pdf_url", records.field("Nota").alias("nota"), records.field("Autor").alias("autor"))


ORACLES["q_record_values"] = f"""
SELECT nullif(c_custkey % 50, 0) AS page_id, '{HOST}/handle/p/' || c_custkey AS url, 1 AS tables_found,
  '{HOST}/m.pdf?k=' || c_custkey AS pdf_url,
  c_mktsegment || ' | b L' || c_custkey || ' | L' || c_custkey AS nota, 'x | x' AS autor FROM customer"""


def q_container_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each page's navigation, numbered in page order."""
    links = markup.container_links(inputs.load(spark, sf_dir, "pages"), container="nav", summary=None)
    in_page = Window.partitionBy("page_key").orderBy("pos")
    return links.select("page_id", F.row_number().over(in_page).alias("link_no"), "link")


_SQL_LINKS = r"""
nav AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
  regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)"', 1) AS hrefs FROM pages),
links AS (SELECT page_id, unnest(generate_series(1, len(hrefs))) AS link_no, origin || unnest(hrefs) AS link FROM nav)"""
ORACLES["q_container_links"] = f"WITH {_SQL_LINKS} SELECT page_id, CAST(link_no AS INTEGER) AS link_no, link FROM links"

_WORD_PATH = r"^/[^/.,]+$"


def q_item_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation links whose path is a plain word, each once per page, in first-seen order."""
    links = markup.container_links(inputs.load(spark, sf_dir, "pages"), container="nav", summary=None)
    items = markup.item_links(links, _WORD_PATH)
    in_page = Window.partitionBy("page_key").orderBy("first_pos")
    return items.select("page_id", "link", F.row_number().over(in_page).alias("item_no"))


ORACLES["q_item_links"] = rf"""WITH {_SQL_LINKS},
items AS (SELECT page_id, link, min(link_no) AS first_no FROM links
  WHERE regexp_matches(regexp_extract(link, '^https?://[^/]*(/.*)$', 1), '{_WORD_PATH}') GROUP BY 1, 2)
SELECT page_id, link, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first_no) AS INTEGER) AS item_no FROM items"""


def q_page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.page_titles(inputs.load(spark, sf_dir, "pages"))


def _sql_element(tag: str) -> str:
    inner = f"regexp_extract(html, '(?is)<{tag}>(.*?)</{tag}>', 1)"
    decoded = rf"""replace(regexp_replace({inner}, '&amp;?', '&', 'g'), '&quot;', '"')"""
    return rf"trim(regexp_replace({decoded}, '\s+', ' ', 'g'))"


ORACLES["q_page_titles"] = (
    f"SELECT page_id, {_sql_element('title')} AS page_title, {_sql_element('h1')} AS first_heading FROM pages"
)

# --- item pages rendered from customers and their nations -----------------------------

# Variants by c_custkey % 6: 0 files table by heading, 1 by summary, 2 by its words,
# 3 link outside every table, 4 no link, 5 link inside the metadata table.
_RECORD_ROWS = """concat(
  '<tr><td class="x metadataFieldLabel">&nbsp;Título:&nbsp;</td><td class="metadataFieldValue">', c_name, ' &amp; ', c_mktsegment, '</td></tr>',
  '<tr><th>Autor(es)</th><td>', n_name, '<br>', c_mktsegment, '</td></tr>',
  '<TR><td>Autor(es): </td><td><a href="/browse?author=', c_custkey, '&amp;o=1#top"><b>Autor</b> ', c_custkey, '</a></td></TR>',
  '<tr><td>  </td><td></td></tr>',
  '<tr><td>Autor(es)</td><td>', n_name, '\\n ', c_mktsegment, '</td></tr>',
  '<tr><td>Tamanho</td><td>10 kB</td></tr>',
  '<tr><td>Palavras-chave</td><td>', c_mktsegment, '<table><tr><td>URI</td><td>', c_custkey, '</td></tr></table></td></tr>')"""
_SMALL_TABLE = """CASE WHEN c_custkey % 3 = 0 THEN concat('<h2>Outra tabela</h2><table><tr><td>Tipo</td><td>', n_name,
  '</td></tr><tr><td>Data</td><td>', c_custkey, '</td></tr></table>') ELSE '' END"""
_FILES = f"""CASE c_custkey % 6
  WHEN 0 THEN concat('<h3>Arquivos associados a este item:</h3><table><tr><td><a href="/files/', c_custkey, '.PDF?s=1#p">ler</a></td></tr></table>')
  WHEN 1 THEN concat('<h3></h3><table summary="Files associated with it"><tr><td>a</td><td><a href="/bitstream/prefix/', c_custkey, '/1/t">t</a></td></tr></table>')
  WHEN 2 THEN concat('<table><tr><th>Arquivo</th><th>Formato</th></tr><tr><td><a href="/bitstream/prefix/', c_custkey, '/1/t.pdf">t</a></td><td>Adobe PDF</td></tr></table>')
  WHEN 3 THEN concat('<p><a class="f" href="/bitstream/prefix/', c_custkey, '/1/fora.pdf">t</a></p>')
  ELSE '' END"""
_IN_RECORD = "CASE WHEN c_custkey % 6 = 5 THEN concat('<tr><td>URI</td><td><a href=\"{host}/x/', c_custkey, '.pdf\">link</a></td></tr>') ELSE '' END".replace("{host}", HOST)
_HAS_RECORD = "c_custkey % 4 > 0"
_HAS_FULL_RECORD = "c_custkey % 8 > 0"


def rendered(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    """One item page per customer; every fourth has no table, its full variant mostly has one."""
    # A page takes a millisecond to read, and the customers' short rows may be a single split.
    customers, nations = spread(inputs.load(spark, sf_dir, "customer")), inputs.load(spark, sf_dir, "nation")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    has_record = _HAS_FULL_RECORD if full else _HAS_RECORD
    html = f"""concat('<!DOCTYPE html><html><head><title>Item ', c_name, ' &amp;amp; mais</title><script>var t="<table>";</script></head><body></table>',
      CASE WHEN {has_record} THEN concat({_SMALL_TABLE}, '<!-- <table> --><h2>Registro <i>', n_name, '</i></h2><table class="item">', {_RECORD_ROWS}, {_IN_RECORD}, '</table>', {_FILES})
      ELSE '<p>vazio</p>' END, '</body></html>')"""
    suffix = "?show=full" if full else ""
    return joined.select(
        F.col("c_custkey").alias("page_id"),
        F.expr(f"concat('{HOST}/handle/prefix/', c_custkey, '{suffix}')").alias("url"),
        F.expr(html).alias("html"),
    )


def q_html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = markup.table_cells(rendered(spark, sf_dir))
    first = F.try_element_at("links", F.lit(1))
    return cells.select(
        "page_id",
        "table_no",
        "row_no",
        "cell_no",
        "text",
        "cell_class",
        "heading",
        "summary",
        first["href"].alias("href"),
        first["text"].alias("link_text"),
    )


def _sql_cells() -> str:
    """Expected cells as (table, row, cell, text, class, heading, summary, href, link text)."""
    offset = "CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END"
    registro, id_ = "'Registro ' || n_name", "CAST(c_custkey AS VARCHAR)"
    browse = f"'{HOST}/browse?author=' || c_custkey || '&o=1'"
    rows = [
        ("c_custkey % 3 = 0", "1", [(1, 1, "'Tipo'"), (1, 2, "n_name"), (2, 1, "'Data'"), (2, 2, id_)], "'Outra tabela'"),
        (
            "true",
            f"1 + {offset}",
            [
                (1, 1, "'Título:'", "'x metadataFieldLabel'"),
                (1, 2, "c_name || ' & ' || c_mktsegment", "'metadataFieldValue'"),
                (2, 1, "'Autor(es)'"),
                (2, 2, "n_name || ' ' || c_mktsegment"),
                (3, 1, "'Autor(es):'"),
                (3, 2, f"'Autor ' || {id_}", "''", browse, f"'Autor ' || {id_}"),
                (4, 1, "'Autor(es)'"),
                (4, 2, "n_name || ' ' || c_mktsegment"),
                (5, 1, "'Tamanho'"),
                (5, 2, "'10 kB'"),
                (6, 1, "'URI'"),
                (6, 2, id_),
            ],
            registro,
        ),
        (
            "c_custkey % 6 = 5",
            f"1 + {offset}",
            [(7, 1, "'URI'"), (7, 2, "'link'", "''", f"'{HOST}/x/' || c_custkey || '.pdf'", "'link'")],
            registro,
        ),
        (
            "c_custkey % 6 = 0",
            f"2 + {offset}",
            [(1, 1, "'ler'", "''", f"'{HOST}/files/' || c_custkey || '.PDF?s=1'", "'ler'")],
            "'Arquivos associados a este item:'",
        ),
        (
            "c_custkey % 6 = 1",
            f"2 + {offset}",
            [(1, 1, "'a'"), (1, 2, "'t'", "''", f"'{HOST}/bitstream/prefix/' || c_custkey || '/1/t'", "'t'")],
            registro,
            "'Files associated with it'",
        ),
        (
            "c_custkey % 6 = 2",
            f"2 + {offset}",
            [
                (1, 1, "'Arquivo'"),
                (1, 2, "'Formato'"),
                (2, 1, "'t'", "''", f"'{HOST}/bitstream/prefix/' || c_custkey || '/1/t.pdf'", "'t'"),
                (2, 2, "'Adobe PDF'"),
            ],
            registro,
        ),
    ]
    parts = []
    for condition, table, cells, heading, *summary in rows:
        for row, cell, text, *more in cells:
            css, href, link = [*more, *["''", "NULL", "NULL"][len(more):]]
            parts.append(
                f"SELECT c_custkey AS page_id, CAST({table} AS INTEGER) AS table_no, {row} AS row_no, {cell} AS cell_no, "
                f"{text} AS text, {css} AS cell_class, {heading} AS heading, {summary[0] if summary else chr(39) * 2} AS summary, "
                f"{href} AS href, {link} AS link_text FROM c WHERE {condition}"
            )
    source = f"c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE {_HAS_RECORD})"
    return f"WITH {source} " + " UNION ALL ".join(parts)


ORACLES["q_html_cells"] = _sql_cells()


def q_metadata_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.metadata_tables(markup.page_tables(rendered(spark, sf_dir)))


# The record has five metadata rows of six (six of seven with its link), the small table two of two.
ORACLES["q_metadata_table"] = f"""
SELECT c_custkey AS page_id, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS table_no,
  CAST(CASE WHEN c_custkey % 6 = 5 THEN 67 ELSE 56 END AS BIGINT) AS score
FROM customer WHERE {_HAS_RECORD}"""

_SQL_PDF = f"""CASE c_custkey % 6 WHEN 0 THEN '{HOST}/files/' || c_custkey || '.PDF?s=1'
  WHEN 1 THEN '{HOST}/bitstream/prefix/' || c_custkey || '/1/t'
  WHEN 2 THEN '{HOST}/bitstream/prefix/' || c_custkey || '/1/t.pdf'
  WHEN 3 THEN '{HOST}/bitstream/prefix/' || c_custkey || '/1/fora.pdf'
  WHEN 5 THEN '{HOST}/x/' || c_custkey || '.pdf' END"""


def q_pdf_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_pages(rendered(spark, sf_dir)).select("page_id", "page_title", "tables_found", "pdf_url")


_SQL_TABLES = "1 + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 6 < 3 THEN 1 ELSE 0 END"
ORACLES["q_pdf_url"] = f"""
SELECT c_custkey AS page_id, 'Item ' || c_name || ' & mais' AS page_title,
  CASE WHEN {_HAS_RECORD} THEN {_SQL_TABLES} ELSE 0 END AS tables_found,
  CASE WHEN {_HAS_RECORD} THEN {_SQL_PDF} END AS pdf_url FROM customer"""


def q_record_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = records.records_with_fallback(rendered(spark, sf_dir), rendered(spark, sf_dir, full=True))
    return merged.select(
        "page_id",
        "source_used",
        "tables_found",
        "pdf_url",
        records.field("Título").alias("titulo"),
        records.field("Autor(es)").alias("autores"),
        records.field("URI").alias("uri"),
        records.non_system_labels(F.col("fields")).alias("n_fields"),
        records.parser_warning(F.col("fields")).alias("warning"),
    )


ORACLES["q_record_fallback"] = f"""
WITH c AS (SELECT *, {_HAS_RECORD} AS own, {_HAS_FULL_RECORD} AS found FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey AS page_id, CASE WHEN own THEN 'default' ELSE 'show_full' END AS source_used,
  CASE WHEN found THEN {_SQL_TABLES} ELSE 0 END AS tables_found, CASE WHEN found THEN {_SQL_PDF} END AS pdf_url,
  CASE WHEN found THEN c_name || ' & ' || c_mktsegment END AS titulo,
  CASE WHEN found THEN '["' || n_name || ' ' || c_mktsegment || '","Autor ' || c_custkey || '"]' END AS autores,
  CASE WHEN found THEN CASE WHEN c_custkey % 6 = 5 THEN '["' || c_custkey || '","link"]' ELSE CAST(c_custkey AS VARCHAR) END END AS uri,
  CASE WHEN found THEN 3 ELSE 0 END AS n_fields,
  CASE WHEN NOT found THEN '{fixed.PARSER_WARNING}' END AS warning
FROM c"""


def q_record_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON documents of the records, read back by key."""
    stored = records.documents(records.parse_pages(rendered(spark, sf_dir)))
    keys = F.from_json("document", "map<string,string>")
    at = lambda name: F.try_element_at(keys, F.lit(name))
    return stored.select(
        "item_id",
        at("_id").alias("id"),
        at("_source_url").alias("source_url"),
        at("_pdf_url").alias("pdf_url"),
        at("_parser_warning").alias("warning"),
        at("Título").alias("titulo"),
        at("Autor(es)").alias("autores"),
    )


ORACLES["q_record_documents"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS item_id, CAST(c_custkey AS VARCHAR) AS id,
  '{HOST}/handle/prefix/' || c_custkey AS source_url, CASE WHEN {_HAS_RECORD} THEN {_SQL_PDF} END AS pdf_url,
  CASE WHEN NOT ({_HAS_RECORD}) THEN '{fixed.PARSER_WARNING}' END AS warning,
  CASE WHEN {_HAS_RECORD} THEN c_name || ' & ' || c_mktsegment END AS titulo,
  CASE WHEN {_HAS_RECORD} THEN '["' || n_name || ' ' || c_mktsegment || '","Autor ' || c_custkey || '"]' END AS autores
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

QUERIES.update({name: fn for name, fn in globals().items() if name.startswith("q_")})
