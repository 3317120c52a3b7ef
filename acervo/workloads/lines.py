"""Tables of contents from lines, and consecutive repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.operators import contents, relations
from acervo.workloads import inputs

QUERIES, ORACLES = {}, {}

_NOISE = rf"(line = '' OR regexp_matches(lower(line), '{fixed.ROMAN_NUMBER_LINE}') OR regexp_matches(line, '{fixed.PAGE_NUMBER_LINE}'))"
_LEADER = f"regexp_matches(line, '{fixed.LEADERS}')"
_NUMBER = f"regexp_matches(line, '{fixed.TRAILING_PAGE_NUMBER}')"
_TERM = f"regexp_matches(upper(line), '{'|'.join(fixed.CONTENTS_TERMS)}')"
_HEADING = f"regexp_matches(line, '{fixed.NUMBERED_HEADING}')"
_SQL_LINES = rf"""
raw AS ({inputs.LINES_SQL}),
norm AS (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS line FROM raw),
classified AS (SELECT *, {_NOISE} AS noise, lower(line) IN ('sumário', 'sumario') AS is_marker,
  NOT {_NOISE} AND ({_LEADER} OR {_NUMBER} OR {_TERM} OR {_HEADING}) AS is_entry,
  {_LEADER} AND NOT {_NOISE} AS has_leader, {_NUMBER} AND NOT {_NOISE} AS has_number FROM norm)"""


def q_toc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = contents.classified(inputs.lines(spark, sf_dir))
    return lines.select(
        "doc_id", "page_no", "line_no", "line", "noise", "is_marker", "is_entry", "has_leader", "has_number"
    )


ORACLES["q_toc_lines"] = f"""WITH {_SQL_LINES}
SELECT doc_id, page_no, line_no, line, noise, is_marker, is_entry, has_leader, has_number FROM classified"""

def _sql_pages(scanned: str = "") -> str:
    return f"""{_SQL_LINES},
stats AS (SELECT doc_id, page_no, count(*) FILTER (NOT noise) AS n_lines, count(*) FILTER (is_entry) AS n_entries,
  count(*) FILTER (has_number) AS n_numbers, count(*) FILTER (has_leader) AS n_leaders,
  CAST(coalesce(sum(length(line) + 1) FILTER (line <> '') - 1, 0) AS BIGINT) AS n_chars,
  min(line_no) FILTER (is_marker) AS marker_line
  FROM classified {scanned} GROUP BY 1, 2),
toc_pages AS (SELECT *, n_lines > 0 AND (n_entries >= 3 OR n_numbers >= 3 OR n_leaders >= 2
  OR n_entries / n_lines >= 0.45) AS looks_like_contents FROM stats)"""


_SQL_PAGES = _sql_pages()


def q_toc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents.page_stats(inputs.lines(spark, sf_dir)).drop("first_line", "last_line")


ORACLES["q_toc_pages"] = f"WITH {_SQL_PAGES} SELECT * FROM toc_pages"


def q_toc_scan_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan cap is the feature here: counts of the first pages of each document only."""
    lines = inputs.lines(spark, sf_dir)
    return contents.page_stats(lines, max_pages=fixed.MAX_PAGES_TO_SCAN).drop("first_line", "last_line")


ORACLES["q_toc_scan_cap"] = f"WITH {_sql_pages(f'WHERE page_no <= {fixed.MAX_PAGES_TO_SCAN}')} SELECT * FROM toc_pages"

_SQL_SECTION = f"""{_SQL_PAGES},
first_page AS (SELECT doc_id, min(page_no) AS marker_page FROM toc_pages WHERE marker_line IS NOT NULL GROUP BY 1),
last_page AS (SELECT p.doc_id, min(page_no) AS end_page FROM toc_pages p JOIN first_page f ON p.doc_id = f.doc_id
  WHERE page_no > marker_page AND NOT looks_like_contents GROUP BY 1),
bounds AS (SELECT f.doc_id, marker_page, end_page, t.marker_line FROM first_page f
  JOIN toc_pages t ON t.doc_id = f.doc_id AND t.page_no = marker_page LEFT JOIN last_page l ON l.doc_id = f.doc_id),
section AS (SELECT c.doc_id, page_no, line_no, line FROM classified c JOIN bounds b ON c.doc_id = b.doc_id
  WHERE NOT noise AND page_no >= marker_page
  AND (end_page IS NULL OR page_no < end_page) AND (page_no > marker_page OR line_no >= marker_line))"""


def q_toc_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents.section_lines(inputs.lines(spark, sf_dir)).drop("part")


ORACLES["q_toc_section"] = f"WITH {_SQL_SECTION} SELECT * FROM section"

_SQL_CLEAN = rf"""{_SQL_SECTION},
plain AS (SELECT doc_id, page_no, line_no,
  trim(regexp_replace(regexp_replace(line, '{fixed.LEADERS}', ' ', 'g'), '\s+', ' ', 'g')) AS line FROM section),
marked AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY page_no, line_no) AS previous FROM plain),
cleaned AS (SELECT doc_id, page_no, line_no, line FROM marked WHERE previous IS NULL OR previous <> line)"""


def q_toc_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents.clean_section(contents.section_lines(inputs.lines(spark, sf_dir))).drop("part")


ORACLES["q_toc_clean"] = f"WITH {_SQL_CLEAN} SELECT * FROM cleaned"

_SQL_TEXTS = rf"""{_SQL_CLEAN},
texts AS (SELECT doc_id, regexp_replace(string_agg(line, chr(10) ORDER BY page_no, line_no), '^\n+|\n+$', '', 'g') AS section
  FROM cleaned GROUP BY 1)"""


def q_toc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents.section_texts(contents.clean_section(contents.section_lines(inputs.lines(spark, sf_dir))))


ORACLES["q_toc_text"] = f"WITH {_SQL_TEXTS} SELECT doc_id, section FROM texts"


def q_status_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents.section_status(inputs.lines(spark, sf_dir))


ORACLES["q_status_gates"] = f"""WITH {_SQL_TEXTS},
chars AS (SELECT p.doc_id, marker_page, CAST(sum(n_chars) FILTER (end_page IS NULL OR page_no <= end_page) AS BIGINT) AS text_chars
  FROM toc_pages p LEFT JOIN bounds b ON p.doc_id = b.doc_id GROUP BY 1, 2),
m AS (SELECT c.doc_id, text_chars, coalesce(length(section), 0) AS section_chars,
  CASE WHEN text_chars < {fixed.MIN_EXTRACTED_TEXT_CHARS} THEN '{fixed.NOT_ENOUGH_TEXT}'
    WHEN marker_page IS NULL THEN '{fixed.MARKER_NOT_FOUND}'
    WHEN length(section) < {fixed.MIN_SECTION_CHARS} THEN '{fixed.SECTION_TOO_SHORT}' END AS message
  FROM chars c LEFT JOIN texts t ON c.doc_id = t.doc_id)
SELECT doc_id, text_chars, section_chars, CASE WHEN message IS NULL THEN 200 ELSE 422 END AS status, message FROM m"""

_OBJECTS = {
    "path": "concat('PDF/', o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' ELSE '.txt' END)",
    "length": "cast(floor(o_totalprice / 100) as bigint)",
}


def q_pdf_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents.pdf_status(inputs.spark_select(inputs.load(spark, sf_dir, "orders"), _OBJECTS))


ORACLES["q_pdf_gates"] = f"""
WITH o AS ({inputs.sql_select(_OBJECTS, 'orders')}),
m AS (SELECT *, CASE WHEN NOT lower(path) LIKE '%.pdf' THEN '{fixed.NOT_A_PDF}' || path
  WHEN length < {fixed.MIN_PDF_BYTES} THEN replace('{fixed.PDF_TOO_SMALL}', '%d', CAST(length AS VARCHAR)) END AS message FROM o)
SELECT path, length, CASE WHEN message IS NULL THEN 200 ELSE 422 END AS status, message FROM m"""


def q_consecutive_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events have no user, and two thirds fall into one burst."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    events = inputs.load(spark, sf_dir, "events").select(
        F.expr("nullif(user_id, 7)").alias("user_id"),
        F.when(F.expr("event_id % 3 = 0"), at).otherwise(F.col("event_id")).alias("micros"),
        "event_id",
        "event_type",
    )
    blocked = relations.numbered_blocks(events, F.col("micros"))
    kept = relations.drop_consecutive_repeats(blocked, ["user_id"], ["block"], ["micros", "event_id"], "event_type")
    return kept.drop("block")


ORACLES["q_consecutive_dedupe"] = """
WITH e AS (SELECT nullif(user_id, 7) AS user_id, CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) ELSE event_id END AS micros,
  event_id, event_type FROM events)
SELECT user_id, micros, event_id, event_type FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY micros, event_id) AS previous FROM e)
WHERE previous IS NULL OR previous <> event_type"""

# Documents as pages of text, with symbols and blanks that the rules normalise.
_RAW_PAGE = {
    "doc_id": "doc_id",
    "page_no": "1",
    "text": "concat(replace(text, 'the', concat('…', chr(0))), ' ·', chr(9), ' ', chr(10), ' ', chr(10), chr(10), ' end', chr(13), chr(10))",
}


def q_page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of document texts with NUL, ellipsis, middle dot, byte order mark and blank lines in them."""
    pages = inputs.spark_select(inputs.load(spark, sf_dir, "documents"), _RAW_PAGE)
    marked = pages.withColumn("text", F.concat(F.lit("\ufeff"), F.col("text")))
    return contents.page_lines(marked)


ORACLES["q_page_lines"] = rf"""
WITH p AS ({inputs.sql_select(_RAW_PAGE, 'documents')}),
s AS (SELECT doc_id, page_no, replace(replace(replace(chr(65279) || text, chr(0), ' '), chr(65279), ' '), '·', '.') AS t FROM p),
n AS (SELECT doc_id, page_no, regexp_replace(replace(t, '…', '...'), '[ \t\r\f\x0B]+', ' ', 'g') AS t FROM s),
b AS (SELECT doc_id, page_no, regexp_replace(regexp_replace(t, '\n\s*\n+', chr(10), 'g'), ' *\n *', chr(10), 'g') AS t FROM n),
l AS (SELECT doc_id, page_no, string_split(regexp_replace(t, '^\s+|\s+$', '', 'g'), chr(10)) AS lines FROM b)
SELECT doc_id, page_no, CAST(unnest(generate_series(0, len(lines) - 1)) AS INTEGER) AS line_no, unnest(lines) AS text FROM l"""

QUERIES.update({name: fn for name, fn in globals().items() if name.startswith("q_")})
