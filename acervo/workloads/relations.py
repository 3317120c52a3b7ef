"""Unions, replacement by key, JSON columns, the backfill plan, data tests and envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.functions import text, urls
from acervo.operators import envelopes, quality, relations
from acervo.sources.documents import period_name
from acervo.workloads import inputs

QUERIES, ORACLES = {}, {}
HOST = inputs.HOST

# --- union ------------------------------------------------------------------------

# Year range of each period relation and its columns; together they cover all orders.
_PERIOD_YEARS = [(None, 1995), (1996, 1996), (1997, 1997), (1998, 1998), (1999, 1999), (2000, None)]
_PERIOD_COLUMNS = [
    {"o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus"},
    {"o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus", "o_custkey": "o_custkey"},
    {"o_orderkey": "o_orderkey", "o_custkey": "concat('c', o_custkey)"},
    {"o_orderpriority": "o_orderpriority", "o_orderkey": "o_orderkey"},
    {"o_orderkey": "o_orderkey", "Título": "concat('Nº ', o_orderkey)", "o_custkey": "o_custkey"},
    {"o_orderkey": "o_orderkey", "o_totalprice": "o_totalprice"},
]


def _period_filter(first, last) -> str:
    after = f"o_orderdate >= timestamp '{first}-01-01 00:00:00'" if first else "true"
    before = f"o_orderdate < timestamp '{last + 1}-01-01 00:00:00'" if last else "true"
    return f"{after} AND {before}"


def q_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.load(spark, sf_dir, "orders")
    parts = {
        period_name("papers_metadata", period): inputs.spark_select(orders.where(_period_filter(*years)), columns)
        for period, years, columns in zip(fixed.PERIODS, _PERIOD_YEARS, _PERIOD_COLUMNS)
    }
    return relations.union_relations(parts)


ORACLES["q_union_by_name"] = " UNION ALL BY NAME ".join(
    "SELECT '{}' AS __table_source, {} FROM orders WHERE {}".format(
        period_name("papers_metadata", period),
        ", ".join(
            f'CAST({e} AS VARCHAR) AS "{c}"' if c == "o_custkey" else f'{e} AS "{c}"' for c, e in columns.items()
        ),
        _period_filter(*years),
    )
    for period, years, columns in zip(fixed.PERIODS, _PERIOD_YEARS, _PERIOD_COLUMNS)
)

# --- replacement and values by key --------------------------------------------------


def q_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.load(spark, sf_dir, "events")
    return relations.latest_per_key(events, "user_id", ["ts", "event_id"])


ORACLES["q_latest_per_key"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


def _labelled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = inputs.load(spark, sf_dir, "conversations")
    return turns.select(
        "conv_id",
        "turn",
        text.label(F.concat(F.lit(" "), F.col("role"), F.lit(" ::"))).alias("label"),
        text.clean_cell(F.col("text")).alias("value"),
    ).where((F.col("label") != "") & (F.col("value") != ""))


def q_multi_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.distinct_values(_labelled_values(spark, sf_dir), ["conv_id", "label"], "value", "turn")


_SQL_VALUES = r"""SELECT conv_id, turn, role AS label, trim(regexp_replace(text, '\s+', ' ', 'g')) AS value
FROM conversations WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''"""
ORACLES["q_multi_value"] = f"""
SELECT conv_id, label, value, min(turn) AS first_seen FROM ({_SQL_VALUES}) GROUP BY 1, 2, 3"""


def q_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = relations.distinct_values(_labelled_values(spark, sf_dir), ["conv_id", "label"], "value", "turn")
    counts = relations.label_counts(values, ["conv_id", "label"])
    return counts.withColumn("is_list", F.col("n_values") > 1)


ORACLES["q_label_counts"] = f"""
SELECT conv_id, label, count(DISTINCT value) AS n_values, count(DISTINCT value) > 1 AS is_list
FROM ({_SQL_VALUES}) GROUP BY 1, 2"""

# --- JSON columns -------------------------------------------------------------------


def q_json_map_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.load(spark, sf_dir, "events")
    totals = events.select("user_id", relations.json_map_total(F.col("props")).alias("row_total"))
    return totals.groupBy("user_id").agg(
        F.sum("row_total").alias("total"), text.two_decimals(F.sum("row_total")).alias("total_text")
    )


ORACLES["q_json_map_sum"] = """
WITH t AS (SELECT user_id, sum(CAST(json_extract(props, '$.k') AS DOUBLE)) AS total FROM events GROUP BY 1)
SELECT user_id, total, printf('%.2f', total) AS total_text FROM t"""

# --- backfill plan --------------------------------------------------------------------

_MODE = "CASE user_id % 4 WHEN 0 THEN 'DIRECT_LINK' WHEN 1 THEN 'OTHER' ELSE 'PUBLISH_DATE' END"
_LINK = f"concat('{HOST}/handle/prefix/', user_id)"
_BUCKET = "concat('store-', user_id % 3)"


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per user, from the first to the last day; some ranges are the wrong way round."""
    events = inputs.load(spark, sf_dir, "events")
    spans = events.groupBy("user_id").agg(
        F.min("ts").cast("date").alias("first"), F.max("ts").cast("date").alias("last")
    )
    swapped = F.expr("user_id % 11 = 0")
    return spans.select(
        "user_id",
        F.when(swapped, F.col("last")).otherwise(F.col("first")).alias("date_start"),
        F.when(swapped, F.col("first")).otherwise(F.col("last")).alias("date_end"),
        F.expr(_MODE).alias("run_mode"),
        F.expr(_LINK).alias("direct_link"),
        F.expr(_BUCKET).alias("bucket"),
    )


def q_backfill_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = relations.backfill_plan(_requests(spark, sf_dir), HOST)
    started = relations.run_configurations(plan, F.col("bucket"))
    return started.select("user_id", "publish_date", "run_mode", "payload", "run_conf")


_SQL_REQUESTS = f"""r AS (SELECT user_id, {_MODE} AS run_mode, {_LINK} AS direct_link, {_BUCKET} AS bucket,
  CASE WHEN user_id % 11 = 0 THEN CAST(max(ts) AS DATE) ELSE CAST(min(ts) AS DATE) END AS date_start,
  CASE WHEN user_id % 11 = 0 THEN CAST(min(ts) AS DATE) ELSE CAST(max(ts) AS DATE) END AS date_end
  FROM events GROUP BY user_id)"""
ORACLES["q_backfill_plan"] = f"""WITH {_SQL_REQUESTS},
d AS (SELECT user_id, run_mode, direct_link, bucket,
  CAST(unnest(generate_series(date_start, date_end, INTERVAL 1 DAY)) AS DATE) AS publish_date
  FROM r WHERE date_end >= date_start)
SELECT user_id, publish_date, run_mode, '{{"url":"' || CASE run_mode
  WHEN 'PUBLISH_DATE' THEN '{HOST}' || replace('{fixed.SEARCH_QUERY}', '%s', CAST(publish_date AS VARCHAR))
  WHEN 'DIRECT_LINK' THEN direct_link ELSE '' END || '"}}' AS payload,
  '{{"run_mode":"' || run_mode || '","papers_publish_date":"' || CAST(publish_date AS VARCHAR)
    || '","aws_bucket_name":"' || bucket || '"}}' AS run_conf FROM d"""


def q_backfill_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable requests in strict mode, a run per week."""
    usable = _requests(spark, sf_dir).where("date_end >= date_start")
    plan = relations.backfill_plan(usable, HOST, days_per_batch=7, strict=True)
    return plan.select("user_id", "publish_date")


ORACLES["q_backfill_strict"] = f"""WITH {_SQL_REQUESTS}
SELECT user_id, CAST(unnest(generate_series(date_start, date_end, INTERVAL 7 DAY)) AS DATE) AS publish_date
FROM r WHERE date_end >= date_start"""


def q_backfill_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.rejected_requests(_requests(spark, sf_dir)).select(
        "user_id", "date_start", "date_end", "message"
    )


ORACLES["q_backfill_rejected"] = f"""WITH {_SQL_REQUESTS}
SELECT user_id, date_start, date_end, '{fixed.BAD_DATE_RANGE}' AS message FROM r WHERE date_end < date_start"""


def q_chained_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.papers(spark, sf_dir).select(F.col("_source_url").alias("link"), F.col("_pdf_url").alias("pdf_url"))
    return relations.chained_payloads(orders, "store")


ORACLES["q_chained_payloads"] = f"""
WITH p AS ({inputs.PAPERS_SQL})
SELECT _source_url AS link, _pdf_url AS pdf_url,
  '{{"url":"' || _source_url || '","bucket":"store","prefix":"Metadata"}}' AS paper_payload,
  '{{"id":"' || _id || '"' || coalesce(',"pdf_url":"' || _pdf_url || '"', '') || ',"bucket":"store","prefix":"PDF"}}' AS pdf_payload,
  '{{"paper_id":"' || _id || '","pdf_s3_uri":"s3://store/PDF/' || _id || '.pdf","output_prefix":"TableOfContent"}}' AS contents_payload
FROM p"""

# --- data tests -----------------------------------------------------------------------


def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One passing and one failing column."""
    labels = quality.not_null(inputs.load(spark, sf_dir, "labels"), "quality")
    papers = inputs.papers(spark, sf_dir)
    return labels.unionByName(quality.not_null(papers, "Primeiro Orientador"))


ORACLES["q_dq_not_null"] = f"""
SELECT 'not_null' AS "check", 'quality' AS column_name, count(*) FILTER (quality IS NULL) AS violations,
  count(*) FILTER (quality IS NULL) = 0 AS passed FROM labels
UNION ALL SELECT 'not_null', 'Primeiro Orientador', count(*) FILTER (a IS NULL), count(*) FILTER (a IS NULL) = 0
FROM (SELECT {inputs.PAPERS['Primeiro Orientador']} AS a FROM orders)"""


def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One passing and one failing column."""
    orders = quality.unique(inputs.load(spark, sf_dir, "orders"), "o_orderkey")
    return orders.unionByName(quality.unique(inputs.load(spark, sf_dir, "lineitem"), "l_orderkey"))


ORACLES["q_dq_unique"] = """
WITH v AS (
  SELECT 'o_orderkey' AS column_name, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS violations
  UNION ALL
  SELECT 'l_orderkey', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)))
SELECT 'unique' AS "check", column_name, violations, violations = 0 AS passed FROM v"""

# --- addresses ------------------------------------------------------------------------


def q_url_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.load(spark, sf_dir, "pages")
    url = F.col("url")
    key = F.concat(F.lit("in/"), urls.last_segment(url), F.lit(".pdf"))
    uri = urls.storage_uri(F.lit("store"), key)
    return pages.select(
        "page_id",
        urls.last_segment(url).alias("segment"),
        urls.item_number(url).alias("number"),
        urls.full_record_url(url).alias("full_url"),
        urls.resolve_url(url, F.lit("../up/./x?y=1#z")).alias("resolved"),
        urls.storage_bucket(uri).alias("bucket"),
        urls.storage_key(uri).alias("storage_key"),
        urls.parent_prefix(urls.storage_key(uri)).alias("prefix"),
        urls.file_number(urls.storage_key(uri)).alias("file_number"),
        urls.contents_key(F.lit("/out/"), urls.last_segment(url)).alias("contents_key"),
    )


ORACLES["q_url_ids"] = r"""
WITH u AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
  regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '\?([^#]*)', 1) AS query, regexp_extract(url, '(#.*)$', 1) AS fragment FROM pages),
k AS (SELECT *, nullif(regexp_extract(path, '([^/]+)/*$', 1), '') AS segment, string_split(path, '/') AS raw FROM u)
SELECT page_id, segment, nullif(regexp_extract(path, '(\d+)\D*$', 1), '') AS number,
  origin || path || '?' || CASE WHEN query = '' THEN '' ELSE query || '&' END || 'show=full' || fragment AS full_url,
  origin || array_to_string(list_concat(raw[:len(raw)-2], ['up', 'x']), '/') || '?y=1' AS resolved,
  'store' AS bucket, 'in/' || segment || '.pdf' AS storage_key, 'in' AS prefix,
  nullif(regexp_extract(segment, '(\d+)', 1), '') AS file_number,
  'out/' || segment || '_tableOfContent.json' AS contents_key
FROM k"""

# --- envelopes ------------------------------------------------------------------------


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request envelopes of every shape, by event number."""
    events = inputs.load(spark, sf_dir, "events").select("event_id", "event_type")
    url = F.concat(F.lit(f"{HOST}/handle/prefix/"), F.col("event_id"))
    direct = F.struct(url.alias("url"))
    kind = F.expr("event_id % 10")
    bad = F.lit("no json").alias("body")
    event = (
        F.when(kind == 0, F.to_json(direct))
        .when(kind == 1, F.to_json(F.struct(F.to_json(direct).alias("body"))))
        .when(kind == 2, F.to_json(F.struct(direct.alias("body"))))
        .when(
            kind == 3,
            F.to_json(
                F.struct(
                    direct.alias("queryStringParameters"), F.struct(F.lit("ignored").alias("url")).alias("body")
                )
            ),
        )
        .when(kind == 4, F.lit('{"other": 1}'))
        .when(kind == 5, F.lit("not json"))
        .when(kind == 7, F.to_json(F.struct(bad, url.alias("url"))))
        .when(kind == 8, F.to_json(F.struct(direct.alias("queryStringParameters"), bad)))
        .when(kind == 9, F.to_json(F.struct(F.lit("[1]").alias("body"), url.alias("url"))))
        .otherwise(F.to_json(F.struct(F.lit("").alias("body"), url.alias("url"))))
    )
    return events.select("event_id", event.alias("event"))


def q_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.link_requests(_event_texts(spark, sf_dir)).drop("event")


ORACLES["q_envelope"] = f"""
SELECT event_id, CASE WHEN event_id % 10 NOT IN (4, 5, 7) THEN '{HOST}/handle/prefix/' || event_id END AS url,
  CASE WHEN event_id % 10 IN (4, 5, 7) THEN 500 ELSE 200 END AS status,
  CASE event_id % 10 WHEN 4 THEN '{fixed.URL_REQUIRED.replace("'", "''")}' WHEN 5 THEN '{fixed.INVALID_EVENT}'
    WHEN 7 THEN '{fixed.UNREADABLE_BODY}' END AS message
FROM events"""


def q_paper_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.paper_requests(_event_texts(spark, sf_dir), bucket="store", prefix="papers").drop("event")


ORACLES["q_paper_requests"] = f"""
WITH k AS (SELECT event_id, event_id % 10 AS kind FROM events),
u AS (SELECT *, CASE WHEN kind = 3 THEN 'ignored' WHEN kind NOT IN (4, 5, 7, 8) THEN '{HOST}/handle/prefix/' || event_id END AS url FROM k)
SELECT event_id, url, 'store' AS bucket, 'papers' AS prefix,
  CASE WHEN kind = 3 THEN 'ignored' WHEN url IS NOT NULL THEN CAST(event_id AS VARCHAR) END AS item_id,
  CASE WHEN kind IN (4, 5, 7, 8) THEN 500 ELSE 200 END AS status,
  CASE kind WHEN 4 THEN '{fixed.MISSING_URL}' WHEN 5 THEN '{fixed.INVALID_EVENT}' WHEN 7 THEN '{fixed.UNREADABLE_BODY}'
    WHEN 8 THEN '{fixed.UNREADABLE_BODY}' END AS message FROM u"""


def _pdf_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.load(spark, sf_dir, "events").select("event_id", "event_type")
    number = F.col("event_id").cast("string")
    kind = F.expr("event_id % 5")
    event = (
        F.when(
            kind == 0,
            F.to_json(F.struct(F.concat(F.lit(f"{HOST}/bitstream/prefix/"), number, F.lit("/1/t.pdf")).alias("pdf_url"))),
        )
        .when(kind == 1, F.to_json(F.struct(F.concat(F.lit(f"{HOST}/x/"), number, F.lit("/y")).alias("url"))))
        .when(kind == 2, F.to_json(F.struct(F.lit(f"{HOST}/none").alias("pdf_url"))))
        .when(kind == 3, F.to_json(F.struct(F.lit(f"{HOST}/none").alias("pdf_url"), number.alias("id"))))
        .otherwise(F.lit("{}"))
    )
    return events.select("event_id", event.alias("event"))


def q_pdf_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.pdf_requests(_pdf_events(spark, sf_dir), bucket="store", prefix="PDF").drop("event")


ORACLES["q_pdf_requests"] = f"""
WITH k AS (SELECT event_id, event_id % 5 AS kind FROM events),
u AS (SELECT *, CASE kind WHEN 0 THEN '{HOST}/bitstream/prefix/' || event_id || '/1/t.pdf'
  WHEN 1 THEN '{HOST}/x/' || event_id || '/y' WHEN 4 THEN NULL ELSE '{HOST}/none' END AS pdf_url,
  CASE WHEN kind IN (0, 1, 3) THEN CAST(event_id AS VARCHAR) END AS item_id FROM k)
SELECT event_id, pdf_url, item_id, 'store' AS bucket, 'PDF' AS prefix, 'PDF/' || item_id || '.pdf' AS key,
  CASE WHEN item_id IS NULL THEN 500 ELSE 200 END AS status,
  CASE kind WHEN 2 THEN '{fixed.NO_ID_IN_PDF_URL}' WHEN 4 THEN '{fixed.MISSING_PDF_URL}' END AS message FROM u"""


def _contents_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.load(spark, sf_dir, "events").select("event_id", "event_type")
    number = F.col("event_id").cast("string")
    kind = F.expr("event_id % 6")
    event = (
        F.when(kind == 0, F.to_json(F.struct(F.concat(F.lit("s3://store/PDF/"), number, F.lit(".pdf")).alias("pdf_s3_uri"))))
        .when(
            kind == 1,
            F.to_json(
                F.struct(
                    F.lit("store").alias("bucket"), F.lit("a/b/text.pdf").alias("key"), number.alias("paper_id"),
                    F.lit("").alias("output_prefix"),
                )
            ),
        )
        .when(kind == 2, F.lit('{"pdf_s3_uri": "http://store/x.pdf"}'))
        .when(kind == 3, F.lit('{"bucket": "store"}'))
        .when(kind == 4, F.lit('{"bucket": "store", "key": "a/text.pdf"}'))
        .otherwise(F.lit('{"key": "1.pdf"}'))
    )
    return events.select("event_id", event.alias("event"))


def q_contents_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = envelopes.contents_requests(_contents_events(spark, sf_dir))
    return requests.select("event_id", "bucket", "key", "paper_id", "output_bucket", "output_key", "status", "message")


ORACLES["q_contents_requests"] = f"""
WITH k AS (SELECT event_id, event_id % 6 AS kind, CAST(event_id AS VARCHAR) AS n FROM events),
u AS (SELECT *, CASE WHEN kind IN (0, 1, 3, 4) THEN 'store' END AS bucket,
  CASE kind WHEN 0 THEN 'PDF/' || n || '.pdf' WHEN 1 THEN 'a/b/text.pdf' WHEN 4 THEN 'a/text.pdf' WHEN 5 THEN '1.pdf' END AS key,
  CASE kind WHEN 0 THEN n WHEN 1 THEN n WHEN 5 THEN '1' END AS paper_id FROM k)
SELECT event_id, bucket, key, paper_id, bucket AS output_bucket,
  CASE kind WHEN 0 THEN 'PDF/' || n || '_tableOfContent.json' WHEN 1 THEN n || '_tableOfContent.json'
    WHEN 5 THEN '1_tableOfContent.json' END AS output_key,
  CASE WHEN kind < 2 THEN 200 ELSE 422 END AS status,
  CASE kind WHEN 2 THEN '{fixed.INVALID_STORAGE_URI}' WHEN 3 THEN '{fixed.MISSING_KEY}'
    WHEN 4 THEN '{fixed.NO_ID_IN_FILE_NAME}' WHEN 5 THEN '{fixed.MISSING_BUCKET}' END AS message FROM u"""


def q_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.load(spark, sf_dir, "events").select("event_id", "event_type")
    kind = F.expr("event_id % 6")
    code = F.when(kind == 2, 404).when(kind == 3, 422).otherwise(200)
    body = F.when(kind == 4, "").when(kind == 5, "not json").when(kind != 1, F.to_json(F.struct("event_id", "event_type")))
    response = F.to_json(F.struct(code.alias("statusCode"), body.alias("body")))
    parsed = envelopes.parsed_responses(events.select("event_id", response.alias("response")))
    return parsed.select("event_id", "statusCode", "decoded", "status", "message")


ORACLES["q_responses"] = f"""
WITH k AS (SELECT *, event_id % 6 AS kind FROM events)
SELECT event_id, CASE kind WHEN 2 THEN 404 WHEN 3 THEN 422 ELSE 200 END AS "statusCode",
  CASE WHEN kind = 0 THEN '{{"event_id":' || event_id || ',"event_type":"' || event_type || '"}}' END AS decoded,
  CASE WHEN kind = 0 THEN 200 ELSE 500 END AS status,
  CASE kind WHEN 1 THEN '{fixed.NO_RESPONSE_BODY}' WHEN 2 THEN '{fixed.NON_200_RESPONSE}' WHEN 3 THEN '{fixed.NON_200_RESPONSE}'
    WHEN 4 THEN '{fixed.UNREADABLE_BODY}' WHEN 5 THEN '{fixed.UNREADABLE_BODY}' END AS message
FROM k"""

QUERIES.update({name: fn for name, fn in globals().items() if name.startswith("q_")})
