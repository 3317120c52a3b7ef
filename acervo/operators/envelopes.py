"""Request and response envelopes: JSON text in, fields or a reason out.

Every function keeps all rows and adds ``status`` (200, or the error's code) and ``message``,
so good and bad rows split by a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo import fixed_values as fixed
from acervo.functions import urls

_REQUEST = (
    "url string, pdf_url string, id string, bucket string, prefix string, pdf_s3_uri string, "
    "key string, paper_id string, output_bucket string, output_prefix string"
)
_UNREADABLE = {"columnNameOfCorruptRecord": "__bad"}
_ENVELOPE = "queryStringParameters struct<url:string>, body string"


def _fields(json: Column, schema: str) -> Column:
    """The fields of a JSON object; ``__bad`` holds a text that is none."""
    return F.from_json(json, f"{schema}, __bad string", _UNREADABLE)


def _is_braced(json: Column) -> Column:
    """Whether a text can only be a JSON object."""
    return F.coalesce(F.ltrim(json, F.lit(" \t\r\n")).startswith("{"), F.lit(False))


def _readable(json: Column) -> Column:
    """Whether the text is JSON of any kind."""
    return F.try_parse_json(json).isNotNull()


def _filled(c: Column) -> Column:
    """NULL for an empty text."""
    return F.nullif(c, F.lit(""))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row, however often they are used.

    A generator's row is no projection, so the optimizer cannot copy what makes it into its uses.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _opened(events: DataFrame) -> DataFrame:
    """Adds the parsed envelope and body and what they are: two parses a row at most.

    A body that is an object, or text holding one, takes the place of the outer object. A body text
    that is no JSON makes the event unreadable: ``__bad_body``, without a request.
    """
    outer = _once(events, __env=_fields(F.col("event"), f"{_ENVELOPE}, {_REQUEST}"))
    body = _filled(F.col("__env.body"))
    braced = _is_braced(body)
    opened = _once(
        outer,
        __inner=F.when(braced, _fields(body, _REQUEST)),
        __other=F.when(body.isNotNull() & ~braced, _readable(body)),  # JSON that is no object
    )
    bad = F.coalesce(F.col("__inner.__bad").isNotNull() | ~F.col("__other"), F.lit(False))
    is_object = _is_braced(F.col("event")) & F.col("__env.__bad").isNull()
    return opened.withColumns({"__bad_body": bad, "__is_object": is_object})


_WORK = ("__env", "__inner", "__other", "__bad_body", "__is_object")


def _asked(name: str) -> Column:
    """A field of the request in force: the body's where that is an object, else the event's own."""
    field = F.when(F.col("__inner").isNotNull(), F.col(f"__inner.{name}")).otherwise(F.col(f"__env.{name}"))
    return F.when(~F.col("__bad_body"), field)


def _verdict(checks: list[tuple[Column, str, int]]) -> dict[str, Column]:
    """status and message of the first check that holds."""
    status, message = F.lit(200), F.lit(None).cast("string")
    for failed, reason, code in reversed(checks):
        status = F.when(failed, code).otherwise(status)
        message = F.when(failed, F.lit(reason)).otherwise(message)
    return {"status": status, "message": message}


def link_requests(events: DataFrame) -> DataFrame:
    """Search-page requests: the query string's url, else the body's, else the event's own."""
    asked = _filled(F.col("__env.queryStringParameters.url"))  # found before the body is looked at
    own = F.coalesce(_filled(F.col("__inner.url")), _filled(F.col("__env.url")))
    url = F.coalesce(asked, F.when(~F.col("__bad_body"), own))
    opened = _opened(events).withColumn("url", url)
    checks = [
        (~F.col("__is_object"), fixed.INVALID_EVENT, 500),
        (F.col("__bad_body") & F.col("url").isNull(), fixed.UNREADABLE_BODY, 500),
        (F.col("url").isNull(), fixed.URL_REQUIRED, 500),
    ]
    return opened.withColumns(_verdict(checks)).drop(*_WORK)


def paper_requests(events: DataFrame, bucket: str | None = None, prefix: str | None = None) -> DataFrame:
    """Paper requests: url, bucket, prefix (with defaults) and the item id of the url."""
    request = _opened(events).withColumns(
        {
            "url": _filled(_asked("url")),
            "bucket": F.coalesce(_filled(_asked("bucket")), F.lit(bucket).cast("string")),
            "prefix": F.coalesce(_filled(_asked("prefix")), F.lit(prefix).cast("string")),
        }
    )
    request = request.withColumn("item_id", urls.last_segment(F.col("url")))
    checks = [
        (~F.col("__is_object"), fixed.INVALID_EVENT, 500),
        (F.col("__bad_body"), fixed.UNREADABLE_BODY, 500),
        (F.col("url").isNull(), fixed.MISSING_URL, 500),
        (F.col("bucket").isNull(), fixed.MISSING_BUCKET_ONLY, 500),
        (F.col("item_id").isNull(), fixed.NO_PAPER_ID, 500),
    ]
    return request.withColumns(_verdict(checks)).drop(*_WORK)


def pdf_requests(events: DataFrame, bucket: str | None = None, prefix: str | None = None) -> DataFrame:
    """PDF requests: pdf_url (or url), item id (given or from the address), bucket, prefix, key."""
    request = _opened(events).withColumn(
        "pdf_url", F.coalesce(_filled(_asked("pdf_url")), _filled(_asked("url")))
    )
    request = request.withColumns(
        {
            "item_id": F.coalesce(_filled(_asked("id")), urls.item_number(F.col("pdf_url"))),
            "bucket": F.coalesce(_filled(_asked("bucket")), F.lit(bucket).cast("string")),
            "prefix": F.coalesce(_filled(_asked("prefix")), F.lit(prefix).cast("string")),
        }
    )
    request = request.withColumn("key", urls.pdf_key(F.col("prefix"), F.col("item_id")))
    checks = [
        (~F.col("__is_object"), fixed.INVALID_EVENT, 500),
        (F.col("__bad_body"), fixed.UNREADABLE_BODY, 500),
        (F.col("pdf_url").isNull(), fixed.MISSING_PDF_URL, 500),
        (F.col("item_id").isNull(), fixed.NO_ID_IN_PDF_URL, 500),
        (F.col("bucket").isNull(), fixed.MISSING_BUCKET_ONLY, 500),
    ]
    return request.withColumns(_verdict(checks)).drop(*_WORK)


def contents_requests(
    events: DataFrame, output_bucket: str | None = None, output_prefix: str | None = None
) -> DataFrame:
    """Contents requests: source bucket and key, paper id, output bucket, prefix and key."""
    uri = _filled(_asked("pdf_s3_uri"))
    request = _opened(events).withColumns(
        {
            "bucket": F.when(uri.isNotNull(), urls.storage_bucket(uri)).otherwise(
                _filled(_asked("bucket"))
            ),
            "key": F.when(uri.isNotNull(), urls.storage_key(uri)).otherwise(_filled(_asked("key"))),
            "__bad_uri": F.coalesce(
                uri.isNotNull() & (urls.storage_bucket(uri).isNull() | urls.storage_key(uri).isNull()),
                F.lit(False),
            ),
        }
    )
    request = request.withColumns(
        {
            "paper_id": F.coalesce(_filled(_asked("paper_id")), urls.file_number(F.col("key"))),
            "output_bucket": F.coalesce(
                _filled(_asked("output_bucket")), F.lit(output_bucket).cast("string"), F.col("bucket")
            ),
            "output_prefix": F.coalesce(
                _asked("output_prefix"),
                F.lit(output_prefix).cast("string"),
                urls.parent_prefix(F.col("key")),
            ),
        }
    )
    request = request.withColumn("output_key", urls.contents_key(F.col("output_prefix"), F.col("paper_id")))
    checks = [
        (~F.col("__is_object"), fixed.INVALID_EVENT, 422),
        (F.col("__bad_body"), fixed.UNREADABLE_BODY, 422),
        (F.col("__bad_uri"), fixed.INVALID_STORAGE_URI, 422),
        (F.col("bucket").isNull(), fixed.MISSING_BUCKET, 422),
        (F.col("key").isNull(), fixed.MISSING_KEY, 422),
        (F.col("paper_id").isNull(), fixed.NO_ID_IN_FILE_NAME, 422),
    ]
    return request.withColumns(_verdict(checks)).drop(*_WORK, "__bad_uri")


def decoded_responses(responses: DataFrame) -> DataFrame:
    """Response envelopes ``(statusCode, body)``: the body of good ones, the reason of the others.

    A body that is no JSON, the empty text included, cannot be decoded.
    """
    checks = [
        (~F.col("statusCode").eqNullSafe(200), fixed.NON_200_RESPONSE, 500),
        (F.col("body").isNull(), fixed.NO_RESPONSE_BODY, 500),
        (~F.col("__readable"), fixed.UNREADABLE_BODY, 500),
    ]
    good = F.when(F.col("statusCode") == 200, _readable(F.col("body")))
    judged = _once(responses, __readable=good).withColumns(_verdict(checks))
    return judged.withColumn("decoded", F.when(F.col("status") == 200, F.col("body"))).drop("__readable")


def parsed_responses(texts: DataFrame, column: str = "response") -> DataFrame:
    """``decoded_responses`` for envelopes that are still JSON text."""
    parsed = _once(texts, __r=F.from_json(column, "statusCode int, body string"))
    return decoded_responses(
        parsed.withColumn("statusCode", F.col("__r.statusCode")).withColumn("body", F.col("__r.body"))
    ).drop("__r")
