"""URL parts, resolution, identifiers and storage addresses as native expressions.

Parts come from one generic URI pattern, so no malformed link can raise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo import fixed_values as fixed

_URI = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


@dataclass
class UrlParts:
    scheme: Column
    host: Column
    path: Column
    query: Column


def url_parts(url: Column) -> UrlParts:
    """Scheme, host, path and query; '' for a part that is absent."""
    return UrlParts(*(F.regexp_extract(url, _URI, i) for i in range(1, 5)))


def drop_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"#.*$", "")


def evaluate_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed a single time, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _without_dots(url: Column) -> Column:
    """Resolve ``.`` and ``..`` path segments; an address that has none passes untouched."""

    def resolve(u: Column) -> Column:
        path = F.regexp_extract(u, r"^[^/?#]*//[^/?#]*([^?#]*)", 1)
        segments = F.split(F.regexp_replace(path, r"/\.{1,2}$", "$0/"), "/")
        stack = F.aggregate(
            F.slice(segments, 2, F.size(segments)),
            F.array().cast("array<string>"),
            lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .when(s == ".", done)
            .otherwise(F.concat(done, F.array(s))),
        )
        return F.concat(
            F.regexp_extract(u, r"^([^/?#]*//[^/?#]*)", 1),
            F.lit("/"),
            F.array_join(stack, "/"),
            F.regexp_extract(u, r"(\?.*)$", 1),
        )

    return evaluate_once(
        url, lambda u: F.when(u.rlike(r"^[^/?#]*//[^?#]*/\.{1,2}(/|\?|$)"), resolve(u)).otherwise(u)
    )


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` on a page at ``base``, without its fragment."""
    origin = F.regexp_extract(base, r"^([^/?#]*//[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(base, r"^([^/?#]*//[^/?#]*/(?:[^?#]*/)?)", 1)

    def against_base(target: Column) -> Column:
        relative = (
            F.when(target.startswith("//"), F.concat(F.regexp_extract(base, r"^([^/?#]*)", 1), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when(target.startswith("?"), F.concat(page, target))
            .when(target == "", drop_fragment(base))
            .otherwise(F.concat(F.coalesce(F.nullif(folder, F.lit("")), F.concat(origin, F.lit("/"))), target))
        )
        return F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), target).otherwise(_without_dots(relative))

    return evaluate_once(drop_fragment(F.regexp_replace(F.ltrim(href), r"[\t\r\n]", "")), against_base)


def is_item_link(url: Column, pattern: str = fixed.ITEM_PATH) -> Column:
    """Whether the path holds an item address."""
    return url_parts(url).path.rlike(pattern)


def _plain_path(url: Column) -> Column:
    """The path without parameters behind a semicolon in its last segment."""
    return F.regexp_replace(url_parts(url).path, r";[^/]*$", "")


def last_segment(url: Column) -> Column:
    """Last non-empty path segment, NULL where the path has none."""
    segments = F.filter(F.split(_plain_path(url), "/"), lambda s: s != "")
    return F.try_element_at(segments, F.lit(-1))


def item_number(url: Column) -> Column:
    """Number of a handle, else of a bitstream, else the last digits of the path."""
    path = _plain_path(url)
    return F.coalesce(
        F.nullif(F.regexp_extract(path, fixed.HANDLE_ID, 1), F.lit("")),
        F.nullif(F.regexp_extract(path, fixed.BITSTREAM_ID, 1), F.lit("")),
        F.nullif(F.regexp_extract(path, r"(\d+)\D*$", 1), F.lit("")),
    )


def file_number(key: Column) -> Column:
    """First digits of the file name, NULL where it has none."""
    return F.nullif(F.regexp_extract(F.substring_index(key, "/", -1), r"(\d+)", 1), F.lit(""))


def _reencode(text: Column) -> Column:
    """A query token decoded and encoded again, blanks as ``+``."""
    encoded = F.url_encode(F.coalesce(F.try_url_decode(text), text))
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def with_query_value(url: Column, name: str, value: str) -> Column:
    """The URL with ``name=value``: replaced in place where present, else appended.

    Parameters without a value are dropped; repeated ones move up to their first place.
    """
    pairs = F.transform(
        F.filter(F.split(url_parts(url).query, "&"), lambda p: p.rlike(r"^[^=]*=.")),
        lambda p: F.struct(
            _reencode(F.substring_index(p, "=", 1)).alias("k"),
            _reencode(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )

    def rebuilt(pairs: Column) -> Column:
        names = F.array_distinct(F.concat(F.transform(pairs, lambda p: p["k"]), F.array(F.lit(name))))
        texts = F.transform(
            names,
            lambda k: F.when(k == name, F.lit(f"{name}={value}")).otherwise(
                F.array_join(
                    F.transform(
                        F.filter(pairs, lambda p: p["k"] == k), lambda p: F.concat(p["k"], F.lit("="), p["v"])
                    ),
                    "&",
                )
            ),
        )
        return F.array_join(texts, "&")

    return F.concat(
        F.regexp_extract(url, r"^([^?#]*)", 1),
        F.lit("?"),
        evaluate_once(pairs, rebuilt),
        F.regexp_extract(url, r"(#.*)$", 1),
    )


def full_record_url(url: Column) -> Column:
    """Address of the full-record variant of an item page."""
    return with_query_value(url, "show", "full")


def storage_bucket(uri: Column) -> Column:
    """Bucket of an ``s3://bucket/key`` address, NULL for any other text."""
    return F.nullif(F.regexp_extract(uri, r"(?i)^s3://([^/?#]*)", 1), F.lit(""))


def storage_key(uri: Column) -> Column:
    """Key of an ``s3://bucket/key`` address, NULL for any other text."""
    return F.nullif(F.regexp_extract(uri, r"(?i)^s3://[^/?#]*/+([^?#]+)", 1), F.lit(""))


def parent_prefix(key: Column) -> Column:
    """Everything before the last slash, '' without one."""
    return F.regexp_extract(key, r"^(.*)/[^/]*$", 1)


def join_key(prefix: Column, file_name: Column) -> Column:
    """``prefix/file_name`` with outer slashes of the prefix removed; no prefix, no slash."""
    trimmed = F.regexp_replace(F.coalesce(prefix, F.lit("")), r"^/+|/+$", "")
    return F.when(trimmed == "", file_name).otherwise(F.concat(trimmed, F.lit("/"), file_name))


def document_key(prefix: Column, item_id: Column) -> Column:
    """Key a paper document is stored under."""
    return join_key(prefix, F.concat(item_id, F.lit(".json")))


def contents_key(prefix: Column, item_id: Column) -> Column:
    """Key a table of contents is stored under."""
    return join_key(prefix, F.concat(item_id, F.lit("_tableOfContent.json")))


def pdf_key(prefix: Column, item_id: Column) -> Column:
    """Key a PDF is stored under."""
    return join_key(prefix, F.concat(item_id, F.lit(".pdf")))


def storage_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)
