from __future__ import annotations

from urllib.parse import parse_qs, urldefrag, urlencode, urljoin, urlsplit, urlunsplit

from pyspark.sql import functions as F

from acervo.functions import urls

BASES = [
    "https://host.example/a/b/page.html?x=1#f",
    "http://host.example",
    "https://host.example/dir/",
    "https://host.example:8080/a/b/c/d",
]
HREFS = [
    "/handle/p/12",
    "other",
    "./other",
    "../up/x?y=1#z",
    "../../../../top",
    "//cdn.example/x",
    "https://else.example/p?q=1#frag",
    "mailto:someone@example.org",
    "javascript:void(0)",
    "?only=query",
    "#only-fragment",
    "",
    "a/b/../c/./d",
    "x/..",
    "/a/b/.",
    "file.pdf#page=2",
    " /spaced",
    "for/the/ü",
]


def test_resolve_agrees_with_the_standard_library(spark):
    pairs = [(b, h, urldefrag(urljoin(b, h))[0]) for b in BASES for h in HREFS]
    df = spark.createDataFrame(pairs, "base string, href string, expected string")
    got = df.withColumn("got", urls.resolve_url(F.col("base"), F.col("href")))
    wrong = got.where(~F.col("got").eqNullSafe(F.col("expected"))).collect()
    assert wrong == []


def test_query_value_agrees_with_the_standard_library(value):
    def expected(url):
        parts = urlsplit(url)
        query = parse_qs(parts.query)
        query["show"] = ["full"]
        return urlunsplit(parts._replace(query=urlencode(query, doseq=True)))

    texts = [
        "https://h.example/x/1",
        "https://h.example/x/1?a=1&b=2",
        "https://h.example/x/1?a=1&show=simple&b=2#top",
        "https://h.example/x/1?a=1&b=&a=2",
        "https://h.example/x/1?q=a%20b~c*d%C3%A9&show=full",
        "https://h.example/x/1?bad=%zz",
    ]
    assert value(urls.full_record_url, texts) == [expected(t) for t in texts]


def test_item_identifiers(value):
    texts = ["https://h/handle/a/12", "https://h/bitstream/a/34/f.pdf", "https://h/x/5/y7z/", "https://h/none", "https://h/", None]
    assert value(urls.item_number, texts) == ["12", "34", "7", None, None, None]
    assert value(urls.last_segment, texts) == ["12", "f.pdf", "y7z", "none", None, None]
    assert value(urls.file_number, ["PDF/ab12c3.pdf", "9/x.pdf", "x"]) == ["12", None, None]


def test_item_link_predicate(value):
    texts = ["https://h/handle/p/2700", "https://h/handle/p/x", "https://h/?u=/handle/p/1", "https://h/a/handle/p/1/b"]
    assert value(urls.is_item_link, texts) == [True, False, False, True]


def test_storage_addresses(value):
    texts = ["s3://bucket/a/b.pdf", "s3://bucket", "http://bucket/a", "s3:///a"]
    assert value(urls.storage_bucket, texts) == ["bucket", "bucket", None, None]
    assert value(urls.storage_key, texts) == ["a/b.pdf", None, None, "a"]
    assert value(urls.parent_prefix, ["a/b/c.pdf", "c.pdf"]) == ["a/b", ""]
    assert value(lambda c: urls.document_key(c, F.lit("7")), ["/x/", "", None, "a/b"]) == [
        "x/7.json", "7.json", "7.json", "a/b/7.json",
    ]
    assert value(lambda c: urls.contents_key(F.lit("T"), c), ["7"]) == ["T/7_tableOfContent.json"]
