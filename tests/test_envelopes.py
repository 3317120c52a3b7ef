from __future__ import annotations

from acervo.operators import envelopes
from tables import rows


def _events(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, event string")


def test_link_requests(spark):
    events = _events(
        spark,
        '{"url": "a"}',
        '{"body": "{\\"url\\": \\"b\\"}", "url": "a"}',
        '{"body": {"url": "c"}}',
        '{"queryStringParameters": {"url": "q"}, "body": "{\\"url\\": \\"b\\"}"}',
        '{"queryStringParameters": null, "body": null, "url": "a"}',
        "{}",
        "[1]",
        "nonsense",
        None,
        '{"body": {"other": 1}, "url": "a"}',
        '{"body": "no json", "url": "a"}',
        '{"body": "no json", "queryStringParameters": {"url": "q"}}',
        '{"body": "", "url": "a"}',
    )
    got = envelopes.link_requests(events).orderBy("i").collect()
    assert [r["url"] for r in got] == ["a", "b", "c", "q", "a", None, None, None, None, "a", None, "q", "a"]
    assert [r["status"] for r in got] == [200] * 5 + [500] * 4 + [200, 500, 200, 200]
    assert got[10]["message"] == "The body is no readable JSON."
    assert got[5]["message"] == "The field 'url' is required."
    assert got[7]["message"] == "Invalid event. Expected JSON object."


def test_paper_requests_let_the_body_replace_the_event(spark):
    events = _events(
        spark, '{"url": "https://h/x/1", "bucket": "b"}', '{"body": {"bucket": "c"}, "url": "https://h/x/1"}', '{"url": "https://h/"}'
    )
    got = envelopes.paper_requests(events, bucket="default", prefix="p").orderBy("i").collect()
    assert [(r["url"], r["bucket"], r["prefix"], r["item_id"], r["status"]) for r in got] == [
        ("https://h/x/1", "b", "p", "1", 200),
        (None, "c", "p", None, 500),
        ("https://h/", "default", "p", None, 500),
    ]
    assert envelopes.paper_requests(events).where("i = 2").first()["message"].startswith("Missing bucket")


def test_pdf_and_contents_requests(spark):
    events = _events(
        spark,
        '{"id": "9", "pdf_url": "https://h/bitstream/p/3/f.pdf"}',
        '{"url": "https://h/bitstream/p/3/f.pdf"}',
        '{"pdf_url": "https://h/none"}',
    )
    got = envelopes.pdf_requests(events, bucket="b", prefix="PDF").orderBy("i").collect()
    assert [(r["item_id"], r["key"], r["status"]) for r in got] == [
        ("9", "PDF/9.pdf", 200), ("3", "PDF/3.pdf", 200), (None, None, 500),
    ]
    events = _events(
        spark,
        '{"pdf_s3_uri": "s3://b/PDF/12.pdf", "output_prefix": "T"}',
        '{"bucket": "b", "key": "x/12.pdf", "output_bucket": "o"}',
        '{"pdf_s3_uri": "file:///x"}',
    )
    got = envelopes.contents_requests(events).orderBy("i").collect()
    assert [(r["paper_id"], r["output_bucket"], r["output_key"], r["status"]) for r in got] == [
        ("12", "b", "T/12_tableOfContent.json", 200),
        ("12", "o", "x/12_tableOfContent.json", 200),
        (None, None, None, 422),
    ]


def test_responses(spark):
    responses = spark.createDataFrame(
        [(200, "[1]"), (200, None), (200, ""), (200, "not json"), (404, "x"), (422, "y"), (None, "z")], "statusCode int, body string"
    )
    got = envelopes.decoded_responses(responses)
    assert rows(got, "statusCode", "decoded", "status") == rows(
        spark.createDataFrame(
            [(200, "[1]", 200), (200, None, 500), (200, None, 500), (200, None, 500), (404, None, 500), (422, None, 500), (None, None, 500)],
            "a int, b string, c int",
        )
    )
    texts = spark.createDataFrame([('{"statusCode": 200, "body": {"id": 1}}',), ("bad",)], "response string")
    assert rows(envelopes.parsed_responses(texts), "decoded", "status") == [('{"id":1}', 200), (None, 500)]
