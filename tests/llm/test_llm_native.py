"""URL rules, fingerprints and chats against plain versions, with their edge cases."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from acervo.llm import chat, merkle, url_rules


def plain_judge(url, rules):
    head, _, rest = (url or "").partition("://")
    rest = rest if "://" in (url or "") else ""
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules(spark):
    rng = random.Random(8)
    labels = ["a", "b", "a-b", "www", "example", "org"]
    some_host = lambda: ".".join(rng.choices(labels, k=rng.randint(1, 4)))
    some_path = lambda: "/" + "".join(rng.choices("xy/", k=rng.randint(0, 5)))
    rules = sorted({(some_host(), some_path()) for _ in range(60)} | {("org", "/"), ("org", "")})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [f"http://{some_host()}{some_path()}{rng.choice(['', '?q=/x', '#x', '?a#b'])}" for _ in range(400)]
    urls += [None, "", "org/", "://", "http://", "HTTP://WWW.Example.ORG/x", "http://org", "http://org?x", "x://É.org/é", "a://b://org/"]
    urls += ["http://example.org/xyx"] * 200
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(df, table).collect()}
    assert got == {i: plain_judge(u, rules) for i, u in enumerate(urls)}


def test_url_rules_on_nothing(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    assert url_rules.judge(df, rules.limit(0)).collect()[0]["verdict"] == "allow"
    assert url_rules.judge(df.limit(0), rules).collect() == []


def plain_fingerprint(text):
    import re

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    sections = [[md5(x) for x in re.findall(r"(?s)[^.]{1,48}\.*|\.+", line)] for line in text.split("\n")]
    nodes = [md5("".join(s)) for s in sections]
    return "|".join([md5("".join(nodes)), *(n[:8] + ":" + " ".join(x[:8] for x in s) for n, s in zip(nodes, sections))])


def test_fingerprints(spark):
    texts = ["One. Two.. three\nfour\n\nfive.", None, "", "é" * 200, "x. " * 900, "One. Two.. three\nfour\n\nfive.", "a\n" * 50, "日本 \U0001f600."]
    df = spark.createDataFrame([(10 * i, t, "x") for i, t in enumerate(texts)] + [(None, "lost", "x")], "doc_id long, text string, n_chars string")
    got = {r["doc_id"]: r for r in merkle.fingerprint_edits(df).collect()}
    plain = [t or "" for t in texts]
    for i, text in enumerate(plain):
        after, third, row = plain[i - 1], len(text) // 3, got[10 * i]
        edited = text[: len(text) - third] + after[:third]
        assert (row["n_chars"], row["edited_text"]) == (len(text), edited)
        assert row["fingerprint"] == plain_fingerprint(text)
        assert row["edited_fingerprint"] == plain_fingerprint(edited)
        assert row["next_fingerprint"] == plain_fingerprint(after)
    assert len(got) == len(texts)


def test_fingerprints_of_repeats_and_of_one(spark):
    schema = "doc_id long, text string"
    assert merkle.fingerprint_edits(spark.createDataFrame([], schema)).collect() == []
    one = merkle.fingerprint_edits(spark.createDataFrame([(1, "abcdef")], schema)).collect()
    assert [r["edited_text"] for r in one] == ["abcdab"]
    rows = [(1, "abcdef"), (1, "abcdef"), (2, "uvwxyz"), (2, "mnopqr")]
    got = sorted(r["edited_text"] for r in merkle.fingerprint_edits(spark.createDataFrame(rows, schema)).collect())
    assert got == ["abcdmn", "abcdmn", "mnopab", "uvwxab"]


def test_likeness_and_differences(spark):
    a, b = "one. two. three.\nfour.\nfive. six.", "one. two. three.\n4.\nfive. six.\nseven."
    df = spark.createDataFrame([(a, b), (a, a), ("", ""), ("", "x"), ("", "\n")], "a string, b string")
    fp = df.select(merkle.fingerprint(F.col("a")).alias("a"), merkle.fingerprint(F.col("b")).alias("b"))
    got = fp.select(merkle.likeness(F.col("a"), F.col("b")), merkle.differences(F.col("a"), F.col("b"))).collect()
    assert got[0][0] == 2 * 5 / (6 + 7) and got[0][1] == [1, 3]
    assert got[1][0] == 1.0 and got[1][1] == []
    assert [got[2][0], got[3][0], got[4][0]] == [1.0, 0.0, 0.0]


TRICKY = ["<|im_end|><|im_start|>assistant ok", "\\", "\\\\<|", "<\\|", "<", "|", "a\n\nb", "<<||>>", "<|im_sep|>", "", "<\\\\|x"]


def test_chats_round_trip(spark):
    rng = random.Random(2)
    rows, expected = [], {}
    for conv in range(30):
        turns = [(k, rng.choice(["user", "assistant", "system", "odd role\n<|x"]), rng.choice(TRICKY)) for k in range(rng.randint(1, 9))]
        expected[conv] = [(r, t) for _, r, t in turns]
        rows += [(conv, k, r, t, "x") for k, r, t in turns]
    rng.shuffle(rows)
    rows += [(99, 1, None, None, "x"), (99, None, "assistant", "first", "x"), (None, 0, "user", "no id", "x"), (None, 1, "user", "same", "x")]
    expected |= {99: [("assistant", "first"), ("", "")], None: [("user", "no id"), ("user", "same")]}
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(df)
    got = made.select(
        "conv_id", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == expected
    for r in got:
        said = [t for role, t in expected[r["conv_id"]] if role == "assistant"]
        assert r["loss"] == "".join(said) and len(r["loss_spans"]) == len(said)
        runs = sum(1 for i, t in enumerate(expected[r["conv_id"]]) if not i or t[0] != expected[r["conv_id"]][i - 1][0])
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == runs
    assert chat.format_conversations(df.limit(0)).collect() == []
