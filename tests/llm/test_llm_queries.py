"""The registered queries against their SQL, and the pipeline against its stages' rules."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from acervo.llm import queries
from acervo.llm.common import table
from oracle import compare, duck
from test_llm_minhash import plain_components

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert compare(spark, duck(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []


def test_near_duplicates_of_the_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    expected = plain_components([d[0] for d in docs], [d[1] for d in docs], 3, 85)
    got = queries.QUERIES["op1_minhash"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_token_queries(spark):
    import base64
    import hashlib
    import struct
    import zlib

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF_DIR, "documents").collect()}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_bpe"](spark, SF_DIR).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        ids = whole.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in queries.QUERIES["op3_packing"](spark, SF_DIR).collect():
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert set(pieces) == set(docs)
    for i, text in docs.items():
        ids = plain.encode(text, add_special_tokens=False).ids + [2]
        starts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids), 1024)]
        ends = [*starts[1:], len(ids)]
        assert sorted(pieces[i]) == [
            (k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(starts, ends))
        ]


def test_model_queries(spark):
    import zlib as z

    ids = sorted(r["doc_id"] for r in table(spark, SF_DIR, "documents").select("doc_id").collect())
    assert sorted(r["doc_id"] for r in queries.QUERIES["op8_quality"](spark, SF_DIR).collect()) == ids
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_DIR, "labels").collect()}
    got = queries.QUERIES["op9_toxicity"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in got) == ids
    assert all(r["held_out"] == (z.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    known = [r for r in got if labels.get(r["doc_id"]) is not None]
    right = [r["predicted"] == labels[r["doc_id"]] for r in known]
    assert sum(right) >= 0.9 * len(right)
    assert sum(r["predicted"] for r in known if labels[r["doc_id"]]) >= 0.8 * sum(labels[r["doc_id"]] for r in known)


def test_stages_leave_clashing_columns_alone(spark):
    rows = [(i, f"{'x' * i} one two three four five six", "en", "gone", i, i) for i in range(1, 6)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, gone string, rejected int, g int")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns and kept.count() == 10
    low = corpus_pipeline.drop_low_quality(spark, docs, SF_DIR)
    assert low.columns == docs.columns and low.count() == 10


def test_all_are_registered():
    import __spark_entry__

    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())


def test_pipeline(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, labels = docs.columns, {r["doc_id"]: r for r in table(spark, SF_DIR, "labels").collect()}
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == columns
        rows = out.collect()
        kept.append({r["doc_id"]: r["text"] for r in rows})
        assert len(kept[-1]) == len(rows)
        docs = spark.createDataFrame(rows, out.schema)
    clean = [i for i, r in labels.items() if r["toxic"] == 0 and r["quality"] == 1]
    assert sum(i in kept[1] for i in clean) >= 0.95 * len(clean)
    assert sum(i in kept[0] for i, r in labels.items() if r["toxic"]) <= 0.4 * sum(r["toxic"] for r in labels.values())
    ids = sorted(kept[1])
    groups = plain_components(ids, [kept[1][i] for i in ids], 5, 80)
    assert set(kept[2]) == {i for i, (_, c) in groups.items() if i == c}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r["doc_id"] for r in pieces} == set(kept[2])
    filled = Counter()
    for r in pieces:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 1024
    whole = defaultdict(int)
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        whole[r["doc_id"]] += r["length"]
    assert set(whole) == set(kept[2])
