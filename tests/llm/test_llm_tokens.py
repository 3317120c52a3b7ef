"""BPE and packing against the libraries and by their own rules."""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from acervo.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = "Some words, and more; a line\nbreak  and 2 spaces. It's über! " * 3000
TEXTS = [
    None, "", " ", "a", "  a  b ", "\n\n  x\t y", "don't WE'LL 12ab34", "<|endoftext|> <|im_start|>", "naïve 日本語 \U0001f600",
    "a\u00a0b \u3000c", "x\x1c y \x85 z", "tail ", "tail \n", "a \n b", "...  ...", "A" * 70000, "ab " * 40000, LONG, LONG,
]


@pytest.fixture(scope="module")
def whole():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(spark, whole):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "ids long, text string").withColumn("decoded", F.lit(1))
    made = bpe.encode_table(df.withColumnRenamed("ids", "k"), RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_table(made, RANKS, public_tokenizers.PATTERN)
    rows = {r["k"]: r for r in back.withColumn("n", bpe.n_tokens(F.col("ids"))).collect()}
    for i, text in enumerate(TEXTS):
        expected = whole.encode_ordinary(text or "")
        assert list(struct.unpack(f"<{len(expected)}I", rows[i]["ids"])) == expected, i
        assert rows[i]["n"] == len(expected)
        assert bytes(rows[i]["decoded"]) == (text or "").encode()
    assert bpe.encode_table(df.limit(0), RANKS, public_tokenizers.PATTERN, ids="new").count() == 0


def test_raw_bytes_need_not_be_text(spark, whole):
    ids = struct.pack("<2I", *whole.encode_ordinary("é")[:1] * 2) if len(whole.encode_ordinary("\u0378")) < 2 else struct.pack("<I", whole.encode_ordinary("\u0378")[0])
    df = spark.createDataFrame([(bytearray(ids),), (None,)], "ids binary")
    got = [bytes(r["decoded"]) for r in bpe.decode_table(df, RANKS, public_tokenizers.PATTERN).collect()]
    assert got[0] == whole.decode_bytes(list(struct.unpack(f"<{len(ids) // 4}I", ids))) and got[1] == b""


def test_parts_join_to_the_text(whole):
    for size in (1, 7, 1000):
        parts = list(bpe.parts(LONG, size))
        assert "".join(parts) == LONG
        assert sum((whole.encode_ordinary(p) for p in parts), []) == whole.encode_ordinary(LONG)


def plain_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_words_give_the_ids_of_the_text():
    texts = [t or "" for t in TEXTS]
    for text, ids in zip(texts, packing.encode_words(texts, TOKENIZER)):
        expected = plain_ids(text)[:-1]
        assert list(struct.unpack(f"<{len(expected)}I", ids)) == expected, text[:40]


def test_packing(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "word " * (i * 37 % 900)) for i in range(300)] + [(None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("piece", F.lit("clash"))
    pieces = packing.tokenize(df, TOKENIZER, end_id=2)
    got = packing.pack(pieces.withColumns({"offset": F.lit("clash"), "sequence_id": F.lit("clash")})).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc_id, text in rows[:30] + rows[-1:]:
        ids = plain_ids(text)
        at = 0
        parts = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        for k, r in enumerate(parts):
            assert (r["piece"], r["start"]) == (k, at) and (r["length"] == 1024 or k == 0)
            data = struct.pack(f"<{r['length']}I", *ids[at : at + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(data) and bytes(r["ids"]) == data
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(by_sequence) <= 1.03 * total / 1024 + 2
    assert packing.pack(pieces.limit(0)).count() == 0
    again = sorted(map(tuple, packing.pack(pieces).drop("ids").collect()), key=repr)
    assert again == sorted((tuple(r[c] for c in r.asDict() if c != "ids") for r in got), key=repr)


def test_bins_close_the_fullest_first():
    bins = packing.Bins(10, 2, 0)
    assert [bins.put(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the third closes: 2 free
    assert bins.put(2) == (1, 7)  # 3 free there, 4 in the first
    assert bins.put(4) == (0, 6) and bins.put(1) == (1, 9) and bins.put(1) == (3, 0)


def test_digest_of_the_ids(spark, whole):
    text = "a few words"
    df = spark.createDataFrame([(text,)], "text string")
    made = bpe.encode_table(df, RANKS, public_tokenizers.PATTERN).select(F.sha2("ids", 256)).first()[0]
    ids = whole.encode_ordinary(text)
    assert made == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_words_that_are_dropped_or_share_a_hash_keep_their_ids(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    texts = ["w0 " + " ".join(f"w{i * k % 97}x{'y' * (i % 70)}" for i in range(60)) + " end" for k in range(1, 20)] + [""]
    expected = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    same_hashes = lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(5)
    for hashed in (packing.hash_spans, same_hashes):
        monkeypatch.setattr(packing, "CACHED_WORDS", 40)
        monkeypatch.setattr(packing, "hash_spans", hashed)
        monkeypatch.setattr(packing, "_words", {})
        assert [packing.encode_words([t], TOKENIZER)[0] for t in texts] == expected
        known = packing._words[TOKENIZER]
        assert 0 < len(known.words) == len(known.ids) == len(known.hashes) <= 40
        assert packing.encode_words(pa.array(texts), TOKENIZER) == expected
        assert packing.encode_words([], TOKENIZER) == []


def test_a_worker_lets_go_of_the_words_when_another_operator_is_at_work():
    from acervo.llm import common

    common.at_work("packing", packing._forget)
    expected = packing.encode_words(["a b c a"], TOKENIZER)
    common.at_work("packing")
    assert packing._words and packing._tokenizers
    common.at_work("toxicity")
    assert not packing._words and not packing._tokenizers
    assert packing.encode_words(["a b c a"], TOKENIZER) == expected and packing._words


def test_a_task_gives_its_memory_back(spark):
    import re

    from pyspark.sql.functions import col

    from acervo.llm import common

    def held() -> int:
        with open("/proc/self/smaps_rollup") as f:
            return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", f.read()))) // 1024

    def use(batches):
        for batch in batches:
            kept = [bytes(n) for n in range(4000, 24_000)] + [batch]  # 280 MB of many small pieces
            yield pa.RecordBatch.from_arrays([pa.array([held()], pa.int64()), pa.array([len(kept)], pa.int64())], ["held", "n"])

    def look(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([held()], pa.int64()), pa.array([0], pa.int64())], ["held", "n"])

    import pyarrow as pa

    one = spark.range(1).coalesce(1)
    full = one.mapInArrow(common.tidy(use), "held long, n long").first()["held"]
    idle = one.mapInArrow(look, "held long, n long").where(col("n") == 0).first()["held"]
    assert full > 250 and idle < full - 200


def test_batches_of_whole_texts_are_bounded_by_bytes(spark, tmp_path):
    import pyarrow as pa

    from acervo.llm import common

    spark.range(6000).selectExpr("id AS doc_id", "repeat('word ', 400) AS text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64()), pa.array([batch.num_rows], pa.int64())], ["bytes", "n"])

    got = common.table(spark, str(tmp_path), "documents").mapInArrow(sizes, "bytes long, n long").collect()
    assert sum(r["n"] for r in got) == 6000 and max(r["bytes"] for r in got) < 5 << 20


def test_texts_are_taken_from_a_batch_in_pieces_of_bounded_size():
    import pyarrow as pa

    from acervo.llm import words

    texts = ["é" * n for n in range(50)] + [None, "", "x" * 500, None]
    for array in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["skipped", *texts])[1:]):
        found = list(words.pieces(array, 200))
        assert [t for piece in found for t in piece] == [(t or "").encode() for t in texts]
        assert len(found) > 5 and all(sum(len(t) + 1 for t in piece[:-1]) < 200 for piece in found)
    assert list(words.pieces(pa.array([], pa.string()))) == []
