"""Neighbours, quality and toxicity against brute force, a plain model and held-out rows."""

from __future__ import annotations

import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from acervo.llm import ann, kn_quality, toxicity


def made_vectors():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 24))
    vectors = [c + 0.2 * rng.standard_normal(24) for c in centres for _ in range(60)] + list(rng.standard_normal((200, 24)))
    vectors += [vectors[0]] * 40 + [vectors[100]] * 3
    return [[float(np.float32(x)) for x in v] for v in vectors]


def test_neighbours(spark):
    vectors = made_vectors()
    bad = [None, [0.0] * 24, [], [None] + [1.0] * 23, [math.nan] + [1.0] * 23, [math.inf] + [1.0] * 23, [1.0, 2.0]]
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(5000 + 10 * i, v, "x") for i, v in enumerate(bad)]
    rows += [(None, vectors[5], "x"), rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string").repartition(5)
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 10 == 0, k=10, cell=128).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    data = np.array(vectors)
    assert set(got) == {i for i in range(0, len(vectors), 10)}
    found = wanted = 0
    for q, rows_ in got.items():
        d = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(len(d)), d)) if i != q][:10]
        rows_.sort()
        assert [r[0] for r in rows_] == list(range(1, 11))
        assert all(abs(s - d[i]) < 1e-12 for _, i, s in rows_)
        assert [r[1:] for r in rows_] == sorted((r[1:] for r in rows_), key=lambda x: (x[1], x[0]))
        found += len(set(best) & {r[1] for r in rows_})
        wanted += 10
        if q in (0, 720 + 200):  # queries among the copies: all ties, smallest ids
            assert [r[1] for r in rows_] == best
    assert found / wanted >= 0.9


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, size):
    from acervo.llm import queries

    folder = f"/root/testdata/{size}"
    if not os.path.isdir(folder):
        pytest.skip("no benchmark tables")
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, data = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    got = defaultdict(set)
    for r in queries.QUERIES["op5_ann"](spark, folder).collect():
        got[r["query_id"]].add(r["vec_id"])
    found = wanted = 0
    for q in ids[ids % 100 == 0]:
        d = ((data - data[ids == q][0]) ** 2).sum(axis=1)
        best = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        found += len(got[q] & set(best))
        wanted += len(best)
    print(f"recall {size}: {found} of {wanted}, {len(got)} queries of {len(ids)} vectors")
    assert found / wanted >= 0.95


def test_neighbours_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [4.0, 4.0])], schema)
    got = ann.nearest(df, F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 3, 0.0), (0, 2, 5, 5.0)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert ann.nearest(df.where("vec_id = 5"), F.col("vec_id") % 100 == 0).collect() == []


def test_chi_square():
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((200_000, 8)) ** 2).sum(axis=1)
    assert abs((x <= ann.stop_ratio(0.02)).mean() - 0.98) < 0.002


def plain_model(trusted, scored):
    """Interpolated modified Kneser-Ney over characters, by dictionaries."""
    order = kn_quality.ORDER
    pad = kn_quality.START * (order - 1)
    counts = Counter()
    for text in trusted:
        text = pad + text
        counts.update(text[i : i + order] for i in range(len(text) - order + 1))
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    discounts = {n: kn_quality.modified_discounts([float(sum(c == k for c in lv.values())) for k in (1, 2, 3, 4)]) for n, lv in levels.items()}
    totals = {n: Counter() for n in levels}
    taken = {n: defaultdict(float) for n in levels}
    for n, level in levels.items():
        for g, c in level.items():
            totals[n][g[:-1]] += c
            taken[n][g[:-1]] += discounts[n][min(c, 3) - 1]

    def p(gram):
        low = p(gram[1:]) if len(gram) > 1 else 1 / 65536
        n, h, c = len(gram), gram[:-1], levels[len(gram)][gram]
        if not totals[n][h]:
            return low
        own = (c - discounts[n][min(c, 3) - 1]) / totals[n][h] if c else 0
        return own + taken[n][h] / totals[n][h] * low

    out = []
    for text in scored:
        grams = [(pad + text)[i : i + order] for i in range(len(text))]
        out.append(math.exp(-sum(math.log(p(g)) for g in grams) / len(grams)) if grams else None)
    return out


def test_perplexity_as_by_a_plain_model(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices(["th", "er", "on", "é", "a"], k=rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rng.randint(3, 60))) for _ in range(60)]
    texts += ["QX!! ZZ## 19|" * 20, None, "", "a", "ab " * 3000, texts[0]]
    rows = [(i, t, ["en", "fr", None][i % 3], "x") for i, t in enumerate(texts)] + [(None, "a word", "en", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, block string")
    labels = [(i, int(i != 60), 0) for i in range(62)] + [(3, 0, 0), (4, None, 0), (None, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in kn_quality.score_quality(df, labels).collect()}
    spared = {r[0] for r in df.where(F.pmod(F.xxhash64(F.lit("spared"), "doc_id"), F.lit(kn_quality.SPARED)) == 0).select("doc_id").collect()}
    trusted = [texts[i] or "" for i in range(62) if i != 60 and i not in spared]
    for i, expected in enumerate(plain_model(trusted, [t or "" for t in texts])):
        value = got[i]["perplexity"]
        assert value is expected is None or math.isclose(value, expected, rel_tol=1e-4), i
    assert got[60]["kept"] is False and got[61]["kept"] and got[62]["kept"] and got[0]["kept"]
    assert len(got) == len(rows)
    kept = kn_quality.reject_low_quality(df, labels)
    assert kept.columns == df.columns and 60 not in {r["doc_id"] for r in kept.collect()}
    assert kept.count() == sum(r["kept"] or i is None for i, r in got.items())  # without a key a row stays


def test_one_odd_or_short_text_sets_no_threshold(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("aeinrst", k=rng.randint(2, 6))) for _ in range(80)]
    spared = spark.range(3000).where(F.pmod(F.xxhash64(F.lit("spared"), "id"), F.lit(kn_quality.SPARED)) == 0)
    spared = [r["id"] for r in spared.collect() if r["id"] >= 2000]
    texts = {i: (" ".join(rng.choices(words, k=40)), "en") for i in range(800)}
    odd, short = spared[0], spared[1:6]
    texts |= {odd: ("QX!! ZZ## 19|" * 20, "fr")} | {i: ("Q#.", "en") for i in short}
    texts[5000] = "WX?? YY$$ 28/" * 20, "fr"  # junk about as unlike the model as the odd text
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in texts.items()], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i != 5000), 0) for i in texts], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in kn_quality.score_quality(df, labels).collect()}
    least = min(got[i]["perplexity"] for i in [odd, *short])
    assert not got[5000]["kept"] and got[5000]["threshold"] < least and got[0]["threshold"] < least
    assert sum(got[i]["kept"] for i in range(800)) >= 0.95 * 800


def test_hot_and_null_keys_are_dealt_over_blocks(spark, monkeypatch):
    rng = random.Random(10)
    texts = [" ".join("".join(rng.choices("aeinrst", k=4)) for _ in range(30)) for _ in range(120)]
    spared = F.pmod(F.xxhash64(F.lit("spared"), "id"), F.lit(kn_quality.SPARED)) == 0
    hot = spark.range(100).where(~spared).first()["id"]
    rows = [(None if i % 2 else hot, t, "en") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    blocks = kn_quality.dealt(df, "doc_id", "text", "lang", 8).select("block").distinct().count()
    assert blocks == 8
    labels = spark.createDataFrame([(hot, 1, 0)], "doc_id long, quality int, toxic int")
    got = sorted(r["perplexity"] for r in kn_quality.score_quality(df, labels).collect())
    expected = sorted(plain_model([t for k, t, _ in rows if k is not None], texts))
    assert np.allclose(got, expected, rtol=1e-4)
    monkeypatch.setattr(kn_quality, "BLOCK_CHARS", 100)
    assert kn_quality.block_count(df, "text") == -(-sum(map(len, texts)) // 100)


def test_quality_without_rows_or_labels(spark):
    df = spark.createDataFrame([(1, "abc", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["kept"] for r in kn_quality.score_quality(df, labels).collect()] == [True]
    assert kn_quality.score_quality(df.limit(0), labels).collect() == []


BAD = ["vile", "rotten", "fool", "grässlich"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        text = rng.choices(words, k=rng.randint(5, 80))
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text), rng.choice(["en", "de", None]), "clash"))
        labels.append((i, 1, toxic))
    rows += [(None, "vile fool", "en", "clash"), (2000, None, "xx", "clash"), (2001, "", "en", "clash"), (2002, "word1 " * 9000 + "vile fool rotten", "en", "clash")]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, score string"),
        spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int"),
    )


def test_toxicity_on_held_out_rows(labelled):
    df, labels = labelled
    got = {r["doc_id"]: r for r in toxicity.classify(df, labels).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == truth[i] for i in held) / len(held) >= 0.95
    assert got[2001]["score"] == got[2000]["score"] and got[2001]["predicted"] == 0
    assert got[2002]["predicted"] == 1  # at the end of a long text
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())


def test_a_score_depends_on_the_text_alone():
    rng = np.random.default_rng(0)
    rows = [rng.integers(0, toxicity.EMPTY, 20).astype(np.int32) for _ in range(40)]
    net = toxicity.train(rows, (np.arange(40) % 2).astype(np.float32))
    texts = [b"one two three", b"", b"x " * 50000, b"one two three", b"four"]
    together = net.scores(texts)
    alone = np.array([net.scores([t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-6) and together[0] == together[3]


def test_rejecting_toxic_texts(labelled):
    df, labels = labelled
    kept = toxicity.reject_toxic(df, labels)
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in kept.collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] is not None}
    clean = [i for i in range(900) if not truth[i]]
    bad = [i for i in range(900) if truth[i]]
    assert sum(i in ids for i in clean) / len(clean) >= 0.97
    assert sum(i in ids for i in bad) / len(bad) <= 0.15
    assert {2000, 2001} <= ids and 2002 not in ids


def test_rejecting_toxic_texts_scores_each_row_once(labelled):
    kept = toxicity.reject_toxic(*labelled)
    # A second node is a second run of the network over all texts, and a second Python worker for each task.
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def sampled(monkeypatch, df, labels):
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda rows, y: seen.update(rows=rows, y=y))
    toxicity.learn(df, labels)
    return seen["rows"], seen["y"]


def test_long_texts_are_in_the_sample(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    lengths = {i: 5000 if k < 2 else 10 for k, i in enumerate(ids)}
    df = spark.createDataFrame([(i, "word " * n) for i, n in lengths.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    assert sorted(map(len, sampled(monkeypatch, df, labels)[0])) == sorted(lengths.values())
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 5100)
    rows = sampled(monkeypatch, df, labels)[0]
    assert 0 < sum(map(len, rows)) <= 5100 and len(rows) < len(ids)


def test_a_key_gives_one_text_to_the_sample(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"word {i}") for i in ids] + [(ids[0], f"another {k % 7}") for k in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    found, y = sampled(monkeypatch, spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert len(found) == len(y) == len(ids)


def test_few_clean_texts_set_no_threshold(spark):
    rows = [(i, "en", 0.1) for i in range(400)] + [(i, "xx", 0.999 if i == 400 else 0.1) for i in range(400, 420)]
    rows = [(f"k{i}", lang, s) for i, lang, s in rows]
    odd = next(i for i, r in enumerate(rows) if r[1] == "xx" and zlib.crc32(r[0].encode()) % 5)
    rows = [(k, lang, 0.999 if i == odd else 0.1) for i, (k, lang, _) in enumerate(rows)]
    scored = spark.createDataFrame(rows, "doc_id string, lang string, score double")
    labels = spark.createDataFrame([(r[0], 0) for r in rows], "doc_id string, toxic int")
    got = {r["lang"]: r["threshold"] for r in toxicity.thresholds(scored, labels).collect()}
    assert got.get("xx", got[None]) == 0.5


def test_toxicity_without_labels_or_rows(labelled):
    df, labels = labelled
    assert len({r["score"] for r in toxicity.classify(df, labels.limit(0)).collect()}) == 1
    assert toxicity.classify(df.limit(0), labels).collect() == []
    assert toxicity.reject_toxic(df, labels.limit(0)).count() == df.count()


def test_scores_of_a_network_by_plain_loops():
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(50)]
    texts = ["", " . ", "w1", "w1 w2", *[" ".join(rng.choice(words, n)) for n in (3, 9, 40, 700, 21_000)], "W3, w4;w5"]
    rows, offsets = toxicity.buckets([t.encode() for t in texts])
    parts = [rows[a:b] for a, b in zip(offsets, offsets[1:])]
    net = toxicity.train(parts, np.array([0, 1] * (len(texts) // 2), np.float32))
    expected = []
    for part in parts:
        # As many empty words follow a text as the widest filter has besides the first; an empty text is one empty word.
        padded = list(part) + [toxicity.EMPTY] * (toxicity.GAP + (not len(part)))
        top = []
        for f, b in zip(net.filters, net.biases):
            starts = range(max(len(part), 1))
            values = [sum(net.embedding[padded[i + k]].astype(float) @ f[k] for k in range(len(f))) + b for i in starts]
            top.append(np.max(values, axis=0))
        z = np.maximum(np.concatenate(top), 0) @ net.weights + net.bias[0]
        expected.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    assert np.allclose(net.scores([t.encode() for t in texts], step=64), expected, atol=1e-4)
    assert np.allclose(net.scores([t.encode() for t in texts]), expected, atol=1e-4)
