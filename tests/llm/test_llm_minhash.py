"""Near-duplicates, components and word hashes against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from acervo.llm import components, minhash, words


def plain_sets(texts, width):
    out = []
    for text in texts:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def plain_components(ids, texts, width, percent):
    sets = plain_sets(texts, width)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(ids)):
        for y in range(x):
            shared = len(sets[x] & sets[y])
            if shared and 100 * shared >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(ids[x]), root(ids[y])))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in zip(ids, sets)}


def made_texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([30, 80, 200]))
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [texts[0]] * 20 + [texts[3].upper()] * 5
    # A large group of near copies, of which not all pairs are linked.
    base = rng.choices(vocabulary, k=120)
    for _ in range(80):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [None, "", " \t\n", "one", "ONE", "one two", "one two", "x y z", "É a b c", "é a b c", "w " * 5000]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_groups_as_by_brute_force(spark, width, percent):
    texts = made_texts()
    ids = [7 * i + 3 for i in range(len(texts))]
    df = spark.createDataFrame([(t, i, "x", 1) for i, t in zip(ids, texts)], "text string, doc_id long, component_id string, n long")
    got = {r[0]: (r[1], r[2], r[3]) for r in minhash.near_duplicates(df, width=width, percent=percent).collect()}
    expected = {i: (n, c, c == i) for i, (n, c) in plain_components(ids, texts, width, percent).items()}
    assert got == expected


@pytest.mark.parametrize("percent", [80, 85])
def test_differences_join_up_what_is_linked(spark, percent):
    """Two buckets that share members: a family of edited sets whose edits often agree, and one without a common core."""
    rng = random.Random(percent)
    base, family = list(range(60)), []
    for _ in range(70):
        gone = rng.sample(range(24), rng.choice([0, 3, 7, 11]))
        family.append((set(base) - set(gone)) | set(rng.sample(range(100, 130), rng.choice([0, 2, 6, 10]))))
    family = [set(x) for x in {frozenset(x) for x in family}]
    family += [{1000 * k + i for i in range(40)} - {1000 * k + rng.randrange(40)} for k in range(1, 5) for _ in range(3)]
    sets = spark.createDataFrame([(i, sorted(x)) for i, x in enumerate(family)], "id long, items array<long>")
    half = len(family) // 2
    rows = [(1, i, i) for i in range(half + 9)] + [(2, i, i) for i in range(half, len(family))]
    members = spark.createDataFrame(rows, "key long, id long, label long")
    found = minhash._by_differences(members, sets, percent).where("linked").collect()
    similar = lambda a, b: 100 * len(family[a] & family[b]) >= percent * len(family[a] | family[b])

    def labels(links):
        root = list(range(len(family)))
        for a, b in links:
            x, y = sorted((root[a], root[b]))
            root = [x if r == y else r for r in root]
        return root

    expected = [(a, b) for b in range(len(family)) for a in range(b) if similar(a, b)]
    assert labels([(r["label_a"], r["label_b"]) for r in found]) == labels(expected)
    assert all(similar(r["label_a"], r["label_b"]) for r in found)
    assert 5 < len(set(labels(expected))) < len(family) - 5


def test_edge_cases(spark):
    schema = "doc_id long, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f"), (2, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got)) == [(2, 0, 2, True), (5, 2, 5, True), (5, 2, 5, True), (9, 2, 5, False)]


def test_a_key_with_two_texts(spark):
    rng = random.Random(11)
    text = lambda: rng.choices([f"w{i}" for i in range(400)], k=120)
    a, b, c, d, e = (text() for _ in range(5))
    near = lambda words: [*words[:60], "x", *words[61:]]
    rows = [(2, a), (2, b), (1, near(a)), (7, c), (7, c), (9, c), (9, d), (11, d), (12, near(d)), (20, e), (20, near(near(e)[::-1]))]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()}
    expected = {2: 1, 1: 1, 7: 7, 9: 7, 11: 7, 12: 7, 20: 20}
    assert got == {(i, c, i == c) for i, c in expected.items()}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["label"] for r in components.components(df).collect()}
    expected = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {301: 300}
    assert got == expected


def test_both_ends_are_unbiased():
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(60):
        items = words.mix(rng.integers(0, 2**63, 300).astype(np.uint64))
        a, b = minhash.min_max(items[:250]), minhash.min_max(items[50:])
        errors.append((a == b).mean() - 200 / 300)
    assert abs(np.mean(errors)) < 0.02
    assert minhash.band_rows(0.85) == 5 and minhash.band_rows(0.8) == 4


def test_word_hashes():
    texts = [b"The cat, the CAT", b"", b"  ", b"cat\tthe", "é e".encode(), b"x" * 70000 + b" cat"]
    hashes, at = words.hash_words(texts)
    per = [hashes[a:b].tolist() for a, b in zip(at, at[1:])]
    assert [len(p) for p in per] == [4, 0, 0, 2, 2, 2]
    the, cat_comma, the2, cat = per[0]
    assert the == the2 == per[3][1] and cat == per[3][0] == per[5][1] and cat_comma != cat and per[4][0] != per[4][1]
    many = [f"word{i}".encode() for i in range(50000)]
    assert len(set(words.hash_words(many)[0].tolist())) == 50000
