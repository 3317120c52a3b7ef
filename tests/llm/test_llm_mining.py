"""Benchmark passages, integer centroids and collocations against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from acervo.llm import bitmaps, centroids, collocations, decontaminate

LETTERS = {c: c + 32 for c in range(65, 91)}


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LETTERS))


def plain_contamination(texts, items, span=10):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        own = min(span, len(words))
        for i in range(len(words) - own + 1) if own else ():
            windows[tuple(words[i : i + own])].add(item)
    out = []
    for text in texts:
        words, hit, found = plain_words(text), set(), set()
        for own in {len(w) for w in windows}:
            for i in range(len(words) - own + 1):
                if tuple(words[i : i + own]) in windows:
                    hit |= set(range(i, i + own))
                    found |= windows[tuple(words[i : i + own])]
        out.append((len(words), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def test_winnowing_keeps_every_shared_span():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 6, 500, dtype=np.uint64)  # few values: many ties
    offsets = np.array([0, 0, 180, 189, 199, 500])
    for span in (1, 3, 5, 7, 10):
        windows, at, prints = decontaminate.winnow(hashes, offsets, span)
        whole = [i for a, b in zip(offsets, offsets[1:]) for i in range(a, b - span + 1)]
        assert windows.tolist() == whole
        assert all(w <= a <= w + span - min(5, span) for w, a in zip(windows, at))
        said = defaultdict(set)
        for w, p in zip(windows, prints):
            said[tuple(hashes[w : w + span])].add(int(p))
        assert all(len(s) == 1 for s in said.values())


def test_contamination(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Größe", "naïve", "中文", "x1"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([11, 25, 60]))) for i in range(12)]
    common = items[0][1]
    items += [(20, say(4)), (21, say(7)), (22, "w1"), (23, None), (24, " ,;"), (None, say(30)), (26, common), (9, say(12)), (9, say(12))]
    texts = [None, "", "...", say(3), say(400), say(9000)]
    for _, t in items:
        words = (t or "").split()
        texts += [say(5) + " " + (t or "").upper() + "! " + say(5), " - ".join(words[2:13]) + say(3), " ".join(words[:9]) + "-" + " ".join(words[11:])]
    texts += [say(3) + " " + common] * 5 + [common + " " + say(2) + " " + common]
    rows = [(i, t, "a", 1) for i, t in enumerate(texts)]
    rows += [rows[-1], rows[-1], (None, common, "a", 1), (None, "nothing", "a", 1), (3, common, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, span string, hits int").repartition(3)
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, n_words int").repartition(2)
    found = decontaminate.contaminated_words(df, benchmark)
    got = found.select("doc_id", "n_words", decontaminate.words_hit("spans"), "items").collect()
    expected = [(r[0], *e) for r, e in zip(rows, plain_contamination([r[1] for r in rows], items))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert sum(e[2] > 0 for e in expected) > 30
    none = decontaminate.contaminated_words(df, benchmark.limit(0)).collect()
    assert len(none) == len(rows) and all(r["spans"] is None and r["items"] == [] for r in none)
    assert decontaminate.contaminated_words(df.limit(0), benchmark).collect() == []


def test_bitmap(spark):
    values = np.random.default_rng(2).integers(0, 2**63, 3000) * 2 - 2**62
    found, bits = bitmaps.bitmap(spark.createDataFrame([(int(v),) for v in values], "h long"), "h")
    assert bits == 20 and bitmaps.in_bitmap(found.value, bits, values.view(np.uint64)).all()
    other = np.random.default_rng(3).integers(0, 2**63, 10_000).view(np.uint64)
    assert bitmaps.in_bitmap(found.value, bits, other).mean() < 0.008
    found, bits = bitmaps.bitmap(spark.createDataFrame([], "h long"), "h")
    assert not bitmaps.in_bitmap(found.value, bits, other).any()


def plain_clusters(rows, k, rounds, dimensions, scale=256):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: ((r[0] is None), hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [v for _, v in sorted(good, key=key)[:k]]
    for n in range(rounds + 1):
        own = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)) for _, v in good]
        if n < rounds:
            for j in range(len(centres)):
                mine = [v for (_, v), (_, c) in zip(good, own) if c == j]
                if mine:
                    centres[j] = [sum(col) // len(mine) for col in zip(*mine)]
    total = Counter()
    for d, c in own if good else ():
        total[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((str(i), c, d, total[c], sum(total.values()), sha[c]) for (i, _), (d, c) in zip(good, own if good else ()))


def test_centroids(spark):
    rng = np.random.default_rng(6)
    middles = rng.standard_normal((9, 8))
    rows = [(i, (middles[i % 9] + 0.3 * rng.standard_normal(8)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)] + [rows[5], rows[5], (None, rows[7][1]), (None, [0.0] * 8)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [None] + [1.0] * 7), (2004, [math.nan] * 8), (2005, [math.inf] + [0.0] * 7), (2006, [1.0] * 9)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, distance string").repartition(4)
    for pivots in (1, 4, 9):
        got = centroids.cluster(df, k=20, rounds=4, dimensions=8, pivots=pivots).collect()
        assert sorted((str(r[0]), *r[1:6]) for r in got) == plain_clusters(rows, 20, 4, 8)
    few = df.where("vec_id in (1, 2, 2003)")
    assert [r["distance"] for r in centroids.cluster(few, k=20, rounds=2, dimensions=8).collect()] == [0, 0]
    same = centroids.cluster(df.where("vec_id >= 1000 and vec_id < 2000"), k=3, rounds=2, dimensions=8).collect()
    assert {(r["cluster"], r["distance"]) for r in same} == {(0, 0)} and len(same) == 150
    assert centroids.cluster(df.where("vec_id = 2001"), dimensions=8).collect() == []
    with pytest.raises(Exception, match="would not fit 64 bits"):
        centroids.cluster(spark.createDataFrame([(1, [1e8] * 8)], "vec_id long, embedding array<double>"), dimensions=8).collect()


def test_simplex_bounds():
    rng = np.random.default_rng(7)
    points = rng.integers(-500, 500, (60, 12)) * (rng.random(12) > 0.4)
    points[10:20] = points[0]
    far = np.concatenate((points, points * 200_000))
    for most in (1, 2, 5, 40):
        simplex = centroids.Simplex(points, most)
        one, other = simplex.apexes(far.astype(float)).astype(np.float32).astype(float), simplex.apexes(points.astype(float))
        low, high = centroids.bounds(one, other)
        real = np.sqrt(((far[:, None] - points[None]).astype(float) ** 2).sum(axis=2))
        assert (low <= real).all() and (real <= high).all()


def plain_collocations(rows, longest=5, least=100, top=2000, covered=100):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LETTERS)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        scored = []
        for p, a in found.items():
            if inside[p] and 100 * inside[p] >= covered * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(8)
    vocabulary = ["a", "B", "the", "of", "a\x01", "\x00", "Größe", "x-y", "中", "ÀÉ"]
    odds = [9, 5, 8, 6, 2, 1, 2, 2, 1, 2]

    def say(n):
        return "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r;"]) for w in rng.choices(vocabulary, odds, k=n))

    rows = [(say(rng.choice([0, 3, 40])), rng.choice(["en", "de", None, "und", "e.n"])) for _ in range(300)]
    rows += [("once upon a time there was; the end", "en")] * 60 + [("the " * 5000, "de"), (None, "en"), ("", None), (" .,; ", "fr"), ("One two", "es")]
    rows += [("one two three", "es")] * 20
    return rows


@pytest.mark.parametrize("range_rows", [400_000, 40])
def test_collocations(spark, monkeypatch, range_rows):
    monkeypatch.setattr(collocations, "RANGE_ROWS", range_rows)  # many ranges: most prefixes lie on their ends
    rows = phrase_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, phrase int, n int").repartition(5)
    for least, top, covered in ((20, 2000, 100), (5, 7, 90)):
        got = sorted(map(tuple, collocations.collocations(df, least=least, top=top, covered=covered).collect()))
        assert got == plain_collocations(rows, 5, least, top, covered)
        assert len(got) > 10
    assert sorted(map(tuple, collocations.collocations(df, longest=3, least=20).collect())) == plain_collocations(rows, 3, 20)
    assert collocations.collocations(df.limit(0)).collect() == []
    assert collocations.collocations(df.where("lang = 'fr'")).collect() == []


def test_exact_scores(spark):
    """Counts whose products pass 64 bits."""
    a, n, l, r = 4_000_000_007, 9_000_000_000_009, 5_000_000_011, 4_100_000_003
    score = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").select(F.expr(collocations.SCORE)).first()[0]
    assert score == 1000 * a * n // (l * r)


def test_multikey_quicksort():
    rng = np.random.default_rng(9)
    keys = np.minimum(rng.zipf(1.4, (4, 3000)), 50).astype(np.int64)
    ends = rng.integers(1, 5, 3000)
    keys[np.arange(4)[:, None] >= ends[None]] = 0
    weights = rng.integers(1, 4, 3000)
    plain = Counter()
    for column, weight in zip(keys.T.tolist(), weights.tolist()):
        for m in range(1, 5):
            if column[m - 1]:
                plain[tuple(column[:m])] += weight
    got = {tuple(keys[:level, row].tolist()): n for rows, counts, level in collocations.multikey_quicksort(keys, weights, 30) for row, n in zip(rows, counts)}
    assert got == {p: n for p, n in plain.items() if n >= 30}
    assert list(collocations.multikey_quicksort(keys[:, :0], weights[:0], 1)) == []


def test_blocks_agree_with_one_block(monkeypatch):
    import pyarrow as pa

    rows = phrase_rows()
    batch = pa.record_batch([pa.array([r[1] or "und" for r in rows]), pa.array([r[0] for r in rows])], ["lang", "text"])
    small = [batch.slice(i, 7) for i in range(0, len(rows), 7)]
    whole, added = list(collocations._blocks(iter([batch]), {})), list(collocations._blocks(iter(small), {}))
    monkeypatch.setattr(collocations, "BLOCK", 500)
    parts = [b.joined() for b in collocations._blocks(iter(small), {})]
    assert len(whole) == len(added) == 1 and len(parts) > 10
    for one, same, others in zip(whole[0].joined(), added[0].joined(), zip(*parts)):
        assert one.tolist() == same.tolist() == np.concatenate(others).tolist()
    numbers = np.arange(0, len(whole[0].joined()[0]), 3)
    assert added[0].words(numbers).equals(whole[0].words(numbers))
