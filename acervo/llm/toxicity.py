"""Toxicity by a convolutional text classifier, trained in numpy.

Words are hashed into rows of an embedding table. Filters over one, two and three words slide along the
whole text; the largest value of each goes into a logistic layer. The embeddings, filters and weights
are trained on a bounded sample of labelled rows; scoring is one pass over the whole texts without a
shuffle. Which score counts as toxic is calibrated by language, over all labelled rows but those held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.llm import words as W
from acervo.llm.common import at_work, cut, release, tidy

BUCKET_BITS = 18
WIDTHS = (1, 2, 3)
SIZE, FILTERS, BATCH, RATE = 8, 12, 32, 0.1
#: The sample is gone through so often, at least, and on until so many batches have been learned from.
EPOCHS, UPDATES = 5, 2000
#: Labelled texts that the network is trained on, at most, and their words all together.
SAMPLE_ROWS, SAMPLE_WORDS = 16_000, 8 << 20
#: A language's threshold may reject at most this share of its labelled clean texts; with fewer of them
#: than ``OWN`` it takes the threshold of all languages.
CLEAN_LOSS, OWN = 0.005, 200
GAP = max(WIDTHS) - 1  # empty words between texts, so that no filter sees two
EMPTY = 1 << BUCKET_BITS


def held_out(key: Column) -> Column:
    """A fifth of all rows, by their key: never learned from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0, F.lit(False))


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all words, and offsets per text. A word is a run of letters and digits, in lower case."""
    hashes, offsets = W.hash_words(texts, gap=W.NO_LETTER)
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), offsets


def spaced(rows: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with ``GAP`` empty ones after each text, and one more for an empty text; starts of the texts."""
    lengths = np.diff(offsets)
    room = np.maximum(lengths, 1) + GAP
    starts = np.concatenate(([0], np.cumsum(room)))
    out = np.full(starts[-1], EMPTY, np.int32)
    out[np.arange(len(rows)) + np.repeat(starts[:-1] - offsets[:-1], lengths)] = rows
    return out, starts


@dataclass
class Network:
    embedding: np.ndarray  # (buckets + 1, SIZE); the last row, of the empty word, is zero
    filters: list  # per width: (width, SIZE, FILTERS)
    biases: list  # per width: (FILTERS,)
    weights: np.ndarray  # (len(WIDTHS) * FILTERS,)
    bias: np.ndarray  # (1,)

    def features(self, words: np.ndarray) -> list[np.ndarray]:
        """For each width the value of each filter from each word on; ``words`` ends with ``GAP`` empty ones."""
        x = self.embedding[words]
        n = len(words) - GAP
        return [sum(x[k : k + n] @ f[k] for k in range(len(f))) + b for f, b in zip(self.filters, self.biases)]

    def scores(self, texts: list[bytes], step: int = 1 << 14) -> np.ndarray:
        words, starts = spaced(*buckets(texts))
        top = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        # Piece by piece; a text that goes over several keeps the largest values so far.
        for at in range(0, len(words), step):
            piece = words[at : at + step + GAP]
            if at + step + GAP > len(words):
                piece = np.concatenate((piece, np.full(GAP, EMPTY, np.int32)))
            values = np.concatenate(self.features(piece), axis=1)
            first = np.searchsorted(starts, at, "right") - 1
            last = np.searchsorted(starts, at + len(values), "left")
            # Windows that begin between texts see the next text's first words in part: they are left out.
            begins = np.maximum(starts[first:last], at) - at
            ends = np.minimum(starts[first + 1 : last + 1] - GAP, at + len(values)) - at
            for text, b, e in zip(range(first, last), begins, ends):
                if e > b:
                    np.maximum(top[text], values[b:e].max(axis=0), out=top[text])
        # Row by row: a product of matrices may round a row by its place among the others.
        z = (np.maximum(top, 0) * self.weights).sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Network:
    """Train on texts given as embedding rows. Fixed seed and order: the same sample gives the same network.

    The first embedding column starts as how much more often a word occurs in toxic texts, in standard
    errors; the rest starts at random. Without a label of each kind the network scores the rate.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    normal = lambda *shape, scale=0.1: (rng.standard_normal(shape) * scale).astype(np.float32)
    rate = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    net = Network(
        normal(EMPTY + 1, SIZE),
        [normal(w, SIZE, FILTERS, scale=0.3) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        normal(len(WIDTHS) * FILTERS),
        np.array([np.log(rate / (1 - rate))], np.float32),
    )
    net.embedding[EMPTY] = 0
    if not len(labels) or labels.min() == labels.max():
        net.weights[:] = 0
        return net
    seen = np.full((2, EMPTY + 1), 0.5)
    for words, label in zip(rows, labels):
        seen[int(label), np.unique(words)] += 1
    totals = np.bincount(labels.astype(int), minlength=2)
    odds = np.log(seen[1] / totals[1]) - np.log(seen[0] / totals[0])
    net.embedding[:EMPTY, 0] = np.clip(odds / np.sqrt(1 / seen[0] + 1 / seen[1]), -4, 4)[:EMPTY] / 4
    net.filters[0][0, 0] = np.abs(net.filters[0][0, 0]) + 0.5
    params = [net.embedding, *net.filters, *net.biases, net.weights, net.bias]
    sums = [np.full(p.shape, 1e-2, np.float32) for p in params]

    def step(i: int, grad: np.ndarray, at=slice(None)) -> None:
        sums[i][at] += grad * grad
        params[i][at] -= RATE * grad / np.sqrt(sums[i][at])

    for _ in range(max(EPOCHS, -(-UPDATES * BATCH // len(rows)))):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            offsets = np.concatenate(([0], np.cumsum([len(rows[i]) for i in chosen])))
            words, starts = spaced(np.concatenate([rows[i] for i in chosen]), offsets)
            values = net.features(words)
            ends = starts[1:] - GAP
            places = [
                np.stack([b + v[b:e].argmax(axis=0) for b, e in zip(starts[:-1], ends)]) for v in values
            ]  # per width: (texts, FILTERS)
            tops = np.concatenate([np.take_along_axis(v, p, axis=0) for v, p in zip(values, places)], axis=1)
            hidden = np.maximum(tops, 0)
            z = np.clip(hidden @ net.weights + net.bias, -30, 30)
            error = ((1 / (1 + np.exp(-z)) - labels[chosen]) / len(chosen)).astype(np.float32)
            back = error[:, None] * net.weights * (tops > 0)
            step(len(params) - 2, hidden.T @ error)
            step(len(params) - 1, error.sum(keepdims=True))
            touched, grads = [], []
            for i, (width, place) in enumerate(zip(WIDTHS, places)):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                filter_grad = np.empty_like(net.filters[i])
                for k in range(width):
                    at = words[place + k]  # (texts, FILTERS)
                    filter_grad[k] = np.einsum("tfs,tf->sf", net.embedding[at], g)
                    touched.append(at.ravel())
                    grads.append((g[:, :, None] * net.filters[i][k].T[None]).reshape(-1, SIZE))
                step(1 + i, filter_grad)
                step(1 + len(WIDTHS) + i, g.sum(axis=0))
            which, where = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(which), SIZE), np.float32)
            np.add.at(total, where, np.concatenate(grads))
            real = which != EMPTY
            step(0, total[real], which[real])
    return net


def learn(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Network:
    """A network from at most ``SAMPLE_ROWS`` labelled keys that are not held out, chosen by a hash of the key.

    Whole texts of all lengths are in the sample, as many in the hash's order as have ``SAMPLE_WORDS`` words
    together; a text with more than all of these is left out. A key gives one text, that of the smallest
    hash. Null labels and keys are ignored; a key with several labels counts as toxic if one is.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("id")).agg((F.max(label) > 0).cast("int").alias("y"))
    # At most SAMPLE_ROWS narrow rows, whatever the table's size.
    sample = cut(known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS))

    @tidy
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("toxicity")
        for batch in batches:
            found = []
            for texts in W.pieces(batch.column(2)):
                rows, offsets = buckets(texts)
                found += [rows[a:b].tobytes() if b - a <= most else None for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(3), pa.array(found, pa.binary())], ["id", "y", "h", "words"])

    most = SAMPLE_WORDS
    chosen = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    chosen = chosen.join(F.broadcast(sample), "id").select("id", "y", "text", F.xxhash64("text").alias("h"))
    # One text per key before any of them are collected, by a partial aggregate.
    one = chosen.mapInArrow(hashed, "id long, y int, h long, words binary").where("words is not null")
    one = cut(one.groupBy("id").agg(F.min(F.struct("h", "y", "words")).alias("m")).select("id", "m.y", "m.words"))
    sizes = one.select("id", F.xxhash64("id").alias("h"), (F.octet_length("words") / 4).cast("long").alias("n")).toPandas()
    sizes = sizes.sort_values(["h", "id"])
    within = (sizes["n"].cumsum() <= most).to_numpy()
    if not within.all():
        h, i = (F.lit(sizes[c].tolist()[int(within.argmin())]) for c in ("h", "id"))
        own = F.xxhash64("id")
        one = one.where((own < h) | ((own == h) & (F.col("id") < i)))
    taken = one.toPandas().sort_values("id")
    rows = [np.frombuffer(w, np.int32) for w in taken["words"]]
    return train(rows, taken["y"].to_numpy(np.float32))


def score(net: Network, text: Column) -> Column:
    """The network's score, 0 to 1, of every whole text; null is scored as the empty text."""

    @F.arrow_udf("double")
    @tidy
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at_work("toxicity")
        for batch in batches:
            found = [net.scores(texts) for texts in W.pieces(batch)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return scored(text.cast("string"))


def thresholds(scored: DataFrame, labels: DataFrame, key: str = "doc_id", lang: str = "lang", label: str = "toxic") -> DataFrame:
    """``lang`` and ``threshold``: the lowest score, 0.5 at least, above all but ``CLEAN_LOSS`` of its clean texts.

    Over all labelled rows that are not held out. The row with a null ``lang`` is for all languages
    together and serves those with fewer than ``OWN`` labelled clean texts; with fewer in all
    it is 0.5.
    """
    clean = labels.where((F.col(label) == 0) & ~held_out(F.col(key))).select(F.col(key).alias("id")).distinct()
    known = scored.select(F.col(key).alias("id"), F.col(lang).alias("lang"), "score").join(clean, "id")
    high = F.percentile_approx("score", F.lit(1 - CLEAN_LOSS), F.lit(10_000))
    found = known.where(F.col("lang").isNotNull()).groupBy("lang").agg(high.alias("high"), F.count("*").alias("n"))
    found = found.where(F.col("n") >= OWN).drop("n")
    found = found.unionByName(known.agg(F.when(F.count("*") >= OWN, high).alias("high")).select(F.lit(None).cast("string").alias("lang"), "high"))
    return found.select("lang", F.greatest(F.lit(0.5), F.coalesce("high", F.lit(0.5))).alias("threshold"))


def classify(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``score`` and ``predicted``, 1 from a score of 0.5; columns of these names are replaced.

    Null and empty texts get the score of a text without words. Labels, language and key are no
    inputs of a score. Repeated rows get equal scores. Without labels all scores are alike. An empty
    table stays empty.
    """
    net = learn(df, labels, key, text)
    return df.withColumn("score", score(net, F.col(f"`{text}`"))).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def reject_toxic(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``df`` without the texts that score above their language's threshold; rows and columns else as they are."""
    columns = [F.col(f"d.`{c}`") for c in df.columns]
    net = learn(df, labels, key, text)
    # Stored, because the thresholds read the scores twice.
    narrow = cut(df.select(F.col(f"`{key}`"), F.col(f"`{lang}`"), score(net, F.col(f"`{text}`")).alias("score")))
    limits = cut(thresholds(narrow, labels, key, lang))
    release(narrow)
    overall = limits.where("lang is null").select(F.col("threshold").alias("overall"))
    # Never null, and Spark has to know it: a filter against nulls would score each row a second time, in a second worker.
    own = F.coalesce(score(net, F.col(f"`{text}`")), F.lit(0.0))
    marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("d"), own.alias("score"))
    fitting = limits.where("lang is not null").withColumnRenamed("lang", "of_lang")
    default = overall.first()["overall"]
    joined = marked.join(F.broadcast(fitting), F.col(f"d.`{lang}`") == F.col("of_lang"), "left")
    return joined.where(F.col("score") <= F.coalesce("threshold", F.lit(default))).select(*columns)
