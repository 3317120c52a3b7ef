"""Quality by an interpolated modified Kneser-Ney model of character 4-grams, trained on trusted text.

How the counts reach the texts, and back:

* Texts are dealt into blocks by their key and text, compressed, once. The exchange serves counting and scoring.
* A block gives each of its distinct 4-grams once, with how often trusted texts in it have it.
* Counts, continuation counts and history totals are aggregates and joins by n-gram or history: rows
  are distinct n-grams, never positions of a text. Each distinct 4-gram gets one log probability.
* Those go back to the blocks that asked, and a block scores its texts with array operations.

A text's perplexity is compared with a quantile of the trusted texts of its language.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import at_work, cut, give_back, partitions, tidy

ORDER = 4
#: Three of these stand before each text: a control character, one UTF-16 unit.
START = "\x02"
#: Quantile of perplexity among the trusted texts of a language that the model was not trained on; a text
#: above it is not kept.
QUANTILE = 0.99
#: Texts of fewer n-grams say nothing about a language's threshold; a language with fewer texts than
#: ``OWN`` takes the threshold of all languages.
SHORT, OWN = 20, 100
#: One in so many trusted texts, by key, is not trained on.
SPARED = 5
#: Texts of a task are compressed together, per block, whenever they reach so many characters.
BUFFER_CHARS = 12 << 20
STEP = 1 << 19
#: Characters of a block, on average, at most.
BLOCK_CHARS = 32 << 20


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All 4-grams of the texts as numbers, 16 bits a UTF-16 unit, and the offsets of the texts.

    Each text gives as many as it has units: the first stand behind the start marks.
    """
    units = [np.frombuffer(t.encode("utf-16-le", "surrogatepass"), "<u2") for t in texts]
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    pad = np.full(ORDER - 1, ord(START), np.uint16)
    joined = np.concatenate([x for u in units for x in (pad, u)]).astype(np.uint64) if units else np.zeros(0, np.uint64)
    if not lengths.sum():
        return np.zeros(0, np.int64), np.concatenate(([0], np.cumsum(lengths)))
    keys = joined[: -3 or None] << np.uint64(48)
    keys |= joined[1:-2] << np.uint64(32)
    keys |= joined[2:-1] << np.uint64(16)
    keys |= joined[3:]
    # A window that ends in a text's own unit belongs to it.
    ends = np.arange(len(keys)) + ORDER - 1
    starts = np.concatenate(([0], np.cumsum(lengths + ORDER - 1)))[:-1]
    within = ends - np.repeat(starts, lengths + ORDER - 1)[ORDER - 1 :]
    return keys[within >= ORDER - 1].view(np.int64), np.concatenate(([0], np.cumsum(lengths)))


def _steps(texts: list[str], size: int = STEP) -> Iterator[tuple[int, int]]:
    start, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def block_count(df: DataFrame, text: str) -> int:
    """Enough blocks for the session's partitions and for the measured characters."""
    chars = df.agg(F.sum(F.length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    return max(2 * partitions(df.sparkSession), -(-chars // BLOCK_CHARS))


def block_of(key: str, text: str, blocks: int) -> Column:
    """By key and text, so that neither null keys nor a key with many texts make a large block."""
    hashed = F.xxhash64(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return F.pmod(hashed, F.lit(blocks)).cast("int").alias("block")


def dealt(df: DataFrame, key: str, text: str, lang: str, blocks: int) -> DataFrame:
    """The texts, compressed, as rows (block, chunk); a chunk holds keys, languages and texts of one block."""
    source = df.select(
        block_of(key, text, blocks),
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )

    @tidy
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        at_work("quality")
        packer = zstandard.ZstdCompressor(level=3)
        held, chars = {}, 0

        def flush():
            rows = [(b, packer.compress(pickle.dumps(tuple(zip(*rows))))) for b, rows in sorted(held.items())]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "chunk"]
            )

        for batch in batches:
            for block, *row in zip(*(c.to_pylist() for c in batch.columns)):
                row[2] = row[2] or ""
                held.setdefault(block, []).append(row)
                chars += len(row[2])
                if chars > BUFFER_CHARS:
                    yield flush()
                    held, chars = {}, 0
        if held:
            yield flush()

    return source.mapInArrow(chunks, "block int, chunk binary")


def _chunks(pdf: pd.DataFrame) -> Iterator[tuple[list, list, list]]:
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    for chunk in pdf["chunk"]:
        yield pickle.loads(unpacker.decompress(chunk))


def block_grams(texts: DataFrame, trusted: DataFrame) -> DataFrame:
    """block, gram, n: the distinct 4-grams of each block, and their number in trusted texts.

    ``texts`` from ``dealt``; ``trusted``: block, id.
    """

    def count(docs: pd.DataFrame, good: pd.DataFrame) -> pd.DataFrame:
        at_work("quality")
        try:
            return counted(docs, good)
        finally:
            give_back()

    def counted(docs: pd.DataFrame, good: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"block": [], "gram": [], "n": []}).astype({"block": "int32", "gram": "int64", "n": "int64"})
        ids, parts = np.unique(good["id"].to_numpy(np.int64)), []
        for keys, _, texts in _chunks(docs):
            # Null keys have no label.
            trust = np.array([k is not None and k in good_ids for k in keys]) if (good_ids := set(ids.tolist())) else np.zeros(len(keys), bool)
            for start, end in _steps(texts):
                found, at = grams(list(texts[start:end]))
                codes, names = pd.factorize(found)
                weights = np.repeat(trust[start:end], np.diff(at))
                parts.append(pd.Series(np.bincount(codes, weights, len(names)).astype(np.int64), names))
            if len(parts) > 16:
                parts = [pd.concat(parts).groupby(level=0).sum()]
        total = pd.concat(parts).groupby(level=0).sum()
        return pd.DataFrame({"block": np.int32(docs["block"].iloc[0]), "gram": total.index.to_numpy(np.int64), "n": total.to_numpy()})

    return texts.groupBy("block").cogroup(trusted.groupBy("block")).applyInPandas(count, "block int, gram long, n long")


def _suffix(gram: Column, n: int) -> Column:
    """The last n characters of a gram; all of it for ``ORDER``."""
    return gram if n == ORDER else gram.bitwiseAND(F.lit((1 << 16 * n) - 1))


def _history(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 16)


def log_probabilities(counted: DataFrame) -> DataFrame:
    """gram, logp: each distinct 4-gram of ``counted`` (block, gram, n) under the model of the trusted counts.

    Order 4 has counts, lower orders continuation counts: how many characters come before. A count
    k is discounted by D(min(k, 3)), estimated from the counts of counts of the order.
    """
    totals = cut(counted.groupBy("gram").agg(F.sum("n").alias("n")))
    asked = totals.select("gram")
    level = totals.where("n > 0").select(F.col("gram").alias("g"), F.col("n").alias("c"))
    for n in range(ORDER, 0, -1):
        # Four numbers: the counts of counts of an order.
        ones = [F.sum((F.col("c") == k).cast("double")) for k in (1, 2, 3, 4)]
        discounts = modified_discounts([x or 0.0 for x in level.agg(*ones).first()])
        taken = F.get(F.array(*[F.lit(d) for d in discounts]), F.least("c", F.lit(3)).cast("int") - 1)
        named = level.select("g", "c", taken.alias("taken"))
        history = named.groupBy(_history(F.col("g")).alias("h")).agg(
            F.sum("c").cast("double").alias(f"total{n}"), F.sum("taken").alias(f"taken{n}")
        )
        own = named.select("g", (F.col("c") - F.col("taken")).alias(f"kept{n}"))
        gram = _suffix(F.col("gram"), n)
        asked = asked.withColumn("g", gram).join(own, "g", "left").drop("g")
        asked = asked.withColumn("h", _history(gram)).join(history, "h", "left").drop("h")
        if n > 1:
            level = cut(level.groupBy(_suffix(F.col("g"), n - 1).alias("g")).agg(F.count("*").alias("c")))
    # Every UTF-16 unit is as likely below order 1; without the history all is left to the lower order.
    p = F.lit(1 / 65536)
    for n in range(1, ORDER + 1):
        total = F.col(f"total{n}")
        p = F.coalesce(F.col(f"kept{n}") / total, F.lit(0.0)) + F.coalesce(F.col(f"taken{n}") / total, F.lit(1.0)) * p
    return cut(asked.select("gram", F.log(p).cast("float").alias("logp")))


def modified_discounts(seen: list[float]) -> list[float]:
    """What is taken off counts of 1, 2 and 3 or more, from how many n-grams have counts 1 to 4.

    Where too few are known to say, half the count; always less than the count.
    """
    y = seen[0] / (seen[0] + 2 * seen[1]) if seen[0] else 0.0
    found = [k - (k + 1) * y * seen[k] / seen[k - 1] if seen[k - 1] else k / 2 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found)]


def block_scores(texts: DataFrame, answers: DataFrame) -> DataFrame:
    """id, lang, n_grams, perplexity of every text; ``answers``: block, gram, logp."""

    def score(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        at_work("quality")
        try:
            return scored(docs, known)
        finally:
            give_back()

    def scored(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("gram")
        names, values = known["gram"].to_numpy(np.int64), known["logp"].to_numpy(np.float64)
        out = []
        for keys, langs, texts in _chunks(docs):
            for start, end in _steps(texts):
                found, at = grams(list(texts[start:end]))
                codes, distinct = pd.factorize(found)
                logs = values[np.searchsorted(names, distinct)][codes] if len(found) else np.zeros(0)
                sums = np.concatenate(([0.0], np.cumsum(logs)))
                n = np.diff(at)
                with np.errstate(invalid="ignore", divide="ignore"):
                    perplexity = np.exp(-(sums[at[1:]] - sums[at[:-1]]) / n)
                out.append(
                    pd.DataFrame(
                        {
                            "id": pd.array(keys[start:end], "Int64"),
                            "lang": list(langs[start:end]),
                            "n_grams": n,
                            "perplexity": [x if k else None for x, k in zip(perplexity, n)],
                        }
                    )
                )
        empty = pd.DataFrame({"id": pd.array([], "Int64"), "lang": [], "n_grams": np.zeros(0, int), "perplexity": np.zeros(0)})
        return pd.concat(out) if out else empty

    schema = "id long, lang string, n_grams long, perplexity double"
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, schema)


def score_quality(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", quantile: float = QUANTILE
) -> DataFrame:
    """``key``, lang, n_grams, perplexity, threshold and kept, a row per document.

    Trusted are the texts labelled 1 in ``labels.quality``. The model is trained on four fifths of them.
    ``threshold`` is the quantile of the perplexities of the others of at least ``SHORT`` n-grams in the
    language, or in all languages where it has fewer than ``OWN`` of them; above it a text is not kept.

    * Null and empty texts have a null perplexity and are kept: nothing speaks against them. So is all
      without any trusted text. Null languages form no language of their own.
    * Rows with a null key are scored, and never trusted. Repeated rows are scored alike. A key with
      several labels is trusted if one of them is 1. An empty table gives no rows.
    """
    blocks = block_count(df, text)
    texts = dealt(df, key, text, lang, blocks)
    good = labels.where("quality = 1").select(F.col(key).cast("long").alias("id")).where("id is not null").distinct()
    spared = F.pmod(F.xxhash64(F.lit("spared"), "id"), F.lit(SPARED)) == 0
    # A trusted key goes to each block that has one of its rows.
    places = df.select(block_of(key, text, blocks), F.col(f"`{key}`").cast("long").alias("id")).distinct()
    trusted = places.join(good.where(~spared), "id").select("block", "id")
    counted = cut(block_grams(texts, trusted))
    answers = counted.select("block", "gram").join(log_probabilities(counted), "gram")
    scored = cut(block_scores(texts, answers))

    high = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    known = scored.join(good.where(spared), "id", "left_semi").where(F.col("n_grams") >= SHORT)
    overall = known.agg(high.alias("overall"))
    by_lang = known.where("lang is not null").groupBy("lang").agg(high.alias("of_lang"), F.count("*").alias("n"))
    by_lang = cut(by_lang.where(F.col("n") >= OWN).drop("n"))
    limit = F.coalesce("of_lang", F.lit(overall.first()["overall"]).cast("double"))
    return scored.join(by_lang, "lang", "left").select(
        F.col("id").alias(key),
        "lang",
        "n_grams",
        "perplexity",
        limit.alias("threshold"),
        F.coalesce(F.col("perplexity") <= limit, F.lit(True)).alias("kept"),
    )


def reject_low_quality(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``df`` without the documents that are not kept; a key goes where one of its rows does.

    Rows with a null key cannot be told apart by it, and stay.
    """
    judged = score_quality(df, labels, key, text, lang)
    rejected = cut(judged.where(~F.col("kept")).select(F.col(key).alias("rejected")).where("rejected is not null").distinct())
    return df.alias("d").join(rejected.alias("r"), F.col(f"d.`{key}`") == F.col("r.rejected"), "left_anti")
