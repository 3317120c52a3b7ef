"""Benchmark passages in training texts, by winnowing.

Of the hashes of the word 5-grams in a window of 10 words the least one is kept, the last of equal ones.
Which one that is depends on the window's words alone, so that two texts which share a window also share
its fingerprint: no shared span of 10 words or more is missed.

* One pass over the texts winnows them. A fingerprint goes on where a bitmap of the benchmark's
  fingerprints, of bounded size, has it; with it go the words of its windows, its context.
* Passages that many texts share have equal contexts. Each distinct one is joined with the benchmark's
  fingerprints and extended once: its windows are compared, word for word, with those of the items.
* Windows with the same items are one class, and texts with the same classes share one list of items, so
  that neither a window in very many items nor one in very many texts is expanded against the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm import words as W
from acervo.llm.bitmaps import bitmap, in_bitmap
from acervo.llm.common import cut, release

SPAN, GRAM = 10, 5


def winnow(hashes: np.ndarray, offsets: np.ndarray, span: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words of all windows of ``span`` words within a text, first word of each one's fingerprint, its hash).

    ``hashes``: of the words of several texts, ``offsets`` as in ``hash_words``.
    """
    gram = min(gram, span)
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.full(len(hashes) - gram + 1, gram, np.uint64)
    for k in range(gram):
        grams = W.mix(grams + hashes[k : k + len(grams)])
    least, at = grams[:n].copy(), np.zeros(n, np.int8)
    for k in range(1, span - gram + 1):
        lower = grams[k : k + n] <= least
        least[lower] = grams[k : k + n][lower]
        at[lower] = k
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    windows = np.flatnonzero(np.arange(n) + span <= ends)
    return windows, windows + at[windows], least[windows]


def _marked(docs: DataFrame, spans: list[int], found, bits: int) -> DataFrame:
    """id, text -> id, text_hash, n_words and hits: span, fingerprint, first word and words of its windows."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = found.value
        hit_type = pa.list_(pa.struct([("span", pa.int32()), ("fingerprint", pa.int64()), ("first", pa.int32()), ("context", pa.string())]))
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            counts, hits = [], []
            for start, end in W.groups(texts):
                data, begins, ends, offsets = W.word_spans(texts[start:end], W.NO_LETTER)
                hashes = W.hash_spans(data, begins, ends)
                counts += np.diff(offsets).tolist()
                own = [[] for _ in range(end - start)]
                word = lambda i: data[begins[i] : ends[i]].tobytes()
                for span in spans:
                    windows, at, prints = winnow(hashes, offsets, span)
                    passed = in_bitmap(known, bits, prints)
                    windows, at, prints = windows[passed], at[passed], prints[passed]
                    # The windows of a fingerprint are neighbours.
                    edges = np.flatnonzero(np.diff(at, prepend=-1))
                    lasts = windows[np.append(edges[1:], len(windows)) - 1] if len(edges) else edges
                    texts_of = np.searchsorted(offsets, windows[edges], "right") - 1
                    for text, first, last, value in zip(texts_of.tolist(), windows[edges].tolist(), lasts.tolist(), prints[edges].view(np.int64).tolist()):
                        context = b" ".join([word(i) for i in range(first, last + span)]).decode()
                        own[text].append((span, value, first - int(offsets[text]), context))
                hits += own
            made = [dict(zip(("span", "fingerprint", "first", "context"), h)) for own in hits for h in own]
            edges = np.concatenate(([0], np.cumsum([len(own) for own in hits])))
            column = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(made, hit_type.value_type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), column], ["id", "text_hash", "n_words", "hits"]
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        mark,
        f"id {kind}, text_hash long, n_words long, hits array<struct<span:int,fingerprint:bigint,first:int,context:string>>",
    )


def item_windows(items: DataFrame, span: int = SPAN) -> DataFrame:
    """item, text -> item, span, fingerprint, window: the words of each window; a shorter item is one."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, begins, ends, offsets = W.word_spans([(batch.column(1)[i].as_py() or "").encode()], W.NO_LETTER)
                own = min(span, len(begins))
                if not own:
                    continue
                windows, _, prints = winnow(W.hash_spans(data, begins, ends), offsets, own)
                said = [data[b:e].tobytes() for b, e in zip(begins, ends)]
                for start in range(0, len(windows), 10_000):
                    part = windows[start : start + 10_000]
                    columns = [
                        batch.column(0).take(pa.array([i] * len(part), pa.int64())),
                        pa.array([own] * len(part), pa.int32()),
                        pa.array(prints[start : start + 10_000].view(np.int64)),
                        pa.array([b" ".join(said[w : w + own]).decode() for w in part], pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["item", "span", "fingerprint", "window"])

    return items.mapInArrow(cut_up, "item string, span int, fingerprint long, window string")


def contaminated_words(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", span: int = SPAN
) -> DataFrame:
    """A row per document: ``key``, n_words, spans (first word and length of each occurring window) and items.

    Words are runs of letters, digits and all beyond ASCII, A-Z as a-z. ``spans`` are sorted, and null
    where none occurs; ``items``, sorted strings, are those that have an occurring window.

    * Null and empty texts have no words; an item without words has no window.
    * An item of fewer than ``span`` words occurs where all its words do, in their order.
    * Items with a null id mark words but are not named; items that share an id are one.
    * Documents with a null or repeated key each keep a row, decided by their own text.
    * No documents: no rows. No items: no spans. Other columns are not read.
    """
    windows = cut(item_windows(benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text")), span))
    prints = cut(windows.select("span", "fingerprint").distinct())
    spans = sorted(r["span"] for r in prints.select("span").distinct().collect())  # at most ``span`` numbers
    docs = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    found, bits = bitmap(prints, "fingerprint")
    marked = cut(_marked(docs, spans, found, bits))
    hits = marked.where(F.size("hits") > 0).select("id", "text_hash", F.explode("hits").alias("h")).select("id", "text_hash", "h.*")

    # Each distinct context meets the benchmark once.
    contexts = hits.select("span", "fingerprint", "context").distinct().join(prints, ["span", "fingerprint"], "left_semi")
    said = F.split("context", " ")
    starts = F.sequence(F.lit(0), F.size(said) - F.col("span"))
    extended = contexts.select("span", "context", F.posexplode(F.transform(starts, lambda i: F.array_join(F.slice(said, i + 1, F.col("span")), " "))))
    extended = cut(extended.select("span", "context", F.col("pos").alias("at"), F.col("col").alias("window")))
    occurring = windows.join(extended.select("window").distinct(), "window", "left_semi")
    classes = occurring.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    classes = cut(classes.withColumn("class", F.sha2(F.to_json("items"), 256)))
    known = extended.join(classes.select("window", "class"), "window").groupBy("span", "context")
    known = cut(known.agg(F.collect_set("at").alias("ats"), F.collect_set("class").alias("classes")))

    placed = hits.join(known, ["span", "context"]).select(
        "id", "text_hash", F.transform("ats", lambda a: F.struct((F.col("first") + a).alias("first"), F.col("span").alias("length"))).alias("spans"), "classes"
    )
    per_doc = placed.groupBy("id", "text_hash").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("classes")))).alias("classes"),
    )
    per_doc = cut(per_doc)
    lists = per_doc.select("classes").distinct().select("classes", F.explode("classes").alias("class"))
    lists = lists.join(classes.select("class", "items").distinct(), "class").groupBy("classes")
    lists = lists.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    per_doc = per_doc.join(lists, "classes").select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_text"), "spans", "items")
    release(windows, prints, extended, known)
    same = F.col("id").eqNullSafe(F.col("of_id")) & F.col("text_hash").eqNullSafe(F.col("of_text"))
    result = marked.select("id", "text_hash", "n_words").join(per_doc, same, "left")
    return result.select(F.col("id").alias(key), "n_words", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def words_hit(spans: str):
    """How many words lie in at least one of the sorted ``spans``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def covered(sofar, one):
        end = one["first"] + one["length"]
        new = F.greatest(F.lit(0), end - F.greatest(one["first"], sofar["end"]))
        return F.struct(F.greatest(end, sofar["end"]).alias("end"), (sofar["n"] + new).alias("n"))

    return F.coalesce(F.aggregate(spans, zero, covered, lambda a: a["n"]), F.lit(0))
