"""Phrase collocations, from counts by multikey three-way quicksort of suffixes.

A suffix is the words from one word of a piece on, as far as the longest phrase goes; a phrase's count
is the number of suffixes that begin with it.

* One pass counts hashes of words and of neighbouring pairs. Frequent ones go into a bitmap of bounded size.
* A second pass makes the suffixes, cut off after the first word whose pair with the next one is not in
  the bitmap: no phrase over that pair is frequent. Words that are not in it count for the language's total
  alone. Each task counts equal suffixes before they leave it.
* Suffixes are routed by their leading words: by ranges of the whole suffix, so that a very frequent
  word or pair is split by the words that follow it. Each task sorts its range by multikey three-way
  quicksort; the weight of an equal partition is a count, and partitions under the least count
  are abandoned. Only prefixes of a range's first and last suffix can go on in the next range; these are
  given out whatever their count and added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm import words as W
from acervo.llm.bitmaps import bitmap, in_bitmap
from acervo.llm.common import at_work, cut, release, tidy

LONGEST, LEAST, TOP, NO_LANG = 5, 100, 2000, "und"
#: Bytes of text whose pairs and suffixes a task counts before it gives them out.
BLOCK = 4 << 20
#: Rows of a batch whose texts are unpacked at once; different suffixes that a task keeps count of.
ROWS, KEPT = 256, 1_000_000
#: Suffixes per range, about.
RANGE_ROWS = 400_000
#: A language's candidates are ranked in so many parts before the best of each are ranked together.
PARTS = 64

#: Products of two counts have up to 38 digits.
SCORE = "cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"

_ends_piece = np.zeros(256, bool)
_ends_piece[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_gap = _ends_piece.copy()
_gap[[0x20, 0x09]] = True


class _Block:
    """The words of some texts: hashes, languages, whether the next one is in the same piece, and where their bytes are."""

    def __init__(self):
        self.size, self.hashes, self.langs, self.followed, self.spans = 0, [], [], [], []

    def add(self, texts: list[bytes], langs: np.ndarray) -> None:
        data, starts, ends, offsets = W.word_spans(texts, _gap)
        self.hashes.append(W.hash_spans(data, starts, ends))
        pieces = np.cumsum(_ends_piece[data], dtype=np.int32)[starts]
        self.followed.append(np.append(pieces[1:] == pieces[:-1], np.zeros(min(len(pieces), 1), bool)))
        self.langs.append(np.repeat(langs, np.diff(offsets)))
        self.spans.append((data, starts, ends))
        self.size += len(data)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, languages, whether each word has a next one in its piece)."""
        return tuple(map(np.concatenate, (self.hashes, self.langs, self.followed)))

    def words(self, at: np.ndarray) -> pa.Array:
        """The texts of words by their numbers, ascending."""
        edges = np.cumsum([0, *map(len, self.hashes)])
        out = []
        for (data, starts, ends), low, high in zip(self.spans, edges, edges[1:]):
            own = at[np.searchsorted(at, low) : np.searchsorted(at, high)] - low
            whole = data.tobytes()
            out += [whole[b:e] for b, e in zip(starts[own].tolist(), ends[own].tolist())]
        return pa.array(out, pa.binary()).cast(pa.string())


def _grams(hashes: np.ndarray, salts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word, and of each word and the next one, with their language; the last pair is of no use."""
    words = W.mix(hashes + salts)
    return words, W.mix(words + np.append(hashes[1:], hashes[:1]))


def _blocks(batches: Iterator[pa.RecordBatch], names: dict[str, int]) -> Iterator[_Block]:
    """Blocks of about ``BLOCK`` bytes of the rows lang, text; ``names`` gets a number for each language met."""
    block = _Block()
    for part in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
        lang = np.array([names.setdefault(x, len(names)) for x in part.column(0).to_pylist()], np.int32)
        texts = [(t or "").encode() for t in part.column(1).to_pylist()]
        for start, end in W.groups(texts):
            block.add(texts[start:end], lang[start:end])
            if block.size >= BLOCK:
                yield block
                block = _Block()
    if block.size:
        yield block


def lang_salt(name: str) -> int:
    """What a language adds to the hash of a pair: the same in all tasks."""
    return int(W.hash_words([b"=" + name.encode().hex().encode()])[0][0])


def _salts(names: dict[str, int]) -> np.ndarray:
    return np.array([lang_salt(n) for n in names], np.uint64)


def gram_counts(texts: DataFrame) -> DataFrame:
    """lang, text -> gram (hash of a word or a pair with the language), n: how often it is in a block.

    A gram has a row for each block that it is in.
    """

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("collocations")
        names: dict[str, int] = {}
        for block in _blocks(batches, names):
            hashes, langs, followed = block.joined()
            block.spans.clear()
            words, pairs = _grams(hashes, _salts(names)[langs])
            for grams in (words, pairs[followed]):
                gram, n = np.unique(grams, return_counts=True)
                for start in range(0, len(gram), 50_000):
                    part = slice(start, start + 50_000)
                    yield pa.RecordBatch.from_arrays([pa.array(gram[part].view(np.int64)), pa.array(n[part])], ["gram", "n"])

    return texts.mapInArrow(count, "gram long, n long")


def _grouped(columns: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(number of an equal row for each row, how many rows it stands for by that number): rows of small numbers."""
    code = np.zeros(len(columns[0]), np.int64)
    for column, size in zip(columns, sizes):
        code = np.unique(code * size + column, return_inverse=True)[1]
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return first, n


def suffixes(texts: DataFrame, found, bits: int, longest: int = LONGEST) -> DataFrame:
    """lang, text -> suffix (language and up to ``longest`` words), n: how often it occurs.

    A task counts up to ``KEPT`` suffixes and gives them out when there are more, or at its end.
    """

    @tidy
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("collocations")
        known, names = found.value, {}
        sofar = pa.table({"key": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        for block in _blocks(batches, names):
            hashes, langs, followed = block.joined()
            if not len(hashes):
                continue
            words, pairs = _grams(hashes, _salts(names)[langs])
            linked, frequent = followed & in_bitmap(known, bits, pairs), in_bitmap(known, bits, words)
            _, first, code = np.unique(hashes, return_index=True, return_inverse=True)
            del hashes, followed, words, pairs
            order = np.argsort(first)
            number = np.empty(len(order), np.int32)
            number[order] = np.arange(len(order), dtype=np.int32)
            code = number[code]  # words numbered by their first place
            every = pa.concat_arrays([pa.array([str(i) for i in range(len(names))]), block.words(first[order])])
            block.spans.clear()
            size = len(order) + 1
            # Words without a frequent pair stand alone; the others take along the words they are linked with.
            # A pair of the bitmap by chance, whose first word is not in it, is no phrase.
            linked &= frequent
            rows = [np.flatnonzero(linked), np.flatnonzero(~linked)]
            for at, depth in zip(rows, (longest, 1)):
                columns, goes = [langs[at], np.where(frequent[at], code[at] + 1, 0)], np.ones(len(at), bool)
                for k in range(1, depth):
                    goes = goes & linked[np.minimum(at + k - 1, len(code) - 1)]
                    columns.append(np.where(goes, code[np.minimum(at + k, len(code) - 1)] + 1, 0).astype(np.int32))
                firsts, n = _grouped(columns, [len(names)] + [size] * depth)
                table = np.stack([c[firsts] for c in columns])
                del columns, goes, firsts
                sofar = pa.concat_tables([sofar, pa.table({"key": _keys(table, len(names), every), "n": pa.array(n)})])
                sofar = sofar.group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns(["key", "n"])
            if len(sofar) > KEPT:
                yield from _given(sofar, names)
                sofar = sofar.slice(0, 0)
        yield from _given(sofar, names)

    return texts.mapInArrow(make, "suffix array<string>, n long")


def _keys(table: np.ndarray, n_langs: int, every: pa.Array) -> pa.Array:
    """Rows of numbers, language and words with 0 for none, as lines of what ``every`` has for them, languages first."""
    numbers = table.T.copy()
    there = numbers > 0
    there[:, 0] = True
    numbers[:, 1:] += n_langs - 1
    edges = np.concatenate(([0], np.cumsum(there.sum(axis=1))))
    # No word has a line feed in it.
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), every.take(pa.array(numbers[there]))), "\n")


def _given(counted: pa.Table, names: dict[str, int]) -> Iterator[pa.RecordBatch]:
    named = pa.array(list(names), pa.string())
    for batch in counted.to_batches(max_chunksize=50_000):
        lists = pc.split_pattern(batch.column("key"), "\n")
        words, heads = lists.flatten(), lists.offsets.to_numpy()[:-1]
        mask = np.zeros(len(words), bool)
        mask[heads] = True
        words = pc.replace_with_mask(words, pa.array(mask), named.take(words.take(pa.array(heads)).cast(pa.int64())))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(lists.offsets, words), batch.column("n")], ["suffix", "n"])


def multikey_quicksort(keys: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Counts of prefixes by three-way partitions of row pointers, all partitions of a round at once.

    ``keys``: (depth, rows) of word numbers, 0 after the last word. A partition's rows agree in their first
    words; at the next one they are parted into less than, equal to and greater than the pivot, a median of
    three. An equal partition is a prefix one word longer and its weight that prefix's count. Partitions
    under ``least`` are abandoned. Yields (a row of each prefix, count, number of words).
    """
    depth, rows = keys.shape
    pointers = np.arange(rows)
    sizes, levels = np.array([rows]), np.array([0])
    flat = keys.ravel()
    while len(pointers):
        starts = np.cumsum(sizes) - sizes
        part = np.repeat(np.arange(len(sizes)), sizes)
        key = flat[levels[part] * rows + pointers]
        pivot = np.median(np.stack([key[starts], key[starts + sizes // 2], key[starts + sizes - 1]]), axis=0)[part]
        side = part * 3 + 1 + (key > pivot) - (key < pivot)
        order = np.argsort(side, kind="stable")
        pointers, side = pointers[order], side[order]
        sizes = np.bincount(side, minlength=3 * len(sizes))
        weight = np.bincount(side, weights[pointers], len(sizes)).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        equal = np.arange(len(sizes)) % 3 == 1
        levels = np.repeat(levels, 3) + equal
        goes = (weight >= least) & (sizes > 0)
        heads = pointers[np.minimum(starts, max(len(pointers) - 1, 0))]
        ended = equal & goes & (flat[np.maximum(levels - 1, 0) * rows + heads] == 0)
        goes &= ~ended
        said = equal & goes
        for level in np.unique(levels[said]):
            now = said & (levels == level)
            yield heads[now], weight[now], int(level)
        goes &= levels < depth
        pointers = pointers[goes[side]]
        sizes, levels = sizes[goes], levels[goes]


def prefix_counts(ranges: DataFrame, least: int, longest: int) -> DataFrame:
    """phrase (language and words), n: of each partition, which must be a range of the suffixes.

    Complete counts from ``least`` on, and for prefixes of the first and the last suffix their part.
    """

    @tidy
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("collocations")
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        lists = pa.chunked_array([b.column(0) for b in batches]).combine_chunks()
        weights = np.concatenate([b.column(1).to_numpy() for b in batches])
        batches.clear()
        words = lists.flatten().dictionary_encode()
        # Numbered in the order of their bytes, so that the least and the greatest suffix are the range's ends.
        rank = pc.sort_indices(words.dictionary.cast(pa.binary())).to_numpy()
        number = np.empty(len(rank), np.int64)
        number[rank] = np.arange(1, len(rank) + 1)
        length = pc.list_value_length(lists).to_numpy()
        at = np.arange(len(words)) - np.repeat(np.cumsum(length) - length, length)
        keys = np.zeros((longest + 1, len(length)), np.int64)
        keys[at, np.repeat(np.arange(len(length)), length)] = number[words.indices.to_numpy()]
        names = words.dictionary.take(pa.array(rank))

        def given(rows: np.ndarray, n: np.ndarray, level: int) -> pa.RecordBatch:
            said = names.take(pa.array(keys[:level, rows].T.ravel() - 1))
            edges = pa.array(np.arange(0, len(said) + 1, level), pa.int32())
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(edges, said), pa.array(n)], ["phrase", "n"])

        ends = set()
        for pick in (np.min, np.max):
            inside = np.arange(keys.shape[1])
            for level in range(1, longest + 2):
                key = pick(keys[level - 1, inside])
                inside = inside[keys[level - 1, inside] == key]
                if key == 0:
                    break
                # All that agree with the end so far, not only those that may be the end themselves.
                prefix = tuple(keys[:level, inside[0]].tolist())
                if level > 1 and prefix not in ends:
                    ends.add(prefix)
                    same = (keys[:level] == np.array(prefix)[:, None]).all(axis=0)
                    yield given(inside[:1], np.array([weights[same].sum()]), level)
        for rows, n, level in multikey_quicksort(keys, weights, least):
            if level > 1:
                inner = np.array([tuple(k) not in ends for k in keys[:level, rows].T.tolist()], bool)
                for start in range(0, len(rows), 50_000):
                    part = slice(start, start + 50_000)
                    if inner[part].any():
                        yield given(rows[part][inner[part]], n[part][inner[part]], level)

    return ranges.mapInArrow(sort, "phrase array<string>, n long")


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(phrase, f: all phrases of 1 to ``longest`` words with a count of at least ``least``; lang, n: words in all).

    ``phrase`` is an array, the language first. Both tables are stored.
    """
    texts = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    frequent = cut(gram_counts(texts).groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("gram"))
    found, bits = bitmap(frequent, "gram")
    rows = cut(suffixes(texts, found, bits, longest))
    release(frequent)
    totals = cut(rows.groupBy(F.col("suffix")[0].alias("lang")).agg(F.sum("n").alias("n")))
    ranges = rows.repartitionByRange(max(1, -(-rows.count() // RANGE_ROWS)), "suffix")
    counts = prefix_counts(ranges, least, longest).groupBy("phrase").agg(F.sum("n").alias("f"))
    counts = cut(counts.where(F.col("f") >= least))
    release(rows)
    return counts, totals


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP, covered: int = 100
) -> DataFrame:
    """Per language the ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Words are runs of other than space and tab within pieces, which end at ``. , ; : ! ?`` and line ends;
    A-Z as a-z. ``a`` is a phrase's count, ``n`` that of all words. A cut after k words gives l and r,
    the counts of both sides, and the score floor(1000 * a * n / (l * r)); the lowest one counts, of
    equal ones that with the smallest k. A candidate is left out where a longer one holds its words and
    occurs in at least ``covered`` hundredths of its places. Ties by a, then by the phrase's bytes.

    * A null language is ``und``. Null and empty texts have no words. Repeated rows count each time.
    * No rows, or no phrase with a count of ``least``: no rows. Other columns are not read.
    * Products of counts are decimals of 38 digits; beyond these (10**13 words) they fail, not round.
    """
    counts, totals = phrase_counts(df, text, lang, longest, least)
    found = counts.where(F.size("phrase") > 2)
    cuts = found.select("phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("phrase") - 2)).alias("k"))
    cuts = cuts.select(
        "phrase",
        "a",
        "k",
        F.slice("phrase", F.lit(1), F.col("k") + 1).alias("left"),
        F.concat(F.slice("phrase", 1, 1), F.slice("phrase", F.col("k") + 2, F.size("phrase"))).alias("right"),
    )
    one, two = counts.select(F.col("phrase").alias("left"), F.col("f").alias("l")), counts.select(F.col("phrase").alias("right"), F.col("f").alias("r"))
    sides = cuts.join(one, "left").join(two, "right").withColumn("lang", F.col("phrase")[0])
    sides = sides.join(totals, "lang")
    scored = sides.withColumn("score", F.expr(SCORE)).groupBy("phrase", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))

    # Every run of words inside a longer candidate, with the count of the most frequent one that holds it.
    size = F.size("phrase") - 1
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda m: F.transform(F.sequence(F.lit(2), size - m + 2), lambda i: F.concat(F.slice("phrase", 1, 1), F.slice(F.col("phrase"), i, m))),
        )
    )
    held = found.where(F.size("phrase") > 3).select(F.explode(inner).alias("phrase"), F.col("f").alias("longer"))
    held = held.groupBy("phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(held, "phrase", "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    named = kept.select(
        "lang", F.array_join(F.slice("phrase", F.lit(2), F.size("phrase")), " ").alias("phrase"), "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "n", F.col("s.score").alias("score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
