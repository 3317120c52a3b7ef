"""Best-fit packing of token sequences: bounded-space, online.

Two steps. ``tokenize`` turns each document into pieces of at most ``limit`` tokens, a narrow row each.
``pack`` deals the pieces out and each task packs its share with a fixed number of open bins.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark import TaskContext

from acervo.llm.common import at_work, cut, quiet_threads, tidy
from acervo.llm.words import hash_spans

LIMIT = 1024
OPEN_BINS = 4096
#: Ids of so many words are kept in a Python worker (about 60 bytes each), none of words of more than LONG_WORD bytes.
CACHED_WORDS, LONG_WORD = 250_000, 64
#: New words in one text for the tokenizer; bytes of texts whose words are looked up together.
TEXT_WORDS, BLOCK = 1000, 2 << 20
#: Texts that the tokenizer encodes at once: what it says of a token takes far more room than the id.
TEXTS = 16
#: A space that white space or the end follows: such a text is not cut into words.
_LOOSE_SPACE = r" (?=\s|\Z)"

_words: dict[str, "_Known"] = {}
_tokenizers: dict = {}
_spaced: dict = {}
_uncut: dict = {}


def _forget() -> None:
    for kept in (_words, _tokenizers, _spaced, _uncut):
        kept.clear()


def _tokenizer(path: str):
    if path not in _tokenizers:
        quiet_threads()
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _whole(path: str) -> re.Pattern:
    """What a text holds that is not to be cut into words: a loose space, or the string of a special token."""
    if path not in _uncut:
        special = [re.escape(token.content) for token in _tokenizer(path).get_added_tokens_decoder().values()]
        _uncut[path] = re.compile("|".join([_LOOSE_SPACE, *special]))
    return _uncut[path]


def _encoded(texts: list[str], path: str) -> Iterator:
    """The ids of each text."""
    import numpy as np

    for at in range(0, len(texts), TEXTS):
        for found in _tokenizer(path).encode_batch_fast(texts[at : at + TEXTS], add_special_tokens=False):
            yield np.array(found.ids, "<u4")


def _starts_word(path: str):
    """For each id whether its token begins with a space."""
    import numpy as np

    if path not in _spaced:
        vocabulary = _tokenizer(path).get_vocab()
        _spaced[path] = np.zeros(max(vocabulary.values()) + 1, bool)
        _spaced[path][[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
    return _spaced[path]


class _Known:
    """Ids of words met lately. They are found by a hash, and the word itself confirms what is found."""

    def __init__(self):
        import numpy as np

        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by hash; rows of words and ids
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used, self.round = np.zeros(0, np.int64), 0

    def find(self, words: pa.Array, hashes):
        """The row of each word, -1 for those that are not known."""
        import numpy as np

        self.round += 1
        if not len(self.hashes):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        rows = self.places[at]
        same = self.hashes[at] == hashes
        same &= pc.equal(self.words.take(pa.array(rows)), words).to_numpy(zero_copy_only=False)
        self.used[rows[same]] = self.round
        return np.where(same, rows, -1)

    def add(self, words: pa.Array, hashes, ids: pa.Array) -> None:
        """Keeps words that were not found, beyond ``CACHED_WORDS`` the half that was met last. Long words are left out."""
        import numpy as np

        fresh = np.unique(hashes, return_index=True)[1]
        fresh = fresh[pc.binary_length(words).to_numpy()[fresh] <= LONG_WORD]
        at = np.searchsorted(self.hashes, hashes[fresh])
        fresh = fresh[at == np.searchsorted(self.hashes, hashes[fresh], "right")]  # another word may have the hash
        kept = np.arange(len(self.words))
        if len(kept) + len(fresh) > CACHED_WORDS:
            kept = np.argsort(-self.used, kind="stable")[: CACHED_WORDS // 2]
            fresh = fresh[: CACHED_WORDS - len(kept)]
            own = np.empty(len(self.words), np.uint64)
            own[self.places] = self.hashes
            own = own[kept]
            self.words, self.ids, self.used = self.words.take(pa.array(kept)), self.ids.take(pa.array(kept)), self.used[kept]
            self.places = np.argsort(own)
            self.hashes = own[self.places]
        hashes = np.concatenate([self.hashes, hashes[fresh]])
        places = np.concatenate([self.places, len(kept) + np.arange(len(fresh))])
        order = np.argsort(hashes, kind="stable")  # two sorted runs
        self.hashes, self.places = hashes[order], places[order]
        self.words = pa.concat_arrays([self.words, words.take(pa.array(fresh))])
        self.ids = pa.concat_arrays([self.ids, ids.take(pa.array(fresh))])
        self.used = np.concatenate([self.used, np.full(len(fresh), self.round)])


def _new_ids(words: list[str], path: str) -> pa.Array:
    """The ids of words that a space stands before, four bytes per id.

    They go to the tokenizer in texts of ``TEXT_WORDS`` words, and its ids are cut where a token begins with a space.
    """
    import numpy as np

    texts = [" " + " ".join(words[at : at + TEXT_WORDS]) for at in range(0, len(words), TEXT_WORDS)]
    ids = np.concatenate([np.zeros(0, "<u4"), *_encoded(texts, path)])
    edges = np.append(np.flatnonzero(_starts_word(path)[ids]), len(ids))
    if len(edges) != len(words) + 1:
        raise ValueError("each word's first token, and no other, has to begin with a space")
    return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(4 * edges.astype(np.int64)), pa.py_buffer(ids)])


def _word_ids(words: pa.Array, path: str) -> pa.Array:
    """The ids of distinct words; new ones are kept for the next texts."""
    import numpy as np

    known = _words.setdefault(path, _Known())
    offsets = np.frombuffer(words.buffers()[1], np.int64, words.offset + len(words) + 1)[words.offset :]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    hashes = hash_spans(data, offsets[:-1] - offsets[0], offsets[1:] - offsets[0])
    rows = known.find(words, hashes)
    new = np.flatnonzero(rows < 0)
    unknown = words.take(pa.array(new))
    ids = _new_ids(unknown.to_pylist(), path)
    rows[new] = len(known.ids) + np.arange(len(new))
    found = pa.concat_arrays([known.ids, ids]).take(pa.array(rows))
    known.add(unknown, hashes[new], ids)
    return found


def encode_words(texts: list[str] | pa.Array, path: str) -> list[bytes]:
    """The ids of each text, four bytes per id; a worker gives a word to the tokenizer once while it keeps it.

    A byte-level tokenizer starts a new pre-token at a space that a visible character follows and
    that no white space precedes, so a text can be cut there without changing an id. The words of all
    texts are looked up once per distinct word, and their ids are gathered by array operations.
    """
    import numpy as np

    at_work("packing", _forget)
    whole = _whole(path)
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
    uncut = np.fromiter((whole.search(t) is not None for t in texts.to_pylist()), bool, len(texts))
    lists = pc.split_pattern(texts.filter(pa.array(~uncut)).cast(pa.large_string()), " ")
    edges = lists.offsets.to_numpy()
    # The first word of a text has no space before it.
    first = iter(pc.list_element(lists, 0).to_pylist() if len(lists) else [])
    heads = [t if u else next(first) for t, u in zip(texts.to_pylist(), uncut.tolist())]
    heads = [ids.tobytes() for ids in _encoded(heads, path)]
    coded = lists.flatten().dictionary_encode()
    tails = np.delete(coded.indices.to_numpy(), edges[:-1])
    needed = np.zeros(len(coded.dictionary), bool)
    needed[tails] = True
    ids = _word_ids(coded.dictionary.filter(pa.array(needed)), path).take(pa.array((np.cumsum(needed) - 1)[tails]))
    places = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
    data, places = memoryview(ids.buffers()[2] or b""), places[edges - np.arange(len(edges))].tolist()
    parts = zip(places, places[1:])
    return [head if u else head + data[slice(*next(parts))] for head, u in zip(heads, uncut.tolist())]


def tokenize(df: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """A row per piece: ``key``, piece, start, length, ids_crc32, and ``ids`` as bytes.

    A document's ids end with ``end_id``. Longer ones than ``limit`` are cut so that all pieces but the
    first are full. Null text: empty, which leaves the piece of ``end_id`` alone. Repeated rows give
    repeated pieces. Whatever the key is, it is carried along.
    """
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    out = f"key {kind}, piece int, start long, length long, ids_crc32 long, ids binary"

    @tidy
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        end = end_id.to_bytes(4, "little")
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            edges = [0, *(np.flatnonzero(np.diff(size // BLOCK)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                part = batch.slice(low, high - low)
                columns = [[], [], [], [], [], []]
                keys, texts = part.column(0), pc.fill_null(part.column(1), "")
                owner = []
                for row, ids in enumerate(encode_words(texts, path)):
                    ids += end
                    total = len(ids) // 4
                    start, number = 0, 0
                    while start < total:
                        length = (total - start - 1) % limit + 1 if not start else limit
                        piece = ids[4 * start : 4 * (start + length)]
                        owner.append(row)
                        for column, value in zip(columns[1:], (number, start, length, zlib.crc32(piece), piece)):
                            column.append(value)
                        start, number = start + length, number + 1
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [keys.take(pa.array(owner, pa.int64()))]
                arrays += [pa.array(c, t) for c, t in zip(columns[1:], kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "piece", "start", "length", "ids_crc32", "ids"])

    return source.mapInArrow(pieces, out).withColumnRenamed("key", key)


class Bins:
    """A fixed number of open bins. Bit f of ``free`` says that an open bin has f tokens free."""

    def __init__(self, limit: int, open_bins: int, first: int):
        self.limit, self.open_bins, self.next = limit, open_bins, first
        self.free, self.by_free, self.n_open = 0, {}, 0

    def put(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece: in the fullest open bin that it fits, else in a new one.

        Where too many are open then, the fullest closes.
        """
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            bins = self.by_free[space]
            number = bins.pop()
            if not bins:
                self.free &= ~(1 << space)
            self.n_open -= 1
        else:
            space, number = self.limit, self.next
            self.next += 1
        left = space - length
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.free |= 1 << left
            self.n_open += 1
            if self.n_open > self.open_bins:
                fullest = (self.free & -self.free).bit_length() - 1
                bins = self.by_free[fullest]
                bins.pop()
                if not bins:
                    self.free &= ~(1 << fullest)
                self.n_open -= 1
        return number, self.limit - space


def pack(pieces: DataFrame, key: str = "doc_id", limit: int = LIMIT, open_bins: int = OPEN_BINS, rows_per_task: int = 20_000) -> DataFrame:
    """``pieces`` (key, piece, length and more) with ``sequence_id`` and ``offset``.

    Full pieces are sequences by themselves. The others are dealt out at random, yet by their values
    and not by chance, into tasks of about ``rows_per_task``, and each task packs its share in an order
    that depends on values only: a task that runs again gives the same rows. A task's number goes into
    the upper bits of its sequence ids. The pieces are stored first, so leave out wide columns that
    another table has. Columns named sequence_id and offset are replaced.
    """
    pieces = cut(pieces.drop("sequence_id", "offset"))
    order = F.xxhash64(F.lit(7), F.col(f"`{key}`"), "piece", "ids_crc32")
    parts = max(1, -(-pieces.where(F.col("length") < limit).count() // rows_per_task))
    dealt = pieces.repartition(parts, order).sortWithinPartitions(order, key, "piece", "length")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long"
    at = pieces.columns.index("length")

    @tidy
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(limit, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            placed = [bins.put(n) for n in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([p[0] for p in placed], pa.int64()), pa.array([p[1] for p in placed], pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    return dealt.mapInArrow(packed, schema)
