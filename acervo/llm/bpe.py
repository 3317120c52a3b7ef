"""Byte-level BPE with the tiktoken library and a rank file of one's own.

Ids are carried as bytes, four per id, little-endian: compact in a shuffle and hashed as they are.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts longer than this many characters are encoded in parts.
PART_CHARS = 1 << 16
#: Between one of these characters and a space or line feed a match of the pattern always ends: none
#: but white space reaches over white space, and a look-ahead never passes a visible character.
_BOUNDARY = re.compile(r"(?<=[0-9A-Za-z.,;:!?])(?=[ \n])")

_loaded: dict = {}


def encoding(rank_file: str, pattern: str):
    """The encoding of a rank file, read once per Python worker."""
    if (rank_file, pattern) not in _loaded:
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _loaded[rank_file, pattern] = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _loaded[rank_file, pattern]


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """A text in parts of at least ``size`` characters, cut at safe boundaries only.

    A text without such a boundary, however long, is one part.
    """
    start = 0
    while len(text) - start > size:
        found = _BOUNDARY.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_text(enc, text: str) -> bytes:
    import numpy as np

    if len(text) <= PART_CHARS:
        return np.array(enc.encode_ordinary(text), dtype="<u4").tobytes()
    return b"".join(np.array(enc.encode_ordinary(part), dtype="<u4").tobytes() for part in parts(text))


def encode(text: Column, rank_file: str, pattern: str) -> Column:
    """The ids of a text as bytes; special tokens in it are ordinary text. Null: the ids of an empty text, none."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            yield pa.array([encode_text(enc, t.as_py() or "") for t in batch], pa.binary())

    return ids(text.cast("string"))


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """The raw bytes that ids stand for, whether or not they are valid UTF-8. Null: no bytes."""

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        enc = encoding(rank_file, pattern)
        for batch in batches:
            yield pa.array([enc.decode_bytes(np.frombuffer(i.as_py() or b"", "<u4").tolist()) for i in batch], pa.binary())

    return raw(ids)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def encode_table(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the column ``ids``; a column of that name is replaced. Rows and other columns stay.

    One pass, no shuffle. Null and empty texts have no ids; repeated rows are encoded alike; an empty
    table stays empty. Texts longer than 65,536 characters are encoded in parts, with the same ids.
    """
    return df.withColumn(ids, encode(F.col(f"`{text}`"), rank_file, pattern))


def decode_table(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the column ``decoded``, the bytes of ``ids``; a column of that name is replaced."""
    return df.withColumn(decoded, decode(F.col(f"`{ids}`"), rank_file, pattern))
