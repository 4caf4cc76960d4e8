"""Byte-level BPE over a file of ranks: texts to ids and ids to bytes.

The bytes of a word start as single parts. A segment tree over the byte positions holds, at the leaf of a live part,
the rank of the pair it forms with the part behind it; every node holds the least rank below it and, of equal ones,
the leftmost place. The root names the next merge. A merge changes three leaves (the pair itself, the part that went
into it, the part before) and the nodes above them, so a word of n bytes costs n log n however long it is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .text import slices

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of words (and 16 for each) whose ids a Python worker keeps in each of two generations; longer words than
#: KEPT are never kept.
CACHED_CHARS = 8_000_000
KEPT = 256
#: Words of a text that are held at a time.
PIECES = 1 << 16

_NONE = 1 << 62
_PLACE = (1 << 32) - 1


class Codec:
    """The vocabulary of one ranks file, found by `public_tokenizers.path` on whichever machine runs this."""

    def __init__(self, file: str = RANKS, pattern: str | None = None):
        import public_tokenizers
        import regex

        with open(public_tokenizers.path(file), "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern or public_tokenizers.PATTERN)
        self.parts: dict[int, bytes] = {i: b for b, i in self.ranks.items()}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one match of the pattern. A match that is an entry itself is that entry."""
        whole = self.ranks.get(word)
        return [whole] if whole is not None else self.merge(word)

    def merge(self, word: bytes) -> list[int]:
        n = len(word)
        rank = self.ranks.get
        if n < 2:
            return [self.ranks[word]] if n else []
        size = 1 << (n - 2).bit_length()
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            r = rank(word[i : i + 2])
            if r is not None:
                tree[size + i] = r << 32 | i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        end = list(range(1, n + 1))  # where the live part that starts here ends
        before = list(range(-1, n - 1))  # where the live part before it starts

        def put(i: int, r: int | None) -> None:
            k = size + i
            tree[k] = _NONE if r is None else r << 32 | i
            while k > 1:
                k >>= 1
                a, b = tree[2 * k], tree[2 * k + 1]
                least = a if a < b else b
                if tree[k] == least:
                    return
                tree[k] = least

        while tree[1] != _NONE:
            i = tree[1] & _PLACE
            j = end[i]
            stop = end[j]
            end[i] = stop
            if stop < n:
                before[stop] = i
                put(j, None)
                put(i, rank(word[i : end[stop]]))
            else:
                if j < n - 1:
                    put(j, None)
                put(i, None)
            h = before[i]
            if h >= 0:
                put(h, rank(word[h:stop]))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[word[i : end[i]]])
            i = end[i]
        return ids

    def ids_of(self, words: list[str]) -> list[int]:
        """Ids of words. Those met since CACHED_CHARS before last are remembered, so frequent words stay known."""
        if self.held > CACHED_CHARS:
            self.older, self.known, self.held = self.known, {}, 0
        got = list(map(self.known.get, words))
        if None in got:
            for k in [k for k, ids in enumerate(got) if ids is None]:
                w = words[k]
                got[k] = ids = self.known.get(w) or self.older.get(w) or tuple(self.encode_word(w.encode("utf-8", "replace")))
                if len(w) <= KEPT and w not in self.known:
                    self.known[w] = ids
                    self.held += len(w) + 16
        return list(chain.from_iterable(got))

    def chunks(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, some words at a time."""
        if len(text) <= PIECES:
            yield self.ids_of(self.pattern.findall(text))
            return
        found = self.pattern.finditer(text)
        while some := [m.group() for m in islice(found, PIECES)]:
            yield self.ids_of(some)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.chunks(text)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.parts.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(file: str) -> Codec:
    if file not in _codecs:
        _codecs[file] = Codec(file)
    return _codecs[file]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[str]]]:
    """Rows and their texts; a null text is empty, and a byte that is no UTF-8 is U+FFFD."""
    for part, raw, offsets in slices(batches):
        data = raw.tobytes()
        yield part, (data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:]))


def encode(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """doc_id, ids: a row for each input row, whole texts; a null or empty text has no ids."""
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([cols.schema["doc_id"], StructField("ids", ArrayType(IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for part, texts in _texts(batches):
            ids = [np.fromiter(chain.from_iterable(c.chunks(t)), np.int32) for t in texts]
            bounds = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(ids)))], names=schema.names)

    return cols.mapInArrow(run, schema)


def decode(df: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", ranks: str = RANKS) -> DataFrame:
    """doc_id, bytes: what the ids stand for, as bytes, as ids may cut a character. Null ids, an id that the file
    lacks, or a null in the list give null bytes."""
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    schema = StructType([cols.schema["doc_id"], StructField("bytes", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                out = [None if ids is None or any(i not in c.parts for i in ids) else c.decode(ids) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())], names=schema.names)

    return cols.mapInArrow(run, schema)


def round_trip(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (the bytes decoded from them).

    A row for each input row. The ids of a long text are made, hashed and decoded some words at a time.
    """
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([cols.schema["doc_id"], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for part, texts in _texts(batches):
            counts, of_ids, of_bytes = [], [], []
            for text in texts:
                n, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
                for ids in c.chunks(text):
                    if ids:
                        ids_hash.update((("," if n else "") + ",".join(map(str, ids))).encode())
                        bytes_hash.update(c.decode(ids))
                        n += len(ids)
                counts.append(n)
                of_ids.append(ids_hash.hexdigest())
                of_bytes.append(bytes_hash.hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=schema.names)

    return cols.mapInArrow(run, schema)
