"""Hashes of words and word windows over Arrow text columns, on numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

U = np.uint64


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _spread(x + U((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1)))


BYTE = mix(np.arange(256, dtype=np.uint64), 11)
STEP = U(0x5851F42D4C957F2D)
SLOT = mix(np.arange(16, dtype=np.uint64), 12) | U(1)

# A-Z to lower case; every other byte stays, so UTF-8 letters beyond ASCII are untouched.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def separators(extra: str = "") -> np.ndarray:
    """Truth per byte: space, tab to carriage return, and the extra ASCII characters."""
    out = np.zeros(256, dtype=bool)
    out[[0x20, *range(0x09, 0x0E), *extra.encode("ascii")]] = True
    return out


BLANKS = separators()
PUNCTUATION = separators("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

_powers = np.ones(1, dtype=np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            grown = np.full(max(n, 2 * len(_powers)), STEP, dtype=np.uint64)
            grown[0] = 1
            _powers = np.cumprod(grown)
    return _powers


def slices(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches with a column `text` into pieces of about `limit` bytes: (rows, bytes, offsets).

    A null text is empty. One text is never cut, so a piece holds `limit` bytes plus one text at most.
    """
    for batch in batches:
        text = pc.fill_null(batch.column(batch.schema.get_field_index("text")), "")
        if isinstance(text, pa.ChunkedArray):
            text = text.combine_chunks()
        text = text.cast(pa.large_string())
        ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            data = text.buffers()[2]
            raw = np.frombuffer(data, dtype=np.uint8)[ends[at] : ends[to]] if data is not None else np.zeros(0, dtype=np.uint8)
            yield batch.slice(at, to - at), raw, ends[at : to + 1] - ends[at]
            at = to


def words(raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each lower-cased word, and the first word's index for each row (rows + 1 entries)."""
    low = LOWER[raw]
    solid = ~apart[low]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < len(raw)]
    first[heads] |= solid[heads]
    starts = np.flatnonzero(first)
    rows = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), rows
    where = np.flatnonzero(solid)
    lead = np.flatnonzero(first[where])
    sizes = np.diff(np.append(lead, len(where)))
    within = np.arange(len(where)) - np.repeat(lead, sizes)
    with np.errstate(over="ignore"):
        total = np.add.reduceat(BYTE[low[where]] * _power(int(sizes.max()))[within], lead)
        return mix(total + sizes.astype(np.uint64) * SLOT[15]), rows


def windows(word: np.ndarray, gaps: tuple[int, ...], tag: int) -> np.ndarray:
    """Hash of the words at i + gap for each i where all exist; rows must be cut by the caller."""
    n = len(word) - max(gaps)
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        for k, gap in enumerate(gaps):
            total += word[gap : gap + n] * SLOT[k]
    return mix(total, 100 + tag)


def fold_of(id_col: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % parts


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
