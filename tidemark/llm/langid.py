"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram's vector binds (multiplies) its letters' vectors, each
rotated by its place; a document's vector bundles (adds) those of its n-grams; a language's prototype bundles
the unit vectors of its documents. The answer is the prototype of the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .text import mix, slices

SCALE = 1 << 20
BLOCK = 4096


@dataclass(frozen=True)
class Profiles:
    """Unit prototypes, a row of `size` 32-bit numbers (4 KB) for each language, whatever the number of rows."""

    size: int
    languages: list[str]
    vectors: np.ndarray


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """The lower-case code point of each letter, 0 for every other code point."""
    global _letters
    if _letters is None:
        _letters = np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 0 for i in range(0x110000)], dtype=np.int32)
    return _letters


def letter_vectors(points: np.ndarray, size: int) -> np.ndarray:
    """A row of +1 and -1 for each code point, made from the code point alone; 0 stands for a gap between words."""
    part = np.arange(size // 64, dtype=np.uint64)
    bits = mix(points.astype(np.uint64)[:, None] * np.uint64(1 << 20) + part[None, :], 21)
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32) * 2 - 1)[:, :size]


def document_vectors(raw: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """The bundle of all letter trigrams of each text, gaps as one letter; zero for a text without a letter."""
    n = len(offsets) - 1
    out = np.zeros((n, size), dtype=np.float32)
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    upto = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
    text = np.insert(letters()[points], upto, 0)
    row = np.repeat(np.arange(n + 1), np.append(np.diff(upto), 0) + 1)
    kept = text != 0
    kept[1:] |= text[:-1] != 0
    kept[0] = True  # the gap before the first word
    text, row = text[kept], row[kept]
    known = np.unique(text)
    place = np.zeros(0x110000, dtype=np.int64)
    place[known] = np.arange(len(known))
    own = place[text]
    mid = np.flatnonzero(text[1:-1] != 0) + 1
    if not len(mid):
        return out
    k = len(known)
    code = (own[mid - 1] * k + own[mid]) * k + own[mid + 1]
    row = row[mid]
    if k <= 100:
        seen = np.zeros(k**3, dtype=bool)
        seen[code] = True
        distinct = np.flatnonzero(seen)
        number = np.zeros(k**3, dtype=np.int64)
        number[distinct] = np.arange(len(distinct))
        column = number[code]
    else:
        distinct, column = np.unique(code, return_inverse=True)
    base = letter_vectors(known, size)
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    for at in range(0, len(distinct), BLOCK):
        grams = distinct[at : at + BLOCK]
        bound = first[grams // (k * k)] * second[grams // k % k] * base[grams % k]
        inside = (column >= at) & (column < at + BLOCK) if len(distinct) > BLOCK else slice(None)
        counts = np.bincount(row[inside] * len(grams) + column[inside] - at, minlength=n * len(grams)).reshape(n, len(grams))
        out += counts.astype(np.float32) @ bound
    return out


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def learn(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang", where: Column | None = None, size: int = 1024) -> Profiles:
    """Prototypes from all rows that satisfy `where` and have a language. Rows without a letter add nothing.

    Each task sends one vector per language it met; they are added in whole numbers, so the order is of no matter.
    """
    rows = df.filter(where) if where is not None else df
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull())

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, raw, offsets in slices(batches):
            vectors = np.rint(unit(document_vectors(raw, offsets, size)) * SCALE).astype(np.int64)
            langs = np.array(part.column("lang").to_pylist())
            for lang in np.unique(langs):
                sums[lang] = sums.get(lang, 0) + vectors[langs == lang].sum(axis=0)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["lang", "total"])

    parts = rows.mapInArrow(bundle, "lang string, total array<bigint>")
    each = parts.select("lang", F.posexplode("total").alias("at", "v")).groupBy("lang", "at").agg(F.sum("v").alias("v"))
    whole = each.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("vs")).select("lang", F.transform("vs", lambda x: x["v"]).alias("v"))
    got = whole.orderBy("lang").collect()
    vectors = np.array([r["v"] for r in got], dtype=np.float64).reshape(len(got), size)
    return Profiles(size, [r["lang"] for r in got], unit(vectors).astype(np.float32))


def predict(df: DataFrame, profiles: Profiles, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1), a row for each input row; only the text enters.

    `und` and 0 for a null text, one without a letter, or when no language was learned. Of equal cosines the
    language first in code point order wins.
    """
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([cols.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    held = df.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        for part, raw, offsets in slices(batches):
            n = part.num_rows
            names, scores = ["und"] * n, np.zeros(n)
            if p.languages:
                vectors = document_vectors(raw, offsets, p.size)
                cosines = unit(vectors) @ p.vectors.T
                best = cosines.argmax(axis=1)
                lettered = vectors.any(axis=1)
                scores = np.where(lettered, np.clip(cosines[np.arange(n), best], 0.0, 1.0), 0.0).astype(float)
                names = [p.languages[b] if ok else "und" for b, ok in zip(best, lettered)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return cols.mapInArrow(run, schema)
