"""Compression of vectors to codes: one codebook for each of several equal parts, in exact integers.

Lloyd's rounds keep with every part its entry and the exact distance to it. An update marks the entries it moved.
In the next round a part whose own entry stayed compares only the moved ones against the stored distance: nothing
else can have come nearer. A part whose own entry moved is compared with all. Equal distances go to the lower index
both ways, so the codes are those of a full scan.

The rows and their state are written once a round, together with the task's partial sums; the table before goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..session import discard, staged
from .exact import LONG_MAX, PARTIAL, by_size, integers, partial, summed, wide


@dataclass(frozen=True)
class Settings:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


def cut(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows of n components to (rows, parts, width); a length that the parts do not divide is filled up with zeros."""
    width = -(-x.shape[1] // parts)
    full = np.zeros((len(x), parts * width), dtype=x.dtype)
    full[:, : x.shape[1]] = x
    return full.reshape(len(x), parts, width)


def _squares(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    apart = x[:, None, :] - words[None, :, :]
    return (apart * apart).sum(2)


def reassign(x: np.ndarray, words: np.ndarray, codes: np.ndarray | None, stored: np.ndarray | None, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(codes, exact distances, comparisons made) of one part position.

    `codes` and `stored` are those of the round before, or None at first. A stored distance of LONG_MAX did not fit
    and is not relied on.
    """
    if wide(x) or wide(words):
        x, words = x.astype(object), words.astype(object)
    n, k = len(x), len(words)
    fresh = np.ones(n, dtype=bool) if codes is None else moved[codes] | (stored == LONG_MAX)
    out = np.zeros(n, dtype=np.int64) if codes is None else codes.copy()
    best = np.zeros(n, dtype=x.dtype) if codes is None else stored.astype(x.dtype)
    if fresh.any():
        d = _squares(x[fresh], words)
        out[fresh] = d.argmin(1)
        best[fresh] = d.min(1)
    active = np.flatnonzero(moved)
    rest = np.flatnonzero(~fresh)
    if len(active) and len(rest):
        d = _squares(x[rest], words[active])
        near = d.argmin(1)
        least = d[np.arange(len(rest)), near]
        entry = active[near]
        better = (least < best[rest]) | ((least == best[rest]) & (entry < out[rest]))
        out[rest[better]] = entry[better]
        best[rest[better]] = least[better]
    return out, np.minimum(best, LONG_MAX).astype(np.int64), int(fresh.sum()) * k + len(rest) * len(active)


def books_hash(book: np.ndarray) -> str:
    """Of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for v in book.reshape(-1).tolist()).encode()).hexdigest()


def _first(rows: DataFrame, s: Settings) -> dict[int, np.ndarray]:
    """The codebooks of the rows with the smallest ids, (parts, entries, width) for each vector length."""
    order = W.partitionBy("size").orderBy(F.col("vec_id").asc_nulls_last(), "x")
    got: dict[int, list] = {}
    for r in rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= s.entries).orderBy("size", "_rank").collect():
        got.setdefault(r["size"], []).append(r["x"])
    return {size: cut(np.array(x, dtype=np.int64).reshape(len(x), size), s.parts).transpose(1, 0, 2) for size, x in got.items()}


def _updated(books: dict[int, np.ndarray], sums: dict) -> tuple[dict, dict]:
    """(new codebooks, moved marks): componentwise floor of the mean; an unused entry stays."""
    new = {size: b.copy() for size, b in books.items()}
    for (size, p, e), (n, total) in sums.items():
        if n:
            new[size][p, e] = [t // n for t in total]
    return new, {size: (new[size] != books[size]).any(axis=2) for size in books}


def compress(df: DataFrame, s: Settings = Settings(), *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: a row for each row with a sound vector.

    Rows whose vector is null or holds null or non-finite components go; other columns are not read. Ids order the
    first codebooks (nulls last, then the vector), and rows that repeat are rows of their own. Vectors of one length
    share codebooks; a length that `parts` does not divide is filled up with zeros, and an empty vector has code 0 in
    every part with error 0. With fewer rows than entries the codebook is smaller. Integers beyond 2^48 and errors
    beyond a long stay at that bound.
    """
    spark = df.sparkSession
    rows = staged(integers(df, id_col, vector_col, s.scale, label_col=label_col), "vectors")
    books = _first(rows, s)
    moved = {size: np.ones(b.shape[:2], dtype=bool) for size, b in books.items()}
    fields = list(rows.schema.fields)
    state_schema = StructType([*fields, StructField("codes", ArrayType(IntegerType())), StructField("stored", ArrayType(LongType())), StructField("partial", PARTIAL)])
    final_schema = StructType([rows.schema["vec_id"], rows.schema["label"], StructField("code", StringType()), StructField("error", LongType()), StructField("codebooks_sha256", StringType())])
    arrow_state = to_arrow_schema(state_schema)

    def assign(part: pa.RecordBatch, held: dict, marks: dict, known: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(size, row numbers, parts, codes, distances) for each vector length of a batch."""
        before = [np.array(part.column(c).flatten().to_numpy(zero_copy_only=False)).reshape(-1, s.parts) for c in ("codes", "stored")] if known else None
        for size, at, x in by_size(part):
            cells = cut(x, s.parts)
            codes = np.zeros((len(at), s.parts), dtype=np.int64)
            far = np.zeros((len(at), s.parts), dtype=np.int64)
            for p in range(s.parts):
                old = (before[0][at, p].astype(np.int64), before[1][at, p]) if known else (None, None)
                codes[:, p], far[:, p], _ = reassign(cells[:, p], held[size][p], *old, marks[size][p])
            yield size, at, cells, codes, far

    def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * s.parts, pa.int32()), pa.array(rows.reshape(-1), kind))

    def step(shared, known: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, marks = shared.value
            sums: dict = {}
            for batch in batches:
                for start in range(0, batch.num_rows, 2048):
                    part = batch.slice(start, 2048)
                    all_codes = np.zeros((part.num_rows, s.parts), dtype=np.int64)
                    all_far = np.zeros((part.num_rows, s.parts), dtype=np.int64)
                    for size, at, cells, codes, far in assign(part, held, marks, known):
                        all_codes[at], all_far[at] = codes, far
                        exact = cells.astype(object) if wide(cells) else cells
                        for p in range(s.parts):
                            for e in np.unique(codes[:, p]):
                                mine = exact[codes[:, p] == e, p]
                                n, total = sums.get((size, p, int(e)), (0, 0))
                                sums[size, p, int(e)] = n + len(mine), total + mine.sum(0).astype(object)
                    first = [part.column(f.name) for f in fields]
                    yield pa.RecordBatch.from_arrays([*first, lists(all_codes, pa.int32()), lists(all_far, pa.int64()), pa.nulls(part.num_rows, arrow_state.field("partial").type)], schema=arrow_state)
            places = [partial(*key, n, total) for key, (n, total) in sums.items()]
            for start in range(0, len(places), 1024):
                some = pa.array(places[start : start + 1024], arrow_state.field("partial").type)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(some), f.type) for f in list(arrow_state)[:-1]), some], schema=arrow_state)

        return run

    def last(shared, known: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, marks = shared.value
            hashes = {size: books_hash(b) for size, b in held.items()}
            for batch in batches:
                for start in range(0, batch.num_rows, 2048):
                    part = batch.slice(start, 2048)
                    code, error, books_of = [""] * part.num_rows, [0] * part.num_rows, [""] * part.num_rows
                    for size, at, _, codes, far in assign(part, held, marks, known):
                        for i, c, d in zip(at.tolist(), codes.tolist(), far.tolist()):
                            code[i], error[i], books_of[i] = "".join(f"{v:02x}" for v in c), min(sum(d), LONG_MAX), hashes[size]
                    yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64()), pa.array(books_of, pa.string())], names=final_schema.names)

        return run

    state, known = rows, False
    for _ in range(s.rounds):
        if known and not any(m.any() for m in moved.values()):
            break  # nothing moved, so every further round gives the same
        written = staged(state.mapInArrow(step(spark.sparkContext.broadcast((books, moved)), known), state_schema), "vector_codes")
        discard(state)
        books, moved = _updated(books, summed(written.filter("partial is not null").select("partial.*")))
        state, known = written.filter("partial is null").drop("partial"), True
    coded = staged(state.mapInArrow(last(spark.sparkContext.broadcast((books, moved)), known), final_schema), "vector_errors")
    discard(state)
    by_label = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX)).cast("bigint").alias("label_error"))
    by_label = by_label.withColumnRenamed("label", "_label")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
