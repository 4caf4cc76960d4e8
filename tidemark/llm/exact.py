"""Vectors as exact integers, and sums of integers over all tasks without rounding."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DecimalType, IntegerType, LongType, StructField, StructType

#: Scaled components saturate here: their squares, summed over a vector, and their sums over all rows stay below 38 digits.
MOST = 2**48
LONG_MAX = 2**63 - 1
#: Below this, distances and short sums of squares fit 64 bits; above it Python integers take over.
NARROW = 2**26

WHOLE = DecimalType(38, 0)
#: One partial sum: of `n` rows of vectors with `size` components, `total` stands at place (`part`, `entry`).
PARTIAL = StructType([StructField("size", IntegerType()), StructField("part", IntegerType()), StructField("entry", IntegerType()), StructField("n", LongType()), StructField("total", ArrayType(WHOLE))])


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int, shift: int = 0, label_col: str | None = None) -> DataFrame:
    """vec_id, (label), size, x: floor(scale * component) + shift of each row whose vector is sound.

    Rows whose vector is null or holds null or non-finite components go. An empty vector stays.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("vec_id"), *([F.col(label_col).alias("label")] if label_col else []), vector.alias("vector"))
    sound = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    held = F.transform("vector", lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("bigint") + shift)
    rows = rows.filter(F.col("vector").isNotNull() & sound)
    return rows.select("vec_id", *(["label"] if label_col else []), F.size("vector").alias("size"), held.alias("x"))


def by_size(part: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, row numbers, integer matrix) for each vector length of a batch; object integers where they are wide."""
    sizes = part.column("size").to_numpy(zero_copy_only=False)
    x = part.column("x")
    flat = np.asarray(x.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
    starts = np.append(0, np.cumsum(sizes))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, flat[(starts[rows][:, None] + np.arange(size)[None, :])]


def wide(x: np.ndarray) -> bool:
    return bool(x.size) and int(np.abs(x).max()) >= NARROW


def partial(size: int, part: int, entry: int, n: int, total) -> dict:
    return {"size": size, "part": part, "entry": entry, "n": int(n), "total": [Decimal(int(v)) for v in total]}


def summed(partials: DataFrame) -> dict[tuple[int, int, int], tuple[int, list[int]]]:
    """(size, part, entry) → (n, totals by position) over the partial sums of all tasks.

    The sums are made on the executors; what comes back has an entry for each place, whatever the number of rows.
    """
    keys = ["size", "part", "entry"]
    counts = {tuple(r[:3]): int(r[3]) for r in partials.groupBy(*keys).agg(F.sum("n")).collect()}
    spread = partials.select(*keys, F.posexplode("total").alias("pos", "v"))
    sums: dict = {k: (n, {}) for k, n in counts.items()}
    for r in spread.groupBy(*keys, "pos").agg(F.sum("v").cast(WHOLE).alias("v")).collect():
        sums[r["size"], r["part"], r["entry"]][1][r["pos"]] = int(r["v"])
    return {k: (n, [at[p] for p in sorted(at)]) for k, (n, at) in sums.items()}
