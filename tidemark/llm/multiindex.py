"""Near-duplicate vectors by an inverted multi-index.

Each half of a unit vector has a codebook of its own; the pairs of codewords are the cells of a grid. A vector
visits cells in the order of the least distance that a vector of the cell can have, until the recall target is
reached (`visit_limit`). Vectors in the visited cells are compared in double precision.

A cell's rows are cut into blocks; a block is held in memory while the visitors stream past it. Blocks give link
counts and a few links that keep the same parts connected, never all pairs. Equal vectors are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged
from .graph import components

BLOCK = 2048


@dataclass(frozen=True)
class Settings:
    """`cell_rows`: wanted mean of rows per cell, which sets the codebooks' size. The codebooks are fitted on at
    most about `sample_rows` vectors, those of the smallest crc32(id); every vector is indexed and compared.
    `recall`: the target at which a traversal ends; 1 visits all cells that can hold a link."""

    cosine: float = 0.98
    cell_rows: int = 200
    most_words: int = 512
    sample_rows: int = 20_000
    passes: int = 8
    recall: float = 0.999


def units(rows: list, size: int) -> np.ndarray:
    x = np.array(rows, dtype=np.float64).reshape(len(rows), size)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of rows to codewords."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)[None, :], 0.0)


def codebook(x: np.ndarray, k: int, passes: int) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows of x; a codeword without rows stays where it is."""
    words = np.unique(x, axis=0)
    words = words[np.linspace(0, len(words) - 1, min(k, len(words))).astype(int)].copy()
    for _ in range(passes):
        near = distances(x, words).argmin(1)
        counts = np.bincount(near, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, near, x)
        words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], words)
    return words


def bounds(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword, squared least distance from each row to anything nearest to each codeword).

    Whatever is nearer to codeword c than to the row's own codeword a lies beyond the plane between a and c.
    """
    d = distances(x, words)
    own = d.argmin(1)
    between = np.sqrt(distances(words, words))[own]
    with np.errstate(divide="ignore", invalid="ignore"):
        gap = (d - d[np.arange(len(x)), own][:, None]) / (2 * between)
    gap[~np.isfinite(gap)] = 0.0
    return own, np.maximum(gap, 0.0) ** 2


def multi_sequence(first: np.ndarray, second: np.ndarray, limit: float) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) with first[i] + second[j] <= limit, by ascending staircase over both sorted lists."""
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    sorted_second = second[by_second]
    for i in by_first:
        if first[i] > limit:
            return
        for j in by_second[: int(np.searchsorted(sorted_second, limit - first[i], side="right"))]:
            yield int(i), int(j)


def visit_limit(size: int, s: Settings) -> float:
    """The squared least distance up to which cells are visited.

    Linked unit vectors are at most sqrt(2 - 2 * cosine) apart. If the difference has no preferred direction, its
    part across one plane per half is that of two of `size` directions: the squares' sum passes the limit with
    probability exp(-limit * size / (2 * distance ** 2)), which is set to 1 - recall.
    """
    most = 2 - 2 * s.cosine
    return (most if s.recall >= 1 else min(most, -2 * np.log(1 - s.recall) * most / size)) + 1e-9


def near_duplicates(df: DataFrame, s: Settings = Settings(), *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each input row.

    Linked: equal labels that are not null, equal lengths, cosine of `cosine` or more. Null, empty and zero
    vectors, and such with null or non-finite components, link with nothing; so does a null id, whose
    component is null. Rows that repeat are vectors of their own that link with each other; they should have
    ids of their own, as rows of one id are one node of the links.
    """
    spark = df.sparkSession
    vector = F.col(vector_col) if df.schema[vector_col].dataType.simpleString() == "array<float>" else F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), vector.alias("vector"))
    sound = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    good = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & sound & F.exists("vector", lambda v: v != 0))
    classes = staged(good.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")).withColumn("size", F.size("vector")), "vectors")

    total = classes.count()
    chosen = classes if total <= s.sample_rows else classes.filter(F.crc32(F.col("node").cast("string").cast("binary")) < int(2**32 * s.sample_rows / total))
    sample = chosen.select("size", "vector").orderBy("node").collect()
    k = int(np.clip(np.sqrt(total / s.cell_rows), 1, s.most_words))
    books: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in sorted({r["size"] for r in sample}):
        x = units([r["vector"] for r in sample if r["size"] == size], size)
        half = size // 2
        books[size] = codebook(x[:, :half], k, s.passes), codebook(x[:, half:], k, s.passes)
    held = spark.sparkContext.broadcast(books)  # at most 2 * most_words codewords for each vector length met
    limits = {size: visit_limit(size, s) for size in books}

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for the home cell (role 0) and one for each further cell to visit (role 1). Of two cells the one
        with the larger number is visited from the other, so a pair meets once."""
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes = part.column("size").to_numpy()
                vectors = part.column("vector").to_pylist()
                take, cell, role = [], [], []
                for size in np.unique(sizes):
                    own = np.flatnonzero(sizes == size)
                    if int(size) not in held.value:  # a length that the sample lacks: one cell
                        take += own.tolist()
                        cell += [0] * len(own)
                        role += [0] * len(own)
                        continue
                    one, two = held.value[int(size)]
                    x = units([vectors[i] for i in own], int(size))
                    a, first = bounds(x[:, : int(size) // 2], one)
                    b, second = bounds(x[:, int(size) // 2 :], two)
                    for r, i in enumerate(own):
                        home = int(a[r]) * len(two) + int(b[r])
                        take.append(int(i))
                        cell.append(home)
                        role.append(0)
                        for p, q in multi_sequence(first[r], second[r], limits[int(size)]):
                            if p * len(two) + q > home:
                                take.append(int(i))
                                cell.append(p * len(two) + q)
                                role.append(1)
                out = part.take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell, pa.int64()), pa.array(role, pa.int32())], names=[*out.schema.names, "cell", "role"])

    visits = classes.mapInArrow(cells, ", ".join(f"{n} {t}" for n, t in classes.dtypes) + ", cell bigint, role int")
    visits = visits.withColumn("own_block", F.pmod(F.xxhash64("node"), F.lit(1 << 40)))
    homes = visits.filter("role = 0").groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / (BLOCK // 2)).alias("blocks"))
    visits = visits.join(homes, ["label", "size", "cell"])  # a cell without rows is visited for nothing
    own = F.col("own_block") % F.col("blocks")
    # Home rows join their own block and visit the blocks after it; visitors visit all blocks of the cell.
    visits = visits.withColumn("block", F.explode(F.sequence(F.when(F.col("role") == 0, own).otherwise(F.lit(0)), F.col("blocks") - 1)))
    visits = visits.withColumn("role", F.when((F.col("role") == 0) & (F.col("block") == own), 0).otherwise(1))
    dealt = visits.select("label", "size", "cell", "block", "role", "node", "n", "vector").repartition("label", "size", "cell", "block").sortWithinPartitions("label", "size", "cell", "block", "role", "node")
    least = s.cosine

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, n) adds n links; (node, other) is a link that was found."""
        key, block = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "size", "cell", "block"))))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for at, to in zip(cuts[:-1], cuts[1:]):
                if at == to:
                    continue
                if keys[at] != key:
                    if block is not None:
                        yield from block.close()
                    key, block = keys[at], Block(least)
                part = batch.slice(at, to - at)
                homes_here = int((part.column("role").to_numpy() == 0).sum())
                for lo, hi in ((0, homes_here), (homes_here, to - at)):
                    for start in range(lo, hi, 1024):
                        piece = part.slice(start, min(1024, hi - start))
                        x = units(piece.column("vector").to_pylist(), key[1])
                        yield from block.add(piece.column("node").to_numpy(), piece.column("n").to_numpy(), x, lo == 0 and hi == homes_here)
        if block is not None:
            yield from block.close()

    found = staged(dealt.mapInArrow(compare, "node bigint, other bigint, n bigint"), "vector_links")
    counts = found.filter("other is null").groupBy("node").agg(F.sum("n").alias("met"))
    reached = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    per_class = classes.select("label", "vector", "node", "n").join(counts, "node", "left").join(reached, "node", "left")
    per_class = per_class.select(F.col("label").alias("_label"), F.col("vector").alias("_vector"), (F.coalesce("met", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "node").alias("reached"))
    joined = rows.join(per_class, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("reached", "vec_id")
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


class Block:
    """The home rows of one block, their link counts and which of them are known to be connected."""

    def __init__(self, least: float):
        self.least = least
        self.nodes = np.zeros(0, dtype=np.int64)
        self.weights = np.zeros(0, dtype=np.int64)
        self.links = np.zeros(0, dtype=np.int64)
        self.part = np.zeros(0, dtype=np.int64)
        self.rows: np.ndarray | None = None

    def add(self, nodes: np.ndarray, weights: np.ndarray, x: np.ndarray, home: bool) -> Iterator[pa.RecordBatch]:
        near = x @ self.rows.T >= self.least if self.rows is not None else np.zeros((len(x), 0), dtype=bool)
        self.links += weights @ near
        links = near @ self.weights
        edges = []
        for r in np.flatnonzero(near.any(axis=1)):
            met = near[r]
            parts = np.unique(self.part[met])
            if len(parts) > 1:
                self.part[np.isin(self.part, parts)] = parts[0]
            edges.append((int(nodes[r]), int(self.nodes[np.argmax(met)])))
        if home:
            inner = x @ x.T >= self.least
            np.fill_diagonal(inner, False)
            base = len(self.nodes)
            self.nodes = np.append(self.nodes, nodes)
            self.weights = np.append(self.weights, weights)
            self.links = np.append(self.links, links + inner @ weights)
            self.part = np.append(self.part, base + np.arange(len(nodes)))
            self.rows = x if self.rows is None else np.vstack([self.rows, x])
            for r in np.flatnonzero(inner.any(axis=1)):
                parts = np.unique(np.append(self.part[base:][inner[r]], self.part[base + r]))
                if len(parts) > 1:
                    self.part[np.isin(self.part, parts)] = parts[0]
            counts = np.zeros(0, dtype=np.int64)
            nodes = nodes[:0]
        else:
            counts = links
        yield self._rows(nodes[counts > 0], counts[counts > 0], edges)

    def close(self) -> Iterator[pa.RecordBatch]:
        apart = np.flatnonzero(self.part != np.arange(len(self.part)))
        some = self.links > 0
        yield self._rows(self.nodes[some], self.links[some], [(int(self.nodes[i]), int(self.nodes[self.part[i]])) for i in apart])

    @staticmethod
    def _rows(nodes: np.ndarray, counts: np.ndarray, edges: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([*nodes.tolist(), *(a for a, _ in edges)], pa.int64()), pa.array([*[None] * len(nodes), *(b for _, b in edges)], pa.int64()),
            pa.array([*counts.tolist(), *[0] * len(edges)], pa.int64())], names=["node", "other", "n"])
