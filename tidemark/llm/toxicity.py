"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training is one ordered pass after another over a bounded sample of labelled rows, because FTRL updates its
weights after every row. Scoring runs over all rows with the few weights that the L1 term leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .text import PUNCTUATION, fold_of, narrow, slices, windows, words


#: The bias of a model that has seen no example of label 1.
NEVER = -35.0


@dataclass(frozen=True)
class Settings:
    """alpha and beta set the rate alpha / (beta + sqrt(sum of squared gradients)) of each coordinate; l1 is the
    pull to zero. At most about `sample_rows` labelled rows are learned from: those of the smallest crc32. They end
    where they hold `sample_features` features together (4 bytes each), which long texts may reach earlier."""

    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    passes: int = 2
    sample_rows: int = 16_000
    sample_features: int = 60_000_000


@dataclass(frozen=True)
class Model:
    """Non-zero weights by feature number, in order; at most 2**bits of them."""

    bits: int
    bias: float
    features: np.ndarray
    weights: np.ndarray


def features(raw: np.ndarray, offsets: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each row the distinct numbers of its words, word pairs, word triples and pairs with one word between."""
    word, rows = words(raw, offsets, PUNCTUATION)
    mask = np.uint64((1 << bits) - 1)
    out = []
    for a, b in zip(rows[:-1], rows[1:]):
        own = word[a:b]
        made = [own, windows(own, (0, 1), 1), windows(own, (0, 1, 2), 2), windows(own, (0, 2), 3)]
        out.append(np.unique((np.concatenate(made) & mask).astype(np.int64)))
    return out


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def ftrl(rows: list[tuple[np.ndarray, int]], s: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, feature numbers, weights) after `passes` over the rows in their order.

    The bias is not pulled to zero: it carries how rare the label is. Without a row of label 1 nothing can be
    called toxic, and the score is that of NEVER.
    """
    size = 1 << s.bits
    if not any(label for _, label in rows):
        return NEVER, np.zeros(0, dtype=np.int64), np.zeros(0)
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    pull = np.full(size + 1, s.l1)
    pull[size] = 0.0

    def weight(i):
        zi, li = z[i], pull[i]
        w = -(zi - np.sign(zi) * li) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)
        return np.where(np.abs(zi) <= li, 0.0, w)

    bias = np.array([size])
    for _ in range(s.passes):
        for feats, label in rows:
            i = np.concatenate([feats, bias])
            w = weight(i)
            g = float(sigmoid(w.sum())) - label
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / s.alpha * w
    kept = np.flatnonzero(np.abs(z[:size]) > s.l1)
    return float(weight(bias)[0]), kept, weight(kept)


def fit(df: DataFrame, labels: DataFrame, s: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out_parts: int = 5) -> Model:
    """Learn from rows whose crc32(id) mod `held_out_parts` is not 0 and whose label is 0 or 1.

    A row with a null id or label is no example. An id with several labels counts as 1 if any is 1. Ids that
    repeat in `df` give one example each. Without an example of label 1 every score is next to 0.
    """
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        (fold_of("doc_id", held_out_parts) != 0) & F.col("label").isin(0, 1))
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("turn", F.crc32(F.concat(F.lit("order:"), F.col("doc_id").cast("string")).cast("binary")))
    total = marks.count()
    if total > s.sample_rows:
        marks = marks.filter(F.col("turn") < int(2**32 * s.sample_rows / total))
    # About sample_rows rows of 24 bytes, whatever the tables hold: small enough for each executor.
    chosen = narrow(df, id_col, text_col).join(F.broadcast(marks), "doc_id").select("doc_id", "text", "label", "turn")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for part, raw, offsets in slices(batches):
            each = features(raw, offsets, s.bits)
            ends = np.cumsum([len(f) for f in each])
            fits = int(np.searchsorted(ends, s.sample_features - held, side="right"))
            if fits and held < s.sample_features:
                # One block of numbers for each piece: small arrays would leave the worker's memory in shreds.
                block = np.concatenate(each[:fits]).astype(np.int32)
                rows += zip(np.split(block, ends[: fits - 1]), part.column("label").to_pylist())
            held += int(ends[-1]) if len(ends) else 0
        bias, kept, weights = ftrl(rows, s)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(kept, -1)), pa.array(np.append(weights, bias))], names=["feature", "weight"])

    learned = chosen.repartition(1).sortWithinPartitions("turn", "doc_id", "text").mapInArrow(learn, "feature long, weight double").toPandas()
    kept = learned[learned.feature >= 0].sort_values("feature")
    bias = learned[learned.feature < 0].weight
    return Model(s.bits, float(bias.iloc[0]) if len(bias) else NEVER, kept.feature.to_numpy(np.int64), kept.weight.to_numpy(float))


def score(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """The columns of `keep` (the id where none are named), score (0 to 1) and predicted (1 from 0.5 on), one row
    for each input row. The two result columns need names that `keep` does not hold.

    A null or empty text has the bias alone. Only the text enters the score.
    """
    dense = np.zeros(1 << model.bits, dtype=np.float32)
    dense[model.features] = model.weights
    held = df.sparkSession.sparkContext.broadcast((dense, model.bias))
    bits = model.bits
    kept = list(keep or (id_col,))
    cols = df.select(F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    own = cols.schema["row"].dataType.fields
    schema = StructType([*own, StructField(score_col, DoubleType()), StructField(predicted_col, IntegerType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = held.value
        for part, raw, offsets in slices(batches):
            p = sigmoid(np.array([bias + table[f].sum(dtype=np.float64) for f in features(raw, offsets, bits)]))
            yield pa.RecordBatch.from_arrays([*part.column("row").flatten(), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=names)

    return cols.mapInArrow(run, schema)
