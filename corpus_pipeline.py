"""A corpus pipeline: each stage is one operator whose decisions hold for the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import decontam, mixing, ngramjoin, secretscan, toxicity
from tidemark.llm.ship import ship
from tidemark.session import Scratch, staged


def _row(docs: DataFrame) -> Column:
    """A whole row in one column, so that no column of the documents meets one of a stage."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose `key` is not in `gone` (a column gone). Few keys are joined as a copy, many by a shuffle."""
    gone = staged(gone.distinct(), "gone")
    if gone.count() <= ngramjoin.MOST_BROADCAST:
        gone = F.broadcast(gone)
    return rows.join(gone, F.col(key).eqNullSafe(F.col("gone")), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The model learns from the labels of the documents at hand."""
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select(_row(docs), "text"), model, keep=("row",), score_col="score", predicted_col="toxic")
    return scored.filter("toxic = 0").select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of the n-gram Jaccard join connect, the one with the smallest id stays.

    Rows that share id and text are one document, and one of them stays. Different texts of one id are documents of
    their own; in a group, all but the first text of an id come after every id. Rows without an id stay.
    """
    ship(spark)
    rows = docs.select(_row(docs), F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.filter("id is not null").groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("id").alias("gone"))
    ids = staged(ids, "repeated_ids")
    again = rows.join(ids, F.col("id") == F.col("gone"), "left_semi")
    again = again.groupBy("id", "text").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    first = again.groupBy(F.col("id").alias("_id")).agg(F.min("text").alias("first"))
    further = F.lit(2**62) + F.abs(F.xxhash64("id", "text") % 2**61)
    again = again.join(first, F.col("id") == F.col("_id")).select("row", F.when(F.col("text") == F.col("first"), F.col("id")).otherwise(further).alias("node"), "text")
    nodes = _without(rows, ids, "id").select("row", F.col("id").alias("node"), "text").unionByName(staged(again, "own_ids"))
    classes = ngramjoin.near_duplicates(nodes, id_col="node")
    return _without(nodes, classes.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("gone")), "node").select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, perhaps with other parameters, go. Each row is judged by its own text."""
    own = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    keyed = docs.select(_row(docs), F.struct(F.col("doc_id").alias("id"), own.alias("text")).alias("key"), "text")
    found = decontam.leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    return _without(keyed, found.select(F.col("doc_id").alias("gone")), "key").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts become a mark; n_chars follows. Every document stays."""
    found = secretscan.scan(docs.select(_row(docs), "doc_id", "text"))
    found = found.select("row", F.size("secret_spans") > 0, secretscan.redacted(F.col("text"), F.col("secret_spans"))).toDF("row", "changed", "text")
    held = {c: F.col("row")[c] for c in docs.columns}
    held["text"] = F.col("text")
    if "n_chars" in held:
        held["n_chars"] = F.when(F.col("changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(held["n_chars"])
    return found.select(*[held[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the documents taken, with their texts, once for each time they are taken.

    In the order of `word_end`, then `lap`; see mixing.mixed for the columns that come with those of the documents.
    """
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
]

#: Training a model and comparing sets are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. Once a stage's documents are written, what led to them is removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch()
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
        scratch.clear(keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
