"""Completeness reports that take up where the last one stopped.

A report holds one row and what it found lost, as merged ranges. The next one reads from the oldest loss, or from four
days before the newest block tested, whichever is lower; below that everything was found whole and is carried over, so
its row is that of a test of the whole table. The bound is a literal: older files are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ...operators.joins import int_range
from ...operators.windows import group_by_marker, lag_gap

#: Blocks whose numbers tested are carried as one count, and ids of one window task.
BUCKET = 10_000
RECENT = "interval 96 hours"


@dataclass(frozen=True)
class Report:
    """`row`: the report. `lost`: ranges lost_from … lost_to. `tested`: blocks tested in each bucket of ids."""

    row: DataFrame
    lost: DataFrame
    tested: DataFrame


def merged_ranges(rows: DataFrame, bucket: int = BUCKET, **sums: Column) -> DataFrame:
    """lost_from, lost_to, n: runs of consecutive block_id, each row one id."""
    chunk = F.expr(f"block_id div {bucket}")
    gaps = lag_gap(rows.withColumn("_one", F.lit(1)), ["_one"], "block_id", chunk=chunk)
    marked = group_by_marker(gaps, ["_one"], ["block_id"], F.coalesce(F.col("gap") > 1, F.lit(True)), "_run", chunk=chunk)
    return marked.groupBy("_run").agg(F.min("block_id").alias("lost_from"), F.max("block_id").alias("lost_to"), F.count(F.lit(1)).alias("n"), *[v.alias(k) for k, v in sums.items()]).drop("_run")


def lost_ids(lost: DataFrame) -> DataFrame:
    """missing_id: the ids of the ranges, one by one."""
    return int_range(lost, F.col("lost_from"), F.col("lost_to") - F.col("lost_from") + 1, "missing_id").select("missing_id")


def scope_start(blocks: DataFrame, last: Report | None, bucket: int = BUCKET) -> int | None:
    """The block from which the next report reads; None for all. It begins a bucket, as those are counted whole."""
    if last is None:
        return None
    row, lost = last.row.first(), last.lost.agg(F.min("lost_from").alias("m")).first()["m"]
    if row["max_block"] is None:
        return None
    newest = F.lit(row["max_block_timestamp"]) - F.expr(RECENT)
    recent = blocks.filter(F.col("block_timestamp") >= newest).agg(F.min("block_id").alias("m")).first()["m"]
    low = min(x for x in (recent, row["max_block"], None if lost is None else lost - 1) if x is not None)
    return low // bucket * bucket


def _older_than(blocks: DataFrame, as_of, hours: int) -> DataFrame:
    return blocks.filter(F.col("block_timestamp") < F.lit(as_of) - F.expr(f"interval {hours} hours"))


def _counted(rows: DataFrame, start: int | None, last: Report | None, bucket: int) -> DataFrame:
    """Blocks tested in each bucket: below the scope those of the last report."""
    per = [F.count(F.lit(1)).alias("n"), F.min("block_id").alias("lo"), F.max("block_id").alias("hi"), F.min("block_timestamp").alias("lo_time"), F.max("block_timestamp").alias("hi_time")]
    now = rows.groupBy(F.expr(f"block_id div {bucket}").alias("bucket")).agg(*per)
    return now if start is None else now.unionByName(last.tested.filter(F.col("bucket") < start // bucket))


def _ends(tested: DataFrame) -> list[Column]:
    return [F.min("lo").alias("min_block"), F.max("hi").alias("max_block"), F.min("lo_time").alias("min_block_timestamp"), F.max("hi_time").alias("max_block_timestamp")]


def _beside(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two aggregates of one row each as one row."""
    return one.withColumn("_k", F.lit(1)).join(other.withColumn("_k", F.lit(1)), "_k").drop("_k")


def blocks_report(blocks: DataFrame, as_of, last: Report | None = None, bucket: int = BUCKET) -> Report:
    """Ids missing between the first and the last block that is a day old."""
    start = scope_start(blocks, last, bucket)
    rows = _older_than(blocks, as_of, 24).select("block_id", "block_timestamp")
    rows = (rows if start is None else rows.filter(F.col("block_id") >= start)).groupBy("block_id").agg(F.min("block_timestamp").alias("block_timestamp"))
    # The scope's first gap begins at the last block below it, which the last report found.
    edge = None if start is None else last.tested.filter(F.col("bucket") < start // bucket).agg(F.max("hi").alias("m")).first()["m"]
    ids = rows.select(F.lit(1).alias("_one"), "block_id")
    if edge is not None:
        ids = ids.unionByName(ids.sparkSession.range(edge, edge + 1).select(F.lit(1).alias("_one"), F.col("id").alias("block_id")))
    gaps = lag_gap(ids, ["_one"], "block_id", chunk=F.expr(f"block_id div {bucket}")).filter("gap > 1")
    lost = gaps.select((F.col("prev_block_id") + 1).alias("lost_from"), (F.col("block_id") - 1).alias("lost_to")).withColumn("n", F.col("lost_to") - F.col("lost_from") + 1)
    tested = _counted(rows, start, last, bucket)
    impacted = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("blocks_impacted_count"), F.count(F.lit(1)).alias("lost_ranges"))
    row = _beside(tested.agg(*_ends(tested), F.sum("n").alias("_n")), impacted).select(
        F.lit("blocks").alias("test_name"), "min_block", "max_block", "min_block_timestamp", "max_block_timestamp", (F.col("_n") + F.col("blocks_impacted_count")).alias("blocks_tested"), "blocks_impacted_count", "lost_ranges", F.lit(as_of).alias("test_timestamp"))
    return Report(row, lost, tested)


def transactions_report(txs: DataFrame, metas: DataFrame, as_of, last: Report | None = None, bucket: int = BUCKET) -> Report:
    """Blocks half a day old whose own number of transactions (block_id, block_timestamp, num_txs) is not that stored."""
    start = scope_start(metas, last, bucket)
    told = _older_than(metas, as_of, 12).select("block_id", "block_timestamp", "num_txs")
    told = told if start is None else told.filter(F.col("block_id") >= start)
    have = txs if start is None else txs.filter(F.col("block_id") >= start)
    have = have.select("block_id", "tx_id").distinct().groupBy(F.col("block_id").alias("_id")).agg(F.count(F.lit(1)).alias("_have"))
    rows = told.join(have, F.col("block_id") == F.col("_id"), "left").withColumn("diff", F.coalesce("_have", F.lit(0)) - F.col("num_txs"))
    lost = merged_ranges(rows.filter("diff <> 0").select("block_id", "diff"), bucket, transactions=F.sum(F.abs("diff")))
    tested = _counted(rows, start, last, bucket)
    impacted = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("blocks_impacted_count"), F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions_impacted_count"), F.count(F.lit(1)).alias("lost_ranges"))
    row = _beside(tested.agg(*_ends(tested), F.sum("n").alias("blocks_tested")), impacted).select(
        F.lit("transactions").alias("test_name"), "min_block", "max_block", "min_block_timestamp", "max_block_timestamp", "blocks_tested", "blocks_impacted_count", "transactions_impacted_count", "lost_ranges", F.lit(as_of).alias("test_timestamp"))
    return Report(row, lost, tested)
