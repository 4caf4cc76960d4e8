"""Hourly metrics and completeness reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.coins import BASE_DENOM, coin_amount
from ...operators import increments as inc
from ...operators.aggregates import distinct_counts, ordered_arrays
from ...operators.joins import missing_between
from ...operators.windows import ffill, lag_gap
from ..audit import keyed
from .attrs import STAMP

HOUR = "block_timestamp_hour"
# fee amounts are in millionths of the chain coin
FEE_SCALE = 10**6


def _hour() -> Column:
    return F.date_trunc("hour", F.col("block_timestamp")).cast("timestamp_ntz").alias(HOUR)


def recomputed_from(source: DataFrame, stored: DataFrame):
    """First hour that rows newer than the stored table touch; hours from there on are recomputed whole."""
    new = inc.newer_than(source, STAMP, inc.high_water(stored, STAMP))
    return new.agg(F.date_trunc("hour", F.min("block_timestamp")).alias("m")).first()["m"]


def block_metrics(chain_blocks: DataFrame, as_of, since=None) -> DataFrame:
    """Blocks per closed hour."""
    rows = inc.closed_hours(chain_blocks, "block_timestamp", F.lit(as_of))
    rows = rows if since is None else rows.filter(F.col("block_timestamp") >= F.lit(since))
    out = rows.groupBy(_hour()).agg(F.min("block_id").alias("block_number_min"), F.max("block_id").alias("block_number_max"), F.count(F.lit(1)).alias("block_count"), F.max(STAMP).alias(STAMP))
    return keyed(out, "core_metrics_block_hourly_id", HOUR)


def transaction_metrics(txs: DataFrame, as_of, since=None) -> DataFrame:
    """Transactions, outcomes, distinct senders and fees per closed hour.

    Both distinct counts fold to one row per (hour, entity) first, so an hour or sender with a large
    share of the rows is combined map-side and spread.
    """
    rows = inc.closed_hours(txs, "block_timestamp", F.lit(as_of))
    rows = (rows if since is None else rows.filter(F.col("block_timestamp") >= F.lit(since))).withColumn(HOUR, _hour())
    counts = distinct_counts(rows, [HOUR], "tx_id", transaction_count_success=F.col("tx_succeeded"), transaction_count_failed=~F.col("tx_succeeded"))
    senders = distinct_counts(rows, [HOUR], "tx_from")
    fee = coin_amount(F.regexp_replace("fee", "^[^0-9]+", ""))
    sums = rows.groupBy(HOUR).agg((F.sum(fee).cast("double") / FEE_SCALE).alias("total_fees"), F.max(STAMP).alias(STAMP))
    out = sums.join(counts, HOUR, "left").join(senders, HOUR, "left").select(
        HOUR, F.coalesce("n_tx_id", F.lit(0)).alias("transaction_count"), F.coalesce("transaction_count_success", F.lit(0)).alias("transaction_count_success"),
        F.coalesce("transaction_count_failed", F.lit(0)).alias("transaction_count_failed"), F.coalesce("n_tx_from", F.lit(0)).alias("unique_from_count"), "total_fees", STAMP)
    return keyed(out, "core_metrics_hourly_id", HOUR)


def ez_core_metrics(per_block: DataFrame, per_tx: DataFrame, prices: DataFrame) -> DataFrame:
    """Both tables per hour with fees in USD at the last known price."""
    native = prices.filter(F.col("token_address") == BASE_DENOM).select(F.col("hour").alias(HOUR), "price")
    priced = per_tx.join(native, HOUR, "left").withColumn("_one", F.lit(1))
    filled = ffill(priced, ["_one"], [HOUR], F.col("price"), "_close", chunk=F.to_date(HOUR))
    txs = filled.select(HOUR, "transaction_count", "transaction_count_success", "transaction_count_failed", "unique_from_count", F.col("total_fees").alias("total_fees_native"),
                        F.round(F.col("total_fees") * F.col("_close"), 2).alias("total_fees_usd"))
    blocks = per_block.select(HOUR, "block_number_min", "block_number_max", "block_count", F.col("core_metrics_block_hourly_id").alias("ez_core_metrics_hourly_id"))
    return blocks.join(txs, HOUR)


# --- completeness ---------------------------------------------------------------------------------


def missing_blocks(chain_blocks: DataFrame, width: int = 100_000) -> DataFrame:
    """Every missing id between two present ones, with its neighbours."""
    ids = chain_blocks.select(F.lit(1).alias("_one"), "block_id").distinct()
    gaps = lag_gap(ids, ["_one"], "block_id", chunk=F.expr(f"block_id div {width}")).filter("gap > 1")
    return missing_between(gaps, "prev_block_id", "block_id", "missing_id").select("missing_id", "prev_block_id", "block_id")


def blocks_completeness(chain_blocks: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Summary row and the list of missing blocks, over blocks older than a day.

    The published report keeps the ids in one array; here they are rows of a second table, which stays
    whole whatever its length.
    """
    old = chain_blocks.filter(F.col("block_timestamp") < F.lit(as_of) - F.expr("interval 24 hours"))
    lost = missing_blocks(old)
    stats = old.agg(F.min("block_id").alias("min_block"), F.max("block_id").alias("max_block"), F.min("block_timestamp").alias("min_block_timestamp"),
                    F.max("block_timestamp").alias("max_block_timestamp"), F.count_distinct("block_id").alias("_n"))
    impacted = lost.agg(F.count(F.lit(1)).alias("blocks_impacted_count"))
    # both sides are one aggregated row
    summary = stats.withColumn("_k", F.lit(1)).join(impacted.withColumn("_k", F.lit(1)), "_k").select(
        F.lit("blocks").alias("test_name"), "min_block", "max_block", "min_block_timestamp", "max_block_timestamp",
        (F.col("_n") + F.col("blocks_impacted_count")).alias("blocks_tested"), "blocks_impacted_count", F.lit(as_of).alias("test_timestamp"))
    return summary, lost


def impacted_arrays(lost: DataFrame, size: int = 10_000) -> DataFrame:
    """Missing ids as ordered arrays in numbered parts."""
    return ordered_arrays(lost.withColumn("test_name", F.lit("blocks")), ["test_name"], ["missing_id"], "missing_id", "blocks_impacted_array", size, chunk=F.expr("missing_id div 100000")).drop("test_name")


def retest_scope(chain_blocks: DataFrame, last_lost: DataFrame, last_max_time) -> DataFrame:
    """Blocks to test again: the last four days' worth, and everything from just below the oldest id that
    was missing last time."""
    recent = F.lit(False) if last_max_time is None else F.col("block_timestamp") >= F.lit(last_max_time) - F.expr("interval 96 hours")
    low = last_lost.agg(F.min("missing_id").alias("m")).first()["m"]
    again = F.lit(False) if low is None else F.col("block_id") >= low - 1
    return chain_blocks.filter(recent | again)


def transaction_gaps(txs: DataFrame, chain_blocks: DataFrame, metas: DataFrame, as_of) -> DataFrame:
    """Per block the chain's own transaction count against the stored one, over blocks older than 12 hours."""
    old = chain_blocks.filter(F.col("block_timestamp") < F.lit(as_of) - F.expr("interval 12 hours")).select("block_id", "block_timestamp")
    have = txs.select("block_id", "tx_id").distinct().join(old.select("block_id"), "block_id", "left_semi").groupBy("block_id").agg(F.count(F.lit(1)).alias("bronze_num_txs"))
    ends = old.agg(F.min("block_timestamp").alias("lo"), F.max("block_timestamp").alias("hi")).first()
    first = have.agg(F.min("block_id").alias("m")).first()["m"]
    if first is None:
        return metas.filter(F.lit(False)).select("block_id", "block_timestamp", F.col("num_txs").alias("blockchain_num_txs"), F.lit(0).cast("bigint").alias("bronze_num_txs"), F.lit(0).cast("bigint").alias("diff"))
    told = metas.filter(F.col("block_timestamp").between(F.lit(ends["lo"]), F.lit(ends["hi"])) & (F.col("block_id") >= first))
    rows = told.select("block_id", "block_timestamp", F.col("num_txs").alias("blockchain_num_txs")).join(have, "block_id", "left")
    rows = rows.withColumn("bronze_num_txs", F.coalesce("bronze_num_txs", F.lit(0)))
    return rows.withColumn("diff", F.col("bronze_num_txs") - F.col("blockchain_num_txs"))


def transactions_completeness(gaps: DataFrame) -> DataFrame:
    """Summary row of transaction_gaps()."""
    return gaps.agg(
        F.lit("transactions").alias("test_name"), F.min("block_id").alias("min_block"), F.max("block_id").alias("max_block"), F.min("block_timestamp").alias("min_block_timestamp"),
        F.max("block_timestamp").alias("max_block_timestamp"), F.count(F.lit(1)).alias("blocks_tested"), F.count_if(F.col("diff") != 0).alias("blocks_impacted_count"),
        F.sum(F.abs("diff")).alias("transactions_impacted_count"))
