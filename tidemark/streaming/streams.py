"""The incremental jobs on Structured Streaming.

Sources are file streams of landed rows. Checkpoints live under the shared folder. Every foreachBatch
writer is idempotent in the batch id: a batch that is retried after a lost executor or driver writes
the same folder or partitions again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.increments import late_parent, upsert_partitions, write_partitions
from ..operators.windows import across_chunks, dedup_latest, running_sum
from ..session import discard, scratch_path, staged


def read_files(spark: SparkSession, folder: str, schema, glob: str = "*.parquet", per_trigger: int = 100) -> DataFrame:
    """File stream over landed parquet files."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", per_trigger).parquet(folder)
    )


def run_available(writer, checkpoint: str) -> None:
    """Process what has landed, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append closed results to a parquet folder, exactly once."""
    run_available(stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint)


def each_batch(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    run_available(stream.writeStream.foreachBatch(apply), checkpoint)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def stream_upsert(stream: DataFrame, path: str, keys: list[str], order, by: str, checkpoint: str, keep: list[str] = ()) -> None:
    """Merge each batch into a table partitioned by `by`, newest arrival per key; `by` follows from the key."""

    def apply(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        latest = dedup_latest(batch, keys, order)
        if _exists(spark, path):
            upsert_partitions(spark, path, latest, keys, by, keep)
        else:
            write_partitions(latest, path, by)

    each_batch(stream, apply, checkpoint)


def stream_latest(stream: DataFrame, path: str, keys: list[str], order, by: str, checkpoint: str) -> None:
    """The newest row per key, whichever batch brings it; `by` follows from the key. A batch meets the stored
    rows of the partitions it touches and replaces those."""

    def apply(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        rows = dedup_latest(batch, keys, order)
        if _exists(spark, path):
            touched = rows.select(by).distinct()
            stored = spark.read.parquet(path).join(touched, by, "left_semi")
            rows = dedup_latest(stored.unionByName(rows, allowMissingColumns=True), keys, order)
        write_partitions(rows, path, by)

    each_batch(stream, apply, checkpoint)


def stream_dedup(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """First row per key within the watermark; state is dropped once the watermark passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def tumbling_hours(stream: DataFrame, time: str, delay: str, keys: list[str], **aggs: Column) -> DataFrame:
    """Hourly aggregates, emitted once the hour is closed."""
    w = F.window(F.col(time), "1 hour")
    out = stream.withWatermark(time, delay).groupBy(w, *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(F.col("window.start").alias("hour"), *keys, *aggs)


def daily_cells(stream: DataFrame, time: str, delay: str, keys: list[str], **aggs: Column) -> DataFrame:
    """Closed daily aggregates, the cells a trailing window of any length is summed from.

    A sliding window of 90 days would put each row into 90 state cells; one cell per day and a batch
    trailing_days() over the cells gives the same figures.
    """
    day = F.window(F.col(time), "1 day")
    out = stream.withWatermark(time, delay).groupBy(day, *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(F.col("window.start").cast("date").alias("day"), *keys, *aggs)


def stream_marker_groups(stream: DataFrame, path: str, part: list[str], order: list[str], flag: Column, chunk: Column, by: Column, checkpoint: str) -> None:
    """Keep the rows from which marker_groups() numbers the stretches that marker rows open, in any order of arrival.

    Rows are stored with the number of markers before them inside their (group, chunk), and beside them one count
    per (group, chunk). A batch, early or late, rewrites the partitions it has rows for and no other: a late marker
    reaches the rows of later chunks through the counts. Group and order together are the key; a row that comes
    again counts once, so a batch that is retried writes the same. `chunk` never decreases along the order, and
    `by`, the partition column, follows from the chunk.
    """
    rows_at, counts_at = f"{path}/rows", f"{path}/counts"

    def apply(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        mark = F.when(flag, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        fresh = staged(batch.withColumns({"marker": mark, "marker_chunk": chunk, "marker_by": by}), "marker_batch")
        rows = fresh
        if _exists(spark, rows_at):
            ends = fresh.agg(F.min("marker_by").alias("lo"), F.max("marker_by").alias("hi")).first()
            stored = spark.read.parquet(rows_at)
            near = stored.filter(F.col("marker_by").between(F.lit(ends["lo"]), F.lit(ends["hi"])) | F.col("marker_by").isNull())
            touched = fresh.select(F.col("marker_by").alias("touched")).distinct()
            near = near.join(touched, F.col("marker_by").eqNullSafe(F.col("touched")), "left_semi")
            rows = near.select(*fresh.columns).unionByName(fresh)
        once = rows.dropDuplicates([*part, *order])
        numbered = staged(running_sum(once, [*part, "marker_by", "marker_chunk"], order, F.col("marker"), "markers"), "marker_rows")
        write_partitions(numbered, rows_at, "marker_by")
        write_partitions(numbered.groupBy(*part, "marker_by", "marker_chunk").agg(F.sum("marker").alias("markers")), counts_at, "marker_by")
        discard(fresh, numbered)

    each_batch(stream, apply, checkpoint)


def marker_groups(spark: SparkSession, path: str, part: list[str], out: str) -> DataFrame:
    """The rows that stream_marker_groups() keeps, with the number of their stretch; rows before the first marker
    of the group get NULL."""
    rows, counts = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/counts")
    total = across_chunks(rows, counts, part, "marker_chunk", "markers", "_m")
    return total.withColumn(out, F.nullif(F.col("_m") - 1, F.lit(-1))).drop("_m", "marker", "markers", "marker_chunk", "marker_by")


def stream_late_parent(facts: DataFrame, parents: DataFrame, on: list[str], fact_time: str, parent_time: str, delay: str) -> DataFrame:
    """Stream-stream join that waits for the parent; state is bounded by the watermark on both sides.

    Both sides carry an arrival time. A fact is emitted when its parent is there, at most `delay` apart.
    """
    f = facts.withWatermark(fact_time, delay)
    p = parents.withWatermark(parent_time, delay)
    near = p[parent_time].between(f[fact_time] - F.expr(f"interval {delay}"), f[fact_time] + F.expr(f"interval {delay}"))
    on_keys = [f[k] == p[k] for k in on]
    cond = on_keys[0]
    for c in on_keys[1:]:
        cond = cond & c
    joined = f.join(p, cond & near, "inner")
    for k in on:
        joined = joined.drop(p[k])
    return joined


def batch_late_parent(stream: DataFrame, parents: Callable[[SparkSession, int], DataFrame], path: str, on: list[str], keys: list[str], time: str, checkpoint: str) -> None:
    """Late-parent repair per batch: pending rows are kept in a table of their own and tried again with
    every batch, so the settled part of the target is never rewritten."""

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = f"{path}/pending/epoch={epoch - 1}"
        waiting = spark.read.parquet(before) if epoch and _exists(spark, before) else None
        dated = staged(late_parent(waiting, batch, parents(spark, epoch), on, keys, time), "late_parent")
        hold = F.col(time) == F.lit("2099-12-31 00:00:00").cast("timestamp_ntz")
        dated.filter(~hold).write.mode("overwrite").parquet(f"{path}/settled/epoch={epoch}")
        dated.filter(hold).write.mode("overwrite").parquet(f"{path}/pending/epoch={epoch}")

    each_batch(stream, apply, checkpoint)


def scratch(spark: SparkSession, label: str) -> tuple[str, str]:
    """Fresh (table, checkpoint) folders."""
    base = scratch_path(spark, label)
    return f"{base}/table", f"{base}/checkpoint"
