"""Increments, merges and late-data repair on plain tables.

Merge operators return the new content of the target. `write_partitions` puts it in place for the
partitions a batch touches, so the cost follows the batch and not the table.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def high_water(target: DataFrame, stamp: str):
    """Newest arrival stamp of the target, None when it is empty. One aggregated row is read."""
    return target.agg(F.max(stamp).alias("m")).first()["m"]


def newer_than(source: DataFrame, stamp: str, mark, lookback: timedelta = timedelta(0), floor=None, strict: bool = False) -> DataFrame:
    """Rows at or past the mark minus a lookback, never older than `floor`.

    The bound is a literal, so it prunes partitions and row groups of the scan.
    """
    if mark is None and floor is None:
        return source
    bounds = [b for b in ((mark - lookback) if mark is not None else None, floor) if b is not None]
    bound = F.lit(max(bounds))
    return source.filter(F.col(stamp) > bound if strict else F.col(stamp) >= bound)


def increment(source: DataFrame, target: DataFrame, stamp: str, lookback: timedelta = timedelta(0), floor_days: int | None = None, as_of=None, strict: bool = False) -> DataFrame:
    """Rows newer than the target's high-water mark (less lookback); with `floor_days`, at most that many
    days before `as_of`."""
    floor = as_of - timedelta(days=floor_days) if floor_days is not None else None
    return newer_than(source, stamp, high_water(target, stamp), lookback, floor, strict)


def merge_upsert(target: DataFrame, batch: DataFrame, keys: list[str], keep: list[str] = ()) -> DataFrame:
    """Target after a merge on unique keys: matched rows take the batch's values except the columns in
    `keep`, new rows are added, columns only one side has are kept. One full join, so each side is
    shuffled once. Keys must be unique on both sides and not NULL."""
    cols = list(dict.fromkeys([*target.columns, *batch.columns]))
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    b = batch.select(*[F.col(c).alias(f"_b_{c}") for c in batch.columns], F.lit(True).alias("_in_b"))
    on = reduce(lambda x, y: x & y, [F.col(f"_t_{k}") == F.col(f"_b_{k}") for k in keys])

    def pick(c):
        if c in keys:
            return F.coalesce(f"_t_{c}", f"_b_{c}").alias(c)
        if c not in batch.columns:
            return F.col(f"_t_{c}").alias(c)
        if c not in target.columns:
            return F.col(f"_b_{c}").alias(c)
        wins = F.col("_in_t").isNotNull() if c in keep else F.col("_in_b").isNull()
        return F.when(wins, F.col(f"_t_{c}")).otherwise(F.col(f"_b_{c}")).alias(c)

    return t.join(b, on, "full").select(*[pick(c) for c in cols])


def merge_update_columns(target: DataFrame, batch: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Merge that changes only the listed columns of matched rows."""
    keep = [c for c in target.columns if c not in update and c not in keys]
    return merge_upsert(target, batch, keys, keep)


def delete_insert(target: DataFrame, batch: DataFrame, keys: list[str], keep=lambda df: df) -> DataFrame:
    """Remove every target row sharing a key with the batch, then add the batch. Keys may be coarser than
    the row: all old rows of a touched block or day go. `keep` may store the list of keys."""
    touched = keep(batch.select(*keys).distinct())
    return target.join(touched, keys, "left_anti").unionByName(batch, allowMissingColumns=True)


def post_delete(target: DataFrame, flag: Column) -> DataFrame:
    """Target without the rows whose flag is TRUE; an unknown flag keeps the row."""
    return target.filter(~F.coalesce(flag, F.lit(False)))


def destination_range(target: DataFrame, batch: DataFrame, col: str, back=None, bucket: int | None = None, upper: bool = False) -> DataFrame:
    """Target rows a batch can possibly touch: from the batch's minimum (less `back`, or rounded down to
    `bucket`), optionally up to its maximum. Both ends are literals, for partition pruning."""
    ends = batch.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if ends["lo"] is None:
        return target.filter(F.lit(False))
    lo = ends["lo"]
    if bucket:
        lo = (lo // bucket) * bucket
    if back is not None:
        lo = lo - back
    out = target.filter(F.col(col) >= F.lit(lo))
    return out.filter(F.col(col) <= F.lit(ends["hi"])) if upper else out


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace exactly the partitions present in `df`; others stay. Rows are sent to their partition's
    tasks with AQE free to split large ones, and the swap happens at job commit."""
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def upsert_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], by: str, keep: list[str] = ()) -> None:
    """Merge a batch into a partitioned table, rewriting only the partitions it touches. The partition
    column must be part of the key, or follow from it."""
    values = [r[0] for r in batch.select(by).distinct().collect()]
    old = spark.read.parquet(path).filter(F.col(by).isin(values))
    write_partitions(merge_upsert(old, batch, keys, keep), path, by)


# --- late and incomplete rows -----------------------------------------------------------------

# Fixed value: event time of a row whose parent has not arrived.
PENDING_TIME = "2099-12-31 00:00:00"


def with_parent_time(facts: DataFrame, parents: DataFrame, on: list[str], time: str) -> DataFrame:
    """Facts with the time of their parent; the sentinel time while it is missing."""
    p = parents.select(*on, F.col(time).alias("_t"))
    sentinel = F.lit(PENDING_TIME).cast(parents.schema[time].dataType)
    return facts.drop(time).join(p, on, "left").withColumn(time, F.coalesce("_t", sentinel)).drop("_t")


def late_parent(target: DataFrame | None, batch: DataFrame, parents: DataFrame, on: list[str], keys: list[str], time: str) -> DataFrame:
    """Rows to merge this run: the batch and every stored row still pending, joined to the parents again.
    The batch's version of a key wins over the stored one."""
    if target is None:
        return with_parent_time(batch, parents, on, time)
    pending = target.filter(is_pending(time)).join(batch.select(*keys), keys, "left_anti")
    return with_parent_time(batch.unionByName(pending, allowMissingColumns=True), parents, on, time)


def is_pending(time: str) -> Column:
    return F.col(time) == F.lit(PENDING_TIME).cast("timestamp_ntz")


def settled(df: DataFrame, time: str) -> DataFrame:
    """Hide rows whose parent has not arrived."""
    return df.filter(~is_pending(time))


def heal_nulls(target: DataFrame, dim: DataFrame, on: list[str], fill: dict[str, str]) -> DataFrame:
    """Stored rows that are NULL now and resolvable now, with the values filled in.

    fill: target column → dimension column. Rows that could not improve are left out, so running it
    again on the merged target gives nothing.
    """
    names = {d: f"_d_{d}" for d in fill.values()}
    lookup = dim.select(*on, *[F.col(d).alias(n) for d, n in names.items()])
    gains = reduce(lambda a, b: a | b, [F.col(t).isNull() & F.col(names[d]).isNotNull() for t, d in fill.items()])
    needy = target.filter(reduce(lambda a, b: a | b, [F.col(t).isNull() for t in fill]))
    joined = needy.join(lookup, on).filter(gains)
    filled = [F.coalesce(F.col(c), F.col(names[fill[c]])).alias(c) if c in fill else F.col(c) for c in target.columns]
    return joined.select(*filled)


def healable_groups(target: DataFrame, dim: DataFrame, on: list[str], fill: dict[str, str], group: list[str]) -> DataFrame:
    """Group keys with at least one row that can improve."""
    return heal_nulls(target, dim, on, fill).select(*group).distinct()


def heal_groups(target: DataFrame, groups: DataFrame, group: list[str], recompute, keep=lambda df: df) -> DataFrame:
    """Target with whole groups computed again: `recompute` gets the members of the touched groups. `keep` may store the
    lists of groups: the joins then know their size before they send the target."""
    members = target.join(keep(groups), group, "left_semi")
    return delete_insert(target, recompute(members), group, keep)


def ranges(df: DataFrame, col: str, rows: int) -> list[Column]:
    """Conditions that cut a table by ranges of a column, about `rows` rows each. Equal values stay together, whatever
    their number; nulls are in the first range."""
    n = -(-df.count() // rows)
    cuts = df.agg(F.percentile_approx(col, [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    cuts, c = sorted(set(cuts or [])), F.col(col)
    if not cuts:
        return [F.lit(True)]
    return [c.isNull() | (c <= cuts[0]), *[(c > a) & (c <= b) for a, b in zip(cuts, cuts[1:])], c > cuts[-1]]


def unprocessed_days(spine: DataFrame, target: DataFrame, day: str) -> DataFrame:
    """Days of the spine the target has no rows for."""
    return spine.select(day).distinct().join(target.select(day).distinct(), day, "left_anti")


def complete_days(df: DataFrame, ts: str, day: str = "block_date") -> DataFrame:
    """Days in which all 24 hours occur. Folded to (day, hour) before counting."""
    hours = df.select(F.date_trunc("hour", F.col(ts)).alias("_h")).distinct()
    days = hours.groupBy(F.to_date("_h").alias(day)).agg(F.count(F.lit(1)).alias("_n"))
    return days.filter("_n = 24").select(day)


def closed_hours(df: DataFrame, ts: str, as_of: Column) -> DataFrame:
    """Rows of hours that ended before `as_of`."""
    return df.filter(F.date_trunc("hour", F.col(ts)) < F.date_trunc("hour", as_of))


def touched_hours(batch: DataFrame, source: DataFrame, ts: str) -> DataFrame:
    """All source rows of the hours a batch touches, so that those hours can be recomputed whole."""
    low = batch.agg(F.min(ts).alias("m")).first()["m"]
    if low is None:
        return source.filter(F.lit(False))
    hours = batch.select(F.date_trunc("hour", F.col(ts)).alias("_h")).distinct()
    near = source.filter(F.col(ts) >= F.date_trunc("hour", F.lit(low)))
    return near.withColumn("_h", F.date_trunc("hour", F.col(ts))).join(hours, "_h", "left_semi").drop("_h")
