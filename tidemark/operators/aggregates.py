"""Aggregations. Every group is combined map-side first; values kept per group are bounded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .windows import row_number_in_group, top_per_group


def distinct_counts(df: DataFrame, keys: list[str], entity: str, **conditions: Column) -> DataFrame:
    """Exact distinct count of `entity`, in total and under each condition, in one pass.

    The entity is folded to one row per (key, entity) first. That shuffles on (key, entity), so a hot
    key is spread, and avoids the row multiplication of several COUNT(DISTINCT …) in one query.
    """
    flags = [F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in conditions.items()]
    once = df.filter(F.col(entity).isNotNull()).groupBy(*keys, entity).agg(F.count(F.lit(1)).alias("_n"), *flags)
    return once.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n_{entity}"), *[F.sum(n).alias(n) for n in conditions])


def pivot_known(df: DataFrame, keys: list[str], k: str, v: str, names: dict[str, str]) -> DataFrame:
    """Key-value rows to one row per group with a column for each known key (names: key → column)."""
    wide = [F.max(F.when(F.col(k) == key, F.col(v))).alias(col) for key, col in names.items()]
    return df.groupBy(*keys).agg(*wide)


def pivot_map(df: DataFrame, keys: list[str], k: str, v: str, out: str = "j") -> DataFrame:
    """Key-value rows to one map per group: NULL values left out, largest value for a repeated key.

    Folded to distinct keys before collecting, so the map is bounded by the number of keys in use.
    """
    once = df.filter(F.col(v).isNotNull() & F.col(k).isNotNull()).groupBy(*keys, k).agg(F.max(v).alias(v))
    entries = F.array_sort(F.collect_list(F.struct(F.col(k).alias("key"), F.col(v).alias("value"))))
    return once.groupBy(*keys).agg(F.map_from_entries(entries).alias(out))


def ordered_arrays(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, size: int = 10_000, chunk: Column | None = None) -> DataFrame:
    """Values of each group as arrays in order, NULLs skipped.

    A group longer than `size` comes as several numbered parts, so nothing is dropped and no array grows
    without bound.
    """
    numbered = row_number_in_group(df.filter(F.col(value).isNotNull()), keys, order, "_pos", chunk)
    parts = numbered.withColumn("part_no", F.expr(f"cast((_pos - 1) div {size} as bigint)"))
    rows = parts.groupBy(*keys, "part_no").agg(F.collect_list(F.struct("_pos", value)).alias("_l"))
    return rows.withColumn(out, F.transform(F.array_sort("_l"), lambda x: x[value])).drop("_l")


def distinct_arrays(df: DataFrame, keys: list[str], value: str, out: str, size: int = 10_000, chunk: Column | None = None) -> DataFrame:
    """Distinct values per group, sorted, in numbered parts of at most `size`."""
    once = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    return ordered_arrays(once, keys, [value], value, out, size, chunk)


def array_union_size(df: DataFrame, keys: list[str], arrays: str, out: str) -> DataFrame:
    """Number of distinct non-null elements over all arrays of the group; 0 for empty arrays only."""
    groups = df.groupBy(*keys).agg(F.lit(0).alias("_z"))
    elems = df.select(*keys, F.explode(arrays).alias("_e")).filter(F.col("_e").isNotNull()).distinct()
    counts = elems.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.join(counts, keys, "left").select(*keys, F.coalesce("_n", F.lit(0)).alias(out))


def capped_collect(df: DataFrame, keys: list[str], order, value: str, n: int, out: str) -> DataFrame:
    """At most n values per group in a fixed order: the cap is the feature here."""
    kept = top_per_group(df, keys, order, n)
    return kept.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(out))


def merge_totals(stored: DataFrame, batch: DataFrame, keys: list[str], add: list[str], keep_max: list[str]) -> DataFrame:
    """Stored totals plus a batch of totals: counts add up, marks keep their maximum."""
    both = stored.unionByName(batch.select(*stored.columns))
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in add], *[F.max(c).alias(c) for c in keep_max])


def share_in(inflow: DataFrame, outflow: DataFrame, keys: list[str], amount: str, out: str, one_sided: float | None) -> DataFrame:
    """inflow / (inflow + outflow) per key, over keys found on either side.

    `one_sided` is the value of a key without any outflow row (the two published ratios differ in it);
    a key without inflow gets 0, and so does an undefined ratio.
    """
    ins = inflow.select(*keys, F.col(amount).cast("double").alias("_i"), F.lit(None).cast("double").alias("_o"))
    outs = outflow.select(*keys, F.lit(None).cast("double").alias("_i"), F.col(amount).cast("double").alias("_o"))
    sums = ins.unionByName(outs).groupBy(*keys).agg(F.sum("_i").alias("_i"), F.sum("_o").alias("_o"))
    both = F.try_divide(F.col("_i"), F.col("_i") + F.col("_o"))
    value = F.when(F.col("_o").isNull() & F.col("_i").isNotNull(), F.lit(one_sided).cast("double")).otherwise(both)
    return sums.select(*keys, F.coalesce(value, F.lit(0.0)).alias(out))


def sum_sources(sources: list[DataFrame], keys: list[str], amount: str, out: str) -> DataFrame:
    """Several (keys, amount) tables as one, summed."""
    one = reduce(DataFrame.unionByName, [s.select(*keys, amount) for s in sources])
    return one.groupBy(*keys).agg(F.sum(amount).alias(out))


def trailing_days(daily: DataFrame, day: str, dates: DataFrame, score_date: str, days: int) -> DataFrame:
    """Copy each daily row to every score date whose trailing window of `days` days holds it.

    Input is one row per (entity, day), already aggregated. The score dates name the days they hold, a table as
    long as the calendar, and a daily row meets its dates by equality: no row is copied to a date nobody asked
    for. A NULL day reaches none, a NULL date holds none.
    """
    held = F.sequence(F.date_sub(F.col(score_date), days - 1), F.to_date(score_date), F.expr("interval 1 day"))
    wanted = dates.select(score_date).distinct().withColumn("_held", F.explode(held))
    rows = daily.drop(score_date) if score_date in daily.columns and score_date != day else daily
    return rows.join(wanted, F.col(day) == F.col("_held")).select(*[rows[c] for c in rows.columns], score_date)
