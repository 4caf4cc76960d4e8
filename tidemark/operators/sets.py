"""Set operations over tables of one shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_labelled(tables: dict[str, DataFrame], label: str = "platform") -> DataFrame:
    """Tables of one schema as one, each row naming its source."""
    return union_all([t.withColumn(label, F.lit(name)) for name, t in tables.items()])


def missing(expected: DataFrame, *done: DataFrame) -> DataFrame:
    """Keys expected and in none of the done tables; keys must not be NULL."""
    keys = expected.columns
    left = expected.distinct()
    for d in done:
        left = left.join(d.select(*keys), keys, "left_anti")
    return left


def symmetric_diff(actual: DataFrame, expected: DataFrame, cols: list[str]) -> DataFrame:
    """Rows found on one side only, with the direction.

    One aggregation over both tables instead of two EXCEPTs: each side is read and shuffled once.
    """
    both = actual.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        expected.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    sides = both.groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b")).filter("_a + _b = 1")
    which = F.when(F.col("_a") == 1, F.lit("in_actual_not_in_expected")).otherwise(F.lit("in_expected_not_in_actual"))
    return sides.select(which.alias("which_diff"), *cols)
