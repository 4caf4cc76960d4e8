"""Data-quality checks. Each returns the offending rows; an empty result is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .sets import symmetric_diff
from .windows import lag_gap


def sequence_gaps(df: DataFrame, part: list[str], col: str, chunk: Column | None = None) -> DataFrame:
    """Neighbours of one group whose distance is not 1, widest gap first."""
    pairs = lag_gap(df.select(*part, col), part, col, chunk)
    return pairs.filter((F.col("gap") != 1)).orderBy(F.col("gap").desc(), *part, col)


def compare_subset(actual: DataFrame, expected: DataFrame, cols: list[str]) -> DataFrame:
    return symmetric_diff(actual, expected, cols)


def count_matches_parent(children: DataFrame, parents: DataFrame, key: str, expected: str) -> DataFrame:
    """Parents whose number of children differs from the number they state."""
    n = children.groupBy(key).agg(F.count(F.lit(1)).alias("actual"))
    both = parents.select(key, F.col(expected).alias("expected")).join(n, key, "left")
    return both.withColumn("actual", F.coalesce("actual", F.lit(0))).filter(F.col("actual") != F.col("expected"))


def child_has_parent(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct child keys without a parent row."""
    return child.select(*keys).distinct().join(parent.select(*keys), keys, "left_anti")


def parent_has_child(parent: DataFrame, child: DataFrame, keys: list[str], threshold: int = 1) -> DataFrame:
    """Parents without children, reported only when there are at least `threshold` of them."""
    lonely = parent.select(*keys).distinct().join(child.select(*keys), keys, "left_anti")
    if threshold <= 1:
        return lonely
    enough = lonely.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= threshold)
    return lonely.withColumn("_all", F.lit(1)).join(enough.select(F.lit(1).alias("_all")), "_all", "left_semi").select(*keys)


def missing_rows(base: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the base table without a counterpart on the keys."""
    return base.join(model.select(*keys), keys, "left_anti")


def missing_for_key(base: DataFrame, model: DataFrame, keys: list[str], only: Column, stamp: str, before) -> DataFrame:
    """The same for one slice, leaving out rows younger than the grace bound."""
    return missing_rows(base.filter(only & (F.col(stamp) < before)), model, keys)


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def matches(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Rows whose text has no match (NULL passes)."""
    return df.filter(~F.col(col).rlike(pattern))


def in_set(df: DataFrame, col: str, allowed: list) -> DataFrame:
    return df.filter(~F.col(col).isin(allowed))


def column_types(df: DataFrame, expected: dict[str, list[str]]) -> list[str]:
    """Columns missing or of another type; metadata only, no job runs."""
    have = dict(df.dtypes)
    return [c for c, types in expected.items() if have.get(c) not in types]


def untyped(df: DataFrame, keys: list[str], expected: dict[str, str], whole: list[str] = ()) -> DataFrame:
    """keys and column_name for each value that does not read as its type; of those in `whole`, also numbers with
    a fraction. NULL passes."""
    tests = []
    for c, kind in expected.items():
        read = F.col(c).try_cast(kind)
        bad = read.isNull() if c not in whole else read.isNull() | (read != F.floor(read))
        tests.append(F.when(F.col(c).isNotNull() & bad, F.lit(c)))
    return df.select(*keys, F.explode(F.array_compact(F.array(*tests))).alias("column_name"))


def without_fields(df: DataFrame, payload: str, fields: list[str]) -> DataFrame:
    """Rows whose JSON object lacks one of the fields."""
    names = F.json_object_keys(F.col(payload))
    return df.filter(~reduce(lambda a, b: a & b, [F.coalesce(F.array_contains(names, f), F.lit(False)) for f in fields]))


def recent(df: DataFrame, stamp: str, since) -> DataFrame:
    """One row with the newest stamp when it is older than `since` or absent."""
    top = df.agg(F.max(stamp).alias("newest"))
    return top.filter(F.col("newest").isNull() | (F.col("newest") < since))


def profile(df: DataFrame, nulls: list[str] = (), regexes: dict[str, str] | None = None, sets: dict[str, list] | None = None) -> DataFrame:
    """All row-wise checks of a table in one pass: one row per check with its number of failures."""
    checks: dict[str, Column] = {f"not_null:{c}": F.col(c).isNull() for c in nulls}
    checks.update({f"regex:{c}": ~F.col(c).rlike(p) for c, p in (regexes or {}).items()})
    checks.update({f"in_set:{c}": ~F.col(c).isin(v) for c, v in (sets or {}).items()})
    one = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(n) for n, bad in checks.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("failures")) for n in checks])
    return one.select(F.explode(pairs).alias("r")).select("r.*")


def severity(count: Column, warn_over: int, error_over: int) -> Column:
    return F.when(count > error_over, F.lit("error")).when(count > warn_over, F.lit("warn")).otherwise(F.lit("pass"))


def store_failures(failures: DataFrame, path: str) -> None:
    failures.write.mode("overwrite").parquet(path)
