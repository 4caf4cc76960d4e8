"""Audit columns every stored table carries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.common import surrogate_key

# Fixed value: stamp of rows stored before stamps were kept.
BEFORE_STAMPS = "2000-01-01 00:00:00"


def keyed(df: DataFrame, name: str, *cols: str) -> DataFrame:
    return df.withColumn(name, surrogate_key(*cols))


def stamped(df: DataFrame, as_of) -> DataFrame:
    """Row-write stamps. The clock is an argument, so a run can be repeated."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return df.withColumn("inserted_timestamp", now).withColumn("modified_timestamp", now)


def published(df: DataFrame, cols: list, row_id: str, out_id: str, *key_cols: str) -> DataFrame:
    """Published view: chosen columns, the row id (computed where absent) and defaulted stamps."""
    ident = F.coalesce(F.col(row_id), surrogate_key(*key_cols)) if row_id in df.columns else surrogate_key(*key_cols)
    stamps = []
    for c in ("inserted_timestamp", "modified_timestamp"):
        have = F.col(c) if c in df.columns else F.lit(None).cast("timestamp_ntz")
        stamps.append(F.coalesce(have, F.lit(BEFORE_STAMPS).cast("timestamp_ntz")).alias(c))
    return df.select(*cols, ident.alias(out_id), *stamps)
