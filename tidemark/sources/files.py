"""Landed JSON files, seeds and number tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.common import part

# Fixed value: node error codes whose payloads are skipped.
SKIPPED_ERROR_CODES = [
    "-32000", "-32001", "-32002", "-32003", "-32004", "-32005", "-32006", "-32007",
    "-32008", "-32009", "-32010", "-32602", "-32603",
]

PAYLOAD = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("data", T.StringType()),
])


def path_key(depth: int = 4, name: Column | None = None) -> Column:
    """Partition key from a file path: the leading number of its `depth`-th component, as in
    a/b/c/<key>_rest."""
    path = F.col("file_name") if name is None else name
    return part(part(path, "/", depth), "_", 1).try_cast("bigint")


def _landed(spark: SparkSession, path: str, key: Column, schema: T.StructType, root: str | None, **options) -> DataFrame:
    raw = spark.read.schema(schema).options(recursiveFileLookup="true", **options).json(path)
    prefix = (root or path).rstrip("/") + "/"
    return raw.select(
        *raw.columns,
        F.substring_index(F.col("_metadata.file_path"), prefix, -1).alias("file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_inserted_timestamp"),
    ).withColumn("partition_key", key)


def scan_full_history(spark: SparkSession, path: str, key: Column, schema: T.StructType = PAYLOAD, root: str | None = None) -> DataFrame:
    """Every landed file, with its name, landing time and partition key."""
    return _landed(spark, path, key, schema, root)


def scan_files(spark: SparkSession, path: str, key: Column, since, schema: T.StructType = PAYLOAD, floor: int | None = None, root: str | None = None) -> DataFrame:
    """Files landed at or after `since`, at or above a partition floor.

    The time cut goes to the reader (modifiedAfter), so older files never enter the scan.
    """
    rows = _landed(spark, path, key, schema, root, modifiedAfter=since.strftime("%Y-%m-%dT%H:%M:%S"))
    return rows if floor is None else rows.filter(F.col("partition_key") >= floor)


def partition_floor(ref: DataFrame, col: str, width: int = 1000, back: int = 400_000) -> int:
    """max(col) rounded half-up to `width`, less `back`: the oldest partition still worth reading."""
    top = ref.agg(F.max(F.col(col)).alias("m")).first()["m"]
    return 0 if top is None else (int(top) + width // 2) // width * width - back


def read_seed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Lookup table from a CSV file with a header; all columns are text, as some ids exceed 64 bits."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", "true").csv(path)


def inline_map(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """Small literal table. The rows are part of the plan, so Spark knows how small it is and broadcasts it."""
    literals = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, columns)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*literals)))


def number_sequence(spark: SparkSession, lo: int, hi: int, name: str = "block_number") -> DataFrame:
    return spark.range(lo, hi + 1).withColumnRenamed("id", name)
