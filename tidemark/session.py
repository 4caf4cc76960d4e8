"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Folders of staged tables that this driver made.
_ours: set[str] = set()
#: Their paths, in the order of writing.
_written: list[str] = []
#: Whether Spark removes the shuffles of a job at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs assume; cluster settings given by the launcher win.

    Everything runs in UTC. AQE stays on: it coalesces small shuffles, splits skewed join partitions and
    turns a sort-merge join into a broadcast join once the real size of a side is known.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or a local one where that is unset."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="tidemark-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(path)
    return path


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of the store that holds the path, as Spark's own readers see it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder. The application's folder goes when its driver ends."""
    app = f"{shared_dir(spark).rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"
    if app not in _ours:
        fs, at = _file_system(spark, app)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _ours.add(app)
    path = f"{app}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several branches read, and read it back.

    Unlike persist() the result outlives lost executors, and its plan is a plain scan, so each
    branch prunes columns and pushes filters on its own. The shuffles behind it are removed once it is written:
    nothing reads them again, and a chain of jobs would fill the disks with them.
    """
    return staged_parts([df], label)


class Appended:
    """A table that is written frame by frame, all of the same columns, and read back in the end."""

    def __init__(self, label: str):
        self.label, self.path = label, None

    def add(self, df: DataFrame) -> None:
        spark = self.spark = df.sparkSession
        self.schema = df.schema
        self.path = self.path or scratch_path(spark, self.label)
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("append").option("compression", "zstd").parquet(self.path)
        finally:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)

    def table(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def staged_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """Write frames of the same columns one after another as one table, and read it back. A part is asked for when the one
    before it is written, so the disks hold the shuffles of one part at a time."""
    out = Appended(label)
    for df in parts:
        out.add(df)
    return out.table()


def discard(*paths_or_frames: DataFrame | str) -> None:
    """Remove staged tables, or those a frame reads, once nothing will read them again. Other inputs stay."""
    for x in paths_or_frames:
        spark = SparkSession.active() if isinstance(x, str) else x.sparkSession
        for path in [x] if isinstance(x, str) else _read_by(x):
            if path in _written:
                fs, at = _file_system(spark, path)
                fs.delete(at, True)
                _written.remove(path)


class Relay:
    """A table handed on from step to step of one job: each step stores it anew, and the one before goes."""

    def __init__(self, label: str):
        self.label, self.last = label, None

    def store(self, df: DataFrame) -> DataFrame:
        out = staged(df, self.label)
        if self.last is not None:
            discard(self.last)
        self.last = out
        return out


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder from whichever store holds it."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def _read_by(df: DataFrame) -> list[str]:
    """The staged tables that a frame reads; their names are never used twice."""
    folders = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in df.inputFiles()}
    return [p for p in _written if p.rsplit("/", 1)[-1] in folders]


class Scratch:
    """Staged tables written from here on, for a job that ends with a written result."""

    def __init__(self):
        self.before = set(_written)

    def clear(self, keep: DataFrame) -> None:
        """Remove all of them but those that `keep` reads."""
        kept = {*_read_by(keep), *self.before}
        discard(*[p for p in _written if p not in kept])


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly row work on an input of few splits; an input with enough of them is left
    alone, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
