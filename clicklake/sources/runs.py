"""Appending to tables in runs that may be repeated.

A run has a name that the caller gives it, such as a date and a type. Each attempt writes to folders of its own and is
entered in a log at the end. Readers see the last logged attempt of every run: an attempt that dies half way leaves
nothing to be seen, and one that is made again replaces the one before instead of adding to it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

_LOG = "run string, attempt string, seq bigint, entry bigint"


@dataclass(frozen=True)
class Attempt:
    """One go at a run. ``seq`` orders runs by when they were first logged."""

    root: str
    run: str
    seq: int
    entry: int
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def write(self, df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
        path = f"{self.root}/{table}/attempt={self.name}"
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)

    def commit(self, spark: SparkSession) -> None:
        """From here on readers see this attempt; a log entry is one file, put in place at once."""
        row = [(self.run, self.name, self.seq, self.entry)]
        spark.createDataFrame(row, _LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")


def _exists(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def logged(spark: SparkSession, root: str) -> DataFrame:
    """(run, attempt, seq, entry) of what counts: the last attempt of each run."""
    if not _exists(spark, f"{root}/log"):
        return spark.createDataFrame([], _LOG)
    log = spark.read.schema(_LOG).parquet(f"{root}/log")
    return log.groupBy("run").agg(F.max_by(F.struct("attempt", "seq", "entry"), "entry").alias("last")).select("run", "last.*")


def begin(spark: SparkSession, root: str, run: str, only_last: bool = False) -> Attempt:
    """A new attempt at a run. With ``only_last`` no run may be repeated once another one has followed it."""
    runs = logged(spark, root)
    last, entry = runs.agg(F.max("seq"), F.max("entry")).first()
    own = runs.where(F.col("run") == run).select("seq").first()
    if only_last and own is not None and own[0] != last:
        raise ValueError(f"run {run} was followed by others that rest on it")
    seq = own[0] if own is not None else (last or 0) + 1
    return Attempt(root, run, seq, (entry or 0) + 1)


def read_runs(spark: SparkSession, root: str, table: str, schema: str | None = None, besides: str | None = None) -> DataFrame | None:
    """The rows of all logged runs, ``besides`` one perhaps; None before there is a first one."""
    if not _exists(spark, f"{root}/{table}"):
        return None
    runs = logged(spark, root)
    if besides is not None:
        runs = runs.where(F.col("run") != besides)
    reader = spark.read.option("basePath", f"{root}/{table}")
    rows = (reader.schema(schema) if schema else reader).parquet(f"{root}/{table}")
    # A semi join by partition: folders of other attempts are not read.
    return rows.join(runs.select("attempt"), "attempt", "left_semi").drop("attempt")


def append_run(df: DataFrame, root: str, table: str, run: str) -> None:
    """Append rows as one run; the same run again replaces them."""
    attempt = begin(df.sparkSession, root, run)
    attempt.write(df, table)
    attempt.commit(df.sparkSession)
