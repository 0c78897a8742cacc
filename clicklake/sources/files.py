"""File sources and sinks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Writers drop microseconds unless a longer pattern is named. Readers take what Spark takes: these and other forms.
TIME_FORMATS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def shared_root(checkpoint: str | None, warehouse: str, is_local: bool, one_machine: bool) -> str:
    """Where shared folders go: the checkpoint folder, or one below the warehouse unless that is a disk of one machine of several."""
    if checkpoint:
        return checkpoint.rstrip("/")
    if is_local and not one_machine:
        raise ValueError("executors do not share the warehouse's disk: set spark.checkpoint.dir to a folder that they share")
    return f"{warehouse.rstrip('/')}/scratch"


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared one (``spark.checkpoint.dir``), else below the session's warehouse.

    The folder goes with the session: Hadoop removes it when the driver's JVM ends.
    """
    warehouse, hadoop = spark.conf.get("spark.sql.warehouse.dir"), spark._jsc.hadoopConfiguration()
    path = lambda folder: spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = shared_root(
        spark.conf.get("spark.checkpoint.dir", None), warehouse,
        is_local=path(warehouse).getFileSystem(hadoop).getUri().getScheme() == "file",
        one_machine=spark.sparkContext.master.split("[")[0] == "local",
    )
    folder = f"{root}/clicklake-{uuid.uuid4().hex}"
    path(folder).getFileSystem(hadoop).deleteOnExit(path(folder))
    return folder


def settled(df: DataFrame) -> DataFrame:
    """The rows computed once and kept as a table in the shared folder, for results that several steps read."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Settled tables of a job that go once their last reader has been written, not only with the session."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.kept = spark, []

    def settled(self, df: DataFrame) -> DataFrame:
        folder = shared_dir(self.spark)
        df.write.parquet(folder)
        table = self.spark.read.parquet(folder)
        self.kept.append((table, folder))
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete those of the tables that come from here. Nothing that reads them may run any more."""
        for table, folder in self.kept:
            if any(table is t for t in tables):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.kept = [(t, f) for t, f in self.kept if not any(t is x for x in tables)]


# -- sources -----------------------------------------------------------------


def read_csv(spark: SparkSession, path, schema: str | StructType, sep: str = ",", **options) -> DataFrame:
    """CSV with a header and a known schema; bzip2 files are recognised by name and split."""
    return spark.read.schema(schema).options(**{"header": True, "sep": sep, **options}).csv(path)


def read_csv_inferred(spark: SparkSession, path, **options) -> DataFrame:
    """CSV with a header whose types Spark infers, at the price of one more pass over the files."""
    return spark.read.options(header=True, inferSchema=True, **options).csv(path)


def read_positional(spark: SparkSession, path, positions: Mapping[str, int], sep: str = ",") -> DataFrame:
    """Headerless delimited text: the columns at the given positions, named; all of them strings."""
    raw = spark.read.options(header=False, sep=sep).csv(path)
    return raw.select([F.col(f"_c{position}").alias(name) for name, position in positions.items()])


def read_json_tree(spark: SparkSession, root, schema: str | StructType, **options) -> DataFrame:
    """JSON lines, gzipped or not, in all folders below ``root``."""
    return spark.read.schema(schema).options(**{"recursiveFileLookup": True, **options}).json(root)


def read_json_folders(spark: SparkSession, folders: Mapping[str, Mapping[str, str]], schema: str | StructType) -> DataFrame:
    """JSON lines of many folders in one scan, with constants of their own: ``{folder: {column: value}}``.

    A file tells its folder by its own path, so neither the plan nor the number of scans grows with the folders. A folder has one set of constants.
    Folders may be patterns, which are looked up first.
    """
    hadoop, known = spark._jsc.hadoopConfiguration(), {}
    for folder, constants in folders.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        for status in path.getFileSystem(hadoop).globStatus(path) or []:
            known[status.getPath().toString()] = tuple(constants.values())
    names = list(next(iter(folders.values())))
    types = ", ".join(f"{name} string" for name in names)
    values = spark.createDataFrame([(_plain(path), *constants) for path, constants in known.items()], f"_folder string, {types}")
    # The scheme and its slashes are written in several ways.
    of_file = F.regexp_replace(F.regexp_replace(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), "/[^/]*$", ""), "^[a-z0-9]+:/*", "/")
    read = spark.read.schema(schema).json(list(known)).withColumn("_folder", of_file)
    # As many rows as the caller named folders.
    return read.join(F.broadcast(values), "_folder").drop("_folder")


def _plain(path: str) -> str:
    return re.sub("^[a-z0-9]+:/*", "/", path)


def read_json_inferred(spark: SparkSession, path) -> DataFrame:
    return spark.read.json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_partition_leafs(spark: SparkSession, root: str, leafs: Sequence[str]) -> DataFrame:
    """Some partition folders of a partitioned table, with their partition columns."""
    return spark.read.option("basePath", root).parquet(*[f"{root}/{leaf}" for leaf in leafs])


# -- sinks -------------------------------------------------------------------


def _writer(df: DataFrame, single_file: bool = False, partition_by: Sequence[str] = ()):
    # One file means one task, for results known to be small. It gets the finished rows by a shuffle,
    # so that what makes them still runs in as many tasks as before.
    # Rebalancing gives each partition few files of even size: Spark splits partitions
    # that got too much (a hot hour) and merges the small ones.
    if single_file:
        df = df.repartition(1)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    return df.write.mode("overwrite").partitionBy(*partition_by)


def write_csv(
    df: DataFrame, path: str, header: bool = True, compression: str = "none", sep: str = ",", single_file: bool = False
) -> None:
    writer = _writer(df, single_file).options(header=header, compression=compression, sep=sep, **TIME_FORMATS)
    writer.csv(path)


def write_json(df: DataFrame, path: str, compression: str = "gzip", partition_by: Sequence[str] = ()) -> None:
    _writer(df, False, partition_by).options(compression=compression, **TIME_FORMATS).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), single_file: bool = False) -> None:
    _writer(df, single_file, partition_by).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def replace_partitions(df: DataFrame, name: str, partition_by: Sequence[str], path: str | None = None) -> None:
    """Replace those partitions of a table that the rows belong to; make the table if there is none."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        write_table(df, name, partition_by, path)
        return
    ordered = df.select(spark.table(name).columns).hint("rebalance", *partition_by)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        ordered.write.mode("overwrite").insertInto(name)


def write_table(df: DataFrame, name: str, partition_by: Sequence[str], path: str | None = None) -> None:
    """Replace a partitioned table."""
    writer = _writer(df, False, partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_metrics(metrics: DataFrame, target: str, fmt: str = "parquet", **options) -> None:
    """Append metric rows to a table: a folder, or whatever the options of ``fmt`` describe (say JDBC)."""
    writer = metrics.write.format(fmt).mode("append").options(**options)
    if fmt == "jdbc":
        writer.option("dbtable", target).save()
    else:
        writer.save(target)


# -- layout ------------------------------------------------------------------


def sorted_export(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Globally sorted by ``keys`` then ``order``, in one range shuffle.

    The ranges cut through ``keys`` and ``order``, so the rows of one hot key
    spread over as many partitions as they need.
    """
    columns = [F.col(c) for c in [*keys, *order]]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of equal ``columns`` together where size permits; Spark cuts groups that are too large."""
    return df.hint("rebalance", *columns)


def with_constants(df: DataFrame, constants: Mapping[str, Column]) -> DataFrame:
    """Add literal partition columns to a freshly read part before it joins a union."""
    return df.withColumns(dict(constants))
