"""Projections over whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, _parse_datatype_string


def project_map(df: DataFrame, columns: Mapping[str, Column], drop: Sequence[str] = ()) -> DataFrame:
    """Add a map of named columns in one flat projection, then drop the inputs."""
    return df.withColumns(dict(columns)).drop(*[c for c in drop if c not in columns])


def cast_schema(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Cast the listed columns; they end up behind the others, in schema order.

    Values that do not fit become null.
    """
    fields = (schema if isinstance(schema, StructType) else _parse_datatype_string(schema)).fields
    listed = {f.name for f in fields}
    casts = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    return df.select(*[c for c in df.columns if c not in listed], *casts)


def case_column(df: DataFrame, name: str, text: str) -> DataFrame:
    """A column from SQL expression text."""
    return df.withColumn(name, F.expr(text))


def values_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small dimension table from literals."""
    return spark.createDataFrame(list(rows), schema)
