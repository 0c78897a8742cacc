"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# What lies between words, and what is in them.
SPACES, NO_SPACE = "[ \\t-\\r]+", "[^ \\t-\\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    return F.array_remove(F.split(filled(text), SPACES), "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hash52(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts, joined by colons; any SQL engine can repeat it."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))
