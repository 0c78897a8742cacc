"""Joins that stay even when one key holds a large share of the rows.

Spark's adaptive execution splits a hot key of either side of an inner join, of
the left side of a left, semi or anti join, and of the right side of a right
join. The functions below put every other case into one of those forms. None of
them hints a broadcast: Spark broadcasts a side by its measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# (column of the left side, column of the right side)
Pairs = Sequence[tuple[str, str]]


def _matches(on: Pairs) -> list[Column]:
    # By name, so that both sides may come from the same table; names must differ between the sides.
    return [F.col(a) == F.col(b) for a, b in on]


def inner_join(left: DataFrame, right: DataFrame, on: Pairs) -> DataFrame:
    return left.join(right, _matches(on), "inner")


def semi_join(left: DataFrame, right: DataFrame, on: Pairs) -> DataFrame:
    """Left rows with a match. Only the distinct keys of the right side travel."""
    keys = right.select([b for _, b in on]).distinct()
    return left.join(keys, _matches(on), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: Pairs) -> DataFrame:
    """Left rows without a match, null keys included. Only the distinct keys of the right side travel."""
    keys = right.select([b for _, b in on]).distinct()
    return left.join(keys, _matches(on), "left_anti")


def left_join(left: DataFrame, right: DataFrame, on: Pairs, hot_right: bool = False) -> DataFrame:
    """All left rows with their matches.

    A key that is hot on the right cannot be split in an outer join;
    ``hot_right`` runs the matches as an inner join and adds the rest.
    """
    if not hot_right:
        return left.join(right, _matches(on), "left")
    rest = anti_join(left, right, on)
    return inner_join(left, right, on).unionByName(rest, allowMissingColumns=True)


def right_join(left: DataFrame, right: DataFrame, on: Pairs, hot_left: bool = False) -> DataFrame:
    """All right rows with their matches, columns in left-right order."""
    swapped = left_join(right, left, [(b, a) for a, b in on], hot_right=hot_left)
    return swapped.select(*left.columns, *right.columns)


def full_join(left: DataFrame, right: DataFrame, on: Pairs, hot_right: bool = False) -> DataFrame:
    """All rows of both sides: the left join, then the right rows nobody matched.

    A full outer join could not split a hot key on either side.
    """
    rest = anti_join(right, left, [(b, a) for a, b in on])
    return left_join(left, right, on, hot_right).unionByName(rest, allowMissingColumns=True)


def join_using(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equally named keys, which appear once."""
    return left.join(right, list(keys), how)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equally named keys, where null equals null; the keys appear once."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(right, same, how).drop(*[f"_right_{k}" for k in keys])


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after a look at rows and bytes; beyond the bounds leave the join as it is."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def is_small(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> bool:
    """At most so many rows, and so many bytes as JSON text."""
    size = F.octet_length(F.to_json(F.struct("*")))
    rows, used = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and used <= max_bytes
