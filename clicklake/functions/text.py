"""Text, URL and JSON column functions."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

HOME = "home"


def strip_quotes(c: Column) -> Column:
    """Delete every single and double quote."""
    return F.translate(c, "\"'", "")


def session_key(cookie: Column) -> Column:
    """The part of a session cookie before its first dot."""
    return F.substring_index(cookie, ".", 1)


def replace_literal(template: Column, key: Column, value: Column) -> Column:
    """Replace ``key`` by ``value``; the template stays as is when either is empty or null."""
    usable = (F.length(key) > 0) & (F.length(value) > 0)
    return F.when(usable, F.replace(template, key, value)).otherwise(template)


def path_level(url: Column, level: int) -> Column:
    """The ``level``-th piece of ``url`` between slashes, null when there is none."""
    return F.get(F.split(url, "/"), level)


def json_field(c: Column, path: str) -> Column:
    """JSON path lookup that gives null for null or broken text."""
    return F.get_json_object(c, path)


def json_number_plus(c: Column, path: str, add: int) -> Column:
    """Number at a JSON path plus a constant; null when the text is not a number."""
    return F.get_json_object(c, path).try_cast("bigint") + F.lit(add)


def has_query_param(params: Column, name: str) -> Column:
    """Whether a raw query string holds the key ``name``, with or without a value.

    Leading and trailing control characters and blanks go first, then every
    question mark; blank and null strings hold no key.
    """
    trimmed = F.regexp_replace(params, r"^[\x00-\x20]+|[\x00-\x20]+\z", "")
    bare = F.translate(trimmed, "?", "")
    return F.coalesce(bare.rlike(rf"(\A|&){re.escape(name)}(=|&|\z)"), F.lit(False))


def _last_piece(text: Column, separator: str) -> Column:
    """The last piece of ``text`` between separators, cut from left to right.

    Trailing empty pieces do not count; a text of separators only has no last piece.
    """
    after = F.substring_index(text, separator, -1)
    pieces = F.array_remove(F.split(text, re.escape(separator)), "")
    # What follows the last separator is the last piece, unless it is empty or separators overlap ("///").
    overlaps = [separator + separator[k:] for k in range(1, len(separator)) if separator.endswith(separator[:k])]
    plain = reduce(and_, [~text.contains(overlap) for overlap in overlaps], after != "")
    return F.when(plain | (text == ""), after).otherwise(F.try_element_at(pieces, F.lit(-1)))


def _shorten_pair(segment: Column) -> Column:
    # "a=b" -> "a=..."; a segment made of equals signs only has no name and gives null.
    shortened = F.when(
        F.rtrim(segment, F.lit("=")) != "", F.concat(F.substring_index(segment, "=", 1), F.lit("=..."))
    )
    return F.when(segment.contains("="), shortened).otherwise(segment)


def with_page_category(df: DataFrame, referrer: str, site: str, out: str = "page_category") -> DataFrame:
    """Add the section of the page a visitor came from.

    The section is the first path level below ``site`` (the second one below
    ``account``); for foreign addresses the host counts as level zero. Whatever
    cannot be read that way belongs to the home page.

    The steps are columns of their own, so that each is evaluated once and the
    generated code stays small.
    """
    url, path, levels = F.col("_url"), F.col("_path"), F.col("_levels")
    first, second = F.get(levels, 1), F.get(levels, 2)
    section = (
        F.when((path != "") & (F.get(levels, 0) == "") & (F.size(levels) == 1), F.lit(None))
        .when(F.size(levels) == 1, F.get(levels, 0))
        .when((first == "account") & (F.size(levels) > 2), second)
        .otherwise(first)
    )
    encoded = F.col(referrer).contains("%") | F.col(referrer).contains("+")
    decoded = F.coalesce(F.when(encoded, F.try_url_decode(F.col(referrer))), F.col(referrer))
    head = F.when(F.translate(url, "?", "") != "", F.substring_index(url, "?", 1))
    category = F.when(F.size(levels) == 1, F.col("_section")).otherwise(_shorten_pair(F.col("_section")))
    return (
        df.withColumn("_url", decoded)
        .withColumn("_head", head)
        .withColumn("_address", _last_piece(F.col("_head"), "//"))
        .withColumn("_path", _last_piece(F.col("_address"), site))
        .withColumn("_levels", F.split(F.rtrim(path, F.lit("/")), "/"))
        .withColumn("_section", section)
        .withColumn(out, F.when(F.col(referrer) == "", F.lit(HOME)).otherwise(F.coalesce(category, F.lit(HOME))))
        .drop("_url", "_head", "_address", "_path", "_levels", "_section")
    )
