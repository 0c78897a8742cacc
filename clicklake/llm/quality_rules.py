"""Quality rules as a ledger of bits.

Every rule is evaluated once per text. Its outcome is one bit of ``failed_bits``, stored next to the measurements it
rests on. A policy is a versioned list of rules, that is, a mask; applying or comparing policies and asking what a
single rule costs are bitwise operations on the stored ledger and never read a text again.

Null texts count as empty. A ledger has one row per input row, repeated rows and null ids included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clicklake.llm.common import NO_SPACE, filled, fresh, words

# Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]+"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# The place of a rule is its bit: append new rules, never reorder. Each is a condition over the measurements.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "100 * n_symbols > 40 * n_words",
    "repeated_lines": "n_dup_lines >= 3 AND 100 * n_dup_lines > 60 * n_lines",
    "short_words": "n_words > 0 AND 10 * word_chars < 15 * n_words",
    "long_words": "n_words > 0 AND word_chars > 30 * n_words",
}

BASE = ("few_words", "repeated_windows")
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": BASE,
    "web-1": (*BASE, "many_symbols", "repeated_lines", "short_words", "long_words"),
}


def mask(rules: Sequence[str], known: Mapping[str, str] = RULES) -> int:
    """The bits of the named rules."""
    places = list(known)
    return sum(1 << places.index(r) for r in set(rules))


def _window_hashes(tokens: Column, width: int) -> Column:
    last = F.size(tokens) - width
    parts = lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(width)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), parts)).otherwise(F.array().cast("array<bigint>"))


def measured(docs: DataFrame, text: str = "text", to: str = "measures") -> DataFrame:
    """All columns plus a struct of measurements under the name ``to``.

    A word repeats when it lies in a window of three words that the text holds twice or more. Windows are compared by
    their 64-bit hashes; texts without an equal pair of them stop there, the others sort theirs once.
    """
    name = lambda part: fresh(docs, f"__quality_{part}")
    tokens, lines, hashes, ordered, places = map(name, ("words", "lines", "hashes", "ordered", "places"))
    whole = filled(F.col(text))
    out = docs.withColumns({tokens: words(F.col(text)), lines: F.split(whole, "\n")})
    out = out.withColumns({
        hashes: _window_hashes(F.col(tokens), 3),
        lines: F.filter(lines, lambda line: line.rlike(NO_SPACE)),
    })
    located = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn(ordered, F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), located))
    same = lambda x, j: x["h"] == F.get(F.col(ordered), j)["h"]
    repeated = F.filter(
        ordered, lambda x, j: F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False))
    )
    out = out.withColumn(places, F.sort_array(F.transform(repeated, lambda x: x["i"])))
    covered = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(F.col(places), j + 1) - p, F.lit(3))))
    repeats = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))
    values = {
        "n_words": F.size(tokens),
        "word_chars": F.length(F.array_join(tokens, "")),
        "n_symbols": F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeats,
    }
    measures = F.struct(*[values[m].cast("long").alias(m) for m in MEASURES])
    return out.withColumn(to, measures).drop(tokens, lines, hashes, ordered, places)


def failed_bits(measures: str, rules: Mapping[str, str] = RULES) -> Column:
    """The bits of the rules that the measurements in a struct column fail."""
    inner = {m: f"`{measures}`.{m}" for m in MEASURES}
    bits = F.lit(0).cast("long")
    for place, condition in enumerate(rules.values()):
        for m, path in inner.items():
            condition = condition.replace(m, path)
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return bits


def passes(bits: Column, policy: Sequence[str]) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy))) == 0


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, measurements and failed bits of every row."""
    rows = measured(docs.select(F.col(key).alias("key"), F.col(text).alias("text")))
    rows = rows.withColumn("failed_bits", failed_bits("measures"))
    return rows.select(F.col("key").alias(key), "measures.*", "failed_bits")


def ablation(rows: DataFrame, policy: Sequence[str], bits: str = "failed_bits") -> DataFrame:
    """What each rule of a policy does: rows that fail it, fail nothing else, and pass without it.

    The ledger shrinks to one row per set of bits before anything else looks at it.
    """
    whole = mask(policy)
    counted = rows.groupBy(F.col(bits).bitwiseAND(F.lit(whole)).alias("b")).agg(F.count("*").alias("n"))
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).cast("long").alias("bit")) for r in policy])
    per_rule = counted.select("b", "n", F.explode(each).alias("r")).select("b", "n", "r.*")
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")
    return per_rule.groupBy("rule").agg(
        total(F.col("b").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(F.col("b") == F.col("bit")).alias("failed_alone"),
        total(F.col("b").bitwiseAND(F.lit(whole).bitwiseXOR(F.col("bit"))) == 0).alias("kept_without"),
        total(F.col("b") == 0).alias("kept"),
    )


def keep(docs: DataFrame, policy: Sequence[str] = POLICIES["web-1"], text: str = "text") -> DataFrame:
    """The rows that a policy accepts, with their own columns."""
    to, bits = fresh(docs, "__quality"), fresh(docs, "__failed_bits")
    judged = measured(docs, text, to).withColumn(bits, failed_bits(to)).drop(to)
    # Not a filter: Catalyst would push it down and copy all measurements into it, many times over. No row comes of a null.
    one = F.when(passes(F.col(bits), policy), F.array(F.lit(True)))
    return judged.withColumn(to, F.explode(one)).drop(to, bits)
