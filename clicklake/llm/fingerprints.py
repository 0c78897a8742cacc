"""Document fingerprints by consistent weighted sampling.

A text is a bag of terms (what stands between spaces), each weighted by how often it occurs. For sample number d, every
term draws gamma and uniform variates that depend on the term and d alone; they quantise the term's weight and give it
a rank, and the term of the smallest rank is the sample. Two texts share a sample with the probability of their generalised Jaccard similarity:
the sum of the smaller weights over the sum of the larger ones.

The smallest rank is a function of term, quantised weight and d, so it stands for the sample itself. Null texts count
as empty, and an empty text has one term, the empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import filled
from clicklake.llm.sharding import _at_or_below
from clicklake.sources.files import settled

SAMPLES = 64
ROWS_PER_RANGE = 1000
#: Ranges of ids, and so the boundaries that the driver holds. Beyond, ranges grow and spill; results stay the same.
MOST_RANGES = 10_000
_LAST = (1 << 63) - 1


def weighted_terms(text: Column) -> Column:
    """Sorted hashes of a text's terms, repeats included."""
    return F.sort_array(F.transform(F.split(filled(text), " "), lambda w: F.xxhash64(w)))


def runs(ordered: str) -> Column:
    """Where the runs in a column of sorted hashes begin."""
    return F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (F.get(F.col(ordered), i) != F.get(F.col(ordered), i - 1)),
    )


def rank(term: Column, log_weight: Column, sample: int) -> Column:
    """The logarithm of a term's rank in one sample. All variates come from one hash of 64 bits."""
    bits = F.xxhash64(term, F.lit(sample))
    part = lambda k: F.shiftrightunsigned(bits, 12 * k).bitwiseAND(0xFFF) + 0.5
    gamma = lambda k: math.log(2.0**24) - F.ln(part(k) * part(k + 1))
    shift = (F.shiftrightunsigned(bits, 48) + 0.5) * (1.0 / 65536.0)
    r = gamma(0)
    return F.ln(gamma(2)) - r * (F.floor(log_weight / r + shift) - shift + 1.0)


def fingerprinted(rows: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """One row per distinct keys, with ``codes``: one short code per sample. Needs one row per keys.

    If the rows are already dealt by some of the keys, nothing is shuffled.
    """
    ordered = rows.select(*keys, weighted_terms(F.col(text)).alias("__h"))
    marked = ordered.withColumn("__at", runs("__h"))
    terms = F.transform("__at", lambda i, j: F.struct(
        F.get(F.col("__h"), i).alias("term"),
        (F.coalesce(F.get(F.col("__at"), j + 1), F.size("__h")) - i).alias("weight"),
    ))
    exploded = marked.withColumn("__terms", terms).select(*keys, F.explode_outer("__terms").alias("t"))
    exploded = exploded.select(*keys, F.col("t.term").alias("term"), F.ln(F.col("t.weight")).alias("log_weight"))
    least = exploded.groupBy(*keys).agg(
        *[F.min(rank(F.col("term"), F.col("log_weight"), d)).alias(f"m{d}") for d in range(samples)]
    )
    code = lambda c: F.coalesce(F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(c), F.lit(1 << 32)))), 8, "0"), F.lit("0" * 8))
    codes = F.array(*[F.when(F.col(f"m{d}").isNull(), F.lit("0" * 8)).otherwise(code(f"m{d}")) for d in range(samples)])
    return least.select(*keys, codes.alias("codes"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    same = sum((F.get(a, F.lit(d)) == F.get(b, F.lit(d))).cast("int") for d in range(samples))
    return same.cast("double") / samples


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every row with the text that follows in the order of ids (nulls last), the first one after the last.

    Ids are cut into ranges, and each range also gets the first row of the one behind it (``extra``), so that texts
    are dealt once. Rows get ``range`` and ``row``, their place in it.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("id"), filled(F.col(text)).alias("text"))
    rows = rows.withColumn("at", F.coalesce(F.col("id"), F.lit(_LAST)))
    n = rows.count()
    cuts = min(-(-n // ROWS_PER_RANGE), MOST_RANGES)
    bounds = []
    if cuts > 1:
        shares = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
        bounds = sorted(set(rows.agg(F.percentile_approx("at", shares, 20 * cuts)).first()[0]))
    place = _at_or_below(bounds, F.col("at"))
    ranged = rows.withColumn("range", place)
    # One row per range, at most MOST_RANGES.
    firsts = settled(ranged.groupBy("range").agg(F.min("at").alias("first")))
    texts = ranged.join(F.broadcast(firsts), "range").where("at = first").groupBy("range", "at").agg(F.min("text").alias("text"))
    whole = Window.orderBy("range")
    around = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = F.coalesce(F.lead(F.struct("at", "text")).over(whole), F.first(F.struct("at", "text")).over(around))
    extra = settled(texts).select("range", ends.alias("e")).select(
        F.lit(None).cast("bigint").alias("id"), F.col("e.text").alias("text"), F.col("e.at").alias("at"), "range",
        F.lit(True).alias("extra"),
    )
    both = rows.withColumns({"range": F.lit(None).cast("int"), "extra": F.lit(False)}).unionByName(extra)
    both = both.withColumn("range", F.coalesce("range", place))
    order = Window.partitionBy("range").orderBy("extra", "at", "text")
    return both.select(
        "range", F.row_number().over(order).alias("row"), "extra", "id", "text", F.lead("text").over(order).alias("next")
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as many characters of another one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they are to each other and to the next one."""
    rows = with_next(docs, key, text)
    other = F.when(~F.col("extra"), edited(F.col("text"), F.col("next")))
    rows = rows.withColumn("edited", other).withColumns({
        "n_chars": F.length("text").cast("long"), "edited_sha256": F.sha2(F.col("edited").cast("binary"), 256),
    })
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))
    )
    keys = ["range", "row", "extra", "id", "n_chars", "edited_sha256"]
    each = rows.select(*keys, F.explode(kinds).alias("k")).select(*keys, "k.*").where("kind = 0 OR NOT extra")
    prints = fingerprinted(each, [*keys, "kind"], "text", samples)
    pick = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("codes")))
    pairs = prints.groupBy(*keys).agg(pick(0).alias("own"), pick(1).alias("other"))
    order = Window.partitionBy("range").orderBy("row")
    out = pairs.withColumn("following", F.lead("own").over(order)).where("NOT extra")
    return out.select(
        F.col("id").alias(key), "n_chars", "edited_sha256", F.array_join("own", "").alias("fingerprint"),
        F.array_join("other", "").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), samples).alias("near_next"),
    )
