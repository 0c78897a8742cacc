"""Addresses, places and local time.

A range table holds address ranges: ``start`` and ``end`` (inclusive numbers) and
a ``geo`` struct. Where ranges overlap, the narrowest one counts. Ranges are cut at
the borders of buckets of 65,536 addresses and made disjoint within each bucket. A
prefix table holds networks of both families instead, of which the longest counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from clicklake.functions.numbers import ip_to_long, with_ip_key
from clicklake.functions.text import json_field
from clicklake.functions.times import known_zone, local_time
from clicklake.operators.aggregates import count_by
from clicklake.operators.joins import broadcast_if_small
from clicklake.sources.files import settled

BUCKET = 65_536
MAX_BROADCAST_BYTES = 64 << 20
DEFAULT_ZONE = "America/New_York"


def _pieces(ranges: DataFrame) -> DataFrame:
    first, last = F.floor(F.col("start") / BUCKET), F.floor(F.col("end") / BUCKET)
    return ranges.withColumn("bucket", F.explode(F.sequence(first, last))).select(
        "bucket",
        F.greatest("start", F.col("bucket") * BUCKET).alias("start"),
        F.least("end", F.col("bucket") * BUCKET + (BUCKET - 1)).alias("end"),
        "geo",
        # Narrow ranges first; then a rule that leaves no tie between different places.
        F.struct(F.col("end") - F.col("start"), "start", F.to_json("geo")).alias("_rank"),
    )


def _blocks(pieces: DataFrame) -> DataFrame:
    """The pieces as aligned blocks (bucket, level, block) of 2**level addresses, at most two per level.

    Those are the blocks that make up a range in a binary tree of its bucket: of each level the odd first one and the
    last one before an odd border.
    """
    levels = BUCKET.bit_length() - 1
    first, after = F.col("start") - F.col("bucket") * BUCKET, F.col("end") + 1 - F.col("bucket") * BUCKET

    def of_level(k: int) -> list[Column]:
        low, high = F.floor((first + (2**k - 1)) / 2**k), F.floor(after / 2**k)
        block = lambda number, on: F.when((low < high) & on, F.struct(F.lit(k).alias("level"), number.alias("block")))
        return [block(low, low % 2 == 1), block(high - 1, high % 2 == 1)]

    # The whole bucket is one block of the highest level.
    found = [block for k in range(levels + 1) for block in of_level(k)]
    return pieces.withColumn("_block", F.explode(F.array_compact(F.array(*found)))).select("bucket", "_block.*", "geo", "_rank")


def _disjoint(pieces: DataFrame) -> DataFrame:
    """Pieces (bucket, start, end, geo) of which no two overlap; each address keeps its narrowest range.

    Borders of pieces cut a bucket into intervals that no border divides, so the first address of an interval tells all
    of it. An address lies in one block of each of 17 levels, and a piece is made of at most 32 blocks: the narrowest
    piece of an interval is the best of the best pieces of its 17 blocks. No piece meets another one.
    """
    best = _blocks(pieces).groupBy("bucket", "level", "block").agg(F.min_by("geo", "_rank").alias("geo"), F.min("_rank").alias("_rank"))
    borders = pieces.select("bucket", F.explode(F.array(F.col("start"), F.col("end") + 1)).alias("start")).distinct()
    following = F.lead("start").over(Window.partitionBy("bucket").orderBy("start"))
    cuts = borders.withColumn("end", following - 1).where(F.col("end").isNotNull())
    level = F.explode(F.sequence(F.lit(0), F.lit(BUCKET.bit_length() - 1)))
    # A border may be the first address after the bucket; it begins no interval there.
    probes = cuts.withColumn("level", level).withColumn(
        "block", F.floor((F.col("start") - F.col("bucket") * BUCKET) / F.pow(F.lit(2), F.col("level")))
    )
    met = probes.join(best, ["bucket", "level", "block"])
    return met.groupBy("bucket", "start", "end").agg(F.min_by("geo", "_rank").alias("geo"))


def _settled_pieces(ranges: DataFrame) -> tuple[DataFrame, int, int]:
    """Disjoint pieces, how many there are and their bytes. A sound table is used as it is, others are cut once and kept."""
    pieces = _pieces(ranges)
    order = Window.partitionBy("bucket").orderBy("start", "end")
    size = F.octet_length(F.to_json(F.struct("geo"))) + 24
    told = pieces.withColumn("_next", F.lead("start").over(order)).agg(
        F.count("*"), F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(F.col("end") >= F.col("_next")), F.lit(False))
    )
    rows, used, overlap = told.first()
    if not overlap:
        return pieces.drop("_rank"), rows, used
    pieces = settled(_disjoint(pieces))
    rows, used = pieces.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return pieces, rows, used


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Pieces that reach into a later one; empty for a sound range table."""
    following = F.lead("start").over(Window.partitionBy("bucket").orderBy("start", "end"))
    return _pieces(ranges).withColumn("next_start", following).where(F.col("end") >= F.col("next_start"))


def range_lookup(df: DataFrame, ip: str, ranges: DataFrame, max_broadcast_rows: int = 200_000) -> DataFrame:
    """All rows with the ``geo`` of the narrowest range their address lies in, null for a miss.

    Up to ``max_broadcast_rows`` pieces (counted and measured, not assumed) go to every
    executor, and the rows are not shuffled. Beyond that each distinct
    address is resolved once, by one sorted pass per bucket over addresses and
    range starts, neither of which can exceed the bucket; the rows then join by
    address, where Spark can split a hot one.
    """
    rows = df.withColumn("_ip", ip_to_long(F.col(ip)))
    pieces, n_pieces, n_bytes = _settled_pieces(ranges)
    if n_pieces <= max_broadcast_rows and n_bytes <= MAX_BROADCAST_BYTES:
        within = (F.floor(F.col("_ip") / BUCKET) == F.col("bucket")) & F.col("_ip").between(
            F.col("start"), F.col("end")
        )
        return rows.join(F.broadcast(pieces), within, "left").drop("_ip", "bucket", "start", "end")

    # No filter on the parsed address: Catalyst would parse it once more to push the filter below.
    addresses = rows.select("_ip").distinct()
    probes = addresses.select(F.floor(F.col("_ip") / BUCKET).alias("bucket"), F.col("_ip"), F.col("_ip").alias("pos"))
    starts = pieces.select(
        "bucket", F.col("start").alias("pos"), F.struct(F.col("end").alias("until"), "geo").alias("_range")
    )
    # At equal positions the start comes first: its address is null, and nulls sort low.
    upto = Window.partitionBy("bucket").orderBy("pos", "_ip").rowsBetween(Window.unboundedPreceding, 0)
    resolved = (
        probes.unionByName(starts, allowMissingColumns=True)
        .withColumn("_hit", F.last("_range", ignorenulls=True).over(upto))
        .where(F.col("_ip").isNotNull() & (F.col("_ip") <= F.col("_hit.until")))
        .select("_ip", F.col("_hit.geo").alias("geo"))
    )
    return rows.join(resolved, "_ip", "left").drop("_ip")


def _masked(number: str, kept: str) -> Column:
    """The first ``kept`` bits of a 64-bit number, all for 64 and more, none for 0 and less."""
    return F.expr(f"CASE WHEN {kept} >= 64 THEN {number} WHEN {kept} <= 0 THEN 0L ELSE {number} & shiftleft(-1L, 64 - {kept}) END")


def prefix_table(networks: DataFrame, network: str = "network") -> DataFrame:
    """(family, bits, high, low, geo) of networks written as ``address/bits``, IPv4 and IPv6.

    Bits behind the prefix are cleared, networks that cannot be read are left out, and of equal ones one counts.
    IPv4 networks written as IPv6 ones (``::ffff:10.0.0.0/104``) are IPv4 networks.
    """
    split = networks.select(
        F.substring_index(network, "/", 1).alias("_address"), F.substring_index(network, "/", -1).try_cast("int").alias("_bits"), "geo"
    )
    # Kept: filters and joins on the parts of a key would parse addresses many times over.
    keyed = settled(with_ip_key(split, "_address", "_key"))
    mapped = F.col("_address").contains(":") & (F.col("_key.family") == 4)
    keyed = keyed.withColumn("_own", F.when(mapped, F.col("_bits") - 96).otherwise(F.col("_bits")))
    most = F.when(F.col("_key.family") == 4, 32).otherwise(128)
    sound = keyed.where(F.col("_own").between(0, most)).select(F.col("_key.family").alias("family"), F.col("_own").alias("bits"), "_key.high", "_key.low", "geo")
    return _prefix_of(sound).groupBy("family", "bits", "high", "low").agg(F.min_by("geo", F.to_json("geo")).alias("geo"))


def _prefix_of(keys: DataFrame) -> DataFrame:
    """Keys with everything behind their first ``bits`` cleared; IPv4 numbers are the low half's last 32 bits."""
    v4 = F.col("family") == 4
    return keys.withColumns({
        "high": F.when(v4, F.col("high")).otherwise(_masked("high", "bits")),
        "low": F.when(v4, _masked("low", "(bits + 32)")).otherwise(_masked("low", "(bits - 64)")),
    })


def prefix_lookup(df: DataFrame, ip: str, prefixes: DataFrame) -> DataFrame:
    """All rows with the ``geo`` of the longest prefix of their address, IPv4 or IPv6; null for a miss.

    Each distinct address asks once for each length that the table has for its family, and takes the longest answer.
    Only keys travel; the rows then join by address, where Spark can split a hot one.
    """
    prefixes = settled(prefixes)
    lengths = {r["family"]: r["bits"] for r in prefixes.groupBy("family").agg(F.collect_set("bits").alias("bits")).collect()}
    asked = lambda family: F.array(*map(F.lit, sorted(lengths.get(family, [])))).cast("array<int>")  # noqa: E731  129 at most
    addresses = settled(with_ip_key(df.select(F.col(ip).alias("_address")).distinct(), "_address", "_key"))
    probes = addresses.select(
        "_address", "_key.*", F.explode(F.when(F.col("_key.family") == 4, asked(4)).otherwise(asked(6))).alias("bits")
    )
    table = broadcast_if_small(prefixes, 200_000)
    met = _prefix_of(probes).join(table, ["family", "bits", "high", "low"])
    resolved = met.groupBy("_address").agg(F.max_by("geo", "bits").alias("geo"))
    return df.join(resolved, F.col(ip) == F.col("_address"), "left").drop("_address")


def geo_json(df: DataFrame) -> DataFrame:
    """``geo`` as JSON text, empty for a miss."""
    return df.withColumn("geo_json", F.coalesce(F.to_json("geo"), F.lit(""))).drop("geo")


def client_time(
    df: DataFrame, ts: str, ip: str, ranges: DataFrame, stored_zone: str = "UTC", **options
) -> DataFrame:
    """Rows with the visitor's zone (or the default) and wall clock (or the stored time); unknown zone ids are no zone.

    ``stored_zone`` is the zone of a zone-free ``ts``; a ``timestamp`` is an instant and needs none.
    """
    is_instant = isinstance(df.schema[ts].dataType, T.TimestampType)
    stored = F.current_timezone() if is_instant else F.lit(stored_zone)
    zone = F.col("geo.timezone")
    # Unknown zones are told once per range: a conversion to them would fail the query.
    ranges = ranges.withColumn("geo", F.col("geo").withField("timezone", known_zone(zone)))
    return (
        range_lookup(df, ip, ranges, **options)
        .withColumn("client_time", local_time(F.col(ts), zone, stored))
        .withColumn("timezone", F.coalesce(zone, F.lit(DEFAULT_ZONE)))
        .drop("geo")
    )


def _geo_field(df: DataFrame, geo: str, field: str) -> Column:
    """A field of ``geo``, which is the struct of a lookup or its JSON text; null where the ranges do not have it."""
    kind = df.schema[geo].dataType
    if isinstance(kind, T.StructType):
        return F.col(f"{geo}.{field}") if field in kind.names else F.lit(None).cast("string")
    return json_field(F.col(geo), f"$.{field}")


def geo_mobility(df: DataFrame, day: str, user: str, geo: str = "geo") -> DataFrame:
    """Distinct places (country and region) per user and day; an unknown place counts as one."""
    place = F.struct(*[_geo_field(df, geo, field).alias(field) for field in ("countryName", "region")])
    return df.select(day, user, place.alias("place")).groupBy(day, user).agg(
        F.count_distinct("place").alias("places")
    )


def geo_breakdown(df: DataFrame, fields: Sequence[str], by: Sequence[str] = (), geo: str = "geo") -> DataFrame:
    """Rows per combination of geo fields (and ``by``), most frequent first."""
    extracted = {field: _geo_field(df, geo, field) for field in fields}
    return count_by(df.withColumns(extracted), *by, *fields)
