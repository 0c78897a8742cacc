"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def growth(count: Column, previous: Column) -> Column:
    """Relative change against the previous count; 100.0 when that was zero, null when unknown."""
    change = (count - previous).cast("double") / F.nullif(previous, F.lit(0)).cast("double")
    return F.when(count.isNull(), F.lit(None).cast("double")).when(previous == 0, F.lit(100.0)).otherwise(change)


def floor_mod(x: Column, y: Column) -> Column:
    """Remainder with the sign of the divisor, as ``Math.floorMod`` gives it."""
    rest = x % y
    return F.when((rest != 0) & ((rest < 0) != (y < 0)), rest + y).otherwise(rest)


IPV4 = r"\A(?:(?:25[0-5]|2[0-4]\d|[01]?\d{1,2})(?:\.(?!\z)|\z)){4}\z"


def _octets(ip: Column) -> Column:
    cut = F.substring_index
    parts = [cut(ip, ".", 1), cut(cut(ip, ".", 2), ".", -1), cut(cut(ip, ".", -2), ".", 1), cut(ip, ".", -1)]
    a, b, c, d = [part.cast("bigint") for part in parts]
    return ((a * 256 + b) * 256 + c) * 256 + d


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 address as a number; null when malformed."""
    return F.when(ip.rlike(IPV4), _octets(ip))


# Either eight groups, or fewer around one "::"; a dotted IPv4 address may stand for the last two.
_GROUPS = r"\A(?=(?:[0-9A-Fa-f]{0,4}:){2,8}[0-9A-Fa-f]{0,4}\z)(?!.*:::)(?!:[^:])(?!.*[^:]:\z)(?!.*::.*::).*\z"


def with_ip_key(df: DataFrame, ip: str, to: str) -> DataFrame:
    """Add a struct (family, high, low) of an address: two numbers of 64 bits, null when malformed.

    IPv4 addresses, also those written as IPv6 ones (``::ffff:1.2.3.4``), are of family 4 with their number as ``low``;
    others are of family 6. The steps are columns, so each runs once per row.
    """
    taken = {c.lower() for c in df.columns}

    def name(part: str) -> str:
        while f"_ip_{part}" in taken:
            part = f"_{part}"
        return f"_ip_{part}"

    v4, tail, text, digits = map(name, ("v4", "tail", "text", "digits"))
    hexed = lambda n: F.lower(F.lpad(F.conv(n.cast("string"), 10, 16), 4, "0"))
    dotted = F.substring_index(F.col(ip), ":", -1)
    stepped = df.withColumns({
        v4: ip_to_long(F.col(ip)),
        # A dotted end as two groups.
        tail: F.when(F.col(ip).contains(":") & F.col(ip).contains("."), ip_to_long(dotted)),
    }).withColumn(
        text,
        F.when(
            F.col(tail).isNotNull(),
            F.concat(F.expr(f"left(`{ip}`, length(`{ip}`) - length(substring_index(`{ip}`, ':', -1)))"),
                     hexed(F.shiftright(tail, 16)), F.lit(":"), hexed(F.col(tail).bitwiseAND(0xFFFF))),
        ).otherwise(F.col(ip)),
    )
    groups = lambda t: F.filter(F.split(t, ":"), lambda g: g != "")
    left, right = groups(F.substring_index(text, "::", 1)), groups(F.substring_index(text, "::", -1))
    padded = lambda gs: F.array_join(F.transform(gs, lambda g: F.lpad(g, 4, "0")), "")
    whole = F.when(
        F.col(text).contains("::"),
        F.when(
            F.size(left) + F.size(right) < 8,
            F.concat(padded(left), F.repeat(F.lit("0000"), 8 - F.size(left) - F.size(right)), padded(right)),
        ),
    ).when(F.size(groups(F.col(text))) == 8, padded(groups(F.col(text))))
    written = F.when(F.col(text).rlike(_GROUPS), F.lower(whole))
    stepped = stepped.withColumn(digits, F.when(F.col(text).contains(":"), written))
    half = lambda start: F.conv(F.substring(digits, start, 16), 16, -10).cast("bigint")
    key = lambda family, high, low: F.struct(F.lit(family).alias("family"), high.alias("high"), low.alias("low"))
    nothing = F.lit(0).cast("bigint")
    mapped = F.col(digits).startswith("0" * 20 + "ffff")
    return stepped.withColumn(
        to,
        F.when(F.col(v4).isNotNull(), key(4, nothing, F.col(v4)))
        .when(mapped, key(4, nothing, half(17).bitwiseAND(0xFFFFFFFF)))
        .when(F.col(digits).isNotNull(), key(6, half(1), half(17))),
    ).drop(v4, tail, text, digits)
