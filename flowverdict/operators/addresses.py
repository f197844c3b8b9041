"""Addresses in any spelling, and their longest matching network.

An address is held as 128 bits in a string of 0 and 1; IPv4 stands in the block ::ffff:0:0/96,
so both versions share one table.  ``address_bits`` reads

* IPv4 of one to four parts, each decimal, octal (leading 0) or hexadecimal (0x); the last part
  fills the remaining bytes, so ``2130706433``, ``0x7f.1`` and ``0177.0.0.1`` are 127.0.0.1;
* IPv6 with ``::``, with a trailing dotted IPv4, in brackets or with a zone.

Anything else is null and lies in no network.

``longest_match`` joins without comparing each address with each network: an address has one
prefix for each length that occurs in the table (129 at most), and prefixes meet networks by
an equi-join on (length, bits).  Equal addresses are looked up once.  A small table is
broadcast; otherwise it is copied ``salts`` times, so that the addresses of a busy network are dealt over
as many tasks.  Networks of equal prefix: the least name wins.  Null addresses, nulls in
the table and spellings that cannot be read match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowverdict.operators.decoding import bound

BITS = 128
SALTS = 16
BROADCAST_NETWORKS = 100_000
V4_LEAD = "0" * 80 + "1" * 16
_V4_PART = "(?:0[xX][0-9a-fA-F]{1,8}|[0-9]{1,11})"


def _number(part: Column) -> Column:
    """The value of an IPv4 part; null if it is none."""
    digits = F.substring(part, F.lit(3), F.length(part))
    return (
        F.when(part.rlike("^0[xX]"), F.conv(digits, 16, 10))
        .when(part.rlike("^0[0-7]+$"), F.conv(part, 8, 10))
        .when(part.rlike("^(0|[1-9][0-9]*)$"), part)
        .try_cast("long")
    )


def _bits(number: Column, width: int) -> Column:
    return F.lpad(F.bin(number), width, "0")


def _v4(text: Column) -> Column:
    def joined(numbers: Column) -> Column:
        n = F.size(numbers)
        last = numbers[n - 1]
        size = (5 - n) * 8
        lead = F.transform(F.slice(numbers, F.lit(1), n - 1), lambda x: _bits(x, 8))
        fits = ~F.exists(numbers, lambda x: x.isNull()) & (last < F.pow(F.lit(2.0), size))
        fits &= ~F.exists(F.slice(numbers, F.lit(1), n - 1), lambda x: x > 255)
        tail = F.lpad(F.bin(last), size, "0")
        return F.when(F.coalesce(fits, F.lit(False)), F.concat(F.array_join(lead, ""), tail))

    shape = text.rlike(rf"^{_V4_PART}(\.{_V4_PART}){{0,3}}$")
    numbers = F.transform(F.split(text, r"\."), _number)
    return F.when(shape, bound(numbers, joined))


def _v6(text: Column) -> Column:
    """Bits of an IPv6 text without brackets and zone."""

    def groups(side: Column) -> Column:
        """The 16-bit groups of a side, as bits; a dotted tail counts as two."""
        parts = F.when(side == "", F.array().cast("array<string>")).otherwise(F.split(side, ":"))

        def as_bits(part: Column) -> Column:
            dotted = part.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
            group = F.when(part.rlike("^[0-9a-fA-F]{1,4}$"), F.lpad(F.conv(part, 16, 2), 16, "0"))
            return F.when(dotted, _v4(part)).otherwise(group)

        return F.transform(parts, as_bits)

    def whole(sides: Column) -> Column:
        def joined(both: Column) -> Column:
            left, right = F.array_join(both[0], ""), F.array_join(both[1], "")
            bad = F.exists(both[0], lambda x: x.isNull()) | F.exists(both[1], lambda x: x.isNull())
            # A dotted part, which has 32 bits, stands last.
            parts = F.concat(both[0], both[1])
            early = F.exists(
                F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.length(x) > 16
            ) | ((F.size(sides) == 2) & F.exists(both[0], lambda x: F.length(x) > 16))
            gap = BITS - F.length(left) - F.length(right)
            filled = F.when(F.size(sides) == 2, gap >= 16).otherwise(gap == 0)
            return F.when(~bad & ~early & filled, F.concat(left, F.repeat(F.lit("0"), gap), right))

        second = F.when(F.size(sides) == 2, sides[1]).otherwise("")
        return bound(F.array(groups(F.get(sides, 0)), groups(second)), joined)

    sides = F.split(text, "::", -1)
    shape = text.rlike(r"^[0-9a-fA-F:.]{2,45}$") & text.contains(":") & ~text.contains(":::")
    return F.when(shape & (F.size(sides) <= 2), bound(sides, whole))


def address_bits(text: Column) -> Column:
    """128 characters 0 / 1, or null."""

    def read(plain: Column) -> Column:
        v4 = F.concat(F.lit(V4_LEAD), _v4(plain))
        return F.when(plain.contains(":"), _v6(plain)).otherwise(v4)

    return bound(F.regexp_replace(F.trim(text), r"^\[|\]$|%.*$", ""), read)


def networks_table(networks: DataFrame, cidr: str = "cidr", name: str = "name") -> DataFrame:
    """Networks as (length, prefix, name); those of equal prefix keep the least name."""
    address = F.substring_index(F.col(cidr), "/", 1)
    given = F.regexp_extract(F.col(cidr), "/([0-9]{1,3})$", 1)
    v6 = address.contains(":")
    length = F.when(given == "", F.when(v6, 128).otherwise(32)).otherwise(given.try_cast("int"))
    length = F.when(v6, length).when(length <= 32, length + 96)
    rows = networks.select(
        length.alias("length"), address_bits(address).alias("bits"), F.col(name).alias("name")
    ).filter("bits IS NOT NULL AND length BETWEEN 0 AND 128 AND name IS NOT NULL")
    rows = rows.select("length", F.substring("bits", F.lit(1), F.col("length")).alias("prefix"), "name")
    return rows.groupBy("length", "prefix").agg(F.min("name").alias("name"))


def longest_match(
    df: DataFrame,
    address: str,
    networks: DataFrame,
    into: str = "network",
    cidr: str = "cidr",
    name: str = "name",
    salts: int = SALTS,
    broadcast_networks: int = BROADCAST_NETWORKS,
) -> DataFrame:
    """``df`` with the name of the longest network that holds the address, or null.

    The table is read three times; store it where that is dear.
    """
    table = networks_table(networks, cidr, name)
    # At most 129 numbers.
    lengths = sorted(r[0] for r in table.select("length").distinct().collect())
    distinct = df.select(F.col(address).alias("__address")).distinct()
    found = distinct.select("__address", address_bits(F.col("__address")).alias("__bits"))
    found = found.filter("__bits IS NOT NULL")
    found = found.withColumn("length", F.explode(F.lit(lengths).cast("array<int>")))
    found = found.withColumn("prefix", F.substring("__bits", F.lit(1), F.col("length")))
    if table.limit(broadcast_networks + 1).count() <= broadcast_networks:
        joined = found.join(F.broadcast(table), ["length", "prefix"])
    else:
        salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        found = found.withColumn("__salt", F.pmod(F.xxhash64("__address"), F.lit(salts)).cast("int"))
        joined = found.join(salted, ["length", "prefix", "__salt"])
    best = joined.groupBy("__address").agg(F.max_by("name", "length").alias("__name"))
    out = df.drop(into).join(best, F.col(address) == F.col("__address"), "left")
    return out.withColumn(into, F.col("__name")).drop("__address", "__name")
