"""IP prefixes as columns: family 4 or 6, prefix length, and the network as four 32-bit words.

An address is (w0, w1, w2, w3), most significant first; a v4 address is held in w0 and the rest are 0. Containment of
one prefix in another is then equality of masked words, which Spark can hash.
"""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = ("w0", "w1", "w2", "w3")
V4 = r"^\s*(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?:/(\d{1,2}))?\s*$"


def v4_network(prefix: Column) -> Column:
    """A v4 prefix as struct<family, plen, w0..w3>, host bits cleared; null if it isn't one."""
    parts = F.split(F.trim(prefix), "[./]")
    octets = [parts[i].try_cast("long") for i in range(4)]
    plen = F.coalesce(F.try_element_at(parts, F.lit(5)).try_cast("int"), F.lit(32))
    address = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    valid = prefix.rlike(V4) & (F.greatest(*octets) <= 255) & (plen <= 32)
    zero = F.lit(0).cast("long")
    return F.when(valid, F.struct(F.lit(4).alias("family"), plen.alias("plen"), masked(address, plen).alias("w0"), *(zero.alias(w) for w in WORDS[1:])))


def masked(word: Column, bits: Column) -> Column:
    """The first ``bits`` (0 to 32) bits of a 32-bit word."""
    off = F.lit(32) - F.greatest(F.lit(0), F.least(F.lit(32), bits))
    return F.call_function("shiftleft", F.call_function("shiftright", word, off), off)


def mask(plen: Column) -> list[Column]:
    """The words w0 to w3 of a row, masked to a prefix length."""
    return [masked(F.col(w), plen - 32 * i) for i, w in enumerate(WORDS)]


V6 = T.StructType([T.StructField(c, T.IntegerType() if c in ("family", "plen") else T.LongType()) for c in ("family", "plen", *WORDS)])


@F.pandas_udf(V6)
def v6_network(prefix: pd.Series) -> pd.DataFrame:
    """A v6 prefix likewise. Text forms of v6 are beyond SQL; only rows that aren't v4 get here."""

    def parse(text):
        try:
            net = ipaddress.IPv6Network((text or "").strip(), strict=False)
        except ValueError:
            return (None,) * 6
        n = int(net.network_address)
        return (6, net.prefixlen, *((n >> (96 - 32 * i)) & 0xFFFFFFFF for i in range(4)))

    return pd.DataFrame([parse(t) for t in prefix], columns=["family", "plen", *WORDS]).astype("Int64")


def with_network(df: DataFrame, column: str = "prefix", v6: bool = True) -> DataFrame:
    """``df`` with family, plen and w0 to w3 of a prefix or address column (null where it is neither).

    ``v6``: whether to expect v6 at all; without, the plan is free of Python.
    """
    df = df.withColumn("_net", v4_network(F.col(column)))
    if v6:
        other = F.when(F.col("_net").isNull() & F.col(column).contains(":"), F.col(column))
        df = df.withColumn("_net", F.coalesce("_net", F.when(other.isNotNull(), v6_network(other))))
    return df.select(*(c for c in df.columns if c != "_net"), *(F.col(f"_net.{c}").alias(c) for c in ("family", "plen", *WORDS)))


def covers(larger: str, smaller: str) -> Column:
    """Whether prefix struct ``larger`` contains ``smaller`` (both with family, plen, w0 to w3)."""
    same = [masked(F.col(f"{smaller}.{w}"), F.col(f"{larger}.plen") - 32 * i) == F.col(f"{larger}.{w}") for i, w in enumerate(WORDS)]
    return (F.col(f"{larger}.family") == F.col(f"{smaller}.family")) & (F.col(f"{larger}.plen") <= F.col(f"{smaller}.plen")) & same[0] & same[1] & same[2] & same[3]
