"""Domain names."""

from __future__ import annotations

import encodings.idna
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Second-level labels under which a two-letter country domain registers names.
SECOND_LEVEL = ("co", "com", "org", "net", "gov", "ac", "edu")


def ascii_lower(x: Column) -> Column:
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normalize(x: Column) -> Column:
    """Trimmed, without leading ``*.`` and dots, A-Z in lower case."""
    return ascii_lower(F.regexp_replace(F.regexp_replace(x, r"^\s+|\s+$", ""), r"^(?:\*\.)*\.*", ""))


def registrable(x: Column) -> Column:
    """The registered name: two labels, or three under a country's second level; one leading ``www.`` doesn't count."""
    name = F.regexp_replace(normalize(x), r"^www\.", "")
    labels = F.filter(F.split(name, r"\."), lambda p: p != "")
    n = F.size(labels)
    country = (n >= 3) & (F.length(F.try_element_at(labels, F.lit(-1))) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LEVEL)
    return F.when(n <= 2, name).when(country, F.array_join(F.slice(labels, -3, 3), ".")).otherwise(F.array_join(F.slice(labels, -2, 2), "."))


def families(domains: Column) -> Column:
    """The distinct non-empty registrable names of a list of domains."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(domains, F.array().cast("array<string>")), registrable), lambda d: d != ""))


def shares_family(a: Column, b: Column) -> Column:
    return F.arrays_overlap(families(a), families(b))


def of_website(x: Column) -> Column:
    """The host of a website, https by default, normalised; null if there is none."""
    site = F.regexp_replace(x, r"^\s+|\s+$", "")
    url = F.when(site.contains("://"), site).otherwise(F.concat(F.lit("https://"), site))
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@\\]*@)?(\[[^\]/?#]*\]|[^/:?#\\]+)", 1)
    return F.nullif(normalize(host), F.lit(""))


#: Characters that stand for a dot between labels.
DOTS = str.maketrans({"\u3002": ".", "\uff0e": ".", "\uff61": "."})
#: Letters that mapping keeps although an older rule of names takes them apart.
KEPT = "ßς\u200c\u200d"


def ascii_name(host: str) -> str | None:
    """A host name with international labels in their ASCII form; None if a label can't have one."""
    out = []
    for label in unicodedata.normalize("NFKC", host.translate(DOTS)).lower().replace("\u00ad", "").split("."):
        label = unicodedata.normalize("NFC", label)
        try:
            if label.isascii():
                out.append(label)
            elif any(c in KEPT for c in label):
                out.append("xn--" + label.encode("punycode").decode())
            else:
                out.append(encodings.idna.ToASCII(label).decode())
        except UnicodeError:
            return None
    return ".".join(out)


@F.pandas_udf(StringType())
def ascii_names(hosts: pd.Series) -> pd.Series:
    return hosts.map(lambda h: None if h is None else ascii_name(h))


def with_ascii_names(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with international host names of a column in ASCII; null where there is no such form. Each distinct name is mapped once."""
    odd = rows.where(F.col(column).rlike(r"[^\x00-\x7F]")).select(column).distinct()
    names = odd.select(column, ascii_names(column).alias("_ascii"), F.lit(True).alias("_odd"))
    return rows.join(names, column, "left").withColumn(column, F.when(F.col("_odd"), F.col("_ascii")).otherwise(F.col(column))).select(rows.columns)
