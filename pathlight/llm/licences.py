"""Licence scans by canonical digest: whole texts are normalised, digested and joined with digests of known licences.

Normalising, in this order: A-Z to lower case; statements of a copyright (holder and years)
are blanked, whether the licence goes on in their line or not; runs of anything but letters
and digits become one space; equivalent spellings become one; the ends are trimmed. The SHA-256 of what is left is the canonical digest. Only
DataFrame functions run here, over every whole text.

Null text counts as empty. A text with nothing left has the digest of the empty string and no licence. Repeated rows
are looked up each for itself. If two known licences have one digest, the id that sorts first is given. Other columns
are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, ascii_lower
from .licence_texts import TEXTS

#: Known licences that are broadcast at most; a larger table is joined by a shuffle.
BROADCAST = 10_000

#: The patterns of a copyright statement, of what separates words, and of equivalent spellings, with what replaces them.
#: A statement begins a line, has a sign or a year (or the place for one), and ends with its line, its sentence or where
#: a licence begins; a holder has at most 300 characters.
YEAR = r"[\[<{(]?(?:[0-9]{4}|yyyy|year)"
COPYRIGHT = (
    (
        r"(?:^|\n)[\x20\t*#/;>-]*(?:copyright[\x20\t:]*(?:\(c\)|©|" + YEAR + r")|\(c\)[\x20\t]*(?:copyright|" + YEAR + r")|©)(?:(?:inc|ltd|co|corp|jr|dr|st|\x20[a-z])\.|[^\n]){0,300}?"
        r"(\n|$|\.\x20|\x20(?:permission is hereby|permission to use|redistribution and use|all rights reserved|this (?:file|library|program|software|work)))",
        "\n$1",
    ),
    (r"(?:^|\n)[\x20\t*#/;>-]*all rights reserved\.?", "\n"),
)
BETWEEN = (r"[\x00-\x2F\x3A-\x60\x7B-\x{BF}\x{2000}-\x{206F}\x{3000}-\x{303F}]+", " ")
SPELLINGS = (
    (r"\b(author|capital|categor|emphas|initial|maxim|optim|organ|real|recogn|util)is(e|ed|es|ing|ation|ations)\b", "$1iz$2"),
    (r"\b(behavi|col|fav|hon|lab)our", "$1or"),
    (r"\b(cancel|label|model|signal)l(ed|ing)\b", "$1$2"),
    (r"\b(acknowledg|judg)ement", "$1ment"),
    (r"\b(analog|catalog)ue", "$1"),
    (r"\b(sub ?)?licen[cs](e|ed|es|ing|ee|ees|or|ors)\b", "$1licens$2"),
    (r"\b(def|off)ence", "$1ense"),
    (r"\bcentre", "center"),
    (r"\bfulfil(ment)?\b", "fulfill$1"),
    (r"\bpractis(e|ed|es|ing)\b", "practic$1"),
    (r"\bprogramme\b", "program"),
    (r"\bwhilst\b", "while"),
    (r"\bwilful", "willful"),
    (r"\bnon commercial", "noncommercial"),
    (r"\bsub licens", "sublicens"),
    (r"\bper cent\b", "percent"),
    (r"\bcopyright (owner|holder)s?\b", "copyright holder"),
    (r"\bhttps? www (?:[a-z0-9]+ )?", "http "),
)


#: Where none of the spellings occurs, none is looked for one by one.
ANY = "|".join(re.sub(r"\((?!\?)", "(?:", p) for p, _ in SPELLINGS)


def with_digest(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with canonical_sha256 instead of a text column."""
    out = ascii_lower(F.coalesce(text, F.lit("")))
    for pattern, to in (*COPYRIGHT, BETWEEN):
        out = F.regexp_replace(out, pattern, to)
    spelled = F.col("_plain")
    for pattern, to in SPELLINGS:
        spelled = F.regexp_replace(spelled, pattern, to)
    rows = rows.withColumn("_plain", out)  # a projection of its own, so that it is computed once
    canonical = F.trim(F.when(F.col("_plain").rlike(ANY), spelled).otherwise(F.col("_plain")))
    return rows.withColumn("canonical_sha256", F.sha2(canonical.cast("binary"), 256)).drop(text, "_plain")


def known_licences(spark: SparkSession) -> DataFrame:
    """licence_id and text of the licences that come with the package."""
    return spark.createDataFrame(list(TEXTS), "licence_id string, text string")


def scan(docs: DataFrame, licences: DataFrame | None = None) -> DataFrame:
    """doc_id, canonical_sha256 and licence_id (null: none) of every document. ``licences``: licence_id and text, of any number."""
    licences = known_licences(docs.sparkSession) if licences is None else licences
    known = with_digest(licences.select(licences["text"].cast("string").alias("text"), licences["licence_id"].cast("string").alias("licence_id")), "text")
    known = known.groupBy("canonical_sha256").agg(F.min("licence_id").alias("licence_id")).where(F.col("canonical_sha256") != F.sha2(F.lit("").cast("binary"), 256))
    if known.limit(BROADCAST + 1).count() <= BROADCAST:
        known = F.broadcast(known)
    rows = with_digest(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), "text")
    return rows.join(known, "canonical_sha256", "left").select("doc_id", "canonical_sha256", "licence_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    t = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
    for pattern, to in (*COPYRIGHT, BETWEEN, *SPELLINGS):
        t = f"regexp_replace({t}, {quoted(pattern)}, {quoted(to.replace('$', chr(92)))}, 'g')"
    known = ", ".join(f"({quoted(i)}, {quoted(x)})" for i, x in TEXTS)
    return f"""
WITH k AS (
  SELECT sha256(trim({t})) AS canonical_sha256, min(licence_id) AS licence_id FROM (VALUES {known}) AS v(licence_id, text) GROUP BY 1
), d AS (
  SELECT doc_id, sha256(trim({t})) AS canonical_sha256 FROM documents
)
SELECT doc_id, d.canonical_sha256, licence_id FROM d LEFT JOIN k ON d.canonical_sha256 = k.canonical_sha256 AND k.canonical_sha256 <> sha256('')
"""


SQL = _sql()
