"""Importance resampling towards a target: documents whose n-grams the target has more often are drawn rather.

1. A dictionary of distinct features: each task counts the n-grams of its documents in blocks, each distinct string once
   a block. They travel sorted, a text for each part of the dictionary, and Spark sums them by string within the parts.
   Each string of the whole dictionary is hashed once, and its count goes to its bucket; the same for the target's texts.
2. A bucket's gain is the scaled log ratio of its smoothed shares in the target and in the documents. There are ``BUCKETS``
   gains, however large the input is; every task gets them.
3. Documents are read again. A block's distinct strings are looked up once each, and their gains go back to the feature
   counts of each document. Its weight is the floored mean.
4. Gumbel noise from a hash of ``doc_id`` is added; of the documents with at least ``LEAST`` words the ``PERCENT`` percent
   of highest scores are drawn. Ranks come from ranges of the order, so no task sees all rows.

Words are runs of a-z, digits and characters beyond ASCII after A-Z are lower-cased; features are all runs of one or two
of them, joined by a space, repeats counted. Null and empty texts have no feature and weight 0. Rows that share a ``doc_id``
are rows of their own, with one noise; their ties are broken at random. A null ``doc_id`` has the noise of an empty id and is
last among ties. Without any document nothing is drawn; without a target all gains come from the documents alone. Other
columns are ignored, but ``resampled`` keeps them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, byte_words, in_row, lean, materialize, numbered, raw_values, slices

BUCKETS = 10_000
SCALE = 1000
PERCENT = 25
LEAST = 20
SEED = 7
#: Parts of the dictionary that a shuffle partition gets on average, so that all get about as much.
PARTS = 8
#: Between a feature and its count; no word has it.
MARK = b"\x01"
#: Bytes of text that a block's dictionary is made of, texts of it at most, and rows that a task hands on at a time.
BLOCK, TEXTS, ROWS = 5 << 20, 20_000, 100_000


BYTES = pa.large_binary()


def checksums(strings: pa.Array) -> np.ndarray:
    data, ends = raw_values(strings)
    return np.fromiter((zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])), np.int64, len(strings))


class Block:
    """The distinct features of some texts, and where they occur.

    ``words``: distinct words. ``codes``: the word at each place. ``pairs``: distinct pairs of word numbers. ``pair_codes``:
    the pair at each of ``places``, the words that aren't a text's last. ``ends``: where each text's words end.
    """

    def __init__(self, texts: pa.Array):
        words, counts = byte_words(texts, ALNUM)
        encoded = words.dictionary_encode()
        self.words, self.codes = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        self.counts, self.ends = counts, np.cumsum(counts)
        inner = np.ones(len(self.codes), bool)
        inner[self.ends[counts > 0] - 1] = False
        self.places = np.flatnonzero(inner)
        wide = max(1, len(self.words))
        self.pair_codes, keys = pd.factorize(self.codes[self.places] * wide + self.codes[self.places + 1])
        self.pairs = np.divmod(keys, wide)

    def features(self) -> Iterator[pa.Array]:
        """Distinct strings, words before pairs."""
        yield self.words
        for at in range(0, len(self.pairs[0]), ROWS):
            yield self.joined(*(x[at : at + ROWS] for x in self.pairs))

    def joined(self, first: np.ndarray, second: np.ndarray) -> pa.Array:
        """Pairs of words as strings; a word alone where the second is -1."""
        more = pc.binary_join_element_wise(pa.scalar(b"", BYTES), self.words.take(pa.array(np.maximum(second, 0))), pa.scalar(b" ", BYTES))
        more = pc.if_else(pa.array(second >= 0), more, pa.scalar(b"", BYTES))
        return pc.binary_join_element_wise(self.words.take(pa.array(first)), more, pa.scalar(b"", BYTES))

    def parts(self, parts: int) -> Iterator[tuple[int, bytes]]:
        """The dictionary in parts: each a text of sorted lines, a feature and its count if that isn't 1."""
        if not len(self.words):
            return
        hashes = checksums(self.words).astype(np.uint64)
        order = pc.sort_indices(self.words).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        first = np.concatenate([np.arange(len(order)), self.pairs[0]])
        second = np.concatenate([np.full(len(order), -1), self.pairs[1]])
        n = np.concatenate([np.bincount(self.codes, minlength=len(order)), np.bincount(self.pair_codes, minlength=len(self.pairs[0]))])
        mixed = (hashes[first] * np.uint64(0x9E3779B97F4A7C15) + np.where(second < 0, np.uint64(0), hashes[np.maximum(second, 0)] + np.uint64(1))) * np.uint64(0xBF58476D1CE4E5B9)
        part = ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        wide = len(order) + 1
        order = np.argsort((part * wide + place[first]) * wide + np.where(second < 0, 0, place[np.maximum(second, 0)] + 1))
        starts = np.flatnonzero(np.append(True, np.diff(part[order]) > 0))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
            own = order[a:b]
            many = pc.binary_join_element_wise(pa.scalar(MARK, BYTES), pa.array(n[own]).cast(pa.string()).cast(BYTES), pa.scalar(b"", BYTES))
            ends = pc.binary_join_element_wise(pc.if_else(pa.array(n[own] > 1), many, pa.scalar(b"", BYTES)), pa.scalar(b"\n", BYTES), pa.scalar(b"", BYTES))
            lines, at = raw_values(pc.binary_join_element_wise(self.joined(first[own], second[own]), ends, pa.scalar(b"", BYTES)))
            yield int(part[own[0]]), lines[at[0] : at[-1] - 1]

    def sums(self, gains: np.ndarray) -> np.ndarray:
        """The sum of the gains over each text's features."""
        own = [gains[checksums(strings) % len(gains)] for strings in self.features()]
        each = own[0][self.codes]
        each[self.places] += np.concatenate([gains[:0], *own[1:]])[self.pair_codes]
        sums = np.append(0, np.cumsum(each))[np.append(0, self.ends)]
        return np.diff(sums)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for big in batches:
        for b in slices(big, "text", TEXTS, BLOCK):
            yield b, Block(b.column("text"))


def counted(parts: int):
    """Texts to (part, features): each distinct n-gram of a block once, a row a part of the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in blocks(batches):
            rows = list(block.parts(parts))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([t for _, t in rows], pa.binary()).cast(pa.string())], ["part", "features"])

    return run


def dictionary(docs: DataFrame) -> DataFrame:
    """part, feature and n of every distinct n-gram of the texts.

    A feature's part is a hash of it, so that rows of a part meet and strings are summed where they are.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = PARTS * partitions
    texts = docs.select(docs["text"].cast("string").alias("text")).where("text is not null")
    rows = texts.mapInArrow(lean(counted(parts)), "part int, features string").repartition(partitions, "part")
    lines = rows.select("part", F.explode(F.split("features", "\n")).alias("line"))
    mark = F.instr("line", MARK.decode())
    feature = F.when(mark == 0, F.col("line")).otherwise(F.substring("line", F.lit(1), mark - 1))
    n = F.when(mark == 0, F.lit(1)).otherwise(F.substring("line", mark + 1, F.lit(20)).cast("bigint"))
    return lines.select("part", feature.alias("feature"), n.alias("n")).groupBy("part", "feature").agg(F.sum("n").alias("n"))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the texts fall into each bucket; each distinct string is hashed once."""
    found = dictionary(docs).groupBy((F.crc32(F.col("feature").cast("binary")) % buckets).cast("int").alias("bucket")).agg(F.sum("n").alias("n")).collect()  # a row a bucket
    out = np.zeros(buckets, np.int64)
    for bucket, n in found:
        out[bucket] = n
    return out


def gains_of(own: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    size, wanted, k = float(own.sum()), float(target.sum()), float(len(own))
    return np.array([math.floor(scale * math.log((t + 1.0) * (size + k) / ((s + 1.0) * (wanted + k)))) for s, t in zip(own.tolist(), target.tolist())], np.int64)


def weighed(gains: np.ndarray):
    """Adds n_words, n_features and the weight to rows, and takes their texts away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, block in blocks(batches):
            features = block.counts + np.maximum(block.counts - 1, 0)
            weights = block.sums(gains) // np.maximum(features, 1)
            keep = [i for i, name in enumerate(b.schema.names) if name != "text"]
            more = [pa.array(x, pa.int64()) for x in (block.counts, features, weights)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), *more], [*(b.schema.names[i] for i in keep), "n_words", "n_features", "weight"])

    return run


def noise(doc_id, seed: int = SEED, scale: int = SCALE):
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + 0.5) / F.lit(2.0**32)))).cast("long")


def ranked(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST, buckets: int = BUCKETS, seed: int = SEED, rows: bool = False) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document; ``rows``: with all its columns as ``row``."""
    gains = gains_of(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    need = [docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")]
    kept = in_row(docs, *need) if rows else docs.select(*need)
    head = [f for f in kept.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in head), "n_words bigint, n_features bigint, weight bigint"])
    scored = kept.mapInArrow(lean(weighed(gains)), schema).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(scored.withColumn("out", F.col("n_words") < least), "scores")
    draws = scored.where(~F.col("out")).count() * percent // 100
    placed = numbered(scored, "place", F.col("out"), F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    rank = F.when(~F.col("out") & (F.col("place") < draws), F.col("place") + 1)
    return placed.select(*(f.name for f in head), "n_features", "weight", "score", rank.alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with their own columns."""
    return ranked(docs, target, rows=True, **options).where("rank is not null").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
