"""Exact deduplication against a persistent digest index.

The index is a Parquet table with one row per distinct normalised text, bucketed and sorted by the SHA-256 digest. New
documents are reduced to one row per digest (partial sums before the shuffle, so a text that a third of all rows share
costs one row per task), anti-joined with the index by a sort-merge join that doesn't move the index, and the digests
it lacks are appended, last of all: what a batch decides is written before. A batch has a name. What an earlier, broken
attempt of the same batch has appended counts as this batch's own, so a batch that is run again decides as if it ran
for the first time, and appends only what is missing. Batches are added one at a time. Only DataFrame functions run
here.

Null text counts as empty; empty texts are equal to each other. Rows that share text and ``doc_id`` are told apart by
their position: one of them stays. A null ``doc_id`` loses to any other. Other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, fresh_path, in_row, materialize, small_side, union

#: A digest is hot if over 1/HOT_SHARE of the batch has it, so at most HOT_SHARE digests are: that bounds the broadcast.
HOT_SHARE = 1000

SCHEMA = "digest binary, keep_id bigint, batch string"


def digest(text):
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class DigestIndex:
    """A digest index at ``location``; it is made there, or attached if it exists.

    The number of buckets is fixed when the index is made and kept beside it; to attach with another one is an error.
    """

    def __init__(self, spark: SparkSession, location: str | None = None, buckets: int | None = None):
        self.spark, self.location = spark, (location or fresh_path(spark, "digest-index")).rstrip("/")
        known = spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}.buckets")
        if known.getFileSystem(spark._jsc.hadoopConfiguration()).exists(known):
            had = spark.read.parquet(f"{self.location}.buckets").agg(F.max("buckets")).first()[0]
            if buckets not in (None, had):
                raise ValueError(f"{self.location} has {had} buckets")
            self.buckets = had
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.parquet(f"{self.location}.buckets")
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.name} ({SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.location}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def before(self, batch: str) -> DataFrame:
        """What other batches have added."""
        return self.table().where(F.col("batch") != batch)

    def add(self, rows: DataFrame, batch: str | None = None) -> DataFrame:
        """Add ``rows`` (rid, doc_id, digest; already written) to the index as ``batch``; without a name, as one that never comes again.

        Returns one row per row: rid, doc_id, digest, keep_id (the row that stays, of this batch or an earlier one),
        group_size (rows of this batch with the digest), kept.
        """
        batch = batch or uuid.uuid4().hex
        groups = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "rid")).alias("top"), F.count("*").alias("group_size"))
        old = self.before(batch).select("digest", F.col("keep_id").alias("old_id"), F.lit(True).alias("known"))
        held = materialize(groups.hint("merge").join(old.hint("merge"), "digest", "left"), "digest-groups")
        fresh = held.where("known is null").select("digest", F.col("top.doc_id").alias("keep_id"), F.lit(batch).alias("batch"))
        held = held.select("digest", "group_size", F.when(F.col("known"), F.col("old_id")).otherwise(F.col("top.doc_id")).alias("keep_id"), F.when(F.col("known").isNull(), F.col("top.rid")).alias("stays"))
        total = rows.count()
        hot = F.col("group_size") * HOT_SHARE > total
        common = F.broadcast(held.where(hot).withColumn("common", F.lit(True)))
        first = rows.join(common, "digest", "left")
        rest = first.where("common is null").select("rid", "doc_id", "digest")
        rest = rest.join(held.where(~hot), "digest")
        columns = ["rid", "doc_id", "digest", "keep_id", "group_size", F.coalesce(F.col("stays") == F.col("rid"), F.lit(False)).alias("kept")]
        out = materialize(first.where("common").select(*columns).unionByName(rest.select(*columns)), "copies")
        # last: the sort-merge anti-join with the index leaves the digests that it lacks, those of a broken attempt too
        new = materialize(fresh.hint("merge").join(self.table().select("digest").hint("merge"), "digest", "left_anti"), "digest-fresh")
        new.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)
        return out


def keyed(docs: DataFrame) -> DataFrame:
    return materialize(docs.select(F.monotonically_increasing_id().alias("rid"), docs["doc_id"].cast("long").alias("doc_id"), digest(docs["text"]).alias("digest")), "digests")


def exact_groups(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None, batches: int = 1) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document.

    ``batches``: in how many the documents go to the index, those with larger ids first, so that of equal texts the one
    with the largest id is there first; group_size counts them all.
    """
    index, rows = index or DigestIndex(docs.sparkSession), keyed(docs)
    cuts = rows.approxQuantile("doc_id", [k / batches for k in range(batches - 1, 0, -1)], 0.01) if batches > 1 else []
    left, parts = F.lit(True), []
    for k in range(batches):
        own = left & F.coalesce(F.col("doc_id") >= F.lit(int(cuts[k])), F.lit(False)) if k < len(cuts) else left
        parts.append(index.add(rows.where(own), f"{batch}/{k}" if batch else None))
        left = left & ~own
    out = union(parts)
    if batches > 1:
        sizes = union([p.select("digest", "group_size").distinct() for p in parts]).groupBy("digest").agg(F.sum("group_size").alias("total"), F.count("*").alias("n"))
        out = out.join(small_side(materialize(sizes.where("n > 1").drop("n"), "digests-of-several")), "digest", "left").withColumn("group_size", F.coalesce("total", "group_size"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The documents that stay, with all their columns. ``docs`` is read twice.

    What decides about a row is its digest and id, both of which the second reading computes anew. Rows that share both
    with the row that stays are reduced to one by themselves.
    """
    index = index or DigestIndex(docs.sparkSession)
    added = index.add(keyed(docs), batch)
    verdicts = added.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.bool_or("kept").alias("any_kept"), F.count_if(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("like_kept"), F.count("*").alias("n")
    )
    verdicts = materialize(verdicts.where("n > 1 OR NOT any_kept"), "verdicts")  # any other text is new and has no copy
    rows = in_row(docs, docs["doc_id"].cast("long").alias("doc_id"), digest(docs["text"]).alias("digest")).join(small_side(verdicts), "digest", "left")
    stays = F.col("n").isNull() | F.col("any_kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    once = F.coalesce("like_kept", F.lit(1)) == 1
    out = rows.where(stays & once).select("row.*")
    if not verdicts.where("any_kept AND like_kept > 1").isEmpty():
        twins = rows.where(stays & ~once).groupBy("digest").agg(F.first("row").alias("row"))
        out = out.unionByName(twins.select("row.*"))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), batches=2)


SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), h AS (
  SELECT doc_id, sha256(t) AS text_sha256 FROM d
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept, text_sha256
FROM h WINDOW g AS (PARTITION BY text_sha256)
"""
