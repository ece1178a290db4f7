"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Each source's documents are dealt by hash into at most ``BLOCKS`` blocks; the blocks of a source are permuted.
2. The target of a source, in words, fixes how many blocks it gives, its quota: whole passes over its permuted blocks,
   then the blocks of a last pass, in permuted order, whose words come near to what is missing (``fill``, ``swapped``).
   So quotas follow from the words of the blocks that are picked; they aren't a share of the number of blocks.
3. A binary tree over the output shards splits the vector of block quotas exactly: at each node, the blocks that go left
   are a draw without replacement from the node's blocks, of all sources at once. A leaf thereby owns an interval of
   each source's draws, and the intervals of all leaves are disjoint and cover every draw. The draw is made in two
   levels, which gives the same distribution: first over at most ``GROUPS`` groups of sources, then, group by group,
   over the group's sources. Tasks walk the tree with random streams seeded by the node, so nothing is handed around and
   retries agree.
4. Documents join their blocks and come out with their shard and a random place in it: the local shuffle.

Null text has size 0. Null is a source of its own, the last. A document's block depends on its id and text alone, so
rows that share both are taken alike. A source of size 0 has target 0; none of its documents is taken. Sources are a
table like any other, of any length. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, numbered, small_side, word_count

#: Blocks of a source at most. A source of fewer documents has as many blocks as documents. A run has at most LIMIT draws
#: a block, so the table of draws is bounded by the number of sources, not by the documents.
BLOCKS = 2048
#: Groups of sources in the upper level of the tree; up to so many sources are a group each.
GROUPS = 1024
SEED = 11
CYCLE = (1.0, 2.0, 3.0)
LIMIT = 3
#: Output shards at least, and words that a shard holds on average beyond that.
SHARDS, SHARD_WORDS = 64, 20_000_000
#: Tasks that write a shard.
PARTS = 8


def with_targets(sources: DataFrame, cycle: tuple[float, ...] = CYCLE, limit: int = LIMIT) -> DataFrame:
    """``sources`` (no, words) with target: shares of all words by weight; a share stops at ``limit`` times its source, and the excess is shared again.

    A source stops if the words a weight of all others that go on, ``level``, exceed what it can give a weight. Each
    round is an aggregate of two sums, until no further source stops.
    """
    weights = F.element_at(F.array(*map(F.lit, map(float, cycle))), (F.pmod("no", F.lit(len(cycle))) + 1).cast("int"))
    sources = sources.withColumn("weight", weights)
    full, level, stopped = F.col("words") * float(limit) / F.col("weight"), 0.0, -1
    while True:
        over = full < level
        r = sources.agg(F.sum("words").alias("all"), F.sum(F.when(over, F.col("words") * float(limit))).alias("given"), F.sum(F.when(~over, F.col("weight"))).alias("open"), F.count_if(over).alias("n")).first()
        if r.n == stopped or not r.open:
            break
        stopped, level = r.n, (r.all - (r.given or 0.0)) / r.open
    return sources.withColumn("target", F.least(F.col("words") * float(limit), F.col("weight") * level)).drop("weight")


def fill(words: list[int], missing: float, first: int | None = None) -> tuple[float, list[int]]:
    """Blocks in order whose words come near ``missing``: one that would overshoot is passed over, and at the end the one that helps most may overshoot.

    ``first``: a block that is taken before all others. Returns how far off the sum is, and the blocks.
    """
    taken, total, over = ([], 0, []) if first is None else ([first], words[first], [])
    for i, w in enumerate(words):
        if i != first:
            if total + w <= missing:
                taken.append(i)
                total += w
            else:
                over.append(i)
    best = min(over, key=lambda i: (abs(missing - total - words[i]), i), default=None)
    if best is not None and abs(missing - total - words[best]) < abs(missing - total):
        taken.append(best)
        total += words[best]
    return abs(missing - total), taken


def swapped(words: np.ndarray, taken: list[int], missing: float) -> list[int]:
    """``taken`` after moves, each of which takes a block in, leaves one out, or both, as long as the sum comes nearer to ``missing``."""
    words = np.append(words, 0)  # no block: what a move of one block has on its other side
    none, held = len(words) - 1, np.zeros(len(words), bool)
    held[taken] = True
    for _ in range(MOVES):
        off = missing - words[held].sum()
        out, gone = np.append(np.flatnonzero(held), none), np.flatnonzero(~held)
        gone = gone[np.argsort(words[gone], kind="stable")]
        at = np.searchsorted(words[gone], words[out] + off)
        near = np.clip(np.stack([at - 1, at]), 0, len(gone) - 1)
        left = np.abs(off + words[out] - words[gone[near]])
        side, i = np.unravel_index(int(left.argmin()), left.shape)
        if left[side, i] >= abs(off):
            break
        held[out[i]], held[gone[near[side, i]]] = False, True
        held[none] = False
    return np.flatnonzero(held).tolist()


#: Moves at most, after the last pass.
MOVES = 16
#: Large blocks that are tried as the first one where the plain order stays off by more than CLOSE of what is missing.
TRIES, CLOSE = 16, 0.001


def draw_blocks(target: float, total: int, limit: int = LIMIT):
    """A source's blocks (block, words, place) to the number of times that each is drawn."""

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values(["place", "block"], kind="stable")
        words = blocks["words"].tolist()
        times = np.zeros(len(blocks), np.int64)
        if total:
            passes = min(int(target / total), limit)
            missing = target - passes * total
            times += passes
            if passes < limit:
                off, taken = fill(words, missing)
                if off > CLOSE * missing:  # a few blocks outweigh the rest
                    large = sorted(set(range(len(words))) - set(taken), key=lambda i: (-words[i], i))[:TRIES]
                    off, taken = min([(off, taken), *(fill(words, missing, i) for i in large)], key=lambda x: x[0])
                times[swapped(blocks["words"].to_numpy(), taken, missing)] += 1
        return blocks.assign(times=times)

    return run


def split(held: np.ndarray, counts: np.ndarray, key: list[int]) -> np.ndarray:
    """Draws without replacement from a vector of quotas for shards that take ``counts``: shard x quota, by a binary tree over the shards."""
    out = np.zeros((len(counts), len(held)), np.int64)
    todo = [(0, len(counts), held.astype(np.int64))]
    while todo:
        first, last, held = todo.pop()
        if last - first == 1:
            out[first] = held
            continue
        middle = (first + last) // 2
        take = int(counts[first:middle].sum())
        rng = np.random.default_rng([*key, first, last])
        left = rng.multivariate_hypergeometric(held, take, method="marginals") if take else np.zeros(len(held), np.int64)
        todo += [(first, middle, left), (middle, last, held - left)]
    return out


def even(total: int, shards: int) -> np.ndarray:
    """How many blocks each shard takes: a node gives its halves shares by their shards."""
    return np.diff(np.arange(shards + 1) * total // shards)


def upper(quotas: list[int], shards: int, seed: int):
    """Groups of sources to (grp, blocks that each shard takes of it), from the tree over all groups."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.array(quotas, np.int64)
        table = None
        for frame in frames:
            if table is None and len(frame):
                table = split(held, even(int(held.sum()), shards), [seed])
            for g in frame["id"].tolist():
                yield pd.DataFrame({"grp": [g], "counts": [table[:, g].tolist()]})

    return run


def lower(seed: int):
    """A group's sources (no, quota) and its shards' counts to the interval of draws of each source that a shard owns."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("no")
        table = split(group["quota"].to_numpy(), np.array(group["counts"].iloc[0], np.int64), [seed, 1, int(group["grp"].iloc[0])])
        hi = table.cumsum(axis=0)
        shard, at = np.nonzero(table)
        return pd.DataFrame({"no": group["no"].to_numpy()[at], "shard": shard, "lo": (hi - table)[shard, at], "hi": hi[shard, at]})

    return run


def owners(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``quotas``: no, quota, written. The shard of each draw: no, shard, draw."""
    spark = quotas.sparkSession
    quotas = quotas.withColumn("grp", F.pmod("no", F.lit(GROUPS)))
    sums = {r.grp: r.q for r in quotas.groupBy("grp").agg(F.sum("quota").alias("q")).collect()}  # at most GROUPS rows
    groups = max(sums, default=-1) + 1
    counts = spark.range(0, groups, 1, min(8, max(1, groups))).mapInPandas(upper([sums.get(g, 0) for g in range(groups)], shards, seed), "grp bigint, counts array<bigint>")
    parts = quotas.join(F.broadcast(counts), "grp").groupBy("grp").applyInPandas(lower(seed), "no bigint, shard bigint, lo bigint, hi bigint")
    return parts.select("no", "shard", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("draw"))


def document_hash(docs: DataFrame, seed: int):
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"), F.lit(seed))


def in_blocks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (of: the source, h: a hash) with the columns of their source and their block."""
    found = rows.join(small_side(sources), rows["of"].eqNullSafe(sources["source"]))
    return found.drop("of", "source").withColumn("block", F.pmod("h", "blocks"))


def plan_mix(docs: DataFrame, cycle: tuple[float, ...] = CYCLE, limit: int = LIMIT, shards: int | None = None, seed: int = SEED):
    """Sizes of all documents, the table of sources, and the blocks that are drawn: no, block, draws (copy, shard of each), all written."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("of"), word_count(docs["text"]).alias("size"), document_hash(docs, seed).alias("h"))
    rows = materialize(rows, "sizes")
    stats = rows.groupBy(F.col("of").alias("source")).agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    stats = materialize(numbered(stats, "no", F.col("source").asc_nulls_last()), "source-sizes")
    sources = with_targets(stats, cycle, limit).select("no", "source", F.col("words").alias("source_size"), "target", F.least(F.lit(BLOCKS), "docs").alias("blocks"))
    sources = materialize(sources, "sources")
    blocks = in_blocks(rows, sources).groupBy("no", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("total"), F.first("target").alias("target"))
    blocks = blocks.withColumn("place", F.xxhash64("no", "block", F.lit(seed)))

    def drawn(group: pd.DataFrame) -> pd.DataFrame:
        out = draw_blocks(float(group["target"].iloc[0]), int(group["total"].iloc[0]), limit)(group)
        times = out["times"].to_numpy()
        passes = int(times.min())
        extra = times > passes  # drawn in the last pass
        draws = [pd.DataFrame({"block": out["block"], "copy": c, "draw": c * len(out) + np.arange(len(out))}) for c in range(passes)]
        draws.append(pd.DataFrame({"block": out["block"][extra], "copy": passes, "draw": passes * len(out) + np.arange(extra.sum())}))
        return pd.concat(draws).assign(no=int(group["no"].iloc[0]))[["no", "block", "copy", "draw"]]

    # a source has at most BLOCKS rows here
    draws = materialize(blocks.groupBy("no").applyInPandas(drawn, "no bigint, block bigint, copy int, draw bigint"), "draws")
    quotas = materialize(draws.groupBy("no").agg(F.count("*").alias("quota")), "quotas")
    shards = shards or max(SHARDS, round((stats.agg(F.sum("words")).first()[0] or 0) / SHARD_WORDS))
    placed = draws.join(owners(quotas, shards, seed), ["no", "draw"]).groupBy("no", "block").agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("draws"))
    return rows, sources, materialize(placed, "placed")


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words that the shards' draws take of it) and shards (one for each draw) of every document."""
    rows, sources, placed = plan_mix(docs, **options)
    out = in_blocks(rows, sources).join(small_side(placed), ["no", "block"], "left")
    shards = F.coalesce(F.col("draws.shard"), F.array().cast("array<bigint>"))
    return out.select("doc_id", "size", "source_size", "target", (F.size(shards).cast("long") * F.col("size")).alias("taken"), shards.alias("shards"))


def mixed_documents(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mix with all columns of ``docs``: each document as often as it is drawn, shuffled within its shard.

    A shard is written by several tasks, each with a random share of its rows.
    """
    _, sources, placed = plan_mix(docs, seed=seed, **options)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["source"].cast("string").alias("of"), document_hash(docs, seed).alias("h"))
    # the texts move once, to their shards, while the table of draws is small
    out = in_blocks(rows, sources).select("row", "h", "no", "block").join(small_side(placed), ["no", "block"])
    out = out.select("row", "h", F.inline("draws")).select("row", "shard", F.xxhash64("h", "copy", "shard").alias("place"))
    return out.repartition(F.col("shard"), F.pmod("place", F.lit(PARTS))).sortWithinPartitions("shard", "place").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
