"""Exact top-k by inner product: a KD-tree in each shard, searched best first.

1. Vectors become integers, floor(``SCALE`` * x). Median splits of a bounded sample (``SAMPLE``) cut the space into at
   most ``CELLS`` cells; the vectors of a cell are a shard, or several, dealt by hash, so that each has about ``SHARD``.
   A shard's task builds its tree, by median splits along the widest side with a tight bounding box at each node, and
   writes it to a file in the shared folder; its root box goes to a table.
2. Each query is searched in the shard where it lives. Its k-th score there is the bound that it carries on.
3. In rounds, each query visits further shards, best first: those whose root box allows the largest inner product, as
   long as that reaches the query's bound; 1, then 4, then 16 and so on, with the bound that the round before has left.
   A query that has no such shard left is done; no other shard receives it. Tasks read a tree once for all its queries.
4. In a tree, nodes are visited in the order of the largest inner product that their box allows; the search ends when
   that falls below the query's k-th score so far. Of each visit at most k rows are shuffled.

Scores are integers and exact: floating-point sums are used only while all of them stay below 2^53, and unbounded
integers beyond. Ties go to the smaller ``vec_id``. Vectors that are null or hold a null or non-finite component take no
part, as queries neither. Components that one vector lacks against another count as 0. Components are held as 64-bit
integers, so those above about 2^55 saturate; scores saturate likewise. Rows that share a ``vec_id`` are rows of their
own: a query's own row alone isn't its candidate. A null ``vec_id`` is a candidate, last among ties, and no query.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, materialize, new_file, opened

K = 5
EVERY = 50
SCALE = 256
SHARD = 8192
LEAF = 64
#: Vectors that the cells are cut by, at most, and cells at most.
SAMPLE, CELLS = 16_384, 1024
#: Queries that visit a shard together.
BLOCK = 256
#: Visits that a task makes, on average.
VISITS = 256
#: Root boxes that are compared with a batch of queries at a time.
BOXES = 4096
SEED = 3
EXACT = 2.0**53
LONG = 2**63 - 1


def alike(queries: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
    """Arrays of one width, as floats if all inner products with ``queries`` are exact then, else as unbounded integers."""
    d = max(x.shape[1] for x in (queries, *more))
    out = [np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (queries, *more)]
    most = float(np.abs(out[0].astype(float)).max(initial=0)) * max(float(np.abs(x.astype(float)).max(initial=0)) for x in out[1:]) * max(1, d)
    return [x.astype(np.float64 if most < EXACT else object) for x in out]


def reaches(queries: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Query x box: the largest inner product that a box allows."""
    return np.maximum(queries, 0) @ hi.T + np.minimum(queries, 0) @ lo.T


class Tree:
    """A KD-tree over integer points. Nodes are in preorder; a leaf's points are a slice of the reordered points."""

    def __init__(self, points, ids, rids, lo, hi, span, child):
        self.points, self.ids, self.rids, self.lo, self.hi, self.span, self.child = points, ids, rids, lo, hi, span, child

    @classmethod
    def build(cls, points: np.ndarray, ids: np.ndarray, rids: np.ndarray, leaf: int = LEAF) -> Tree:
        order, lo, hi, span, child = np.arange(len(points)), [], [], [], []

        def node(a: int, b: int) -> int:
            me = len(span)
            own = points[order[a:b]]
            low, high = own.min(axis=0), own.max(axis=0)
            lo.append(low)
            hi.append(high)
            span.append((a, b))
            child.append((-1, -1))
            if b - a > leaf and (low < high).any():
                axis = int((high.astype(float) - low.astype(float)).argmax())
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
                child[me] = (node(a, a + middle), node(a + middle, b))
            return me

        node(0, len(points))
        return cls(points[order], ids[order], rids[order], np.array(lo), np.array(hi), np.array(span), np.array(child))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, points=self.points, ids=self.ids, rids=self.rids, lo=self.lo, hi=self.hi, span=self.span, child=self.child)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Tree:
        return cls(**np.load(io.BytesIO(raw)))

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: list[int | None], k: int) -> list[list[tuple[int, int, int]]]:
        """Of each query the best k of (score, id, rid), without the row ``own``; those below its bound may be missing."""
        queries, points, lo, hi = alike(queries, self.points, self.lo, self.hi)
        box = reaches(queries, lo, hi)
        out = []
        for q, row, reach, bound in zip(queries, own.tolist(), box, bounds):
            found: list[tuple] = []  # (score, -id, rid)
            heap = [(-reach[0], 0)]
            while heap:
                far, n = heapq.heappop(heap)
                if bound is not None and -far < bound:
                    break
                a, b = self.child[n]
                if a >= 0:
                    heapq.heappush(heap, (-reach[a], int(a)))
                    heapq.heappush(heap, (-reach[b], int(b)))
                    continue
                s, e = self.span[n]
                scores = points[s:e] @ q
                good = np.flatnonzero(self.rids[s:e] != row)  # before the trim, so that the own row takes no place
                if bound is not None:
                    good = good[scores[good] >= bound]
                if len(good) > k:  # only the best k of a leaf can count: all above the k-th score, and its ties
                    good = good[scores[good] >= np.sort(scores[good])[-k]]
                new = [(int(scores[i]), -int(self.ids[s + i]), int(self.rids[s + i])) for i in good.tolist()]
                if new:
                    found = heapq.nlargest(k, found + new)
                    if len(found) == k and (bound is None or found[-1][0] > bound):
                        bound = found[-1][0]
            out.append([(score, -i, r) for score, i, r in found])
        return out


def arrays(values) -> np.ndarray:
    """Lists of integers as one array; short ones are filled with zeros."""
    width = max(map(len, values), default=0)
    return np.array([np.pad(np.asarray(v, np.int64), (0, width - len(v))) for v in values], np.int64).reshape(len(values), width)


NO_ID = LONG  # stands for a null id: the last among ties


def clip(x: int) -> int:
    return max(-LONG, min(LONG, x))


def cells(sample: np.ndarray, count: int) -> list[tuple[int, int, int, int]]:
    """Median splits of a sample into about ``count`` cells: nodes (axis, cut, left, right); a cell is -1 - its number."""
    out: list[tuple[int, int, int, int]] = []
    ends = 0

    def node(points: np.ndarray, want: int) -> int:
        nonlocal ends
        if want > 1 and len(points) > 1:
            axis = int((points.max(axis=0).astype(float) - points.min(axis=0).astype(float)).argmax())
            cut = int(np.sort(points[:, axis])[len(points) // 2])
            low = points[:, axis] < cut
            if low.any() and not low.all():
                me = len(out)
                out.append((axis, cut, 0, 0))
                out[me] = (axis, cut, node(points[low], want // 2), node(points[~low], want - want // 2))
                return me
        ends += 1
        return -ends

    node(sample, count)
    return out


def placed(nodes: list[tuple[int, int, int, int]]):
    """Vectors to their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = arrays([x.values.to_numpy() for x in b.column("v")])
            width = max([points.shape[1], *(axis + 1 for axis, *_ in nodes)])
            points, at = np.pad(points, ((0, 0), (0, width - points.shape[1]))), np.full(b.num_rows, 0 if nodes else -1)
            for me, (axis, cut, low, high) in enumerate(nodes):  # a node stands before its children
                here = np.flatnonzero(at == me)
                at[here] = np.where(points[here, axis] < cut, low, high)
            yield b.append_column("cell", pa.array((-1 - at).astype(np.int32)))

    return run


HOME = "shard int, file string, lo array<bigint>, hi array<bigint>, rid bigint, query_id bigint, v array<bigint>, ids array<bigint>, scores array<bigint>"
VISIT = "shard int, file string, rid bigint, query_id bigint, v array<bigint>, bound bigint"


def at_home(k: int, folder: str):
    """A shard's vectors to a row with its tree's file and root box, and a row for each of its queries with what it found here."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        points = arrays(group["v"].tolist())
        ids, rids = group["vec_id"].to_numpy(), group["rid"].to_numpy()
        tree = Tree.build(points, ids, rids)
        out, name = new_file(folder, "tree")
        out.write(tree.dump())
        out.close()
        shard = int(group["shard"].iloc[0])
        rows = [(shard, name, tree.lo[0], tree.hi[0], None, None, None, None, None)]
        asks = np.flatnonzero(group["asks"].to_numpy())
        for i, best in zip(asks.tolist(), tree.search(points[asks], rids[asks], [None] * len(asks), k)):
            rows.append((shard, None, None, None, int(rids[i]), int(ids[i]), group["v"].iloc[i], [b[1] for b in best], [clip(b[0]) for b in best]))
        return pd.DataFrame(rows, columns=["shard", "file", "lo", "hi", "rid", "query_id", "v", "ids", "scores"]).astype({"rid": "Int64", "query_id": "Int64"})

    return run


def boxes_of(path: str) -> Iterator[tuple[np.ndarray, list[str], np.ndarray, np.ndarray]]:
    """Root boxes of all shards, some at a time: shards, files, lower and upper corners."""
    fs, at = opened(path)
    files = sorted(f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(at)) if f.path.endswith(".parquet"))
    for f in files:
        with fs.open_input_file(f) as source:
            for b in pq.ParquetFile(source).iter_batches(BOXES):
                yield b.column("shard").to_numpy(), b.column("file").to_pylist(), *(arrays([x.values.to_numpy() for x in b.column(c)]) for c in ("lo", "hi"))


def visits(path: str, k: int, first: int, last: int):
    """Queries to the shards that they visit now: the ``first`` to ``last`` best of those whose box reaches the query's k-th score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("rid", pa.int64()), ("query_id", pa.int64()), ("v", pa.list_(pa.int64())), ("bound", pa.int64())])
        for big in batches:
            for at in range(0, big.num_rows, BLOCK):
                b = big.slice(at, BLOCK)
                queries, home = arrays([x.values.to_numpy() for x in b.column("v")]), b.column("home").to_numpy()
                bounds = [s[-1] if len(s) == k else None for s in b.column("scores").to_pylist()]
                best: list[list] = [[] for _ in bounds]  # (-reach, shard, file)
                for shards, names, lo, hi in boxes_of(path):
                    q, lo, hi = alike(queries, lo, hi)
                    for i, (row, bound) in enumerate(zip(reaches(q, lo, hi), bounds)):
                        near = np.flatnonzero((shards != home[i]) & (True if bound is None else np.asarray(row >= bound, bool)))
                        best[i] = heapq.nsmallest(last, best[i] + [(-row[j], int(shards[j]), names[j]) for j in near.tolist()])
                out = [(shard, name, i) for i, found in enumerate(best) for _, shard, name in found[first:last]]
                take = pa.array([i for *_, i in out], pa.int64())
                rows = [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.string()), *(b.column(c).take(take) for c in ("rid", "query_id", "v"))]
                yield pa.RecordBatch.from_arrays([x.cast(t) for x, t in zip([*rows, pa.array([bounds[i] for *_, i in out], pa.int64())], schema.types)], schema=schema)

    return run


def abroad(folder: str, k: int):
    """Visits, sorted by shard, to what they found there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        name, tree = None, None
        for b in batches:
            files = b.column("file").to_pylist()
            starts = [i for i, f in enumerate(files) if i == 0 or f != files[i - 1]]
            for s, e in zip(starts, [*starts[1:], len(files)]):
                if files[s] != name:
                    name = files[s]
                    with fs.open_input_file(f"{path}/{name}") as source:
                        tree = Tree.load(source.read())
                part = b.slice(s, e - s)
                found = tree.search(arrays([x.values.to_numpy() for x in part.column("v")]), part.column("rid").to_numpy(), part.column("bound").to_pylist(), k)
                lists = [pa.array(x, pa.list_(pa.int64())) for x in ([[f[1] for f in own] for own in found], [[clip(f[0]) for f in own] for own in found])]
                yield pa.RecordBatch.from_arrays([part.column("rid"), *lists], ["rid", "ids", "scores"])

    return run


def best_of(found: DataFrame, k: int, *keep: str) -> DataFrame:
    """The best k of all that was found for each query: ids and scores, best first."""
    first = [F.first(c, ignorenulls=True).alias(c) for c in keep]
    merged = found.groupBy("rid").agg(*first, F.flatten(F.collect_list(F.arrays_zip(F.transform("scores", lambda s: -s).alias("s"), F.col("ids").alias("i")))).alias("all"))
    merged = merged.withColumn("all", F.slice(F.array_sort("all"), 1, k))
    return merged.select("rid", *keep, F.transform("all", lambda b: b["i"]).alias("ids"), F.transform("all", lambda b: -b["s"]).alias("scores"))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score: of each row whose ``vec_id`` is divisible by ``every``, the k best other rows."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("e"))
    good = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    quantised = F.transform("e", lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), F.lit(9e18)), F.lit(-9e18))).cast("long"))
    rows = materialize(rows.where(F.col("e").isNotNull() & good).select(F.monotonically_increasing_id().alias("rid"), "vec_id", quantised.alias("v")), "vectors")
    n = rows.count()
    want, draw = min(CELLS, -(-n // shard)), F.xxhash64("rid", F.lit(SEED))
    some = rows.where(F.pmod(draw, F.lit(max(1, n // SAMPLE))) == 0).orderBy(draw).limit(SAMPLE).select("v").toArrow().column("v") if want > 1 else []
    nodes = cells(arrays([x.values.to_numpy() for x in some]), want) if len(some) else []
    asks = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    dealt = rows.withColumns({"asks": asks, "vec_id": F.coalesce("vec_id", F.lit(NO_ID))})  # pandas holds longs with nulls as floats
    dealt = dealt.mapInArrow(placed(nodes), "rid bigint, vec_id bigint, v array<bigint>, asks boolean, cell int")
    sizes = dealt.groupBy("cell").count().orderBy("cell").collect()  # at most CELLS rows
    shares, shards = [], 0
    for r in sizes:
        shares.append((r.cell, shards, -(-r["count"] // shard)))
        shards += shares[-1][2]
    dealt = dealt.join(F.broadcast(spark.createDataFrame(shares, "cell int, first int, parts int")), "cell")
    dealt = dealt.withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("rid"), "parts")).cast("int")).drop("cell", "first", "parts")
    folder, path = fresh_path(spark, "trees"), fresh_path(spark, "boxes")
    home = materialize(dealt.groupBy("shard").applyInPandas(at_home(k, folder), HOME), "homes")
    state = home.where("rid is not null").select("rid", "query_id", "v", F.col("shard").alias("home"), "ids", "scores")
    if shards > 1:
        home.where("file is not null").select("shard", "file", "lo", "hi").write.parquet(path)
        blocks, first, width = max(1, -(-state.count() // block)), 0, 1
        while first < shards - 1:
            pairs = materialize(state.mapInArrow(visits(path, k, first, first + width), VISIT), "visits")
            if pairs.isEmpty():
                break
            # by number: visits are few bytes and much work, so tasks aren't to be merged
            tasks = -(-pairs.count() // VISITS)
            pairs = pairs.repartition(tasks, F.col("shard"), F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(blocks))).sortWithinPartitions("shard")
            found = pairs.mapInArrow(abroad(folder, k), "rid bigint, ids array<bigint>, scores array<bigint>")
            state = materialize(best_of(state.unionByName(found, allowMissingColumns=True), k, "query_id", "v", "home"), "best")
            first, width = first + width, 4 * width
    best = state.select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("at", "b"))
    return best.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.nullif(F.col("b.ids"), F.lit(NO_ID)).alias("vec_id"), F.col("b.scores").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
