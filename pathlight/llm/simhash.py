"""SimHash near-duplicates by pivot distance tables.

1. A fingerprint of ``64 * lanes`` bits sums up a document's word shingles: a bit is set if it is set in over half of
   the shingle hashes (lane 0 is XXH64 with seed 42; further lanes remix it).
   For a similarity threshold, which is one of shingle sets, each distinct shingle counts once.
2. Equal fingerprints are one node, so copies are counted before anything is compared; for a similarity threshold, equal
   fingerprints of equal shingle sets are.
3. Each node gets a row of Hamming distances to ``PIVOTS`` reference fingerprints, kept per byte of the fingerprint.
   By the triangle inequality two fingerprints that agree on a set of bytes have equal distances there, so such a
   partial row is an equi-join key: ``Plan.keys`` lists the sets of bytes. For 64 bits and a radius of 2 the keys are
   the six pairs of the four 16-bit blocks; two fingerprints that differ in at most 2 bits agree on one of them, so no
   link is lost. For a similarity threshold the keys are bands, and the radius is wider than the threshold's expected
   distance by three standard deviations; a pair at the threshold is met with about the probability that
   ``Plan.recall`` measures. Components of these links only bring together what is then verified (7).
4. Rows are dealt out and sorted by key and streamed. Within a key, pairs whose distances to any one reference
   fingerprint differ by more than the radius are discarded; survivors are verified by the Hamming distance itself.
   Of the links of a bucket, a spanning forest leaves (at most one link a member): the components are the same.
5. A bucket of more than ``BUCKET`` different fingerprints is cut into chunks before anything in it is compared, and
   each pair of chunks is compared in a task of its own: memory and time of a task stay bounded and no link is lost.
6. Connected components of the links give the groups.
7. For a similarity threshold a group is searched for a spanning forest of its pairs whose shingle sets are similar
   enough, whatever links brought it together, and the components of these forests are the groups. A large one is cut
   into parts (``parts_of``), and each pair of parts is searched in a task of its own.

Texts are hashed piece by piece, so a very long one costs little more than its shingles' hashes. Null and empty texts
have the fingerprint zero and link with each other. A null ``doc_id`` counts in no minimum; rows
that share a ``doc_id`` are told apart by position. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_row, lean, materialize, small_side, text_digest
from .components import components

SEED = 42
PIVOTS = 32
#: Fingerprints of one key that a chunk has; a task compares two chunks at most.
BUCKET = 16_384
#: Buckets up to this size are compared by shifted arrays, larger ones by a search from each member.
SMALL = 32
#: Shingles whose bits are counted at a time: a sum of that many bits fits a byte.
BLOCK = 255
#: Bytes of a text that are split into words at a time, up to the next white space.
PIECE = 1 << 18
GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Each byte of a fingerprint makes a band with the bytes so far behind it.
SHIFTS = (1, 3, 9)


@dataclass(frozen=True)
class Plan:
    """``words`` a shingle, ``lanes`` of 64 bits, links at ``radius`` or fewer differing bits, ``keys``: sets of bytes."""

    words: int
    lanes: int
    radius: int
    keys: tuple[tuple[int, ...], ...]
    #: Least Jaccard similarity of shingle sets; 0: the radius decides.
    similarity: float = 0.0

    def recall(self, similarity: float, pairs: int = 4000) -> float:
        """The share of pairs of this Jaccard similarity that meet in a key within the radius, by drawing ``pairs`` of them.

        Bits differ independently; keys that share bytes aren't taken to be independent.
        """
        flips = np.random.default_rng(SEED).random((pairs, 8 * self.lanes, 8)) < differing(similarity)
        same = ~flips.any(axis=2)
        met = np.any([same[:, list(k)].all(axis=1) for k in self.keys], axis=0)
        return float((met & (flips.sum(axis=(1, 2)) <= self.radius)).mean())


def differing(similarity: float) -> float:
    """The share of bits in which SimHash of two equally long texts of this Jaccard similarity differs, as expected."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


#: The contract of op1: three words, 64 bits, two bits; pairs of 16-bit blocks are keys.
EXACT = Plan(3, 1, 2, tuple(a + b for a, b in combinations([(0, 1), (2, 3), (4, 5), (6, 7)], 2)))


def near_plan(words: int = 5, similarity: float = 0.8, lanes: int = 4) -> Plan:
    """Links at a similarity of ``similarity`` or more. Bands are pairs of bytes: each byte with those ``SHIFTS`` behind it."""
    n, p = 8 * lanes, differing(similarity)
    bands = sorted({tuple(sorted((i, (i + s) % n))) for s in SHIFTS for i in range(n)})
    return Plan(words, lanes, int(64 * lanes * p + 3 * math.sqrt(64 * lanes * p * (1 - p))), tuple(bands), similarity)


def word_runs(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a run of about PIECE bytes at a time. Bytes: A-Z only are lower-cased, and the white space is the contract's."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield text[at:end].lower().split()
        at = end


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    h, out, tail, long = xxhash.xxh64_intdigest, [], [], False
    for run in word_runs(text):
        w = tail + run
        if len(w) >= words:
            long = True
            out.append(np.fromiter((h(b" ".join(p), SEED) for p in zip(*(w[i:] for i in range(words)))), np.uint64))
        tail = w[max(0, len(w) - words + 1) :]
    if not long and tail:  # fewer words than a shingle has: the whole sequence
        out.append(np.array([h(b" ".join(tail), SEED)], np.uint64))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def remix(h: np.ndarray, lane: int) -> np.ndarray:
    """Hashes for a further lane: a 64-bit finaliser over the hash plus a lane's constant (arithmetic is modulo 2^64)."""
    x = h + np.uint64((lane * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: bytes, plan: Plan) -> bytes:
    return summed(counted(text, plan), plan)


def counted(text: bytes, plan: Plan) -> np.ndarray:
    """The shingles that a fingerprint counts: distinct ones for a plan that verifies sets."""
    h = shingle_hashes(text, plan.words)
    return np.unique(h) if plan.similarity else h


def summed(h: np.ndarray, plan: Plan) -> bytes:
    """Big-endian lanes, so that the hex digits of lane 0 read as its number."""
    if not len(h):
        return bytes(8 * plan.lanes)
    ones = np.zeros(64 * plan.lanes, np.int64)
    for i in range(0, len(h), BLOCK):
        part = h[i : i + BLOCK]
        rows = np.stack([part if k == 0 else remix(part, k) for k in range(plan.lanes)], axis=1).astype(">u8")
        ones += np.unpackbits(rows.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(h)).tobytes()


def fingerprints(plan: Plan):
    """Column text to fp and, for a plan that verifies, a digest of the shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            fps, sets = [], []
            for t in texts:
                h = counted(t.as_buffer().to_pybytes() if t.is_valid else b"", plan)
                fps.append(summed(h, plan))
                sets.append(hashlib.md5(h.tobytes()).digest())
            new = {"fp": fps, "shingles": sets} if plan.similarity else {"fp": fps}
            keep = [i for i, name in enumerate(b.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), *(pa.array(x, pa.binary()) for x in new.values())], [*(b.schema.names[i] for i in keep), *new])

    return run


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of ``width`` bytes a value as an array, without copies a value."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def references(lanes: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 256, (PIVOTS, 8 * lanes), np.uint8)


def distances(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """The table of Hamming distances: fingerprint x reference."""
    return np.stack([np.bitwise_count(fps ^ r).sum(axis=1, dtype=np.int16) for r in refs], axis=1)


def keys(plan: Plan):
    """(node, fp) to a row for each key: key, node, fp. The distances make the key; they are cheaper to compute again than to shuffle."""
    refs = references(plan.lanes)
    weights = np.random.default_rng(SEED + 1).integers(1, 2**63, (len(plan.keys), PIVOTS * max(map(len, plan.keys)) + 1), np.int64).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 2000):
                b = big.slice(at, 2000)
                fps = matrix(b.column("fp"), 8 * plan.lanes)
                table = np.bitwise_count(fps[:, None, :] ^ refs[None, :, :])  # node x reference x byte
                for k, own in enumerate(plan.keys):
                    part = table[:, :, list(own)].reshape(len(fps), -1).astype(np.uint64)
                    key = (part * weights[k, : part.shape[1]]).sum(axis=1, dtype=np.uint64) + weights[k, -1]
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), b.column("node"), b.column("fp")], ["key", "node", "fp"])

    return run


def linked(fps: np.ndarray, coords: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs (i, j) survive the reference distances and then the Hamming distance."""
    near = np.flatnonzero(np.abs(coords[i] - coords[j]).max(axis=1) <= radius)
    return near[np.bitwise_count(fps[i[near]] ^ fps[j[near]]).sum(axis=1) <= radius]


def forest(fps: np.ndarray, coords: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of one bucket: a search from each member, over those not yet reached.

    It begins at the first member and goes on from the first one reached. Rows come in order of node, so that buckets with
    many members in common give the same links, which a group of n near copies then has by some n, not by n a band.
    """
    order = np.argsort(coords[:, 0], kind="stable")
    out: list[tuple[int, int]] = []
    first = coords[:, 0]
    while len(order):
        at = int(order.argmin())
        todo, order = [int(order[at])], np.delete(order, at)
        while todo:
            x = heapq.heappop(todo)
            lo, hi = np.searchsorted(first[order], [first[x] - radius, first[x] + radius + 1])
            near = order[lo:hi]
            for p in range(1, coords.shape[1], 4):  # most pairs fall at the first few
                near = near[np.abs(coords[near, p : p + 4] - coords[x, p : p + 4]).max(axis=1) <= radius]
            near = near[np.bitwise_count(fps[near] ^ fps[x]).sum(axis=1) <= radius]
            if len(near):
                out += [(x, int(y)) for y in near]
                for y in near.tolist():
                    heapq.heappush(todo, y)
                order = np.concatenate([order[:lo], order[lo:hi][~np.isin(order[lo:hi], near)], order[hi:]])
    return out


def spanning(pairs: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a list of pairs, from those of the first members on."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[x]
        return x

    out = []
    for i, j in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def bucket_links(key: np.ndarray, node: np.ndarray, fps: np.ndarray, coords: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (a, b) of whole buckets, sorted by key."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    run = np.repeat(np.arange(len(starts)), sizes)
    small = np.flatnonzero(sizes[run] <= SMALL)
    hits = []
    for gap in range(1, SMALL):
        i, j = small[:-gap], small[gap:]
        same = run[i] == run[j]
        if not same.any():
            break
        i, j = i[same], j[same]
        hit = linked(fps, coords, i, j, radius)
        hits.append(np.stack([i[hit], j[hit]], axis=1))
    if hits:
        found = np.array(spanning(np.concatenate(hits)), np.int64).reshape(-1, 2)
        yield node[found[:, 0]], node[found[:, 1]]
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        found = np.array(forest(fps[s : s + n], coords[s : s + n], radius), np.int64).reshape(-1, 2) + s
        yield node[found[:, 0]], node[found[:, 1]]


LINKS = "a bigint, b bigint, key bigint, chunk int, fp binary"


def links_of(plan: Plan, bucket: int = BUCKET):
    """Rows sorted by key to links. A bucket over ``bucket`` rows isn't compared here: its members leave as (a, key, chunk, fp)."""
    width, refs = 8 * plan.lanes, references(plan.lanes)

    def pack(a, b, key=None, chunk=None, fp=None):
        n = len(a)
        empty = lambda t: pa.nulls(n, t)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), empty(pa.int64()) if b is None else pa.array(b, pa.int64()), empty(pa.int64()) if key is None else pa.array(key, pa.int64()),
             empty(pa.int32()) if chunk is None else pa.array(np.full(n, chunk, np.int32)), empty(pa.binary()) if fp is None else pa.array(list(map(bytes, fp)), pa.binary())],
            ["a", "b", "key", "chunk", "fp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(part):
            key, node, fps = part
            for a, b in bucket_links(key, node, fps, distances(fps, refs), plan.radius):
                if len(a):
                    yield pack(a, b)

        def cut(part, chunk):
            return pack(part[1], None, part[0], chunk, part[2])

        held, chunk = None, None  # the bucket that may go on in the next batch; its next chunk if it was cut
        for b in batches:
            if not b.num_rows:
                continue
            part = (b.column("key").to_numpy(), b.column("node").to_numpy(), matrix(b.column("fp"), width))
            if held is not None:
                part = tuple(np.concatenate(x) for x in zip(held, part))
            last = int(np.searchsorted(part[0], part[0][-1]))  # where its last bucket begins
            if last:
                if chunk is not None:  # a bucket that was cut has ended
                    end = int(np.searchsorted(part[0], part[0][0], side="right"))
                    yield cut(tuple(x[:end] for x in part), chunk)
                    chunk = None
                    yield from solve(tuple(x[end:last] for x in part)) if end < last else ()
                else:
                    yield from solve(tuple(x[:last] for x in part))
                part = tuple(x[last:] for x in part)
            while len(part[0]) > bucket:
                chunk = 0 if chunk is None else chunk
                yield cut(tuple(x[:bucket] for x in part), chunk)
                part, chunk = tuple(x[bucket:] for x in part), chunk + 1
            held = part
        if held is not None and len(held[0]):
            if chunk is None:
                yield from solve(held)
            else:
                yield cut(held, chunk)

    return run


def cross_links(plan: Plan):
    """Links within and between two chunks of one bucket."""
    refs = references(plan.lanes)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node").combine_chunks()
        fps = matrix(table.column("fp").combine_chunks(), 8 * plan.lanes)
        coords = distances(fps, refs)
        node = table.column("node").to_numpy()
        found = np.array(forest(fps, coords, plan.radius), np.int64).reshape(-1, 2)
        return pa.table({"a": node[found[:, 0]], "b": node[found[:, 1]]})

    return run


def links_between(nodes: DataFrame, plan: Plan, bucket: int = BUCKET) -> DataFrame:
    """``nodes``: node bigint, fp binary. Returns links a, b whose components are those of all links."""
    # a batch's buckets are compared as a whole, so rows come sorted by key within a task
    rows = nodes.select("node", "fp").mapInArrow(lean(keys(plan)), "key bigint, node bigint, fp binary")
    rows = rows.repartition(F.col("key")).sortWithinPartitions("key", "node")
    found = materialize(rows.mapInArrow(lean(links_of(plan, bucket)), LINKS), "links")
    links = found.where("b is not null").select("a", "b")
    cut = found.where("b is null").select("key", "chunk", F.col("a").alias("node"), "fp")
    chunks = cut.groupBy("key").agg(F.max("chunk").alias("last"))
    if not chunks.isEmpty():
        cut = cut.join(chunks, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last")))).where("other <> chunk")
        cut = cut.select("key", F.least("chunk", "other").alias("c"), F.greatest("chunk", "other").alias("d"), "node", "fp")
        links = links.unionByName(cut.groupBy("key", "c", "d").applyInArrow(cross_links(plan), "a bigint, b bigint"))
    return links


def shingle_sets(words: int):
    """(node, text) to the sorted distinct hashes of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingle_hashes((t.as_py() or "").encode(), words)).view(np.int64) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return run


#: A group of more than WHOLE members, or of more than HELD shingles, is cut into parts: of about PART members, at most
#: PARTS of them, or as many as it takes for a part to have about HELD shingles.
WHOLE, PART, PARTS, HELD = 128, 64, 24, 2**20


def parts_of(members, shingles):
    """Into how many parts a group is cut, as a column; each member meets all others, as each pair of parts does."""
    parts = F.greatest(F.lit(2), F.least(F.lit(PARTS), F.ceil(members / PART)), F.ceil(shingles / HELD))
    return F.when((members > WHOLE) | (shingles > HELD), parts).otherwise(1).cast("int")


def similar(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets (sorted, distinct) whose Jaccard similarity is at least ``similarity``.

    As in ``forest``, a search from each set over those not yet reached, by increasing size.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]  # shingles by number
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sets)), sizes)[np.argsort(flat, kind="stable")]  # the sets that have a shingle, by shingle
    last = np.cumsum(np.bincount(flat))
    first = np.r_[0, last[:-1]]

    def shared(x: int, near: np.ndarray) -> np.ndarray:
        own = flat[ends[x] - sizes[x] : ends[x]]
        counts = last[own] - first[own]
        if 4 * sizes[near].sum() < counts.sum():  # few sets are left
            return np.array([np.isin(flat[ends[y] - sizes[y] : ends[y]], own, assume_unique=True).sum() for y in near.tolist()], np.int64)
        at = np.arange(counts.sum()) + np.repeat(first[own] - np.cumsum(counts) + counts, counts)
        return np.bincount(owner[at], minlength=len(sets))[near]

    order, out = np.argsort(sizes, kind="stable"), []
    while len(order):
        todo, order = [int(order[0])], order[1:]
        while todo and len(order):
            x = todo.pop()
            lo, hi = np.searchsorted(sizes[order], [math.floor(similarity * sizes[x]), math.ceil(sizes[x] / similarity) + 1])
            near = order[lo:hi]
            if not len(near):
                continue
            both = shared(x, near)
            hit = both >= similarity * (sizes[x] + sizes[near] - both)
            out += [(x, y) for y in near[hit].tolist()]
            todo += near[hit].tolist()
            order = np.concatenate([order[:lo], near[~hit], order[hi:]])
    return out


def similar_pairs(plan: Plan):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node = table.column("node").to_numpy()
        found = np.array(similar([x.values.to_numpy() for x in table.column("shingles")], plan.similarity), np.int64).reshape(-1, 2)
        return pa.table({"a": node[found[:, 0]], "b": node[found[:, 1]]})

    return run


def verified(links: DataFrame, rows: DataFrame, docs: DataFrame, plan: Plan) -> DataFrame:
    """Links between nodes that ``links`` connect and whose documents' shingle sets are similar enough: their components are those of all such pairs.

    ``rows``: rid and digest of the nodes, written; ``docs`` has their texts.
    """
    met = components(links).select(F.col("node").alias("rid"), "root")
    wanted = materialize(rows.select("rid", "digest").join(met, "rid").select(F.col("rid").alias("node"), "root", "digest"), "linked-nodes")
    texts = docs.select(text_digest(docs["text"]).alias("digest"), docs["text"].cast("string").alias("text"))
    # equal texts have one shingle set and so one node, but are read as often as they occur
    sets = texts.join(small_side(wanted.select("node", "digest")), "digest").select("node", "text").mapInArrow(lean(shingle_sets(plan.words)), "node bigint, shingles array<bigint>")
    sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles")).join(wanted.select("node", "root"), "node")
    sets = materialize(sets, "shingles")
    parts = parts_of(F.count("*"), F.sum(F.size("shingles")))
    cut = materialize(sets.groupBy("root").agg(parts.alias("parts")).where("parts > 1"), "cut-groups")
    sets = sets.join(small_side(cut), "root", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("other <> part OR parts = 1")
    sets = sets.select("root", F.least("part", "other").alias("c"), F.greatest("part", "other").alias("d"), "node", "shingles")
    return sets.groupBy("root", "c", "d").applyInArrow(similar_pairs(plan), "a bigint, b bigint")


def node_key(plan: Plan) -> list[str]:
    return ["fp", "shingles"] if plan.similarity else ["fp"]


def grouped(rows: DataFrame, plan: Plan, bucket: int = BUCKET, docs: DataFrame | None = None) -> DataFrame:
    """``rows``: rid, doc_id, fp, written. Returns one row per node (``node_key``): its key, component_id, stays (the rid that stays).

    For a plan that verifies, ``rows`` also has digest and shingles (the digest of the set), and ``docs`` the texts.
    """
    own = node_key(plan)
    nodes = rows.groupBy(*own).agg(
        F.min("rid").alias("node"), F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    )
    nodes = materialize(nodes, "fingerprints")
    links = links_between(nodes, plan, bucket)
    roots = components(verified(links, rows, docs, plan) if plan.similarity else links)
    nodes = materialize(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    tops = nodes.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    return materialize(nodes.select(*own, "root").join(tops, "root").select(*own, "component_id", F.col("first.rid").alias("stays")), "groups")


def simhash_groups(docs: DataFrame, plan: Plan = EXACT) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (the least doc_id that links reach) of every document."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = materialize(rows.mapInArrow(lean(fingerprints(plan)), "rid bigint, doc_id bigint, fp binary"), "documents-fp")
    return rows.join(grouped(rows, plan), "fp").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """One document of each group (the least ``doc_id``), with all its columns. ``docs`` is read again for the texts and the result.

    What decides about a row is its id and its text's digest. Of rows that share both with the row that stays, one stays.
    """
    plan = plan or near_plan()
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), docs["doc_id"].cast("long").alias("doc_id"), text_digest(docs["text"]).alias("digest"), docs["text"].cast("string").alias("text"))
    rows = materialize(rows.mapInArrow(lean(fingerprints(plan)), "rid bigint, doc_id bigint, digest binary, fp binary, shingles binary"), "documents-fp")
    judged = rows.join(grouped(rows, plan, docs=docs), node_key(plan)).groupBy("doc_id", "digest").agg(F.bool_or(F.col("stays") == F.col("rid")).alias("kept"), F.count("*").alias("n"))
    changed = materialize(judged.where("NOT kept OR n > 1"), "near-copies")
    marked = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest"))
    verdicts = small_side(changed.select(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"), "kept"))
    every = in_row(docs, docs["doc_id"].cast("long").alias("doc_id"), text_digest(docs["text"]).alias("digest")).join(verdicts, marked, "left")
    out = every.where("kept IS NULL").select("row.*")
    if not changed.where("kept").isEmpty():
        twins = every.where("kept").groupBy("doc_id", "digest").agg(F.first("row").alias("row"))
        out = out.unionByName(twins.select("row.*"))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
