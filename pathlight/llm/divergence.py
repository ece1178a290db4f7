"""Source divergence audit: how far the sources of a language are from each other, and the terms that set each apart.

1. Each task sorts the terms of a block of documents by (lang, source, term, document); a scan of the runs gives one row a
   (lang, term, source) and block: the documents that have the term, and its count.
2. These rows are dealt out by (lang, term) and sorted by (lang, term, source). A scan of the runs sums them and keeps the
   terms that at least ``LEAST`` documents of the language have. What is held from batch to batch is one row a source.
3. Kept terms get the shares of their group, are dealt out and sorted likewise, and scanned again. A run is a term of a
   language with the sources that have it. It gives its partial pairs of sources, summed in the task, and its terms: those
   whose share in the group is above that in the language.

The value of a pair sums f(p, q) over all kept terms, those that neither source has included. A sum over absent terms
needs no row of theirs: f(a, b) = f(a, 0) + [f(0, b) - f(0, 0)] + d(a, b), where d is 0 unless both sources have the term.
Runs give d; the other two come from the histogram of a group's counts, as one join on the language. Everything is exact
in integers: shares are decimals' integer quotients, all else fits 64 bits.

Null text, lang and source are ''. Each row is a document, also where ``doc_id`` is shared or null. A group without kept
terms has a row for each other source of its language. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LETTERS, byte_words, lean, materialize, numbered, slices, small_side, union

LEAST = 3
TOP = 200
SHARE = 1_000_000_000
#: Bytes of text whose terms are sorted together, and texts of it at most.
BLOCK, TEXTS = 12 << 20, 50_000
#: Pairs of rows that are held at a time, and sums of pairs of sources that a task holds before it hands them on.
PAIRS, SUMS = 1 << 20, 1 << 20

Arrays = dict[str, np.ndarray]


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def changes(column: pa.Array) -> np.ndarray:
    """Numbers that differ between neighbours where a column does."""
    if len(column) < 2:
        return np.zeros(len(column), np.int64)
    other = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.append(0, np.cumsum(other))


def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, term, source, docs, n), a row a run of a block."""
    for big in batches:
        for b in slices(big, "text", TEXTS, BLOCK):
            words, counts = byte_words(b.column("text"), LETTERS)
            encoded = words.dictionary_encode()
            terms = encoded.indices.to_numpy().astype(np.int64)
            groups = pa.StructArray.from_arrays([b.column(c) for c in ("lang", "source")], ["lang", "source"])
            langs, sources = (b.column(c).dictionary_encode() for c in ("lang", "source"))
            doc = np.repeat(np.arange(b.num_rows), counts)
            wide, many = max(1, len(encoded.dictionary)), max(1, len(sources.dictionary))
            group = langs.indices.to_numpy().astype(np.int64) * many + sources.indices.to_numpy()
            _, at, group = np.unique(group, return_index=True, return_inverse=True)
            # (group, term, document) as one number: a block has few of each
            key = (group[doc] * wide + terms) * b.num_rows + doc
            key.sort()
            first = runs(key // b.num_rows)
            own = key // b.num_rows
            docs = np.add.reduceat(np.append(True, key[1:] != key[:-1]), first, dtype=np.int64) if len(key) else first
            g, term = np.divmod(own[first], wide)
            place = pa.array(at[g])
            yield pa.RecordBatch.from_arrays(
                [groups.field("lang").take(place), encoded.dictionary.take(pa.array(term)).cast(pa.string()), groups.field("source").take(place), pa.array(docs), pa.array(np.diff(np.append(first, len(key))))],
                ["lang", "term", "source", "docs", "n"],
            )


def scanned(batches: Iterator[pa.RecordBatch], sums: tuple[str, ...] = ()) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by (lang, term, source) as tables of whole (lang, term) runs, with the first row of each.

    ``sums``: columns that are summed over rows of one source, so that a run is held as one row a source.
    """
    held: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([b])
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        columns = {c: rows.column(c).combine_chunks() for c in rows.column_names}
        lang, term = changes(columns["lang"]), changes(columns["term"])
        if sums:
            first = runs(lang, term, changes(columns["source"]))
            for c in sums:
                columns[c] = pa.array(np.add.reduceat(columns[c].to_numpy(), first))
            take = pa.array(first)
            rows = pa.table({c: columns[c] if c in sums else columns[c].take(take) for c in rows.column_names})
            lang, term = lang[first], term[first]
        start = runs(lang, term)
        held = rows.slice(start[-1])
        if len(start) > 1:
            yield rows.slice(0, start[-1]), start[:-1]
    if held is not None:
        yield held, np.zeros(1, np.int64)


def kept_terms(least: int):
    """Rows of blocks to kept terms: n of each source, total of the language, and whether a row is its term's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, start in scanned(batches, ("docs", "n")):
            lengths = np.diff(np.append(start, len(rows)))
            good = np.repeat(np.add.reduceat(rows.column("docs").to_numpy(), start) >= least, lengths)
            total = np.repeat(np.add.reduceat(rows.column("n").to_numpy(), start), lengths)
            head = np.zeros(len(rows), bool)
            head[start] = True
            rows = rows.select(["lang", "term", "source", "n"]).append_column("total", pa.array(total)).append_column("head", pa.array(head))
            yield from rows.filter(pa.array(good)).combine_chunks().to_batches()

    return run


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def neighbours(start: np.ndarray, rows: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ordered pairs of different rows of the same run, at most ``most`` or one row's at a time."""
    lengths = np.diff(np.append(start, rows))
    size, begin = np.repeat(lengths, lengths), np.repeat(start, lengths)
    ends, at = np.cumsum(size), 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        left = np.repeat(np.arange(at, end), size[at:end])
        base = np.repeat(np.cumsum(size[at:end]) - size[at:end], size[at:end])
        right = np.arange(len(left)) - base + begin[left]
        other = left != right
        yield left[other], right[other]
        at = end


def pairs_and_terms(groups: int, most: int = PAIRS, sums: int = SUMS):
    """Kept terms with the shares of their groups to partial pairs (x, y, value) and terms (x, term, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
        new: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            key, inverse = np.unique(np.concatenate([keys, *(k for k, _ in new)]), return_inverse=True)
            out = np.zeros(len(key), np.int64)
            np.add.at(out, inverse, np.concatenate([values, *(v for _, v in new)]))
            return key, out

        def handed() -> pa.RecordBatch:
            x, y = np.divmod(keys, groups)
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.nulls(len(keys), pa.string()), pa.array(values)], ["x", "y", "term", "value"])

        for rows, start in scanned(batches):
            x, p, zero, q = (rows.column(c).to_numpy() for c in ("x", "p", "zero", "share"))
            for i, j in neighbours(start, len(rows), most):
                new.append((x[i] * groups + x[j], f(p[i], p[j]) - f(p[i], zero[j]) - f(zero[i], p[j]) + f(zero[i], zero[j])))
                if sum(len(k) for k, _ in new) > sums:
                    keys, values = summed()
                    new = []
                    if len(keys) > sums:
                        yield handed()
                        keys, values = keys[:0], values[:0]
            over = np.flatnonzero(p > q)
            yield pa.RecordBatch.from_arrays([pa.array(x[over]), pa.nulls(len(over), pa.int64()), rows.column("term").take(pa.array(over)).combine_chunks(), pa.array(f(p[over], q[over]))], ["x", "y", "term", "value"])
        keys, values = summed()
        yield handed()

    return run


def share(count: str, total: str) -> Column:
    """1 + floor(SHARE * (count + 1) / total), exact; null if the total is 0."""
    return F.expr(f"1 + (CAST({count} + 1 AS DECIMAL(20, 0)) * CAST({SHARE} AS DECIMAL(10, 0))) div CAST(nullif({total}, 0) AS DECIMAL(20, 0))")


def distance(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def absent_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(x, y, value) of what a pair's value is but for the terms that both sources have: from histograms of counts."""
    own = kept.groupBy("x", "n").agg(F.count("*").alias("h"), F.first("lang").alias("lang"), F.first("p").alias("p"), F.first("zero").alias("zero"))
    rest = groups.select("x", (F.col("v") - F.col("terms")).alias("h"), "lang", F.col("zero").alias("p"), "zero")
    others = small_side(groups.select("lang", F.col("x").alias("y"), F.col("zero").alias("other")))
    both = own.select("x", "h", "lang", "p", "zero").unionByName(rest).join(others, "lang").where("x <> y")
    sums = both.groupBy("x", "y").agg(
        F.sum(F.expr(f"h * coalesce({distance('p', 'other')}, 0)")).alias("there"),
        F.sum(F.expr(f"h * coalesce({distance('other', 'p')} - {distance('other', 'zero')}, 0)")).alias("back"),
    )
    return sums.select(F.explode(F.array(F.struct("x", "y", F.col("there").alias("value")), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col("back").alias("value")))).alias("s")).select("s.*")


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part (pair, term), item, value and rank."""
    rows = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = rows.mapInArrow(lean(in_blocks), "lang string, term string, source string, docs bigint, n bigint")
    ordered = found.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    kept = materialize(ordered.mapInArrow(lean(kept_terms(least)), "lang string, term string, source string, n bigint, total bigint, head boolean"), "terms")

    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("terms"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_size"), F.count_if("head").alias("v"))
    groups = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["size", "terms", "lang_size", "v"])
    groups = materialize(numbered(materialize(groups.withColumn("zero", share("0", "size + v")), "groups"), "x", "lang", "source"), "groups")

    each = kept.join(small_side(groups.drop("zero", "terms")), ["lang", "source"])
    each = each.withColumns({"p": share("n", "size + v"), "zero": share("0", "size + v"), "share": share("total", "lang_size + v")})
    ordered = each.select("lang", "term", "source", "x", "p", "zero", "share").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    partial = materialize(ordered.mapInArrow(lean(pairs_and_terms(groups.count())), "x bigint, y bigint, term string, value bigint"), "partial")

    pairs = union([partial.where("y is not null").select("x", "y", "value"), absent_terms(each, groups)]).groupBy("x", "y").agg(F.sum("value").alias("value"))
    names = small_side(groups.select("x", "lang", "source"))
    pairs = pairs.join(names, "x").join(names.select(F.col("x").alias("y"), F.col("source").alias("item")), "y").withColumn("part", F.lit("pair"))
    order = [F.col("value").desc(), F.col("item")]
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("x").orderBy(*order)))
    terms = partial.where("y is null").select("x", F.col("term").alias("item"), "value")
    terms = terms.withColumn("rank", F.row_number().over(Window.partitionBy("x").orderBy(*order))).where(F.col("rank") <= top)
    terms = terms.join(names, "x").withColumn("part", F.lit("term"))
    return union([x.select("lang", "source", "part", "item", "value", "rank") for x in (pairs, terms)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
  FROM documents
), t AS (
  SELECT lang, source, term, id, count(*) AS n FROM (SELECT lang, source, id, unnest(terms) AS term FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM t GROUP BY ALL HAVING count(*) >= 3
), size AS (SELECT lang, sum(n) AS n, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, kept.term, CAST(coalesce(s.n, 0) AS HUGEINT) AS n, kept.n AS total
  FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM t GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source AND s.term = kept.term
), p AS (
  SELECT c.lang, source, term, c.n, 1 + (1000000000 * (c.n + 1)) // (sum(c.n) OVER (PARTITION BY c.lang, source) + v) AS p, 1 + (1000000000 * (total + 1)) // (size.n + v) AS q
  FROM c JOIN size ON c.lang = size.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
