"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings. DataFrame functions only.

Patterns: ``assign`` (a key word, ``=`` or ``:``, a value of 8 or more), ``access`` (an access key id) and ``hex`` (32 or
more hex digits), leftmost and not overlapping within a kind. Positions are code points: the lengths of the pieces that
``split`` leaves between matches and of the matches themselves are summed up.

``entropy`` spans: every run of 20 or more characters of the base64 and URL-safe alphabets is a candidate. A window of
``WINDOW`` characters moves along it with the counts of its characters, 5 bits each in a few long integers; as one
character leaves and one enters, two counts and two terms of the sum of n*log2(n) change. A candidate is reported if some window's entropy reaches the threshold of the
candidate's character class (``LIMITS``) and no allow-list pattern (``ALLOWED``) matches the candidate.

Null text counts as empty and has no spans. Rows that repeat are scanned each for itself. Other columns are ignored.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The base patterns. The group that has a least length, and that length.
KEYS = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
BASE = {
    "assign": (KEYS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),  # the runs of [0-9a-f]+ that have 32 characters or more
}
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
WINDOW = 20
#: The characters of candidates, and how many counts of 5 bits (WINDOW is below 32) a long integer holds.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
COUNTS = 12
#: Matches of a text whose places are summed up together: a list of n matches is made in about n * (BLOCK + n / BLOCK) steps.
BLOCK = 256
#: Least entropy in bits a character of a window, by the candidate's class: the first that matches counts. No window of
#: 20 has exactly these entropies, so rounding decides nothing.
LIMITS = (("^[0-9=_+/-]+$", 3.05), ("^[0-9a-fA-F=_-]+$", 2.95), ("^[A-Za-z=_+/-]+$", 4.03), ("", 3.53))
#: Candidates that are no secrets: UUIDs, examples, alphabets and counts, paths of words, rules of signs.
ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "EXAMPLE|[eE]xample|[sS]ample|[pP]laceholder",
    "abcdefghij|ABCDEFGHIJ|0123456789",
    "^[a-z]*(?:[/_-][a-z]*)+$",
    "^[=_+/-]+$",
)
ORDER = [*BASE, "entropy"]


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def located(text: str, pattern: str, keep: str) -> str:
    """SQL for the matches of a pattern in ``text`` as array<struct<start, end, found>>, of those for which ``keep`` (of x.found, x.value) holds."""
    p = quoted(pattern[0])
    pieces = f"split({text}, {p}, -1)"
    found = f"regexp_extract_all({text}, {p}, 0)"
    value = f"regexp_extract_all({text}, {p}, {pattern[1]})" if pattern[1] else found
    kind = "array<struct<start:bigint,end:bigint,found:string>>"
    one = "named_struct('start', s.at + length(x.gap), 'end', s.at + length(x.gap) + length(x.found), 'found', x.found)"
    zipped = f"transform(arrays_zip(slice({pieces}, 1, size({found})), {found}, {value}), x -> named_struct('gap', x.`0`, 'found', x.`1`, 'value', x.`2`))"
    block = f"slice(m, {{}} * {BLOCK} + 1, {BLOCK})"
    starts = f"""aggregate(sequence(0, (size(m) - 1) div {BLOCK}), named_struct('at', 0L, 'out', CAST(array() AS array<struct<k:bigint,at:bigint>>)),
        (s, k) -> named_struct('at', s.at + aggregate({block.format("k")}, 0L, (n, x) -> n + length(x.gap) + length(x.found)),
            'out', concat(s.out, array(named_struct('k', k, 'at', s.at)))), s -> s.out)"""
    own = f"""aggregate({block.format("CAST(b.k AS INT)")}, named_struct('at', b.at, 'out', CAST(array() AS {kind})),
        (s, x) -> named_struct('at', s.at + length(x.gap) + length(x.found), 'out', CASE WHEN {keep} THEN concat(s.out, CAST(array({one}) AS {kind})) ELSE s.out END),
        s -> s.out)"""
    # the matches are bound by a transform over one element, so that they are found once
    return f"CASE WHEN {text} RLIKE {p} THEN element_at(transform(array({zipped}), m -> flatten(transform({starts}, b -> {own}))), 1) ELSE CAST(array() AS {kind}) END"


def least_sum(chars: str) -> str:
    """SQL for the least sum of n*log2(n) over the windows of an array of characters.

    An event is the number of a character that enters the window, or that number below zero as it leaves.
    """
    terms = "array(" + ", ".join(f"{n * log2(n) if n else 0.0!r}D" for n in range(WINDOW + 2)) + ")"
    codes = f"transform({chars}, c -> instr('{ALPHABET}', c))"
    events = f"element_at(transform(array({codes}), a -> flatten(transform(a, (c, i) -> CASE WHEN i >= {WINDOW} THEN array(-a[i - {WINDOW}], c) ELSE array(c) END))), 1)"
    place, sign = f"((abs(e) - 1) div {COUNTS})", "sign(e)"
    bits = f"(5 * ((abs(e) - 1) % {COUNTS}))"
    n = f"CAST(shiftright(s.counts[CAST({place} AS INT)], {bits}) & 31 AS INT)"
    after = f"s.sum + {terms}[{n} + CAST({sign} AS INT)] - {terms}[{n}]"
    words = -(-len(ALPHABET) // COUNTS)
    return f"""aggregate({events}, named_struct('sum', 0D, 'held', 0, 'least', CAST('Infinity' AS DOUBLE), 'counts', array_repeat(0L, {words})),
        (s, e) -> named_struct('sum', {after}, 'held', s.held + CAST({sign} AS INT),
            'least', CASE WHEN e > 0 AND s.held >= {WINDOW - 1} THEN least(s.least, {after}) ELSE s.least END,
            'counts', transform(s.counts, (w, k) -> CASE WHEN k = {place} THEN w + CAST({sign} AS INT) * shiftleft(1L, {bits}) ELSE w END)), s -> s.least)"""


def limit(text: str) -> str:
    """SQL for the largest sum of n*log2(n) at which a window of the candidate's class is reported."""
    bound = {bits: f"{WINDOW * (log2(WINDOW) - bits)!r}D" for _, bits in LIMITS}
    return "CASE " + " ".join(f"WHEN {text} RLIKE {quoted(p)} THEN {bound[b]}" for p, b in LIMITS[:-1]) + f" ELSE {bound[LIMITS[-1][1]]} END"


def spans(text: Column) -> dict[str, Column]:
    """Kind to array<struct<start, end, found>> (code points, end exclusive) for a text column named ``text``."""
    out = {kind: F.expr(located("text", (p, group), f"length(x.value) >= {least}")) for kind, (p, group, least) in BASE.items()}
    allowed = " OR ".join(f"x.found RLIKE {quoted(p)}" for p in ALLOWED)
    # the characters of a candidate are bound by a transform over one element, so that they are split once
    hot = f"element_at(transform(array(split(x.found, '')), chars -> {least_sum('chars')} <= {limit('x.found')}), 1)"
    out["entropy"] = F.expr(located("text", (CANDIDATE, 0), f"NOT ({allowed}) AND {hot}"))
    return out


def labelled(kind: str):
    """A span as (start, order of its kind, kind:start:end)."""
    return lambda s: F.struct(s["start"].alias("start"), F.lit(ORDER.index(kind)).alias("order"), F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("text"))


def listed(kinds: list[str]) -> Column:
    """The spans of these columns as kind:start:end, by start and then by kind, comma-joined."""
    parts = [F.transform(F.col(k), labelled(k)) for k in kinds]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda s: s["text"]), ",")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and, for each kind, its spans with the matched strings, for every document."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", *(c.alias(k) for k, c in spans(F.col("text")).items()))


def secret_digests(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(list(BASE)).cast("binary"), 256).alias("base_sha256"), listed(ORDER).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    """The same rows by other means: windows are listed and each one's entropy is computed afresh."""

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    found = [(ORDER.index(k), k, p, g, least) for k, (p, g, least) in BASE.items()] + [(3, "entropy", CANDIDATE, 0, 0)]
    parts = " UNION ALL ".join(
        f"SELECT k, {o} AS o, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, {text(p)}) AS f, regexp_extract_all(t, {text(p)}, {g}) AS v, string_split_regex(t, {text(p)}) AS g FROM d WHERE regexp_matches(t, {text(p)})"
        for o, kind, p, g, least in found
    )
    allowed = " OR ".join(f"regexp_matches(f, {text(p)})" for p in ALLOWED)
    bits = "CASE " + " ".join(f"WHEN regexp_matches(f, {text(p)}) THEN {b}" for p, b in LIMITS[:-1]) + f" ELSE {LIMITS[-1][1]} END"
    lengths = "coalesce(list_sum(list_transform({0}, lambda x: length(x))), 0)"
    window = f"string_split(substr(f, CAST(w AS BIGINT), {WINDOW}), '')"
    entropy = f"-list_sum(list_transform(list_distinct({window}), lambda c: len(list_filter({window}, lambda x: x = c)) / {WINDOW}.0 * log2(len(list_filter({window}, lambda x: x = c)) / {WINDOW}.0)))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({parts}),
s AS (SELECT k, o, kind, f[i] AS f, {lengths.format("g[1:i]")} + {lengths.format("f[1:i - 1]")} AS a FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM m) WHERE length(v[i]) >= least),
hot AS (SELECT DISTINCT k, a FROM (SELECT k, a, f, unnest(range(1, length(f) - {WINDOW} + 2)) AS w FROM s WHERE o = 3 AND NOT ({allowed})) WHERE {entropy} >= {bits}),
r AS (SELECT k, o, kind, CAST(a AS BIGINT) AS a, concat(kind, ':', CAST(a AS BIGINT), ':', CAST(a + length(f) AS BIGINT)) AS span FROM s WHERE o < 3 OR (k, a) IN (SELECT (k, a) FROM hot))
SELECT doc_id, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access, count(*) FILTER (WHERE o = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY a, o) FILTER (WHERE o < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY a, o), '') AS spans
FROM d LEFT JOIN r USING (k) GROUP BY k, doc_id
"""


SQL = _sql()
