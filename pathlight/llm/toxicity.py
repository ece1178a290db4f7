"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Labelled rows that aren't held out (a bounded sample of at most ``SAMPLE``) are dealt by a hash of the id into two
halves. Words and word beginnings that mark toxic texts are learned three times: from all rows, for the texts that are
scored, and from each half, for the features of the other. The trees are grown on all rows, and the calibration is
fitted to what trees grown on one half say about the other. So no row's features or calibration score come from its own
label, and a small table is treated as a large one is. Every whole text is then scored: features in Arrow batches, trees
and calibration in the JVM.

Features (``NAMES``): densities and sums of lexicon hits, second-person words and how near they stand to hits, capitals,
punctuation, obfuscation. Labels, language, source and id are no inputs.

Null and empty texts have all-zero features and a score like any other text. Without labelled rows of both kinds, or
where all fall into one half, the score is their mean label, or 0. A document with several labels is an example of each. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, in_row, lean, materialize, union

#: Labelled rows that are learned from, at most.
SAMPLE = 16_000
#: Lexicon entries that are learned, at most; documents that must have one; length of a word's beginning.
ENTRIES, SUPPORT, BEGINNING = 2000, 4, 5
REJECT = 0.3
NEAR = 5
SEED = 5

#: Insults that the first lexicon counts.
INSULTS = frozenset("idiot idiots idiotic moron morons moronic stupid dumb loser losers trash garbage scum clown clowns pathetic worthless disgusting fool fools jerk pig filth vermin imbecile cretin".split())
#: Second-person words of English, German, French and Spanish.
SECOND = frozenset("you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tuyo usted vosotros".split())
#: Characters that stand for letters.
LOOKS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "-": "", ".": "", "_": ""})

NAMES = (
    "insult_density insult_sum word_density word_sum word_max beginning_density beginning_sum second_density second_near "
    "capitals capital_words punctuation exclamations obfuscated obfuscated_insults words"
).split()

WORDS = re.compile(r"[^\W\d_]+")
HIDDEN = re.compile(r"(?:[^\W\d_]+[\d@$!*._-]+)+[^\W\d_]+")
CAPITAL = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{3,}\b")


def kinds() -> np.ndarray:
    """Kind of each code point of the basic plane: 1 upper case, 2 other letter, 3 exclamation or question mark, 4 other punctuation, 0 else."""
    out = np.zeros(65536, np.uint8)
    for i in range(65536):
        c = chr(i)
        out[i] = 1 if c.isupper() else 2 if c.isalpha() else 3 if c in "!?¡¿" else 0 if c.isalnum() or c.isspace() or not c.isprintable() else 4
    return out


_kinds: list[np.ndarray] = []


def features(text: str, words: dict[str, float], beginnings: dict[str, float]) -> list[float]:
    if not text:
        return [0.0] * len(NAMES)
    if not _kinds:
        _kinds.append(kinds())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    count = np.bincount(_kinds[0][np.minimum(codes, 65535)], minlength=5)
    low = WORDS.findall(text.lower())
    n, letters, chars = max(1, len(low)), max(1, count[1] + count[2]), len(codes)
    insults = [i for i, w in enumerate(low) if w in INSULTS]
    learned = [words[w] for w in low if w in words]
    begun = [beginnings[w] for w in [w[:BEGINNING] for w in low] if w in beginnings]
    second = [i for i, w in enumerate(low) if w in SECOND]
    near = 0
    if insults and second:
        at = np.searchsorted(second, insults)
        s = np.array([-(10**9), *second, 10**9])
        near = int((np.minimum(np.abs(s[at] - insults), np.abs(s[at + 1] - insults)) <= NEAR).sum())
    hidden = HIDDEN.findall(text)
    return [
        len(insults) / n, math.log1p(len(insults)), sum(learned) / n, math.log1p(sum(learned)), max(learned, default=0.0), sum(begun) / n, math.log1p(sum(begun)),
        len(second) / n, near / max(1, len(insults)), count[1] / letters, len(CAPITAL.findall(text)) / n, count[4] / chars, count[3] / chars,
        len(hidden) / n, float(sum(h.lower().translate(LOOKS) in INSULTS for h in hidden)), math.log1p(len(low)),
    ]


def extract(words: dict[str, float], beginnings: dict[str, float]):
    """A vectorised function from texts to features. Only the text goes to Python and only the features come back."""

    def run(texts: pd.Series) -> pd.Series:
        out = pd.Series([features(t or "", words, beginnings) for t in texts])
        pa.default_memory_pool().release_unused()
        return out

    return F.pandas_udf(run, "array<double>")


def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic, half) to each document's distinct words and word beginnings."""
    for b in batches:
        for t, y, h in zip((x.as_py() for x in b.column("text")), b.column("toxic").to_pylist(), b.column("half").to_pylist()):
            own = set(WORDS.findall((t or "").lower()))
            for kind, found in enumerate((own, {w[:BEGINNING] for w in own})):
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *(pa.array([x] * n, pa.int32()) for x in (kind, y, h))], ["entry", "kind", "toxic", "half"])


def learn_lexicons(rows: DataFrame) -> list[tuple[dict[str, float], dict[str, float]]]:
    """Words and beginnings whose share of toxic texts is far above the rest's: log odds with a prior, the best ENTRIES of each kind.

    Learned without the first half, without the second, and from all rows.
    """
    halves = [(F.sum(F.when(F.col("half") == h, F.col("toxic")).otherwise(0)).alias(f"t{h}"), F.count_if(F.col("half") == h).alias(f"n{h}")) for h in (0, 1)]
    counts = [c for half in halves for c in half]
    sizes = rows.agg(*counts).first()
    seen = materialize(rows.select("text", "toxic", "half").mapInArrow(lean(entries), "entry string, kind int, toxic int, half int").groupBy("kind", "entry").agg(*counts), "entries")
    out = []
    for used in ((1,), (0,), (0, 1)):
        t, n = (sum((F.col(f"{c}{h}") for h in used), F.lit(0)) for c in "tn")
        toxic, every = (sum(sizes[f"{c}{h}"] for h in used) for c in "tn")
        odds = F.log((F.col("t") + 0.5) / (F.col("n") - F.col("t") + 0.5)) - math.log((toxic + 1) / (every - toxic + 1))
        best = seen.select("kind", "entry", t.alias("t"), n.alias("n")).where(f"n >= {SUPPORT}").withColumn("odds", odds).where("odds > 1.5").withColumn("rank", F.col("odds") * F.sqrt("t"))
        out.append(tuple({r.entry: r.odds for r in best.where(F.col("kind") == k).orderBy(F.desc("rank"), "entry").limit(ENTRIES).collect()} for k in (0, 1)))
    return out


def grow(rows: DataFrame):
    return GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.25, maxBins=64, minInstancesPerNode=2, subsamplingRate=0.9, seed=SEED).fit(rows)


class ToxicityModel:
    """``fit`` on documents and labels; ``score`` adds ``score`` and ``predicted`` to rows of a text."""

    def __init__(self, words, beginnings, trees, calibration, constant):
        self.words, self.beginnings, self.trees, self.calibration, self.constant = words, beginnings, trees, calibration, constant

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
        """``docs`` are looked up by the ids of at most ``sample`` labelled rows that aren't held out."""
        rows = labels.select(labels["doc_id"].cast("long").alias("id"), labels["toxic"].cast("int").alias("toxic")).where("toxic in (0, 1) and id is not null")
        rows = rows.where(~held_out(F.col("id"), 4, 2))
        share = min(1.0, sample / max(1, rows.count()))
        draw = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30))
        rows = rows.where(draw < int(share * (1 << 30))).orderBy(draw, "id", "toxic").limit(sample)
        texts = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].cast("string").alias("text"))
        rows = texts.join(F.broadcast(rows), "id")  # at most ``sample`` ids
        rows = materialize(rows.withColumn("half", F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.lit(2)).cast("int")), "labelled")
        mean = rows.agg(F.avg("toxic").alias("all"), F.countDistinct("half").alias("halves")).first()
        if not mean.all or mean.all == 1 or mean.halves < 2:
            return cls({}, {}, None, None, float(mean.all or 0.0))
        *others, (words, beginnings) = learn_lexicons(rows)
        halves = [rows.where(F.col("half") == h).select("half", "toxic", extract(*others[h])("text").alias("x")) for h in (0, 1)]
        known = materialize(union(halves).coalesce(8), "features").select("half", F.col("toxic").cast("double").alias("label"), array_to_vector("x").alias("features"))
        known = known.coalesce(2).persist()  # each iteration reads the few rows; if lost, they are read again
        *crossed, trees = (grow(known.where(part)) for part in ("half = 1", "half = 0", "true"))
        unseen = union([m.transform(known.where(F.col("half") == h)).select("label", vector_to_array("probability")[1].alias("p")) for h, m in enumerate(crossed)])
        calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="prediction_calibrated").fit(unseen.coalesce(1))
        known.unpersist()
        return cls(words, beginnings, trees, calibration, None)

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` must have a string column text and none named x, features, score or predicted; text is left out of the result."""
        kept = [c for c in rows.columns if c != "text"]
        if self.constant is not None:
            out = rows.select(*kept, F.lit(self.constant).alias("score"))
        else:
            out = rows.select(*kept, extract(self.words, self.beginnings)("text").alias("x")).withColumn("features", array_to_vector("x"))
            out = self.trees.transform(out).withColumn("p", vector_to_array("probability")[1])
            out = self.calibration.transform(out).select(*kept, F.least(F.greatest(F.col("prediction_calibrated"), F.lit(0.0)), F.lit(1.0)).alias("score"))
        return out.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = ToxicityModel.fit(docs, labels, sample)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"].cast("long"), 4, 2).alias("held_out"), docs["text"].cast("string").alias("text"))
    return model.score(rows)


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that aren't predicted to be toxic, with all their columns."""
    model = ToxicityModel.fit(docs, labels, sample)
    return model.score(in_row(docs, docs["text"].cast("string").alias("text"))).where("predicted = 0").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
