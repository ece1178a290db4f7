"""Language identification by unigram models over the pieces of a fixed public vocabulary, summed over segmentations.

The probability of a word in a language is the sum, over all ways to cut it into pieces of the vocabulary, of the
product of the pieces' probabilities; the forward algorithm gives it without listing the cuts. A text's is the product
over its words. Probabilities are learned by expectation-maximisation from at most ``DOCS`` documents a language that
aren't held out: each round, tasks send expected piece counts (at most vocabulary x languages rows each) to be summed.
Every value of ``lang`` is a language; the driver and each worker hold vocabulary x languages numbers.

Scoring runs in Arrow batches over whole texts; each worker scores a distinct word once, many words at a time, and
remembers ``CACHE`` bytes of scores. Words of over ``LONG`` letters (scripts without spaces, blobs) are walked in
windows and aren't remembered. They teach like all others: sums are scaled at each character, in any script.

A text that is null or has no letter is ``und`` with score 0, and so is every text if there is nothing to learn from.
A document whose ``lang`` is null teaches nothing. Ties go to the language that sorts first. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, lean, materialize, slices

DOCS = 600
ROUNDS = 4
SEED = 13
#: Bytes of word scores that a worker remembers before it starts anew.
CACHE = 64 << 20
#: Words that are scored together: of all of them, at most so many bytes of forward sums are held.
CHUNK = 64 << 20
#: Letters of a word beyond which it is walked by itself, and characters of it that are looked up at a time.
LONG, WINDOW = 64, 8192
#: The least probability of a character outside the vocabulary, or one that no piece covers; and its share of what a
#: language has of such characters. Scripts outside the vocabulary are told from others by that.
UNKNOWN, SPREAD = 1e-7, 0.01
#: What is added to each expected count.
SMOOTH = 0.05
WORDS = re.compile(r"[^\W\d_]+")
BASE = np.uint64(0x100000001B3)
START = "▁"
MODEL = "piece_bpe_32k.model"


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Pieces:
    """Lower-case letter pieces of the vocabulary, with and without the word start, found by a rolling hash."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or model_path())
        own = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        self.pieces = sorted({p for p in own if (w := p.removeprefix(START)) and w.isalpha() and w == w.lower()})
        self.longest = max(map(len, self.pieces), default=1)
        keys = np.array([self.key(p) for p in self.pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order.astype(np.int64)
        bits = 22  # most substrings are no piece: a bit map turns them down before the search
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.slot(self.keys)] = True

    def __len__(self) -> int:
        return len(self.pieces)

    @staticmethod
    def key(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c)) & (2**64 - 1)
        return h

    def slot(self, h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes, -1 for none."""
        out = np.full(len(h), -1, np.int64)
        some = np.flatnonzero(self.maybe[self.slot(h)])
        at = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
        right = self.keys[at] == h[some]
        out[some[right]] = self.ids[at[right]]
        return out

    def lattice(self, words: list[str]) -> list[list[np.ndarray]]:
        """For words of one length, [i][l - 1]: the piece from character i of length l of each word, -1 for none. The start is character 0."""
        n = len(words[0]) + 1
        codes = np.frombuffer("".join(START + w for w in words).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.uint64)
        out = []
        for i in range(n):
            h, row = np.zeros(len(words), np.uint64), []
            for j in range(i, min(n, i + self.longest)):
                h = h * BASE + codes[:, j]
                row.append(self.find(h))
            out.append(row)
        return out

    def forward(self, lattice: list[list[np.ndarray]], p: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Scaled forward sums at each character, and the log probability, of each word in each language. ``p``: pieces x languages, then a row for the unknown."""
        n, words, langs = len(lattice), len(lattice[0][0]), p.shape[1]
        f = [np.ones((words, langs))] + [np.zeros((words, langs)) for _ in range(n)]
        log = np.zeros((words, langs))
        for i in range(n):
            if i:  # what reaches character i is complete: scale it and all that it has led to so far
                scale = f[i].copy()
                log += np.log(scale)
                for j in range(i, min(n, i + self.longest) + 1):
                    f[j] /= scale
            for k, piece in enumerate(lattice[i]):
                has = np.flatnonzero(piece >= 0)
                if len(has):
                    f[i + k + 1][has] += f[i][has] * p[piece[has]]
            none = np.flatnonzero(lattice[i][0] < 0)  # a lone character always has a way on
            f[i + 1][none] += f[i][none] * p[-1]
        return f, log + np.log(f[n])

    def chunk(self, length: int, langs: int) -> int:
        """Words of a length that are taken together: their sums and pieces stay below CHUNK bytes."""
        return max(1, CHUNK // (8 * (length + 2) * (langs + self.longest)))

    def scores(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Log probabilities, words x languages."""
        out = np.zeros((len(words), p.shape[1]))
        lengths = np.array(list(map(len, words)))
        order = np.argsort(lengths, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
            n = int(lengths[part[0]])
            if n > LONG:
                for i in part.tolist():
                    out[i] = self.walk(words[i], p)
                continue
            size = self.chunk(n, p.shape[1])
            for at in range(0, len(part), size):
                own = part[at : at + size]
                out[own] = self.forward(self.lattice([words[i] for i in own]), p)[1]
        return out

    def walk(self, word: str, p: np.ndarray) -> np.ndarray:
        """Log probability of one long word in each language: the forward sums of the last ``longest`` characters move along it."""
        wide, langs, most = np.vstack([p, np.zeros((1, p.shape[1]))]), p.shape[1], self.longest
        none, codes = len(wide) - 1, np.frombuffer((START + word).encode("utf-32-le"), np.uint32).astype(np.uint64)
        n, size = len(codes), max(most, min(WINDOW, CHUNK // (8 * most * langs)))
        sums, log = np.zeros((most, langs)), np.zeros(langs)  # of the characters before the window, the last one last
        sums[-1] = 1
        for a in range(0, n, size):
            ends = min(size, n - a)  # pieces that end at a + 1 .. a + ends
            first = max(0, a + 1 - most)
            part = codes[first : a + ends]
            ending = np.full((ends, most), none)  # [end][length - 1]
            h = np.zeros(len(part), np.uint64)
            for k in range(min(most, len(part))):
                h = h[: len(part) - k] * BASE + part[k:]
                found = self.find(h)
                if k == 0:
                    found = np.where(found < 0, len(p) - 1, found)  # a lone character always has a way on
                start = max(0, a - k - first)  # the first of them that ends in the window
                own = found[start:]
                at = first + start + k - a
                ending[at : at + len(own), k] = np.where(own < 0, none, own)
            f = np.vstack([sums, np.zeros((ends, langs))])
            for i, row in enumerate(wide[ending[:, ::-1]]):
                f[most + i] = (f[i : most + i] * row).sum(axis=0)
                if i % 8 == 7 or i == ends - 1:
                    scale = f[most + i].copy()
                    log += np.log(scale)
                    f[i + 1 : most + i + 1] /= scale
            sums = f[-most:]
        return log

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected counts of each piece (and of the unknown) in words that occur ``counts`` times, in one language."""
        out = np.zeros(len(self) + 1)
        lengths = np.array(list(map(len, words)))
        order = np.argsort(lengths, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
            n = int(lengths[part[0]])
            size = self.chunk(n, self.longest) if n <= LONG else 1
            for at in range(0, len(part), size):
                own = part[at : at + size]
                self.expect([words[i] for i in own], counts[own], p, out)
        return out

    def expect(self, words: list[str], weight: np.ndarray, p: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected counts of words of one length. Sums are scaled at each character and their scale is kept as a
        logarithm, so that they are finite for words of any length; a long word's pieces are looked up window by window."""
        codes = np.frombuffer("".join(START + w for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)
        n, most = codes.shape[1], self.longest
        step = max(most, WINDOW // len(words))
        odds = np.append(p, 0.0)  # the last for no piece, before it the unknown
        none, unknown = len(odds) - 1, len(odds) - 2

        def lattice(first: int) -> np.ndarray:
            """[i][l - 1]: the piece from character first + i of length l."""
            found = np.full((min(step, n - first), most, len(words)), none)
            h = np.zeros((len(words), len(found)), np.uint64)
            for k in range(most):
                live = min(len(found), n - first - k)  # those that end inside the word
                if live <= 0:
                    break
                h = h[:, :live] * BASE + codes[:, first + k : first + k + live]
                piece = self.find(h.ravel()).reshape(h.shape).T
                found[:live, k] = np.where(piece >= 0, piece, unknown if k == 0 else none)
            return found

        # forward: f[i] is scaled to 1, what it leads to is relative to it; log[i] is the logarithm of the scale so far
        log, ahead = np.zeros((n + 1, len(words))), np.zeros((most + 1, len(words)))
        ahead[0] = 1
        for first in range(0, n, step):
            for i, row in enumerate(lattice(first), first):
                log[i] = log[i - 1] + np.log(ahead[0]) if i else 0
                ahead = np.vstack([ahead[1:] / ahead[0], np.zeros((1, len(words)))])
                ahead[:most] += odds[row]
        log[n] = log[n - 1] + np.log(ahead[0])
        # backward, likewise: behind[l - 1] is the sum from l characters further on, relative to the one at i + 1
        behind, back = np.zeros((most, len(words))), np.zeros(len(words))
        behind[0] = 1
        for first in reversed(range(0, n, step)):
            pieces = lattice(first)
            for i in range(first + len(pieces) - 1, first - 1, -1):
                row = pieces[i - first]
                ways = odds[row] * behind
                share = ways * (weight * np.exp(log[i] + back - log[n]))
                some = share > 0
                out += np.bincount(row[some], share[some], minlength=len(out) + 1)[: len(out)]
                total = ways.sum(axis=0)
                back = back + np.log(total)
                behind = np.vstack([np.ones((1, len(words))), behind[:-1] / total])


_pieces: dict[str, Pieces] = {}


def pieces_of(path: str | None) -> Pieces:
    """One for each Python worker."""
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(no, text) to the words of each text."""
    for b in batches:
        for no, t in zip(b.column("no").to_pylist(), (x.as_py() for x in b.column("text"))):
            words = WORDS.findall((t or "").lower())
            yield pa.RecordBatch.from_arrays([pa.array([no] * len(words), pa.int32()), pa.array(words, pa.string())], ["no", "word"])


def expectations(path: str | None, p: np.ndarray):
    """(no, word, n) to expected counts of pieces: at most one row a language and piece from a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = pieces_of(path), np.zeros(p.shape)
        for b in batches:
            no, n, words = b.column("no").to_numpy(), b.column("n").to_numpy(), b.column("word").to_pylist()
            for k in np.unique(no):
                at = np.flatnonzero(no == k)
                sums[:, k] += own.expected([words[i] for i in at], n[at].astype(float), p[:, k])
        piece, k = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(sums[piece, k])], ["no", "piece", "n"])

    return run


class LanguageModel:
    """``langs``, and the pieces' probabilities: pieces (and the unknown) x languages."""

    def __init__(self, langs: list[str], p: np.ndarray, path: str | None = None):
        self.langs, self.p, self.path = langs, p, path

    @classmethod
    def fit(cls, docs: DataFrame, per_language: int = DOCS, rounds: int = ROUNDS, path: str | None = None) -> LanguageModel:
        """``docs``: those with a lang, not held out, are learned from, about ``per_language`` of each language."""
        spark = docs.sparkSession
        rows = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")).where("lang is not null")
        rows = rows.where(~held_out(F.col("id"), 3, 1))
        counts = rows.groupBy("lang").count().collect()
        langs = sorted(r.lang for r in counts)
        size = {r.lang: r["count"] for r in counts}
        if not langs:
            return cls([], np.zeros((1, 0)), path)
        shares = spark.createDataFrame([(i, lang, int(min(1.0, per_language / size[lang]) * (1 << 30))) for i, lang in enumerate(langs)], "no int, lang string, share bigint")
        some = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) < F.col("share"))
        words = some.select("no", "text").mapInArrow(lean(word_lists), "no int, word string").groupBy("no", "word").agg(F.count("*").alias("n"))
        words = materialize(words, "words")
        size_of = len(pieces_of(path))
        p = np.full((size_of + 1, len(langs)), 1.0 / (size_of + 1))
        p[-1] = UNKNOWN
        for _ in range(rounds):
            found = words.mapInArrow(lean(expectations(path, p)), "no int, piece int, n double").groupBy("no", "piece").agg(F.sum("n").alias("n")).toPandas()
            sums = np.zeros(p.shape)
            sums[found["piece"], found["no"]] = found["n"]
            if not np.isfinite(sums).all():
                raise ArithmeticError("expected counts aren't finite")
            p = (sums + SMOOTH) / (sums + SMOOTH).sum(axis=0)
            p[-1] = np.maximum(UNKNOWN, SPREAD * p[-1])
        return cls(langs, p, path)

    def scorer(self):
        langs, p, path = self.langs, self.p, self.path

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = pieces_of(path)
            known: dict[str, int] = {}
            table = np.zeros((0, len(langs)))
            most = max(1000, CACHE // (8 * max(1, len(langs))))
            for big in batches:
                for b in slices(big, "text", 1000):
                    texts = [WORDS.findall((x.as_py() or "").lower()) for x in b.column("text")]
                    if len(known) > most:
                        known, table = {}, table[:0]
                    new = list({w for t in texts for w in t if len(w) <= LONG and w not in known}) if langs else []
                    if new:
                        known.update(zip(new, range(len(known), len(known) + len(new))))
                        table = np.concatenate([table, own.scores(new, p)])
                    best, score = [], []
                    for t in texts:
                        if not t or not langs:
                            best.append("und")
                            score.append(0.0)
                            continue
                        log = table[[known[w] for w in t if len(w) <= LONG]].sum(axis=0) + own.scores([w for w in t if len(w) > LONG], p).sum(axis=0)
                        k = int(log.argmax())
                        best.append(langs[k])
                        score.append(float(1 / np.exp(log - log[k]).sum()))
                    keep = [i for i, name in enumerate(b.schema.names) if name != "text"]
                    yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(best, pa.string()), pa.array(score, pa.float64())], [*(b.schema.names[i] for i in keep), "lang_pred", "score"])

        return run


def identify(docs: DataFrame, model: LanguageModel | None = None, **options) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = model or LanguageModel.fit(docs, **options)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"].cast("long"), 3, 1).alias("held_out"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(lean(model.scorer()), "doc_id bigint, held_out boolean, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
