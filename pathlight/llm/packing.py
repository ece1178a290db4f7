"""Packing documents into sequences of at most ``SEQUENCE`` tokens: first-fit decreasing in randomised groups.

1. Each task tokenises whole texts, ends each document with ``END`` and cuts it into pieces of 4096 tokens and a rest.
   Strings of the tokeniser's added tokens in a text become those tokens. Token ids don't move: a piece is (document, start, length, CRC-32 of its ids).
2. A full piece is a sequence of its own. The rests are dealt at random into groups of about ``GROUP`` and each group is
   packed by first-fit decreasing: a tournament tree over the capacities of its bins gives the first bin with room in
   O(log bins). A group loses at most its last few bins to padding, so the loss doesn't grow with the input.

Null text counts as empty: a document of one token. Rows that share a ``doc_id`` are packed each for itself. A null
``doc_id`` stays null. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from string import punctuation

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, materialize, slices

SEQUENCE = 4096
END = 2
#: Pieces a group holds on average.
GROUP = 8192
SEED = 7
VOCABULARY = "word_bpe_49k.json"

#: Letters of the Latin blocks and plain punctuation: where `re` and the tokeniser agree on what a letter is.
PLAIN = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ‘’“”„–—…«»¡¿€]")
#: The tokeniser's own split of text into words, for plain text.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Bytes of words and their ids that a worker remembers before it lets old ones go, what a word costs besides, and words that
#: are encoded at a time. Texts with a word of over 256 bytes go to the tokeniser whole, so that none is remembered.
CACHE, EACH = 96 << 20, 150
BATCH = 500
LONG = 256


def split_word(word: str) -> Sequence[str]:
    """The parts of a word of a plain text; letters with punctuation behind them, the usual ones, without the pattern."""
    head = word.rstrip(punctuation)
    if head.isalpha():
        return (head, word[len(head) :]) if len(head) < len(word) else (word,)
    return SPLIT.findall(unicodedata.normalize("NFC", word))


def byte_letters() -> dict[int, str]:
    """The letter that the byte-level vocabulary has for each byte; a space stays, to part words."""
    own = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
    return own | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)} | {32: " "}


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokeniser never merges across white space, so in plain texts each distinct word between white space is encoded
    once and remembered. New words are normalised and split here and go to the tokeniser's model many at a time: the
    tokens that close a word show where each ends. Any other text goes to the tokeniser whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        #: The same model, for words that are normalised, split and spelt in the letters of bytes.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.letters = byte_letters()
        #: Strings that the tokeniser takes for one token anywhere in a text, inside a word too.
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def plain(self, text: str) -> str | None:
        """A plain text without added tokens in lower case."""
        if PLAIN.search(text):
            return None
        lower = text.lower()
        return None if any(t in lower for t in self.added) else lower

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of_parts(self, parts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(parts), BATCH):
            spelt = " ".join(parts[i : i + BATCH]).encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.model.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")
            ends = ((np.flatnonzero(self.closes[ids]) + 1) * 4).tolist()
            raw = ids.tobytes()
            yield from (raw[a:b] for a, b in zip([0, *ends], ends))

    def of_words(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words. Of two generations the older goes when the younger is full; what is met again moves up."""
        if 2 * self.held > CACHE:
            self.words, self.old, self.held = {}, self.words, 0
        out = list(map(self.words.get, words))
        missed = [w for w, ids in zip(words, out) if ids is None]
        if not missed:
            return out
        again = list(map(self.old.get, missed))
        new = [w for w, ids in zip(missed, again) if ids is None]
        split = list(map(split_word, new))
        known = {p: self.words.get(p) or self.old.get(p) for s in split if len(s) > 1 for p in s}
        for s in split:
            if len(s) == 1:
                known.setdefault(s[0])
        parts = [p for p, ids in known.items() if ids is None]
        known.update(zip(parts, self.of_parts(parts)))
        learned = iter([known[s[0]] if len(s) == 1 else b"".join(map(known.__getitem__, s)) for s in split])
        again = [next(learned) if ids is None else ids for ids in again]
        self.words.update(zip(missed, again))
        self.held += EACH * len(missed) + sum(map(len, missed)) + sum(map(len, again))
        found = iter(again)
        return [next(found) if ids is None else ids for ids in out]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """One text after another, so that no more than one text's ids are held."""
        plain = [self.plain(t) for t in texts]
        words, ends = split_words(plain)
        long = np.flatnonzero(pc.binary_length(words).to_numpy() > LONG)
        if len(long):
            for i in set((np.searchsorted(ends, long, side="right") - 1).tolist()):
                plain[i] = None
            words, ends = split_words(plain)
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy()
        found = self.of_words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        firsts = np.cumsum(counts) - counts
        ids = np.frombuffer(b"".join(found), "<u4")
        for text, own, a, b in zip(texts, plain, ends[:-1].tolist(), ends[1:].tolist()):
            if own is None:
                yield self.whole(text)
                continue
            c = codes[a:b]
            n = counts[c]
            before = np.cumsum(n) - n
            yield ids[np.repeat(firsts[c] - before, n) + np.arange(n.sum())].tobytes()


def split_words(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The words between white space of plain texts, one list after another, and where each list begins and the last ends. Null has none."""
    lists = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
    return lists.values, lists.offsets.to_numpy()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(path: str | None, size: int = SEQUENCE, end: int = END):
    """(doc_id, text) to pieces of at most ``size`` tokens. ``path``: the vocabulary; where the package has it, if None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path or vocabulary())
        last = np.array([end], "<u4").tobytes()
        for big in batches:
            for b in slices(big, "text", 500):
                texts = [t or "" for t in b.column("text").to_pylist()]
                rows = []
                for doc, ids in zip(b.column("doc_id").to_pylist(), own.encode(texts)):
                    ids += last
                    n = len(ids) // 4
                    for s in range(0, n, size):
                        part = ids[4 * s : 4 * (s + size)]
                        rows.append((doc, s, len(part) // 4, zlib.crc32(part), n))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


class Tournament:
    """Bins in order of opening; a tree of the most room in each range of bins finds the first that has enough."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = room
        self.tree = [room] * (2 * self.leaves)

    def place(self, need: int) -> tuple[int, int]:
        """The first bin with room for ``need``, and where in it the piece begins."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at *= 2
            if tree[at] < need:
                at += 1
        start = self.room - tree[at]
        found = at - self.leaves
        tree[at] -= need
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
        return found, start


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Ties keep their order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = Tournament(len(lengths), size)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i], offsets[i] = tree.place(int(lengths[i]))
    return bins, offsets


def pack_group(size: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "order"], ascending=[False, True])
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), size)
        return group.assign(sequence_id=(group["grp"].to_numpy() << 32) + bins, offset=offsets).drop(columns=["grp", "order"])

    return run


def pack(docs: DataFrame, size: int = SEQUENCE, group: int = GROUP, path: str | None = None, end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    Sequences of full pieces have negative ids, those of packed rests are (group, bin).
    """
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = materialize(texts.mapInArrow(lean(pieces(path, size, end)), PIECES).withColumn("order", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == size
    groups = -(-rows.where(~full).count() // group) or 1
    whole = rows.where(full).withColumns({"sequence_id": -1 - F.col("order"), "offset": F.lit(0).cast("long")}).drop("order")
    grp = F.pmod(F.xxhash64("order", "doc_id", F.lit(SEED)), F.lit(groups)).cast("long")
    rests = rows.where(~full).withColumn("grp", grp).groupBy("grp").applyInPandas(pack_group(size), f"{PIECES}, sequence_id bigint, offset bigint")
    return whole.unionByName(rests)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
