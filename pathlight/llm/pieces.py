"""SentencePiece encoding and decoding: byte-pair merges of a public model, done for many words at a time.

A text is normalised as the model says (a space in front, spaces as a mark) and cut into words before each run of marks.
A worker encodes each distinct word once, and remembers up to ``CACHE`` bytes of them; words of over ``LONG`` characters
aren't remembered. New words are encoded together:

1. Their characters are one flat array of symbols, cut wherever no piece of the vocabulary has two neighbours side by side.
2. In rounds, each part finds the best pair of neighbours that a piece stands for, and merges it where it occurs from the
   left on; merges that are done at once give what one after another would: a part stops for this round behind the first
   merge that makes a pair at least as good.
3. Merged symbols are compacted; parts without such a pair leave. The rounds end when no pair remains. What is left of a
   part after ``ROUNDS`` rounds (long runs of spaces, whose pieces are all equally good) is merged pair by pair from a heap.

Symbols that aren't pieces become the bytes of their characters. Decoding takes the surfaces of pieces and bytes, without
the space in front; bytes that are no UTF-8 become U+FFFD, as many as the library gives.

Models whose normaliser rewrites characters, or that aren't byte-pair models, are refused. Null texts are empty and have
no ids. Rows that share a ``doc_id`` are rows of their own. A null list of ids decodes to null. Other columns are kept, but
those of the names that are added.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from .common import lean, slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Bytes of words and their ids that a worker remembers before it lets old ones go, and what a word costs besides.
CACHE, EACH = 96 << 20, 150
#: Characters of a word beyond which it isn't remembered, and of words that are encoded together.
LONG, TOGETHER = 128, 1 << 20
ROUNDS = 200
#: Bytes of text that are encoded at a time, and texts at most.
BLOCK, TEXTS = 4 << 20, 2000
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NONE = np.iinfo(np.int32).max


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Vocabulary:
    """The pieces of a model, which of them a pair of symbols makes, and how good each is.

    A symbol is the number of a piece, or of a character that is none: those come after the pieces.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        self.library = SentencePieceProcessor(model_file=path)
        model.ParseFromString(self.library.serialized_model_proto())
        rules, kinds = model.normalizer_spec, model.SentencePiece
        plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
        bpe = model.trainer_spec.model_type == model.trainer_spec.BPE and model.trainer_spec.byte_fallback and not model.trainer_spec.treat_whitespace_as_suffix
        if not plain or not bpe or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("only byte-pair models with byte fallback and without rules of normalisation are read")
        self.size = len(model.pieces)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.bytes = np.zeros(256, np.uint32)
        surfaces = []
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
                surfaces.append(bytes([int(p.piece[3:5], 16)]))
            else:
                surfaces.append({kinds.CONTROL: "", kinds.UNKNOWN: model.trainer_spec.unk_surface}.get(p.type, p.piece.replace(MARK, " ")).encode())
        self.surfaces = pa.array(surfaces, pa.large_binary())
        self.is_byte = np.zeros(self.size, bool)
        self.is_byte[self.bytes] = True
        self.is_control = np.array([p.type == kinds.CONTROL for p in model.pieces])
        # ranks: the same for pieces of one score, smaller for better ones
        scores = -np.array([p.score for p in model.pieces])
        rank = np.unique(scores, return_inverse=True)[1].astype(np.int32)
        self.characters = {c: i for c, i in self.ids.items() if len(c) == 1}
        made = {}
        for piece, i in self.ids.items():
            for at in range(1, len(piece)):
                parts = [self.ids.get(x) if len(x) > 1 else self.character(x) for x in (piece[:at], piece[at:])]
                if None not in parts:
                    made[parts[0], parts[1]] = i
        self.wide = len(self.characters) + self.size  # no more symbols than these occur in a pair
        self.keys, self.makes = self.sorted({a * self.wide + b: i for (a, b), i in made.items()})
        self.rank = rank[self.makes]
        bits = 21  # most neighbours make no piece: a bit map turns them down before the search
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.slot(self.keys)] = True
        self.joined = np.sort(np.array(list({ord(a) << 32 | ord(b) for p in self.ids for a, b in zip(p, p[1:])}), np.int64))
        codes = np.array(sorted(map(ord, self.characters)), np.int64)
        self.codes, self.symbols = codes, np.array([self.characters[chr(c)] for c in codes.tolist()], np.int64)

    def character(self, c: str) -> int:
        """The symbol of a character; one that is only part of pieces gets a number behind them."""
        return self.characters.setdefault(c, self.size + len(self.characters))

    @staticmethod
    def sorted(table: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array(sorted(table), np.int64)
        return keys, np.array([table[k] for k in keys.tolist()], np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and pieces of pairs of symbols; the rank is NONE where they make no piece. A symbol -1 makes none."""
        rank, made = np.full(len(left), NONE, np.int32), np.zeros(len(left), np.int64)
        key = np.where((left < 0) | (right < 0), -1, left * self.wide + right)
        some = np.flatnonzero(self.maybe[self.slot(key)] & (key >= 0))
        at = np.minimum(np.searchsorted(self.keys, key[some]), len(self.keys) - 1)
        right_ones = self.keys[at] == key[some]
        some, at = some[right_ones], at[right_ones]
        rank[some], made[some] = self.rank[at], self.makes[at]
        return rank, made

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols of all words after the last merge, the character that each begins at, and where each word's characters begin."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        begins = np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words))))
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        symbols = np.where(self.codes[at] == codes, self.symbols[at], -1)
        # parts: no piece reaches over their ends
        new = np.ones(len(codes), bool)
        key = codes[:-1] << 32 | codes[1:]
        near = np.minimum(np.searchsorted(self.joined, key), len(self.joined) - 1)
        new[1:] = self.joined[near] != key
        new[begins[:-1]] = True
        done = []
        place = np.arange(len(codes))
        rank, made = self.pairs(symbols, np.append(symbols[1:], -1))
        rank[np.append(np.flatnonzero(new)[1:], len(codes)) - 1] = NONE
        rounds = 0
        while len(symbols):
            if rounds == ROUNDS:
                done.append(self.one_by_one(symbols, place, new))
                break
            rounds += 1
            start = np.flatnonzero(new)
            lengths = np.diff(np.append(start, len(symbols)))
            best = np.minimum.reduceat(rank, start)
            over = np.repeat(best == NONE, lengths)
            if over.any():  # parts without a pair leave
                done.append((symbols[over], place[over]))
                symbols, place, rank, made, new = (x[~over] for x in (symbols, place, rank, made, new))
                if not len(symbols):
                    break
                live = best != NONE
                best, lengths = best[live], lengths[live]
            part = np.repeat(np.arange(len(lengths)), lengths)
            left = self.from_the_left(np.flatnonzero(rank == best[part]))
            left, before, behind = self.until_a_better(symbols, made, new, left, part, best)
            symbols[left] = made[left]
            # ranks of the pairs that a merge has changed: with the symbol before, and with the one behind
            stay = np.ones(len(symbols), bool)
            stay[left + 1] = False
            change = np.union1d(left, before[before >= 0])
            symbols, place, rank, made, new = (x[stay] for x in (symbols, place, rank, made, new))
            change = (np.cumsum(stay) - 1)[change]
            follow = np.minimum(change + 1, len(symbols) - 1)
            rank[change], made[change] = self.pairs(symbols[change], np.where((change + 1 < len(symbols)) & ~new[follow], symbols[follow], -1))
        if not done:
            return symbols, place, begins
        symbols, place = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place, kind="stable")
        return symbols[order], place[order], begins

    @staticmethod
    def from_the_left(at: np.ndarray) -> np.ndarray:
        """Of ascending places, those that pairs can be merged at one after another: every second one of neighbours in a row."""
        if not len(at):
            return at
        row = np.append(True, np.diff(at) > 1)
        first = np.flatnonzero(row)
        return at[(np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))) % 2 == 0]

    def until_a_better(self, symbols, made, new, left, part, best):
        """The merges up to the first of each part that makes a pair as good as the one merged, or better; and the symbols before and behind each, -1 for none."""
        last = len(symbols)
        joined = np.append(False, left[1:] == left[:-1] + 2) & ~new[left]  # the symbol before was just merged as well
        before = np.where(new[left], -1, np.where(joined, left - 2, left - 1))
        behind = np.where((left + 2 < last) & ~new[np.minimum(left + 2, last - 1)], left + 2, -1)
        own = made[left]
        ahead = np.where(before < 0, -1, np.where(joined, np.append(-1, own[:-1]), symbols[np.maximum(before, 0)]))
        good = np.minimum(self.pairs(ahead, own)[0], self.pairs(own, np.where(behind < 0, -1, symbols[behind]))[0]) <= best[part[left]]
        if good.any():
            first = np.flatnonzero(np.append(True, part[left][1:] != part[left][:-1]))
            lengths = np.diff(np.append(first, len(left)))
            earlier = np.cumsum(good) - good
            keep = earlier - np.repeat(earlier[first], lengths) == 0
            left, before, behind = left[keep], before[keep], behind[keep]
        return left, before, behind

    def one_by_one(self, symbols: np.ndarray, place: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last symbols of parts, by merging the best pair again and again, the leftmost first."""
        table = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.makes.tolist())))
        own, n = symbols.tolist(), len(symbols)
        first, last = new.tolist(), np.append(new[1:], True).tolist()
        behind, before, heap = [i + 1 if not last[i] else -1 for i in range(n)], [i - 1 if not first[i] else -1 for i in range(n)], []

        def look(i: int) -> None:
            j = behind[i] if i >= 0 else -1
            if j >= 0 and own[i] >= 0 and own[j] >= 0 and (found := table.get(own[i] * self.wide + own[j])):
                heapq.heappush(heap, (found[0], i, own[i], own[j], found[1]))

        for i in range(n):
            look(i)
        gone = np.zeros(n, bool)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = behind[i]
            if gone[i] or own[i] != a or j < 0 or own[j] != b:
                continue
            own[i], gone[j], behind[i] = made, True, behind[j]
            if behind[i] >= 0:
                before[behind[i]] = i
            look(before[i])
            look(i)
        return np.array(own, np.int64)[~gone], place[~gone]

    def encoded(self, words: list[str]) -> Iterator[np.ndarray]:
        """The ids of each normalised word."""
        symbols, place, begins = self.merged(words)
        lost = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        if len(lost):  # each is one character: its bytes instead
            text = "".join(words)
            raw = [text[i].encode() for i in place[lost].tolist()]
            counts = np.ones(len(symbols), np.int64)
            counts[lost] = list(map(len, raw))
            out = np.repeat(symbols, counts)
            starts = np.cumsum(counts) - counts
            for i, b in zip(starts[lost].tolist(), raw):
                out[i : i + len(b)] = self.bytes[list(b)]
            symbols, place = out, np.repeat(place, counts)
        ends = np.searchsorted(place, begins)
        symbols = symbols.astype("<u4")
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            yield symbols[a:b]


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes; a worker's memory of words is in it."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.words, self.old, self.held = vocabulary, {}, {}, 0

    def learned(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, a bounded number of characters at a time."""
        out, at = {}, 0
        while at < len(words):
            end, size = at, 0
            while end < len(words) and (size == 0 or size + len(words[end]) <= TOGETHER):
                size += len(words[end])
                end += 1
            out.update(zip(words[at:end], (x.tobytes() for x in self.vocabulary.encoded(words[at:end]))))
            at = end
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if 2 * self.held > CACHE:  # of two generations the older goes; what is met again moves up
            self.words, self.old, self.held = {}, self.words, 0
        known = self.words
        new = {w for words in split for w in words} - known.keys()
        met = {w: self.old[w] for w in new if w in self.old}
        ids = self.learned(list(new - met.keys()))
        for w, x in [*met.items(), *ids.items()]:
            if len(w) <= LONG:
                known[w] = x
                self.held += EACH + len(w) + len(x)
        return [b"".join([known[w] if w in known else ids[w] for w in words]) for words in split]

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of lists of ids that stand one after another in ``flat``."""
        own = self.vocabulary
        if len(flat) and (flat.min() < 0 or flat.max() >= own.size):
            raise ValueError("an id is outside the vocabulary")
        strings = own.surfaces.take(pa.array(flat))
        raw = strings.buffers()[2]
        ends = np.frombuffer(strings.buffers()[1], np.int64)[np.append(0, np.cumsum(counts))] if len(flat) else np.zeros(len(counts) + 1, np.int64)
        data = raw.to_pybytes() if raw is not None else b""
        out, at = [], 0
        for n, a, b in zip(counts.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
            ids = flat[at : at + n]
            at += n
            out.append(self.text_of(data[a:b], ids))
        return out

    def text_of(self, raw: bytes, ids: np.ndarray) -> str:
        own = self.vocabulary
        shown = ids[~own.is_control[ids]]
        try:  # a control piece shows nothing, but ends a run of bytes
            text = raw.decode() if len(shown) == len(ids) else self.with_replacements(ids)
        except UnicodeDecodeError:
            text = self.with_replacements(ids)
        first = shown[:1]
        return text[1:] if len(first) and not own.is_byte[first[0]] and text.startswith(" ") and first[0] != own.library.unk_id() else text

    def with_replacements(self, ids: np.ndarray) -> str:
        """The text of ids whose runs of bytes are decoded each by itself."""
        own, out = self.vocabulary, []
        is_byte = own.is_byte[ids]
        cuts = np.flatnonzero(np.diff(is_byte)) + 1
        for part in np.split(ids, cuts):
            raw = b"".join(own.surfaces.take(pa.array(part)).to_pylist())
            out.append(replaced(raw) if own.is_byte[part[0]] else raw.decode())
        return "".join(out)


def replaced(raw: bytes) -> str:
    """Bytes as text; each byte that begins no character is U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        size = 1 if raw[at] < 0x80 else 2 if 0xC2 <= raw[at] < 0xE0 else 3 if 0xE0 <= raw[at] < 0xF0 else 4 if 0xF0 <= raw[at] < 0xF5 else 1
        try:
            out.append(raw[at : at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """One for each Python worker."""
    path = path or model_path()
    if path not in _encoders:
        _encoders[path] = Encoder(Vocabulary(path))
    return _encoders[path]


def with_column(b: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*b.columns, values], [*b.schema.names, name])


def encoding(column: str, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for big in batches:
            for b in slices(big, column, TEXTS, BLOCK):
                ids = own.encode([t or "" for t in b.column(column).to_pylist()])
                ends = np.append(0, np.cumsum([len(x) // 4 for x in ids]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                keep = [i for i, name in enumerate(b.schema.names) if name != column]
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), lists], [*(b.schema.names[i] for i in keep), "ids"])

    return run


def decoding(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for big in batches:
            for at in range(0, big.num_rows, TEXTS):
                b = big.slice(at, TEXTS)
                lists = b.column("ids")
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                flat = lists.flatten()
                if flat.null_count:
                    raise ValueError("an id is null")
                texts = own.decode(flat.to_numpy(), counts)
                yield with_column(b, "decoded", pa.array([t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist())], pa.string()))

    return run


def kept_beside(df: DataFrame, *names: str) -> list:
    return [df[c] for c in df.columns if c not in names]


def encode(docs: DataFrame, column: str = "text", path: str | None = None) -> DataFrame:
    """The other columns of ``docs`` and ``ids``, the list of ids of the column's whole text. ``path``: the model; where the package has it, if None."""
    rows = docs.select(*kept_beside(docs, "ids", column), docs[column].cast("string").alias(column))
    schema = StructType([f for f in rows.schema.fields if f.name != column]).add("ids", ArrayType(IntegerType()))
    return rows.mapInArrow(lean(encoding(column, path)), schema)


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` and ``decoded``, the text of the list ``ids``."""
    rows = rows.select(*kept_beside(rows, "ids", "decoded"), rows["ids"].cast("array<int>").alias("ids"))
    return rows.mapInArrow(lean(decoding(path)), StructType(list(rows.schema.fields)).add("decoded", StringType()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = decode(encode(docs.select("doc_id", "text")))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
