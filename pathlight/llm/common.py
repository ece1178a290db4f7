"""What the training-data operators share: tables written between stages, row ids, and text helpers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import shared
from ..functions.shared import fresh_path, materialize, numbered  # noqa: F401  also for the operators

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space of the contracts: space and tab to carriage return. The same bytes that ``bytes.split()`` splits at.
WORD = r"[^\x20\x09-\x0D]+"


def clean(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder, and its digest indexes there. Call it when its results are used up."""
    shared.clean(spark)
    for t in spark.catalog.listTables("default", "digest_index_*"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def slices(batch: pa.RecordBatch, column: str, rows: int, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``rows`` rows and about ``size`` bytes of a text column, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        most = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
        end = min(at + rows, max(at + 1, most))
        yield batch.slice(at, end - at)
        at = end


def give_back() -> None:
    """Give memory that Arrow's pool and the C library hold without use back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function of batches whose worker gives what Arrow no longer uses back to the system, batch by batch, and what no one uses at the end.

    Workers are used again, so that what one stage leaves would count in all later ones.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pa.default_memory_pool()

        def each() -> Iterator[pa.RecordBatch]:
            for b in batches:
                pool.release_unused()
                yield b

        yield from run(each())
        give_back()

    return own


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def new_file(folder: str, name: str):
    """A file of this attempt of a task alone, in the shared folder, and its name."""
    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    return fs.open_output_stream(f"{path}/{name}"), name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo ``mod``, is ``rest`` (null ids are trained on)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


#: Rows of a table of ids or digests that are broadcast at most: some ten megabytes. Larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def is_small(written: DataFrame) -> bool:
    return written.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def small_side(written: DataFrame) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it is small enough."""
    return F.broadcast(written) if is_small(written) else written


def text_digest(text: Column) -> Column:
    """16 bytes that tell texts apart; null and empty texts are alike."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def in_row(docs: DataFrame, *extra: Column) -> DataFrame:
    """``row`` (all columns of ``docs``, so that no name can clash) and ``extra``."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *extra)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def byte_words(texts: pa.Array, kept: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The maximal runs of kept bytes of each UTF-8 text, with A-Z lower-cased, and how many each text has. Null texts have none.

    ``kept``: 256 booleans. A set that has all bytes from 0x80 on never cuts a character, so byte runs are the matches of
    a character class.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    ends = offsets[1:] - offsets[0] if len(texts) else np.zeros(0, np.int64)
    mask = kept[raw]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    cut = ends[:-1][ends[:-1] < len(raw)]
    first[cut] = mask[cut]  # a text begins a run of its own
    starts = np.flatnonzero(first)
    data = LOWERED[raw[mask]]
    places = np.append(np.flatnonzero(first[mask]), len(data))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)])
    return words, np.diff(np.searchsorted(starts, np.append(0, ends)))


def raw_values(strings: pa.Array) -> tuple[bytes, list[int]]:
    """The bytes of a large binary array without nulls, and where each value begins in them and the last one ends."""
    if not len(strings):
        return b"", [0]
    ends = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return strings.buffers()[2].to_pybytes() if strings.buffers()[2] is not None else b"", ends.tolist()


LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
#: Bytes that the classes of words keep: letters of ASCII and all beyond it; the second with digits.
LETTERS = np.array([chr(i).isascii() and chr(i).isalpha() or i >= 0x80 for i in range(256)])
ALNUM = LETTERS | np.array([48 <= i < 58 for i in range(256)])
