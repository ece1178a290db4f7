"""A Spark data source for MRT routing dumps (RFC 6396) and the BGP messages in them (RFC 4271, RFC 6793).

``spark.dataSource.register(MrtSource); spark.read.format("mrt").load(path)`` gives a row for each announced or withdrawn
prefix: ``schemas.ELEMENT`` and ``file``. A file is one partition, as a compressed dump can't be split; rows leave it in
Arrow batches. Paths are local files, ``file:`` and what ``pyarrow.fs`` opens; ``.gz`` and ``.bz2`` are unpacked.

What isn't asked for isn't decoded: ``load(spark, path)`` pushes filters on ``elem_type`` and ``peer_asn`` down to the
records (Spark wants a setting and the option ``pushdown`` for it), the option ``elem_type`` (A or W) does the same
without, and a schema without ``as_path`` and ``origin_asns`` (``.schema(...)``) leaves paths undecoded.

``seq`` is (number of the file << 40) + the row's place in it, whatever is filtered, so that files in order of name give the
order of writes. ``paths`` (a JSON list) instead of a path gives the files and their order. Records that hold routes in a
form that isn't read here (the old table dump, generic and multicast tables, additional paths) fail the load, unless
``skip_unknown`` is set.

An AS_SET makes a path empty: it has no single next hop; the origin then comes from the set's members if there is one.

As a stream (``spark.readStream.format("mrt")``), a folder's files are read once each, in order of name: new ones must sort
behind those that were there, and old ones stay while the stream is to go on. An offset is the last name that was read.
"""

from __future__ import annotations

import bz2
import gzip
import ipaddress
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..schemas import ELEMENT

TABLE_DUMP_V2, BGP4MP, BGP4MP_ET = 13, 16, 17
PEER_INDEX, RIB_V4, RIB_V6 = 1, 2, 4
MESSAGE, MESSAGE_AS4, MESSAGE_LOCAL, MESSAGE_AS4_LOCAL = 1, 4, 6, 7
AS_SEQUENCE, AS_SET = 2, 1
ORIGIN_PATH, MP_REACH, MP_UNREACH, AS4_PATH = 2, 14, 15, 17


def prefixes(data: bytes, family: int) -> Iterator[str]:
    at = 0
    while at < len(data):
        bits = data[at]
        size = (bits + 7) // 8
        yield prefix_text(data[at + 1 : at + 1 + size], bits, family)
        at += 1 + size


def prefix_text(raw: bytes, bits: int, family: int) -> str:
    full = raw.ljust(4 if family == 1 else 16, b"\0")
    kind = ipaddress.IPv4Network if family == 1 else ipaddress.IPv6Network
    return str(kind((full, bits), strict=False))


def as_path(data: bytes, size: int) -> tuple[list[int], list[int]]:
    """The path, empty if it has a set, and its origins."""
    path, last, flat, at = [], [], True, 0
    while at + 2 <= len(data):
        kind, n = data[at], data[at + 1]
        hops = list(struct.unpack_from(f">{n}{'I' if size == 4 else 'H'}", data, at + 2))
        at += 2 + n * size
        if kind == AS_SEQUENCE:
            path += hops
            last = hops[-1:] or last
        elif kind == AS_SET:
            flat, last = False, hops
    return (path if flat else []), last


def attributes(data: bytes, size: int, in_rib: bool = False, paths: bool = True) -> dict:
    """path, origins (unless ``paths`` is false), announced and withdrawn v6 prefixes of a message's attributes."""
    out: dict = {"path": [], "origins": [], "reach": [], "unreach": []}
    at, four = 0, None
    while at + 3 <= len(data):
        flags, kind = data[at], data[at + 1]
        n, at = (struct.unpack_from(">H", data, at + 2)[0], at + 4) if flags & 0x10 else (data[at + 2], at + 3)
        value, at = data[at : at + n], at + n
        if kind == ORIGIN_PATH and paths:
            out["path"], out["origins"] = as_path(value, size)
        elif kind == AS4_PATH and size == 2 and paths:
            four = as_path(value, 4)
        elif kind == MP_REACH and not in_rib:
            family, hop = struct.unpack_from(">H", value)[0], value[3]
            out["reach"] = list(prefixes(value[5 + hop :], family))
        elif kind == MP_UNREACH and not in_rib:
            out["unreach"] = list(prefixes(value[3:], struct.unpack_from(">H", value)[0]))
    if four and len(four[0]) <= len(out["path"]):
        out["path"] = out["path"][: len(out["path"]) - len(four[0])] + four[0]
        out["origins"] = four[1] or out["origins"]
    return out


#: Kinds of records with routes that aren't read: (type, subtypes; none: all).
UNREAD = {12: (), TABLE_DUMP_V2: (3, 5, 6, 8, 9, 10, 11, 12), BGP4MP: (8, 9, 10, 11)}


@dataclass
class Wanted:
    """What is decoded: kinds of elements and peers (None: all), and whether paths are."""

    kinds: frozenset[str] | None = None
    peers: frozenset[int] | None = None
    paths: bool = True

    def takes(self, kind: str, peer: int) -> bool:
        return (self.kinds is None or kind in self.kinds) and (self.peers is None or peer in self.peers)


def elements(data, skip_unknown: bool = False, wanted: Wanted | None = None) -> Iterator[tuple]:
    """(place, ts, elem_type, prefix, peer_asn, as_path, origin_asns) of a stream of MRT records. Places count what isn't wanted as well."""
    wanted = wanted or Wanted()
    peers: list[int] = []
    place = 0
    while len(head := data.read(12)) == 12:
        seconds, kind, sub, size = struct.unpack(">IHHI", head)
        body, ts = data.read(size), float(seconds)
        if kind == BGP4MP_ET:
            ts += struct.unpack_from(">I", body)[0] / 1e6
            kind, body = BGP4MP, body[4:]
        if kind == TABLE_DUMP_V2 and sub == PEER_INDEX:
            peers = list(peer_index(body))
        elif kind == TABLE_DUMP_V2 and sub in (RIB_V4, RIB_V6):
            bits, prefix = body[4], None
            n = (bits + 7) // 8
            (count,), at = struct.unpack_from(">H", body, 5 + n), 7 + n
            for i in range(count):
                peer, when, length = struct.unpack_from(">HIH", body, at)
                if wanted.takes("A", peers[peer]):
                    prefix = prefix or prefix_text(body[5 : 5 + n], bits, 1 if sub == RIB_V4 else 2)
                    found = attributes(body[at + 8 : at + 8 + length], 4, True) if wanted.paths else NO_PATH
                    yield place + i, float(when), "A", prefix, peers[peer], found["path"], found["origins"]
                at += 8 + length
            place += count
        elif kind == BGP4MP and sub in (MESSAGE, MESSAGE_AS4, MESSAGE_LOCAL, MESSAGE_AS4_LOCAL):
            for own in message(body, ts, 4 if sub in (MESSAGE_AS4, MESSAGE_AS4_LOCAL) else 2, wanted.paths):
                if wanted.takes(own[1], own[3]):
                    yield place, *own
                place += 1
        elif not skip_unknown and kind in UNREAD and (not UNREAD[kind] or sub in UNREAD[kind]):
            raise ValueError(f"an MRT record of type {kind}, subtype {sub} holds routes that aren't read")


NO_PATH = {"path": [], "origins": []}


def peer_index(body: bytes) -> Iterator[int]:
    at = 6 + struct.unpack_from(">H", body, 4)[0]
    (count,), at = struct.unpack_from(">H", body, at), at + 2
    for _ in range(count):
        kind, at = body[at], at + 5 + (16 if body[at] & 1 else 4)
        yield struct.unpack_from(">I" if kind & 2 else ">H", body, at)[0]
        at += 4 if kind & 2 else 2


def message(body: bytes, ts: float, size: int, paths: bool = True) -> Iterator[tuple]:
    peer = struct.unpack_from(">I" if size == 4 else ">H", body)[0]
    family = struct.unpack_from(">H", body, 2 * size + 2)[0]
    m = body[2 * size + 4 + (8 if family == 1 else 32) :]
    if len(m) < 23 or m[18] != 2:  # only UPDATE messages hold routes
        return
    (gone,) = struct.unpack_from(">H", m, 19)
    (length,) = struct.unpack_from(">H", m, 21 + gone)
    at = 23 + gone
    found = attributes(m[at : at + length], size, paths=paths)
    for p in [*prefixes(m[21 : 21 + gone], 1), *found["unreach"]]:
        yield ts, "W", p, peer, [], []
    for p in [*prefixes(m[at + length : struct.unpack_from(">H", m, 16)[0]], 1), *found["reach"]]:
        yield ts, "A", p, peer, found["path"], found["origins"]


class File(InputPartition):
    def __init__(self, number: int, path: str):
        self.number, self.path = number, path


def filesystem(path: str):
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def names_of(folder: str) -> list[str]:
    """The files of a folder in order of name, or a single file, as paths of its file system."""
    fs, path = filesystem(folder)
    if fs.get_file_info(path).type != pyarrow.fs.FileType.Directory:
        return [path]
    return sorted(f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(path)) if f.is_file)


#: Rows of a batch.
ROWS = 8192


@dataclass
class Options:
    """What a reader needs on an executor. ``schema``: the columns that are asked for."""

    path: str
    schema: StructType
    paths: list[str] | None = None
    skip_unknown: bool = False

    def batches(self, partition: File, wanted: Wanted) -> Iterator[pa.RecordBatch]:
        own = self.paths is not None
        fs, path = filesystem(partition.path if own else self.path)
        schema = to_arrow_schema(self.schema)
        names = ["seq", "ts", "elem_type", "prefix", "peer_asn", "as_path", "origin_asns"]
        columns = [names.index(n) if n in names else None for n in schema.names]
        wanted.paths = bool({"as_path", "origin_asns"} & set(schema.names))

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cells = list(zip(*rows))
            cells[0] = [(partition.number << 40) + place for place in cells[0]]
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(rows) if c is None else cells[c], f.type) for c, f in zip(columns, schema)], schema=schema)

        with fs.open_input_stream(path if own else partition.path, compression=None) as raw:
            data = gzip.GzipFile(fileobj=raw) if partition.path.endswith(".gz") else bz2.BZ2File(raw) if partition.path.endswith(".bz2") else raw
            rows: list[tuple] = []
            for row in elements(data, self.skip_unknown, wanted):
                rows.append(row)
                if len(rows) == ROWS:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


class MrtReader(DataSourceReader):
    def __init__(self, options: Options, kind: str | None):
        self.options, self.wanted = options, Wanted(frozenset([kind]) if kind else None)

    def partitions(self):
        names = self.options.paths if self.options.paths is not None else names_of(self.options.path)
        return [File(i, n) for i, n in enumerate(names)]

    def read(self, partition: File):
        return self.options.batches(partition, self.wanted)


class PushingReader(MrtReader):
    """Takes filters on elem_type and peer_asn over, so that other records aren't decoded."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            values = frozenset([f.value]) if isinstance(f, EqualTo) else frozenset(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("elem_type",):
                self.wanted.kinds = values if self.wanted.kinds is None else self.wanted.kinds & values
            elif values is not None and f.attribute == ("peer_asn",):
                self.wanted.peers = values if self.wanted.peers is None else self.wanted.peers & values
            else:
                yield f


class MrtStreamReader(DataSourceStreamReader):
    """A folder's files, each once, in order of name."""

    def __init__(self, options: Options, kind: str | None):
        self.options, self.kind = options, kind

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        return {"after": max(names_of(self.options.path), default="")}

    def partitions(self, start: dict, end: dict):
        return [File(i, n) for i, n in enumerate(names_of(self.options.path)) if start["after"] < n <= end["after"]]

    def read(self, partition: File):
        return self.options.batches(partition, Wanted(frozenset([self.kind]) if self.kind else None))

    def commit(self, end: dict) -> None:
        pass


class MrtSource(DataSource):
    @classmethod
    def name(cls):
        return "mrt"

    def schema(self):
        return f"{ELEMENT}, file string"

    def read_options(self, schema: StructType) -> Options:
        paths = self.options.get("paths")
        return Options(self.options.get("path", ""), schema, json.loads(paths) if paths else None, self.options.get("skip_unknown", "").lower() == "true")

    def reader(self, schema):
        kind = PushingReader if self.options.get("pushdown", "").lower() == "true" else MrtReader
        return kind(self.read_options(schema), self.options.get("elem_type"))

    def streamReader(self, schema):
        return MrtStreamReader(self.read_options(schema), self.options.get("elem_type"))


def load(spark: SparkSession, path: str | None = None, columns: str | None = None, **options) -> DataFrame:
    """Messages of a file or folder, with filters pushed down. ``columns``: a schema of those that are wanted."""
    spark.dataSource.register(MrtSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    read = spark.read.format("mrt").option("pushdown", "true").options(**options)
    read = read.schema(columns) if columns else read
    return read.load(path) if path else read.load()
