"""WARC archives with a two-level capture index.

Writing: each task writes one archive (WARC/1.1, a gzip member a record) to a shared folder; a retried task writes another
file, and only the files of tasks that ended well are in the index. Of records with equal payloads (SHA-1, SHA-256 and length), the one with the
largest ``page_id`` is a response; the others are revisits that refer to it. The largest ids are found by partial
aggregation, so a payload that a third of all pages share isn't gathered anywhere; payloads move by row, not by digest.

Indexing: captures are dealt out by ranges of (reversed-host URL key, page_id) and sorted; each task writes an index file
of compressed blocks of ``LINES`` captures. The directory has one row a block: first key, file, offset, length. Its files
are listed with their first keys in a small table, the top.

Looking up: wanted captures are sorted the same way; each task reads the top once and of the directory the files that
span its batch, finds blocks by binary search, unpacks each block once, and reads the byte range of each record.

Null html counts as empty. A null url has an empty key. Rows with equal ``page_id`` and payload are responses alike if
that id is the largest; every row is a record of its own. A null ``page_id`` is never referred to and never a response
if another row has its payload. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, is_small, materialize, new_file, opened

#: Captures in a block of the index.
LINES = 3000
#: Payloads of fewer bytes are always responses.
LEAST = 0
#: Pages of a batch in Python: bounds memory with large payloads.
BATCH = 200
#: Captures that a task looks up.
LOOKUPS = 8192
END = b"\r\n"


def surt(url: str | None) -> str:
    """The key of a URL: host labels reversed and joined by commas, ``)``, then path and query; scheme, ``www.``, port and fragment don't count."""
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#]*)(?::\d*)?([^#]*)", url or "")
    host = re.sub(r"^www\d*\.", "", m[1].lower()).strip(".")
    return ",".join(reversed(host.split("."))) + ")" + (m[2].strip().lower() or "/") if m[1] else m[2].strip().lower()


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header(fields: dict[str, object]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items()) + END


def urn(page_id: object, row: object) -> str:
    return f"<urn:page:{page_id}:{row}>"


def clean(url: str | None) -> str:
    """A URL as a header's value: control characters would end it."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def write_record(row: dict, date: str) -> bytes:
    """One record. A revisit keeps the HTTP header, whose Content-Length tells the payload's size, and no payload."""
    payload = row["payload"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = row["refers_to"] is not None
    block = http if revisit else http + payload
    fields = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": urn(row["page_id"], row["rid"]), "WARC-Date": date, "WARC-Target-URI": clean(row["url"])}
    if revisit:
        fields |= {"WARC-Refers-To": urn(row["refers_to"], row["refers_rid"]), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    fields |= {"WARC-Payload-Digest": "sha1:" + row["digest"], "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    z = zlib.compressobj(wbits=31)
    return z.compress(header(fields) + END.join([block, b"", b""])) + z.flush()


def page_of(name: str) -> int | None:
    found = name.split(":")[2]
    return None if found == "None" else int(found)


def read_record(raw: bytes) -> dict:
    """A record's fields, and its payload if it holds one. A payload that doesn't match its digest is an error."""
    data = zlib.decompress(raw, wbits=31)
    head, _, rest = data.partition(END + END)
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(END + END)
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload doesn't match its digest")
    refers = fields.get("WARC-Refers-To")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": page_of(refers) if refers else None, "payload": payload if kind == "response" else None,
    }


def archive(folder: str, date: str):
    """(rid, page_id, url, payload, digest, refers_to) to a line of the index for each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        for big in batches:
            for start in range(0, big.num_rows, BATCH):
                if out is None:
                    out, name = new_file(folder, "archive")
                lines = []
                for row in big.slice(start, BATCH).to_pylist():
                    raw = write_record(row | {"payload": row["payload"] or b""}, date)
                    out.write(raw)
                    lines.append((surt(row["url"]), row["page_id"], row["rid"], name, at, len(raw)))
                    at += len(raw)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["key", "page_id", "rid", "file", "at", "bytes"])
        if out is not None:
            out.close()

    return run


def index_blocks(folder: str, lines: int):
    """Sorted captures to compressed blocks in an index file; a row of the directory for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at, held = None, "", 0, []

        def block(rows):
            nonlocal out, name, at
            if out is None:
                out, name = new_file(folder, "index")
            raw = zlib.compress("\n".join(json.dumps(r) for r in rows).encode())
            out.write(raw)
            at += len(raw)
            return pa.RecordBatch.from_pylist([{"key": rows[0][0], "rid": rows[0][1], "file": name, "at": at - len(raw), "bytes": len(raw), "captures": len(rows)}])

        for b in batches:
            held += zip(*(b.column(c).to_pylist() for c in ("key", "rid", "file", "at", "bytes")))
            while len(held) >= lines:
                yield block(held[:lines])
                held = held[lines:]
        if held:
            yield block(held)
        if out is not None:
            out.close()

    return run


class Archives:
    """What ``write_archives`` leaves: the folders of archives and index files, and the paths of the block directory and of its top."""

    def __init__(self, folder: str, directory: str, top: str):
        self.folder, self.directory, self.top = folder, directory, top


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """rid, page_id, url, payload, digest (base32 SHA-1) and refers_to of each page."""
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.unhex(F.sha1("payload")), "same": F.unhex(F.concat(F.sha1("payload"), F.sha2("payload", 256), F.lpad(F.hex(F.length("payload").cast("long")), 16, "0")))})
    rows = materialize(rows, "pages")
    groups = rows.where(F.length("payload") >= least).groupBy("same").agg(F.max(F.struct("page_id", "rid")).alias("top"), F.count("*").alias("n"))
    groups = groups.where("n > 1 and top.page_id is not null").select("same", "top")
    groups = materialize(groups, "equal-payloads")
    if is_small(groups):
        found = rows.join(F.broadcast(groups), "same", "left")
    else:  # narrow rows meet by payload, payloads by row
        found = rows.drop("same").join(rows.select("rid", "same").join(groups, "same").select("rid", "top"), "rid", "left")
    other = ~F.col("page_id").eqNullSafe(F.col("top.page_id"))
    refers = (F.when(other, F.col(f"top.{c}")).alias(name) for c, name in (("page_id", "refers_to"), ("rid", "refers_rid")))
    return found.select("rid", "page_id", "url", "payload", "sha1", *refers)


def write_archives(pages: DataFrame, least: int = LEAST, lines: int = LINES, date: str = "2024-01-01T00:00:00Z") -> Archives:
    """Write a record for every page, and the two-level index of them."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    rows = with_revisits(pages, least)

    def encode(batches):
        for b in batches:
            digests = pa.array([base64.b32encode(d).decode() for d in b.column("sha1").to_pylist()], pa.string())
            yield b.set_column(b.schema.get_field_index("sha1"), "digest", digests)

    def run(batches):
        return archive(f"{folder}/archives", date)(encode(batches))

    captures = materialize(rows.mapInArrow(run, "key string, page_id bigint, rid bigint, file string, at bigint, bytes bigint"), "captures")
    ordered = captures.repartitionByRange("key", "rid").sortWithinPartitions("key", "rid")
    directory = ordered.mapInArrow(index_blocks(f"{folder}/index", lines), "key string, rid bigint, file string, at bigint, bytes bigint, captures bigint")
    path = fresh_path(spark, "directory")
    directory.write.parquet(path)  # a file for each task, in order
    top = fresh_path(spark, "top")
    spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.min(F.struct("key", "rid")).alias("first")).select("first.key", "first.rid", "name").coalesce(1).write.parquet(top)
    return Archives(folder, path, top)


class Reader:
    """Reads of one task: byte ranges of files that stay open, and the last blocks of the index."""

    def __init__(self, archives: Archives):
        self.archives, self.files, self.block = archives, {}, (None, [], [])
        self.top, self.held = None, (None, [])

    def range(self, kind: str, name: str, at: int, size: int) -> bytes:
        if name not in self.files:
            if len(self.files) >= 64:
                self.files.pop(next(iter(self.files))).close()
            fs, path = opened(f"{self.archives.folder}/{kind}")
            self.files[name] = fs.open_input_file(f"{path}/{name}")
        return self.files[name].read_at(size, at)

    def rows(self, path: str, names: list[str] | None, columns: list[str]) -> list[tuple]:
        """Sorted rows of a Parquet folder, or of some of its files."""
        fs, at = opened(path)
        if names is None:
            names = [f.base_name for f in fs.get_file_info(pyarrow.fs.FileSelector(at)) if f.base_name.endswith(".parquet")]
        out = []
        for name in names:
            with fs.open_input_file(f"{at}/{name}") as source:
                out += zip(*(c.to_pylist() for c in pq.read_table(source, columns=columns).columns))
        return sorted(out)

    def directory(self, low: str, high: str) -> list[tuple]:
        """The directory's rows of the files that can hold keys from ``low`` to ``high``; the ranges of files don't overlap."""
        if self.top is None:
            self.top = self.rows(self.archives.top, None, ["key", "rid", "name"])
        first = max(0, bisect.bisect_left(self.top, (low,)) - 1)
        names = [name for key, _, name in self.top[first:] if key <= high]
        if self.held[0] != names:
            self.held = (names, self.rows(self.archives.directory, names, ["key", "rid", "file", "at", "bytes"]))
        return self.held[1]

    def captures(self, entry: tuple) -> tuple[list, list]:
        if self.block[0] != entry[2:4]:
            lines = [json.loads(x) for x in zlib.decompress(self.range("index", *entry[2:])).decode().split("\n")]
            self.block = (entry[2:4], lines, [(x[0], x[1]) for x in lines])
        return self.block[1:]


FOUND = "rid bigint, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def find(archives: Archives, payloads: bool):
    """Wanted captures (key, rid), sorted, to their records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(archives)
        for big in batches:
            if not big.num_rows:
                continue
            keys = big.column("key")
            entries = reader.directory(pc.min(keys).as_py(), pc.max(keys).as_py())
            firsts = [e[:2] for e in entries]
            for start in range(0, big.num_rows, BATCH):
                out = []
                for key, rid in zip(*(big.slice(start, BATCH).column(c).to_pylist() for c in ("key", "rid"))):
                    at = bisect.bisect_right(firsts, (key, rid)) - 1
                    if at < 0:
                        continue
                    lines, own = reader.captures(entries[at])
                    i = bisect.bisect_left(own, (key, rid))
                    if i < len(own) and own[i] == (key, rid):
                        record = read_record(reader.range("archives", *lines[i][2:]))
                        out.append({"rid": rid} | record | ({} if payloads else {"payload": None}))
                schema = pa.schema([("rid", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
                yield pa.RecordBatch.from_pylist(out, schema)

    return run


def look_up(wanted: DataFrame, archives: Archives, payloads: bool = False) -> DataFrame:
    """``wanted``: key (see ``surt``) and rid of captures. Their records, read through the index; captures it lacks give no row."""
    rows = materialize(wanted.select("key", "rid"), "wanted")
    rows = rows.repartitionByRange(-(-rows.count() // LOOKUPS) or 1, "key", "rid").sortWithinPartitions("key", "rid")
    return rows.mapInArrow(find(archives, payloads), FOUND)


def captured(spark: SparkSession, archives: Archives) -> DataFrame:
    """All captures of the index: key and rid."""

    def run(batches):
        reader = Reader(archives)
        for b in batches:
            for name, at, size in zip(*(b.column(c).to_pylist() for c in ("file", "at", "bytes"))):
                lines = reader.captures((None, None, name, at, size))[0]
                yield pa.RecordBatch.from_pylist([{"key": x[0], "rid": x[1]} for x in lines])

    return spark.read.parquet(archives.directory).select("file", "at", "bytes").mapInArrow(run, "key string, rid bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return look_up(captured(spark, archives), archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t FROM pages
), h AS (
  SELECT page_id, t, sha1(t) AS x, max(page_id) OVER (PARTITION BY t) AS top FROM p
)
SELECT page_id, strlen(t) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((('0x' || substr(x, CAST(1 + (i // 4) * 5 AS INTEGER), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM h
"""
