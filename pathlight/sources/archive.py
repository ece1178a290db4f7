"""A Spark data source that lists archives of routing dumps: the manifest of a window, found where the files are.

``spark.read.format("archive").option("base", ...)`` gives ``manifest.SCHEMA``. Each collector and month (and kind, where it
has a folder of its own) is a partition, so that a long window of many collectors is listed in parallel, and only what the
options ``start``, ``end``, ``collectors`` and ``data_type`` leave is listed at all. ``base`` is a folder that ``pyarrow.fs``
opens, or an http(s) address whose pages link to the files. Layouts (option ``layout``):

* ``routeviews``: ``<collector>/bgpdata/YYYY.MM/RIBS/rib.YYYYMMDD.HHMM.*`` and ``.../UPDATES/updates.*``
* ``ris``: ``<collector>/YYYY.MM/bview.YYYYMMDD.HHMM.*`` and ``updates.*``

A month that isn't there has no files. Where no collectors are named, the base's folders are taken for them.
"""

from __future__ import annotations

import datetime
import re
import urllib.error
import urllib.request
from dataclasses import dataclass

import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .manifest import SCHEMA
from .mrt import filesystem

NAME = re.compile(r"^(rib|bview|updates)\.(\d{8})\.(\d{4})\.(?:gz|bz2)$")
LINK = re.compile(r"href=[\"']([^\"'?#]+)[\"']", re.IGNORECASE)
#: Minutes that a file of updates spans.
SPAN = {"routeviews": 15, "ris": 5}
TIMEOUT = 120


@dataclass
class Month(InputPartition):
    collector: str
    kind: str
    path: str


def listed(folder: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    if folder.startswith(("http://", "https://")):
        try:
            with urllib.request.urlopen(f"{folder}/", timeout=TIMEOUT) as page:
                return sorted({n.strip("/") for n in LINK.findall(page.read().decode("utf-8", "replace")) if "/" not in n.strip("/")})
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return []
            raise
    fs, path = filesystem(folder)
    return sorted(f.base_name for f in fs.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True)))


def months(start: datetime.datetime, end: datetime.datetime) -> list[str]:
    return [f"{m // 12:04d}.{m % 12 + 1:02d}" for m in range(start.year * 12 + start.month - 1, end.year * 12 + end.month)]


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.base, self.layout = options["base"].rstrip("/"), options.get("layout", "routeviews")
        self.start, self.end = (datetime.datetime.fromisoformat(options[k]).replace(tzinfo=None) for k in ("start", "end"))
        self.collectors = [c for c in options.get("collectors", "").split(",") if c]
        self.kinds = [options["data_type"]] if options.get("data_type") else ["rib", "updates"]

    def partitions(self):
        out = []
        for c in self.collectors or [n for n in listed(self.base) if "." not in n]:
            for m in months(self.start, self.end):
                if self.layout == "routeviews":
                    out += [Month(c, k, f"{self.base}/{c}/bgpdata/{m}/{'RIBS' if k == 'rib' else 'UPDATES'}") for k in self.kinds]
                else:
                    out.append(Month(c, ",".join(self.kinds), f"{self.base}/{c}/{m}"))
        return out

    def read(self, partition: Month):
        for name in listed(partition.path):
            if not (found := NAME.match(name)):
                continue
            kind = "updates" if found[1] == "updates" else "rib"
            at = datetime.datetime.strptime(found[2] + found[3], "%Y%m%d%H%M")
            if kind in partition.kind.split(",") and self.start <= at <= self.end:
                span = datetime.timedelta(minutes=SPAN[self.layout] if kind == "updates" else 0)
                yield at.replace(tzinfo=datetime.UTC), (at + span).replace(tzinfo=datetime.UTC), partition.collector, kind, f"{partition.path}/{name}"


class ArchiveSource(DataSource):
    @classmethod
    def name(cls):
        return "archive"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ArchiveReader(self.options)
