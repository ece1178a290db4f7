"""A Spark data source for a network registry's JSON pages: networks by offset, organisations by chunks of ids.

``spark.read.format("registry").option("base", url).option("what", "net").load()``. The registry allows few requests, so
one task asks for page after page, waits between requests, and tries again when it is turned away. A base of ``file:``
or a plain path reads pages from files, as tests do.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Limits of the registry: seconds between requests, rows a page, ids a request, tries, seconds a request may take.
INTERVAL, PAGE, CHUNK, TRIES, TIMEOUT = 3.1, 250, 100, 12, 120

SCHEMAS = {"net": "id bigint, org_id bigint, asn bigint, website string", "org": "id bigint, name string, website string"}


def wait_after(attempt: int, retry_after: str | None) -> float:
    """Seconds to wait after a refusal: what the answer asks for, else 2, 4, ... 64."""
    return float(retry_after) if retry_after and retry_after.strip().isdigit() else float(2 ** min(attempt, 6))


def get(url: str, sleep=time.sleep, interval: float = INTERVAL) -> dict:
    """One answer as JSON. 429 and 5xx are tried again."""
    for attempt in range(1, TRIES + 1):
        sleep(interval)
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "pathlight"}), timeout=TIMEOUT) as r:
                return json.load(r)
        except urllib.error.HTTPError as e:
            if attempt == TRIES or e.code != 429 and e.code < 500:
                raise
            sleep(wait_after(attempt, e.headers.get("Retry-After")))
    raise AssertionError


class Pages(DataSourceReader):
    def __init__(self, options: dict):
        self.base, self.what = options["base"].rstrip("/"), options.get("what", "net")
        self.page, self.most = int(options.get("page", PAGE)), options.get("max_pages")
        self.ids = [int(i) for i in options.get("ids", "").split(",") if i]
        self.interval = float(options.get("interval", INTERVAL))

    def partitions(self):
        return [InputPartition(0)]

    def fetch(self, name: str, query: str) -> list[dict]:
        if self.base.startswith(("http:", "https:")):
            return get(f"{self.base}/{self.what}?{query}", interval=self.interval)["data"]
        path = Path(self.base.removeprefix("file://").removeprefix("file:")) / f"{name}.json"
        return json.loads(path.read_text())["data"] if path.exists() else []

    def read(self, partition):
        names = [f.split()[0] for f in SCHEMAS[self.what].split(", ")]
        if self.what == "org":
            pages = (self.fetch(f"org-{i // CHUNK}", "id__in=" + ",".join(map(str, self.ids[i : i + CHUNK]))) for i in range(0, len(self.ids), CHUNK))
        else:
            pages = self.nets()
        for page in pages:
            for row in page:
                yield tuple(row.get(n) for n in names)

    def nets(self):
        """Pages until one is short or the cap is reached."""
        at = 0
        while self.most is None or at < int(self.most):
            page = self.fetch(f"net-{at}", f"limit={self.page}&skip={at * self.page}")
            yield page
            at += 1
            if len(page) < self.page:
                return


class RegistrySource(DataSource):
    @classmethod
    def name(cls):
        return "registry"

    def schema(self):
        return SCHEMAS[self.options.get("what", "net")]

    def reader(self, schema):
        return Pages(dict(self.options))
