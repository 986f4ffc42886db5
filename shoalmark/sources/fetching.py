"""Fetching pages through a cache: serial for each host, hosts side by side, with back-off and a memory of what is gone.

The transport, a function (url, data) -> (status, final url, body), is handed in: the engine has no network of its own.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from hashlib import sha1
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Transport = Callable[[str, "str | None"], "tuple[int, str, str | None]"]
#: Answers that say a page is gone for good, and those after which one waits and asks again.
GONE, BUSY = (404, 410), (429, 500, 502, 503, 504)


def cache_key(url: Column, data: Column | None = None) -> Column:
    """The name of a page in the cache: a hash of its URL and of what is posted to it."""
    return F.sha1(F.concat(url, F.coalesce(data, F.lit(""))) if data is not None else url)


class Fetcher:
    """One host's pages, one after the other, through a folder that all who fetch share."""

    def __init__(self, folder: str, transport: Transport, interval: float = 1.0, retries: int = 5, wait: Callable[[float], None] = time.sleep, same_host: bool = False):
        self.folder, self.transport, self.interval, self.retries, self.wait, self.same_host = folder, transport, interval, retries, wait, same_host
        self.asked = False

    def get(self, url: str, data: str | None = None) -> dict:
        """{url, final, status, html}; what is cached isn't asked for again, nor what is known to be gone.

        A busy host is asked again after twice the time, at most `retries` times; what it then still refuses isn't cached, so
        that a later run tries once more.  same_host: a redirect to another host counts as gone.
        """
        at = os.path.join(self.folder, sha1((url + (data or "")).encode()).hexdigest())
        if os.path.exists(at + ".gone"):
            return {"url": url, "final": url, "status": "gone", "html": None}
        if os.path.exists(at + ".json"):
            with open(at + ".json", encoding="utf-8") as f:
                return json.load(f)
        pause = self.interval
        for _ in range(self.retries + 1):
            if self.asked:
                self.wait(pause)
            self.asked = True
            status, final, body = self.transport(url, data)
            if status not in BUSY:
                break
            pause *= 2
        page = {"url": url, "final": final, "status": str(status), "html": body if status == 200 else None}
        if status in GONE or (self.same_host and urlsplit(final).netloc != urlsplit(url).netloc):
            self._put(at + ".gone", "")
            return page | {"status": "gone", "html": None}
        if status not in BUSY:
            self._put(at + ".json", json.dumps(page, ensure_ascii=False))
        return page

    def _put(self, path: str, text: str) -> None:
        with open(f"{path}.{os.getpid()}.tmp", "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(f"{path}.{os.getpid()}.tmp", path)


def fetched(urls: DataFrame, fetcher: Callable[[], Fetcher], url_col: str = "url") -> DataFrame:
    """(url, final, status, html) of the URLs: a host's are asked for in one task, one after the other, hosts side by side."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_host: dict[str, Fetcher] = {}
        for part in parts:
            yield pd.DataFrame([by_host.setdefault(urlsplit(u).netloc, fetcher()).get(u) for u in part["url"]], columns=["url", "final", "status", "html"])

    rows = urls.select(F.col(url_col).alias("url")).distinct().withColumn("_host", F.parse_url("url", F.lit("HOST")))
    return rows.repartition("_host").sortWithinPartitions("_host", "url").select("url").mapInPandas(run, "url string, final string, status string, html string")
