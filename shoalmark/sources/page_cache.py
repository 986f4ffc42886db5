"""A data source over cached pages: spark.read.format("page_cache").option("path", folder).load().

Each file of the folder is one response as JSON: url, final, status, html.  A host is one partition; it is the beginning of
a file named host__name.json, else in the first characters of the file, so that no page is read whole to plan the scan.  The
folder is listed where the readers run, so it has to be one that all of them mount.  sources/fetching.py fills it.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


#: Characters of a file in which its URL stands.
HEAD = 4096
_URL = re.compile(r'"url":\s*"([^"]*)"')


class _Host(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(0)
        self.files = files


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def _load(self, file: str) -> dict | None:
        try:
            with open(os.path.join(self.path, file), encoding="utf-8") as f:
                return json.load(f)
        except (OSError, ValueError):
            return None

    def partitions(self) -> list[InputPartition]:
        hosts: dict[str, list[str]] = {}
        for file in sorted(os.listdir(self.path)):
            if file.endswith(".json"):
                hosts.setdefault(self._host(file), []).append(file)
        return [_Host(files) for files in hosts.values()] or [_Host([])]

    def _host(self, file: str) -> str:
        """The host that a file's name begins with, else the one of the URL at the head of the file, of which no more is read."""
        host, mark, _ = file.partition("__")
        if mark:
            return host
        try:
            with open(os.path.join(self.path, file), encoding="utf-8", errors="replace") as f:
                url = _URL.search(f.read(HEAD))
        except OSError:
            return ""
        return urlsplit(url[1]).netloc if url else ""

    def read(self, partition: _Host) -> Iterator[tuple]:
        for file in partition.files:
            if page := self._load(file):
                yield page.get("url"), page.get("final"), page.get("status"), page.get("html")


class PageCache(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_cache"

    def schema(self) -> str:
        return "url string, final string, status string, html string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageCache)
