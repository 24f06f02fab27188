"""Paged web services as Spark data sources.

A reader is planned per page where the number of pages is known, and follows cursors in one partition where it is
not. How a page is fetched is an option: ``folder`` reads recorded answers (``<md5 of the address>.json``), ``url`` asks
the service, with retries; rows are ``key, page, payload``, and payloads are parsed natively afterwards. Credentials
come from the environment of the worker and are part of no plan and no cache key.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def load_env(path: str = ".env") -> dict[str, str]:
    """``KEY=value`` lines of a file, without overriding what is set."""
    found = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                key, sep, value = line.strip().partition("=")
                if sep and not key.startswith("#"):
                    found[key.strip()] = value.strip().strip("'\"")
    for key, value in found.items():
        os.environ.setdefault(key, value)
    return found


def require_env(name: str) -> str:
    value = os.environ.get(name, "").strip()
    if not value:
        raise RuntimeError(f"{name} is not set")
    return value


def address_key(address: str) -> str:
    """Cache key of an address, without its credentials."""
    head, _, query = address.partition("?")
    kept = [p for p in query.split("&") if p and p.partition("=")[0].lower() not in ("token", "key", "api_key", "access_token", "secret")]
    return hashlib.md5((head + ("?" + "&".join(kept) if kept else "")).encode()).hexdigest()


def fetch(address: str, folder: str | None = None, retries: int = 3, pause: float = 1.1, opener=urllib.request.urlopen) -> dict | None:
    """The JSON object at an address: recorded, or asked for. Missing (404) and refused (400) pages are None."""
    if folder is not None:
        path = os.path.join(folder, address_key(address) + ".json")
        if not os.path.exists(path):
            return None
        try:
            with open(path, encoding="utf-8") as handle:
                found = json.load(handle)
        except ValueError:
            return None
        return found if isinstance(found, dict) else None
    for attempt in range(retries + 1):
        try:
            with opener(address) as answer:
                return json.load(answer)
        except urllib.error.HTTPError as error:
            if error.code in (400, 404):
                return None
            if error.code not in (429, 500, 502, 503) or attempt == retries:
                raise
            time.sleep(pause * 2**attempt)
    return None


class _Part(InputPartition):
    def __init__(self, key: str, page: int):
        super().__init__((key, page))
        self.key, self.page = key, page


class PagedSource(DataSource):
    """Format ``catloom_pages``.

    Options: ``keys`` (comma list of what is paged), ``address`` with ``{key}``, ``{page}`` and ``{offset}``; the paging
    rule ``mode``: ``count`` (pages as the payload's ``total_path`` says, counted ``in`` pages or items), ``cursor``
    (``next_path`` names the next address) or ``until_empty`` (``items_path`` comes back empty); ``page_size``,
    ``max_pages``; ``folder`` for recorded answers.
    """

    @classmethod
    def name(cls) -> str:
        return "catloom_pages"

    def schema(self) -> str:
        return "key string, page int, payload string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


def at_path(payload: dict | None, path: str):
    for step in filter(None, path.split(".")):
        payload = payload.get(step) if isinstance(payload, dict) else None
    return payload


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)
        self.mode = self.options.get("mode", "count")
        self.size = int(self.options.get("page_size", "100"))
        self.limit = int(self.options.get("max_pages", "1000000"))

    def _get(self, address: str) -> dict | None:
        return fetch(address, self.options.get("folder"))

    def _address(self, key: str, page: int) -> str:
        return self.options["address"].format(key=key, page=page, offset=(page - 1) * self.size)

    def partitions(self) -> list[InputPartition]:
        parts = []
        for key in filter(None, (k.strip() for k in self.options["keys"].split(","))):
            pages = 1
            if self.mode == "count":
                total = at_path(self._get(self._address(key, 1)), self.options["total_path"]) or 1
                pages = int(total) if self.options.get("in", "pages") == "pages" else -(-int(total) // self.size)
            parts += [_Part(key, p) for p in range(1, min(max(1, pages), self.limit) + 1)]
        return parts

    def read(self, partition: _Part) -> Iterator[tuple]:
        if self.mode == "count":
            payload = self._get(self._address(partition.key, partition.page))
            if payload is not None:
                yield partition.key, partition.page, json.dumps(payload)
            return
        address, page = self._address(partition.key, 1), 1
        while address and page <= self.limit:
            payload = self._get(address)
            if payload is None or (self.mode == "until_empty" and not at_path(payload, self.options["items_path"])):
                return
            yield partition.key, page, json.dumps(payload)
            page += 1
            address = at_path(payload, self.options.get("next_path", "next")) if self.mode == "cursor" else self._address(partition.key, page)


def pages(spark: SparkSession, **options):
    """``key, page, payload`` of a paged service."""
    spark.dataSource.register(PagedSource)
    reader = spark.read.format("catloom_pages")
    for name, value in options.items():
        reader = reader.option("in" if name == "counted_in" else name, str(value))
    return reader.load()
