"""Pages over HTTP as a data source: spark.read.format("crawl") and readStream.

    spark.dataSource.register(CrawlSource)
    spark.read.format("crawl").option("transport", "mine:client").option("urls", json.dumps([...])).load()

`transport` names a function, module:function, that makes a client in each task: a
callable (url, timeout) -> (status, headers, body), which raises for what is no
response.  No network is used here by itself.

A partition is one host, so that what a host asks for (a pause between requests, 429
with Retry-After) holds back no other; requests of a host follow one another, at
least `pause` seconds apart.  429, 5xx and failures of the connection are tried again
inside the reader, `retries` times, after the delays of `control.retry_delay` (a
longer Retry-After wins); what then still fails is a row with its error, so a
batch always has a row for each URL.

As a stream, `feed` names a function that makes a list of URLs by place, an object
with `size()` and `urls(start, stop)`; an offset is a place in it, so that a restarted
query goes on where the last committed batch ended.  `most` bounds a batch.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from loomline.streaming.control import Retry, retry_delay

SCHEMA = "url string, host string, status int, content string, error string, attempts int, seconds double"


class HostPartition(InputPartition):
    def __init__(self, host: str, urls: list[str]):
        self.host, self.urls = host, urls


def named(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def by_host(urls: list[str]) -> list[HostPartition]:
    hosts: dict[str, list[str]] = {}
    for url in urls:
        hosts.setdefault(urlsplit(url).netloc, []).append(url)
    return [HostPartition(host, mine) for host, mine in hosts.items()]


def _wanted(headers: dict) -> float:
    """Seconds that Retry-After asks for; 0 for none or a date."""
    value = next((v for k, v in (headers or {}).items() if k.lower() == "retry-after"), "0")
    try:
        return max(0.0, float(value))
    except ValueError:
        return 0.0


class Fetcher:
    """Fetches one URL after another, with retries and pauses."""

    def __init__(self, options: dict):
        self.policy = Retry(max_retries=int(options.get("retries", 3)), base=float(options.get("base", 1.0)))
        self.timeout, self.pause, self.longest = float(options.get("timeout", 30)), float(options.get("pause", 0)), float(options.get("longest", 300))
        self.client = named(options["transport"])()
        self.sleep = named(options["sleep"]) if "sleep" in options else time.sleep

    def one(self, url: str) -> tuple:
        host, began, status, error, attempt = urlsplit(url).netloc, time.monotonic(), None, None, 0
        while True:
            wanted, reason = 0.0, None
            try:
                status, headers, body = self.client(url, self.timeout)
                if status < 400:
                    return url, host, status, body, None, attempt + 1, time.monotonic() - began
                error, wanted = f"HTTP {status}", _wanted(headers)
                reason = "rate_limited" if status == 429 else "server_error" if status >= 500 else None
            except TimeoutError as problem:
                status, error, reason = None, str(problem) or "timeout", "timeout"
            except OSError as problem:
                status, error, reason = None, str(problem) or type(problem).__name__, "network_error"
            except Exception as problem:  # noqa: BLE001 - recorded with the URL
                status, error = None, str(problem) or type(problem).__name__
            if reason is None or attempt >= self.policy.max_retries:
                return url, host, status, None, error, attempt + 1, time.monotonic() - began
            self.sleep(min(self.longest, max(wanted, retry_delay(attempt, reason, self.policy))))
            attempt += 1

    def all(self, urls: list[str]) -> Iterator[tuple]:
        for i, url in enumerate(urls):
            if i and self.pause:
                self.sleep(self.pause)
            yield self.one(url)


class CrawlReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[HostPartition]:
        return by_host(json.loads(self.options["urls"]))

    def read(self, partition: HostPartition) -> Iterator[tuple]:
        if partition is not None:  # None: there are no URLs
            yield from Fetcher(self.options).all(partition.urls)


class CrawlStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.most = int(self.options.get("most", 1000))
        self.feed = named(self.options["feed"])()
        self.at = 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"next": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self.at = min(self.feed.size(), self.at + self.most)
        return {"next": self.at}

    def partitions(self, start: dict, end: dict) -> list[HostPartition]:
        self.at = max(self.at, end["next"])  # after a restart, go on from what was planned
        return by_host(self.feed.urls(start["next"], end["next"]))

    def commit(self, end: dict) -> None:
        """Nothing: the feed keeps its URLs, their places are in the checkpoint."""

    def read(self, partition: HostPartition) -> Iterator[tuple]:
        return Fetcher(self.options).all(partition.urls)


class CrawlSource(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return "crawl"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CrawlReader:
        return CrawlReader(self.options)

    def streamReader(self, schema) -> CrawlStreamReader:  # noqa: N802
        return CrawlStreamReader(self.options)
