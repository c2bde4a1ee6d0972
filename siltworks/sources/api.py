"""Repository discovery as a Python data source: pages of a search, of users, or single names.

With the option ``fixture`` (a directory) responses are read from JSON files instead of the network:
``search-<page>.json``, ``user-<user>-<page>.json``, ``repo-<owner>__<name>.json``, ``license-<owner>__<name>.json``; a
missing file is a 404.  Of a licence only full_name and license are filled.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.discover import API_SCHEMA

API = "https://api.github.com"
PAGE = 100


class RateLimiter:
    """A token bucket that is refilled by whole seconds; a server's count of what is left only lowers it."""

    def __init__(self, per_second: int = 5, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.most = self.tokens = per_second
        self.clock, self.sleep = clock, sleep
        self.filled = clock()

    def take(self) -> None:
        while True:
            seconds = int(self.clock() - self.filled)
            if seconds > 0:
                self.tokens, self.filled = min(self.most, self.tokens + seconds * self.most), self.clock()
            if self.tokens > 0:
                self.tokens -= 1
                return
            self.sleep(max(0.0, 1 - (self.clock() - self.filled)))

    def server_says(self, remaining: int | None) -> None:
        if remaining is not None:
            self.tokens = min(self.tokens, remaining)


@dataclass
class Answer:
    status: int
    body: object
    headers: dict


def fetch(url: str, token: str | None, timeout: float = 60) -> Answer:
    request = urllib.request.Request(url, headers={"Accept": "application/vnd.github+json"} | ({"Authorization": f"Bearer {token}"} if token else {}))
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return Answer(r.status, json.loads(r.read()), {k.lower(): v for k, v in r.headers.items()})
    except urllib.error.HTTPError as e:
        return Answer(e.code, None, {k.lower(): v for k, v in e.headers.items()})


def shared_limiter(rate: int, readers: int) -> RateLimiter:
    """One of ``readers`` limiters that together let ``rate`` requests a second pass: each has its share of the time."""
    speed = rate / readers
    return RateLimiter(1, lambda: time.monotonic() * speed, lambda s: time.sleep(s / speed))


def get(ask: Callable[[], Answer], limiter: RateLimiter, wall: Callable[[], float] = time.time, tries: int = 5, sleep: Callable[[float], None] | None = None) -> Answer:
    """Ask under the limiter; after a 403 wait until the limit's reset and a second more, then ask for the same again."""
    answer = Answer(403, None, {})
    for _ in range(tries):
        limiter.take()
        answer = ask()
        left = answer.headers.get("x-ratelimit-remaining")
        limiter.server_says(int(left) if left is not None else None)
        if answer.status != 403:
            return answer
        (sleep or limiter.sleep)(max(0.0, float(answer.headers.get("x-ratelimit-reset", wall())) - wall()) + 1)
    return answer


class _Ask:
    def __init__(self, kind: str, name: str, page: int, place: int):
        self.kind, self.name, self.page, self.place = kind, name, page, place


class _Asks(InputPartition):
    """What one reader asks for, in turn: all pages of a name are with one reader."""

    def __init__(self, asks: list[_Ask], readers: int):
        self.asks, self.readers = asks, readers


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options

    def partitions(self) -> list[InputPartition]:
        limit = int(self.o.get("limit", PAGE))
        pages = range(1, -(-limit // PAGE) + 1)
        names = [x for x in self.o.get("names", "").split(",") if x]
        kind = self.o.get("kind", "search")
        if kind == "search":
            asks = [[_Ask(kind, self.o.get("query", ""), p, p * PAGE) for p in pages]]
        elif kind == "users":
            asks = [[_Ask(kind, u, p, (i * 1000 + p) * PAGE) for p in pages] for i, u in enumerate(names)]
        else:
            asks = [[_Ask(kind, n, 1, i)] for i, n in enumerate(names)]
        readers = max(1, min(int(self.o.get("concurrency", 5)), len(asks)))
        return [_Asks([a for one in asks[k::readers] for a in one], readers) for k in range(readers)]

    def _answer(self, ask: _Ask, limiter: RateLimiter) -> Answer:
        if fixture := self.o.get("fixture"):
            name = {"search": f"search-{ask.page}", "users": f"user-{ask.name}-{ask.page}"}.get(ask.kind, f"{ask.kind[:-1]}-{ask.name.replace('/', '__')}")
            try:
                with open(f"{fixture}/{name}.json", encoding="utf-8") as f:
                    return Answer(200, json.load(f), {})
            except FileNotFoundError:
                return Answer(404, None, {})
        q = urllib.parse.quote
        url = {
            "search": f"{API}/search/repositories?q={q(ask.name)}&sort=stars&order=desc&per_page={PAGE}&page={ask.page}",
            "users": f"{API}/users/{q(ask.name)}/repos?type=owner&sort=stars&per_page={PAGE}&page={ask.page}",
            "licenses": f"{API}/repos/{q(ask.name, safe='/')}/license",
        }.get(ask.kind, f"{API}/repos/{q(ask.name, safe='/')}")
        return get(lambda: fetch(url, self.o.get("token")), limiter, sleep=time.sleep)

    def read(self, partition: _Asks) -> Iterator[tuple]:
        limiter, ended = shared_limiter(int(self.o.get("rate", 5)), partition.readers), set()
        for ask in partition.asks:
            if ask.name in ended or ask.kind in ("repos", "licenses") and len([x for x in ask.name.split("/") if x]) != 2:
                continue
            rows = self._rows(ask, limiter)
            if len(rows) < PAGE:  # a short page is the last
                ended.add(ask.name)
            for k, r in enumerate(rows):
                owner, lic = r.get("owner") or {}, r.get("license")
                yield (
                    r.get("full_name"), r.get("name"), (owner.get("login"),), r.get("stargazers_count"), r.get("language"), (lic.get("spdx_id"),) if lic else None,
                    r.get("description"), r.get("default_branch"), r.get("html_url"), r.get("fork"), ask.name, ask.place + k,
                )

    def _rows(self, ask: _Ask, limiter: RateLimiter) -> list[dict]:
        answer = self._answer(ask, limiter)
        if answer.status == 404:
            return []
        if answer.status != 200:
            raise RuntimeError(f"{ask.kind} {ask.name}, page {ask.page}: status {answer.status}")
        if ask.kind == "licenses":
            return [{"full_name": ask.name, "license": answer.body.get("license")}]
        return answer.body["items"] if ask.kind == "search" else answer.body if isinstance(answer.body, list) else [answer.body]


class RepositorySource(DataSource):
    """Options: kind (search, users, repos, licenses), query or names, limit, token, rate (of all readers), concurrency
    (readers), fixture."""

    @classmethod
    def name(cls) -> str:
        return "code_repositories"

    def schema(self) -> str:
        return API_SCHEMA + ", asked string, src_pos long"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


ARCHIVES = "https://codeload.github.com"
FETCHED = "full_name string, path string, content binary, error string"


def fetch_archives(repos: DataFrame, base: str = ARCHIVES, timeout: float = 120) -> DataFrame:
    """The default branches of repos (full_name, default_branch) as archives, a row each.

    A repository that cannot be fetched has an error in place of its content; the others are not touched by it.  base
    may be any address that urllib opens and that holds <owner>/<repo>/tar.gz/<branch>.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, branch in zip(batch.column("full_name").to_pylist(), batch.column("default_branch").to_pylist(), strict=True):
                content = error = None
                try:
                    with urllib.request.urlopen(f"{base}/{urllib.parse.quote(name)}/tar.gz/{urllib.parse.quote(branch or 'HEAD')}", timeout=timeout) as r:
                        content = r.read()
                except (OSError, ValueError) as e:
                    error = str(e)
                path = name.replace("/", "__", 1) + ".tar.gz"
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([path]), pa.array([content], pa.binary()), pa.array([error], pa.string())], names=["full_name", "path", "content", "error"])

    return repos.select("full_name", "default_branch").mapInArrow(run, FETCHED)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RepositorySource)
