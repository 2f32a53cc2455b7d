"""A paged search API as a source: pages, keys, retries, and a Spark data source over it.

The network is a callable, so everything else can be tested and run without one:
`fetch(params, key)` and `poll(url)` return the decoded answer or raise.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Server errors that pass.
PASSING = frozenset({500, 502, 503, 504})
ATTEMPTS, BACKOFF = 3, 2.0
POLLS, POLL_DELAY = 6, 2.0


class StatusError(Exception):
    """An answer with an HTTP status other than success."""

    def __init__(self, code: int):
        super().__init__(f"HTTP status {code}")
        self.code = code


class QuotaExhausted(Exception):
    """A key has no searches left."""


class NoResults(Exception):
    """No key gave an answer."""


def with_retry(call: Callable[[], dict], attempts: int = ATTEMPTS, backoff: float = BACKOFF, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The answer of call; passing errors are tried again after a delay that grows by backoff, 429 never."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except StatusError as error:
            if error.code == 429:
                raise QuotaExhausted from error
            if error.code not in PASSING or attempt == attempts:
                raise
        except ConnectionError:
            if attempt == attempts:
                raise
        sleep(backoff * attempt)
    raise AssertionError


@dataclass
class SearchClient:
    """Collects the jobs of a search with the first key that gives any; used-up keys are remembered."""

    fetch: Callable[[dict, str], dict]
    keys: list[str]
    poll: Callable[[str], dict] | None = None
    source_name: str = "search_api"
    delay: float = 0.0
    sleep: Callable[[float], None] = time.sleep
    now: Callable[[], datetime] = lambda: datetime.now(UTC)
    exhausted: set[str] = field(default_factory=set)

    def jobs(self, search: dict) -> list[dict]:
        """Records of one search, as many as its max_jobs; a key that fails starts the search anew with the next."""
        for key in [k for k in self.keys if k not in self.exhausted]:
            found = self._with_key(search, key)
            if found is not None:
                return found
        raise NoResults(f"search {search['query_id']}: no key gave results")

    def _with_key(self, search: dict, key: str) -> list[dict] | None:
        limit, token, found, page = search["max_jobs"], None, [], 0
        while not limit or len(found) < limit:
            try:
                answer = self._answer(search, token, key)
            except QuotaExhausted:
                self.exhausted.add(key)
                return None
            if answer is None:
                return None
            results = answer.get("jobs_results") or []
            if not results:
                return found if page else None
            page += 1
            about = answer.get("search_metadata") or {}
            room = limit - len(found) if limit else None
            found += [self._record(search, about, page, job) for job in results[:room]]
            token = (answer.get("serpapi_pagination") or {}).get("next_page_token")
            if not token:
                break
            if self.delay:
                self.sleep(self.delay)
        return found

    def _answer(self, search: dict, token: str | None, key: str) -> dict | None:
        """One page; null if the API gives up on it."""
        params = {"engine": "google_jobs", "q": search["q"]} | {k: search[k] for k in ("location", "hl", "gl", "google_domain") if search.get(k)}
        if token:
            params["next_page_token"] = token
        answer = with_retry(lambda: self.fetch(params, key), sleep=self.sleep)
        for _ in range(POLLS):
            about = answer.get("search_metadata") or {}
            if about.get("status") != "Processing" or not about.get("json_endpoint") or self.poll is None:
                break
            self.sleep(POLL_DELAY)
            answer = with_retry(lambda url=about["json_endpoint"]: self.poll(url), sleep=self.sleep)
        return None if (answer.get("search_metadata") or {}).get("status") in ("Error", "Processing") else answer

    def _record(self, search: dict, about: dict, page: int, job: dict) -> dict:
        base = {k: search.get(k) for k in ("query_id", "q", "location", "hl", "gl", "google_domain")}
        return {"source_name": self.source_name} | base | {
            "fetched_at": self.now().isoformat(), "page": page, "serpapi_search_id": about.get("id"), "serpapi_json_endpoint": about.get("json_endpoint"), "job": job,
        }


class SearchSource(DataSource):
    """spark.read.format("search_api") over searches, one partition for each.

    Options: searches (JSON array of rows as active_searches gives them) and client
    (module:function that makes a SearchClient on the executor).
    """

    @classmethod
    def name(cls) -> str:
        return "search_api"

    def schema(self) -> str:
        return "query_id bigint, value string"

    def reader(self, schema: object) -> DataSourceReader:
        return SearchReader(self.options)


@dataclass
class OneSearch(InputPartition):
    search: dict


class SearchReader(DataSourceReader):
    def __init__(self, options: dict):
        import json

        self.searches, self.client = json.loads(options["searches"]), options["client"]

    def partitions(self) -> list[OneSearch]:
        return [OneSearch(s) for s in self.searches]

    def read(self, partition: OneSearch) -> Iterator[tuple[int, str]]:
        import importlib
        import json

        module, _, function = self.client.partition(":")
        client = getattr(importlib.import_module(module), function)()
        for record in client.jobs(partition.search):
            yield partition.search["query_id"], json.dumps(record)
