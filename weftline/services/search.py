"""The search service: results from memory, a cache table or the data, fetch jobs and counters."""

from __future__ import annotations

import dataclasses
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.sql import functions as F

from weftline.config import Config
from weftline.functions.text import CORE_FIELDS
from weftline.operators import search as S
from weftline.operators.records import related
from weftline.operators.textindex import TextIndex
from weftline.sources.store import Store

# Labels of the fields in results, and how many keyword candidates are tried.
LABELS = {"article_title": "标题", "graduation_year": "届别", "grade": "年级", "degree": "学历", "major": "专业", "city": "城市", "employer": "单位", "position": "岗位", "evidence": "依据"}
MOST_CANDIDATES = 4


@dataclass(frozen=True)
class Result:
    query: S.Query
    total: int = 0
    hits: tuple[Mapping[str, Any], ...] = ()
    related: tuple[str, ...] = ()
    suggestion: Mapping[str, Any] | None = None
    version: int = 0
    source: str = "data"
    elapsed_ms: float = 0.0


def to_payload(r: Result) -> str:
    return json.dumps(dataclasses.asdict(r), ensure_ascii=False)


def from_payload(text: str) -> Result | None:
    """A result again; None for a payload that is none."""
    try:
        raw = json.loads(text)
        q = raw.pop("query")
        query = S.Query(tuple(q["keywords"]), dict(q["fields"]), int(q["limit"]), int(q["offset"]), q["raw_text"])
        return Result(query, int(raw["total"]), tuple(raw["hits"]), tuple(raw["related"]), raw["suggestion"], int(raw["version"]), raw["source"], float(raw["elapsed_ms"]))
    except (ValueError, KeyError, TypeError):
        return None


class KeyedFiles:
    """Rows of JSON by key, a file each, written whole or not at all; what small service tables need."""

    def __init__(self, folder: Path) -> None:
        self.folder, self._lock = folder, threading.Lock()

    def _at(self, key: str) -> Path:
        return self.folder / f"{uuid.uuid5(uuid.NAMESPACE_OID, key).hex}.json"

    def put(self, key: str, row: Mapping[str, Any]) -> None:
        with self._lock:
            self.folder.mkdir(parents=True, exist_ok=True)
            part = self._at(key).with_suffix(".part")
            part.write_text(json.dumps(dict(row) | {"key": key}, ensure_ascii=False), encoding="utf-8")
            part.replace(self._at(key))

    def get(self, key: str) -> dict | None:
        try:
            return json.loads(self._at(key).read_text(encoding="utf-8"))
        except (OSError, ValueError):
            return None

    def drop(self, key: str) -> None:
        self._at(key).unlink(missing_ok=True)

    def rows(self) -> Iterator[dict]:
        for path in sorted(self.folder.glob("*.json")):
            try:
                yield json.loads(path.read_text(encoding="utf-8"))
            except (OSError, ValueError):
                continue


class CacheTable:
    """Results that outlive the process: a version that is not the data's, or an age over ttl, is a miss; ttl 0 is no age."""

    def __init__(self, folder: Path, ttl: float = 300, most: int = 2000, clock: Callable[[], float] = time.time) -> None:
        self.rows, self.ttl, self.most, self.clock = KeyedFiles(folder), max(0, ttl), max(1, most), clock

    def _old(self, row: Mapping[str, Any]) -> bool:
        return bool(self.ttl) and self.clock() - row["created_at"] > self.ttl

    def get(self, key: str, version: int) -> Result | None:
        row = self.rows.get(key)
        if row is None or row["version"] != version or self._old(row):
            return None
        found = from_payload(row["payload"])
        if found:
            self.rows.put(key, row | {"last_hit_at": self.clock()})
        return found

    def put(self, key: str, result: Result) -> None:
        now = self.clock()
        self.rows.put(key, {"query_text": result.query.raw_text or " ".join(result.query.keywords), "version": result.version, "payload": to_payload(result), "created_at": now, "last_hit_at": now})

    def prune(self) -> int:
        """Old rows go, then those used longest ago until `most` are left; returns how many went."""
        rows = list(self.rows.rows())
        fresh = sorted((r for r in rows if not self._old(r)), key=lambda r: (-r["last_hit_at"], r["key"]))
        kept = {r["key"] for r in fresh[: self.most]}
        for r in rows:
            if r["key"] not in kept:
                self.rows.drop(r["key"])
        return len(rows) - len(kept)

    def invalidate(self) -> int:
        keys = [r["key"] for r in self.rows.rows()]
        for k in keys:
            self.rows.drop(k)
        return len(keys)

    def __len__(self) -> int:
        return sum(1 for _ in self.rows.rows())


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


@dataclass(frozen=True)
class Job:
    job_id: str = ""
    search_value: str = ""
    state: str = "pending"
    message: str = ""
    started_at: str = ""
    finished_at: str = ""
    counters: Mapping[str, int] = field(default_factory=dict)


#: Fetches what a query asks for; returns counters, of which records_inserted says what is new.
Fetch = Callable[[S.Query], Mapping[str, int]]


class SearchService:
    """Search over a store: memory, then the cache table, then the data, each filling those before it."""

    def __init__(self, config: Config, store: Store, folder: str | Path, fetch: Fetch | None = None, login: Callable[[], None] | None = None, clock: Callable[[], float] = time.time) -> None:
        c, folder = config.search, Path(folder)
        self.config, self.store, self.clock = config, store, clock
        self.memory = S.ResultCache(c.l1_size)
        self.table = CacheTable(folder / "cache", c.cache_ttl_seconds, c.cache_max_rows, clock)
        self.index = TextIndex(store.spark, str(folder / f"index-{c.fts_tokenizer}"), c.fts_tokenizer)
        self.jobs, self.cooldowns = KeyedFiles(folder / "jobs"), KeyedFiles(folder / "cooldowns")
        self.fetch, self.login, self._threads = fetch, login, ThreadPoolExecutor(1, "fetch")

    # search

    def query(self, text: str, fields: Mapping[str, str] | None = None, limit: int | None = None, offset: int = 0) -> S.Query:
        c = self.config.search
        words = self.store.spark.range(1).select(S.query_tokens(F.lit(text)).alias("t")).first().t
        known = {k: v for k, v in (fields or {}).items() if k in CORE_FIELDS and str(v).strip()}
        return S.Query(tuple(words), known, max(1, min(c.default_limit if limit is None else limit, c.max_limit)), max(0, offset), text.strip())

    def search(self, query: S.Query) -> Result:
        began, version = time.perf_counter(), self.store.version
        key = query.key(version, fallback=True)
        for name, found in (("memory", self.memory.get(key)), ("table", None)):
            found = found or (self.table.get(key, version) if name == "table" else None)
            if found:
                self.memory.put(key, found)
                return dataclasses.replace(found, source=name, elapsed_ms=1000 * (time.perf_counter() - began))
        result = self._from_data(query, version)
        result = dataclasses.replace(result, elapsed_ms=1000 * (time.perf_counter() - began))
        self.table.put(key, result)
        self.memory.put(key, result)
        return result

    def _from_data(self, query: S.Query, version: int) -> Result:
        rows = self.store.read()
        if version:
            self.index.maintain(rows.withColumn("_index", S.index_text()), "article_key", "_index", version)
        found = S.matching(rows, query, self.config.search.fts_tokenizer, self.index if version else None)
        total = found.count()
        corpus = F.concat_ws(" ", "article_title", *CORE_FIELDS, "evidence")
        extra = [F.col(c) for c in ("source_url", "publish_date", "extract_method", "content_kind", "score")]
        extra += [S.snippet(corpus, query.keywords).alias("snippet"), S.highlights(LABELS, query.keywords).alias("highlights")]
        page = S.hits(S.page_of(found, query, self.config.search.max_limit), "article_key", "article_title", CORE_FIELDS, extra).collect()
        similar = self.related(query.keywords) if query.keywords else ()
        result = Result(query, total, tuple(r.asDict() for r in page), tuple(similar), None, version)
        return dataclasses.replace(result, suggestion=self.suggestion(result))

    def related(self, words: Sequence[str], limit: int = 8) -> list[str]:
        return [r.value for r in related(self.store.read(), CORE_FIELDS, list(words), limit).collect()]

    # fetch jobs

    @staticmethod
    def search_value(query: S.Query) -> str:
        return query.raw_text.strip() or " ".join(query.keywords)

    def cooldown_left(self, search_value: str) -> int:
        row = self.cooldowns.get(search_value)
        left = self.config.search.fetch_cooldown_seconds - (self.clock() - row["at"]) if row else 0
        return max(0, int(left))

    def suggestion(self, result: Result) -> dict | None:
        c = self.config
        left = self.cooldown_left(self.search_value(result.query))
        return S.fetch_estimate(result.total, result.query, c.search.max_fetch_pages, c.request.interval_seconds, c.search.trigger_enabled, c.search.max_estimated_seconds, left)

    def request_fetch(self, query: S.Query) -> Job:
        """A job that fetches in the background, or one that says why it is skipped; a skipped one costs no cooldown."""
        value = self.search_value(query)
        if not self.config.search.trigger_enabled or self.fetch is None:
            return Job("", value, "skipped", "fetching is disabled")
        if not value:
            return Job("", value, "skipped", "an empty query fetches nothing")
        try:
            if self.login:
                self.login()
        except Exception as e:
            return Job("", value, "skipped", f"no valid login: {e}")
        if left := self.cooldown_left(value):
            return Job("", value, "skipped", f"{left // 60 + 1} minutes until it may be fetched again")
        job = Job(uuid.uuid4().hex[:12], value)
        self._keep(job)
        self.cooldowns.put(value, {"at": self.clock()})
        self._threads.submit(self._run, job, query)
        return job

    def _keep(self, job: Job) -> None:
        known = self.jobs.get(job.job_id)
        self.jobs.put(job.job_id, dataclasses.asdict(job) | {"at": known["at"] if known else self.clock()})

    def _run(self, job: Job, query: S.Query) -> None:
        job = dataclasses.replace(job, state="running", started_at=_now())
        self._keep(job)
        try:
            job = dataclasses.replace(job, state="done", counters=dict(self.fetch(query)))
        except Exception as e:
            job = dataclasses.replace(job, state="failed", message=f"{type(e).__name__}: {e}")
        self._keep(dataclasses.replace(job, finished_at=_now()))

    @staticmethod
    def _job(row: Mapping[str, Any] | None) -> Job | None:
        return Job(**{f.name: row[f.name] for f in dataclasses.fields(Job)}) if row else None

    def job(self, job_id: str) -> Job | None:
        return self._job(self.jobs.get(job_id))

    def latest_job(self) -> Job | None:
        return self._job(max(self.jobs.rows(), key=lambda r: r["at"], default=None))

    def stats(self) -> dict[str, Any]:
        return {"version": self.store.version, "rows": self.store.read().count(), "cache_rows": len(self.table), "memory_entries": len(self.memory), "memory_hits": self.memory.hits, "memory_misses": self.memory.misses, "trigger_enabled": self.config.search.trigger_enabled}

    def close(self) -> None:
        self._threads.shutdown(wait=True)


def fetch_with_candidates(list_page: Callable[[int, str], list[dict]], candidates: Sequence[str], pages: int) -> tuple[list[dict], str, int]:
    """(references, keyword, pages read) of the first candidate that finds any; a page that fails ends its candidate."""
    read, keyword = 0, candidates[0] if candidates else ""
    for keyword in candidates[:MOST_CANDIDATES]:
        found: list[dict] = []
        for page in range(1, pages + 1):
            try:
                refs = list_page(page, keyword)
            except Exception:
                break
            read += 1
            if not refs:
                break
            found += refs
        if found:
            return found, keyword, read
    return [], keyword, read
