"""A small HTTP API over the search service, for this machine only."""

from __future__ import annotations

import dataclasses
import json
import mimetypes
from http import HTTPStatus
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path
from typing import Any
from urllib.parse import parse_qs, urlsplit

from weftline.config import ConfigError
from weftline.functions.text import CORE_FIELDS
from weftline.services.search import SearchService

#: Fixed value: the largest request body.
MOST_BODY = 64 * 1024


def _number(value: str | None, default: int | None) -> int | None:
    try:
        return int(str(value).strip()) if value and value.strip() else default
    except ValueError:
        return default


class Refused(Exception):
    """A request that is answered with an error."""

    def __init__(self, status: HTTPStatus, message: str) -> None:
        super().__init__(message)
        self.status = status


def handler(service: SearchService, static: Path | None) -> type[BaseHTTPRequestHandler]:
    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *args: Any) -> None:
            pass

        def _send(self, status: HTTPStatus, body: bytes, kind: str) -> None:
            self.send_response(status)
            for name, value in (("Content-Type", kind), ("Content-Length", str(len(body))), ("Cache-Control", "no-store")):
                self.send_header(name, value)
            self.end_headers()
            self.wfile.write(body)

        def _answer(self, work) -> None:
            try:
                status, payload = work()
            except Refused as e:
                status, payload = e.status, {"error": str(e)}
            if isinstance(payload, Path):
                kind = mimetypes.guess_type(payload.name)[0] or "application/octet-stream"
                self._send(status, payload.read_bytes(), f"{kind}; charset=utf-8" if kind.startswith("text/") else kind)
            else:
                self._send(status, json.dumps(payload, ensure_ascii=False).encode(), "application/json; charset=utf-8")

        def do_GET(self) -> None:
            self._answer(self._get)

        def do_POST(self) -> None:
            self._answer(self._post)

        def _get(self):
            parts = urlsplit(self.path)
            route, given = parts.path.rstrip("/") or "/", {k: v[0] for k, v in parse_qs(parts.query).items()}
            if route == "/api/search":
                fields = {f: given[f] for f in CORE_FIELDS if f in given}
                query = service.query(given.get("q", ""), fields, _number(given.get("limit"), None), _number(given.get("offset"), 0))
                return HTTPStatus.OK, dataclasses.asdict(service.search(query))
            if route == "/api/related":
                return HTTPStatus.OK, {"related": service.related(service.query(given.get("q", "")).keywords, 10)}
            if route == "/api/stats":
                return HTTPStatus.OK, service.stats()
            if route == "/api/fetch":
                job = service.latest_job()
                return HTTPStatus.OK, {"job": dataclasses.asdict(job) if job else None}
            if route.startswith("/api/fetch/"):
                if job := service.job(route.removeprefix("/api/fetch/")):
                    return HTTPStatus.OK, {"job": dataclasses.asdict(job)}
                raise Refused(HTTPStatus.NOT_FOUND, "no such job")
            if route.startswith("/api/") or static is None:
                raise Refused(HTTPStatus.NOT_FOUND, "no such route")
            target = (static / ("index.html" if route == "/" else route.lstrip("/"))).resolve()
            if not target.is_relative_to(static.resolve()):
                raise Refused(HTTPStatus.FORBIDDEN, "outside the folder")
            if not target.is_file():
                raise Refused(HTTPStatus.NOT_FOUND, "no such file")
            return HTTPStatus.OK, target

        def _post(self):
            if urlsplit(self.path).path.rstrip("/") != "/api/fetch":
                raise Refused(HTTPStatus.NOT_FOUND, "no such route")
            size = _number(self.headers.get("Content-Length"), 0)
            if size < 0:
                raise Refused(HTTPStatus.BAD_REQUEST, "the body's length is negative")
            if size > MOST_BODY:
                raise Refused(HTTPStatus.REQUEST_ENTITY_TOO_LARGE, "the body is too large")
            try:
                body = json.loads(self.rfile.read(size) or b"{}")
            except ValueError:
                raise Refused(HTTPStatus.BAD_REQUEST, "the body is no JSON") from None
            given = body if isinstance(body, dict) else {}
            query = service.query(str(given.get("q") or ""), None, _number(str(given.get("limit") or ""), None))
            if query.empty:
                raise Refused(HTTPStatus.BAD_REQUEST, "an empty query fetches nothing")
            job = service.request_fetch(query)
            return HTTPStatus.ACCEPTED if job.job_id else HTTPStatus.CONFLICT, {"job": dataclasses.asdict(job)}

    return Handler


def build_server(service: SearchService, port: int | None = None, static: str | Path | None = None) -> ThreadingHTTPServer:
    """A server that is not started yet; port 0 takes a free one. ConfigError where search is disabled."""
    c = service.config.search
    if not c.enabled:
        raise ConfigError("search.enabled is false")
    return ThreadingHTTPServer((c.host, c.port if port is None else port), handler(service, Path(static) if static else None))
