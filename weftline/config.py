"""Settings: typed sections read from YAML, the environment over them, checked before any run."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any, get_type_hints

from weftline.functions import lexicon as lexicons
from weftline.functions.selectors import SelectorError, compiled
from weftline.functions.text import CORE_FIELDS, MISSING

#: Fixed value: seconds between two requests, at the least.
LEAST_INTERVAL = 2.0


class ConfigError(ValueError):
    """Settings that no run may start with."""


@dataclass(frozen=True)
class Portal:
    base_url: str = ""
    list_url: str = ""
    page_param: str = "page"
    page_start: int = 1
    page_end: int = 1
    detail_link_selector: str = ""
    login_url: str = ""
    login_check_url: str = ""
    mode: str = "html"
    api_url: str = ""
    api_body: Mapping[str, Any] = field(default_factory=dict)
    api_param_style: str = "query"
    api_page_field: str = "currentPage"
    api_token_field: str = ""
    api_token_style: str = "js_random"
    api_token_length: int = 32
    api_list_path: str = "data.records"
    api_total_path: str = "page.total"
    api_total_pages_path: str = "page.totalCounts"
    api_link_field: str = "notice_link"
    api_link_state_field: str = "notice_link_state"
    api_link_state_external: int = 1
    external_link_policy: str = "fetch"
    detail_org_id: str = ""
    detail_url_template: str = ""


@dataclass(frozen=True)
class Auth:
    method: str = "account"
    student_id: str = ""
    password: str = ""
    cookie: str = ""
    session_file: str = "data/.session.json"

    @property
    def ready(self) -> bool:
        return bool(self.cookie.strip()) if self.method == "cookie" else bool(self.student_id.strip() and self.password.strip())


@dataclass(frozen=True)
class Request:
    interval_seconds: float = LEAST_INTERVAL
    timeout: float = 20.0
    retries: int = 2
    user_agent: str = "Mozilla/5.0 (compatible)"
    proxy: str = ""
    use_playwright: bool = False
    verify_tls: bool = True
    encoding: str = ""


@dataclass(frozen=True)
class Extract:
    rule_first: bool = True
    missing_placeholder: str = MISSING
    manual_review_output: str = "data/processed/manual_review"
    raw_html_dir: str = "data/raw_html"
    regex_file: str = ""
    lexicon_file: str = ""
    ocr_images_dir: str = "data/images"
    ocr_cache_dir: str = "data/ocr_cache"
    llm_trigger_below: int = len(CORE_FIELDS)


@dataclass(frozen=True)
class Llm:
    enabled: bool = False
    provider: str = "openai"
    base_url: str = ""
    model: str = ""
    api_key: str = ""
    timeout: float = 60.0
    max_retries: int = 1
    temperature: float = 0.0


@dataclass(frozen=True)
class Ocr:
    enabled: bool = False
    lang: str = "chi_sim+eng"


@dataclass(frozen=True)
class Storage:
    folder: str = "data/store"
    batch_size: int = 200


@dataclass(frozen=True)
class Search:
    enabled: bool = True
    host: str = "127.0.0.1"
    port: int = 8765
    default_limit: int = 20
    max_limit: int = 100
    cache_ttl_seconds: int = 300
    cache_max_rows: int = 2000
    l1_size: int = 128
    trigger_enabled: bool = False
    max_fetch_pages: int = 2
    fetch_cooldown_seconds: int = 900
    max_estimated_seconds: float = 120.0
    fts_tokenizer: str = "unicode61"


@dataclass(frozen=True)
class Output:
    csv_path: str = "data/processed/jobs"
    xlsx_path: str = "data/processed/jobs.xlsx"
    summary_path: str = "data/processed/summary.json"
    report_path: str = "data/processed/report.html"


@dataclass(frozen=True)
class Sampling:
    review_rate: float = 0.1
    seed: int = 42


# Environment names that stand above the file.
ENVIRONMENT = {
    "PORTAL_BASE_URL": ("portal", "base_url"),
    "AUTH_STUDENT_ID": ("auth", "student_id"),
    "AUTH_PASSWORD": ("auth", "password"),
    "AUTH_COOKIE": ("auth", "cookie"),
    "CRAWLER_PROXY": ("request", "proxy"),
    "LLM_ENABLED": ("llm", "enabled"),
    "LLM_BASE_URL": ("llm", "base_url"),
    "LLM_MODEL": ("llm", "model"),
    "LLM_API_KEY": ("llm", "api_key"),
    "OCR_ENABLED": ("ocr", "enabled"),
}


@dataclass(frozen=True)
class Config:
    root: Path = Path(".")
    portal: Portal = Portal()
    auth: Auth = Auth()
    request: Request = Request()
    extract: Extract = Extract()
    llm: Llm = Llm()
    ocr: Ocr = Ocr()
    storage: Storage = Storage()
    search: Search = Search()
    output: Output = Output()
    sampling: Sampling = Sampling()

    def path(self, relative: str) -> Path:
        return self.root / relative

    @property
    def lexicon(self) -> dict:
        return lexicons.load(self.path(self.extract.lexicon_file)) if self.extract.lexicon_file else lexicons.load()


def _typed(kind: type, value: Any, where: str) -> Any:
    try:
        if kind is bool:
            return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "true", "yes", "on")
        if kind in (int, float, str):
            return kind("" if value is None and kind is str else value)
    except (TypeError, ValueError) as e:
        raise ConfigError(f"{where}: {value!r} is no {kind.__name__}") from e
    return dict(value or {})


def read_env(path: Path) -> dict[str, str]:
    """NAME=value lines; blank lines, comments and quotes around values go."""
    if not path.exists():
        return {}
    pairs = (line.partition("=") for line in path.read_text(encoding="utf-8").splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {name.strip().removeprefix("export "): value.strip().strip("'\"") for name, _, value in pairs}


def build(raw: Mapping[str, Any], root: Path = Path("."), env: Mapping[str, str] | None = None) -> Config:
    """Settings from nested mappings; names that are not known are passed over."""
    merged = {name: dict(section or {}) for name, section in raw.items() if isinstance(section, Mapping) or section is None}
    for name, (section, key) in ENVIRONMENT.items():
        if (env or {}).get(name, "").strip():
            merged.setdefault(section, {})[key] = env[name]
    sections = {}
    for f in dataclasses.fields(Config):
        if f.name != "root":
            given, cls = merged.get(f.name, {}), type(f.default)
            hints = get_type_hints(cls)
            sections[f.name] = cls(**{x.name: _typed(hints[x.name], given[x.name], f"{f.name}.{x.name}") for x in dataclasses.fields(cls) if x.name in given})
    if "page_end" not in merged.get("portal", {}):
        sections["portal"] = dataclasses.replace(sections["portal"], page_end=sections["portal"].page_start)
    return checked(Config(root, **sections))


def load(path: str | Path, root: str | Path | None = None, env: str | Path | None = None) -> Config:
    """Settings of a YAML file, with a .env file beside the root over them."""
    import yaml

    path = Path(path)
    root = Path(root) if root else path.resolve().parent.parent
    if not path.exists():
        raise ConfigError(f"no settings at {path}")
    raw = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    if not isinstance(raw, Mapping):
        raise ConfigError(f"{path} holds no sections")
    return build(raw, root, read_env(Path(env) if env else root / ".env"))


def _is_selector(text: str) -> bool:
    """True for a selector that can be read, and for none."""
    try:
        return not text.strip() or bool(compiled(text))
    except SelectorError:
        return False


def checked(c: Config) -> Config:
    """c, if every rule holds; ConfigError names all that do not."""
    web = ("http://", "https://")
    rules = {
        "portal.base_url must be an http(s) address": c.portal.base_url.startswith(web),
        "portal.mode must be html or api": c.portal.mode in ("html", "api"),
        "portal.api_param_style must be query or json": c.portal.api_param_style in ("query", "json"),
        "portal.external_link_policy must be fetch, portal or skip": c.portal.external_link_policy in ("fetch", "portal", "skip"),
        "portal.api_url must be an http(s) address in api mode": c.portal.mode != "api" or c.portal.api_url.startswith(web),
        "portal.detail_url_template must be given in api mode": c.portal.mode != "api" or bool(c.portal.detail_url_template),
        "portal.detail_link_selector must be a CSS selector": _is_selector(c.portal.detail_link_selector),
        "portal.page_start must be 1 or more": c.portal.page_start >= 1,
        "portal.page_end must be 0 or not under page_start": c.portal.page_end == 0 or c.portal.page_end >= c.portal.page_start,
        f"request.interval_seconds must be {LEAST_INTERVAL} or more": c.request.interval_seconds >= LEAST_INTERVAL,
        "auth.method must be account or cookie": c.auth.method in ("account", "cookie"),
        "extract.rule_first must be true": c.extract.rule_first,
        f"extract.missing_placeholder must be {MISSING}": c.extract.missing_placeholder == MISSING,
        "extract.llm_trigger_below must be 1 or more": c.extract.llm_trigger_below >= 1,
        "sampling.review_rate must be over 0 and at most 1": 0 < c.sampling.review_rate <= 1,
        "llm.provider must be openai or ollama": not c.llm.enabled or c.llm.provider in ("openai", "ollama"),
        "llm.model must be given": not c.llm.enabled or bool(c.llm.model.strip()),
        "llm.api_key must be given": not c.llm.enabled or c.llm.provider != "openai" or bool(c.llm.api_key.strip()),
        "ocr.lang must be given": not c.ocr.enabled or bool(c.ocr.lang.strip()),
        "storage.batch_size must be 1 or more": c.storage.batch_size >= 1,
        "search.host must be this machine": c.search.host in ("127.0.0.1", "localhost", "::1"),
        "search.port must be a port": 1 <= c.search.port <= 65535,
        "search.default_limit must be 1 or more": c.search.default_limit >= 1,
        "search.max_limit must not be under default_limit": c.search.max_limit >= c.search.default_limit,
        "search.max_fetch_pages must be 1 or more": c.search.max_fetch_pages >= 1,
        "search.fetch_cooldown_seconds must not be negative": c.search.fetch_cooldown_seconds >= 0,
        "search.max_estimated_seconds must be positive": c.search.max_estimated_seconds > 0,
        "search.fts_tokenizer must be trigram or unicode61": c.search.fts_tokenizer in ("trigram", "unicode61"),
    }
    if broken := [rule for rule, holds in rules.items() if not holds]:
        raise ConfigError("; ".join(broken))
    return c


def masked(secret: str) -> str:
    """Whether a secret is set, and nothing of it."""
    return "***" if secret else ""
