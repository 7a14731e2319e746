"""The batch run in three stages: fetch, extract, export; each gives counters and an exit code."""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import config as settings
from weftline.config import Config, ConfigError
from weftline.functions import text as T
from weftline.functions.html import clean_pages
from weftline.operators import extract as X
from weftline.operators import records as R
from weftline.operators.results import ResultTable
from weftline.services import report
from weftline.sources import crawl as C
from weftline.sources import fetch as W
from weftline.sources.store import Store, export_csv, export_review, export_xlsx, summary_json

STAGES = ("fetch", "extract", "export")
#: References that are looked up in the store together.
_REFS = 200
# Exit codes.
OK, FAILED, USAGE, BAD_CONFIG, NO_LOGIN, INTERRUPTED = 0, 1, 2, 3, 4, 130


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


@dataclass
class StageResult:
    stage: str
    ok: bool = True
    started_at: str = field(default_factory=_now)
    finished_at: str = ""
    counters: dict[str, int] = field(default_factory=dict)
    artifacts: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)

    def add(self, name: str, n: int = 1) -> None:
        self.counters[name] = self.counters.get(name, 0) + n

    def finished(self) -> StageResult:
        self.finished_at, self.ok = _now(), self.ok and not self.errors
        return self

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self) | {"counters": dict(sorted(self.counters.items()))}, ensure_ascii=False)


def extracted(pages: DataFrame, lexicon: dict, site_patterns: dict[str, list[str]] | None = None, model: Callable[[str], str] | None = None, below: int = len(T.CORE_FIELDS), image_text: str | None = None, results: ResultTable | None = None, named: str = "") -> DataFrame:
    """Article rows of manifest entries with html, in one plan: clean, extract, shape.

    pages hold detail_url, list_url, title, publish_date, html_path, crawl_time and html.
    """
    clean = clean_pages(pages, "detail_url", "detail_url", "html", ("title", "text", "images")).select("detail_url", F.col("title").alias("page_title"), "text", F.size("images").alias("n_images"))
    rows = pages.drop("html", "images").join(clean, "detail_url")
    title = F.when(F.length(F.trim("page_title")) > 0, F.col("page_title")).otherwise(F.coalesce("title", F.lit("")))
    rows = rows.withColumn("article_title", title).withColumn("content_kind", X.content_kind(F.lit("html"), F.col("text"), F.col("n_images")))
    found = X.two_stage(rows, "article_title", "text", lexicon, model, below, image_text=image_text, more=site_patterns, results=results, named=named)
    return found.withColumns({"article_key": T.article_key(F.col("detail_url")), "source_url": F.col("detail_url"), "raw_html_path": F.col("html_path"), "review_status": F.lit("pending")})


class Batch:
    """The stages over one configuration; the transport, the model and the image reader come from outside."""

    def __init__(self, spark: SparkSession, config: Config, opener: W.Opener = W.open_url, throttle: C.Throttle | None = None, model: Callable[[str], str] | None = None, recognise: Callable[[bytes], str] | None = None, login: Callable[[W.Client], None] = W.require_login, today: date | None = None) -> None:
        self.spark, self.config, self.model, self.recognise, self.login = spark, config, model, recognise, login
        self.client, self.archive = W.Client(config, opener, throttle), W.Archive(config)
        self.store, self.year = Store(spark, str(config.path(config.storage.folder))), (today or date.today()).year

    def run(self, stage: str) -> StageResult:
        if stage not in STAGES:
            raise ValueError(f"no stage {stage!r}")
        return getattr(self, stage)()

    def fetch(self, search: str = "") -> StageResult:
        """New articles into the archive and the manifest; one that fails is noted and passed over."""
        result = StageResult("fetch")
        self.login(self.client)  # without a login nothing is fetched
        refs = iter(W.all_refs(self.client, search))
        while some := list(islice(refs, _REFS)):
            new = self._fresh(some)
            result.add("refs_found", len(some))
            if len(new) < len(some):
                result.add("skipped_existing", len(some) - len(new))
            for ref in new:
                self._detail(ref, result)
        result.artifacts += [self.config.extract.raw_html_dir, str(self.archive.manifest)]
        return result.finished()

    def _fresh(self, refs: Sequence[Mapping[str, str]]) -> list[Mapping[str, str]]:
        """Those of a few references that are not stored yet; stored URLs are joined to them, never listed."""
        if not refs:
            return []
        asked = self.spark.createDataFrame([(r["detail_url"],) for r in refs], "detail_url string")
        new = {r.detail_url for r in self.store.fresh(asked).collect()}
        return [r for r in refs if r["detail_url"] in new]

    def _detail(self, ref: Mapping[str, str], result: StageResult) -> None:
        entry = W.fetch_detail(self.client, self.archive, ref, _now())
        self.archive.append(entry)
        if entry["error"]:
            result.add("details_failed")
            result.warnings.append(f"{entry['detail_url']}: {entry['error']}")
        else:
            result.add("details_fetched")
            result.add("images_fetched", len(entry["images"]))

    def _pages(self) -> DataFrame:
        """Manifest entries with their archived pages."""
        entries = C.read_manifest(self.spark, str(self.archive.manifest))
        folder = self.config.path(self.config.extract.raw_html_dir)
        files = self.spark.read.text(f"{folder}/*.html", wholetext=True).select(F.concat(F.lit(f"{self.config.extract.raw_html_dir}/"), F.col("_metadata.file_name")).alias("html_path"), F.col("value").alias("html"))
        return C.with_archive(entries, files)

    def _image_text(self, pages: DataFrame) -> DataFrame:
        """pages with what their images say; known texts come from the cache, new ones go there."""
        e, empty = self.config.extract, "article_key string, place int, data binary"
        rows = pages.select("detail_url", F.posexplode("images").alias("place", "image")).select("detail_url", "place", "image.image_path", F.col("image.sha1").alias("sha1"))
        root = str(self.config.root.resolve())
        if self.config.path(e.ocr_images_dir).exists():
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(self.config.path(e.ocr_images_dir)))
            files = files.select(F.regexp_replace("path", rf"^(file:)?/*\Q{root}\E/", "").alias("image_path"), F.col("content").alias("data"))
            images = rows.join(files, "image_path").select(F.col("detail_url").alias("article_key"), "place", "data")
        else:
            images = self.spark.createDataFrame([], empty)
        found = X.recognised_once(images, ResultTable(self.spark, self.config.path(e.ocr_cache_dir)), self.recognise)
        counts = found.agg(*[c.alias(n) for n, c in X.cache_counts(F.col("cached")).items()]).first()
        merged = found.where(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0).groupBy("article_key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "text"))), lambda x: F.trim(x["text"])), "\n").alias("image_text"))
        self._images = counts.asDict()
        return pages.join(merged.withColumnRenamed("article_key", "detail_url"), "detail_url", "left")

    def extract(self) -> StageResult:
        """From the manifest and the archive, without any request: extract, validate, store, and list what needs a look."""
        result = StageResult("extract")
        if not self.archive.manifest.exists():
            result.warnings.append("the manifest is empty; fetch first")
            return result.finished()
        pages = self._pages()
        seen = R.counters(pages, {"entries": F.lit(True), "failed": F.coalesce("error", F.lit("")) != "", "archived": F.col("archived")}).first()
        pages = pages.where("archived and coalesce(error, '') = ''")
        image_text = None
        if self.config.ocr.enabled and self.recognise:
            pages, image_text = self._image_text(pages), "image_text"
            result.counters |= self._images
        lexicon = self.config.lexicon
        model = self.model if self.config.llm.enabled else None
        rows = extracted(pages, lexicon, self._site_patterns(), model, self.config.extract.llm_trigger_below, image_text, ResultTable(self.spark, self.config.path(self.config.storage.folder) / "replies"), f"{self.config.llm.provider} {self.config.llm.model} {self.config.llm.temperature}")
        standards = {f: list(lexicon.get(g, ())) for f, g in (("degree", "degree"), ("city", "cities"), ("grade", "grade"))}
        checked = R.verdict(rows.withColumn("issues", R.issues(["source_url", "raw_html_path", "crawl_time"], standards, self.year))).cache()
        n = {
            "records_extracted": F.lit(True), "rule_records": X.n_hits(F.col("rule_hits")) > 0, "llm_records": X.n_hits(F.col("model_hits")) > 0,
            "image_records": X.n_hits(F.col("image_hits")) > 0, "invalid": ~F.col("ok"), "manual_review": F.col("needs_review"),
        }
        result.counters |= R.counters(checked, n).first().asDict() | {"entries": seen.entries, "entries_failed": seen.failed}
        valid = R.keep_first(checked.where("ok"), "source_url", [F.desc("crawl_time")])
        result.add("stored", valid.count())
        if result.counters["stored"]:
            self.store.upsert(valid)
        pending = checked.where("needs_review")
        export_review(pending, str(self.config.path(self.config.extract.manual_review_output)))
        checked.unpersist()
        result.artifacts += [self.config.storage.folder, self.config.extract.manual_review_output]
        return result.finished()

    def _site_patterns(self) -> dict[str, list[str]] | None:
        if not self.config.extract.regex_file:
            return None
        import yaml

        raw = yaml.safe_load(self.config.path(self.config.extract.regex_file).read_text(encoding="utf-8")) or {}
        return {str(f): [str(p) for p in (ps if isinstance(ps, list) else [ps])] for f, ps in raw.items()}

    def export(self) -> StageResult:
        """CSV, workbook, summary and report of all that is stored, made anew."""
        result, out = StageResult("export"), self.config.output
        rows = self.store.scan()
        result.add("exported_rows", rows.count())
        if not result.counters["exported_rows"]:
            result.warnings.append("the store is empty; extract first")
        export_csv(rows, str(self.config.path(out.csv_path)))
        for relative in (out.xlsx_path, out.summary_path, out.report_path):
            self.config.path(relative).parent.mkdir(parents=True, exist_ok=True)
        export_xlsx(rows, str(self.config.path(out.xlsx_path)))
        found = report.summary(rows, self.config.sampling.review_rate, self.config.sampling.seed)
        result.add("manual_review", found["manual_review_count"])
        self.config.path(out.summary_path).write_text(summary_json(found), encoding="utf-8")
        entries = C.read_manifest(self.spark, str(self.archive.manifest)) if self.archive.manifest.exists() else C.manifest_entries(self.spark.createDataFrame([], "line_no long, value string"))
        with self.config.path(out.report_path).open("w", encoding="utf-8") as f:
            f.writelines(report.report_lines(rows, entries.withColumn("article_key", T.article_key(F.col("detail_url")))))
        result.artifacts += [out.csv_path, out.xlsx_path, out.summary_path, out.report_path]
        self.last_summary: Mapping[str, Any] = found
        return result.finished()

    def targeted(self, list_page: Callable[[int, str], list[dict]], query: Any) -> dict[str, int]:
        """Fetch what a query asks for: the first keyword candidate with results, titles that hold it, then extract."""
        from weftline.operators.search import keyword_candidates
        from weftline.services.search import fetch_with_candidates

        text = query.raw_text or " ".join(query.keywords)
        candidates = self.spark.range(1).select(keyword_candidates(F.lit(text)).alias("c")).first().c
        refs, keyword, pages = fetch_with_candidates(list_page, candidates, self.config.search.max_fetch_pages)
        before, result = self.store.existing_urls().count(), StageResult("fetch")
        for ref in self._fresh([r for r in refs if keyword in r["title"]]):
            self._detail(ref, result)
        if result.counters.get("details_fetched"):
            self.extract()
        after = self.store.existing_urls().count()
        return {"pages_fetched": pages, "refs_found": len(refs), "details_ok": result.counters.get("details_fetched", 0), "details_failed": result.counters.get("details_failed", 0), "records_inserted": after - before}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="fetch, extract or export")
    p.add_argument("--stage", required=True, choices=STAGES)
    p.add_argument("--config", default="config/config.yaml")
    for name in ("--page-start", "--page-end"):
        p.add_argument(name, type=int)
    for name in ("llm", "ocr"):
        p.add_argument(f"--{name}", action=argparse.BooleanOptionalAction)
    p.add_argument("--json", action="store_true", help="print the result only")
    return p


def overridden(c: Config, args: argparse.Namespace) -> Config:
    """Settings with those of the command line over them, checked again."""
    pages = {k: getattr(args, k) for k in ("page_start", "page_end") if getattr(args, k) is not None}
    changed = dataclasses.replace(c, portal=dataclasses.replace(c.portal, **pages))
    for name in ("llm", "ocr"):
        if getattr(args, name) is not None:
            changed = dataclasses.replace(changed, **{name: dataclasses.replace(getattr(c, name), enabled=getattr(args, name))})
    return settings.checked(changed)


def main(argv: Sequence[str] | None = None, session: Callable[[], SparkSession] | None = None, **parts: Any) -> int:
    """Run one stage; the result goes to standard output as JSON, the exit code says how it went."""
    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    try:
        c = overridden(settings.load(args.config), args)
    except ConfigError as e:
        print(f"settings: {e}", file=sys.stderr)
        return BAD_CONFIG
    try:
        batch = Batch((session or SparkSession.builder.getOrCreate)(), c, **parts)
        result = batch.run(args.stage)
    except W.LoginError as e:
        print(f"login: {e}", file=sys.stderr)
        return NO_LOGIN
    except KeyboardInterrupt:
        return INTERRUPTED
    except Exception as e:
        print(f"{args.stage}: {type(e).__name__}: {e}", file=sys.stderr)
        return FAILED
    print(result.to_json())
    if not args.json:
        for line in (*result.warnings, *result.errors):
            print(f"  - {line}", file=sys.stderr)
        if args.stage == "export":
            print(report.console(batch.last_summary), file=sys.stderr)
    return OK if result.ok else FAILED


if __name__ == "__main__":
    sys.exit(main())
