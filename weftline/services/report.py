"""Summary and HTML report of a store."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from html import escape
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import CORE_FIELDS, MISSING
from weftline.operators import records as R

# Labels of the fields.
FIELD_LABELS = {"graduation_year": "届别", "grade": "年级", "degree": "学历", "major": "专业", "city": "城市", "employer": "单位", "position": "岗位"}


def summary(rows: DataFrame, rate: float = 0.1, seed: int = 42) -> dict[str, Any]:
    """Counts, completeness, distributions, sources of fields, and the seeded sample's keys."""
    totals = R.unknown_totals(rows).first()
    total = rows.count()
    return {
        "total": total,
        "complete_records": totals.complete,
        "manual_review_count": totals.manual_review,
        "unknown_total": totals.unknown_total,
        "completeness": R.completeness(rows, CORE_FIELDS).first().asDict(),
        "extract_method": {r.value: r.n for r in R.distribution(rows, "extract_method", R.METHODS, "none").collect()},
        "content_kind": {r.value: r.n for r in R.distribution(rows, "content_kind", R.KINDS, "html").collect()},
        "field_source": {r.field: {"rule": r.rule, "llm": r.llm} for r in R.field_source(rows, CORE_FIELDS).collect()},
        "review_rate": rate,
        "sample": sorted(r.article_key for r in R.review_sample(rows, ["article_key"], rate, seed).select("article_key").collect()) if total else [],
    }


def console(found: Mapping[str, Any]) -> str:
    """The summary as lines for a terminal."""
    lines = [f"records {found['total']}, complete {found['complete_records']}, to review {found['manual_review_count']}, unknown fields {found['unknown_total']}"]
    lines += [f"  {FIELD_LABELS[f]} {rate:.1%} ({f})" for f, rate in found["completeness"].items()]
    for part in ("extract_method", "content_kind"):
        lines.append(f"{part}: " + ", ".join(f"{k} {n}" for k, n in found[part].items()))
    lines.append(f"sample {len(found['sample'])} at {found['review_rate']:.0%}")
    return "\n".join(lines)


def _row(tag: str, *cells: str) -> str:
    return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"


def _known(value: str) -> str:
    return escape(value) if value.strip() and value != MISSING else f'<span class="unknown">{MISSING}</span>'


def report_lines(rows: DataFrame, entries: DataFrame) -> Iterator[str]:
    """An HTML page: cards, hit rates, all rows with the most complete first, and what needs a look.

    rows are article rows; entries are manifest entries with article_key. Rows stream
    through the driver, so their number is no matter of memory.
    """
    cards = R.report_cards(rows, entries).first()
    yield "<!DOCTYPE html><html><head><meta charset='utf-8'><title>Report</title></head><body><h1>Report</h1><div class='cards'>"
    for label, n in (("记录", cards.total), ("归档", cards.archived), ("图片", cards.images), ("站外正文", cards.external), ("齐备", cards.complete), ("待复核", cards.manual)):
        yield f"<div class='card'><b>{label}</b> {n}</div>"
    yield "</div><h2>字段命中率</h2><table>"
    rates = R.completeness(rows, CORE_FIELDS).first()
    for f in CORE_FIELDS:
        yield _row("td", f"{FIELD_LABELS[f]} ({f})", f"{rates[f]:.1%}")
    yield "</table><h2>明细</h2><table id='jobs'>" + _row("th", "#", "标题", *FIELD_LABELS.values(), "方式", "依据")
    shown = R.report_order(rows.join(entries.select("article_key", "content_url"), "article_key", "left"))
    shown = shown.select("article_title", "source_url", F.coalesce("content_url", F.lit("")).alias("content_url"), *CORE_FIELDS, "extract_method", F.substring("evidence", 1, 220).alias("evidence"))
    for i, r in enumerate(shown.toLocalIterator(), 1):
        link = f"<a href='{escape(r.content_url or r.source_url)}'>{escape(r.article_title[:60] or '(无标题)')}</a>"
        yield _row("td", str(i), link, *(_known(r[f]) for f in CORE_FIELDS), escape(r.extract_method), escape(r.evidence))
    yield f"</table><h2>待复核（{cards.manual}）</h2><table>"
    pending = rows.withColumn("missing", R.unknown_fields()).where(F.size("missing") > 0).select("article_title", "missing", "source_url").orderBy("source_url")
    for r in pending.toLocalIterator():
        yield _row("td", escape(r.article_title[:56]), "、".join(FIELD_LABELS[f] for f in r.missing), escape(r.source_url))
    yield "</table></body></html>"
