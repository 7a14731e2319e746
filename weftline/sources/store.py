"""A versioned table of Parquet snapshots, and exports of it."""

from __future__ import annotations

import json
import time
import uuid
import zipfile
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.records import keep_last, scan_order, unknown_fields, upsert, with_status
from weftline.functions.text import CORE_FIELDS
from weftline.operators.versionlog import Conflict, VersionLog

__all__ = ["COLUMNS", "REVIEW_COLUMNS", "Conflict", "State", "Store", "export_csv", "export_review", "export_xlsx", "projected", "read_csv", "summary_json"]

# The columns of the article table, in order.
COLUMNS = ("article_key", *CORE_FIELDS, "article_title", "publish_date", "source_url", "list_url", "raw_html_path", "crawl_time", "extract_method", "content_kind", "evidence", "review_status")
REVIEW_COLUMNS = ("article_key", *CORE_FIELDS, "source_url", "content_kind", "extract_method", "evidence", "review_status")

#: Buckets of a new table; rebucket() gives a table others.
BUCKETS = 16
_BUCKET = "_bucket"


def projected(df: DataFrame, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """The columns in order, as strings; null and absent ones are empty."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])


@dataclass(frozen=True)
class State:
    """One version of the table: of each bucket that holds rows, the folder of data that holds them."""

    version: int = 0
    buckets: int = 0
    parts: Mapping[int, str] = field(default_factory=dict)


class Store:
    """A table of snapshots, kept as a log of versions over bucketed Parquet.

    Rows are dealt to buckets by a hash of source_url. A version is one small file that names,
    for each bucket, the folder its rows stand in; data never changes once it is named. A
    change writes the buckets that it touches anew, in a folder of its own, and then
    publishes the next version. The file of a version is written beside the log and put
    in its place whole, only where no other writer has, so readers see complete versions
    and a writer that dies at any step leaves nothing that stops others; expire() removes
    what it left. A writer that finds its version taken goes on from the newer one: as it is,
    if that one changed other buckets, and from the start if not.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self._buckets = spark, folder.rstrip("/"), buckets
        self._log = VersionLog(spark, self.folder)
        self._fs, self._path, self._names = self._log.fs, self._log.path, self._log.names

    # the log

    def state(self, version: int | None = None) -> State:
        """A version of the table; the newest where none is named."""
        version = self.version if version is None else version
        if not version:
            return State(buckets=self._buckets)
        raw = self._log.read(version)
        return State(version, raw["buckets"], {int(b): name for b, name in raw["parts"].items()})

    def _publish(self, state: State) -> None:
        """Makes state the version that it says; Conflict if there is one already."""
        self._log.publish(state.version, {"buckets": state.buckets, "parts": dict(state.parts)})

    def _commit(self, base: State, changed: Mapping[int, str | None], tries: int = 50) -> int:
        """Publishes base with buckets changed (None: empty); goes on from newer versions that left these buckets alone."""
        for _ in range(tries):
            parts = {b: n for b, n in {**base.parts, **changed}.items() if n is not None}
            try:
                self._publish(State(base.version + 1, base.buckets, parts))
                return base.version + 1
            except Conflict:
                newer = self.state()
                if newer.buckets != base.buckets or any(newer.parts.get(b) != base.parts.get(b) for b in changed):
                    raise
                base = newer
        raise Conflict(f"version {base.version + 1} was written by others again and again")

    # rows

    @property
    def version(self) -> int:
        return max(self._log.versions(), default=0)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64("source_url"), F.lit(buckets)).cast("int")

    def read(self, state: State | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version, the newest if none is given; only: of these buckets."""
        state = state or self.state()
        parts = {b: n for b, n in state.parts.items() if only is None or b in set(only)}
        kinds = ", ".join(f"{c} string" for c in COLUMNS)
        if not parts:
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).parquet(*(f"{self.folder}/data/{n}/{_BUCKET}={b}" for b, n in sorted(parts.items())))

    def _put(self, rows: DataFrame, buckets: int) -> tuple[str, set[int]]:
        """Writes rows by bucket to a new folder; returns its name and the buckets that have rows."""
        name = uuid.uuid4().hex
        dealt = projected(rows).withColumn(_BUCKET, self._bucket(buckets))
        dealt.repartition(buckets, _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.folder}/data/{name}")
        return name, {int(n.partition("=")[2]) for n in self._names(f"data/{name}") if n.startswith(f"{_BUCKET}=")}

    def write(self, df: DataFrame, after: int | None = None) -> int:
        """A new snapshot of all rows, made from version `after` (the newest where it is not given); returns its version.

        Conflict if there is a later one by now.
        """
        base = self.state(after)
        name, filled = self._put(df, base.buckets)
        self._publish(State(base.version + 1, base.buckets, dict.fromkeys(sorted(filled), name)))
        return base.version + 1

    def upsert(self, records: DataFrame, order: Sequence = (), tries: int = 20) -> int:
        """Records in place of those of their source_url; of several new ones the last by order counts.

        Records are worked out once, into the folder of the writer, whatever other writers
        do; only buckets that have new records are read and written.
        """
        buckets = self.state().buckets
        staged, touched = self._put(keep_last(projected(records), ["source_url"], list(order) or [F.desc("crawl_time")]), buckets)
        new = self.spark.read.schema(", ".join(f"{c} string" for c in COLUMNS)).parquet(*(f"{self.folder}/data/{staged}/{_BUCKET}={b}" for b in sorted(touched))) if touched else self.read(State())
        for left in range(tries, 0, -1):
            base = self.state()
            if base.buckets != buckets:
                raise Conflict("the table has other buckets by now")
            if not set(touched) & set(base.parts):  # nothing to merge with: the records are the buckets
                name, filled = staged, touched
            else:
                name, filled = self._put(upsert(self.read(base, touched), new, "source_url"), buckets)
            try:
                version = self._commit(base, {b: name if b in filled else None for b in touched})
            except Conflict:
                if left == 1:
                    raise
                continue
            if name != staged:
                self._fs.delete(self._path(f"{self.folder}/data/{staged}"), True)
            return version
        raise AssertionError

    def set_status(self, key: str, status: str, tries: int = 20) -> int:
        """The review status of one article; returns how many rows have the key."""
        for left in range(tries, 0, -1):
            base = self.state()
            chosen = F.col("article_key") == key
            found = self.read(base).where(chosen).groupBy(self._bucket(base.buckets).alias("b")).count().collect()  # at most one row a bucket
            if not found:
                return 0
            touched = [r.b for r in found]
            name, filled = self._put(with_status(self.read(base, touched), chosen, status), base.buckets)
            try:
                self._commit(base, {b: name if b in filled else None for b in touched})
                return sum(r["count"] for r in found)
            except Conflict:
                if left == 1:
                    raise
        raise AssertionError

    def rebucket(self, buckets: int) -> int:
        """The same rows in another number of buckets, each one file a bucket, as a table that has grown wants; returns the version."""
        base = self.state()
        name, filled = self._put(self.read(base), buckets)
        self._publish(State(base.version + 1, buckets, dict.fromkeys(sorted(filled), name)))
        return base.version + 1

    def expire(self, keep: int = 10, grace_seconds: float = 86_400) -> int:
        """Removes versions but the last `keep`, and what no version names: old data and the leavings of writers that died.

        Nothing that is younger than the grace goes, as its writer or a reader may be at
        work. Returns how many folders of data went.
        """
        versions = self._log.versions()
        for v in versions[: max(0, len(versions) - max(1, keep))]:
            self._fs.delete(self._path(self._log.file(v)), False)
        named = {n for v in self._log.versions() for n in self.state(v).parts.values()}
        oldest, gone = (time.time() - grace_seconds) * 1000, 0
        for folder in ("data", "pending"):
            at = self._path(f"{self.folder}/{folder}")
            for f in self._fs.listStatus(at) if self._fs.exists(at) else ():
                if f.getPath().getName() not in named and f.getModificationTime() <= oldest:
                    gone += bool(self._fs.delete(f.getPath(), True)) and folder == "data"
        return gone

    def scan(self) -> DataFrame:
        """All rows, the newest first."""
        return scan_order(self.read())

    def manual_review(self) -> DataFrame:
        """Rows with a core field that is not known."""
        return self.read().where(F.size(unknown_fields()) > 0)

    def existing_urls(self) -> DataFrame:
        return self.read().select("source_url").where("source_url != ''").distinct()

    def fresh(self, refs: DataFrame, column: str = "detail_url") -> DataFrame:
        """References that are not stored yet."""
        return refs.join(self.existing_urls(), refs[column] == F.col("source_url"), "left_anti")


def export_csv(df: DataFrame, folder: str, columns: Sequence[str] = COLUMNS, one_file: bool = True) -> None:
    """CSV in column order, with a byte order mark before the first name for spreadsheet programs.

    One file is written by one task, as spreadsheets want it; for large tables ask for parts.
    """
    out = projected(df, columns)
    names = ["\ufeff" + columns[0], *columns[1:]]
    out = out.toDF(*names)
    (out.coalesce(1) if one_file else out).write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def read_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of an export; the byte order mark before the first name goes."""
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(folder)
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns]).na.fill("")


def export_review(df: DataFrame, folder: str) -> None:
    """The review list; written anew even when empty."""
    export_csv(df, folder, REVIEW_COLUMNS)


def _letter(i: int) -> str:
    return (chr(64 + i // 26) if i >= 26 else "") + chr(65 + i % 26)


def export_xlsx(df: DataFrame, path: str, columns: Sequence[str] = COLUMNS, sheet: str = "jobs", most: int = 1_048_575) -> int:
    """A workbook of one sheet of text cells; rows stream through the driver into the file.

    A sheet holds 1,048,576 rows at most, so a larger table is an error.
    """
    out, rows = projected(df, columns), 0
    if out.count() > most:
        raise ValueError(f"a sheet holds {most} rows")

    def row(number: int, values: Sequence[str]) -> str:
        cells = (f'<c r="{_letter(i)}{number}" t="inlineStr"><is><t xml:space="preserve">{_xml(v)}</t></is></c>' for i, v in enumerate(values))
        return f'<row r="{number}">{"".join(cells)}</row>'

    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, package = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/package/2006"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="{_xml(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'{head}<worksheet xmlns="{main}"><sheetData>{row(1, columns)}'.encode())
            for r in out.toLocalIterator():
                rows += 1
                f.write(row(rows + 1, r).encode())
            f.write(b"</sheetData></worksheet>")
    return rows


def _xml(text: str) -> str:
    """Escaped, without characters that XML cannot hold."""
    return escape("".join(c for c in text if c in "\t\n\r" or c >= " " and c not in "\ufffe\uffff"), {'"': "&quot;"})


def summary_json(summary: dict) -> str:
    return json.dumps(summary, ensure_ascii=False, indent=2, default=str)
