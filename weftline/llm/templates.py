"""Line deduplication by a log-template tree.

A line is its white-space separated tokens; tokens with a digit are variable fields. The
tree has fixed depth: the number of tokens, then the first DEPTH tokens. In a leaf a line
joins the template that agrees with it in the largest share of positions, at least ALIKE,
and positions that differ become variable; else it starts a template. A template that
lines of `least_documents` or more documents share recurs: its first line in the corpus
stays, all later ones are dropped.

Only hashes of leaves and lines are counted; the text of one line for each distinct line
is fetched, and only in leaves where several lines could form a template. Leaves stream
through tasks one by one; a frequent line is one row there, whatever its count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.shared import buckets, checkpointed, documents, freed, ordered, releasing

DEPTH = 3
ALIKE = 0.7
LEAST_DOCUMENTS = 5
FIELD = "<*>"
#: Groups that the lines of one template are dealt to.
SALTS = 16
_VARIABLE = re.compile(r"\S*\d\S*")
_SPREAD = 1_000_003


def tokens_of(line: str) -> list[str]:
    return (_VARIABLE.sub(FIELD, line) if _VARIABLE.search(line) else line).split()


def _hash(tokens: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x00".join(tokens).encode("utf-8", "surrogatepass")) - (1 << 63)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns: list[list] = [[], [], [], [], []]
        for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            seen = set()
            for i, line in enumerate(text.as_py().split("\n")):
                if tokens := tokens_of(line):
                    h = _hash(tokens)
                    for c, x in zip(columns, (_hash([str(len(tokens)), *tokens[:DEPTH]]), h, key, i, int(h not in seen)), strict=True):
                        c.append(x)
                    seen.add(h)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["leaf", "line", "order_key", "line_no", "counts"])


def _lines_of(docs: pa.Table, wanted: pa.Table) -> pa.Table:
    """Texts of wanted lines, from the documents of one bucket."""
    if not docs.num_rows or not wanted.num_rows:
        return pa.table({c: pa.array([], t) for c, t in (("leaf", pa.int64()), ("line", pa.int64()), ("n", pa.int64()), ("first_key", pa.int64()), ("first_no", pa.int64()), ("text", pa.string()))})
    at = {k: i for i, k in enumerate(docs.column("order_key").to_pylist())}
    split: dict[int, list[str]] = {}
    text = []
    column = docs.column("text")
    for key, no in zip(wanted.column("first_key").to_pylist(), wanted.column("first_no").to_pylist(), strict=True):
        if key not in split:
            split[key] = column[at[key]].as_py().split("\n")
        text.append(split[key][no])
    return wanted.select(["leaf", "line", "n", "first_key", "first_no"]).append_column("text", pa.array(text, pa.string()))


class Leaf:
    """Templates of one leaf, in the order in which they were started."""

    def __init__(self) -> None:
        self.templates: list[list[str]] = []
        self.having: dict[tuple[int, str], list[int]] = {}  # templates with a token at a position

    def place(self, tokens: list[str]) -> int:
        """The template that the line joins, changed to cover it."""
        agree: dict[int, int] = {}
        for at in enumerate(tokens):
            for t in self.having.get(at, ()):
                if self.templates[t][at[0]] == at[1]:
                    agree[t] = agree.get(t, 0) + 1
        best = max(agree, key=lambda t: (agree[t], -t), default=None)
        if best is None or agree[best] < ALIKE * len(tokens):
            best = len(self.templates)
            self.templates.append(list(tokens))
            for at in enumerate(tokens):
                self.having.setdefault(at, []).append(best)
        else:
            template = self.templates[best]
            for i, t in enumerate(tokens):
                if template[i] != t:
                    template[i] = FIELD
        return best


def _cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaf, line and template number, from rows sorted by leaf, frequency and place."""
    leaf, current = Leaf(), None
    for b in batches:
        number = []
        for key, line in zip(b.column("leaf").to_pylist(), b.column("text").to_pylist(), strict=True):
            if key != current:
                leaf, current = Leaf(), key
            number.append(leaf.place(tokens_of(line)))
        yield pa.RecordBatch.from_arrays([b.column("leaf"), b.column("line"), b.column("n"), b.column("first_key"), b.column("first_no"), pa.array(number, pa.int64())], names=["leaf", "line", "n", "first_key", "first_no", "template"])


def _rebuild(docs: pa.Table, drops: pa.Table, carry: tuple[str, ...]) -> pa.Table:
    gone: dict[int, set[int]] = {}
    for key, no in zip(drops.column("order_key").to_pylist(), drops.column("line_no").to_pylist(), strict=True) if drops.num_rows else ():
        gone.setdefault(key, set()).add(no)
    n_lines, dropped, text = [], [], []
    for key, t in zip(docs.column("order_key").to_pylist(), docs.column("text"), strict=True):
        lines, out = t.as_py().split("\n"), gone.get(key, ())
        n_lines.append(len(lines)), dropped.append(len(out))
        text.append("\n".join([x for i, x in enumerate(lines) if i not in out]) if out else t.as_py())
    return pa.table([docs.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(text, pa.string()), *(docs.column(c) for c in carry)], names=["doc_id", "n_lines", "n_dropped", "text", *carry])


def _of_templates(lines: DataFrame, templates: DataFrame) -> DataFrame:
    """Lines joined to some of the templates; the lines of one template are dealt to SALTS groups."""
    salted = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return lines.withColumn("salt", F.pmod(F.xxhash64("line"), F.lit(SALTS)).cast("int")).join(salted, ["leaf", "template", "salt"])


def deduplicate_lines(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_dropped, text (the lines that stay), and columns to carry.

    Lines are separated by newlines; blank lines always stay. A template's support is the
    number of distinct documents with one of its lines. The first line of a recurring
    template, by document and place, stays. Null text is empty. Rows that repeat a doc_id
    are documents of their own, in the order of their text, a null id last. An empty table
    gives an empty result; other columns play no part.
    """
    base = ordered(docs, id_col, text_col, carry)
    parts = buckets(docs.sparkSession)

    def part(column: str):
        return F.pmod(F.pmod(column, F.lit(_SPREAD)), F.lit(parts)).cast("int").alias("part")

    keys = checkpointed(base.select("order_key", "text").mapInArrow(releasing(_keys), "leaf long, line long, order_key long, line_no long, counts long"))
    first = F.min(F.struct("order_key", "line_no"))
    lines = keys.groupBy("leaf", "line").agg(F.sum("counts").alias("n"), first.alias("first"))
    leaves = lines.groupBy("leaf").agg(F.sum("n").alias("support"), F.count("*").alias("forms")).where(F.col("support") >= least_documents)
    lines = checkpointed(lines.join(leaves, "leaf").select("leaf", "line", "n", F.col("first.order_key").alias("first_key"), F.col("first.line_no").alias("first_no"), "forms"))

    by_document = base.withColumn("part", part("order_key")).groupBy("part")
    wanted = lines.where("forms > 1").withColumn("part", part("first_key")).groupBy("part")
    texts = by_document.cogroup(wanted).applyInArrow(freed(_lines_of), "leaf long, line long, n long, first_key long, first_no long, text string")
    sorted_leaves = texts.repartition("leaf").sortWithinPartitions("leaf", F.desc("n"), "first_key", "first_no")
    formed = sorted_leaves.mapInArrow(releasing(_cluster), "leaf long, line long, n long, first_key long, first_no long, template long")
    formed = checkpointed(formed.unionByName(lines.where("forms = 1").select("leaf", "line", "n", "first_key", "first_no", F.lit(0).cast("long").alias("template"))))

    # (document, line) pairs are at least the documents; those of one line are of as many documents.
    grouped = formed.groupBy("leaf", "template").agg(F.sum("n").alias("pairs"), F.max("n").alias("most"), F.min(F.struct("first_key", "first_no")).alias("stays")).where(F.col("pairs") >= least_documents)
    clear = grouped.where(F.col("most") >= least_documents)
    open_lines = _of_templates(formed, grouped.where(F.col("most") < least_documents).select("leaf", "template")).select("leaf", "line", "template")
    documents_of = keys.where("counts = 1").select("leaf", "line", "order_key").join(open_lines, ["leaf", "line"]).select("leaf", "template", "order_key").distinct()
    shared = documents_of.groupBy("leaf", "template").count().where(F.col("count") >= least_documents).select("leaf", "template")
    recurring = clear.unionByName(grouped.join(shared, ["leaf", "template"])).select("leaf", "template", "stays")
    decided = _of_templates(formed, recurring).select("leaf", "line", "stays")
    drops = keys.join(decided, ["leaf", "line"]).where("order_key != stays.first_key or line_no != stays.first_no").select("order_key", "line_no", part("order_key"))
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return by_document.cogroup(drops.groupBy("part")).applyInArrow(freed(lambda d, x: _rebuild(d, x, carry)), f"doc_id long, n_lines long, n_dropped long, text string{kinds}")


def op5_line_templates(spark, sf_dir: str) -> DataFrame:
    return deduplicate_lines(documents(spark, sf_dir))
