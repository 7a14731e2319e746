"""How far the sources of a language differ in their words, by an inverted index of corrections.

A term is a run of letters (A-Z, a-z and all code points above 127), A-Z folded. Each
language keeps the terms that stand in at least LEAST_DOCUMENTS of its documents. A group,
which is a source of a language or a whole language, gives a kept term the smoothed share
p = 1 + floor(10^9 (count + 1) / (N + V)), N its occurrences of the V kept terms. What a
group with share p differs from one with share q is f(p, q) = floor((p - q)^2 / q).

Most groups lack most terms. So each pair of sources starts at V f(p0, q0) of two zero
counts, and postings add what a nonzero count changes: for a term that one side holds, by
the histogram of its counts, as the change depends on the count alone; for a term that both
hold, by a join of the term's postings. All numbers are integers. Shares add up to at most
10^9 + V and q is 1 or more, so no sum passes 4 (10^9 + V)^2: longs are enough for V up to
5 * 10^8, and a larger sum is an error, not a wrong value.

Null text, lang and source are empty strings. A source without terms is a group as any
other; a language without kept terms has differences of 0. Repeated rows count each by
itself, ids play no part, an empty table gives no rows and other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from weftline.llm import textvec as V
from weftline.llm.shared import checkpointed, documents, releasing

LEAST_DOCUMENTS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
#: Bytes of text that are counted together before Spark adds the counts up.
_SLICE = 4 << 20
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def terms_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The document index and the folded text of each term."""
    buf = V.FOLD[buf]
    mask = _LETTER[buf]
    start, end = V.runs(mask, offs)
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=ends[1:])
    texts = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(buf[mask]))
    return np.searchsorted(offs, start, side="right") - 1, texts.dictionary_encode()


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of each slice of whole texts."""
    for b in batches:
        lang, langs = _codes(b.column(0))
        source, sources = _codes(b.column(1))
        group = lang * len(sources) + source
        for lo, hi, buf, offs in V.slices(b.column(2), _SLICE):
            doc, texts = terms_of(buf, offs)
            size = len(texts.dictionary)
            if not size:
                continue
            held, times = np.unique(doc * size + texts.indices.to_numpy(), return_counts=True)
            key, at = np.unique(group[lo:hi][held // size] * size + held % size, return_inverse=True)
            of, term = np.divmod(key, size)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(of // len(sources))),
                    sources.take(pa.array(of % len(sources))),
                    texts.dictionary.take(pa.array(term)).cast(pa.string()),
                    pa.array(np.bincount(at, times).astype(np.int64)),
                    pa.array(np.bincount(at)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, of_lang, leads) of the kept terms; leads is true in one row of each (lang, term)."""
    counted = docs.select(_text("lang"), _text("source"), _text("text")).mapInArrow(releasing(_count), "lang string, source string, term string, n long, docs long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = W.partitionBy("lang", "term")
    counted = counted.withColumns({"held": F.sum("docs").over(term), "of_lang": F.sum("n").over(term), "leads": F.row_number().over(term.orderBy("source")) == 1})
    return counted.where(F.col("held") >= least).select("lang", "source", "term", "n", "of_lang", "leads")


def share(n: str, total: str, terms: str) -> Column:
    """p of n occurrences in a group of total; null without terms."""
    return F.expr(f"case when {terms} > 0 then 1 + (cast({UNIT} as decimal(20,0)) * ({n} + 1)) div ({total} + {terms}) end")


def differ(p: str, q: str) -> Column:
    """f of two shares."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.cast("int").alias("rank"))


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): the other sources of the language in part `pair`,
    and in part `term` the terms of the source that it holds more of than its language, to rank top.

    Of equal values the item that is first in UTF-8 has the smaller rank. Nulls, repeated
    rows and empty tables: see the module.
    """
    kept = checkpointed(term_counts(docs, least))
    langs = kept.groupBy("lang").agg(F.sum(F.col("leads").cast("long")).alias("terms"), F.sum("n").alias("of_all"))
    held = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(_text("lang"), _text("source")).distinct().join(held, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "of_all")))
    groups = checkpointed(groups.withColumn("zero", F.coalesce(share("0", "total", "terms"), F.lit(1))))

    postings = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "of_lang", "zero", share("n", "total", "terms").alias("p"), share("of_lang", "of_all", "terms").alias("q"))
    terms = postings.where("p > q").select("lang", "source", F.col("term").alias("item"), differ("p", "q").alias("value"))

    mine = groups.select("lang", "source", "zero", "terms")
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("item_zero"))
    base = mine.join(other, "lang").where("source != item").select("lang", "source", "item", (F.col("terms") * differ("zero", "item_zero")).alias("value"))
    # A term of one side alone: all terms of a source with one count change a pair alike.
    alike = postings.groupBy("lang", "source", "zero", "p").agg(F.count("*").alias("m")).join(other, "lang").where("source != item")
    given = alike.select("lang", "source", "item", (F.col("m") * (differ("p", "item_zero") - differ("zero", "item_zero"))).alias("value"))
    taken = alike.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("m") * (differ("item_zero", "p") - differ("item_zero", "zero"))).alias("value"))
    # A term of both sides: what stands in for the two changes above.
    left = postings.select("lang", "term", "source", "zero", "p")
    right = postings.select("lang", "term", F.col("source").alias("item"), F.col("zero").alias("item_zero"), F.col("p").alias("q"))
    both = left.join(right, ["lang", "term"]).where("source != item")
    both = both.select("lang", "source", "item", (differ("p", "q") - differ("p", "item_zero") - differ("zero", "q") + differ("zero", "item_zero")).alias("value"))
    pairs = base.unionByName(given).unionByName(taken).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(terms, "term").where(F.col("rank") <= top))


def op11_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir))


#: The definition as it stands: every kept term in every group.
OP11_SQL = r"""
with docs as (select row_number() over () as row_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (
  select row_id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from docs),
kept as (select lang, term, count(*) as n from words group by lang, term having count(distinct row_id) >= 3),
langs as (select lang, count(*) as terms, sum(n) as total from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select w.lang, w.source, w.term, count(*) as n from words w join kept k on w.lang = k.lang and w.term = k.term group by all),
totals as (select lang, source, sum(n) as total from counts group by all),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.terms)::hugeint as p,
    1 + (1000000000::hugeint * (k.n + 1)) // (l.total + l.terms)::hugeint as q
  from groups g join kept k on g.lang = k.lang join langs l on g.lang = l.lang
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join totals t on t.lang = g.lang and t.source = g.source),
sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source != b.source group by all),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source != b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from shares where n > 0 and p > q)
select lang, source, part, item, value, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
from parts qualify part = 'pair' or rank <= 200
"""
