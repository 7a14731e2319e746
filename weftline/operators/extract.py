"""Field extraction by rules, as column expressions, with the evidence for every value."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import lexicon as L
from weftline.functions.text import CORE_FIELDS, MISSING, fold_missing, is_missing, match_first, squeezed, stripped
from weftline.operators.lineage import checkpointed
from weftline.operators.results import ResultTable
from weftline.operators.spellings import with_hits

# Organisation words after a city, cue words, suffixes and titles.
CITY_FALSE_SUFFIXES = ("大学", "学院", "公司", "集团", "银行", "研究院", "研究所", "设计院", "医院", "中学", "小学", "航空", "理工", "师范", "民族")
EMPLOYER_CUES = ("现任", "任职于", "就职于", "供职于", "工作于", "服务于", "任职", "签约", "入职", "进入", "加入", "被录取到", "拿到")
POSITION_CUES = "担任|岗位为|职位为|岗位是|任职|从事|现任"
SUFFIXES = ("有限公司", "股份有限公司", "有限责任公司", "集团有限公司", "科技有限公司", "公司", "集团", "银行", "证券", "保险", "研究院", "研究所", "设计院", "科学院", "大学", "学院", "中学", "小学", "医院", "事务所", "局", "委员会", "中心", "事业部")
TITLES = ("算法工程师", "开发工程师", "软件工程师", "前端工程师", "后端工程师", "测试工程师", "运维工程师", "数据分析师", "产品经理", "项目经理", "客户经理", "助理工程师", "管理培训生", "总经理", "副总经理", "总监", "主管", "董事长", "创始人", "合伙人", "总裁", "副总裁", "首席代表", "主任", "处长", "科长", "会长", "主席", "工程师", "经理", "助理", "专员", "教师", "研究员", "设计师", "分析师", "顾问", "会计", "律师", "公务员", "管培生", "实习生")
LOCATION_PREFIXES = ("在", "于", "了", "的")
CITY_FOLLOWERS = "的一某该这那"
YEAR_PATTERNS = (r"(?U)(\d{4})\s*届", r"(?U)(\d{4})\s*级", r"(?U)(\d{4})\s*年\s*毕业")
#: A group of more spellings than this is matched by an automaton, not by an expression for each.
WIDE = 200
HIT = "struct<value:string,evidence:string>"
WORD = "一-龥A-Za-z0-9()（）·"


def patterns(lexicon: dict, more: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """Regexes of the fields found by cue, with site patterns appended; those that do not compile are skipped."""
    import re

    suffix = L.alternation(SUFFIXES, lexicon.get("employer_suffix", ()))
    cue = L.alternation(EMPLOYER_CUES, lexicon.get("employer_cues", ()))
    title = L.alternation(TITLES, lexicon.get("position_keywords", ()))
    out = {
        "graduation_year": list(YEAR_PATTERNS),
        "employer": [f"(?:{cue})([{WORD}]{{2,30}}?(?:{suffix}))"],
        "position": [f"(?:{POSITION_CUES})(?:[{WORD}]{{2,30}}?(?:{suffix}))?([一-龥A-Za-z0-9]{{0,12}}?(?:{title}))"],
    }
    for field, extra in (more or {}).items():
        for p in extra if field in out else ():
            try:
                re.compile(p)
            except re.error:
                continue
            out[field].append(p)
    return out


def strip_location(c: Column, cities) -> Column:
    """Up to three rounds: leading connectives go, and a leading city that only qualifies what follows."""
    names = "|".join(sorted((rf"\Q{x}\E" for x in cities), key=lambda x: -len(x)))
    for _ in range(3):
        for p in LOCATION_PREFIXES:
            c = F.regexp_replace(c, f"(?s)^{p}(?=.{{2}})", "")
        if names:
            c = F.regexp_replace(c, f"(?s)^(?:{names})(?=[{CITY_FOLLOWERS}].)", "")
    return c


def accepted(hit: Column, value: Column, evidence: Column) -> Column:
    """The hit if its value is not missing and its evidence not blank; else null."""
    return F.when(~is_missing(value) & (F.length(squeezed(evidence)) > 0), hit)


def extract(df: DataFrame, title: str, text: str, lexicon: dict, more: dict[str, list[str]] | None = None) -> DataFrame:
    """df with a struct column `hits`, the core fields, extract_method and evidence.

    Each step is a projection of its own, so that no expression is written out several
    times inside another.
    """
    columns, pats, cities = df.columns, patterns(lexicon, more), lexicon.get("cities", {})
    lexical = ("grade", "degree", "major")
    df = df.withColumns({"_h": squeezed(F.coalesce(F.col(title), F.lit(""))), "_b": squeezed(F.coalesce(F.col(text), F.lit("")))})
    df = df.withColumn("_t", F.concat("_h", "_b"))
    for f in lexical:
        group = lexicon.get(f, {})
        wide = sum(1 + len(aliases) for aliases in group.values()) > WIDE
        df = with_hits(df, "_t", group, f"_m_{f}") if wide else df.withColumn(f"_m_{f}", L.matches(F.col("_t"), group))
    df = df.withColumns(
        {f"_r_{f}": L.best(F.col(f"_m_{f}")) for f in lexical}
        | {f"_r_{f}": match_first(F.col("_b"), pats[f]) for f in ("employer", "position")}
        | {"_r_city": L.match_unless_followed(F.col("_t"), cities, CITY_FALSE_SUFFIXES), "_y1": match_first(F.col("_b"), pats["graduation_year"]), "_y2": match_first(F.col("_h"), pats["graduation_year"])}
    )
    df = df.withColumn("_r_graduation_year", F.coalesce("_y1", "_y2"))
    values = {f: F.col(f"_r_{f}.value") for f in CORE_FIELDS}
    values["graduation_year"] = F.regexp_extract(values["graduation_year"], r"(?U)\d{4}", 0)
    values |= {f: strip_location(values[f], cities) for f in ("employer", "position")}
    df = df.withColumns({f"_v_{f}": v for f, v in values.items()})
    hits = [accepted(F.struct(F.col(f"_v_{f}").alias("value"), F.col(f"_r_{f}.evidence").alias("evidence")), F.col(f"_v_{f}"), F.col(f"_r_{f}.evidence")).alias(f) for f in CORE_FIELDS]
    return merge_hits(df.select(*columns, F.struct(*hits).alias("hits")), ["hits"], ["rule"])


def rule_hits(df: DataFrame, title: str, text: str, lexicon: dict, name: str, more: dict[str, list[str]] | None = None) -> DataFrame:
    """df with the hits of the rules in a struct column of the given name, and nothing merged."""
    kept = [c for c in df.columns if c not in ("hits", "extract_method", "evidence", *CORE_FIELDS)]
    found = extract(df, title, text, lexicon, more)
    return found.withColumnRenamed("hits", name).select(*kept, name)


def merge_hits(df: DataFrame, sources: list[str], methods: list[str]) -> DataFrame:
    """Core fields from hit structs, later sources over earlier ones; the method names all that gave a field."""
    used = [F.lit(False)] * len(sources)
    for f in CORE_FIELDS:
        tries = [F.col(s)[f] for s in reversed(sources)]
        df = df.withColumn(f"_{f}", F.coalesce(*tries))
        for i, s in enumerate(sources):
            used[i] = used[i] | F.col(s)[f].isNotNull()
    kinds = F.array_distinct(F.array_compact(F.array(*[F.when(u, F.lit(m)) for u, m in zip(used, methods, strict=True)])))
    method = F.when(F.size(kinds) == 0, "none").when(F.size(kinds) == 1, F.element_at(kinds, 1)).otherwise("hybrid")
    evidence = F.concat_ws(" | ", *[F.when(F.col(f"_{f}").isNotNull(), F.concat(F.lit(f"{f}="), F.col(f"_{f}.value"), F.lit(" ← "), F.col(f"_{f}.evidence"))) for f in CORE_FIELDS])
    df = df.withColumn("extract_method", method).withColumn("evidence", evidence)
    for f in CORE_FIELDS:
        df = df.withColumn(f, F.coalesce(F.col(f"_{f}.value"), F.lit(MISSING))).drop(f"_{f}")
    return df


def content_kind(declared: Column, text: Column, images: Column, least: int = 200) -> Column:
    """The declared kind unless html; html for enough text, ocr for images, else html."""
    return F.when(declared != "html", declared).when(F.length(squeezed(text)) >= least, "html").when(images > 0, "ocr").otherwise("html")


def prompt_text(body: Column, limit: int = 6000) -> Column:
    """White space collapsed; of a longer text the two ends, with the number of characters left out."""
    t = F.trim(F.regexp_replace(body, r"(?U)\s+", " "))
    half = F.lit(limit // 2)
    gap = F.concat(F.lit("\n……（中间省略 "), (F.length(t) - limit).cast("string"), F.lit(" 字）……\n"))
    return F.when(F.length(t) > limit, F.concat(F.left(t, half), gap, F.right(t, half))).otherwise(t)


def supported(evidence: Column, body: Column) -> Column:
    """Does the evidence occur in the body, white space aside?"""
    e = squeezed(evidence)
    return (F.length(e) > 0) & F.contains(squeezed(body), e)


def needs_model(hits: Column, unknown: Column, below: int, enabled: bool = True) -> Column:
    """Is the model asked: it is enabled, a field is unknown, and the rules found fewer than `below`?"""
    return F.lit(enabled) & (unknown > 0) & (hits < below)


def n_hits(hits: Column) -> Column:
    return sum((hits[f].isNotNull().cast("int") for f in CORE_FIELDS), F.lit(0))


def unfenced(reply: Column) -> Column:
    """The body of the first fenced block of a reply, or the reply."""
    inner = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)```", 1)
    return F.trim(F.when(inner != "", inner).otherwise(reply))


def reply_hits(reply: Column, body: Column, wanted: Sequence[str] = CORE_FIELDS) -> Column:
    """Hits of a model's reply: a JSON object of known fields with a value that is not missing and evidence from the body.

    A reply that is no JSON object gives no hits.
    """
    fields = F.from_json(unfenced(reply), "map<string,string>")

    def hit(field: str) -> Column:
        value, evidence = (F.get_json_object(fields[field], f"$.{k}") for k in ("value", "evidence"))
        found = F.struct(fold_missing(value).alias("value"), stripped(evidence).alias("evidence"))
        return F.when(~is_missing(value) & F.coalesce(supported(evidence, body), F.lit(False)), found).cast(HIT).alias(field)

    return F.struct(*[hit(f) if f in wanted else F.lit(None).cast(HIT).alias(f) for f in CORE_FIELDS])


def prompts(title: Column, body: Column, unknown: Column, limit: int = 6000) -> Column:
    """What the model is asked: the fields, the title, and the body within the limit."""
    return F.concat(F.lit("fields: "), F.array_join(unknown, ", "), F.lit("\ntitle: "), F.coalesce(title, F.lit("")), F.lit("\nbody: "), prompt_text(body, limit))


def asking(model: Callable[[str], str], retries: int = 1) -> Callable[[str | None], str | None]:
    """The model with more tries after an error; null for a null prompt, or where every try failed."""

    def ask(text: str | None) -> str | None:
        for _ in range(retries + 1 if text is not None else 0):
            try:
                return model(text)
            except Exception:
                continue
        return None

    return ask


def asked(df: DataFrame, prompt: str, model: Callable[[str], str], retries: int = 1, name: str = "reply", results: ResultTable | None = None, named: str = "") -> DataFrame:
    """df with the model's reply to each prompt; null for a null prompt, or where every try failed.

    The model is called on executors; an error costs the row its reply, no more. With
    results, each distinct prompt is asked for once and its reply is kept there, before df
    goes on; named says which model and settings the replies are of. Without, the model is
    called once a row and try, whenever df is worked out.
    """
    ask = asking(model, retries)
    if results is not None:
        # What led to the prompts is kept, as it is read twice: to ask, and to go on with the replies.
        keyed = checkpointed(df.withColumn("_key", F.when(F.col(prompt).isNotNull(), F.sha2(F.concat_ws("\n", F.lit(named), prompt), 256))))
        replies = results.answers(keyed.select(F.col("_key").alias("key"), F.col(prompt).alias("payload")), ask)
        return keyed.join(replies.select(F.col("key").alias("_key"), F.col("value").alias(name)), "_key", "left").drop("_key")
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            replies = pa.array([ask(t) for t in b.column(columns.index(prompt)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, replies], names=[*columns, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, `{name}` string")


def recognised_once(images: DataFrame, results: ResultTable, recognise: Callable[[bytes], str]) -> DataFrame:
    """Image rows (article_key, place, data) with sha1, text and `cached`, for data.

    An image is known by its bytes: one that results hold, or that occurs again, is not
    read again. An image that cannot be read has no text.
    """
    named = images.withColumn("sha1", F.sha1("data"))
    texts = results.answers(named.select(F.col("sha1").alias("key"), F.col("data").alias("payload")), recognise)
    texts = texts.select(F.col("key").alias("sha1"), F.col("value").alias("text"), "cached")
    return named.join(texts, "sha1", "left").select("article_key", "place", "sha1", "text", F.coalesce("cached", F.lit(False)).alias("cached"))


def cache_counts(cached: Column) -> dict[str, Column]:
    """How many images the cache had, and how many were read."""
    return {"ocr_cached": F.count_if(cached), "ocr_computed": F.count_if(~cached)}


def with_image_text(text: Column, image_text: Column) -> Column:
    """A text with what its images say on lines after it."""
    more = F.when(F.length(F.trim(F.coalesce(image_text, F.lit("")))) > 0, F.trim(image_text))
    return stripped(F.concat_ws("\n", F.coalesce(text, F.lit("")), more))


#: What marks evidence from images, and how far such a hit is trusted.
IMAGE_MARK, IMAGE_CONFIDENCE = "[OCR] ", 0.6


def image_hits(df: DataFrame, title: str, text: str, image_text: str, lexicon: dict, name: str = "image_hits") -> DataFrame:
    """df with the hits that the rules find in the text and that of the images; null fields without image text."""
    has = F.length(F.trim(F.coalesce(F.col(image_text), F.lit("")))) > 0
    columns = df.columns
    found = rule_hits(df.withColumn("_both", with_image_text(F.col(text), F.col(image_text))), title, "_both", lexicon, "_found")
    marked = [F.when(has & F.col("_found")[f].isNotNull(), F.struct(F.col("_found")[f]["value"].alias("value"), F.concat(F.lit(IMAGE_MARK), F.col("_found")[f]["evidence"]).alias("evidence"))).cast(HIT).alias(f) for f in CORE_FIELDS]
    return found.select(*columns, F.struct(*marked).alias(name))


def two_stage(df: DataFrame, title: str, text: str, lexicon: dict, model: Callable[[str], str] | None = None, below: int = len(CORE_FIELDS), retries: int = 1, image_text: str | None = None, more: dict[str, list[str]] | None = None, results: ResultTable | None = None, named: str = "") -> DataFrame:
    """Rules first, then the model for what they left unknown, then the text of images.

    df gains rule_hits, model_hits and image_hits, the core fields, extract_method,
    evidence, content_kind (ocr where images gave a field) and confidence (1, or what
    image hits are trusted at most). Later stages overwrite earlier ones.
    """
    df = rule_hits(df, title, text, lexicon, "rule_hits", more)
    df = df.withColumn("_unknown", F.array_compact(F.array(*[F.when(F.col("rule_hits")[f].isNull(), F.lit(f)) for f in CORE_FIELDS])))
    none = F.struct(*[F.lit(None).cast(HIT).alias(f) for f in CORE_FIELDS])
    if model is None:
        df = df.withColumn("model_hits", none)
    else:
        wanted = needs_model(n_hits(F.col("rule_hits")), F.size("_unknown"), below)
        df = asked(df.withColumn("_prompt", F.when(wanted, prompts(F.col(title), F.col(text), F.col("_unknown")))), "_prompt", model, retries, "_reply", results, named)
        said = reply_hits(F.col("_reply"), F.col(text))
        # Of a reply only fields that were asked for count.
        df = df.withColumn("_said", said).withColumn("model_hits", F.struct(*[F.when(F.array_contains("_unknown", f), F.col("_said")[f]).alias(f) for f in CORE_FIELDS])).drop("_said", "_prompt", "_reply")
    if image_text is None:
        df = df.withColumn("image_hits", none)
    else:
        df = image_hits(df, title, text, image_text, lexicon)
        left = n_hits(F.col("rule_hits")) + n_hits(F.col("model_hits")) < len(CORE_FIELDS)
        df = df.withColumn("image_hits", F.struct(*[F.when(left, F.col("image_hits")[f]).alias(f) for f in CORE_FIELDS]))
    df = merge_hits(df.drop("_unknown"), ["rule_hits", "model_hits", "image_hits"], ["rule", "llm", "rule"])
    by_image = n_hits(F.col("image_hits")) > 0
    kind = F.col("content_kind") if "content_kind" in df.columns else F.lit("html")
    return df.withColumn("content_kind", F.when(by_image, "ocr").otherwise(kind)).withColumn("confidence", F.when(by_image, IMAGE_CONFIDENCE).otherwise(1.0))
