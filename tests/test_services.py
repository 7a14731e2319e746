import dataclasses
import json
import sqlite3
import threading
import urllib.error
import urllib.request
import xml.etree.ElementTree as ET
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from weftline import config as settings
from weftline.functions import lexicon as L
from weftline.functions import text as T
from weftline.operators import extract as X
from weftline.operators import records as R
from weftline.operators import search as S
from weftline.operators.textindex import TextIndex
from weftline.services import batch, report
from weftline.services.search import CacheTable, Result, SearchService, fetch_with_candidates, from_payload, to_payload
from weftline.services.server import build_server
from weftline.sources import crawl as C
from weftline.sources import fetch as W
from weftline.operators.results import ResultTable
from weftline.sources.store import COLUMNS, Conflict, Store, export_csv, export_xlsx, read_csv

LIST = "<ul>" + "".join(f'<li class="item"><a href="/a{i}.html">标题{i}</a><span>2025-06-0{i}</span></li>' for i in (1, 2, 3)) + "</ul>"
PAGE = '<html><body><h1>学长分享</h1><div class="content"><p>本人是软件工程专业2025届本科毕业生，大四在读。</p><p>毕业后到北京工作，签约某某科技有限公司。</p><p>担任算法工程师。</p><img src="/i/1.png"></div></body></html>'
EMPTY = '<html><body><h1>通知</h1><div class="content"><p>详见附件。</p></div></body></html>'


class Portal:
    """Answers without a network; keeps what was asked."""

    def __init__(self, answers, landed=None):
        self.answers, self.landed, self.asked = answers, landed, []

    def __call__(self, method, url, headers, body, timeout):
        self.asked.append((method, url, dict(headers), body))
        found = self.answers(url) if callable(self.answers) else self.answers.get(url)
        if found is None:
            return W.Answer(404, b"", "", url)
        if isinstance(found, Exception):
            raise found
        data = found if isinstance(found, bytes) else found.encode()
        return W.Answer(200, data, "", self.landed or url)


def fast():
    return C.Throttle(2.0, lambda: 0.0, lambda s: None)


def config(root=".", **sections):
    raw = {"portal": {"base_url": "https://h", "list_url": "https://h/list", "page_start": 1, "page_end": 0}, "auth": {"method": "cookie", "cookie": "c=1"}}
    for name, section in sections.items():
        raw[name] = raw.get(name, {}) | section
    import pathlib

    return settings.build(raw, pathlib.Path(root))


def portal():
    def answer(url):
        if url.startswith("https://h/list"):
            return LIST if url.endswith("page=1") or url == "https://h/list" else "<html></html>"
        return {"https://h/a1.html": PAGE, "https://h/a2.html": EMPTY, "https://h/i/1.png": b"\x89PNG1"}.get(url)

    return Portal(answer)


# settings


def test_settings_are_typed_and_checked(tmp_path):
    (tmp_path / "config").mkdir()
    file = tmp_path / "config" / "config.yaml"
    file.write_text("portal: {base_url: 'https://h', page_start: '3', unknown: 1}\nrequest: {interval_seconds: 2, retries: '1', verify_tls: 'no'}\nllm:\n", encoding="utf-8")
    (tmp_path / ".env").write_text("# note\nAUTH_COOKIE='a=b'\nexport PORTAL_BASE_URL=https://other\n", encoding="utf-8")
    c = settings.load(file)
    assert (c.portal.base_url, c.portal.page_start, c.portal.page_end, c.request.retries, c.request.verify_tls, c.auth.cookie) == ("https://other", 3, 3, 1, False, "a=b")
    assert c.lexicon["degree"] and c.path("x") == tmp_path / "x"
    bad = [{"portal": {"base_url": "h"}}, {"request": {"interval_seconds": 1}}, {"portal": {"mode": "api"}}, {"portal": {"page_start": 2, "page_end": 1}}, {"search": {"host": "0.0.0.0"}}, {"llm": {"enabled": True}}, {"sampling": {"review_rate": 0}}, {"search": {"port": "x"}}, {"extract": {"rule_first": False}}, {"search": {"fts_tokenizer": "words"}}]
    for sections in bad:
        with pytest.raises(settings.ConfigError):
            config(**sections)
    with pytest.raises(settings.ConfigError):
        settings.load(tmp_path / "none.yaml")
    assert settings.masked("secret") == "***" and settings.masked("abc") == "***" and settings.masked("") == ""


# fetching


def test_texts_are_decoded_by_what_is_known():
    assert W.page_text(W.Answer(200, "页面内容".encode("gb18030"))) == "页面内容"
    assert W.page_text(W.Answer(200, "页".encode(), "iso-8859-1")) == "页"
    assert W.page_text(W.Answer(200, b'<meta charset="gbk">' + "页".encode("gbk"))).endswith("页")
    assert W.page_text(W.Answer(200, "é".encode("latin-1"), "latin-1")) == "é"
    assert W.payload_text(W.Answer(200, "页面内容".encode("gb18030"))) == "页面内容" and W.payload_text(W.Answer(200, b"\xe9"), "latin-1") == "é"


def test_only_exceptions_are_tried_again():
    p = Portal({"https://h/x": OSError("down")})
    client = W.Client(config(), p, fast())
    got = client.get("https://h/x")
    assert not got.ok and "down" in got.error and len(p.asked) == 3
    assert client.get("https://h/missing").status == 404 and len(p.asked) == 4
    assert p.asked[0][2]["Cookie"] == "c=1"


def test_lists_by_dom_and_by_api():
    client = W.Client(config(), portal(), fast())
    refs = list(W.all_refs(client))
    assert [(r["detail_url"], r["title"], r["publish_date"]) for r in refs] == [(f"https://h/a{i}.html", f"标题{i}", f"2025-06-0{i}") for i in (1, 2, 3)]
    payload = {"data": {"records": [{"notice_id": 7, "title": "T", "publishTime": "2025-6-1"}]}}
    p = Portal(lambda url: json.dumps(payload if "currentPage=1" in url else {"data": {"records": []}}))
    api = config(portal={"mode": "api", "api_url": "https://h/api", "detail_url_template": "https://h/d/{notice_id}", "api_body": {"pageSize": 15, "start": 0}, "api_token_field": "t"})
    assert [r["detail_url"] for r in W.all_refs(W.Client(api, p, fast()), "词")] == ["https://h/d/7"]
    for name in ("organization_id", "organizationId", "orgId"):  # what a record lacks comes from the settings
        named = config(portal={"mode": "api", "api_url": "https://h/api", "detail_url_template": f"https://h/{{{name}}}/{{notice_id}}", "detail_org_id": "9"})
        assert [r["detail_url"] for r in W.list_refs(W.Client(named, p, fast()), 1)] == ["https://h/9/7"]
    method, url, headers, _ = p.asked[0]
    assert method == "POST" and "searchValue=%E8%AF%8D" in url and "end=15" in url and "t=0." in url
    with pytest.raises(W.FetchError):
        W.list_refs(W.Client(config(), Portal({}), fast()), 1)
    assert list(W.all_refs(W.Client(config(), Portal({}), fast()))) == []


def test_tokens():
    assert W.random_token().startswith("0.") and len(W.random_token("hex32", 20)) == 20 and len(W.random_token("hex32", 2)) <= 8


def test_details_are_archived_and_replayed(tmp_path):
    client, archive = W.Client(config(tmp_path), portal(), fast()), W.Archive(config(tmp_path))
    ref = {"detail_url": "https://h/a1.html", "list_url": "L", "title": "t", "publish_date": "", "content_url": ""}
    entry = W.fetch_detail(client, archive, ref, "now")
    assert entry["html_path"] == archive.html_path("https://h/a1.html") and archive.page("https://h/a1.html") == PAGE
    assert entry["images"][0]["byte_size"] == 5 and archive.image_paths(entry) == [str(tmp_path / entry["images"][0]["image_path"])]
    assert archive.image_paths({"detail_url": "https://h/a1.html"}) == archive.image_paths(entry)
    failed = W.fetch_detail(client, archive, ref | {"detail_url": "https://h/none"}, "now")
    assert failed["error"] == "HTTP 404" and archive.page("https://h/none") is None
    archive.append(entry)
    archive.append(failed)
    assert len(archive.manifest.read_text(encoding="utf-8").splitlines()) == 2


def test_login_probe(tmp_path):
    check = lambda c, p: W.check_login(W.Client(c, p, fast()))
    ok = Portal({"https://h/list": "<html>welcome</html>"})
    assert check(config(), ok).valid
    assert not check(config(auth={"cookie": ""}), ok).valid
    assert not check(config(auth={"method": "account", "student_id": "1", "password": "2"}), ok).valid
    assert not check(config(), Portal({"https://h/list": "x"}, landed="https://sso/login")).valid
    assert not check(config(), Portal({"https://h/list": '<input type="password">'})).valid
    assert not check(config(), Portal({})).valid
    with pytest.raises(W.LoginError):
        W.require_login(W.Client(config(), Portal({}), fast()))
    c = config(tmp_path)
    assert not W.clear_session(c)
    (tmp_path / "data").mkdir()
    c.path(c.auth.session_file).write_text("{}")
    assert W.clear_session(c) and not c.path(c.auth.session_file).exists()


# model and images


def test_replies_of_a_model(spark):
    body = "张三 签约某某公司，在北京。"
    cases = [
        ('{"city": {"value": "北京", "evidence": "在 北京"}}', {"city": "北京"}),
        ('text ```json\n{"employer": {"value": "某某公司", "evidence": "签约某某公司"}, "x": {"value": "1", "evidence": "张三"}}\n```', {"employer": "某某公司"}),
        ('{"city": {"value": "上海", "evidence": "在上海"}, "degree": {"value": "未知", "evidence": "张三"}, "major": "法学"}', {}),
        ("not json", {}),
        ("[1]", {}),
        (None, {}),
    ]
    df = spark.createDataFrame([(i, r, body) for i, (r, _) in enumerate(cases)], "i int, reply string, body string")
    got = df.select("i", X.reply_hits(F.col("reply"), F.col("body")).alias("h")).collect()
    for r in got:
        assert {f: r.h[f].value for f in T.CORE_FIELDS if r.h[f]} == cases[r.i][1], cases[r.i]


def test_two_stages_with_model_and_images(spark):
    def model(prompt):
        if "boom" in prompt:
            raise RuntimeError("down")
        return '{"city": {"value": "北京", "evidence": "去北漂"}, "grade": {"value": "大四", "evidence": "去北漂"}}'

    rows = [("1", "t", "大三，去北漂", ""), ("2", "boom", "去北漂", ""), ("3", "t", "无", "软件工程专业 2024届"), ("4", "t", "本科", " ")]
    df = spark.createDataFrame(rows, "k string, title string, body string, seen string")
    got = {r.k: r for r in X.two_stage(df, "title", "body", L.load(), model, image_text="seen").collect()}
    assert (got["1"].city, got["1"].grade, got["1"].extract_method) == ("北京", "大三", "hybrid")  # the model was not asked for the grade
    assert (got["2"].city, got["2"].extract_method) == (T.MISSING, "none")
    assert (got["3"].major, got["3"].graduation_year, got["3"].content_kind, got["3"].confidence) == ("软件工程", "2024", "ocr", 0.6)
    assert "[OCR] " in got["3"].evidence and (got["4"].content_kind, got["4"].confidence) == ("html", 1.0)
    few = {r.k: r for r in X.two_stage(df, "title", "body", L.load(), model, below=1).collect()}
    assert few["1"].city == T.MISSING and few["1"].grade == "大三"


def test_images_are_read_once(spark, tmp_path):
    folder = tmp_path / "read"
    folder.mkdir()

    def recognise(data):
        import uuid

        (folder / uuid.uuid4().hex).write_bytes(data)
        if data == b"bad":
            raise ValueError
        return data.decode().upper()

    table = ResultTable(spark, tmp_path / "texts")
    images = spark.createDataFrame([("a", 0, b"one"), ("a", 1, b"two"), ("b", 0, b"one"), ("b", 1, b"bad"), ("c", 0, b"old")], "article_key string, place int, data binary")
    X.recognised_once(images.where("article_key = 'c'"), table, recognise).count()
    rows = X.recognised_once(images, table, recognise)
    for _ in range(2):  # a second action asks nothing
        got = {(r.article_key, r.place): (r.text, r.cached) for r in rows.collect()}
        assert got == {("a", 0): ("ONE", False), ("a", 1): ("TWO", False), ("b", 0): ("ONE", False), ("b", 1): (None, False), ("c", 0): ("OLD", True)}
    assert sorted(p.read_bytes() for p in folder.iterdir()) == [b"bad", b"old", b"one", b"two"]
    again = X.recognised_once(images, table, recognise)
    assert again.where("cached").count() == 4 and len(list(folder.iterdir())) == 5  # what could not be read is tried again


def test_a_failed_task_asks_nothing_again(spark, tmp_path):
    asked_ = tmp_path / "asked"
    asked_.mkdir()

    def ask(text):
        import os
        import uuid

        (asked_ / uuid.uuid4().hex).write_text(text, encoding="utf-8")
        if text == "p7" and not (asked_ / "died").exists():
            (asked_ / "died").write_text("")
            os._exit(1)  # the worker dies in the middle of its task
        return text.upper() + "\n"

    wanted = spark.range(10).selectExpr("sha2(cast(id as string), 256) as key", "concat('p', id) as payload").coalesce(1)
    table = ResultTable(spark, tmp_path / "replies")
    dead = tmp_path / "replies" / "journal" / "dead"
    dead.mkdir(parents=True)
    key_of_3 = wanted.where("payload = 'p3'").first().key
    (dead / key_of_3).write_text("left by a run that died", encoding="utf-8")
    try:
        got = table.answers(wanted, ask)
    except Exception:  # a local master does not try a task again
        got = ResultTable(spark, tmp_path / "replies").answers(wanted, ask)
    for _ in range(2):
        assert sorted(r.value for r in got.collect()) == sorted([f"P{i}\n" for i in range(10) if i != 3] + ["left by a run that died"])
    texts = sorted(p.read_text(encoding="utf-8") for p in asked_.iterdir() if p.name != "died")
    assert texts == sorted([f"p{i}" for i in range(10) if i != 3] + ["p7"])  # p7 had no answer when its worker died
    table.compact()
    assert table.known().count() == 10 and list((tmp_path / "replies" / "journal").glob("*")) == []


def test_the_batch_asks_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def note(kind, answer):
        def run(data):
            import uuid

            (calls / f"{kind}-{uuid.uuid4().hex}").write_text("x")
            return answer

        return run

    c = config(tmp_path, ocr={"enabled": True}, llm={"enabled": True, "provider": "ollama", "model": "m"})
    b = batch.Batch(spark, c, portal(), fast(), model=note("model", "{}"), recognise=note("image", "图片"), login=lambda client: None, today=date(2026, 1, 1))
    b.fetch()
    for _ in range(2):
        result = b.extract()
    count = lambda kind: sum(p.name.startswith(kind) for p in calls.iterdir())
    assert count("image") == 1 and count("model") == 1 and result.counters["ocr_cached"] == 1


# batch


def test_three_stages(spark, tmp_path, capsys):
    (tmp_path / "config").mkdir()
    file = tmp_path / "config" / "config.yaml"
    file.write_text("portal: {base_url: 'https://h', list_url: 'https://h/list', page_end: 0}\nauth: {method: cookie, cookie: 'c=1'}\nocr: {enabled: true}\nsampling: {review_rate: 0.5}\n", encoding="utf-8")
    parts = {"opener": portal(), "throttle": fast(), "login": lambda client: None, "today": date(2026, 1, 1), "recognise": lambda data: "图片"}
    run = lambda *args, **more: batch.main([*args, "--config", str(file), "--json"], lambda: spark, **(parts | more))
    out = lambda: json.loads(capsys.readouterr().out)

    assert run("--stage", "extract") == batch.OK and out()["warnings"]
    assert run("--stage", "fetch") == batch.OK
    got = out()
    assert got["counters"] == {"refs_found": 3, "details_fetched": 2, "details_failed": 1, "images_fetched": 1} and len(got["warnings"]) == 1
    for _ in range(2):  # the second run finds the same, with the image's text known
        assert run("--stage", "extract") == batch.OK
        got = out()["counters"]
    assert (got["entries"], got["entries_failed"], got["records_extracted"], got["stored"], got["manual_review"], got["ocr_cached"]) == (3, 1, 2, 2, 2, 1)  # the short page with an image is to be looked at, too
    store = Store(spark, str(tmp_path / "data/store"))
    rows = {r.source_url: r for r in store.scan().collect()}
    r = rows["https://h/a1.html"]
    assert [r[f] for f in T.CORE_FIELDS] == ["2025", "大四", "本科", "软件工程", "北京", "某某科技有限公司", "算法工程师"]
    assert r.article_key == W.article_key("https://h/a1.html") and r.raw_html_path.endswith(f"{r.article_key}.html") and len(rows) == 2
    assert run("--stage", "export") == batch.OK and out()["counters"] == {"exported_rows": 2, "manual_review": 1}
    found = json.loads((tmp_path / "data/processed/summary.json").read_text(encoding="utf-8"))
    assert found["total"] == 2 and found["complete_records"] == 1 and len(found["sample"]) == 1 and found["extract_method"]["rule"] == 1
    page = (tmp_path / "data/processed/report.html").read_text(encoding="utf-8")
    assert "学长分享" in page and page.index("学长分享") < page.index("通知") and "待复核（1）" in page
    assert "records 2" in report.console(found)
    assert run("--stage", "fetch") == batch.OK and out()["counters"]["skipped_existing"] == 2

    assert batch.main(["--stage", "nothing"]) == batch.USAGE
    assert batch.main(["--stage", "fetch", "--config", str(tmp_path / "none")]) == batch.BAD_CONFIG
    assert run("--stage", "fetch", "--page-start", "0") == batch.BAD_CONFIG
    assert run("--stage", "fetch", login=W.require_login, opener=Portal({})) == batch.NO_LOGIN


def test_targeted_fetch(spark, tmp_path):
    b = batch.Batch(spark, config(tmp_path), portal(), fast(), login=lambda c: None)
    ref = {"detail_url": "https://h/a1.html", "list_url": "L", "title": "点迷津", "publish_date": "", "content_url": ""}
    asked = []

    def list_page(page, keyword):
        asked.append(keyword)
        return [ref, ref | {"detail_url": "https://h/a2.html", "title": "别的"}] if keyword == "点迷津" and page == 1 else []

    got = b.targeted(list_page, S.Query(("职点迷津",), raw_text="职点迷津"))
    assert got == {"pages_fetched": 3, "refs_found": 2, "details_ok": 1, "details_failed": 0, "records_inserted": 1} and asked[0] == "职点迷津"
    assert fetch_with_candidates(lambda p, k: 1 / 0, ["a", "b"], 2) == ([], "b", 0) and fetch_with_candidates(list_page, [], 2) == ([], "", 0)


# store and exports


def article(**more):
    base = dict.fromkeys(COLUMNS, "") | {f: f"v-{f}" for f in T.CORE_FIELDS}
    return base | {"article_key": "k", "source_url": "https://a", "crawl_time": "1", "content_kind": "html", "extract_method": "rule"} | more


def articles(spark, *records):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in records], ", ".join(f"{c} string" for c in COLUMNS))


def test_two_writers_and_status(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.version == 0 and store.read().count() == 0
    store.upsert(articles(spark, article()))
    with pytest.raises(Conflict):
        store.write(articles(spark, article(city="lost")), after=0)
    assert store.version == 1 and store.read().first().city == "v-city"
    assert store.set_status("k", "approved") == 1 and store.read().first().review_status == "approved"
    assert store.set_status("none", "approved") == 0 and store.version == 2
    store.upsert(articles(spark, article(source_url="https://b", crawl_time="2", city=T.MISSING)))
    assert [r.source_url for r in store.scan().collect()] == ["https://b", "https://a"]
    assert [r.source_url for r in store.manual_review().collect()] == ["https://b"]


def test_exports_can_be_read(spark, tmp_path):
    df = articles(spark, article(city='a"b,c\nd'), article(city="<&\x01>", source_url="https://b"))
    export_csv(df, str(tmp_path / "csv"))
    assert {r.city for r in read_csv(spark, str(tmp_path / "csv")).collect()} == {'a"b,c\nd', "<&\x01>"}
    export_csv(df.repartition(2), str(tmp_path / "parts"), one_file=False)
    assert read_csv(spark, str(tmp_path / "parts")).count() == 2
    assert export_xlsx(df.orderBy("source_url"), str(tmp_path / "x.xlsx")) == 2
    with zipfile.ZipFile(tmp_path / "x.xlsx") as z:
        for name in z.namelist():
            ET.fromstring(z.read(name))
        cells = [t.text for t in ET.fromstring(z.read("xl/worksheets/sheet1.xml")).iter() if t.tag.endswith("}t")]
    assert cells[0] == "article_key" and 'a"b,c\nd' in cells and "<&>" in cells


def test_review_sample_takes_the_seeded_rows(spark):
    df = spark.range(200).repartition(7).select((199 - F.col("id")).alias("k"), F.lit("text").alias("t"))
    assert sorted(r.k for r in R.review_sample(df, ["k"], 0.1, 7).collect()) == sorted(R.sample_indices(200, 0.1, 7))


def test_manifest_files_are_ordered_by_time(spark, tmp_path):
    for name, size, entry in (("a", 1, ("u", "new", "2")), ("b", 2000, ("u", "old", "1"))):
        line = json.dumps(dict(zip(("detail_url", "title", "crawl_time"), entry)))
        (tmp_path / f"{name}.jsonl").write_text("\n".join([line, *["{}"] * size]))
    assert [r.title for r in C.read_manifest(spark, str(tmp_path)).collect()] == ["new"]


# search


def test_trigram_scores_equal_fts5(spark):
    texts = ["the cat sat", "a CAT and a cat here", "cats cats", "dogs", "aaaaa", "招聘会公告招聘会", ""]
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE t USING fts5(x, tokenize='trigram')")
    db.executemany("INSERT INTO t(rowid, x) VALUES (?, ?)", list(enumerate(texts)))
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, x string")
    for parts in (["cat"], ["cats"], ["aaa"], ["招聘会"], ["cat", "the"], ["none"]):
        want = dict(db.execute("SELECT rowid, bm25(t) FROM t WHERE t MATCH ?", (" AND ".join(f'"{p}"' for p in parts),)).fetchall())
        got = {r.id: r.score for r in S.bm25(docs, "id", "x", parts, tokenizer="trigram").collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want), parts


def test_stored_index_gives_the_scores_of_bm25(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").cast("string").alias("k"), "text")
    index = TextIndex(spark, str(tmp_path))
    assert index.state() is None and index.maintain(docs, "k", "text", 1) and not index.maintain(docs, "k", "text", 1)
    for phrases in ([["the"], ["was"]], [["of", "the"]], [["der"]], [["nothere"]], [["the", "the"]]):
        want = {r.k: r.score for r in S.bm25(docs, "k", "text", phrases).collect()}
        got = {r.k: r.score for r in index.scores(phrases, "k").collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    index.maintain(docs.where("k = '0'"), "k", "text", 2)
    assert index.state()[:2] == (2, 1)


def test_cache_table(tmp_path):
    now = [100.0]
    table = CacheTable(tmp_path, ttl=10, most=2, clock=lambda: now[0])
    result = Result(S.Query(("x",), {"city": "y"}, 5, 1, "x"), 1, ({"article_key": "1"},), ("r",), {"requests": 1}, 3)
    assert from_payload(to_payload(result)) == result and from_payload("{}") is None and from_payload("x") is None
    table.put("a", result)
    assert table.get("a", 3) == result and table.get("a", 4) is None and table.get("b", 3) is None
    now[0] = 105
    table.put("b", result)
    now[0] = 106
    table.get("a", 3)
    table.put("c", result)
    now[0] = 107
    assert table.prune() == 1 and table.get("b", 3) is None and table.get("a", 3) == result  # b was used longest ago
    now[0] = 111
    assert table.get("a", 3) is None and table.get("c", 3) == result and table.prune() == 1
    assert len(table) == 1 and table.invalidate() == 1 and len(table) == 0
    forever = CacheTable(tmp_path, ttl=0, clock=lambda: now[0])
    forever.put("a", result)
    now[0] = 1e9
    assert forever.get("a", 3) == result


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    s.upsert(articles(spark, article(article_key="1", article_title="甲 北京硕士", city="北京"), article(article_key="2", article_title="校园招聘会公告", source_url="https://b", city="上海", crawl_time="2")))
    return s


def test_tiers_follow_the_version(spark, store, tmp_path):
    service = SearchService(config(), store, tmp_path / "service")
    first = service.search(service.query("北京"))
    assert (first.total, first.source, first.hits[0]["article_key"], first.hits[0]["highlights"]) == (1, "data", "1", ["标题", "城市"])
    assert "<em>北京</em>" in first.hits[0]["snippet"] and "北京" not in first.related and first.suggestion["blocked"] == "disabled"
    assert service.search(service.query("北京")).source == "memory"
    again = SearchService(config(), store, tmp_path / "service")
    assert again.search(again.query("北京")).source == "table" and again.search(again.query("北京")).source == "memory"
    found = service.search(service.query("招聘"))
    assert [(h["article_key"], h["score"]) for h in found.hits] == [("2", 0.0)] and found.total == 1
    assert service.search(service.query("", {"city": "上海"})).hits[0]["article_key"] == "2"
    assert service.search(service.query("北京", limit=1, offset=1)).hits == ()
    store.upsert(articles(spark, article(article_key="3", article_title="北京", source_url="https://c", crawl_time="3")))
    assert service.search(service.query("北京")).source == "data" and service.search(service.query("北京")).total == 2
    assert service.stats()["rows"] == 3 and service.stats()["version"] == 2 and service.stats()["cache_rows"] >= 4


def test_trigram_service(spark, store, tmp_path):
    service = SearchService(config(search={"fts_tokenizer": "trigram"}), store, tmp_path / "s")
    got = service.search(service.query("招聘会"))
    assert got.total == 1 and got.hits[0]["score"] < 0
    assert service.search(service.query("招聘")).hits[0]["score"] == 0.0


def test_jobs_and_cooldown(spark, store, tmp_path):
    now, gate = [1000.0], threading.Event()

    def fetch(query):
        gate.wait(5)
        if query.raw_text == "bad":
            raise RuntimeError("down")
        return {"records_inserted": 2}

    on = config(search={"trigger_enabled": True})
    service = SearchService(on, store, tmp_path / "s", fetch, clock=lambda: now[0])
    job = service.request_fetch(service.query("新词"))
    assert job.job_id and service.job(job.job_id).state in ("pending", "running")
    assert service.request_fetch(service.query("新词")).state == "skipped" and service.cooldown_left("新词") == 900
    assert service.search(service.query("新词")).suggestion["blocked"] == "cooldown"
    now[0] += 1
    bad = service.request_fetch(service.query("bad"))
    gate.set()
    service.close()
    assert (service.job(job.job_id).state, service.job(job.job_id).counters) == ("done", {"records_inserted": 2})
    assert service.job(bad.job_id).state == "failed" and "down" in service.job(bad.job_id).message
    other = SearchService(on, store, tmp_path / "s", fetch, clock=lambda: now[0])
    assert other.latest_job().job_id == bad.job_id and other.job("none") is None
    assert other.request_fetch(other.query(" ")).message == "an empty query fetches nothing"

    def no_login():
        raise W.LoginError("out")

    gated = SearchService(on, store, tmp_path / "t", fetch, no_login, clock=lambda: now[0])
    assert "login" in gated.request_fetch(gated.query("x")).message and gated.cooldown_left("x") == 0
    off = SearchService(config(), store, tmp_path / "u", fetch)
    assert off.request_fetch(off.query("x")).message == "fetching is disabled"


def test_a_disabled_search_is_not_served():
    from types import SimpleNamespace

    with pytest.raises(settings.ConfigError):
        build_server(SimpleNamespace(config=config(search={"enabled": False})), 0)


def test_http_api(spark, store, tmp_path):
    (tmp_path / "web").mkdir()
    (tmp_path / "web" / "index.html").write_text("<p>hi</p>")
    service = SearchService(config(), store, tmp_path / "s")
    server = build_server(service, 0, tmp_path / "web")
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"

    def get(path, data=None):
        try:
            with urllib.request.urlopen(base + path, data=data, timeout=60) as r:
                return r.status, r.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode()

    try:
        status, body = get("/api/search?q=%E5%8C%97%E4%BA%AC&limit=x&city=%E5%8C%97%E4%BA%AC")
        assert status == 200 and json.loads(body)["total"] == 1
        assert get("/api/stats")[0] == 200 and json.loads(get("/api/related?q=x")[1])["related"]
        assert get("/api/fetch") == (200, '{"job": null}') and get("/api/fetch/none")[0] == 404 and get("/api/none")[0] == 404
        assert get("/") == (200, "<p>hi</p>") and get("/../secret")[0] in (403, 404) and get("/%2e%2e/x")[0] in (403, 404)
        assert get("/api/fetch", b"{")[0] == 400 and get("/api/fetch", b"{}")[0] == 400 and get("/api/fetch", b'{"q": "x"}')[0] == 409
        assert get("/api/none", b"{}")[0] == 404
    finally:
        server.shutdown()


def test_each_query_calls_the_library():
    """The queries of the operators, each with what it must call."""
    import inspect

    from weftline.plans import registry

    calls = {
        "bm25_search": "S.bm25", "bm25_phrase": "S.bm25", "trigram_search": "S.bm25", "search_page": "S.search", "search_substring": "S.search", "hit_projection": "S.hits", "cache_key": "S.cache_keys",
        "cache_prune": "R.prune", "page_clamp": "S.clamped", "fetch_estimate": "S.fetch_estimates", "cooldown_remaining": "S.cooldown_left", "html_title": "clean_pages", "html_links": "clean_pages",
        "hit_merge": "X.merge_hits", "hit_acceptance": "X.accepted", "cue_suffix_extract": "X.patterns", "fallback_trigger": "X.needs_model", "reply_validation": "X.reply_hits", "cached_text_rerun": "X.with_image_text",
        "cache_stats": "X.cache_counts", "extract_records": "X.extract", "existing_urls": "R.distinct_values", "json_records_explode": "C.records_column", "title_filter": "C.title_matches", "archive_replay": "C.with_archive",
        "manifest_lines": "C.manifest_entries", "url_class": "C.kind_of", "latest_row": "R.latest", "word_union": "R.value_union", "stage_counters": "R.counters", "benchmark_times": "R.times", "unknown_counts": "R.unknown_totals",
        "scan_sorted": "R.scan_order", "report_cards": "R.report_cards", "report_order": "R.report_order", "hit_source": "R.hit_source", "upsert_by_key": "R.upsert", "review_sample": "R.review_sample",
    }
    queries = registry.queries()
    for name, call in calls.items():
        assert f"{call}(" in inspect.getsource(queries[name]), name
    assert dataclasses.is_dataclass(S.Query)
