"""The versioned table: writers that die, writers at once, what a change writes, and expiry."""

import os
import threading

import pytest

from weftline.functions import text as T
from weftline.sources.store import COLUMNS, Conflict, Store


def article(**more):
    base = dict.fromkeys(COLUMNS, "") | {f: f"v-{f}" for f in T.CORE_FIELDS}
    return base | {"article_key": "k", "source_url": "https://a", "crawl_time": "1"} | more


def articles(spark, *records):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in records], ", ".join(f"{c} string" for c in COLUMNS))


def many(spark, n, **more):
    return articles(spark, *(article(source_url=f"https://{i}", article_key=f"k{i}", **more) for i in range(n)))


def content(store):
    rows = store.read().collect()
    assert len({r.source_url for r in rows}) == len(rows)
    return {r.source_url: (r.city, r.review_status) for r in rows}


class Died(RuntimeError):
    pass


STEPS = ["staged", "merged", "pending", "linked", "published"]


@pytest.mark.parametrize("step", STEPS)
def test_a_writer_killed_at_any_step_stops_nobody(spark, tmp_path, monkeypatch, step):
    folder = str(tmp_path)
    store = Store(spark, folder, buckets=4)
    store.upsert(many(spark, 6, city="old"))
    dying, calls = Store(spark, folder), []

    def die_after(name, at):
        real = getattr(dying, name)

        def run(*args):
            out = real(*args)
            calls.append(name)
            if len(calls) == at:
                raise Died
            return out

        setattr(dying, name, run)

    if step in ("staged", "merged"):
        die_after("_put", 1 if step == "staged" else 2)
    elif step == "published":
        die_after("_publish", 1)
    else:
        real = os.link

        def link(a, b):
            if step == "linked":
                real(a, b)
            raise Died

        monkeypatch.setattr(os, "link", link)
        monkeypatch.setattr(dying._fs.__class__, "delete", lambda *a: (_ for _ in ()).throw(Died()), raising=False)
    with pytest.raises(Died):
        dying.upsert(many(spark, 3, city="new", crawl_time="2"))
    monkeypatch.undo()
    done = step in ("linked", "published")
    assert store.version == (2 if done else 1)
    assert [content(store)[f"https://{i}"][0] for i in range(6)] == (["new"] * 3 if done else ["old"] * 3) + ["old"] * 3
    # All go on: the same upsert again, a status, and a third writer.
    assert store.upsert(many(spark, 3, city="new", crawl_time="2")) == store.version
    assert Store(spark, folder).set_status("k5", "approved") == 1
    assert store.upsert(articles(spark, article(source_url="https://z"))) == store.version
    got = content(store)
    assert len(got) == 7 and got["https://0"] == ("new", "") and got["https://5"] == ("old", "approved")
    store.expire(keep=1, grace_seconds=0)
    assert content(store) == got and os.listdir(tmp_path / "pending") == []
    named = set(store.state().parts.values())
    assert set(os.listdir(tmp_path / "data")) == named and len(os.listdir(tmp_path / "versions")) <= 2  # and a checksum


def test_an_upsert_between_reading_and_writing_a_status_is_kept(spark, tmp_path):
    one, two = Store(spark, str(tmp_path), buckets=1), Store(spark, str(tmp_path))
    one.upsert(many(spark, 2))
    real, done = one._put, []

    def put(*args):
        out = real(*args)
        if not done:
            done.append(two.upsert(articles(spark, article(source_url="https://between", city="kept"))))
        return out

    one._put = put
    assert one.set_status("k1", "approved") == 1
    got = content(one)
    assert done == [2] and one.version == 3 and got["https://between"][0] == "kept" and got["https://1"][1] == "approved"


def test_writers_at_once_lose_nothing(spark, tmp_path):
    Store(spark, str(tmp_path), buckets=4).upsert(many(spark, 8))
    failed = []

    def work(n):
        store = Store(spark, str(tmp_path))
        try:
            for i in range(4):
                if n % 2:
                    assert store.set_status(f"k{i + 4 * (n // 2)}", "approved") == 1
                else:
                    store.upsert(articles(spark, article(source_url=f"https://new-{n}-{i}", city="new")))
        except Exception as e:  # shown by the assertion below
            failed.append(e)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    store = Store(spark, str(tmp_path))
    got = content(store)
    assert failed == [] and store.version == 17
    assert [got[f"https://{i}"][1] for i in range(8)] == ["approved"] * 8
    assert sum(city == "new" for city, _ in got.values()) == 8


def test_a_change_writes_the_buckets_that_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=8)
    store.upsert(many(spark, 200))
    before = store.state()
    assert len(before.parts) == 8
    store.upsert(articles(spark, article(source_url="https://7", city="new", crawl_time="2")))
    after = store.state()
    changed = [b for b in after.parts if after.parts[b] != before.parts[b]]
    assert len(changed) == 1 and len(content(store)) == 200 and content(store)["https://7"][0] == "new"
    (written,) = {after.parts[b] for b in changed}
    assert spark.read.parquet(f"{tmp_path}/data/{written}").count() < 60
    assert store.set_status("k9", "rejected") == 1 and sum(store.state().parts[b] != after.parts[b] for b in after.parts) == 1


def test_a_version_read_stays_as_it_is(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    store.upsert(many(spark, 5, city="old"))
    rows, state = store.read(), store.state()
    store.upsert(many(spark, 5, city="new", crawl_time="2"))
    assert {r.city for r in rows.collect()} == {"old"} == {r.city for r in store.read(state).collect()}
    assert store.expire(keep=5, grace_seconds=0) == 0 and store.expire(keep=1, grace_seconds=3600) == 0
    assert store.expire(keep=1, grace_seconds=0) == 1 and {r.city for r in store.read().collect()} == {"new"}


def test_records_are_worked_out_once_whatever_others_do(spark, tmp_path):
    store, calls = Store(spark, str(tmp_path), buckets=1), spark.sparkContext.accumulator(0)
    store.upsert(many(spark, 2))

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    records = articles(spark, article(source_url="https://n1"), article(source_url="https://n2")).mapInArrow(counted, ", ".join(f"{c} string" for c in COLUMNS))
    real, raced = store._publish, []

    def publish(state):
        if not raced:
            raced.append(Store(spark, str(tmp_path)).upsert(articles(spark, article(source_url="https://other"))))
        return real(state)

    store._publish = publish
    store.upsert(records)
    assert raced == [2] and calls.value == 2 and len(content(store)) == 5


def test_buckets_may_grow_and_a_snapshot_may_be_written_whole(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    assert store.upsert(many(spark, 40)) == 1 and store.rebucket(8) == 2
    assert store.state().buckets == 8 and len(content(store)) == 40
    assert store.upsert(many(spark, 41)) == 3 and len(content(store)) == 41
    assert store.write(many(spark, 3), after=3) == 4 and len(content(store)) == 3
    with pytest.raises(Conflict):
        store.write(many(spark, 1), after=3)
    with pytest.raises(Conflict):
        Store(spark, str(tmp_path)).write(many(spark, 1), after=2)


def test_tables_without_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.version == 0 and store.read().count() == 0 and store.set_status("k", "approved") == 0
    assert store.upsert(articles(spark)) == 1 and store.read().count() == 0
    assert store.upsert(many(spark, 1)) == 2 and store.write(articles(spark)) == 3 and store.read().count() == 0
