"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Every text becomes the set of its distinct word shingles, as 64-bit hashes. Texts
   with equal sets form one class; from here on a class is one row.
2. The k smallest hashes of a set are its sketch. Two sets of the wanted similarity
   share at least `least_shared` retained values (all but surely, see there), so the
   inverted lists need only a rarest-first prefix of each sketch: a value that very
   many sketches retain stands last and is left out unless the sketch has little else.
3. Each list proposes links to its hub, the member with the most frequent values. A class
   meets its heaviest hub first: the union-sketch estimate of the Jaccard similarity says
   whether there is hope, and the full sets decide. Links that hold join components, so a
   group of n copies costs about n comparisons, and hubs whose lists lie inside one
   component are done.
4. What is left are hubs whose lists reach over several components. Their members near
   the hub are compared by their differences from it, which give their exact similarity, in
   blocks of bounded size that return only links that hold. A member far from the hub of a
   list meets the list's other members by estimate, and on full sets where the estimate
   leaves hope.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.components import components, joined, rooted
from weftline.llm.shared import checkpointed, releasing, swept

MULT = np.uint64(0xD6E8FEB86659FD93)
PAD = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Members of an inverted list that one task compares with one another.
BLOCK = 512
#: Groups that the members of one hub are dealt to where hubs are picked.
SALTS = 32
#: Stands for a null id where one row of a class is named.
_LAST = (1 << 63) - 1


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order; empty without words."""
    with np.errstate(over="ignore"):
        for lo, hi, buf, offs in V.slices(column):
            _, _, doc, h = V.words(buf, offs)
            n = len(h)
            per_doc = np.bincount(doc, minlength=hi - lo)
            if n >= width:
                acc = h[: n - width + 1].copy()
                for j in range(1, width):
                    acc *= MULT
                    acc += h[j : n - width + 1 + j]
                same = doc[: n - width + 1] == doc[width - 1 :]
                sh, d = V.mix64(acc[same]), doc[: n - width + 1][same]
            else:
                sh, d = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            ends = np.cumsum(per_doc)
            short = np.flatnonzero((per_doc > 0) & (per_doc < width))
            if len(short):
                whole = np.zeros(len(short), np.uint64) + per_doc[short].astype(np.uint64)
                for j in range(width - 1):
                    has = per_doc[short] > j
                    at = (ends - per_doc)[short][has] + j
                    whole[has] = whole[has] * MULT + h[at]
                sh, d = np.concatenate([sh, V.mix64(whole)]), np.concatenate([d, short])
            order = np.lexsort((sh, d))
            sh, d = sh[order], d[order]
            keep = np.ones(len(sh), bool)
            keep[1:] = (sh[1:] != sh[:-1]) | (d[1:] != d[:-1])
            sh, d = sh[keep], d[keep]
            cut = np.searchsorted(d, np.arange(hi - lo + 1))
            for i in range(hi - lo):
                yield sh[cut[i] : cut[i + 1]]


def _signature(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, k: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, sig, sketch) of every row; sig and sketch are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sig, sk = [], [], []
            for s in shingle_sets(b.column(1), width):
                n.append(len(s))
                sig.append(_signature(s) if len(s) else None)
                sk.append(s[:k].view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(sk, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "n_shingles", "sig", "sketch"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long"), text, F.xxhash64(text)).mapInArrow(releasing(run), "doc_id long, text_hash long, n_shingles long, sig binary, sketch array<long>")


def least_shared(n: int, k: int, percent: int, loss: float = 1e-7) -> int:
    """Retained values that two sets of the wanted similarity share at least.

    Of the k smallest values of the union, each is common with probability t; fewer
    than the returned number are with a probability under loss. A set no larger than k
    is its own sketch, for which t * n is a bound without exception.
    """
    return max(1, min(_tail_bound(k, percent, loss), -(-n * percent // 100)))


def _tail_bound(k: int, percent: int, loss: float) -> int:
    """The most m for which fewer than m of k values are shared with a probability under loss at the wanted similarity."""
    t, tail, m = percent / 100, 0.0, 0
    while True:
        tail += math.comb(k, m) * t**m * (1 - t) ** (k - m)
        if tail >= loss:
            return m
        m += 1


def _estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates from the k smallest values of each union; rows are padded sketches."""
    k = a.shape[1]
    both = np.sort(np.concatenate([a, b], 1), 1)
    real = both != PAD
    twice = np.zeros_like(real)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~twice, 1)
    shared = (twice & (rank <= k)).sum(1)
    return shared / np.maximum(1, np.minimum(k, rank[:, -1]))


def _matrix(rows: pd.Series, k: int) -> np.ndarray:
    out = np.full((len(rows), k), PAD, np.uint64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = np.asarray(r, np.int64).view(np.uint64)
    return out


def _floor(k: int, percent: int, loss: float = 1e-7) -> float:
    """Estimates under this are hopeless: a pair of the wanted similarity has one with a probability under loss."""
    return _tail_bound(k, percent, loss) / k


def _both_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("sig").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("sig").alias("b"), F.col("members").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")


def _reached(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """Rows of the given hubs; the rows of one hub are dealt to SALTS groups, as one may have a large share of all."""
    salted = hubs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("sig"), F.lit(SALTS)).cast("int")).join(salted, ["hub", "salt"]).drop("salt")


def _members(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets reach the wanted similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for x, y in zip(t.column("set_a"), t.column("set_b"), strict=True):
                both = np.sort(np.concatenate([_members(x), _members(y)]))
                inter = int((both[1:] == both[:-1]).sum())
                ok.append(100 * inter >= percent * (len(both) - inter))
            yield t.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return _both_sets(pairs, sets).mapInArrow(releasing(run), "a binary, b binary")


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, hub b) with the size of a's set, what the two sets do not share, and whether they link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            size, differ, link = [], [], []
            for x, y in zip(t.column("set_a"), t.column("set_b"), strict=True):
                x, y = _members(x), _members(y)
                d = np.setxor1d(x, y, assume_unique=True)
                size.append(len(x)), differ.append(d.tobytes())
                inter = (len(x) + len(y) - len(d)) // 2
                link.append(100 * inter >= percent * (inter + len(d)))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), pa.array(size, pa.int64()), pa.array(differ, pa.binary()), pa.array(link, pa.bool_())], names=["a", "b", "n", "differ", "link"])

    return _both_sets(pairs, sets).mapInArrow(releasing(run), "a binary, b binary, n long, differ binary, link boolean")


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups, as tables with the first row of each group, from rows sorted by the keys."""
    held: list[pa.Table] = []
    for last, b in _with_last(batches):
        t = pa.concat_tables([*held, pa.Table.from_batches([b])]).combine_chunks()
        if not t.num_rows:
            continue
        new = np.ones(t.num_rows, bool)
        same = np.ones(t.num_rows - 1, bool)
        for k in keys:
            c = t.column(k).to_numpy()
            same &= c[1:] == c[:-1]
        new[1:] = ~same
        new = np.flatnonzero(new)
        end = t.num_rows if last else int(new[-1])
        held = [t.slice(end)]
        if end:
            yield t.slice(0, end), new[new < end]


def _near_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links across components between members near one hub, from rows sorted by (hub, p, q, sig).

    |x ^ y| = |dx| + |dy| - 2 |dx & dy| for the differences dx and dy from the hub, and the
    overlaps of all pairs of a block are one matrix product. Of the links of a block, a
    spanning forest over its components is returned.
    """
    for t, first in _grouped(batches, ["hub", "p", "q"]):
        sig, n = t.column("sig").combine_chunks(), t.column("n").to_numpy()
        root, _ = pd.factorize(t.column("root").to_pandas())
        differ = [_members(v) for v in t.column("differ").combine_chunks()]
        a, b = [], []
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), t.num_rows], strict=True):
            size = np.array([len(d) for d in differ[lo:hi]])
            values = np.concatenate(differ[lo:hi])
            owner = np.repeat(np.arange(hi - lo), size)
            _, value, often = np.unique(values, return_inverse=True, return_counts=True)
            twice = often[value] > 1
            _, value = np.unique(value[twice], return_inverse=True)
            owner, shared = owner[twice], np.zeros((hi - lo, hi - lo), np.float32)
            columns = int(value.max()) + 1 if len(value) else 0
            for c in range(0, columns, 2048):
                now = (value >= c) & (value < c + 2048)
                has = np.zeros((hi - lo, 2048), np.float32)
                has[owner[now], value[now] - c] = 1
                shared += has @ has.T
            apart = size[:, None] + size - 2 * np.rint(shared).astype(np.int64)
            total = n[lo:hi, None] + n[lo:hi]
            linked = 100 * (total - apart) >= percent * (total + apart)
            own = root[lo:hi]
            i, j = np.nonzero(np.triu(linked & (own[:, None] != own), 1))
            joined: dict[int, int] = {}

            def top(x: int, joined: dict[int, int] = joined) -> int:
                while joined.get(x, x) != x:
                    x = joined[x]
                return x

            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                u, v = top(int(own[x])), top(int(own[y]))
                if u != v:
                    joined[max(u, v)] = min(u, v)
                    a.append(lo + x), b.append(lo + y)
        yield pa.RecordBatch.from_arrays([sig.take(pa.array(a, pa.int64())), sig.take(pa.array(b, pa.int64()))], names=["a", "b"])


def _far_pairs(batches: Iterator[pa.RecordBatch], k: int, percent: int, floor: float) -> Iterator[pa.RecordBatch]:
    """Hopeful pairs across components with a member far from the hub, from rows sorted by (value, p, q, sig)."""
    for t, new in _grouped(batches, ["value", "p", "q"]):
        end = t.num_rows
        sk, n, root = _matrix(t.column("sketch").to_pandas(), k), t.column("n").to_numpy(), pd.factorize(t.column("root").to_pandas())[0]
        far = t.column("far").to_numpy()
        first = np.repeat(new, np.diff(np.append(new, end)))
        before = np.arange(end) - first
        done = np.concatenate([[0], np.cumsum(before)])
        lo, found = 0, [np.zeros((2, 0), np.int64)]
        while lo < end:
            hi = max(lo + 1, int(np.searchsorted(done, done[lo] + 100_000, side="right")) - 1)
            j = np.repeat(np.arange(lo, hi), before[lo:hi])
            i = np.repeat(first[lo:hi], before[lo:hi]) + V.ragged(before[lo:hi])
            ok = (far[i] | far[j]) & (root[i] != root[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            i, j = i[ok], j[ok]
            if len(i):
                good = _estimates(sk[i], sk[j]) >= floor
                found.append(np.stack([i[good], j[good]]))
            lo = hi
        i, j = np.unique(np.concatenate(found, 1), axis=1)
        sig = t.column("sig").combine_chunks()
        yield pa.RecordBatch.from_arrays([sig.take(pa.array(i)), sig.take(pa.array(j))], names=["a", "b"])


def _with_last(items: Iterator) -> Iterator[tuple[bool, object]]:
    """Each item with whether it is the last."""
    items = iter(items)
    for held in items:
        break
    else:
        return
    for x in items:
        yield False, held
        held = x
    yield True, held


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, k: int = 48, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Documents whose shingle sets satisfy 100 * |intersection| >= percent * |union| are
    linked; component_id is the smallest doc_id that links reach, kept says whether the
    document is that one. Null or empty texts, and texts without words, have no shingles
    and are linked with nothing. Fewer than `width` words make one shingle of all of them.
    Rows that repeat a doc_id are taken as they come, each with its own text; a null
    doc_id takes part, is never a component_id beside others, and is kept only alone.
    An empty table gives an empty result; other columns of docs play no part.
    """
    floor = _floor(k, percent)
    rows = checkpointed(sketches(docs, id_col, text_col, width, k))
    sets_of_rows = rows.where("sig is not null")
    classes = checkpointed(sets_of_rows.groupBy("sig").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "text_hash")).alias("named"), F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))

    values = classes.select("sig", F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    at_most_k = F.least(F.col("n"), F.lit(k))
    needed = F.element_at(F.array(*[F.lit(least_shared(n, k, percent)) for n in range(1, k + 1)]), at_most_k.cast("int"))
    listed = values.join(common, "value").groupBy("sig").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))  # at most k a class
    # Values that no other sketch retains come first in the rarest-first order.
    prefix = at_most_k - needed + 1 - (at_most_k - F.size("shared"))
    postings = (
        classes.join(listed, "sig")
        .withColumn("shared_prefix", F.when(prefix > 0, F.slice("shared", F.lit(1), F.greatest(prefix, F.lit(1)).cast("int"))))
        .where("shared_prefix is not null")
        .select("sig", "named", "n", "sketch", F.aggregate("shared", F.lit(0).cast("long"), lambda s, x: s + x["df"]).alias("weight"), F.transform("shared_prefix", lambda x: x["value"]).alias("prefix"))
    )
    postings = checkpointed(postings)
    swept(docs.sparkSession)

    # A row of each class, by its id and text: rows that share an id meet the class of their own text alone.
    wanted = postings.select(F.col("sig").alias("want"), F.col("named.id").alias("id"), F.col("named.text_hash").alias("text_hash"))

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            members = list(shingle_sets(b.column(1), width))
            found = [i for i, w in enumerate(b.column(0).to_pylist()) if _signature(members[i]) == w]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(found, pa.int64())), pa.array([members[i].tobytes() for i in found], pa.binary())], names=["sig", "members"])

    body = F.col(text_col).cast("string")
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    sets = texts.join(wanted, ["id", "text_hash"]).select("want", "body").mapInArrow(releasing(with_sets), "sig binary, members binary")
    sets = checkpointed(sets.dropDuplicates(["sig"]))
    swept(docs.sparkSession)

    lists = postings.select("sig", "n", "weight", F.explode("prefix").alias("value"))
    hubs = lists.groupBy("value").agg(F.max(F.struct("weight", "sig")).alias("hub"), F.count("*").alias("size")).where("size > 1").select("value", F.col("hub.sig").alias("hub"), F.col("hub.weight").alias("hub_weight"))
    to_hub = checkpointed(lists.join(hubs, "value").select("sig", "value", "hub", "hub_weight"))
    swept(docs.sparkSession)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (_matrix(b.column(c).to_pandas(), k) for c in ("sk_a", "sk_b"))
            yield b.select(["a", "b"]).filter(pa.array(_estimates(x, y) >= floor))

    by_a, by_b = (postings.select(F.col("sig").alias(c), F.col("sketch").alias(f"sk_{c}")) for c in "ab")

    def estimated(pairs: DataFrame) -> DataFrame:
        return pairs.join(by_a, "a").join(by_b, "b").select("a", "b", "sk_a", "sk_b").mapInArrow(releasing(near), "a binary, b binary")

    # Each class meets its heaviest hub first, so that most groups need one comparison a member.
    heaviest = to_hub.where("sig != hub").groupBy("sig").agg(F.max(F.struct("hub_weight", "hub")).alias("best")).select(F.col("sig").alias("a"), F.col("best.hub").alias("b"))
    roots = checkpointed(components(_confirmed(estimated(heaviest), sets, percent)))
    swept(docs.sparkSession)

    # Only hubs whose lists reach over several components are looked at further, with all their members.
    members = to_hub.select("sig", "hub").distinct()
    reach = rooted(members, roots, "sig").groupBy("hub").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 != r2").select("hub")
    close = checkpointed(_differences(estimated(_reached(members, reach).select(F.col("sig").alias("a"), F.col("hub").alias("b"))), sets, percent))
    swept(docs.sparkSession)
    roots = joined(roots, close.where("link and a != b").select("a", "b"))
    swept(docs.sparkSession)

    def in_blocks(rows: DataFrame, key: str, is_open: str) -> DataFrame:
        """Rows of open groups with their blocks: a member of part p meets part q in block (min(p, q), max(p, q))."""
        rows = rooted(rows, roots, "sig")
        groups = rows.groupBy(key).agg(F.count("*").alias("size"), F.min("root").alias("r1"), F.max("root").alias("r2"), F.max("far").alias("any_far"))
        groups = groups.where(is_open).select(key, F.ceil(F.col("size") / BLOCK).cast("int").alias("parts"))
        placed = rows.join(groups, key).withColumn("part", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return placed.withColumn("p", F.least("part", "other")).withColumn("q", F.greatest("part", "other"))

    def dealt(rows: DataFrame, key: str, *more: str) -> DataFrame:
        return rows.repartition(key, "p", "q").sortWithinPartitions(key, "p", "q", "sig").select(key, "p", "q", "sig", "root", *more)

    by_hub = in_blocks(close.select(F.col("a").alias("sig"), F.col("b").alias("hub"), "n", "differ", F.lit(False).alias("far")), "hub", "r1 != r2")
    near_links = dealt(by_hub, "hub", "n", "differ").mapInArrow(releasing(lambda batches: _near_links(batches, percent)), "a binary, b binary")

    open_lists = _reached(to_hub, reach).select("sig", "value", "hub")
    marked = open_lists.join(close.select(F.col("a").alias("sig"), F.col("b").alias("hub"), F.lit(False).alias("far")), ["sig", "hub"], "left").select("sig", "value", F.coalesce("far", F.lit(True)).alias("far"))
    by_value = in_blocks(marked, "value", "r1 != r2 and any_far").join(postings.select("sig", "n", "sketch"), "sig")
    hopeful = dealt(by_value, "value", "far", "n", "sketch").mapInArrow(releasing(lambda batches: _far_pairs(batches, k, percent, floor)), "a binary, b binary").distinct()
    final = joined(roots, near_links.unionByName(_confirmed(hopeful, sets, percent)))

    reps = classes.select("sig", "rep").join(final, F.col("sig") == F.col("node"), "left").select("sig", "rep", F.coalesce("root", "sig").alias("root"))
    lowest = reps.groupBy("root").agg(F.min("rep").alias("component_id"))
    label = reps.join(lowest, "root").select("sig", "component_id")
    out = rows.select("doc_id", "n_shingles", "sig").join(label, "sig", "left")
    component = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op9_minhash(spark, sf_dir: str) -> DataFrame:
    from weftline.llm.shared import documents

    return near_duplicates(documents(spark, sf_dir), percent=85)
