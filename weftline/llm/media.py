"""Media columns in a store of content-defined chunks.

A text becomes a payload of bytes, the payload 8-bit samples of a WAV file (PCM, one
channel, 8 kHz). A rolling gear hash cuts the payload where its high bits are zero, about
every 200 bytes, so equal passages give equal chunks wherever they lie. The header, which
holds the file's lengths, is in no chunk; it follows from the payload. A media row is the
ordered list of its chunks' digests.

Joins on digests tell which chunks several media hold. Such a chunk is kept once, by its
digest; a chunk of one media alone is kept with that media, so most bytes move once.
Equal media are one. Reading joins the shared chunks back by digest and place, verifies
every chunk, writes the header, verifies the whole file, and takes the samples from the
file's data.

Chunks are compressed one by one with a dictionary trained on a bounded sample, so that
they can be stored, deduplicated and joined as plain rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.shared import checkpointed, releasing

UNIT = 64
RATE = 8000
#: The least is the window of the hash.
LEAST_CHUNK, MOST_CHUNK = 64, 16_384
CUT_MASK = np.uint64(((1 << 7) - 1) << 57)
GEAR = V.keyed_table(256, 0x6EA2)
SAMPLE = 2_000
DICTIONARY_BYTES = 65_536
LEVEL = 9
#: Places of a shared chunk for each copy that is sent to them, and copies at most.
SALTED, MOST_SALTS = 500, 65_536
#: Bytes of a digest: 10**12 chunks share one with a probability of 1e-5, and a chunk is verified against its own.
DIGEST = 12


def payload_of(text: bytes) -> bytes:
    return text + bytes(-len(text) % UNIT if text else UNIT)


def wav(payload: bytes) -> bytes:
    """A WAV file whose unsigned 8-bit samples are the payload."""
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8)
    pad = bytes(len(payload) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(fmt) + 8 + len(payload) + len(pad)) + b"WAVE" + fmt + b"data" + struct.pack("<I", len(payload)) + payload + pad


def samples(media: bytes) -> bytes:
    """The samples of a WAV file, found by walking its blocks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at = 12
    while at + 8 <= len(media):
        kind, size = struct.unpack_from("<4sI", media, at)
        if kind == b"fmt " and struct.unpack_from("<HHIIHH", media, at + 8) != (1, 1, RATE, RATE, 1, 8):
            raise ValueError("not 8-bit mono PCM")
        if kind == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data block")


def gear_hashes(buf: np.ndarray) -> np.ndarray:
    """h = (h << 1) + GEAR[byte] at every byte, by doubling; a byte leaves after 64 steps."""
    h = GEAR[buf]
    for span in (1, 2, 4, 8, 16, 32):
        more = h[:-span] << np.uint64(span)
        h = h.copy()
        h[span:] += more
    return h


def chunk_ends(hashes: np.ndarray) -> list[int]:
    """Ends of the chunks of one payload; hashes may carry what stood before it, as no chunk is under the window but the last."""
    n, ends, start = len(hashes), [], 0
    candidates = np.flatnonzero((hashes & CUT_MASK) == 0) + 1
    while n - start > LEAST_CHUNK:
        i = int(np.searchsorted(candidates, start + LEAST_CHUNK))
        end = min(int(candidates[i]) if i < len(candidates) else n, start + MOST_CHUNK, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=DIGEST).digest()


def _cut(texts: list[bytes]) -> Iterator[tuple[bytes, list[bytes]]]:
    """Media of each text and chunks of its payload."""
    lo = 0
    while lo < len(texts):
        payloads, size = [], 0
        while lo < len(texts) and size < V.SLICE_BYTES:
            payloads.append(payload_of(texts[lo]))
            size += len(payloads[-1])
            lo += 1
        h, at = gear_hashes(np.frombuffer(b"".join(payloads), np.uint8)), 0
        for p in payloads:
            ends = chunk_ends(h[at : at + len(p)])
            at += len(p)
            yield wav(p), [p[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _packer(trained: bytes) -> zstandard.ZstdCompressor:
    """Frames without the marks that all chunks would share."""
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_dict_id=False)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)


def _unpacker(trained: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None, format=zstandard.FORMAT_ZSTD1_MAGICLESS)


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def feature_of(payload: bytes) -> str:
    """Statistics of the samples around their zero, 128, in whole numbers."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"n={len(x)};sum={int(x.sum())};energy={int((x * x).sum())};low={int(x.min())};high={int(x.max())};crossings={crossings}"


def _dictionary(docs: DataFrame) -> bytes:
    """A dictionary from at most about SAMPLE texts; empty where there are too few."""
    n = docs.count()
    picked = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(min(1.0, SAMPLE / max(n, 1)) * (1 << 20)))
    openings = picked.select(F.substring(F.col("text").cast("binary"), 1, MOST_CHUNK).alias("text"))  # bounded rows of bounded size
    parts = sorted(t for t in _texts(openings.toArrow().column(0).combine_chunks()) if t)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes() if len(parts) > 100 else b""
    except zstandard.ZstdError:
        return b""


class Store(NamedTuple):
    """packs: media_id, digests, own (a chunk at each place, empty where it is shared or stands further left);
    chunks: digest, data of those that several media hold; places: media_id, place, digest, salt of these."""

    packs: DataFrame
    chunks: DataFrame
    places: DataFrame
    trained: bytes


def _is_shared(place):
    return F.substring("mask", place + 1, F.lit(1)) == F.lit(b"\x01")


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A byte for each place up to the last one shared, 1 where shared."""
    for b in batches:
        out = []
        for places in b.column(1).to_pylist():
            mask = np.zeros(max(places) + 1, np.uint8)
            mask[places] = 1
            out.append(mask.tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["media_id", "mask"])


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Store]:
    """Media rows (doc_id, n_bytes, media_id, n_chunks), and the store of their chunks."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    trained = _dictionary(base)
    shared = docs.sparkSession.sparkContext.broadcast(trained)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b.column(1))
            cut = [(_digest(m), len(parts)) for m, parts in _cut(texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([m for m, _ in cut], pa.binary()), pa.array([n for _, n in cut], pa.int32())], names=["doc_id", "n_bytes", "media_id", "n_chunks"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = {_digest(m): [_digest(c) for c in parts] for m, parts in _cut(_texts(b.column(1).unique()))}
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.list_(pa.binary()))], names=["media_id", "digests"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _packer(shared.value)
        for b in batches:
            media, digests, chunks = [], [], []
            for m, parts in _cut(_texts(b.column(1).unique())):
                own, first = [_digest(c) for c in parts], set()
                media.append(_digest(m)), digests.append(own)
                chunks.append([b"" if d in first else first.add(d) or pack.compress(c) for d, c in zip(own, parts, strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(media, pa.binary()), pa.array(digests, pa.list_(pa.binary())), pa.array(chunks, pa.list_(pa.binary()))], names=["media_id", "digests", "chunks"])

    rows = base.mapInArrow(releasing(rows_of), "doc_id long, n_bytes long, media_id binary, n_chunks int")
    named = base.mapInArrow(releasing(lists), "media_id binary, digests array<binary>").select(F.xxhash64("media_id").alias("m"), "media_id", F.posexplode("digests").alias("place", "digest"))
    # Two media with one 64-bit hash would each keep a chunk that they share.
    several = named.groupBy("digest").agg(F.min("m").alias("low"), F.max("m").alias("high"), F.count("*").alias("n")).where("low != high")
    several = several.select("digest", F.least(F.lit(MOST_SALTS), F.ceil(F.col("n") / SALTED)).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("media_id"), F.col("salts")).cast("int").alias("salt")
    places = checkpointed(named.join(several, "digest").select("media_id", "place", "digest", salt).distinct())
    masks = places.groupBy("media_id").agg(F.collect_list("place").alias("places")).mapInArrow(_masks, "media_id binary, mask binary")  # at most a text's chunks
    # The filter, which holds always, stands here as the joins below would put it on one side only, and the shuffle of packs would not be shared.
    packs = base.mapInArrow(releasing(packed), "media_id binary, digests array<binary>, chunks array<binary>").where("media_id is not null").dropDuplicates(["media_id"]).join(masks, "media_id", "left")
    own = F.transform("chunks", lambda c, i: F.when(F.coalesce(_is_shared(i), F.lit(False)), F.lit(b"")).otherwise(c))
    given = F.filter(F.arrays_zip("digests", "chunks"), lambda x, i: _is_shared(i) & (F.octet_length(x["chunks"]) > 0))
    given = packs.where("mask is not null").select(F.explode(given).alias("x")).select(F.col("x.digests").alias("digest"), F.col("x.chunks").alias("data"))
    return rows, Store(packs.select("media_id", "digests", own.alias("own")), given.groupBy("digest").agg(F.first("data").alias("data")), places, trained)


def read_media(store: Store) -> DataFrame:
    """media_id and media of each distinct media, put together from the store and verified."""
    trained = store.packs.sparkSession.sparkContext.broadcast(store.trained)
    # A chunk that very many media hold goes out in several copies, each to a part of its places.
    copies = store.places.select("digest", "salt").distinct().join(store.chunks, "digest")
    fetched = store.places.join(copies, ["digest", "salt"], "left").groupBy("media_id").agg(F.collect_list(F.struct("place", "data")).alias("fetched"))  # at most a text's chunks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker(trained.value)
        for b in batches:
            out = []
            for media_id, digests, own, fetched in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                frames = {x["place"]: x["data"] for x in fetched or ()}
                known: dict[bytes, bytes] = {}
                for place, (digest, frame) in enumerate(zip(digests, own, strict=True)):
                    if digest not in known:
                        known[digest] = unpack.decompress(frames.get(place) or frame)
                        if _digest(known[digest]) != digest:
                            raise ValueError("a stored chunk does not match its digest")
                out.append(wav(b"".join(map(known.__getitem__, digests))))
                if _digest(out[-1]) != media_id:
                    raise ValueError("chunks do not give back the media")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["media_id", "media"])

    return store.packs.join(fetched, "media_id", "left").select("media_id", "digests", "own", "fetched").mapInArrow(releasing(run), "media_id binary, media binary")


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs with digests and features of its media as read from the store.

    Null text is empty, and an empty payload is one unit of zeros. Equal texts share one
    media and have equal values. Rows that repeat a doc_id have each their own. An empty
    table gives an empty result; other columns play no part.
    """
    rows, store = store_media(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            media = b.column(1).to_pylist()
            payload = [samples(m) for m in media]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(p) for p in payload], pa.int64()),
                    pa.array([hashlib.sha256(p).digest() for p in payload], pa.binary()),
                    pa.array([zlib.crc32(p[-UNIT:]) for p in payload], pa.int64()),
                    pa.array([len(m) for m in media], pa.int64()),
                    pa.array([hashlib.sha256(m).digest() for m in media], pa.binary()),
                    pa.array([feature_of(p) for p in payload], pa.string()),
                ],
                names=["media_id", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    read = read_media(store).mapInArrow(run, "media_id binary, payload_bytes long, payload_sha256 binary, tail_crc32 long, media_bytes long, media_sha256 binary, feature string")
    out = rows.join(read, "media_id")
    out = out.withColumns({c: F.lower(F.hex(c)) for c in ("payload_sha256", "media_sha256")})
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_chunks")


def op10_media(spark, sf_dir: str) -> DataFrame:
    from weftline.llm.shared import documents

    return media_digests(documents(spark, sf_dir))
