"""Media columns stored as content-defined chunks.

The payload of a row becomes an 8-bit PCM WAV. A rolling gear hash cuts the
media into chunks; a join of chunk digests tells which chunks occur more than
once. A media row keeps its ordered chunk list and, inline, the chunks that
occur once; repeated chunks live once each in a chunk table. Reading back
joins the chunk list with the chunk table, puts the media together, and
compares its SHA-256 with the one taken before storing.

Chunk payloads are shuffled only if they are repeated. Whether a chunk is, a
scanning task asks a Bloom filter of fixed size (2**BLOOM_BITS bits): a false
yes sends a single chunk to the chunk table, which changes no result.

Defined results: null text counts as empty; an empty text has one padded
block; repeated rows and equal texts have equal values; a null id is kept; an
empty table gives no rows; other columns are ignored. Texts of any length are
cut into chunks of at most MAX bytes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import materialize

BLOCK = 576
MIN, MAX, MASK_BITS = 512, 16384, 11
BLOOM_BITS, BLOOM_KEYS = 25, 4
HEADER = 44
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 2024) for b in range(256)], dtype=np.uint32)


def payload_of(text: bytes | None) -> bytes:
    """Text bytes, padded with 255 to a positive multiple of BLOCK."""
    t = text or b""
    return t + b"\xff" * ((-len(t)) % BLOCK if t else BLOCK)


def encode(payload: bytes, rate: int = 8000) -> bytes:
    """8-bit unsigned mono PCM WAV."""
    n = len(payload)
    return b"RIFF" + struct.pack("<I", 36 + n) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", n) + payload


def decode(media: bytes) -> bytes:
    if media[:4] != b"RIFF" or media[36:40] != b"data":
        raise ValueError("not a media value of this store")
    return media[HEADER:HEADER + struct.unpack_from("<I", media, 40)[0]]


def cuts(media: bytes) -> list[int]:
    """Ends of the chunks: where the gear hash of the last 32 bytes has its
    top MASK_BITS bits zero, at least MIN and at most MAX bytes apart."""
    h = GEAR[np.frombuffer(media, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        x = h.copy()
        x[k:] += h[:-k] << np.uint32(k)
        h = x
    ends, last, n = [], 0, len(media)
    for c in (np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + 1).tolist():
        while c - last > MAX:
            last += MAX
            ends.append(last)
        if c - last >= MIN:
            ends.append(c)
            last = c
    while n - last > MAX:
        last += MAX
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def chunks(media: bytes) -> list[tuple[bytes, bytes]]:
    """(digest, bytes) in order."""
    out, a = [], 0
    for b in cuts(media):
        part = media[a:b]
        out.append((hashlib.blake2b(part, digest_size=16).digest(), part))
        a = b
    return out


def feature_of(payload: bytes) -> str:
    """Of the samples around 128: mean, deviation, crossing rate and mean step."""
    x = np.frombuffer(payload, np.uint8)
    up = x >= 128
    step = np.abs(np.diff(x.astype(np.int16)))
    return f"mean={x.mean() - 128:.4f};std={x.std():.4f};cross={(up[1:] != up[:-1]).mean():.6f};step={step.mean():.4f}"


def _keys(digest: bytes) -> list[int]:
    a, b = struct.unpack("<QQ", digest)
    return [((a + i * b) & 0xFFFFFFFFFFFFFFFF) >> (64 - BLOOM_BITS) for i in range(BLOOM_KEYS)]


class Bloom:
    def __init__(self, words: np.ndarray):
        self.words = words

    def __contains__(self, digest: bytes) -> bool:
        return all(int(self.words[k >> 6]) >> (k & 63) & 1 for k in _keys(digest))


def repeated_filter(docs: DataFrame) -> Bloom:
    """Bloom filter of the digests that occur more than once in the table."""

    def digests(batches):
        for batch in batches:
            found = [d for t in batch.column(0).to_pylist() for d, _ in chunks(encode(payload_of(t)))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["digest"])

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([k for d in batch.column(0).to_pylist() for k in _keys(d)], pa.int64())], ["k"])

    twice = docs.select("t").mapInArrow(digests, "digest binary").groupBy("digest").count().where("count > 1").select("digest")
    words = (twice.mapInArrow(keys, "k long").groupBy((F.col("k") / 64).cast("long").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(k % 64 as int))")).alias("bits")).toPandas())  # at most 2**BLOOM_BITS / 64 rows
    out = np.zeros(1 << (BLOOM_BITS - 6), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return Bloom(out)


_RECIPE = "array<struct<digest: binary, size: int, shared: boolean>>"
_RECIPE_ARROW = pa.list_(pa.struct([("digest", pa.binary()), ("size", pa.int32()), ("shared", pa.bool_())]))


def write_store(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(media table, chunk table), both written to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("t"))
    bloom = rows.sparkSession.sparkContext.broadcast(repeated_filter(rows))

    def media_rows(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for t in part.column(1).to_pylist():
                    media = encode(payload_of(t))
                    cut = [(d, p, d in bloom.value) for d, p in chunks(media)]
                    inline = pack.compress(b"".join(p for _, p, s in cut if not s))
                    out.append((hashlib.sha256(media).digest(), len(t or b""), [{"digest": d, "size": len(p), "shared": s} for d, p, s in cut], inline))
                key, size, recipe, inline = zip(*out)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(key, pa.binary()), pa.array(size, pa.int64()), pa.array(recipe, _RECIPE_ARROW), pa.array(inline, pa.binary())],
                                                 ["doc_id", "media_key", "n_bytes", "recipe", "inline"])

    def shared_chunks(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            found = {d: p for t in batch.column(1).to_pylist() for d, p in chunks(encode(payload_of(t))) if d in bloom.value}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([pack.compress(p) for p in found.values()], pa.binary())], ["digest", "chunk"])

    media = materialize(rows.mapInArrow(media_rows, f"doc_id long, media_key binary, n_bytes long, recipe {_RECIPE}, inline binary"), "media")
    table = materialize(rows.mapInArrow(shared_chunks, "digest binary, chunk binary").groupBy("digest").agg(F.first("chunk").alias("chunk")), "chunks")
    return media, table


_READ = "media_key binary, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks int, n_shared int"


def _read_rows(batches):
    """Put media together, verify it, and describe what was read. Columns:
    media_key, n_bytes, recipe, inline, parts [(index, chunk)]."""
    unpack = zstandard.ZstdDecompressor()
    names = [x.split()[0] for x in _READ.split(", ")]
    for batch in batches:
        out = []
        for key, n, recipe, inline, parts in zip(*(c.to_pylist() for c in batch.columns)):
            inline, at, media = unpack.decompress(inline), 0, []
            got = {p["i"]: p["chunk"] for p in parts or ()}
            for i, c in enumerate(recipe):
                if c["shared"]:
                    media.append(unpack.decompress(got[i]))
                else:
                    media.append(inline[at:at + c["size"]])
                    at += c["size"]
            media = b"".join(media)
            sha = hashlib.sha256(media)
            if sha.digest() != key:
                raise ValueError("a stored media value does not match its digest")
            payload = decode(media)
            out.append((key, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), sha.hexdigest(), feature_of(payload), len(recipe), len(got)))
        cols = list(zip(*out)) or [[] for _ in names]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)


def read_store(media: DataFrame, table: DataFrame) -> DataFrame:
    """One verified row for each distinct media value."""
    alone = ~F.exists("recipe", lambda c: c["shared"])
    # a media value without shared chunks occurs once, or its chunks would be shared
    whole = media.where(alone).select("media_key", "n_bytes", "recipe", "inline", F.lit(None).cast("array<struct<i: int, chunk: binary>>").alias("parts"))
    mixed = materialize(media.where(~alone).groupBy("media_key").agg(F.first("n_bytes").alias("n_bytes"), F.first("recipe").alias("recipe"), F.first("inline").alias("inline")), "mixed")
    wanted = mixed.select("media_key", F.posexplode("recipe").alias("i", "c")).where("c.shared").select("media_key", "i", F.col("c.digest").alias("digest"))
    parts = wanted.join(table, "digest").groupBy("media_key").agg(F.collect_list(F.struct("i", "chunk")).alias("parts"))
    joined = mixed.join(parts, "media_key").select("media_key", "n_bytes", "recipe", "inline", "parts")
    return whole.mapInArrow(_read_rows, _READ).unionByName(joined.mapInArrow(_read_rows, _READ))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: media columns of every document, read back from the store."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    media, table = write_store(docs)
    read = materialize(read_store(media, table), "read")
    return media.select("doc_id", "media_key").join(read, "media_key").drop("media_key")
