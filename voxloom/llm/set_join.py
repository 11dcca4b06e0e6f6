"""Exact join of sets by Jaccard similarity of SIMILARITY or more, DataFrame only.

Sets are sorted arrays of hashes. Two sets that similar share one of the
lowest fifth of each (the prefix), in any order of hashes that is the same for
all. Hashes that are common in a sample come last, so that what many texts have
in common makes no pairs; the sample decides the order alone. Rows of the
prefixes meet by hash, and hashes that only one set has are left out. Beyond the hashes that prefixes
share, at most the rest of one set can be shared; pairs that cannot reach the
similarity even so are dropped, the others are verified with whole sets. No
pair is lost: no set or hash is sampled, sketched or capped.

Whole sets take twice the room of the texts, so only prefixes are kept, and
the sets of the pairs to verify are made again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from voxloom.llm.common import connected_components, discard, materialize, release

SHINGLE = 5
NUM, DEN = 4, 5  # SIMILARITY as a fraction, so that its comparison is exact
SIMILARITY = NUM / DEN
BROADCAST_IDS = 2_000_000
SAMPLE = 1 << 15  # texts at most whose hashes tell which are common
COMMON, MOST_COMMON = 3, 1 << 18

Whole = Callable[[DataFrame], DataFrame]  # (id, sh), the whole sets, of a table of ids


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): of lower-cased texts the sorted distinct hashes of the
    word shingles, one text after the other; of fewer words, the hash of all;
    of none, no hash."""
    for c in "\t\n\v\f\r":
        if pc.any(pc.match_substring(texts, c)).as_py():
            texts = pc.replace_substring(texts, c, " ")
    split = pc.split_pattern(texts, " ")
    words, row = pc.dictionary_encode(split.flatten()), np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    hashes = np.fromiter((xxh64_intdigest(w, 42) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    at = words.indices.to_numpy()
    held = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)[at]
    if not held.all():
        at, row = at[held], row[held]
    word, count = hashes[at], np.bincount(row, minlength=len(texts))
    end, n = np.cumsum(count), len(word)
    out = word * np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, shingle):  # past a text's end too, which is dropped below
        x = out[:max(n - k, 0)]
        x ^= x >> np.uint64(29)
        x += word[k:]
        x *= np.uint64(0x9E3779B97F4A7C15)
    for i in np.flatnonzero((count > 0) & (count < shingle)).tolist():
        out[end[i] - count[i]] = xxh64_intdigest(word[end[i] - count[i]:end[i]].tobytes(), 42)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    whole = np.repeat(end - np.minimum(count, shingle), count) >= np.arange(n)
    out, row = out[whole], row[whole]
    stops = np.cumsum(np.bincount(row, minlength=len(texts)))
    for i, j in zip([0, *stops[:-1].tolist()], stops.tolist()):
        out[i:j].sort()
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new].view(np.int64), np.bincount(row[new], minlength=len(texts))


def common_hashes(hashes: DataFrame) -> np.ndarray:
    """The hashes of column key that COMMON rows or more have, at most
    MOST_COMMON of them, the rarest first."""
    found = hashes.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") >= COMMON).orderBy(F.desc("c"), "key").limit(MOST_COMMON).toPandas()
    return found["key"].to_numpy(np.int64)[::-1].copy()


class Order:
    """The order of hashes by which prefixes are the lowest: common ones come
    last, the most common at the end, all others by their value."""

    def __init__(self, common: np.ndarray):
        self.rank = np.argsort(common, kind="stable")
        self.common = common[self.rank]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[common & ((1 << 22) - 1)] = True

    def prefixes(self, flat: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, sizes) of the prefixes of sets."""
        size = np.where(n > 0, n - (n * NUM + DEN - 1) // DEN + 1, 0)
        at = np.flatnonzero(self.maybe[flat & ((1 << 22) - 1)])
        place = np.searchsorted(self.common, flat[at])
        hit = self.common[np.minimum(place, max(len(self.common) - 1, 0))] == flat[at] if len(self.common) else np.zeros(0, bool)
        if hit.any():
            rank = np.zeros(len(flat), np.int64)
            rank[at[hit]] = self.rank[place[hit]] + 1
            flat = flat[np.argsort(np.repeat(np.arange(len(n)), n) << 32 | rank, kind="stable")]
        return flat[np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n) < np.repeat(size, n)], size


def list_array(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))


def prefixes(sets: DataFrame) -> DataFrame:
    """(id, n, key): the hashes of each prefix that another set's prefix has
    too."""
    rows = sets.where("n > 0").select("id", "n", F.explode("pre").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    found = materialize(rows.join(shared, "key", "left_semi"), "prefixes")
    del rows, shared
    release(sets.sparkSession)
    return found


def verified(met: DataFrame, whole: Whole) -> DataFrame:
    """(u, v) of met(u, nu, v, nv, a row for each shared hash) that are similar
    enough."""
    past = F.expr(f"(greatest(nu, nv) * {NUM} + {DEN - 1}) div {DEN} - 1")  # hashes after the longer prefix
    near = met.groupBy("u", "v", "nu", "nv").agg(F.count("*").alias("c")).where((F.col("c") + past) * (NUM + DEN) >= (F.col("nu") + F.col("nv")) * NUM)
    return similar(near.select("u", "v", "nu", "nv"), whole)


def similar(pairs: DataFrame, whole: Whole) -> DataFrame:
    """(u, v) of pairs(u, v, nu, nv) that are similar enough, by whole sets."""
    cand = materialize(pairs, "similar")
    wanted = materialize(cand.select(F.col("u").alias("id")).unionByName(cand.select(F.col("v").alias("id"))).distinct(), "wanted")
    held = materialize(whole(wanted), "held")
    release(wanted.sparkSession)
    both = (cand.join(held.select(F.col("id").alias("u"), F.col("sh").alias("a")), "u").join(held.select(F.col("id").alias("v"), F.col("sh").alias("b")), "v")
            .select("u", "v", "nu", "nv", F.size(F.array_intersect("a", "b")).alias("c")))
    near = materialize(both.where(F.col("c") * DEN >= (F.col("nu") + F.col("nv") - F.col("c")) * NUM).select("u", "v"), "near")
    for table in (cand, wanted, held):  # sets are large, so they go before others are held
        discard(table)
    del both
    release(near.sparkSession)
    return near


def _sides(rows: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    cols = lambda s: [F.col("id").alias(s), F.col("n").alias(f"n{s}"), *[F.col(c).alias(f"{c}_{s}") for c in more]]
    return rows.select("key", *cols("u")), rows.select("key", *cols("v"))


SIZES = f"nu * {DEN} >= nv * {NUM} AND nv * {DEN} >= nu * {NUM}"


def similar_pairs(sets: DataFrame, whole: Whole) -> DataFrame:
    """All pairs (u, v), u < v, of sets(id, n, pre) that are similar enough."""
    u, v = _sides(prefixes(sets))
    return verified(u.join(v, "key").where("u < v").where(SIZES), whole)


def similar_components(sets: DataFrame, whole: Whole, linked: DataFrame | None = None) -> DataFrame:
    """(node, component) of the graph of all similar pairs; sets without a
    neighbour are left out. linked: pairs (u, v) that are known to be similar.

    Sets of a hash meet only if they are in different components so far: first
    the lowest of them meets the others, so that large groups need no pairs of
    their own, then those that are apart even so."""
    rows = prefixes(sets)
    edges = sets.sparkSession.createDataFrame([], "u long, v long") if linked is None else linked
    for stars in (True, False):
        comp = connected_components(edges)
        named = rows.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("g", F.coalesce("component", "id")).drop("component")
        mixed = named.groupBy("key").agg(F.min("g").alias("a"), F.max("g").alias("b")).where("a < b").select("key")
        u, v = _sides(materialize(named.join(mixed, "key", "left_semi"), "mixed"), "g")
        if stars:
            u = u.groupBy("key").agg(F.min(F.struct("u", "nu", "g_u")).alias("m")).select("key", "m.*")
        found = verified(u.join(v, "key").where("u < v AND g_u <> g_v").where(SIZES), whole)
        edges = materialize(edges.unionByName(found), "linked")
    return connected_components(edges)
