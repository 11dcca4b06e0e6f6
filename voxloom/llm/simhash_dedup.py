"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints are the leaves of a binary trie. Pairs of trie nodes are
traversed together from the root; each pair carries the bits its prefixes
differ in and is dropped once they exceed the error budget. The top of the
trie is cut into blocks of a bounded number of fingerprints: a block meets
every block whose prefix lies within the budget, and crowded blocks are cut
again into chunk pairs, so no task holds more than two chunks. Exact copies
collapse to one leaf before the join. Tasks return a spanning forest of the
links they find, never all pairs of a group.

Defined results: null text counts as empty; an empty text has fingerprint
zero and is linked like any other; repeated rows are kept as they are; a
component of null ids only has a null id; an empty table gives no rows; only
the two named columns are read, whatever else the table holds.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from voxloom.llm import set_join
from voxloom.llm.common import connected_components, discard, free_names, materialize, release, scratch

CHUNK = 8192  # fingerprints of one side that a task holds
FRONTIER = 1 << 18  # node pairs expanded at once


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of one text (see op2's contract)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    norm = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxh64_intdigest(norm, 42)]
    else:
        ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
        starts = [0, *[e + 1 for e in ends]]
        hashes = [xxh64_intdigest(norm[a:b], 42) for a, b in zip(starts, ends[shingle - 1:])]
    ones, n = np.zeros(64, np.int64), len(hashes)
    for i in range(0, n, 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(x, shingle) for x in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t")).mapInArrow(run, "doc_id long, fp long")


def forest(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the components of the edges among n nodes."""
    root = np.arange(n)
    while True:
        a, b = root[u], root[v]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        if (lo == hi).all():
            break
        np.minimum.at(root, hi, lo)
        while (root[root] != root).any():
            root = root[root]
    kept = np.flatnonzero(root != np.arange(n))
    return kept, root[kept]


def trie_pairs(a: np.ndarray, b: np.ndarray, budget: int, depth: int = 0):
    """Yield arrays (i, j) of indexes of sorted distinct uint64 a and b within
    budget bits, by walking both tries together. All of a share their first
    depth bits, and so do all of b."""
    one = np.uint64(1)
    sums = [{}, {}]

    def ones(k, bit):
        if bit not in sums[k]:
            x = (a, b)[k]
            sums[k][bit] = np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & one, dtype=np.int64)])
        return sums[k][bit]

    if not len(a) or not len(b):
        return
    top = bin(int((a[0] ^ b[0]) >> np.uint64(64 - depth))).count("1") if depth else 0
    stack = [(63 - depth, np.array([[0], [len(a)], [0], [len(b)], [budget - top]]))] if top <= budget else []
    while stack:
        bit, f = stack.pop()
        if f.shape[1] > FRONTIER:
            stack += [(bit, f[:, i:i + FRONTIER]) for i in range(0, f.shape[1], FRONTIER)]
            continue
        leaf = (f[1] - f[0] == 1) & (f[3] - f[2] == 1)
        if bit < 0 or leaf.any():
            if bit < 0:
                leaf[:] = True
            i, j = f[0, leaf], f[2, leaf]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if near.any():
                yield i[near], j[near]
            f = f[:, ~leaf]
        if bit < 0 or not f.shape[1]:
            continue
        oa, ob = ones(0, bit), ones(1, bit)
        ma, mb = f[1] - (oa[f[1]] - oa[f[0]]), f[3] - (ob[f[3]] - ob[f[2]])
        out = []
        for x0, x1, y0, y1, cost in ((f[0], ma, f[2], mb, 0), (ma, f[1], mb, f[3], 0), (f[0], ma, mb, f[3], 1), (ma, f[1], f[2], mb, 1)):
            left = f[4] - cost
            ok = (x0 < x1) & (y0 < y1) & (left >= 0)
            out.append(np.stack([x0[ok], x1[ok], y0[ok], y1[ok], left[ok]]))
        f = np.concatenate(out, axis=1)
        if f.shape[1]:
            stack.append((bit - 1, f))


def links(distinct_fps: DataFrame, budget: int = 2, chunk: int = CHUNK) -> DataFrame:
    """A spanning set of links (u, v) between the distinct fingerprints of
    column fp that differ in at most budget bits."""
    fps = distinct_fps.select("fp")
    n = fps.count()
    p = min(max((max(n, 1) * 4 // chunk).bit_length(), 3), 24)  # a block has a quarter of a chunk on average
    masks = [sum(1 << i for i in c) for k in range(budget + 1) for c in combinations(range(p), k)]
    own = fps.select("fp", F.shiftrightunsigned("fp", 64 - p).alias("block"))
    guest = (own.select("fp", "block", F.explode(F.array(*[F.lit(m).cast("long") for m in masks if m])).alias("mask"))
             .select("fp", F.col("block").bitwiseXOR(F.col("mask")).alias("to"), "block").where("to > block")
             .select("fp", F.col("to").alias("block"), F.lit(1).alias("role")))
    rows = own.select("fp", "block", F.lit(0).alias("role")).unionByName(guest).unionByName(own.select("fp", "block", F.lit(2).alias("role")))
    sizes = (rows.groupBy("block").agg(F.sum((F.col("role") == 0).cast("long")).alias("na"), F.sum((F.col("role") > 0).cast("long")).alias("nb"))
             .select("block", F.ceil(F.col("na") / chunk).alias("ka"), F.ceil(F.col("nb") / chunk).alias("kb")).where("ka > 0"))
    h = F.pmod(F.xxhash64("fp"), F.lit(1 << 20))
    dealt = (rows.join(sizes, "block")
             .select("fp", "role", "block", F.when(F.col("role") == 0, F.pmod(h, F.col("ka"))).otherwise(F.pmod(h, F.col("kb"))).alias("c"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("role") == 0, F.col("kb")).otherwise(F.col("ka")) - 1)).alias("o"))
             .select("fp", "role", "block", F.when(F.col("role") == 0, F.col("c")).otherwise(F.col("o")).alias("i"),
                     F.when(F.col("role") == 0, F.col("o")).otherwise(F.col("c")).alias("j")))

    def pair_up(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, guest_row = pdf["fp"].to_numpy().view(np.uint64), pdf["role"].to_numpy() > 0
        a = np.sort(fp[~guest_row])
        b = np.sort(fp[guest_row])
        nodes = np.unique(fp)
        ia, ib = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
        us, vs, held = [], [], 0
        top = b >> np.uint64(64 - p)
        for t in np.unique(top):  # every guest block is a subtrie of its own
            lo, hi = np.searchsorted(top, t), np.searchsorted(top, t, side="right")
            for i, j in trie_pairs(a, b[lo:hi], budget, p):
                u, v = ia[i], ib[lo + j]
                us.append(u[u != v])
                vs.append(v[u != v])
                held += len(us[-1])
                if held > 4 * FRONTIER:
                    u, v = forest(np.concatenate(us), np.concatenate(vs), len(nodes))
                    us, vs, held = [u], [v], len(u)
        u, v = forest(np.concatenate(us), np.concatenate(vs), len(nodes)) if us else (np.zeros(0, int), np.zeros(0, int))
        return pd.DataFrame({"u": nodes[u].view(np.int64), "v": nodes[v].view(np.int64)})

    return dealt.groupBy("block", "i", "j").applyInPandas(pair_up, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 2, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of docs."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "fps")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    comp = connected_components(links(classes, budget))
    known = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    lead = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    return fps.join(known.join(lead, "component").select("fp", "component_id"), "fp", "left").select("doc_id", "fp", "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: doc_id, fingerprint (16 hex digits), component_id."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def set_links(sets: DataFrame, whole: set_join.Whole, budget: int = 2) -> DataFrame:
    """Pairs (u, v) of sets(id, n, fp) that the trie join finds by fingerprints
    of the sets, and whose Jaccard similarity is high enough."""
    fps = sets.where("n > 0").select("id", "n", "fp")
    lead = F.min(F.struct("id", "n")).alias("m")
    classes = materialize(fps.groupBy("fp").agg(lead, F.count("*").alias("c")).select("fp", F.col("m.id").alias("id"), F.col("m.n").alias("n"), "c"), "classes")
    pair = lambda x: [F.col(f"id_{x}").alias(x), F.col(f"n_{x}").alias(f"n{x}")]
    side = lambda x: classes.select(F.col("fp").alias(x), F.col("id").alias(f"id_{x}"), F.col("n").alias(f"n_{x}"))
    across = links(classes, budget).join(side("u"), "u").join(side("v"), "v").select(*[c for x in "uv" for c in pair(x)])
    within = (fps.join(classes.where("c > 1").select("fp", F.col("id").alias("u"), F.col("n").alias("nu")), "fp").where("id <> u")
              .select("u", "nu", F.col("id").alias("v"), F.col("n").alias("nv")))
    return set_join.similar(across.unionByName(within).select("u", "v", "nu", "nv").where(set_join.SIZES), whole)


def set_fingerprints(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHash of sets of hashes, as signed longs."""
    ends, out = np.cumsum(sizes), np.zeros(len(sizes), np.int64)
    for i in range(0, len(sizes), 256):
        n = sizes[i:i + 256]
        some = np.flatnonzero(n)
        if len(some):
            begin = ends[i] - n[0]
            bits = np.unpackbits(flat[begin:ends[i + len(n) - 1]].astype("<i8").view(np.uint8), bitorder="little").reshape(-1, 64)
            ones = np.add.reduceat(bits, (ends[i:i + 256] - n - begin)[some], axis=0, dtype=np.int64)
            out[i + some] = np.packbits(2 * ones > n[some, None], axis=1, bitorder="little").view("<i8")[:, 0]
    return out


def described(common: np.ndarray):
    """From batches of (row, doc_id, th, lower-cased text) to (row, doc_id, th,
    id, n, fp, pre): id is a hash of the set, pre its prefix."""

    def run(batches):
        order = set_join.Order(common)
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                flat, n = set_join.shingle_sets(part.column(3))
                stops = np.cumsum(n)
                ids = np.fromiter((xxh64_intdigest(flat[a:b].tobytes(), 42) for a, b in zip((stops - n).tolist(), stops.tolist())), np.uint64, len(n))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(ids.view(np.int64)), pa.array(n.astype(np.int32)), pa.array(set_fingerprints(flat, n)), set_join.list_array(*order.prefixes(flat, n))],
                                                 ["row", "doc_id", "th", "id", "n", "fp", "pre"])

    return run


def sampled_hashes(texts: DataFrame) -> DataFrame:
    """(key): the hashes of the sets of an eighth of the texts, at most some
    SAMPLE of them, a text once."""
    step = max(8, texts.count() // set_join.SAMPLE)
    some = texts.where(F.pmod(F.xxhash64("th"), F.lit(step)) == 0).groupBy("th").agg(F.first("t").alias("t"))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                yield pa.RecordBatch.from_arrays([pa.array(set_join.shingle_sets(batch.column(0).slice(i, 2048))[0])], ["key"])

    return some.select("t").mapInArrow(run, "key long")


def whole_sets(batches):
    """(id, sh) of batches of (id, lower-cased text)."""
    for batch in batches:
        for i in range(0, batch.num_rows, 2048):
            part = batch.slice(i, 2048)
            yield pa.RecordBatch.from_arrays([part.column(0), set_join.list_array(*set_join.shingle_sets(part.column(1)))], ["id", "sh"])


def similar_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, th, lead_id, lead_th): one row per row of docs, th being its
    text's hash, and the smallest (doc_id, th) of its group; texts are linked
    whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

    The trie join links the closest sets, those of fingerprints within two
    bits. At a similarity of 0.8 fingerprints differ by some ten bits, and a
    budget that wide prunes nothing, so a prefix join of the sets links what
    is still apart. Null ids are smaller than none, so they lead no group that
    has another id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.lower(text).alias("t"))
    common = set_join.common_hashes(sampled_hashes(texts))
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "th", "t").mapInArrow(described(common), "row long, doc_id long, th long, id long, n int, fp long, pre array<long>")
    rows = materialize(rows, "shingles")
    lead = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))).alias("rep")
    # of equal sets one row stands for all, and where is the least place that has it
    first = materialize(rows.groupBy("id").agg(F.min("row").alias("row"), lead, F.min(F.struct("doc_id", "th")).alias("at")), "first")
    named = rows.select("doc_id", "th", "id")
    if first.count() <= set_join.BROADCAST_IDS:
        sets = rows.join(F.broadcast(first.select("row")), "row", "left_semi")
    else:
        named = materialize(named, "named")
        sets = materialize(rows.join(first.select("row"), "row", "left_semi"), "sets")
        discard(rows)
        release(docs.sparkSession)
    sets = sets.select("id", "n", "fp", "pre")

    def whole(wanted: DataFrame) -> DataFrame:
        at = first.join(wanted, "id", "left_semi").select("id", F.col("at.doc_id").alias("doc_id"), F.col("at.th").alias("th"))
        if wanted.count() <= set_join.BROADCAST_IDS:
            at = F.broadcast(materialize(at, "at"))
        found = texts.join(at, (texts["th"] == at["th"]) & texts["doc_id"].eqNullSafe(at["doc_id"]))
        return found.groupBy("id").agg(F.first("t").alias("t")).mapInArrow(whole_sets, "id long, sh array<long>")

    comp = set_join.similar_components(sets, whole, set_links(sets, whole)).withColumnRenamed("node", "id")
    known = first.select("id", "rep").join(comp, "id", "left").select("id", "rep", F.coalesce("component", "id").alias("component"))
    best = known.groupBy("component").agg(F.min("rep").alias("rep"))
    led = known.select("id", "component").join(best, "component").select("id", F.col("rep.doc_id").alias("lead_id"), F.col("rep.th").alias("lead_th"))
    return named.join(led, "id", "left").select("doc_id", "th", "lead_id", "lead_th")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of similar documents the one with the
    smallest doc_id stays, of equal ids the one whose text has the smallest
    hash; of rows equal in id and text one stays, rows without an id all do.
    An id may stand for several texts, which are judged apart."""
    cols = docs.columns
    i, th = free_names(cols, "i", "th")
    with scratch(spark, "leads"):
        lead = materialize(similar_documents(docs).where("doc_id = lead_id AND th = lead_th").select(F.col("doc_id").alias(i), F.col("th").alias(th)).distinct(), "leads")
    keyed = docs.select("*", F.col("doc_id").cast("long").alias(i), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias(th))
    kept = keyed.join(lead, [i, th], "left_semi").dropDuplicates([i, th])
    return kept.unionByName(keyed.where(F.col(i).isNull())).select(*[F.col(f"`{c}`") for c in cols])
