"""Benchmark decontamination with SimHash windows, DataFrame only.

A window has as many words as a benchmark item. Only windows that share
enough word shingles with the item, at whatever places, can be similar to it:
a first pass over the texts joins shingle hashes with those of the benchmark,
and every start whose window holds that many of them is tried. Windows and items get 64-bit SimHash
fingerprints of their shingles, weighted by their counts. Fingerprints are
matched by a multi-index: BLOCKS blocks of bits, each probed with all values
within RADIUS // BLOCKS flips, which finds every pair within RADIUS. What is
found is verified with the exact weighted Jaccard similarity of the shingles.

Words are runs of letters and digits, lower-cased; a shingle has five words
(an item of fewer words is one shingle of all its words). Weights are counts.

RADIUS is set so that a pair at the similarity threshold, whose fingerprints
differ in 9.6 bits on average with a deviation of 2.9, lies within it but for
about one case in a million.

Defined results: null text counts as empty and matches nothing; items
without words are ignored; items with equal ids are separate items with that
id; a null item id is kept; rows with equal ids and texts give one result, rows
of one id and other texts one each; a null doc_id is kept; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import free_names, materialize, once, scratch

SHINGLE = 5
SIMILARITY = 0.8
RADIUS, BLOCKS = 23, 8
# Characters that end words, beyond white space; others that aren't letters or digits are rare and stay in words.
MARKS = ".,;:!?\"'()[]{}<>|/\\*&%$#@^~_+=`-–—…«»“”‘’¿¡\t\r\n\u000b\u000c "


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def words_of(text: Column) -> Column:
    plain = F.translate(F.lower(F.coalesce(text.cast("string"), F.lit(""))), MARKS, " " * len(MARKS))
    return F.array_remove(F.split(plain, " "), "")


def shingles_of(words: Column, size: int) -> Column:
    """Hashes of the size-word shingles in order; none of fewer words."""
    last = F.size(words) - (size - 1)
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(size)]))).otherwise(
        F.expr("cast(array() as array<bigint>)"))


def items_of(benchmark: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(item, item_id, n, size, shingles): n words, shingles of size words."""
    rows = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where("size(w) > 0")
    by_size = [rows.where(F.size("w") == k).select("item_id", "w", F.lit(k).alias("size"), shingles_of(F.col("w"), k).alias("shingles")) for k in range(1, shingle)]
    full = rows.where(F.size("w") >= shingle).select("item_id", "w", F.lit(shingle).alias("size"), shingles_of(F.col("w"), shingle).alias("shingles"))
    for x in by_size:
        full = full.unionByName(x)
    return full.select(F.xxhash64("item_id", F.concat_ws(" ", "w")).alias("item"), "item_id", F.size("w").alias("n"), "size", "shingles").dropDuplicates(["item", "item_id"])


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys and fp, the SimHash of the shingles of each row of (keys, shingles)."""
    bits = rows.select(*keys, F.explode("shingles").alias("h")).groupBy(*keys).agg(
        F.count("*").alias("_n"), *[F.sum(F.shiftright("h", b).bitwiseAND(F.lit(1).cast("long"))).alias(f"_{b}") for b in range(64)])
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.when(2 * F.col(f"_{b}") > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return bits.select(*keys, fp.alias("fp"))


def _block(fp: Column, i: int, width: int) -> Column:
    return F.shiftright(fp, i * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def multi_index_pairs(windows: DataFrame, items: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(window, item) of equal n whose fp differ in at most radius bits."""
    width = 64 // blocks
    flips = [sum(1 << b for b in c) for k in range(radius // blocks + 1) for c in combinations(range(width), k)]
    held = items.select("item", "n", F.col("fp").alias("fp2"), F.posexplode(F.array(*[_block(F.col("fp"), i, width) for i in range(blocks)])).alias("block", "value"))
    probe = (windows.select("window", "n", "fp", F.posexplode(F.array(*[_block(F.col("fp"), i, width) for i in range(blocks)])).alias("block", "own"))
             .select("window", "n", "fp", "block", F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in flips]), lambda m: m.bitwiseXOR(F.col("own")))).alias("value")))
    near = probe.join(held, ["n", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= radius)
    return near.select("window", "item").distinct()


def weighted_similarity(pairs: DataFrame, windows: DataFrame, items: DataFrame) -> DataFrame:
    """pairs with similarity: sum of minima over sum of maxima of the counts."""
    a = windows.select("window", F.explode("shingles").alias("h")).groupBy("window", "h").agg(F.count("*").alias("x"))
    b = items.select("item", F.explode("shingles").alias("h")).groupBy("item", "h").agg(F.count("*").alias("y"))
    both = pairs.join(a, "window").join(b, ["item", "h"]).groupBy("window", "item").agg(F.sum(F.least("x", "y")).alias("common"))
    sizes = both.join(windows.select("window", F.size("shingles").alias("nx")), "window").join(items.select("item", F.size("shingles").alias("ny")), "item")
    return sizes.select("window", "item", (F.col("common") / (F.col("nx") + F.col("ny") - F.col("common"))).alias("similarity"))


def starts_of(hits: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, th, item, n, size, start) of all windows that hold enough of an
    item's shingles to reach the similarity, from hits (doc_id, th, item, n,
    size, nw, pos). The window of a shorter text is the text."""
    spots = hits.groupBy("doc_id", "th", "item", "n", "size", "nw").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    spots = spots.withColumn("m", F.least("n", "nw") - F.col("size") + 1)
    least = F.ceil((F.col("m") + F.col("n") - F.col("size") + 1) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9))  # shared ones at the similarity
    spots = spots.withColumn("need", F.greatest(least, F.lit(1)).cast("int")).where("size(p) >= need")
    runs = F.expr("transform(sequence(1, size(p) - need + 1), i -> struct(greatest(0, p[i + need - 2] - m + 1) as a, least(p[i - 1], greatest(0, nw - n)) as b))")
    spots = spots.select("doc_id", "th", "item", "n", "size", F.inline(runs)).where("a <= b")
    return spots.select("doc_id", "th", "item", "n", "size", F.explode(F.sequence("a", "b")).alias("start")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, th, item_id, start, n_words, similarity, n_windows): for each
    document and item the best of the windows that verify; th is the hash of
    the text, which tells documents of one id apart."""
    items = materialize(items_of(benchmark), "items")
    marks = items.select("item", "n", "size", F.explode(F.array_distinct("shingles")).alias("h"))
    sizes = [r[0] for r in items.select("size").distinct().collect()]  # at most SHINGLE values
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), words_of(F.col("text")).alias("w"))
    marked = rows.select("doc_id", once(F.col("th")).alias("th"), once(F.size("w")).alias("nw"), "w")
    hits = None
    for k in sizes:
        found = marked.select("doc_id", "th", "nw", F.posexplode(shingles_of(F.col("w"), k)).alias("pos", "h"))
        found = found.join(marks.where(F.col("size") == k), "h").select("doc_id", "th", "item", "n", "size", "nw", "pos")
        hits = found if hits is None else hits.unionByName(found)
    none = docs.select(F.col("doc_id").cast("long").alias("doc_id")).limit(0)
    if hits is None:
        return none.selectExpr("doc_id", "0L th", "cast(null as bigint) item_id", "0 start", "0 n_words", "cast(0 as double) similarity", "cast(0 as bigint) n_windows")
    starts = materialize(starts_of(hits, similarity), "starts")
    spots = starts.select("doc_id", "th", "n", "size", "start").distinct()
    who = spots.select("th").distinct()
    texts = rows.join(who, "th", "left_semi").dropDuplicates(["th"]).select("th", "w")
    cut = spots.select("th", "n", "size", "start").distinct().join(texts, "th").select(F.xxhash64("th", "n", "start").alias("window"), "th", "n", "size", "start", F.slice("w", F.col("start") + 1, F.col("n")).alias("w"))
    arrays = F.when(F.col("size") == SHINGLE, shingles_of(F.col("w"), SHINGLE))
    for k in range(1, SHINGLE):
        arrays = arrays.when(F.col("size") == k, shingles_of(F.col("w"), k))
    windows = materialize(cut.select("window", "th", "n", "start", arrays.alias("shingles")).where("size(shingles) > 0"), "windows")
    wfp, ifp = fingerprints(windows, ["window", "n"]), fingerprints(items, ["item", "n"])
    pairs = multi_index_pairs(wfp, ifp)
    good = weighted_similarity(pairs, windows, items).where(F.col("similarity") >= similarity)
    named = good.join(windows.select("window", "th", "n", "start"), "window").join(items.select("item", "item_id"), "item")
    ids = starts.select("doc_id", "th").distinct()
    return (named.join(ids, "th").groupBy("doc_id", "th", "item_id")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n")).alias("b"), F.count("*").alias("n_windows"))
            .select("doc_id", "th", "item_id", (-F.col("b.s")).alias("start"), F.col("b.n").alias("n_words"), F.col("b.similarity").alias("similarity"), "n_windows"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: one row for each document and benchmark item found in it."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("th")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go; rows of one id
    are judged apart by their texts, other columns pass through."""
    cols = docs.columns
    i, th = free_names(cols, "i", "th")
    with scratch(spark, "bad"):
        bad = materialize(leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("bad_id"), F.col("th").alias("bad_th")).distinct(), "bad")
    keyed = docs.select("*", F.col("doc_id").cast("long").alias(i), text_hash().alias(th))
    return keyed.join(bad, F.col(i).eqNullSafe(F.col("bad_id")) & (F.col(th) == F.col("bad_th")), "left_anti").select(*[F.col(f"`{c}`") for c in cols])
