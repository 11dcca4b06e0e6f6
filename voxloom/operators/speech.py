"""Relational operators of the speech pipeline over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxloom.functions import text as T


def speaker_views(rows: DataFrame, doc: str, speaker: str, order: str, text: str) -> DataFrame:
    """Text of each speaker in order, and of all as speaker 'combined': one
    shuffle by document."""
    joined = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["t"]), " ")
    both = rows.select(F.col(doc), F.explode(F.array(F.lit("combined"), F.col(speaker))).alias("speaker"), F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t")).alias("x"))
    return both.groupBy(doc, "speaker").agg(joined(F.collect_list("x")).alias("text"))


def turn_taking(turns: DataFrame, key: str, start: str, end: str, speaker: str) -> DataFrame:
    """What follows each turn: overlap, pause (same speaker) or gap, with its
    span; the turn's end is trimmed where the next one overlaps it."""
    w = W.partitionBy(key).orderBy(start, end, speaker)
    nxt = turns.select("*", F.lead(start).over(w).alias("_s"), F.lead(end).over(w).alias("_e"), F.lead(speaker).over(w).alias("_who"))
    kind = F.when(F.col("_s").isNull(), "last").when(F.col("_s") < F.col(end), "overlap").when(F.col("_who") == F.col(speaker), "pause").otherwise("gap")
    return nxt.select(key, F.col(start).alias("start"), F.least(end, F.coalesce("_s", end)).alias("end"), F.col(speaker).alias("speaker"), kind.alias("follows"),
                      F.when(F.col("_s") < F.col(end), F.least(end, "_e") - F.col("_s")).otherwise(F.col("_s") - F.col(end)).alias("seconds"))


def nearest_speaker(words: DataFrame, turns: DataFrame, key: str) -> DataFrame:
    """words (key, word, mid) with the first turn (key, speaker, start, end)
    that contains mid, else the nearest one, the earlier on ties; UNKNOWN
    without turns. A minimum with map-side combination, no sort of the join."""
    t = turns.select(key, "speaker", F.col("start").alias("s"), F.col("end").alias("e"))
    joined = words.join(t, key, "left")
    dist = F.when(F.col("mid").between(F.col("s"), F.col("e")), F.lit(0.0)).otherwise(F.least(F.abs(F.col("mid") - F.col("s")), F.abs(F.col("mid") - F.col("e"))))
    rank = F.struct((~F.col("mid").between(F.col("s"), F.col("e"))).alias("out"), dist.alias("d"), F.col("s"), F.col("speaker"))
    return joined.groupBy(*words.columns).agg(F.coalesce(F.min(F.when(F.col("s").isNotNull(), rank))["speaker"], F.lit("UNKNOWN")).alias("speaker"))


def in_intervals(points: DataFrame, intervals: DataFrame, key: str, at: str, width: int) -> DataFrame:
    """points in [start, end] of intervals (key, name, start, end), both ends
    in. Both sides are dealt by a time bucket of the given width, so that a
    long recording isn't one task and the join has equal keys."""
    p = points.withColumn("_b", F.floor(F.col(at) / width))
    i = intervals.withColumn("_b", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    return p.join(i, [key, "_b"]).where(F.col(at).between(F.col("start"), F.col("end"))).drop("_b")


def shortest_containing(ids: DataFrame, names: DataFrame) -> DataFrame:
    """For each id the shortest name that contains it, the first of equals.
    ids is a review list; it is broadcast only if Spark finds it small."""
    return ids.join(names, F.contains("name", "id")).groupBy("id").agg(F.min(F.struct(F.length("name").alias("n"), "name"))["name"].alias("name"), F.count("*").alias("n_matches"))


HEAD = 5  # words of a phrase by which it is looked up


def phrase_spans(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """(key, phrase_id, pos): every place where a phrase's words follow each
    other. docs: (key, w), an array of words; phrases: (phrase_id, words), ones
    without words go. The hash of the first HEAD words (of a shorter phrase, of
    all) joins, which leaves common words no weight; the whole phrase decides."""
    p = phrases.where("size(words) > 0").select("phrase_id", "words", F.least(F.size("words"), F.lit(HEAD)).alias("k"))
    p = p.withColumn("h", F.xxhash64("k", F.slice("words", F.lit(1), F.col("k"))))
    sizes = sorted(r["k"] for r in p.select("k").distinct().collect())  # at most HEAD values
    heads = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - (k - 1), F.lit(1))), lambda i: F.struct((i - 1).alias("pos"), F.xxhash64(F.lit(k), F.slice("w", i, F.lit(k))).alias("h")))
    places = F.flatten(F.array(*[F.when(F.size("w") >= k, heads(k)).otherwise(F.slice(heads(k), 1, 0)) for k in sizes])) if sizes else F.expr("cast(array() as array<struct<pos: int, h: bigint>>)")
    found = docs.select("key", F.inline(places)).join(p.select("phrase_id", "words", "h"), "h")
    return found.join(docs, "key").where(F.slice("w", F.col("pos") + 1, F.size("words")) == F.col("words")).select("key", "phrase_id", "pos")


BIN = 1 << 16  # different values of a bin, on average
STEPS = [1 << i for i in reversed(range(20))]  # of the search among a group's bounds


def quantiles_of(long: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(by, shares): exact interpolated quantiles of each group's values, none
    for a group of nulls. Values are counted first; of a group's different
    values one in BIN, by their hash, bounds its bins, so no task needs more
    than a bin, whatever the group. A bin's running count begins with a row
    that counts the group's lower bins. Bounds depend on values alone, so they
    are the same whenever they are computed."""
    c = long.select(*by, F.col(value).cast("double").alias("v")).where("v IS NOT NULL").groupBy(*by, "v").agg(F.count("*").alias("n"))
    # one aggregation with a use of n, so that the plan shuffles the counts once for all uses
    some = F.collect_list(F.when(F.pmod(F.xxhash64("v"), F.lit(BIN)) == 0, F.col("v")))
    bounds = c.groupBy(*by).agg(some.alias("_b"), F.sum("n").alias("_n")).where("size(_b) > 0 AND _n > 0").select(*[F.col(k).alias(f"_{k}") for k in by], F.sort_array("_b").alias("_b"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]  # a null key is a group
    found = F.aggregate(F.array(*map(F.lit, STEPS)), F.lit(0), lambda i, s: F.when(F.get("_b", i + s - 1) <= F.col("v"), i + s).otherwise(i))  # bounds up to v
    binned = c.join(F.broadcast(bounds), same, "left").select(*by, F.when(F.col("_b").isNull(), 0).otherwise(found).alias("bin"), "v", "n")
    w = W.partitionBy(*by)
    bins = binned.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    lower = bins.select(*by, "bin", F.lit(None).cast("double").alias("v"), (F.sum("n").over(w.orderBy("bin")) - F.col("n")).alias("n"), F.sum("n").over(w).alias("total"))
    one = W.partitionBy(*by, "bin")
    ranked = binned.withColumn("total", F.lit(None).cast("long")).unionByName(lower)
    ranked = ranked.select(*by, "v", "n", F.sum("n").over(one.orderBy(F.col("v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)).alias("end"), F.max("total").over(one).alias("total")).where("v IS NOT NULL")
    place = {k: (F.col("total") - 1) * F.lit(q) for k, q in shares.items()}
    at = lambda r: F.max(F.when((F.col("end") - F.col("n") <= r) & (r < F.col("end")), F.col("v")))
    ends = ranked.groupBy(*by).agg(F.max("total").alias("total"), *[at(f(p)).alias(f"{k}_{e}") for k, p in place.items() for e, f in (("low", F.floor), ("high", F.ceil))])

    def between(k):
        low, high, p = F.col(f"{k}_low"), F.col(f"{k}_high"), place[k]
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high).alias(k)

    return ends.select(*by, *map(between, shares))


def stats_long(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, variable, mean, median, std, min, max, cov, iqr) by unpivot."""
    long = rows.unpivot(key, columns, "variable", "value")
    m, s = F.avg("value"), F.stddev_samp("value")
    g = long.groupBy(key, "variable").agg(m.alias("mean"), s.alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), F.when(m == 0, 0.0).otherwise(s / F.nullif(m, F.lit(0.0))).alias("cov"))
    q = quantiles_of(long.withColumnRenamed(key, "_key").withColumnRenamed("variable", "_variable"), ["_key", "_variable"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    both = g.join(q, F.col(key).eqNullSafe(F.col("_key")) & (F.col("variable") == F.col("_variable")), "left")
    return both.select(key, "variable", "mean", "median", "std", "min", "max", "cov", (F.col("q75") - F.col("q25")).alias("iqr"))


def duplicate_files(files: DataFrame, key: str, digest: str, order: str) -> DataFrame:
    """keep for the first of the files with a key, delete for others of the
    same content, review where contents differ. A plan only."""
    # distinct contents and the first file come from one aggregation; no window over a hot key
    g = files.groupBy(key).agg(F.min(order).alias("_first"), F.count("*").alias("_n"), F.count_distinct(digest).alias("_d")).where("_n > 1")
    act = F.when(F.col(order) == F.col("_first"), "keep").when(F.col("_d") == 1, "delete").otherwise("review")
    return files.join(g, key).select(key, order, act.alias("action"))


def word_graph(docs: DataFrame, key: str, ws: Column) -> DataFrame:
    """Nodes, edges, density and mean degree of the graph of neighbouring
    words; a self-loop counts once as an edge, twice as a degree."""
    d = docs.select(key, ws.alias("w"))
    # edges as hashes, distinct within the row: no shuffle
    pair = lambda x, i: F.xxhash64(F.least(x, F.get("w", i + 1)), F.greatest(x, F.get("w", i + 1)))
    edges = F.size(F.array_distinct(F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), pair)))
    g = d.select(key, F.size(F.array_distinct("w")).alias("nodes"), edges.cast("long").alias("edges"))
    e, n = F.col("edges"), F.col("nodes")
    return g.select(key, "nodes", "edges", F.when(n > 1, 2.0 * e / F.nullif(n.cast("long") * (n - 1), F.lit(0))).otherwise(0.0).alias("density"), F.when(n > 0, 2.0 * e / F.nullif(n, F.lit(0))).otherwise(0.0).alias("degree"))


def shift_date(date: Column, days: Column) -> Column:
    """MM-DD-YY or MM-DD-YYYY, shifted, with as many digits of the year; a
    two-digit year from 69 is of the last century."""
    long_year = F.length(date) >= 10
    short = F.try_to_timestamp(F.concat(F.substring(date, 1, 6), F.when(F.substring(date, 7, 2) >= "69", "19").otherwise("20"), F.substring(date, 7, 2)), F.lit("MM-dd-yyyy"))
    d = F.when(long_year, F.try_to_timestamp(date, F.lit("MM-dd-yyyy"))).otherwise(short).cast("date")
    moved = F.date_add(d, days)
    return F.when(long_year, F.date_format(moved, "MM-dd-yyyy")).otherwise(F.date_format(moved, "MM-dd-yy"))


def greedy_chunks(lines: Column, limit: int) -> Column:
    """Chunk number of each line: lines fill a chunk up to limit characters;
    a longer line is a chunk of its own."""
    first = F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("held"), F.expr("cast(array() as array<int>)").alias("out"))

    def step(s, x):
        full = (s["held"] > 0) & (s["held"] + F.length(x) > limit)
        at = s["chunk"] + full.cast("int")
        return F.struct(at.alias("chunk"), F.when(full, F.length(x)).otherwise(s["held"] + F.length(x)).alias("held"), F.concat(s["out"], F.array(at)).alias("out"))

    return F.aggregate(lines, first, step, lambda s: s["out"])


def islands(rows: DataFrame, key: str, at: str) -> DataFrame:
    """Runs of consecutive integers: (key, first, last, n)."""
    g = rows.select(key, at).distinct().withColumn("_g", F.col(at) - F.row_number().over(W.partitionBy(key).orderBy(at)))
    return g.groupBy(key, "_g").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n")).drop("_g")


def ranked_choice(candidates: DataFrame, key: str, name: str, priority: Column) -> DataFrame:
    """The candidate of lowest priority (then name), and why: single, or the
    class that decided."""
    g = candidates.groupBy(key).agg(F.min(F.struct(priority.alias("p"), F.col(name).alias("n"))).alias("b"), F.count("*").alias("n_candidates"))
    return g.select(key, F.col("b.n").alias(name), "n_candidates", F.when(F.col("n_candidates") == 1, "single").otherwise(F.concat(F.lit("priority_"), F.col("b.p").cast("string"))).alias("reason"))
