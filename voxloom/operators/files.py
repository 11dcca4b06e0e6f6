"""File indexes, matches between files, plans of file work, and reports.
Nothing here touches a file: copies, renames and removals are rows to act on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

COPY_NUMBER = r"^(.*?)( (\d+))?(\.[^.]*)?$"


def name_index(files: DataFrame, name: str, path: str) -> DataFrame:
    """(name, path): of files of one name the last path."""
    return files.groupBy(name).agg(F.max(path).alias(path))


def stem_index(files: DataFrame, stem: str, path: str, most: int = 5) -> DataFrame:
    """(stem, n, paths): how many files have a stem, and the first few."""
    return first_of(files, [stem], path, "paths", most)


def first_of(rows: DataFrame, by: list[str], value: str, name: str, most: int = 5) -> DataFrame:
    """(by, n, name): rows of a group, and the lowest few values. Only those
    are gathered, so a group of any size does."""
    ranked = rows.select(*by, value, F.row_number().over(W.partitionBy(*by).orderBy(value)).alias("_k")).where(F.col("_k") <= most)
    few = ranked.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias(name))
    return rows.groupBy(*by).agg(F.count("*").alias("n")).join(few, by)


def grams(text: Column, size: Column) -> Column:
    """The different substrings of a size."""
    n = F.length(text) - size + 1
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, size)))).otherwise(F.expr("cast(array() as array<string>)"))


def parts(texts: DataFrame, text: str, whole: DataFrame, of: str) -> DataFrame:
    """texts with part: the different substrings as long as some value of
    whole. A value equals a part where a text contains it, so rows meet by whole
    values and not by a beginning that all of them share; a text has at most its
    length times the different lengths of values, however many rows there are."""
    lengths = sorted(r["k"] for r in whole.select(F.length(of).alias("k")).distinct().collect() if r["k"] is not None)
    sizes = F.array(*map(F.lit, lengths)).cast("array<int>")
    return texts.select(text, F.explode(F.flatten(F.transform(sizes, lambda k: grams(F.col(text), k)))).alias("part"))


def containing(ids: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name): names that contain the id, once for each row of both."""
    return parts(names, "name", ids, "id").withColumnRenamed("part", "id").join(ids, "id")


def fuzzy_match(ids: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name, how): the name that equals the id, else the shortest that
    contains it or is contained in it, the first of equals. Of the names that
    contain a part only the best one is kept before ids are looked up, so an id
    that all names contain is one row."""
    names = names.distinct()
    best = F.min(F.struct((F.col("id") != F.col("name")).cast("int").alias("o"), F.length("name").alias("n"), "name")).alias("m")
    longer = parts(names, "name", ids, "id").withColumnRenamed("part", "id").groupBy("id").agg(best).join(ids, "id").select("id", "m.name")
    shorter = parts(ids, "id", names, "name").withColumnRenamed("part", "name").join(names, "name").select("id", "name")
    return longer.unionByName(shorter).groupBy("id").agg(best).select("id", F.col("m.name").alias("name"), F.when(F.col("m.o") == 0, "exact").otherwise("part").alias("how"))


def paired(ids: DataFrame, names: DataFrame, first: str, second: str) -> DataFrame:
    """(id, first, second): the lowest names that contain the id and end in
    either suffix; ids without both go."""
    met = containing(ids, names)
    g = met.groupBy("id").agg(F.min(F.when(F.col("name").endswith(first), F.col("name"))).alias("first"), F.min(F.when(F.col("name").endswith(second), F.col("name"))).alias("second"))
    return g.where("first IS NOT NULL AND second IS NOT NULL")


def starting(stems: DataFrame, names: DataFrame, lengths: list[int]) -> DataFrame:
    """(stem, name): the lowest name that starts with the stem; lengths are
    those that stems have."""
    heads = names.select("name", F.explode(F.array(*[F.when(F.length("name") >= k, F.substring("name", 1, k)) for k in lengths])).alias("stem")).where("stem IS NOT NULL")
    return stems.join(heads, "stem").groupBy("stem").agg(F.min("name").alias("name"))


def match_class(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n, kind): none, single or multiple matches of each left key."""
    n = F.coalesce("n", F.lit(0).cast("long"))
    return left.join(right.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, n.alias("n"), F.when(n == 0, "none").when(n == 1, "single").otherwise("multiple").alias("kind"))


def copies_plan(files: DataFrame, name: str, size: str, digest: str) -> DataFrame:
    """files named alike but for a number before the extension: keep the lowest
    number; delete the others if all have its size and content, else review."""
    part = lambda i: F.regexp_extract(name, COPY_NUMBER, i)
    f = files.withColumn("base", F.concat(part(1), part(4))).withColumn("number", F.when(part(3) == "", 0).otherwise(part(3).cast("long")))
    g = f.groupBy("base").agg(F.count("*").alias("n"), F.count_distinct(size).alias("sizes"), F.count_distinct(digest).alias("digests"), F.min(F.struct("number", name)).alias("low")).where("n > 1")
    keep = (F.col("number") == F.col("low.number")) & (F.col(name) == F.col(f"low.{name}"))
    return f.join(g, "base").select(*files.columns, "base", F.when(keep, "keep").when((F.col("sizes") == 1) & (F.col("digests") == 1), "delete").otherwise("review").alias("action"))


def path_tallies(files: DataFrame, key: str, path: str, size: str) -> DataFrame:
    """(key, n, deid, duplicate, original, sizes_differ) for keys of several files."""
    has = lambda p: F.bool_or(F.lower(path).contains(p))
    return files.groupBy(key).agg(F.count("*").alias("n"), has("deid").alias("deid"), has("duplicate").alias("duplicate"), has("original").alias("original"), (F.count_distinct(size) > 1).alias("sizes_differ")).where("n > 1")


def coverage(rows: DataFrame, families: dict[str, list[str]]) -> DataFrame:
    """(family, n_cells, n_missing, percent): null and NaN cells by family of columns."""
    miss = lambda c: F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double")))
    one = rows.agg(F.count("*").alias("_n"), *[sum((miss(c) for c in cols), F.lit(0)).alias(k) for k, cols in families.items()])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("family"), (F.col("_n") * len(cols)).alias("n_cells"), F.col(k).alias("n_missing")) for k, cols in families.items()]))
    return one.select(each.alias("e")).select("e.*").withColumn("percent", F.coalesce(100.0 * (F.col("n_cells") - F.col("n_missing")) / F.nullif("n_cells", F.lit(0)), F.lit(0.0)))


def first_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows of equal keys the one first in order."""
    return rows.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where("_k = 1").drop("_k")


def gaps(regions: DataFrame, key: str, n: Column, least: int = 800) -> DataFrame:
    """(key, start, end): what is longer than least between regions(start, end)
    in order of their starts, before the first and after the last up to n."""
    w = W.partitionBy(key).orderBy("start", "end")
    r = regions.withColumn("_n", n).select(key, "start", "end", "_n", F.lag("end", 1, 0).over(w).alias("_before"), F.lead("start").over(w).alias("_next"))
    both = F.array(F.struct(F.col("_before").alias("start"), F.col("start").alias("end")), F.when(F.col("_next").isNull(), F.struct(F.col("end").alias("start"), F.col("_n").alias("end"))))
    return r.select(key, F.explode(both).alias("g")).where("g IS NOT NULL").select(key, "g.*").where(F.col("end") - F.col("start") > least)


def frame_regions(frames: DataFrame, key: str, at: str, hop: int, frame: int, n: Column) -> DataFrame:
    """(key, start, end) in samples of runs of consecutive frames; only the
    last region of a key is clipped to n."""
    g = frames.select(key, at).distinct().withColumn("_g", F.col(at) - F.row_number().over(W.partitionBy(key).orderBy(at)))
    r = g.groupBy(key, "_g").agg((F.min(at) * hop).alias("start"), ((F.max(at) + 1) * hop + frame).alias("end")).withColumn("_n", n)
    last = F.max("start").over(W.partitionBy(key)) == F.col("start")
    return r.select(key, "start", F.when(last, F.least("end", "_n")).otherwise(F.col("end")).alias("end"))


def assign_by_overlap(items: DataFrame, turns: DataFrame, key: str, width: int) -> DataFrame:
    """items(key, item, start, end) with the speaker whose turns overlap it
    most, the first name of equals; UNKNOWN without any. Both sides are dealt by
    time buckets of a width, in which an overlap counts once."""
    cut = lambda df: df.withColumn("_b", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    i, t = cut(items.select(key, "item", "start", "end")), cut(turns.select(key, "speaker", F.col("start"), F.col("end"))).select(key, "_b", "speaker", F.col("start").alias("s"), F.col("end").alias("e"))
    low, high = F.greatest("start", "s", F.col("_b") * width), F.least("end", "e", (F.col("_b") + 1) * width)
    met = i.join(t, [key, "_b"]).withColumn("o", high - low).where("o > 0").groupBy(key, "item", "speaker").agg(F.sum("o").alias("o"))
    best = met.groupBy(key, "item").agg(F.min(F.struct((-F.round("o", 6)).alias("o"), "speaker"))["speaker"].alias("speaker"))
    return items.join(best, [key, "item"], "left").withColumn("speaker", F.coalesce("speaker", F.lit("UNKNOWN")))


def report(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A Markdown table of a small result, of at most the given rows."""
    found = rows.limit(most).collect()
    line = lambda v: "| " + " | ".join("" if x is None else str(x) for x in v) + " |"
    return "\n".join([f"# {title}", "", line(rows.columns), "|" + "---|" * len(rows.columns), *map(line, found), ""])


def manifest(plan: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """plan with status and error: done(key, error) tells what was tried."""
    tried = done.select(key, "error", F.lit(True).alias("_tried"))
    return plan.join(tried, key, "left").withColumn("status", F.when(F.col("_tried").isNull(), "planned").when(F.col("error").isNull(), "success").otherwise("error")).drop("_tried")
