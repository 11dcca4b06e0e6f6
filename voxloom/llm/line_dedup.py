"""Near-duplicate lines by a segment-partition edit join, DataFrame only.

A line is a sequence of symbols, its characters or (from LONG words on) its
words. Distinct lines are cut into tau + 1 even segments. Lines within tau edits
share a segment unchanged, at a place that the length difference bounds, so a
line probes an index keyed by (length, segment number, segment) with the few
pieces that a match allows. Candidates are verified with a banded bit-parallel
edit distance: the 2 * tau + 1 cells of a column are the bits of one integer,
folded over the symbols of the other line.

Two lines are alike if they are equal; or if both have MIN_CHARS characters,
one has fewer than LONG words, and they are within TAU character edits; or if
both have LONG words or more and are within as many word edits as CLASSES
gives for the shorter one. A line occurrence goes if an earlier occurrence (by
doc_id, then text, then place) has a line alike. Lines are compared lower-cased
and trimmed; those of fewer than EXACT_CHARS characters are never dropped and
drop nothing, those of fewer than MIN_CHARS meet equal lines alone.

Defined results: null text counts as empty and stays; a null id comes after
every other; rows of equal id and equal text count as one document, so repeated
rows keep their lines; rows of equal id and other texts are documents of their
own; the order of what stays, and short lines, are unchanged; an empty table
gives no rows; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import free_names, materialize, once, release, scratch

TAU = 2
EXACT_CHARS, MIN_CHARS = 6, 24
LONG = 50
CLASSES = ((LONG, 2), (150, 3), (300, 4))  # (words of a line at least, word edits)
MOST_EDITS = CLASSES[-1][1]
BLOCK = 256  # lines of a key that are compared at once
BROADCAST_IDS = 2_000_000  # 16 MB of ids; beyond it the join shuffles
_LAST = 9223372036854775807


def banded_distance(a: Column, b: Column, tau: int, words: bool = False) -> Column:
    """Edit distance of strings (or arrays of words) whose lengths differ by at
    most tau; right wherever it is at most tau, and over tau elsewhere.

    Bit r of the vectors is row j - tau + r of column j. The distance is
    followed down the diagonal that ends in the last cell."""
    width, mask = 2 * tau + 1, (1 << (2 * tau + 1)) - 1
    if words:
        chars, size = (lambda s: s), F.size
    else:
        chars = lambda s: F.when(F.length(s) > 0, F.split(s, "")).otherwise(F.expr("cast(array() as array<string>)"))
        size = F.length
    fence = F.array_repeat(F.lit("\u0000\u0000"), tau)  # equal to no symbol
    pattern = F.concat(fence, chars(a), F.array_repeat(F.lit("\u0000\u0000"), 2 * tau + 1))
    bound = F.array(F.struct(pattern.alias("p"), chars(b).alias("t"), (size(a) - size(b)).cast("int").alias("diff")))  # made once for a pair
    return F.element_at(F.transform(bound, lambda s: _fold(s["p"], s["t"], s["diff"], tau, width, mask)), 1)


def _fold(p: Column, t: Column, diff: Column, tau: int, width: int, mask: int) -> Column:
    equal = F.transform(t, lambda c, j: sum((F.when(F.try_element_at(p, j + (1 + r)) == c, 1 << r).otherwise(0) for r in range(1, width)),
                                            F.when(F.try_element_at(p, j + 1) == c, 1).otherwise(0)))
    start = ((1 << (tau + 1)) - 1) << tau

    def step(s, x):
        vp, vn = s["vp"], s["vn"]
        band = lambda v: v.bitwiseAND(F.lit(mask))
        d0 = band(((x.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(x).bitwiseOR(vn))
        hp = band(vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))))
        hn = d0.bitwiseAND(vp)
        down = F.shiftright(d0, 1)
        same = F.expr("0") + F.shiftright(d0, 0).bitwiseAND(s["bit"]).cast("int")
        return F.struct(band(hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)))).alias("vp"), hp.bitwiseAND(down).alias("vn"),
                        (s["d"] + F.when((s["j"] > -diff) & (same == 0), 1).otherwise(0)).alias("d"), (s["j"] + 1).alias("j"), s["bit"].alias("bit"))

    first = F.struct(F.lit(start).alias("vp"), F.lit(0).alias("vn"), F.abs(diff).alias("d"), F.lit(1).alias("j"),
                     F.element_at(F.array(*[F.lit(1 << r) for r in range(width)]), diff + tau + 1).alias("bit"))
    return F.aggregate(equal, first, step, lambda s: s["d"])


def _norm(line: Column) -> Column:
    return F.trim(F.lower(line))


def _document() -> list[Column]:
    """The id and a number of the text, by which documents are told apart."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("d"),
            once(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << 31) - 1).cast("long"))).alias("th")]


def occurrences(docs: DataFrame) -> DataFrame:
    """(line, place): place orders occurrences by document, then position."""
    rows = docs.select(*_document(), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("pos", "raw"))
    rows = rows.where(F.length(F.trim("raw")) >= EXACT_CHARS).select("d", "th", "pos", _norm(F.col("raw")).alias("line"))
    low = F.col("th") * F.lit(1 << 31).cast("long") + F.col("pos")
    return rows.select("line", (F.col("d").cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)") + low.cast("decimal(19,0)")).cast("decimal(38,0)").alias("place"))


def _plan(tau: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The (segment, shift, delta) of a line's index keys and of its probes: a
    probe looks for a segment, moved by shift, of a line shorter by delta."""
    index = [(i, 0, 0) for i in range(tau + 1)]
    probes = [(i, shift, delta) for i in range(tau + 1) for delta in range(tau + 1)
              for shift in range(max(-i, delta - (tau - i)), min(i, delta + (tau - i)) + 1)]
    return index, probes


def _keyed(rows: DataFrame, classes: tuple[tuple[int, int], ...], piece: str, probe: bool) -> DataFrame:
    """(id, own, key) for every key of rows(id, x, n) under classes (symbols at
    least, tau); piece is SQL for the symbols of x from at on, span of them.
    own tells a probe that is the line's index key as well.

    The plan is exploded first and one small expression makes the key, which
    the JVM compiles. A key is of the shorter line's length, and so is its class."""
    parts = []
    for k, (low, tau) in enumerate(classes):
        high = classes[k + 1][0] if k + 1 < len(classes) else 1 << 30
        plan = ", ".join(f"named_struct('k', {tau + 1}, 'low', {low}, 'high', {high}, 'i', {i}, 'shift', {shift}, 'delta', {delta})" for i, shift, delta in _plan(tau)[probe])
        parts.append((f"n >= {low} AND n - {tau if probe else 0} < {high}", f"array({plan})"))
    entries = parts[0][1] if len(parts) == 1 else "concat(" + ", ".join(f"if({test}, {plan}, slice({plan}, 1, 0))" for test, plan in parts) + ")"
    rows = rows.selectExpr("id", "x", "n", f"inline({entries})").selectExpr("id", "x", "n", "k", "low", "high", "i", "shift", "delta", "n - delta AS size").where("size >= low AND size < high")
    rows = rows.selectExpr("id", "x", "n", "size", "i", "shift = 0 AND delta = 0 AS own", "cast((size div k) * i + greatest(0, size % k - (k - i)) + shift AS int) AS at", "cast(size div k + if(i >= k - size % k, 1, 0) AS int) AS span")
    return rows.where("at >= 0 AND at + span <= n").selectExpr("id", "own", f"xxhash64(size, i, {piece}) AS key")


def keys_of(lines: DataFrame, tau: int, probe: bool = True) -> DataFrame:
    """(id, own, key) of the lines, by characters and by words."""
    by_char = lines.where((F.length("line") >= MIN_CHARS) & (F.col("words") < LONG + tau)).select("id", F.col("line").alias("x"), F.length("line").alias("n"))
    words = F.transform(F.split("line", " "), lambda w: F.xxhash64(w))
    # not deterministic, or it would be made again for each key
    by_word = lines.where(F.col("words") >= LONG).select("id", F.when(F.monotonically_increasing_id() >= 0, words).alias("x"), F.col("words").alias("n"))
    return _keyed(by_char, ((MIN_CHARS, tau),), "substring(x, at + 1, span)", probe).unionByName(_keyed(by_word, CLASSES, "'w', slice(x, at + 1, span)", probe))


def shape(lines: DataFrame) -> DataFrame:
    """lines with code: a string with a character for each symbol of the line,
    by which edit distances never come out larger than by the line's own."""
    codes = F.array_join(F.transform(F.split("line", " "), lambda w: F.chr(F.pmod(F.xxhash64(w), F.lit(251)) + 1)), "")
    return lines.withColumn("code", F.when(F.col("words") >= LONG, codes))


def are_alike(a: Column, b: Column, tau: int) -> Column:
    """Of structs of shape()'s columns line, words and code. A bound on the
    distance of few words goes first, the banded distance decides."""
    least = F.least(a["words"], b["words"])
    edits = F.lit(CLASSES[0][1])
    for low, most in CLASSES[1:]:
        edits = F.when(least >= low, most).otherwise(edits)
    by_word = (F.levenshtein(a["code"], b["code"], MOST_EDITS).between(0, edits)) & (banded_distance(F.split(a["line"], " "), F.split(b["line"], " "), MOST_EDITS, words=True) <= edits)
    by_char = (F.levenshtein(a["line"], b["line"], tau) >= 0) & (banded_distance(a["line"], b["line"], tau) <= tau)
    return F.when(least >= LONG, by_word).otherwise(by_char)


def later_lines(lines: DataFrame, tau: int = TAU) -> DataFrame:
    """(id) of the lines of distinct_lines() that are alike to an earlier one.

    The lines of a key first meet the lowest line that it indexes, so a large
    group of alike lines needs no pairs of its own (ids follow the places
    roughly, so that line is among the earliest). Where a key indexes several
    lines, those that this hasn't settled are compared in blocks of BLOCK lines
    inside a row, which gives the lines settled and no pairs."""
    keys = keys_of(lines, tau).repartition("key")  # dealt once, for both sides
    held = keys.groupBy("key").agg(F.min(F.when(F.col("own"), F.col("id"))).alias("lead"), F.count_if("own").alias("held")).where("held > 0")
    # a row for each key, so a hash table of it is small whatever the keys' lines, and the keys need no sort
    met = materialize(keys.join(held.hint("shuffle_hash"), "key").where("id <> lead OR held > 1").select("key", "id", "own", "lead", "held"), "met")
    del held, keys
    release(lines.sparkSession)
    wanted = materialize(met.select("id").unionByName(met.select(F.col("lead").alias("id"))).distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    text = materialize(shape(lines.join(wanted, "id", "left_semi").select("id", "line", "words", "place")), "texts")
    side = lambda x: text.select(F.col("id").alias(x), F.struct("line", "words", "code", "place").alias(f"{x}x"))
    pairs = met.where("id <> lead").select(F.greatest("id", "lead").alias("a"), F.least("id", "lead").alias("b")).distinct().join(side("a"), "a").join(side("b"), "b")
    near = pairs.where(are_alike(F.col("ax"), F.col("bx"), tau))
    settled = materialize(near.select(F.when(F.col("ax.place") > F.col("bx.place"), F.col("a")).otherwise(F.col("b")).alias("id")).distinct(), "settled")

    crowd = met.where("held > 1").select("key", "id", "own").join(settled.withColumn("done", F.lit(True)), "id", "left")
    open_keys = crowd.where("done IS NULL").groupBy("key").agg(F.count("*").alias("n"))
    sizes = crowd.join(open_keys.select("key"), "key", "left_semi").groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = crowd.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # lines still open are the later ones of a pair, any line the earlier one, and one of the two is indexed
    ways = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    later = dealt.where("done IS NULL").select("key", "id", "own", F.lit(True).alias("later"), "block", ways).select("key", "id", "own", "later", F.col("block").alias("i"), F.col("other").alias("j"))
    first = dealt.select("key", "id", "own", F.lit(False).alias("later"), "block", ways).select("key", "id", "own", "later", F.col("other").alias("i"), F.col("block").alias("j"))
    rows = later.unionByName(first).join(text, "id").select("key", "i", "j", "later", F.struct("id", "own", "line", "words", "code", "place").alias("x"))
    groups = rows.groupBy("key", "i", "j").agg(F.collect_list(F.when(F.col("later"), F.col("x"))).alias("xs"), F.collect_list(F.when(~F.col("later"), F.col("x"))).alias("ys"))
    found = F.filter("xs", lambda x: F.exists("ys", lambda y: (y["place"] < x["place"]) & (x["own"] | y["own"]) & are_alike(x, y, tau)))
    more = groups.where("size(ys) > 0").select(F.explode(F.transform(found, lambda x: x["id"])).alias("id"))
    return settled.unionByName(more).distinct()


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(id, line, words, place, copies): the distinct lines with their earliest
    place; ids are unique, and by their upper bits in rough order of place."""
    words = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    rows = occurrences(docs).groupBy("line").agg(F.min("place").alias("place"), F.count("*").alias("copies"))
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("n"), "line", words.alias("words"), "place", "copies"), "lines")
    size = F.col("place").cast("double")
    low, high = rows.where(size < float(_LAST) * (1 << 62)).agg(F.min(size), F.max(size)).first()
    part = F.least(F.greatest(F.floor((size - (low or 0.0)) / max((high or 0.0) - (low or 0.0), 1.0) * 1023), F.lit(0)), F.lit(1023)).cast("long")
    return rows.select(F.shiftleft(part, 53).bitwiseOR(F.col("n").bitwiseAND(F.lit((1 << 53) - 1).cast("long"))).alias("id"), "line", "words", "place", "copies")


def keepers(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """(line, place, copies): the one occurrence that stays of every eligible
    distinct line that has no earlier neighbour."""
    lines = distinct_lines(docs)
    release(docs.sparkSession)
    return lines.join(later_lines(lines, tau), "id", "left_anti").select("line", "place", "copies")


def marks(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """(d, th, drop): for each document with lines to drop, their positions in
    order; d is the id, or the largest long for null, th is of the text."""
    with scratch(docs.sparkSession, "marks"):
        stays = keepers(docs, tau).select("place")
        rows = occurrences(docs).select("place")
        low = F.pmod("place", F.lit(1 << 62).cast("decimal(19,0)")).cast("long")
        gone = rows.join(stays.hint("shuffle_hash"), "place", "left_anti").select(
            F.floor((F.col("place") - low) / F.lit(1 << 62).cast("decimal(19,0)")).cast("long").alias("d"), F.shiftright(low, 31).alias("th"), low.bitwiseAND(F.lit((1 << 31) - 1).cast("long")).cast("int").alias("pos"))
        return materialize(gone.groupBy("d", "th").agg(F.array_sort(F.collect_set("pos")).alias("drop")), "marks")


def dedup(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """docs without the lines that go, and the columns n_lines and n_dropped
    (with underscores before them where docs has such columns)."""
    cols = docs.columns
    d, th, drop = free_names(cols, "d", "th", "drop")
    n_lines, n_dropped = counts_of(cols)
    lost = marks(docs, tau).toDF(d, th, drop)
    keys = [c.alias(name) for c, name in zip(_document(), (d, th))]
    joined = docs.select("*", *keys).join(lost, [d, th], "left")
    parts, gone = F.split(F.col("text").cast("string"), "\n"), F.col(drop)
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(parts)))
    kept = F.flatten(F.transform(F.sequence(F.lit(1), F.size(gone) + 1), lambda i: F.slice(parts, F.element_at(bounds, i) + 2, F.element_at(bounds, i + 1) - F.element_at(bounds, i) - 1)))
    text = F.when(gone.isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in cols],
                         F.coalesce(F.size(parts), F.lit(0)).alias(n_lines), F.coalesce(F.size(gone), F.lit(0)).alias(n_dropped))


def counts_of(cols: list[str]) -> list[str]:
    """The names of dedup's counts beside columns cols."""
    return free_names(cols, "n_lines", "n_dropped")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: for every document its lines, how many of them go, and which (by
    position from 0). dedup() also cuts the texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", *_document(), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    none = F.expr("cast(array() as array<int>)")
    return rows.join(marks(docs), ["d", "th"], "left").select("doc_id", "n_lines", F.coalesce(F.size("drop"), F.lit(0)).alias("n_dropped"), F.coalesce("drop", none).alias("dropped"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated lines go; a row of which nothing is left goes
    too (a row that came in without text stays)."""
    cols = docs.columns
    out = dedup(docs)
    out = out.where((F.col(counts_of(cols)[1]) == 0) | (F.length(F.trim("text")) > 0))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in cols])
