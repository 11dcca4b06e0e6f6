"""Queries over tokens and sentences, file matches, reports, regions and
graphs, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions import tiers as R
from voxloom.operators import files as O
from voxloom.plans.catalog import register
from voxloom.plans.files_and_deid import FILES, files
from voxloom.plans.queries import LOWER, WORDS


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _r(c, name, places=6):
    return F.round(c, places).alias(name)


def _scaled(c, name, places=6):
    """Rounded as DuckDB does, after scaling: halves such as 0.071875, which
    are no binary numbers, go the way that their product goes."""
    return (F.round(c * 10.0**places) / 10.0**places).alias(name)


TOKENS = f"regexp_extract_all(regexp_replace(coalesce(text, ''), 'n''t\\b', ' n''t', 'g'), '{R.TOKEN.replace(chr(39), chr(39) * 2)}', 1)"
SENTENCES = "list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '')"
_WORD = r"^[\p{L}\p{N}]+$"
_EXPAND = "flatten(list_transform({x}, lambda t: CASE " + " ".join(f"WHEN suffix(t, '{e.replace(chr(39), chr(39) * 2)}') THEN [left(t, length(t) - {len(e)}), '{w}']" for e, w in R.CONTRACTIONS) + " ELSE [t] END))"
_TTR = "CASE WHEN len({x}) = 0 THEN 0 ELSE len(list_distinct({x})) / len({x}) END"


@register("mattr_windows", f"""WITH w AS (SELECT doc_id, {LOWER} AS ws FROM documents) SELECT doc_id, """ + ", ".join(f"""round(CASE WHEN len(ws) = 0 THEN 0 WHEN len(ws) < {k} THEN len(list_distinct(ws)) / len(ws)
  ELSE list_sum(list_transform(range(1, len(ws) - {k - 2}), lambda i: len(list_distinct(ws[i:i+{k - 1}])))) / ((len(ws) - {k - 1}) * {k}.0) END, 6) AS mattr_{k}""" for k in (25, 100)) + " FROM w")
def mattr_windows(spark, d):
    w = F.col("w")
    return _t(spark, d, "documents").select("doc_id", T.words(F.lower("text")).alias("w")).select("doc_id", *[_r(T.mattr(w, k), f"mattr_{k}") for k in (25, 100)])


@register("ttr_ways", f"""WITH t AS (SELECT doc_id, {TOKENS} AS a FROM documents), p AS (SELECT doc_id, a, list_transform(a, lambda x: lower(x)) l, list_filter(list_transform(a, lambda x: lower(x)), lambda x: regexp_matches(x, '{_WORD}')) n, {_EXPAND.format(x='a')} e FROM t),
  q AS (SELECT doc_id, a, l, n, list_transform(e, lambda x: lower(x)) el, list_filter(list_transform(e, lambda x: lower(x)), lambda x: regexp_matches(x, '{_WORD}')) en FROM p), r AS (SELECT *, list_filter(en, lambda x, i: i = 1 OR x <> en[i - 1]) s FROM q),
  v AS (SELECT doc_id, list_filter([{', '.join(f"CASE WHEN len({x}) > 0 THEN {_TTR.format(x=x)} END" for x in ('a', 'l', 'n', 'el', 'en', 's'))}], lambda x: x IS NOT NULL) v FROM r)
  SELECT doc_id, round(coalesce(list_min(v), 0), 6) AS ttr_min, round(coalesce(list_max(v), 0), 6) AS ttr_max, round(coalesce(list_avg(v), 0), 6) AS ttr_mean, round(coalesce(list_stddev_pop(v), 0), 5) AS ttr_std, round(coalesce(list_max(v) - list_min(v), 0), 6) AS ttr_range FROM v""")
def ttr_ways(spark, d):
    some = F.filter(R.ttr_ways(F.col("a")), lambda x: x > 0)  # a way without tokens has 0
    v = _t(spark, d, "documents").select("doc_id", R.tokens(F.col("text")).alias("a")).select("doc_id", some.alias("v"))
    return v.select("doc_id", *[_scaled(F.coalesce(c, F.lit(0.0)), f"ttr_{k}", 5 if k == "std" else 6) for k, c in R.spread(F.col("v")).items()])


@register("honore_2", f"""WITH t AS (SELECT doc_id, list_transform({TOKENS}, lambda x: lower(x)) a FROM documents), m AS (SELECT doc_id, len(a) n, len(list_distinct(a)) v, len(list_filter(map_values(list_histogram(a)), lambda x: x = 1)) v1 FROM t)
  SELECT doc_id, n AS n_tokens, round(CASE WHEN n = 0 OR v1 = v THEN 0 ELSE 100 * ln(n) / (1 - v1 / v) END, 4) AS honore FROM (SELECT doc_id, n, v, coalesce(v1, 0) v1 FROM m)""")
def honore_2(spark, d):
    a = _t(spark, d, "documents").select("doc_id", F.transform(R.tokens(F.col("text")), F.lower).alias("a")).select("doc_id", F.size("a").alias("n"), T.frequencies(F.col("a")).alias("f"))
    m = a.select("doc_id", "n", F.size("f").cast("double").alias("v"), F.size(F.filter("f", lambda x: x == 1)).cast("double").alias("v1"))
    some = F.when((F.col("n") == 0) | (F.col("v1") == F.col("v")), 0.0).otherwise(100 * F.ln(F.greatest("n", F.lit(1))) / F.nullif(1 - F.col("v1") / F.nullif("v", F.lit(0.0)), F.lit(0.0)))
    return m.select("doc_id", F.col("n").alias("n_tokens"), _r(some, "honore", 4))


@register("word_lengths", f"""WITH w AS (SELECT doc_id, {WORDS} ws FROM documents), s AS (SELECT doc_id, ws, list_transform(list_filter(ws, lambda x: regexp_matches(x, '^\\p{{L}}+$')), lambda x: length(x)) s FROM w)
  SELECT doc_id, round(coalesce(list_avg(s), 0), 6) AS mean_length, coalesce(list_max(s), 0) AS max_length, round(coalesce(list_var_pop(s), 0), 4) AS var_length, round(CASE WHEN len(ws) = 0 THEN 0 ELSE 100.0 * len(list_filter(ws, lambda x: length(x) > 9)) / len(ws) END, 6) AS long_percent FROM s""")
def word_lengths(spark, d):
    w = _t(spark, d, "documents").select("doc_id", T.words(F.col("text")).alias("w"))
    return w.select("doc_id", *[c.alias(k) if k == "max_length" else _r(c, k, 4 if k == "var_length" else 6) for k, c in R.word_lengths(F.col("w")).items()])


@register("sentence_lengths", f"""WITH s AS (SELECT doc_id, list_transform({SENTENCES}, lambda x: len(list_filter(regexp_split_to_array(x, '\\s+'), lambda w: w <> ''))) n FROM documents)
  SELECT doc_id, len(n) AS n_sentences, round(coalesce(list_avg(n), 0), 6) AS mean, len(list_filter(n, lambda x: x < 3)) AS short, round(coalesce(list_stddev_pop(n), 0), 4) AS std, round(list_aggregate(n, 'quantile_cont', 0.25), 4) AS q25, round(list_aggregate(n, 'quantile_cont', 0.5), 4) AS q50, round(list_aggregate(n, 'quantile_cont', 0.75), 4) AS q75 FROM s""")
def sentence_lengths(spark, d):
    n = F.transform(R.sentences(F.col("text")), lambda x: F.size(T.words(x)).cast("double"))
    s = _t(spark, d, "documents").select("doc_id", n.alias("n"))
    some = R.spread(F.col("n"))
    return s.where("size(n) > 0").select("doc_id", F.size("n").alias("n_sentences"), _r(some["mean"], "mean"), F.size(F.filter("n", lambda x: x < 3)).alias("short"), _r(some["std"], "std", 4), *[_r(c, k, 4) for k, c in R.quartiles(F.col("n")).items()]).unionByName(
        s.where("size(n) = 0").select("doc_id", F.lit(0).alias("n_sentences"), F.lit(0.0).alias("mean"), F.lit(0).alias("short"), F.lit(0.0).alias("std"), *[F.lit(None).cast("double").alias(k) for k in ("q25", "q50", "q75")]))


_UP = r"^\p{Lu}"
_REST = f"flatten(list_transform({SENTENCES}, lambda s: (" + TOKENS.replace("coalesce(text, '')", "s") + ")[2:]))"


@register("capitals", f"""WITH t AS (SELECT doc_id, {TOKENS} a, {_REST} r FROM documents), f AS (SELECT doc_id, a, r, list_transform(r, lambda x: regexp_matches(x, '{_UP}')) f FROM t), c AS (SELECT *, len(list_filter(r, lambda x: regexp_matches(x, '{_UP}') AND NOT (upper(x) = x))) k FROM f)
  SELECT doc_id, k AS mid_capitals, round(CASE WHEN len(r) = 0 THEN 0 ELSE k / len(r) END, 6) AS mid_rate, len(list_filter(a, lambda x: length(x) > 1 AND regexp_matches(x, '\\p{{Lu}}') AND upper(x) = x)) AS all_caps,
  len(list_filter(range(2, len(f)), lambda i: f[i] AND f[i - 1] AND NOT f[i + 1])) AS title_runs FROM c""")
def capitals(spark, d):
    c = R.capitals(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", *[_r(v, k) if k == "mid_rate" else v.alias(k) for k, v in c.items()])


@register("specificity", f"""SELECT doc_id, len(regexp_extract_all(text, '{R.EXACT_DATE}')) AS exact_dates, {' + '.join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in R.VAGUE_TIMES)} AS vague_times, {' + '.join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in R.VAGUE_PLACES)} AS vague_places,
  {' + '.join(f"len(regexp_extract_all(text, '{p}'))" for p in R.STREETS)} AS streets FROM documents""")
def specificity(spark, d):
    t = F.col("text")
    return _t(spark, d, "documents").select("doc_id", *[c.alias(k) for k, c in R.specificity(t).items()], T.count_pattern(t, *R.STREETS).alias("streets"))


@register("marker_density", f"""SELECT doc_id, round(CASE WHEN n = 0 THEN 0 ELSE 100.0 * k / n END, 6) AS density FROM (SELECT doc_id, len({WORDS}) n, {' + '.join(f"(length(lower(text)) - length(replace(lower(text), ' {p} ', ''))) // {len(p) + 2}" for v in T.DISCOURSE.values() for p in v)} k FROM documents)""")
def marker_density(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.lower("text").alias("x"), F.size(T.words(F.col("text"))).alias("n"))
    k = sum((T.count_any(F.col("x"), v, True) for v in T.DISCOURSE.values()), F.lit(0))
    return rows.select("doc_id", _r(F.when(F.col("n") == 0, 0.0).otherwise(100.0 * k / F.greatest("n", F.lit(1))), "density"))


@register("ngram_counts", f"""WITH w AS (SELECT conv_id, turn, {LOWER} ws FROM conversations) SELECT conv_id, turn, greatest(len(ws) - 2, 0) AS n3, len(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' ')))) AS types3, greatest(len(ws) - 4, 0) AS n5 FROM w""")
def ngram_counts(spark, d):
    w = _t(spark, d, "conversations").select("conv_id", "turn", T.words(F.lower("text")).alias("w"))
    return w.select("conv_id", "turn", F.size(T.ngrams(F.col("w"), 3)).alias("n3"), F.size(F.array_distinct(T.ngrams(F.col("w"), 3))).alias("types3"), F.size(T.ngrams(F.col("w"), 5)).alias("n5"))


@register("plain_words", "SELECT doc_id, md5(translate(lower(coalesce(text, '')), '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', '')) AS digest FROM documents")
def plain_words(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(R.strip_marks(F.coalesce("text", F.lit("")))).alias("digest"))


@register("sizes_and_clocks", "SELECT event_id, CASE WHEN v < 1024 THEN printf('%.1f B', v) WHEN v < 1048576 THEN printf('%.1f KB', v / 1024) ELSE printf('%.1f MB', v / 1048576) END AS size, printf('%02d:%02d', CAST(floor(floor(v / 1000) / 60) AS BIGINT), CAST(floor(v / 1000) AS BIGINT) % 60) AS clock FROM (SELECT event_id, CAST(event_id % 977 AS DOUBLE) * 4096 v FROM events)")
def sizes_and_clocks(spark, d):
    v = _t(spark, d, "events").select("event_id", ((F.col("event_id") % 977).cast("double") * 4096).alias("v"))
    return v.select("event_id", T.human_size(F.col("v")).alias("size"), T.mm_ss(F.col("v") / 1000).alias("clock"))


# --- matches, reports, plans
_STEM = "regexp_replace(regexp_replace(name, '\\.[^.]*$', ''), '(_transcript|_cleaned)$', '')"


@register("name_index", f"SELECT {_STEM} AS stem, count(*) AS n, array_to_string((list(path ORDER BY path))[1:5], ';') AS paths, max(path) AS last FROM {FILES} GROUP BY 1")
def name_index(spark, d):
    from voxloom.functions.paths import base_stem

    f = files(spark, d).select(base_stem(F.col("name")).alias("stem"), "path")
    return O.stem_index(f, "stem", "path").join(O.name_index(f, "stem", "path").withColumnRenamed("path", "last"), "stem").select("stem", "n", F.array_join("paths", ";").alias("paths"), "last")


@register("fuzzy_match", """WITH i AS (SELECT CAST(n_nationkey AS VARCHAR) id FROM nation UNION SELECT s_name FROM supplier WHERE s_acctbal > 0 UNION SELECT concat(s_name, '-x') FROM supplier WHERE s_acctbal < 0), n AS (SELECT s_name AS name FROM supplier),
  j AS (SELECT id, name, CASE WHEN id = name THEN 0 ELSE 1 END o FROM i JOIN n ON id = name OR contains(name, id) OR contains(id, name)), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY o, length(name), name) k FROM j) SELECT id, name, CASE WHEN o = 0 THEN 'exact' ELSE 'part' END AS how FROM r WHERE k = 1""")
def fuzzy_match(spark, d):
    s = _t(spark, d, "supplier")
    ids = _t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id")).unionByName(s.where("s_acctbal > 0").select(F.col("s_name").alias("id"))).unionByName(s.where("s_acctbal < 0").select(F.concat("s_name", F.lit("-x")).alias("id"))).distinct()
    return O.fuzzy_match(ids, s.select(F.col("s_name").alias("name")))


@register("paired_outputs", """WITH n AS (SELECT concat(o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '.labels' WHEN o_orderkey % 3 = 1 THEN '.plain' ELSE '.labels.old' END) AS name FROM orders UNION ALL SELECT concat(o_orderkey, '.plain') FROM orders WHERE o_orderstatus = 'F'), i AS (SELECT DISTINCT CAST(1000 + c_nationkey AS VARCHAR) id FROM customer)
  SELECT id, min(name) FILTER (suffix(name, '.labels')) AS first, min(name) FILTER (suffix(name, '.plain')) AS second FROM i JOIN n ON contains(name, id) GROUP BY 1 HAVING count(*) FILTER (suffix(name, '.labels')) > 0 AND count(*) FILTER (suffix(name, '.plain')) > 0""")
def paired_outputs(spark, d):
    o = _t(spark, d, "orders")
    names = o.selectExpr("concat(o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '.labels' WHEN o_orderkey % 3 = 1 THEN '.plain' ELSE '.labels.old' END) AS name").unionByName(o.where("o_orderstatus = 'F'").selectExpr("concat(o_orderkey, '.plain') AS name"))
    return O.paired(_t(spark, d, "customer").selectExpr("CAST(1000 + c_nationkey AS STRING) AS id").distinct(), names, ".labels", ".plain")


@register("prefix_match", "SELECT stem, min(p_name) AS name FROM (SELECT DISTINCT left(p_name, 5) stem FROM part) JOIN part ON starts_with(p_name, stem) GROUP BY 1")
def prefix_match(spark, d):
    p = _t(spark, d, "part")
    return O.starting(p.select(F.substring("p_name", 1, 5).alias("stem")).distinct(), p.select(F.col("p_name").alias("name")), [5]).select("stem", "name")


@register("match_classes", "SELECT n_nationkey AS k, count(s_suppkey) AS n, CASE count(s_suppkey) WHEN 0 THEN 'none' WHEN 1 THEN 'single' ELSE 'multiple' END AS kind FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 6000 GROUP BY 1")
def match_classes(spark, d):
    return O.match_class(_t(spark, d, "nation").select(F.col("n_nationkey").alias("k")), _t(spark, d, "supplier").where("s_acctbal > 6000").select(F.col("s_nationkey").alias("k")), "k")


@register("stem_join", "SELECT w.doc_id, r.last FROM labels w LEFT JOIN (SELECT doc_id % 500 AS k, max(source) last FROM documents GROUP BY 1) r ON w.doc_id = r.k")
def stem_join(spark, d):
    r = _t(spark, d, "documents").select((F.col("doc_id") % 500).alias("doc_id"), "source").groupBy("doc_id").agg(F.max("source").alias("last"))
    return _t(spark, d, "labels").select("doc_id").join(r, "doc_id", "left")


@register("copies_plan", """WITH f AS (SELECT doc_id, concat('f', doc_id % 300, CASE WHEN doc_id >= 300 THEN concat(' ', doc_id // 300) ELSE '' END, '.txt') AS name, md5(coalesce(text, '')) dg, length(coalesce(text, '')) sz, concat('f', doc_id % 300, '.txt') base, doc_id // 300 number FROM documents),
  g AS (SELECT base, count(*) n, count(DISTINCT sz) a, count(DISTINCT dg) b, min(number) low FROM f GROUP BY 1 HAVING count(*) > 1) SELECT doc_id, f.base, CASE WHEN number = low THEN 'keep' WHEN a = 1 AND b = 1 THEN 'delete' ELSE 'review' END AS action FROM f JOIN g USING (base)""")
def copies_plan(spark, d):
    f = _t(spark, d, "documents").select("doc_id", F.expr("concat('f', doc_id % 300, CASE WHEN doc_id >= 300 THEN concat(' ', doc_id div 300) ELSE '' END, '.txt')").alias("name"), F.md5(F.coalesce("text", F.lit(""))).alias("dg"), F.length(F.coalesce("text", F.lit(""))).alias("sz"))
    return O.copies_plan(f, "name", "sz", "dg").select("doc_id", "base", "action")


@register("path_tallies", "SELECT page_id % 40 AS k, count(*) AS n, bool_or(contains(lower(url), 'deid')) AS deid, bool_or(contains(lower(url), 'duplicate')) AS duplicate, bool_or(contains(lower(url), 'original')) AS original, count(DISTINCT length(html)) > 1 AS sizes_differ FROM pages GROUP BY 1 HAVING count(*) > 1")
def path_tallies(spark, d):
    return O.path_tallies(_t(spark, d, "pages").select((F.col("page_id") % 40).alias("k"), "url", F.length("html").alias("size")), "k", "url", "size")


@register("format_counts", "SELECT p_brand, p_size, count(*) AS n, bool_or(p_size > 48) AS any_violation FROM part GROUP BY 1, 2")
def format_counts(spark, d):
    return _t(spark, d, "part").groupBy("p_brand", "p_size").agg(F.count("*").alias("n"), F.bool_or(F.col("p_size") > 48).alias("any_violation"))


@register("file_totals", "SELECT coalesce(event_type, 'all') AS file, count(*) AS n, count(value) AS ok, round(coalesce(sum(abs(value)), 0), 2) AS seconds, round(100.0 * count(value) / count(*), 4) AS percent FROM events GROUP BY GROUPING SETS ((event_type), ())")
def file_totals(spark, d):
    e = _t(spark, d, "events").select(F.explode(F.array("event_type", F.lit("all"))).alias("file"), "value")
    return e.groupBy("file").agg(F.count("*").alias("n"), F.count("value").alias("ok"), _r(F.coalesce(F.sum(F.abs("value")), F.lit(0.0)), "seconds", 2), _r(100.0 * F.count("value") / F.count("*"), "percent", 4))


@register("first_intervals", "SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY 2, 3")
def first_intervals(spark, d):
    return O.first_by(_t(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"], "event_id")


@register("status_counts", "SELECT CASE WHEN value IS NULL THEN 'error' WHEN event_type = 'view' THEN 'skipped' ELSE 'processed' END AS status, count(*) AS n FROM events GROUP BY 1")
def status_counts(spark, d):
    return _t(spark, d, "events").groupBy(F.when(F.col("value").isNull(), "error").when(F.col("event_type") == "view", "skipped").otherwise("processed").alias("status")).agg(F.count("*").alias("n"))


@register("coverage", "SELECT 'measures' AS family, count(*) * 2 AS n_cells, count(*) * 2 - count(value) - count(user_id) AS n_missing, round(100.0 * (count(value) + count(user_id)) / (count(*) * 2), 4) AS percent FROM events UNION ALL SELECT 'ids', count(*), count(*) - count(event_id), round(100.0 * count(event_id) / count(*), 4) FROM events")
def coverage(spark, d):
    return O.coverage(_t(spark, d, "events"), {"measures": ["value", "user_id"], "ids": ["event_id"]}).withColumn("percent", F.round("percent", 4))


@register("risk_order", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 3 END, event_id) AS place FROM events")
def risk_order(spark, d):
    from pyspark.sql import Window as W

    risk = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "view", 2).otherwise(3)
    return _t(spark, d, "events").select("user_id", "event_id", F.row_number().over(W.partitionBy("user_id").orderBy(risk, "event_id")).alias("place"))


@register("next_batch", "SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = e.event_id) ORDER BY event_id LIMIT 25")
def next_batch(spark, d):
    """The next files of a batch: the limit is the feature."""
    done = _t(spark, d, "labels").select(F.col("doc_id").alias("event_id"))
    return _t(spark, d, "events").select("event_id").join(done, "event_id", "left_anti").orderBy("event_id").limit(25)


@register("log_union", "SELECT doc_id, lang FROM documents WHERE lang = 'en' UNION SELECT doc_id, lang FROM documents WHERE length(text) > 1000")
def log_union(spark, d):
    t = _t(spark, d, "documents")
    return t.where("lang = 'en'").select("doc_id", "lang").union(t.where("length(text) > 1000").select("doc_id", "lang")).distinct()


@register("batch_concat", "SELECT doc_id, lang, NULL::INT AS quality FROM documents UNION ALL SELECT doc_id, NULL, quality FROM labels")
def batch_concat(spark, d):
    return _t(spark, d, "documents").select("doc_id", "lang").unionByName(_t(spark, d, "labels").select("doc_id", F.col("quality").cast("int").alias("quality")), allowMissingColumns=True)


@register("task_rows", "SELECT c_custkey, 'GrandfatherPassage' AS task, c_custkey % 100 AS start, c_custkey % 100 + 30 AS stop FROM customer UNION ALL SELECT c_custkey, 'SpontSpeech', c_custkey % 77, c_custkey % 77 + 60 FROM customer")
def task_rows(spark, d):
    """A row for each task of a table with a start and a stop column a task."""
    c = _t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 100).alias("GrandfatherPassageStart"), (F.col("c_custkey") % 100 + 30).alias("GrandfatherPassageStop"), (F.col("c_custkey") % 77).alias("SpontSpeechStart"), (F.col("c_custkey") % 77 + 60).alias("SpontSpeechStop"))
    each = F.array(*[F.struct(F.lit(t).alias("task"), F.col(f"{t}Start").alias("start"), F.col(f"{t}Stop").alias("stop")) for t in ("GrandfatherPassage", "SpontSpeech")])
    return c.select("c_custkey", F.inline(each))


# --- regions and overlaps
REGIONS = "(SELECT user_id, floor(epoch(ts) / 600)::BIGINT * 600 AS start, floor(epoch(ts) / 600)::BIGINT * 600 + 300 + event_id % 900 AS \"end\" FROM events)"


def _regions(spark, d):
    at = (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 600e6) * 600).alias("start")
    return _t(spark, d, "events").select("user_id", at, (at + 300 + F.col("event_id") % 900).alias("end"))


@register("region_gaps", f"""WITH r AS (SELECT user_id, start, "end" e, lag("end", 1, 0) OVER w b, lead(start) OVER w n FROM {REGIONS} WINDOW w AS (PARTITION BY user_id ORDER BY start, "end")), g AS (SELECT user_id, b AS start, start AS "end" FROM r UNION ALL SELECT user_id, e, 2000000000 FROM r WHERE n IS NULL)
  SELECT user_id, start, "end" FROM g WHERE "end" - start > 800""")
def region_gaps(spark, d):
    return O.gaps(_regions(spark, d), "user_id", F.lit(2000000000).cast("long")).select("user_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@register("frame_regions", """WITH f AS (SELECT DISTINCT user_id, floor(epoch(ts) / 3600)::BIGINT % 2000 AS h FROM events), g AS (SELECT user_id, h, h - row_number() OVER (PARTITION BY user_id ORDER BY h) g FROM f), r AS (SELECT user_id, min(h) * 160 s, (max(h) + 1) * 160 + 400 e FROM g GROUP BY user_id, g)
  SELECT user_id, s AS start, CASE WHEN s = max(s) OVER (PARTITION BY user_id) THEN least(e, 300000) ELSE e END AS "end" FROM r""")
def frame_regions(spark, d):
    f = _t(spark, d, "events").select("user_id", (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3600e6) % 2000).alias("h"))
    return O.frame_regions(f, "user_id", "h", 160, 400, F.lit(300000).cast("long"))


@register("overlap_speakers", """WITH i AS (SELECT user_id, event_id AS item, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT + 7200 AS e FROM events WHERE event_type = 'click'), t AS (SELECT user_id, event_type AS speaker, floor(epoch(ts))::BIGINT - 3600 s, floor(epoch(ts))::BIGINT + 3600 e FROM events WHERE event_type IN ('view', 'purchase', 'signup')),
  o AS (SELECT i.user_id, item, speaker, sum(least(i.e, t.e) - greatest(i.s, t.s)) o FROM i JOIN t ON i.user_id = t.user_id AND least(i.e, t.e) > greatest(i.s, t.s) GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY o DESC, speaker) k FROM o)
  SELECT i.item, coalesce(r.speaker, 'UNKNOWN') AS speaker FROM i LEFT JOIN r ON r.item = i.item AND k = 1""")
def overlap_speakers(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", "event_type", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    i = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("item"), F.col("at").alias("start"), (F.col("at") + 7200).alias("end"))
    t = e.where("event_type IN ('view', 'purchase', 'signup')").select("user_id", F.col("event_type").alias("speaker"), (F.col("at") - 3600).alias("start"), (F.col("at") + 3600).alias("end"))
    return O.assign_by_overlap(i, t, "user_id", 7200).select("item", "speaker")


@register("vector_sums", "SELECT label, i AS place, round(sum(x), 3) AS total FROM (SELECT label, unnest(embedding::DOUBLE[]) x, generate_subscripts(embedding, 1) - 1 i FROM embeddings) GROUP BY 1, 2")
def vector_sums(spark, d):
    e = _t(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("place", "x"))
    return e.groupBy("label", "place").agg(_r(F.sum(F.col("x").cast("double")), "total", 3)).select("label", F.col("place").cast("long").alias("place"), "total")


@register("word_vectors", f"""WITH v AS (SELECT DISTINCT x AS word FROM (SELECT unnest({LOWER}) x FROM benchmark)), e AS (SELECT doc_id, unnest({LOWER}) word FROM documents) SELECT doc_id, count(*) AS n_found, sum(length(word))::BIGINT AS first, sum(ascii(word))::BIGINT AS second FROM e JOIN v USING (word) GROUP BY 1""")
def word_vectors(spark, d):
    """Sums of the vectors of a text's words; words without a vector go."""
    v = _t(spark, d, "benchmark").select(F.explode(T.words(F.lower("text"))).alias("word")).distinct().select("word", F.array(F.length("word").cast("double"), F.ascii("word").cast("double")).alias("vector"))
    found = _t(spark, d, "documents").select("doc_id", F.explode(T.words(F.lower("text"))).alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("c")).join(v, "word")
    return found.groupBy("doc_id").agg(F.sum("c").alias("n_found"), *[F.sum(F.col("c") * F.get("vector", F.lit(i))).cast("long").alias(k) for i, k in enumerate(("first", "second"))])


@register("window_pairs", """WITH e AS (SELECT label, vec_id, embedding::DOUBLE[] v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 i FROM embeddings), w AS (SELECT *, i // 3 AS w FROM e)
  SELECT a.label, a.w AS win, count(*) AS n, round(avg(list_cosine_similarity(a.v, b.v)), 5) AS mean FROM w a JOIN w b ON a.label = b.label AND a.w = b.w AND a.i < b.i GROUP BY 1, 2""")
def window_pairs(spark, d):
    """Mean cosine of all pairs within windows of three vectors."""
    from pyspark.sql import Window as W

    e = _t(spark, d, "embeddings").select("label", "vec_id", "embedding", (F.row_number().over(W.partitionBy("label").orderBy("vec_id")) - 1).alias("i"))
    g = e.groupBy("label", F.floor(F.col("i") / 3).alias("win")).agg(F.array_sort(F.collect_list(F.struct("i", F.col("embedding").alias("v")))).alias("a"))
    pair = lambda i, j: F.when(F.size("a") > j, T.cosine(F.get("a", F.lit(i))["v"], F.get("a", F.lit(j))["v"]))
    all_pairs = F.filter(F.array(pair(0, 1), pair(0, 2), pair(1, 2)), lambda c: c.isNotNull())
    return g.select("label", "win", all_pairs.alias("c")).where("size(c) > 0").select("label", "win", F.size("c").cast("long").alias("n"), _r(F.aggregate("c", F.lit(0.0), lambda s, x: s + x) / F.size("c"), "mean", 5))


@register("lag_coherence", "WITH e AS (SELECT label, embedding::DOUBLE[] v, lead(embedding::DOUBLE[], 3) OVER (PARTITION BY label ORDER BY vec_id) n3, lead(embedding::DOUBLE[], 5) OVER (PARTITION BY label ORDER BY vec_id) n5 FROM embeddings) SELECT label, round(avg(list_cosine_similarity(v, n3)), 5) AS mean_3, round(avg(list_cosine_similarity(v, n5)), 5) AS mean_5, round(min(list_cosine_similarity(v, n5)), 5) AS low_5 FROM e GROUP BY 1")
def lag_coherence(spark, d):
    from pyspark.sql import Window as W

    w = W.partitionBy("label").orderBy("vec_id")
    e = _t(spark, d, "embeddings").select("label", F.col("embedding").alias("v"), F.lead("embedding", 3).over(w).alias("n3"), F.lead("embedding", 5).over(w).alias("n5"))
    c = e.select("label", T.cosine(F.col("v"), F.col("n3")).alias("c3"), T.cosine(F.col("v"), F.col("n5")).alias("c5"))
    return c.groupBy("label").agg(_r(F.avg("c3"), "mean_3", 5), _r(F.avg("c5"), "mean_5", 5), _r(F.min("c5"), "low_5", 5))


@register("graph_clustering", f"""WITH w AS (SELECT conv_id, turn, {LOWER} ws FROM conversations), p AS (SELECT conv_id, turn, unnest(ws) a, unnest(ws[2:]) b FROM w), e AS (SELECT DISTINCT conv_id, turn, least(a, b) a, greatest(a, b) b FROM p WHERE b IS NOT NULL AND a <> b),
  n AS (SELECT conv_id, turn, a AS x, b AS y FROM e UNION ALL SELECT conv_id, turn, b, a FROM e), g AS (SELECT conv_id, turn, x, count(*) k FROM n GROUP BY ALL), t AS (SELECT u.conv_id, u.turn, u.x, count(*) c FROM n u JOIN n v ON u.conv_id = v.conv_id AND u.turn = v.turn AND u.x = v.x AND u.y < v.y JOIN e ON e.conv_id = u.conv_id AND e.turn = u.turn AND e.a = u.y AND e.b = v.y GROUP BY ALL),
  s AS (SELECT g.conv_id, g.turn, sum(CASE WHEN k > 1 THEN 2.0 * coalesce(c, 0) / (k * (k - 1)) ELSE 0 END) s FROM g LEFT JOIN t USING (conv_id, turn, x) GROUP BY 1, 2) SELECT conv_id, turn, round(CASE WHEN len(ws) = 0 THEN 0 ELSE coalesce(s, 0) / len(list_distinct(ws)) END, 6) AS clustering, least(len(ws), 1) AS components FROM w LEFT JOIN s USING (conv_id, turn)""")
def graph_clustering(spark, d):
    """Mean clustering of the graph of neighbouring words. A text's words follow
    each other, so its graph is one component. Neighbours of a node are looked
    up inside the row, by sets of hashed edges."""
    c = _t(spark, d, "conversations").select("conv_id", "turn", T.words(F.lower("text")).alias("w"))
    pairs = F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), lambda x, i: F.struct(F.least(x, F.get("w", i + 1)).alias("a"), F.greatest(x, F.get("w", i + 1)).alias("b")))
    e = c.select("conv_id", "turn", F.explode(F.filter(F.array_distinct(pairs), lambda p: p["a"] != p["b"])).alias("p")).select("conv_id", "turn", "p.a", "p.b")
    both = e.unionByName(e.select("conv_id", "turn", F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("conv_id", "turn", "a").agg(F.array_sort(F.collect_set("b")).alias("near"))
    near = both.groupBy("conv_id", "turn").agg(F.map_from_entries(F.collect_list(F.struct("a", "near"))).alias("m"))
    one = lambda k, v: F.when(F.size(v) > 1, F.aggregate(v, F.lit(0.0), lambda s, y: s + F.size(F.array_intersect(v, F.try_element_at("m", y)))) / (F.size(v) * (F.size(v) - 1))).otherwise(0.0)
    total = F.aggregate(F.map_values(F.transform_values("m", one)), F.lit(0.0), lambda s, x: s + x)
    n = F.size(F.array_distinct("w"))
    return c.join(near, ["conv_id", "turn"], "left").select("conv_id", "turn", _r(F.when(n == 0, 0.0).otherwise(F.coalesce(total, F.lit(0.0)) / F.greatest(n, F.lit(1))), "clustering"), F.least(F.size("w"), F.lit(1)).alias("components"))
