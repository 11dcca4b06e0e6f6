"""The engine's registered queries with SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.operators import files as O
from voxloom.operators import speech as S
from voxloom.plans.catalog import register

WORDS = r"list_filter(regexp_split_to_array(coalesce(text,''), '\s+'), lambda x: x <> '')"
LOWER = WORDS.replace("coalesce(text,'')", "lower(coalesce(text,''))")


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _r(c, name, places=6):
    return F.round(c, places).alias(name)


def _sub(part, col="x"):
    p = part.replace("'", "''")
    return f"((length({col}) - length(replace({col}, '{p}', ''))) // {len(part)})"


def _subs(parts, padded=False):
    return "(" + " + ".join(_sub(f" {p} " if padded else p) for p in parts) + ")"


def _lex_sql(table, keys):
    return f"""WITH w AS (SELECT {keys}, {LOWER} AS ws FROM {table}),
    c AS (SELECT {keys}, ws, len(ws) n, len(list_distinct(ws)) v, map_values(list_histogram(ws)) f FROM (SELECT {keys}, ws, list_histogram(ws) FROM w)),
    m AS (SELECT {keys}, ws, n, v, coalesce(len(list_filter(f, lambda x: x = 1)), 0) v1, coalesce(list_sum(list_transform(f, lambda x: x * x)), 0) m2 FROM c)
    SELECT {keys}, n AS n_words, v AS n_types, v1 AS n_once, round(CASE WHEN n = 0 THEN 0 ELSE v / n END, 6) AS ttr,
      round(CASE WHEN n = 0 THEN 0 ELSE pow(v, -0.165) * ln(n) END, 6) AS brunet,
      round(CASE WHEN n = 0 OR v1 = v THEN 0 ELSE 100 * v / (1 - v1 / v) END, 4) AS honore,
      round(CASE WHEN n = 0 THEN 0 ELSE 10000.0 * (m2 - n) / (n * n) END, 4) AS yule_k FROM m"""


def lexical(rows, *keys):
    w = rows.select(*keys, T.words(F.lower("text")).alias("ws"))
    f = w.select(*keys, "ws", F.size("ws").alias("n"), T.frequencies(F.col("ws")).alias("f"))
    m = f.select(*keys, "ws", "n", F.when(F.col("n") == 0, 0).otherwise(F.size("f")).alias("v"), F.size(F.filter("f", lambda x: (x == 1) & (F.col("n") > 0))).alias("v1"),
                 F.aggregate("f", F.lit(0).cast("long"), lambda a, x: a + x * x).alias("m2"))
    n, v, v1 = F.col("n"), F.col("v"), F.col("v1")
    some = F.nullif(n, F.lit(0))
    return m.select(*keys, n.alias("n_words"), v.alias("n_types"), v1.alias("n_once"), _r(F.coalesce(v / some, F.lit(0.0)), "ttr"),
                    _r(F.coalesce(F.pow(v.cast("double"), F.lit(-0.165)) * F.ln(some), F.lit(0.0)), "brunet"),
                    _r(F.when((n == 0) | (v1 == v), 0.0).otherwise(100 * v / F.nullif(1 - v1 / F.nullif(v, F.lit(0)), F.lit(0.0))), "honore", 4),
                    _r(F.coalesce(10000.0 * (F.col("m2") - n) / (some * some), F.lit(0.0)), "yule_k", 4))


VIEWS = "(SELECT conv_id, coalesce(role, 'combined') AS speaker, string_agg(coalesce(text,''), ' ' ORDER BY turn) AS text FROM conversations GROUP BY GROUPING SETS ((conv_id, role), (conv_id)))"


def _views(spark, d):
    return S.speaker_views(_t(spark, d, "conversations"), "conv_id", "role", "turn", "text")


@register("speaker_views", f"SELECT conv_id, speaker, md5(text) AS digest, length(text) AS n_chars FROM {VIEWS}")
def speaker_views(spark, d):
    return _views(spark, d).select("conv_id", "speaker", F.md5("text").alias("digest"), F.length("text").alias("n_chars"))


@register("speaker_lexical", _lex_sql(VIEWS, "conv_id, speaker"))
def speaker_lexical(spark, d):
    return lexical(_views(spark, d), "conv_id", "speaker")


@register("lexical_core", _lex_sql("documents", "doc_id"))
def lexical_core(spark, d):
    return lexical(_t(spark, d, "documents"), "doc_id")


@register("mattr", f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents) SELECT doc_id, round(CASE WHEN len(ws) = 0 THEN 0 WHEN len(ws) < 50 THEN len(list_distinct(ws)) / len(ws)
  ELSE list_sum(list_transform(range(1, len(ws) - 48), lambda i: len(list_distinct(ws[i:i+49])))) / ((len(ws) - 49) * 50.0) END, 6) AS mattr_50 FROM w""")
def mattr(spark, d):
    return _t(spark, d, "documents").select("doc_id", T.words(F.col("text")).alias("w")).select("doc_id", _r(T.mattr(F.col("w"), 50), "mattr_50"))


@register("filler_markers", f"""SELECT doc_id, {_subs(T.FILLED_PAUSES)} AS filled_pauses, len(list_filter(w, lambda v: v IN ({", ".join(repr(x) for x in T.FILLERS)}))) AS fillers,
  len(list_filter(w, lambda v: v IN ({", ".join(repr(x) for x in T.UMS_AHS)}))) AS ums_ahs, {_subs(T.CORRECTIONS)} AS corrections, {_sub('-')} + {_sub('...')} AS restarts
  FROM (SELECT doc_id, lower(text) x, {LOWER} w FROM documents)""")
def filler_markers(spark, d):
    x, w = F.lower("text"), T.words(F.lower("text"))
    return _t(spark, d, "documents").select("doc_id", T.count_any(x, T.FILLED_PAUSES).alias("filled_pauses"), T.among(w, T.FILLERS).alias("fillers"), T.among(w, T.UMS_AHS).alias("ums_ahs"),
                                            T.count_any(x, T.CORRECTIONS).alias("corrections"), (T.count_of(x, "-") + T.count_of(x, "...")).alias("restarts"))


@register("discourse_markers", "SELECT doc_id, " + ", ".join(f"{_subs(v, True)} AS {k}" for k, v in T.DISCOURSE.items()) + f", {_subs(T.CLARIFICATION)} AS clarification FROM (SELECT doc_id, lower(text) x FROM documents)")
def discourse_markers(spark, d):
    x = F.lower("text")
    return _t(spark, d, "documents").select("doc_id", *[T.count_any(x, v, True).alias(k) for k, v in T.DISCOURSE.items()], T.count_any(x, T.CLARIFICATION).alias("clarification"))


@register("narrative_markers", "SELECT doc_id, " + ", ".join(f"{_subs(v)} AS {k}" for k, v in T.NARRATIVE.items()) + " FROM (SELECT doc_id, lower(text) x FROM documents)")
def narrative_markers(spark, d):
    x = F.lower("text")
    return _t(spark, d, "documents").select("doc_id", *[T.count_any(x, v).alias(k) for k, v in T.NARRATIVE.items()])


def _rx(p, col="text"):
    return f"len(regexp_extract_all({col}, '{p}'))"


@register("temporal_markers", f"""SELECT doc_id, {" + ".join(_rx(p) for p in T.DATES)} AS dates, {_subs(T.MONTHS)} AS months, {_subs(T.DAYS)} AS days, {_rx(T.YEAR)} AS years, {_rx(T.CLOCK)} AS times,
  {_rx(T.AMPM, 'x')} AS ampm, {_subs(T.RELATIVE)} AS relative, {_rx(T.AGE, 'x')} AS over_89 FROM (SELECT doc_id, text, lower(text) x FROM documents)""")
def temporal_markers(spark, d):
    t, x = F.col("text"), F.lower("text")
    return _t(spark, d, "documents").select("doc_id", T.count_pattern(t, *T.DATES).alias("dates"), T.count_any(x, T.MONTHS).alias("months"), T.count_any(x, T.DAYS).alias("days"), T.count_pattern(t, T.YEAR).alias("years"),
                                            T.count_pattern(t, T.CLOCK).alias("times"), T.count_pattern(x, T.AMPM).alias("ampm"), T.count_any(x, T.RELATIVE).alias("relative"), T.count_pattern(x, T.AGE).alias("over_89"))


@register("spatial_markers", f"""SELECT doc_id, {_rx(T.CITY_STATE)} AS city_state, {_rx(T.ZIP_CODE)} AS zips, {_subs(T.LANDMARKS)} AS landmarks, {_subs(T.PREPOSITIONS, True)} AS prepositions FROM (SELECT doc_id, text, lower(text) x FROM documents)""")
def spatial_markers(spark, d):
    t, x = F.col("text"), F.lower("text")
    return _t(spark, d, "documents").select("doc_id", T.count_pattern(t, T.CITY_STATE).alias("city_state"), T.count_pattern(t, T.ZIP_CODE).alias("zips"), T.count_any(x, T.LANDMARKS).alias("landmarks"), T.count_any(x, T.PREPOSITIONS, True).alias("prepositions"))


@register("word_repetitions", f"""SELECT conv_id, turn, len(list_filter(w, lambda v, i: i > 1 AND v = w[i-1])) AS repeats, len(w) - len(list_filter(w, lambda v, i: i > 1 AND v = w[i-1])) AS n_without FROM (SELECT conv_id, turn, {LOWER} w FROM conversations)""")
def word_repetitions(spark, d):
    c = _t(spark, d, "conversations").select("conv_id", "turn", T.words(F.lower("text")).alias("w"))
    return c.select("conv_id", "turn", T.repeats(F.col("w")).alias("repeats"), F.size(T.without_repeats(F.col("w"))).alias("n_without"))


@register("run_lengths", f"""WITH w AS (SELECT doc_id, {WORDS} ws FROM documents), e AS (SELECT doc_id, unnest(ws) x, generate_subscripts(ws, 1) i, len(ws) n FROM w),
  f AS (SELECT doc_id, i, n, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) g FROM e WHERE regexp_matches(x, '^[A-Z]')), r AS (SELECT doc_id, count(*) k FROM f GROUP BY doc_id, g HAVING count(*) >= 2 AND max(i) < max(n))
  SELECT doc_id, count(k) AS n_runs, coalesce(max(k), 0) AS longest FROM (SELECT doc_id FROM documents) LEFT JOIN r USING (doc_id) GROUP BY doc_id""")
def run_lengths(spark, d):
    flags = F.transform(T.words(F.col("text")), lambda x: x.rlike("^[A-Z]"))
    rows = _t(spark, d, "documents").select("doc_id", flags.alias("f"))
    n, most = T.runs(F.col("f"))
    return rows.select("doc_id", n.cast("long").alias("n_runs"), most.cast("long").alias("longest"))


TURNS = "(SELECT user_id, event_type AS speaker, epoch(ts) AS s, epoch(ts) + abs(value) AS e FROM events WHERE value IS NOT NULL)"


def _turns(spark, d):
    return _t(spark, d, "events").where("value IS NOT NULL").select("user_id", F.col("event_type").alias("speaker"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"),
                                                                   (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 + F.abs("value")).alias("e"))


@register("turn_taking", f"""WITH n AS (SELECT *, lead(s) OVER w s2, lead(e) OVER w e2, lead(speaker) OVER w p2 FROM {TURNS} WINDOW w AS (PARTITION BY user_id ORDER BY s, e, speaker))
  SELECT user_id, CASE WHEN s2 IS NULL THEN 'last' WHEN s2 < e THEN 'overlap' WHEN p2 = speaker THEN 'pause' ELSE 'gap' END AS follows, count(*) AS n, round(sum(CASE WHEN s2 < e THEN least(e, e2) - s2 ELSE s2 - e END), 2) AS seconds FROM n GROUP BY 1, 2""")
def turn_taking(spark, d):
    return S.turn_taking(_turns(spark, d), "user_id", "s", "e", "speaker").groupBy("user_id", "follows").agg(F.count("*").alias("n"), _r(F.sum("seconds"), "seconds", 2))


@register("nearest_speaker", """WITH w AS (SELECT event_id, user_id, epoch(ts) mid FROM events WHERE event_type = 'click'), t AS (SELECT user_id, event_type AS speaker, epoch(ts) s, epoch(ts) + 3600 e FROM events WHERE event_type IN ('view', 'purchase')),
  j AS (SELECT event_id, speaker, row_number() OVER (PARTITION BY event_id ORDER BY CASE WHEN mid BETWEEN s AND e THEN 0 ELSE 1 END, CASE WHEN mid BETWEEN s AND e THEN 0 ELSE least(abs(mid - s), abs(mid - e)) END, s, speaker) r FROM w LEFT JOIN t USING (user_id))
  SELECT event_id, coalesce(speaker, 'UNKNOWN') AS speaker FROM j WHERE r = 1""")
def nearest_speaker(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"))
    w = e.where("event_type = 'click'").select("event_id", "user_id", F.col("s").alias("mid"))
    t = e.where("event_type IN ('view', 'purchase')").select("user_id", F.col("event_type").alias("speaker"), F.col("s").alias("start"), (F.col("s") + 3600).alias("end"))
    return S.nearest_speaker(w, t, "user_id").select("event_id", "speaker")


@register("interval_lines", """WITH i AS (SELECT user_id, event_id AS name, epoch(ts) s, epoch(ts) + 86400 e FROM events WHERE event_type = 'signup') SELECT i.name AS task, count(*) AS n_lines, sum(v.event_id)::BIGINT AS ids
  FROM events v JOIN i ON v.user_id = i.user_id AND epoch(v.ts) BETWEEN i.s AND i.e GROUP BY 1""")
def interval_lines(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    i = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("task"), F.col("at").alias("start"), (F.col("at") + 86400).alias("end"))
    return S.in_intervals(e.select("user_id", "event_id", "at"), i, "user_id", "at", 86400).groupBy("task").agg(F.count("*").alias("n_lines"), F.sum("event_id").alias("ids"))


@register("substring_match", """WITH j AS (SELECT n_nationkey::VARCHAR AS id, s_name AS name FROM nation JOIN supplier ON contains(s_name, n_nationkey::VARCHAR)),
  r AS (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY length(name), name) k, count(*) OVER (PARTITION BY id) n FROM j) SELECT id, name, n AS n_matches FROM r WHERE k = 1""")
def substring_match(spark, d):
    return S.shortest_containing(_t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id")), _t(spark, d, "supplier").select(F.col("s_name").alias("name")))


@register("priority_match", """WITH c AS (SELECT s_nationkey AS k, s_name AS name, CASE WHEN s_acctbal > 5000 THEN 0 WHEN s_acctbal > 0 THEN 1 ELSE 2 END p FROM supplier), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, name) i, count(*) OVER (PARTITION BY k) n FROM c)
  SELECT k AS nation, name, n AS n_candidates, CASE WHEN n = 1 THEN 'single' ELSE 'priority_' || p END AS reason FROM r WHERE i = 1""")
def priority_match(spark, d):
    s = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), "s_acctbal")
    return S.ranked_choice(s, "nation", "name", F.when(F.col("s_acctbal") > 5000, 0).when(F.col("s_acctbal") > 0, 1).otherwise(2))


@register("anti_processed", "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_processed(spark, d):
    return _t(spark, d, "documents").select("doc_id", "source").join(_t(spark, d, "labels"), "doc_id", "left_anti")


@register("anti_composite", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderpriority = o.o_orderpriority AND p.o_orderstatus = 'F')")
def anti_composite(spark, d):
    o = _t(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    return o.select("o_custkey", "o_orderpriority").distinct().join(o.where("o_orderstatus = 'F'"), ["o_custkey", "o_orderpriority"], "left_anti")


@register("norms_lookup", f"""WITH n AS (SELECT x AS word, avg(length(text)) AS norm FROM (SELECT unnest(list_distinct({LOWER})) x, text FROM benchmark) GROUP BY 1), e AS (SELECT doc_id, unnest({LOWER}) word FROM documents)
  SELECT d.doc_id, count(norm) AS n_found, round(coalesce(avg(norm) FILTER (norm > 0), 0), 4) AS mean_norm FROM documents d LEFT JOIN (SELECT e.doc_id, norm FROM e JOIN n USING (word)) j ON j.doc_id = d.doc_id GROUP BY 1""")
def norms_lookup(spark, d):
    n = _t(spark, d, "benchmark").select(F.explode(F.array_distinct(T.words(F.lower("text")))).alias("word"), F.length("text").alias("l")).groupBy("word").agg(F.avg("l").alias("norm"))
    docs = _t(spark, d, "documents").select("doc_id", "text")
    found = docs.select("doc_id", F.explode(T.words(F.lower("text"))).alias("word")).join(n, "word").groupBy("doc_id").agg(F.count("norm").alias("n_found"), F.avg(F.when(F.col("norm") > 0, F.col("norm"))).alias("m"))
    return docs.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("n_found", F.lit(0)).alias("n_found"), _r(F.coalesce("m", F.lit(0.0)), "mean_norm", 4))


@register("phrase_spans", f"""WITH t AS (SELECT doc_id, {LOWER} w FROM documents), e AS (SELECT doc_id, w, unnest(w) x, generate_subscripts(w, 1) i FROM t), p AS (SELECT item_id, {LOWER} pw FROM benchmark)
  SELECT doc_id, item_id, i - 1 AS pos FROM e JOIN p ON e.x = p.pw[1] AND e.w[i:i+len(p.pw)-1] = p.pw""")
def phrase_spans(spark, d):
    t = _t(spark, d, "documents").select(F.col("doc_id").alias("key"), T.words(F.lower("text")).alias("w"))
    p = _t(spark, d, "benchmark").select(F.col("item_id").alias("phrase_id"), T.words(F.lower("text")).alias("words"))
    return S.phrase_spans(t, p).select(F.col("key").alias("doc_id"), F.col("phrase_id").alias("item_id"), F.col("pos").cast("long").alias("pos"))


@register("stats_long", "WITH l AS (SELECT l_returnflag, 'l_quantity' AS variable, l_quantity AS v FROM lineitem UNION ALL SELECT l_returnflag, 'l_extendedprice', l_extendedprice FROM lineitem UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem) "
          "SELECT l_returnflag, variable, round(avg(v), 4) AS mean, round(quantile_cont(v, 0.5), 4) AS median, round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max, round(stddev_samp(v) / avg(v), 4) AS cov, round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 4) AS iqr FROM l GROUP BY 1, 2")
def stats_long(spark, d):
    s = S.stats_long(_t(spark, d, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice", "l_discount"])
    return s.select("l_returnflag", "variable", *[c if c in ("min", "max") else _r(F.col(c), c, 4) for c in s.columns[2:]])


@register("histogram_bins", "SELECT l_returnflag, least(greatest(floor(l_quantity / 5)::INT, 0), 8) AS bin, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS share FROM lineitem GROUP BY 1, 2")
def histogram_bins(spark, d):
    b = _t(spark, d, "lineitem").groupBy("l_returnflag", F.least(F.greatest(F.floor(F.col("l_quantity") / 5).cast("int"), F.lit(0)), F.lit(8)).alias("bin")).agg(F.count("*").alias("n"))
    t = b.groupBy("l_returnflag").agg(F.sum("n").alias("t"))
    return b.join(t, "l_returnflag").select("l_returnflag", "bin", "n", _r(F.col("n") / F.col("t"), "share"))


@register("dup_groups", "WITH g AS (SELECT md5(text) AS k, min(doc_id) f, count(*) n FROM documents GROUP BY 1 HAVING count(*) > 1) SELECT k AS digest, doc_id, CASE WHEN doc_id = f THEN 'keep' ELSE 'delete' END AS action FROM documents JOIN g ON md5(text) = k")
def dup_groups(spark, d):
    f = _t(spark, d, "documents").select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("size"))
    return S.duplicate_files(f, "digest", "size", "doc_id")


@register("deid_shift", "WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%m-%d-%Y') AS given, (o_custkey % 61)::INT - 30 AS days, o_orderdate FROM orders) SELECT o_orderkey, strftime(o_orderdate + to_days(days), '%m-%d-%Y') AS shifted, strftime(o_orderdate + to_days(days), '%m-%d-%y') AS shifted_short FROM o")
def deid_shift(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM-dd-yyyy").alias("a"), F.date_format("o_orderdate", "MM-dd-yy").alias("b"), (F.col("o_custkey") % 61 - 30).cast("int").alias("days"))
    return o.select("o_orderkey", S.shift_date(F.col("a"), F.col("days")).alias("shifted"), S.shift_date(F.col("b"), F.col("days")).alias("shifted_short"))


EMAIL, PHONE = r"[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", r"\+[0-9] \([0-9]{3}\) [0-9]{3}-[0-9]{4}"


@register("redact_labels", f"SELECT doc_id, len(regexp_extract_all(text, '{EMAIL}')) AS n_emails, len(regexp_extract_all(text, '{PHONE}')) AS n_phones, md5(regexp_replace(regexp_replace(text, '{EMAIL}', '[EMAIL]', 'g'), '{PHONE}', '[PHONE]', 'g')) AS digest FROM documents")
def redact_labels(spark, d):
    t = F.col("text")
    return _t(spark, d, "documents").select("doc_id", F.regexp_count(t, F.lit(EMAIL)).alias("n_emails"), F.regexp_count(t, F.lit(PHONE)).alias("n_phones"), F.md5(F.regexp_replace(F.regexp_replace(t, EMAIL, "[EMAIL]"), PHONE, "[PHONE]")).alias("digest"))


@register("risk_review", "WITH r AS (SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS INT) k FROM events), c AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'HIGH' WHEN k % 4 = 1 THEN 'MEDIUM' WHEN k % 4 = 2 THEN 'LOW' ELSE 'UNKNOWN' END risk FROM r) "
          "SELECT user_id, count(*) AS n, count(*) FILTER (risk = 'HIGH') AS high, count(*) FILTER (risk = 'MEDIUM') AS medium, count(*) FILTER (risk NOT IN ('HIGH', 'MEDIUM')) AS other, CASE WHEN count(*) FILTER (risk = 'HIGH') > 0 THEN 'review' ELSE 'pass' END AS recommendation FROM c GROUP BY 1")
def risk_review(spark, d):
    k = F.get_json_object("props", "$.k").cast("int") % 4
    risk = F.when(k == 0, "HIGH").when(k == 1, "MEDIUM").when(k == 2, "LOW").otherwise("UNKNOWN")
    g = _t(spark, d, "events").select("user_id", risk.alias("risk")).groupBy("user_id")
    high = F.count_if(F.col("risk") == "HIGH")
    return g.agg(F.count("*").alias("n"), high.alias("high"), F.count_if(F.col("risk") == "MEDIUM").alias("medium"), F.count_if(~F.col("risk").isin("HIGH", "MEDIUM")).alias("other"), F.when(high > 0, "review").otherwise("pass").alias("recommendation"))


@register("coherence", "WITH e AS (SELECT label, vec_id, embedding::DOUBLE[] v, lead(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) n, first_value(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) f, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 i FROM embeddings), "
          "c AS (SELECT label, i, list_cosine_similarity(v, n) c, CASE WHEN i > 0 THEN list_cosine_similarity(f, v) END t FROM e) SELECT label, round(avg(c), 5) AS mean, round(stddev_pop(c), 5) AS std, round(min(c), 5) AS low, round(max(c), 5) AS high, round(regr_slope(t, i), 6) AS tangent FROM c GROUP BY 1")
def coherence(spark, d):
    from pyspark.sql import Window as W

    w = W.partitionBy("label").orderBy("vec_id")
    e = _t(spark, d, "embeddings").select("label", F.col("embedding").alias("v"), F.lead("embedding").over(w).alias("n"), F.first("embedding").over(w).alias("f"), (F.row_number().over(w) - 1).alias("i"))
    c = e.select("label", "i", T.cosine(F.col("v"), F.col("n")).alias("c"), F.when(F.col("i") > 0, T.cosine(F.col("f"), F.col("v"))).alias("t"))
    return c.groupBy("label").agg(_r(F.avg("c"), "mean", 5), _r(F.stddev_pop("c"), "std", 5), _r(F.min("c"), "low", 5), _r(F.max("c"), "high", 5), _r(F.regr_slope("t", "i"), "tangent"))


@register("word_graph", f"""WITH w AS (SELECT doc_id, {LOWER} ws FROM documents), p AS (SELECT doc_id, unnest(ws) a, unnest(ws[2:]) b FROM w), e AS (SELECT doc_id, count(DISTINCT (least(a, b), greatest(a, b))) edges FROM p WHERE b IS NOT NULL GROUP BY 1)
  SELECT doc_id, len(list_distinct(ws)) AS nodes, coalesce(edges, 0) AS edges, round(CASE WHEN len(list_distinct(ws)) > 1 THEN 2.0 * coalesce(edges, 0) / (len(list_distinct(ws)) * (len(list_distinct(ws)) - 1)) ELSE 0 END, 6) AS density, round(CASE WHEN len(ws) > 0 THEN 2.0 * coalesce(edges, 0) / len(list_distinct(ws)) ELSE 0 END, 6) AS degree FROM w LEFT JOIN e USING (doc_id)""")
def word_graph(spark, d):
    g = S.word_graph(_t(spark, d, "documents"), "doc_id", T.words(F.lower("text")))
    return g.select("doc_id", "nodes", "edges", _r(F.col("density"), "density"), _r(F.col("degree"), "degree"))


@register("windows_100ms", "SELECT event_id, unnest(range(0, n - 1600, 1600)) AS start FROM (SELECT event_id, (abs(value) * 160)::INT n FROM events WHERE value IS NOT NULL) WHERE n > 1600")
def windows_100ms(spark, d):
    n = _t(spark, d, "events").where("value IS NOT NULL").select("event_id", F.rint(F.abs("value") * 160).cast("int").alias("n")).where("n > 1600")
    return n.select("event_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1601, F.lit(1600).cast("long"))).alias("start"))


@register("frame_merge", "WITH f AS (SELECT DISTINCT user_id, floor(epoch(ts) / 3600)::BIGINT h FROM events), g AS (SELECT user_id, h, h - row_number() OVER (PARTITION BY user_id ORDER BY h) g FROM f) SELECT user_id, min(h) AS first, max(h) AS last, count(*) AS n FROM g GROUP BY user_id, g")
def frame_merge(spark, d):
    e = _t(spark, d, "events").select("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3600e6).alias("h"))
    return S.islands(e, "user_id", "h")


@register("chunker")  # an ordered fold; tests compare it with a plain loop
def chunker(spark, d):
    c = _t(spark, d, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n").alias("l")).select("doc_id", F.arrays_zip(S.greedy_chunks(F.col("l"), 3000).alias("c"), F.col("l").alias("l")).alias("z"))
    return c.select("doc_id", F.explode("z").alias("z")).groupBy("doc_id", F.col("z.c").alias("chunk")).agg(F.count("*").alias("n_lines"), F.sum(F.length("z.l")).alias("n_chars"))


@register("tier_merge", f"""SELECT doc_id, n_chars, quality, toxic, len({WORDS}) AS n_words FROM documents JOIN labels USING (doc_id)""")
def tier_merge(spark, d):
    return _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id").select("doc_id", "n_chars", "quality", "toxic", F.size(T.words(F.col("text"))).alias("n_words"))


@register("pre_post_corr", f"""WITH p AS (SELECT length(text) a, length(regexp_replace(text, '{EMAIL}', '', 'g')) b, source FROM documents) SELECT source, round(corr(a, b), 6) AS r, round(100 * (avg(a) - avg(b)) / nullif(avg(a), 0), 6) AS loss_pct FROM p GROUP BY 1""")
def pre_post_corr(spark, d):
    p = _t(spark, d, "documents").select("source", F.length("text").alias("a"), F.length(F.regexp_replace("text", EMAIL, "")).alias("b"))
    return p.groupBy("source").agg(_r(F.corr("a", "b"), "r"), _r(100 * (F.avg("a") - F.avg("b")) / F.nullif(F.avg("a"), F.lit(0.0)), "loss_pct"))


@register("missing_by_group", "SELECT lang, source, count(*) AS n, list_sort(list(doc_id))[1:5]::VARCHAR AS examples FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1, 2")
def missing_by_group(spark, d):
    rest = _t(spark, d, "documents").select("doc_id", "lang", "source").join(_t(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    few = O.first_of(rest, ["lang", "source"], "doc_id", "ids")
    return few.select("lang", "source", "n", F.concat(F.lit("["), F.array_join(F.col("ids").cast("array<string>"), ", "), F.lit("]")).alias("examples"))
