"""Queries over file names, paths and de-identification. The inputs (names,
notes, record keys) are made from the tables by expressions that the query and
its SQL share."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import deid as D
from voxloom.functions import paths as P
from voxloom.plans.catalog import register

STR = lambda x: f"CAST({x} AS STRING)"
TASK = "CASE doc_id % 6 WHEN 0 THEN 'Grandfather' WHEN 1 THEN 'PicnicScene' WHEN 2 THEN 'SpontaneousTalk' WHEN 3 THEN '10MinuteConvo' WHEN 4 THEN 'gfpTask' ELSE 'Other' END"
ID3 = f"concat({STR('doc_id % 9')}, '-', lpad({STR('doc_id % 1000')}, 3, '0'), '-', {STR('doc_id % 7')})"
DAY = f"concat({STR('doc_id % 12 + 1')}, '-', {STR('doc_id % 28 + 1')}, '-', lpad({STR('doc_id % 40')}, 2, '0'))"
NAME = f"""CASE doc_id % 8 WHEN 0 THEN concat({ID3}, '-', {TASK}, '-Mac-', {DAY}, '-EM_transcript.txt') WHEN 1 THEN concat({ID3}, '-', {TASK}, '-', {DAY}, '-EM_transcript.txt')
  WHEN 2 THEN concat({ID3}, '-', {TASK}, '_transcript.txt') WHEN 3 THEN concat({ID3}, '.txt') WHEN 4 THEN concat('x', {STR('doc_id')}, '_gfp.txt') WHEN 5 THEN concat({STR('doc_id % 20000')}, '-', {DAY}, '.wav')
  WHEN 6 THEN concat('anon_', {ID3}, '_cleaned.deid.piiCategoryTag.json') ELSE concat('-a-b-', {STR('doc_id')}, '_clean.WAV') END"""
FOLDER = "CASE doc_id % 5 WHEN 0 THEN '10minute_conversation' WHEN 1 THEN 'Grandfather Passage' WHEN 2 THEN 'Mac_Audacity_Picnic_Description' WHEN 3 THEN 'SpontSpeech' ELSE 'Notes' END"
COHORT = "CASE doc_id % 4 WHEN 0 THEN 'CSA-Research' WHEN 1 THEN '004' WHEN 2 THEN 'Follow-Up' ELSE 'LIIA' END"
FILES = f"(SELECT doc_id, name, folder, concat('/data/in/', cohort, '/', folder, '/', name) AS path, concat(cohort, '/', folder, '/', name) AS rel FROM (SELECT doc_id, {NAME} AS name, {FOLDER} AS folder, {COHORT} AS cohort FROM documents))"


def files(spark, d):
    f = spark.read.parquet(f"{d}/documents.parquet").selectExpr("doc_id", f"{NAME} AS name", f"{FOLDER} AS folder", f"{COHORT} AS cohort")
    return f.selectExpr("doc_id", "name", "folder", "concat('/data/in/', cohort, '/', folder, '/', name) AS path", "concat(cohort, '/', folder, '/', name) AS rel")


def _case(value, rules, other):
    return "CASE " + " ".join(f"WHEN regexp_matches({value}, '{p}') THEN '{n}'" for p, n in rules) + f" ELSE {other} END"


_PAD = lambda x: f"lpad({x}, CAST(greatest(length({x}), 2) AS INT), '0')"
_BARE = "replace(name, '_transcript.txt', '')"


@register("recording_names", f"""WITH p AS (SELECT doc_id, name, folder, string_split({_BARE}, '-') p, {_BARE} stem FROM {FILES}),
  q AS (SELECT *, len(p) n, CASE WHEN p[5] = 'Mac' THEN 1 ELSE 0 END o, {_case('lower(folder)', P.FOLDERS_1, "'Unknown'")} fb FROM p)
  SELECT doc_id, CASE WHEN n >= 3 THEN concat_ws('-', p[1], p[2], p[3]) ELSE stem END AS participant,
    CASE WHEN n >= 7 AND p[7 + o] IS NOT NULL THEN concat('20', p[7 + o], '-', {_PAD('p[5 + o]')}, '-', {_PAD('p[6 + o]')}) ELSE 'unknown' END AS date,
    CASE WHEN n < 3 THEN 'unknown' WHEN n >= 4 THEN {_case('lower(p[4])', P.TASKS_1, 'fb')} ELSE fb END AS task FROM q""")
def recording_names(spark, d):
    return files(spark, d).select("doc_id", P.recording(F.col("name"), F.col("folder")).alias("r")).select("doc_id", "r.*")


@register("stem_names", f"SELECT doc_id, replace({_BARE}, '.txt', '') AS participant, 'unknown' AS date, {_case('lower(name)', P.TASKS_2, chr(39) + 'Unknown' + chr(39))} AS task FROM {FILES}")
def stem_names(spark, d):
    return files(spark, d).select("doc_id", P.stem_and_task(F.col("name")).alias("r")).select("doc_id", "r.*")


@register("numbered_names", f"""WITH p AS (SELECT doc_id, string_split(replace({_BARE}, '.txt', ''), '-') p FROM {FILES}),
  q AS (SELECT doc_id, p, len(p) n, len(p) >= 3 AND regexp_full_match(p[1], '[0-9]+') AND regexp_full_match(p[2], '[0-9]+') AND regexp_full_match(p[3], '[0-9]+') ok FROM p)
  SELECT doc_id, CASE WHEN ok THEN concat_ws('-', p[1], p[2], p[3]) WHEN n >= 3 AND p[1] <> '' THEN p[1] ELSE 'unknown' END AS participant,
    CASE WHEN ok AND n >= 7 THEN concat(CASE WHEN length(p[3]) = 2 THEN '20' ELSE '' END, p[3], '-', {_PAD('p[1]')}, '-', {_PAD('p[2]')}) ELSE 'unknown' END AS date,
    CASE WHEN ok AND n > 3 THEN {_case('lower(p[4])', P.TASKS_3, chr(39) + 'unknown' + chr(39))} ELSE 'unknown' END AS task FROM q""")
def numbered_names(spark, d):
    return files(spark, d).select("doc_id", P.numbered_recording(F.col("name")).alias("r")).select("doc_id", "r.*")


_G = lambda i: f"regexp_extract(name, '{P.DATED_NAME}', {i})"


@register("dated_names", f"""SELECT doc_id, lpad({_G(1)}, CAST(greatest(length({_G(1)}), 4) AS INT), '0') AS mrn, concat_ws('-', {_PAD(_G(2))}, {_PAD(_G(3))}, {_G(4)}) AS date,
  concat_ws('/', {_PAD(_G(2))}, {_PAD(_G(3))}, concat(CASE WHEN length({_G(4)}) > 2 THEN '' WHEN {_G(4)} <= '30' THEN '20' ELSE '19' END, {_G(4)})) AS full_date FROM {FILES} WHERE regexp_matches(name, '{P.DATED_NAME}')""")
def dated_names(spark, d):
    return files(spark, d).select("doc_id", P.dated_name(F.col("name")).alias("r")).where("r IS NOT NULL").select("doc_id", "r.*")


@register("core_names", f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(name, '{P.EXTENSION}', ''), '{P.PREFIX}', ''), '{P.SUFFIX}', '') AS core, regexp_replace(name, '(?i)\\.wav$', '_cleaned.wav') AS cleaned,
  regexp_replace(regexp_replace(name, '\\.[^.]*$', ''), '(_transcript|_cleaned)$', '') AS stem, regexp_replace(regexp_replace(name, '^anon_', ''), '_clean\\.wav$', '') AS anonymous FROM {FILES}""")
def core_names(spark, d):
    n = F.col("name")
    return files(spark, d).select("doc_id", P.core_name(n).alias("core"), P.cleaned_name(n).alias("cleaned"), P.base_stem(n).alias("stem"), P.anonymous_stem(n).alias("anonymous"))


@register("path_tests", f"""SELECT doc_id, regexp_matches(lower(path), '{P.SPEECH_TASK}') AS speech_task, len(list_filter(string_split(lower(path), '/'), lambda p: contains(p, 'follow') AND contains(p, 'up'))) > 0 AS follow_up,
  len(list_intersect(string_split(path, '/'), ['LIIA', 'Notes'])) > 0 AS skipped, len(list_filter(string_split(path, '/'), lambda p: regexp_matches(p, '^CSA'))) > 0 AS csa FROM {FILES}""")
def path_tests(spark, d):
    p = F.col("path")
    return files(spark, d).select("doc_id", P.is_speech_task(p).alias("speech_task"), P.is_follow_up(p).alias("follow_up"), P.in_directories(p, ["LIIA", "Notes"]).alias("skipped"), P.has_part(p, "^CSA").alias("csa"))


_MAP = lambda table, x: "CASE " + x + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


@register("path_parts", f"SELECT doc_id, string_split(rel, '/')[1] AS cohort, string_split(rel, '/')[2] AS task, {_MAP(P.COHORTS, chr(40) + 'string_split(rel, ' + repr('/') + ')[1]' + chr(41))} AS turns_cohort, {_MAP(P.DIRECTORIES, 'folder')} AS standard FROM {FILES}")
def path_parts(spark, d):
    return files(spark, d).select("doc_id", P.cohort_of(F.col("rel")).alias("c"), P.standard_directory(F.col("folder")).alias("standard")).select("doc_id", "c.*", "standard")


@register("clip_intervals", "SELECT event_id, greatest(0, CAST(trunc((value - 100) * 160) AS BIGINT)) AS start, least(20000, CAST(trunc(value * 160) AS BIGINT)) AS \"end\" FROM events WHERE value IS NOT NULL")
def clip_intervals(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").where("value IS NOT NULL")
    return e.select("event_id", P.clip(F.col("value") - 100, F.col("value"), 160, F.lit(20000)).alias("c")).select("event_id", F.col("c.start").cast("long").alias("start"), F.col("c.end").cast("long").alias("end"))


@register("mirrored_paths", f"""WITH o AS (SELECT doc_id, path, concat('/out/', string_split(rel, '/')[1], '/', string_split(rel, '/')[2], '/', 'P', doc_id % 50, '.txt') o FROM {FILES}),
  k AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY path) - 1 k FROM o) SELECT doc_id, CASE WHEN k = 0 THEN o ELSE concat(regexp_replace(o, '\\.txt$', ''), '_', lpad(CAST(k AS VARCHAR), 3, '0'), '.txt') END AS out FROM k""")
def mirrored_paths(spark, d):
    new = F.concat(F.lit("P"), (F.col("doc_id") % 50).cast("string"), F.lit(".txt"))
    # most names repeat after 63,000 documents, so paths do; the SQL leaves their order open
    return P.mirrored(files(spark, d), "path", "/data/in", "/out", new, "doc_id").select("doc_id", "out")


# --- record keys and notes
KEY = f"(SELECT lpad({STR('c_custkey')}, CAST(greatest(length({STR('c_custkey')}), 4) AS INT), '0') AS mrn, concat('P', {STR('c_custkey % 900')}) AS uid, CAST(c_custkey % 61 - 30 AS INT) AS days FROM customer WHERE c_mktsegment = 'BUILDING')"
NOTE = f"""concat('Seen ', lpad({STR('o_orderkey % 14')}, 2, '0'), '-', lpad({STR('o_orderkey % 33')}, 2, '0'), '-', lpad({STR('o_orderkey % 100')}, 2, '0'), ' record ', lpad({STR('o_custkey')}, 4, '0'), '; next ',
  {STR('o_orderkey % 9 + 1')}, '-', {STR('o_orderkey % 25 + 1')}, '-', {STR('2000 + o_orderkey % 50')}, ' or ', lpad({STR('o_custkey * 7 % 9999')}, 4, '0'), '.')"""
LENGTHS = [4, 5, 6, 7, 8]


def key_of(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").where("c_mktsegment = 'BUILDING'")
    return c.selectExpr(f"lpad({STR('c_custkey')}, CAST(greatest(length({STR('c_custkey')}), 4) AS INT), '0') AS mrn", f"concat('P', {STR('c_custkey % 900')}) AS uid", "CAST(c_custkey % 61 - 30 AS INT) AS days")


def notes(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey", "o_custkey", f"{NOTE} AS note")


_RX = r"\b[0-9]{1,2}-[0-9]{1,2}-[0-9]{2,4}\b"
_HITS = f"""k AS (SELECT * FROM {KEY}), n AS (SELECT o_orderkey, o_custkey, {NOTE} AS note FROM orders),
  h AS (SELECT o_orderkey, list(struct_pack(o := -length(mrn), mrn := mrn, uid := uid, days := days) ORDER BY -length(mrn), mrn) h FROM n JOIN k ON contains(note, mrn) GROUP BY 1),
  j AS (SELECT n.*, coalesce(h, []) h FROM n LEFT JOIN h USING (o_orderkey))"""


def _replaced(col, most=6):
    text, count = col, "0"
    for i in range(1, most + 1):
        m = f"h[{i}].mrn"
        count += f" + CASE WHEN {m} IS NULL THEN 0 ELSE (length({text}) - length(replace({text}, {m}, ''))) // length({m}) END"
        text = f"CASE WHEN {m} IS NULL THEN {text} ELSE replace({text}, {m}, h[{i}].uid) END"
    return text, count


def _shifted(x, days):
    y = f"(CASE WHEN length(p[3]) > 2 THEN p[3] WHEN p[3] >= '69' THEN concat('19', p[3]) ELSE concat('20', p[3]) END)"
    day = f"try_strptime(concat({y}, '-', lpad(p[1], 2, '0'), '-', lpad(p[2], 2, '0')), '%Y-%m-%d')"
    at = f"CAST({day} AS DATE) + to_days({days})"
    moved = f"CASE WHEN length(p[3]) > 2 THEN strftime({at}, '%m-%d-%Y') ELSE strftime({at}, '%m-%d-%y') END"
    return f"list_transform({x}, lambda m: coalesce(list_transform([string_split(m, '-')], lambda p: CASE WHEN length(p[3]) <> 3 AND CAST(p[1] AS INT) BETWEEN 1 AND 12 AND CAST(p[2] AS INT) BETWEEN 1 AND 31 THEN {moved} END)[1], m))"


def _rejoined(text, shifted):
    return f"concat(regexp_split_to_array({text}, '{_RX}')[1], array_to_string(list_transform({shifted}, lambda m, i: concat(m, regexp_split_to_array({text}, '{_RX}')[i + 1])), ''))"


@register("record_lookup", f"WITH {_HITS} SELECT o_orderkey, len(h) AS n_records, h[1].mrn AS context, h[1].days AS days FROM j")
def record_lookup(spark, d):
    n = D.with_records(notes(spark, d), key_of(spark, d), "o_orderkey", F.col("note"), LENGTHS)
    first = F.get("hits", F.lit(0))
    return n.select("o_orderkey", F.size("hits").cast("long").alias("n_records"), first["mrn"].alias("context"), first["days"].alias("days"))


_T, _C = _replaced("note")


@register("deid_notes", f"""WITH {_HITS}, r AS (SELECT o_orderkey, h, {_T} AS t, {_C} AS c FROM j), f AS (SELECT *, regexp_extract_all(t, '{_RX}') f FROM r), s AS (SELECT *, {_shifted('f', 'h[1].days')} s FROM f)
  SELECT o_orderkey, CASE WHEN len(f) = 0 THEN t ELSE {_rejoined('t', 's')} END AS note, c + len(list_filter(range(1, len(f) + 1), lambda i: s[i] <> f[i])) AS n FROM s""")
def deid_notes(spark, d):
    return D.deidentify(notes(spark, d).select("o_orderkey", "note"), key_of(spark, d), "o_orderkey", ["note"], LENGTHS)


@register("deid_file_names", f"""WITH k AS (SELECT * FROM {KEY}), b AS (SELECT doc_id, name, lpad({_G(1)}, CAST(greatest(length({_G(1)}), 4) AS INT), '0') AS mrn, concat_ws('-', {_PAD(_G(2))}, {_PAD(_G(3))}, {_G(4)}) dt FROM {FILES} WHERE regexp_matches(name, '{P.DATED_NAME}')),
  j AS (SELECT b.doc_id, name, uid, days, b.mrn, dt FROM b LEFT JOIN k USING (mrn)) SELECT doc_id, CASE WHEN uid IS NULL THEN NULL ELSE concat(uid, '-', strftime(CAST(try_strptime(concat(CASE WHEN right(dt, 2) <= '30' THEN '20' ELSE '19' END, right(dt, 2), '-', left(dt, 5)), '%Y-%m-%d') AS DATE) + to_days(days), '%m-%d-%y'), '.wav') END AS new_name,
  CASE WHEN uid IS NULL THEN 'no record' ELSE 'renamed' END AS status FROM j""")
def deid_file_names(spark, d):
    """File names with a record and a date: the record becomes its uid, the
    date moves; names of unknown records are listed with the reason."""
    f = files(spark, d).select("doc_id", P.dated_name(F.col("name")).alias("r")).where("r IS NOT NULL").select("doc_id", "r.mrn", "r.full_date")
    moved = F.date_format(F.date_add(F.try_to_timestamp("full_date", F.lit("MM/dd/yyyy")).cast("date"), F.col("days")), "MM-dd-yy")
    return f.join(key_of(spark, d), "mrn", "left").select("doc_id", F.when(F.col("uid").isNotNull(), F.concat("uid", F.lit("-"), moved, F.lit(".wav"))).alias("new_name"), F.when(F.col("uid").isNull(), "no record").otherwise("renamed").alias("status"))


_T2, _C2 = _replaced("ref")


@register("deid_rows", f"""WITH k AS (SELECT * FROM {KEY}), n AS (SELECT o_orderkey, concat('ref ', lpad({STR('o_custkey')}, 4, '0')) AS ref, concat('due ', lpad({STR('o_orderkey % 12 + 1')}, 2, '0'), '-', lpad({STR('o_orderkey % 28 + 1')}, 2, '0'), '-', {STR('2000 + o_orderkey % 20')}) AS due FROM orders),
  h AS (SELECT o_orderkey, list(struct_pack(o := -length(mrn), mrn := mrn, uid := uid, days := days) ORDER BY -length(mrn), mrn) h FROM n JOIN k ON contains(concat(ref, ' ', due), mrn) GROUP BY 1), j AS (SELECT n.*, coalesce(h, []) h FROM n LEFT JOIN h USING (o_orderkey)),
  r AS (SELECT o_orderkey, h, {_T2} AS ref, {_replaced('due')[0]} AS t FROM j), f AS (SELECT *, regexp_extract_all(t, '{_RX}') f FROM r), s AS (SELECT *, {_shifted('f', 'h[1].days')} s FROM f)
  SELECT o_orderkey, ref, CASE WHEN len(f) = 0 THEN t ELSE {_rejoined('t', 's')} END AS due FROM s""")
def deid_rows(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey", f"concat('ref ', lpad({STR('o_custkey')}, 4, '0')) AS ref", f"concat('due ', lpad({STR('o_orderkey % 12 + 1')}, 2, '0'), '-', lpad({STR('o_orderkey % 28 + 1')}, 2, '0'), '-', {STR('2000 + o_orderkey % 20')}) AS due")
    return D.deidentify(rows, key_of(spark, d), "o_orderkey", ["ref", "due"], LENGTHS).drop("n")


_LABEL = D.REDACTED.replace("'", "''")


@register("redact_phrases", f"SELECT doc_id, md5(replace(replace(replace(coalesce(text, ''), lang || ' ', '{_LABEL}'), 'All rights', '{_LABEL}'), 'the', '{_LABEL}')) AS digest FROM documents")
def redact_phrases(spark, d):
    # longest first: 'All rights', then 'xx ' and 'the', by text
    t = spark.read.parquet(f"{d}/documents.parquet")
    listed = F.array(F.lit("the"), F.lit("All rights"), F.concat("lang", F.lit(" ")))
    text = F.coalesce("text", F.lit(""))
    return t.select("doc_id", F.md5(D.redact_all(text, listed)).alias("digest"))


@register("locate_phrases", """WITH p AS (SELECT doc_id, coalesce(text, '') t, CASE doc_id % 3 WHEN 0 THEN 'the' WHEN 1 THEN 'ALL RIGHTS' ELSE 'In  the' END q FROM documents), e AS (SELECT *, instr(t, q) a, instr(lower(t), lower(q)) b,
  instr(regexp_replace(lower(trim(t)), '\\s+', ' ', 'g'), left(regexp_replace(lower(trim(q)), '\\s+', ' ', 'g'), 20)) c FROM p), s AS (SELECT *, CASE WHEN a > 0 THEN a WHEN b > 0 THEN b WHEN c > 0 THEN c END - 1 s FROM e)
  SELECT doc_id, s AS start, least(s + length(q), length(t)) AS "end", CASE WHEN a > 0 THEN 'exact' WHEN b > 0 THEN 'any_case' WHEN c > 0 THEN 'even_space' ELSE 'missing' END AS how, md5(substring(t, greatest(s - 200, 0) + 1, least(s + length(q), length(t)) + 200 - greatest(s - 200, 0))) AS around FROM s""")
def locate_phrases(spark, d):
    t = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.expr("CASE doc_id % 3 WHEN 0 THEN 'the' WHEN 1 THEN 'ALL RIGHTS' ELSE 'In  the' END").alias("q"))
    return t.select("doc_id", D.locate(F.col("t"), F.col("q")).alias("l")).select("doc_id", F.col("l.start").cast("long").alias("start"), F.col("l.end").cast("long").alias("end"), F.col("l.how").alias("how"), F.md5("l.around").alias("around"))


@register("redact_positions", "SELECT doc_id, md5(concat(left(t, 4), '<B>', substring(t, 11, 10), '<A>', substring(t, 31))) AS digest FROM (SELECT doc_id, rpad(coalesce(text, ''), 60, 'x') AS t0, CASE WHEN length(coalesce(text, '')) < 60 THEN rpad(coalesce(text, ''), 60, 'x') ELSE text END AS t FROM documents)")
def redact_positions(spark, d):
    text = F.coalesce("text", F.lit(""))
    long = F.when(F.length(text) < 60, F.rpad(text, 60, "x")).otherwise(text)
    spans = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(x).alias("label")) for a, b, x in ((20, 30, "<A>"), (4, 10, "<B>"), (8, 22, "<over>"))])
    # the span in the middle reaches over the one to its right and is left out
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.md5(D.redact_at(long, spans)).alias("digest"))


@register("password_policy", "SELECT c_custkey, length(p) >= 12 AND regexp_matches(p, '[A-Z]') AND regexp_matches(p, '[a-z]') AND regexp_matches(p, '[0-9]') AND regexp_matches(p, '[^A-Za-z0-9]') AS strong FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN concat(c_name, c_mktsegment) ELSE lower(c_name) END p FROM customer)")
def password_policy(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN concat(c_name, c_mktsegment) ELSE lower(c_name) END AS p")
    return c.select("c_custkey", D.strong_password(F.col("p")).alias("strong"))


@register("prompts", "SELECT event_id, concat('Review ', event_type, ' of ', coalesce(CAST(user_id AS VARCHAR), ''), ': ', coalesce(props, '')) AS prompt FROM events")
def prompts(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", D.prompt("Review {kind} of {user}: {text}", kind=F.col("event_type"), user=F.col("user_id"), text=F.col("props")).alias("prompt"))


@register("analysis_items", """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 1 + CAST(event_id % 2 = 0 AS INT) END AS n_items, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS first_k FROM events""")
def analysis_items(spark, d):
    """Segments of review documents: a broken document gives null, an item that
    is a plain string goes."""
    e = spark.read.parquet(f"{d}/events.parquet")
    body = F.concat(F.lit('{"segments":['), "props", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(","), "props")).otherwise(F.lit(',"note"')), F.lit("]}"))
    items = D.object_items(F.when(F.col("event_id") % 5 == 0, F.lit("{broken")).otherwise(body), "$.segments")
    return e.select("event_id", items.alias("i")).select("event_id", F.nullif(F.size("i"), F.lit(-1)).alias("n_items"), F.try_variant_get(F.get("i", F.lit(0)), "$.k", "int").alias("first_k"))
