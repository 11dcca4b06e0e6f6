"""Names, texts and files by literals and by plain Python on random input."""

import random
from collections import Counter

from pyspark.sql import functions as F

from voxloom.functions import deid as D
from voxloom.functions import paths as P
from voxloom.functions import text as T
from voxloom.functions import tiers as R
from voxloom.operators import files as O
from voxloom.operators import speech as S


def of(spark, column, rows, schema):
    return [r["r"] for r in spark.createDataFrame([(i, *r) if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)], "i int, " + schema).orderBy("i").select(column.alias("r")).collect()]


def test_names(spark):
    names = ["2-002-8-Spontaneous-Mac-1-8-24-EM_transcript.txt", "2-013-8-10Minute_transcript.txt", "3-004-1-Thing-11-30-23-XX_transcript.txt", "ab_transcript.txt", "2-1-3-Mac", None]
    got = of(spark, P.recording(F.col("n"), F.lit("Picnic things")), names, "n string")
    assert [tuple(x) for x in got[:5]] == [("2-002-8", "2024-01-08", "Spontaneous"), ("2-013-8", "unknown", "10MinConversation"), ("3-004-1", "2023-11-30", "Picnic"), ("ab", "unknown", "unknown"), ("2-1-3", "unknown", "Picnic")]
    assert [tuple(x) for x in of(spark, P.numbered_recording(F.col("n")), ["2-002-8-gfp-1-8-24.txt", "x-1-2", "", "2-002-08-a-b-c-d"], "n string")] == [("2-002-8", "8-02-002", "Grandfather"), ("x", "unknown", "unknown"), ("unknown", "unknown", "unknown"), ("2-002-08", "2008-02-002", "unknown")]
    assert of(spark, P.core_name(F.col("n")), ["anon_P1_Cleaned.WAV", "a.deid.piiCategoryTag.json", "x.txt.json", None], "n string") == ["P1", "a", "x.txt", None]
    assert [tuple(x) if x else x for x in of(spark, P.dated_name(F.col("n")), ["12-1-5-31.txt", "12345-10-05-2022", "a-1-1-22", ""], "n string")] == [("0012", "01-05-31", "01/05/1931"), ("12345", "10-05-2022", "10/05/2022"), None, None]


def test_paths_that_clash_are_numbered(spark):
    df = spark.createDataFrame([("/in/a/x 1.txt",), ("/in/a/x 2.txt",), ("/in/b/x 1.txt",), ("/in/top",)], "path string")
    got = {r.path: r.out for r in P.mirrored(df, "path", "/in", "/out", F.lit("n.txt")).collect()}
    assert got == {"/in/a/x 1.txt": "/out/a/n.txt", "/in/a/x 2.txt": "/out/a/n_001.txt", "/in/b/x 1.txt": "/out/b/n.txt", "/in/top": "/out/n.txt"}


def test_records_and_dates(spark):
    key = spark.createDataFrame([("1234", "P001", 45), ("12345", "P002", -10), ("0077", "P003", 0)], "mrn string, uid string, days int")
    rows = [(1, "1234,1234-01-15-22.wav,85", ""), (2, "see 12345 on 3-1-2020 or 13-1-20", "due 1-2-24"), (3, "none 1-2-24", None), (4, None, None)]
    got = {r.i: (r.a, r.b, r.n) for r in D.deidentify(spark.createDataFrame(rows, "i int, a string, b string"), key, "i", ["a", "b"], [4, 5]).collect()}
    assert got == {1: ("P001,P001-03-01-22.wav,85", "", 3), 2: ("see P002 on 02-20-2020 or 13-1-20", "due 12-23-23", 3), 3: ("none 1-2-24", None, 0), 4: (None, None, 0)}


def test_redaction(spark):
    spans = F.array(F.struct(F.lit(0).alias("start"), F.lit(2).alias("end"), F.lit("<A>").alias("label")), F.struct(F.lit(6).alias("start"), F.lit(8).alias("end"), F.lit("<B>").alias("label")), F.struct(F.lit(7).alias("start"), F.lit(9).alias("end"), F.lit("<C>").alias("label")))
    assert of(spark, D.redact_at(F.col("t"), spans), ["0123456789"], "t string") == ["<A>23456<C>9"]
    got = of(spark, D.locate(F.col("t"), F.lit("My  Boss"), 3), ["say My  Boss ok", "my  boss", "oh my\nboss", "no"], "t string")
    assert [(x["start"], x["how"]) for x in got] == [(4, "exact"), (0, "any_case"), (3, "even_space"), (None, "missing")] and got[0]["around"] == "ay My  Boss ok"
    assert of(spark, D.redact_all(F.col("t"), F.array(F.lit("ab"), F.lit("abc"), F.lit(""))), ["abcab"], "t string") == [D.REDACTED * 2]
    items = of(spark, F.size(D.object_items(F.col("t"), "$.s")), ['{"s":[{"a":1},"x",{"b":2}]}', "{", '{"s":[]}'], "t string")
    assert items == [2, None, 0]


def test_text_features(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("a b c d e f g h".split()) for _ in range(n)) for n in (0, 1, 3, 4, 5, 30, 200)]
    for w in (1, 4, 25):
        got = of(spark, T.mattr(T.words(F.col("t")), w), texts, "t string")
        for t, x in zip(texts, got):
            ws = t.split()
            want = 0 if not ws else len(set(ws)) / len(ws) if len(ws) < w else sum(len(set(ws[i:i + w])) for i in range(len(ws) - w + 1)) / (w * (len(ws) - w + 1))
            assert abs(x - want) < 1e-9
    assert of(spark, R.tokens(F.col("t")), ["I don't know, it's É9!", None], "t string") == [["I", "do", "n't", "know", ",", "it", "'s", "É9", "!"], []]
    assert of(spark, R.expand(R.tokens(F.col("t"))), ["don't we're"], "t string") == [["do", "", "not", "we", "", "are"]]
    assert of(spark, R.capitals(F.col("t"))["title_runs"], ["We met Ann Lee Poe there. Then Bob Ray", "a B C d E F g"], "t string") == [1, 2]
    assert of(spark, T.human_size(F.col("n")), [(0,), (1024,), (1310720,), (5 << 30,)], "n long") == ["0.0 B", "1.0 KB", "1.2 MB", "5.0 GB"]
    assert of(spark, T.clean_word(F.col("t")), ["'Hi!?", "a.b."], "t string") == ["hi", "a.b"]


def test_spread_of_nothing_and_of_halves(spark):
    got = spark.createDataFrame([(0, []), (1, [0.84375, 0.7]), (2, [1.0, 1.0])], "i int, v array<double>").orderBy("i").select(*R.spread(F.col("v")).values()).collect()
    assert tuple(got[0]) == (None,) * 5 and got[2][3] == 0.0
    mean, squares = 0.0, 0.0  # running, as DuckDB's list_stddev_pop
    for n, x in enumerate([0.84375, 0.7], 1):
        before, mean = mean, mean + (x - mean) / n
        squares += (x - mean) * (x - before)
    assert got[1][3] == (squares / 2) ** 0.5


def test_phrases_of_any_length(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g a b"), (2, ""), (3, "b")], "key int, t string").select("key", T.words(F.col("t")).alias("w"))
    phrases = spark.createDataFrame([(1, "a b"), (2, "b"), (3, "b c d e f g a"), (4, ""), (5, "c d e f x")], "phrase_id int, t string").select("phrase_id", T.words(F.col("t")).alias("words"))
    assert Counter(tuple(r) for r in S.phrase_spans(docs, phrases).collect()) == Counter([(1, 1, 0), (1, 1, 7), (1, 2, 1), (1, 2, 8), (3, 2, 0), (1, 3, 1)])
    assert S.phrase_spans(docs, phrases.where("false")).count() == 0


def test_file_work(spark):
    f = spark.createDataFrame([("x.txt", 1, "a"), ("x 2.txt", 1, "a"), ("x 3.txt", 1, "a"), ("y 1.txt", 1, "b"), ("y 2.txt", 2, "c"), ("z", 1, "d")], "name string, size int, digest string")
    assert {r.name: r.action for r in O.copies_plan(f, "name", "size", "digest").collect()} == {"x.txt": "keep", "x 2.txt": "delete", "x 3.txt": "delete", "y 1.txt": "keep", "y 2.txt": "review"}
    ids, names = spark.createDataFrame([("12",), ("7",), ("long-name",)], "id string"), spark.createDataFrame([("a12b",), ("xx12",), ("long",), ("7",), ("q",)], "name string")
    assert {(r.id, r.name, r.how) for r in O.fuzzy_match(ids, names).collect()} == {("12", "a12b", "part"), ("7", "7", "exact"), ("long-name", "long", "part")}
    r = spark.createDataFrame([("k", 1000, 1100), ("k", 1500, 3000), ("k", 2000, 2500)], "key string, start long, end long")
    assert sorted(tuple(x) for x in O.gaps(r, "key", F.lit(5000)).collect()) == [("k", 0, 1000), ("k", 2500, 5000)]
    assert O.report(ids.orderBy("id"), "Ids").splitlines()[:4] == ["# Ids", "", "| id |", "|---|"]
    plan = O.manifest(spark.createDataFrame([("a",), ("b",), ("c",)], "f string"), spark.createDataFrame([("a", None), ("b", "gone")], "f string, error string"), "f")
    assert {x.f: x.status for x in plan.collect()} == {"a": "success", "b": "error", "c": "planned"}


def test_matches_of_values_that_begin_alike(spark):
    rng = random.Random(5)
    some = lambda n: ["".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(n)]
    ids, names = list({*some(60), "zz", "Supplier#1-x"}), [*some(25), *(f"Supplier#{i}" for i in range(3))]
    want = {}
    for i in ids:
        met = min(((i != n, len(n), n.encode()) for n in names if i in n or n in i), default=None)
        if met:
            want[i] = (met[2].decode(), "part" if met[0] else "exact")
    rows = lambda values, name: spark.createDataFrame([(x,) for x in [*values, None]], f"{name} string")
    assert {r.id: (r.name, r.how) for r in O.fuzzy_match(rows(ids, "id"), rows(names, "name")).collect()} == want
    assert Counter((r.id, r.name) for r in O.containing(rows(ids, "id"), rows(names, "name")).collect()) == Counter((i, n) for i in ids for n in names if i in n)
    assert O.fuzzy_match(rows(ids, "id").where("false"), rows(names, "name")).count() == 0 == O.fuzzy_match(rows(ids, "id"), rows(names, "name").where("false")).count()
    n = 3000  # all begin alike: the pairs that meet are as many as the rows, not their square
    same = spark.range(n).selectExpr("concat('Supplier#', lpad(id, 9, '0')) AS name")
    assert O.parts(same, "name", same, "name").join(same.withColumnRenamed("name", "part"), "part").count() == n


def test_quantiles_of_groups_in_bins(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(k, rng.choice([rng.uniform(0, 1), float(rng.randint(-3, 3)), None])) for k in [None, "a", "a", "a", "b"] * 200] + [("c", 5.0), ("d", 1.0), ("d", 2.0), ("e", None)]
    df = spark.createDataFrame(rows, "k string, x double").withColumn("y", F.col("x") * 3)
    cols = ["k", "variable", "median", "iqr"]
    long = df.unpivot("k", ["x", "y"], "variable", "value").groupBy("k", "variable")
    want = long.agg(F.percentile("value", 0.5).alias("median"), (F.percentile("value", 0.75) - F.percentile("value", 0.25)).alias("iqr")).select(*cols).collect()
    near = lambda found: sorted((str(r.k), r.variable, *[x if x is None else round(x, 9) for x in (r.median, r.iqr)]) for r in found)
    for size in (1 << 16, 4, 1):  # one bin, many, one for each value
        monkeypatch.setattr(S, "BIN", size)
        assert near(S.stats_long(df, "k", ["x", "y"]).select(*cols).collect()) == near(want)
    plan = S.stats_long(df, "k", ["x", "y"])._jdf.queryExecution().toString()
    assert "percentile(" not in plan  # that would hold a group's values in one task


def test_equal_paths_are_numbered_by_id(spark):
    df = spark.range(400).selectExpr("400 - id AS i", "concat('/in/a/', IF(id % 2 = 0, 'x', 'y')) AS path").repartition(7)
    got = {r.i: r.out for r in P.mirrored(df, "path", "/in", "/out", F.lit("n.txt"), "i").collect()}
    order = sorted(got, key=lambda i: (i % 2, i))  # 400 - id is even where id is
    assert [got[i] for i in order] == ["/out/a/n.txt", *(f"/out/a/n_{k:03d}.txt" for k in range(1, 400))]
