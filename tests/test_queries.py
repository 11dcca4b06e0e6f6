"""Every query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from voxloom.functions import text as T
from voxloom.operators import speech as S
from voxloom.plans import catalog, files_and_deid, queries, tiers_and_joins  # noqa: F401

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents benchmark labels conversations embeddings pages".split()


def rows(df):
    cols = sorted(df.columns)
    plain = lambda v: None if v is None or v is pd.NA or v != v else float(v) if hasattr(v, "__float__") else v
    return cols, sorted([tuple(str(plain(v)) for v in r) for r in df[cols].itertuples(index=False)])


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    assert rows(catalog.queries()[name](spark, DATA).toPandas()) == rows(con.sql(catalog.oracle_sql()[name]).df())


def one(spark, column, **values):
    from pyspark.sql import functions as F

    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).first()["r"]


def test_small_functions(spark):
    from pyspark.sql import functions as F

    assert one(spark, T.repeats(T.words(F.col("t"))), t="a a b b b") == 3
    assert one(spark, T.mattr(T.words(F.col("t")), 2), t="a b a c") == 1.0
    assert one(spark, F.array_sort(T.frequencies(T.words(F.col("t")))), t="a b a c a") == [1, 1, 3]
    assert one(spark, T.frequencies(T.words(F.col("t"))), t="") == []
    for given, want in {"45": "00:45", "2:13": "02:13", "13:58": "13:58", "0": "00:00", "1201.334": "20:01", "": None, "1:02:03": None, "nan": None}.items():
        assert one(spark, T.clock_time(F.col("t")), t=given) == want
    assert one(spark, T.is_marker(F.col("t")), t="[***NAME***]") and not one(spark, T.is_marker(F.col("t")), t="name")
    assert one(spark, T.safe_name(F.col("t")), t="a<b>::c*") == "a_b_c"
    assert one(spark, S.shift_date(F.col("t"), F.lit(45)), t="01-15-22") == "03-01-22"
    assert one(spark, S.shift_date(F.col("t"), F.lit(0)), t="01-15-75") == "01-15-75"


def test_run_at_end_is_not_counted(spark):
    from pyspark.sql import functions as F

    n, most = T.runs(F.array(*[F.lit(x) for x in (True, True, False, True, True, True)]))
    assert tuple(spark.range(1).select(n, most).first()) == (1, 2)


def test_nearest_speaker_tie_takes_the_first(spark):
    w = spark.createDataFrame([("f", 1, 2.0)], "k string, word int, mid double")
    t = spark.createDataFrame([("f", "S0", 0.0, 1.0), ("f", "S1", 3.0, 4.0)], "k string, speaker string, start double, end double")
    assert S.nearest_speaker(w, t, "k").first()["speaker"] == "S0"
    assert S.nearest_speaker(w, t.where("false"), "k").first()["speaker"] == "UNKNOWN"


def test_chunks_fill_to_the_limit(spark):
    from pyspark.sql import functions as F

    lines = ["aaa", "bb", "cccccccc", "d", "e"]
    assert spark.range(1).select(S.greedy_chunks(F.array(*[F.lit(x) for x in lines]), 5)).first()[0] == [0, 0, 1, 2, 2]


def test_ttr_ways_of_texts_without_tokens_and_of_halves(spark, tmp_path):
    texts = [None, "", "  ", "!!", "n't", " ".join(["a"] * 3 + ["b", "!"] * 4), " ".join(f"w{i % 27} w{i % 5}" for i in range(16))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = rows(catalog.queries()["ttr_ways"](spark, str(tmp_path)).toPandas())
    assert got == rows(con.sql(catalog.oracle_sql()["ttr_ways"]).df()) and len(got[1]) == len(texts)
