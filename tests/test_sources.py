"""Readers, sinks and incremental runs on small files."""

import struct

from pyspark.sql import functions as F

from voxloom.sources import readers as R
from voxloom.sources import sinks as K
from voxloom.streaming import incremental as I

TRANSCRIPT = "Gap: 1.250 - 2.5\nSpeaker 0: Rain fell all night.\n31.5 - 32.75\nspeaker 1: So it did.\nPause: 3.5 - 4.25\n\nloose line\nSpeaker 2:  \n"
INLINE = "[0.11 - 4.49] Speaker 0: Hello there.\n[[*** TEMPORAL ***]] Speaker 0: I was born.\nSpeaker Unknown: Yes\nGAP here\n"


def _turns(spark, text, style):
    lines = R.lines_of(spark.createDataFrame([("a", text)], "name string, text string"))
    return [(r.speaker, r.said) for r in R.turns(lines, style).orderBy("pos").collect()]


def test_turn_styles(spark):
    two = [("0", "Rain fell all night."), ("1", "So it did.")]
    assert _turns(spark, TRANSCRIPT, "labelled") == two
    assert _turns(spark, TRANSCRIPT, "open") == [*two, (None, "loose line")]
    assert _turns(spark, INLINE, "bracketed") == [("0", "Hello there."), ("Unknown", "Yes")]
    assert _turns(spark, INLINE, "labelled") == []
    assert _turns(spark, "", "open") == []
    assert _turns(spark, None, "open") == []


def test_texts_and_clock_lines(spark, tmp_path):
    (tmp_path / "deep/er").mkdir(parents=True)
    (tmp_path / "deep/er/b_transcript.txt").write_bytes(b"head\n[01:05 - 2:10] some \xff text\n")
    (tmp_path / "other.txt").write_text("no")
    docs = R.texts(spark, str(tmp_path))
    assert [r.name for r in docs.collect()] == ["b_transcript.txt"]
    assert [tuple(r) for r in R.clock_lines(R.lines_of(docs)).collect()] == [("b_transcript.txt", 1, 65, 130, "some  text")]


def test_rttm(spark, tmp_path):
    (tmp_path / "a.rttm").write_text("SPEAKER a 1 0.000 2.450 <NA> <NA> SPEAKER_01 <NA> <NA>\nSPEAKER a 1 2.5 x <NA> <NA> HOST <NA>\nSPEAKER a 1 3\nLEXEME a 1 0 1 <NA> <NA> S1 <NA>\n")
    got = [tuple(r)[1:] for r in R.rttm(spark, str(tmp_path)).orderBy("start").collect()]
    assert got == [("a", 0.0, 2.45, 2.45, "SPEAKER_01", 1), ("a", 2.5, None, None, "HOST", 0)]


def test_word_timings(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"audio_file":"a.wav","words":[{"word":"Hi","start":0.1,"end":0.3,"speaker":"S0"},{"word":"you"}]}')
    (tmp_path / "b.json").write_text('{"segments":[{"text":"x","words":[{"word":"x,","start":1,"end":2}]},{"text":"none"},{"words":[{"word":"y"}]}]}')
    got = [tuple(r)[1:] for r in R.word_timings(spark, str(tmp_path)).orderBy("path", "pos").collect()]
    assert got == [(0, "Hi", 0.1, 0.3, "S0"), (1, "you", None, None, None), (0, "x,", 1.0, 2.0, None), (1, "y", None, None, None)]


def test_tables(spark, tmp_path):
    (tmp_path / "key.csv").write_text("mrn,UID,date_shift_days\n1234,P001,45\n12345,P002,-10\n77,P003,\n")
    assert sorted(map(tuple, R.deid_key(spark, str(tmp_path / "key.csv")).collect()), key=str) == [("0077", "P003", None), ("1234", "P001", 45), ("12345", "P002", -10)]
    (tmp_path / "t.csv").write_text('file,x\na.wav,"two\nlines, ""q"""\n')
    assert [tuple(r) for r in R.table(spark, str(tmp_path / "t.csv"), ("FILE", "file")).collect()] == [("a.wav", 'two\nlines, "q"', "a.wav")]
    (tmp_path / "log.txt").write_text("Row 12: 'my old boss' not found in 999-1\nRow 12: 'my old boss' not found in 999-1\nRow 2: 'it's here' not found in 7\nnoise\nRow 3: none not found in 8\n")
    assert sorted(map(tuple, R.not_found_log(spark, str(tmp_path / "log.txt")).collect())) == [("7", "it"), ("999-1", "my old boss")]
    (tmp_path / "v.txt").write_text("cat 1 2.5\ndog -1 0\n")
    assert sorted(map(tuple, R.vectors(spark, str(tmp_path / "v.txt")).collect())) == [("cat", [1.0, 2.5]), ("dog", [-1.0, 0.0])]


def test_files(spark, tmp_path):
    body = b"\x80" * 10
    head = b"RIFF" + struct.pack("<I", 46) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 2, 44100, 176400, 4, 16) + b"data" + struct.pack("<I", 10)
    (tmp_path / "a.WAV").write_bytes(head + body)
    (tmp_path / "b.wav").write_bytes(b"nothing")
    got = {r.path.rsplit("/", 1)[1]: tuple(r)[1:] for r in R.wav_headers(spark, str(tmp_path)).collect()}
    assert got == {"a.WAV": (2, 2, 44100), "b.wav": (None, None, None)}
    assert {(r.name, r["size"]) for r in R.inventory(spark, str(tmp_path)).collect()} == {("a.WAV", 54), ("b.wav", 7)}


def test_sinks(spark, tmp_path):
    seg = spark.createDataFrame([("f", 65.9, 70.0, "b"), ("f", 0.0, 5.0, " a "), ("f", 6001.0, 6002.0, None)], "file string, start double, end double, text string")
    assert K.clock_transcript(seg).first().transcript == "[00:00 - 00:05] a\n[01:05 - 01:10] b\n[100:01 - 100:02] "
    df = spark.createDataFrame([("k", 1.23456, "x")], "id string, v double, note string")
    K.wide_csv(df, str(tmp_path / "csv"), ["note"], one_file=True)
    assert [tuple(r) for r in R.table(spark, str(tmp_path / "csv")).collect()] == [("x", "k", "1.235")]
    K.json_documents(df, str(tmp_path / "json"))
    assert [tuple(r) for r in spark.read.schema(df.schema).json(str(tmp_path / "json")).collect()] == [("k", 1.23456, "x")]
    key = F.lit("0123456789abcdef0123456789abcdef").cast("binary")
    sealed = K.seal(df, "id", key)
    assert sealed.first().id != "k" and K.unseal(sealed, "id", key).first().id == "k"


def test_incremental(spark, tmp_path):
    src, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    src.mkdir()
    (src / "a_transcript.txt").write_text("Speaker 0: one\n")
    run = lambda: I.run_new(I.new_texts(spark, str(src)), out, mark, lambda s: R.turns(R.lines_of(s)), 60)
    run()
    (src / "b_transcript.txt").write_text("Speaker 1: two\nSpeaker 0: three\n")
    run()
    run()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("a_transcript.txt", 0, "0", "one"), ("b_transcript.txt", 0, "1", "two"), ("b_transcript.txt", 1, "0", "three")]
    left = I.remaining(spark.createDataFrame([("a",), ("b",), (None,)], "k string"), spark.createDataFrame([("a",), ("a",)], "k string"), "k")
    assert sorted(str(r.k) for r in left.collect()) == ["None", "b"]


def test_window_counts_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = str(tmp_path / "events")
    events.repartition(2).write.parquet(src)
    I.run_new(I.window_counts(I.new_rows(spark, src)), str(tmp_path / "o"), str(tmp_path / "m"), timeout=60)
    batch = I.window_counts(events)
    assert batch.agg(F.sum("n")).first()[0] == events.count()
    # windows that the watermark has not closed wait for the next run
    closed = spark.read.schema(batch.schema).parquet(str(tmp_path / "o")).drop("total")
    assert 0 < closed.count() <= batch.count() and closed.exceptAll(batch.drop("total")).count() == 0
