"""Readers of transcripts, speaker turns, word timings, review logs and media
headers. Every reader is a DataFrame plan over Spark's own file sources, so
files are split over tasks and only the wanted columns are read.

Undecodable bytes are dropped, blank lines are skipped, and a row that doesn't
have the format's shape is left out unless its reader says otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: line patterns of the formats
TIME_LINE = r"^(\[)?(\w+:?\s*)?[\d\.]+ *[-â€“] *[\d\.]+"
SPEAKER_LINE = r"(?i)^Speaker (\d+):\s*(.*)"
BRACKETED_LINE = r"^\[[\d\.\s\-]+\]\s*Speaker\s+(\d+|Unknown):\s*(.+)"
PLAIN_LINE = r"^Speaker\s+(\d+|Unknown):\s*(.+)"
CLOCK_LINE = r"^\[(\d+:\d+)\s*-\s*(\d+:\d+)\]\s*(.*)"

_WORD = "struct<word:string,start:double,end:double,speaker:string>"
WORD_JSON = f"audio_file string, rttm_file string, total_words int, words array<{_WORD}>, segments array<struct<text:string,words:array<{_WORD}>>>"


def name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def texts(spark: SparkSession, path: str, glob: str = "*_transcript.txt") -> DataFrame:
    """(path, name, text): one row for each file below path, at any depth."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    at = F.col("_metadata.file_path")
    return files.select(at.alias("path"), name_of(at).alias("name"), F.translate("value", "�", "").alias("text"))


def lines_of(docs: DataFrame, id_col: str = "name", text_col: str = "text") -> DataFrame:
    """(id, pos, line): trimmed lines that aren't blank, pos from 0."""
    rows = docs.select(id_col, F.posexplode(F.split(text_col, r"\r?\n|\r")).alias("pos", "line"))
    return rows.withColumn("line", F.regexp_replace("line", r"^\s+|\s+$", "")).where("line <> ''")


def turns(lines: DataFrame, style: str = "labelled") -> DataFrame:
    """lines with the columns speaker and said instead of line.

    labelled: lines that begin with times go, labels in either case;
    bracketed: gap lines go, times in brackets may precede a label;
    open: as labelled, and a line without a label is kept with speaker null
    (it belongs to the combined text only)."""
    keep = [c for c in lines.columns if c != "line"]
    if style == "bracketed":
        rows = lines.where(~F.lower("line").startswith("gap"))
        pick = lambda k: F.when(F.col("line").rlike(BRACKETED_LINE), F.regexp_extract("line", BRACKETED_LINE, k)).when(F.col("line").rlike(PLAIN_LINE), F.regexp_extract("line", PLAIN_LINE, k))
    elif style in ("labelled", "open"):
        rows = lines.where(~F.col("line").rlike(TIME_LINE))
        pick = lambda k: F.when(F.col("line").rlike(SPEAKER_LINE), F.regexp_extract("line", SPEAKER_LINE, k))
    else:
        raise ValueError(f"unknown style {style}")
    said = pick(2)
    if style == "open":
        said = F.coalesce(said, F.col("line"))
    return rows.select(*keep, pick(1).alias("speaker"), F.trim(said).alias("said")).where("said <> ''")


def clock_lines(lines: DataFrame) -> DataFrame:
    """Lines `[MM:SS - MM:SS] text` as start_s, end_s, said; others go."""
    keep = [c for c in lines.columns if c != "line"]

    def seconds(k):
        part = F.split(F.regexp_extract("line", CLOCK_LINE, k), ":")
        return part[0].cast("int") * 60 + part[1].cast("int")

    return lines.where(F.col("line").rlike(CLOCK_LINE)).select(*keep, seconds(1).alias("start_s"), seconds(2).alias("end_s"), F.regexp_extract("line", CLOCK_LINE, 3).alias("said"))


def rttm(spark: SparkSession, path: str, glob: str = "*.rttm") -> DataFrame:
    """(path, file, start, duration, end, speaker, speaker_num) of SPEAKER rows
    with eight fields or more; a label without digits has number 0, a time
    that is no number is null."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path).select(F.col("_metadata.file_path").alias("path"), F.split(F.trim("value"), r"\s+").alias("f"))
    rows = rows.where((F.size("f") >= 8) & (F.col("f")[0] == "SPEAKER"))
    start, duration = F.expr("try_cast(f[3] as double)"), F.expr("try_cast(f[4] as double)")
    number = F.regexp_extract(F.col("f")[7], r"(\d+)", 1)
    return rows.select("path", F.col("f")[1].alias("file"), start.alias("start"), duration.alias("duration"), (start + duration).alias("end"), F.col("f")[7].alias("speaker"),
                       F.when(number == "", 0).otherwise(number.try_cast("int")).alias("speaker_num"))


def word_timings(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """(path, pos, word, start, end, speaker): the words of a file in order,
    from its words or else from its segments. Words without times stay."""
    docs = spark.read.schema(WORD_JSON).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(path)
    nested = F.flatten(F.filter(F.transform("segments", lambda s: s["words"]), lambda w: w.isNotNull()))
    words = F.when(F.size("words") > 0, F.col("words")).otherwise(nested)
    return docs.select(F.col("_metadata.file_path").alias("path"), F.posexplode(words).alias("pos", "w")).select("path", "pos", "w.word", "w.start", "w.end", "w.speaker")


def table(spark: SparkSession, path: str, file_columns: tuple[str, ...] = ()) -> DataFrame:
    """A CSV table with a header, all strings, quoted line breaks allowed. With
    file_columns, file_key is the first of those there that is filled, or
    else the first column."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if not file_columns:
        return df
    found = [F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`")) for c in file_columns if c in df.columns]
    return df.withColumn("file_key", F.coalesce(*found, F.col(f"`{df.columns[0]}`")))


def deid_key(spark: SparkSession, path: str) -> DataFrame:
    """(mrn, uid, shift_days): mrn padded to four digits, longer ones kept."""
    mrn = F.trim("mrn")
    return table(spark, path).select(F.when(F.length(mrn) < 4, F.lpad(mrn, 4, "0")).otherwise(mrn).alias("mrn"), F.trim("UID").alias("uid"), F.expr("try_cast(trim(date_shift_days) as int)").alias("shift_days"))


def not_found_log(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (participant_id, text) of `Row 3: 'text' not found in id`. The
    text ends at its first apostrophe; other lines go."""
    part = F.split(F.trim("value"), "not found in", -1)
    rows = spark.read.text(path).where(F.col("value").contains("Row")).select(part.alias("part")).where(F.size("part") == 2)
    quoted = F.split(F.col("part")[0], "'", -1)
    return rows.where(F.size(quoted) > 1).select(F.trim(F.col("part")[1]).alias("participant_id"), quoted[1].alias("text")).distinct()


def vectors(spark: SparkSession, path: str) -> DataFrame:
    """(word, vector): lines `word v1 ... vd`."""
    f = F.split(F.rtrim("value"), " ")
    return spark.read.text(path).where(F.size(f) > 1).select(f[0].alias("word"), F.slice(f, F.lit(2), F.size(f) - 1).cast("array<float>").alias("vector"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, size, mtime) of every file below path that isn't hidden;
    contents aren't read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df.select("path", name_of(F.col("path")).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime")).where(~F.col("name").startswith("."))


def wav_headers(spark: SparkSession, path: str, glob: str = "*.{wav,WAV}") -> DataFrame:
    """(path, channels, sample_bytes, rate) from the canonical 44-byte header;
    null where a file isn't RIFF/WAVE."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", F.substring("content", 1, 44).alias("h"))

    def little(at, n):  # at: offset from 0
        return F.conv(F.concat(*[F.hex(F.substring("h", at + k + 1, 1)) for k in reversed(range(n))]), 16, 10).cast("int")

    is_wav = (F.hex(F.substring("h", 1, 4)) == "52494646") & (F.hex(F.substring("h", 9, 4)) == "57415645")
    only = lambda c, name: F.when(is_wav, c).alias(name)
    return df.select("path", only(little(22, 2), "channels"), only((little(34, 2) / 8).cast("int"), "sample_bytes"), only(little(24, 4), "rate"))
