"""Sinks: wide tables, JSON documents, clock-stamped transcripts and encrypted
key columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wide_csv(df: DataFrame, path: str, first: list[str], places: int = 3, one_file: bool = False) -> None:
    """CSV with the metadata columns first and floats rounded. one_file sends
    all rows through one task, for small reports only."""
    rest = [c for c in df.columns if c not in first]
    kinds = dict(df.dtypes)
    out = df.select(*first, *[F.round(c, places).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in rest])
    (out.coalesce(1) if one_file else out).write.mode("overwrite").option("header", True).csv(path)


def json_documents(df: DataFrame, path: str) -> None:
    """One JSON document for each row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def _clock(seconds: Column) -> Column:
    whole = F.floor(seconds)
    minutes = F.floor(whole / 60).cast("string")  # more than 99 minutes keep their digits
    return F.concat_ws(":", F.lpad(minutes, F.greatest(F.length(minutes), F.lit(2)), F.lit("0")), F.lpad((whole % 60).cast("string"), 2, "0"))


def clock_transcript(segments: DataFrame, key: str = "file", places: tuple[str, str, str] = ("start", "end", "text")) -> DataFrame:
    """(key, transcript): segments as lines `[MM:SS - MM:SS] text`, in order of
    start, end and text. A recording's segments meet in one group."""
    a, b, t = places
    line = F.concat(F.lit("["), _clock(F.col(a)), F.lit(" - "), _clock(F.col(b)), F.lit("] "), F.trim(F.coalesce(t, F.lit(""))))
    rows = F.array_sort(F.collect_list(F.struct(F.col(a).alias("a"), F.col(b).alias("b"), line.alias("line"))))
    return segments.groupBy(key).agg(F.array_join(F.transform(rows, lambda r: r["line"]), "\n").alias("transcript"))


def seal(df: DataFrame, column: str, key: Column) -> DataFrame:
    """column encrypted with AES-GCM under a 16-, 24- or 32-byte key."""
    return df.withColumn(column, F.base64(F.aes_encrypt(F.col(column).cast("binary"), key)))


def unseal(df: DataFrame, column: str, key: Column) -> DataFrame:
    """The inverse of seal; a value that fails authentication is an error."""
    return df.withColumn(column, F.aes_decrypt(F.unbase64(column), key).cast("string"))
