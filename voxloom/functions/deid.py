"""De-identification of texts: record numbers, dates, listed phrases and
positions. Built-in expressions and equi joins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import bind
from voxloom.operators.speech import shift_date

# --- Fixed values: patterns, labels and prompts that results depend on. ---
DATE = r"\b\d{1,2}-\d{1,2}-\d{2,4}\b"
REDACTED = "[LLMAnon-Redacted]"
# --- End of fixed values. ---


def number_parts(text: Column, lengths: list[int]) -> Column:
    """The different substrings of given lengths of the text's runs of digits,
    by which record numbers are found with an equi join."""
    runs = F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))
    part = lambda r, k: F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - (k - 1), F.lit(1))), lambda i: F.substring(r, i, F.lit(k)))
    each = F.flatten(F.transform(runs, lambda r: F.flatten(F.array(*[F.when(F.length(r) >= k, part(r, k)).otherwise(F.expr("cast(array() as array<string>)")) for k in lengths]))))
    return F.array_distinct(each)


def with_records(rows: DataFrame, key: DataFrame, row_id: str, text: Column, lengths: list[int]) -> DataFrame:
    """rows with hits, the records of key(mrn, uid, days) whose number is in the
    text, longest first, then by number. Record numbers are digits of one of
    the given lengths. The join is by equal substrings, so neither side is
    repeated for the other."""
    parts = rows.select(F.col(row_id), F.explode(number_parts(text, lengths)).alias("mrn"))
    hits = parts.join(key, "mrn").groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct((-F.length("mrn")).alias("o"), "mrn", "uid", "days"))).alias("hits"))
    none = F.expr("cast(array() as array<struct<o: int, mrn: string, uid: string, days: int>>)")
    return rows.join(hits, row_id, "left").withColumn("hits", F.coalesce("hits", none))


def replace_records(text: Column, hits: Column, once: bool = False) -> Column:
    """struct(text, n): record numbers become their uid, longest first; n
    counts the places, or with once the records."""
    start = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))

    def step(s, h):
        found = ((F.length(s["text"]) - F.length(F.replace(s["text"], h["mrn"], F.lit("")))) / F.length(h["mrn"])).cast("long")
        return F.struct(F.replace(s["text"], h["mrn"], h["uid"]).alias("text"), (s["n"] + (F.least(found, F.lit(1).cast("long")) if once else found)).alias("n"))

    return F.aggregate(hits, start, step)


def shift_dates(text: Column, days: Column) -> Column:
    """struct(text, n): dates M-D-YY or M-D-YYYY of the text moved by days, n
    of them changed. What is no date (month 13, February 30) stays; nothing
    moves if days is null. A moved date has two digits for month and day."""
    parts, found = F.split(text, DATE, -1), F.regexp_extract_all(text, F.lit(f"({DATE})"), F.lit(1))

    def moved(d):
        f = F.split(d, "-")
        two = F.concat_ws("-", F.lpad(f[0], 2, "0"), F.lpad(f[1], 2, "0"), f[2])
        fits = f[0].cast("int").between(1, 12) & f[1].cast("int").between(1, 31) & (F.length(f[2]) != 3)
        return F.coalesce(F.when(fits, shift_date(two, days)), d)

    out = F.transform(found, moved)
    joined = lambda m: F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(m, lambda d, i: F.concat(d, F.get(parts, i + 1))), ""))
    return bind(out, lambda m: F.struct(joined(m).alias("text"), F.size(F.filter(F.arrays_zip(m.alias("m"), found.alias("f")), lambda z: z["m"] != z["f"])).cast("long").alias("n")))


def deidentify(rows: DataFrame, key: DataFrame, row_id: str, columns: list[str], lengths: list[int], days: Column | None = None) -> DataFrame:
    """rows with their columns de-identified and n, the replacements. The dates
    of a row move by the days of the first record found anywhere in it, or by
    days where that is not null (the record that a file's name gives)."""
    found = with_records(rows, key, row_id, F.concat_ws(" ", *columns), lengths)
    move = F.get("hits", F.lit(0))["days"]
    if days is not None:
        move = F.coalesce(days, move)
    out, n = found.withColumn("_days", move), F.lit(0).cast("long")
    for c in columns:
        out = out.withColumn(f"_{c}", replace_records(F.col(c), F.col("hits")))
        out = out.withColumn(f"_{c}_d", shift_dates(F.col(f"_{c}.text"), F.col("_days")))
        n = n + F.coalesce(F.col(f"_{c}.n"), F.lit(0)) + F.coalesce(F.col(f"_{c}_d.n"), F.lit(0))
    keep = [F.col(f"_{c}_d.text").alias(c) if c in columns else F.col(c) for c in rows.columns]
    return out.select(*keep, n.alias("n"))


def redact_all(text: Column, phrases: Column, label: str = REDACTED) -> Column:
    """Every place of the phrases (an array, longest first) becomes the label."""
    listed = F.array_sort(F.transform(F.filter(phrases, lambda p: F.length(p) > 0), lambda p: F.struct((-F.length(p)).alias("o"), p.alias("p"))))
    return F.aggregate(listed, text, lambda t, p: F.replace(t, p["p"], F.lit(label)))


def locate(text: Column, phrase: Column, context: int = 200) -> Column:
    """struct(start, end, how, around): where a phrase stands, from 0: as it is,
    else in any case, else by its first 20 characters with white space made
    even; null positions if it is nowhere. around has context characters on
    either side."""
    even = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    exact, loose = F.instr(text, phrase), F.instr(F.lower(text), F.lower(phrase))
    near = F.instr(even(text), F.substring(even(phrase), 1, 20))
    at = F.when(exact > 0, exact).when(loose > 0, loose).when(near > 0, near)
    how = F.when(exact > 0, "exact").when(loose > 0, "any_case").when(near > 0, "even_space").otherwise("missing")
    start = at - 1
    end = F.least(start + F.length(phrase), F.length(text))
    low = F.greatest(start - context, F.lit(0))
    return F.struct(start.alias("start"), end.alias("end"), how.alias("how"), F.substring(text, low + 1, end + context - low).alias("around"))


def redact_at(text: Column, spans: Column) -> Column:
    """spans (start, end, label), from 0, replaced from right to left, so that
    positions hold; a span that reaches over one to its right is left out."""
    start = F.struct(text.alias("text"), F.lit(1 << 30).alias("floor"))
    ordered = F.reverse(F.array_sort(spans))

    def step(s, x):
        ok = (x["end"] <= s["floor"]) & (x["start"] < x["end"])
        return F.when(ok, F.struct(F.overlay(s["text"], x["label"], x["start"] + 1, x["end"] - x["start"]).alias("text"), x["start"].alias("floor"))).otherwise(s)

    return F.aggregate(ordered, start, step, lambda s: s["text"])


def strong_password(value: Column) -> Column:
    """Twelve characters or more, with an upper- and a lower-case letter, a
    digit and a symbol."""
    return (F.length(value) >= 12) & value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]") & value.rlike("[^A-Za-z0-9]")


def prompt(template: str, **values: Column) -> Column:
    """A template with {names} filled in."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def object_items(json: Column, path: str) -> Column:
    """The objects of a JSON array at path, as variants; items that are no
    objects go; null where the text is no JSON."""
    items = F.try_variant_get(F.try_parse_json(json), path, "array<variant>")
    return F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT"))
