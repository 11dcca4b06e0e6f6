"""Column functions for transcript text. Every one is built-in expressions
only, so it stays inside the JVM and features can be pruned one by one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: word lists and patterns that results depend on. ---
FILLED_PAUSES = ["um", "uh", "er", "ah", "mm", "hmm"]
FILLERS = ["um", "uhm", "ah", "uh", "hm", "huh", "er", "mm"]
UMS_AHS = ["um", "uhm", "ah", "uh", "hm", "huh"]
CORRECTIONS = ["i mean", "or rather", "actually", "correction", "sorry"]
DISCOURSE = {
    "temporal": ["then", "next", "after", "before", "while", "when", "later", "earlier", "finally"],
    "causal": ["because", "since", "so", "therefore", "thus", "hence", "consequently"],
    "contrast": ["but", "however", "although", "though", "yet", "nevertheless", "instead"],
    "additive": ["and", "also", "moreover", "furthermore", "additionally", "plus"],
}
CLARIFICATION = ["for example", "for instance", "such as", "like", "that is"]
NARRATIVE = {
    "setting": ["was", "were"],
    "problem": ["problem", "issue", "difficult", "hard", "trouble", "challenge"],
    "resolution": ["solved", "fixed", "resolved", "ended", "finally"],
    "emotion": ["happy", "sad", "angry", "excited", "worried", "surprised", "felt"],
    "sequence": ["first", "second", "third", "then", "next", "finally"],
}
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
          "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep", "sept", "oct", "nov", "dec"]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
        "mon", "tue", "tues", "wed", "thu", "thur", "thurs", "fri", "sat", "sun"]
RELATIVE = ["yesterday", "tomorrow", "today", "last week", "next month", "last year", "recently", "lately"]
LANDMARKS = ["hospital", "school", "university", "building", "center", "mall", "church", "temple", "mosque", "library", "park"]
PREPOSITIONS = ["at", "in", "on", "near", "by", "inside", "outside", "beside", "behind"]
DATES = [r"[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4}", r"[0-9]{4}[/-][0-9]{1,2}[/-][0-9]{1,2}"]
YEAR, CLOCK, AMPM = r"\b(?:19|20)[0-9]{2}\b", r"[0-9]{1,2}:[0-9]{2}", r"[0-9]{1,2}\s*(?:am|pm|a\.m\.|p\.m\.)"
MARKERS = [r"^\[\*\*\*[A-Z][A-Z\s]+\*\*\*\]$", r"^\[\*+[A-Za-z\s]+\*+\]$"]
AGE = r"\b(?:9[0-9]|[1-9][0-9]{2,})\s*years?\s*old\b"
CITY_STATE, ZIP_CODE = r"[A-Z][a-z]+,\s*[A-Z]{2}\b", r"\b[0-9]{5}(?:-[0-9]{4})?\b"
# --- End of fixed values. ---

SPACE = r"\s+"


def words(text: Column) -> Column:
    """Words between white space; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda x: x != "")


def count_of(text: Column, part: str) -> Column:
    """Occurrences of a substring that don't overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def count_any(text: Column, parts: list[str], padded: bool = False) -> Column:
    return sum((count_of(text, f" {p} " if padded else p) for p in parts), F.lit(0))


def count_pattern(text: Column, *patterns: str) -> Column:
    return sum((F.regexp_count(text, F.lit(p)) for p in patterns), F.lit(0))


def among(ws: Column, listed: list[str]) -> Column:
    """How many words are in a list."""
    return F.size(F.filter(ws, lambda x: F.lower(x).isin(listed)))


def types(ws: Column) -> Column:
    return F.size(F.array_distinct(ws))


def bind(value: Column, use) -> Column:
    """use(value) with value computed once for a row: a lambda would compute
    an expression that it refers to once for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def frequencies(ws: Column) -> Column:
    """Counts of the distinct words, from runs in the sorted array: n log n
    where comparing each word with each distinct word is quadratic."""

    def from_sorted(s):
        starts = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (F.try_element_at(s, i) != F.try_element_at(s, F.greatest(i - 1, F.lit(1)))))
        return bind(starts, lambda b: F.transform(b, lambda x, k: F.coalesce(F.get(b, k + 1), F.size(s) + 1) - x))

    return F.when(F.size(ws) > 0, bind(F.array_sort(ws), from_sorted)).otherwise(F.expr("cast(array() as array<int>)"))


def repeats(ws: Column) -> Column:
    """Words that equal the one before."""
    return F.size(F.filter(ws, lambda x, i: (i > 0) & (x == F.get(ws, i - 1))))


def without_repeats(ws: Column) -> Column:
    return F.filter(ws, lambda x, i: (i == 0) | (x != F.get(ws, i - 1)))


def mattr(ws: Column, window: int) -> Column:
    """Mean share of distinct words in all windows; plain TTR if shorter.

    A word is the first of its kind in the windows that begin after the place
    before where it stands and hold it; what these ranges add up to is the sum
    of the distinct words of all windows, from one sort of the words."""
    n = F.size(ws)
    last = n - (window - 1)  # of the windows' starts

    def total(s):
        def firsts(x, k):
            before = F.get(s, k - 1)
            after = F.when((k > 0) & (before["w"] == x["w"]), before["i"]).otherwise(0)
            return F.greatest(F.least(x["i"], last) - F.greatest(after + 1, x["i"] - (window - 1)) + 1, F.lit(0))

        return F.aggregate(F.transform(s, firsts), F.lit(0).cast("long"), lambda a, x: a + x)

    placed = F.array_sort(F.transform(ws, lambda w, i: F.struct(w.alias("w"), (i + 1).alias("i"))))
    mean = bind(placed, total) / (F.greatest(last, F.lit(1)) * window)
    return F.when(n == 0, 0.0).when(n < window, types(ws) / F.greatest(n, F.lit(1))).otherwise(mean)


def runs(flags: Column, flush: bool = False) -> tuple[Column, Column]:
    """(number of runs of two or more, longest such run) of an array of
    booleans. A run that reaches the end counts only with flush."""
    state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("most"), F.lit(0).alias("now"))

    def step(s, x):
        ends = ~x & (s["now"] >= 2)
        return F.struct((s["n"] + ends.cast("int")).alias("n"), F.greatest(s["most"], F.when(ends, s["now"]).otherwise(0)).alias("most"), F.when(x, s["now"] + 1).otherwise(0).alias("now"))

    body = F.concat(flags, F.array(F.lit(False))) if flush else flags
    return F.aggregate(body, state, step, lambda s: s["n"]), F.aggregate(body, state, step, lambda s: s["most"])


def ngrams(ws: Column, n: int) -> Column:
    last = F.size(ws) - n + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(ws, i, n), " "))).otherwise(F.expr("cast(array() as array<string>)"))


def clean_word(w: Column) -> Column:
    """A word as phrases are matched: lower case, no marks at its ends."""
    return F.lower(F.btrim(w, F.lit(".,!?'\"")))


def mm_ss(seconds: Column) -> Column:
    s = F.floor(seconds)
    return F.format_string("%02d:%02d", F.floor(s / 60), s % 60)


def clock_time(value: Column) -> Column:
    """Times as typed to MM:SS: seconds, M:SS, decimal seconds; blank, nan and
    three-part times are null."""
    v = F.trim(value)
    plain = F.try_to_number(F.when(v.rlike(r"^[0-9]+(\.[0-9]+)?$"), F.regexp_extract(v, r"^([0-9]+)", 1)), F.lit("999999999")).cast("long")
    parts = F.split(v, ":")
    pair = F.concat_ws(":", F.lpad(F.get(parts, F.lit(0)), 2, "0"), F.lpad(F.get(parts, F.lit(1)), 2, "0"))
    return F.when(v.rlike(r"^[0-9]{1,2}:[0-9]{1,2}$"), pair).when(plain.isNotNull(), F.format_string("%02d:%02d", F.floor(plain / 60), plain % 60))


def safe_name(name: Column) -> Column:
    return F.btrim(F.regexp_replace(F.translate(name, '<>:"|?*,&', "_________"), "_+", "_"), F.lit("_"))


def human_size(n: Column) -> Column:
    """B to GB with one digit, halves to the even one."""
    k = F.lit(1024.0)
    one = lambda x, unit: F.format_string(f"%.1f {unit}", F.bround(x.cast("double"), 1))
    return F.when(n < k, one(n, "B")).when(n < k * k, one(n / k, "KB")).when(n < k * k * k, one(n / (k * k), "MB")).otherwise(one(n / (k * k * k), "GB"))


def is_marker(text: Column) -> Column:
    """A de-identification marker rather than text: [***NAME***]."""
    return text.rlike(MARKERS[0]) | text.rlike(MARKERS[1])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))
