"""Features over tokens and sentences. The tokenizer is a rule (runs of letters
and digits, marks one by one, English contractions split off), not a trained
model; built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.text import bind, types

# --- Fixed values: suffixes, lists and patterns that results depend on. ---
TOKEN = r"(n't|'(?:s|re|ve|ll|d|m)|[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_])"
CONTRACTIONS = [("n't", "not"), ("'re", "are"), ("'ve", "have"), ("'ll", "will"), ("'d", "would"), ("'m", "am")]
STREETS = [r"(?i)\d+\s+\w+\s+(street|st|avenue|ave|road|rd|boulevard|blvd|drive|dr|lane|ln|way|court|ct|place|pl)", r"(?i)\b\d+\s+[A-Z][a-z]+\s+(Street|Avenue|Road|Boulevard|Drive|Lane|Way|Court|Place)\b"]
VAGUE_TIMES = ["sometime", "recently", "once"]
VAGUE_PLACES = ["somewhere", "that place"]
EXACT_DATE = r"\d{1,2}[/-]\d{1,2}"
# --- End of fixed values. ---


def tokens(text: Column) -> Column:
    split = F.regexp_replace(F.coalesce(text, F.lit("")), r"n't\b", " n't")
    return F.regexp_extract_all(split, F.lit(TOKEN), F.lit(1))


def sentences(text: Column) -> Column:
    """Parts that end in . ! or ? before white space."""
    return F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])\s+", "$1\u0001"), "\u0001"), lambda s: F.trim(s) != "")


def expand(ts: Column) -> Column:
    """Tokens with a contraction's ending as a word of its own; what is left of
    a token that is only the ending is an empty one."""

    def parts(t):
        out = F.array(t)
        for ending, word in reversed(CONTRACTIONS):
            out = F.when(t.endswith(ending), F.array(F.substring(t, F.lit(1), F.length(t) - len(ending)), F.lit(word))).otherwise(out)
        return out

    return F.flatten(F.transform(ts, parts))


def only_words(ts: Column) -> Column:
    return F.filter(ts, lambda t: t.rlike(r"^[\p{L}\p{N}]+$"))


def spread(values: Column) -> dict[str, Column]:
    """min, max, mean, population deviation and range of an array of numbers;
    null if it is empty. The deviation is from running means, as squares less
    the squared mean lose digits that rounding shows."""
    n = F.nullif(F.size(values), F.lit(0))
    mean = F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / n
    state = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))

    def step(s, x):
        m = s["m"] + (x - s["m"]) / (s["n"] + 1.0)
        return F.struct((s["n"] + 1.0).alias("n"), m.alias("m"), (s["q"] + (x - m) * (x - s["m"])).alias("q"))

    var = F.aggregate(values, state, step, lambda s: s["q"]) / n
    return {"min": F.array_min(values), "max": F.array_max(values), "mean": mean, "std": F.sqrt(var), "range": F.array_max(values) - F.array_min(values)}


def quartiles(values: Column) -> dict[str, Column]:
    """q25, q50 and q75 of an array, interpolated; null if it is empty."""

    def at(s, q):
        place = (F.size(s) - 1) * q
        low = F.floor(place).cast("int")
        a, b = F.get(s, low), F.get(s, F.least(low + 1, F.size(s) - 1))
        return a + (b - a) * (place - low)

    def of(q):
        return bind(F.array_sort(values), lambda s: at(s, q))

    return {f"q{int(q * 100)}": of(q) for q in (0.25, 0.5, 0.75)}


def ttr(ts: Column) -> Column:
    return F.when(F.size(ts) == 0, 0.0).otherwise(types(ts) / F.greatest(F.size(ts), F.lit(1)))


def ttr_ways(ts: Column) -> Column:
    """TTR of the tokens in the six ways of preparing them."""
    low = lambda a: F.transform(a, F.lower)
    single = lambda a: F.filter(a, lambda x, i: (i == 0) | (x != F.get(a, i - 1)))
    made = F.struct(ts.alias("t"), low(ts).alias("l"), low(expand(ts)).alias("e"))  # each way once
    return bind(made, lambda s: F.array(ttr(s["t"]), ttr(s["l"]), ttr(only_words(s["l"])), ttr(s["e"]), *[bind(only_words(s["e"]), f) for f in (ttr, lambda a: ttr(single(a)))]))


def word_lengths(ws: Column) -> dict[str, Column]:
    """Mean, most and population variance of the letters of words of letters,
    and the share of all words over nine characters, in percent."""
    sizes = F.transform(F.filter(ws, lambda w: w.rlike(r"^\p{L}+$")), F.length)
    n = F.size(sizes)
    mean = F.aggregate(sizes, F.lit(0.0), lambda s, x: s + x) / F.nullif(n, F.lit(0))
    squares = F.aggregate(sizes, F.lit(0.0), lambda s, x: s + x * x) / F.nullif(n, F.lit(0))
    return {"mean_length": F.coalesce(mean, F.lit(0.0)), "max_length": F.coalesce(F.array_max(sizes), F.lit(0)), "var_length": F.coalesce(squares - mean * mean, F.lit(0.0)),
            "long_percent": F.coalesce(100.0 * F.size(F.filter(ws, lambda w: F.length(w) > 9)) / F.nullif(F.size(ws), F.lit(0)), F.lit(0.0))}


def capitals(text: Column) -> dict[str, Column]:
    """Capitalised tokens past the first of a sentence, their rate, tokens all
    in capitals, and runs of two or more capitals that end before the text."""
    rest = F.flatten(F.transform(sentences(text), lambda s: bind(tokens(s), lambda t: F.when(F.size(t) > 1, F.slice(t, F.lit(2), F.size(t) - 1)).otherwise(F.slice(t, F.lit(1), F.lit(0))))))
    upper = lambda t: t.rlike(r"^\p{Lu}")
    shout = lambda t: t.rlike(r"\p{Lu}") & (F.upper(t) == t)
    mixed = F.size(F.filter(rest, lambda t: upper(t) & ~shout(t)))
    runs = bind(F.transform(rest, upper), lambda f: F.size(F.filter(F.sequence(F.lit(2), F.greatest(F.size(f) - 1, F.lit(2))), lambda i: (i < F.size(f)) & F.coalesce(F.get(f, i - 1) & F.get(f, i - 2) & ~F.get(f, i), F.lit(False)))))
    return {"mid_capitals": mixed, "mid_rate": F.coalesce(mixed / F.nullif(F.size(rest), F.lit(0)), F.lit(0.0)), "all_caps": F.size(F.filter(tokens(text), lambda t: (F.length(t) > 1) & shout(t))), "title_runs": runs}


def specificity(text: Column) -> dict[str, Column]:
    low = F.lower(text)
    there = lambda words: sum((low.contains(w).cast("int") for w in words), F.lit(0))
    return {"exact_dates": F.regexp_count(text, F.lit(EXACT_DATE)), "vague_times": there(VAGUE_TIMES), "vague_places": there(VAGUE_PLACES)}


def strip_marks(text: Column) -> Column:
    marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    return F.translate(F.lower(text), marks, "")
