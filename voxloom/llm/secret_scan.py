"""Secrets, told apart by who owns them across the corpus.

Candidates are found by pattern with their code-point positions, all in the
JVM: matches are fenced by two control characters, the text is split at the
fences, and a fold over the pieces gives the positions. (A text's own
occurrences of those control characters are mapped to a third one first,
which no pattern accepts either, so lengths and matches stay.) The hash of
every candidate value is aggregated over the corpus: first by owner, then by
hash, to the numbers of distinct repositories and owners. All holders are
counted and returned. The label goes by them but for copies of a document,
which make no example: identical texts count for one repository, and for an
owner who holds all texts with the value. A value that several owners or over
MAX_REPOS repositories hold even so is a copied example; any other that looks
random is live. Labels don't depend on how documents are numbered. All
candidates are reported, each with its label.

Defined results: null text counts as empty, null owner or repository as a
value of its own; no match gives zero counts, an empty span list and the hash
of the empty string; repeated rows are reported each; an empty table gives no
rows; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import materialize

OPEN, CLOSE, OTHER = "\u0001", "\u0002", "\u0003"
# Kinds in the order that breaks ties of the start: pattern, whether a fixed contract asks for it.
ASSIGN = r"""(?i)(?=[pstaPSTA])(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    ("assign", ASSIGN),
    ("access", r"AKIA[A-Z0-9]{12,}"),  # maximal runs: the same as 16 characters or more of AKIA[A-Z0-9]+
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}"),
    ("vendor", r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|AIza[A-Za-z0-9_-]{35}|[sr]k_live_[A-Za-z0-9]{20,}|glpat-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
]
BASE = 3  # the first kinds
MIN_VALUE = 8
MIN_DISTINCT = 8  # characters of a value that looks random
MAX_OWNERS = 1  # owners of a live value
MAX_REPOS = 5  # repositories of a live value, which its one owner may use in a few


def spans_of(text: Column, rank: int, pattern: str) -> Column:
    """array<struct<start, rank, end, value>> of one kind, by start."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{OPEN}$0{CLOSE}"), OPEN)
    none = F.expr("cast(array() as array<struct<start: bigint, rank: int, end: bigint, value: string>>)")
    body = F.aggregate(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        F.struct(F.length(F.element_at(pieces, 1)).cast("long").alias("at"), none.alias("out")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p) - 1).cast("long").alias("at"),
            F.concat(s["out"], F.array(F.struct(
                s["at"].alias("start"), F.lit(rank).alias("rank"),
                (s["at"] + F.length(F.substring_index(p, CLOSE, 1))).cast("long").alias("end"),
                F.substring_index(p, CLOSE, 1).alias("value")))).alias("out")),
        lambda s: s["out"])
    return F.when(F.size(pieces) > 1, body).otherwise(none)


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """(row, doc_id, repo, owner, th, found): th is the text's hash, found holds the spans of all kinds."""
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = F.translate(whole, OPEN + CLOSE, OTHER + OTHER)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"), F.xxhash64(whole).alias("th"), text.alias("t"))
    by_kind = []
    for k, (name, pattern) in enumerate(KINDS):
        found = spans_of(F.col("t"), k, pattern)
        if name == "assign":
            found = F.filter(F.transform(found, lambda s: s.withField("value", F.regexp_extract(s["value"], ASSIGN, 2))), lambda s: F.length(s["value"]) >= MIN_VALUE)
        by_kind.append(found)
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "repo", "owner", "th", F.array_sort(F.concat(*by_kind)).alias("found"))


def ownership(hits: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners, all_repos, all_owners) from (hash, repo,
    owner, th). all_repos and all_owners count every holder. Copies of a text
    aside, n_owners is 1 if one owner holds every text that has the value, and
    n_repos is at most the number of those texts."""
    held = hits.select("hash", "repo", "owner", "th").distinct()
    owners = held.groupBy("hash", "owner").agg(F.countDistinct("th").alias("texts")).groupBy("hash").agg(F.count("*").alias("all_owners"), F.max("texts").alias("most"))
    repos = held.groupBy("hash").agg(F.countDistinct("th").alias("texts"), F.countDistinct(F.struct("repo")).alias("all_repos"))  # a struct, as null is a value here
    return repos.join(owners, "hash").select("hash", F.least("texts", "all_repos").alias("n_repos"), F.when(F.col("most") == F.col("texts"), F.lit(1).cast("long")).otherwise(F.col("all_owners")).alias("n_owners"), "all_repos", "all_owners")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """(row, doc_id, spans): spans are (kind rank, start, end, n_repos,
    n_owners, all_repos, all_owners, live), one row for each row of docs."""
    base = materialize(candidates(docs, id_col, text_col, repo_col, owner_col), "spans")
    hits = base.where(F.size("found") > 0).select("row", "repo", "owner", "th", F.explode("found").alias("s")).select(
        "row", "repo", "owner", "th", F.col("s.rank").alias("rank"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.sha2("s.value", 256).alias("hash"),
        (F.size(F.array_distinct(F.split("s.value", ""))) >= MIN_DISTINCT).alias("random"))
    judged = hits.join(ownership(hits), "hash").select("row", F.struct("start", "rank", "end", "n_repos", "n_owners", "all_repos", "all_owners", ((F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repos") <= MAX_REPOS) & F.col("random")).alias("live")).alias("s"))
    kept = judged.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    return base.select("row", "doc_id").join(kept, "row", "left")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: one row for each document. A document stands for a repository and
    its source for the owner. labels, the counts that they go by and those of all
    holders follow the spans."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array(*[F.lit(k) for k, _ in KINDS])
    spans = F.coalesce("spans", F.expr("cast(array() as array<struct<start: bigint, rank: int, end: bigint, n_repos: bigint, n_owners: bigint, all_repos: bigint, all_owners: bigint, live: boolean>>)"))
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")
    count = lambda test: F.size(F.filter(F.col("s"), test)).cast("long")
    each = lambda f: F.array_join(F.transform("s", f), ",")
    is_kind = lambda k: lambda s: s["rank"] == k
    return found.select("doc_id", spans.alias("s")).select(
        "doc_id", *[count(is_kind(k)).alias(f"n_{KINDS[k][0]}") for k in range(BASE)],
        F.sha2(text(F.filter("s", lambda s: s["rank"] < BASE)), 256).alias("base_sha256"), text(F.col("s")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_copied"),
        each(lambda s: F.when(s["live"], "live").otherwise("copied")).alias("labels"), each(lambda s: s["n_repos"]).alias("n_repos"), each(lambda s: s["n_owners"]).alias("n_owners"),
        each(lambda s: s["all_repos"]).alias("all_repos"), each(lambda s: s["all_owners"]).alias("all_owners"))
