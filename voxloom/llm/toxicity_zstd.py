"""Toxicity by compression distance.

Two zstandard dictionaries of equal size are trained, one on toxic and one on
ordinary text. A window is a word with the spaces around it (of a word over
WINDOW bytes, its parts); it is compressed with either dictionary, and the
difference of the two lengths is what toxic text explains of it. A window is
marked if that difference reaches the threshold for its length, which is set so
that a given share of the ordinary windows of that length reaches it (RATES are
the shares tried). Share and score are calibrated on the training fold with
both classes weighted alike, so that a score of 0.5 is the balanced decision:
the score of a text follows from the number of its marked windows.

A dictionary is made of the words typical of its class. The toxic one has
the words whose number of distinct left neighbours is significantly, and
several times, larger in toxic than in ordinary text (repeated copies of one
text share their neighbours and so count once). The ordinary one has as many
bytes of the words with most neighbours in ordinary text. Words that meet
often stand last, where zstandard's offsets are shortest.

Training takes a bounded sample of labelled rows, whole texts of the TOXIC and
ORDINARY rows with the smallest hash of the id; neighbours are counted and
windows compressed on the executors, and the driver gets at most the words of
two dictionaries and a table of counts. Scoring takes every row and whole texts.

Defined results: null text counts as empty; a text without marked windows,
such as an empty one, has the lowest score; null labels are not learnt from;
without rows of both classes every score is the smoothed base rate; where no
word is significantly toxic (few labels), words of lesser significance are
taken, and without any every score is the same; repeated rows are scored each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import fold_of, materialize, scratch

TOXIC, ORDINARY = 3_000, 6_000  # sampled rows of each class
WINDOW = 64  # bytes
DICTIONARY = 8192  # bytes of a dictionary at most
MIN_Z, MIN_COUNT, MIN_RATIO = 5.0, 4, 4.0
RATES = (3e-3, 1e-3, 3e-4, 1e-4, 3e-5, 1e-5)  # candidate shares of marked ordinary windows
MOST = 8  # marked windows that the score tells apart
CACHE = 150_000  # windows that a worker remembers


def windows(text: bytes | None) -> list[bytes]:
    """The words of a text, lower-cased; long ones in parts."""
    words = (text or b"").lower().split()
    if not words or len(max(words, key=len)) <= WINDOW:
        return words
    return [w[i:i + WINDOW] for w in words for i in range(0, len(w), WINDOW)]


def _params():
    return zstandard.ZstdCompressionParameters(window_log=15, hash_log=14, chain_log=14, search_log=4, min_match=4, target_length=0,
                                               strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)


class Pair:
    """The two compressors of a worker, and the savings of windows met."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.makers, self.known = [], {}
        for content in (ordinary, toxic):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=_params())
            self.makers.append(zstandard.ZstdCompressor(dict_data=d, compression_params=_params()))

    def savings(self, ws: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
        a, b = (m.compress for m in self.makers)
        for w in {*ws}.difference(known):
            padded = b" " + w + b" "
            known[w] = len(a(padded)) - len(b(padded))
        return np.fromiter(map(known.__getitem__, ws), np.int16, len(ws))

    def marked(self, text: bytes | None, least: np.ndarray) -> np.ndarray:
        """Numbers of marked windows by the rows of least, thresholds by length."""
        ws = windows(text)
        return (self.savings(ws) >= least[:, np.fromiter(map(len, ws), np.int64, len(ws))]).sum(1)


@dataclass
class Model:
    ordinary: bytes = b" "
    toxic: bytes = b" "
    least: np.ndarray = field(default_factory=lambda: np.ones((1, WINDOW + 1), int))  # saving of a marked window by its length
    table: np.ndarray = field(default_factory=lambda: np.full(MOST + 1, 0.5))  # score by the number of marked windows

    def pair(self) -> Pair:
        return Pair(self.ordinary, self.toxic)

    def scores(self, pair: Pair, texts: list[bytes | None]) -> np.ndarray:
        n = [pair.marked(t, self.least)[0] for t in texts]
        return self.table[np.minimum(np.array(n, np.int64), MOST)]


def neighbours(sample: DataFrame) -> DataFrame:
    """(word, a, b): distinct left neighbours in toxic and in ordinary rows of
    sample(doc_id, t, y)."""

    def pairs(batches):
        for batch in batches:
            for t, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ws = windows(t)
                found = list({*zip(ws, ws[1:])})
                for i in range(0, len(found), 1 << 16):
                    left, word = zip(*found[i:i + (1 << 16)])
                    yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(word, pa.binary()), pa.array([y] * len(left), pa.float64())], ["left", "word", "y"])

    met = sample.select("doc_id", "t", "y").mapInArrow(pairs, "left binary, word binary, y double")
    met = met.groupBy("word", "left", "y").agg(F.lit(1).alias("one"))
    return met.groupBy("word").agg(F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b"))


def dictionaries(counts: DataFrame) -> tuple[bytes, bytes]:
    """(ordinary, toxic) contents of equal size from neighbours()."""
    total = counts.agg(F.sum("a"), F.sum("b")).first()
    na, nb = (max(int(x or 0), 1) for x in total)
    p = (F.col("a") + F.col("b")) / float(na + nb)
    z = (F.col("a") / na - F.col("b") / nb) / F.sqrt(p * (1 - p) * (1 / na + 1 / nb))
    rated = counts.where("a > 1").withColumn("z", z).where((F.col("a") / na > MIN_RATIO * (F.col("b") + 1) / nb) & F.col("z").isNotNull())
    join = lambda rows: (b" " + b" ".join(bytes(r["word"]) for r in reversed(rows)) + b" ")[-DICTIONARY:]
    for least, count in ((MIN_Z, MIN_COUNT), (2.0, 2)):
        rows = rated.where((F.col("z") > least) & (F.col("a") >= count)).orderBy(F.desc("z"), "word").limit(DICTIONARY // 2).collect()
        if rows:
            break
    toxic = join(rows)
    usual = counts.where((F.col("b") > 0) & (F.octet_length("word") >= 4)).orderBy(F.desc("b"), "word").limit(DICTIONARY // 4).collect()
    taken = {bytes(r["word"]) for r in rows}
    return join([r for r in usual if bytes(r["word"]) not in taken])[-len(toxic):], toxic


def thresholds(seen: dict[tuple[int, int], int]) -> np.ndarray:
    """[RATES, lengths]: the least saving, one byte or more, that no larger
    share of ordinary windows of the length reaches; seen counts those windows
    by (length, saving)."""
    total, by = Counter(), {}
    for (size, saved), n in seen.items():
        total[size] += n
        by.setdefault(size, []).append((saved, n))
    out = np.ones((len(RATES), WINDOW + 1), int)
    for size, found in by.items():
        found.sort(reverse=True)
        for i, rate in enumerate(RATES):
            over = 0
            for saved, n in found:
                over += n
                if saved < 1 or over > rate * total[size]:
                    out[i, size] = max(saved + 1, 1)
                    break
    return out


def calibrate(tally: dict[tuple[int, int, int], int]) -> tuple[int, np.ndarray]:
    """(rate's index, table) from rows counted by (rate's index, class, marked
    windows): the rate that tells the classes apart best, and for it the share
    of toxic rows with that many marked windows, classes weighted alike, never
    falling."""
    best = None
    for step in range(len(RATES)):
        n = np.array([[tally.get((step, y, k), 0) for k in range(MOST + 1)] for y in (0, 1)], float)
        share = n / np.maximum(n.sum(1, keepdims=True), 1)
        gain = float((share[1].cumsum() - share[0].cumsum()).min())  # the most negative: rows above a cut
        if best is None or gain < best[0] - 1e-12:
            best = (gain, step, n, share)
    _, step, n, share = best
    least = 0.5 / np.maximum(n.sum(1), 1)
    out: list[list[float]] = []
    for k in range(MOST + 1):  # pool neighbours that fall
        out.append([share[1, k] + least[1], share[0, k] + least[0], 1])
        while len(out) > 1 and out[-2][0] * out[-1][1] >= out[-1][0] * out[-2][1]:
            t, o, m = out.pop()
            out[-1] = [out[-1][0] + t, out[-1][1] + o, out[-1][2] + m]
    return step, np.array([t / (t + o) for t, o, m in out for _ in range(int(m))])


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> Model:
    with scratch(docs.sparkSession):
        return _train(docs, labels, modulus, held)


def _train(docs: DataFrame, labels: DataFrame, modulus: int, held: int) -> Model:
    known = (labels.select("doc_id", F.col("toxic").cast("double").alias("y")).where("y IN (0, 1) AND doc_id IS NOT NULL")
             .where(fold_of(F.col("doc_id"), modulus) != held))
    pick = lambda y, n: known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = pick(1, TOXIC).unionByName(pick(0, ORDINARY))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    sample = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t")).join(F.broadcast(chosen), "doc_id").select("doc_id", "t", "y"), "sample")
    size = {int(r["y"]): r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        p = (size.get(1, 0) + 1) / (sum(size.values()) + 2)
        return Model(table=np.full(MOST + 1, p))
    ordinary, toxic = dictionaries(materialize(neighbours(sample), "neighbours"))
    model = Model(ordinary, toxic)

    def measured(batches):
        pair, seen = model.pair(), Counter()
        for batch in batches:
            for t in batch.column(1).to_pylist():
                ws = windows(t)
                seen.update(zip(map(len, ws), pair.savings(ws).tolist()))
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in seen], pa.int32()) for i in (0, 1)] + [pa.array(list(seen.values()), pa.int64())], ["size", "saved", "n"])

    seen = sample.where("y = 0").mapInArrow(measured, "size int, saved int, n long").groupBy("size", "saved").agg(F.sum("n").alias("n")).collect()  # at most WINDOW ** 2 rows
    least = thresholds({(r["size"], r["saved"]): r["n"] for r in seen})

    def counted(batches):
        pair, rows = model.pair(), Counter()
        for batch in batches:
            for t, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows.update((i, int(y), min(int(k), MOST)) for i, k in enumerate(pair.marked(t, least)))
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in rows], pa.int32()) for i in range(3)] + [pa.array(list(rows.values()), pa.int64())], ["step", "y", "k", "n"])

    tally = sample.mapInArrow(counted, "step int, y int, k int, n long").groupBy("step", "y", "k").agg(F.sum("n").alias("n")).collect()  # at most 2 * (MOST + 1) rows a rate
    step, model.table = calibrate({(r["step"], r["y"], r["k"]): r["n"] for r in tally})
    model.least = least[step:step + 1]
    return model


def score(docs: DataFrame, model: Model, modulus: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of docs."""

    def run(batches):
        pair = model.pair()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(pair, batch.column(1).to_pylist()))], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("t")).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (fold_of(F.col("doc_id"), modulus) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: toxicity of every document."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows that the operator predicts toxic go; text may be
    null, ids may repeat, other columns pass through."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    at = docs.columns.index("text")

    def keep(batches):
        pair = model.pair()
        for batch in batches:
            texts = [None if t is None else t.encode() for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(model.scores(pair, texts) < 0.5))

    return docs.mapInArrow(keep, docs.schema)
