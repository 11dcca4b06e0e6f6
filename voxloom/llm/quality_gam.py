"""Document quality by a generalised additive model with pairwise interactions.

Every text becomes a fixed list of surface features (byte-class rates, line
and word shapes, repetition). Features are cut into quantile bins; cyclic
boosting visits the features in turn and fits a shallow tree on the bins of
one feature to the current gradient, so that each feature ends with a lookup
table over its bins. Then the strongest pairs (largest gain of a two-by-two
split on the residual) get small two-dimensional tables the same way. A
score is a sum of table look-ups, done with numpy for a whole batch.

The model is fitted on a bounded sample of the labelled rows that are not
held out (SAMPLE rows with the smallest hash of the id); scoring covers every
row and whole texts.

Defined results: null text counts as empty and gets the score of an empty
text; null labels are not learnt from; several labels of an id all count as
rows; with no labelled rows, or with one class only, every score is the
smoothed base rate; repeated rows are scored each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import fold_of

SAMPLE = 20_000
BINS = 32
ROUNDS = 60
RATE = 0.15
PAIRS = 6

FEATURES = ["log_bytes", "log_words", "mean_word", "upper", "digit", "space", "punct", "symbol", "pipe", "bang", "dot", "comma", "wide",
            "log_lines", "mean_line", "short_lines", "distinct_lines", "distinct_words", "top_word", "repeat_pairs", "caps_words", "edge_symbols"]

_CLASSES = np.zeros((256, 10), np.float64)
for _k, _set in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n\v\f", b".,;:!?'\"()-", b"*&%$#@^~=+<>{}[]\\/_`", b"|", b"!", b".", b","]):
    _CLASSES[list(_set), _k] = 1
_CLASSES[128:, 9] = 1
_SYMBOLS = b"*&%$#|!@^~"


def features(text: bytes | None) -> list[float]:
    text = text or b""
    n = len(text)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    nw, nl = len(words), len(lines)
    rates = (np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES / n).tolist() if n else [0.0] * 10
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    distinct = len(counts)
    pairs = len(set(zip(words, words[1:])))
    upper, digit, space, punct, symbol, pipe, bang, dot, comma, wide = rates
    return [np.log1p(n), np.log1p(nw), n / (nw + 1), upper, digit, space, punct, symbol, pipe, bang, dot, comma, wide,
            np.log1p(nl), np.log1p(n / (nl + 1)), sum(len(x) < 40 for x in lines) / (nl + 1), len(set(lines)) / (nl + 1),
            distinct / (nw + 1), max(counts.values(), default=0) / (nw + 1), 1 - pairs / max(nw - 1, 1) if nw > 1 else 0.0,
            sum(c for w, c in counts.items() if w.isupper()) / (nw + 1), sum(c for w, c in counts.items() if w[-1] in _SYMBOLS) / (nw + 1)]


@dataclass
class Gam:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: np.ndarray | None = None
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if self.tables is None:
            return out
        b = self.bins(x)
        for k in range(b.shape[1]):
            out += self.tables[k, b[:, k]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[b[:, i], b[:, j]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _tree_update(g: np.ndarray, h: np.ndarray, leaves: int = 4, penalty: float = 2.0) -> np.ndarray:
    """Best greedy split of ordered bins into a few leaves; Newton value of each."""
    cuts = [0, len(g)]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    score = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + penalty)
    for _ in range(leaves - 1):
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            m = np.arange(a + 1, b)
            if len(m):
                gain = score(a, m) + score(m, b) - score(a, b)
                if gain.max() > best:
                    best, at = gain.max(), int(m[gain.argmax()])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + penalty)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = BINS, rounds: int = ROUNDS, rate: float = RATE, n_pairs: int = PAIRS) -> Gam:
    """Cyclic boosting of one-feature tables, then of the strongest pairs."""
    p = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(p / (1 - p))))
    if len(y) < 20 or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    width = max(len(e) for e in model.edges) + 1
    b = model.bins(x)
    model.tables = np.zeros((x.shape[1], width))
    logit = np.full(len(y), model.base)
    for _ in range(rounds):
        for k in range(x.shape[1]):
            q = 1 / (1 + np.exp(-logit))
            step = rate * _tree_update(np.bincount(b[:, k], y - q, width), np.bincount(b[:, k], q * (1 - q), width))
            model.tables[k] += step
            logit += step[b[:, k]]
    q = 1 / (1 + np.exp(-logit))
    g, h = y - q, q * (1 - q)
    half = np.minimum(b * 4 // np.maximum([len(e) + 1 for e in model.edges], 1), 3)
    gains = []
    for i in range(x.shape[1]):
        for j in range(i):
            cell = half[:, i] * 4 + half[:, j]
            gg, hh = np.bincount(cell, g, 16), np.bincount(cell, h, 16)
            gains.append(((gg**2 / (hh + 5)).sum(), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:n_pairs]]
    model.pair_tables = [np.zeros((width, width)) for _ in model.pairs]
    for _ in range(rounds // 2):
        for t, (i, j) in zip(model.pair_tables, model.pairs):
            q = 1 / (1 + np.exp(-logit))
            cell = half[:, i] * 4 + half[:, j]
            step = rate * np.bincount(cell, y - q, 16) / (np.bincount(cell, q * (1 - q), 16) + 5)
            ci = np.minimum(np.arange(width) * 4 // (len(model.edges[i]) + 1), 3)
            cj = np.minimum(np.arange(width) * 4 // (len(model.edges[j]) + 1), 3)
            t += step[ci[:, None] * 4 + cj[None, :]]
            logit += step[cell]
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, limit: int) -> tuple[list[bytes], np.ndarray]:
    """Texts and labels of at most limit rows outside the held-out fold, those
    with the smallest hash of the id."""
    rows = (labels.select("doc_id", F.col(label).alias("y")).where("y IS NOT NULL AND doc_id IS NOT NULL").where(fold_of(F.col("doc_id"), modulus) != held)
            .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(limit))
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("t")).join(F.broadcast(rows), "doc_id")
    return found


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, limit: int = SAMPLE) -> Gam:
    """Fit on the features of the bounded sample; texts stay on the executors."""
    found = labelled_sample(docs, labels, "quality", modulus, held, limit)

    def run(batches):
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()], dtype=np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    got = found.select("doc_id", "t", F.col("y").cast("double").alias("y")).mapInArrow(run, "doc_id long, y double, x array<double>").toPandas()
    if not len(got):
        return Gam(0.0)
    got["key"] = got["x"].map(tuple)
    got = got.sort_values(["doc_id", "y", "key"])
    return fit(np.array(got["x"].tolist()), got["y"].to_numpy())


def score(docs: DataFrame, model: Gam, modulus: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()], dtype=np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.scores(x))], ["doc_id", "score"])

    out = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("t")).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (fold_of(F.col("doc_id"), modulus) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: quality of every document."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels))
