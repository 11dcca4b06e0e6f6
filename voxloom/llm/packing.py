"""Packing by lexical retrieval.

Documents are tokenized and dealt to shards of SHARD_TOKENS tokens on average,
by their topic: the least hash of their long words, which two documents have in
common the likelier the more words they share, so copies and near copies meet.
A topic of many tokens is dealt over several shards by row. A shard has a BM25
inverted index of its own over token ids. A
window starts with a seed (what is left of the document cut last, or the
first unused one); the index gives the seed's unused neighbours in order of
score, which fill the window greedily. The document that doesn't fit is cut,
and its rest seeds the next window, so only a shard's last window is padded.

Defined results: null text counts as empty and has its end token alone; a
repeated row is packed once for each time it occurs; a null id is kept; an
empty table gives no rows; a text of any length is cut over as many windows
as it needs; other columns are ignored; ties of score go to the smaller id.
"""

from __future__ import annotations

import math
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import materialize

WINDOW = 4096
END_ID = 2
SHARD_TOKENS = 1 << 19  # of a shard on average
TOPIC = 3  # tokens of a word that makes a topic
BROADCAST_TOPICS = 1_000_000  # 16 MB; beyond it the join shuffles
VOCABULARY = "word_bpe_49k.json"
BATCH, PART = 8 << 10, 1 << 10  # texts whose words are looked up together, and whose ids are gathered together
CACHE = 400_000  # words of each half of a worker's cache
K1, B = 1.2, 0.75
_PRE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class Words:
    """Token ids of texts by way of their words. Tokens don't reach across
    white space, so each different word is tokenized once and kept."""

    def __init__(self, name: str = VOCABULARY, limit: int = CACHE):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what was kept before the limit was last met
        self.limit = limit
        self.marks = {m: self._one(m).tobytes() for m in (".", ",")}

    def _one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u2")

    def _learn(self, words: list[str]) -> None:
        """Tokenize words in one text, and tell them apart by the tokens that
        close a word."""
        ids = self._one(" ".join(words))
        # letters alone are one piece; an empty word is none
        n = [1 if w.isalpha() and max(w) < "\u0250" and "\u0130" not in w else len(_PRE.findall(unicodedata.normalize("NFC", w).lower())) for w in words]
        ends = np.flatnonzero(self.closes[ids]) + 1 if len(ids) else np.zeros(0, int)
        if len(ends) != sum(n) or (len(ends) and ends[-1] != len(ids)):
            self.kept.update((w, self._one(w).tobytes()) for w in words)
            return
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n)])].tolist()
        raw = ids.tobytes()
        self.kept.update((w, raw[2 * a:2 * b]) for w, a, b in zip(words, cut, cut[1:]))

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Little-endian uint16 ids of each of some different words. A mark
        that ends a word is a piece of its own, so that the word before it is
        tokenized once for all marks."""
        if len(self.kept) > self.limit:
            self.older, self.kept = self.kept, {}
        kept, older, new, marked = self.kept, self.older, {}, []
        found = [*map(kept.get, words)]
        for w in [w for w, x in zip(words, found) if x is None]:
            if (ids := older.get(w)) is not None:
                kept[w] = ids
                continue
            if w[-1:] in (".", ",") and w[-2:-1].isalpha():
                marked.append(w)
                w = w[:-1]
                if w in kept:
                    continue
            new[w] = None
        new = [*new]
        for i in range(0, len(new), 2000):
            self._learn(new[i:i + 2000])
        kept.update((w, kept[w[:-1]] + self.marks[w[-1]]) for w in marked)
        return [kept[w] if x is None else x for w, x in zip(words, found)]

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends, topics) of all texts at once, as by encode_parts()."""
        return next(self.encode_parts(texts, max(len(texts), 1)))

    def encode_parts(self, texts: list[str | None] | pa.Array, rows: int = PART):
        """(ids, ends, topics) for every so many rows of texts: the ids of all,
        without end tokens, where each text's end, and each text's topic.

        The different words of all texts are told apart first, so that what is
        done for every word is a gather. The topic is the least hash among the
        text's words of TOPIC tokens or more, or else among all."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        texts = pc.ascii_lower(texts)
        if any(pc.any(pc.match_substring(texts, c)).as_py() for c in "\n\t\r"):
            for c in "\n\t\r":
                texts = pc.replace_substring(texts, c, " ")
        split = pc.split_pattern(texts, " ")
        del texts
        words = pc.dictionary_encode(split.flatten())
        bounds = split.offsets.to_numpy().copy()
        del split
        ids = self.ids_of(words.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        start = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
        flat = np.frombuffer(b"".join(ids), "<u2")
        del ids
        hashes = np.zeros(len(size), np.uint64)
        for k in range(int(size.max(initial=0))) if len(flat) else ():
            here = size > k
            if not here.any() or k == 16:  # words that agree so far share their topic
                break
            hashes[here] = (hashes[here] + flat[start[here] + k] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(29)
        hashes = ((hashes >> np.uint64(2)) | np.where(size < TOPIC, np.uint64(1 << 62), np.uint64(0))).astype(np.int64)
        indices = words.indices.to_numpy()
        for i in range(0, len(bounds) - 1, rows):
            cut = bounds[i:i + rows + 1]
            at = indices[cut[0]:cut[-1]]
            n = size[at]
            stop = np.cumsum(n)
            out = flat[np.repeat(start[at] - (stop - n), n) + np.arange(int(n.sum()))]
            ends = np.concatenate([[0], stop])[cut[1:] - cut[0]]
            yield out, ends, np.minimum.reduceat(hashes[at], cut[:-1] - cut[0]) if len(at) else np.zeros(len(cut) - 1, np.int64)


_of_worker: dict[str, Words] = {}


def words_of(name: str = VOCABULARY) -> Words:
    """This Python worker's tokenizer and cache, which its tasks share."""
    if name not in _of_worker:
        _of_worker[name] = Words(name)
    return _of_worker[name]


def forget() -> None:
    """Drop this worker's caches, so that it has room for the stages it goes on to."""
    _of_worker.clear()


class Bm25:
    """Inverted index of one shard."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        size = np.array([len(d) for d in docs], float)
        key = np.concatenate([d.astype(np.int64) * n + i for i, d in enumerate(docs)])
        pairs, tf = np.unique(key, return_counts=True)
        term, self.doc = pairs // n, (pairs % n).astype(np.int32)
        df = np.bincount(term, minlength=1 << 16)
        self.begin = np.concatenate([[0], np.cumsum(df)])
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        self.impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.doc] / size.mean()))
        self.n = n

    def scores(self, terms: np.ndarray) -> np.ndarray:
        a, b = self.begin[terms], self.begin[terms.astype(np.int64) + 1]
        length = b - a
        at = np.repeat(a - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        return np.bincount(self.doc[at], weights=self.impact[at], minlength=self.n)


def pack(docs: list[np.ndarray], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard."""
    index, unused, first = Bm25(docs), np.ones(len(docs), bool), 0
    pieces, sequence, offset = [], 0, 0
    seed, at = -1, 0  # the seed and how much of it has been placed

    def place(doc, start):
        """Put as much of a document as fits; the new start."""
        nonlocal sequence, offset
        n = min(window - offset, len(docs[doc]) - start)
        pieces.append((doc, start, n, sequence, offset))
        offset += n
        if offset == window:
            sequence, offset = sequence + 1, 0
        return start + n

    while True:
        if seed < 0:
            while first < len(docs) and not unused[first]:
                first += 1
            if first == len(docs):
                return pieces
            seed, at = first, 0
            unused[seed] = False
        while at < len(docs[seed]) and (offset == 0 and len(docs[seed]) - at >= window):
            at = place(seed, at)  # whole windows of its own
        if at == len(docs[seed]):
            seed = -1
            continue
        at = place(seed, at)
        if offset == 0:
            continue
        scores = np.where(unused, index.scores(np.unique(docs[seed])), -1.0)
        seed = -1
        for doc in np.argsort(-scores, kind="stable"):
            if not unused[doc]:
                break
            unused[doc] = False
            at = place(doc, 0)
            if offset == 0:
                if at < len(docs[doc]):
                    seed = int(doc)
                break
        else:
            return pieces


def tokenized(docs: DataFrame) -> DataFrame:
    """(row, doc_id, topic, n, ids): ids are little-endian uint16, the end
    token among them, n is their number."""

    def tokens(batches):
        words = words_of()
        for batch in batches:
            for at, (flat, ends, topics) in zip(range(0, batch.num_rows, PART), (x for i in range(0, batch.num_rows, BATCH) for x in words.encode_parts(batch.column(2).slice(i, BATCH)))):
                part = batch.slice(at, PART)
                whole = np.insert(flat, ends, END_ID)  # an end token after each text
                stops = ends + np.arange(1, len(ends) + 1)
                raw = whole.astype("<u2").tobytes()
                cut = np.concatenate([[0], stops]).tolist()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(topics), pa.array(np.diff(cut)), pa.array([raw[2 * a:2 * b] for a, b in zip(cut, cut[1:])], pa.binary())],
                                                 ["row", "doc_id", "topic", "n", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("t"))
    return materialize(rows.mapInArrow(tokens, "row long, doc_id long, topic long, n long, ids binary"), "tokens")


def sharded(rows: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """rows with shard: those of a topic meet in one shard, or if they are many
    in as many as hold them, dealt by row, so equal rows are dealt out too."""
    shards = max(1, math.ceil((rows.agg(F.sum("n")).first()[0] or 0) / shard_tokens))
    part = max(shard_tokens // 4, 1)
    large = materialize(rows.groupBy("topic").agg(F.sum("n").alias("tokens")).where(F.col("tokens") > part).select("topic", F.ceil(F.col("tokens") / part).alias("salts")), "topics")
    if large.count() <= BROADCAST_TOPICS:
        large = F.broadcast(large)
    salt = F.pmod(F.xxhash64("row"), F.coalesce("salts", F.lit(1)))
    return rows.join(large, "topic", "left").select("row", "doc_id", "n", "ids", F.pmod(F.xxhash64("topic", salt), F.lit(shards)).alias("shard"))


def sequences(docs: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        forget()  # all texts are tokenized by now
        pdf = pdf.sort_values(["doc_id", "n", "row"], na_position="last")
        ids = [np.frombuffer(x, "<u2") for x in pdf["ids"]]
        base = int(pdf["shard"].iloc[0]) << 32
        name = pdf["doc_id"].to_numpy()
        got = pack(ids, window)
        crc = [zlib.crc32(ids[d][s:s + n].astype("<u4").tobytes()) for d, s, n, _, _ in got]
        d, s, n, q, o = map(np.array, zip(*got))
        return pd.DataFrame({"doc_id": pd.array(name[d], dtype="Int64"), "start": s, "length": n, "ids_crc32": np.array(crc, np.int64),
                             "doc_tokens": np.array([len(x) for x in ids])[d], "sequence_id": base + q, "offset": o})

    return sharded(tokenized(docs), shard_tokens).groupBy("shard").applyInPandas(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: a row for each piece."""
    return sequences(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: what is left, packed."""
    return sequences(docs.select("doc_id", "text"))
