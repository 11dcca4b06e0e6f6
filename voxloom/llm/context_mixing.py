"""Language-model scores by logistic context mixing.

A text is a sequence of tokens (words between ASCII white space, then one end
token), and a token is a sequence of bits. The FREQUENT most frequent words
have a Huffman code whose bits are predicted over the running text; a leaf of
the code stands for all other words. Such a word's own probability is max(c -
d, 0) / R + d * W / R * spelled(word), absolute discounting over the W rare
words with their R training tokens, whose backoff spells the word byte by byte
and bit by bit. All bits, of codes and of spellings, are predicted alike:

- several hashed contexts each predict the bit from how often it was 0 or 1
  there in training: for a code's bit at its place in the code, none, the last
  word, the last two, and the last of the COMMON most frequent words; for a
  spelling's bit the word's last 1, 2, 3 and 5 bytes with the bits of the byte
  so far. The counts make one of few states, each with its prediction;
- a gated set of weights, chosen by how often the contexts GATED of them have
  been seen, mixes the predictions in the logistic domain. The weights are
  those that code all training bits best, each predicted without its own count
  (but for the none of codes). As the states are few, the bits of each cell, a
  combination of states, are counted, and the weights are fitted to the counts;
- an adaptive probability map, keyed by the cell, refines the mix.

The probabilities of all texts add up to one at most.

Counts cover all training rows and are whole numbers, so scores do not depend
on the partitions but for rounding. Word counts are aggregated by Spark. The
hashed tables and the cells have fixed sizes, and so has what is broadcast; a
task sends its part of a table as compressed blocks, which are added up block
by block. A rare word is spelled once, however often it occurs, and reaches
its texts by a join.

Defined results: null text counts as empty (one end token); a null id counts
as the empty text in the fold; repeated rows count and are scored each; with
no training rows N = V = 0, base_score is 0 and the score is the spelling's;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import discard, fold_of, materialize, release

CONTEXTS = 4
BYTES_BACK = (1, 2, 3, 5)  # of the contexts of a spelling
TABLE_BITS = 21
BLOCK = 1 << 17  # counts added up in one group
FREQUENT = 65_536
LEAST = 3  # training tokens of a word that has a code
GATED = (1, 2)  # for codes: the last word, the last two; for spellings: 2 and 3 bytes
GATES = 16
COMMON = 64  # the most frequent words, of which the last one tells kinds of text apart
PRIOR = 20  # bits that the mix counts for beside those seen in a cell
END = b"\n"  # the end token; no word holds white space
PART = 4_000_000  # bytes of texts encoded at once
CHUNK = 500  # a tenth of the words spelled, or of the tokens mixed, at once
RARE = np.uint32(1 << 31)  # marks the ids of words without a code

LEVELS = np.concatenate([np.arange(32), 32 * 2.0 ** (np.arange(1, 225) / 14)])  # a count in one byte, exact below 32
OFFSET = np.arange(CONTEXTS)[:, None] << TABLE_BITS


def _steps(*edges: float) -> np.ndarray:
    """The edges between steps of the logistic domain, alike on both sides."""
    return np.array([*(-e for e in reversed(edges)), 0, *edges])


def _states():
    """The state of every slot code in a gated context and in another: 65,536
    without the own count of a 0, as many without that of a 1, then all with
    every count. A state is a step of the stretched probability, in a gated
    context one of its steps for how often it was seen: never, below 4 (where
    the counts are exact), below 32, more often. Then each state's stretch, and how
    often a gated one was seen."""
    n0, n1 = np.meshgrid(LEVELS, LEVELS, indexing="ij")
    less = lambda n, own: np.where(n < 32, np.maximum(n - own, 0), n).ravel()
    a = np.concatenate([less(n0, own) for own in (1, 0, 0)])
    b = np.concatenate([less(n1, own) for own in (0, 1, 0)])
    t = a + b
    stretch = np.clip(np.log((b + 0.05) / (a + 0.05)) * (t / (t + 0.5)), -8, 8)
    some, many = _steps(0.35, 0.8, 1.5, 2.5), _steps(0.15, 0.4, 0.8, 1.4, 2.5)
    plain = np.searchsorted(_steps(0.08, 0.16, 0.25, 0.35, 0.5, 0.7, 1, 1.4, 2, 3, 4.5), stretch, "right")
    exact = np.where(t < 4, t * (t + 1) // 2 + b, 0).astype(int)  # 0 to 9
    gated = np.where(t < 4, exact, np.where(t < 32, 10 + np.searchsorted(some, stretch, "right"), 20 + np.searchsorted(many, stretch, "right")))
    seen = (t >= 1).astype(int) + (t >= 4) + (t >= 32)
    mean = lambda state, x: np.bincount(state, x) / np.bincount(state)
    return plain.astype(np.uint8), gated.astype(np.uint8), mean(plain, stretch), mean(gated, stretch), mean(gated, seen).astype(int)


PLAIN, GATED_STATE, PLAIN_STRETCH, GATED_STRETCH, SEEN = _states()
STATE = [GATED_STATE if k in GATED else PLAIN for k in range(CONTEXTS)]
STRETCH = [GATED_STRETCH if k in GATED else PLAIN_STRETCH for k in range(CONTEXTS)]
SHAPE = tuple(map(len, STRETCH))
CELLS = int(np.prod(SHAPE))  # one for every combination of the contexts' states


def _mix32(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
    return x ^ (x >> np.uint32(15))


def places(groups: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Hashed places of bits: the hash of a group of places, then 4 bits for
    the place within it, then a bit left free."""
    return (_mix32(groups.astype(np.uint32)) & ~np.uint32(31)) | (within << 1).astype(np.uint32)


PREFIX = np.arange(1, 256)  # of a spelling's bit: the byte so far, after a 1
PLACE = places(np.append(0, np.where(PREFIX < 16, 1, np.where(PREFIX < 32, PREFIX, PREFIX >> np.log2(PREFIX).astype(int) - 4))),
               np.append(0, np.where(PREFIX < 16, PREFIX, (PREFIX & (1 << np.maximum(np.log2(PREFIX).astype(int) - 4, 0)) - 1) | 1 << np.maximum(np.log2(PREFIX).astype(int) - 4, 0))))


def slots_of(keys: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Table slots [contexts, bits] of the hashes of the last contexts, or of
    all, at a place; those of a group of places lie together, so a token
    touches few cache lines."""
    x = keys ^ (place | np.uint32(31))
    x *= np.uint32(0x9E3779B1)
    x >>= np.uint32(32 - TABLE_BITS)
    x ^= (place >> np.uint32(1)) & np.uint32(15)
    return x + OFFSET[CONTEXTS - len(keys):]


class Code:
    """A Huffman code of the frequent words and one leaf, the last, for the
    others: hashed nodes, each with its bit, of every leaf's way, and hashed
    contexts."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.uint8)
        heap = [(int(c), i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        for made in range(n, 2 * n - 1):
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            parent[[i, j]], side[j] = made, 1
            heapq.heappush(heap, (a + b, made))
        at, leaf, found = np.arange(n), np.arange(n), []
        while len(leaf := leaf[go := at < 2 * n - 2]):
            at = at[go]
            found.append((leaf, parent[at] - n, side[at]))
            at = parent[at]
        leaves, nodes, bits = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        depth = np.concatenate([np.full(len(x[0]), i) for i, x in enumerate(found)]) if found else leaves
        order = np.lexsort((-depth, leaves))  # the way of a leaf from the root
        leaves, nodes, bits = leaves[order], nodes[order], bits[order].astype(np.int64)
        self.size = np.bincount(leaves, minlength=n)
        self.start = np.cumsum(self.size) - self.size
        level = np.arange(len(leaves)) - self.start[leaves]
        within = np.ones(len(leaves), np.int64)  # a group is 4 levels under a node
        for i in range(1, 4):
            deep = np.flatnonzero(level % 4 >= i)
            within[deep] = within[deep] << 1 | bits[deep - level[deep] % 4 + i - 1]
        self.way = places(nodes[np.arange(len(leaves)) - level % 4], within) | bits.astype(np.uint32)
        self.first = slots_of(np.zeros((CONTEXTS, 1), np.uint32), self.way)[0].astype(np.uint32)  # the first context is none
        self.other = n - 1

    def first_codes(self, counts: np.ndarray) -> np.ndarray:
        """Slot codes of the first context, which is none, after counts tokens of each leaf."""
        number, index = np.unique(self.first * 2 + (self.way & np.uint32(1)), return_inverse=True)
        level = np.searchsorted(LEVELS, np.bincount(index, np.repeat(counts, self.size)), "right") - 1
        codes = np.zeros(1 << TABLE_BITS, np.uint16)
        np.bitwise_or.at(codes, number // 2, (level << np.where(number % 2, 0, 8)).astype(np.uint16))
        return codes

    def bits_of(self, ids: np.ndarray, first: np.ndarray, end: int):
        """(bit, slots, token) of tokens, as ways_of, with the slots of all contexts."""
        for y, at, way, token in self.ways_of(ids, first, end):
            yield y, np.vstack([self.first[way], at]), token

    def ways_of(self, ids: np.ndarray, first: np.ndarray, end: int):
        """(bit, slots but for the first context's, place of the bit in the
        leaves' ways, token) of tokens, some of which are first of a text, in
        pieces of bounded size; the word before a text is the end token."""
        last = np.concatenate([[np.uint32(end)], ids[:-1]]).astype(np.uint32)
        last[first] = end
        before = np.concatenate([[np.uint32(end)], last[:-1]])
        before[first] = end
        leaf = np.where(ids >= RARE, self.other, ids).astype(np.int64)
        a, b = (last + np.uint32(1)) * np.uint32(0x85EBCA6B), (before + np.uint32(1)) * np.uint32(0xC2B2AE3D)
        common = np.maximum.accumulate(np.where(last < COMMON, np.arange(len(last)), 0))  # a text's first word follows the end
        c = (last[common] + np.uint32(1)) * np.uint32(0x9E3779B1)
        keys = _mix32(np.stack([a, (a ^ (b >> np.uint32(7)) ^ (b << np.uint32(9))) * np.uint32(0x27D4EB2F), c ^ np.uint32(0x5BD1E995)]))
        for i in range(0, len(ids), 10 * CHUNK):
            part = leaf[i:i + 10 * CHUNK]
            size = self.size[part]
            token = np.repeat(np.arange(len(part)), size)
            way = np.repeat(self.start[part] - (np.cumsum(size) - size), size) + np.arange(len(token))
            place = np.take(self.way, way)
            yield (place & np.uint32(1)).astype(np.int64), slots_of(np.take(keys[:, i:i + 10 * CHUNK], token, 1), place), way, token + i


def spelling(words: list[bytes]):
    """(bit, slots, word) of the spellings of words, a piece for each place in
    the byte; the end token is spelled as an empty word, a space closes each."""
    words = [b"" if w == END else w for w in words]
    text = np.frombuffer(b"".join(w + b" " for w in words), np.uint8).astype(np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    at = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
    keys, h = [], np.zeros(len(text), np.uint32)
    for order in range(1, max(BYTES_BACK) + 1):
        back = np.zeros(len(text), np.uint32)
        back[order:] = text[:-order]
        back[at < order] = 0
        h = (h * np.uint32(0x9E3779B1)) ^ ((back + np.uint32(1)) * np.uint32(0x85EBCA6B))
        h ^= h >> np.uint32(15)
        if order in BYTES_BACK:
            keys.append(h)
    keys, word = _mix32(np.stack(keys)), np.repeat(np.arange(len(words)), size)
    for bit in range(7, -1, -1):
        yield ((text >> np.uint32(bit)) & np.uint32(1)).astype(np.int64), slots_of(keys, PLACE[(text | np.uint32(256)) >> np.uint32(bit + 1)]), word


def cells_of(states: np.ndarray, slots: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """The cell of every bit, from the states of all slots; first has the first
    context's states, where slots lacks them."""
    first = np.take(states, slots[0]) if first is None else first
    found = [first, *(np.take(states, at) for at in slots[1 - CONTEXTS:])]
    pairs = []
    for k in range(0, CONTEXTS, 2):  # two states fit 16 bits
        pair = found[k].astype(np.uint16)
        pair *= np.uint16(SHAPE[k + 1])
        pair += found[k + 1]
        pairs.append(pair)
    cell = pairs[0].astype(np.int64)
    cell *= SHAPE[2] * SHAPE[3]
    cell += pairs[1]
    return cell


def states_of(codes: np.ndarray, own: int = 2, whole: tuple[int, ...] = ()) -> np.ndarray:
    """A byte for every slot; own is 0 or 1 to leave out a bit's own count, but
    in the contexts of whole."""
    states = []
    for k, part in enumerate(codes.reshape(CONTEXTS, -1)):
        at = 2 if k in whole else own
        states.append(STATE[k][at << 16:(at + 1) << 16][part])
    return np.concatenate(states)


def inputs(cells: np.ndarray):
    """Stretched predictions [CONTEXTS, cells] and the gate of cells."""
    states = np.unravel_index(cells, SHAPE)
    return np.stack([STRETCH[k][states[k]] for k in range(CONTEXTS)]), SEEN[states[GATED[0]]] * 4 + SEEN[states[GATED[1]]]


def fit(seen: np.ndarray) -> np.ndarray:
    """Weights [CONTEXTS, GATES] that code the bits seen in all cells best, by
    Newton's method: a gate's weights do not depend on another's."""
    weights = np.full((CONTEXTS, GATES), 0.4)
    cells = np.flatnonzero(seen.any(1))
    stretch, gate = inputs(cells)
    for g in np.unique(gate):
        s, (n0, n1) = stretch[:, gate == g], seen[cells[gate == g]].T
        w = weights[:, g]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(w @ s, -12, 12)))
            step = np.linalg.solve((s * ((n0 + n1) * p * (1 - p))) @ s.T + 10 * np.eye(CONTEXTS), s @ (n1 - (n0 + n1) * p) - 10 * (w - 0.4))
            w += step / max(1, 2 * np.abs(step).max())
            if np.abs(step).max() < 1e-6:
                break
    return weights


class Mixer:
    """The mix over a fixed table of slot codes: the levels of the counts of 0
    and of 1, a byte each. As a slot's prediction is one of few states, the
    mix and its adaptive map are worked out once for each cell."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray | None = None, seen: np.ndarray | None = None):
        self.states = states_of(codes)
        stretch, gate = inputs(np.arange(CELLS))
        weights = np.full((CONTEXTS, GATES), 0.4) if weights is None else weights
        p = 1 / (1 + np.exp(-np.clip(sum(weights[k][gate] * stretch[k] for k in range(CONTEXTS)), -12, 12)))
        if seen is not None:
            p = (seen[:, 1] + PRIOR * p) / (seen.sum(1) + PRIOR)
        p = np.clip(p, 1e-6, 1 - 1e-6)
        self.logs = np.log10(np.stack([1 - p, p], 1)).ravel().astype(np.float32)

    def predict(self, y: np.ndarray, slots: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of every bit."""
        cell = cells_of(self.states, slots, first)
        cell *= 2
        cell += y
        return np.take(self.logs, cell)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts (binary), and how many each text has."""
    texts = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)  # these kernels read bytes, valid UTF-8 or not
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    each = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    words = words.flatten()
    full = pc.greater(pc.binary_length(words), 0)  # white space at an end splits off an empty word
    words = words.filter(full)
    return pa.Array.from_buffers(pa.binary(), len(words), words.buffers(), offset=words.offset), np.bincount(each[full.to_numpy(zero_copy_only=False)], minlength=len(texts))


def _parts(batch: pa.RecordBatch, texts: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows whose texts are of size bytes together, or of the last one more."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy().astype(np.int64))
    i = 0
    while i < batch.num_rows:
        j = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size)) + 1
        yield batch.slice(i, j - i)
        i = j


def lexicon(rows: DataFrame) -> DataFrame:
    """(word, c): every token of the table, c its count in training rows.
    rows: (t, held_out)."""

    def run(batches):
        for batch in batches:
            for part in _parts(batch, 0, 8 * PART):
                words, size = _words(part.column(0))
                held = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                coded = words.dictionary_encode()
                n = np.bincount(coded.indices.to_numpy()[np.repeat(~held, size)], minlength=len(coded.dictionary))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())]), pa.array(np.append(n, (~held).sum()), pa.int64())], ["word", "c"])

    return rows.select("t", "held_out").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def add_up(data: DataFrame, size: int, numbers, dtype, finish=lambda n: n) -> np.ndarray:
    """How often numbers(batches) gives each number below size, over all rows;
    finish is applied to blocks of the sums."""

    def run(batches):
        table = np.zeros(size, np.uint32)
        one = np.ones(0, np.uint32)
        for at in numbers(batches):
            if len(one) < len(at):
                one = np.ones(len(at), np.uint32)
            np.add.at(table, at, one[:len(at)])
        pack = zstandard.ZstdCompressor(level=1)
        for i in range(0, size, BLOCK):
            if table[i:i + BLOCK].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK], pa.int32()), pa.array([pack.compress(table[i:i + BLOCK].tobytes())], pa.binary())], ["block", "part"])

    def total(key: tuple, groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Adds up a block, one task's part at a time."""
        n, unpack = np.zeros(min(BLOCK, size - key[0] * BLOCK), np.int64), zstandard.ZstdDecompressor()
        for group in groups:
            for part in group["part"]:
                n += np.frombuffer(unpack.decompress(part), np.uint32)
        yield pd.DataFrame({"block": [key[0]], "n": [finish(n).astype(dtype).tobytes()]})

    got = data.mapInArrow(run, "block int, part binary").groupBy("block").applyInPandas(total, "block int, n binary").toPandas()
    parts = {int(i): np.frombuffer(n, dtype) for i, n in zip(got["block"], got["n"])}
    empty = [finish(np.zeros(min(BLOCK, size - i), np.int64)).astype(dtype) for i in range(0, size, BLOCK)]
    release(data.sparkSession)
    return np.concatenate([parts.get(i, x) for i, x in enumerate(empty)])


def _levels(n: np.ndarray) -> np.ndarray:
    level = np.searchsorted(LEVELS, n, "right") - 1
    return level[0::2] << 8 | level[1::2]


def bit_counts(data: DataFrame, events, first: np.ndarray | None = None) -> np.ndarray:
    """Slot codes, 2 bytes a slot, of the table of all bits that events(batch)
    gives; first are those of the first context, where events leaves it out."""

    def numbers(batches):
        for batch in batches:
            for y, at, _ in events(batch):
                at *= 2
                at += y
                yield from at

    codes = add_up(data, 2 * CONTEXTS << TABLE_BITS, numbers, np.uint16, _levels)
    if first is not None:
        codes[:len(first)] = first
    return codes


def train_mixer(data: DataFrame, events, codes: np.ndarray, first: np.ndarray | None = None) -> Mixer:
    """The mixer of all bits of the data, each predicted without its own count.
    Where events leaves out the first context's slots, first has them by place
    in the ways; its counts stay whole: a code's two sides count alike by its
    making, so that without the own one the other would seem likelier."""
    shared = data.sparkSession.sparkContext.broadcast((codes, first))

    def numbers(batches):
        states = ahead = None
        for batch in batches:
            if states is None:
                table, places = shared.value
                states = np.stack([states_of(table, own, () if places is None else (0,)) for own in (0, 1)], 1).ravel()
                ahead = None if places is None else states[places * 2]
            for y, at, who in events(batch):
                at *= 2
                at += y
                cell = cells_of(states, at, None if ahead is None else np.take(ahead, who))
                cell *= 2
                cell += y
                yield cell

    seen = add_up(data, 2 * CELLS, numbers, np.int64).reshape(-1, 2)
    shared.unpersist()
    return Mixer(codes, fit(seen), seen)


def spell(mixer: Mixer, words: list[bytes]) -> np.ndarray:
    """log10 probability of the spelling of each word."""
    total = np.zeros(len(words))
    for y, at, word in spelling(words):
        total += np.bincount(word, mixer.predict(y, at), len(words))
    return total


def _spellings(batch):
    for i in range(0, batch.num_rows, 10 * CHUNK):
        yield from spelling(batch.column(0).slice(i, 10 * CHUNK).to_pylist())


def rate_words(words: DataFrame, N: int, V: int) -> DataFrame:
    """(word, c, base, value) of words without a code; value is the log10
    probability of the word among them."""
    known = words.where("c > 0")
    R, W, once, twice = (int(x or 0) for x in known.agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first())
    d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
    part = known.select("word")
    mixer = train_mixer(part, _spellings, bit_counts(part, _spellings))
    shared = words.sparkSession.sparkContext.broadcast(mixer)

    def rate(batches):
        m = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 10 * CHUNK):
                part = batch.slice(i, 10 * CHUNK)
                c = part.column(1).to_numpy().astype(float)
                spelled = spell(m, part.column(0).to_pylist())
                value = np.log10(np.maximum(c - d, 0) / R + d * W / R * 10.0**spelled + 1e-300) if R else spelled
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.log10((c + 1) / (N + V + 1))), pa.array(value)], ["word", "c", "base", "value"])

    return materialize(words.mapInArrow(rate, "word binary, c long, base double, value double"), "rated")


def encode(rows: DataFrame, top: pd.DataFrame, end: int, N: int, V: int) -> DataFrame:
    """Every row's tokens as ids (uint32; RARE and a hash for words without a
    code), its words without one, and its sums over the others."""
    index = rows.sparkSession.sparkContext.broadcast((pa.array(map(bytes, top["word"]), pa.binary()), np.append(np.log10((top["c"].to_numpy(float) + 1) / (N + V + 1)), 0)))

    def run(batches):
        place, base = index.value
        for batch in batches:
            for part in _parts(batch, 1, PART):
                words, size = _words(part.column(1))
                at = pc.index_in(words, value_set=place)
                other = words.filter(at.is_null())
                at = pc.fill_null(at, -1).to_numpy()
                text, ends = np.repeat(np.arange(len(size)), size), np.cumsum(size + 1)
                b = np.bincount(text, base[at], len(size))  # -1 is the last, which is 0
                missing = np.flatnonzero(at < 0)
                text = text[missing]
                n_known = size - np.bincount(text, minlength=len(size))
                coded = other.dictionary_encode()
                hashes = np.fromiter(map(zlib.crc32, coded.dictionary.to_pylist()), np.uint32, len(coded.dictionary)) | RARE
                known = at.astype(np.uint32)
                known[missing] = hashes[coded.indices.to_numpy()]
                ids, inner = np.full(len(at) + len(size), end, np.uint32), np.ones(len(at) + len(size), bool)
                inner[ends - 1] = False
                ids[inner] = known
                if end < RARE:
                    n_known, b = n_known + 1, b + base[end]
                    spelled = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size + 1 - n_known)), pa.int32()), other)
                else:  # the end token, too, has no code
                    order = np.argsort(np.append(text, np.arange(len(size))), kind="stable")
                    both = pa.concat_arrays([other, pa.array([END] * len(size), pa.binary())]).take(pa.array(order))
                    spelled = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size + 1 - n_known)), pa.int32()), both)
                bytes_of = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.append(0, ends * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(size + 1, pa.int64()), pa.array(n_known, pa.int64()), pa.array(b, pa.float64()),
                                                  pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64()), bytes_of, spelled], ["doc_id", "held_out", "n", "k", "b", "size", "ids", "rare"])

    coded = rows.mapInArrow(run, "doc_id long, held_out boolean, n long, k long, b double, size long, ids binary, rare array<binary>")
    return materialize(coded.withColumn("row", F.monotonically_increasing_id()), "coded")


def score(docs: DataFrame, modulus: int = 7, held: int = 2) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("t"), (fold_of(F.col("doc_id"), modulus) == held).alias("held_out"))
    words = materialize(lexicon(rows), "words")
    release(spark)
    N, V = (int(x or 0) for x in words.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first())
    top = words.where(F.col("c") >= LEAST).orderBy(F.desc("c"), "word").limit(FREQUENT).toPandas()
    last = None if len(top) < FREQUENT else (int(top["c"].iloc[-1]), bytes(top["word"].iloc[-1]))
    rare = words.where(F.col("c") < LEAST) if last is None else words.where((F.col("c") < last[0]) | ((F.col("c") == last[0]) & (F.col("word") > F.lit(last[1]))))
    rated = rate_words(rare, N, V)
    ends = np.flatnonzero(top["word"].map(bytes) == END)
    end = int(ends[0]) if len(ends) else zlib.crc32(END) | 1 << 31
    coded = encode(rows, top, end, N, V)
    discard(words)
    counts = np.append(top["c"].to_numpy(np.int64), N - int(top["c"].sum()))
    code = Code(np.maximum(counts, 1))
    shared = spark.sparkContext.broadcast(code)

    def texts(column):
        """(ids, first tokens) of bounded groups of texts."""
        held, size = [], 0
        for x in column:
            ids = np.frombuffer(x.as_buffer(), np.uint32)
            held.append(ids)
            size += len(ids)
            if size > 10 * CHUNK:
                yield held
                held, size = [], 0
        if held:
            yield held

    def events(batch):
        for held in texts(batch.column(0)):
            size = np.fromiter(map(len, held), np.int64, len(held))
            for y, at, way, _ in shared.value.ways_of(np.concatenate(held), np.cumsum(size) - size, end):
                yield y, at, way

    training = coded.where("NOT held_out").select("ids")
    mixer = train_mixer(training, events, bit_counts(training, events, code.first_codes(counts)), code.first)
    mixed = spark.sparkContext.broadcast(mixer)

    def mix(batches):
        m, ways = mixed.value, shared.value
        ahead = np.take(m.states, ways.first)
        for batch in batches:
            out = []
            for held in texts(batch.column(0)):
                size = np.fromiter(map(len, held), np.int64, len(held))
                start, total = np.cumsum(size) - size, np.zeros(len(held))
                for y, at, way, token in ways.ways_of(np.concatenate(held), start, end):
                    if len(y):
                        i, j = np.searchsorted(start, token[[0, -1]], "right")
                        total[i - 1:j] += np.add.reduceat(m.predict(y, at, np.take(ahead, way)), np.append(0, np.searchsorted(token, start[i:j])), dtype=np.float64)
                out.append(total)
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.concatenate(out))], ["doc_id", "held_out", "n", "k", "b", "size", "row", "v"])

    scored = materialize(coded.select("ids", "doc_id", "held_out", "n", "k", "b", "size", "row").mapInArrow(mix, "doc_id long, held_out boolean, n long, k long, b double, size long, row long, v double"), "scored")
    rest = (coded.select("row", F.explode("rare").alias("word")).join(rated, "word").groupBy("row")
            .agg(F.count_if(F.col("c") > 0).alias("k2"), F.sum("base").alias("b2"), F.sum("value").alias("v2")))
    value = F.col("v") + F.coalesce("v2", F.lit(0.0))
    return scored.join(rest, "row", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("k") + F.coalesce("k2", F.lit(0))).alias("n_known"), F.lit(N).cast("long").alias("train_tokens"),
        (F.col("b") + F.coalesce("b2", F.lit(0.0))).alias("base_score"), value.alias("score"), (-value / float(np.log10(2)) / F.greatest("size", F.lit(1))).alias("bits_per_byte"))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: the log10 probability of every document."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
