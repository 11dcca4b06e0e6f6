"""The training-data operators against brute force on small tables, and the
odd rows that each must take: nulls, empty texts, repeated rows, extra
columns, no rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from voxloom.llm import common, context_mixing, decontaminate, line_dedup, media_chunks, packing, quality_gam, secret_scan, shard_store, simhash_dedup, toxicity_zstd

WORDS = "ash bell corn dune elm fern gold hill iris jade kelp lime moss nest oak pine quay reed sage thyme".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    base = [text(rng, rng.randrange(5, 300)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)] + [(50, base[3]), (51, base[3] + " x"), (52, base[4]), (None, "a null id"), (60, None), (61, ""), (62, "one"), (50, base[3])]
    rows = [(i, t, "s", "s") for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, fp string").repartition(3)


def test_simhash(spark, docs):
    got = simhash_dedup.near_duplicates(docs).collect()
    fps = {(r.doc_id, r.fp & (1 << 64) - 1) for r in docs and got}
    ids = {}
    for i, f in fps:
        ids.setdefault(f, []).append(i)
    nodes = list(ids)
    group = {f: f for f in nodes}
    for _ in nodes:
        for a in nodes:
            for b in nodes:
                if bin(a ^ b).count("1") <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    want = {f: min((i for g in nodes if group[g] == group[f] for i in ids[g] if i is not None), default=None) for f in nodes}
    assert len(got) == docs.count() and all(r.component_id == want[r.fp & (1 << 64) - 1] for r in got)
    assert simhash_dedup.near_duplicates(docs.where("false")).count() == 0


def test_trie_pairs_match_brute_force():
    rng = np.random.default_rng(3)
    center = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
    near = [center ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in rng.integers(0, 4, 300)]
    x = np.unique(np.concatenate([*near, rng.integers(0, 1 << 63, 200, dtype=np.uint64)]))
    got = {(int(a), int(b)) for i, j in simhash_dedup.trie_pairs(x, x, 2) for a, b in zip(i, j)}
    want = {(i, j) for i in range(len(x)) for j in range(len(x)) if bin(int(x[i] ^ x[j])).count("1") <= 2}
    assert got == want


def test_lines(spark):
    long = "the quick brown fox jumps over the lazy dog again"
    rows = [(1, f"{long}\nshort"), (2, f"{long}\nother words are here and they do stay"), (3, "the quick brown fox jumps over the lazy cog again\nshort"), (4, None), (5, ""), (None, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.dedup(docs).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("other words are here and they do stay", 1), 3: ("short", 1), 4: (None, 0), 5: ("", 0), None: ("", 1)}
    assert line_dedup.dedup(docs.where("false")).count() == 0


def test_banded_distance(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("abé ") for _ in range(rng.randrange(14)))
        b = list(a)
        for _ in range(rng.randrange(4)):
            b.insert(rng.randrange(len(b) + 1), rng.choice("abé ")) if rng.random() < 0.5 or not b else b.pop(rng.randrange(len(b)))
        rows.append((a, "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string").where("abs(length(a) - length(b)) <= 2")
    for r in df.select(line_dedup.banded_distance(F.col("a"), F.col("b"), 2).alias("d"), F.levenshtein("a", "b").alias("e")).collect():
        assert r.d == r.e or (r.d > 2 and r.e > 2)


def test_media(docs):
    media, table = media_chunks.write_store(docs)
    read = {bytes(r.media_key): r for r in media_chunks.read_store(media, table).collect()}
    for r in media.collect():
        assert bytes(r.media_key) in read
    want = {hashlib.sha256(media_chunks.payload_of(None if t.text is None else t.text.encode())).hexdigest() for t in docs.collect()}
    assert {r.payload_sha256 for r in read.values()} == want
    m = media_chunks.encode(random.Random(2).randbytes(50_000))
    assert b"".join(p for _, p in media_chunks.chunks(m)) == m and max(len(p) for _, p in media_chunks.chunks(m)) <= media_chunks.MAX


def test_secrets(spark):
    h = "0123456789abcdef" * 2
    rows = [(1, f"x token = \"{h}\" AKIA{'A1' * 8}", "a"), (2, f"É\u0001secret: short token={h}", "b"), (3, None, None), (4, "", "a"), (4, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id, [(s.start, s.rank, s.end, s.live) for s in r.spans or ()]) for r in secret_scan.scan(docs).collect())
    assert got == [(1, [(2, 0, 43, False), (11, 2, 43, False), (45, 1, 65, False)]), (2, [(16, 0, 54, False), (22, 2, 54, False)]), (3, []), (4, []), (4, [])]


def test_tokens_are_the_tokenizers_own():
    rng = random.Random(4)
    words = packing.Words(limit=50)
    texts = ["It's 2024, the Élan!", "a\tb  c\n\nd", "", None, " x ", "don't. stop,, ok., É. é, I\u0307. ﬁne, 9. ,", "日本 語. ß,", "A." * 5]
    texts += [" ".join(rng.choice(WORDS).title() + rng.choice(["", ",", ".", "!", "'s", "7"]) for _ in range(40)) for _ in range(20)]
    for part in (texts, texts[:1], texts[2:4], texts[::-1]):
        flat, ends, topics = words.encode(part)
        got = [x.tolist() for x in np.split(flat, ends[:-1])]
        assert got == [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in part] and len(topics) == len(part)


def test_packing(spark, docs):
    """Every piece by brute force: whose ids it has, where it stands, that none is lost."""
    words = packing.Words()
    ids = lambda t: [*words.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
    hot = spark.createDataFrame([(7, "same words again and again", "s", "s")] * 300, docs.schema)
    for given, shard in ((docs, 1 << 19), (docs.union(hot), 700), (docs.where("doc_id = 61"), 700)):
        rows = given.collect()
        got = packing.sequences(given, window=256, shard_tokens=shard).toPandas().sort_values(["sequence_id", "offset"])
        crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
        whole = Counter((r.doc_id, crc(x), len(x)) for r in rows for x in [ids(r.text)] if len(x) <= 5)
        seen = Counter((None if i != i or i is None else int(i), c, n) for i, c, n, s, d in zip(got.doc_id, got.ids_crc32, got.length, got.start, got.doc_tokens) if n == d <= 5)
        assert all(seen[k] <= n for k, n in whole.items())
        texts = {}
        for r in rows:
            texts.setdefault((r.doc_id, len(ids(r.text))), []).append(ids(r.text))
        for i, s, n, c, d in zip(got.doc_id, got.start, got.length, got.ids_crc32, got.doc_tokens):
            assert any(crc(x[s:s + n]) == c for x in texts[None if i != i or i is None else int(i), d])
        assert got.length.sum() == sum(len(ids(r.text)) for r in rows)
        assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all() and got.groupby("sequence_id").length.sum().max() <= 256
    assert packing.sequences(docs.where("false")).count() == 0


def test_neighbours_follow_their_seed():
    """A window is filled by the seed's best neighbours by BM25, as scored plainly."""
    rng = np.random.default_rng(8)
    docs = [rng.choice(50, rng.integers(5, 30)).astype(np.uint16) + 50 * (k % 3) for k in range(30)]
    size, n = np.array([len(d) for d in docs]), len(docs)
    index = packing.Bm25(docs)
    for q in range(5):
        want = np.zeros(n)
        for t in set(docs[q].tolist()):
            tf = np.array([(d == t).sum() for d in docs])
            idf = np.log(1 + (n - (tf > 0).sum() + 0.5) / ((tf > 0).sum() + 0.5))
            want += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / size.mean()))
        assert np.allclose(index.scores(np.unique(docs[q])), want)
    first = [d for d, _, _, q, _ in packing.pack(docs, 100) if q == 0]
    assert all(d % 3 == first[0] % 3 for d in first)


def test_leaks(spark):
    rng = random.Random(5)
    item = text(rng, 30)
    changed = item.split()
    changed[2] = "zzz"
    rows = [(1, f"{text(rng, 50)} {item} {text(rng, 20)}"), (2, text(rng, 80)), (3, " ".join(changed)), (4, None), (5, ""), (6, item.upper())]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(9, item), (10, None), (11, "tiny item")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(1, 9): 1.0, (6, 9): 1.0}  # document 3 has a similarity of 23 / 29
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0 and decontaminate.leaks(docs.where("false"), bench).count() == 0


def test_store(spark, docs, tmp_path):
    s = shard_store.ShardStore(spark, f"file://{tmp_path}/s", target=1 << 20, base=1 << 20)
    for _ in range(5):
        s.append(docs)
        s.compact()
    s.append(docs.where("false"))
    assert s.read().count() == 5 * docs.count() and len(s.manifest()["runs"]) == 2
    with pytest.raises(shard_store.Conflict):
        s.commit(1, [], docs.schema)
    old = s.versions()[-2]
    assert s.vacuum() == 0 and s.vacuum(keep=2, seconds=0) == 4 and s.read(old).count() == 5 * docs.count()  # young runs stay, and so does what a kept version lists
    assert s.read().exceptAll(docs.union(docs).union(docs).union(docs).union(docs)).count() == 0


def test_store_merges_to_the_target_and_survives_writers(spark, docs, tmp_path):
    s = shard_store.ShardStore(spark, f"file://{tmp_path}/s", target=40_000, base=10_000)
    for k in range(9):
        s.append(docs)
        if k == 4:  # a writer died before its rename
            (tmp_path / "s/manifests/.draft-dead").write_text("{")
    runs = s.manifest()["runs"]
    assert len(s.plan(runs)) == 2 and all(len(g) == 4 for g in s.plan(runs)) and s.plan(runs)[0] == runs[:4]
    s.compact()
    for r in s.manifest()["runs"]:
        assert "/arrival-" in r.path or 1 <= r.files <= max(1, round(4 * r.bytes / 40_000))
    assert s.read().count() == 9 * docs.count()
    other = shard_store.ShardStore(spark, f"file://{tmp_path}/s", target=40_000, base=10_000)
    commit, once = s.commit, []

    def late(version, runs, schema):
        if not once:
            once.append(other.append(docs))  # another writer is faster
        commit(version, runs, schema)

    s.commit = late
    s.append(docs)
    assert s.read().count() == 11 * docs.count()


def test_store_query(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 7), "x") for i in range(300)] + [(None, None, "y"), (5, "", "z"), (5, "", "z")]
    spark.createDataFrame(rows, "doc_id long, text string, run string").write.parquet(f"{tmp_path}/documents.parquet")
    got = shard_store.query(spark, str(tmp_path)).collect()
    want = Counter((i, None if t is None else len(t), None if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, t, _ in rows)
    assert Counter((r.doc_id, r.n_bytes, r.text_sha256) for r in got) == want and all(r.tier == 0 or r.tier == 1 for r in got)


def test_scores(spark, docs):
    got = context_mixing.score(docs).toPandas()
    count, rows = Counter(), docs.collect()
    tokens = lambda t: (t or "").encode().lower().split() + [b"\n"]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    for r in rows:
        if not held(r.doc_id):
            count.update(tokens(r.text))
    n, v = sum(count.values()), len(count)
    want = sorted(round(sum(np.log10((count[w] + 1) / (n + v + 1)) for w in tokens(r.text)), 6) for r in rows)
    assert len(got) == len(rows) and (got.train_tokens == n).all() and sorted(got.base_score.round(6)) == want and (got.score <= 0).all()
    assert all(s > b for s, b, k in zip(got.score, got.base_score, got.held_out) if not k)


def test_scores_of_odd_tables(spark):
    schema = "doc_id long, text string, row string, v string"
    assert context_mixing.score(spark.createDataFrame([], schema)).collect() == []
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = context_mixing.score(spark.createDataFrame([(held, "a b", "x", "y"), (held, "a b", "x", "y"), (held, None, "x", "y")], schema)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0), (3, 0, 0, 0), (3, 0, 0, 0)]
    assert all(r.score < 0 for r in got)


def some_mixer():
    rng = np.random.default_rng(1)
    return context_mixing.Mixer(rng.choice(np.array([0, 1, 256, 259, 1281], np.uint16), context_mixing.CONTEXTS << context_mixing.TABLE_BITS), rng.normal(size=(context_mixing.CONTEXTS, context_mixing.GATES)))


def test_spelling_adds_up():
    first = [bytes([b]) for b in range(256) if b not in (32,)]
    p = 10.0 ** context_mixing.spell(some_mixer(), [*first, b"\n"])
    assert 0 < p.sum() <= 1 + 1e-9


def test_code_adds_up_and_is_short():
    """After any words the probabilities of all leaves add up to one; the code
    is as short as the entropy but for a bit."""
    c = np.random.default_rng(2).integers(1, 1000, 300)
    code, mixer = context_mixing.Code(c), some_mixer()
    for before in ([], [7], [7, 250], [3, 299 | 1 << 31]):
        total = 0.0
        for leaf in range(300):
            ids = np.array([*before, leaf], np.uint32)
            total += 10.0 ** sum(mixer.predict(y, at)[token == len(before)].sum() for y, at, token in code.bits_of(ids, np.array([0]), 0))
        assert abs(total - 1) < 1e-5
    p = c / c.sum()
    assert -(p * np.log2(p)).sum() <= (p * code.size).sum() < 1 - (p * np.log2(p)).sum()


def test_texts_in_a_group_are_apart(monkeypatch):
    """A text has the bits and slots that it has alone, in any pieces."""
    rng = np.random.default_rng(3)
    code = context_mixing.Code(rng.integers(1, 50, 100))
    texts = [np.append(rng.integers(1, 100, n), 0).astype(np.uint32) for n in (0, 1, 5, 0, 40)]
    size = np.array([len(t) for t in texts])
    alone = [np.concatenate([np.vstack([y, at]) for y, at, _ in code.bits_of(t, np.array([0]), 0)], 1) for t in texts]
    monkeypatch.setattr(context_mixing, "CHUNK", 1)
    parts = list(code.bits_of(np.concatenate(texts), np.cumsum(size) - size, 0))
    assert len(parts) == 6 and (np.concatenate([np.vstack([y, at]) for y, at, _ in parts], 1) == np.concatenate(alone, 1)).all()


def test_bit_counts_match_brute_force(spark):
    words = [w.encode() for w in WORDS] + [b"\n", "\u00e9\u00e8".encode()]
    data = spark.createDataFrame([(bytearray(w),) for w in words * 3], "word binary").repartition(3)
    seen: Counter = Counter()
    for w in words * 3:
        for y, at, _ in context_mixing.spelling([w]):
            for k in at:
                seen.update(zip(k.tolist(), y.tolist()))
    codes = context_mixing.bit_counts(data, context_mixing._spellings)
    at = np.flatnonzero(codes)
    level = lambda n: int((context_mixing.LEVELS <= n).sum()) - 1
    assert {int(i): int(codes[i]) for i in at} == {i: level(seen[i, 0]) << 8 | level(seen[i, 1]) for i, _ in seen}


def test_words_without_a_code_are_joined(spark, docs, monkeypatch):
    """With few words in the code, counts and base stay; the score is still over the base where it learnt."""
    monkeypatch.setattr(context_mixing, "FREQUENT", 5)
    got = context_mixing.score(docs).toPandas()
    tokens = [len((r.text or "").split()) + 1 for r in docs.collect()]
    assert sorted(got.n_tokens) == sorted(tokens) and (got.n_known <= got.n_tokens).all() and np.isfinite(got.score).all() and (got.score < 0).all()


def test_scores_do_not_depend_on_partitions(spark, docs):
    one, many = ({tuple(r) for r in context_mixing.score(docs.repartition(n)).selectExpr("doc_id", "n_tokens", "round(score, 6)").collect()} for n in (1, 5))
    assert one == many


def test_mixer_matches_brute_force(spark):
    """Every bit's cell holds the states without its own count; the weights are at the optimum."""
    words = [w.encode() for w in WORDS] * 2 + [b"\n"]
    data = spark.createDataFrame([(bytearray(w),) for w in words], "word binary").repartition(3)
    codes = context_mixing.bit_counts(data, context_mixing._spellings)
    mixer = context_mixing.train_mixer(data, context_mixing._spellings, codes)
    seen = np.zeros((context_mixing.CELLS, 2), np.int64)
    for w in words:
        for y, at, _ in context_mixing.spelling([w]):
            for bit, slots in zip(y, at.T):
                cell = 0
                for k, slot in enumerate(slots):
                    n = context_mixing.LEVELS[[codes[slot] >> 8, codes[slot] & 255]]
                    n[bit] -= n[bit] < 32
                    i, j = np.searchsorted(context_mixing.LEVELS, n, "right") - 1
                    cell = cell * context_mixing.SHAPE[k] + int(context_mixing.STATE[k][131_072 + i * 256 + j])
                seen[cell, bit] += 1
    want = context_mixing.Mixer(codes, context_mixing.fit(seen), seen)
    assert seen.sum() == 8 * sum(len(w) + (w != b"\n") for w in words) and np.array_equal(mixer.logs, want.logs)
    stretch, gate = context_mixing.inputs(np.flatnonzero(seen.any(1)))
    n0, n1 = seen[seen.any(1)].T

    def loss(w):
        x = (w[:, gate] * stretch).sum(0)
        return (n0 * np.logaddexp(0, x) + n1 * np.logaddexp(0, -x)).sum() + 5 * ((w - 0.4) ** 2).sum()

    best, rng = context_mixing.fit(seen), np.random.default_rng(5)
    assert all(loss(best) < loss(best + rng.normal(size=best.shape) * 0.05) for _ in range(20))


def test_counts_of_the_first_context_are_those_of_the_code(spark):
    rng = np.random.default_rng(6)
    ids = np.append(rng.zipf(1.3, 3000) % 90, np.arange(90)).astype(np.uint32)
    counts = np.bincount(ids, minlength=90)
    code = context_mixing.Code(counts)
    seen = np.zeros(2 * context_mixing.CONTEXTS << context_mixing.TABLE_BITS, np.int64)
    for y, at, _ in code.bits_of(ids, np.array([0]), 0):
        np.add.at(seen, at[0] * 2 + y, 1)
    assert np.array_equal(code.first_codes(counts), context_mixing._levels(seen)[:1 << context_mixing.TABLE_BITS])


def test_words_by_arrow():
    """Any bytes, null and white space, as Python's bytes split them."""
    texts = [b"x y", b"", None, b"  A b\tC\x0b\x0c\r\nd\xc3\x89 ", b" \n ", b"\x1c\x85\xa0 \xff\xfe Y", b"a\xc2\xa0b \xe2\x80\x83c"]
    for start in (0, 1):
        words, size = context_mixing._words(pa.array(texts, pa.binary()).slice(start))
        want = [(t or b"").lower().split() for t in texts[start:]]
        assert words.to_pylist() == sum(want, []) and list(size) == list(map(len, want))


def test_classifiers(spark, docs):
    rng = random.Random(11)
    rows = [(i, text(rng, 120) + (" " + " ".join(rng.choice(["vilehog", "badword", "scumbag"]) + " " + rng.choice(WORDS) for _ in range(6)) if i % 3 == 0 else "")) for i in range(300)]
    many = spark.createDataFrame([(i, t if i % 4 else t.upper() + "!!") for i, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), int(i % 3 == 0)) for i, _ in rows] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    for module, column in ((toxicity_zstd, "toxic"), (quality_gam, "quality")):
        got = module.score(many, module.train(many, labels)).join(labels, "doc_id").where(f"held_out AND {column} IS NOT NULL").toPandas()
        assert (got.predicted == got[column]).mean() > 0.9
        odd = module.score(docs, module.train(docs, labels.where("false"))).toPandas()
        assert len(odd) == docs.count() and odd.score.between(0, 1).all()


def test_simhash_stage_takes_similar_documents(spark):
    """Components of 5-word shingle sets of Jaccard similarity >= 0.8, by brute force."""
    rng = random.Random(13)
    rows = []
    for _ in range(12):
        words = text(rng, rng.randrange(40, 260)).split()
        for _ in range(5):  # a chain of ever more changed words, some over and some under the threshold
            rows.append((len(rows), " ".join(words)))
            for _ in range(rng.randrange(1, 5)):
                words[rng.randrange(len(words))] = "new" + str(rng.randrange(999))
    rows += [(100, rows[0][1] + " x"), (101, rows[0][1].upper()), (102, None), (103, ""), (104, "one two"), (None, rows[0][1])]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    sets = [(i, shingles(t)) for i, t in rows]
    group = list(range(len(sets)))
    near = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a][1] & sets[b][1]) >= 4 * len(sets[a][1] | sets[b][1])]
    for _ in sets:
        for a, b in near:
            group[a] = group[b] = min(group[a], group[b])
    want = {min(i for (i, _), g in zip(sets, group) if g == h and i is not None) for h in group}
    got = [r.doc_id for r in simhash_dedup.stage(spark, docs, "").collect()]
    assert Counter(got) == Counter([*want, None]) and 12 < len(want) < 40
    assert simhash_dedup.stage(spark, docs.where("false"), "").count() == 0


def test_long_lines_with_changed_words_and_short_repeats(spark):
    """Lines that go, against brute force: equal, within 2 characters, or long and within 2 to 4 words."""
    rng = random.Random(17)
    lines = ["All rights reserved.", "short", "零一二三四五六七八九十零一二三四五六七八九十零一二三四五"]
    for n in (6, 12, 40, 49, 50, 51, 60, 120, 149, 151, 310):
        for _ in range(4):
            lines.append(text(rng, n))
            for k in (1, 1, 2, 3):
                words = lines[-1].split()
                for _ in range(k):
                    words.insert(rng.randrange(len(words)), "word") if rng.random() < 0.5 else words.__setitem__(rng.randrange(len(words)), "other")
                lines.append(" ".join(words))
    lines += lines[:3] + [lines[2][:-1] + "六"]
    rng.shuffle(lines)
    docs = [(i, "\n".join(lines[i::9])) for i in range(9)]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, old = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(row[j] + 1, old[j + 1] + 1, old[j] + (x != y)))
        return row[-1]

    def near(a, b):
        if a == b:
            return len(a) >= 6
        x, y = a.split(), b.split()
        if min(len(x), len(y)) >= 50:
            return edits(x, y) <= 2 + (min(len(x), len(y)) >= 150) + (min(len(x), len(y)) >= 300)
        return min(len(a), len(b)) >= 24 and abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2

    seen, want = [], {}
    for i, t in docs:
        for pos, line in enumerate(t.split("\n")):
            line = line.strip().lower()
            if any(near(line, x) for x in seen):
                want.setdefault(i, []).append(pos)
            seen.append(line)
    got = {r.d: r.drop for r in line_dedup.marks(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and sum(map(len, want.values())) > 20


def test_lines_of_one_id_and_clashing_columns(spark):
    """Rows of one id are told apart by their texts; columns of any name stay."""
    long = "the quick brown fox jumps over the lazy dog again"
    rows = [(1, long, 0, 1), (9, f"{long}\nother words", 2, 3), (9, "x", 4, 5), (9, f"y\n{long}", 6, 7), (9, "x", 8, 9), (None, long + "!", 1, 1), (None, "z", 1, 1), (5, None, 0, 0), (6, "", 0, 0)]
    for names in (("_d", "_drop"), ("d", "th"), ("n_lines", "n_dropped"), ("drop", "pos")):
        docs = spark.createDataFrame(rows, f"doc_id long, text string, {names[0]} int, {names[1]} int")
        got = sorted((tuple(r) for r in line_dedup.stage(spark, docs, "").collect()), key=str)
        want = [(1, long, 0, 1), (9, "other words", 2, 3), (9, "x", 4, 5), (9, "y", 6, 7), (9, "x", 8, 9), (None, "z", 1, 1), (5, None, 0, 0), (6, "", 0, 0)]
        assert got == sorted(want, key=str)
    odd = spark.createDataFrame([(1, "a " * 8_000 + "b"), (2, "a " * 8_000 + "c"), (3, "q" * 30_000), (4, "q" * 30_000 + "r")], "doc_id long, text string")
    assert [r.n_dropped for r in line_dedup.dedup(odd).orderBy("doc_id").collect()] == [0, 1, 0, 1]


def test_simhash_stage_keeps_texts_of_one_id(spark):
    a, b = text(random.Random(1), 60), text(random.Random(2), 60)
    docs = spark.createDataFrame([(1, a, "x"), (1, b, "x"), (1, a, "x"), (2, b, "y"), (3, a + " more", "z"), (None, a, "w")], "doc_id long, text string, th string")
    got = sorted((r.doc_id or 0, r.text, r.th) for r in simhash_dedup.stage(spark, docs, "").collect())
    assert got == sorted([(1, a, "x"), (1, b, "x"), (0, a, "w")])


def test_leaks_with_parts_in_another_order(spark):
    """All windows that reach the similarity, by brute force; halves swapped included."""
    rng = random.Random(23)
    items = {i: text(rng, n) for i, n in enumerate((50, 55, 20, 8, 3))}
    cut = lambda t, k: t.split()[k:] + t.split()[:k]
    rows = [(1, f"{text(rng, 30)} {' '.join(cut(items[0], 25))} {text(rng, 9)}"), (2, " ".join(cut(items[1], 3))), (3, " ".join(items[0].split()[:46])),
            (4, f"{items[2]} {items[3]} {items[4]} {items[2]}"), (5, f"{text(rng, 9)} {' '.join((cut(items[1], 40) * 2)[3:70])}"), (6, text(rng, 90))]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = {}
    for d, t in rows:
        for i, x in items.items():
            w, x = t.lower().split(), x.lower().split()
            size = min(5, len(x))
            counts = lambda v: Counter(tuple(v[k:k + size]) for k in range(len(v) - size + 1))
            for s in range(max(len(w) - len(x), 0) + 1):
                a, b = counts(w[s:s + len(x)]), counts(x)
                if 5 * sum((a & b).values()) >= 4 * sum((a | b).values()):
                    want.setdefault((d, i), []).append(s)
    assert {(r.doc_id, r.item_id): r.n_windows for r in decontaminate.leaks(docs, bench).collect()} == {k: len(v) for k, v in want.items()}
    assert (1, 0) in want


def test_secrets_are_judged_by_repositories_and_owners(spark):
    key = lambda k: "ghp_" + hashlib.sha256(k.encode()).hexdigest()[:36].upper()
    rows = [(i, f"note {i} {key('hot')}", "a") for i in range(20)] + [(30, f"mine {key('copied')}", "a"), (31, f"mine {key('copied')}", "b")]
    rows += [(40, f"one {key('owners')}", "a"), (41, f"two {key('owners')}", "b"), (50, key("single"), "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: [(s.rank, s.n_repos, s.n_owners, s.live) for s in r.spans or ()] for r in secret_scan.scan(docs).collect()}
    want = {i: [(3, 20, 1, False)] for i in range(20)} | {i: [(3, 1, 1, True)] for i in (30, 31, 50)} | {i: [(3, 2, 2, False)] for i in (40, 41)}
    assert got == want


def test_simhash_stage_makes_no_pairs_of_a_common_template(spark, monkeypatch):
    """Many texts that have most of their words in common, but are under the
    threshold, make no candidates by the square; tables over the broadcast
    limit give the same rows."""
    from voxloom.llm import set_join

    rng = random.Random(29)
    template = text(rng, 120)
    rows = [(i, f"{template} {text(rng, 60)}") for i in range(120)]
    rows += [(200, rows[5][1] + " more"), (201, rows[5][1]), (202, template), (203, template + " end"), (204, None), (205, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    met, verified = [], set_join.verified
    monkeypatch.setattr(set_join, "verified", lambda pairs, whole: met.append(pairs.select("u", "v").distinct().count()) or verified(pairs, whole))
    got = [sorted(r.doc_id for r in simhash_dedup.stage(spark, docs, "").collect())]
    assert max(met) < 200  # of 7140 pairs
    monkeypatch.setattr(set_join, "BROADCAST_IDS", 0)
    got.append(sorted(r.doc_id for r in simhash_dedup.stage(spark, docs, "").collect()))
    assert got == [[*range(120), 202, 204]] * 2


def test_shingle_sets_match_brute_force():
    import pyarrow as pa

    from voxloom.llm import set_join

    rng = random.Random(31)
    texts = ["", " ", "a", "a b\tc\n\nd", " a b c d e ", "a b c d e f a b c d e f", "é é é é é é", *(text(rng, rng.randrange(0, 40)) for _ in range(30)), "a b c d"]
    flat, n = set_join.shingle_sets(pa.array(texts))
    got = [x.tolist() for x in np.split(flat.view(np.uint64), np.cumsum(n)[:-1])]
    words = [t.split() for t in texts]
    want = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} - {()}) for w in words]
    assert [len(x) for x in got] == [len(x) for x in want] and all(x == sorted(set(x)) for x in got)
    assert all(len({*a} & {*b}) == len(x & y) for a, x in zip(got, want) for b, y in zip(got, want))


def test_secrets_count_every_holder(spark):
    """Null and empty owners are two; of an identical text all owners count,
    whatever its rows are numbered; texts that differ are not identical."""
    key = lambda k: "ghp_" + hashlib.sha256(k.encode()).hexdigest()[:36].upper()
    rows = [(1, f"one {key('null')}", None), (2, f"two {key('null')}", "")]
    for k, owners in ((10, "ab"), (20, "ba")):  # the text's other owner has another text with the value
        rows += [(k, f"{k} same {key(str(k))}", owners[0]), (k + 1, f"{k} same {key(str(k))}", owners[1]), (k + 2, f"{k} more {key(str(k))}", "b")]
    rows += [(30, f"\u0001 {key('marks')}", "a"), (31, f"\u0003 {key('marks')}", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: [(s.n_repos, s.n_owners, s.all_repos, s.all_owners, s.live) for s in r.spans] for r in secret_scan.scan(docs).collect()}
    want = {i: [(2, 2, 2, 2, False)] for i in (1, 2, 30, 31)} | {i: [(2, 1, 3, 2, True)] for i in (10, 11, 12, 20, 21, 22)}
    assert got == want


def test_packing_leaves_no_cache_in_workers(spark, docs):
    """Workers go on to other stages, so they drop the words when texts are tokenized."""
    import pyarrow as pa

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many tasks as there are workers, or more
    try:
        packing.sequences(docs, window=256, shard_tokens=100).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def kept(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(w.kept) + len(w.older) for w in packing._of_worker.values())], pa.int64())], ["n"])

    assert {r.n for r in spark.range(0, 4, 1, 4).mapInArrow(kept, "n long").collect()} == {0}


def test_parts_of_a_batch_are_as_one(docs):
    texts = [r.text for r in docs.collect()] + [None, ""]
    flat, ends, topics = packing.Words().encode(texts)
    parts = [*packing.Words().encode_parts(texts, 7)]
    assert np.concatenate([p[0] for p in parts]).tolist() == flat.tolist() and np.concatenate([p[2] for p in parts]).tolist() == topics.tolist()
    assert np.concatenate([np.diff(p[1], prepend=0) for p in parts]).tolist() == np.diff(ends, prepend=0).tolist()


def test_a_table_written_gives_back_the_drivers_memory(spark, monkeypatch):
    class Runtime:
        def __init__(self, total):
            self.total, self.collected = total, 0
            self.sparkContext = self._jvm = self.java = self.lang = self.Runtime = self

        getRuntime = lambda self: self
        totalMemory = lambda self: self.total
        maxMemory = lambda self: 1000

        def gc(self):
            self.collected += 1

    grown, small = Runtime(501), Runtime(500)
    common.shrink(grown)
    common.shrink(small)
    assert (grown.collected, small.collected) == (1, 0)
    calls = []
    monkeypatch.setattr(common, "shrink", calls.append)
    assert common.materialize(spark.range(5), "few").count() == 5
    assert calls == [spark]
    assert common.trim(spark)  # the JVM of these tests has the command
