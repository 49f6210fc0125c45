"""Jaccard join, suffix dedup and vector search against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from lakeworks.llm import shingle_join, suffix_dedup, vector_search
from lakeworks.llm.graph import components


def shingles(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def linked_components(texts, n, num, den):
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if den * shared >= num * (len(sets[i]) + len(sets[j]) - shared):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def near_copies(seed=1):
    g = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t", "a", "a b", "A B"]
    for size in (4, 6, 9, 12, 30, 80, 200, 500):
        for _ in range(3):
            base = [g.choice(vocabulary) for _ in range(size)]
            texts.append(" ".join(base))
            for edits in (0, 1, 1, 2, 3, 5, 9):
                copy = list(base)
                for _ in range(edits):
                    copy[g.randrange(len(copy))] = g.choice(vocabulary)
                if g.random() < 0.3:
                    copy = copy[g.randrange(3):]
                texts.append(" ".join(copy))
    line = " ".join(f"licence{i}" for i in range(40))
    texts += [f"{line} unique{i}" for i in range(30)] + [line] * 5
    return texts


def test_join_equals_brute_force(spark):
    texts = near_copies()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, node string, n long").repartition(5)
    for n, num, den in ((3, 90, 100), (5, 80, 100), (3, 60, 100)):
        roots, sizes = linked_components(texts, n, num, den)
        for tile in (8192, 4):  # tiles over 4 sets are taken apart
            rows = shingle_join.join(df, n, num, den, tile_nodes=tile).collect()
            assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {
                i: (sizes[i], roots[i]) for i in range(len(texts))}
            assert len(rows) == len(texts)


def test_join_on_odd_rows(corpus, nothing):
    rows = shingle_join.join(corpus).collect()
    assert len(rows) == corpus.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert by_id[1][0].n_shingles == 0 and by_id[1][0].component_id == 1
    assert {r.component_id for r in by_id[8]} == {7}
    assert by_id[6][0].component_id == 5 and sorted((r.n_shingles, r.component_id) for r in by_id[None]) == [(0, None), (1, 5)] \
        if all(r.component_id is not None or r.n_shingles == 0 for r in by_id[None]) else False
    assert shingle_join.join(nothing).count() == 0


def test_every_linked_pair_shares_a_key():
    g = random.Random(9)
    for num in (90, 80):
        bands = shingle_join.Bands(num, 100)
        for size in [*range(2, 40), 100, 333, 1000]:
            a = np.unique(np.asarray([g.getrandbits(64) for _ in range(size)], np.uint64))
            for _ in range(4):
                b, union = a.copy(), len(a)
                while True:  # edit as long as the pair stays linked
                    c = np.unique(np.concatenate([np.delete(b, g.randrange(len(b))),
                                                  np.asarray([g.getrandbits(64)] * g.randrange(2), np.uint64)]))
                    if not len(c) or not shingle_join.linked(a, c, num, 100):
                        break
                    b = c
                assert union and set(shingle_join.keys_of(a, bands).tolist()) & set(
                    shingle_join.keys_of(b, bands).tolist()) or np.array_equal(a, b)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(9, 9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 5 for i in range(200, 400))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed_by_force(texts, length):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        out.append(mark)
    return out


def passages(seed=2):
    g = random.Random(seed)

    def noise(n):
        return "".join(g.choice("abcde fghé") for _ in range(n))
    shared = [noise(n) for n in (60, 64, 70, 100, 150, 300)]
    texts = ["", None, noise(63), "z" * 300, "xy" * 200]
    for _ in range(40):
        texts.append("".join(x for _ in range(g.randint(1, 4)) for x in (noise(g.randint(0, 90)), g.choice(shared))))
    texts += [texts[7]] * 2 + [texts[8] + "!"]
    return texts


def test_repeats_equal_brute_force(spark):
    texts = passages()
    raw = [(t or "").encode() for t in texts]
    df = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(texts)], "doc_id long, text string, spans binary").repartition(4)
    for length, symbols in ((64, 8), (80, 4), (64, 1)):
        marks = removed_by_force(raw, length)
        for hot in (1 << 20, 1):  # with hot=1 all anchors go by window digests
            got = {r.doc_id: r for r in suffix_dedup.digests(df, length, symbols, hot=hot).collect()}
            for i, (t, m) in enumerate(zip(raw, marks)):
                spans = sum(1 for k in range(len(m)) if m[k] and (not k or not m[k - 1]))
                kept = bytes(b for b, x in zip(t, m) if not x)
                assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(t), sum(m), spans)
                assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    cleaned = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, 64, 8).collect()}
    marks = removed_by_force(raw, 64)
    assert cleaned[1].text is None and all(
        cleaned[i].text == bytes(b for b, x in zip(t, m) if not x).decode(errors="ignore")
        for i, (t, m) in enumerate(zip(raw, marks)) if texts[i] is not None)
    assert bytes(cleaned[0].spans) == b"x"


def test_repeats_with_contexts_on_both_sides_of_the_hot_limit(spark):
    """Equal windows at the end of a frequent header: one text has the whole header, the other its end only."""
    g = random.Random(5)

    def noise(n):
        return "".join(g.choice("abcdefghijklmnop ") for _ in range(n))
    header, texts = noise(200), []
    for tail in range(30, 70):
        passage = noise(60)
        texts += [header + passage, noise(50) + header[-tail:] + passage + noise(20), passage + noise(30)]
    raw = [t.encode() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for length, symbols in ((64, 8), (81, 3)):
        marks = removed_by_force(raw, length)
        for hot in (2, 5, 20, 60):
            got = {r.doc_id: r for r in suffix_dedup.digests(df, length, symbols, hot=hot).collect()}
            for i, (t, m) in enumerate(zip(raw, marks)):
                kept = bytes(b for b, x in zip(t, m) if not x)
                assert (hot, i, got[i].n_removed) == (hot, i, sum(m))
                assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_on_odd_rows(corpus, nothing):
    rows = suffix_dedup.digests(corpus).collect()
    data = corpus.collect()
    marks = removed_by_force([(r.text or "").encode() for r in data], 400)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in rows) == sorted(
        (r.doc_id or 0, len(m), sum(m)) for r, m in zip(data, marks))
    assert suffix_dedup.digests(nothing).count() == 0
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_repeated_passages_of_over_50_words_go_from_400_bytes_on(spark, tmp_path):
    """The contract counts bytes, not words; n_bytes is the length of the text as given, whatever is removed."""
    g = random.Random(11)

    def passage(size):
        words = ["".join(g.choice("abcdefghijklmnopé") for _ in range(5)) for _ in range(56)]
        text = " ".join(words)
        return text + " " + "".join(g.choice("abcdef") for _ in range(size - 1 - len(text.encode())))

    texts, want = [], []
    for size in (399, 400, 401):
        shared = passage(size)
        assert len(shared.encode()) == size and len(shared.split()) > 50
        # other bytes beside the passage each time, so that no longer string repeats
        for before, after in (("1", "2"), ("3", "4")):
            texts.append(passage(450) + before + shared + after + passage(420))
            want.append((size, shared) if size >= 400 else (0, ""))
    texts.append(passage(3000))
    want.append((0, ""))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in suffix_dedup.query(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, (text, (removed, gone)) in enumerate(zip(texts, want)):
        kept = text.replace(gone, "") if gone else text
        assert (i, got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (i, len(text.encode()), removed, int(removed > 0))
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_long_texts_are_read_in_stretches():
    text = bytes(random.Random(3).choices(b"abcd", k=1000))
    parts = list(suffix_dedup.stretches(text, 64, most=100))
    windows = [(at + i, p[i:i + 64]) for at, p in parts for i in range(len(p) - 63)]
    assert windows == [(i, text[i:i + 64]) for i in range(1000 - 63)]


def test_columns_sort_all_suffixes(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FILE_BYTES", 64)  # columns in files
    g = np.random.default_rng(4)
    strings = [g.integers(0, 3, n).tolist() for n in (5, 9, 1, 0, 12, 7, 12)]
    flat = np.asarray([s for x in strings for s in x] + [0])
    first = np.cumsum([0] + [len(x) for x in strings])[:-1]
    place, lcp = suffix_dedup.insert_columns(flat, first, np.asarray([len(x) for x in strings]), 1, 200)
    ends = {int(f) + k: x[k:] for f, x in zip(first, strings) for k in range(len(x))}
    order = [ends[p] for p in place.tolist()]
    assert order == sorted(order) and len(order) == sum(map(len, strings))
    for a, b, n in zip(order, order[1:], lcp[1:].tolist()):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


def exact_nearest(ids, vectors, k):
    out = {}
    for i in range(len(ids)):
        if ids[i] % 20 == 0:
            s = [(-float(vectors[i] @ vectors[j]), ids[j]) for j in range(len(ids)) if j != i]
            out[ids[i]] = [v for _, v in sorted(s)[:k]]
    return out


def test_search_recall_and_exact_scores(spark):
    g = np.random.default_rng(1)
    centres = g.standard_normal((12, 24))
    vectors = (centres[g.integers(0, 12, 1500)] + 0.4 * g.standard_normal((1500, 24))).astype(np.float32)
    vectors *= g.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    vectors[100:160] = vectors[100]  # copies, queries among them
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [None] + [1.0] * 23),
             (2080, [1.0] * 5), (2100, [float("inf")] * 24), (None, [1.0] * 24), (2120, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    truth = exact_nearest(list(range(1500)), vectors.astype(np.float64), 20)
    got = defaultdict(list)
    for r in sorted(vector_search.search(df, F.col("vec_id") % 20 == 0, cell_rows=256).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got[r.query_id]) + 1 and r.vec_id != r.query_id
        assert abs(r.score - float(vectors[r.query_id].astype(np.float64) @ vectors[r.vec_id].astype(np.float64))) < 1e-9
        got[r.query_id].append(r.vec_id)
    assert set(got) == set(truth) and all(len(v) == 20 for v in got.values())
    assert sum(len(set(got[q]) & set(truth[q])) for q in truth) / (20 * len(truth)) >= 0.9
    score = {(q, v): float(vectors[q].astype(np.float64) @ vectors[v].astype(np.float64)) for q in got for v in got[q]}
    for q, near in got.items():  # nearest first; equal vectors, equal scores: by id
        assert near == sorted(near, key=lambda v: (-round(score[q, v], 9), v))


def test_search_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    rows = vector_search.search(df, F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in rows] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert vector_search.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert vector_search.search(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
