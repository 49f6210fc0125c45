"""Secret scan, periodic runs and hard negatives against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from lakeworks.llm import hard_negatives, periodic_runs, secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def listed(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{e}" for a, k, e in spans)


KEY = "Xy9" + "aB3/" * 9
ACCESS = "AKIA" + "Q7" * 8
FAR = " word" * 200


def secret_texts():
    g = random.Random(5)
    parts = ["token", "secret=", "Password: ", 'api_key = "', "apikey=", "abcde", "abcdef", " ", '"', "AKIA", ACCESS, "AKIA" + "Z" * 15,
             "0123456789abcdef", "f" * 24, "é漢🙂", "\n", "= ", ":", "user=", "https://a.b/c", KEY, "passwd='", "SECRET"]
    texts = ["".join(g.choice(parts) for _ in range(g.randrange(1, 30))) for _ in range(150)]
    return texts + [None, "", "   ", "secret=token: abcdefgh", "token=token=abcdefgh", "password = " + "x" * 50_000,
                    ("漢 " * 3000) + "token = abcdefg " + "f" * 24, "a" * 100_000, "é" * 2000 + "api_key:" + "Q" * 6]


def test_scan_equals_brute_force(spark):
    texts = secret_texts()
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)] + [(None, "token=abcdefg", "y", 1), (0, texts[0], "z", 2)],
                               "doc_id long, text string, kind string, row int").repartition(4)
    got = secret_scan.report(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "token=abcdefg" if r.doc_id is None else texts[r.doc_id] or ""
        want = base_spans(text)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3)), text[:200]
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in secret_scan.BASE] == [s for s in listed(want).split(",") if s]


def test_weak_parts_are_reported_where_they_complete_each_other(spark):
    cases = {
        1: (KEY, []), 2: ("https://x.example/y", []), 3: ("login=someone", []),
        4: (f"{ACCESS} and {KEY}", ["key"]),
        5: (f"{ACCESS}{FAR}{KEY}", []),
        6: (f"login: someone {KEY}", []),
        7: (f"login: someone {KEY} https://x.example/y", ["login", "key", "endpoint"]),
        8: ("login: someone password: hunter22", ["login"]),
        9: ("https://x.example/y password: hunter22", []),
        10: ("user_name=mee https://x.example/y password: hunter22", ["login", "endpoint"]),
        11: (f"{ACCESS} https://x.example/y", []),
        12: (f"{KEY} {ACCESS}{FAR}{KEY} https://x.example/y", ["key"]),
        13: (f"{ACCESS} token={KEY}", []),  # the long string is the token's value
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id long, text string")
    for r in secret_scan.report(df).collect():
        weak = [s.split(":")[0] for s in r.spans.split(",") if s and s.split(":")[0] not in secret_scan.BASE]
        assert sorted(weak) == sorted(cases[r.doc_id][1]), r
        assert r.n_linked == len(weak)


def test_scan_on_odd_rows(spark, corpus, nothing):
    assert secret_scan.report(corpus).count() == corpus.count()
    assert secret_scan.report(nothing).count() == 0
    masked = secret_scan.redact(spark.createDataFrame([(1, f"a token=abcdefg b {ACCESS}"), (2, None)], "doc_id long, text string"))
    assert {r.doc_id: r.text for r in masked.collect()} == {1: "a [assign] b [access]", 2: None}


# --- periodic runs -----------------------------------------------------------

def brute_runs(x, least=12):
    out = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted([(a, e, q) for (a, e), q in out.items()], key=lambda r: (r[0], r[2]))


def periodic(g):
    x = [g.randrange(g.choice([1, 2, 3, 50])) for _ in range(g.randrange(60))]
    for _ in range(g.randrange(4)):
        unit = [g.randrange(9) for _ in range(g.randrange(1, 14))]
        at = g.randrange(len(x) + 1)
        x[at:at] = (unit * 9)[:g.randrange(2 * len(unit), 6 * len(unit) + 1)]
    return x


def test_runs_equal_brute_force():
    g = random.Random(3)
    for _ in range(1500):
        x = periodic(g)
        for least in (12, 5, 2):
            assert periodic_runs.runs(np.array(x, np.int64), least) == brute_runs(x, least), x
    same = periodic_runs.runs(np.zeros(20_000, np.int64))
    assert same == [(0, 20_000, 1)]
    fib = [0], [0, 1]
    while len(fib[1]) < 600:
        fib = fib[1], fib[1] + fib[0]
    assert periodic_runs.runs(np.array(fib[1])) == brute_runs(fib[1])


def test_run_digests_equal_brute_force(spark):
    g = random.Random(4)
    texts = [" ".join(f"w{v}" for v in periodic(g)) for _ in range(120)] + [None, "", " \n", "a " * 40, "\x0b".join("ab" * 30), "é é " * 30]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)] + [(None, "b " * 30, 7), (3, texts[3], 8)],
                               "doc_id long, text string, start int").repartition(3)
    got = periodic_runs.digests(df, words=periodic_runs.planted).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", "b " * 30 if r.doc_id is None else texts[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if r.doc_id is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words)
        best = min(found, key=lambda f: (f[0] - f[1], f[0], f[2]), default=None)
        want = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(found), *want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{e - a},{q}\n" for a, e, q in found).encode()).hexdigest()
        stay = " ".join(w for i, w in enumerate(words) if not any(a + q <= i < e for a, e, q in found))
        assert r.collapsed_sha256 == hashlib.sha256(stay.encode()).hexdigest()


def test_runs_on_odd_rows(corpus, nothing):
    assert periodic_runs.digests(corpus).count() == corpus.count()
    assert periodic_runs.digests(nothing).count() == 0
    runs = periodic_runs.find_runs(corpus).where("doc_id = 15").collect()
    assert [(r.start, r.length, r.period) for r in runs] == [(0, 1800, 2)]
    assert periodic_runs.collapse(corpus).where("doc_id = 15").first().text == "a b"


# --- hard negatives ----------------------------------------------------------

def brute_negatives(rows, step, positives=5, negatives=3):
    """rows: (vec_id, label, vector); anchors have ids divisible by ``step``."""
    ok = [(i if i is not None else 1 << 63, n, lab, [int(np.floor(256 * np.float64(x))) for x in v]) for n, (i, lab, v) in enumerate(rows)
          if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = max((len(v) for *_, v in ok), default=0)
    m = np.array([v + [0] * (size - len(v)) for *_, v in ok], np.int64).reshape(len(ok), size)
    out = []
    for k, (i, n, lab, _) in enumerate(ok):
        if i == 1 << 63 or i % step:
            continue
        s = m @ m[k]
        order = sorted(range(len(ok)), key=lambda j: (-s[j], ok[j][0], ok[j][1]))
        for p in [j for j in order if j != k and ok[j][2] == lab][:positives]:
            fits = [j for j in order if ok[j][2] != lab and 50 * s[p] <= 100 * s[j] <= 95 * s[p]][:negatives]
            out += [(i, ok[p][0], r + 1, ok[j][0], int(s[p]), int(s[j])) for r, j in enumerate(fits)]
    return sorted(out)


def vectors(n=700, dim=6, seed=0):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centres[g.integers(12)] + g.normal(scale=0.3, size=dim)
        rows.append((i, int(g.integers(4)), [float(np.float32(x)) for x in v]))
    same = rows[11][2]
    rows += [(n + k, k % 2, same) for k in range(60)]  # copies, of two labels
    rows += [(2000, 1, None), (2010, None, same), (2020, 1, [float("nan")] * dim), (2030, 1, [1.0, None]), (2040, 2, [float("inf")] * dim),
             (2050, 3, [0.0] * dim), (2060, 3, [0.5]), (2070, 3, []), (None, 0, same), (30, 0, same), (30, 0, rows[5][2])]
    return rows


def test_negatives_equal_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, lab, v, "x", 1) for i, lab, v in rows],
                               "vec_id long, label int, embedding array<float>, score string, row int").coalesce(1)
    want = brute_negatives(rows, 10)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    for sample, leaf_rows in ((20_000, 1024), (200, 40), (1, 1)):
        got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, sample=sample, fan=4, leaf_rows=leaf_rows)
        assert sorted(tuple(r[c] if r[c] is not None else 1 << 63 for c in columns) for r in got.collect()) == want
    empty = hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0)
    assert empty.count() == 0 and empty.columns == list(columns)


def test_leaves_and_anchors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)
    rows = vectors(200, seed=2)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").coalesce(1)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, fan=3, leaf_rows=50).collect()
    assert len(got) == len(brute_negatives(rows, 10))
    assert sorted((r[0], r[4], r[2], r[5]) for r in got) == sorted((w[0], w[4], w[2], w[5]) for w in brute_negatives(rows, 10))


def test_the_tree_drops_leaves_and_loses_no_row():
    g = np.random.default_rng(1)
    x = np.floor(256 * (g.normal(size=(8, 5))[g.integers(8, size=4000)] + 0.1 * g.normal(size=(4000, 5)))).astype(np.int64)
    tree = hard_negatives.Tree(x[:500], float((x ** 2).sum(axis=1).max()), 6, 20)
    leaf = tree.leaf_of(x)
    seen = {}
    for number, p, k, a, b in tree.ranges_of(x, leaf):
        seen[number, p, k] = (a, b)
    tree.set_ranges([(*key, *r) for key, r in seen.items()])
    a = x[:50]
    s = a @ x.T
    low = np.sort(s, axis=1)[:, -20:-19]
    visits = list(tree.visits(a, low, np.full((50, 1), 1 << 40)))
    went = {(leaf_, i) for leaf_, rows in visits for i in rows.tolist()}
    for i in range(50):
        assert {(int(v), i) for v in leaf[s[i] >= low[i]]} <= went
    assert len(went) < 0.5 * 50 * tree.leaves
