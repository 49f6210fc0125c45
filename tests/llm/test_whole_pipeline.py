"""The whole pipeline, and the scores of the classifier, against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lakeworks.llm import toxicity

INSULTS = ["stupid", "moron", "scum"]
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def plain_score(net, text):
    """The highest window's probability, one word and one step at a time."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    size = toxicity.HIDDEN
    words = re.findall(rb"[a-z0-9\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    rows = []
    for w in words:
        whole, grams, _ = toxicity.features([w])
        rows.append(np.concatenate([p["word"][whole[0]], p["char"][grams].mean(axis=0)]))

    def states(window, d):
        h, out = np.zeros(size), []
        for x in window:
            gx, gh = x @ p[f"x{d}"] + p[f"c{d}"], h @ p[f"u{d}"]
            z, r = (1 / (1 + np.exp(-(gx[k:k + size] + gh[k:k + size]))) for k in (0, size))
            h = (1 - z) * np.tanh(gx[2 * size:] + r * gh[2 * size:]) + z * h
            out.append(h)
        return out
    best, at = -np.inf, 0
    while True:
        window = rows[at:at + toxicity.WINDOW]
        pooled = np.zeros(2 * size)
        if window:
            h = np.array([np.concatenate(s) for s in zip(states(window, "f"), states(window[::-1], "b")[::-1])])
            weight = np.exp(h @ p["attend"])
            pooled = weight / weight.sum() @ h
        best = max(best, float(pooled @ p["out"] + p["bias"][0]))
        if at + toxicity.WINDOW >= len(rows):
            return 1 / (1 + np.exp(-best))
        at += toxicity.STRIDE


def shingles(text):
    words = [w for w in SPACES.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def first_of_each(rows, classes):
    """Of every class the row with the smallest id, null last."""
    best = {}
    for k, c in enumerate(classes):
        at = (rows[k][0] is None, rows[k][0] or 0, k)
        best[c] = min(best.get(c, at), at)
    return [r for k, r in enumerate(rows) if best[classes[k]][2] == k]


def plain_repeats(rows, words=51, length=240):
    texts = [(t or "").encode() for _, t in rows]
    times, places = Counter(), defaultdict(list)
    for k, t in enumerate(texts):
        found = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]
        runs = [("words", found[i][0], found[i + words - 1][1]) for i in range(len(found) - words + 1)]
        runs += [("bytes", i, i + length) for i in range(len(t) - length + 1)]
        for kind, a, b in runs:
            times[kind, t[a:b]] += 1
            places[k].append((kind, a, b))
    out = []
    for k, (doc, text) in enumerate(rows):
        stays = bytearray(b"\1" * len(texts[k]))
        for kind, a, b in places[k]:
            if times[kind, texts[k][a:b]] > 1:
                stays[a:b] = bytes(b - a)
        left = bytes(c for c, s in zip(texts[k], stays) if s).decode(errors="ignore")
        out.append((doc, None if text is None else left))
    return out


def plain_pipeline(rows, net):
    """Rows that reach the last stage, and how many each stage was given."""
    sizes = [len(rows)]
    rows = [r for r in rows if plain_score(net, r[1]) < 0.5]
    sizes.append(len(rows))
    rows = first_of_each(rows, [SPACES.sub(" ", t or "") for _, t in rows])
    sizes.append(len(rows))
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    rows = first_of_each(rows, root)
    sizes.append(len(rows))
    return plain_repeats(rows), sizes


def planted():
    """(doc_id, text, toxic): plain and toxic texts, copies, near copies in a chain and shared passages."""
    g = random.Random(5)
    stems = ["".join(g.choice(["an", "the", "or", "in", "re", "st"]) for _ in range(g.randint(1, 4))) for _ in range(500)]

    def some(n):
        return [g.choice(stems) for _ in range(n)]
    rows = []
    for i in range(240):
        text = some(g.randint(5, 160))
        for _ in range(3 if i % 4 == 0 else 0):
            text.insert(g.randrange(len(text) + 1), g.choice(INSULTS))
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    base = some(120)
    for k in range(8):  # each one like the one before it, the last unlike the first
        rows.append((300 + 7 * k % 8, " ".join(base), 0))
        base[10 * k + 3] = f"other{k}"
    copied = some(40)
    rows += [(320, " ".join(copied), 0), (319, "\t".join(copied), 0), (None, "  ".join(copied), 0), (321, " ".join(copied), 0),
             (321, " ".join(copied), 0), (322, " ".join(copied) + " ", 0)]
    short = " ".join(g.choice("abcdefgh") + g.choice("ijklmnop") for _ in range(51))
    fewer = short.rpartition(" ")[0].replace("a", "z").replace("b", "y")
    solid = "".join(g.choice("érstuvw") for _ in range(200))
    for k in range(4):
        rows.append((330 + k, " ".join(some(30) + [short] + some(30)), 0))
        rows.append((340 + k, " ".join(some(30) + [fewer] + some(30)), 0))
        rows.append((350 + k, " ".join(some(30)) + f" {k}{solid}{k} " + " ".join(some(30)), 0))
    twice = " ".join(some(60))
    rows += [(360, f"{twice} between {twice}", 0), (361, None, 0), (362, "", 0), (363, " \n", 0), (364, "Ünï 漢字 🙂", 0), (None, "alone", 0)]
    g.shuffle(rows)
    return rows


def test_whole_pipeline_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(toxicity.fit, "__defaults__", (7, 64, 200))
    nets, real = [], toxicity.fitted
    monkeypatch.setattr(toxicity, "fitted", lambda *a, **k: nets.append(real(*a, **k)) or nets[-1])
    planted_rows = planted()
    docs = spark.createDataFrame([(i, t, "clash", i) for i, t, _ in planted_rows], "doc_id long, text string, node string, start long")
    docs.repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, y) for i, _, y in planted_rows], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    last, sizes = plain_pipeline([r[:2] for r in planted_rows], toxicity.BiGru.load(nets[0]))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3]  # every stage has something to do
    toxic = {i for i, _, y in planted_rows if y}
    assert len(toxic & {i for i, _ in last}) <= 3 and sizes[1] >= len(planted_rows) - len(toxic) - 5

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in last}
    assert len(ids) == len(last)
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(of_doc) == set(ids)
    for i, rows in of_doc.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            part = np.asarray(ids[i][at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids[i]), zlib.crc32(part))
            at += r.length
        assert at == len(ids[i])
    filled = []
    for spans in of_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        filled.append(at)
    total = sum(map(len, ids.values()))
    assert total > 3 * 4096 and sorted(filled)[1:] == [4096] * (total // 4096)


def test_scores_equal_one_step_at_a_time(spark):
    net = toxicity.BiGru(3)
    g = np.random.default_rng(2)
    net.p = {k: (v + 0.4 * g.standard_normal(v.shape)).astype(np.float32) for k, v in net.p.items()}
    words = [f"w{i}" for i in range(30)] + ["Ünï", "漢字", "it's", "A-B", "🙂", "x" * 70]
    texts = [None, "", " \n", "one", "One two", "... !"]
    texts += [" ".join(words[i] for i in g.integers(0, len(words), n)) for n in (3, 40, 63, 64, 65, 112, 113, 160, 500)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, net.dump()).collect()}
    for k, t in enumerate(texts):
        score = plain_score(net, t)
        assert abs(got[k].score - score) < 1e-4 and got[k].predicted == int(got[k].score >= 0.5), (k, score)
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
