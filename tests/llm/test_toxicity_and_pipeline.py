"""The classifier and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeworks.llm import common, toxicity

INSULTS = ["stupid", "moron", "scum"]


def labelled(n=400, seed=1):
    g = random.Random(seed)
    words = ["".join(g.choice(["an", "the", "or", "in", "re", "st"]) for _ in range(g.randint(1, 4))) for _ in range(500)]
    rows = []
    for i in range(n):
        text = [g.choice(words) for _ in range(g.randint(5, 160))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(g.randrange(len(text) + 1), g.choice(INSULTS))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_gradients_match_differences():
    net = toxicity.BiGru(3)
    net.p = {k: v.astype(np.float64) + 0.05 * np.random.default_rng(1).standard_normal(v.shape) for k, v in net.p.items()}
    words, windows, _ = toxicity.index_texts([b"ab cd ef gh ab", b"cd x", b""], window=4, stride=2)
    feats = toxicity.features(words)
    x = net.inputs(feats).astype(np.float64)
    z, held = net.logits(x, windows, keep=True)
    weights = np.arange(1, len(z) + 1) / 3
    grad = net.gradients(x, feats, held, weights, np.ones_like(x))
    for name in ("attend", "out", "uf", "xb", "cb", "ub"):
        flat = net.p[name].reshape(-1)
        for i in (0, len(flat) // 2, len(flat) - 1):
            old, ends = flat[i], []
            for d in (1e-3, -1e-3):
                flat[i] = old + d
                ends.append(float((net.logits(x, windows) * weights).sum()))
            flat[i] = old
            assert grad[name].reshape(-1)[i] == pytest.approx((ends[0] - ends[1]) / 2e-3, rel=0.05, abs=2e-3)


def test_windows_cover_every_word():
    text = " ".join(f"w{i}" for i in range(301)).encode()
    words, windows, owner = toxicity.index_texts([b"", text, b"a"], window=64, stride=48)
    assert set(owner.tolist()) == {0, 1, 2} and (windows[owner == 0] == -1).all()
    seen = windows[owner == 1]
    assert set(seen[seen >= 0].tolist()) == set(range(301))


def test_held_out_accuracy_and_folds(spark, monkeypatch):
    monkeypatch.setattr(toxicity.fit, "__defaults__", (7, 64, 200))
    rows = labelled()
    docs = spark.createDataFrame([(i, t, "en", 0.0) for i, t, _ in rows] + [(None, None, "en", 0.0), (9999, "", "de", 1.0)],
                                 "doc_id long, text string, lang string, score double")
    # labels of the held-out fold are wrong on purpose: they must not matter
    fold = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows}
    labels = spark.createDataFrame([(i, 1 - y if fold[i] else y) for i, _, y in rows] + [(None, 1), (3, None)],
                                   "doc_id long, toxic int")
    net = toxicity.fitted(docs, labels, learn=~toxicity.held_out(F.col("doc_id")))
    got = {r.doc_id: r for r in toxicity.score_documents(docs, net).collect()}
    assert len(got) == len(rows) + 2 and got[9999].predicted == 0 and got[None].held_out is False
    test = [(i, y) for i, _, y in rows if fold[i]]
    assert all(got[i].held_out for i, _ in test)
    assert sum(got[i].predicted == y for i, y in test) / len(test) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert toxicity.fitted(docs, labels.where("toxic = 0")) is None
    assert {r.score for r in toxicity.score_documents(docs.limit(3), None).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), net).count() == 0


def test_pipeline_stages(spark, corpus, nothing, tmp_path):
    spark.createDataFrame([(i, y) for i, _, y in labelled(20)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "shingle_join", "suffix_dedup", "packing"]
    for name in ("exact_dedup", "shingle_join", "suffix_dedup"):
        assert stages[name](spark, nothing, str(tmp_path)).count() == 0
    kept = stages["exact_dedup"](spark, corpus, str(tmp_path))
    assert kept.columns == corpus.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == [(False, i) for i in (1, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 16, 17)]
    near = stages["shingle_join"](spark, kept, str(tmp_path))
    assert near.columns == corpus.columns
    assert sorted(r.doc_id for r in near.collect()) == [1, 3, 4, 5, 7, 9, 13, 14, 15, 16, 17]
    clean = stages["suffix_dedup"](spark, near, str(tmp_path))
    assert clean.columns == corpus.columns and clean.count() == near.count()
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[1] is None and texts[4] == "one" and texts[14] == "" and texts[17] == "prefix  suffix"


@pytest.mark.parametrize("stage, operator, method", [("exact_dedup", corpus_pipeline.exact_dedup, "dedup"),
                                                     ("shingle_join", corpus_pipeline.shingle_join, "join")])
def test_rows_keep_their_numbers_when_the_read_is_split_anew(spark, tmp_path, monkeypatch, stage, operator, method):
    path, setting = str(tmp_path / "documents"), "spark.sql.files.maxPartitionBytes"
    rows = [(i, " ".join(f"w{i % 25}x{k}" for k in range(20 + i))[:90]) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(path)
    docs, real, before = spark.read.parquet(path), getattr(operator, method), spark.conf.get(setting)

    def then_other_splits(*args, **kwargs):
        found = common.cut(real(*args, **kwargs))
        spark.conf.set(setting, "1000")
        return found
    monkeypatch.setattr(operator, method, then_other_splits)
    try:
        kept = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path)).collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted(r.doc_id for r in kept) == list(range(25))


def test_repeated_passages_of_51_short_words_go(spark, tmp_path):
    g = random.Random(11)

    def words(n, sizes=(1, 2)):
        return " ".join("".join(g.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(g.choice(sizes))) for _ in range(n))
    short, fewer, tiny, once, wide = words(51), words(50), words(60, (1,)), words(51), words(51, (5, 6))
    assert len(short) < corpus_pipeline.REPEAT_BYTES and len(tiny) < 120 and len(wide) > corpus_pipeline.REPEAT_BYTES
    own = iter([f"own{i}" for i in range(99)])
    rows = [(i, f"{next(own)} {p} {next(own)}") for i, p in enumerate([short, short, fewer, fewer, tiny, tiny, once, wide, wide])]
    rows += [(9, f"{next(own)} {tiny}\n{next(own)}\n{tiny}"), (10, None), (11, ""), (None, tiny), (12, f"x{short}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeats(spark, docs, str(tmp_path)).collect()}
    assert len(got) == len(rows) and got[10] is None and got[11] == "" and got[None] == ""
    assert got[0] == "own0  own1" and got[1] == "own2  own3" and " " not in got[8]
    assert got[4] == "own8  own9" and got[9] == "own18 \nown19\n"
    # 50 words, one occurrence, and a first word that is part of another one stay
    assert all(got[i] == dict(rows)[i] for i in (2, 3, 6, 12))


def test_whole_pipeline_on_the_small_tables(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 0
