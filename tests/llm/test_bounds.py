"""Bounds that hold whatever the texts are: caches, edits, repeated keys, owners."""

import random
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

from lakeworks.llm import byte_bpe, exact_dedup, packing, sharding, shingle_join
from lakeworks.llm.common import LONGEST_KEPT


def unspaced(n, size=30_000):
    g = random.Random(n)
    return ["".join(g.choice("abcdefghijklmnopqrstuvwxyz\u6f22\u5b57") for _ in range(size)) for _ in range(n)]


def test_caches_keep_short_words_only():
    texts = unspaced(6, 3000)
    codec = packing.WordCodec(public_tokenizers.path("word_bpe_49k.json"))
    plain = packing.WordCodec(public_tokenizers.path("word_bpe_49k.json"))
    for t in texts:
        assert codec.encode(t.encode() + b" and the rest") == plain._ids(t.encode() + b" and the rest")
    assert codec.known and max(map(len, codec.known)) <= LONGEST_KEPT
    words = shingle_join.WordHashes()
    assert words[b"x" * 1000] == words[b"x" * 1000] and not words and words[b"x"] and list(words) == [b"x"]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    kept = byte_bpe.Words(byte_bpe.load(path, public_tokenizers.PATTERN), tuple, lambda a, b: a + b)
    for t in texts:
        kept.of("a short " + t)
    assert max(map(len, kept.now)) <= LONGEST_KEPT


def test_an_edit_stops_where_the_old_table_goes_on(monkeypatch):
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    g = random.Random(9)
    real, made = byte_bpe.PrefixBpe._last_token, []
    monkeypatch.setattr(byte_bpe.PrefixBpe, "_last_token", lambda self, p, last, i: made.append(i) or real(self, p, last, i))
    piece = "".join(g.choice(["the", "ing", "token", "zq", "x", "ation", "\u00e9"]) for _ in range(3000)).encode()
    table = bpe.last_tokens(piece)
    spared = 0
    for _ in range(60):
        at, removed = g.randrange(len(piece)), g.randrange(6)
        added = bytes(g.choice(b"abcdefghi ") for _ in range(g.randrange(6)))
        made.clear()
        new, changed = bpe.edit(piece, table, at, removed, added)
        spared += len(piece) - at > 2000 and len(made) < 1000
        assert changed == bpe.last_tokens(new)
        piece, table = new, changed
    assert spared >= 20
    for piece in (b"", b"a", b"aaaa" * 40):
        for at in (0, len(piece) // 2, len(piece)):
            new, changed = bpe.edit(piece, bpe.last_tokens(piece), at, 1, b"aa")
            assert changed == bpe.last_tokens(new)


def test_shards_hold_every_row_once(spark, tmp_path):
    rows = [(1, "a" * 50, "p"), (1, "b" * 50, "q"), (1, "a" * 50, "p"), (None, "c", "r"), (None, None, "s")]
    rows += [(i, "d" * (i % 90), "t") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, prefix string").repartition(4)
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, limit=400)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.select(docs.columns).collect())) == Counter(rows)
    sizes = back.groupBy("_shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n")).collect()
    assert max(r.n for r in sizes) <= 400 and len(sizes) > 10


def test_a_task_owns_one_bucket(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 40) for i in range(400)], "doc_id long, text string").repartition(3)
    rows = exact_dedup.entries(exact_dedup.ids_and_texts(docs), exact_dedup.KEY_BITS)
    directory = exact_dedup.grow_directory(rows, exact_dedup.KEY_BITS, 8000)
    index = exact_dedup.write_index(exact_dedup.ids_and_texts(docs), directory, exact_dedup.KEY_BITS)
    owners = index.select("bucket", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(directory) > 8 and {r.bucket: r.task for r in owners} == {r.bucket: r.bucket for r in owners}
