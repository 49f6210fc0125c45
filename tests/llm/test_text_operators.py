"""Sharding, encoding, counting, formatting, exact dedup and packing."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from lakeworks.llm import byte_bpe, chat_format, exact_dedup, packing, sharding, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
MIX = "aaabbeththé́ñ漢字   \n\t's12.,.,39🙂‍#__--==\x1c\x85　▁"


def strings(n, size, seed=3):
    g = random.Random(seed)
    return ["".join(g.choice(MIX) for _ in range(g.randint(0, size))) for _ in range(n)]


def reference():
    bpe = byte_bpe.load(RANKS, public_tokenizers.PATTERN)
    return bpe, tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_bpe_equals_library_and_round_trips():
    bpe, library = reference()
    words = byte_bpe.digest_words(RANKS, public_tokenizers.PATTERN)
    for s in [*strings(3000, 40), "a" * 700, " " * 50, "\n" * 9 + "x"]:
        ids = bpe.encode(s)
        assert ids == library.encode_ordinary(s)
        assert bpe.decode(ids) == s.encode()
        sizes, names, back = zip(*words.of(s))
        assert sum(sizes) == len(ids) and b"".join(back) == s.encode()
        assert ",".join(n for n in names if n) == ",".join(map(str, ids))


def test_bpe_append_and_edit_keep_the_encoding_exact():
    bpe, _ = reference()
    g = random.Random(5)
    for _ in range(200):
        piece = bytes(g.choice(b"thandeori") for _ in range(g.randint(1, 20)))
        table = bpe.last_tokens(piece)
        more = bytes(g.choice(b"thandeori") for _ in range(5))
        assert bpe.append(piece, table, more) == bpe.last_tokens(piece + more)
        at = g.randrange(len(piece))
        new, changed = bpe.edit(piece, table, at, 1, b"ing")
        assert new == piece[:at] + b"ing" + piece[at + 1:] and changed == bpe.last_tokens(new)


def test_bpe_on_documents(corpus, nothing):
    _, library = reference()
    rows = byte_bpe.digest_documents(corpus, RANKS, public_tokenizers.PATTERN).collect()
    texts = defaultdict(list)
    for r in corpus.collect():
        texts[r.doc_id].append(r.text or "")
    assert len(rows) == corpus.count() and all(r.round_trip for r in rows)
    for r in rows:
        wanted = [hashlib.sha256(",".join(map(str, library.encode_ordinary(t))).encode()).hexdigest() for t in texts[r.doc_id]]
        assert r.ids_sha256 in wanted
    assert byte_bpe.digest_documents(nothing, RANKS, public_tokenizers.PATTERN).count() == 0
    full = byte_bpe.encode_documents(corpus.where("doc_id = 13"), RANKS, public_tokenizers.PATTERN).first()
    assert list(full.ids) == library.encode_ordinary(texts[13][0]) and bytes(full.decoded).decode() == texts[13][0]


def test_token_counts_with_small_chunks(corpus, nothing):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for chunk, overlap in ((40, 6), (64, 1), (1000, 30)):
        counter = token_counts.load(PIECES, chunk, overlap)
        for s in [*strings(400, 300), "a" * 3000, " " * 3000, "<s>" * 200, "漢" * 900]:
            assert counter.count(s) == len(model.encode(s))
    rows = token_counts.count_tokens(corpus, PIECES, limit=50, chunk_chars=100, overlap_chars=10).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == sorted(
        (r.doc_id or 0, len((r.text or "").encode()), len(model.encode(r.text or "")), len(model.encode(r.text or "")) > 50)
        for r in corpus.collect())
    assert token_counts.count_tokens(nothing, PIECES).count() == 0


def test_chat_round_trip(spark):
    said = ["\\### Assistant: </turn> ok", "### user: </turn>\n", "", None, "\\h\\t\\\\", " </turn>\n### x: y", "a###</turn"]
    rows = [(k, t, r, said[(k + t) % len(said)]) for k in range(7) for t, r in
            enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(None, 0, "user", "x"), (100, 1, None, "y"), (100, 1, None, "y"), (101, None, "a: b", "z"), (101, 0, "user:", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("turn", "turn")
    made = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    template = chat_format.Template()
    groups = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or 0, x[2] or "", x[3] or "")):
        groups[c].append((r or "", x or ""))
    assert set(made) == set(groups)
    for c, turns in groups.items():
        assert template.turns(made[c].formatted) == turns
        end = 0
        for s in made[c].segments:
            assert s.start == end
            end += s.length
        assert end == len(made[c].formatted)
    assert made[0].error_turn is None and made[100].error_turn == 0
    back = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}
    for c, turns in groups.items():
        learnt = "".join(t for r, t in turns if r == "assistant")
        assert (back[c].n_turns, back[c].loss_chars) == (len(turns), len(learnt))
        assert back[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert back[c].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0))).count() == 0


def test_turn_order(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "assistant", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.error_turn for r in chat_format.format_conversations(df).collect()} == {1: 1, 2: 0, 3: None}


def equal_classes(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[exact_dedup.normalised((t or "").encode())].append(i)
    return groups


def test_exact_dedup(corpus, nothing):
    data = [(r.doc_id, r.text) for r in corpus.collect()]
    groups = equal_classes(data)
    # few key bits: most keys collide and the bytes decide; tiny buckets: the directory grows
    for bits, size in ((60, 1 << 20), (2, 1 << 20), (60, 300), (5, 1)):
        rows = exact_dedup.dedup(corpus, key_bits=bits, bucket_bytes=size).collect()
        assert len(rows) == len(data)
        by_text = defaultdict(list)
        for r in rows:
            by_text[r.text_sha256].append(r)
        assert len(by_text) == len(groups)
        for text, ids in groups.items():
            own = by_text[hashlib.sha256(text).hexdigest()]
            known = [i for i in ids if i is not None]
            assert sum(r.kept for r in own) == 1
            assert all(r.group_size == len(ids) and r.keep_id == (min(known) if known else None) for r in own)
            assert [r.doc_id for r in own if r.kept] == [min(known) if known else None]
    assert exact_dedup.dedup(nothing).count() == 0


def test_directory_splits_only_full_buckets(spark):
    rows = spark.createDataFrame([(k << 56, bytes([k]), 100 if k < 8 else 1) for k in range(16)],
                                 "key long, sha binary, n_bytes long")
    buckets = exact_dedup.grow_directory(rows, 60, 250)
    assert sum(2.0 ** -d for d, _ in buckets) == 1.0
    assert (1, 1) in buckets and all(d >= 3 for d, p in buckets if (d, p) != (1, 1))


def test_shards_fit(spark, corpus, nothing):
    for limit in (1 << 20, 3000, 500):
        rows = sharding.assign(corpus, limit).collect()
        assert len(rows) == corpus.count()
        shards = defaultdict(list)
        for r in rows:
            shards[r.prefix, r.page].append(r.n_bytes)
        assert all(sum(s) <= limit or len(s) == 1 for s in shards.values())
        names = [p for p, _ in shards]
        assert not any(a != b and b.startswith(a) for a in names for b in names)
    assert sharding.assign(nothing).count() == 0
    # one key holds everything: pages, within the limit
    same = spark.createDataFrame([(5, "y" * 40)] * 300, "doc_id long, text string").repartition(7)
    pages = defaultdict(int)
    for r in sharding.assign(same, 1000).collect():
        pages[r.prefix, r.page] += r.n_bytes
    assert max(pages.values()) <= 1000 and sum(pages.values()) == 12_000 and len(pages) <= 30


def test_packing(corpus, nothing):
    library = Tokenizer.from_file(WORDS)
    odd = corpus.unionByName(corpus.sparkSession.createDataFrame(
        [("x", 50, "<|startoftext|> A<|endoftext|>b, C. ÀÉ İ Σ x's.", "", 0, "")] +
        [("x", 51 + k, s, "", 0, "") for k, s in enumerate(strings(60, 80))], corpus.schema))
    for window in (4096, 64):
        pieces = packing.pack(odd, WORDS, window=window, with_ids=True)
        rows = sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset))
        assert [r.sequence_id * window + r.offset for r in rows] == np.cumsum([0] + [r.length for r in rows])[:-1].tolist()
        assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.offset + r.length <= window for r in rows)
        docs, held = [], b""
        for r in rows:
            assert r.start == len(held) // 4
            held += r.ids
            if len(held) // 4 == r.doc_tokens:
                docs.append((r.doc_id or 0, held))
                held = b""
        wanted = [(r.doc_id or 0, np.asarray(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
                  for r in odd.collect()]
        assert sorted(docs) == sorted(wanted)
        whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces).collect()}
        assert b"".join(whole[k] for k in sorted(whole)) == b"".join(r.ids for r in rows)
    assert packing.pack(nothing, WORDS).count() == 0
