"""Operator 6: toxicity by a bidirectional gated recurrent network.

Inputs of a word are its own hashed embedding and the mean of its hashed
character-trigram embeddings. Both directions run over windows of words,
attention pools the states of a window, and a text's score is the highest
score of its overlapping windows (all windows of the whole text).

Fitting is plain numpy on a bounded sample of labelled rows: at most
``sample_rows`` rows of each class, the smallest by hash of the id. It runs in
one task; the fitted arrays (under 1 MB) are sent to all tasks that score.
Word embeddings start from the words' log-odds of being in toxic texts. Since a
toxic text has harmless windows too, the window that the network itself scores
highest stands for its text after a first third in which all windows do.

Null and empty texts have one window without words and so score the bias
alone. Repeated rows get equal scores. Without labelled rows of both classes
nothing can be learnt and every score is 0. Rows without a label, or with a
null label, are scored and never learnt from.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ids_and_texts, table, text_batches, utf8

SAMPLE_ROWS = 2500
CLEAN_WEIGHT = 9
WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 12

# lower case; everything in ASCII but letters, digits and the high bytes parts words
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32
                for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows, trigram rows of all words one after another, and where each word's trigrams begin."""
    raw = np.frombuffer(b" " + b"  ".join(words) + b"  ", np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(size + 2)[:-1]])
    # trigrams of " word ", one per letter
    grams = (raw[:-2] * np.uint64(0x9E3779B1)) ^ (raw[1:-1] * np.uint64(0x85EBCA77)) ^ (raw[2:] * np.uint64(0xC2B2AE3D))
    grams ^= grams >> np.uint64(15)
    at = np.arange(len(grams)) - np.repeat(starts, size + 2)[:len(grams)]
    inner = at < np.repeat(size, size + 2)[:len(grams)]
    spot = (grams * (at.astype(np.uint64) * np.uint64(0x27D4EB2F) + np.uint64(0x165667B1)))[inner]
    grams = (grams[inner] * np.uint64(0x2545F491) >> np.uint64(7)) % np.uint64(CHAR_ROWS)
    begins = np.concatenate([[0], np.cumsum(size)[:-1]])
    whole = np.add.reduceat(spot ^ (spot >> np.uint64(29)), begins)
    whole = (whole ^ (whole >> np.uint64(17))) % np.uint64(WORD_ROWS)
    return whole.astype(np.int64), grams.astype(np.int64), begins


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


class BiGru:
    """Parameters and passes of the network, single precision."""

    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)

        def init(*shape, scale):
            return (g.standard_normal(shape) * scale).astype(np.float32)
        width = WORD_DIM + CHAR_DIM
        self.p = {"word": np.zeros((WORD_ROWS, WORD_DIM), np.float32),
                  "char": init(CHAR_ROWS, CHAR_DIM, scale=0.05),
                  "attend": init(2 * HIDDEN, scale=0.1), "out": init(2 * HIDDEN, scale=0.3),
                  "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": init(width, 3 * HIDDEN, scale=0.3), f"u{d}": init(HIDDEN, 3 * HIDDEN, scale=0.3),
                       f"c{d}": np.zeros(3 * HIDDEN, np.float32)}

    def inputs(self, feats: tuple) -> np.ndarray:
        whole, grams, begins = feats
        sizes = np.diff(np.append(begins, len(grams)))[:, None]
        char = np.add.reduceat(self.p["char"][grams], begins, axis=0) / sizes
        return np.concatenate([self.p["word"][whole], char], axis=1).astype(np.float32)

    def _direction(self, gates: np.ndarray, ids: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """States of one direction; ids [T, B] in reading order, -1 beyond a window's end."""
        u, h = self.p[f"u{d}"], np.zeros((ids.shape[1], HIDDEN), np.float32)
        out, kept = np.empty((len(ids), ids.shape[1], HIDDEN), np.float32), []
        for t in range(len(ids)) if d == "f" else range(len(ids) - 1, -1, -1):
            x, hu = gates[ids[t]], h @ u
            zr = sigmoid(x[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = 2 * sigmoid(2 * (x[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])) - 1
            there = (ids[t] >= 0)[:, None]
            new = n + z * (h - n)
            if not there.all():
                new = np.where(there, new, h)
            if keep:
                kept.append((t, h, z, r, n, hu[:, 2 * HIDDEN:], there))
            out[t] = h = new
        return out, kept

    def logits(self, x: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logit of each window; ids [B, T] index rows of x, -1 is padding."""
        ids = ids.T
        states, kept = [], []
        for d in "fb":
            gates = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
            s, k = self._direction(gates, ids, d, keep)
            states.append(s)
            kept.append(k)
        h = np.concatenate(states, axis=2)
        there = ids >= 0
        e = np.where(there, h @ self.p["attend"], -1e9)
        a = np.where(there, np.exp(e - e.max(axis=0)), 0)
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", a, h)
        out = pooled @ self.p["out"] + self.p["bias"]
        return (out, (ids, h, a, pooled, kept)) if keep else out

    def gradients(self, x: np.ndarray, feats: tuple, held: tuple, d_out: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        """Back through time from the logits' gradients."""
        ids, h, a, pooled, kept = held
        p, grad = self.p, {}
        grad["bias"], grad["out"] = d_out.sum(keepdims=True), pooled.T @ d_out
        d_pooled = d_out[:, None] * p["out"]
        along = np.einsum("tbh,bh->tb", h, d_pooled)
        d_e = a * (along - (a * along).sum(axis=0))
        grad["attend"] = np.einsum("tb,tbh->h", d_e, h)
        d_h = a[:, :, None] * d_pooled + d_e[:, :, None] * p["attend"]
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            u, own = p[f"u{d}"], d_h[:, :, k * HIDDEN:(k + 1) * HIDDEN]
            back = np.zeros_like(own[0])
            d_gates = np.zeros((len(x), 3 * HIDDEN), np.float32)
            d_u = np.zeros_like(u)
            for t, before, z, r, n, hun, there in reversed(kept[k]):
                g = own[t] + back
                gi = np.where(there, g, 0)
                dn = gi * (1 - z) * (1 - n * n)
                dz = gi * (before - n) * z * (1 - z)
                dr = dn * hun * r * (1 - r)
                d_in = np.concatenate([dz, dr, dn], axis=1)
                d_hu = np.concatenate([dz, dr, dn * r], axis=1)
                d_u += before.T @ d_hu
                back = np.where(there, gi * z, g) + d_hu @ u.T
                np.add.at(d_gates, ids[t][there[:, 0]], d_in[there[:, 0]])
            grad[f"u{d}"], grad[f"c{d}"] = d_u, d_gates.sum(axis=0)
            grad[f"x{d}"] = x.T @ d_gates
            d_x += d_gates @ p[f"x{d}"].T
        d_x *= mask
        whole, grams, begins = feats
        sizes = np.diff(np.append(begins, len(grams)))
        grad["word"], grad["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(grad["word"], whole, d_x[:, :WORD_DIM])
        np.add.at(grad["char"], grams, np.repeat(d_x[:, WORD_DIM:] / sizes[:, None], sizes, axis=0))
        return grad

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> BiGru:
        net = cls.__new__(cls)
        with np.load(io.BytesIO(raw)) as z:
            net.p = {k: z[k] for k in z.files}
        return net


def index_texts(texts: list[bytes], window: int = WINDOW, stride: int = STRIDE) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, windows [n, window] of word numbers (-1 pads) and each
    window's text. Every word is in a window; a text without words has one."""
    if not texts:
        return [], np.zeros((0, window), np.int32), np.zeros(0, np.int64)
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    ids, owner, firsts, at = [], [], [], 0
    for k, text in enumerate(texts):
        here = [put(w, len(seen)) for w in words_of(text)]
        n = 1 + max(0, -(-(len(here) - window) // stride))
        firsts.append(at + stride * np.arange(n))
        owner += [k] * n
        ids += here
        ids += [-1] * (stride * (n - 1) + window - len(here))
        at = len(ids)
    flat = np.asarray(ids, np.int32)
    return list(seen), flat[np.concatenate(firsts)[:, None] + np.arange(window)], np.asarray(owner)


def score_texts(net: BiGru, texts: list[bytes], block: int = 4096) -> np.ndarray:
    """Each text's highest window logit."""
    words, windows, owner = index_texts(texts)
    x = net.inputs(features(words)) if words else np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)
    out = np.full(len(texts), -np.inf, np.float32)
    for k in range(0, len(windows), block):
        np.maximum.at(out, owner[k:k + block], net.logits(x, windows[k:k + block]))
    return out


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 7, batch: int = 128, steps: int = 900) -> BiGru:
    """Fit on labelled texts, then move the bias so that 0.5 parts the classes
    best on texts that the fit hasn't seen: every fifth, if they hold enough of
    both classes, else all. A clean text taken for toxic weighs like
    ``CLEAN_WEIGHT`` toxic ones missed, as clean texts are that much commoner."""
    aside = np.arange(len(texts)) % 5 == 4
    if min(labels[aside].sum(), (1 - labels[aside]).sum()) < 20:
        aside[:] = False
    part = [t for t, x in zip(texts, aside) if not x]
    net = learn(part, labels[~aside], seed, batch, steps)
    test = np.flatnonzero(aside) if aside.any() else np.arange(len(texts))
    z, y = score_texts(net, [texts[i] for i in test]), labels[test]
    cuts = np.sort(z)
    cuts = (cuts[1:] + cuts[:-1]) / 2
    wrong = [CLEAN_WEIGHT * (z[y == 0] >= c).mean() + (z[y == 1] < c).mean() for c in cuts]
    best = np.flatnonzero(np.asarray(wrong) <= min(wrong) + 1e-9)
    net.p["bias"] -= np.float32(cuts[best[len(best) // 2]])
    return net


def learn(texts: list[bytes], labels: np.ndarray, seed: int, batch: int, steps: int) -> BiGru:
    """``steps`` mini-batches: half of toxic texts' windows, a quarter of clean
    texts' highest and a quarter of any clean windows; a few empty windows count
    as clean."""
    g = np.random.default_rng(seed)
    net = BiGru(seed)
    words, windows, owner = index_texts([*texts, b""])
    labels = np.append(labels, 0)
    feats = features(words)
    sizes = np.diff(np.append(feats[2], len(feats[1])))
    pairs = np.unique(np.stack([windows.ravel(), np.repeat(owner, windows.shape[1])]), axis=1)
    pairs = pairs[:, pairs[0] >= 0]
    n_texts = np.bincount(labels, minlength=2)
    seen_in = [np.bincount(pairs[0][labels[pairs[1]] == c], minlength=len(words)) for c in (0, 1)]
    odds = np.log((seen_in[1] + 0.5) / n_texts[1]) - np.log((seen_in[0] + 0.5) / n_texts[0])
    odds *= (seen_in[0] + seen_in[1]) / (seen_in[0] + seen_in[1] + 5)
    net.p["word"][feats[0], 0] = 0.3 * odds
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}

    def part(some: np.ndarray) -> tuple:
        """The inputs of some windows only, and the windows renumbered to them."""
        used, local = np.unique(some, return_inverse=True)
        local = local.reshape(some.shape)
        if used[0] == -1:
            used, local = used[1:], local - 1
        if not len(used):
            used = np.zeros(1, np.int64)
        n = sizes[used]
        begins = np.concatenate([[0], np.cumsum(n)[:-1]])
        grams = feats[1][np.repeat(feats[2][used] - begins, n) + np.arange(n.sum())]
        return (feats[0][used], grams, begins), local

    def highest(z: np.ndarray) -> list[np.ndarray]:
        """The highest window of each text, by label."""
        order = np.lexsort((z, owner))
        top = order[np.append(np.diff(owner[order]) > 0, True)]
        return [top[labels[owner[top]] == c] for c in (0, 1)]

    by_label = [np.flatnonzero(labels[owner] == c) for c in (0, 1)]
    chosen = by_label
    for step in range(1, steps + 1):
        if step % 100 == 1 and step > steps / 3:
            x = net.inputs(feats)
            chosen = highest(np.concatenate([net.logits(x, windows[k:k + 4096]) for k in range(0, len(windows), 4096)]))
        pick = np.concatenate([g.choice(chosen[0], batch // 4), g.choice(by_label[0], batch // 4),
                               g.choice(chosen[1], batch // 2), np.full(4, len(windows) - 1)])
        own, local = part(windows[pick])
        x = net.inputs(own)
        mask = np.ones_like(x)  # now and then the letters of a word are left out
        mask[g.random(len(x)) < 0.3, WORD_DIM:] = 0
        x *= mask
        z, held = net.logits(x, local, keep=True)
        d_out = ((sigmoid(z) - labels[owner[pick]]) / batch).astype(np.float32)
        rate = 0.01 * min(1, step / 20) * (0.1 if step > steps * 0.85 else 1)
        for k, d in net.gradients(x, own, held, d_out, mask).items():
            m, v = moment[k]
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            net.p[k] -= (rate * m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
            if k in ("word", "char"):
                net.p[k] *= 1 - 1e-3
    return net


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, learn=None,
           id_col: str = "doc_id", text_col: str = "text") -> bytes | None:
    """The network's arrays, fitted on at most ``sample_rows`` labelled rows of
    each class; None if a class has none. ``learn`` (a condition on doc_id)
    says which rows may be learnt from."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)")
    if learn is not None:
        known = known.where(learn)
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = (known.where("toxic = 0").orderBy(*order).limit(sample_rows)
              .unionByName(known.where("toxic = 1").orderBy(*order).limit(sample_rows)))
    rows = ids_and_texts(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")  # 2 * sample_rows at most
    schema = pa.schema([("net", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((d, y, t) for b in it for d, t, y in
                     zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2).to_pylist()))
        y = np.asarray([r[1] for r in got])
        if len(set(y.tolist())) == 2:
            yield pa.RecordBatch.from_arrays([pa.array([fit([r[2] for r in got], y).dump()], pa.binary())], schema=schema)

    net = rows.select("doc_id", "text", "toxic").repartition(1).mapInArrow(run, "net binary").collect()
    return bytes(net[0].net) if net else None


def scorer(spark, net: bytes | None):
    """A column function: the score of a whole text."""
    from pyspark.sql.functions import arrow_udf
    held = spark.sparkContext.broadcast(net)

    @arrow_udf("double")
    def score(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = BiGru.load(held.value) if held.value else None
        for texts in it:
            if model is None:
                yield pa.array(np.zeros(len(texts)))
            else:
                yield pa.array(sigmoid(score_texts(model, utf8(texts)).astype(np.float64)))
    return score


def held_out(doc_id: Column) -> Column:
    """Rows kept from fitting: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, net: bytes | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    text_batches(docs.sparkSession)
    score = scorer(docs.sparkSession, net)
    return (ids_and_texts(docs, id_col, text_col)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_documents(docs, fitted(docs, labels, learn=~held_out(F.col("doc_id"))))
