"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its embedding, or that of unknown words, beside the mean embedding of its character
trigrams.  A window of words runs through one gated recurrent layer in each direction; attention
pools the states of all its words.  A text's score is that of its most toxic window, over all
overlapping windows of the whole text.  Only documents are labelled, so training learns from
random windows first and then from each document's own most toxic one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.pu_quality import remainder
from tillroll.llm.shared import text_chunks, text_key
from tillroll.llm.winnowing import Words

THRESHOLD = 0.5
WINDOW = 32
STRIDE = 24
#: Labelled documents of each class that training draws, by a hash of their ids, and the longest text it takes.
TRAIN_ROWS = 2000
TRAIN_BYTES = 12_000

#: A word has an embedding of its own if so many training texts hold it; others share one and are told apart by their characters.
TEXTS_OF_A_WORD = 4
CHAR_BUCKETS, WORD_SIZE, CHAR_SIZE, STATE = 1 << 12, 8, 8, 8
SEED = 7


def numbers(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Places in the sorted vocabulary, from 1; 0 for words outside."""
    if not len(vocabulary):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + 1, 0)


def vocabulary_of(data: np.ndarray, offsets: np.ndarray, least: int = TEXTS_OF_A_WORD) -> np.ndarray:
    words = Words(data, offsets)
    order = np.lexsort((words.text, words.hashes))
    h, t = words.hashes[order], words.text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    found, texts = np.unique(h[new], return_counts=True)
    return found[texts >= least]


class Piece:
    """Windows over a piece of texts: distinct words with their inputs, and per window the words' numbers."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> None:
        words = Words(data, offsets)
        distinct, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        self.word = numbers(distinct, vocabulary)
        starts, self.length = words.starts[first], (words.ends - words.starts)[first]
        self.heads = np.cumsum(self.length) - self.length
        at = np.arange(int(self.length.sum())) - np.repeat(self.heads - starts, self.length)
        text = words.data.astype(np.int64)
        before, after = np.where(at > np.repeat(starts, self.length), text[at - 1], 0), np.where(at + 1 < np.repeat(starts + self.length, self.length), text[np.minimum(at + 1, len(text) - 1)], 0) if len(at) else at
        self.trigram = ((before * 65_599 + text[at]) * 65_599 + after) * 40_503 % 16_777_213 % CHAR_BUCKETS
        count = words.counts()
        self.n_texts = len(count)
        windows = np.where(count > 0, 1 + np.maximum(0, -(-(count - window) // stride)), 0)
        self.text = np.repeat(np.arange(self.n_texts), windows)
        nth = np.arange(len(self.text)) - np.repeat(np.cumsum(windows) - windows, windows)
        head = np.cumsum(count) - count
        place = (head[self.text] + nth * stride)[:, None] + np.arange(window)
        self.mask = place < (head + count)[self.text][:, None]
        self.ids = inverse[np.where(self.mask, place, 0)] if len(inverse) else place


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    def __init__(self, vocabulary: np.ndarray, seed: int = SEED) -> None:
        self.vocabulary = vocabulary
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        inputs, s = WORD_SIZE + CHAR_SIZE, STATE
        self.p = {
            "word": normal(len(vocabulary) + 1, WORD_SIZE, scale=0.1), "char": normal(CHAR_BUCKETS, CHAR_SIZE, scale=0.3),
            "enter": normal(inputs, 6 * s, scale=inputs**-0.5), "bias": np.zeros(6 * s, np.float32),
            "ahead": normal(s, 3 * s, scale=s**-0.5), "back": normal(s, 3 * s, scale=s**-0.5),
            "look": normal(2 * s, scale=0.3), "out": normal(2 * s, scale=0.3), "base": np.zeros(1, np.float32),
        }

    def inputs(self, piece: Piece) -> np.ndarray:
        chars = np.add.reduceat(self.p["char"][piece.trigram], piece.heads) / piece.length[:, None] if len(piece.heads) else np.empty((0, CHAR_SIZE))
        return np.hstack([self.p["word"][piece.word], chars]).astype(np.float32)

    @staticmethod
    def _run(x: np.ndarray, ids: np.ndarray, mask: np.ndarray, u: np.ndarray, states: np.ndarray, order: range, keep: list | None) -> None:
        s = STATE
        h = np.zeros((len(ids), s), np.float32)
        for t in order:
            entered, pushed = x[ids[:, t]], h @ u
            gates = _sigmoid(entered[:, : 2 * s] + pushed[:, : 2 * s])
            z, r = gates[:, :s], gates[:, s:]
            new = np.tanh(entered[:, 2 * s :] + r * pushed[:, 2 * s :])
            if keep is not None:
                keep.append((t, h, z, r, new, pushed[:, 2 * s :]))
            h = h + mask[:, t, None] * (1 - z) * (new - h)
            states[t] = h

    def forward(self, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows."""
        s, (n, steps) = STATE, ids.shape
        m = mask.astype(np.float32)
        projected = x @ self.p["enter"] + self.p["bias"]
        states = np.empty((2, steps, n, s), np.float32)
        tapes: list[list] = [[], []]
        self._run(projected[:, : 3 * s].copy(), ids, m, self.p["ahead"], states[0], range(steps), tapes[0] if keep is not None else None)
        self._run(projected[:, 3 * s :].copy(), ids, m, self.p["back"], states[1], range(steps - 1, -1, -1), tapes[1] if keep is not None else None)
        look = self.p["look"]
        e = states[0] @ look[:s] + states[1] @ look[s:] + (m.T - 1) * 1e9
        e = np.exp(e - e.max(0))
        a = e / e.sum(0)
        pooled = np.hstack([np.einsum("tn,tns->ns", a, states[0]), np.einsum("tn,tns->ns", a, states[1])])
        if keep is not None:
            keep.update(states=states, tapes=tapes, a=a, pooled=pooled, m=m)
        return pooled @ self.p["out"] + self.p["base"][0]

    def gradient(self, piece: Piece, rows: np.ndarray, labels: np.ndarray, ids: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss over some windows of a piece, and its gradient; ids: other words in their place."""
        s, p, keep = STATE, self.p, {}
        used, ids = np.unique(piece.ids[rows] if ids is None else ids, return_inverse=True)
        ids = ids.reshape(len(rows), -1)
        x = self.inputs(piece)[used] if len(used) * 4 > len(piece.word) else self._inputs_of(piece, used)
        logits = self.forward(x, ids, piece.mask[rows], keep)
        d = (_sigmoid(logits) - labels).astype(np.float32) / len(rows)
        states, a, m = keep["states"], keep["a"], keep["m"]
        g = {"out": keep["pooled"].T @ d, "base": np.array([d.sum()], np.float32), "look": np.empty(2 * s, np.float32)}
        pooled = d[:, None] * p["out"]
        da = np.einsum("tns,ns->tn", states[0], pooled[:, :s]) + np.einsum("tns,ns->tn", states[1], pooled[:, s:])
        de = a * (da - (a * da).sum(0))
        entered = np.zeros((*ids.shape, 6 * s), np.float32)
        for k, name in enumerate(("ahead", "back")):
            half = slice(k * s, k * s + s)
            g["look"][half] = np.einsum("tn,tns->s", de, states[k])
            outer = a[:, :, None] * pooled[None, :, half] + de[:, :, None] * p["look"][half]
            u, du, carry = p[name], np.zeros_like(p[name]), np.zeros((len(rows), s), np.float32)
            for t, h, z, r, new, pushed in reversed(keep["tapes"][k]):
                dh = carry + outer[t]
                step = m[:, t, None] * dh
                dz, dn = step * (h - new) * z * (1 - z), step * (1 - z) * (1 - new * new)
                dr = dn * pushed * r * (1 - r)
                dp = np.hstack([dz, dr, dn * r])
                carry = dh - step * (1 - z) + dp @ u.T
                du += h.T @ dp
                entered[:, t, k * 3 * s : (k + 1) * 3 * s] = np.hstack([dz, dr, dn])
            g[name] = du
        flat = ids.ravel()
        dx = np.zeros((len(used), 6 * s), np.float32)
        np.add.at(dx, flat, entered.reshape(len(flat), -1))
        g["bias"], g["enter"] = dx.sum(0), x.T @ dx
        dx = dx @ p["enter"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], piece.word[used], dx[:, :WORD_SIZE])
        each = piece.length[used]
        at = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each - piece.heads[used], each)
        np.add.at(g["char"], piece.trigram[at], np.repeat(dx[:, WORD_SIZE:] / each[:, None], each, axis=0))
        loss = float(np.mean(np.logaddexp(0, logits) - labels * logits))
        return loss, g

    def _inputs_of(self, piece: Piece, used: np.ndarray) -> np.ndarray:
        each = piece.length[used]
        heads = np.cumsum(each) - each
        at = np.arange(int(each.sum())) - np.repeat(heads - piece.heads[used], each)
        chars = np.add.reduceat(self.p["char"][piece.trigram[at]], heads) / each[:, None]
        return np.hstack([self.p["word"][piece.word[used]], chars]).astype(np.float32)

    def windows(self, piece: Piece, most: int = 4096) -> np.ndarray:
        """Probability of every window of a piece."""
        x = self.inputs(piece)
        return np.concatenate([np.empty(0), *[_sigmoid(self.forward(x, piece.ids[i : i + most], piece.mask[i : i + most])) for i in range(0, len(piece.text), most)]])

    def texts(self, piece: Piece) -> np.ndarray:
        """Score of every text: its most toxic window's; 0 without words."""
        out = np.zeros(piece.n_texts)
        np.maximum.at(out, piece.text, self.windows(piece))
        return out


def train(texts: list[bytes], labels: np.ndarray, seed: int = SEED, epochs: tuple[int, int] = (3, 4), rate: float = 0.01, batch: int = 256) -> Network:
    """A network for the texts' labels; without both labels, the untrained one with their share as its answer."""
    rng, labels = np.random.default_rng(seed), np.asarray(labels, np.float32)
    order = rng.permutation(len(texts))
    data = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
    offsets = np.cumsum([0, *[len(texts[i]) for i in order]])
    net = Network(vocabulary_of(data, offsets), seed)
    if not len(labels) or labels.min() == labels.max():
        net.p["out"][:] = 0
        net.p["base"][:] = 5.0 if len(labels) and labels[0] else -5.0
        return net
    piece = Piece(data, offsets, net.vocabulary)
    own = labels[order][piece.text]
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second, steps = {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    for epoch in range(sum(epochs)):
        score = rng.random(len(own)) if epoch < epochs[0] else net.windows(piece) + 1e-6 * rng.random(len(own))
        ranked = np.lexsort((-score, piece.text))
        place = np.arange(len(own)) - np.searchsorted(piece.text[ranked], piece.text[ranked])
        take = ranked[place < np.where(own[ranked] == 1, 4 if epoch < epochs[0] else 1, 4)]
        if epoch >= epochs[0]:
            take = np.concatenate([np.repeat(take[own[take] == 1], 2), take[own[take] == 0]])
        take = rng.permutation(take)
        for i in range(0, len(take), batch):
            rows = take[i : i + batch]
            # One clean window in ten is its first word over and over: repetition by itself isn't toxic.
            stutter = (own[rows] == 0) & (rng.random(len(rows)) < 0.1)
            _, grads = net.gradient(piece, rows, own[rows], np.where(stutter[:, None], piece.ids[rows, :1], piece.ids[rows]))
            steps += 1
            pace = rate * min(1.0, 2.0 * (1 - epoch / sum(epochs))) * (1 - 0.999**steps) ** 0.5 / (1 - 0.9**steps)
            for k, d in grads.items():
                first[k] += 0.1 * (d - first[k])
                second[k] += 0.001 * (d * d - second[k])
                net.p[k] -= pace * first[k] / (np.sqrt(second[k]) + 1e-8)
    return net


def drawn(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, rows: int = TRAIN_ROWS) -> tuple[list[bytes], np.ndarray]:
    """Labelled texts to learn from: at most `rows` of each class, each of at most TRAIN_BYTES."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder(F.col("doc_id"), folds) != held_out))
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("low"), F.max("toxic").alias("high")).where("low = high").select("doc_id", F.col("high").alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    some = known.where("toxic = 1").orderBy(*order).limit(rows).union(known.where("toxic = 0").orderBy(*order).limit(rows))
    texts = docs.where(F.octet_length("text") <= TRAIN_BYTES).select(F.col("doc_id"), F.col("text").cast("binary").alias("text"))
    met = texts.join(F.broadcast(some), "doc_id").select("doc_id", "text", "toxic").limit(2 * rows).collect()
    met = sorted((r.doc_id, bytes(r.text), r.toxic) for r in met)
    return [r[1] for r in met], np.array([r[2] for r in met])


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, text_key, held_out and score of every document row.

    Only labels outside the held-out fold are read.  NULL and empty texts score 0, and a NULL
    doc_id isn't held out.  Labels that contradict each other are left out; with labels of one kind
    only, that kind is the answer for all.  Repeated rows are judged alike; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    net = train(*drawn(docs, labels, folds, held_out))
    shared = spark.sparkContext.broadcast((net.vocabulary, net.p))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.__new__(Network)
        own.vocabulary, own.p = shared.value
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column("text"), 1 << 19):
                found = own.texts(Piece(data, offsets, own.vocabulary))
                columns = [batch.column(c).slice(row, len(found)) for c in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], ["doc_id", "text_key", "score"])

    raw = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("binary").alias("text"))
    scored = raw.mapInArrow(score, "doc_id bigint, text_key bigint, score double")
    return scored.withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), folds) == held_out, F.lit(False)))
