"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; every document of the table is unlabelled text; the
share of good documents, the class prior, is estimated from the labels that may be used.  The model
is additive over statistics of the text: each statistic falls in one of the bins between its
quantiles over all documents.  With the logistic loss and prior p the unbiased risk
p E+[l(g)] + (Eu[l(-g)] - p E+[l(-g)]) is convex, and is minimised by Newton steps whose sums are
made over all documents by Spark.  The second part estimates a risk of negatives, which can't be
negative: a step that would make it so is halved until it isn't.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.shared import packed, staged, text_chunks, text_key
from tillroll.llm.winnowing import Words

THRESHOLD = 0.7
STATISTICS = (
    "words", "word_length", "long_words", "upper", "digits", "symbols", "points", "other_marks", "beyond_ascii", "spaces", "lines",
    "symbol_ends", "lone_symbols", "distinct_words", "top_word", "distinct_runs", "same_as_last",
)
QUANTILES = (0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.94, 0.97, 0.99)
RIDGE = 1e-3
STEPS = 15

_BARE = np.arange(256, dtype=np.uint8)
_BARE[0] = 1
_BARE[[9, 10, 11, 12, 13, 32]] = 0
#: Classes of bytes: other, lower, upper, digit, symbol, point, beyond ASCII, space, line end.
_CLASS = np.zeros(256, np.int64)
for _number, _bytes in enumerate((b"", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b"#*$%&|<>", b".,;:!?", bytes(range(128, 256)), b" \t\r\x0b\x0c", b"\n")):
    _CLASS[list(_bytes)] = _number
_CLASSES = 9


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text; all zero for a text without words."""
    n = len(offsets) - 1
    words = Words(data, offsets, _BARE)
    count = words.counts()
    some, sizes = np.maximum(count, 1), np.maximum(np.diff(offsets), 1)
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES)
    lengths = words.ends - words.starts
    marked = _CLASS[words.data[words.ends - 1]] == 4

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(words.text, flags, minlength=n) / some

    def distinct(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different values per text, and how often the most frequent occurs."""
        _, first, times = np.unique(hashes + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), return_index=True, return_counts=True)
        most = np.zeros(n, np.int64)
        np.maximum.at(most, text[first], times)
        return np.bincount(text[first], minlength=n), most

    different, most = distinct(words.hashes, words.text)
    runs, whole = words.grams(5)
    runs, run_text = runs[whole], words.text[: len(runs)][whole]
    different_runs, _ = distinct(runs, run_text)
    same = np.zeros(len(words.hashes))
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.text[1:] == words.text[:-1])
    rows = np.column_stack([
        np.log1p(count), per_text(lengths), per_text(lengths > 14), kinds[:, 2] / sizes, kinds[:, 3] / sizes, kinds[:, 4] / sizes,
        kinds[:, 5] / sizes, kinds[:, 0] / sizes, kinds[:, 6] / sizes, kinds[:, 7] / sizes, kinds[:, 8] / some, per_text(marked),
        per_text(marked & (lengths == 1)),
        different / some, most / some, different_runs / np.maximum(np.bincount(run_text, minlength=n), 1), per_text(same),
    ])
    rows[count == 0] = 0
    return rows.astype(np.float32)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in text_chunks(batch.column("text")):
            rows = statistics_of(data, offsets)
            columns = [batch.column("doc_id").slice(row, len(rows)), batch.column("text_key").slice(row, len(rows))]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, rows.T.copy())], ["doc_id", "text_key", *STATISTICS])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the statistics of every document row, from the text alone."""
    raw = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("binary").alias("text"))
    return raw.mapInArrow(_measured, "doc_id bigint, text_key bigint, " + ", ".join(f"{c} float" for c in STATISTICS))


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; NULL for NULL."""
    return F.crc32(doc_id.cast("string")) % of


class Additive:
    """Bins of each statistic, and a weight for each bin."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray) -> None:
        self.edges, self.weights = edges, weights
        self.starts = np.cumsum([1, *[len(e) + 1 for e in edges]])

    @property
    def size(self) -> int:
        return int(self.starts[-1])

    def columns(self, batch: pa.RecordBatch) -> np.ndarray:
        """Per row the numbers of its non-zero inputs: the constant's, and one for each statistic."""
        found = [np.searchsorted(e, np.asarray(batch.column(c)), "right") + s for c, e, s in zip(STATISTICS, self.edges, self.starts, strict=False)]
        return np.column_stack([np.zeros(batch.num_rows, np.int64), *found])

    def logits(self, columns: np.ndarray) -> np.ndarray:
        return self.weights[columns].sum(1)


def sums(rows: DataFrame, model: Additive) -> dict[int, float]:
    """Over all rows: the parts of the risk, its gradient and the upper half of its Hessian, by position.

    Each task adds up its rows; Spark adds the tasks' sums, so what reaches the driver has the size
    of the model.
    """
    size = model.size

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Positions: 0 to 4 scalars, then gradient of the unlabelled part, sums of positives' inputs, Hessian.
        head, grad, plus, hess = np.zeros(5), np.zeros(size), np.zeros(size), np.zeros((size, size))
        for batch in batches:
            columns, positive = model.columns(batch), np.asarray(batch.column("positive").cast(pa.int8())) == 1
            g = model.logits(columns)
            chance = 1 / (1 + np.exp(-np.clip(g, -60, 60)))
            soft = np.logaddexp(0, g)
            head += [len(g), soft.sum(), positive.sum(), soft[positive].sum(), np.logaddexp(0, -g[positive]).sum()]
            for at in range(columns.shape[1]):
                grad += np.bincount(columns[:, at], chance, size)
                plus += np.bincount(columns[positive, at], minlength=size)
            dense = np.zeros((len(g), size), np.float32)
            dense[np.arange(len(g))[:, None], columns] = 1
            hess += dense.T @ (dense * (chance * (1 - chance)).astype(np.float32)[:, None])
        values = np.concatenate([head, grad, plus, hess[np.triu_indices(size)]])
        there = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(values[there])], ["at", "value"])

    parts = rows.select(*STATISTICS, "positive").mapInArrow(add, "at bigint, value double")
    return dict(parts.groupBy("at").agg(F.sum("value")).collect())


def fitted(rows: DataFrame, prior: float, ridge: float = RIDGE, steps: int = STEPS) -> Additive | None:
    """The model of least non-negative risk; None without rows or positives.  rows: STATISTICS, positive."""
    marks = rows.agg(F.sum(F.col("positive").cast("int")), *[F.percentile_approx(c, list(QUANTILES), 10000) for c in STATISTICS]).first()
    if not marks[0]:
        return None
    model = Additive([np.unique(np.array(q)) for q in marks[1:]], np.zeros(1))
    size = model.size
    model.weights = np.zeros(size)
    model.weights[0] = math.log(prior / (1 - prior))
    penalty = np.full(size, ridge)
    penalty[0] = 1e-9
    step, best, kept = None, np.inf, model.weights
    for _ in range(steps):
        got = sums(rows, model)
        v = np.array([got.get(i, 0.0) for i in range(5 + 2 * size + size * (size + 1) // 2)])
        n, soft, m, plus_soft, plus_loss = v[:5]
        negative = soft / n - prior * plus_soft / m
        risk = prior * plus_loss / m + max(0.0, negative) + (penalty * model.weights**2).sum() / 2
        if step is not None and (negative < 0 or risk > best + 1e-12):
            step = step / 2  # back into the region where the estimate is a risk
            if np.abs(step).max() < 1e-3:
                break
            model.weights = kept + step
            continue
        if best - risk < 1e-6:
            kept = model.weights
            break
        best, kept = risk, model.weights
        gradient = v[5 : 5 + size] / n - prior * v[5 + size : 5 + 2 * size] / m + penalty * model.weights
        hessian = np.zeros((size, size))
        hessian[np.triu_indices(size)] = v[5 + 2 * size :] / n
        hessian = hessian + np.triu(hessian, 1).T + np.diag(penalty)
        step = -np.linalg.solve(hessian, gradient)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        model.weights = kept + step
    model.weights = kept
    return model


def quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, text_key, held_out and score of every document row.

    labels: doc_id and quality; rows whose id falls in the held-out fold aren't read for learning,
    and ids without label, or with both labels, are unlabelled only.  NULL and empty texts have
    statistics of zero and a score like any other.  A NULL doc_id isn't held out.  Without positive
    labels there is nothing to learn and every score is the prior, 0.5 without any label.
    Repeated rows are judged alike; other columns are ignored.
    """
    fold = remainder(F.col("doc_id"), folds)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold != held_out))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high")
    counts = known.agg(F.count("*"), F.sum("high")).first()
    prior = min(0.99, max(0.01, (counts[1] or 0) / counts[0])) if counts[0] else 0.5
    rows = staged(measured(docs), "statistics")
    trusted = known.where("high = 1").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(True).alias("positive"))
    rows = staged(rows.join(trusted, "doc_id", "left").withColumn("positive", F.coalesce("positive", F.lit(False))), "marked")
    model = fitted(rows, prior)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = model.logits(model.columns(batch)) if model else np.full(batch.num_rows, math.log(prior / (1 - prior)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(1 / (1 + np.exp(-np.clip(g, -60, 60))))], ["doc_id", "text_key", "score"])

    scored = rows.select("doc_id", "text_key", *STATISTICS).mapInArrow(score, "doc_id bigint, text_key bigint, score double")
    return scored.withColumn("held_out", F.coalesce(fold == held_out, F.lit(False)))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that reach the threshold, all columns kept."""
    bad = quality(docs, labels).where(F.col("score") < threshold).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    rows = packed(docs)
    return rows.join(bad, rows["id"].eqNullSafe(bad["_id"]) & (rows["key"] == bad["_key"]), "left_anti").select("doc.*")
