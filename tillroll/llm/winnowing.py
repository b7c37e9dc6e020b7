"""Benchmark contamination by winnowed fingerprints.

A text's k-grams of words are hashed; each window of w consecutive hashes keeps its smallest.  Two
texts that share a span of at least k + w - 1 words share a whole window there, so keep the same
hash in it: joining kept hashes finds every such span.  With k = w = 7 that is 13 words, the length
of a benchmark window.  A hit carries the words around it, which are compared as text: the shared
span is extended to both sides, and counts from 13 words on.  Benchmark items of fewer words are
shorter than the guarantee; they are looked up whole, by the hash of all their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.shared import packed, staged, text_chunks, text_key

SPAN = 13
GRAM = 7
#: Bits of the filter of benchmark hashes that is sent to the executors: 2 MB, however large the benchmark is.
FILTER_BITS = 1 << 24

_NORMAL = np.zeros(256, np.uint8)
for _first, _last, _shift in ((0x30, 0x39, 0), (0x61, 0x7A, 0), (0x80, 0xFF, 0), (0x41, 0x5A, 32)):
    _NORMAL[_first : _last + 1] = np.arange(_first, _last + 1) + _shift
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of a piece of texts: bytes, bounds, text number and a 64-bit hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, normal: np.ndarray = _NORMAL) -> None:
        self.data = normal[data]
        inside = self.data != 0
        opens = np.zeros(len(inside) + 1, bool)
        opens[offsets] = True  # a text's first byte starts a word even where the text before ends in one
        first = inside.copy()
        first[1:] &= ~inside[:-1] | opens[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | opens[1:-1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        self.n_texts = len(offsets) - 1
        lengths = self.ends - self.starts
        if len(lengths):
            heads = np.cumsum(lengths) - lengths
            powers = np.cumprod(np.full(int(lengths.max()), _STEP, np.uint64))
            place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
            self.hashes = _mixed(np.add.reduceat(self.data[inside] * powers[place], heads) + lengths.astype(np.uint64))
        else:
            self.hashes = np.empty(0, np.uint64)

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    def joined(self, first: int, end: int) -> bytes:
        raw = self.data.tobytes() if not hasattr(self, "_raw") else self._raw
        self._raw = raw
        return b" ".join(raw[a:b] for a, b in zip(self.starts[first:end].tolist(), self.ends[first:end].tolist(), strict=True))

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the `size` words from each word on, and whether they lie in one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        h = np.full(n, np.uint64(size))
        for j in range(size):
            h = h * _STEP + self.hashes[j : j + n]
        return _mixed(h), self.text[:n] == self.text[size - 1 :]


def winnowed(words: Words, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the k-grams that are the smallest of some window; the leftmost of equals."""
    hashes, _ = words.grams(gram)
    width = span - gram + 1
    n = len(words.hashes) - span + 1
    if n <= 0:
        return np.empty(0, np.int64), hashes[:0]
    whole = np.flatnonzero(words.text[:n] == words.text[span - 1 :])
    least = whole + np.lib.stride_tricks.sliding_window_view(hashes, width)[whole].argmin(1)
    chosen = np.zeros(len(hashes), bool)
    chosen[least] = True
    at = np.flatnonzero(chosen)
    return at, hashes[at]


HIT = pa.struct([("size", pa.int32()), ("hash", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("around", pa.string())])
HIT_SQL = "array<struct<size int, hash bigint, at bigint, before int, around string>>"


def _hits(words: Words, gram: int, span: int, shorter: list[int], allowed: np.ndarray | None, whole_only: bool) -> list[list[dict]]:
    """Per text the hashes kept, those that the filter lets pass, with the words around them."""
    out: list[list[dict]] = [[] for _ in range(words.n_texts)]
    counts = words.counts()
    heads = np.cumsum(counts) - counts
    found = [(span, *winnowed(words, gram, span))]
    for size in shorter:
        hashes, one_text = words.grams(size)
        if whole_only:
            one_text = one_text & (counts[words.text[: len(hashes)]] == size)
        at = np.flatnonzero(one_text)
        found.append((size, at, hashes[at]))
    for size, at, hashes in found:
        if allowed is not None:
            bit = hashes & np.uint64(FILTER_BITS - 1)
            passed = np.flatnonzero(allowed[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
            at, hashes = at[passed], hashes[passed]
        length, reach = (gram, span - gram) if size == span else (size, 0)
        for i, h in zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True):
            text = int(words.text[i])
            head, end = int(heads[text]), int(heads[text] + counts[text])
            left, right = max(head, i - reach), min(end, i + length + reach)
            out[text].append({"size": size, "hash": h, "at": i - head, "before": i - left, "around": words.joined(left, right).decode()})
    return out


def _scan(batches: Iterator[pa.RecordBatch], gram: int, span: int, shorter: list[int], allowed, whole_only: bool) -> Iterator[pa.RecordBatch]:
    bits = allowed.value if allowed is not None else None
    for batch in batches:
        for row, data, offsets in text_chunks(batch.column("text")):
            words = Words(data, offsets)
            hits = _hits(words, gram, span, shorter, bits, whole_only)
            n = len(hits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(row, n), batch.column("text_key").slice(row, n), pa.array(words.counts(), pa.int64()), pa.array(hits, pa.list_(HIT))],
                ["id", "text_key", "n_words", "hits"],
            )


def _scanned(texts: DataFrame, id_column: str, gram: int, span: int, shorter: list[int], allowed, whole_only: bool) -> DataFrame:
    raw = texts.select(F.col(id_column).alias("id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("binary").alias("text"))
    scan = partial(_scan, gram=gram, span=span, shorter=shorter, allowed=allowed, whole_only=whole_only)
    return raw.mapInArrow(scan, f"id bigint, text_key bigint, n_words bigint, hits {HIT_SQL}")


def _filter_bits(items: DataFrame) -> np.ndarray:
    """The benchmark's hashes as a bit field of fixed size, gathered as at most FILTER_BITS / 64 rows."""
    bit = F.col("hash").bitwiseAND(FILTER_BITS - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int"))
    rows = items.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(one).alias("bits")).collect()
    field = np.zeros(FILTER_BITS // 64, np.int64)
    for at, bits in rows:
        field[at] = bits
    return field.view(np.uint8)


def _spans(batches: Iterator[pa.RecordBatch], gram: int, span: int) -> Iterator[pa.RecordBatch]:
    """The shared span around each hash that both sides keep, if it is long enough."""
    for batch in batches:
        kept, begin, end = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("size", "at", "before", "around", "item_before", "item_around")]
        for row, (size, at, before, around, item_before, item_around) in enumerate(zip(*columns, strict=True)):
            mine, theirs = around.split(" "), item_around.split(" ")
            length = gram if size == span else size
            if mine[before : before + length] != theirs[item_before : item_before + length]:
                continue
            left = right = 0
            while left < min(before, item_before) and mine[before - left - 1] == theirs[item_before - left - 1]:
                left += 1
            a, b = mine[before + length :], theirs[item_before + length :]
            while right < min(len(a), len(b)) and a[right] == b[right]:
                right += 1
            if left + length + right >= size:
                kept.append(row), begin.append(at - left), end.append(at + length + right)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row").take(pa.array(kept, pa.int64())), batch.column("item_id").take(pa.array(kept, pa.int64())), pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
            ["row", "item_id", "begin", "end"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, text_key, n_words, n_hit, n_items, items (ids as text, sorted), contaminated.

    A document word is hit if it lies in an occurrence of `span` consecutive words of an item, or
    of a whole item of fewer words.  Documents with a twentieth of their words hit are
    contaminated.  NULL and empty texts have no words and no hits; an item without words has no
    window; one without item_id hits words but isn't counted among the items.  Repeated rows
    are judged alike, each on its own; other columns are ignored.
    """
    if not span > gram > 0:
        raise ValueError("the k-gram must be shorter than the span")
    spark = docs.sparkSession
    items = staged(_scanned(benchmark, "item_id", gram, span, list(range(1, span)), None, True), "items")
    marks = items.select(F.col("id").alias("item_id"), F.inline("hits")).select(
        "item_id", "size", "hash", F.col("before").alias("item_before"), F.col("around").alias("item_around")
    ).distinct()
    shorter = sorted(r[0] for r in marks.where(F.col("size") < span).select("size").distinct().collect())
    allowed = spark.sparkContext.broadcast(_filter_bits(marks))
    scanned = _scanned(docs, "doc_id", gram, span, shorter, allowed, False)
    scanned = staged(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")
    met = scanned.where(F.size("hits") > 0).select("row", F.inline("hits")).join(marks, ["size", "hash"])
    spans = met.select("row", "size", "at", "before", "around", "item_id", "item_before", "item_around").mapInArrow(
        partial(_spans, gram=gram, span=span), "row bigint, item_id bigint, begin bigint, end bigint"
    )
    spans = staged(spans.distinct(), "spans")
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("begin"), F.coalesce(F.max("end").over(before), F.lit(0))))
    covered = spans.select("row", "begin", "end").distinct().withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = spans.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (
        scanned.select("row", F.col("id").alias("doc_id"), "text_key", "n_words").join(covered, "row", "left").join(named, "row", "left")
        .select(
            "doc_id", "text_key", "n_words", n_hit.alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, all columns kept."""
    bad = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    rows = packed(docs)
    return rows.join(bad, rows["id"].eqNullSafe(bad["_id"]) & (rows["key"] == bad["_key"]), "left_anti").select("doc.*")
