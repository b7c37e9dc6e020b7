"""Periodic runs of words, found online by dyadic square catching.

Words arrive one after another.  Whenever a block of b = 2^j words is complete, a catcher is set up
for it: it waits for its block to come again q words later, b <= q < 2b.  For every level b each
appended word completes one suffix of b words, and exactly one catcher waits for it there, so a
word costs one comparison of suffix and block per level.  A caught pair is a place where words q
apart agree for b words; it is extended to both sides as far as they agree.  From q agreeing words
on the stretch holds squares; all squares of one stretch merge into one run.

A run of smallest period q and length of at least 3q and 24 words agrees over at least 2q (for
q < 8: 17) words, so it holds a whole block of the largest power of two up to q (for q < 8: of 8)
words: no run is missed.  Suffixes and blocks are compared by 64-bit hashes of windows, each made
from two of half its size; a stretch is then measured on the words themselves, so a chance
agreement of hashes costs time and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: A run has at least so many words, and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Blocks of the lowest level: the largest power of two that every run of a short period must hold whole.
LOWEST = 8
#: Texts are read in pieces of about so many bytes; a longer text is a piece of its own.
PIECE = 1 << 22

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


def _grown(array: np.ndarray, n: int, fill: int = 0) -> np.ndarray:
    """The array with room for n values at least."""
    if n <= len(array):
        return array
    out = np.full(max(n, 2 * len(array)), fill, array.dtype)
    out[: len(array)] = array
    return out


class Catchers:
    """The state of the online search over one stream of whole numbers (words).

    `append` takes any number of words, one or millions, with the same outcome.  `longest` bounds the
    periods looked for: a stream of separate texts needs no level beyond its longest text.
    """

    def __init__(self, longest: int | None = None) -> None:
        self.longest = longest
        self.n = 0
        self.words = np.empty(1024, np.int64)
        self.windows: dict[int, tuple[int, np.ndarray]] = {}  # level: first start kept, hashes of windows from there on
        self.run_of = np.full(1024, -1, np.int32)  # the run that covers a position, that which ends last
        self.run_end, self.run_period = np.empty(64, np.int64), np.ones(64, np.int64)
        self.run_start: list[int] = []
        self.latest: dict[int, list[int]] = {}  # period: start and end of its latest stretch, and its run or -1
        self.open: set[int] = set()  # periods whose latest stretch reaches the last word

    def _agreeing(self, q: int, at: int) -> int:
        """The first position from `at` on whose word differs from that q later, or n - q."""
        step, last = 64, self.n - q
        while at < last:
            end = min(at + step, last)
            same = self.words[at:end] == self.words[at + q : end + q]
            if not same.all():
                return at + int(same.argmin())
            at, step = end, min(4 * step, 1 << 16)
        return last

    def _agreeing_back(self, q: int, at: int) -> int:
        """The first position of those just before `at` whose words agree with that q later."""
        step = 64
        while at > 0:
            begin = max(0, at - step)
            same = self.words[begin:at] == self.words[begin + q : at + q]
            if not same.all():
                return at - int(same[::-1].argmin())
            at, step = begin, min(4 * step, 1 << 16)
        return 0

    def _measured(self, q: int, start: int, end: int) -> None:
        """Notes the stretch [start, end) of period q, new or grown, and the run that it is once it is long enough."""
        run, marked = -1, start
        if q in self.latest and self.latest[q][0] == start:
            run, marked = self.latest[q][2], self.latest[q][1]
        if run < 0 and end - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
            run, marked = len(self.run_start), start
            self.run_start.append(start)
            self.run_end, self.run_period = _grown(self.run_end, run + 1), _grown(self.run_period, run + 1, 1)
            self.run_period[run] = q
            self.run_end[run] = -1
        if run >= 0:
            self.run_end[run] = end
            here = self.run_of[marked:end]
            here[(here < 0) | (self.run_end[here] < end) | ((self.run_end[here] == end) & (self.run_period[here] > q))] = run
        self.latest[q] = [start, end, run]
        (self.open.add if end == self.n else self.open.discard)(q)

    def _outside(self, b: int, s: np.ndarray, q: np.ndarray | int) -> np.ndarray:
        """Whether a pair of blocks lies outside the runs so far.  Inside one whose period divides q, its stretch is that run."""
        run = self.run_of[s]
        return (run < 0) | (self.run_end[run] < s + q + b) | (q % self.run_period[run] != 0)

    def _caught(self, b: int, s: np.ndarray, q: np.ndarray) -> None:
        """Blocks [s, s + b) that came again q later."""
        new = self._outside(b, s, q)
        s, q = s[new], q[new]
        order = np.argsort(q, kind="stable")
        periods, firsts = np.unique(q[order], return_index=True)
        for period, at in zip(periods.tolist(), np.split(s[order], firsts[1:]), strict=False):
            at = at[self._outside(b, at, period)]
            k = 0
            while k < len(at):
                block = int(at[k])
                seen = self.latest.get(period)
                if seen is None or not seen[0] <= block <= seen[1] - period - b:
                    end = self._agreeing(period, block)
                    if end > block:
                        self._measured(period, self._agreeing_back(period, block), end + period)
                    seen = [block, max(end + period, block + period + b), -1]
                k = int(np.searchsorted(at, seen[1] - period - b, "right"))

    def append(self, words: np.ndarray) -> None:
        before, self.n = self.n, self.n + len(words)
        self.words, self.run_of = _grown(self.words, self.n), _grown(self.run_of, self.n, -1)
        self.words[before : self.n] = words
        for q in sorted(self.open):
            start, end, _ = self.latest[q]
            self._measured(q, start, self._agreeing(q, end - q) + q)
        b, first, hashes = 1, before, _mixed(self.words[before : self.n].view(np.uint64) + _STEP)
        while len(hashes) or b in self.windows:
            if b in self.windows:
                first, hashes = self.windows[b][0], np.concatenate([self.windows[b][1], hashes])
            new = max(before - b + 1, 0)  # the first suffix that was not complete before
            if b >= LOWEST:
                if b == LOWEST and new < b:  # in the first block there is only the block itself to wait for
                    at = np.arange(max(new, 1), min(b, first + len(hashes)))
                    hit = at[hashes[at - first] == hashes[0]] if len(at) and first == 0 else at[:0]
                    if len(hit):
                        self._caught(b, np.zeros(len(hit), np.int64), hit)
                at = np.arange(max(new, b), first + len(hashes))
                for back in (0, 1) if b == LOWEST else (1,):  # short periods first
                    block = (at // b - back) * b
                    hit = np.flatnonzero(hashes[block - first] == hashes[at - first])
                    hit = hit[at[hit] > block[hit]]
                    if len(hit):
                        self._caught(b, block[hit], at[hit] - block[hit])
            # The next level needs the last b windows, the catchers the last two blocks.
            keep = max(first, (first + len(hashes)) // b * b - 2 * b)
            self.windows[b] = (keep, hashes[keep - first :])
            if self.longest is not None and 2 * b > max(LOWEST, self.longest // LEAST_PERIODS):
                break
            begin, end = max(before - 2 * b + 1, 0), first + len(hashes) - b
            left, right = hashes[begin - first : max(end, begin) - first], hashes[begin + b - first : max(end, begin) + b - first]
            b, first, hashes = 2 * b, begin, _mixed(left * _STEP + right)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs so far, by start and period."""
        found: dict[tuple[int, int], int] = {}
        for k, start in enumerate(self.run_start):
            place, period = (start, int(self.run_end[k])), int(self.run_period[k])
            found[place] = min(period, found.get(place, period))
        return sorted((start, end - start, q) for (start, end), q in found.items())


def _numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as whole numbers, equal for equal words, and the number of words of each text."""
    parts = pc.ascii_split_whitespace(texts)
    flat, of = parts.flatten(), np.repeat(np.arange(len(parts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    coded = flat.dictionary_encode()
    ids, blank = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.index(pa.scalar("", coded.dictionary.type)).as_py()
    if blank >= 0:
        ids, of = ids[ids != blank], of[ids != blank]
    return ids, np.bincount(of, minlength=len(parts))


def piece_runs(texts: pa.Array) -> tuple[np.ndarray, dict[int, list[tuple[int, int, int]]]]:
    """Word counts of the texts, and the runs of those that have any.  The texts are one stream with a mark of its own after each."""
    ids, counts = _numbered(texts)
    stream = np.empty(len(ids) + len(counts), np.int64)
    ends = np.cumsum(counts + 1)
    stream[ends - 1] = -1 - np.arange(len(counts))
    inside = np.ones(len(stream), bool)
    inside[ends - 1] = False
    stream[inside] = ids
    found: dict[int, list[tuple[int, int, int]]] = {}
    if len(counts) and counts.max() >= LEAST_WORDS:
        search = Catchers(int(counts.max()))
        search.append(stream)
        for start, length, period in search.runs():
            text = int(np.searchsorted(ends, start, "right"))
            found.setdefault(text, []).append((start - int(ends[text] - counts[text] - 1), length, period))
    return counts, found


def collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and those of each run's first period, joined by one space."""
    parts = text.split()
    if runs:
        keep = np.ones(len(parts), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        parts = [parts[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(parts)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows with about PIECE bytes of text each."""
    sizes = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(batch):
        end = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + PIECE, "right")))
        yield batch.slice(row, end - row)
        row = end


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in _pieces(batch):
            raw = piece.column("text").cast(pa.large_binary()).fill_null(b"")
            counts, found = piece_runs(raw.view(pa.large_string()))
            runs = [found.get(k, []) for k in range(len(piece))]
            kept = [collapsed(t.as_py(), r) for t, r in zip(raw, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"), pa.array(counts, pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], RUNS), pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period in words, by start and period) and collapsed of every document row.

    A run is a stretch of words with smallest period q, at least 24 and at least 3q words long,
    that no neighbouring word extends.  `collapsed` is the text, its words joined by one space,
    without the words that any run repeats after its first period.  NULL and empty texts have no
    words, no runs and an empty collapsed text.  Rows that share an id are each searched; a NULL id
    stays NULL; other columns are ignored.  Texts are searched where they lie, without a shuffle.
    """
    raw = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = raw.mapInArrow(_search, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))

