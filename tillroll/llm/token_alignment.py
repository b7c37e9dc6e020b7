"""Alignment of the tokens of two tokenizers over the same text.

A is a vocabulary of the tokenizers library (byte-level pairs), which reports for each token the
characters it comes from; B is one of sentencepiece, which reports spans for its pieces.  Where both
report the end of a token at the same place there is a coarse cut.  Between coarse cuts the spans
say too little wherever a token is only a part of a character: A then gives several tokens the same
character, B's byte-fallback pieces share one span.  There the ends are those of the tokens' decoded
bytes.  The bytes of all tokens joined must be the text itself, else the text counts as not aligned.

Texts are cut into segments that both tokenizers treat alone: before a lone space between two
characters that aren't white space, A always begins a new piece, and no piece of B reaches over it
(this is looked up in B's vocabulary, else texts stay whole).  So each different segment is encoded
and aligned once for each piece of the table, and a text is the chain of its segments.

Two tokens that end together are suffixes of one another.  So the id pairs that can ever be linked
are given by the vocabularies: at most two for each suffix of each token, under a million for 50,000 and
32,000 entries.  That bounds the table of counts, however large the corpus is.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.shared import staged

#: Different segments that are encoded at once, and that are put together as one text.
CHUNK = 8192
RUN = 64
#: Texts are aligned in pieces of about so many bytes; a longer text is a piece of its own.
PIECE = 1 << 22

#: Rows whose links are counted or scored at once.
ROWS = 1000

_LONE_SPACE = re.compile(r"(?<=\S)(?= \S)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Encodes segments with both vocabularies and aligns their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # An id pair is one number: A's id above the bits of B's.
        self.bits = (len(pieces) - 1).bit_length()
        self.type = np.dtype("<u4" if (len(self.a_bytes) - 1).bit_length() + self.bits <= 32 else "<u8")
        self.splits = not any("▁" in p.lstrip("▁") for p in pieces)
        # How a token is shown inside its group and at the group's end.
        shown = [f"{i}{mark}" for marks, n in (((",", "|"), len(self.a_bytes)), ((",", ";"), len(pieces))) for i in range(n) for mark in marks]
        self.shown = pa.array(shown, pa.large_binary())
        self.a_lengths, self.b_lengths = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))

    def _a_tokens(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of tokens of A in each segment, their ids, and their spans in characters."""
        found = self.a.encode_batch(segments, add_special_tokens=False)
        ids = [x.ids for x in found]
        n = np.array(list(map(len, ids)), np.int64)
        spans = np.fromiter(chain.from_iterable(chain.from_iterable([x.offsets for x in found])), np.int64, 2 * int(n.sum()))
        return n, np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), spans.reshape(-1, 2)

    def _b_tokens(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of tokens of B in each piece, their ids, and their spans in bytes, counted from the space that is put before it."""
        # The spans of the library's immutable proto; this version of it hands them over as an offset mapping.
        found = self.b.encode([p.encode() for p in pieces], return_type="offset_mapping", num_threads=1)
        ids = [x["ids"] for x in found]
        n = np.array(list(map(len, ids)), np.int64)
        spans = np.fromiter(chain.from_iterable(chain.from_iterable([x["offsets"] for x in found])), np.int64, 2 * int(n.sum())).reshape(-1, 2) + 1
        spans[(np.cumsum(n) - n)[n > 0], 0] = 0  # the first token has that space
        return n, np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), spans

    def _aligned(self, pieces: list[str], run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]:
        """Of segments, each a space and a piece: numbers of tokens of A and B, whether their bytes aren't the segment's,
        the groups as text, each ending in `;`, and the links as pair codes.

        Up to `run` pieces that may be cut apart are encoded as one text; where its tokens aren't its bytes, each alone.
        """
        plain = [k for k, p in enumerate(pieces) if p and not (p[0].isspace() or p[-1].isspace())] if run > 1 else []
        odd = sorted(set(range(len(pieces))) - set(plain))
        texts = [" ".join([pieces[k] for k in plain[at : at + run]]) for at in range(0, len(plain), run)] + [pieces[k] for k in odd]
        turn = np.array(plain + odd, np.int64)
        whole = [" " + t for t in texts]
        raw = [t.encode() for t in whole]
        sizes = np.array(list(map(len, raw)), np.int64)
        begins = np.cumsum(sizes) - sizes  # the texts lie one after another: a place names text and byte
        a_n, a_ids, a_spans = self._a_tokens(whole)
        b_n, b_ids, b_spans = self._b_tokens(texts)
        letters = np.array(list(map(len, whole)), np.int64)
        a_spans = a_spans + np.repeat(np.cumsum(letters) - letters, a_n)[:, None]
        if letters.sum() < sizes.sum():  # from characters to bytes
            codes = np.frombuffer("".join(whole).encode("utf-32-le"), "<u4")
            widths = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
            a_spans = np.concatenate([[0], np.cumsum(widths)])[a_spans]
        b_spans = b_spans + np.repeat(begins, b_n)[:, None]

        bad = np.zeros(len(texts), bool)
        sides = []
        for n, ids, spans, parts, lengths in ((a_n, a_ids, a_spans, self.a_bytes, self.a_lengths), (b_n, b_ids, b_spans, self.b_bytes, self.b_lengths)):
            of, first = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
            ends = np.concatenate([[0], np.cumsum(lengths[ids])])
            bad |= ends[np.cumsum(n)] - ends[first] != sizes
            if bad.any() or b"".join([parts[i] for i in ids.tolist()]) != b"".join(raw):
                rows = np.split(ids, first[1:])
                bad |= np.array([b"".join([parts[i] for i in row.tolist()]) != r for row, r in zip(rows, raw, strict=True)])
            follows = np.concatenate([(of[1:] != of[:-1]) | (spans[1:, 0] == spans[:-1, 1]), [True]]) if len(of) else np.empty(0, bool)
            # The end of a span is the end of its token if the span isn't empty and the next begins there.
            sides.append([of, ids, spans[:, 1], ends[1:] - np.repeat(ends[first] - begins, n), (spans[:, 1] > spans[:, 0]) & follows])
        for side in sides:
            side[:] = [x[~bad[side[0]]] for x in side]
        (_, a_ids, a_spans, a_ends, a_clean), (_, b_ids, b_spans, b_ends, b_clean) = sides
        # Coarse cuts by the spans, as far as the bytes bear them out; the rest by the decoded bytes.
        shared = both(a_ends, b_ends)
        coarse = both(shared, both(np.sort(a_spans[a_clean]), np.sort(b_spans[b_clean])))
        vague = np.sort(np.concatenate([a_ends[~a_clean | (a_spans != a_ends)], b_ends[~b_clean | (b_spans != b_ends)]]))
        cuts = np.union1d(coarse, both(shared, vague)) if len(vague) else coarse
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        a_last, b_last = a_ends == cuts[a_group], b_ends == cuts[b_group]
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        shown = np.concatenate([2 * a_ids + a_last, 2 * (len(self.a_bytes) + b_ids) + b_last])[order]

        # Back to the pieces, which lie one after another in the texts.
        ends = np.cumsum([len(pieces[k].encode()) + 1 for k in turn.tolist()])
        a_of, b_of = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
        a_n, b_n = np.bincount(a_of, minlength=len(pieces)), np.bincount(b_of, minlength=len(pieces))
        groups = joined(self.shown.take(pa.array(shown)), a_n + b_n)
        links = (a_ids[a_last] << self.bits | b_ids[b_last]).astype(self.type)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(a_of[a_last], minlength=len(pieces)))]) * self.type.itemsize
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(offsets), pa.py_buffer(links.tobytes())])
        failed = bad[np.searchsorted(begins + sizes, ends)]
        failed[~failed] |= ~np.isin(ends[~failed], cuts)  # a token across two pieces
        result = (a_n, b_n, failed, groups, coded)
        place = np.empty(len(pieces), np.int64)
        place[turn] = np.arange(len(pieces))
        again = np.flatnonzero(failed[: len(plain)]) if run > 1 else np.empty(0, np.int64)
        if len(again):
            # With a piece that fails, its neighbours in the text are encoded again.
            of = np.unique(again // run)
            again = np.flatnonzero(np.isin(np.arange(len(plain)) // run, of))
            alone = self._aligned([pieces[k] for k in turn[again].tolist()], 1)
            result = tuple(np.concatenate([x, y]) if isinstance(x, np.ndarray) else pa.concat_arrays([x, y]) for x, y in zip(result, alone, strict=True))
            place[turn[again]] = len(pieces) + np.arange(len(again))
        return tuple(x[place] if isinstance(x, np.ndarray) else x.take(pa.array(place)) for x in result)

    def segments(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The texts as chains of segments: segment numbers, the first place of each text among them, and the segments' texts without their space."""
        if self.splits:
            lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        else:
            lists = pa.array([[t] for t in texts], pa.large_list(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        codes, pieces = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        opens = np.array([not p or p[0].isspace() for p in pieces], bool)
        closes = np.array([not p or p[-1].isspace() for p in pieces], bool)
        of = np.repeat(np.arange(len(texts)), np.diff(bounds))
        odd = np.unique(of[:-1][(closes[codes[:-1]] | opens[codes[1:]]) & (of[:-1] == of[1:])])
        if not len(odd):
            return codes, bounds, pieces
        # Texts with other white space are cut at lone spaces only.
        number = {p: k for k, p in enumerate(pieces)}
        chains = np.split(codes, bounds[1:-1])
        for k in odd.tolist():
            own = [x[1:] for x in _LONE_SPACE.split(" " + texts[k])]
            chains[k] = np.array([number.setdefault(p, len(number)) for p in own], codes.dtype)
        return np.concatenate(chains), np.concatenate([[0], np.cumsum([len(c) for c in chains])]).astype(np.int64), list(number)

    def texts(self, texts: list[str]) -> list[tuple[int, int, bytes, bytes] | None]:
        """Per text the numbers of tokens, the groups and the links; None without tokens."""
        codes, bounds, pieces = self.segments(texts)
        used = np.unique(codes)
        position = np.zeros(len(pieces), np.int64)
        position[used] = np.arange(len(used))
        codes = position[codes]
        wanted = [pieces[k] for k in used.tolist()]
        found = [self._aligned(wanted[at : at + CHUNK]) for at in range(0, len(wanted), CHUNK)]
        if not found:
            return [None] * len(texts)
        sums = [np.concatenate([[0], np.cumsum(np.concatenate([f[x] for f in found])[codes])]) for x in range(3)]
        n_a, n_b, n_bad = (np.diff(x[bounds]).tolist() for x in sums)
        chained = []
        for x in (3, 4):
            taken = pa.concat_arrays([f[x] for f in found]).take(pa.array(codes))
            chained.append((memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], np.int64)[bounds].tolist()))
        (groups, g), (links, e) = chained
        return [
            None if n_bad[k] or not texts[k] else (n_a[k], n_b[k], bytes(groups[g[k] : g[k + 1] - 1]), bytes(links[e[k] : e[k + 1]]))
            for k in range(len(texts))
        ]


def both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The values of x that y has too; both are sorted."""
    return x[y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x] if len(y) else x[:0]


def joined(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """So many of the values, one after another, put together each time."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    offsets = np.frombuffer(values.buffers()[1], np.int64)[ends]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), values.buffers()[2] or pa.py_buffer(b"")])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The process's aligner: loaded once for all its tasks."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _decoded(raw: bytes | None) -> str:
    """The text; empty where it isn't UTF-8, as no token bytes can be equal to it."""
    try:
        return (raw or b"").decode()
    except UnicodeDecodeError:
        return ""


FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]


def _align(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    own = aligner(a_path, b_path)
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False))
        row = 0
        while row < len(batch):
            end = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + PIECE, "right")))
            rows = own.texts([_decoded(t) for t in batch.column("text").slice(row, end - row).to_pylist()])
            full = [r or (0, 0, b"", b"") for r in rows]
            links = pa.array([r[3] for r in full], pa.binary())
            n = pa.array([len(r[3]) // own.type.itemsize for r in full], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, end - row), pa.array([r[0] for r in full], pa.int64()), pa.array([r[1] for r in full], pa.int64()),
                    n, n, pa.array([r[2] for r in full], pa.binary()), links,
                ],
                FIELDS,
            )
            row = end


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups and links of every document row.

    A encodes a space and the text, B the text, before which it puts a space itself; strings of special
    tokens are plain text.  The places where tokens of both end cut the tokens into groups; `groups` has their ids as
    `a1,a2|b1;a3|b2,b3`.  Tokens that end together are linked; no token is empty, so each group holds one link, of its
    last tokens.  `links` has their ids as pair codes, see `pair_layout`.  Texts that are NULL, empty, not UTF-8, or whose joined
    tokens of A or B aren't a space and the text have no tokens: zeros and empty strings.  Rows that share an id are
    each aligned; a NULL id stays NULL; other columns are ignored.  Nothing is shuffled.
    """
    raw = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups binary, links binary"
    found = raw.mapInArrow(partial(_align, a_path=a_path, b_path=b_path), schema)
    return found.withColumn("groups", F.col("groups").cast("string"))


def pair_layout(a_path: str, b_path: str) -> tuple[int, str]:
    """Of the pair codes in `links`: the bits of B's id below those of A's, and the numpy type."""
    own = aligner(a_path, b_path)
    return own.bits, own.type.str


def _merged(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _codes(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All pair codes of a column of links, and the first place of each row among them."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


def _some_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(0, len(batch), ROWS):
            yield batch.slice(row, ROWS)


def _count(batches: Iterator[pa.RecordBatch], bits: int, kind: str) -> Iterator[pa.RecordBatch]:
    parts, size = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
    for batch in _some_rows(batches):
        codes, n = np.unique(_codes(batch.column("links"), kind)[0], return_counts=True)
        parts.append((codes.astype(np.int64), n))
        size += len(codes)
        if size > 1 << 21:
            parts = [_merged(*map(np.concatenate, zip(*parts, strict=True)))]
            size = 0
    codes, counts = _merged(*map(np.concatenate, zip(*parts, strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array(codes >> bits), pa.array(codes & (1 << bits) - 1), pa.array(counts)], ["a", "b", "n"])


def pair_counts(found: DataFrame, bits: int, kind: str) -> DataFrame:
    """a, b, n (how many links hold the pair) and best (no pair has more with this b), summed in each task before the shuffle."""
    counts = found.select("links").mapInArrow(partial(_count, bits=bits, kind=kind), "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    counts = staged(counts, "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _score(batches: Iterator[pa.RecordBatch], table, kind: str) -> Iterator[pa.RecordBatch]:
    known, counts, best = table.value
    for batch in _some_rows(batches):
        codes, bounds = _codes(batch.column("links"), kind)
        at = np.searchsorted(known, codes)
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[at])])[bounds]) for x in (best, counts)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(x, pa.int64()) for x in sums]], [*batch.schema.names[:-1], "n_best", "count_sum"])


def with_counts(found: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The frame, written, with n_best and count_sum in place of its column `links`.

    A pair's count is the number of links of the whole frame that hold it; n_best counts a row's links
    whose pair no other pair of the same B id exceeds, count_sum adds up the counts of its links.  The table of counts is
    bounded by the vocabularies, see above, and broadcast.
    """
    spark, (bits, kind) = found.sparkSession, pair_layout(a_path, b_path)
    rest = [c for c in found.columns if c != "links"]
    written = staged(found.select(*rest, "links"), "aligned")
    pairs = pair_counts(written, bits, kind).toArrow()
    codes = (pairs.column("a").to_numpy() << bits | pairs.column("b").to_numpy()).astype(kind)
    order = np.argsort(codes)
    table = spark.sparkContext.broadcast((codes[order], pairs.column("n").to_numpy()[order], pairs.column("best").to_numpy().astype(np.int64)[order]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written.schema if f.name != "links") + ", n_best bigint, count_sum bigint"
    return written.mapInArrow(partial(_score, table=table, kind=kind), schema)


def default_vocabularies(spark: SparkSession) -> tuple[str, str]:
    """The vocabulary files: the settings `spark.tillroll.tokenizer` and `spark.tillroll.pieces`, or else the installed public ones."""
    named = [spark.conf.get(f"spark.tillroll.{k}", None) for k in ("tokenizer", "pieces")]
    if all(named):
        return named[0], named[1]
    import public_tokenizers

    return named[0] or public_tokenizers.path("byte_bpe_50k.json"), named[1] or public_tokenizers.path("piece_bpe_32k.model")
