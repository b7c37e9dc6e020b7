"""Token ids in flat binary files.

A part of the output is three files that can be memory-mapped: `.ids` has the ids of all its
documents one after another, unsigned, little-endian, of 2 bytes where the vocabulary allows it and
else of 4; `.off` has for each document, and once more for the end, the number of ids before it in
this part, as unsigned 64-bit numbers; `.doc` has the documents' ids as signed 64-bit numbers.  The
manifest, a small Parquet table, names the parts in order with their counts and the number of
ids before each: the prefix sum of the parts' counts.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.shared import staged
from tillroll.sources.scratch import scratch_path

#: In `.doc` files: a document without id.
NO_ID = -(1 << 63)
END = 2
#: Different pieces of text whose ids a worker remembers: as many again are kept from before.
REMEMBERED = 400_000
#: Different pieces that are encoded at once, and that are put together as one text.
CHUNK = 8192
RUN = 64
#: Texts are encoded in pieces of about so many bytes; a longer text is a piece of its own.
PIECE = 1 << 23

_LONE_SPACE = re.compile(r"(?<=\S)(?= \S)")


def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of whole texts as bytes.

    The vocabulary's rule splits a text before it merges: a lone space between two characters that aren't
    white space always begins a new piece.  So texts are cut there, each different piece is looked up once for
    many texts, and the ids of the texts are taken from these as one array.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # A token has as many bytes as letters in a byte-level vocabulary, where each letter stands for a byte.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.lengths[number] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        if sys.byteorder == "big":
            return [np.array(x.ids, self.type).tobytes() for x in found]
        code = "H" if self.type.itemsize == 2 else "I"
        return [array(code, x.ids).tobytes() for x in found]

    def together(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces that may be cut apart, encoded in texts of many pieces; the bytes of the tokens tell where each piece
        ends.  If the tokens aren't the
        pieces' bytes, none is given."""
        texts = ["".join(pieces[at : at + RUN]) for at in range(0, len(pieces), RUN)]
        ids = np.fromiter(chain.from_iterable([x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]), np.int64)
        ends = np.cumsum(self.lengths[ids])
        wanted = np.cumsum([len(p.encode()) for p in pieces])
        if not len(ids) or ends[-1] != wanted[-1]:
            return {}
        last = np.searchsorted(ends, wanted)
        if (ends[last] != wanted).any():
            return {}
        data, size = ids.astype(self.type).tobytes(), self.type.itemsize
        places = [0, *((last + 1) * size).tolist()]
        return {p: data[a:b] for p, a, b in zip(pieces, places[:-1], places[1:], strict=True)}

    def look_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces; those that aren't known are encoded first."""
        if len(self.known) > REMEMBERED:
            # What is still in use comes back from the older half when it is next seen.
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = [p for p in pieces if p not in known]
        known.update((p, older[p]) for p in new if p in older)
        new = [p for p in new if p not in known]
        # A letter and the mark after it are never merged: such pieces are put together from what is known.
        marked = [p for p in new if p[-1:] in (".", ",") and p[-2:-1].isalpha()]
        wanted = set(new).difference(marked).union((p[:-1] for p in marked), (p[-1] for p in marked)).difference(known)
        wanted = list(wanted)
        spaced = [p for p in wanted if p[:1] == " " and p[1:2] and not (p[1].isspace() or p[-1].isspace())]
        for at in range(0, len(spaced), CHUNK):
            known.update(self.together(spaced[at : at + CHUNK]))
        alone = [p for p in wanted if p not in known]
        for at in range(0, len(alone), CHUNK):
            known.update(zip(alone[at : at + CHUNK], self.raw(alone[at : at + CHUNK]), strict=True))
        known.update((p, known[p[:-1]] + known[p[-1]]) for p in marked)
        return [known[p] for p in pieces]

    def encode(self, texts: list[str], tail: bytes = b"") -> tuple[memoryview, np.ndarray]:
        """The ids of all texts, one after another, each text's ending in `tail`, and the number of bytes of each text's."""
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        opens = np.array([not w or w[0].isspace() for w in words], bool)
        closes = np.array([not w or w[-1].isspace() for w in words], bool)
        of = np.repeat(np.arange(len(texts)), sizes)
        odd = np.unique(of[:-1][(closes[codes[:-1]] | opens[codes[1:]]) & (of[:-1] == of[1:])]).tolist()
        # A text's first word is a piece as it is, each other one with the space before it.
        pieces = words + [" " + w for w in words]
        later = np.ones(len(codes), bool)
        later[first] = False
        codes[later] += len(words)
        end = len(pieces)
        chains = np.split(codes, first[1:]) if odd else None
        if odd:
            # Texts with other white space are cut at lone spaces only.
            extra: dict[str, int] = {}
            for k in odd:
                own = _LONE_SPACE.split(texts[k])
                chains[k] = np.array([extra.setdefault(p, end + len(extra)) for p in own], np.int64)
            pieces, codes, sizes = pieces + list(extra), np.concatenate(chains), np.array(list(map(len, chains)), np.int64)
        codes = np.insert(codes, np.cumsum(sizes), len(pieces))
        seen = np.zeros(len(pieces) + 1, bool)
        seen[codes] = True
        used, codes = np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]
        values = self.look_up([pieces[k] for k in used[:-1].tolist()]) + [tail]
        taken = pa.array(values, pa.large_binary()).take(pa.array(codes))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(sizes + 1)])]
        return memoryview(taken.buffers()[2] or b""), np.diff(ends)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder: loaded once for all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end: int) -> Iterator[pa.RecordBatch]:
    """Writes one part.  The name is new in each attempt; only the manifest says which attempt counts."""
    enc, context = encoder(tokenizer), TaskContext.get()
    part = context.partitionId() if context else 0
    name, tail = f"part-{part:06d}-{uuid.uuid4().hex}", np.array([end], enc.type).tobytes()
    fs, base = pafs.FileSystem.from_uri(folder)
    files, lengths, total, docs = None, [], 0, 0
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False))
        row = 0
        while row < len(batch):
            stop = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + PIECE, "right")))
            piece, row = batch.slice(row, stop - row), stop
            if files is None:
                fs.create_dir(base, recursive=True)
                files = [fs.open_output_stream(f"{base}/{name}.{kind}") for kind in ("ids", "off", "doc")]
                files[1].write(np.zeros(1, "<u8").tobytes())
            data, n_bytes = enc.encode([t or "" for t in piece.column("text").to_pylist()], tail)
            files[0].write(data)
            lengths = np.cumsum(n_bytes // enc.type.itemsize) + total
            files[1].write(lengths.astype("<u8").tobytes())
            files[2].write(np.asarray(piece.column("doc_id").fill_null(NO_ID)).astype("<i8").tobytes())
            total, docs = int(lengths[-1]), docs + len(piece)
    if files:
        for f in files:
            f.close()
        yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "width": enc.type.itemsize, "n_docs": docs, "n_ids": total}], schema=PART)


PART = pa.schema([("part", pa.int32()), ("name", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
PART_SQL = "part int, name string, width int, n_docs bigint, n_ids bigint"


def folder_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int = END) -> DataFrame:
    """Encodes the whole texts in order of doc_id into files in `folder`; returns the manifest.

    Each document is its ids and then `end`.  NULL is an empty text.  Documents without id come
    first; rows with equal ids follow in order of their text.  An empty table gives an empty
    manifest.  Columns beside doc_id and text are ignored.  The folder must be one that all
    executors reach: a path, or a URI of a file system that Arrow can write.
    """
    uri = folder_uri(folder)
    order = [F.col("doc_id"), F.col("text")]
    sorted_docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions(*order)
    parts = sorted_docs.mapInArrow(partial(_write_part, folder=uri, tokenizer=tokenizer, end=end), PART_SQL)
    rows = sorted(staged(parts, "parts").collect())  # one small row for each file
    manifest, before = [], 0
    for r in rows:
        manifest.append((r.part, r.name, r.width, r.n_docs, r.n_ids, before))
        before += r.n_ids
    return staged(docs.sparkSession.createDataFrame(manifest, f"{PART_SQL}, base bigint").coalesce(1), "manifest")


def _mapped(fs: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where it is local to the machine, else read."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if fs.get_file_info(path).size else np.empty(0, kind)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _read_parts(batches: Iterator[pa.RecordBatch], folder: str, ids: bool) -> Iterator[pa.RecordBatch]:
    fs, base = pafs.FileSystem.from_uri(folder)
    for batch in batches:
        for part in batch.to_pylist():
            path = f"{base}/{part['name']}"
            tokens, bounds, names = _mapped(fs, f"{path}.ids", f"<u{part['width']}"), _mapped(fs, f"{path}.off", "<u8"), _mapped(fs, f"{path}.doc", "<i8")
            for at in range(0, len(names), 1024):
                some = np.array(names[at : at + 1024])
                edges = np.array(bounds[at : at + len(some) + 1], np.int64)
                own = [np.asarray(tokens[a:b], "<u4") for a, b in zip(edges[:-1], edges[1:], strict=True)]
                columns = [
                    pa.array(some, pa.int64(), mask=some == NO_ID), pa.array(edges[:-1] + part["base"]), pa.array(np.diff(edges)),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()),
                ]
                if ids:
                    columns.append(pa.array([x.tolist() for x in own], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])


def read_tokens(manifest: DataFrame, folder: str, ids: bool = False) -> DataFrame:
    """Per document of the files, in their order: doc_id, start, n_tokens, ids_crc32, and on request the ids."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids
    spread = manifest.repartition(max(1, manifest.count()), "part")
    return spread.mapInArrow(partial(_read_parts, folder=folder_uri(folder), ids=ids), schema)


def token_digests(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Writes the documents to a new folder in the shared one and reads them back."""
    folder = f"{scratch_path(docs.sparkSession)}-tokens"
    return read_tokens(write_tokens(docs, folder, tokenizer, end), folder)


def default_tokenizer(spark: SparkSession) -> str:
    """The vocabulary file: the setting `spark.tillroll.tokenizer`, or else the installed public one."""
    named = spark.conf.get("spark.tillroll.tokenizer", None)
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
