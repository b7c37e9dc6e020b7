"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has 64 bits.  Bit i belongs to a vector m(i), one of the 15 non-zero vectors of 4
bits.  Table v, one for each non-zero v, compares the bits whose m(i) has an odd inner product with
v.  Two fingerprints that differ in at most 3 bits involve at most 3 vectors m(i); these span at
most 3 of 4 dimensions, so some v is orthogonal to all of them, and in table v the two agree.  So
every pair within the radius meets in a table: nothing is left to chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.shared import components, packed, staged, text_key

BITS = 64
SEED = 42
#: Fingerprints of a bucket that are compared with each other in one task.  Larger buckets take `hub_rows`.
BLOCK = 4096
PIECE = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the word shingles of a UTF-8 text; zero for a text without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined, size = b" ".join(parts), min(shingle, len(parts))
    ends = list(accumulate(map(len, parts), lambda a, b: a + 1 + b))
    starts = [e - len(w) for e, w in zip(ends, parts, strict=True)]
    digest, n = xxhash.xxh64_intdigest, len(parts) - size + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, PIECE):
        spans = zip(starts[at : min(n, at + PIECE)], ends[at + size - 1 :], strict=False)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def masks(radius: int = 3) -> list[int]:
    """The covering masks: 2^(radius + 1) - 1 of them, each of about half of the bits."""
    vectors = (1 << radius + 1) - 1
    return [
        sum(1 << i for i in range(BITS) if (i % vectors + 1 & v).bit_count() % 2) for v in range(1, vectors + 1)
    ]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        prints = [signed(fingerprint(t.as_py() or b"", shingle)) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(prints, pa.int64())], ["doc_id", "text_key", "fp"]
        )


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text_key and fingerprint (fp, a signed 64-bit number) of every document row."""
    raw = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
        F.col("text").cast("binary").alias("text"),
    )
    return raw.mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id bigint, text_key bigint, fp bigint")


def forest(values: np.ndarray, offsets: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect, within each block of values, exactly those that links within the radius connect.

    Each value is joined to one of its group, so there are fewer edges than values.
    """
    sizes = np.diff(offsets)
    left = np.repeat(offsets[1:], sizes) - np.arange(len(values))  # this one and those after it in its block
    root, active, k = np.arange(len(values)), np.arange(len(values)), 1
    while (active := active[left[active] > k]).size:
        near = active[np.bitwise_count(values[active] ^ values[active + k]) <= radius]
        near = near[root[near] != root[near + k]]
        if near.size:
            for a, b in zip(root[near].tolist(), root[near + k].tolist(), strict=True):
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
            while (root[root] != root).any():
                root = root[root]
        k += 1
    moved = np.flatnonzero(root != np.arange(len(values)))
    return values[moved], values[root[moved]]


def _block_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks = batch.column("members")
        offsets = np.asarray(blocks.offsets, np.int64)
        a, b = forest(np.asarray(blocks.values)[offsets[0] : offsets[-1]].astype(np.int64).view(np.uint64), offsets - offsets[0], radius)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def _hub_rows(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Hubs of the fingerprints of large buckets: all values within ceil(radius / 2) bits, `near` those within floor(radius / 2)."""
    flips = []
    for mask in masks(radius):
        free = [i for i in range(BITS) if not mask >> i & 1]
        steps = [(0, True)]
        for n in range(1, -(-radius // 2) + 1):
            steps += [(sum(1 << i for i in c), n <= radius // 2) for c in combinations(free, n)]
        flips.append((np.array([s for s, _ in steps], np.uint64), np.array([n for _, n in steps])))
    for batch in batches:
        for number, value in zip(batch.column("tab").to_pylist(), batch.column("fp").to_pylist(), strict=True):
            bits, near = flips[number]
            hubs = (np.uint64(value % (1 << BITS)) ^ bits).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(hubs), number, np.int32)), pa.array(hubs), pa.array(near), pa.array(np.full(len(hubs), value, np.int64))],
                ["tab", "hub", "near", "fp"],
            )


def hub_links(crowded: DataFrame, radius: int) -> DataFrame:
    """Links in buckets too large to compare in one task, exactly, with rows in proportion to the bucket.

    A pair within the radius has a value between the two that is within half the radius, rounded
    down, of one and half, rounded up, of the other; conversely any two such members of a hub are
    within the radius.  So, in each hub that has a near member, all members belong together.  A hub
    has at most as many members as it has neighbours in the bits its table leaves free.
    """
    rows = crowded.select("tab", "fp").mapInArrow(partial(_hub_rows, radius=radius), "tab int, hub bigint, near boolean, fp bigint")
    hubs = rows.groupBy("tab", "hub").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.collect_set("fp").alias("members"))
    return hubs.where(F.col("b").isNotNull() & (F.size("members") > 1)).select(F.explode("members").alias("a"), "b").where("a <> b")


def links(prints: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp): their components are those of all links within the radius."""
    spread = F.array(*[F.struct(F.lit(k).alias("tab"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bucket")) for k, m in enumerate(masks(radius))])
    rows = prints.select("fp", F.inline(spread))
    shared = rows.groupBy("tab", "bucket").count().where("count > 1")
    met = staged(rows.join(shared, ["tab", "bucket"]), "met")
    small = met.where(F.col("count") <= block).groupBy("tab", "bucket").agg(F.collect_list("fp").alias("members")).select("members")
    found = small.mapInArrow(partial(_block_links, radius=radius), "a bigint, b bigint")
    crowded = met.where(F.col("count") > block)
    return found if crowded.isEmpty() else found.union(hub_links(crowded, radius))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """doc_id, text_key, fp, root (the fingerprint that names the group) and component_id of every document row.

    Fingerprints that differ in at most `radius` bits are linked; component_id is the smallest
    doc_id of the connected group.  Equal fingerprints are one node, so copies add no links.
    NULL and empty texts have fingerprint zero and are linked like any other.  A NULL doc_id is
    never a component_id unless no row of the group has one.  Rows with the same doc_id are each
    judged; other columns are ignored.
    """
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = staged(components(links(distinct.select("fp"), radius, block)), "roots")
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    of = staged(of, "components")
    named = of.join(of.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "root", "component_id")
    return prints.join(named, "fp")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The documents with one of each near-duplicate group: the one with the smallest doc_id, all columns kept.

    A row repeated with the same id and text stays once.  Documents without an id come last in
    their group.
    """
    found = near_duplicates(docs, shingle, radius)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("text_key").alias("k"))
    kept = found.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.i").alias("_id"), F.col("first.k").alias("_key"))
    rows = packed(docs)
    same = rows["id"].eqNullSafe(kept["_id"]) & (rows["key"] == kept["_key"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "key"]).select("doc.*")
