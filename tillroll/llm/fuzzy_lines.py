"""Fuzzy duplicate lines: tables in which lines meet, edit similarity, one occurrence of each group.

Lines that meet in a table are linked if their edit similarity, 1 - distance / longer length, is at
least 0.8.  There are two ways to meet.

`by_words`, which the query takes: least hash values of a line's words, and for short lines and those of
long words of its character trigrams, in tables of four values each.  Lines that share two thirds of
their different words miss each other in about one of a hundred cases, those that share more hardly
ever.  Pairs are passed over before their distance is computed where the lengths or, of those that meet by
trigrams, too few common ones rule the similarity out, and where lines that meet by words share less
than a fifth of their different words; they would meet in three of a hundred cases at most.

`by_bits`: the 64 bits of a line's SimHash are cut into five blocks, and each pair of blocks is a table.
Lines that differ in at most three bits agree in two blocks at least, so they meet in a table; those
of up to `RADIUS` bits that agree in two blocks are taken along, and others aren't compared.  One changed
word moves more bits than that on most lines, so it finds near-copies of long lines only.

Not all pairs of a crowded bucket are compared.  Rounds of pivots come first: in each bucket all
lines are compared with one, first the smallest and then one of those that aren't connected to it,
and what is linked becomes one component.  Then only pairs of a bucket that lie in different
components are compared, as pairs of one component have nothing to add.  The components are those
of all links.  All of it is made of DataFrame functions.
"""

from __future__ import annotations

import random
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.llm.shared import SPACE_RUN, SPACES, components, staged
from tillroll.sources.scratch import scratch_path

BITS, BLOCKS = 64, 5
RADIUS = 8
SIMILARITY = 0.8
#: Tables of `by_words`, the least values that agree in a table, and how many tables each value serves.
TABLES, AGREE, SERVES = 20, 4, 2
#: Lines of up to so many characters, or with words of more characters than that on average, meet by their trigrams too.
SHORT_LINE, LONG_WORD = 80, 12
#: 64-bit numbers that a sketch's bits are kept in.
SKETCH = 16
#: The part of their different words that lines share at least to be compared.
SHARED = 0.2
#: Words among which a word is looked for in order.
AHEAD = 32
TOGETHER = 8
#: Stretches of more letters are not compared.
STRETCH = 200
#: Tables dealt to buckets at a time.
AT_ONCE = 5
#: A column of a row by its name.
Fields = Callable[[str], Column]
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rounds of pivots before the remaining pairs are compared.
ROUNDS = 2


def normal_lines(docs: DataFrame) -> DataFrame:
    """doc_id, number of the line in its text, and the line: its words, lower-cased, one space apart."""
    lines = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("nth", "raw")).where(F.col("raw").rlike(r"[^\x20\x09-\x0D]"))
    bare = F.btrim(F.lower("raw"), F.lit(SPACES))
    # Most lines have lone spaces only and stay as they are.
    line = F.when(bare.rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace(bare, SPACE_RUN, " ")).otherwise(bare)
    return lines.select("doc_id", "nth", line.alias("line"))


def simhash(lines: DataFrame) -> DataFrame:
    """key and simhash of distinct lines (key, line).

    Counts of set bits are summed two to a number, in halves of 32 bits; the sums are partial
    aggregates over the words, so a long line is no row of its own size anywhere.
    """
    hashed = lines.select("key", F.explode(F.split("line", " ")).alias("word")).select("key", F.xxhash64("word").alias("h"))

    def pair(i: int) -> Column:
        return F.shiftrightunsigned("h", i).bitwiseAND(1) + F.call_function("shiftleft", F.shiftrightunsigned("h", i + 32).bitwiseAND(F.lit(1).cast("bigint")), F.lit(32))

    sums = hashed.groupBy("key").agg(F.count("*").alias("n"), *[F.sum(pair(i)).alias(f"s{i}") for i in range(32)])
    bits = F.lit(0).cast("bigint")
    for i in range(32):
        low, high = F.col(f"s{i}").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(f"s{i}", 32)
        bits = bits + F.when(2 * low > F.col("n"), 1 << i).otherwise(0)
        # The highest bit is the sign.
        bits = bits + F.when(2 * high > F.col("n"), (1 << i + 32) if i < 31 else -(1 << 63)).otherwise(0)
    return sums.select("key", bits.alias("simhash"))


def _by_key(rows: DataFrame, kind: str, compression: str) -> DataFrame:
    """The rows written once in buckets of their key: what is summed by key or joined on it later doesn't move them again."""
    spark = rows.sparkSession
    name, parts = f"{kind}_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.format("parquet").option("path", f"{scratch_path(spark)}-{kind}").option("compression", compression)
    writer.bucketBy(parts, "key").sortBy("key").saveAsTable(name)
    return spark.table(name)


def kept_by_key(lines: DataFrame) -> DataFrame:
    """Distinct lines (key, line), written in buckets of their key."""
    return _by_key(lines.groupBy("key").agg(F.first("line").alias("line")), "lines", "zstd")


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= RADIUS


def by_bits(lines: DataFrame, similarity: float) -> tuple[DataFrame, Callable[[Column, Column], Column], Callable[[Fields, Fields], Column]]:
    """key, mark (the SimHash) and tables, a bucket for each pair of blocks, which marks may be linked, and all sketches may."""
    hashes = staged(simhash(lines), "simhashes")
    edges = [round(k * BITS / BLOCKS) for k in range(BLOCKS + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
    pairs = [x | y for x, y in combinations(masks, 2)]
    signed = [m - (1 << BITS) if m >> BITS - 1 else m for m in pairs]
    spread = F.array(*[F.xxhash64(F.lit(k), F.col("simhash").bitwiseAND(F.lit(m))) for k, m in enumerate(signed)])
    return hashes.select("key", F.col("simhash").alias("mark"), spread.alias("tables")), _near, lambda a, b: F.lit(True)


def _least(features: DataFrame, kind: int) -> DataFrame:
    """key, mark (the line's length, below 0 for the second kind), tables and sketch of lines given by their features (key, size, h, own).

    The sketch is a set of bits, one for each feature as told apart by `own`, and their number.
    """
    rng, values = random.Random(kind), TABLES * AGREE // SERVES
    flips = [rng.getrandbits(63) for _ in range(values)]
    place, bit = F.shiftrightunsigned("own", 58).cast("int") % SKETCH, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned("own", 52).bitwiseAND(63).cast("int"))
    marked = features.select("key", "size", "h", place.alias("place"), bit.alias("bit"))
    bits = [F.bit_or(F.when(F.col("place") == i, F.col("bit")).otherwise(F.lit(0).cast("bigint"))).alias(f"b{i}") for i in range(SKETCH)]
    least = marked.groupBy("key").agg(F.first("size").alias("mark"), *[F.min(F.xxhash64(F.col("h").bitwiseXOR(F.lit(f)))).alias(f"m{i}") for i, f in enumerate(flips)], *bits)
    dealt = [i for _ in range(SERVES) for i in rng.sample(range(values), values)]
    tables = [dealt[k * AGREE : (k + 1) * AGREE] for k in range(TABLES)]
    spread = F.array(*[F.xxhash64(F.lit(kind), F.lit(k), *[f"m{i}" for i in sorted(t)]) for k, t in enumerate(tables)])
    n = reduce(Column.__add__, [F.bit_count(f"b{i}") for i in range(SKETCH)])
    return least.select("key", (-F.col("mark") if kind else F.col("mark")).alias("mark"), spread.alias("tables"), n.alias("n_bits"), *[f"b{i}" for i in range(SKETCH)])


def by_words(lines: DataFrame, similarity: float) -> tuple[DataFrame, Callable[[Column, Column], Column], Callable[[Fields, Fields], Column]]:
    """key, mark (the length), tables, a bucket for each table of least values, and sketch, which marks may be linked, and which sketches."""
    sized = lines.select("key", "line", F.length("line").alias("size"))
    of_words = sized.select("key", "size", F.explode(F.split("line", " ")).alias("part"))
    n_words = F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1
    letters = sized.where((F.col("size") <= SHORT_LINE) | (F.col("size") > LONG_WORD * n_words))
    trigrams = F.regexp_extract_all(F.concat(F.lit(" "), "line", F.lit(" ")), F.lit("(?s)(?=(...))"), F.lit(1))
    of_letters = letters.select("key", "size", F.explode(trigrams).alias("part"))
    of_words, of_letters = (f.select("key", "size", F.xxhash64("part").alias("h")) for f in (of_words, of_letters))
    # A trigram that a line has twice counts twice.
    times = of_letters.groupBy("key", "size", "h").agg(F.count("*").alias("n")).select("key", "size", "h", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("nth"))
    kinds = [_least(f, kind) for kind, f in enumerate((of_words.withColumn("own", F.col("h")), times.withColumn("own", F.xxhash64("h", "nth"))))]

    def most(a: Column, b: Column) -> Column:
        return _most(F.greatest(F.abs(a), F.abs(b)), similarity)

    def alike(a: Fields, b: Fields) -> Column:
        both = reduce(Column.__add__, [F.bit_count(a(f"b{i}").bitwiseAND(b(f"b{i}"))) for i in range(SKETCH)])
        # A change of a letter takes three trigrams at most.
        letters = F.greatest(a("n_bits"), b("n_bits")) - 3 * most(a("mark"), b("mark"))
        return both >= F.when(a("mark") < 0, letters).otherwise(F.ceil(SHARED / (1 + SHARED) * (a("n_bits") + b("n_bits"))))

    return _by_key(kinds[0].union(kinds[1]), "tables", "snappy"), lambda a, b: F.abs(a - b) <= most(a, b), alike


def buckets(tables: DataFrame, near: Callable[[Column, Column], Column]) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs (a, b) of the buckets of two near lines with one of their marks, and the rows (bucket, key, mark) of larger ones, a frame for each deal.

    Buckets of different tables never meet, so the tables are dealt out some at a time: what lies
    in an exchange at once is a part of the rows.
    """
    pairs, crowded = [], []
    n = tables.select(F.max(F.size("tables"))).first()[0] or 0
    for at in range(1, n + 1, AT_ONCE):
        # One exchange serves both the sums and the rows.
        rows = tables.select("key", "mark", F.explode(F.slice("tables", at, AT_ONCE)).alias("bucket")).repartition("bucket")
        sums = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b"), F.min("mark").alias("low"), F.max("mark").alias("high"))
        met = staged(rows.join(sums.where("n > 1"), "bucket").where((F.col("n") > 2) | (F.col("key") == F.col("a")) & near(F.col("low"), F.col("high"))), "met")
        pairs.append(met.where("n = 2").select("a", "b", F.col("low").alias("mark")))
        crowded.append(met.where("n > 2").select("bucket", "key", "mark"))
    empty = tables.limit(0)
    return reduce(DataFrame.union, pairs, empty.select(F.col("key").alias("a"), F.col("key").alias("b"), "mark")), crowded


def _most(longer: Column, similarity: float) -> Column:
    """The largest distance that is similar enough."""
    return F.floor(F.round((1 - similarity) * longer, 6)).cast("int")


def _aligned(a: Column, b: Column) -> Column:
    """Letters to change if the words of two lines meet in the order found here, no less than the distance.

    Each word of the first line is looked for at the place reached in the second, with the word behind it
    also at the next ones; `TOGETHER` words that are found nowhere may stand for as many like ones.  Of the stretches between words that meet, short ones count by their
    distance, and of long ones the longer is changed whole.
    """
    def lined(words: Column) -> Column:
        """The words, and each with the one behind it."""
        return F.struct(words.alias("one"), F.zip_with(words, F.slice(words, 2, F.size(words)), lambda w, behind: F.concat_ws(" ", w, behind)).alias("two"))

    def changes(x: Column, y: Column) -> Column:
        longer, shorter = F.greatest(F.length(x), F.length(y)), F.least(F.length(x), F.length(y))
        return F.when(longer == 0, 0).when((shorter == 0) | (longer > STRETCH), longer + 1).otherwise(F.call_function("levenshtein", x, y))

    def walked(lines: Column) -> Column:
        first, second = lines["first"], lines["second"]

        def stretch(line: Column, start: Column, n: Column) -> Column:
            return F.array_join(F.slice(line["one"], start + 1, n), " ")

        def word(acc: Column, at: Column) -> Column:
            w, reached, n_missed = F.get(first["one"], at), acc["reached"], at - acc["since"]
            further = F.array_position(F.slice(second["two"], reached + 1, AHEAD), F.get(first["two"], at)).cast("int")
            # A word in place of one is none that is missing.
            one = (n_missed == 0) & (F.get(first["one"], at + 1) == F.get(second["one"], reached + 1))
            ahead = F.when(F.get(second["one"], reached) == w, 1).when(F.get(second["one"], reached + n_missed) == w, n_missed + 1).when(one, 0).otherwise(further)

            def met(n: Column) -> Column:
                between = changes(stretch(first, acc["since"], n_missed), stretch(second, reached, n - 1))
                cost = acc["cost"] + F.when((n == 1) & (n_missed == 0), 0).otherwise(between)
                return F.when(n > 0, F.struct((reached + n).alias("reached"), (at + 1).alias("since"), cost.alias("cost"))).when(n_missed + 1 == TOGETHER, beside).otherwise(acc)

            def close(x: Column) -> Column:
                together = F.struct((reached + TOGETHER).alias("reached"), (at + 1).alias("since"), (acc["cost"] + changes(x["a"], x["b"])).alias("cost"))
                return F.when(2 * changes(x["a"], x["b"]) <= F.length(x["a"]), together).otherwise(acc)

            beside = F.get(F.transform(F.array(F.struct(*[stretch(line, start, F.lit(TOGETHER)).alias(name) for line, start, name in ((first, acc["since"], "a"), (second, reached, "b"))])), close), F.lit(0))
            return F.get(F.transform(F.array(ahead), met), F.lit(0))

        def rest(acc: Column) -> Column:
            return acc["cost"] + changes(*(stretch(line, acc[start], F.size(line["one"])) for line, start in ((first, "since"), (second, "reached"))))

        start = F.struct(*[F.lit(0).alias(name) for name in ("reached", "since", "cost")])
        return F.aggregate(F.sequence(F.lit(0), F.size(first["one"]) - 1), start, word, rest)

    # What a function of elements refers to is computed for each of them, unless it is an element itself.
    split = F.transform(F.array(F.struct(F.split(a, " ").alias("a"), F.split(b, " ").alias("b"))), lambda x: F.struct(lined(x["a"]).alias("first"), lined(x["b"]).alias("second")))
    return F.get(F.transform(split, walked), F.lit(0))


def _similar(a: Column, b: Column, similarity: float) -> Column:
    """Edit similarity of at least `similarity`; lengths that rule it out are seen first."""
    longer, shorter = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    most = _most(longer, similarity)
    # With a bound the distance is computed in a band of that width, and is -1 beyond it: most similar lines pass without, or a narrow one.
    passed = F.when(longer > SHORT_LINE, _aligned(a, b) <= most).otherwise(F.call_function("levenshtein", a, b, F.floor(most / 4).cast("int")) >= 0)
    return (longer - shorter <= most) & F.when(passed, True).otherwise(F.call_function("levenshtein", a, b, most) >= 0)


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _shared(a: Column, b: Column) -> Column:
    """What sketches say of two lines' words, told from the words; true of lines that may have met by trigrams."""
    x, y = F.split(a, " "), F.split(b, " ")
    lettered = [(F.length(line) <= SHORT_LINE) | (F.length(line) > LONG_WORD * F.size(words)) for line, words in ((a, x), (b, y))]
    return (lettered[0] & lettered[1]) | (F.size(F.array_intersect(x, y)) >= SHARED * F.size(F.array_union(x, y)))


def verified(pairs: DataFrame, lines: DataFrame, similarity: float, words: bool = False) -> DataFrame:
    """Of the pairs (a, b) of keys those that are similar; with `words` those that share too few words are none."""
    left = pairs.join(lines.select(F.col("key").alias("a"), F.col("line").alias("left")), "a")
    both = left.join(lines.select(F.col("key").alias("b"), F.col("line").alias("right")), "b")
    like = _similar(F.col("left"), F.col("right"), similarity)
    return both.where(_shared(F.col("left"), F.col("right")) & like if words else like).select("a", "b")


def _rooted(rows: DataFrame, key: str, found: DataFrame, name: str) -> DataFrame:
    named = found.select(F.col("node").alias(key), F.col("root").alias(name))
    return rows.join(named, key, "left").withColumn(name, F.coalesce(name, key))


def linked(lines: DataFrame, similarity: float = SIMILARITY, rounds: int = ROUNDS, meet: Callable = by_bits) -> DataFrame:
    """Components (node, root) of the links between distinct lines."""
    tables, near, alike = meet(lines, similarity)
    sketch = [c for c in tables.columns if c not in ("key", "mark", "tables")]
    direct, crowded = buckets(tables, near)

    def fields(prefix: str) -> Fields:
        return lambda name: F.col(prefix + name)

    def may(a: Fields, b: Fields) -> Column:
        return near(a("mark"), b("mark")) & alike(a, b)

    if sketch:
        direct = direct.select("a", "b", F.when(F.col("mark") < 0, -1).otherwise(1).alias("kind")).distinct()
        for side in ("a", "b"):
            direct = direct.join(tables.select(F.col("key").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("mark", *sketch)]), side).where(F.col("kind") * F.col(f"{side}_mark") > 0)
        direct = direct.where(may(fields("a_"), fields("b_")))
    direct = staged(direct.select("a", "b").distinct(), "pairs")
    tried = direct.limit(0)
    links = found = None

    def open_rows(crowd: DataFrame) -> DataFrame:
        """Rows of buckets whose lines lie in more than one component, with their roots."""
        rows = _rooted(crowd, "key", found, "root")
        state = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        return rows.join(state, "bucket")

    def sketched(rows: DataFrame) -> DataFrame:
        # Marks are no part of the key, so that the sketches stay where they are; those of one line differ in sign.
        of_kind = tables.select("key", F.col("mark").alias("of"), *sketch)
        return rows.join(of_kind, "key").where(F.col("mark").cast("bigint") * F.col("of") > 0).drop("of") if sketch else rows

    def in_turn(work: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
        """What is found in the crowded buckets, half of their rows at a time, as sketches are wide."""
        halves = [reduce(DataFrame.union, half) for half in (crowded[::2], crowded[1::2]) if half]
        return reduce(DataFrame.union, [staged(work(half), name) for half in halves] or [direct.limit(0)])

    def add(pairs: DataFrame) -> None:
        nonlocal tried, links, found
        pairs = staged(pairs.join(tried, ["a", "b"], "left_anti"), "tried")
        new = verified(pairs, lines, similarity, bool(sketch))
        tried = tried.union(pairs)
        links = staged(new if links is None else links.union(new), "similar")
        found = staged(components(links), "components")

    def with_pivots(crowd: DataFrame, number: int) -> DataFrame:
        """Lines and one of the pivots of their buckets that they may be linked with."""
        rows = sketched(crowd if number == 0 else open_rows(crowd))
        pivot = (rows if number == 0 else rows.where("root = high")).groupBy("bucket").agg(F.min("key").alias("first"), *[F.min_by(c, "key").alias(f"first_{c}") for c in ("mark", *sketch)])
        chosen = rows.join(pivot, "bucket").where((F.col("key") != F.col("first")) & may(F.col, fields("first_")))
        return chosen.groupBy("key").agg(F.min("first").alias("first"))

    def across(crowd: DataFrame) -> DataFrame:
        """Pairs of a bucket that lie in different components."""
        rows = sketched(open_rows(crowd))
        x, y = (rows.select("bucket", *[F.col(c).alias(side + c) for c in ("key", "root", "mark", *sketch)]) for side in ("x_", "y_"))
        return x.join(y, "bucket").where((F.col("x_root") < F.col("y_root")) & may(fields("x_"), fields("y_"))).select(*_pairs(F.col("x_key"), F.col("y_key"))).distinct()

    for number in range(rounds):
        chosen = in_turn(lambda crowd, number=number: with_pivots(crowd, number), "chosen")
        if number == 0:
            # The line of a bucket of two that isn't its first.
            chosen = chosen.union(direct.select(F.col("b").alias("key"), F.col("a").alias("first")))
        # One pivot for each line and round is enough to connect a crowd.
        add(chosen.toDF("key", "first").groupBy("key").agg(F.min("first").alias("first")).select(*_pairs(F.col("key"), F.col("first"))).distinct())
    if found is None:
        found = direct.limit(0).select(F.col("a").alias("node"), F.col("b").alias("root"))
    apart = _rooted(_rooted(direct, "a", found, "ra"), "b", found, "rb").where("ra <> rb").select("a", "b")
    add(in_turn(across, "across").union(apart).distinct())
    return found


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go when it ends; what is needed further is written to the shared folder by then."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def fuzzy(docs: DataFrame, similarity: float = SIMILARITY, rounds: int = ROUNDS, meet: Callable = by_bits) -> DataFrame:
    """Every line with a word: doc_id, nth, key, component (key of its group) and kept.

    kept is true for the first occurrence of each group, by doc_id, NULL last, and number of the line.
    NULL and empty texts have no lines.  Where rows repeat an id, the first place may be theirs
    together; one of them keeps the line.  Lines are told apart by a 64-bit hash.  Other columns are ignored.
    `meet` is `by_bits` or `by_words`.
    """
    with _shuffles_released(docs.sparkSession):
        all_lines = normal_lines(docs).withColumn("key", F.xxhash64("line"))
        places = staged(all_lines.select("doc_id", "nth", "key").withColumn("row", F.monotonically_increasing_id()), "places")
        lines = kept_by_key(all_lines.select("key", "line"))
        found = linked(lines, similarity, rounds, meet).select(F.col("node").alias("key"), "root")
        placed = places.join(found, "key", "left").withColumn("component", F.coalesce("root", "key"))
        placed = staged(placed.select("doc_id", "nth", "key", "component", "row"), "placed")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("nth").alias("c"), F.col("row").alias("d"))
    first = placed.groupBy("component").agg(F.min(order).alias("first")).select("component", F.col("first.d").alias("first"))
    return placed.join(first, "component").select("doc_id", "nth", "key", "component", (F.col("row") == F.col("first")).alias("kept"))
