"""The operators on documents against plain restatements, on odd rows, on nothing, and on held-out labels."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import DUCK_KIND, SPARK_KIND, differences, duck_rows, spark_rows
from tests.llm import cases
from tillroll.llm import covering_simhash, entropy_mix, fuzzy_lines, line_frequency, perspectives, pu_quality, token_files, toxicity_gru, url_templates, winnowing
from tillroll.llm.queries import ORACLE, QUERIES
from tillroll.llm.shared import components, text_key

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def triples(spark, data_dir):
    return cases.small(spark, data_dir)


@pytest.fixture(scope="module")
def docs(spark, triples):
    return cases.frame(spark, triples).repartition(5)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(name, spark, duck, data_dir):
    SPARK_KIND.setdefault("boolean", "bool"), DUCK_KIND.setdefault("BOOLEAN", "bool")
    assert differences(spark_rows(QUERIES[name](spark, data_dir)), duck_rows(duck, ORACLE[name])) == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(200, 260)] + [(7, 7), (500, 499), (499, 500)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{k: 100 for k in range(200, 260)}, 499: 499, 500: 499}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# SimHash

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, radius=3):
    parent = list(range(len(values)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(values, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= radius) + i + 1:
            x, y = top(i), top(int(j))
            parent[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(values))]


def test_masks_cover_every_triple():
    masks = covering_simhash.masks(3)
    assert len(masks) == 15
    rng = np.random.default_rng(1)
    for _ in range(3000):
        flipped = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(flipped & m == 0 for m in masks)


@pytest.mark.parametrize("block", [covering_simhash.BLOCK, 3])
def test_simhash_groups(spark, triples, docs, block):
    """block=3 sends nearly all buckets through hubs: both ways give the same groups."""
    got = covering_simhash.near_duplicates(docs, block=block).select("doc_id", "text_key", "fp", "component_id").collect()
    prints = [plain_fingerprint(t) for _, t, _ in triples]
    groups = plain_groups(prints)
    first = defaultdict(list)
    for (i, _, _), g in zip(triples, groups, strict=True):
        if i is not None:
            first[g].append(i)
    want = Counter((i, p, min(first[g]) if first[g] else None) for (i, _, _), p, g in zip(triples, prints, groups, strict=True))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want


def test_large_buckets_by_hubs(spark):
    """A crowd of fingerprints within few bits of each other, compared in tasks and through hubs."""
    rng = np.random.default_rng(3)
    crowd = {0x0F0F0F0F0F0F0F0F}
    while len(crowd) < 60:
        crowd.add(int(rng.choice(sorted(crowd))) ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 5)), replace=False)))
    values = sorted(crowd)
    frame = spark.createDataFrame([(covering_simhash.signed(v),) for v in values], "fp bigint")
    want = plain_groups(values)
    for block in (4096, 1):
        found = {r.node % (1 << 64): r.root for r in components(covering_simhash.links(frame, 3, block)).collect()}
        got = [found.get(v, covering_simhash.signed(v)) for v in values]
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_one_of_each_group(spark, triples, docs):
    kept = covering_simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = plain_groups([plain_fingerprint(t) for _, t, _ in triples])
    want = set()
    for g in set(groups):
        want.add(min(((i is None, i or 0, t or "") for (i, t, _), x in zip(triples, groups, strict=True) if x == g), key=lambda x: x[:2])[:2])
    got = [((r.doc_id is None), r.doc_id or 0) for r in kept.collect()]
    assert len(got) == len(set(groups)) and set(got) == want
    assert covering_simhash.one_of_each(cases.empty(spark)).count() == 0


# Winnowing

def plain_contamination(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    hit, named = set(), set()
    for item_id, item in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").translate({i: i + 32 for i in range(65, 91)}))
        size = min(13, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(words) - size + 1 if windows else 0):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                named.add(item_id)
    return len(words), len(hit), sorted(map(str, named - {None})), bool(hit) and 20 * len(hit) >= len(words)


def test_winnowing(spark, triples):
    span = " ".join(f"q{i}" for i in range(40))
    items = [(1, span), (2, "Same ID"), (3, None), (4, ""), (5, "zz"), (None, "other text"), (6, " ".join(f"q{i}" for i in range(20, 33))), (6, "again"), (7, "same x same x same x same x same x same x same x")]
    tails = [
        (1001, "so " * 30 + " ".join(f"q{i}" for i in range(3, 16)) + " end", "s"), (1002, "Q0 q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11", "s"),
        (1003, span + " " + span, "s"), (1004, "zz zz", "s"), (1005, "same x " * 30, "s"), (1006, ("pad " * 500) + span, "s"),
    ]
    rows = triples + tails
    got = winnowing.contamination(cases.frame(spark, rows).repartition(4), spark.createDataFrame(items, "item_id bigint, text string"))
    want = Counter((i, *plain_contamination(t, items)[:2], tuple(plain_contamination(t, items)[2]), plain_contamination(t, items)[3]) for i, t, _ in rows)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got.collect()) == want
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert winnowing.contamination(cases.frame(spark, rows), none).where("n_hit > 0").count() == 0
    assert winnowing.contamination(cases.empty(spark), spark.createDataFrame(items, "item_id bigint, text string")).count() == 0


# Mixing

def test_mix(spark, triples, docs):
    got = entropy_mix.mixed(docs).collect()
    sizes = Counter()
    for _, t, s in triples:
        sizes[s] += len(SPACE.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        share = (total - sum(3 * sizes[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in sizes if s not in full and 3 * sizes[s] <= share * weight[s]}
        if not more:
            break
        full |= more
    target = {s: 3 * sizes[s] if s in full else share * weight[s] for s in sizes}
    taken = Counter()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(SPACE.findall(t or ""))) for i, t, _ in triples)
    longest = defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= 3 and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.copies * r.size
        longest[r.source] = max(longest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1
    key = lambda r: (str(r.doc_id), r.text_key, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, entropy_mix.mixed(docs.repartition(3)).collect()))
    out = entropy_mix.repeated(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    assert entropy_mix.mixed(cases.empty(spark)).count() == 0 and entropy_mix.repeated(cases.empty(spark)).count() == 0


def test_mix_is_close_on_the_table(spark, data_dir):
    rows = QUERIES["op2_entropy_mix"](spark, data_dir).join(spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "source"), "doc_id")
    for r in rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.01)


# Classifiers

def accuracy(found, labels, column, threshold):
    met = [r for r in found.join(labels, "doc_id").collect() if r.held_out]
    good = [r for r in met if r[column] == 1]
    bad = [r for r in met if r[column] == 0]
    higher = sum((g.score > b.score) + (g.score == b.score) / 2 for g in good for b in bad) / (len(good) * len(bad))
    return higher, sum((r.score >= threshold) == (r[column] == 1) for r in met) / len(met)


def test_quality_on_held_out_labels(spark, data_dir):
    directory = data_dir.replace("sf0.01", "sf0.1")
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    area, right = accuracy(QUERIES["op4_pu_quality"](spark, directory), labels, "quality", 0.7)
    assert area > 0.97 and right > 0.95


def test_toxicity_on_held_out_labels(spark, data_dir):
    directory = data_dir.replace("sf0.01", "sf0.1")
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    area, right = accuracy(QUERIES["op9_toxicity_gru"](spark, directory), labels, "toxic", 0.5)
    assert area > 0.92 and right > 0.95


def test_gradient_of_the_network():
    texts = [b"one bad word here and there", b"all fine words here", b"", b"a"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    net = toxicity_gru.Network(toxicity_gru.vocabulary_of(data, offsets, 1))
    piece = toxicity_gru.Piece(data, offsets, net.vocabulary, 4, 2)
    rows, labels = np.arange(len(piece.text)), np.arange(len(piece.text)) % 2
    _, grads = net.gradient(piece, rows, labels)
    for name, value in net.p.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        kept, step = value[at], 1e-2
        value[at] = kept + step
        up, _ = net.gradient(piece, rows, labels)
        value[at] = kept - step
        down, _ = net.gradient(piece, rows, labels)
        value[at] = kept
        assert (up - down) / (2 * step) == pytest.approx(float(grads[name][at]), rel=0.05, abs=1e-4)


@pytest.mark.parametrize("operator", [pu_quality.quality, toxicity_gru.toxicity])
def test_classifiers_on_odd_rows(spark, triples, docs, operator):
    labels = cases.labels(spark, triples)
    got = operator(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in triples)
    assert all(0 <= r.score <= 1 for r in got)
    folds, out = (4, 2) if operator is pu_quality.quality else (5, 0)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in got)
    assert operator(docs, labels.limit(0)).count() == len(triples)
    assert operator(cases.empty(spark), labels).count() == 0


def test_labels_of_the_held_out_fold_are_not_read(spark, triples, docs):
    labels = cases.labels(spark, triples)
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((str(r.doc_id), round(r.score, 6)) for r in pu_quality.quality(docs, x).collect()) for x in (labels, turned))
    assert a == b


# Token files

def test_token_files(spark, triples, docs, tmp_path):
    from tokenizers import Tokenizer

    path = token_files.default_tokenizer(spark)
    odd = triples + [(900100, "two  spaces\n\nblank line\tand a tab <|endoftext|> it's", "s"), (900101, " lead", "s"), (900102, "trail ", "s")]
    frame = cases.frame(spark, odd).repartition(4)
    manifest = token_files.write_tokens(frame, str(tmp_path), path)
    got = sorted(token_files.read_tokens(manifest, str(tmp_path), ids=True).collect(), key=lambda r: r.start)
    tokenizer, at = Tokenizer.from_file(path), 0
    for r, (i, t, _) in zip(got, sorted(odd, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())), strict=True):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r["ids"]) == (i, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_files.token_digests(cases.empty(spark), path).count() == 0


# Line rules

def test_line_frequency_on_odd_rows(spark, triples, docs):
    shared = [(2000 + k, f"Shared  line of WORDS\nown{k} line of twelve different words number {k} to keep it long enough", "h") for k in range(6)]
    thin = [(3000 + k, "shared line of words " * 1 + f"\nshared line of words\nshared line of words\nand x{k} y{k}", "h") for k in range(2)]
    got = {(r.doc_id, r.n_words): r for r in line_frequency.judged(cases.frame(spark, triples + shared + thin), line_documents=5, line_share=0.1).collect()}
    assert got[(2000, 17)].n_removed == 4 and got[(2000, 17)].kept
    assert got[(3000, 15)].n_removed == 12 and not got[(3000, 15)].kept
    assert got[(900001, 0)].base_failed and got[(900005, 0)].base_failed and not got[(900001, 0)].kept
    assert got[(900004, 120000)].n_repeat_words == 120000 - 0 or got[(900004, 120000)].base_failed
    assert line_frequency.judged(cases.empty(spark)).count() == 0


def test_line_frequency_in_a_large_source(spark):
    """A line of thousands of documents is removed however many other documents its source has."""
    text = F.concat_ws("\n", F.when(F.col("id") < 2000, "subscribe to our letter"), F.format_string("%d some text of its own with ten words in all", "id"))
    got = line_frequency.judged(spark.range(210_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("big").alias("source")))
    assert [tuple(r) for r in got.groupBy(F.col("doc_id") < 2000, "n_removed").count().orderBy("n_removed").collect()] == [(False, 0, 208_000), (True, 4, 2000)]


# Fuzzy lines

def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def plain_simhash(line):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in line.split(" ")]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("rounds", [0, 2])
def test_fuzzy_lines(spark, rounds):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{rng.integers(400)}" for _ in range(60)) for _ in range(4)]
    texts = []
    for b in base:
        for _ in range(12):
            words = b.split(" ")
            for place in rng.choice(60, int(rng.integers(0, 5)), replace=False):
                words[place] = f"v{rng.integers(50)}"
            texts.append(" ".join(words).upper() if rng.random() < 0.2 else "  ".join(words))
    rows = [(k, f"{t}\n\n{texts[(k * 7) % len(texts)]}\nonly {k}", "s") for k, t in enumerate(texts)] + [(None, None, None), (77, "", "s"), (505, "Only 5", "s")]
    got = fuzzy_lines.fuzzy(cases.frame(spark, rows), rounds=rounds).collect()
    lines = [(i, n, " ".join(raw.lower().split())) for i, t, _ in rows for n, raw in enumerate((t or "").split("\n")) if raw.strip()]
    distinct = sorted({x[2] for x in lines})
    edges = [round(k * 64 / 5) for k in range(6)]
    whole = [plain_simhash(x) for x in distinct]
    prints = [[x >> a & (1 << b - a) - 1 for a, b in zip(edges, edges[1:], strict=False)] for x in whole]
    parent = list(range(len(distinct)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(distinct)):
        for j in range(i):
            a, b = distinct[i], distinct[j]
            met = sum(x == y for x, y in zip(prints[i], prints[j], strict=True)) >= 2 and (whole[i] ^ whole[j]).bit_count() <= 8
            if met and edit_distance(a, b) <= int(round(0.2 * max(len(a), len(b)), 6)):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    group = {x: top(k) for k, x in enumerate(distinct)}
    assert Counter((r.doc_id, r.nth) for r in got) == Counter((i, n) for i, n, _ in lines)
    of = {(i, n): group[x] for i, n, x in lines}
    pairs = {(r.component, of[(r.doc_id, r.nth)]) for r in got}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    first = {}
    for i, n, x in sorted(lines, key=lambda t: (t[0] is None, t[0] or 0, t[1])):
        first.setdefault(group[x], (i, n))
    assert {(r.doc_id, r.nth) for r in got if r.kept} == set(first.values()) and sum(r.kept for r in got) == len(first)
    assert fuzzy_lines.fuzzy(cases.empty(spark)).count() == 0


def test_fuzzy_lines_find_what_edit_similarity_finds(spark):
    """Recall against edit similarity over all pairs, and nothing that it doesn't connect."""
    rng = np.random.default_rng(8)
    texts = ["\u4f60\u597d\u4e16\u754c" * 6 + "abcdefgh"[k:] for k in range(3)]
    for n, changed in ((6, 1), (10, 1), (20, 1), (20, 2), (40, 4), (60, 5)):
        for _ in range(25):
            words = ["".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(2, 8)))) for _ in range(n)]
            copy = list(words)
            for place in rng.choice(n, changed, replace=False):
                copy[place] = "".join(rng.choice(list("qrstuvwxyz"), int(rng.integers(2, 8))))
            texts += [" ".join(words), " ".join(copy)]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    component = {r.doc_id: r.component for r in fuzzy_lines.fuzzy(cases.frame(spark, rows), meet=fuzzy_lines.by_words).collect()}
    x = spark.createDataFrame([r[:2] for r in rows], "i int, x string")
    y = spark.createDataFrame([r[:2] for r in rows], "j int, y string")
    longer = F.greatest(F.length("x"), F.length("y"))
    close = x.join(y, (F.col("i") < F.col("j")) & (5 * F.levenshtein("x", "y") <= longer)).select("i", "j").collect()
    recall = sum(component[i] == component[j] for i, j in close) / len(close)
    print("recall", recall, len(close))
    assert len(close) > 110 and recall >= 0.97
    groups = dict(components(spark.createDataFrame(close, "a bigint, b bigint")).collect())
    whole = defaultdict(set)
    for i, c in component.items():
        whole[c].add(groups.get(i, i))
    assert all(len(g) == 1 for g in whole.values())


def test_fuzzy_lines_release_their_shuffles(spark):
    """Exchanges of the tables and of the texts don't lie on disk together until the driver collects its garbage."""
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        names = [f.rsplit("/", 1)[-1] for f in files.mkString("\n").split("\n")]
        return {f.split("_")[1] for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before, kept = shuffles(), spark.conf.get(fuzzy_lines.RELEASE, None)
    fuzzy_lines.fuzzy(cases.frame(spark, [(k, f"line {k // 2} of some words\nword {k}", "s") for k in range(200)]), meet=fuzzy_lines.by_words)
    left = shuffles() - before
    print("left", len(left))
    # Spark still holds those of a last action or two.
    assert len(left) <= 3 and spark.conf.get(fuzzy_lines.RELEASE, None) == kept


def test_similar_by_words_replaced_or_distance(spark):
    """Long lines that are similar word by word, shifted, or not at all."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(60)]
    line = " ".join(words)
    others = [" ".join(["zzzzzz"] * n + words[n:]) for n in (1, 11, 13, 30)] + [" ".join(["zz", *words]), " ".join(["new", *words[:-1]]), " ".join(words[::-1])]
    frame = spark.createDataFrame([(line, x) for x in others], "a string, b string")
    got = [r[0] for r in frame.select(fuzzy_lines._similar(F.col("a"), F.col("b"), 0.8)).collect()]
    assert got == [edit_distance(line, x) <= int(round(0.2 * max(len(line), len(x)), 6)) for x in others] and set(got) == {True, False}


def test_fuzzy_lines_that_meet_by_chance_are_not_compared(spark, monkeypatch):
    """Lines of a few common words and short lines of common letters: few pairs get as far as the edit distance, all near copies are found."""
    rng = np.random.default_rng(3)
    common, syllables = [a + b for a in "abcdefgh" for b in "xyz"], [a + b for a in "bdfgk" for b in "aeiou"]
    long = [" ".join([*rng.choice(common, 12, replace=False), *("".join(rng.choice(list("klmnopqrst"), 9)) for _ in range(24))]) for _ in range(300)]
    short = [" ".join([*["the of and"] * 2, *("".join(rng.choice(syllables, 3)) for _ in range(6))]) for _ in range(300)]
    texts = [*long, *short]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(1000 + k, t[:40] + "q" + t[41:], "s") for k, t in enumerate(texts)]
    compared, verified = [], fuzzy_lines.verified
    monkeypatch.setattr(fuzzy_lines, "verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    component = {r.doc_id: r.component for r in fuzzy_lines.fuzzy(cases.frame(spark, rows), meet=fuzzy_lines.by_words).collect()}
    print("compared", compared)
    assert all(component[k] == component[1000 + k] for k in range(600)) and len(set(component.values())) == 600
    # 14450 before pairs were told apart by their sketches.
    assert sum(compared) < 6000


def test_fuzzy_lines_sketches_keep_similar_short_lines(spark):
    """Changed letters, also where trigrams repeat: what the lengths and the distance allow, sketches allow too."""
    rng = np.random.default_rng(5)
    rows, letters = [], list("ab ")
    for k in range(300):
        a = "x" + "".join(rng.choice(letters if k % 2 else list("abcdefghij "), int(rng.integers(3, 78))))
        b = list(a)
        for _ in range(int(0.2 * len(a))):
            at = int(rng.integers(0, len(b)))
            b[at : at + 1] = [[], ["z"], [b[at], "y"]][int(rng.integers(0, 3))]
        lines = [" ".join(x.split()) for x in (a, "".join(b))]
        if all(lines) and edit_distance(*lines) <= int(round(0.2 * max(map(len, lines)), 6)):
            rows += [(2 * k, lines[0]), (2 * k + 1, lines[1])]
    tables, near, alike = fuzzy_lines.by_words(spark.createDataFrame(rows, "key bigint, line string"), 0.8)
    of_letters = tables.where("mark < 0")
    x, y = (of_letters.select(*[F.col(c).alias(side + c) for c in of_letters.columns]) for side in "xy")
    fields = [lambda name, side=side: F.col(side + name) for side in "xy"]
    met = x.join(y, (F.col("xkey") % 2 == 0) & (F.col("ykey") == F.col("xkey") + 1))
    got = met.select((near(F.col("xmark"), F.col("ymark")) & alike(*fields)).alias("kept")).collect()
    assert len(got) == len(rows) / 2 > 100 and all(r.kept for r in got)


def test_aligned_is_no_less_than_the_distance(spark):
    """Words replaced, moved, dropped, doubled or joined; near copies come out similar without their distance."""
    rng = np.random.default_rng(6)
    pairs = [("a", "a"), ("a", "b"), ("a b", "b a"), ("a " * 20 + "a", "b"), ("a b c", "abc")]
    for _ in range(60):
        a = ["".join(rng.choice(list("abcd"), int(rng.integers(1, 6)))) for _ in range(int(rng.integers(5, 60)))]
        b = list(a)
        for _ in range(int(rng.integers(0, len(a)))):
            at = int(rng.integers(0, len(b)))
            b[at : at + 1] = [["new"], [], [b[at], b[at]], [b[at] + "x"], [b[at], *["more"] * 10]][int(rng.integers(0, 5))] or ["e"]
        pairs.append((" ".join(a), " ".join(b)))
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(200)]
    near = " ".join([*words[:20], "new", *words[21:90], *words[92:150], "and", "one", *words[150:]])
    frame = spark.createDataFrame([(a, b) for a, b in [*pairs, (" ".join(words), near)]], "a string, b string")
    got = [r[0] for r in frame.select(fuzzy_lines._aligned(F.col("a"), F.col("b"))).collect()]
    assert all(n >= edit_distance(a, b) for n, (a, b) in zip(got, pairs, strict=False)) and got[:2] == [0, 1]
    assert edit_distance(" ".join(words), near) <= got[-1] <= 40


def test_fuzzy_lines_on_odd_rows(spark, docs):
    assert fuzzy_lines.fuzzy(docs).where("kept").count() > 0


# Urls

def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Example.COM/en/1", "https://www.example.com/en/2#x", "http://a.example.com/en/", "http://com/x?y", "http://acom/x",
            "http://x.net/es/1", "http://net/fr/", "http://x.net", "http://x.com?q=/en/", "a://b://c.com/d", "http://EXAMPLE.com/EN/"]
    bad = [f"http://shop.net/es/{k}" for k in range(40)] + [f"http://shop.net/fr/{k}.html" for k in range(40)] + [f"http://shop.net/odd/{k}" for k in range(3)]
    mixed = [f"http://news.org/a{k}/{k}" for k in range(30)]
    rows = [(k, u, None) for k, u in enumerate(urls + bad + mixed + mixed[:3])] + [(None, "http://z.com/", "h")]
    got = url_templates.judge(spark.createDataFrame(rows, "page_id bigint, url string, host string")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    want = [("", "", None), ("", "", None), ("", "", None), ("", "", None), ("example.com", "/en/1", "example.com/en/"), ("www.example.com", "/en/2", "www.example.com/en/"),
            ("a.example.com", "/en/", "example.com/en/"), ("com", "/x", "com/"), ("acom", "/x", None), ("x.net", "/es/1", "net/es/"), ("net", "/fr/", "net/fr/"), ("x.net", "", None),
            ("x.com", "", None), ("b:", "//c.com/d", None), ("example.com", "/EN/", "com/")]
    assert [(by[k].host, by[k].path, by[k].rule) for k in range(len(urls))] == want
    assert [by[k].verdict for k in (4, 5, 6, 7, 9, 10)] == ["block", "allow", "block", "allow", "block", "block"]
    shop = [r for r in got if r.host == "shop.net"]
    assert {r.template for r in shop} == {"/es/*", "/fr/*", "/odd/*"} and len({r.branch for r in shop}) == 2
    assert {r.verdict for r in shop if r.template == "/odd/*"} == {"block"}  # nearly all of the host is blocked
    assert {(r.template, r.verdict) for r in got if r.host == "news.org"} == {("/*/*", "allow")}
    assert url_templates.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


@pytest.mark.parametrize("sections", [8, 9, 100])
def test_urls_of_many_sections(spark, sections):
    """A few blocked pages don't block the rest of a host, however many sections it has."""
    urls = [f"http://big.net/{'es' if s == 0 else f'part-x{s}'}/{name}x{k}" for s in range(sections) for k in range(20) for name in ("p", "q")]
    got = url_templates.judge(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")).collect()
    assert len(got) == len(urls)
    assert {r.verdict for r in got if r.path.startswith("/es/")} == {"block"} and {r.template for r in got if r.path.startswith("/es/")} == {"/es/*"}
    assert {r.verdict for r in got if not r.path.startswith("/es/")} == {"allow"}


# Dialogues

def test_perspectives(spark):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "ann", "tie"), (1, None, None, "late"), (2, 0, "system", "alone"), (None, 0, "cy", "x"), (3, 0, "ann", "y"), (3, 0, "ann", "y")]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("piece", F.lit("z"))
    got = {(r.conv_id, r.perspective, r.piece): r for r in perspectives.perspectives(frame, piece=3).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (None, "cy", 0), (3, "ann", 0)}
    r = got[(1, "ann", 0)]
    assert r.rendered == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi < |im_end|><|im_end|>\n<|im_start|>assistant\ntie<|im_end|>\n"
    )
    assert [r.rendered[s["begin"] : s["end"]] for s in r.spans] == ["Hi < |im_end|><|im_end|>", "tie<|im_end|>"]
    r = got[(1, "bob", 1)]
    assert r.rendered == "<|im_start|>assistant\n<|im_end|>\n<|im_start|>user name=unknown\nlate<|im_end|>\n" and r.n_own == 1
    assert got[(3, "ann", 0)].n_turns == 2
    assert perspectives.perspectives(frame.limit(0)).count() == 0


# Pipeline

def test_pipeline_stages(spark, data_dir, tmp_path):
    """Each stage keeps the columns, and its decisions are those of its operator on what came before."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{data_dir}/labels.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, data_dir)
        out.write.parquet(f"{tmp_path}/{number}")
        out = spark.read.parquet(f"{tmp_path}/{number}")
        ids = Counter(r.doc_id for r in out.select("doc_id").collect())
        if number < 4:
            assert out.columns == columns
        if number == 0:
            assert set(ids) == {r.doc_id for r in pu_quality.quality(docs, labels).where("score >= 0.7").collect()}
        if number == 1:
            assert set(ids) == {r.component_id for r in covering_simhash.near_duplicates(docs).collect()}
        if number == 2:
            items = [tuple(r) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
            assert set(ids) == {r.doc_id for r in docs.collect() if not plain_contamination(r.text, items)[3]}
        if number == 3:
            assert ids == {r.doc_id: r.copies for r in entropy_mix.mixed(docs).collect() if r.copies}
        if number == 4:
            assert ids == Counter(r.doc_id for r in docs.collect()) and out.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == out.agg(F.sum("n_tokens")).first()[0]
        docs = out


def test_pipeline_on_odd_rows(spark, triples, docs, tmp_path):
    cases.labels(spark, triples).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a text without a source")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (docs, cases.empty(spark)):
        frame = start
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            frame = stage(spark, frame, str(tmp_path))
            if number < 4:
                assert frame.columns == docs.columns
        assert (frame.count() > 0) == (start is docs)


def test_text_key_tells_rows_apart(spark):
    assert spark.range(1).select(text_key(F.lit("a")) == text_key(F.lit("b"))).first()[0] is False
