"""Periodic runs against a plain search, word by word and all at once, and the query against its contract."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm import cases
from tillroll.llm import periodic_runs
from tillroll.llm.queries import QUERIES, _with_planted_run

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every run by trying all periods at all places."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((i, j - i, q) for (i, j), q in found.items())


def searched(words, cuts=()):
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.array([numbers[w] for w in words], np.int64)
    search = periodic_runs.Catchers()
    for part in np.split(ids, sorted(c % (len(ids) + 1) for c in cuts)):
        search.append(part)
    return search.runs()


def repetitive(rng, n):
    """Words with runs of many periods beside, inside and across each other."""
    out = []
    while len(out) < n:
        kind = rng.integers(5)
        if kind == 0:
            out += rng.integers(0, 3, rng.integers(1, 40)).tolist()
        elif kind == 1:
            out += rng.integers(0, 1000, rng.integers(1, 60)).tolist()
        elif kind == 2 and out:
            out += out[-int(rng.integers(1, 90)) :] * int(rng.integers(1, 6))
        else:
            p = int(rng.integers(1, 70))
            out += (rng.integers(0, int(rng.integers(2, 9)), p).tolist() * int(rng.integers(2, 9)))[: int(rng.integers(5, 400))]
    return out[:n]


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_repetitive_words(seed):
    rng = np.random.default_rng(seed)
    words = repetitive(rng, int(rng.integers(20, 350)))
    want = plain_runs(words)
    assert searched(words) == want
    assert searched(words, rng.integers(0, 10_000, 12).tolist()) == want
    assert searched(words, range(len(words))) == want  # one word at a time


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=160), st.lists(st.integers(0, 400), max_size=5))
def test_runs_of_any_words(words, cuts):
    assert searched(words, cuts) == plain_runs(words)


def test_structured_words():
    fibonacci = [0], [0, 1]
    while len(fibonacci[1]) < 600:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    thue_morse = [bin(k).count("1") % 2 for k in range(600)]
    for words in (fibonacci[1][:600], thue_morse, [7] * 23, [7] * 24, [7] * 500, [1, 2] * 300, [1, 2, 3] * 8, list(range(7)) * 3, list(range(8)) * 3, [*range(100)] * 3, [*range(100)] * 3 + [0]):
        assert searched(words) == plain_runs(words)
        assert searched(words, [5, 100, 101, 300]) == plain_runs(words)


def test_one_long_run_is_cheap():
    search = periodic_runs.Catchers()
    search.append(np.zeros(400_000, np.int64))
    assert search.runs() == [(0, 400_000, 1)]


def contract(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs, keep = plain_runs(words), [True] * n
    for start, length, q in runs:
        keep[start + q : start + length] = [False] * (length - q)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), *best, milli, digest(listed), digest(" ".join(w for w, k in zip(words, keep, strict=True) if k)))


def odd_documents():
    rng = np.random.default_rng(5)
    out = [(k, " ".join(f"w{x}" for x in repetitive(rng, int(rng.integers(0, 250))))) for k in range(1000, 1120)]
    out += [(i, t) for i, t, _ in cases.rows([]) if i != 900004] + [(77, "b " * 30), (77, "b " * 30), (None, "c\td\n" * 40), (78, " \r\n\x0b")]
    return out + [(2000 + k, " ".join(map(str, range(n)))) for k, n in enumerate([1, 2, 3, 23, 24, 25, 26, 60] * 12)]


def test_query_follows_contract(spark, tmp_path):
    docs = odd_documents()
    spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, runs string, start int").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    frame = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert frame.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    order = lambda r: tuple((x is None, str(x)) for x in r)
    want = sorted((contract(i, t) for i, t in docs), key=order)
    assert sorted((tuple(r) for r in frame.collect()), key=order) == want
    assert sum(r[1] > 0 for r in want) > 40


def test_query_on_given_documents(spark, data_dir):
    """Of the given table: documents of up to 400 words, all of them checked."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()}
    small = {i for i, t in texts.items() if len((t or "").split()) <= 400}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, data_dir).collect()}
    assert got.keys() == texts.keys()
    assert {i: got[i] for i in small} == {i: contract(i, texts[i]) for i in small}


def test_operator_on_odd_rows(spark):
    triples = cases.rows([])
    found = periodic_runs.periodic_runs(cases.frame(spark, triples))
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = {(r.doc_id, r.n_words): r for r in found.collect()}
    assert len(found.collect()) == len(triples)
    long = rows[(900004, 120_000)]
    assert [tuple(r) for r in long.runs] == [(0, 120_000, 2 * 977 * 13)] and long.collapsed.count(" ") == 2 * 977 * 13 - 1
    assert rows[(900001, 0)].runs == [] and rows[(900001, 0)].collapsed == ""
    assert periodic_runs.periodic_runs(cases.empty(spark)).count() == 0
    assert _with_planted_run(cases.empty(spark)).count() == 0
