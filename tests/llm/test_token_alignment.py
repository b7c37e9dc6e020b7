"""Token alignment against whole texts encoded at once and aligned byte by byte."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm import cases
from tillroll.llm import token_alignment
from tillroll.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
ODD = [
    "a  b", " a", "a ", "  ", " ", "\n", "a\nb", "a \n b", "a\n\nb c", "x\t y z", "a b c", "a  b", "a  b c", "▁ a", "a ▁b c", "héllo w世\U0001f600\nx  y",
    "世 界 \U0001f9d1‍\U0001f680 k", "<|endoftext|> <s> </s> <0x41> x", "don't we'll  it's 's", "\x00 a \x00b", "\x1c a b\x1d c", "ﬁ ﬂ é é", "1234 56.78 !!! a,b", "\r\n x", "ᚠᛇᚻ᛫ᛒᛦᚦ ᚠᚱᚩᚠᚢᚱ", "\U00013080 \U00013081x", "a" * 300,
]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain(tools, text):
    """Groups of the whole text, by nothing but the bytes of its tokens."""
    a, b = tools
    if not text:
        return None
    letters = token_alignment.byte_letters()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_parts = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
        return None
    ends = []
    for parts in (a_parts, b_parts):
        n, out = 0, []
        for p in parts:
            n += len(p)
            out.append(n)
        ends.append(out)
    groups, x, y = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        u, v = ends[0].index(end, x) + 1, ends[1].index(end, y) + 1
        groups.append((a_ids[x:u], b_ids[y:v]))
        x, y = u, v
    return groups


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def want(tools, documents):
    found = [(i, plain(tools, t)) for i, t in documents]
    pairs = Counter((a[-1], b[-1]) for _, groups in found for a, b in groups or [])
    most = Counter()
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    rows = []
    for i, groups in found:
        links = [(a[-1], b[-1]) for a, b in groups or []]
        rows.append((
            i, sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(links), len(links),
            hashlib.sha256(shown(groups).encode()).hexdigest() if groups else "", sum(pairs[p] == most[p[1]] for p in links), sum(pairs[p] for p in links),
        ))
    return Counter(rows)


def check(tools, texts):
    own = token_alignment.aligner(*PATHS)
    for text, got in zip(texts, own.texts(texts), strict=True):
        groups = plain(tools, text)
        assert (got and (got[0], got[1], got[2].decode())) == (groups and (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), shown(groups))), text


def test_odd_texts(tools):
    check(tools, ["", *ODD, " ".join(ODD), "\n".join(ODD[:10])])
    check(tools, [])
    assert [plain(tools, t) is None for t in ("a ▁b c", "▁ a", "a b")] == [True, True, False]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\tab's1.▁é世\U0001f600 \x1f"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=4))
def test_any_texts(tools, texts):
    check(tools, texts)


def test_whole_texts_without_cuts(tools):
    own = token_alignment.Aligner(*PATHS)
    assert own.splits
    own.splits = False
    check(tools, ODD)
    assert [r and r[2] for r in own.texts(ODD)] == [r and r[2] for r in token_alignment.aligner(*PATHS).texts(ODD)]


def test_table_of_counts_is_bounded():
    """Pairs that can end together: of each token the tokens of the other vocabulary that are its suffixes."""
    own = token_alignment.aligner(*PATHS)
    a, b = Counter(own.a_bytes), Counter(own.b_bytes)
    pairs = sum(b[t[k:]] * n for t, n in a.items() for k in range(len(t))) + sum(a[t[k:]] * n for t, n in b.items() for k in range(1, len(t)))
    assert 100_000 < pairs < 1_000_000


def test_query_follows_contract(spark, tools, data_dir, tmp_path):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()]
    documents = given + [(i, t) for i, t, _ in cases.rows([])] + [(800_000 + k, t) for k, t in enumerate(ODD)]
    spark.createDataFrame([(i, t, "g", 3) for i, t in documents], "doc_id bigint, text string, groups string, n_a int").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    frame = QUERIES["op13_token_alignment"](spark, str(tmp_path))
    assert frame.columns == COLUMNS
    assert Counter(tuple(r) for r in frame.collect()) == want(tools, documents)


def test_empty_table_and_bad_bytes(spark):
    found = token_alignment.with_counts(token_alignment.aligned(cases.empty(spark), *PATHS), *PATHS)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"] and found.count() == 0
    bad = spark.range(1).selectExpr("id AS doc_id", "CAST(X'61FF20' AS STRING) AS text")
    assert [tuple(r) for r in token_alignment.with_counts(token_alignment.aligned(bad, *PATHS), *PATHS).collect()] == [(0, 0, 0, 0, 0, "", 0, 0)]
