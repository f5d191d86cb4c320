"""Alignment of two tokenizers against a plain version, and its corpus counts."""

import hashlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerostrata.llm import token_align as ta

ODD = [None, "", " ", "x", "a  b \n\n c", "日本語 テキスト é🙂\x00", "a" * 300 + " b", "<|endoftext|> and </s> <s> <unk> <0x0A>", "it's we'll …— ¼ ﬁ",
       "already ▁ marked", "don't stop", "don't stop", "  x y", "İstanbul ǅ é", "ա բ \U000e0001"]


@cache
def one_aligner():
    files = ta.paths()
    return ta.Aligner(ta.ByteTokens(*files[:3]), ta.SentenceTokens(files[3]))


@pytest.fixture(scope="module")
def aligner():
    return one_aligner()


def plain(aligner, text):
    """Groups and links of a text by walking over its bytes."""
    if not text:
        return None
    a = aligner.a.own.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.model.encode(text)
    sides = []
    for ids, p in ((a, aligner.a.pieces), (b, aligner.b.pieces)):
        raw = [p.raw[p.start[i]:p.start[i] + p.size[i]].tobytes() for i in ids]
        if b"".join(raw) != (" " + text).encode():
            return None
        sides.append(np.cumsum([len(r) for r in raw]).tolist())
    shared = sorted(set(sides[0]) & set(sides[1]))
    groups = [([i for i, e in zip(a, sides[0]) if low < e <= high], [i for i, e in zip(b, sides[1]) if low < e <= high])  # noqa: B905
              for low, high in zip([0, *shared], shared)]  # noqa: B905
    links, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        x, y = sides[0][i], sides[1][j]
        i, j = i + (x <= y), j + (y <= x)
    return a, b, groups, links


def written(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


def check(aligner, texts):
    for t, got in zip(texts, aligner.whole(texts), strict=True):
        want = plain(aligner, t)
        if want is None:
            assert got in ([], [None]), t
            continue
        a, b, groups, links = want
        assert b";".join(x["written"] for x in got).decode() == written(groups), t
        assert [i for x in got for i in x["a"]] == a and [i for x in got for i in x["b"]] == b
        found = Counter()
        for x in got:
            found.update(dict(zip(x["pairs"].tolist(), x["times"].tolist(), strict=True)))
        assert found == Counter(i * len(aligner.b.pieces.size) + j for i, j in links)
        assert sum(x["n_groups"] for x in got) == len(groups) and sum(x["n_links"] for x in got) == len(links)


def test_align(aligner, spark, sf):
    check(aligner, ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_align_any_text(texts):
    check(one_aligner(), texts)


def test_long_texts_in_parts(aligner, monkeypatch, spark, sf):
    monkeypatch.setattr(ta, "PART", 50)
    monkeypatch.setattr(ta, "TOGETHER", 200)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(20).collect()]
    assert max(len(ta.parts(t)) for t in texts) > 3
    check(aligner, texts)


def test_pointers_reach_the_end_of_each_group():
    # A: 2 2 2 2 3 | B: 1 2 2 2 1 3, one group over 8 bytes, then one over 3.
    a, b = np.cumsum([2, 2, 2, 2, 3]), np.cumsum([1, 2, 2, 2, 1, 3])
    assert ta.terminals(a, a - [2, 2, 2, 2, 3], b, b - [1, 2, 2, 2, 1, 3]).tolist() == [3, 3, 3, 3, 4, 3, 3, 3, 3, 3, 4]


def test_corpus_links(spark, aligner, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    df = spark.createDataFrame([(i, t, 7, 1) for i, t in enumerate(texts)], "doc_id long, text string, pairs int, _row int").repartition(6)
    docs, want = Counter(), {}
    for t in texts:
        if p := plain(aligner, t):
            docs.update(set(p[3]))
    most = Counter()
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    for i, t in enumerate(texts):
        if p := plain(aligner, t):
            a, b, groups, links = p
            want[i] = (len(a), len(b), len(groups), len(links), sum(docs[x] == most[x[0]] for x in links), sum(docs[x] for x in links),
                       hashlib.sha256(written(groups).encode()).hexdigest())
        else:
            want[i] = (0, 0, 0, 0, 0, 0, "")
    for kept in (0, 10**6):
        assert {r[0]: tuple(r)[1:] for r in ta.corpus_links(df, broadcast_pairs=kept).collect()} == want
    assert ta.corpus_links(df.limit(0)).collect() == []
    again = df.filter("doc_id = 1").union(df.filter("doc_id = 3")).selectExpr("cast(null as long) doc_id", "text")
    assert len(ta.corpus_links(again).collect()) == 2
    row = ta.alignments(df.filter("doc_id = 10"), with_tokens=True).first()
    assert len(row.a_ids) == len(row.a_groups) and max(row.b_groups) == row.n_groups - 1
