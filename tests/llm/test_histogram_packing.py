"""Shortest-pack-first packing: no token lost, gapless sequences, no padding."""

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerostrata.llm import histogram_packing as hp
from aerostrata.llm import packing

ODD = [None, "", " \t", "one more text " * 100, "one more text " * 100, "word " * 9000, "日本語 é🙂 ﬁ", "it's we'll. ..x ?!", "a" * 300]


def check_gapless(rows, capacity):
    """rows (sequence, offset, length): the fills of the sequences, each either full or a power of two used once."""
    by = defaultdict(list)
    for sequence, offset, length in rows:
        by[sequence].append((offset, length))
    fills = []
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        fills.append(at)
    short = [f for f in fills if f < capacity]
    assert all(f & (f - 1) == 0 for f in short) and len(set(short)) == len(short) and max(fills, default=0) <= capacity


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 5000), max_size=40))
def test_every_token_of_the_histogram_has_one_place(histogram):
    patterns = hp.shortest_pack_first(histogram, 64)
    assert all(s == 0 and n == r for p in patterns for r, _, s, n in p.places)
    plan = hp.plan_rows(hp.fill_up(patterns, 64))
    placed, ranks = [], defaultdict(list)
    for rest, low, high, parts in plan:
        at = 0
        for start, length, _, _ in parts:
            assert start == at
            at += length
        assert at == rest
        ranks[rest].append((low, high))
        placed += [(rank + shift, offset, length) for rank in range(low, high) for _, length, shift, offset in parts]
    for rest, spans in ranks.items():
        at = 0
        for low, high in sorted(spans):
            assert low == at < high
            at = high
        assert at == histogram[rest]
    check_gapless(placed, 64)


def test_longest_first_into_the_shortest_pack():
    patterns = hp.shortest_pack_first({6: 2, 5: 1, 3: 1, 2: 3}, 8)
    assert sorted(tuple(n for *_, n in p.places) for p in patterns for _ in range(p.count)) == [(2,), (5, 3), (6, 2), (6, 2)]


def test_pack(spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(80).collect()]
    df = spark.createDataFrame([(i if i else None, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, ids string, _rest int").repartition(5)
    library, want = Tokenizer.from_file(packing.tokenizer_path()), {}
    for i, t in enumerate(texts):
        want[i if i else None] = library.encode(t or "", add_special_tokens=False).ids + [2]
    for kept in (0, 10**6):
        rows = hp.pack(df, packing.tokenizer_path(), capacity=512, with_ids=True, broadcast_rows=kept).collect()
        check_gapless([(r.sequence_id, r.offset, r.length) for r in rows], 512)
        got = defaultdict(list)
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == len(got[r.doc_id]) and r.length == len(r.ids)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            assert r.doc_tokens == len(want[r.doc_id])
            got[r.doc_id] += r.ids
        assert got == want


def test_pack_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert hp.pack(empty, packing.tokenizer_path()).collect() == []
    twice = spark.createDataFrame([(1, "a b c")] * 3, "doc_id long, text string")
    rows = hp.pack(twice, packing.tokenizer_path(), capacity=4).collect()
    assert sum(r.length for r in rows) == 12
    check_gapless([(r.sequence_id, r.offset, r.length) for r in rows], 4)
