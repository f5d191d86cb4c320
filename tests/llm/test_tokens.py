"""Token operators: exact round trips and comparison with the tokenizer libraries."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from aerostrata.llm import packing, piece_dropout

ODD = ["", "  a\tb\n ﬁ ①  x", "日本語 テキスト\x00 é🙂", "a" * 300 + " " * 41 + "b", "x  \n  y ", "<s> </s> <0x0A>", "it's we'll I'M 'S ''s",
       "<|endoftext|> a<|startoftext|>b <| <|end", "end. stop.,; wow!!! ...x ?! .", "\x1cx\x85y\u00a0z e\u0301 \u0301 İstanbul ΣΑΣ ǅ ß", "ﬀ½Ⅷ٣ 12a3",
       "word’s “quoted” — dash…. naïve. Ÿ."]


@pytest.fixture(scope="module")
def cache():
    return packing.WordCache(packing.tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.tokenizer_path())


def test_word_cache_equals_the_library(cache, library, spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    for t in texts:
        assert cache.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids, t[:50]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_word_cache_equals_the_library_on_any_text(text):
    c = packing._caches.setdefault("t", packing.WordCache(packing.tokenizer_path()))
    assert c.encode(text).tolist() == c.tokenizer.encode(text, add_special_tokens=False).ids


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack(spark, library):
    texts = ODD + [None, "word " * 9000, "one more text " * 100, "one more text " * 100]
    df = spark.createDataFrame([(i if i else None, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, ids string, piece int")
    rows = packing.pack(df, packing.tokenizer_path(), capacity=512, with_ids=True).collect()
    check_packed(rows, 512)
    whole = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.piece):
        assert r.start == len(whole[r.doc_id]) and r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        whole[r.doc_id] += r.ids
    for i, t in enumerate(texts):
        assert whole[i if i else None] == library.encode(t or "", add_special_tokens=False).ids + [1]
    assert packing.pack(df.limit(0), packing.tokenizer_path()).count() == 0


def test_pipeline_returns_the_tokens(spark, library):
    df = spark.createDataFrame([(1, "one more text"), (2, "")], "doc_id long, text string")
    rows = {r.doc_id: r.ids for r in corpus_pipeline.sequences(spark, df, "").collect()}
    assert rows == {1: library.encode("one more text", add_special_tokens=False).ids + [1], 2: [1]}


@pytest.mark.parametrize("per_group", [10, 1000])
def test_placement_wastes_little(spark, per_group):
    rng = np.random.default_rng(0)
    sizes = rng.geometric(1 / 300, 600).clip(1, 1000)
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "doc_id long, length long")
    rows = packing.place(df, 1000, per_group).collect()
    assert sorted(r.doc_id for r in rows) == list(range(600))
    used = check_packed(rows, 1000)
    if per_group == 1000:
        assert used <= -(-sizes.sum() // 1000) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_local_search_only_improves(sizes):
    sizes = np.array(sizes)
    start = packing.best_fit(sizes, 100)
    squares = sum(int(sizes[b].sum()) ** 2 for b in start)
    end = packing.local_search([list(b) for b in start], sizes, 100)
    assert sorted(i for b in end for i in b) == list(range(len(sizes)))
    assert max(int(sizes[b].sum()) for b in end) <= 100
    assert len(end) <= len(start) and sum(int(sizes[b].sum()) ** 2 for b in end) >= squares


def test_local_search_empties_a_bin():
    sizes = np.array([6, 4, 6, 4, 5, 5, 3, 3, 4])
    poor = [[0, 6], [2, 7], [1, 4], [3, 5], [8]]
    assert len(packing.local_search(poor, sizes, 10)) == 4


def test_no_dropout_is_sentencepiece(spark, sf):
    model = piece_dropout.model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    coder = piece_dropout.Dropout(model, 0.0)
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    for t, ids in zip(texts, coder.encode_many(texts, [0] * len(texts)), strict=True):
        assert ids.tolist() == sp.encode(t), t[:50]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), st.integers(-5, 2**62))
def test_decoding_is_lossless(text, key):
    coder = piece_dropout._coder(piece_dropout.model_path(), 0.5, 1, 4)
    assert coder.decode(coder.encode(text, key)) == text


def test_side_by_side_agenda_equals_the_heap():
    coder = piece_dropout.Dropout(piece_dropout.model_path(), 0.3, 9, 3)
    words = [" the", " information", "aaaaaaaa", " ▁x", "   deep", " naïveté,", "日本", " international", " xyzzy\x00"]
    for v in range(3):
        assert coder.segment_many(words, v) == [coder.segment(w, v) for w in words]


def test_every_occurrence_has_its_own_draws():
    coder = piece_dropout.Dropout(piece_dropout.model_path(), 0.1, 5)
    ids = coder.encode_many(["international " * 3000, "international " * 3000, "the " * 3000], [1, 2, 3])
    alone = [coder.segment(" international", int(x)) for x in range(3000)]
    assert len({tuple(x) for x in alone}) > 4
    assert ids[0].tolist() != ids[1].tolist()
    marks = [x.tolist() for x in ids]
    whole = coder.ids["▁the"]
    assert 0.05 < 1 - marks[2].count(whole) / 3000 < 0.35  # a short word varies as well
    want, k = [], piece_dropout.mix(1)
    for i, unit in enumerate(piece_dropout.UNIT.findall(" " + "international " * 3000)):
        want += coder.segment(unit, k + i * piece_dropout.STEP)
    assert marks[0] == want


def test_encode_varies_and_repeats(spark):
    text = "internationalisation of information processing " * 20
    df = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, text, "x"), (None, None, "x"), (4, "", "x")], "doc_id long, text string, ids string")
    model = piece_dropout.model_path()
    out = piece_dropout.encode(df, model)
    rows = out.collect()
    assert all(r.lossless for r in rows)
    ones = [r.ids for r in rows if r.doc_id == 1]
    assert ones[0] == ones[1]
    plain = sentencepiece.SentencePieceProcessor(model_file=model).encode(text)
    assert len(ones[0]) > len(plain)
    n = len(plain) // 20
    assert len({tuple(piece_dropout.Dropout(model).segment(" internationalisation", v)) for v in range(4)}) > 1 and n
    assert {r.ids_crc32 for r in piece_dropout.encode(df, model, seed=6).collect() if r.doc_id == 1} != {rows[0].ids_crc32}
    back = {r.doc_id: r.text for r in piece_dropout.decode(out, model).collect()}
    assert back == {1: text, 2: text, None: "", 4: ""}
    assert piece_dropout.encode(df.limit(0), model).count() == 0


def test_words_are_learned_side_by_side(monkeypatch):
    """Learning agendas spells whole batches: per word no Python runs, and characters outside the vocabulary come out as the heap has them."""
    coder = piece_dropout.Dropout(piece_dropout.model_path(), 0.3, 9)
    words = [" the", " ▁日x本", " naïveté,", " xyzzy\x00", " 𝔘nder", " information", "   deep"]
    want = [coder.segment(w, (piece_dropout.mix(7) + i * piece_dropout.STEP) & piece_dropout.WORD) for i, w in enumerate(words * 40)]
    calls = []
    symbols = piece_dropout.Dropout._symbols
    monkeypatch.setattr(piece_dropout.Dropout, "_symbols", lambda self, unit: calls.append(unit) or symbols(self, unit))
    assert coder.encode("".join(words * 40)[1:], 7).tolist() == [i for ids in want for i in ids]
    assert not calls


def test_new_skips_of_all_words_are_worked_out_together(monkeypatch):
    calls, learn = [], piece_dropout.Dropout._learn
    monkeypatch.setattr(piece_dropout.Dropout, "_learn", lambda self, *a: calls.append(len(a[0])) or learn(self, *a))
    coder, text = piece_dropout.Dropout(piece_dropout.model_path()), " ".join(f"{a}{b}ation" for a in ("walk", "sing", "house", "night") for b in ("er", "ing", "less", "ful") * 100)
    assert coder.decode(coder.encode(text, 3)) == text
    assert len(calls) <= 8


@pytest.mark.parametrize("dropout", [0.5, 0.95])
def test_long_words_with_many_skips(dropout):
    coder = piece_dropout.Dropout(piece_dropout.model_path(), dropout)
    units = [" " + (w * 32)[:31] for w in ("the", "station", "aeiou", "internationalization")]
    assert coder.segment_many(units, 7) == [coder.segment(u, 7) for u in units]
    for key in range(50):
        own = [i for n, u in enumerate(units) for i in coder.segment(u, (n * piece_dropout.STEP + piece_dropout.mix(key)) & piece_dropout.WORD)]
        assert coder.encode("".join(units)[1:], key).tolist() == own
