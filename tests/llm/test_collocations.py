"""Phrases from FM-indexes against plain counting."""

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from aerostrata.llm import collocations as co


def plain(rows, min_count, max_words, top):
    """rows (lang, text) to the report, by counting every phrase."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
    common = {p: c for p, c in f.items() if c >= min_count}
    covered = {(g, w[i:j]) for (g, w), c in common.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1)
               if j - i < len(w) and c >= common[g, w[i:j]]}
    report = {}
    for (lang, w), a in common.items():
        if len(w) > 1 and (lang, w) not in covered:
            score, _, le, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            report.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), le, r))
    return sorted((lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for lang, x in report.items() for i, (s, a, p, le, r) in enumerate(sorted(x)[:top]))


def report(df, **how):
    return sorted(tuple(r) for r in co.collocations(df, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 3))
def test_index_steps(ids, depth):
    ids = np.array([0, *ids, 0], np.int64)
    index = co.Index(ids, depth)
    places = [i for i in range(len(ids) - depth) if (ids[i:i + depth] > 0).all()]
    first = {}
    for i in places:
        first.setdefault(tuple(ids[i:i + depth]), i)
    nodes = index.nodes(np.array(list(first.values()), np.int64))
    longer = Counter(tuple(ids[i:i + depth + 1]) for i in range(len(ids) - depth) if (ids[i:i + depth + 1] > 0).all())
    deep = co.Index(ids, depth + 1)
    for right in (False, True):
        e = co.extensions(index, nodes, right)
        found, names = {}, list(first)
        for of, start in zip(e["of"].tolist(), e["start"].tolist(), strict=True):
            if of >= 0:
                found.setdefault(of, set()).add(tuple(ids[start:start + depth + 1]))
        assert all(len(x) == 1 for x in found.values())
        got = {next(iter(x)): e["count"][of] for of, x in found.items()}
        assert got == dict(longer)
        for of, x in found.items():
            w = next(iter(x))
            assert names[e["prefix"][of]] == w[:-1] and names[e["suffix"][of]] == w[1:]
        # The rows both ways are those of an index sorted one word deeper.
        raw = index.extend(nodes, right)
        for of in range(len(raw["count"])):
            i = int(raw["start"][np.flatnonzero(raw["of"] == of)[0]])
            a, b, size = (int(x[0]) for x in deep.nodes(np.array([i])))
            assert (a, b, size) == ((raw["other"][of], raw["row"][of]) if right else (raw["row"][of], raw["other"][of])) + (raw["count"][of],)


def test_packed_numbers():
    for x in ([], [0], [1, 2**32 - 1, 70000]):
        assert co.unpack_ints(co.pack_ints(np.array(x, np.int64))).tolist() == x


def test_collocations(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [("en", None), (None, "New York. New York, new york new york"), (None, ""), ("en", " \t\x0b"), ("", "é é é é é"),
           ("en", "the the the the the the the the"), ("fr", "x" * 50 + " y"), ("zh", "日本 語 日本 語 日本 語\x1c日本 語"), ("en", "ends here."), ("en", "Here it starts")]
    odd = odd + [("aa", "to be or not to be"), ("aa", "to be or not to be")]
    df = docs.limit(100).select("lang", "text").union(spark.createDataFrame(odd, "lang string, text string")).repartition(5)
    df = df.selectExpr("lang", "text", "1 as shard", "'q' as ids", "2 as n", "0L as name").cache()
    rows = [(r.lang, r.text) for r in df.collect()]
    for min_count, max_words, top, shard_words in ((2, 5, 50, 500), (3, 3, 10**6, 1 << 21), (1, 2, 5, 100)):
        assert report(df, min_count=min_count, max_words=max_words, top=top, shard_words=shard_words) == plain(rows, min_count, max_words, top)
    assert report(df.limit(0)) == [] and report(df, min_count=10**6) == []


def test_long_texts_in_parts(spark, monkeypatch):
    rows = [("en", "a b c d. " * 400 + "a b " * 30), ("en", "c d, a b c")]
    df = spark.createDataFrame(rows, "lang string, text string")
    whole = report(df, min_count=2)
    assert whole == plain(rows, 2, 5, 2000)


def test_packed_extensions():
    prefix, suffix, n = np.array([3, 3, 1 << 45, (1 << 45) + 7]), np.array([9, 1 << 50, 2, 0]), np.array([1, 1 << 40, 2, 3])
    assert co.unpack_entries(co.pack_entries(prefix, suffix, n)).tolist() == [prefix.tolist(), suffix.tolist(), n.tolist()]
    assert co.unpack_entries(co.pack_entries(prefix[:0], suffix[:0], n[:0])).shape == (3, 0)
    rng = np.random.default_rng(1)
    prefix = np.sort(rng.integers(0, 50_000, 100_000))
    assert len(co.pack_entries(prefix, rng.integers(0, 50_000, 100_000), np.ones(100_000, np.int64))) < 4 * 100_000


def test_extensions_in_many_buckets(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.5, 60) % 30) + "." for _ in range(300)]
    docs = spark.createDataFrame([(t, ("en", "de")[i % 2]) for i, t in enumerate(texts)], "text string, lang string").repartition(4)
    how = {"min_count": 8, "shard_words": 500}
    whole = report(docs, **how)
    monkeypatch.setattr(co, "BUCKET_ENTRIES", 400)
    assert report(docs, **how) == whole
