"""Near-duplicate operators against brute force."""

import random

import numpy as np
import pytest
import xxhash

from aerostrata.llm.common import components
from aerostrata.llm import near_simhash
from aerostrata.llm.near_simhash import ball_links, keep_one, near_duplicates, similar_groups, simhash
from aerostrata.llm.near_vectors import codes, hadamard, near_vectors


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def plain_simhash(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one two", "Ünder ÄB c\x0bd\u00a0e\u2003f g", "a b c d " * 50,
                                  " ".join(str(i) for i in range(70_000))])
def test_simhash(text):
    assert simhash(text) == plain_simhash(text)


def test_chains_become_one_component(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7), (101, 100), (50, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    nodes = {n for e in edges for n in e}
    assert got == roots(nodes, edges)


def test_ball_links_connect_all_within_radius(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(20)] + [0, 1 << 63]
    for v in values[:12]:
        for flips in (1, 2, 3):
            for b in rng.sample(range(64), flips):
                v ^= 1 << b
            values.append(v)
    values = sorted(set(values))
    links = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2]
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = [(r.u % (1 << 64), r.v % (1 << 64)) for r in ball_links(spark.createDataFrame(signed, "fp long"), 2).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in got)
    assert roots(values, got) == roots(values, links)


TEXTS = ["the quick brown fox jumps over the lazy dog today", "The quick brown fox jumps over the lazy dog TODAY", None, "", "  ",
         "completely different words are standing in this other text here", "completely different words are standing in this other text here"]


def test_near_duplicates(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "x"), (5, TEXTS[5], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.component) for r in near_duplicates(df).collect()), key=str)
    fps = {i: plain_simhash(t) for i, t, _ in rows if i is not None}
    links = [(a, b) for a in fps for b in fps if (fps[a] ^ fps[b]).bit_count() <= 2]
    want = roots(fps, links)
    assert got == sorted([*want.items(), (None, want[0]), (5, want[5])], key=str)
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*{want[i] for i in fps}, None, 5], key=str)


def jaccard(a, b):
    a, b = ({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("crowd", [4096, 8])
def test_keep_one_finds_planted_near_copies(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_simhash, "CROWD", crowd)
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    texts = []
    for n in range(150):
        words = rng.choices(vocabulary, k=rng.randint(120, 400))
        copy = list(words)
        for at in rng.sample(range(len(copy)), len(copy) // 60):  # about 0.85 of the shingles' union
            copy[at] = rng.choice(vocabulary)
        texts += [" ".join(words), " ".join(copy)]
    for _ in range(60):  # halves in common are no near copies
        half = rng.choices(vocabulary, k=100)
        texts += [" ".join(half + rng.choices(vocabulary, k=100)) for _ in range(2)]
    hot = rng.choices(vocabulary, k=300)
    for _ in range(120):
        copy = list(hot)
        copy[rng.randrange(300)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = {r.doc_id: r.component for r in similar_groups(df).collect()}
    similar = [i for i in range(0, 300, 2) if jaccard(texts[i], texts[i + 1]) >= 0.8]
    assert len(similar) > 100
    assert sum(group[i + 1] == i for i in similar) >= 0.97 * len(similar)
    assert all(group[i + 1] == i + 1 for i in range(0, 420, 2) if jaccard(texts[i], texts[i + 1]) < 0.8)
    assert {group[i] for i in range(420, 540)} == {420}
    assert {r.doc_id for r in keep_one(df).collect()} == {i for i, g in group.items() if i == g}


@pytest.mark.parametrize("crowd", [4096, 8])
def test_similar_texts_whose_leader_is_another(spark, monkeypatch, crowd):
    """Twins of many families that all resemble one text, but not enough: each pair that meets counts, as by brute force."""
    monkeypatch.setattr(near_simhash, "CROWD", crowd)
    monkeypatch.setattr(near_simhash, "BLOCK", crowd, raising=False)
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    hub = rng.choices(vocabulary, k=300)
    texts = [" ".join(hub)]
    for _ in range(250):
        family = list(hub)
        for at in rng.sample(range(300), 8):
            family[at] = rng.choice(vocabulary)
        twin = list(family)
        for at in rng.sample(range(300), 3):
            twin[at] = rng.choice(vocabulary)
        texts += [" ".join(family), " ".join(twin)]
    sets = [set(near_simhash.shingle_hashes(t.encode().split(), 5).tolist()) for t in texts]
    marks = [near_simhash.short_fingerprints(near_simhash.shingle_hashes(t.encode().split(), 5), near_simhash.TABLES, near_simhash.BITS) for t in texts]
    bits = lambda x, y: ((x ^ y) % (1 << 64)).bit_count()
    most = 21  # of 64 bits, at similarity 0.8
    links = []
    for i, (check, mins, short) in enumerate(marks):
        for j in range(i + 1, len(texts)):
            meet = any(m == n and bits(f, g) <= 2 for m, n, f, g in zip(mins, marks[j][1], short, marks[j][2], strict=True))
            common = len(sets[i] & sets[j])
            if meet and bits(check, marks[j][0]) <= most and common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                links.append((i, j))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component for r in similar_groups(df).collect()} == roots(range(len(texts)), links)
    assert len(links) >= 150


@pytest.mark.parametrize("most", [1 << 12, 1 << 26])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_texts_that_no_pair_needs_stay_out_of_the_shuffle(spark, monkeypatch, kind, most):
    monkeypatch.setattr(near_simhash, "MOST_KEY_BITS", most)
    rows = spark.range(20_000).selectExpr(f"cast(id as {kind}) key", "concat('t', id) text").union(spark.createDataFrame([(None, "x")], f"key {kind}, text string"))
    wanted = rows.filter("cast(key as long) % 50 = 0").select("key")
    passed = near_simhash.maybe_wanted(rows, wanted)
    assert passed.schema == rows.schema
    assert {r.key for r in wanted.collect()} <= {r.key for r in passed.collect()}
    assert all(r.text == f"t{r.key}" for r in passed.filter("key is not null").collect())
    assert passed.count() < (2_000 if most > 1 << 12 else 4_000)
    assert near_simhash.maybe_wanted(rows, wanted.limit(0)).count() <= 1


def test_pairs_of_a_meeting_point():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 62, 5)
    checks = np.concatenate([c ^ (1 << rng.integers(0, 62, 50)) for c in centres])
    same, leaders = rng.permutation(10**6)[:250], []
    pairs = np.concatenate(near_simhash._met(same[:100], checks[:100], leaders, 4) + near_simhash._met(same[100:], checks[100:], leaders, 4))
    assert len(leaders) == 5 and len(pairs) <= 2 * 250
    assert roots(same.tolist(), [tuple(x) for x in pairs.tolist()]) == {int(s): int(same[i // 50 * 50:i // 50 * 50 + 50].min()) for i, s in enumerate(same)}


def test_near_duplicates_of_nothing(spark):
    assert keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(2, 1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    assert (codes(a)[:, :, :, None] == codes(b)[:, :, None, :]).any((1, 2, 3)).mean() > 0.995


@pytest.mark.parametrize("block", [7, 512])
def test_near_vectors(spark, block):
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        for c in range(12):
            x = rng.normal(size=24)
            for k in range(1 + 4 * (c % 4)):
                rows.append((len(rows), (x + rng.normal(size=24) * 0.12 * (k > 2)).astype(np.float32).tolist(), label))
    rows += [(900, None, 0), (901, [], 0), (902, [0.0] * 24, 0), (903, [float("nan")] * 24, 0), (904, [None, 1.0], 0), (905, rows[0][1], None),
             (906, [1.0, 0.0], 0), (907, [2.0, 0.0], 0), (None, rows[5][1], rows[5][2])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), block=block).collect()}
    links = []
    for i, (a, x, la) in enumerate(rows):
        for b, y, lb in rows[i + 1:]:
            if la is not None and la == lb and x and y and len(x) == len(y) and None not in x and None not in y:
                p, q = np.array(x, float), np.array(y, float)
                n = np.linalg.norm(p) * np.linalg.norm(q)
                if n > 0 and p @ q / n >= 0.93:
                    links.append((a, b))
    named = [(a, b) for a, b in links if a is not None and b is not None]
    want = roots([r[0] for r in rows if r[0] is not None], named)
    for v, root in want.items():
        n = sum(v in e for e in links)
        assert got[v] == (n, root, v == root), v
    assert got[None][0] == sum(None in e for e in links) > 0 and not got[None][2]


def test_near_vectors_of_nothing(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
