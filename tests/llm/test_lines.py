"""Line dedup and quality rules on small texts."""

import random

from pyspark.sql import functions as F

from aerostrata.llm.line_winnow import dedup_lines, line_words, window_minima
from aerostrata.llm.quality_lines import apply_rules, base_counts, judge

SCHEMA = "doc_id long, text string, source string, n_removed string, _key int"


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))


def test_windows_guarantee_a_common_fingerprint():
    rng = random.Random(2)
    for _ in range(30):
        shared = [sentence(rng, rng.randint(1, 30)) for _ in range(8)]
        texts = ["\n".join([sentence(rng, rng.randint(1, 30)) for _ in range(3)] + shared + [sentence(rng, 9)]) for _ in range(2)]
        chosen = []
        for t in texts:
            _, _, h, n = line_words(t)
            chosen.append({h[p] for p in window_minima(h, n, 50)})
            for start in range(len(h)):
                end = start
                while end < len(h) and n[start:end].sum() < 50:
                    end += 1
                if n[start:end].sum() >= 50:
                    assert min(h[start:end]) in {h[p] for p in window_minima(h, n, 50)}
        if len(" ".join(shared).split()) >= 50:
            assert chosen[0] & chosen[1]


def test_later_runs_go(spark):
    rng = random.Random(1)
    long = sentence(rng, 60)
    run = [sentence(rng, 20) for _ in range(4)]
    common = sentence(rng, 30)
    own = [sentence(rng, 30) for _ in range(40)]
    texts = [
        f"{own[0]}\n{long}\n{own[1]}",
        f"{long}\n{own[2]}",
        "\n".join([own[3], *run, own[4]]),
        "\n".join([own[5], "", *run, own[6]]),
        f"{run[0]}\n{run[1]}\n{own[7]}",  # 40 words only
        None, "", "\n \n",
        f"{long}\n\n{own[8]}\n{long}",
        f"  {long.replace(' ', '  ', 3)} ",
        f"{own[9]}\n{common}\n{own[10]}",
        *(f"{own[11 + i]}\n{common}\n{own[30]}" if i % 5 == 4 else f"{own[11 + i]}\n{common}" for i in range(12)),
    ]
    df = spark.createDataFrame([(i, t, "s", "clash", 0) for i, t in enumerate(texts)], SCHEMA)
    rows = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert [f.name for f in dedup_lines(df).schema] == ["doc_id", "text", "source", "_key", "n_lines", "n_removed"]
    want = {1: own[2], 3: "\n".join([own[5], "", own[6]]), 8: f"\n{own[8]}", 9: ""}
    # common + own[30] repeats from its second appearance on
    want |= {11 + i: own[11 + i] for i in range(12) if i % 5 == 4 and i > 4}
    for i, t in enumerate(texts):
        assert rows[i].text == want.get(i, t), i
    assert rows[5].n_lines == 0 and rows[3].n_removed == 4


def plain_dedup(texts, min_words):
    """Every run of lines with enough words that an earlier place holds too, without overlap, by trying all."""
    seen, out = {}, []
    for d, t in enumerate(texts):
        lines, gone = t.split("\n"), set()
        for s in range(len(lines)):
            n = 0
            for e in range(s, len(lines)):
                n += len(lines[e].split())
                if n >= min_words:
                    run = tuple(lines[s:e + 1])
                    doc, at = seen.setdefault(run, (d, s))
                    if doc < d or s > at + e - s:
                        gone |= set(range(s, e + 1))
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_short_quotes_do_not_hide_the_longer_match(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(40):
        passage = [sentence(rng, 10) for _ in range(8)]
        for at in range(6):  # earlier documents quote 30 words each, below the limit
            texts.append("\n".join([sentence(rng, 9), *passage[at:at + 3], sentence(rng, 9)]))
        for _ in range(2):
            texts.append("\n".join([sentence(rng, 9), *passage, sentence(rng, 9)]))
    few = [sentence(rng, n) for n in (5, 20, 30, 55, 1, 12)]  # the same lines in ever new order
    texts += ["\n".join(rng.choices(few, k=rng.randint(1, 14))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in dedup_lines(df).collect()}
    want = plain_dedup(texts, 50)
    assert [got[i] for i in range(len(texts))] == want
    assert all(len(want[8 * i + 7].split("\n")) == 2 for i in range(40))


def test_periodic_texts_keep_their_first_copy(spark):
    rng = random.Random(9)
    ten, three = sentence(rng, 10), [sentence(rng, 10) for _ in range(3)]
    texts = ["\n".join([ten] * 10), "\n".join(three * 8), "\n".join([sentence(rng, 10)] * 7), "\n".join([*three, *three, sentence(rng, 3)])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in dedup_lines(df).orderBy("doc_id").collect()]
    assert got == plain_dedup(texts, 50)
    assert [len(x.split("\n")) for x in got] == [5, 6, 7, 1]


def test_lines_with_null_keys_and_repeated_rows(spark):
    long = sentence(random.Random(4), 60)
    df = spark.createDataFrame([(None, long), (3, long), (3, long), (4, long)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in dedup_lines(df).collect()), key=str)
    assert got == sorted([(None, ""), (3, long), (3, long), (4, "")], key=str)
    assert dedup_lines(df.limit(0)).count() == 0


def plain_counts(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = {w: windows.count(w) for w in set(windows)} if len(windows) < 3000 else {}
    inside = {j for i, w in enumerate(windows) if seen.get(w, 0) > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


def test_base_counts(spark):
    rng = random.Random(5)
    texts = [None, "", " \n", "a", "x " * 40, "one two three four five six seven eight " * 3, "a#b <c> |d| 50% $5 &amp;\na\na \na\n\u00a0\n",
             sentence(rng, 300), "\n".join([sentence(rng, 10)] * 4 + [sentence(rng, 9)]), "é" * 30 + " ñ\x0b\x0cz",
             " ".join(str(i % 700) for i in range(1500))]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in base_counts(df).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain_counts(texts[r._key]), r._key
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_common_lines_go_but_once(spark):
    rng = random.Random(6)
    footer, short = sentence(rng, 40), sentence(rng, 30)
    rows = [(i, f"{sentence(rng, 60)}\n{footer}", "h", "x", 1) for i in range(8)]
    rows += [(20 + i, f"{short}\n{sentence(rng, 2)}", "h", "x", 1) for i in range(8)]
    rows += [(40 + i, f"{sentence(rng, 60)}\n{footer}", None, "x", 1) for i in range(3)]  # another host, below its limit
    rows += [(60 + i, rows[0][1], "h", "x", 1) for i in range(9)]  # exact copies of one document
    df = spark.createDataFrame(rows, SCHEMA)
    limits = {"max_docs": 5, "max_doc_share": 0.0}
    got = {r.doc_id: (r.kept, r.n_common_words) for r in judge(df, **limits).collect()}
    assert got[0] == (True, 0) and got[60] == (True, 0)
    assert all(got[i] == (True, 40) for i in range(1, 8))
    assert got[20] == (True, 0) and all(got[20 + i] == (False, 30) for i in range(1, 8))
    assert all(got[40 + i] == (True, 0) for i in range(3))
    out = apply_rules(df, **limits)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == df.columns and set(texts) == {i for i, (k, _) in got.items() if k}
    assert texts[0] == rows[0][1] and texts[3] == rows[3][1].split("\n")[0]
    assert judge(df.limit(0)).count() == 0 and apply_rules(df.limit(0)).count() == 0


def test_quality_with_nulls_and_repeats(spark):
    df = spark.createDataFrame([(None, None, None), (1, "a b", None), (1, "a b", None)], "doc_id long, text string, source string")
    assert sorted(((r.doc_id, r.n_words, r.kept) for r in judge(df).collect()), key=str) == [(1, 2, False), (1, 2, False), (None, 0, False)]
    assert df.filter(F.lit(False)).count() == 0
