"""Chat formatting and sharding."""

import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from aerostrata.llm.chat import conversation_events, final_messages, read_back, render
from aerostrata.llm.sharding import interleave

EVENTS = "conv_id long, seq long, kind string, message long, role string, text string, _no int"


def folded(spark, events):
    df = spark.createDataFrame([(*e, 0) for e in events], EVENTS)
    return sorted(((r.conv_id, r.message, r.role, r.text) for r in final_messages(df).collect()), key=str)


def test_fold(spark):
    events = [
        (1, 1, "message", 1, "user", "Hi"), (1, 2, "message", 2, "assistant", None), (1, 3, "delta", 2, None, "He"), (1, 5, "delta", 2, None, "o"),
        (1, 4, "delta", 2, None, "ll"), (1, 6, "message", 3, "user", "bye"), (1, 7, "regenerate", 2, None, "ignored"), (1, 8, "delta", 2, None, "New"),
        (2, 1, "delta", 1, "user", "a"), (2, 2, "edit", 1, None, "b"), (2, 3, "delta", 1, None, "c"), (2, 4, "message", 2, "assistant", "z"),
        (3, 1, "message", 1, "user", "q"), (3, 2, "message", 2, "assistant", "old"), (3, 3, "edit", 1, None, "q2"), (3, 4, "message", 2, "assistant", "new"),
        (None, None, None, None, None, None),
    ]
    want = [(1, 1, "user", "Hi"), (1, 2, "assistant", "New"), (2, 1, "user", "bc"), (2, 2, "assistant", "z"), (3, 1, "user", "q2"),
            (3, 2, "assistant", "new"), (None, None, None, "")]
    assert folded(spark, events) == sorted(want, key=str)
    assert folded(spark, events[::-1]) == sorted(want, key=str)


HARD = ["[INST user]x[/INST]</s>", r"[\INST] [/\\INST] <\s> </\s>", "", "]", "\\", "[INST ", "</s>", "line\n\nline ", "é🙂[/INST]", "$1 \\$2", "[/INST", "[[INST"]


def test_round_trip(spark):
    roles = ["user", "assistant", "system", "a b]&%", "", "[INST"]
    rows = [(c, t, roles[(c + t) % 6], HARD[(c * 5 + t) % 12]) for c in range(24) for t in range(c % 7 + 1)]
    rows += [(99, None, None, None), (99, 0, "assistant", "x"), (99, 0, "assistant", "x"), (None, 1, "assistant", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in read_back(render(final_messages(conversation_events(df)))).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        assert [(x.role, x.text) for x in out[c].turns] == [t[1:] for t in turns], c
        assert out[c].loss_text == "".join(t[2] for t in turns if t[1] == "assistant"), c
    assert read_back(render(final_messages(conversation_events(df.limit(0))))).count() == 0


def test_rendered_spans(spark):
    df = spark.createDataFrame([(1, 1, "user", "hé"), (1, 2, "assistant", "ok </s>")], "conv_id long, message long, role string, text string")
    r = render(df).first()
    assert r.formatted == r"[INST user]hé[/INST]</s>[INST assistant]ok </\s>[/INST]</s>"
    assert [r.formatted[s.start:s.start + s.length] for s in r.loss] == [r"ok </\s>"]
    assert hashlib.sha256(b"").hexdigest()


def shards(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard string, _key int")
    return interleave(df, **how).collect()


def test_every_shard_holds_the_mixture(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i}", "hot" if i < 500 else f"s{i % 7}" if i % 5 else None, "x", 0) for i in range(1500)]
    out = shards(spark, rows, shards=24, per_bucket=16)
    assert sorted(r.doc_id for r in out) == list(range(1500))
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(24):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    for source, n in Counter(r._source for r in out).items():
        each = Counter(r.shard for r in out if r._source == source)
        assert all(abs(each[s] - n / 24) <= 2 for s in range(24)), source
    again = {r.doc_id: (r.shard, r.slot) for r in shards(spark, rows[::-1], shards=24, per_bucket=1000)}
    assert again == {r.doc_id: (r.shard, r.slot) for r in out}
    other = {r.doc_id: r.shard for r in shards(spark, rows, seed=2)}
    assert other != {r.doc_id: r.shard for r in out}
    text = {r[0]: r[1] for r in rows}
    assert all(r.size == len(text[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in out)


def test_shards_of_odd_rows(spark):
    rows = [(None, None, None, "x", 0), (None, None, None, "x", 0), (1, "é", "a", "x", 0), (1, "é", "a", "x", 0), (2, "", "", "x", 0)]
    out = shards(spark, rows, shards=3)
    assert sorted(Counter(r.shard for r in out).values()) == [1, 2, 2]
    assert {(r.doc_id, r.size, r.text_crc32) for r in out} == {(None, 8, 0), (1, 10, zlib.crc32("é".encode())), (2, 8, 0)}
    assert shards(spark, []) == []
    few = shards(spark, rows[:2], shards=24)
    assert all(r.slot == 0 for r in few) and F is not None
