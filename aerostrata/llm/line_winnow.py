"""Line dedup by winnowing over line hashes.

A window is a shortest run of lines that holds `min_words` words, from its first line on or up to its
last one. Every line of a longer run lies in a window inside it: that from the run's first line on, or
that up to the line itself. So the lines to delete are those of all windows that an earlier place has
too, and a window is looked up by the hash of all its lines: whatever else holds some of them can't
stand in for its first place.

The minimal line hash of a window from a line on is a fingerprint, and carries the windows that start
there. Equal windows have equal fingerprints, so only the windows of lines selected more than once are
looked up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.common import fresh, stored, table

MIN_WORDS = 50


def line_words(text: str | None) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """All lines; of those with a word: line number, hash of the words, word count."""
    lines = text.split("\n") if text is not None else []
    words = [x.encode("utf-8", "surrogatepass").split() for x in lines]
    at = np.array([i for i, w in enumerate(words) if w], np.int64)
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(w)) for w in words if w], np.uint64).view(np.int64)
    return lines, at, hashes, np.array([len(w) for w in words if w], np.int64)


def window_minima(hashes: np.ndarray, counts: np.ndarray, min_words: int) -> list[int]:
    """Positions of each window's minimal hash, the last of equal ones."""
    total = np.concatenate([[0], np.cumsum(counts)])
    ends = np.searchsorted(total, total[:-1] + min_words)
    chosen, queue, head, upto, values = [], [], 0, 0, hashes.tolist()
    for i, end in enumerate(ends.tolist()):
        if end > len(values):
            break
        for j in range(upto, end):
            while len(queue) > head and values[queue[-1]] >= values[j]:
                queue.pop()
            queue.append(j)
        upto = end
        while queue[head] < i:
            head += 1
        if not chosen or chosen[-1] != queue[head]:
            chosen.append(queue[head])
    return chosen


def windows(hashes: np.ndarray, counts: np.ndarray, min_words: int) -> list[tuple[int, int, int, int]]:
    """Distinct windows, in order: first line, last line, hash of the lines, position of the fingerprint.

    The fingerprint of a window up to a line is that of the window from its first line on, which lies in it.
    """
    total = np.concatenate([[0], np.cumsum(counts)])
    ends = np.searchsorted(total, total[:-1] + min_words)
    n = len(hashes)
    chosen = window_minima(hashes, counts, min_words)
    spans = {(i, e - 1) for i, e in enumerate(ends.tolist()) if e <= n}
    starts = np.searchsorted(total, total[1:] - min_words, "right") - 1
    spans |= {(s, e) for e, s in enumerate(starts.tolist()) if s >= 0}
    raw = np.ascontiguousarray(hashes, "<i8").tobytes()
    out, at = [], 0
    values = hashes.tolist()
    minimum: dict[int, int] = {}
    for s, e in sorted(spans):
        if s not in minimum:
            while chosen[at] < s:
                at += 1
            k = at
            for c in range(at + 1, len(chosen)):
                if chosen[c] >= ends[s]:
                    break
                if values[chosen[c]] <= values[chosen[k]]:
                    k = c
            minimum[s] = chosen[k]
        out.append((s, e, xxhash.xxh64_intdigest(raw[8 * s:8 * e + 8]), minimum[s]))
    return out


def fingerprints(docs: DataFrame, min_words: int) -> DataFrame:
    """docs (_key, _copy, _text) to rows (_key, _copy, line, w, s, e): the selected lines, and the hashes,
    first and last lines of their windows."""

    def run(batches):
        for b in batches:
            rows, line, size, w, s, e = [], [], [], [], [], []
            for r, t in enumerate(b.column(2)):
                _, _, hashes, counts = line_words(t.as_py())
                old = None
                for first, last, h, p in windows(hashes, counts, min_words):
                    if p != old:
                        rows.append(r), line.append(hashes[p]), size.append(0)
                        old = p
                    size[-1] += 1
                    w.append(h), s.append(first), e.append(last)
            take, at = pa.array(rows, pa.int64()), pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (np.array(w, np.uint64).view(np.int64), np.array(s, np.int32), np.array(e, np.int32))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(line, pa.int64()), *lists],
                                             names=["_key", "_copy", "line", "w", "s", "e"])

    kind = docs.schema["_key"].dataType.simpleString()
    return docs.select("_key", "_copy", "_text").mapInArrow(
        run, f"_key {kind}, _copy long, line long, w array<long>, s array<int>, e array<int>")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs (_key, _copy, _text) to rows (_key, _copy, runs): runs of lines, by number among the lines
    with words, that an earlier place has too, one in the same text that doesn't overlap them. Places are ordered by key (null last), copy and line."""
    chosen = stored(fingerprints(docs, min_words), "winnow-lines")
    again = chosen.groupBy("line").agg(F.count("*").alias("n")).filter("n > 1").select("line")
    chosen = chosen.join(stored(again, "winnow-again"), "line").select("_key", "_copy", F.explode(F.arrays_zip("w", "s", "e")).alias("x"))
    looked = stored(chosen.select("_key", "_copy", "x.w", "x.s", "x.e"), "winnow-windows")
    place = F.struct(F.col("_key").isNull().alias("none"), "_key", "_copy", "s")
    first = looked.groupBy("w").agg(F.count("*").alias("n"), F.min(place).alias("f")).filter("n > 1").select("w", "f")
    # Inside one text a repeat starts behind the end of the first place: a run that overlaps itself keeps its first copy.
    here = F.col("_key").eqNullSafe(F.col("f._key")) & (F.col("_copy") == F.col("f._copy"))
    behind = (place > F.col("f")) & (~here | (F.col("s") > F.col("f.s") + F.col("e") - F.col("s")))
    met = looked.join(stored(first, "winnow-first"), "w").filter(behind)
    return met.groupBy("_key", "_copy").agg(F.collect_set(F.struct("s", "e")).alias("runs"))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later repeated runs of lines deleted; all columns, and n_lines and n_removed.

    Lines are equal if their words are. A run counts from `min_words` words on, over lines with words;
    lines without words inside a deleted run go with it. The first place by key keeps its text, that of a run
    repeated inside one document included, overlaps of a periodic text with itself too. A null text stays null; a document whose lines are all
    repeats keeps an empty text. Rows that repeat key and text are one document, for which nothing is
    deleted on account of the other; null keys come last. An empty table gives an empty result. The
    names n_lines and n_removed replace columns of these names.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    runs = stored(repeated_runs(docs.select(F.col(key).alias("_key"), F.xxhash64(body).alias("_copy"), body.alias("_text")), min_words), "winnow-runs")
    plain = docs.drop("n_lines", "n_removed")
    marked = plain.select(F.struct(*plain.columns).alias("row"), F.col(key).alias("k"), F.xxhash64(body).alias("c"))
    # The runs grow with the corpus: texts meet them by a shuffle at every size, never by a broadcast.
    joined = marked.join(runs.hint("merge"), F.col("k").eqNullSafe(F.col("_key")) & (F.col("c") == F.col("_copy")), "left")
    joined = joined.select("row.*", F.col("runs").alias(fresh("runs", plain.columns)))
    names, at = [*plain.columns, "n_lines", "n_removed"], plain.columns.index(text)

    def run(batches):
        for b in batches:
            texts, n_lines, n_removed = [], [], []
            for t, r in zip(b.column(at), b.column(len(names) - 2), strict=True):
                old, found = t.as_py(), r.as_py()
                lines, where, _, counts = line_words(old)
                gone = np.zeros(len(lines) + 1, np.int64)
                total = np.concatenate([[0], np.cumsum(counts)])
                for x in found or []:
                    if total[x["e"] + 1] - total[x["s"]] >= min_words:
                        gone[where[x["s"]]] += 1
                        gone[where[x["e"]] + 1] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                texts.append("\n".join(x for x, g in zip(lines, gone.tolist(), strict=True) if not g) if gone.any() else old)
                n_lines.append(len(lines)), n_removed.append(int(gone.sum()))
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema) + ", n_lines long, n_removed long"
    return joined.withColumn(text, F.col(text).cast("string")).mapInArrow(run, schema)


def op2_line_winnowing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)
