"""Near-duplicates by SimHash, found with meet-in-the-middle ball hashing.

Two fingerprints differ in at most 2r bits exactly when some value lies within r bits of both. So
every distinct fingerprint emits all values within r bits of itself, these are shuffled, and what
meets at a value is linked. Meeting fingerprints all lie in one ball, so a group has at most as many
members as a ball has values (65 for r = 1), and a star onto its smallest member links all of it.

`keep_one` looks for texts whose sets of shingles are similar. Their long fingerprints differ in too
many bits for a ball, so each text has several short independent ones with a ball each, and a min-hash beside
each that keeps unrelated texts apart; what meets in any of them is a candidate, and the shingles decide.
Each text is first paired with a leader of its meeting point. What that leaves apart is then compared whole.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.llm.common import components, fresh, stored, table
from aerostrata.llm.piece_dropout import mix

SEED = 42
CHUNK = 1 << 15
# Of keep_one. A table's key is a min-hash (equal with 80 % at the threshold) and a SimHash of BITS bits, of which texts
# at the threshold differ in 15 %: with a ball of one bit each they meet in a table with 58 %, in one of the tables
# with 99 %. The min-hash has 64 bits, so texts meet only if they share a shingle, however many there are.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
TABLES, BITS = 6, 12
# Texts that meet in one task at most, about, and in a block of those compared each with each.
CROWD, BLOCK = 4096, 4096
# Shingles in the sketch of those: the smallest, so all of a short text.
SKETCH = 256
# Bits of the filter that keeps texts which no pair needs out of the shuffle: for each key wanted, and 8 MB at most.
KEY_BITS, MOST_KEY_BITS = 16, 1 << 26


def shingle_hashes(words: list[bytes], shingle_words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text with fewer words than a shingle has one, one without words none."""
    if not words:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(words), len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    k = min(shingle_words, n)
    starts, digest = (ends - lengths)[: n - k + 1].tolist(), xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1:].tolist(), strict=True)), np.uint64, len(starts)))


def _salted(hashes: np.ndarray, n: int):
    return (mix(hashes[at:at + CHUNK] + np.uint64((n + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) for at in range(0, len(hashes), CHUNK))


def _majority(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of 64 bits most of the hashes have, salted by n."""
    ones = np.zeros(64, np.int64)
    for part in _salted(hashes, n):
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return 2 * ones > len(hashes)


def short_fingerprints(hashes: np.ndarray, tables: int, bits: int) -> tuple[int, list[int], list[int]]:
    """A check of 64 bits, and for each table a min-hash and a SimHash of `bits` bits; all are independent."""
    words = -(-tables * bits // 64) + 1
    out = [_majority(hashes, word) for word in range(words)]
    check = int(np.packbits(out[0], bitorder="little").view("<i8")[0])
    rows = np.concatenate(out[1:])[: tables * bits].reshape(tables, bits).astype(np.int64)
    mins = [int(min(part.min() for part in _salted(hashes, words + t)).view(np.int64)) for t in range(tables)]
    return check, mins, (rows << np.arange(bits)).sum(1).tolist()


def sketch(hashes: np.ndarray) -> bytes:
    """The upper halves of the SKETCH smallest of the sorted hashes."""
    return (hashes[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes()


def maybe_similar(one: np.ndarray, others: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the sketches `others` (one a row, filled with -1) may be that of a text similar to that of the sketch `one`.

    Up to where both know all their shingles their similarity is that of a sample, allowed four standard deviations; it is
    exact if both sketches hold the whole text. Equal halves of different hashes can only add to it.
    """
    own = one[one >= 0]
    known = lambda x: np.where(x[..., -1] >= 0, x[..., -1], 1 << 32)
    upto = np.minimum(known(one), known(others))
    common = ((own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others) & (others >= 0)).sum(1)
    both = np.searchsorted(own, upto, "right") + ((others >= 0) & (others <= upto[:, None])).sum(1) - common
    spread = np.where(upto >= 1 << 32, 0, 4 * np.sqrt(similarity * (1 - similarity) * both))
    return common >= similarity * both - spread - 1e-9


def simhash(text: str | None, shingle_words: int = 3) -> int:
    """64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes.

    Words are runs of anything but space and tab to carriage return; A-Z are lower-cased. A text
    with fewer words than a shingle has one shingle, one without words the fingerprint zero.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    k = min(shingle_words, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK], strict=True)], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle_words: int = 3) -> DataFrame:
    """Rows (key, fp long): one per document."""

    def run(batches):
        for b in batches:
            fps = np.array([simhash(t, shingle_words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["key", "fp"])

    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("fp", T.LongType())])
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def ball_masks(half: int) -> list[int]:
    """All values of at most `half` set bits, as signed 64-bit numbers."""
    masks = [sum(1 << b for b in bits) for n in range(half + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def ball_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Distinct rows (u, v), u > v, that connect all fingerprints (column fp, distinct) differing in
    at most `radius` bits (an even number), each verified."""
    if radius % 2 or radius < 2:
        raise ValueError("the radius must be even: variants reach half of it")
    masks = F.lit(ball_masks(radius // 2))
    variants = fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    balls = variants.groupBy("variant").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return (balls.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u"))
            .filter("u <> v").distinct()
            .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle_words: int = 3,
                    radius: int = 2) -> DataFrame:
    """One row per document: key, fp long, component (smallest key reachable over links).

    A null text counts as one without words; all such documents share the fingerprint zero and are
    linked. Rows with a null key get a fingerprint and the component of their fingerprint, but give
    no component its name; a component of null keys alone is null. Repeated rows stay, an empty
    table gives an empty result, other columns are not read.
    """
    marked = stored(fingerprints(docs, text, key, shingle_words), "simhash-fp")
    first = stored(marked.groupBy("fp").agg(F.min("key").alias("first")), "simhash-first")
    roots = components(ball_links(first, radius), "simhash")
    placed = stored(first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-placed")
    named = stored(placed.groupBy("root").agg(F.min("first").alias("component")), "simhash-named")
    names = stored(placed.join(named, "root").select("fp", "component"), "simhash-names")
    return marked.join(names, "fp").select(F.col("key").alias(key), "fp", "component")


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _met(same: np.ndarray, check: np.ndarray, leaders: list[tuple[int, int]], most: int) -> list[np.ndarray]:
    """Pairs (rows of two) of the members of one meeting point whose checks differ in at most `most` bits: each with the
    first leader it is close to and with the member before it. Who is close to no leader becomes one.

    `leaders` (same, check) may hold those of earlier members, and is added to.
    """
    out, left = [], np.arange(len(same))
    close = lambda x, y: np.bitwise_count((x ^ y).view(np.uint64)) <= most  # noqa: E731  of signed numbers it counts the absolute value
    near = np.flatnonzero(close(check[1:], check[:-1]))
    out.append(np.stack([same[near], same[near + 1]], 1))
    at = 0
    while len(left):
        if at == len(leaders):
            leaders.append((int(same[left[0]]), int(check[left[0]])))
        on = close(check[left], np.full(len(left), leaders[at][1], np.int64))
        out.append(np.stack([np.full(on.sum(), leaders[at][0], np.int64), same[left[on]]], 1))
        left, at = left[~on], at + 1
    return out


def meetings(members: DataFrame, most: int) -> DataFrame:
    """members (point, same, check) to rows (u, v), u < v: at most two a member and point."""

    def run(batches):
        point, leaders, last = None, [], None
        for b in batches:
            points, same, check = (c.to_numpy() for c in b.columns)
            if not len(points):
                continue
            starts = np.append(np.flatnonzero(np.append(True, points[1:] != points[:-1])), len(points))
            shared = np.flatnonzero((np.diff(starts) > 1) | (points[starts[:-1]] == point))
            out = [np.zeros((0, 2), np.int64)]
            for i in np.union1d(shared, [len(starts) - 2]).tolist():
                part = slice(starts[i], starts[i + 1])
                own_s, own_c = same[part], check[part]
                if points[starts[i]] == point:
                    own_s, own_c = np.append(last[0], own_s), np.append(last[1], own_c)
                else:
                    leaders = []
                out += _met(own_s, own_c, leaders, most)
                point, last = points[starts[i]], (own_s[-1], own_c[-1])
            pairs = np.concatenate(out)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            pairs = np.unique(np.sort(pairs, 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    return members.select("point", "same", "check").repartition("point").sortWithinPartitions("point", "check", "same").mapInArrow(run, "u long, v long")


def close_checks(similarity: float) -> int:
    """In how many of 64 bits the SimHashes of texts at that similarity differ, with four standard deviations."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(64 * p + 4 * math.sqrt(64 * p * (1 - p)))


def meeting_keys(classes: DataFrame) -> DataFrame:
    """classes (same, check, mins, bits) to rows (same, check, base, f): a table's min-hash, as `base`, and its SimHash."""
    return classes.select("same", "check", F.posexplode(F.arrays_zip("mins", "bits")).alias("t", "x")).select(
        "same", "check", F.xxhash64("t", "x.mins").alias("base"), F.col("x.bits").alias("f"))


def _within_one(bits: int):
    return F.explode(F.transform(F.lit([0, *(1 << b for b in range(bits))]), lambda m: F.col("f").bitwiseXOR(m)))


def candidates(tables: DataFrame, bits: int, most: int) -> DataFrame:
    """tables (same, check, base, f) to distinct rows (u, v), u < v, that meet in a table and may be similar.

    Texts equal in a table's min-hash and SimHash meet first. One of them then emits all values within one bit
    to meet the others with this min-hash, if there are any. So pairs are in proportion to the texts, whatever
    the size of a group; `other_candidates` has those that are left.
    """
    # A crowded key is dealt by a hash of the text; the first of each share meet again under the key itself.
    crowds = tables.groupBy("base", "f").agg(F.ceil(F.count("*") / CROWD).alias("shares")).filter("shares > 1")
    dealt = tables.join(crowds, ["base", "f"], "left").withColumn("share", F.coalesce(F.pmod(F.xxhash64("same"), "shares"), F.lit(-1)))
    firsts = dealt.filter("share >= 0").groupBy("base", "f", "share").agg(F.min(F.struct("same", "check")).alias("rep"))
    equal = meetings(dealt.withColumn("point", F.xxhash64("base", "f", "share")), most).union(
        meetings(firsts.select(F.xxhash64("base", "f").alias("point"), "rep.same", "rep.check"), most))
    reps = tables.groupBy("base", "f").agg(F.min(F.struct("same", "check")).alias("rep"))
    several = reps.groupBy("base").agg(F.count("*").alias("n")).filter("n > 1").select("base")
    variants = (reps.join(several, "base").select("base", "f", "rep.same", "rep.check")
                .select("same", "check", "base", _within_one(bits).alias("value"))
                .withColumn("point", F.xxhash64("base", "value")))
    return equal.union(meetings(variants, most)).distinct()


def _apart(root: np.ndarray, same: np.ndarray, check: np.ndarray, f: np.ndarray, block: np.ndarray, sketches: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs (rows of two) with different roots that meet and whose checks and sketches are close; of several blocks those across."""
    across = len(block) and block.min() != block.max()
    most = close_checks(similarity)
    out = [np.zeros((0, 2), np.int64)]
    for i in range(len(same) - 1):
        on = ((np.bitwise_count((check[i + 1:] ^ check[i]).view(np.uint64)) <= most) & (np.bitwise_count((f[i + 1:] ^ f[i]).view(np.uint64)) <= 2)
              & (root[i + 1:] != root[i]))
        if across:
            on &= block[i + 1:] != block[i]
        j = np.flatnonzero(on) + i + 1
        if len(j):
            j = j[maybe_similar(sketches[i], sketches[j], similarity)]
            out.append(np.stack([np.full(len(j), same[i], np.int64), same[j]], 1))
    return np.sort(np.concatenate(out), 1)


def compared(members: DataFrame, similarity: float) -> DataFrame:
    """members (cell, root, same, check, f, block, sketch) to rows (u, v), u < v: all pairs of a cell that may be similar and have different roots."""

    def run(batches):
        held = None

        def batch(parts):
            pairs = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *parts]), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        for b in batches:
            raw = b.column(6).to_pylist()
            sketches = np.full((len(raw), SKETCH), -1, np.int64)
            sketches[np.arange(SKETCH) < np.fromiter((len(x) // 4 for x in raw), np.int64, len(raw))[:, None]] = np.frombuffer(b"".join(raw), "<u4")
            cols = [*(c.to_numpy() for c in b.columns[:-1]), sketches]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            starts = np.append(np.flatnonzero(np.append(True, cols[0][1:] != cols[0][:-1])), len(cols[0]))
            yield batch([_apart(*(c[s:e] for c in cols[1:]), similarity) for s, e in zip(starts[:-2].tolist(), starts[1:-1].tolist(), strict=True)])
            held = [c[starts[-2]:] for c in cols]
        if held is not None:
            yield batch([_apart(*held[1:], similarity)])

    members = members.select("cell", "root", "same", "check", "f", "block", "sketch")
    return members.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "u long, v long")


def left_apart(tables: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (base, n, same, check, f, root) of the texts with a min-hash that texts with other roots (node, root) have too."""
    several = tables.groupBy("base").agg(F.count("*").alias("n")).filter("n > 1").select("base")
    members = tables.join(several, "base").withColumnRenamed("same", "node").join(roots, "node", "left").withColumnRenamed("node", "same")
    return _of_several_roots(stored(members.withColumn("root", F.coalesce("root", "same")), "similar-members"), "base")


def _of_several_roots(rows: DataFrame, by: str) -> DataFrame:
    """Of the places where more than one root is left; n is how many meet there."""
    left = rows.groupBy(by).agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select(by, "n")
    return rows.join(left, by)


def other_candidates(members: DataFrame, tested: DataFrame, bits: int, similarity: float) -> DataFrame:
    """members (as `left_apart` gives them, and the `sketch`) to distinct rows (u, v), u < v, not yet tested: all that
    meet in a table, may be similar and don't have one root.

    Texts with one min-hash are compared directly while they are few. Many are compared where their balls meet, and
    a crowded place block by block, so that no task holds more than two blocks.
    """
    whole = ["root", "same", "check", "f", "sketch"]
    few = members.filter(F.col("n") <= BLOCK).select(F.col("base").alias("cell"), *whole, F.lit(0).cast("long").alias("block"))
    many = members.filter(F.col("n") > BLOCK).select(*whole, "base", _within_one(bits).alias("value"))
    many = _of_several_roots(many.select(*whole, F.xxhash64("base", "value").alias("point")), "point")
    many = many.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("same"), "blocks"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    many = many.select(F.xxhash64("point", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), *whole, "block")
    return compared(few.union(many), similarity).distinct().join(tested, ["u", "v"], "left_anti")


def maybe_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """rows (key, text) without most of those whose key is not in wanted (key); those that are all stay, a join must follow.

    One bit for each hash of a key tells. The bits are bounded, so with very many keys more rows pass.
    """
    size = min(MOST_KEY_BITS, 1 << max(12, (KEY_BITS * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64("key"), F.lit(size)).alias("at")
    words = wanted.select(place).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
    known = np.zeros(size >> 6, np.int64)
    known[words.column("word").to_numpy()] = words.column("bits").to_numpy()

    def run(batches):
        for b in batches:
            at = b.column(2).to_numpy()
            yield b.select([0, 1]).filter(pa.array((known[at >> 6] >> (at & 63) & 1).astype(bool)))

    return rows.select("key", "text", place).mapInArrow(run, rows.select("key", "text").schema)


def similar_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle_words: int = SHINGLE_WORDS,
                   similarity: float = SIMILARITY, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """One row per document: key, component (smallest key reachable over pairs of similar texts).

    Texts are similar if their sets of shingles have at least that Jaccard similarity. Equal words are
    one text; texts without words are equal to each other only. Short fingerprints propose the pairs,
    so similar pairs that meet in no table are missed. Every pair that meets is verified, unless other links
    connect it already; none is dropped on account of how many meet. Texts that only rows with a null
    key have link nothing, and their component is null.
    """
    kind = docs.schema[key].dataType
    plain = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def mark(batches):
        for b in batches:
            words = [_words(t) for t in b.column(1).to_pylist()]
            same = np.array([xxhash.xxh64_intdigest(b" ".join(w), SEED) for w in words], np.uint64).view(np.int64)
            marks = [short_fingerprints(shingle_hashes(w, shingle_words), tables, bits) if w else (0, [], []) for w in words]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(same), pa.array([m[0] for m in marks], pa.int64()),
                                              *(pa.array([m[i] for m in marks], pa.list_(pa.int64())) for i in (1, 2))], names=["key", "same", "check", "mins", "bits"])

    def sets(what, kind):
        def run(batches):
            for b in batches:
                words = [_words(t) for t in b.column(1).to_pylist()]
                own = [i for i, (w, s) in enumerate(zip(words, b.column(0).to_pylist(), strict=True))
                       if xxhash.xxh64_intdigest(b" ".join(w), SEED) == s % (1 << 64)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own, pa.int64())),
                                                  pa.array([what(shingle_hashes(words[i], shingle_words)) for i in own], kind)],
                                                 names=["same", "shingles"])

        return run

    schema = T.StructType([T.StructField("key", kind), T.StructField("same", T.LongType()), T.StructField("check", T.LongType()),
                           T.StructField("mins", T.ArrayType(T.LongType())), T.StructField("bits", T.ArrayType(T.LongType()))])
    marked = stored(plain.mapInArrow(mark, schema), "similar-marks")
    classes = stored(marked.groupBy("same").agg(F.min("key").alias("first"), F.min("check").alias("check"), F.first("mins").alias("mins"), F.first("bits").alias("bits")), "similar-classes")
    most = close_checks(similarity)
    keys = stored(meeting_keys(classes.filter(F.col("first").isNotNull())), "similar-tables")

    def of_texts(needed: DataFrame, what, kind: pa.DataType, name: str) -> DataFrame:
        needed = stored(classes.join(needed.distinct(), "same").select("same", F.col("first").alias("key")), "similar-needed")
        found = maybe_wanted(plain, needed.select("key")).join(needed, "key").select("same", "text").mapInArrow(sets(what, kind), f"same long, shingles {name}")
        return stored(found.dropDuplicates(["same"]), "similar-shingles")

    def verified(pairs: DataFrame) -> DataFrame:
        found = of_texts(pairs.select(F.col("u").alias("same")).union(pairs.select(F.col("v").alias("same"))), lambda hashes: hashes.view(np.int64), pa.list_(pa.int64()), "array<long>")
        left, right = found.select(F.col("same").alias("u"), F.col("shingles").alias("a")), found.select(F.col("same").alias("v"), F.col("shingles").alias("b"))
        common, both = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
        # The smaller of a pair leads it, and has many: the other's shingles are sent to it.
        return pairs.join(right, "v").join(left, "u").filter(common >= F.lit(similarity) * (both - common)).select("u", "v")

    pairs = stored(candidates(keys, bits, most), "similar-pairs")
    roots = stored(components(verified(pairs), "similar"), "similar-roots")
    apart = stored(left_apart(keys, roots), "similar-apart")
    members = apart.join(of_texts(apart.select("same"), sketch, pa.binary(), "binary").withColumnRenamed("shingles", "sketch"), "same")
    others = stored(other_candidates(members, pairs, bits, similarity), "similar-others")
    links = verified(others).union(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
    roots = components(links, "similar-all")
    placed = stored(classes.join(roots.withColumnRenamed("node", "same"), "same", "left")
                    .select("same", "first", F.coalesce("root", "same").alias("root")), "similar-placed")
    named = stored(placed.groupBy("root").agg(F.min("first").alias("component")), "similar-named")
    names = stored(placed.join(named, "root").select("same", "component"), "similar-names")
    return marked.join(names, "same").select(F.col("key").alias(key), "component")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle_words: int = SHINGLE_WORDS,
             similarity: float = SIMILARITY, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """The documents without those whose group of similar texts has a smaller key; columns as given.

    Rows with a null key stay. Of rows that repeat a kept key all stay.
    """
    groups = similar_groups(docs.select(key, text), text, key, shingle_words, similarity, tables, bits)
    name = fresh("gone", docs.columns)
    gone = groups.filter(F.col(key) > F.col("component")).select(F.col(key).alias(name)).distinct()
    return docs.join(stored(gone, "similar-gone"), F.col(key) == F.col(name), "left_anti")


def op7_simhash_near_dedup(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))
