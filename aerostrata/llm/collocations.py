"""Collocations from FM-indexes over word numbers, one per shard, summed across shards.

A shard holds the words of one language of some texts as numbers. Its bidirectional FM-index, two
Burrows-Wheeler transforms of the numbers read forwards and backwards, knows each phrase by its rows
in both. Extending a phrase by a word on the left is a step in the one transform, on the right in the
other, and moves the rows of both; how often the phrase goes on with each word are the counts of the
longer phrases. A phrase is extended only if it is frequent in the whole corpus, and an extension
counts only if its words without the first, and without the last, are frequent as well. So there is one
exchange for each length: shards send the counts of their extensions, dealt by a hash of the phrase into
buckets, sorted and packed, so that one takes a few bytes; a bucket sums them, and its shards get back which
are frequent. Places that no frequent phrase covers leave the shard.

Rows need only be sorted as many words deep as the phrases are long.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm.common import A_Z, LOWER_A_Z, stored, table
from aerostrata.llm.piece_dropout import mix

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
SHARD_WORDS = 1 << 20
# A bucket gets about so many extensions of all shards, at most.
BUCKET_ENTRIES = 1 << 21
# A text is read in parts of about so many bytes, cut where a piece ends.
PART = 1 << 22
BREAKS = b".,;:!?\n\x0b\x0c\r"
AT_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
LOWER = bytes.maketrans(BREAKS + A_Z.encode(), b"\xff" * len(BREAKS) + LOWER_A_Z.encode())
# Shard and number in the shard, in one long.
NODE_BITS = 28
NO_LANG = "und"


def pack_ints(x: np.ndarray) -> bytes:
    """Numbers below 2^32, their bytes by significance, compressed."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack_ints(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    planes = np.frombuffer(pa.decompress(b[8:], 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def pack_entries(prefix: np.ndarray, suffix: np.ndarray, n: np.ndarray) -> bytes:
    """Rows sorted by prefix; what differs from the prefix before, the suffix and the count, by significance of their bytes, compressed."""
    planes = [np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T) for x in (np.diff(prefix, prepend=0), suffix, n)]
    return len(n).to_bytes(8, "little") + pa.compress(np.concatenate(planes).tobytes(), codec="zstd", asbytes=True)


def unpack_entries(b: bytes) -> np.ndarray:
    """Prefixes, suffixes and counts, a row of the result each."""
    n = int.from_bytes(b[:8], "little")
    planes = np.frombuffer(pa.decompress(b[8:], 24 * n, codec="zstd", asbytes=True), np.uint8).reshape(3, 8, n)
    differences, suffix, count = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8").reshape(3, n)
    return np.stack([np.cumsum(differences), suffix, count])


class Words:
    """The words of one shard while they are gathered; number 0 is a break between pieces."""

    def __init__(self):
        self.known, self.lists, self.size = {b"\xff": 0}, [np.zeros(1, np.int64)], 0

    def add(self, text: bytes):
        words = text.translate(LOWER).replace(b"\xff", b" \xff ").split()
        for at in range(0, len(words), 1 << 17):
            some = words[at:at + (1 << 17)]
            for w in some:
                if w not in self.known:
                    self.known[w] = len(self.known)
            self.lists.append(np.fromiter(map(self.known.__getitem__, some), np.int64, len(some)))
        self.lists.append(np.zeros(1, np.int64))
        self.size += len(words)


def shards(docs: DataFrame, text: str, lang: str, shard_words: int) -> DataFrame:
    """Rows (shard, lang, n words, words, counts, ids): every shard is made by one task from its own rows."""

    def run(batches):
        task, made, open_ = TaskContext.get().partitionId(), 0, {}

        def row(name: str):
            nonlocal made
            s, made = open_.pop(name), made + 1
            ids = np.concatenate(s.lists)
            counts = np.bincount(ids, minlength=len(s.known))
            words = pa.array(list(s.known)[1:], pa.binary()).cast(pa.string())
            flat = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 12) + made - 1]), pa.array([name], pa.string()), pa.array([int(counts[1:].sum())]), flat(words),
                 flat(pa.array(counts[1:], pa.int64())), pa.array([pack_ints(ids)], pa.binary())], names=["shard", "lang", "n", "words", "counts", "ids"])

        for b in batches:
            for raw, name in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
                at = 0
                while raw and at < len(raw):
                    cut = AT_BREAK.search(raw, at + PART) if len(raw) > at + PART else None
                    end = cut.end() if cut else len(raw)
                    s = open_.get(name) or open_.setdefault(name, Words())
                    s.add(raw[at:end])
                    at = end
                    if s.size >= shard_words:
                        yield row(name)
        for name in list(open_):
            yield row(name)

    read = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"))
    return read.mapInArrow(run, "shard long, lang string, n long, words array<string>, counts array<long>, ids binary")


class Half:
    """Rows of all places of `ids`, sorted by the `depth` numbers from there on, and the transform: the number before each."""

    def __init__(self, ids: np.ndarray, depth: int):
        rank, have = ids, 1
        while have < depth:
            step = min(have, depth - have)
            rank = np.unique(rank * (int(rank.max()) + 1) + np.concatenate([rank[step:], np.zeros(step, np.int64)]), return_inverse=True)[1]
            have += step
        self.rank, self.place = rank, np.argsort(rank, kind="stable")
        self.size = np.bincount(rank)
        self.first = np.cumsum(self.size) - self.size
        self.before = ids[self.place - 1]
        # Occurrences sorted by number and row: where (c, row) stands is the row of c + what is sorted there.
        self.n = len(ids)
        self.steps = np.sort(self.before * self.n + np.arange(self.n))

    def step(self, c: np.ndarray, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.steps, c * self.n + row)


class Index:
    """Bidirectional FM-index of numbers with a 0 at either end; phrases of `depth` words are its nodes."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, self.depth, self.m = ids, depth, int(ids.max()) + 1
        self.halves = Half(ids, depth), Half(ids[::-1], depth)

    def nodes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First rows forwards and backwards, and the number of rows, of the phrases that begin at these places."""
        forward, backward = self.halves
        a, b = forward.rank[starts], backward.rank[len(self.ids) - starts - self.depth]
        return forward.first[a], backward.first[b], forward.size[a]

    def extend(self, nodes: tuple[np.ndarray, np.ndarray, np.ndarray], right: bool) -> dict[str, np.ndarray]:
        """All phrases one word longer, to the right or left: the node extended (`node`), `count`, first rows in the half
        stepped in (`row`) and in the `other`, and the phrase of each row looked at (`of`, -1 for a break) with its `start`."""
        half = self.halves[right]
        lo, other = (nodes[1], nodes[0]) if right else (nodes[0], nodes[1])
        size = nodes[2]
        ends = np.cumsum(size)
        rows = np.repeat(lo - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        node = np.repeat(np.arange(len(lo)), size)
        key, of, count = np.unique(node * self.m + half.before[rows], return_inverse=True, return_counts=True)
        node, c = key // self.m, key % self.m
        # In the other half the longer phrases lie in the node's rows, in the order of the added word.
        less = np.cumsum(count) - count
        less -= less[np.searchsorted(node, node)]
        real = c > 0
        number = np.where(real, np.cumsum(real) - 1, -1)
        place = half.place[rows]
        start = len(self.ids) - place - self.depth if right else place - 1
        node, c, count, less = (x[real] for x in (node, c, count, less))
        return {"node": node, "count": count, "row": half.step(c, lo[node]), "other": other[node] + less, "of": number[of], "start": start}


def extensions(index: Index, nodes: tuple[np.ndarray, np.ndarray, np.ndarray], right: bool) -> dict[str, np.ndarray]:
    """Extensions both of whose phrases without an outer word are nodes: `prefix` and `suffix` are their numbers."""
    e = index.extend(nodes, right)
    lo = nodes[1] if right else nodes[0]
    order = np.argsort(lo)
    at = np.searchsorted(lo[order], e["row"], "right") - 1
    near = order[np.maximum(at, 0)] if len(order) else at
    good = (at >= 0) & (e["row"] < lo[near] + nodes[2][near]) if len(order) else at >= 0
    number = np.append(np.where(good, np.cumsum(good) - 1, -1), -1)
    e["of"] = number[e["of"]]
    near, node = near[good], e["node"][good]
    return e | {"count": e["count"][good], "prefix": node if right else near, "suffix": near if right else node}


def collapsed(ids: np.ndarray) -> np.ndarray:
    """Which places stay when a run of breaks becomes one."""
    return (ids > 0) | np.append(True, ids[:-1] > 0)


STEP = "shard long, ids binary, starts binary, names array<long>, bucket long, entries binary"
FOUND = "bucket long, shard long, at binary, names binary, name long, prefix long, suffix long, f long"


def _dealt(names: np.ndarray, prefix: np.ndarray, suffix: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of extensions by bucket and then by the names of their prefix and suffix, and where each bucket begins."""
    bucket = (mix(names.astype(np.uint64)[prefix] * np.uint64(0x9E3779B97F4A7C15) + names.astype(np.uint64)[suffix]) % np.uint64(buckets)).astype(np.int64)
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(names)] = np.arange(len(names))
    order = np.argsort((bucket * len(names) + rank[prefix]) * len(names) + rank[suffix])
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _advance(words: int, buckets: int):
    """Takes a shard and which of its phrases of `words` words are frequent, with their names; gives the shard with only these,
    as one row, and its extensions, a row for each bucket."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("starts", pa.binary()), ("names", pa.list_(pa.int64())),
                            ("bucket", pa.int64()), ("entries", pa.binary())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, shard = unpack_ints(left.column("ids")[0].as_py()), key[0].as_py()
        if words == 1:
            order = pc.sort_indices(right.column("node"))
            node, names = right.column("node").take(order).to_numpy(), right.column("name").take(order).to_numpy()
            ids = (lambda new: new[ids])(_numbers(node + 1, int(ids.max()) + 1))
            covered = ids > 0
            starts_of = lambda kept: np.unique(kept, return_index=True)[1][1:]
        else:
            index = Index(ids, words - 1)
            e = extensions(index, index.nodes(unpack_ints(left.column("starts")[0].as_py())), words % 2 == 0)
            order, begins = _dealt(left.column("names")[0].values.to_numpy(), e["prefix"], e["suffix"], buckets)
            node = np.concatenate([order[begins[bucket] + unpack_ints(at)] for bucket, at in zip(right.column("bucket").to_pylist(), right.column("at").to_pylist(), strict=True)])
            names = np.concatenate([unpack_entries(x)[0] for x in right.column("names").to_pylist()])
            by_node = np.argsort(node)
            node, names = node[by_node], names[by_node]
            chosen = np.append(_numbers(node, len(e["count"])) - 1, -1)[e["of"]]
            at, chosen = e["start"][chosen >= 0], chosen[chosen >= 0]
            covered = np.zeros(len(ids), bool)
            for i in range(words):
                covered[at + i] = True
            first = at[np.unique(chosen, return_index=True)[1]]
            del index, e, at, chosen
            starts_of = None
        ids = np.where(covered, ids, 0)
        stays = collapsed(ids)
        ids = ids[stays]
        starts = starts_of(ids) if starts_of else (np.cumsum(stays) - 1)[first]
        index = Index(ids, words)
        e = extensions(index, index.nodes(starts), words % 2 == 1)
        order, begins = _dealt(names, e["prefix"], e["suffix"], buckets)
        prefix, suffix, count = names[e["prefix"]][order], names[e["suffix"]][order], e["count"][order]
        full = np.flatnonzero(np.diff(begins)).tolist()
        packed = [pack_entries(*(x[begins[i]:begins[i + 1]] for x in (prefix, suffix, count))) for i in full]
        n = len(full)
        head = pa.table([pa.array([shard]), pa.array([pack_ints(ids)], pa.binary()), pa.array([pack_ints(starts)], pa.binary()),
                         pa.array([names], pa.list_(pa.int64())), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())], schema=schema)
        body = pa.table([pa.array(np.full(n, shard, np.int64)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.int64())),
                         pa.array(full, pa.int64()), pa.array(packed, pa.binary())], schema=schema)
        return pa.concat_tables([head, body])

    return run


def _summed(min_count: int):
    """Takes a bucket's extensions, packed by shard; gives those whose counts sum to min_count or more, a row each with a name and
    the sum f, and for each shard at which places of its list these are, with their names."""

    def run(rows: pa.Table) -> pa.Table:
        bucket, shards = rows.column("bucket")[0].as_py(), rows.column("shard").to_pylist()
        parts = [unpack_entries(x) for x in rows.column("entries").to_pylist()]
        prefix, suffix, n = np.concatenate(parts, axis=1)
        ends = np.cumsum([x.shape[1] for x in parts])
        order = np.lexsort((suffix, prefix))
        p, s = prefix[order], suffix[order]
        starts = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (s[1:] != s[:-1])))
        f = np.add.reduceat(n[order], starts)
        good = f >= min_count
        name = np.where(good, (bucket << 32) + np.cumsum(good) - 1, -1)
        named = np.empty(len(order), np.int64)
        named[order] = np.repeat(name, np.diff(starts, append=len(order)))
        at, names, found = [], [], []
        for shard, begin, end in zip(shards, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            some = np.flatnonzero(named[begin:end] >= 0)
            if len(some):
                own, zero = named[begin + some], np.zeros(len(some), np.int64)
                found.append(shard), at.append(pack_ints(some)), names.append(pack_entries(own, zero, zero))
        long, m, k = pa.int64(), len(found), int(good.sum())
        columns = ["bucket", "shard", "at", "names", "name", "prefix", "suffix", "f"]
        marks = [pa.array([bucket] * m, long), pa.array(found, long), pa.array(at, pa.binary()), pa.array(names, pa.binary()), *[pa.nulls(m, long)] * 4]
        new = [pa.nulls(k, long), pa.nulls(k, long), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), *(pa.array(x[good]) for x in (name, p[starts], s[starts], f))]
        return pa.concat_tables([pa.table(x, names=columns) for x in (marks, new)])

    return run


def _numbers(chosen: np.ndarray, n: int) -> np.ndarray:
    """1, 2, ... at the chosen places of n, else 0."""
    out = np.zeros(n, np.int64)
    out[chosen] = np.arange(1, len(chosen) + 1)
    return out


def _frequent(counted: DataFrame, by: list[str], min_count: int) -> DataFrame:
    """Rows whose counts sum to min_count or more over all shards, with the sum f and a name, the smallest spot of its rows."""
    same = Window.partitionBy(*by)
    return (counted.withColumns({"f": F.sum("n").over(same), "name": F.min("spot").over(same)})
            .filter(F.col("f") >= min_count).drop("n"))


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to max_words words found min_count times or more in their language, and the languages' words (lang, n).

    Rows (lang, phrase, words, f, firsts, lasts, longer): firsts and lasts are the counts of the first and last 1, 2, ... words,
    longer is the count of the most frequent phrase with one word more (null: none that is frequent).

    Texts are cut into pieces at . , ; : ! ? and line ends, pieces into words at spaces and tabs; A-Z count as a-z. A null
    or empty text has no words; a null language is `und`. Repeated rows count each. An empty table gives an empty result,
    other columns are not read. A long text may be spread over shards, since phrases stay inside pieces.
    """
    cut = stored(shards(docs, text, lang, shard_words), "phrase-shards")
    each = (cut.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("node", "x"))
            .select("lang", F.col("x.words").alias("phrase"), (F.shiftleft("shard", NODE_BITS) + F.col("node")).alias("spot"), F.col("x.counts").alias("n")))
    found = stored(_frequent(each, ["lang", "phrase"], min_count), "phrase-words")
    none = F.array().cast("array<long>")
    levels = [stored(found.filter("spot = name").select("name", "lang", "phrase", F.col("phrase").alias("last"), "f", none.alias("firsts"), none.alias("lasts")), "phrases-1")]
    state, longer = cut.select("shard", "ids", F.lit(None).cast("binary").alias("starts"), none.alias("names")), []
    marks = found.select(F.shiftright("spot", NODE_BITS).alias("shard"), F.col("spot").bitwiseAND((1 << NODE_BITS) - 1).alias("node"), "name")
    buckets = max(1, -(-(cut.agg(F.sum("n")).first()[0] or 0) // BUCKET_ENTRIES))
    for words in range(1, max_words):
        step = stored(state.groupBy("shard").cogroup(marks.groupBy("shard")).applyInArrow(_advance(words, buckets), STEP), f"phrase-step-{words}")
        state = step.filter("ids is not null").select("shard", "ids", "starts", "names")
        found = stored(step.filter("ids is null").select("bucket", "shard", "entries").groupBy("bucket").applyInArrow(_summed(min_count), FOUND), f"phrase-found-{words}")
        marks = found.filter("shard is not null").select("shard", "bucket", "at", "names")
        new = found.filter("name is not null").select("name", "prefix", "suffix", "f")
        before = levels[-1]
        p = before.select(F.col("name").alias("prefix"), "lang", F.col("phrase").alias("head"), F.col("f").alias("pf"), "firsts")
        s = before.select(F.col("name").alias("suffix"), "last", F.col("f").alias("sf"), "lasts")
        levels.append(stored(new.join(p, "prefix").join(s, "suffix").select(
            "name", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", F.array_append("firsts", F.col("pf")).alias("firsts"),
            F.array_append("lasts", F.col("sf")).alias("lasts")), f"phrases-{words + 1}"))
        inside = new.select(F.col("prefix").alias("name"), "f").union(new.select(F.col("suffix").alias("name"), "f"))
        longer.append(inside.groupBy("name").agg(F.max("f").alias("longer")))
    parts = []
    for i, level in enumerate(levels):
        level = level.join(longer[i], "name", "left") if i < len(longer) else level.withColumn("longer", F.lit(None).cast("long"))
        parts.append(level.select("lang", "phrase", F.lit(i + 1).alias("words"), "f", "firsts", "lasts", "longer"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return stored(out, "phrases"), cut.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 top: int = TOP, inside_percent: int = 100, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Each language's first `top` phrases: lang, rank, phrase, a, l, r, n, score.

    The score is floor(1000 a n / (l r)) of the cut that makes it lowest, the first of equal ones; a, l and r are the counts of the
    phrase and its two parts, n that of all words. Phrases inside one that is longer and has inside_percent of their count or
    more are left out. Ties go by count, then by phrase.
    """
    phrases, totals = frequent_phrases(docs, text, lang, min_count, max_words, shard_words)
    alone = phrases.filter("words > 1").filter(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("f")))
    cuts = F.expr("""array_min(transform(sequence(1, words - 1), k -> struct(
        (1000 * cast(f as decimal(19, 0)) * cast(n as decimal(19, 0))) div
            (cast(firsts[k - 1] as decimal(19, 0)) * cast(lasts[words - k - 1] as decimal(19, 0))) as score,
        k as k, firsts[k - 1] as l, lasts[words - k - 1] as r)))""")
    scored = alone.join(totals, "lang").withColumn("cut", cuts)
    scored = scored.select("lang", "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_fm_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def oracle() -> str:
    return f"""
    WITH pieces AS (
        SELECT coalesce(lang, '{NO_LANG}') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), '{A_Z}', '{LOWER_A_Z}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
    grams AS (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
        FROM words, (SELECT unnest(range(1, {MAX_WORDS + 1})) AS k)),
    counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
    cuts AS (
        SELECT c.lang, c.phrase, c.k, c.f AS a, t.n, j, a.f AS l, b.f AS r,
               (1000 * c.f::HUGEINT * t.n::HUGEINT) // (a.f::HUGEINT * b.f::HUGEINT) AS score
        FROM counted c JOIN totals t USING (lang), unnest(range(1, c.k)) AS u(j),
             counted a, counted b
        WHERE a.lang = c.lang AND a.phrase = array_to_string(string_split(c.phrase, ' ')[1:j], ' ')
          AND b.lang = c.lang AND b.phrase = array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ')),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inner_of AS (
        SELECT DISTINCT g.lang, array_to_string(string_split(g.phrase, ' ')[x:x + m - 1], ' ') AS phrase, g.f
        FROM counted g, unnest(range(2, g.k)) AS v(m), unnest(range(1, g.k - m + 2)) AS w(x)),
    alone AS (SELECT * FROM lowest l WHERE NOT EXISTS (
        SELECT 1 FROM inner_of i WHERE i.lang = l.lang AND i.phrase = l.phrase AND 100 * i.f >= 100 * l.a))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
    FROM alone QUALIFY rank <= {TOP}"""
