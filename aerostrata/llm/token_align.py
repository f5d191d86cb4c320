"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

The tokens of both tokenizers cover a text's bytes without gaps. Every token points to the token that
overlaps it and reaches farthest to the right, or to itself if none reaches farther. Replacing all
pointers by their pointers' pointers doubles the distance of each jump; when nothing changes, every
token points to the last token of its group, the one whose end is an end in the other tokenizer too.

Texts are aligned many at a time as arrays. What a corpus needs beyond a text is only, for each pair
of ids, how many documents hold it linked; it is counted by a shuffle of pre-aggregated pairs and
looked up for each document's own pairs.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm.common import stored, table

MARK = "▁"
# Characters of texts aligned together, and about how long the parts are into which longer texts are cut.
TOGETHER, PART = 1 << 21, 1 << 20
# Counts of up to so many pairs are broadcast (about 30 bytes each); more are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000
# Both tokenizers start a token at a space between plain letters.
SEAM = re.compile(r"(?<=[A-Za-z,.]) (?=[A-Za-z])")


def joined(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of raw that begin at starts, in a row."""
    ends = np.cumsum(sizes)
    return raw[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Pieces:
    """The byte strings that the ids stand for."""

    def __init__(self, pieces: list[bytes]):
        self.raw = np.frombuffer(b"".join(pieces), np.uint8)
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return joined(self.raw, self.start[ids], self.size[ids])


class ByteTokens:
    """Byte-level BPE without special tokens. Texts of Latin characters go through the faster library, which
    splits them by the same rules and has the same ranks; others, where its tables of characters might
    be of another version, through the file's own."""

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
        rest = iter(range(256, 512))
        byte = {chr(b if b in plain else next(rest)): b for b in range(256)}
        vocab = self.own.get_vocab()
        pieces = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            pieces[i] = bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
        self.pieces = Pieces(pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.fast.encode_ordinary(t) if t.isascii() or max(t) < "ɐ"
                else self.own.encode(t, add_special_tokens=False).ids for t in texts]


class SentenceTokens:
    """A SentencePiece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.pieces = Pieces([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) else p.replace(MARK, " ").encode()
                              for i, p in enumerate(names)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def terminals(a_ends: np.ndarray, a_starts: np.ndarray, b_ends: np.ndarray, b_starts: np.ndarray) -> np.ndarray:
    """For each A token, then each B token, the number of the A token that ends its group.

    Both lists cover the same bytes without gaps.
    """
    n = len(a_ends)
    over_a = np.searchsorted(b_starts, a_ends, "left") - 1
    over_b = np.searchsorted(a_starts, b_ends, "left") - 1
    points = np.concatenate([np.where(b_ends[over_a] > a_ends, n + over_a, np.arange(n)), over_b])
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            return points
        points = farther


def parts(text: str) -> list[str]:
    """The text cut at spaces where both tokenizers start a token anyway, without these spaces."""
    out, at = [], 0
    while len(text) - at > 2 * PART:
        seam = SEAM.search(text, at + PART)
        if seam is None:
            break
        out.append(text[at:seam.start()])
        at = seam.end()
    return out + [text[at:]]


class Aligner:
    """Aligns lists of texts; the encoders are kept."""

    def __init__(self, a: ByteTokens, b: SentenceTokens):
        self.a, self.b = a, b
        digits = [f"{i},".encode() for i in range(max(len(a.pieces.size), len(b.pieces.size)))]
        self.digits = Pieces(digits)

    def align(self, texts: list[str]) -> list[dict | None]:
        """For each text (not empty, without the space before it) its tokens, groups and links; None where the bytes differ."""
        spaced = [" " + t for t in texts]
        lists_a, lists_b = self.a.encode(spaced), self.b.encode(texts)
        want = [t.encode("utf-8", "surrogatepass") for t in spaced]
        sizes, fits = np.array([len(w) for w in want], np.int64), np.ones(len(texts), bool)
        flat = {}
        for side, lists, pieces in (("a", lists_a, self.a.pieces), ("b", lists_b, self.b.pieces)):
            ids = np.fromiter((i for x in lists for i in x), np.int64, sum(map(len, lists)))
            of = np.repeat(np.arange(len(texts)), [len(x) for x in lists])
            fits &= np.bincount(of, pieces.size[ids], len(texts)).astype(np.int64) == sizes
            flat[side] = ids, of
        for side, pieces in (("a", self.a.pieces), ("b", self.b.pieces)):
            ids, of = (x[fits[flat[side][1]]] for x in flat[side])
            got, whole = pieces.bytes_of(ids), np.frombuffer(b"".join(w for w, f in zip(want, fits, strict=True) if f), np.uint8)
            wrong = np.flatnonzero(got != whole)
            if len(wrong):
                good = np.flatnonzero(fits)
                fits[good[np.searchsorted(np.cumsum(sizes[good]), wrong, "right")]] = False
        (a, a_of), (b, b_of) = ((ids[fits[of]], of[fits[of]]) for ids, of in (flat["a"], flat["b"]))
        out: list[dict | None] = [None] * len(texts)
        if not len(a):
            return out
        a_sizes, b_sizes = self.a.pieces.size[a], self.b.pieces.size[b]
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        last = terminals(a_ends, a_ends - a_sizes, b_ends, b_ends - b_sizes)
        # Groups are numbered by their last token, in byte order.
        number = np.cumsum(last[:len(a)] == np.arange(len(a))) - 1
        a_group, b_group = number[last[:len(a)]], number[last[len(a):]]
        # Two tokens overlap in exactly one of the stretches between neighbouring ends.
        ends = np.union1d(a_ends, b_ends)
        link_a, link_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        n_b, texts_n = len(self.b.pieces.size), len(texts)
        pair, times = np.unique(a_of[link_a] * (len(self.a.pieces.size) * n_b) + a[link_a] * n_b + b[link_b], return_counts=True)
        pair_of, pair = pair // (len(self.a.pieces.size) * n_b), pair % (len(self.a.pieces.size) * n_b)
        # The written groups: all A tokens of a group, then its B tokens.
        a_many, b_many = np.bincount(a_group), np.bincount(b_group)
        a_at = np.arange(len(a)) + (np.cumsum(b_many) - b_many)[a_group]
        b_at = np.arange(len(b)) + np.cumsum(a_many)[b_group]
        ids, sign = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[a_at], ids[b_at] = a, b
        sign[a_at[np.cumsum(a_many) - 1]], sign[b_at[np.cumsum(b_many) - 1]] = ord("|"), ord(";")
        written, sizes = self.digits.bytes_of(ids), self.digits.size[ids]
        signs_at = np.cumsum(sizes) - 1
        written[signs_at] = sign
        cut = {k: np.searchsorted(of, np.arange(texts_n + 1)) for k, of in (("a", a_of), ("b", b_of), ("pair", pair_of), ("link", a_of[link_a]))}
        tokens_end = cut["a"] + cut["b"]
        ends_at = np.append(0, signs_at + 1)[tokens_end]
        group_end = np.append(0, a_group + 1)[cut["a"]]
        for i in np.flatnonzero(fits).tolist():
            x = {k: slice(c[i], c[i + 1]) for k, c in cut.items()}
            out[i] = {"n_a": int(cut["a"][i + 1] - cut["a"][i]), "n_b": int(cut["b"][i + 1] - cut["b"][i]),
                      "n_groups": int(group_end[i + 1] - group_end[i]), "n_links": int(cut["link"][i + 1] - cut["link"][i]),
                      "written": written[ends_at[i]:ends_at[i + 1] - 1].tobytes(), "pairs": pair[x["pair"]], "times": times[x["pair"]],
                      "a": a[x["a"]], "a_group": a_group[x["a"]] - group_end[i], "b": b[x["b"]], "b_group": b_group[x["b"]] - group_end[i]}
        return out

    def whole(self, texts: list[str | None]) -> list[list[dict | None]]:
        """The parts' alignments of each text, aligned up to TOGETHER characters at a time; a text that is null or empty has none."""
        cut = [parts(t) if t else [] for t in texts]
        out, some, size = [[] for _ in texts], [], 0

        def flush():
            for (i, _), x in zip(some, self.align([t for _, t in some]), strict=True):
                out[i].append(x)
            some.clear()

        for i, of in enumerate(cut):
            for t in of:
                if some and size + len(t) > TOGETHER:
                    flush()
                    size = 0
                some.append((i, t))
                size += len(t)
        if some:
            flush()
        return out


_aligners: dict[tuple, Aligner] = {}


def paths() -> tuple[str, str, str, str]:
    """The two tokenizers' files, the byte tokenizer's ranks and its splitting pattern."""
    import public_tokenizers as p
    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN, p.path("piece_bpe_32k.model")


def alignments(docs: DataFrame, files: tuple[str, str, str, str] | None = None, text: str = "text", key: str = "doc_id",
               with_tokens: bool = False) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, groups_sha256, pairs (A id x B ids + B id, distinct), times
    (links of each), and if asked for a_ids, a_groups, b_ids, b_groups (a group number for each token).

    A text that is null or empty, or whose tokens joined by either tokenizer are not space + text, has no tokens: zeros, empty
    lists, and '' for groups_sha256. A very long text is encoded in parts, cut where both tokenizers start a token. Null keys
    stay, repeated rows give a row each, an empty table gives an empty result, other columns are not read.
    """
    files = files or paths()
    names = ["_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    more = ["a_ids", "a_groups", "b_ids", "b_groups"] if with_tokens else []
    counts = ("n_a", "n_b", "n_groups", "n_links")

    def row(of: list[dict | None]) -> tuple:
        if not of or None in of:
            return (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32), *[np.zeros(0, np.int32)] * len(more))
        digest = hashlib.sha256(of[0]["written"])
        for x in of[1:]:
            digest.update(b";" + x["written"])
        pairs, times = of[0]["pairs"], of[0]["times"]
        if len(of) > 1:
            pairs, back = np.unique(np.concatenate([x["pairs"] for x in of]), return_inverse=True)
            times = np.bincount(back, np.concatenate([x["times"] for x in of])).astype(np.int64)
        tokens = []
        if more:
            before = np.append(0, np.cumsum([x["n_groups"] for x in of]))
            for side in "ab":
                tokens += [np.concatenate([x[side] for x in of]).astype(np.int32),
                           np.concatenate([x[f"{side}_group"] + n for x, n in zip(of, before, strict=False)]).astype(np.int32)]
        return (*(sum(x[c] for x in of) for c in counts), digest.hexdigest(), pairs, times.astype(np.int32), *tokens)

    def run(batches):
        aligner = _aligners.get(files) or _aligners.setdefault(files, Aligner(ByteTokens(*files[:3]), SentenceTokens(files[3])))
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                rows = list(zip(*map(row, aligner.whole(part.column(1).to_pylist())), strict=True))
                kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64())] + [pa.list_(pa.int32())] * (1 + len(more))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(list(r), k) for r, k in zip(rows, kinds, strict=True))], names=names + more)

    kind = docs.schema[key].dataType.simpleString()
    schema = (f"_key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
              + "".join(f", {m} array<int>" for m in more))
    read = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return read.mapInArrow(run, schema).withColumnRenamed("_key", key)


def corpus_links(docs: DataFrame, files: tuple[str, str, str, str] | None = None, text: str = "text", key: str = "doc_id",
                 broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The alignments with n_best (links whose pair is in as many documents as any pair of its A id) and count_sum (documents
    with the pair, summed over links). Rows as in `alignments`, without pairs and times.

    Counts of at most `broadcast_pairs` pairs are broadcast, more are joined by a shuffle.
    """
    import sentencepiece
    files = files or paths()
    n_b = sentencepiece.SentencePieceProcessor(model_file=files[3]).get_piece_size()
    read = docs.select(F.col(key).alias(key), F.col(text).alias(text))
    marked = stored(alignments(read, files, text, key).withColumn("_row", F.monotonically_increasing_id()), "aligned")
    pairs = marked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    # An A id has at most as many pairs as there are B ids.
    best = F.max("docs").over(Window.partitionBy(F.expr(f"pair div {n_b}")))
    counts = stored(stored(pairs, "pair-counts").withColumn("best", F.col("docs") == best), "pair-best")
    of = counts.withColumnRenamed("pair", "_pair")
    if counts.count() <= broadcast_pairs:
        of = F.broadcast(of)
    sums = (marked.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("_row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
            .join(of, F.col("pair") == F.col("_pair"))
            .groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("docs") * F.col("times")).alias("count_sum")))
    sums = sums.withColumnRenamed("_row", "_of")
    none = F.lit(0).cast("long")
    return (marked.join(sums, F.col("_row") == F.col("_of"), "left")
            .select(key, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256"))


def op11_pointer_alignment(spark, sf_dir):
    return corpus_links(table(spark, sf_dir, "documents"))
