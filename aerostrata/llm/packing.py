"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

Documents become pieces of at most `capacity` tokens. Pieces are dealt into groups of bounded size
by a hash; a group is packed best-fit in decreasing order, then its underfull bins exchange pieces
one for one, two for one, or move one, each step raising the sum of squared fills, until the
emptiest bins have given all of theirs away or the group needs no more bins than its tokens fill.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.common import stored, table

CAPACITY = 4096
END_ID = 1
PER_GROUP = 8192
CACHED_WORDS = 400_000
SLICE = 1 << 17
# Punctuation that ends a word; without the apostrophe, which starts contractions.
FINAL = b".,;:!?#*$%&"
# Stands behind each plain word; no letter.
END = b"\x00"


def taken(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of pool that begin at starts, in a row."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class WordCache:
    """Token ids of texts, encoding a distinct word once while it stays in the cache.

    The tokenizer drops white space and its rules look at nothing beyond it, so a text's ids are its
    words' ids in a row. Inside a word, letters followed by final punctuation are two tokens of its
    splitting pattern. Plain letters unknown so far go to the merging model all at once, each with a
    byte behind it that marks the end of a word; other letters go there in the model's byte alphabet, and
    everything else to the whole tokenizer. A full cache keeps the words asked for since it was last
    full; that bounds its memory and changes no result.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merge, self.normal = self.tokenizer.model.tokenize, self.tokenizer.normalizer.normalize_str
        plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
        rest = iter(range(256, 512))
        self.alphabet = {b: b if b in plain else next(rest) for b in range(256)}
        model = json.loads(self.tokenizer.to_str())["model"]
        back, last = {chr(c): b for b, c in self.alphabet.items()}, model["end_of_word_suffix"]
        raw = lambda t: bytes(back[c] for c in t.removesuffix(last)) + END * t.endswith(last)
        # Single bytes, then single bytes at the end of a word, which form before anything else; then the merges in their order.
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + END: 256 + b for b in range(256)}
        for pair in model["merges"]:
            ranks.setdefault(raw("".join(pair.split(" ") if isinstance(pair, str) else pair)), len(ranks))
        self.plain = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        by_bytes = {raw(t): i for t, i in model["vocab"].items() if all(c in back for c in t.removesuffix(last))}
        self.id_of = np.array([by_bytes.get(t, 0) for t in ranks], np.uint32)
        self.ends = np.array([t.endswith(END) for t in ranks])
        self.clear()

    def clear(self, keep: dict[bytes, int] | None = None):
        """Empty, but for the words of keep."""
        old = (self.starts, self.sizes, self.pool) if keep else None
        self.known: dict[bytes, int] = {}
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.sizes = np.zeros(CACHED_WORDS + 3 * SLICE, np.int64), np.zeros(CACHED_WORDS + 3 * SLICE, np.int64)
        self.asked = np.zeros(CACHED_WORDS + 3 * SLICE, bool)
        if keep:
            at = np.fromiter(keep.values(), np.int64, len(keep))
            self._add(list(keep), taken(old[2], old[0][at], old[1][at]), old[1][at])

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray):
        """New words, with their ids in a row."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        n = len(self.known)
        self.known.update(zip(words, range(n, n + len(words)), strict=True))
        self.starts[n:n + len(words)], self.sizes[n:n + len(words)] = self.used + np.cumsum(sizes) - sizes, sizes
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _ids(self, word: bytes) -> list[int]:
        core = word.rstrip(FINAL)
        if core and (text := self.normal(core.decode("utf-8", "surrogatepass"))).isalpha():
            ids = [t.id for t in self.merge(text.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.alphabet))]
            return ids if len(core) == len(word) else ids + self._ids(word[len(core):])
        return self.tokenizer.encode(word.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids

    def _learn(self, words: set[bytes]):
        """Words of letters, and those with final punctuation, are put together from what is known; the rest is encoded whole."""
        known, cores, odd, split = self.known, {}, set(), []
        for w in words:
            core = w.rstrip(FINAL)
            if core not in known and core not in cores:
                text = core if core.isalpha() else self.normal(core.decode("utf-8", "surrogatepass")).encode("utf-8", "surrogatepass") if core else b""
                if not (core.isalpha() or text.decode("utf-8", "surrogatepass").isalpha()):
                    odd.add(w)
                    continue
                cores[core] = text
            if len(core) < len(w):
                end = w[len(core):]
                split.append((w, core, end))
                if end not in known:
                    odd.add(end)
        ids = [self._ids(w) for w in odd]
        self._add(list(odd), np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64))
        if cores:
            got = np.array(self.plain.encode_ordinary((END.join(cores.values()) + END).decode("utf-8", "surrogatepass")))
            self._add(list(cores), self.id_of[got], np.diff(np.flatnonzero(self.ends[got]), prepend=-1))
        if split:
            at = np.array([(known[c], known[end]) for _, c, end in split])
            self._add([w for w, _, _ in split], taken(self.pool, self.starts[at.ravel()], self.sizes[at.ravel()]), self.sizes[at].sum(1))

    def encode_all(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text."""
        lists = [t.lower().split() if t else [] for t in texts]
        words, out, sizes = lists[0] if len(lists) == 1 else list(chain.from_iterable(lists)), [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), SLICE):
            some = words[at:at + SLICE]
            if len(self.known) > CACHED_WORDS:
                hot = self.asked[:len(self.known)].tolist()
                self.clear({w: n for w, n in self.known.items() if hot[n]} if 2 * sum(hot) <= CACHED_WORDS else None)
            idx = np.fromiter(map(self.known.get, some, repeat(-1)), np.int64, len(some))
            new = np.flatnonzero(idx < 0).tolist()
            if new:
                unknown = [some[i] for i in new]
                self._learn(set(unknown))
                idx[new] = [self.known[w] for w in unknown]
            self.asked[idx] = True
            out.append(taken(self.pool, self.starts[idx], self.sizes[idx]))
            sizes.append(self.sizes[idx])
        ids, ends = np.concatenate(out), np.append(0, np.cumsum(np.concatenate(sizes)))
        cuts = ends[np.cumsum([len(x) for x in lists])].tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]  # noqa: B905

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([(text or "").encode("utf-8", "surrogatepass")])[0]


_caches: dict[str, WordCache] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id",
           with_ids: bool = False) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32[, ids]): each document's ids and the end id, cut
    into pieces of `capacity`; only the last may be shorter.

    A null or blank text is the end id alone. ids_crc32 is over little-endian 32-bit ids.
    """

    def run(batches):
        cache = _caches.get(tokenizer) or _caches.setdefault(tokenizer, WordCache(tokenizer))
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                rows, no, start, size, crc, ids_of = [], [], [], [], [], []
                for i, ids in enumerate(cache.encode_all(part.column(1).cast(pa.binary()).to_pylist())):
                    ids = np.append(ids, END_ID).astype("<u4")
                    for n, s in enumerate(range(0, len(ids), capacity)):
                        x = ids[s:s + capacity]
                        rows.append(i), no.append(n), start.append(s), size.append(len(x)), crc.append(zlib.crc32(x.tobytes()))
                        if with_ids:
                            ids_of.append(x.astype(np.int32))
                cols = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(no, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids_of, pa.list_(pa.int32()))] if with_ids else []), names=names)

    kind = docs.schema[key].dataType.simpleString()
    names = ["_key", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    schema = f"_key {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    read = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return read.mapInArrow(run, schema).withColumnRenamed("_key", key)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices: largest first, each into the fullest bin that has room."""
    bins, room = [], []
    for i in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[i])
        at = bisect_left(room, (n, -1))
        free, b = room.pop(at) if at < len(room) else (capacity, len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
        if free > n:
            insort(room, (free - n, b))
    return bins


def local_search(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins that raise the sum of squared fills, emptiest bin first.

    From bin a, one piece moves to bin b, or one or two pieces of a go for one smaller piece of b;
    with d tokens more in b the sum of squares grows by 2d(fill_b - fill_a + d), which is positive
    whenever b is at least as full as a, so the search ends. It stops early at the lower bound.
    """
    fill = np.array([int(sizes[b].sum()) for b in bins], np.int64)
    least, live = -(-int(sizes.sum()) // capacity), len(bins)
    home = np.empty(len(sizes), np.int64)
    for b, items in enumerate(bins):
        home[items] = b
    changed = True
    while changed and live > least:
        changed = False
        for a in sorted(np.flatnonzero((fill > 0) & (fill < capacity)).tolist(), key=lambda b: fill[b]):
            if live <= least:
                break
            while bins[a]:
                others = np.flatnonzero((fill < capacity) & (fill >= fill[a]))
                others = others[others != a]
                if not len(others):
                    break
                room = capacity - fill[others]
                items = np.flatnonzero(np.isin(home, others))
                item_size, item_room = sizes[items], capacity - fill[home[items]]
                best = (0, None)
                mine = sorted(bins[a], key=lambda i: -sizes[i])
                for give in [(i,) for i in mine] + list(combinations(mine, 2)):
                    n = int(sizes[list(give)].sum())
                    if len(give) == 1 and (fits := room >= n).any():
                        b = others[fits][np.argmin(room[fits])]
                        best = max(best, (n, (give, int(b), None)), key=lambda x: x[0])
                    gain = n - item_size
                    gain = np.where((gain > 0) & (gain <= item_room), gain, 0)
                    if len(gain) and gain.max() > best[0]:
                        j = int(items[gain.argmax()])
                        best = (int(gain.max()), (give, int(home[j]), j))
                if best[1] is None:
                    break
                give, b, back = best[1]
                for i in give:
                    bins[a].remove(i)
                    bins[b].append(i)
                    home[i] = b
                if back is not None:
                    bins[b].remove(back)
                    bins[a].append(back)
                    home[back] = a
                fill[a] -= best[0]
                fill[b] += best[0]
                changed = True
            live -= not bins[a]
    return [b for b in bins if b]


def place(cut: DataFrame, capacity: int = CAPACITY, per_group: int = PER_GROUP) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` of 1 to `capacity`.

    Groups hold about `per_group` rows each, dealt by a hash of the row's place in the stored table,
    so equal rows don't meet; every group wastes less than one sequence beyond its own best packing.
    """
    cut = stored(cut, "pieces")
    groups = max(1, -(-cut.count() // per_group))
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(t: pa.Table) -> pa.Table:
        sizes = t.column("length").to_numpy()
        first = t.column("_group")[0].as_py() << 32
        bins = local_search(best_fit(sizes, capacity), sizes, capacity)
        at, seq = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for b, items in enumerate(bins):
            seq[items] = first + b
            at[items] = np.cumsum(sizes[items]) - sizes[items]
        return t.drop_columns(["_group"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(at))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("_group").applyInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id",
         with_ids: bool = False, per_group: int = PER_GROUP) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    Null keys stay null, repeated rows are packed each, an empty table gives an empty result;
    further columns are not read.
    """
    return place(pieces(docs, tokenizer, capacity, text, key, with_ids), capacity, per_group)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op6_swap_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
