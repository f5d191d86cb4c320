"""SentencePiece BPE with seeded merge-dropout, and exact decoding.

The agenda of a word holds its adjacent pairs that form a piece; the best score comes first, then the
leftmost. A candidate is skipped for good when its keyed hash says so. The key is (seed, document,
position of the word, place, piece), so a run repeats exactly while every occurrence of a word is
segmented by draws of its own. Pieces never reach over the start of a word, hence words are segmented
on their own.

A word's agenda depends on nothing but which of its steps were skipped. So the agenda after each set of
skips is worked out once per worker while the cache lasts, and an occurrence walks along it, drawing at
every step; a skip that is new for the word adds the agenda that follows it.
"""

from __future__ import annotations

import re
import sys
import zlib
from heapq import heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.common import table

MARK = "▁"
UNIT = re.compile(" +[^ ]*|[^ ]+")
DROPOUT, SEED = 0.1, 5
CACHED_UNITS = 1_200_000
# Words up to LONG characters are segmented AT_ONCE side by side; texts are taken together up to so many characters.
LONG, AT_ONCE, TOGETHER = 32, 1 << 13, 1 << 20
WORD, STEP = (1 << 64) - 1, 0x9E3779B97F4A7C15
NEVER, SLOT_BITS = np.iinfo(np.int32).max, 20


def mix(x):
    """A 64-bit finaliser, for a Python integer or an array of unsigned 64-bit ones."""
    m = WORD if isinstance(x, int) else np.uint64(WORD)
    k = int if isinstance(x, int) else np.uint64
    x = (x ^ (x >> k(30))) * k(0xBF58476D1CE4E5B9) & m
    x = (x ^ (x >> k(27))) * k(0x94D049BB133111EB) & m
    return x ^ (x >> k(31))


class Dropout:
    """Encoder and decoder over the vocabulary of one model file."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED, variants: int | None = None):
        """variants: only so many different draws for a word, as a test or an experiment may want; None for no limit."""
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        kept = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.ids = {m.id_to_piece(i): i for i in kept}
        self.rank = {m.id_to_piece(i): -m.get_score(i) for i in kept}
        self.byte = {int(m.id_to_piece(i)[3:5], 16): i for i in range(n) if m.is_byte(i)}
        self.unknown = m.unk_id()
        back = {i: b for b, i in self.byte.items()}
        raw = [bytes([back[i]]) if i in back else m.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        self.raw, self.raw_size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.limit, self.seed, self.variants = int(dropout * 2**64), mix(seed * STEP & WORD), variants
        # Every way to split a piece into two, as sorted keys, for looking up many pairs at once.
        self.n = n
        joins = sorted((self.ids[p[:i]] * n + self.ids[p[i:]], self.ids[p]) for p in self.ids for i in range(1, len(p))
                       if p[:i] in self.ids and p[i:] in self.ids)
        self.join_keys, self.join_ids = (np.array(x, np.int64) for x in zip(*joins, strict=True))
        # Most are found in one look at a table by hash; whose place another has are searched for.
        self.slots = np.full(1 << SLOT_BITS, -1, np.int64)
        self.slots[self._slot(self.join_keys)] = np.arange(len(self.join_keys))
        # Ranks as whole numbers in the same order, NEVER for what is no piece.
        self.order = np.full(n, NEVER, np.int32)
        pieces = np.fromiter(self.ids.values(), np.int64, len(self.ids))
        self.order[pieces] = np.unique([self.rank[p] for p in self.ids], return_inverse=True)[1]
        self.symbol = -1 - np.arange(sys.maxunicode + 1)
        for p, i in self.ids.items():
            if len(p) == 1 and p != MARK:
                self.symbol[ord(p)] = i
        self.symbol[ord(" ")] = self.ids.get(MARK, -33)
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}  # the first node of each word
        self.count = 0
        self.pool, self.used = np.zeros(1 << 20, np.int32), 0
        self.starts, self.sizes = np.zeros(CACHED_UNITS, np.int64), np.zeros(CACHED_UNITS, np.int64)
        # A node is a step of an agenda. The next node follows if it is taken, `skipped` if not (-1: not
        # worked out yet). An agenda ends with a node of code -1 - number of the result.
        self.nodes = 0
        self.code, self.skipped, self.agenda = (np.zeros(1 << 20, np.int32) for _ in range(3))
        self.depth = np.zeros(1 << 20, np.uint8)
        # Of each agenda its word and the steps skipped, a bit each; a word of LONG characters has fewer than 3 * LONG steps.
        self.agendas, self.agenda_word, self.agenda_skips = 0, np.zeros(1 << 16, np.int32), np.zeros((1 << 16, 2), np.uint64)
        # The symbols of the words known.
        self.word_start, self.word_size, self.symbols = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _key(self, occurrence: int) -> int:
        return mix(self.seed ^ occurrence & WORD)

    def _symbols(self, unit: str) -> list[int]:
        """Ids of the word's characters; for one outside the vocabulary, or a literal mark, minus its code point, less one."""
        return [self.ids.get(MARK, -33) if c == " " else -1 - ord(c) if c == MARK else self.ids.get(c, -1 - ord(c)) for c in unit]

    def _spelled(self, pieces: list[int]) -> list[int]:
        out = []
        for i in pieces:
            if i >= 0:
                out.append(i)
            elif self.byte:
                out += [self.byte[x] for x in chr(-1 - i).encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return out

    def segment(self, unit: str, occurrence: int) -> list[int]:
        """Ids of one occurrence of a word with its leading spaces, by the agenda as a heap of candidates."""
        symbols = self._symbols(unit)
        key, after, before = self._key(occurrence), list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        names = [MARK if c == " " else c for c in unit]
        agenda = []

        def offer(i):
            j = after[i]
            if i >= 0 and j < len(symbols) and symbols[i] >= 0 and symbols[j] >= 0:
                if (merged := names[i] + names[j]) in self.ids:
                    heappush(agenda, (self.rank[merged], i, merged, names[i]))

        for i in range(len(symbols) - 1):
            offer(i)
        while agenda:
            _, i, merged, left = heappop(agenda)
            j = after[i]
            if names[i] != left or j >= len(symbols) or left + names[j] != merged:
                continue
            if self.limit and mix(key ^ (i * self.n + self.ids[merged])) < self.limit:
                continue
            names[i], names[j], symbols[i] = merged, "", self.ids[merged]
            after[i] = after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return self._spelled([x for x, name in zip(symbols, names, strict=True) if name])

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the piece that two pieces form, or -1."""
        keys = np.where((left >= 0) & (right >= 0), left * self.n + right, -1)
        at = self.slots[self._slot(keys)]
        out = np.where((at >= 0) & (self.join_keys[at] == keys), self.join_ids[at], -1)
        other = (at >= 0) & (out < 0) & (keys >= 0)
        keys = keys[other]
        at = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
        out[other] = np.where(self.join_keys[at] == keys, self.join_ids[at], -1)
        return out

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(STEP) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def segment_many(self, units: list[str], occurrence: int) -> list[list[int]]:
        """Like `segment`, for many short words side by side."""
        key = np.uint64(self._key(occurrence))
        flat, size, *_ = self._run(*self._spell(units), lambda r, step, code: mix(key ^ code) < np.uint64(self.limit))
        return [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])]

    def _spell(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in a row, and how many each has."""
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4")
        return self.symbol[codes], np.fromiter(map(len, units), np.int64, len(units))

    def _run(self, symbols: np.ndarray, lengths: np.ndarray, skips) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, given as `_spell` does, in a row, and how many each has, one agenda step of all words a round; skips(rows, step, codes)
        tells which to skip. Also the codes of all steps by word, and how many each word has."""
        rows, width = len(lengths), int(lengths.max()) + 1
        inside = np.arange(width) < lengths[:, None]
        sym = np.full((rows, width), -1, np.int64)
        sym[inside] = symbols
        after = np.tile(np.arange(1, width + 1), (rows, 1))
        before = np.tile(np.arange(-1, width - 1), (rows, 1))
        alive = inside.copy()
        made = np.full((rows, width), -1, np.int64)
        made[:, :-1] = np.where(inside[:, 1:], self._pairs(sym[:, :-1], sym[:, 1:]), -1)
        cost = np.where(made >= 0, self.order[made], NEVER)
        r, seen, codes = np.arange(rows), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while True:
            at = cost[r].argmin(1)
            going = cost[r, at] != NEVER
            r, at = r[going], at[going]
            if not len(r):
                break
            m = made[r, at]
            seen.append(r), codes.append(at * self.n + m)
            skip = skips(r, len(seen) - 2, codes[-1].astype(np.uint64))
            cost[r[skip], at[skip]] = NEVER
            q, at, m = r[~skip], at[~skip], m[~skip]
            gone = after[q, at]
            sym[q, at], alive[q, gone], cost[q, gone] = m, False, NEVER
            nxt = after[q, gone]
            after[q, at] = nxt
            before[q, np.minimum(nxt, width - 1)] = at
            self._offer(q, at, sym, after, alive, made, cost)
            prev = before[q, at]
            self._offer(q[prev >= 0], prev[prev >= 0], sym, after, alive, made, cost)
        flat, size = sym[alive], alive.sum(1)
        if len(odd := np.flatnonzero(flat < 0)):
            values, which = np.unique(flat[odd], return_inverse=True)
            spelled = [self._spelled([v]) for v in values.tolist()]
            times = np.ones(len(flat), np.int64)
            times[odd] = np.array([len(x) for x in spelled])[which]
            row = np.repeat(np.arange(rows), size)
            flat, size = np.repeat(flat, times), np.bincount(row, times, rows).astype(np.int64)
            flat[flat < 0] = np.fromiter(chain.from_iterable(spelled[i] for i in which.tolist()), np.int64)
        by = np.concatenate(seen)
        steps = np.concatenate(codes)[by.argsort(kind="stable")]
        return flat, size, steps, np.bincount(by, minlength=rows)

    def _offer(self, r, at, sym, after, alive, made, cost):
        j = np.minimum(after[r, at], sym.shape[1] - 1)
        m = np.where(alive[r, j], self._pairs(sym[r, at], sym[r, j]), -1)
        made[r, at] = m
        cost[r, at] = np.where(m >= 0, self.order[m], NEVER)

    def encode(self, text: str | None, key: int = 0) -> np.ndarray:
        """Ids of the whole text, which is taken with one space put before it; none for an empty one."""
        return self.encode_many([text], [key])[0]

    def encode_many(self, texts: list[str | None], keys: list[int]) -> list[np.ndarray]:
        if self.count > CACHED_UNITS:
            self.clear()
        split = [UNIT.findall(" " + t) if t else [] for t in texts]
        units = [u for own in split for u in own]
        sizes = [len(own) for own in split]
        place = [np.arange(n, dtype=np.uint64) * np.uint64(STEP) + np.uint64(mix(k & WORD)) for n, k in zip(sizes, keys, strict=True)]
        place = np.concatenate([np.zeros(0, np.uint64), *place])
        if self.variants:
            place %= np.uint64(self.variants)
        node = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        unknown = np.flatnonzero(node < 0).tolist()
        self._meet([u for u in dict.fromkeys(units[i] for i in unknown) if len(u) <= LONG])
        node[unknown] = [self.known.get(units[i], -1) for i in unknown]
        idx = np.empty(len(units), np.int64)
        long = np.flatnonzero(node < 0)
        found = [self.segment(units[i], int(place[i])) for i in long.tolist()]
        idx[long] = self._keep(np.fromiter(chain.from_iterable(found), np.int32), np.fromiter(map(len, found), np.int64, len(found)))
        at = np.flatnonzero(node >= 0)
        node, key = node[at], mix(np.uint64(self.seed) ^ place[at])
        while len(at):
            # All walk on until they end or a skip is new; then the agendas that are missing are worked out together.
            waiting = []
            while len(at):
                code = self.code[node]
                done = code < 0
                idx[at[done]] = -1 - code[done]
                at, node, key, code = at[~done], node[~done], key[~done], code[~done]
                skip = mix(key ^ code.astype(np.uint64)) < np.uint64(self.limit)
                after = node + 1
                after[skip] = self.skipped[node[skip]]
                new = after < 0
                waiting.append((at[new], node[new], key[new]))
                at, node, key = at[~new], after[~new], key[~new]
            at, node, key = (np.concatenate(x) for x in zip(*waiting, strict=True))
            self._follow(np.unique(node))
            node = self.skipped[node].astype(np.int64)
        return [self._gather(x) for x in np.split(idx, np.cumsum(sizes)[:-1])] if sizes else []

    def _meet(self, units: list[str]):
        """Work out the agendas of new words."""
        symbols, sizes = self._spell(units)
        word = len(self.word_size) + np.arange(len(units))
        self.word_start = np.append(self.word_start, len(self.symbols) + np.cumsum(sizes) - sizes)
        self.word_size, self.symbols = np.append(self.word_size, sizes), np.append(self.symbols, symbols.astype(np.int32))
        starts = self._learn(word, np.zeros((len(units), 2), np.uint64), np.zeros(len(units), np.int64))
        self.known.update(zip(units, starts.tolist(), strict=True))

    def _follow(self, nodes: np.ndarray):
        """Work out the agendas that follow when these steps are skipped too."""
        a, depth = self.agenda[nodes], self.depth[nodes].astype(np.int64)
        skips = self.agenda_skips[a]
        skips[np.arange(len(nodes)), depth >> 6] |= np.uint64(1) << (depth & 63).astype(np.uint64)
        starts = self._learn(self.agenda_word[a], skips, depth + 1)
        self.skipped[nodes] = starts

    def _gather(self, idx: np.ndarray) -> np.ndarray:
        n = self.sizes[idx]
        ends = np.cumsum(n)
        return self.pool[np.repeat(self.starts[idx] - ends + n, n) + np.arange(ends[-1])] if len(idx) else np.zeros(0, np.int32)

    def _learn(self, words: np.ndarray, skips: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Add the agendas of these words with these skips, from the step `base` on; their first nodes."""
        starts = np.zeros(len(words), np.int64)
        order = np.argsort(self.word_size[words], kind="stable")
        for low in range(0, len(order), AT_ONCE):
            part = order[low:low + AT_ONCE]
            own, forced, first = words[part], skips[part], base[part]
            lengths = self.word_size[own]
            ends = np.cumsum(lengths)
            symbols = self.symbols[np.repeat(self.word_start[own] - ends + lengths, lengths) + np.arange(ends[-1])]
            flat, sizes, steps, n = self._run(symbols, lengths, lambda r, step, code, f=forced: (f[r, step >> 6] >> np.uint64(step & 63) & np.uint64(1)) > 0)
            size = n - first + 1  # with the node of the result
            ends = np.cumsum(size)
            row = np.repeat(np.arange(len(own)), size)
            depth = np.arange(int(ends[-1])) - np.repeat(ends - size, size) + first[row]
            last = depth == n[row]
            code = np.empty(len(row), np.int64)
            code[last] = -1 - self._keep(flat, sizes)
            code[~last] = steps[((np.cumsum(n) - n)[row] + depth)[~last]]
            while self.nodes + len(row) > len(self.code):
                for name in ("code", "skipped", "agenda", "depth"):
                    setattr(self, name, np.concatenate([x := getattr(self, name), np.zeros_like(x)]))
            while self.agendas + len(own) > len(self.agenda_word):
                for name in ("agenda_word", "agenda_skips"):
                    setattr(self, name, np.concatenate([x := getattr(self, name), np.zeros_like(x)]))
            at = slice(self.nodes, self.nodes + len(row))
            self.code[at], self.skipped[at], self.agenda[at], self.depth[at] = code, -1, self.agendas + row, depth
            starts[part] = self.nodes + ends - size
            at = slice(self.agendas, self.agendas + len(own))
            self.agenda_word[at], self.agenda_skips[at] = own, forced
            self.agendas += len(own)
            self.nodes += len(row)
        return starts

    def _keep(self, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Put results into the pool, their ids in a row and how many each has; their numbers."""
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.count + len(size) > len(self.sizes):
            self.sizes, self.starts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sizes, self.starts))
        at = slice(self.count, self.count + len(size))
        self.pool[self.used:self.used + len(flat)], self.sizes[at], self.starts[at] = flat, size, self.used + np.cumsum(size) - size
        self.used += len(flat)
        self.count += len(size)
        return np.arange(at.start, at.stop)

    def decode(self, ids: np.ndarray) -> str:
        """The text that was encoded: pieces as bytes, without the space put before it."""
        n = self.raw_size[ids]
        ends = np.cumsum(n)
        raw = self.raw[np.repeat(self.raw_start[ids] - ends + n, n) + np.arange(ends[-1])] if len(ids) else np.zeros(0, np.uint8)
        text = raw.tobytes().decode("utf-8", "surrogatepass")
        return text[1:] if text.startswith(" ") else text


_coders: dict[tuple, Dropout] = {}


def _coder(*how) -> Dropout:
    return _coders.get(how) or _coders.setdefault(how, Dropout(*how))


def encode(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED, variants: int | None = None,
           text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, ids array<int>, n_ids, ids_crc32, lossless (decoding gives the text).

    Null and empty texts have no ids. A null key counts as 0 for the draws. Repeated rows get equal
    results; an empty table gives an empty result; further columns are not read.
    """

    def run(batches):
        coder = _coder(model, dropout, seed, variants)
        for b in batches:
            size = np.cumsum([len(t or "") for t in b.column(2).to_pylist()]) // TOGETHER
            cuts = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), b.num_rows] if b.num_rows else []
            for at, end in zip(cuts[:-1], cuts[1:], strict=True):
                part = b.slice(at, end - at)
                texts = part.column(2).to_pylist()
                rows = [(ids, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), coder.decode(ids) == (t or ""))
                        for t, ids in zip(texts, coder.encode_many(texts, part.column(1).to_pylist()), strict=True)]
                cols = list(zip(*rows, strict=True))
                kinds = [pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=names)

    names = [key, "ids", "n_ids", "ids_crc32", "lossless"]
    kind = docs.schema[key].dataType.simpleString()
    salt = F.coalesce(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 31)), F.lit(0)) if kind == "string" else F.coalesce(F.col(key).cast("long"), F.lit(0))
    return docs.select(F.col(key), salt.alias("_salt"), F.col(text).cast("string").alias("_text")).mapInArrow(
        run, f"`{key}` {kind}, ids array<int>, n_ids long, ids_crc32 long, lossless boolean")


def decode(encoded: DataFrame, model: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """The rows with `ids` decoded into a column `out`; null ids give a null text."""
    rest = [c for c in encoded.columns if c not in (ids, out)]

    def run(batches):
        coder = _coder(model)
        for b in batches:
            texts = [None if x is None else coder.decode(np.array(x, np.int64)) for x in b.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], names=[*rest, out])

    schema = "".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}, " for c in rest) + f"`{out}` string"
    return encoded.select(*rest, ids).mapInArrow(run, schema)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_merge_dropout(spark, sf_dir):
    return encode(table(spark, sf_dir, "documents"), model_path())
