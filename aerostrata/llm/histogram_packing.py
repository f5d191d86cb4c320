"""Shortest-pack-first packing over the histogram of lengths.

A document of n tokens gives n // capacity whole sequences; what remains of it is one of capacity - 1
lengths. The histogram of these lengths is all that is packed: longest first, each length goes to the
packs with the most room, many equal packs (a pattern and its count) at a time. Patterns left with
room are then filled up by cutting pieces off the emptiest ones, again a whole count at a time, until
one pack is left, which is cut at powers of two. So nothing is padded.

A pattern says of each of its places which ranks of a length lie there. Documents are ranked within
their length, and a join of length and rank brings each its pieces.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm import packing
from aerostrata.llm.common import stored, table

CAPACITY, END_ID = 4096, 2
# A plan of more rows than this is joined by a shuffle. On the given tables it has a few thousand.
BROADCAST_ROWS = 100_000


@dataclass(order=True)
class Pattern:
    """`count` packs that are alike. Place i holds piece [start, start + length) of the documents with
    remaining length `rest`, of ranks first to first + count - 1 in pack order."""

    fill: int
    count: int = field(compare=False)
    places: list[tuple[int, int, int, int]] = field(compare=False)  # rest, first, start, length

    def split(self, count: int) -> Pattern | None:
        """Keeps `count` packs; the others are returned."""
        if count == self.count:
            return None
        other = Pattern(self.fill, self.count - count, [(r, f + count, s, n) for r, f, s, n in self.places])
        self.count = count
        return other


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Packs of whole remainders; histogram holds the number of documents by length below capacity."""
    open_: dict[int, list[Pattern]] = defaultdict(list)
    done, most = [], 0

    def put(p: Pattern):
        nonlocal most
        room = capacity - p.fill
        (open_[room] if room else done).append(p)
        most = max(most, room)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            while most and not open_[most]:
                most -= 1
            if most >= length:
                p = open_[most].pop()
                other = p.split(min(p.count, left))
                if other:
                    open_[most].append(other)
                p.places.append((length, rank, 0, length))
                p.fill += length
                rank, left = rank + p.count, left - p.count
                put(p)
            else:
                # One after the other these lengths would fill one new pack and then the next.
                each = min(capacity // length, left)
                count = left // each
                put(Pattern(each * length, count, [(length, rank + i * count, 0, length) for i in range(each)]))
                rank, left = rank + each * count, left - each * count
    return done + [p for ps in open_.values() for p in ps]


def fill_up(patterns: list[Pattern], capacity: int) -> list[Pattern]:
    """Fills the fullest packs with pieces cut off the emptiest, until at most one pack has room."""
    done = [p for p in patterns if p.fill == capacity]
    rest = sorted(p for p in patterns if p.fill < capacity)
    while rest and (len(rest) > 1 or rest[0].count > 1):
        to = rest.pop()
        if not rest:
            other = to.split(max(1, min(to.count - 1, to.count * to.fill // capacity)))
            insort(rest, other)
        giver = rest.pop(0)
        count = min(to.count, giver.count)
        for p in (to, giver):
            if other := p.split(count):
                insort(rest, other)
        while giver.places and to.fill < capacity:
            r, first, start, length = giver.places.pop()
            take = min(length, capacity - to.fill)
            if take < length:
                giver.places.append((r, first, start + take, length - take))
            to.places.append((r, first, start, take))
            to.fill += take
            giver.fill -= take
        if to.fill < capacity:
            insort(rest, to)
        else:
            done.append(to)
        if giver.places:
            insort(rest, giver)
    for last in rest:
        done.extend(_powers(last))
    return done


def _powers(pack: Pattern) -> list[Pattern]:
    """One pack as several whose fills are powers of two."""
    out, places = [], list(pack.places)
    for bit in range(pack.fill.bit_length() - 1, -1, -1):
        if not pack.fill >> bit & 1:
            continue
        part = Pattern(0, 1, [])
        while part.fill < 1 << bit:
            r, first, start, length = places.pop(0)
            take = min(length, (1 << bit) - part.fill)
            part.places.append((r, first, start, take))
            part.fill += take
            if take < length:
                places.insert(0, (r, first, start + take, length - take))
        out.append(part)
    return out


def plan_rows(patterns: list[Pattern]) -> list[tuple]:
    """Rows (rest, low, high, parts): documents of that remaining length with a rank from low to below
    high are laid out as parts (start, length, shift, offset), sequence rank + shift."""
    spans, sequence = defaultdict(list), 0
    for p in patterns:
        offset = 0
        for r, first, start, length in p.places:
            spans[r].append((first, first + p.count, (start, length, sequence - first, offset)))
            offset += length
        sequence += p.count
    rows = []
    for r, of in spans.items():
        of.sort()
        cuts, live, at = sorted({x for a, b, _ in of for x in (a, b)}), [], 0
        for low, high in zip(cuts, cuts[1:]):  # noqa: B905
            live = [s for s in live if s[1] > low]
            while at < len(of) and of[at][0] == low:
                live.append(of[at])
                at += 1
            rows.append((r, low, high, sorted(s[2] for s in live)))
    return rows


def _encoded(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, text: str, key: str) -> DataFrame:
    """Rows (_key, _ids, _n, _rest, _task, _at, _whole): the ids as 16-bit or 32-bit numbers, how many documents of
    this remaining length, and how many whole sequences, the same task has before."""
    from tokenizers import Tokenizer
    kind = "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"
    type_of = docs.schema[key].dataType.simpleString()
    names = ["_key", "_ids", "_n", "_rest", "_task", "_at", "_whole"]

    def run(batches):
        cache = packing._caches.get(tokenizer) or packing._caches.setdefault(tokenizer, packing.WordCache(tokenizer))
        task, seen, whole = TaskContext.get().partitionId(), np.zeros(capacity, np.int64), 0
        for b in batches:
            for start in range(0, b.num_rows, 64):
                part = b.slice(start, 64)
                blobs, size, at, before = [], [], [], []
                for ids in cache.encode_all(part.column(1).cast(pa.binary()).to_pylist()):
                    blobs.append(np.append(ids, end_id).astype(kind).tobytes())
                    n = len(ids) + 1
                    size.append(n), at.append(int(seen[n % capacity])), before.append(whole)
                    seen[n % capacity] += 1
                    whole += n // capacity
                size = np.array(size, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(blobs, pa.binary()), pa.array(size), pa.array((size % capacity).astype(np.int32)),
                     pa.array(np.full(len(size), task, np.int32)), pa.array(at, pa.int64()), pa.array(before, pa.int64())], names=names)

    read = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return read.mapInArrow(run, f"_key {type_of}, _ids binary, _n long, _rest int, _task int, _at long, _whole long"), kind


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", key: str = "doc_id",
         with_ids: bool = False, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    Every sequence has capacity tokens, but for at most one for each power of two below it. A null or
    blank text is the end id alone. Null keys stay null, repeated rows are packed each, an empty table
    gives an empty result, a very long text is many whole sequences; further columns are not read.
    Whole sequences have negative numbers.

    The driver holds the number of documents of each length below capacity and the plan made of it.
    """
    if capacity < 2 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    spark = docs.sparkSession
    encoded, kind = _encoded(docs, tokenizer, capacity, end_id, text, key)
    encoded = stored(encoded, "packed-ids")
    cells = stored(encoded.filter("_rest > 0").groupBy("_rest", "_task").agg(F.count("*").alias("_in")), "packed-cells")
    histogram = {r._rest: r.n for r in cells.groupBy("_rest").agg(F.sum("_in").alias("n")).collect()}
    rows = plan_rows(fill_up(shortest_pack_first(histogram, capacity), capacity))
    plan = spark.createDataFrame(rows, "_rest int, _low long, _high long, _parts array<struct<start: long, length: long, shift: long, offset: long>>")
    if len(rows) <= broadcast_rows:
        plan = F.broadcast(plan)
    earlier = Window.partitionBy("_rest").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("_rest", "_task", F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_before"))
    ranked = (encoded.join(offsets, ["_rest", "_task"], "left").withColumn("_rank", F.col("_before") + F.col("_at"))
              .join(plan.withColumnRenamed("_rest", "_of"), (F.col("_rest") == F.col("_of")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")), "left"))
    names = ["_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + (["ids"] if with_ids else [])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                took, out, ids_of = [], [], []
                for i, (blob, n, task, whole, rank, parts) in enumerate(zip(*(c.to_pylist() for c in part.columns[1:]), strict=True)):
                    ids = np.frombuffer(blob, kind).astype("<u4")
                    full = n // capacity
                    of = [(p * capacity, capacity, -1 - ((task << 33) + whole + p), 0) for p in range(full)]
                    of += [(full * capacity + x["start"], x["length"], rank + x["shift"], x["offset"]) for x in parts or ()]
                    for start, length, sequence, offset in of:
                        x = ids[start:start + length]
                        took.append(i), out.append((start, length, zlib.crc32(x.tobytes()), n, sequence, offset))
                        if with_ids:
                            ids_of.append(x.astype(np.int32))
                cols = [part.column(0).take(pa.array(took, pa.int64()))] + [pa.array(c) for c in np.array(out, np.int64).reshape(-1, 6).T]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids_of, pa.list_(pa.int32()))] if with_ids else []), names=names)

    type_of = docs.schema[key].dataType.simpleString()
    schema = ", ".join([f"_key {type_of}", *(f"{n} long" for n in names[1:7])]) + (", ids array<int>" if with_ids else "")
    return ranked.select("_key", "_ids", "_n", "_task", "_whole", "_rank", "_parts").mapInArrow(run, schema).withColumnRenamed("_key", key)


def op13_shortest_pack_first(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), packing.tokenizer_path())
