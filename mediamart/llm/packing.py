"""Operator 6, best-fit packing after Martello-Toth dominance reduction.

Documents become pieces of at most CAPACITY tokens. How pieces are packed
depends on their lengths only, so the plan is made from the histogram of
lengths (at most CAPACITY numbers, whatever the data): the reduction fixes
small sets that dominate every other way to fill a bin with their largest
item, many equal bins at once; what is left is packed best-fit, longest first,
bins of equal residual together. The plan, a list of (pattern, multiplicity),
goes back to the executors as intervals of ranks per length. Ranks are counted
in salted parts of each length, so that one frequent length is no single task.

Defined cases: a null text counts as empty and is one piece with the end id
alone; a document longer than CAPACITY is cut, its last piece may be shorter;
repeated rows are packed as often as they come; rows that agree in every key
are interchangeable; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediamart.llm.bpe import tokenizer
from mediamart.llm.common import ship, slices, texts, written

CAPACITY, END_ID = 2048, 0
RANK_ROWS = 50_000
Pattern = tuple  # ((length, how many), ...)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of
    every piece; ``path`` is the vocabulary file."""
    ship(docs.sparkSession)
    with open(path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        bpe = tokenizer(source)
        for batch in batches:
            for part in slices(batch, 1):
                ids, size = bpe.encode(texts(part.column(1)))
                # the end id after each document
                ids = np.insert(ids, np.cumsum(size), END_ID).astype("<u4")
                size = size + 1
                first = np.cumsum(size) - size
                count = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                # pieces lie one after another, so their bytes need no copying
                edges = np.concatenate([[0], np.cumsum(length)]) * 4
                raw = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])
                assert int(first[-1] + size[-1]) * 4 == int(edges[-1])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)),
                     pa.array(length.astype(np.int64)), raw.cast(pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])
        bpe.reset()                     # the worker process stays, its memory should not

    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


# -- the plan, from the histogram ------------------------------------------
def reduce_dominated(count: list[int], capacity: int) -> list[tuple[Pattern, int]]:
    """Fix dominating sets. ``count[s]``: items of size s left; is lowered.

    For an item w with room r = capacity - w, a set F that holds w dominates
    if whatever else could share w's bin can change places with F's items:
      nothing fits                             -> {w}
      an item of exactly r                     -> {w, r}
      no two items fit                         -> {w, largest that fits}
      at most two fit, the largest single one
        is no smaller than any pair            -> {w, largest that fits}
      at most two fit, and a pair (a, b) is at
        least as large as every other, item by
        item or both within a, and a is the
        largest single item                    -> {w, a, b}
    """
    fixed: list[tuple[Pattern, int]] = []
    w = capacity
    while w > 0:
        if not count[w]:
            w -= 1
            continue
        room = capacity - w
        count[w] -= 1                     # the item itself is not its own partner
        sizes = [s for s in range(1, room + 1) if count[s]]
        found = _dominating(sizes, count, room)
        count[w] += 1
        if found is None:
            w -= 1
            continue
        need: dict[int, int] = {w: 1}
        for s in found:
            need[s] = need.get(s, 0) + 1
        times = min(count[s] // n for s, n in need.items())
        for s, n in need.items():
            count[s] -= n * times
        fixed.append((tuple(sorted(need.items(), reverse=True)), times))
    return fixed


def _dominating(sizes: list[int], count: list[int], room: int) -> tuple[int, ...] | None:
    if not sizes:
        return ()
    single = sizes[-1]
    if single == room:
        return (single,)
    smallest: list[int] = []
    for s in sizes:
        smallest += [s] * min(count[s], 3 - len(smallest))
        if len(smallest) == 3:
            break
    if len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return (single,)
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    pairs = []
    for a in sizes:
        at = bisect_left(sizes, min(a, room - a) + 1) - 1
        if at >= 0 and sizes[at] == a and count[a] < 2:
            at -= 1
        if at >= 0:
            pairs.append((a, sizes[at]))
    if single >= max(a + b for a, b in pairs):
        return (single,)
    for a, b in reversed(pairs):
        if a >= single and all((c <= a and d <= b) or c + d <= a for c, d in pairs):
            return (a, b)
    return None


def best_fit(count: list[int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, of all items left in ``count``."""
    bins: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []                 # residuals that have bins, ascending
    done: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, times: int, room: int) -> None:
        if not times:
            return
        if not room:
            done.append((pattern, times))
            return
        if room not in bins:
            bins[room] = []
            insort(rooms, room)
        bins[room].append((pattern, times))

    for s in range(capacity, 0, -1):
        n = count[s]
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                each = capacity // s
                put(((s, each),), n // each, capacity - each * s)
                if n % each:
                    put(((s, n % each),), 1, capacity - n % each * s)
                break
            room = rooms[at]
            pattern, times = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(at)
            each = room // s              # the bin just used stays the fullest that fits
            full = min(times, n // each)
            put((*pattern, (s, each)), full, room - each * s)
            n -= full * each
            times -= full
            if times and n and n < each:
                put((*pattern, (s, n)), 1, room - n * s)
                times, n = times - 1, 0
            put(pattern, times, room)
    return done + [x for held in bins.values() for x in held]


class Plan:
    """Where the item of a length and a rank goes."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        count = [0] * (capacity + 1)
        for s, n in histogram.items():
            count[s] = n
        self.patterns = reduce_dominated(count, capacity)
        self.fixed = sum(times for _, times in self.patterns)
        self.patterns += best_fit(count, capacity)
        used, slots, base = [0] * (capacity + 1), [], 0
        for pattern, times in self.patterns:
            offset = 0
            for s, each in pattern:
                slots.append((s, used[s], base, offset, each))
                used[s] += times * each
                offset += s * each
            base += times
        self.sequences = base
        slots.sort()
        table = np.array(slots, np.int64).reshape(-1, 5)
        self.key = table[:, 0] << 48 | table[:, 1]
        self.first, self.base, self.offset, self.each = table[:, 1], table[:, 2], table[:, 3], table[:, 4]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length << 48 | rank, side="right") - 1
        t = rank - self.first[at]
        return self.base[at] + t // self.each[at], self.offset[at] + t % self.each[at] * length


def pack(rows: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (column length, 1 to capacity) with sequence_id and offset.
    ``rows`` should be a written table; ``keys`` order rows of one length."""
    spark = rows.sparkSession
    ship(spark)
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}   # capacity rows at most
    plan = spark.sparkContext.broadcast(Plan(histogram, capacity))
    salts = max(8, -(-sum(histogram.values()) // RANK_ROWS))
    salted = rows.withColumn("salt__", F.pmod(F.xxhash64(*keys), F.lit(salts)))
    part = salted.groupBy("length", "salt__").count()
    before = Window.partitionBy("length").orderBy("salt__").rowsBetween(Window.unboundedPreceding, -1)
    base = part.select("length", "salt__", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base__"))
    within = Window.partitionBy("length", "salt__").orderBy(*keys)
    ranked = salted.withColumn("nth__", F.row_number().over(within)).join(base, ["length", "salt__"])
    ranked = ranked.select(*rows.columns, (F.col("base__") + F.col("nth__") - 1).cast("long").alias("rank__"))
    at = rows.columns.index("length")

    def run(batches):
        for batch in batches:
            seq, offset = plan.value.place(np.asarray(batch.column(at)), np.asarray(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(seq), pa.array(offset)],
                                             names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """The pieces with their ids (a written table), and where each goes:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset. Only the
    narrow columns are ranked and shuffled; join on (doc_id, piece) for ids."""
    cut = written(pieces(docs, path, capacity), "packing_pieces")
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return cut, pack(narrow, ["doc_id", "piece", "ids_crc32"], capacity)
