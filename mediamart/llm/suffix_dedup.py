"""Operator 4, removal of repeated byte strings with suffix arrays.

Every byte covered by a string of LENGTH bytes that also starts in a document
with a smaller id is removed; strings are judged on the input.

Which windows (strings of LENGTH bytes) can match is narrowed first, without
losing any: each window has an anchor, its K-byte substring of least hash, and
equal windows have equal anchors. Blocks of documents ask, by packed hashes,
which of their anchors also occur in another document; around those they cut
segments that hold every window the anchor stands for. Equal segments of a
block are one. Segments meet by anchor hash in groups; those with only one
text left need no comparison, the others get a suffix array by linear grouping
(``suffix_groups``) over the parts that can match, in which equal windows are
neighbours and take the smallest document id among them. Blocks get the runs
of matching windows back, mark the bytes and cut them out.

An anchor with more than HOT places in the whole corpus could have ever
different bytes around it and make one large group. All blocks ask about such
an anchor window by window instead: each window is a segment of its own under
its own hash, so that the group is spread.

Defined cases: a null text counts as empty; texts shorter than LENGTH lose
nothing; matches never cross documents; rows that share an id do not remove
from each other; a row with a null id counts as larger than every id; a match
within one document removes nothing; an empty table gives an empty result;
other columns pass through untouched; ``clean_text`` drops a character of which
a byte was removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mediamart.llm.blocks import chunks, gather, packed, ranges, rest_columns, text_values, unpacked, unzipped, zipped
from mediamart.llm.common import ship, unused, written
from mediamart.llm.suffix_groups import suffix_array

LENGTH, K = 50, 24
SPAN = LENGTH - K + 1                     # anchor positions in a window
HASH_BITS = 48
HOT = 20_000
SORT_BYTES = 4096                         # suffix arrays are built over about so much at once
PIECE = 4 << 20
BLOCK = 8 << 20                           # a task holds segments of one block, several times its text
NO_ID = np.iinfo(np.int64).max
_LETTER = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _power(e: int) -> np.uint64:
    return np.uint64(pow(_BASE, e, 1 << 64))


def rolling(flat: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each position on, by doubling."""
    h, size, out, used = _LETTER[flat], 1, None, 0
    while True:
        if length & size:
            if out is None:
                out, used = h, size
            else:
                n = len(h) - used
                out = out[:max(n, 0)] * _power(size) + h[used:]
                used += size
        if used == length:
            break
        h = h[:len(h) - size] * _power(size) + h[size:]
        size *= 2
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def _least(key: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each ``span`` neighbours."""
    size = 1
    while 2 * size <= span:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    rest = span - size
    return np.minimum(key[:-rest], key[rest:]) if rest else key


def anchors(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """document (its place in ``values``), position and hash of every anchor."""
    out = []
    pieces = [(i, a, v[a:a + PIECE + LENGTH - 1]) for i, v in enumerate(values) if len(v) >= LENGTH
              for a in range(0, len(v) - LENGTH + 1, PIECE)]
    for first, last in chunks([len(x[2]) for x in pieces]):
        part = pieces[first:last]
        flat = np.frombuffer(b"".join(x[2] for x in part), np.uint8)
        h = rolling(flat, K)
        at = np.arange(len(h), dtype=np.uint64)
        key = _least((h >> np.uint64(24) << np.uint64(24)) | at, SPAN)
        size = np.array([len(x[2]) for x in part])
        start = np.cumsum(size) - size
        whole = np.ones(len(key), bool)        # windows that do not cross a border
        for s in start[1:].tolist():
            whole[max(0, s - LENGTH + 1):s] = False
        p = (key[whole] & np.uint64(0xFFFFFF)).astype(np.int64)
        p = p[np.r_[True, p[1:] != p[:-1]]]    # the places of the minima ascend with the windows
        owner = np.searchsorted(start, p, side="right") - 1
        out.append((np.array([x[0] for x in part])[owner], p - start[owner] + np.array([x[1] for x in part])[owner],
                    _spread(h[p])))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    doc, pos, h = (np.concatenate(x) for x in zip(*out))
    # a long text's pieces overlap and may name an anchor twice
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (pos[1:] > pos[:-1])
    return doc[keep], pos[keep], h[keep]


def _spread(h: np.ndarray) -> np.ndarray:
    """The hash that names an anchor. Anchors have the least of their
    neighbours' hashes, so those crowd at the low end; mixed again they spread."""
    h = h * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(32))) * np.uint64(_BASE) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _ids(row: dict, id_at: int) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in rest_columns(row)[id_at].to_pylist()], np.int64)


def _by_hash(h: np.ndarray, groups: int) -> np.ndarray:
    """Group of each hash; ascending, as the hashes are."""
    return (h >> 16) * groups >> (HASH_BITS - 16)


# -- first question: which anchors occur in two documents ---------------------
_ASKED = pa.schema([("block", pa.int64()), ("grp", pa.int64()), ("hashes", pa.binary()), ("several", pa.binary()), ("places", pa.binary())])


def _distinct(doc_id: np.ndarray, h: np.ndarray):
    """Distinct hashes; the smallest and the largest document id and the number of places of each."""
    order = np.argsort(h, kind="stable")
    h, doc_id = h[order], doc_id[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, int)
    if not len(h):
        return h, doc_id, doc_id, h
    return h[first], np.minimum.reduceat(doc_id, first), np.maximum.reduceat(doc_id, first), np.diff(np.r_[first, len(h)])


def _ask_anchors(groups: int, id_at: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc, _, h = anchors(text_values(row))
                key, low, high, places = _distinct(_ids(row, id_at)[doc], h)
                out = [{"block": row["block"], "grp": g, "hashes": packed(np.diff(key[a:b], prepend=0)),
                        "several": zipped(np.packbits(low[a:b] < high[a:b]).tobytes()), "places": packed(places[a:b], np.int32)}
                       for g, a, b in ranges(_by_hash(key, groups))]
                yield pa.RecordBatch.from_pylist(out, _ASKED)
    return run


_MARKED = pa.schema([("block", pa.int64()), ("grp", pa.int64()), ("marks", pa.binary())])


def _bits(blob: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=count).astype(bool)


def _mark_anchors(hot: int):
    """Per block, which of its hashes are in several documents (of the block,
    or of two blocks), and which have more than ``hot`` places in all."""
    def run(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        hashes = [np.cumsum(unpacked(r["hashes"])) for r in rows]
        several = np.concatenate([_bits(unzipped(r["several"]), len(h)) for r, h in zip(rows, hashes)])
        places = np.concatenate([unpacked(r["places"], np.int32) for r in rows])
        _, at, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        wanted = (n > 1) | (np.bincount(at, weights=several) > 0)
        much = np.bincount(at, weights=places) > hot
        ends = np.cumsum([len(h) for h in hashes])
        out = []
        for r, h, b in zip(rows, hashes, ends):
            mine = at[b - len(h):b]
            out.append({"block": r["block"], "grp": r["grp"],
                        "marks": zipped(np.packbits(wanted[mine]).tobytes() + np.packbits(much[mine]).tobytes())})
        return pa.Table.from_pylist(out, _MARKED)
    return run


# -- second question: which windows of the segments match ---------------------
class Segments:
    """A block's segments around its marked anchors. Equal ones are one:
    ``key`` (hash), ``text``, ``left`` (bytes before the anchor); ``doc``,
    ``start`` and ``which`` list the places they were cut from."""

    def __init__(self, values: list[bytes], marks: dict[int, bytes], groups: int):
        doc, pos, h = anchors(values)
        key = np.sort(h)
        key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
        wanted, much = np.zeros(len(key), bool), np.zeros(len(key), bool)
        for g, a, b in ranges(_by_hash(key, groups)):
            both = unzipped(marks[g])
            wanted[a:b], much[a:b] = _bits(both[:len(both) // 2], b - a), _bits(both[len(both) // 2:], b - a)
        hot = set(key[wanted & much].tolist())
        ok = wanted[np.searchsorted(key, h)]
        doc, pos, h = doc[ok], pos[ok], h[ok]
        size = np.fromiter(map(len, values), np.int64, len(values))
        a, b = np.maximum(pos - SPAN + 1, 0), np.minimum(pos + LENGTH, size[doc])
        index: dict[tuple, int] = {}
        which = np.empty(len(doc), np.int64)
        for n, (d, s, e, p, k) in enumerate(zip(doc.tolist(), a.tolist(), b.tolist(), pos.tolist(), h.tolist())):
            which[n] = index.setdefault((k, values[d][s:e], p - s), len(index))
        if hot:
            doc, a, which, index = self._by_window(index, hot, doc, a, which)
        # in the order in which they are asked about
        items = list(index)
        keys = np.array([x[0] for x in items], np.int64)
        order = np.lexsort((np.arange(len(items)), keys))
        rank = np.empty(len(items), np.int64)
        rank[order] = np.arange(len(items))
        self.key = keys[order]
        self.text = [items[i][1] for i in order.tolist()]
        self.doc, self.start, self.which = doc, a, rank[which]

    @staticmethod
    def _by_window(index, hot, doc, start, which):
        """Segments of hot anchors become one segment for each window."""
        items, fresh, cut = list(index), {}, []
        for n, (k, text, left) in enumerate(items):
            if k not in hot:
                cut.append([fresh.setdefault((k, text, left), len(fresh))])
                continue
            keys = _spread(rolling(np.frombuffer(text, np.uint8), LENGTH))
            cut.append([fresh.setdefault((key, text[j:j + LENGTH], 0), len(fresh)) for j, key in enumerate(keys.tolist())])
        count = np.array([len(c) for c in cut])[which]
        flat, first = np.concatenate([np.array(c) for c in cut]), np.cumsum([0, *map(len, cut)])[:-1]
        offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return (np.repeat(doc, count), np.repeat(start, count) + offset, flat[np.repeat(first[which], count) + offset], fresh)


_SEGMENTS = pa.schema([("block", pa.int64()), ("grp", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()),
                       ("texts", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])


def _by_group(t: pa.Table, value: str) -> dict[int, bytes]:
    return dict(zip(t.column("grp").to_pylist(), t.column(value).to_pylist()))


def _ask_segments(groups: int, id_at: int):
    def run(block: pa.Table, marks: pa.Table) -> pa.Table:
        out = []
        for row in block.to_pylist():
            ids = _ids(row, id_at)
            found = Segments(text_values(row), _by_group(marks, "marks"), groups)
            _, low, high, _ = _distinct(ids[found.doc], found.which)
            for g, a, b in ranges(_by_hash(found.key, groups)):
                text = found.text[a:b]
                out.append({"block": row["block"], "grp": g, "keys": packed(np.diff(found.key[a:b], prepend=0)),
                            "sizes": packed(np.fromiter(map(len, text), np.int64, len(text))),
                            "texts": zipped(b"".join(text)), "low": packed(low[a:b]), "high": packed(high[a:b])})
        return pa.Table.from_pylist(out, _SEGMENTS)
    return run


def equal_windows(texts: list[bytes], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of every text: text, offset, and the smallest
    ``owner`` (one number per text) of an equal window, from a suffix array."""
    flat = b"".join(texts)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size)
    order = np.array(suffix_array(flat), np.int64)
    text = np.searchsorted(ends, order, side="right")
    inside = order + LENGTH <= ends[text]      # a suffix goes on into the next text, a window does not
    order, text = order[inside], text[inside]
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(flat, np.uint8), LENGTH)
    new = np.ones(len(order), bool)
    new[1:] = (windows[order[1:]] != windows[order[:-1]]).any(1)
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(owner[text], first)
    return text, order - (ends - size)[text], np.repeat(least, np.diff(np.r_[first, len(order)]))


def _match(key: np.ndarray, texts: list[bytes], low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct segments sorted by hash: first window of each, and for
    every window the smallest document id that has it."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    count = size - LENGTH + 1
    first = np.cumsum(count) - count
    least = np.repeat(low, count)
    crowd = np.repeat([b - a > 1 for _, a, b in ranges(key)], [b - a for _, a, b in ranges(key)]).astype(bool)
    among = np.flatnonzero(crowd)
    if not len(among):
        return first, least
    # what can match: from the first to the last window whose hash two segments of the crowd have
    flat = np.frombuffer(b"".join(texts[i] for i in among.tolist()), np.uint8)
    h = rolling(flat, LENGTH)
    n, c = size[among], count[among]
    owner = np.repeat(np.arange(len(among)), c)
    offset = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
    h = h[np.repeat(np.cumsum(n) - n, c) + offset]
    h ^= key[among][owner].astype(np.uint64) * np.uint64(_BASE)    # windows are compared within a crowd
    order = np.argsort(h, kind="stable")
    hs, os = h[order], owner[order]
    start = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]])
    shared = np.repeat(np.minimum.reduceat(os, start) < np.maximum.reduceat(os, start), np.diff(np.r_[start, len(hs)]))
    at = np.sort(order[shared])
    if not len(at):
        return first, least
    runs = ranges(owner[at])
    crowded: dict[int, dict] = {}
    for o, a, b in runs:
        i = int(among[o])
        x, y = int(offset[at[a]]), int(offset[at[b - 1]])
        crowded.setdefault(int(key[i]), {}).setdefault(texts[i][x:y + LENGTH], []).append((i, x))
    batch: list[tuple[bytes, list]] = []

    def settle() -> None:
        held = np.array([min(int(low[i]) for i, _ in where) for _, where in batch], np.int64)
        which, off, best = equal_windows([t for t, _ in batch], held)
        order = np.lexsort((off, which))
        which, best = which[order], best[order]
        for j, a, b in ranges(which):
            for i, x in batch[j][1]:
                at = first[i] + x
                least[at:at + b - a] = np.minimum(least[at:at + b - a], best[a:b])
        batch.clear()

    total = 0
    for parts in crowded.values():
        if len(parts) == 1:                    # one text: all its windows are in all its segments
            (text, where), = parts.items()
            low_id = min(int(low[i]) for i, _ in where)
            for i, x in where:
                at = first[i] + x
                stop = at + len(text) - LENGTH + 1
                least[at:stop] = np.minimum(least[at:stop], low_id)
            continue
        batch += parts.items()
        total += sum(map(len, parts))
        if total > SORT_BYTES:
            settle()
            total = 0
    if batch:
        settle()
    return first, least


_RUNS = pa.schema([("block", pa.int64()), ("grp", pa.int64()), ("marks", pa.binary()), ("runs", pa.binary())])


def _answer_segments(t: pa.Table) -> pa.Table:
    """Per block: runs (segment, first window, end, smallest id) of windows
    that a document with a smaller id than the segment's largest has."""
    rows, index, asked = t.to_pylist(), {}, []
    keys, texts = [], []
    for r in rows:
        key, size = np.cumsum(unpacked(r["keys"])), unpacked(r["sizes"])
        flat, ends = unzipped(r["texts"]), np.cumsum(size).tolist()
        which = np.empty(len(key), np.int64)
        for j, (k, a, b) in enumerate(zip(key.tolist(), [0, *ends], ends)):
            item = (k, flat[a:b])
            n = index.get(item)
            if n is None:
                n = index[item] = len(index)
                keys.append(k)
                texts.append(item[1])
            which[j] = n
        asked.append(which)
    index.clear()
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    key = np.array(keys, np.int64)[order]
    texts = [texts[i] for i in order.tolist()]
    asked = [rank[w] for w in asked]
    low = np.full(len(key), NO_ID)
    for r, w in zip(rows, asked):
        np.minimum.at(low, w, unpacked(r["low"]))
    first, least = _match(key, texts, low)
    # runs of one value in each segment
    total = len(least)
    cut = np.zeros(total, bool)
    cut[first] = True
    cut[1:] |= least[1:] != least[:-1]
    begin = np.flatnonzero(cut)
    end = np.r_[begin[1:], total]
    seg = np.searchsorted(first, begin, side="right") - 1
    value, begin, end = least[begin], begin - first[seg], end - first[seg]
    n_runs = np.bincount(seg, minlength=len(key))
    run0 = np.cumsum(n_runs) - n_runs
    out = []
    for r, w in zip(rows, asked):
        count = n_runs[w]
        own = np.repeat(np.arange(len(w)), count)
        at = np.repeat(run0[w], count) + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        ok = value[at] < unpacked(r["high"])[own]
        own, at = own[ok], at[ok]
        out.append({"block": r["block"], "grp": r["grp"], "marks": None,
                    "runs": packed(np.stack([own, begin[at], end[at], value[at]]))})
    return pa.Table.from_pylist(out, _RUNS)


# -- cutting -----------------------------------------------------------------
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(groups: int, id_at: int, schema: pa.Schema, text_at: int | None):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        marks = _by_group(answers.filter(pa.compute.is_valid(answers.column("marks"))), "marks")
        runs = _by_group(answers.filter(pa.compute.is_valid(answers.column("runs"))), "runs")
        out = []
        for row in block.to_pylist():
            values, ids = text_values(row), _ids(row, id_at)
            found = Segments(values, marks, groups)
            size = np.array(row["size"], np.int64)
            base = np.cumsum(size) - size
            step = np.zeros(int(size.sum()) + 1, np.int32)
            parts = [(a, unpacked(runs[g]).reshape(4, -1)) for g, a, _ in ranges(_by_hash(found.key, groups))]
            seg = np.concatenate([a + r[0] for a, r in parts]) if parts else np.zeros(0, np.int64)
            begin, end, value = (np.concatenate([r[i] for _, r in parts]) if parts else np.zeros(0, np.int64) for i in (1, 2, 3))
            # every place of a segment with each of its runs (seg ascends)
            count = np.bincount(seg, minlength=len(found.key))
            run0 = np.cumsum(count) - count
            times = count[found.which]
            place = np.repeat(np.arange(len(found.which)), times)
            at = np.repeat(run0[found.which], times) + np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
            ok = value[at] < ids[found.doc[place]]
            place, at = place[ok], at[ok]
            start = base[found.doc[place]] + found.start[place]
            np.add.at(step, start + begin[at], 1)
            np.add.at(step, start + end[at] + LENGTH - 1, -1)
            gone = np.cumsum(step)[:-1] > 0
            rest = rest_columns(row)
            masks = [gone[a:a + n] for a, n in zip(base.tolist(), size.tolist())]
            if text_at is not None:
                masks = [_whole_characters(v, m) if m.any() else m for v, m in zip(values, masks)]
            kept = [np.frombuffer(v, np.uint8)[~m].tobytes() if m.any() else v for v, m in zip(values, masks)]
            if text_at is not None:
                texts = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
                out.append(pa.table([*rest[:text_at], texts, *rest[text_at:]], names=schema.names))
                continue
            edges = [np.flatnonzero(np.diff(np.r_[0, m.astype(np.int8), 0])).tolist() for m in masks]
            spans = [[{"start": s, "end": e} for s, e in zip(x[::2], x[1::2])] for x in edges]
            out.append(pa.table([*rest, pa.array(kept, pa.binary()), pa.array(size), pa.array(spans, _SPANS)], names=schema.names))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def _whole_characters(value: bytes, gone: np.ndarray) -> np.ndarray:
    """``gone`` widened to all bytes of each UTF-8 character that it touches,
    so that what is left of two characters never meets as a third."""
    lead = (np.frombuffer(value, np.uint8) & 0xC0) != 0x80
    lead[0] = True
    hit = np.logical_or.reduceat(gone, np.flatnonzero(lead))
    return hit[np.cumsum(lead) - 1]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   hot: int = HOT) -> tuple[DataFrame, list[str]]:
    """The columns of ``docs`` other than the text, and three more, whose
    names are returned too: the kept bytes, the text's number of bytes, and
    the removed spans (start and end byte)."""
    made = [unused(docs, c) for c in ("kept", "n_bytes", "spans")]
    fields = [_field(f) for f in docs.schema.fields if f.name != text_col]
    return _removed(docs, id_col, text_col, hot, None, [
        *fields, f"`{made[0]}` binary", f"`{made[1]}` long", f"`{made[2]}` array<struct<start:long,end:long>>"]), made


def clean_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``docs`` with its columns, the repeated strings cut out of the text."""
    fields = [f"`{f.name}` string" if f.name == text_col else _field(f) for f in docs.schema.fields]
    return _removed(docs, id_col, text_col, hot, docs.columns.index(text_col), fields)


def _field(f) -> str:
    return f"`{f.name}` {f.dataType.simpleString()}"


def _removed(docs: DataFrame, id_col: str, text_col: str, hot: int, text_at: int | None, fields: list[str]) -> DataFrame:
    ship(docs.sparkSession)
    id_at = [c for c in docs.columns if c != text_col].index(id_col)
    typed = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
    held = written(gather(typed, text_col, block_bytes=BLOCK), "suffix_blocks")
    total = held.select(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0]
    groups = max(12, -(-int(total or 0) // BLOCK))
    asked = held.mapInArrow(_ask_anchors(groups, id_at), "block long, grp long, hashes binary, several binary, places binary")
    marks = written(asked.groupBy("grp").applyInArrow(_mark_anchors(hot), "block long, grp long, marks binary"), "suffix_marks")
    segments = held.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        _ask_segments(groups, id_at), "block long, grp long, keys binary, sizes binary, texts binary, low binary, high binary")
    runs = segments.groupBy("grp").applyInArrow(_answer_segments, "block long, grp long, marks binary, runs binary")
    answers = marks.withColumn("runs", F.lit(None).cast("binary")).union(runs)
    shape = ", ".join(fields)
    schema = to_arrow_schema(StructType.fromDDL(shape))
    return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cut(groups, id_at, schema, text_at), shape)
