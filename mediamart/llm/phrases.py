"""Operator 13, phrase collocations by vertically partitioned suffix trees.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends,
and pieces into words at blanks and tabs. A suffix is a word with the one or
two words after it in its piece: the suffix tree of the pieces, cut off at
DEPTH words. It is built in parts that fit in memory:

- Documents become blocks of word numbers, written once.
- Vertical partitioning: a word (with its language) is a prefix. One that
  starts more than ``hot`` suffixes is extended to its two-word prefixes, and
  such a pair to its three-word ones. Prefixes are dealt by hash into as many
  groups as keep a group at about half of ``budget`` suffixes.
- A block counts its equal suffixes and sends each group one packed row.
- Each group builds its subtrees alone: suffixes sorted, equal ones summed to
  leaf totals, inner nodes read from the totals of the leaves below them.
  Nodes above an extended prefix get a share from several groups and are
  summed after.

Phrase counts, cuts, the containment rule and the ranking then are joins,
groupings and a window over the frequent phrases.

What a task holds: a block, or a group (``budget`` is the bound; a block counts
a suffix once however often it holds it). The only broadcast is the list of
extended prefixes: each starts more than N / MOST_HOT of N suffixes in total,
counted with an allowance that at most doubles their number.

Defined cases: a null text counts as empty, a null lang as ``und``; null or
repeated ids, repeated rows and other columns play no part (every row counts);
texts and words are taken whole however long; ties are broken as the ranking
says, down to the phrase, which is unique within a language; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.llm.blocks import packed, unpacked, unzipped, zipped
from mediamart.llm.common import ship, slices, text_bytes, written

DEPTH = 3
#: Suffixes that a group may hold, and prefixes that are extended at most.
BUDGET, MOST_HOT = 2_000_000, 1_000_000
BLOCK_BYTES = 16 << 20
#: Byte that no UTF-8 text holds: piece border in a block, absent word in a suffix.
NONE = b"\xff"

_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[ord("A"):ord("Z") + 1] += 32
_TABLE[ord("\t")] = ord(" ")
_TABLE[list(b".,;:!?\n\x0b\x0c\r")] = 255


def _words(raw: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words (runs of bytes other than blank and border) and, for each,
    the number of borders before it."""
    border = raw == 255
    inside = np.r_[False, (raw != 32) & ~border, False]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    data = raw[inside[1:-1]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.cumsum(border)[starts] if len(starts) else starts


def encode(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and the texts as numbers from 1 into them, negative for
    the last word of a piece."""
    raw = _TABLE[np.frombuffer(b"\n".join(texts), np.uint8)]
    words, piece = _words(raw)
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    if len(ids):
        ids[np.r_[piece[1:] != piece[:-1], True]] *= -1
    return coded.dictionary.to_pylist(), ids


_BLOCKS = "lang string, n long, words binary, ids binary"


def blocks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, n (words), words, ids: the documents' texts, a row per language
    and about ``block_bytes`` of text that a task read."""
    ship(docs.sparkSession)

    def run(batches):
        held: dict[str, list[bytes]] = {}
        size = 0

        def rows():
            for lang, values in held.items():
                names, ids = encode(values)
                if len(ids):
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [lang], "n": [len(ids)], "words": [zipped(b" ".join(names))], "ids": [packed(ids, np.int32)]},
                        schema=pa.schema([("lang", pa.string()), ("n", pa.int64()), ("words", pa.binary()), ("ids", pa.binary())]))

        for batch in batches:
            for part in slices(batch, 0):
                for text, lang in zip(text_bytes(part.column(0)), part.column(1).to_pylist()):
                    if size and size + len(text) > block_bytes:
                        yield from rows()
                        held.clear()
                        size = 0
                    held.setdefault(lang, []).append(text)
                    size += len(text) + 1
        yield from rows()

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(F.col(text_col).cast("string").alias("text"), lang.alias("lang")).mapInArrow(run, _BLOCKS)


def suffixes(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of a block as rows of three word numbers (0: none),
    sorted, and how often each occurs."""
    goes_on = ids > 0
    w = np.abs(ids).astype(np.int64)
    one = np.where(goes_on, np.r_[w[1:], 0], 0)
    more = goes_on & np.r_[goes_on[1:], False]
    two = np.where(more, np.r_[w[2:], 0, 0][:len(w)], 0)
    bits = int(size + 1).bit_length()
    if 3 * bits <= 63:
        key = np.sort(w << (2 * bits) | one << bits | two)
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        key, mask = key[new], (1 << bits) - 1
        rows = np.stack([key >> (2 * bits), key >> bits & mask, key & mask], 1)
        return rows, np.diff(np.r_[new, len(w)])
    order = np.lexsort((two, one, w))
    rows = np.stack([w, one, two], 1)[order]
    new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(1)])
    return rows[new], np.diff(np.r_[new, len(w)])


def _names(words: bytes) -> list[bytes]:
    return unzipped(words).split(b" ")


def _hot_prefixes(coded: DataFrame, total: int, hot: int, first: dict | None) -> dict[str, set[bytes]]:
    """Prefixes of one word (``first`` None) or, under the words of ``first``,
    of two that start ``hot`` suffixes or more, by language. A block reports
    those above half that share of its own words; what it does not report adds
    up to less than half of ``hot``, so a sum of half of ``hot`` decides."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names, ids = _names(row["words"]), unpacked(row["ids"], np.int32)
                least = max(1.0, len(ids) * hot / (2.0 * total))
                w = np.abs(ids)
                if first is None:
                    n = np.bincount(w, minlength=len(names) + 1)
                    at = np.flatnonzero(n >= least)
                    found, count = [names[i - 1] for i in at.tolist()], n[at]
                else:
                    known = np.fromiter((x in first.get(row["lang"], ()) for x in names), bool, len(names))
                    ok = np.flatnonzero((ids[:-1] > 0) & known[w[:-1] - 1])
                    pair, n = np.unique(w[ok].astype(np.int64) << 32 | w[ok + 1], return_counts=True)
                    pair, count = pair[n >= least], n[n >= least]
                    found = [names[(p >> 32) - 1] + b" " + names[(p & 0xFFFFFFFF) - 1] for p in pair.tolist()]
                yield pa.RecordBatch.from_pydict({
                    "lang": [row["lang"]] * len(found), "prefix": found, "n": pa.array(count, pa.int64())},
                    schema=pa.schema([("lang", pa.string()), ("prefix", pa.binary()), ("n", pa.int64())]))

    columns = ["lang", "words", "ids"]
    seen = coded.select(*columns).mapInArrow(run, "lang string, prefix binary, n long")
    out: dict[str, set[bytes]] = {}
    for r in seen.groupBy("lang", "prefix").agg(F.sum("n").alias("n")).where(F.col("n") * 2 >= hot).select("lang", "prefix").toLocalIterator():
        out.setdefault(r.lang, set()).add(bytes(r.prefix))
    return out


def _large(value: bytes) -> pa.Scalar:
    return pa.scalar(value, pa.large_binary())


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray, other: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (other + _MIX + (h << np.uint64(6)) + (h >> np.uint64(2)))) * _MIX
        return h ^ (h >> np.uint64(29))


def _send(coded: DataFrame, groups: int, words_hot: dict, pairs_hot: dict) -> DataFrame:
    """grp, lang, suffixes: what each block has for each group, a line of three
    words and a count for every distinct suffix."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names, ids = _names(row["words"]), unpacked(row["ids"], np.int32)
                lang, hot1, hot2 = row["lang"], words_hot.get(row["lang"], set()), pairs_hot.get(row["lang"], set())
                rows, count = suffixes(ids, len(names))
                seed = xxhash.xxh64_intdigest(lang.encode())
                hashed = np.array([0, *(xxhash.xxh64_intdigest(x, seed) for x in names)], np.uint64)
                grp = hashed[rows[:, 0]]
                if hot1:
                    is_hot = np.array([False, *(x in hot1 for x in names)])
                    at = np.flatnonzero(is_hot[rows[:, 0]])
                    grp[at] = _mixed(grp[at], hashed[rows[at, 1]])
                    if hot2 and len(at):
                        pair = rows[at, 0] << 32 | rows[at, 1]
                        new = np.r_[True, pair[1:] != pair[:-1]]
                        first = np.flatnonzero(new)
                        held = np.array([b > 0 and names[a - 1] + b" " + names[b - 1] in hot2
                                         for a, b in rows[at[first], :2].tolist()], bool)
                        deep = at[held[np.cumsum(new) - 1]]
                        grp[deep] = _mixed(grp[deep], hashed[rows[deep, 2]])
                grp = (grp % np.uint64(groups)).astype(np.int64)
                order = np.argsort(grp, kind="stable")
                grp, rows, count = grp[order], rows[order], count[order]
                shown = pa.array([NONE, *names], pa.large_binary())
                lines = pc.binary_join_element_wise(
                    *(shown.take(pa.array(rows[:, i])) for i in range(DEPTH)), pa.array(count).cast(pa.string()).cast(pa.large_binary()),
                    _large(b" "))
                lines = pc.binary_join_element_wise(lines, _large(b""), _large(b"\n"))
                _, offsets, data = lines.buffers()
                ends = np.frombuffer(offsets, np.int64)[lines.offset:lines.offset + len(lines) + 1]
                cut = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]]) if len(grp) else np.zeros(0, int)
                blob = pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(np.ascontiguousarray(ends[np.r_[cut, len(grp)]])), data])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp[cut]), pa.array([lang] * len(cut), pa.string()), blob.cast(pa.binary())],
                    names=["grp", "lang", "suffixes"])

    return coded.select("lang", "words", "ids").mapInArrow(run, "grp long, lang string, suffixes binary")


def subtree(blobs: list[bytes], least: int, hot1: set[bytes], hot2: set[bytes]) -> tuple[list[bytes], list[int]]:
    """Node names and totals of one group's subtrees in one language: nodes
    with ``least`` suffixes below them, and all that other groups share."""
    raw = np.frombuffer(b"".join(blobs), np.uint8)
    raw = np.where(raw == 10, np.uint8(32), raw)
    fields = _plain_words(raw)
    coded = fields.dictionary_encode()
    names = coded.dictionary.to_pylist()
    ids = coded.indices.to_numpy(zero_copy_only=False).reshape(-1, DEPTH + 1)
    number = np.array([int(x) if x.isdigit() else 0 for x in names], np.int64)
    count, ids = number[ids[:, DEPTH]], ids[:, :DEPTH]
    none = names.index(NONE) if NONE in names else -1
    order = np.lexsort((ids[:, 2], ids[:, 1], ids[:, 0]))
    ids, count = ids[order], count[order]
    out, totals = [], []
    for depth in range(1, DEPTH + 1):
        part = ids[:, :depth]
        new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]).any(1)])
        total = np.add.reduceat(count, new)
        node = part[new]
        keep = total >= least
        if depth == 1 and hot1:
            keep |= np.array([names[i] in hot1 for i in node[:, 0].tolist()])
        elif depth == 2 and hot2:
            keep |= np.array([names[i] + b" " + names[j] in hot2 for i, j in node.tolist()])
        keep &= node[:, depth - 1] != none
        out += [b" ".join([names[i] for i in x]) for x in node[keep].tolist()]
        totals += total[keep].tolist()
    return out, totals


def _plain_words(raw: np.ndarray) -> pa.Array:
    """Runs of bytes other than the blank."""
    inside = np.r_[False, raw != 32, False]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside[1:-1]])])


def phrase_counts(coded: DataFrame, least: int, budget: int = BUDGET) -> DataFrame:
    """lang, phrase, f of all phrases of up to DEPTH words that occur ``least``
    times or more, from written :func:`blocks`."""
    spark = coded.sparkSession
    total = coded.agg(F.sum("n")).first()[0] or 0
    hot = max(2, budget // 32, total // MOST_HOT)
    groups = max(1, -(-2 * total // budget))
    words_hot = _hot_prefixes(coded, total, hot, None) if total else {}
    pairs_hot = _hot_prefixes(coded, total, hot, words_hot) if words_hot else {}
    sent = _send(coded, groups, words_hot, pairs_hot)

    def build(rows: pa.Table) -> pa.Table:
        held: dict[str, list[bytes]] = {}
        for lang, blob in zip(rows.column("lang").to_pylist(), rows.column("suffixes").to_pylist()):
            held.setdefault(lang, []).append(blob)
        langs, phrases, totals = [], [], []
        for lang, blobs in held.items():
            names, n = subtree(blobs, least, words_hot.get(lang, set()), pairs_hot.get(lang, set()))
            langs += [lang] * len(names)
            phrases += names
            totals += n
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
                         "f": pa.array(totals, pa.int64())})

    tasks = max(groups, spark.sparkContext.defaultParallelism)
    nodes = sent.repartition(tasks, "grp").groupBy("grp").applyInArrow(build, "lang string, phrase string, f long")
    return nodes.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, cover_percent: int = 50,
                 top: int = 2000, budget: int = BUDGET, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases
    of two or three words. A phrase goes if a longer candidate that holds its
    words occurs at least ``cover_percent`` of a hundred times as often."""
    coded = written(blocks(docs, text_col, lang_col, block_bytes), "phrase_blocks")
    found = written(phrase_counts(coded, least, budget), "phrase_counts")
    depth = F.size(F.split("phrase", " "))
    single, double, triple = (found.where(depth == d) for d in (1, 2, 3))

    def with_count(rows: DataFrame, part: Column, counts: DataFrame, name: str) -> DataFrame:
        known = counts.select("lang", F.col("phrase").alias("_part"), F.col("f").alias(name))
        return rows.withColumn("_part", part).join(known, ["lang", "_part"]).drop("_part")

    def score(l: str, r: str) -> Column:                                        # noqa: E741
        wide = "CAST({} AS DECIMAL(20, 0))"
        a, b, c = (wide.format(x) for x in ("f", l, r))
        return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({a} * {a})) DIV ({b} * {c})")

    first, last = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    front, back = F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)
    covers = triple.select("lang", F.explode(F.array(front, back)).alias("phrase"), "f")
    covers = covers.groupBy("lang", "phrase").agg(F.max("f").alias("covered"))
    two = with_count(with_count(double, first, single, "l"), last, single, "r")
    two = two.join(covers, ["lang", "phrase"], "left").where(
        F.col("covered").isNull() | (F.col("covered") * 100 < F.col("f") * cover_percent))
    two = two.select("lang", "phrase", F.col("f").alias("a"), "l", "r", score("l", "r").alias("score"))
    three = with_count(with_count(triple, first, single, "l1"), back, double, "r1")
    three = with_count(with_count(three, front, double, "l2"), last, single, "r2")
    three = three.select("lang", "phrase", "f", "l1", "r1", "l2", "r2", score("l1", "r1").alias("s1"), score("l2", "r2").alias("s2"))
    later = F.col("s2") < F.col("s1")
    three = three.select("lang", "phrase", F.col("f").alias("a"), F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                         F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    place = F.row_number().over(_by_rank())
    best = two.unionByName(three).withColumn("rank", place).where(F.col("rank") <= top)
    size = coded.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _by_rank():
    from pyspark.sql import Window
    return Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
