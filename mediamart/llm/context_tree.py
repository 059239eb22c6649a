"""Operator 3, language-model scores by context-tree weighting.

Model. A text is the sequence of its bytes (A-Z lower-cased) and one end mark.
Each byte is eight binary decisions; a decision is predicted in the context of
the DEPTH bytes before it, at every depth from 0 to DEPTH. A node (context,
decided bits) holds a Krichevsky-Trofimov estimate from its training counts.
Its weighted probability is half its own estimate and half the product of its
children's, so the weight of each depth follows from the counts, and the
prediction mixes the estimates of all depths along the context. A context
that training never saw adds nothing; the mixture ends at the deepest one
seen. A score is log10 of the probability of the whole text.

On Spark. Documents are gathered into blocks of about BLOCK_BYTES, written
once. Each block sends its distinct (context, byte) pairs and distinct words
with their training counts; counts are summed over parts of the blocks and
then over the parts, the tree is weighted bottom-up (depths DEPTH to 3 inside groups of contexts, 2 to 0 as
aggregations of a few thousand rows), every pair gets its probability, and
each block gets back the answers for its own pairs and words only. Nothing is
kept whole on the driver or in one task, and everything gathered grows with
the corpus.

Defined cases: a null text counts as empty and scores its end mark; without
training documents every estimate is one half (8 bits a byte) and the base has
N = V = 0; repeated rows are scored one by one; an empty table gives an empty
result; other columns are ignored; a null id counts as empty text in the
choice of the fold; very long texts are a block of their own.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.llm.blocks import chunks, gather, packed, ranges, rest_columns, text_values, unpacked, unzipped, zipped
from mediamart.llm.common import id_remainder, ship, written

FOLDS, HELD_OUT_FOLD = 7, 2
DEPTH, JOINT = 5, 3            # contexts of JOINT bytes and more are weighted together
MARK = 0xFF                    # not in UTF-8: end of a text, and what stands before its start
LOG_HALF = float(np.log(0.5))


# -- bytes to (context, byte) pairs ----------------------------------------
def pair_keys(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all coded positions of the texts, and each text's number of
    them. A key holds the byte in its lowest 8 bits and above it the context,
    nearest byte highest, so a shorter context is a prefix."""
    pad = bytes([MARK]) * DEPTH
    flat = np.frombuffer(b"".join(pad + v + bytes([MARK]) for v in values), np.uint8).astype(np.int64)
    size = np.fromiter(map(len, values), np.int64, len(values)) + 1
    key = flat[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        key |= flat[DEPTH - back:len(flat) - back] << (8 * (DEPTH + 1 - back))
    ends = np.cumsum(size + DEPTH)
    # positions of the padding before every text but the first are not coded
    coded = np.ones(len(key), bool)
    for back in range(DEPTH):
        coded[ends[:-1] - DEPTH + back] = False
    return key[coded], size


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    return key[first], np.add.reduceat(n, first) if len(key) else n


# -- estimates ---------------------------------------------------------------
def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 0.5 (Stirling's series from 8 up)."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift = np.where(low, shift + np.log(np.where(low, y, 1)), shift)
        y = np.where(low, y + 1, y)
    z = 1 / (y * y)
    tail = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + tail - shift


def log_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def weighted(n0: np.ndarray, n1: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For nodes with children of total log weight ``below``: log weighted
    probability, posterior weight of the node's own estimate, P(next is 1)."""
    own = LOG_HALF + log_block(n0, n1)
    total = np.logaddexp(own, LOG_HALF + below)
    return total, np.exp(own - total), (n1 + 0.5) / (n0 + n1 + 1.0)


class Subtree:
    """Nodes of depths DEPTH to JOINT over sorted distinct pair keys ``key``
    with training counts ``n`` (0: to be predicted only)."""

    def __init__(self, key: np.ndarray, n: np.ndarray):
        j = np.arange(8)
        byte = (key & 255)[:, None]
        self.bit = (byte >> (7 - j)) & 1
        node = (1 << j) | (byte >> (8 - j))
        path = (key >> 8)[:, None] << 8 | node
        levels, below = {}, None
        for depth in range(DEPTH, JOINT - 1, -1):
            here = path if depth == DEPTH else (path >> (8 * (DEPTH - depth) + 8) << 8) | node
            uniq, at = np.unique(here, return_inverse=True)
            at = at.reshape(here.shape)
            ones = np.bincount(at.ravel(), weights=(n[:, None] * self.bit).ravel(), minlength=len(uniq))
            zeros = np.bincount(at.ravel(), weights=(n[:, None] * (1 - self.bit)).ravel(), minlength=len(uniq))
            if depth == DEPTH:
                log_w, share, p1 = log_block(zeros, ones), np.ones(len(uniq)), (ones + 0.5) / (zeros + ones + 1.0)
            else:
                # each child node's weight counts once, with any of its pairs
                child_key, child_log = below
                parent = (child_key >> 16 << 8) | (child_key & 255)
                log_w, share, p1 = weighted(zeros, ones, np.bincount(np.searchsorted(uniq, parent), weights=child_log, minlength=len(uniq)))
            levels[depth] = (uniq, at, zeros, ones, share, p1)
            below = (uniq, log_w)
        self.levels, self.log_w = levels, below[1]

    def nodes(self):
        """Of depth JOINT: key (context << 8 | decided bits), n0, n1, log weight."""
        uniq, _, zeros, ones, _, _ = self.levels[JOINT]
        return uniq, zeros, ones, self.log_w

    def log10(self, node_key: np.ndarray, add: np.ndarray, times: np.ndarray) -> np.ndarray:
        """log10 probability of each pair. The depths above come in as
        ``add + times * prediction of depth JOINT`` for each of its nodes."""
        value = None
        for depth in range(DEPTH, JOINT - 1, -1):
            _, at, zeros, ones, share, p1 = self.levels[depth]
            own = p1[at]
            if value is None:
                value = own
            else:
                w = np.where(seen, share[at], 1.0)
                value = w * own + (1 - w) * value
            seen = (zeros + ones)[at] > 0
        uniq, at = self.levels[JOINT][:2]
        place = np.searchsorted(node_key, uniq)
        one = add[place][at] + times[place][at] * value
        return np.log10(np.where(self.bit == 1, one, 1 - one)).sum(1)


# -- what a block asks and is answered ----------------------------------------
class _Index(dict):
    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _word_order(words: list[bytes], groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Group of each word, and the order by (group, word)."""
    group = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % groups
    by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    return group, by_word[np.argsort(group[by_word], kind="stable")]


def _pair_group(key: np.ndarray, groups: int) -> np.ndarray:
    """Pairs with the same JOINT nearest context bytes are in one group."""
    mixed = (key >> (8 * (DEPTH + 1 - JOINT))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(groups)).astype(np.int64)


def _block_words(values: list[bytes], index: _Index) -> tuple[np.ndarray, np.ndarray]:
    """Number of every word in ``index``, and each text's word count."""
    parts, count, get = [], np.zeros(len(values), np.int64), index.__getitem__
    for i, v in enumerate(values):
        words = v.split()               # bytes: ASCII white space only
        parts.append(np.fromiter(map(get, words), np.int32, len(words)))
        count[i] = len(words)
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), count


def _block_pairs(values: list[bytes], held: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a block sorted by (group, key), training counts, groups."""
    parts = []
    for a, b in chunks([len(v) for v in values]):
        for part, counts in (([v for v, h in zip(values[a:b], held[a:b]) if not h], True),
                             ([v for v, h in zip(values[a:b], held[a:b]) if h], False)):
            if part:
                key, n = np.unique(pair_keys(part)[0], return_counts=True)
                parts.append((key, n if counts else np.zeros(len(n), np.int64)))
    key, n = summed(parts)
    group = _pair_group(key, groups)
    order = np.argsort(group, kind="stable")
    return key[order], n[order], group[order]


def _held(row: dict) -> np.ndarray:
    """Which documents of a block training leaves out."""
    return np.asarray(rest_columns(row)[1].to_pylist(), bool)


def _ask(word_groups: int, pair_groups: int):
    """A block's distinct words and pairs with training counts, by group."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, held, index = text_values(row), _held(row), _Index()
                out = []
                word, count = _block_words(values, index)
                n = np.bincount(word, weights=np.repeat(~held, count), minlength=len(index)).astype(np.int64)
                words = list(index)
                index.clear()
                group, order = _word_order(words, word_groups)
                for g, a, b in ranges(group[order]):
                    part = order[a:b]
                    out.append({"block": row["block"], "kind": "w", "grp": g, "n": packed(n[part]),
                                "keys": zipped(b"\n".join(words[i] for i in part.tolist()))})
                key, n, group = _block_pairs(values, held, pair_groups)
                for g, a, b in ranges(group):
                    out.append({"block": row["block"], "kind": "p", "grp": g, "n": packed(n[a:b]),
                                "keys": packed(np.diff(key[a:b], prepend=0))})
                yield pa.RecordBatch.from_pylist(out, _ASKED)
    return run


_ASKED = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("grp", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("grp", pa.int64()), ("found", pa.binary())])


def _count_words(t: pa.Table) -> pa.Table:
    """Training counts of a group's words over all blocks; the group's number
    of tokens and of words with a count go with its first row."""
    index, asked, total = _Index(), [], np.zeros(0, np.int64)
    rows = t.to_pylist()
    for row in rows:
        words = unzipped(row["keys"]).split(b"\n")
        at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        if len(index) > len(total):
            total = np.concatenate([total, np.zeros(len(index) - len(total), np.int64)])
        total[at] += unpacked(row["n"])          # a block names a word once
        asked.append(at)
    return pa.Table.from_pylist(
        [{"block": r["block"], "kind": "w", "grp": r["grp"], "found": packed(total[at]),
          "tokens": int(total.sum()) if i == 0 else 0, "known": int((total > 0).sum()) if i == 0 else 0}
         for i, (r, at) in enumerate(zip(rows, asked))],
        pa.schema([*_ANSWER, ("tokens", pa.int64()), ("known", pa.int64())]))


def _sum_part(t: pa.Table) -> pa.Table:
    """A group's pairs of some blocks as one row: distinct keys, summed counts."""
    key, n = _summed_rows(t)
    return pa.Table.from_pylist([{"grp": t.column("grp")[0].as_py(), "keys": packed(np.diff(key, prepend=0)), "n": packed(n)}],
                                pa.schema([("grp", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())]))


def _summed_rows(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return summed([(np.cumsum(unpacked(k)), unpacked(n)) for k, n in zip(t.column("keys").to_pylist(), t.column("n").to_pylist())])


def _joint_nodes(t: pa.Table) -> pa.Table:
    key, zeros, ones, log_w = Subtree(*_summed_rows(t)).nodes()
    return pa.table({"grp": pa.array(np.full(len(key), t.column("grp")[0].as_py(), np.int64)), "node": pa.array(key),
                     "zeros": pa.array(zeros), "ones": pa.array(ones), "log_w": pa.array(log_w)})


_PREDICTED = pa.schema([("grp", pa.int64()), ("keys", pa.binary()), ("found", pa.binary())])


def _predict(sums: pa.Table, above: pa.Table) -> pa.Table:
    """log10 probabilities of all distinct pairs of a group, as one row."""
    if not sums.num_rows:
        return _PREDICTED.empty_table()
    key, n = _summed_rows(sums)
    node = np.asarray(above.column("node"))
    order = np.argsort(node)
    log_p = Subtree(key, n).log10(node[order], np.asarray(above.column("add"))[order], np.asarray(above.column("times"))[order])
    return pa.Table.from_pylist([{"grp": sums.column("grp")[0].as_py(), "keys": packed(np.diff(key, prepend=0)),
                                  "found": zipped(log_p.tobytes())}], _PREDICTED)


def _answer_pairs(asked: pa.Table, predicted: pa.Table) -> pa.Table:
    """What each of some blocks asked of a group, from the group's one row."""
    if not asked.num_rows:
        return _ANSWER.empty_table()
    key = np.cumsum(unpacked(predicted.column("keys")[0].as_py()))
    log_p = unpacked(predicted.column("found")[0].as_py(), np.float64)
    rows = zip(*(asked.column(c).to_pylist() for c in ("block", "grp", "keys")))
    return pa.Table.from_pylist([{"block": b, "kind": "p", "grp": g, "found": zipped(
        log_p[np.searchsorted(key, np.cumsum(unpacked(k)))].tobytes())} for b, g, k in rows], _ANSWER)


def _weigh(batches):
    """Adds weight, own share and estimate to summed nodes."""
    for batch in batches:
        node, zeros, ones, below = (np.asarray(c) for c in batch.columns)
        log_w, share, p1 = weighted(zeros, ones, below)
        yield pa.RecordBatch.from_pydict({"node": pa.array(node), "zeros": pa.array(zeros), "ones": pa.array(ones),
                                          "log_w": pa.array(log_w), "share": pa.array(share), "p1": pa.array(p1)})


_PARENT = "((node >> 16) << 8) | (node & 255)"


def _upper(nodes: DataFrame) -> DataFrame:
    """The nodes one depth up."""
    up = nodes.selectExpr(f"{_PARENT} node", "zeros", "ones", "log_w").groupBy("node").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_w").alias("log_w"))
    return up.select("node", "zeros", "ones", "log_w").mapInArrow(
        _weigh, "node long, zeros double, ones double, log_w double, share double, p1 double")


def _above(joint: DataFrame) -> DataFrame:
    """For every node of depth JOINT what depths JOINT - 1 to 0 contribute:
    prediction = add + times * prediction of depth JOINT."""
    out = joint.select("grp", "node", (F.col("zeros") + F.col("ones") > 0).alias("seen"), F.col("node").alias("at"),
                       F.lit(0.0).alias("add"), F.lit(1.0).alias("times"))
    level = joint
    for depth in range(JOINT - 1, -1, -1):
        level = _upper(level)
        if depth == JOINT - 1:
            level = written(level, "context_level")
        here = level.select(F.col("node").alias("at"), "share", "p1", (F.col("zeros") + F.col("ones") > 0).alias("here"))
        # depth 1 has at most 65,536 nodes and depth 0 has 255
        here = F.broadcast(here) if depth <= 1 else here
        out = out.withColumn("at", F.expr(_PARENT.replace("node", "`at`"))).join(here, "at")
        w = F.when(F.col("seen"), F.col("share")).otherwise(F.lit(1.0))
        out = out.select("grp", "node", F.col("here").alias("seen"), "at", (w * F.col("p1") + (1 - w) * F.col("add")).alias("add"),
                         ((1 - w) * F.col("times")).alias("times"))
    return out.select("grp", "node", "add", "times")


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_words", pa.int64()), ("known", pa.int64()),
                     ("log_counts", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])


def _sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sum of each text's values, which lie one after another."""
    out, ends = np.zeros(len(count)), np.cumsum(count)
    some = np.flatnonzero(count)
    if len(some):
        out[some] = np.add.reduceat(values, (ends - count)[some])
    return out


def _score(word_groups: int, pair_groups: int):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        found = {"w": {}, "p": {}}
        for kind, g, blob in zip(*(answers.column(c).to_pylist() for c in ("kind", "grp", "found"))):
            found[kind][g] = blob
        for row in block.to_pylist():
            values, held, index = text_values(row), _held(row), _Index()
            word, count = _block_words(values, index)
            words = list(index)
            index.clear()
            c = np.zeros(len(words), np.int64)
            if words:
                _, order = _word_order(words, word_groups)
                c[order] = np.concatenate([unpacked(found["w"][g]) for g in sorted(found["w"])])
            del words
            known, logs = _sums((c > 0)[word].astype(float), count), _sums(np.log10(c + 1.0)[word], count)
            key, _, _ = _block_pairs(values, held, pair_groups)
            log_p = np.concatenate([unpacked(found["p"][g], np.float64) for g in sorted(found["p"])])
            place, score = pd.Index(key), np.zeros(len(values))
            for a, b in chunks(row["size"]):
                keys, size = pair_keys(values[a:b])
                score[a:b] = _sums(log_p[place.get_indexer(keys)], size)
            out.append(pa.table([rest_columns(row)[0], pa.array(held), pa.array(count),
                                 pa.array(known.astype(np.int64)), pa.array(logs), pa.array(score),
                                 pa.array(row["size"], pa.int64())], schema=_SCORED))
        return pa.concat_tables(out) if out else _SCORED.empty_table()
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes and bits_per_byte (code length, the end mark counted as a byte)."""
    ship(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")
    rows = rows.withColumn("held", id_remainder("doc_id", FOLDS) == HELD_OUT_FOLD)
    train = rows.where(~F.col("held")).count()
    held = written(gather(rows, "text", lower=True), "context_blocks")
    total = held.select(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0]
    word_groups = max(8, -(-int(total or 0) // (12 << 20)))
    pair_groups = max(8, -(-int(total or 0) // (16 << 20)))
    asked = written(held.mapInArrow(_ask(word_groups, pair_groups), "block long, kind string, grp long, keys binary, n binary"),
                    "context_asked")
    words, pairs = asked.where("kind = 'w'"), asked.where("kind = 'p'")
    counted = written(words.groupBy("grp").applyInArrow(
        _count_words, "block long, kind string, grp long, found binary, tokens long, known long"), "context_words")
    tokens, known = counted.agg(F.sum("tokens"), F.sum("known")).first()
    n, v = (tokens or 0) + train, (known or 0) + (train > 0)
    # a frequent context comes from every block: its rows are summed over about sqrt(blocks) parts, then over the parts
    parts = max(1, math.isqrt(held.count()))
    apart = pairs.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts))).repartition(2 * pair_groups, "grp", "part")
    sums = written(apart.groupBy("grp", "part").applyInArrow(_sum_part, "grp long, keys binary, n binary"), "context_sums")
    sums = sums.repartition(2 * pair_groups, "grp")
    joint = written(sums.groupBy("grp").applyInArrow(
        _joint_nodes, "grp long, node long, zeros double, ones double, log_w double"), "context_nodes")
    predicted = sums.groupBy("grp").cogroup(_above(joint).repartition(2 * pair_groups, "grp").groupBy("grp")).applyInArrow(
        _predict, "grp long, keys binary, found binary")
    each = predicted.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))
    answered = apart.groupBy("grp", "part").cogroup(each.repartition(2 * pair_groups, "grp", "part").groupBy("grp", "part")).applyInArrow(
        _answer_pairs, "block long, kind string, grp long, found binary")
    answers = counted.select("block", "kind", "grp", "found").union(answered)
    scored = held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(word_groups, pair_groups),
        "doc_id long, held_out boolean, n_words long, known long, log_counts double, score double, n_bytes long")
    count = F.col("n_words") + 1          # the words and the end
    return scored.select(
        "doc_id", "held_out", count.alias("n_tokens"), (F.col("known") + F.lit(int(train > 0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.lit(float(np.log10(train + 1))) - count * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        "score", "n_bytes", (F.col("score") * F.lit(-float(np.log2(10))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
