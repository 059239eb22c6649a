"""Operator 8, SimHash near-duplicates by tiled exact comparison.

Fingerprints are computed per document; equal ones are one node from then on,
so exact copies, however many, cost one comparison. Two nodes are compared if
they agree in one of RADIUS + 1 bit ranges, as any two within RADIUS bits do
(pigeonhole), so nothing is missed. Within such a bucket the fingerprints are
sorted by population count and compared tile by tile with numpy exclusive-or
and bit counts; a pair of tiles whose population counts differ by more than
the radius is skipped. A bucket of more than PART nodes is cut into parts, and
each pair of parts is a group of its own. A group sends its components as stars,
never all pairs. Components come from rounds of star contraction,
each written to the shared folder.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero; with fewer words than a shingle the whole sequence is the
one shingle; repeated shingles count as often as they occur; a bit is set if
more than half of the hashes have it (an exact half: not set); the component
id is the smallest doc_id of the component, rows with a null id belong to
components too and are never named (null if no row has an id); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import appended, ship, slices, text_bytes, unused, written

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE, PART = 512, 8192
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the ASCII-lower-cased word shingles."""
    words = text.lower().split()          # bytes: A-Z and ASCII white space only
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:n - 1]])
    stops = ends[shingle - 1:] - 1
    ones, h = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, HASHES_AT_ONCE):
        part = np.array([h(joined[a:b], SEED) for a, b in zip(starts[i:i + HASHES_AT_ONCE].tolist(),
                                                             stops[i:i + HASHES_AT_ONCE].tolist())], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                fp = np.array([fingerprint(t, shingle) for t in text_bytes(part.column(1))], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, "doc_id long, fp long")


def tile_links(fp: np.ndarray, radius: int, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The links within ``fp`` (or between ``fp`` and ``other``) as stars: each
    connected node with the smallest node (as a signed number) it is connected
    to, so that later rounds start from short paths."""
    both = fp if other is None else np.concatenate([fp, other])
    side = np.zeros(len(both), bool)
    if other is not None:
        side[len(fp):] = True
    bits = np.bitwise_count(both)
    order = np.argsort(bits, kind="stable")
    both, bits, side = both[order], bits[order].astype(int), side[order]
    label = np.arange(len(both))
    for i in range(0, len(both), TILE):
        a = both[i:i + TILE]
        for j in range(i, len(both), TILE):
            if bits[j] - bits[min(i + TILE, len(both)) - 1] > radius:
                break                     # so do all later tiles
            near = np.bitwise_count(a[:, None] ^ both[None, j:j + TILE]) <= radius
            x, y = np.nonzero(near)
            x, y = x + i, y + j
            ok = x < y
            if other is not None:
                ok &= side[x] != side[y]
            _join(label, x[ok], y[ok])
    signed = both.view(np.int64)
    order = np.lexsort((signed, label))
    first = np.flatnonzero(np.r_[True, label[order][1:] != label[order][:-1]]) if len(order) else order
    root = np.repeat(order[first], np.diff(np.r_[first, len(order)]))
    far = signed[order] != signed[root]
    return both[order[far]], both[root[far]]


def _join(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give the ends of each link (x, y), and all nodes that share a label
    with them, one label."""
    while True:
        lx, ly = label[x], label[y]
        open_ = lx != ly
        if not open_.any():
            return
        x, y, lx, ly = x[open_], y[open_], lx[open_], ly[open_]
        low, high = np.minimum(lx, ly), np.maximum(lx, ly)
        parent = np.arange(len(label))
        np.minimum.at(parent, high, low)
        while True:
            jumped = parent[parent]
            if (jumped == parent).all():
                break
            parent = jumped
        label[:] = parent[label]


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: pairs of distinct fingerprints of ``nodes`` (column fp) that are
    connected, enough of them to connect whatever is."""
    spark = nodes.sparkSession
    ship(spark)
    ranges = radius + 1
    edges = [64 * i // ranges for i in range(ranges + 1)]
    keys = F.array(*[F.struct(F.lit(i).alias("r"), F.shiftrightunsigned("fp", edges[i]).bitwiseAND(
        F.lit((1 << (edges[i + 1] - edges[i])) - 1)).alias("key")) for i in range(ranges)])
    rows = nodes.select("fp", F.explode(keys).alias("k")).select("fp", "k.r", "k.key")
    large = rows.groupBy("r", "key").count().where(F.col("count") > PART).select(
        "r", "key", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    rows = rows.join(large, ["r", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # a part meets every part of its bucket, itself included
    rows = rows.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("r", "key", F.least("part", "mate").alias("i"), F.greatest("part", "mate").alias("j"), "part", "fp")
    rows = rows.repartition("r", "key", "i", "j").sortWithinPartitions("r", "key", "i", "j", "part")

    def compare(cols: list[np.ndarray]):
        r, key, i, j, part, fp = cols
        cut = np.flatnonzero((r[1:] != r[:-1]) | (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        out_a, out_b = [], []
        for s, e in zip(np.r_[0, cut], np.r_[cut, len(fp)]):
            if e - s < 2:
                continue
            f = fp[s:e].view(np.uint64)
            if i[s] == j[s]:
                a, b = tile_links(f, radius)
            else:
                left = part[s:e] == i[s]
                a, b = tile_links(f[left], radius, f[~left])
            out_a.append(a)
            out_b.append(b)
        a = np.concatenate(out_a) if out_a else np.zeros(0, np.uint64)
        b = np.concatenate(out_b) if out_b else np.zeros(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches):
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.asarray(c) for c in batch.columns]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            same = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1]) & (held[3] == held[3][-1])
            done = int(np.argmax(same))       # the last group may go on in the next batch
            if done:
                yield compare([c[:done] for c in held])
                held = [c[done:] for c in held]
        if held is not None:
            yield compare(held)

    return rows.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node of
    ``edges`` (a, b): alternating large and small stars until nothing changes."""
    both = edges.where("a <> b").selectExpr("greatest(a, b) u", "least(a, b) v").distinct()
    both, step, before = written(both, "star0"), 0, None
    while True:
        pairs = both.select("u", "v").union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = pairs.join(low, "u").where("v > u").selectExpr("v u", "m v").where("u <> v").distinct()
        # small star: every node with its smaller neighbours, all to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").selectExpr("v u", "m v").union(least.selectExpr("u", "m v"))
        step += 1
        both = written(small.where("u <> v").distinct(), f"star{step}")
        # a fixed point of both stars: same links again
        now = both.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return both.selectExpr("u node", "v label").union(both.selectExpr("v node", "v label").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp (signed long), component_id."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash_nodes")
    label = components(links(nodes.select("fp"), radius))
    member = nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    top = member.groupBy("label").agg(F.min("rep").alias("component_id"))
    placed = member.join(top, "label").select("fp", "component_id")
    return rows.join(placed, "fp").select("doc_id", "fp", "component_id")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, whole, with the columns of ``docs``: the one
    with the smallest id (a null id last), then the smallest digest of the
    text, then the first as read. Components rest on texts alone, so rows that
    share an id stay if their texts differ, and copies without an id go."""
    fp, row = unused(docs, "_fp"), unused(docs, "_row")
    made = appended(docs.withColumn(row, F.monotonically_increasing_id()), fp, "long", text_col, lambda texts: pa.array(
        np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)))
    held = written(made, "simhash_documents")
    ident = F.col(f"`{id_col}`")
    order = F.struct(ident.isNull().alias("unnamed"), ident.alias("id"),
                     F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256).alias("text"), F.col(row).alias("row"))
    nodes = written(held.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("best")), "simhash_nodes")
    label = components(links(nodes.select("fp"), radius))
    member = nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left")
    kept = member.groupBy(F.coalesce("label", "fp").alias("label")).agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    return held.join(kept, row, "left_semi").select(*[f"`{c}`" for c in docs.columns])
