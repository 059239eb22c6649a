"""Operator 11, the trie of conversation prefixes, by parallel tree contraction.

A conversation is its turns by (turn, role, text), nulls first in turn, null
role or text as empty. ``rebuild`` gives each conversation the first turns of
another one and then its own later ones; ``trie`` finds the distinct prefixes
of such sequences and, for each, totals over its subtree.

- Places in a conversation and the sums that name its prefixes are running
  sums in two steps: within a chunk (a conversation's rows in one range
  partition) and over chunks. No task has to hold one long conversation.
- A prefix is named by 128 bits: the sums, over its turns, of hashes of (place,
  role, text). Equal names are taken as equal prefixes.
- Contraction: rounds of compress and rake. Compress takes every chain of nodes
  with one child out by pointer jumping (joins, the distance doubles each
  time), noting for each node its chain's end and the sum on the way. Rake
  adds all leaves to their parents. A round at least halves the leaves, as
  after compress every inner node has two children or more. Then the rounds
  are gone through backwards: a contracted node's total is its end's total
  plus the noted sum.

Every state is written below the shared folder, so lineage stays short and a
lost executor costs one step.

Defined cases: rows without conv_id take no part; repeated rows are turns of
their own, ties follow role and text; a conversation may be rebuilt without
turns and ends at the root then; other columns are ignored; texts count whole;
an empty table has no conversation, so no root, and gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamart.llm.common import ship, written

#: Depths that come from the other conversation: 0 to HEADS - 1, by the id's crc32.
FAMILY, HEADS = 5, 9
CHUNK_SHIFT = 33           # monotonically_increasing_id: partition number above, row number below
TEXT_BYTES = 1 << 20       # of decimal ids in a row while digests are made
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _hash(seed: int, *columns) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, chunk, place (from 1), t0, t1 (128 bits of role and text),
    size (bytes of the text), written in chunks of range partitions."""
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key).select(
        "conv_id", F.monotonically_increasing_id().alias("at"), _hash(1, "role", "text").alias("t0"),
        _hash(2, "role", "text").alias("t1"), F.octet_length("text").cast("long").alias("size"))
    rows = written(rows, "trie_turns").withColumn("chunk", F.shiftright("at", CHUNK_SHIFT))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv_id", "chunk", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(chunks, ["conv_id", "chunk"]).select(
        "conv_id", "chunk", (F.col("at") - F.col("first") + F.col("before") + 1).alias("place"), "t0", "t1", "size")


def rebuild(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, chunk, depth, length, t0, t1, size) and all
    conversations (conv_id, length): the first h = crc32(id) % heads turns of
    conversation id - id % family, then its own after the first h."""
    own = written(ordered(turns), "trie_places")
    counts = own.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    convs = counts.groupBy("conv_id").agg(F.sum("n").alias("n")).select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    head = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", head.alias("head"), (head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = written(convs, "trie_convs")
    # a conversation's plan reaches its turns by (conversation, chunk), so a long one is no single key
    plan = counts.select("conv_id", "chunk").join(convs.select("conv_id", "h", "head", "length"), "conv_id")
    tail = own.join(plan, ["conv_id", "chunk"]).where(F.col("place") > F.col("h")).select(
        "conv_id", "chunk", (F.col("place") - F.col("h") + F.col("head")).alias("depth"), "length", "t0", "t1", "size")
    first = own.where(F.col("place") < heads).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "t0", "t1", "size")
    front = convs.where("head > 0").join(first, "base").where(F.col("depth") <= F.col("head")).select(
        "conv_id", F.lit(-1).cast("long").alias("chunk"), "depth", "length", "t0", "t1", "size")
    return front.unionByName(tail), convs.select("conv_id", "length")


_LANES = ["s0", "s1", "s2", "s3"]


def _named(depth: Column, lanes: list[Column], seed: int) -> Column:
    return _hash(seed, depth, *lanes)


def prefixes(turns: DataFrame) -> DataFrame:
    """Each rebuilt turn as the prefix that it ends: conv_id, depth, length,
    size, its name (k0, k1) and its parent's (p0, p1)."""
    low = F.lit(0xFFFFFFFF)
    hashed = turns.select("*", _hash(3, "depth", "t0", "t1").alias("x"), _hash(4, "depth", "t0", "t1").alias("y"))
    hashed = hashed.select("conv_id", "chunk", "depth", "length", "size", *[
        e.alias(n) for n, e in zip(["g0", "g1", "g2", "g3"], (
            F.shiftrightunsigned("x", 32), F.col("x").bitwiseAND(low), F.shiftrightunsigned("y", 32), F.col("y").bitwiseAND(low)))])
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = hashed.groupBy("conv_id", "chunk").agg(*[F.sum(f"g{i}").alias(f"b{i}") for i in range(4)])
    chunks = chunks.select("conv_id", "chunk", *[F.coalesce(F.sum(f"b{i}").over(before), F.lit(0)).alias(f"b{i}") for i in range(4)])
    summed = hashed.select("*", *[F.sum(f"g{i}").over(inside).alias(f"r{i}") for i in range(4)])
    summed = summed.join(chunks, ["conv_id", "chunk"])
    now = [F.col(f"r{i}") + F.col(f"b{i}") for i in range(4)]
    prior = [F.col(f"r{i}") + F.col(f"b{i}") - F.col(f"g{i}") for i in range(4)]
    depth, above = F.col("depth"), F.col("depth") - 1
    return summed.select("conv_id", "depth", "length", "size", _named(depth, now, 5).alias("k0"), _named(depth, now, 6).alias("k1"),
                         _named(above, prior, 5).alias("p0"), _named(above, prior, 6).alias("p1"))


def nodes_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """node, parent (null: root), conv_id (smallest member), depth, n_convs,
    own (what its last text saves) and the name, written."""
    zero = [F.lit(0).cast("long")] * 5
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), _named(zero[0], zero[1:], 5).alias("k0"), _named(zero[0], zero[1:], 6).alias("k1"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("size"), F.lit(None).cast("long").alias("p0"), F.lit(None).cast("long").alias("p1"))
    rest = paths.groupBy("depth", "k0", "k1").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"),
        F.min("p0").alias("p0"), F.min("p1").alias("p1"))
    named = written(root.unionByName(rest).withColumn("node", F.monotonically_increasing_id()), "trie_named")
    above = named.select(F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return written(named.join(above, ["p0", "p1"], "left").select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("size")).alias("own"), "k0", "k1"),
        "trie_nodes")


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """node and, for each of ``values``, its sum over the node's subtree, of a
    forest ``tree`` (node, parent: null for a root, values as longs)."""
    def plus(a: list[str], b: list[str], names: list[str]) -> list[Column]:
        return [(F.col(x) + F.col(y)).alias(n) for x, y, n in zip(a, b, names)]

    extra, carried = [f"extra_{v}" for v in values], [f"sum_{v}" for v in values]
    kids = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    # extra: what lies between a node and its live parent
    live = written(tree.join(kids, "node", "left").select(
        "node", "parent", F.coalesce("kids", F.lit(0)).alias("kids"), *values, *[F.lit(0).cast("long").alias(e) for e in extra]), "trie_live")
    chains, raked = [], []
    while not live.isEmpty():
        unary = live.where("kids = 1 AND parent IS NOT NULL")
        below = live.select(F.col("node").alias("end"), F.col("parent").alias("node"), F.col("kids").alias("end_kids"),
                            *[F.col(e).alias(f"{e}_end") for e in extra])
        # a node of a chain: where it points, the sum on the way, whether the chain goes on there
        link = unary.join(below, "node").select(
            "node", "end", (F.col("end_kids") == 1).alias("goes_on"), *plus(values, [f"{e}_end" for e in extra], carried))
        link = written(link, "trie_link")
        while not link.where("goes_on").isEmpty():
            far = link.select(F.col("node").alias("end"), F.col("end").alias("far"), F.col("goes_on").alias("far_goes_on"),
                              *[F.col(c).alias(f"{c}_far") for c in carried])
            jumped = link.where("goes_on").join(far, "end").select(
                "node", F.col("far").alias("end"), F.col("far_goes_on").alias("goes_on"),
                *plus(carried, [f"{c}_far" for c in carried], carried))
            link = written(link.where("NOT goes_on").unionByName(jumped), "trie_link")
        # a chain's end takes the place of its top
        tops = unary.join(unary.select(F.col("node").alias("parent")), "parent", "left_anti").join(link, "node").select(
            F.col("end").alias("node"), F.col("parent").alias("new_parent"), *plus(extra, carried, [f"{e}_new" for e in extra]))
        live = live.where("kids <> 1 OR parent IS NULL").join(tops, "node", "left").select(
            "node", F.coalesce("new_parent", "parent").alias("parent"), "kids", *values,
            *[F.coalesce(f"{e}_new", e).alias(e) for e in extra])
        live = written(live, "trie_compressed")
        leaves = live.where("kids = 0")
        raked.append(leaves.select("node", *values))
        chains.append(link)
        given = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count(F.lit(1)).alias("gone"), *[F.sum(F.col(v) + F.col(e)).alias(f"{v}_given") for v, e in zip(values, extra)])
        live = written(live.where("kids > 0").join(given, "node", "left").select(
            "node", "parent", (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"),
            *[(F.col(v) + F.coalesce(f"{v}_given", F.lit(0))).alias(v) for v in values], *extra), "trie_live")
    if not raked:
        return tree.select("node", *values)
    known = reduce(DataFrame.unionByName, raked)
    for link in reversed(chains):
        at_end = known.select(F.col("node").alias("end"), *values)
        known = known.unionByName(written(link.join(at_end, "end").select("node", *plus(values, carried, values)), "trie_expanded"))
    return known


def end_digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256: digest of the ascending decimal conv_ids of (node,
    conv_id). Range partitions write the ids as text; a node's digest then is
    taken from its runs of text in order, one at a time."""
    ship(ends.sparkSession)

    def text(batches):
        node, first, held, size = None, None, [], 0

        def row():
            return pa.RecordBatch.from_pydict({"node": [node], "first": [first], "ids": [",".join(held)]},
                                              schema=pa.schema([("node", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))

        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (n != node or size > TEXT_BYTES):
                    yield row()
                    held, size = [], 0
                if not held:
                    node, first = n, c
                held.append(str(c))
                size += len(held[-1]) + 1
        if held:
            yield row()

    def digest(batches):
        node, sha = None, None
        for batch in batches:
            out = []
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if n != node:
                    if sha is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = n, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield _digests(out)
        if sha is not None:
            yield _digests([(node, sha.hexdigest())])

    def _digests(out):
        return pa.RecordBatch.from_pydict({"node": [n for n, _ in out], "ends_sha256": [s for _, s in out]},
                                          schema=pa.schema([("node", pa.int64()), ("ends_sha256", pa.string())]))

    runs = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    runs = runs.mapInArrow(text, "node long, first long, ids string")
    return runs.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node long, ends_sha256 string")


def trie(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    rebuilt, convs = rebuild(turns, family, heads)
    paths = written(prefixes(rebuilt), "trie_paths")
    nodes = nodes_of(paths, convs)
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie_with_children")
    sums = subtree_sums(nodes.select("node", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                                     F.col("own").alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    inner = paths.where("depth = length").join(nodes.select("node", "k0", "k1"), ["k0", "k1"]).select("node", paths["conv_id"])
    root = nodes.where("depth = 0").select("node").first()
    turnless = convs.where("length = 0").select(F.lit(root and root.node).cast("long").alias("node"), "conv_id")
    digests = end_digests(inner.unionByName(turnless))
    return nodes.drop("k0", "k1").join(sums, "node").join(digests, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
