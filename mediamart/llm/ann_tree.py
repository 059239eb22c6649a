"""Operator 7, approximate nearest neighbours over a hierarchical k-means tree.

The tree (spherical k-means, split until a node holds few rows of the sample)
is fitted on a bounded sample; every row is then indexed under its leaf. A
query walks the tree best-bin-first: a priority queue holds the nodes not yet
opened, nearest centre first, and the leaves come out in that order. How many
leaves a query visits is widened until, of the calibration queries whose true
neighbours are known exactly, the wanted share reach the wanted recall each. A
query whose leaves hold too few rows for k others goes on to further leaves.
Each visited leaf is searched exactly, in double precision, on the original
vectors.

Parameters with a bound: FIT_ROWS (sample for the tree), CALIBRATION_QUERIES.
Every row is indexed and every query is answered. Neighbouring leaves share a
block of about LEAF_BLOCK rows, and a query is sent once to each block in which
it visits leaves, with their numbers; there it looks into those leaves only. A
leaf with more rows (a repeated vector may hold a third of all) is a block of
its own, cut into salted parts, and so are the queries that visit a block.

Defined cases: rows with a null id, and vectors that are null, empty, zero or
hold a null or non-finite component, take no part; repeated rows of an id
count once; a query never finds its own id; vectors of another length than
the most frequent one in the sample are searched exactly among themselves;
equal scores go to the smaller id; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediamart.llm.common import matrix, ship, valid_vectors, written

FIT_ROWS, CALIBRATION_QUERIES = 20_000, 256
BRANCH, LEAF_SAMPLE, MAX_LEAVES = 8, 24, 1024
LEAF_BLOCK, QUERY_BLOCK = 4096, 4096
TARGET_RECALL = 0.95


class Tree:
    """Nodes in arrays; ``children[i]`` is empty for a leaf, whose number is
    ``leaf[i]``. ``dim`` other than the tree's own falls into leaf -1."""

    def __init__(self, dim: int):
        self.dim, self.centers, self.children, self.leaf, self.leaves = dim, [], [], [], 0

    @classmethod
    def fit(cls, rows: np.ndarray, leaf_rows: int, seed: int = 7) -> Tree:
        tree, rng = cls(rows.shape[1]), np.random.default_rng(seed)
        unit = _unit(rows)

        def grow(part: np.ndarray) -> int:
            node = len(tree.centers)
            tree.centers.append(unit[part].mean(0) if len(part) else np.zeros(tree.dim))
            tree.children.append([])
            tree.leaf.append(-1)
            groups = _split(unit, part, rng) if len(part) > leaf_rows else []
            if len(groups) < 2:
                tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
            else:
                tree.children[node] = [grow(g) for g in groups]
            return node

        grow(np.arange(len(unit)))
        tree.centers = _unit(np.array(tree.centers))
        return tree

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of every row: down the nearest centres."""
        unit, out = _unit(rows), np.empty(len(rows), np.int32)
        work = [(0, np.arange(len(rows)))]
        while work:
            node, part = work.pop()
            kids = self.children[node]
            if not kids:
                out[part] = self.leaf[node]
                continue
            near = np.argmax(unit[part] @ self.centers[kids].T, axis=1)
            work += [(kid, part[near == j]) for j, kid in enumerate(kids) if (near == j).any()]
        return out

    def visit(self, row: np.ndarray, most: int, size: np.ndarray | None = None, need: int = 0) -> list[int]:
        """The first ``most`` leaves, best bin first, and the next ones until
        all together hold ``need`` rows (``size``: rows indexed under each)."""
        unit, queue, out, held = _unit(row[None])[0], [(0.0, 0)], [], 0
        while queue and (len(out) < most or size is not None and held < need):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if kids:
                for far, kid in zip((-(self.centers[kids] @ unit)).tolist(), kids):
                    heapq.heappush(queue, (far, kid))
            else:
                out.append(self.leaf[node])
                held += 0 if size is None else int(size[self.leaf[node]])
        return out


def _unit(rows: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so that squares stay finite
    top = np.abs(rows).max(axis=1, keepdims=True, initial=0)
    rows = rows / np.where(top > 0, top, 1)
    norm = np.sqrt((rows * rows).sum(1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def _split(unit: np.ndarray, part: np.ndarray, rng) -> list[np.ndarray]:
    """k-means of a node's rows; fewer than two groups if all rows are alike."""
    rows = unit[part]
    centers = rows[rng.choice(len(rows), min(BRANCH, len(rows)), replace=False)]
    for _ in range(12):
        near = np.argmax(rows @ centers.T, axis=1)
        fresh = np.array([rows[near == j].mean(0) if (near == j).any() else centers[j] for j in range(len(centers))])
        fresh = _unit(fresh)
        if np.allclose(fresh, centers):
            break
        centers = fresh
    near = np.argmax(rows @ centers.T, axis=1)
    return [part[near == j] for j in range(len(centers)) if (near == j).any()]


def leaf_blocks(size: np.ndarray, limit: int) -> np.ndarray:
    """Block of every leaf: runs of neighbouring leaves of at most ``limit``
    rows together; a larger leaf is a block of its own."""
    out, block, held = np.zeros(len(size), np.int64), 0, 0
    for leaf, n in enumerate(size.tolist()):
        if held and held + n > limit:
            block, held = block + 1, 0
        out[leaf] = block
        held += n
    return out


def nearest(q_ids, q, c_ids, c, k: int, seen: np.ndarray | None = None):
    """Exact (query, candidate, cosine) of the k nearest; equal scores by id.
    ``seen``: which candidates each query looks at (default: all).
    The matrix product only narrows; scores are computed row by row, so that
    equal vectors get equal scores whatever their block."""
    qn, cn = np.sqrt((q * q).sum(1)), np.sqrt((c * c).sum(1))
    rough = (q / qn[:, None]) @ (c / cn[:, None]).T
    rough[q_ids[:, None] == c_ids[None, :]] = -np.inf
    if seen is not None:
        rough[~seen] = -np.inf
    out = []
    for i in range(len(q)):
        s = rough[i]
        kth = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
        at = np.flatnonzero((s >= kth - 1e-9) & (s > -np.inf))
        exact = (c[at] * q[i]).sum(1) / (qn[i] * cn[at])
        first = np.lexsort((c_ids[at], -exact))[:k]
        out.append((np.full(len(first), q_ids[i]), c_ids[at[first]], exact[first]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _exact(rows: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """Brute force for a bounded set of queries held in the closure."""
    def run(batches):
        for batch in batches:
            v = batch.column(1)
            ok = np.asarray(pa.compute.list_value_length(v)) == q.shape[1]
            c = matrix(v.filter(pa.array(ok)))
            if len(c):
                a, b, s = nearest(q_ids, q, np.asarray(batch.column(0))[ok], c, k)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(a), "vec_id": pa.array(b), "score": pa.array(s)})
    return _ranked(rows.select("vec_id", "v").mapInArrow(run, "query_id long, vec_id long, score double"), k)


def _sample(rows: DataFrame, total: int, n: int) -> tuple[np.ndarray, list]:
    """About n rows chosen by a hash of the id, whatever the partitions."""
    share = min(1.0, n / max(total, 1))
    chosen = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < F.lit(share * 1_000_003)).limit(2 * n)
    got = chosen.select("vec_id", "v").collect()
    got.sort(key=lambda r: r[0])
    return np.array([r[0] for r in got], np.int64), [r[1] for r in got]


def leaves_needed(depths: list[list[int]], target: float) -> int:
    """How many leaves to visit, so that a share ``target`` of the queries find
    a share ``target`` of their own neighbours; ``depths`` has for each query
    the places, in its order of visits, of the leaves with its neighbours."""
    at = lambda x: sorted(x)[max(0, int(np.ceil(target * len(x))) - 1)]
    return 1 + at([at(x) for x in depths])


def search(vectors: DataFrame, k: int = 5, query_mod: int = 50, id_col: str = "vec_id",
           vec_col: str = "embedding", target: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank, vec_id, score (cosine) for every row whose id is
    divisible by ``query_mod``, against all rows."""
    spark = vectors.sparkSession
    ship(spark)
    rows = written(valid_vectors(vectors, id_col, vec_col, zero_ok=False), "ann_vectors")
    total = rows.count()
    _, fit = _sample(rows, total, FIT_ROWS)
    dims = np.array([len(v) for v in fit], int)
    dim = int(np.bincount(dims).argmax()) if len(dims) else 1
    kept = np.array([v for v in fit if len(v) == dim], float).reshape(-1, dim)
    tree = Tree.fit(kept, max(LEAF_SAMPLE, -(-2 * len(kept) // MAX_LEAVES)))

    # calibration: exact neighbours of some queries, and how many leaves each needs
    near_k = max(k, 5)
    cal = rows.where((F.col("vec_id") % query_mod == 0) & (F.size("v") == dim))
    cal_ids, cal_v = _sample(cal, -(-total // query_mod), CALIBRATION_QUERIES)
    visits = tree.leaves
    if len(cal_ids):
        cal_v = np.array(cal_v, float)
        truth = _exact(rows, cal_ids, cal_v, near_k).select("query_id", "vec_id")
        truth = truth.join(rows, "vec_id").select("query_id", "v").collect()  # at most CALIBRATION_QUERIES * 2k rows
        order = {i: {leaf: n for n, leaf in enumerate(tree.visit(v, tree.leaves))} for i, v in zip(cal_ids.tolist(), cal_v)}
        if truth:
            leaf = tree.assign(np.array([r[1] for r in truth], float))
            depths: dict[int, list[int]] = {}
            for r, x in zip(truth, leaf):
                depths.setdefault(r[0], []).append(order[r[0]][int(x)])
            visits = leaves_needed(list(depths.values()), target)

    def index(batches):
        for batch in batches:
            v = batch.column(1)
            ok = np.asarray(pa.compute.list_value_length(v)) == dim
            leaf = np.full(batch.num_rows, -1, np.int32)
            if ok.any():
                leaf[ok] = tree.assign(matrix(v.filter(pa.array(ok))))
            yield pa.RecordBatch.from_arrays([batch.column(0), v, pa.array(leaf)], names=["vec_id", "v", "leaf"])

    indexed = written(rows.select("vec_id", "v").mapInArrow(index, "vec_id long, v array<double>, leaf int"), "ann_index")
    rows_of = dict(indexed.groupBy("leaf").count().collect())                      # a row per leaf
    size = np.array([rows_of.get(leaf, 0) for leaf in range(tree.leaves)], np.int64)
    block = leaf_blocks(size, LEAF_BLOCK)

    def route(batches):
        for batch in batches:
            ids, v, to, leaves = [], [], [], []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # k rows and the query's own, which it does not find
                at = np.sort(tree.visit(np.array(x, float), visits, size, k + 1)) if len(x) == dim else np.array([-1])
                home = block[at] if len(x) == dim else np.array([-1])
                cut = np.flatnonzero(np.r_[True, home[1:] != home[:-1]])
                ids += [i] * len(cut)
                v += [x] * len(cut)
                to += home[cut].tolist()
                leaves += [part.tolist() for part in np.split(at, cut[1:])]
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(ids, pa.int64()), "v": pa.array(v, pa.list_(pa.float64())),
                "blk": pa.array(to, pa.int64()), "leaves": pa.array(leaves, pa.list_(pa.int32()))})

    asked = written(rows.where(F.col("vec_id") % query_mod == 0).select("vec_id", "v").mapInArrow(
        route, "vec_id long, v array<double>, blk long, leaves array<int>"), "ann_routes")
    # a row per leaf, in total MAX_LEAVES * BRANCH at most
    held = {-1: rows_of.get(-1, 0)}
    for leaf, n in enumerate(size.tolist()):
        held[int(block[leaf])] = held.get(int(block[leaf]), 0) + n
    home = spark.createDataFrame([(-1, -1)] + [(leaf, int(b)) for leaf, b in enumerate(block)], "leaf int, blk long")
    cs = spark.createDataFrame([(b, max(1, -(-n // LEAF_BLOCK))) for b, n in held.items()], "blk long, cs int")
    qs = asked.groupBy("blk").agg((F.floor((F.count(F.lit(1)) - 1) / QUERY_BLOCK) + 1).cast("int").alias("qs"))
    cuts = F.broadcast(cs.join(qs, "blk"))
    here = F.pmod(F.xxhash64("vec_id"), F.col("cs")).cast("int")
    mine = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("qs")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = indexed.join(F.broadcast(home), "leaf").join(cuts, "blk").select(
        "vec_id", "v", "leaf", "blk", here.alias("c"), every("qs").alias("q"))
    right = asked.join(cuts, "blk").select("vec_id", "v", "leaves", "blk", every("cs").alias("c"), mine.alias("q"))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def score(c: pa.Table, q: pa.Table) -> pa.Table:
        got = []
        if c.num_rows and q.num_rows:
            c = c.sort_by("leaf")
            cv, qv = c.column("v").combine_chunks(), q.column("v").combine_chunks()
            cd, qd = (np.asarray(pa.compute.list_value_length(x)) for x in (cv, qv))
            leaf, visited = np.asarray(c.column("leaf")), q.column("leaves").to_pylist()
            visited = np.array([len(x) for x in visited]), np.concatenate([np.array(x, np.int64) for x in visited])
            low = int(min(leaf[0], visited[1].min()))
            looks = np.zeros((q.num_rows, int(max(leaf[-1], visited[1].max())) - low + 1), bool)
            looks[np.repeat(np.arange(q.num_rows), visited[0]), visited[1] - low] = True
            first = np.argmax(looks, axis=1)      # queries that begin at one leaf go together
            for d in np.intersect1d(cd, qd):      # one length, but for leaf -1
                ci, qi = np.flatnonzero(cd == d), np.flatnonzero(qd == d)
                qi = qi[np.argsort(first[qi], kind="stable")]
                cm, cid = matrix(cv.take(pa.array(ci))), np.asarray(c.column("vec_id"))[ci]
                qm, qid = matrix(qv.take(pa.array(qi))), np.asarray(q.column("vec_id"))[qi]
                for i in range(0, len(qm), 256):
                    seen = looks[qi[i:i + 256]][:, leaf[ci] - low]
                    any_of = seen.any(axis=0)
                    if any_of.any():
                        got.append(nearest(qid[i:i + 256], qm[i:i + 256], cid[any_of], cm[any_of], k, seen[:, any_of]))
        if not got:
            return out.empty_table()
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*got)], schema=out)

    found = left.groupBy("blk", "c", "q").cogroup(right.groupBy("blk", "c", "q")).applyInArrow(
        score, "query_id long, vec_id long, score double")
    return _ranked(found, k)
