"""Operator 10, exact top-k search by distributed histogram selection.

Every component x becomes floor(1024 * x) in double precision; the score of a
pair is the integer inner product. Queries and candidates are packed into
blocks of bounded size; candidate blocks are dealt out by salts and every query
block is sent to each salt (an equi-join on the salt, the stated query set
against all rows). Each pass scores every pair and counts, for each
query, how many scores fall into each bin of its current range; the bin that
holds the k-th value becomes the range of the next pass, until a bin is one
integer wide. A last pass keeps the scores above the k-th value and, of those
equal to it, the smallest ids.

Defined cases: rows with a null id or a vector that is null, empty or holds a
null or non-finite component take no part; repeated rows of an id count once;
vectors are compared with vectors of their own length only; a query never
finds its own id; fewer candidates than k: all are returned; ties go to the
smaller id; scores beyond the range of a long saturate; an empty table gives
an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediamart.llm.common import matrix, ship, valid_vectors, written

QUERY_BLOCK, CANDIDATE_BLOCK, BINS = 1024, 4096, 1024
LONG = 1 << 61


def _quantised(mat: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(mat * 1024.0), -(2.0 ** 62), 2.0 ** 62)


def _packed(rows: DataFrame, block: int) -> DataFrame:
    """Blocks of at most ``block`` vectors of one length: dim, blk, ids, mat."""
    n = F.col("vec_id").alias("vec_id")

    def pack(batches):
        for batch in batches:
            v = batch.column(1)
            dims = np.asarray(pa.compute.list_value_length(v))
            ids = np.asarray(batch.column(0))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for i in range(0, len(at), block):
                    part = at[i:i + block]
                    mat = matrix(v.take(pa.array(part)))
                    yield pa.RecordBatch.from_pydict({
                        "dim": pa.array([int(dim)], pa.int32()), "blk": pa.array([int(ids[part[0]])], pa.int64()),
                        "ids": pa.array([ids[part].astype(np.int64).tobytes()], pa.binary()),
                        "mat": pa.array([_quantised(mat).tobytes()], pa.binary())})

    return rows.select(n, "v").mapInArrow(pack, "dim int, blk long, ids binary, mat binary")


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products, exact at any magnitude (saturating at a long)."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in c], object).T
    return np.clip(exact, -LONG, LONG).astype(np.int64)


def _pairs(batches):
    for batch in batches:
        for r in batch.to_pylist():
            dim = r["dim"]
            q = np.frombuffer(r["q_mat"]).reshape(-1, dim)
            c = np.frombuffer(r["mat"]).reshape(-1, dim)
            qid, cid = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
            yield r, qid, cid, _scores(q, c), cid[None, :] == qid[:, None]


def _histogram(batches):
    """Counts by (query, bin) of this task, summed before they are sent."""
    held: dict[bytes, tuple] = {}

    def rows(qid, counts):
        i, b = np.nonzero(counts)
        return pa.RecordBatch.from_pydict({"query_id": pa.array(qid[i]), "bin": pa.array(b.astype(np.int32)),
                                           "n": pa.array(counts[i, b])})

    for r, qid, cid, s, own in _pairs(batches):
        lo, width = np.frombuffer(r["lo"], np.int64)[:, None], np.frombuffer(r["width"], np.int64)[:, None]
        at = (s - lo) // width
        ok = (s >= lo) & (s < np.frombuffer(r["hi"], np.int64)[:, None]) & ~own
        row = np.broadcast_to(np.arange(len(qid))[:, None], s.shape)[ok]
        counts = np.bincount(row * BINS + at[ok], minlength=len(qid) * BINS).reshape(-1, BINS)
        if r["q_ids"] in held:
            held[r["q_ids"]][1][:] += counts
        else:
            held[r["q_ids"]] = (qid, counts)
        if len(held) > 4:
            yield rows(*held.pop(next(iter(held))))
    for x in held.values():
        yield rows(*x)


def _best(k: int):
    def run(batches):
        for r, qid, cid, s, own in _pairs(batches):
            kth = np.frombuffer(r["lo"], np.int64)
            for i in range(len(qid)):
                at = np.flatnonzero((s[i] >= kth[i]) & ~own[i])
                at = at[np.lexsort((cid[at], -s[i][at]))][:k]
                if len(at):
                    yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.full(len(at), qid[i])),
                                                      "vec_id": pa.array(cid[at]), "score": pa.array(s[i][at])})
    return run


def top_k(vectors: DataFrame, k: int = 10, query_mod: int = 100, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row
    whose id is divisible by ``query_mod``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = written(valid_vectors(vectors, id_col, vec_col, zero_ok=True), "topk_vectors")
    total, largest = rows.agg(F.count(F.lit(1)), F.max(F.aggregate(
        F.transform("v", lambda x: F.pow(F.floor(x * 1024.0).cast("double"), F.lit(2.0))), F.lit(0.0), lambda a, b: a + b))).first()
    largest = math.sqrt(largest or 0.0)
    salts = max(2, min(spark.sparkContext.defaultParallelism * 4, -(-total // CANDIDATE_BLOCK)))
    queries = rows.where(F.col("vec_id") % query_mod == 0)
    n_queries = queries.count()
    n_qb = max(1, -(-n_queries // QUERY_BLOCK))
    # |score| <= norm(q) * largest norm; one more on each side
    norm = F.sqrt(F.aggregate(F.transform("v", lambda x: F.pow(F.floor(x * 1024.0).cast("double"), F.lit(2.0))),
                              F.lit(0.0), lambda a, b: a + b))
    reach = F.ceil(F.least(norm * F.lit(largest) * 1.000001 + 1.0, F.lit(float(LONG))))
    state = written(queries.select(
        "vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(n_qb)).alias("qb"), (-reach).cast("long").alias("lo"),
        (reach + 1).cast("long").alias("hi"),
        (F.floor(reach / (BINS / 2)) + 1).cast("long").alias("width"), F.lit(k).cast("long").alias("need")), "topk_state")
    candidates = written(_packed(rows.repartition(F.pmod(F.xxhash64("vec_id"), F.lit(salts))), CANDIDATE_BLOCK)
                         .withColumn("salt", F.pmod(F.xxhash64("blk", "dim"), F.lit(salts))), "topk_blocks")

    def blocks(state):
        def pack(t: pa.Table) -> pa.Table:
            v = t.column("v").combine_chunks()
            dims = np.asarray(pa.compute.list_value_length(v))
            ids, out = np.asarray(t.column("vec_id")), []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for i in range(0, len(at), QUERY_BLOCK):
                    part = at[i:i + QUERY_BLOCK]
                    col = {c: np.asarray(t.column(c))[part].astype(np.int64).tobytes() for c in ("lo", "hi", "width")}
                    out.append({"qb": t.column("qb")[0].as_py(), "dim": int(dim), "q_ids": ids[part].astype(np.int64).tobytes(),
                                "q_mat": _quantised(matrix(v.take(pa.array(part)))).tobytes(), **col})
            return pa.Table.from_pylist(out, pa.schema([("qb", pa.int64()), ("dim", pa.int32()), ("q_ids", pa.binary()),
                                                        ("q_mat", pa.binary()), ("lo", pa.binary()), ("hi", pa.binary()),
                                                        ("width", pa.binary())]))
        packed = state.groupBy("qb").applyInArrow(pack, "qb long, dim int, q_ids binary, q_mat binary, lo binary, hi binary, width binary")
        return packed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))

    def joined(state):
        # the query blocks go to the candidates, which move once a pass however many queries there are
        return blocks(state).join(candidates.hint("merge"), ["dim", "salt"]).select(
            "qb", "dim", "ids", "mat", "q_ids", "q_mat", "lo", "hi", "width")

    width = int(state.agg(F.max("width")).first()[0] or 1)
    passes = 1
    while width > 1:
        width, passes = (width - 1) // BINS + 1, passes + 1
    for step in range(passes):
        counts = joined(state).mapInArrow(_histogram, "query_id long, bin int, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        high = Window.partitionBy("query_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        cum = counts.withColumn("upto", F.sum("n").over(high))
        # the highest bin by which `need` scores are reached; none: all are kept
        hit = cum.join(state.select(F.col("vec_id").alias("query_id"), "need"), "query_id").where(F.col("upto") >= F.col("need"))
        hit = hit.groupBy("query_id").agg(F.max(F.struct("bin", (F.col("upto") - F.col("n")).alias("above"))).alias("h"))
        old = state.join(hit.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
        b = F.col("h.bin").cast("long")
        state = written(old.select(
            "vec_id", "v", "qb",
            F.when(b.isNull(), F.col("lo")).otherwise(F.col("lo") + b * F.col("width")).alias("lo"),
            F.when(b.isNull(), F.col("hi")).otherwise(F.least(F.col("hi"), F.col("lo") + (b + 1) * F.col("width"))).alias("hi"),
            F.when(b.isNull(), F.col("width")).when(F.col("width") <= 1, F.lit(1)).otherwise(
                F.floor((F.col("width") - 1) / BINS) + 1).cast("long").alias("width"),
            F.when(b.isNull(), F.col("need")).otherwise(F.col("need") - F.col("h.above")).cast("long").alias("need")),
            f"topk_state{step}")
    found = joined(state).mapInArrow(_best(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
