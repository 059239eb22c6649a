"""Operators 6, 7, 8 and 10 against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mediamart.llm import ann_tree, exact_topk, packing
from mediamart.llm import simhash_tiles as sh
from mediamart.llm.registry import WORD_BPE

from .conftest import prose


# -- operator 8 ----------------------------------------------------------------
def plain_fingerprint(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) > 3 else [b" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = min([x for x in (low.get(r), d) if x is not None], default=None)
    return [(d, f, low[find(i)]) for i, ((d, _), f) in enumerate(zip(rows, fps))]


def components_of(df):
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in sh.near_duplicates(df).collect()), key=str)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    base = [prose(rng, 80, "an the er on ti") for _ in range(6)]
    rows = []
    for i in range(80):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
        rows.append((500 - i, " ".join(words)))
    rows += [(1000 + i, "") for i in range(5)] + [(2000, "A b  c"), (2001, "a B\tc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert components_of(df) == sorted(plain_components(rows), key=str)


def test_near_duplicates_of_odd_rows(odd, odd_rows, none):
    assert components_of(odd) == sorted(plain_components([(r[0], r[1]) for r in odd_rows]), key=str)
    assert sh.near_duplicates(none).collect() == []


def test_tiles_find_every_link(monkeypatch):
    monkeypatch.setattr(sh, "TILE", 16)
    rng = np.random.default_rng(4)
    fp = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [x ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for x in fp[:10] for a, b in rng.integers(0, 63, (6, 2))]
    fp = np.unique(np.concatenate([fp, np.array(near, np.uint64)]))

    def parts(a, b, n):
        label = {x: x for x in n}
        for x, y in zip(a, b):
            old, new = label[x], label[y]
            label = {k: new if v == old else v for k, v in label.items()}
        groups = {}
        for k, v in label.items():
            groups.setdefault(v, set()).add(k)
        return {frozenset(g) for g in groups.values()}
    i, j = np.nonzero(np.triu(np.bitwise_count(fp[:, None] ^ fp[None]) <= 4, 1))
    want = parts(fp[i].tolist(), fp[j].tolist(), fp.tolist())
    a, b = sh.tile_links(fp, 4)
    assert parts(a.tolist(), b.tolist(), fp.tolist()) == want and len(a) < len(fp)
    left, right = fp[::2], fp[1::2]
    pairs = [sh.tile_links(left, 4), sh.tile_links(right, 4), sh.tile_links(left, 4, right)]
    a, b = (np.concatenate(x) for x in zip(*pairs))
    assert parts(a.tolist(), b.tolist(), fp.tolist()) == want


def test_large_buckets_are_cut(spark, monkeypatch):
    """Parts of one bucket meet each other, whatever the part size."""
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 1 << 62))
    fps = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (60, 2))})
    nodes = spark.createDataFrame([(x,) for x in fps], "fp long")
    monkeypatch.setattr(sh, "PART", 7)
    labels = {r.node: r.label for r in sh.components(sh.links(nodes)).collect()}
    assert set(labels) == set(fps) and set(labels.values()) == {min(fps)}


def test_components_of_long_paths(spark):
    rng = random.Random(6)
    order = rng.sample(range(300), 300)
    edges = [(order[i], order[i + 1]) for i in range(299) if i % 100 != 99]
    got = {r.node: r.label for r in sh.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (order[:100], order[100:200], order[200:]):
        assert {got[x] for x in part} == {min(part)}


# -- operator 6 ----------------------------------------------------------------
def fill(plan, histogram, capacity):
    bins = {}
    for s, n in histogram.items():
        seq, offset = plan.place(np.full(n, s), np.arange(n))
        for a, b in zip(seq.tolist(), offset.tolist()):
            bins.setdefault(a, []).append((b, s))
    for items in bins.values():
        upto = 0
        for offset, s in sorted(items):
            assert offset == upto
            upto += s
        assert upto <= capacity
    assert len(bins) == plan.sequences
    return len(bins)


def optimum(items, capacity):
    best = [len(items)]

    def rec(i, bins):
        if len(bins) >= best[0] and i < len(items):
            return
        if i == len(items):
            best[0] = min(best[0], len(bins))
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity:
                rec(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1:]])
        rec(i + 1, [*bins, items[i]])
    rec(0, [])
    return best[0]


def test_plans_fill_bins_and_reduction_keeps_the_optimum():
    rng = random.Random(7)
    for _ in range(150):
        capacity = rng.choice([10, 20, 50])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 8))), reverse=True)
        count = [0] * (capacity + 1)
        for x in items:
            count[x] += 1
        histogram = {s: n for s, n in enumerate(count) if n}
        assert fill(packing.Plan(histogram, capacity), histogram, capacity) <= optimum(items, capacity) + 1
        fixed = packing.reduce_dominated(count, capacity)
        rest = [s for s, n in enumerate(count) for _ in range(n)]
        assert sum(t for _, t in fixed) + optimum(sorted(rest, reverse=True), capacity) == optimum(items, capacity)


def test_plan_size_does_not_grow_with_counts():
    rng = random.Random(8)
    small = {s: rng.randint(1, 50) for s in range(1, 2049, 3)}
    few, many = packing.Plan(small), packing.Plan({s: 1000 * n for s, n in small.items()})
    assert len(many.key) < 3 * len(few.key) + 4096
    bound = -(-sum(s * n * 1000 for s, n in small.items()) // 2048)
    large = sum(n * 1000 for s, n in small.items() if s > 1024)      # no two of these share a sequence
    assert many.sequences < 1.03 * max(bound, large) + 1


def test_packing_documents(odd, odd_rows, none):
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for i, text, *_ in odd_rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(i, a // 2048, a, len(ids[a:a + 2048]), zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes()))
                 for a in range(0, len(ids), 2048)]
    pieces, placed = packing.pack_documents(odd, WORD_BPE)
    rows = placed.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    assert pieces.count() == len(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        items.sort()
        assert [o for o, _ in items] == list(np.cumsum([0] + [n for _, n in items])[:-1]) and sum(n for _, n in items) <= 2048
    assert packing.pack_documents(none, WORD_BPE)[1].collect() == []


# -- operators 7 and 10 ---------------------------------------------------------
def vectors(spark, rng, n, dim, extra=()):
    rows = [(i, [float(x) for x in np.float32(v)], 0) for i, v in enumerate(rng.normal(size=(n, dim)))]
    return spark.createDataFrame(rows + list(extra), "vec_id long, embedding array<float>, label int")


ODD = [(None, [1.0] * 8, 0), (5000, None, 0), (5050, [], 0), (5100, [1.0, None] * 4, 0), (5200, [float("nan")] * 8, 0),
       (5300, [float("inf")] * 8, 0), (5400, [0.0] * 8, 0), (5500, [1.0, 2.0], 0), (5501, [2.0, 1.0], 0), (3, [9.0] * 8, 0),
       (5600, [1e30] * 4 + [-1e30] * 4, 0)]


def plain_vectors(df, zero_ok):
    held = {}
    for r in df.collect():
        v = r.embedding
        if r.vec_id is None or not v or any(x is None or not np.isfinite(x) for x in v) or not (zero_ok or any(v)):
            continue
        held[r.vec_id] = min(held.get(r.vec_id, v), v)
    return held


def test_exact_top_k(spark):
    rng = np.random.default_rng(9)
    ties = [(7000 + i, [0.5] * 8, 0) for i in range(40)]
    df = vectors(spark, rng, 400, 8, ODD + ties).repartition(6)
    held = {i: [int(np.floor(np.float64(x) * 1024)) for x in v] for i, v in plain_vectors(df, True).items()}
    want = {}
    for q, v in held.items():
        if q % 100 == 0:
            found = sorted((-max(-exact_topk.LONG, min(exact_topk.LONG, sum(a * b for a, b in zip(v, w)))), i)
                           for i, w in held.items() if i != q and len(w) == len(v))
            want[q] = [(i, -s) for s, i in found[:10]]
    got = {}
    for r in exact_topk.top_k(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: x for q, x in want.items() if x}


def test_exact_top_k_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(exact_topk, "CANDIDATE_BLOCK", 50)
    df = vectors(spark, np.random.default_rng(10), 500, 4)
    got = {(r.query_id, r["rank"]): r.vec_id for r in exact_topk.top_k(df, k=3).collect()}
    m = {i: np.floor(np.array(v, float) * 1024) for i, v in plain_vectors(df, True).items()}
    for q in range(0, 500, 100):
        best = sorted((-(m[q] @ m[i]), i) for i in m if i != q)[:3]
        assert [got[q, n + 1] for n in range(3)] == [i for _, i in best]


@pytest.mark.parametrize("search", [exact_topk.top_k, ann_tree.search])
def test_search_of_nothing_and_of_few(spark, search):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert search(empty).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in search(few).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]


def test_ann_recall_and_scores(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(30, 8)) * 3
    rows = [(i, [float(x) for x in np.float32(centres[i % 30] + rng.normal(size=8))], 0) for i in range(3000)]
    hot = [(9000 + i, [0.25] * 8, 0) for i in range(1500)]          # one vector in a third of the rows
    df = spark.createDataFrame(rows + hot + ODD, "vec_id long, embedding array<float>, label int").repartition(8)
    held = plain_vectors(df, False)
    ids = np.array([i for i, v in held.items() if len(v) == 8])
    m = np.array([held[i] for i in ids.tolist()])
    norm = np.sqrt((m * m).sum(1))
    got = {}
    for r in ann_tree.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = total = 0
    for q in ids[ids % 50 == 0].tolist():
        at = int(np.flatnonzero(ids == q)[0])
        cos = (m * m[at]).sum(1) / (norm * norm[at])
        cos[at] = -9
        best = ids[np.lexsort((ids, -cos))[:5]].tolist()
        hit, total = hit + len({i for i, _ in got[q]} & set(best)), total + 5
        assert len(got[q]) == 5 and q not in [i for i, _ in got[q]]
        for i, s in got[q]:
            assert s == pytest.approx(float(cos[ids == i][0]), abs=1e-12)
    assert hit / total >= 0.9
    assert [i for i, _ in got[9000]] == [9001, 9002, 9003, 9004, 9005]
    assert [i for i, _ in got[5500]] == [5501]                         # vectors of another length


def test_ann_isolated_queries_find_k(spark):
    """Copies make one visit enough for most; a query alone in its leaf goes on."""
    rng = np.random.default_rng(14)
    copies = rng.normal(size=(20, 8))
    rows = [(i, [float(x) for x in copies[i % 20]]) for i in range(2000)]
    alone = [(5000 + 50 * i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(2, 8)))]
    got = {}
    for r in ann_tree.search(spark.createDataFrame(rows + alone, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {*range(0, 2000, 50), 5000, 5050}
    assert all(len(x) == 5 and q not in x for q, x in got.items())


def test_ann_calibrates_each_query():
    depths = [[0] * 5] * 90 + [[0, 0, 0, 3, 3]] * 10        # 96% of all neighbours, but only 90% of the queries, are served by one leaf
    assert ann_tree.leaves_needed(depths, 0.95) == 4
    assert ann_tree.leaves_needed([[0] * 5] * 96 + [[9] * 5] * 4, 0.95) == 1


def test_neighbouring_leaves_share_blocks():
    assert ann_tree.leaf_blocks(np.array([3, 4, 9, 30, 1, 0, 2]), 10).tolist() == [0, 0, 1, 2, 3, 3, 3]


@pytest.mark.parametrize("search", [exact_topk.top_k, ann_tree.search])
def test_search_ignores_other_columns(spark, search):
    df = vectors(spark, np.random.default_rng(15), 300, 4)
    more = df.selectExpr("*", "1 v", "2 leaf", "3 blk", "4 score", "5 query_id", "'x' rank", "6 c", "7 q", "8 n", "9 salt", "10 qb")
    key = lambda x: sorted(map(tuple, x.collect()))
    assert key(search(more)) == key(search(df)) != []


def test_ann_on_data_without_clusters(spark):
    """Isotropic vectors: the calibrated search opens what recall needs."""
    rng = np.random.default_rng(16)
    m = rng.normal(size=(2500, 32))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    unit = m / np.sqrt((m * m).sum(1, keepdims=True))
    hit = total = 0
    for r in ann_tree.search(df).groupBy("query_id").agg(F.collect_set("vec_id").alias("found")).collect():
        cos = unit @ unit[r.query_id]
        cos[r.query_id] = -9
        hit, total = hit + len(set(r.found) & set(np.argsort(-cos)[:5].tolist())), total + 5
    assert total == 250 and hit / total >= 0.9
