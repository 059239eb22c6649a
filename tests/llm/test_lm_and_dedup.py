"""Operators 3 and 4 against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mediamart.llm import context_tree as ct
from mediamart.llm import registry, suffix_dedup as sd
from mediamart.llm.suffix_groups import suffix_array

from .conftest import DOCS, prose


# -- operator 3 ----------------------------------------------------------------
def plain_scores(rows):
    """Context-tree weighting with dictionaries, one decision at a time."""
    low = [(i, (t or "").encode().lower()) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in low]

    def decisions(v):
        q = [255] * ct.DEPTH + list(v) + [255]
        for at in range(ct.DEPTH, len(q)):
            ctx = tuple(q[at - ct.DEPTH:at][::-1])
            for j in range(8):
                yield ctx, (1 << j) | (q[at] >> (8 - j)), q[at] >> (7 - j) & 1

    n = {}
    for (_, v), h in zip(low, held):
        for ctx, node, bit in () if h else decisions(v):
            for d in range(ct.DEPTH + 1):
                n.setdefault((ctx[:d], node), [0, 0])[bit] += 1

    def kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weight, below = {}, Counter()
    for (ctx, node), (a, b) in sorted(n.items(), key=lambda x: -len(x[0][0])):
        own = kt(a, b)
        w = own if len(ctx) == ct.DEPTH else np.logaddexp(math.log(.5) + own, math.log(.5) + below[ctx, node])
        weight[ctx, node] = w
        if ctx:
            below[ctx[:-1], node] += w
    out = []
    for _, v in low:
        total = 0.0
        for ctx, node, bit in decisions(v):
            p = None
            for d in range(ct.DEPTH, -1, -1):
                e = n.get((ctx[:d], node))
                if e:
                    k = (e[1] + .5) / (sum(e) + 1)
                    share = math.exp(math.log(.5) + kt(*e) - weight[ctx[:d], node])
                    p = k if p is None else share * k + (1 - share) * p
            p = .5 if p is None else p
            total += math.log10(p if bit else 1 - p)
        out.append(total)
    count = Counter(w for (_, v), h in zip(low, held) if not h for w in [*v.split(), b"\n"])
    big, kinds = sum(count.values()), len(count)
    return [(i, h, len(v.split()) + 1, sum(count[w] > 0 for w in [*v.split(), b"\n"]), big,
             sum(math.log10((count[w] + 1) / (big + kinds + 1)) for w in [*v.split(), b"\n"]), s)
            for (i, v), h, s in zip(low, held, out)]


def same_scores(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[6], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert a[5:7] == pytest.approx(b[5:], rel=1e-9)
        assert a[8] == pytest.approx(-b[6] * math.log2(10) / (a[7] + 1))        # code length of a byte


def test_scores_equal_plain_context_trees(spark, odd_rows, monkeypatch):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(0, 30), "an the er on Ti é")) for i in range(40)]
    rows += [(r[0], r[1]) for r in odd_rows if r[0] != 7]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same_scores(ct.score(df).collect(), plain_scores(rows))


def test_scores_do_not_depend_on_blocks(spark, odd, monkeypatch):
    """The very long row and clashing columns too; of many blocks, groups are summed in parts."""
    one = [tuple(r)[:7] for r in ct.score(odd.coalesce(1)).collect()]
    gather = ct.gather
    monkeypatch.setattr(ct, "gather", lambda docs, text, lower: gather(docs, text, lower, 2_000))
    many = ct.score(odd.repartition(4))
    assert many.count() == 13
    same_scores([tuple(r) for r in many.collect()], one)


def test_scores_without_training_and_of_nothing(spark, none):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:4]
    rows = [(i, "ab c") for i in held]
    got = ct.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same_scores(got, plain_scores(rows))
    assert got[0].score == pytest.approx(-5 * 8 * math.log10(2)) and got[0].train_tokens == 0
    assert ct.score(none).collect() == []


def test_probabilities_of_a_byte_sum_to_one():
    rng = np.random.default_rng(1)
    text = rng.choice(np.frombuffer(b"abcd ", np.uint8), 4000).tobytes()
    key, n = np.unique(ct.pair_keys([text])[0], return_counts=True)
    ctx = key[len(key) // 2] >> 8
    every = ctx << 8 | np.arange(256)
    key, n = ct.summed([(key, n), (every, np.zeros(256, np.int64))])
    tree = ct.Subtree(key, n)
    node = tree.nodes()[0]
    p = 10 ** tree.log10(node, np.zeros(len(node)), np.ones(len(node)))
    assert p[np.searchsorted(key, every)].sum() == pytest.approx(1)


def test_log_gamma():
    x = np.array([.5, 1, 1.5, 2, 7.9, 8, 100.5, 1e9])
    assert ct.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)


# -- operator 4 ----------------------------------------------------------------
@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=80) | st.lists(st.sampled_from([97, 98]), max_size=80).map(bytes))
def test_suffix_array(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_runs():
    for text in (b"a" * 300, b"ab" * 150, b"ba" * 150, b"abcab" * 60, bytes(range(256)), bytes(range(255, -1, -1))):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def plain_removal(rows):
    first, out = {}, []
    ids = [float("inf") if i is None else i for i, _ in rows]
    texts = [(t or "").encode() for _, t in rows]
    for i, v in zip(ids, texts):
        for a in range(len(v) - 49):
            w = v[a:a + 50]
            first[w] = min(first.get(w, i), i)
    for (i, _), d, v in zip(rows, ids, texts):
        mask = np.zeros(len(v), bool)
        for a in range(len(v) - 49):
            if first[v[a:a + 50]] < d:
                mask[a:a + 50] = True
        edge = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0])).tolist()
        out.append((i, len(v), np.frombuffer(v, np.uint8)[~mask].tobytes(), list(zip(edge[::2], edge[1::2]))))
    return out


def removal_rows(seed=7):
    rng = random.Random(seed)
    line = prose(rng, 12, "an the er on ti")
    base = [prose(rng, 60, "an the er é on ti ing") for _ in range(12)]
    rows = []
    for i in range(60):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):                     # near copies
            words[rng.randrange(len(words))] = f"w{i}"
        text = " ".join(words)
        if i % 3 == 0:                                         # a line in a third of the documents, ever other words around
            text += f"\n{prose(rng, 3, 'x y z q')} {line} {prose(rng, 3, 'x y z q')}"
        if i % 10 == 0:
            text += " Hest" * 40
        rows.append((rng.randrange(1000), text))
    return rows


def same_removal(df, rows, **more):
    cut, (kept, n_bytes, spans) = sd.remove_repeats(df, **more)
    key = lambda r: (str(r[0]), r[1], r[2])
    got = sorted(((r.doc_id, r[n_bytes], bytes(r[kept]), [(s.start, s.end) for s in r[spans]]) for r in cut.collect()), key=key)
    assert got == sorted(plain_removal(rows), key=key)


@pytest.mark.parametrize("hot", [sd.HOT, 1, 8])
def test_removal_equals_brute_force(spark, hot):
    rows = removal_rows()
    same_removal(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, hot=hot)


def test_removal_of_odd_rows(spark, odd, odd_rows, none):
    same_removal(odd, [(r[0], r[1]) for r in odd_rows])
    clean = sd.clean_text(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert sd.remove_repeats(none)[0].collect() == [] and sd.clean_text(none).collect() == []


def test_long_texts_are_cut_into_pieces(monkeypatch):
    rng = random.Random(1)
    values = [prose(rng, 3000, "an the er on").encode(), b"short", b"a" * 2000]
    whole = [x.tolist() for x in sd.anchors(values)]
    monkeypatch.setattr(sd, "PIECE", 700)
    assert [x.tolist() for x in sd.anchors(values)] == whole


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(2)
    passage = prose(rng, 30, "an the er on").encode()
    a, b = b"left words here " + passage + b" tail", b"q" * 77 + passage + b" other"
    marks = []
    for v in (a, b):
        _, pos, h = sd.anchors([v])
        at = v.index(passage)
        inside = (pos >= at) & (pos + sd.K <= at + len(passage))
        marks.append({(p - at, x) for p, x in zip(pos[inside].tolist(), h[inside].tolist())})
    assert len(marks[0] & marks[1]) >= (len(passage) - 49) // sd.SPAN


def test_kept_text_drops_broken_characters(spark):
    passage = "é" * 40
    df = spark.createDataFrame([(1, passage + "A", "x", "y", 1), (2, "B" + passage + "C", "x", "y", 1)], DOCS)
    got = {r.doc_id: r.text for r in sd.clean_text(df).collect()}
    assert got == {1: passage + "A", 2: "BC"}


def test_query_digests(spark, tmp_path):
    rows = removal_rows(9)
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in registry.op4_suffix_dedup(spark, str(tmp_path)).collect())
    want = sorted((i, n, n - len(k), len(s), hashlib.sha256(k).hexdigest()) for i, n, k, s in plain_removal(rows))
    assert got == want
