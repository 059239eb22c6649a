"""Operators 2 and 5: held-out accuracy, and defined results on odd rows."""

import sys
import zlib

import numpy as np
import pytest

from mediamart.llm import language_mixture as lm
from mediamart.llm import quality_rules as qr
from mediamart.llm import registry
from mediamart.llm.blocks import zipped

SF = "/root/testdata/sf0.01"


def fold(i, mod):
    return zlib.crc32(str(i).encode()) % mod


def test_quality_held_out(spark):
    rows = registry.op2_quality_rules(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    bad = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([s >= 0.3 for s in good]) > 0.97


def test_rules_as_columns_equal_rules_as_matrix(spark):
    rng = np.random.default_rng(2)
    x = rng.random((300, len(qr.STATS)))
    y = ((x[:, 3] > 0.6) | (x[:, 7] < 0.2)).astype(float)
    model = qr.Model.fit(x, y)
    assert 0 < len(model.rules) < 200
    total = model.intercept + qr.rule_matrix([r for r, _ in model.rules], x) @ np.array([w for _, w in model.rules])
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i long, s array<double>")
    got = np.array([r[1] for r in df.select("i", model.column("s")).orderBy("i").collect()])
    assert np.allclose(got, 1 / (1 + np.exp(-total)))
    assert np.mean((got >= 0.5) == y) > 0.95


def test_lasso_leaves_useless_columns_out():
    rng = np.random.default_rng(3)
    a = (rng.random((500, 20)) > 0.5).astype(float)
    _, w = qr.lasso_logistic(a, a[:, 4], 0.02)
    assert abs(w[4]) > 1 and np.abs(np.delete(w, 4)).max() < 0.05


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, None)]])
def test_quality_without_two_kinds_of_labels(spark, odd, none, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = qr.fit(odd, known)
    scored = qr.score(odd, model, "quality_score").collect()
    assert len(scored) == odd.count() and len({round(r.quality_score, 9) for r in scored}) == 1
    assert set(odd.columns) <= set(scored[0].asDict())
    assert qr.score(none, model, "quality_score").collect() == []


def test_statistics_of_odd_texts():
    stats = qr.statistics([b"", b" \n", b"AB cd cd.", "é".encode()])
    assert stats.shape == (4, len(qr.STATS)) and np.isfinite(stats).all()
    assert not stats[0].any()
    one = dict(zip(qr.STATS, stats[2]))
    assert one["words"] == 3 and one["upper"] == pytest.approx(2 / 6) and one["stop"] == pytest.approx(1 / 3)
    assert qr.statistics([]).shape == (0, len(qr.STATS))


def test_language_held_out(spark):
    rows = registry.op5_language_mixture(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98


def test_language_counts_equal_plain_counting(spark):
    from collections import Counter
    docs = spark.createDataFrame([("en", "Abc abc é1 d"), ("fr", "abc"), ("en", "")], "lang string, text string")
    want = Counter()
    for lang, words in (("en", ["abc", "abc", "é", "d"]), ("fr", ["abc"])):
        for w in words:
            s = "\x02" + w + "\x02"
            want.update((lang, ord(s[i]) << 42 | ord(s[i + 1]) << 21 | ord(s[i + 2])) for i in range(len(s) - 2))
    assert {(r.lang, r.gram): r.n for r in lm.count_grams(docs).collect()} == dict(want)


def test_mixture_proportions():
    like = np.log(np.array([[0.9, 0.1, 0.001], [0.1, 0.9, 0.001]]))
    ll = np.vstack([np.repeat(like, [60, 40], axis=0), np.repeat(like, [30, 0], axis=0)])
    doc = np.repeat([0, 2], [100, 30])
    pi = lm.mixtures(ll, doc, np.ones(130), 3)
    assert pi.sum(1) == pytest.approx([1, 0, 1]) and pi[2] == pytest.approx([1, 0, 0])
    assert pi[0, 0] == pytest.approx(0.625, abs=0.02) and pi[0, 2] == 0       # EM of a 60/40 mixture at 0.9 / 0.1


def test_language_on_odd_rows(spark, odd, none):
    model = lm.fit(odd)
    rows = lm.predict(odd, model, "found_language").collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, r.found_language)
    assert len(rows) == odd.count() and set(model.langs) <= {"en", "fr", "de"}
    for i in (0, 1, 2, 9):
        assert (by[i].lang, by[i].score) == ("und", 0.0)
    assert by[7].lang in model.langs and by[8].lang in model.langs
    empty = lm.fit(none)
    assert empty.langs == [] and {r.f.lang for r in lm.predict(odd, empty, "f").collect()} == {"und"}
    assert lm.predict(none, model, "f").collect() == []


def test_language_uses_every_count(spark):
    """A language with 260,000 trigrams beside a small one: the same answers as
    from one dense model of all counts, and the small one is not lost."""
    rng = np.random.default_rng(12)
    large = ["".join(map(chr, w)) for w in rng.integers(0x4E00, 0x9FA5, (17_500, 20))]
    small = ["".join(map(chr, w)) for w in rng.integers(0x10D0, 0x10F0, (300, 6))]
    rows = [(i, " ".join(large[35 * i:35 * i + 35]), "zh") for i in range(500)] * 2
    rows += [(500 + i, " ".join(rng.choice(small, 25)), "ka") for i in range(40)] + [(600, None, "ka"), (601, "1 2", "zh")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = lm.fit(docs)
    got = {r.doc_id: r.f for r in lm.predict(docs, model, "f").collect()}
    assert {got[i].lang for i in range(500, 540)} == {"ka"} and got[600].lang == got[601].lang == "und"
    assert np.mean([got[i].lang == "zh" for i in range(500) if fold(i, 4) != 2]) == 1
    # the dense model of all counts, for some texts
    some = [(i, t) for i, t, _ in rows[:8] + rows[1000:1040]]
    n = {(r.lang, r.gram): r.n for r in lm.count_grams(docs.where("text IS NOT NULL").where(
        lm.id_remainder("doc_id", lm.FOLDS) != lm.HELD_OUT_FOLD)).collect()}
    assert len(n) > 200_000
    mass, grams = {x: sum(v for (y, _), v in n.items() if y == x) for x in ("ka", "zh")}, len({g for _, g in n})
    for i, text in some:
        ll = []
        for w in text.split():
            key = lm.trigrams([w])[0].tolist()
            ll.append([sum(np.log((n.get((x, g), 0) + 0.5) / (mass[x] + 0.5 * (grams + 1))) for g in key) for x in ("ka", "zh")])
        pi = lm.mixtures(np.array(ll), np.zeros(len(ll), int), np.ones(len(ll)), 1)[0]
        assert got[i].lang == ("ka", "zh")[int(pi.argmax())] and got[i].score == pytest.approx(pi.max(), abs=1e-9)


def test_language_learns_every_language(spark):
    rng = np.random.default_rng(13)
    rows = [(i, " ".join("".join(map(chr, w)) for w in rng.integers(0x4E00 + 40 * (i % 70), 0x4E14 + 40 * (i % 70), (30 + i % 70, 5))), f"l{i % 70:02d}")
            for i in range(840)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lm.fit(docs)
    assert len(model.langs) == 70
    assert {r.doc_id: r.f.lang for r in lm.predict(docs, model, "f").collect()} == {i: lang for i, _, lang in rows}


def test_documents_in_six_languages_keep_all_six(spark):
    """Evenly in six of eight learned languages: each has about a sixth, and
    the pipeline's language stage keeps the document; text in none goes."""
    import corpus_pipeline
    rng = np.random.default_rng(14)
    word = lambda k: "".join(map(chr, rng.integers(0x4E00 + 40 * k, 0x4E0A + 40 * k, 5)))
    rows = [(i, " ".join(word(i % 8) for _ in range(60)), f"l{i % 8}") for i in range(160)]
    mixed = " ".join(word(k) for _ in range(40) for k in range(6))
    rows += [(1001, mixed, None), (1002, " ".join(chr(0x10D0 + i % 30) * 4 for i in range(50)), None), (1003, "12 34", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lm.fit(docs)
    got = {r.doc_id: r.f for r in lm.predict(docs, model, "f").collect()}
    assert got[1001].score == pytest.approx(1 / 6, abs=0.02) and got[1001].known > 0.9 and got[1002].known == 0
    from unittest import mock
    with mock.patch.object(corpus_pipeline, "table", lambda *_: docs):
        kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert kept == {i for i, _, _ in rows} - {1002, 1003}


def test_language_sets_equal_plain_comparison():
    """The chosen set is the one of least penalised cost among all nested sets."""
    rng = np.random.default_rng(15)
    for langs in (1, 2, 5, 9):
        true = rng.integers(1, langs + 1)
        ll = np.log(rng.random((80, langs)) * 0.05 + 0.9 * (np.arange(langs) == rng.integers(0, true, 80)[:, None]) + 1e-6)
        n = rng.integers(1, 4, 80).astype(float)
        like = np.exp(ll - ll.max(1, keepdims=True))
        pi = np.full(langs, 1 / langs)
        for _ in range(lm.ROUNDS):
            r = pi * like
            pi = ((r / r.sum(1, keepdims=True)) * n[:, None]).sum(0) / n.sum()
        order = sorted(range(langs), key=lambda j: -pi[j])
        cost = []
        for k in range(1, langs + 1):
            part = np.where(np.isin(np.arange(langs), order[:k]), pi, 0)
            cost.append(-2 * float((n * np.log((part / part.sum() * like).sum(1).clip(1e-300))).sum()) + (k - 1) * np.log(n.sum()))
        got = lm.mixtures(ll, np.zeros(80, int), n, 1)[0]
        assert set(np.flatnonzero(got > 0)) == set(order[:int(np.argmin(cost)) + 1])


def plain_words(value):
    return lm.WORD.findall(value.decode().lower())


def as_text(words):
    return [w.decode("utf-32-le") for w in words.to_pylist()]


def test_words_equal_plain_words():
    """Every code point alone, inside and at the end of a word; texts, of which
    none runs into the next, with and without the letters of special lower case."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    usual = [c for c in points if c not in lm.SPECIAL]
    values = [f"{c} a{c}B Z{c}".encode() for c in points[:0x3000]]
    values += ["\n".join(f"{c} a{c}B Z{c}" for c in x).encode() for x in (usual, points)]
    values += [b"", "ΟΔΟΣ".encode(), "Σ".encode(), "ΑΣ".encode(), b"a", b"B1c_d", b" ", "İI".encode(), b"\x02x\x00y"]
    count, words = lm.words_of(values)
    assert count.tolist() == [len(plain_words(v)) for v in values]
    assert as_text(words) == [w for v in values for w in plain_words(v)]
    some = ["ab", "é", "ab", "", "c", "é"]
    number, size, letters = lm.distinct(lm.words_of([w.encode() for w in some])[1])
    assert number.tolist() == [0, 1, 0, 2, 1] and size.tolist() == [2, 1, 1] and letters.tolist() == [97, 98, 0xE9, 99]
    assert [len(x) for x in (*lm.words_of([]), *lm.distinct(lm.words_of([b"1"])[1]))] == [0] * 5


def plain_mixture(like, n):
    """Rounds, choice and refit of one document, in rows of plain arrays."""
    def rounds(pi, times):
        for _ in range(times):
            share = pi * like
            new = (share / share.sum(1, keepdims=True).clip(1e-300) * n[:, None]).sum(0) / n.sum()
            pi, still = new, np.abs(new - pi).max() > lm.SETTLED
            if not still:
                break
        return pi
    pi = rounds(np.full(like.shape[1], 1 / like.shape[1]), lm.ROUNDS)
    order = np.argsort(-pi, kind="stable")
    cost = []
    for k in range(1, len(order) + 1):
        part = np.where(np.isin(np.arange(len(order)), order[:k]), pi, 0)
        cost.append(-2 * (n * np.log((part / part.sum() * like).sum(1).clip(1e-300))).sum() + (k - 1) * np.log(n.sum()))
    k = int(np.argmax(np.array(cost) <= min(cost) + 1e-9)) + 1
    part = np.where(np.isin(np.arange(len(order)), order[:k]), pi, 0)
    return rounds(part / part.sum(), lm.REFIT_ROUNDS if k > 1 else 0)


@pytest.mark.parametrize("langs, cells", [(1, 64), (4, 64), (4, 1 << 19), (7, 300)])
def test_mixtures_equal_plain_rounds(monkeypatch, langs, cells):
    """Documents of any length beside each other, one without a row, also words
    that a language can not say at all."""
    monkeypatch.setattr(lm, "CELLS_AT_ONCE", cells)
    rng = np.random.default_rng(16)
    size = np.array([1, 40, 3, 0, 200, 17, 2, 90])
    doc = np.repeat(np.arange(len(size)), size)
    ll = -rng.exponential(4, (150, langs)) * rng.choice([1, 1, 300], (150, 1))
    word, n = rng.integers(0, 150, len(doc)), rng.integers(1, 9, len(doc)).astype(float)
    got = lm.mixtures(ll, doc, n, len(size), word)
    like = np.exp(ll - ll.max(1, keepdims=True))
    assert not got[3].any()
    for d in np.flatnonzero(size):
        assert got[d] == pytest.approx(plain_mixture(like[word[doc == d]], n[doc == d]), abs=1e-6)


def test_identify_on_texts_with_and_without_letters():
    counts = lm.Counts(*(np.array(x) for x in zip(*[(g, j, 5) for j, w in enumerate(["abab", "cdcd"]) for g in set(lm.trigrams([w])[0].tolist())])))
    unknown = np.log(0.5 / (np.array([20, 20]) + 0.5 * (len(counts.grams) + 1)))
    values = [b"abab", b"", b"12 _", "一".encode(), "Ⅷ ²".encode(), b"cdcd CDCD zz", "一 一丁甲".encode(), b"abab cdcd"]
    lang, score, known = lm.identify(values, ["x", "y"], unknown, counts)
    assert lang == ["x", "und", "und", "und", "und", "y", "x", lang[7]] and score[1:5].tolist() == known[1:5].tolist() == [0] * 4
    assert known[[0, 5, 6, 7]] == pytest.approx([1, 2 / 3, 0, 1]) and (score[[0, 5, 6, 7]] > 0).all()


@pytest.mark.parametrize("step", ["identify", "ask"])
def test_words_are_not_handled_one_by_one(step):
    """CPU time a word: 20,000 different words take far fewer calls than words."""
    rng = np.random.default_rng(17)
    values = [" ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (1000, 8))).encode() for _ in range(20)]
    counts = lm.Counts(lm.trigrams(["abcdefgh"])[0], np.zeros(8, np.int64), np.ones(8, np.int64))
    row = {"block": 1, "size": [len(v) for v in values], "texts": zipped(b"".join(values))}
    batch = lm.pa.RecordBatch.from_pylist([row])
    calls = 0

    def seen(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(seen)
    try:
        if step == "identify":
            lm.identify(values, ["x"], np.array([-5.0]), counts)
        else:
            list(lm._ask([batch]))
    finally:
        sys.setprofile(None)
    assert calls < 5000
