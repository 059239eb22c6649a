"""Operators 11 to 13 against brute force in plain Python."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mediamart.llm import phrases, pii, prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


# ------------------------------------------------------------ prefix trie
def brute_trie(rows):
    talks = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            talks[c].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in talks.items()}
    rebuilt = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = talks.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = set()
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(rebuilt[c]) == len(p)))
        out.add((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], sum(1 for q in below if not kids[q]),
                 sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talk_rows(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 200), n):
        for turn in range(rng.choice([1, 2, 3, 5, 12])):
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]),
                         rng.choice(["", "a", "é", "hello", None, f"x{rng.random()}"])))
    rows += rows[:9] + [(None, 1, "user", "lost"), (500, 0, "user", "same"), (505, 0, "user", "same")]
    rows += [(1000, t, "user", f"turn {t % 3}") for t in range(150)] + [(1001, t, "user", f"turn {t % 3}") for t in range(150)]
    return rows


def test_trie_equals_brute_force(spark):
    # the last takes more turns from an absent conversation than it has: it ends at the root
    turnless = next(c for c in range(3001, 4000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = talk_rows(1) + [(turnless, 0, "user", "a")]
    turns = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS + ", node long, depth string, chunk int").repartition(5)
    got = prefix_trie.trie(turns).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute_trie(rows)


def test_trie_of_an_empty_table(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).collect() == []


def test_a_conversation_over_many_chunks(spark):
    """One conversation of a third of all rows is numbered over range partitions."""
    rows = [(3, t, "user", f"w{t * 7919 % 1000}") for t in range(400)] + [(c, t, "user", "x") for c in range(20, 220) for t in range(4)]
    turns = spark.createDataFrame(rows, TURNS).repartition(6)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merging)
    spark.conf.set(merging, "false")           # as if the table were too large for one partition
    try:
        own = prefix_trie.ordered(turns)
        assert own.where("conv_id = 3").select("chunk").distinct().count() > 1
        assert sorted(r.place for r in own.where("conv_id = 3").collect()) == list(range(1, 401))
        rebuilt, _ = prefix_trie.rebuild(turns)
        names = prefix_trie.prefixes(rebuilt).where("conv_id in (3, 20)").collect()
        above = {(r.conv_id, r.depth): (r.k0, r.k1) for r in names}
        assert sorted(d for c, d in above if c == 3) == list(range(1, max(d for c, d in above if c == 3) + 1))
        assert all((r.p0, r.p1) == above[r.conv_id, r.depth - 1] for r in names if r.depth > 1)
    finally:
        spark.conf.set(merging, before)


def test_subtree_sums_on_chains_stars_and_random_trees(spark):
    rng = random.Random(3)
    shapes = {"chain": [None, *range(40)], "star": [None, *[0] * 30], "caterpillar": [None] + [i - 1 if i % 2 else max(0, i - 2) for i in range(1, 40)],
              "random": [None] + [rng.randrange(i) for i in range(1, 120)]}
    rows, want = [], []
    for k, parents in enumerate(shapes.values()):                  # one forest
        value = [rng.randrange(100) for _ in parents]
        total = value[:]
        for i in range(len(parents) - 1, 0, -1):
            total[parents[i]] += total[i]
        rows += [(1000 * k + i, None if p is None else 1000 * k + p, v) for i, (p, v) in enumerate(zip(parents, value))]
        want += [(1000 * k + i, t) for i, t in enumerate(total)]
    tree = spark.createDataFrame(rows, "node long, parent long, v long")
    assert sorted((r.node, r.v) for r in prefix_trie.subtree_sums(tree, ["v"]).collect()) == want


def test_end_digests_over_several_runs(spark, monkeypatch):
    rows = [(n, c) for n in (1, 2) for c in range(-5, 3000, 3)]
    got = {r.node: r.ends_sha256 for r in prefix_trie.end_digests(spark.createDataFrame(rows, "node long, conv_id long").repartition(7)).collect()}
    want = hashlib.sha256(",".join(str(c) for c in range(-5, 3000, 3)).encode()).hexdigest()
    assert got == {1: want, 2: want}


# -------------------------------------------------------------------- PII
def luhn(digits):
    total = 0
    for i, ch in enumerate(reversed(digits)):
        x = int(ch) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_base(text):
    spans = []
    digits = lambda m: re.sub("[^0-9]", "", m)                                                     # noqa: E731
    for order, (kind, pattern, ok) in enumerate((
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15))):
        spans += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text or "") if ok(m.group())]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def base_found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find(docs, "found").select("doc_id", pii.listed(F.filter("found", lambda s: s["base"])).alias("got")).collect()
    return [r.got for r in sorted(rows)]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(8)
    parts = ["a@b.co", "x_y@z.d_e@f.g", "@", "a@b", "1.2.3.4", "999.1.2.3.4", "00012.0.0.255", "256.1.1.1", "4111 1111 1111 1111", "4111111111111112",
             "378282246310005", "+1 (555) 010-7713", "+44", "+4 1-2.3(4)567890 1", "é", "👩", " ", "-", ".", "7", "..", "\n", "word", "+12345678 "]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", ","]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "a" * 2000, "1.2.3.4 " * 3000, "a@b" + ".c" * 1000, "7" * 2000, "+1" + "(" * 2000, "a@" * 1000]
    assert base_found(spark, texts) == [brute_base(t) for t in texts]


def test_very_long_texts_take_time_in_proportion(spark):
    """Backtracking over these would take hours, recursion would overflow."""
    texts = ["a" * 300_000, "a@b" + ".c" * 150_000, "7" * 300_000, "+1" + "(" * 300_000, "a@" * 150_000, "1." * 3 + "1 " + "é" * 300_000 + "1.2.3.4"]
    assert base_found(spark, texts) == ["", "email:0:300003", "", "", "", "ip:0:7,ip:300008:300015"]


def test_checksums_and_context_of_the_added_spans(spark):
    want = {
        "pay GB82 WEST 1234 5698 7654 32 NOW": [("iban", "GB82 WEST 1234 5698 7654 32", 0.9)],
        "account DE89370400440532013000.": [("iban", "DE89370400440532013000", 1.0)],
        "GB82 WEST 1234 5698 7654 33": [], "xGB82WEST12345698765432": [], "GB82WEST12345698765432x": [],
        "my ssn is 123-45-6789": [("ssn", "123-45-6789", 0.85)],
        "order 123-45-6789 shipped": [], "000-45-6789": [], "1123-45-6789": [],
        "call (555) 123-4567": [("phone", "(555) 123-4567", 0.65)],
        "sum (555) 123-4567": [],
        "call +1 (555) 123-4567": [("phone", "+1 (555) 123-4567", 0.95)],
        "version 1.2.3.4": [("ip", "1.2.3.4", 0.25)]}
    docs = spark.createDataFrame([(t,) for t in want], "text string")
    got = {r.text: [(s.kind, r.text[s.start:s.end], s.score) for s in r.found] for r in pii.find(docs, "found").collect()}
    assert got == want


def test_pii_keeps_rows_and_columns(spark, odd, none):
    found = pii.find(odd, "pii")
    assert found.columns == [*odd.columns, "pii"] and found.count() == odd.count()
    assert found.drop("pii").exceptAll(odd).count() == 0
    assert found.where("text IS NULL").select(F.size("pii")).first()[0] == 0
    assert pii.find(none, "pii").count() == 0


def test_masked_text(spark):
    docs = spark.createDataFrame([(1, "é a@b.co, 1.2.3.4; +1 (555) 123-4567!"), (2, None), (3, "clean")], "doc_id long, text string")
    assert [r.text for r in pii.masked(docs).orderBy("doc_id").collect()] == ["é [EMAIL], [IP]; [PHONE]!", None, "clean"]


def test_pii_has_no_python_in_its_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    plan = pii.find(docs, "s")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---------------------------------------------------------------- phrases
def brute_phrases(rows, least=10, cover=50, top=2000):
    counts, size = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^\x20\x09]+", piece)
            size[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    counts[lang][tuple(w[i:i + k])] += 1
    out = set()
    for lang, f in counts.items():
        ranked = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(100 * b >= cover * a and b >= least and p in (q[:2], q[1:]) for q, b in f.items() if len(q) == 3):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out |= {(lang, i + 1, p.decode(), -a, x, y, size[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(ranked)[:top])}
    return out


def phrase_rows(seed):
    rng = random.Random(seed)
    words = ["the", "New", "york", "é", "z\x1cq", "of", "a"] + [f"w{i}" for i in range(12)]
    rows = []
    for _ in range(250):
        text = "".join(rng.choice(words[:rng.choice([3, 19])]) + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), ("hot word pair " * 4000, "en"), ("x" * 100_000 + " y z", "de"), (" \t . ", "zz")]


@pytest.mark.parametrize("budget, block", [(2_000_000, 16 << 20), (2000, 2000)])
def test_phrases_equal_brute_force(spark, budget, block):
    rows = phrase_rows(4)
    docs = spark.createDataFrame([(i, t, lang, 1, "x") for i, (t, lang) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, phrase string").repartition(4)
    got = phrases.collocations(docs, budget=budget, block_bytes=block).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute_phrases(rows)


def test_phrases_of_odd_rows(spark, odd, odd_rows, none):
    rows = [(r[1], r[2]) for r in odd_rows]
    assert {tuple(r) for r in phrases.collocations(odd, least=2, cover_percent=80, top=7).collect()} == brute_phrases(rows, 2, 80, 7)
    assert phrases.collocations(none).collect() == []


def test_suffixes_of_a_block_with_many_words(spark):
    """Word numbers too wide for one sort key take the other way to the same rows."""
    texts = [b"a b c. a b c. b a"]
    names, ids = phrases.encode(texts)
    rows, n = phrases.suffixes(ids, len(names))
    wide, m = phrases.suffixes(ids, 1 << 40)
    assert rows.tolist() == wide.tolist() and n.tolist() == m.tolist() and n.sum() == 8
