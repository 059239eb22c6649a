"""Operator 9, the queries that SQL can state, the pipeline, and the guard."""

import hashlib
import os
import random
import subprocess
import sys

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from mediamart.llm import chat_format as cf
from mediamart.llm import language_mixture, quality_rules, registry, suffix_dedup
from mediamart.llm.common import written

SF = "/root/testdata/sf0.001"
TALK = "conv_id long, turn long, role string, text string"
ROWS = [(1, 0, "user", "hi <s>[INST]"), (1, 1, "assistant", "a\\b </s>"), (1, 2, "user", "é👩‍👧"), (1, 3, "assistant", "\\l\\e\\b"),
        (2, 0, "user", None), (2, 1, None, "x"), (3, None, "assistant", "n"), (3, 0, "assistant", ""), (3, 0, "assistant", ""),
        (4, 1, "assistant", "tie b"), (4, 1, "assistant", "tie a"), (4, 1, "user", "tie"), (None, 0, "user", "u"), (None, 1, "assistant", "v")]


def plain_digest(rows):
    esc = lambda s: s.replace("\\", "\\e").replace("<", "\\l").replace("[", "\\b")
    talks = {}
    for c, n, r, t in rows:
        talks.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    out = {}
    for c, turns in talks.items():
        turns.sort()
        shown, ends = "", []
        for i, (_, _, r, t) in enumerate(turns):
            shown += f"<s>{esc(r)}[INST]{esc(t)}</s>"
            if r == "assistant" or i == len(turns) - 1:
                ends.append(len(shown))
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(said), len(loss), sha(loss), sum(ends))
    return out


def test_chat_digest(spark):
    df = spark.createDataFrame(ROWS, TALK).withColumn("loss", F.lit(1)).withColumn("ts", F.lit("x"))
    examples = cf.format_examples(df)
    got = {r.conv_id: tuple(r)[1:] for r in cf.digest(examples).collect()}
    assert got == plain_digest(ROWS)
    one = examples.where("conv_id = 1").orderBy("example").collect()
    assert [r.formatted[r.loss_start - 1:r.loss_start - 1 + r.loss_length] for r in one] == ["a\\eb \\l/s>", "\\el\\ee\\eb"]
    assert one[1].formatted.startswith(one[0].formatted) and [r.is_last for r in one] == [False, True]
    empty = spark.createDataFrame([], TALK)
    assert cf.digest(cf.format_examples(empty)).collect() == []


def test_chat_of_many_turns(spark):
    rng = random.Random(3)
    rows = [(9, i, rng.choice(["user", "assistant"]), "<" * rng.randint(0, 3) + "word " * rng.randint(0, 9)) for i in range(1500)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)) + ROWS, TALK).repartition(5)
    assert {r.conv_id: tuple(r)[1:] for r in cf.digest(cf.format_examples(df)).collect()} == plain_digest(rows + ROWS)


def test_chat_plan_is_native(spark):
    plan = registry.op9_chat_formatting(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(registry.ORACLES[name])
    cols = [d[0] for d in cur.description]
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, map(tuple, got.select(*cols).collect()))) == sorted(map(str, cur.fetchall()))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))


def test_pipeline_stage_by_stage(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").withColumn("score", F.lit(1))
    columns, before = docs.columns, docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "repeats", "packing"]
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, corpus), f"test_{name}")
        found[name] = docs
        if name != "packing":
            assert docs.columns == columns and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    model = quality_rules.fit(before, spark.read.parquet(f"{corpus}/labels.parquet"))
    scored = quality_rules.score(before, model, "q").collect()
    assert ids(found["quality"]) == {r.doc_id for r in scored if r.q >= quality_rules.THRESHOLD}
    model = language_mixture.fit(before)
    said = language_mixture.predict(found["quality"], model, "f").collect()
    assert ids(found["language"]) == {r.doc_id for r in said if r.f.lang != "und" and r.f.known >= corpus_pipeline.LEAST_KNOWN}
    from .test_simhash_packing_search import plain_components
    rows = [(r.doc_id, r.text) for r in found["language"].collect()]
    assert ids(found["near_duplicates"]) == {c for _, _, c in plain_components(rows)}
    from .test_lm_and_dedup import plain_removal
    rows = [(r.doc_id, r.text) for r in found["near_duplicates"].collect()]
    want = {i: k.decode("utf-8", "ignore") for i, _, k, _ in plain_removal(rows)}
    got = {r.doc_id: (r.text, r.n_chars) for r in found["repeats"].collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()} and any(len(t) < len(x) for (_, x), t in zip(rows, want.values()))
    assert ids(found["packing"]) == ids(found["repeats"])
    assert corpus_pipeline.run(spark, corpus).count() == found["packing"].count()


def test_pipeline_on_odd_and_empty_tables(spark, odd, none, corpus):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, corpus)
            assert out.count() <= max(1, docs.count() * 60)
            if name != "packing":
                assert out.columns == docs.columns


def test_entry_without_these_folders(tmp_path):
    """The rest imports and lists its queries when the folder and the pipeline are gone."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for top, dirs, files in os.walk(os.path.join(here, "mediamart")):
        dirs[:] = [d for d in dirs if d not in ("llm", "__pycache__")]
        to = tmp_path / os.path.relpath(top, here)
        to.mkdir(parents=True, exist_ok=True)
        for f in files:
            (to / f).write_bytes(open(os.path.join(top, f), "rb").read())
    (tmp_path / "__spark_entry__.py").write_bytes(open(os.path.join(here, "__spark_entry__.py"), "rb").read())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rating_by_decade' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    for extra in ([], ["mediamart/llm"]):               # an empty folder left behind is no package either
        for d in extra:
            (tmp_path / d).mkdir()
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)}, timeout=120)


def test_rows_that_share_an_id_stay_unless_their_texts_do(spark, corpus):
    """Rows go because of their texts, never because of their ids."""
    a, b, c = ("".join(random.Random(i).choice("abcdefgh ") for _ in range(600)) for i in range(3))
    rows = [(5, a, "en", "x", 1), (5, b, "de", "y", 2), (None, c, None, None, None), (None, c, "en", None, 3), (9, a, "fr", "z", 4), (7, b, "en", "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, corpus)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == sorted([(5, a), (5, b), (-1, c)])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text("éêĩĪĨꀀ👩a", max_size=3), st.text("éêĩĪĨꀀ👩a", max_size=3)), min_size=2, max_size=6))
def test_cut_texts_hold_no_new_characters(spark, sides):
    passage = "shared " * 9 + "Ī"
    rows = [(i, x + passage + y) for i, (x, y) in enumerate(sides)]
    docs = spark.createDataFrame(rows + [(90, "ĩ" + passage + "Ĩx"), (91, "é" + passage + "Ī")], "doc_id long, text string")
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in suffix_dedup.clean_text(docs).collect():
        left = iter(whole[r.doc_id])
        assert all(ch in left for ch in r.text), (r.text, whole[r.doc_id])      # a subsequence of the text
