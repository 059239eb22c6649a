"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01), plus the entry smoke check."""

import hashlib
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry_mod
from mediamart.operators import checks
from mediamart.plans import catalog
from mediamart.plans.workbench import Workbench
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and df.columns == ["decade", "avg_rating", "total_movies"]


def test_every_query_has_an_oracle():
    q, o = catalog.queries(), catalog.oracles()
    assert set(q) == set(o)
    assert set(q) <= set(entry_mod.queries()) and set(o) <= set(entry_mod.oracle_sql())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_load_stats_agree_with_counts(spark):
    stats = {r.dataset: r for r in entry_mod.queries()["serve_load_stats"](spark, SF_SMALL).collect()}
    counts = {r.tbl: r.row_count for r in entry_mod.queries()["verify_counts"](spark, SF_SMALL).collect()}
    assert {k: v.row_count for k, v in stats.items()} == counts


def test_storage_report_covers_both_layers(spark):
    rows = checks.storage_report(Workbench.get(spark, SF_SMALL).stored()).collect()
    assert {(r.layer, r.tbl) for r in rows} == {(layer, t) for layer in ("lake", "serve")
                                                for t in ("titles", "people", "principals", "akas")}
    by = {(r.layer, r.tbl): r for r in rows}
    assert all(by[("lake", t)].rows == by[("serve", t)].rows for t in ("titles", "people", "principals", "akas"))
    assert all(r.bytes > 0 and r.files >= 1 and r.disk_size.split()[1] in ("B", "KiB", "MiB") for r in rows)


@pytest.mark.parametrize("name, column", [("malformed_values", "malformed"), ("serve_narrow", "out_of_range"),
                                          ("reconcile_counts", "out_of_range"), ("reconcile_counts", "duplicate_keys"),
                                          ("serve_load_stats", "out_of_range")])
def test_checks_find_what_the_analogs_hold(duck, name, column):
    """The compared counts are not all zero."""
    rel = duck.execute(catalog.oracles()[name])
    at = [d[0] for d in rel.description].index(column)
    values = [r[at] for r in rel.fetchall()]
    assert sum(v > 0 for v in values) >= len(values) / 4


def test_weak_plans_stay_mended(spark):
    def plan(name):
        return catalog.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan("serve_narrow").count("FileScan") == 4                 # one scan per table
    assert plan("reconcile_counts").count("FileScan") == 8             # lake and serving, once each
    filters = re.search(r"PartitionFilters: \[([^]]*)\]", plan("range_scan"))
    assert "decade" in filters.group(1)
    assert "RoundRobin" not in plan("scan_tsv_gz")
    assert "hashpartitioning(file__" in plan("serve_sorted") and plan("serve_sorted").count("FileScan") == 4


def test_a_slot_keeps_one_copy(spark):
    from mediamart.session import shared_dir
    from mediamart.sources.fs import size_bytes
    root = f"{shared_dir(spark)}/mediamart/{spark.sparkContext.applicationId}"
    catalog.queries()["lake_rebuild"](spark, SF_SMALL).collect()
    once = size_bytes(spark, root)
    catalog.queries()["lake_rebuild"](spark, SF_SMALL).collect()
    assert size_bytes(spark, root) < 1.01 * once


def test_storage_report_groups_files_not_rows(spark):
    plan = catalog.queries()["storage_report"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Filter .*row_index.* = 0", plan)) == 8      # both layers of four tables
