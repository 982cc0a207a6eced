"""Every registered query against its SQL, run by DuckDB on the same sample tables."""

import datetime as dt
import glob
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as registered
from registry.oracle import ORACLE_SQL as LAKE_SQL
from registry.queries import QUERIES as LAKE_QUERIES

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = LAKE_QUERIES, LAKE_SQL
# What these return is file sizes, which SQL on the sample tables cannot know.
ROWS_ONLY = {"scan_footprint", "scan_cost_comparison"}


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def sorted_rows(records):
    return sorted(records, key=repr)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(registered.queries()) and set(SQL) <= set(registered.oracle_sql())


@pytest.mark.parametrize("absent", ["roadbook.llm.queries", "corpus_pipeline", "public_tokenizers"])
def test_the_lake_is_registered_without_the_text_operators(monkeypatch, absent):
    text = [m for m in sys.modules if m.startswith(("roadbook.llm", "corpus_pipeline"))]
    for name in text:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, absent, None)  # as if there were no such module
    assert set(QUERIES) <= set(registered.queries()) and set(SQL) <= set(registered.oracle_sql())
    if absent == "public_tokenizers":
        assert set(registered.queries()) == set(QUERIES)


def test_the_lake_is_registered_beside_an_empty_folder(tmp_path):
    root = os.path.dirname(os.path.abspath(registered.__file__))
    for name in ("registry", "roadbook", "__spark_entry__.py"):
        source = os.path.join(root, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    (tmp_path / "roadbook" / "llm").mkdir()
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run.stdout.split() == [str(len(QUERIES)), str(len(SQL))], run.stderr


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(columns).collect()]
    result = oracle.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted_rows(got) == sorted_rows(expected)
    assert len(expected) > 0


@pytest.mark.parametrize("name", ["q1_underutilized_vehicles", "q4_worst_sla_city_days"])
def test_order_of_ranked_rows(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    result = oracle.execute(SQL[name])
    assert df.columns == [c[0] for c in result.description]
    assert [tuple(r) for r in df.collect()] == result.fetchall()


def test_footprint_counts_bytes_and_files(spark):
    before, after = QUERIES["scan_footprint"](spark, SF_DIR).orderBy("files_touched").collect()[::-1]
    assert (before.scenario, after.scenario) == ("before", "after")
    assert after.files_touched == 1 and after.rows_matched == 1
    assert before.bytes_scanned > 100 * after.bytes_scanned
    cost = QUERIES["scan_cost_comparison"](spark, SF_DIR).first()
    assert cost.before == (before.bytes_scanned, before.files_touched, before.rows_matched)
    assert cost.reduction_pct > 99


def test_flagship_query(spark):
    got = registered.entry(spark).collect()
    assert len(got) == 10 and isinstance(got[0].dt, dt.date)
