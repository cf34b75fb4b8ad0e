"""Registered queries against their SQL, and what all of them share."""
import importlib

import duckdb
import pytest
from corpus_helpers import SMALL, TABLES

import __spark_entry__ as E
from tools.oracle_check import canon

OPERATORS = importlib.import_module("tidewater.llm.queries").load_all()


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in OPERATORS) == list(range(1, 11))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", [n for n, (_, sql) in OPERATORS.items() if sql])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    theirs = canon([d[0] for d in cur.description], cur.fetchall())
    df = E.queries()[name](spark, SMALL)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == theirs


@pytest.mark.parametrize("name", ["op2_decontamination", "op4_quality_rules", "op10_line_chunks"])
def test_native_plans_run_no_python(spark, name):
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
