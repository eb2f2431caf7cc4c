"""The queries that SQL can express, against DuckDB; the guard of the entry."""

from __future__ import annotations

import importlib
import re

import duckdb
import pytest

import __spark_entry__ as entry_mod
from opsgrain.llm import registry

SF = "/root/testdata/sf0.001"


def rows(records, columns):
    return sorted(repr(tuple(r[c] for c in sorted(columns))) for r in records)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert rows((r.asDict() for r in got.collect()), names) == rows((dict(zip(names, r, strict=True)) for r in want.fetchall()), names)


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in registry.queries()) == list(range(1, 14))
    assert {*registry.queries(), "pipeline"} <= set(entry_mod.queries())


def test_entry_works_without_the_optional_part(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n in ("opsgrain.llm", "corpus_pipeline") else real(n, *a))
    assert set(entry_mod.queries()) == set(entry_mod.REGISTRY)
    assert not any(k.startswith("op") for k in entry_mod.oracle_sql())
