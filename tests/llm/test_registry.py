"""The registered queries of this subpackage: names, SQL, odd columns."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from hourglass.llm import registry

SMALL = "/root/testdata/sf0.001"


def test_every_number_has_one_query():
    names = list(registry.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert {*names, "pipeline"} <= set(E.queries()) and set(registry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{SMALL}/{file}')")
    cur = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    want = sorted(map(str, cur.fetchall()))
    assert want == sorted(str(tuple(r)) for r in registry.queries()[name](spark, SMALL).select(*columns).collect())


def test_queries_read_tables_with_more_columns(spark, tmp_path):
    """Columns named like results do not clash."""
    for table in ("documents", "benchmark", "pages", "embeddings", "conversations"):
        df = spark.read.parquet(f"{SMALL}/{table}.parquet").limit(60)
        for c in ("fp", "n_hit", "ids", "spans", "payload", "leaf", "block", "h", "kept", "key", "found", "msg", "form", "place", "pii_text", "term"):
            df = df.selectExpr("*", f"1 AS {c}")
        df.write.parquet(str(tmp_path / f"{table}.parquet"))
    for name, query in registry.queries().items():
        assert query(spark, str(tmp_path)).count() > 0, name


def test_queries_on_empty_tables(spark, tmp_path):
    for table in ("documents", "benchmark", "pages", "embeddings", "conversations"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    for name, query in registry.queries().items():
        assert query(spark, str(tmp_path)).count() == (1 if name.startswith("op5") else 0), name
