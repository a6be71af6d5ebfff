"""Registered queries against their SQL in DuckDB, over the smallest tables."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from offerweave.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def as_text(df: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    def one(v):
        if v is None or v is pd.NA or v != v:
            return ""
        return str(float(v)) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)

    return df[columns].astype(object).map(one).sort_values(columns).reset_index(drop=True)


def duck(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.sql(sql).df()


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    mine = entry.queries()[name](spark, sf_dir).toPandas()
    theirs = duck(sf_dir, entry.oracle_sql()[name])
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    assert len(mine)
    pd.testing.assert_frame_equal(as_text(mine, columns), as_text(theirs, columns))


def test_every_query_without_sql_is_known():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_canonical_offers_need_no_shuffle(spark, sf_dir):
    """One pass: apart from the bridge's own joins nothing is exchanged."""
    from offerweave.operators import normalize, scope

    raw = spark.createDataFrame([(1, "bpce", "Data Engineer", "x")], "ord long, source string, title string, description string")
    plan = normalize.normalized(scope.evaluated(raw), catalogue.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
