"""Queries against their DuckDB SQL on the smallest data folder."""

import os

import duckdb
import pytest

from kinweave import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
#: The driver compares all; here those that walk every citizen's network are left out.
NAMES = [n for n in catalog.SQL if not n.startswith(("ego_citizen", "payload", "cache_", "kin_", "ego_cluster", "stage_counts"))]


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _rows(rows):
    return sorted((tuple(str(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in rows))


@pytest.mark.parametrize("name", NAMES)
def test_matches(spark, duck, name):
    rel = duck.sql(catalog.SQL[name])
    df = catalog.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.select(*rel.columns).collect()) == _rows(rel.fetchall())


def test_every_query_has_a_known_name():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
