import glob
import math
import os

import duckdb
import pytest

from tidemark.plans.registry import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
QUICK = ["parse_scalars", "incident_keys", "json_positions", "event_arrivals", "lag_histogram", "average_precision", "f1_threshold", "contract_violations", "retention_expiries", "features_6m_24m"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    rel = duck.sql(ORACLE[name])
    assert sorted(rel.columns) == columns
    assert got == sorted(tuple(map(plain, r)) for r in rel.select(*columns).fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_nothing_outside_imports_the_text_operators():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for f in glob.glob(f"{root}/tidemark/**/*.py", recursive=True):
        if "/llm/" not in f:
            assert "tidemark.llm" not in open(f).read(), f
