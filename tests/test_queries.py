import os

import duckdb
import pytest

from korrel.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(map(normal, r)) for r in df.select(*columns).collect())
    rel = duck.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(tuple(map(normal, r)) for r in duck.sql(f"SELECT {quoted} FROM ({registry.oracle_sql()[name]})").fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_model_queries(spark, sf, name):
    rows = registry.queries()[name](spark, sf).collect()
    assert rows
    if "prob" in rows[0]:
        assert all(0 <= r.prob <= 1 for r in rows)
