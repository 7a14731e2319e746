import math
import os

import duckdb
import pytest

from weftline.plans import registry

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    rel = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    assert sorted(got.columns) == sorted(names)
    order = sorted(names)
    want = sorted(repr([plain(r[names.index(c)]) for c in order]) for r in rel.fetchall())
    have = sorted(repr([plain(r[c]) for c in order]) for r in got.collect())
    assert have == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
