import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in NAMES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    return round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, (list, bytearray)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=str)
    res = duck.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLES) == set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


def test_library_does_not_import_llm():
    root = os.path.join(os.path.dirname(entry.__file__), "tidemark")
    for d, _, files in os.walk(root):
        if "/llm" not in d:
            for f in files:
                if f.endswith(".py"):
                    assert "tidemark.llm" not in open(os.path.join(d, f)).read()
