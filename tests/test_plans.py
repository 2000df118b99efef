"""How often what is left to do reads its inputs, tables and what was kept alike."""

import random
import re

import pytest

from tidemark.operators import timelines
from tidemark.plans import queries  # noqa: F401
from tidemark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def scans(df):
    return len(re.findall(r"\bScan (?:parquet|ExistingRDD)", df._jdf.queryExecution().sparkPlan().toString()))


@pytest.mark.parametrize(("name", "most"), [("publisher_windows", 2), ("arrival_batches", 2), ("lateness_floor", 2), ("group_rows_keyframe", 2), ("shared_edge", 4)])
def test_scans(spark, name, most):
    assert scans(QUERIES[name](spark, SF)) <= most


@pytest.mark.parametrize("name", ["asof_forward_lead", "lateness_floor"])
def test_no_window_by_track_alone(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    rows = [w for w in re.findall(r"Window \[.*\], \[([^\]]*)\], \[", plan) if "chunk" not in w and "__key" not in w]
    assert not rows, rows


def test_no_sliding_window(spark):
    """Each row of a sliding window looks at all rows in its reach again, which grows with how close they lie."""
    plan = QUERIES["lateness_floor"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("specifiedwindowframe") and not [f for f in re.findall(r"specifiedwindowframe\(([^)]*)\)", plan) if "unboundedpreceding" not in f]


def test_floor_against_the_definition(spark):
    rng = random.Random(5)
    for reach in (0, 1, 7, 50):
        rows = [(rng.choice(["a", "b", None]), i, rng.choice([None, *range(-60, 200)]), rng.choice([None, *range(90)])) for i in range(500)]
        got = timelines.above_floor(spark.createDataFrame(rows, "k string, n long, t long, late long"), "k", "t", "late", reach).collect()
        for r in got:
            near = [x[3] for x in rows if x[0] == r["k"] and x[3] is not None and (x[2] is None and r["t"] is None or None not in (x[2], r["t"]) and abs(x[2] - r["t"]) <= reach)]
            assert r["above"] == (r["late"] - min(near) if r["late"] is not None else None)
        assert sorted(r["n"] for r in got) == list(range(500))
