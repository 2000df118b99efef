import random

from tidemark.llm.components import components


def test_against_union_find(spark):
    for seed in range(3):
        rng = random.Random(seed)
        edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)] + [(2000, 2001 + i) for i in range(50)]
        parent = {}

        def find(x, parent=parent):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[find(a)] = find(b)
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
        nodes = {x for a, b in edges if a != b for x in (a, b)}
        assert set(got) == nodes
        groups, want = {}, {}
        for x in nodes:
            groups.setdefault(got[x], set()).add(x)
            want.setdefault(find(x), set()).add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
