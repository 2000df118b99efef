import random

import numpy as np
import xxhash

from tidemark.llm import simhash


def brute_fingerprint(text, width=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, radius=4):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    want = brute_components([r["doc_id"] for r in rows], fps)
    from tidemark.llm.queries import QUERIES

    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op3_simhash"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {r["doc_id"]: (f"{f:016x}", c) for r, f, c in zip(rows, fps, want, strict=True)}


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one TWO"), (None, "one two"), (7, long), (7, long), (8, long + " x"), (None, "zz yy xx ww vv")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, TEXT string, fp int")
    got = simhash.near_duplicates(df).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], fps)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, want, strict=True)), key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r[0] or -1 for r in kept.collect()) == [-1, 1, 4, 7]  # rows without doc_id are decided by their texts as well


def near(rng, fp, n):
    for b in rng.sample(range(64), n):
        fp ^= 1 << b
    return fp


def test_crowded_fingerprints(spark, monkeypatch):
    """Chains, crowds, and a key dealt over tasks and parts."""
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(300)]
    fps = set(base)
    for b in base[:100]:
        fps.add(near(rng, b, rng.randint(1, 6)))
    for _ in range(400):
        fps.add(near(rng, base[0], rng.randint(1, 5)))
    fps = sorted(fps)
    want = brute_components(list(range(len(fps))), fps)
    for heavy, part in ((1 << 25, 1 << 21), (1 << 14, 1 << 12)):
        monkeypatch.setattr(simhash, "HEAVY", heavy)
        monkeypatch.setattr(simhash, "PART", part)
        df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
        edges = [(e["u"], e["v"]) for e in simhash.links(df).collect()]
        at = {int(np.uint64(f).view(np.int64)): i for i, f in enumerate(fps)}
        root = simhash.rooted(np.array([at[u] for u, _ in edges]), np.array([at[v] for _, v in edges]), len(fps))
        assert root.tolist() == want


def test_rows_that_share_a_doc_id_stay(spark):
    long = lambda k: " ".join(f"{k}{i % 37}x{i}" for i in range(120))
    rows = [(5, long("a"), "p"), (5, long("b"), "q"), (6, long("c"), "r"), (None, long("d"), "s"), (None, long("a"), "t"), (7, long("b"), "u"), (6, long("c"), "r"), (None, None, "v"), (8, "", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    got = simhash.one_of_each(df)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    want = [(5, long("a"), "p"), (5, long("b"), "q"), (6, long("c"), "r"), (None, long("d"), "s"), (8, "", "w")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_every_crowded_key_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HEAVY", 3000)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, size=40, dtype=np.int64)
    fps = sorted({int(b) ^ sum(1 << int(i) for i in rng.choice(63, size=rng.integers(0, 4), replace=False)) for b in base for _ in range(20)})
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 4).collect()
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in edges:
        root[find(e["u"])] = find(e["v"])
    want = {f: f for f in fps}

    def top(x):
        while want[x] != x:
            x = want[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if bin(a ^ b).count("1") <= 4:
                want[top(a)] = top(b)
    assert len({(find(f), top(f)) for f in fps}) == len({find(f) for f in fps}) == len({top(f) for f in fps})
