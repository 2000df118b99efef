import random
from pathlib import Path

import numpy as np

from tidemark.operators import logs, matching


def greedy(expected, received):
    """By the definition, one after the other."""
    at, out = 0, []
    for body in received:
        found = next((i for i in range(at, len(expected)) if expected[i] is not None and expected[i] == body), None)
        at = at if found is None else found + 1
        out.append(found)
    return out


def test_chunks_as_functions():
    for seed in range(200):
        rng = random.Random(seed)
        expected = [rng.randrange(rng.choice([1, 3, 30])) for _ in range(rng.randint(0, 40))]
        received = [rng.randrange(32) if rng.random() < 0.1 else rng.choice(expected or [0]) for _ in range(rng.randint(0, 12))]
        places = {b: np.array([i for i, x in enumerate(expected) if x == b], dtype=np.int64) for b in set(expected)}
        uppers, to = matching.stepped(received, places)
        assert (np.diff(uppers) > 0).all() and (np.diff(to) > 0).all()
        for start in range(len(expected) + 2):
            at = start
            for b in received:
                nxt = next((i for i in range(at, len(expected)) if expected[i] == b), None)
                at = at if nxt is None else nxt + 1
            nth = int(np.searchsorted(uppers, start))
            assert at == (to[nth] if nth < len(uppers) else start)


def test_against_the_definition(spark):
    rng, want, e, r = random.Random(7), {}, [], []
    for key, n, kinds in (("long", 900, 12), ("heartbeat", 400, 1), ("unique", 300, 10**6), ("none", 0, 1), ("alone", 50, 5), (None, 20, 3)):
        expected = [rng.randrange(kinds) for _ in range(n)]
        received = [b for b in expected if rng.random() < 0.85] if key != "alone" else []
        for _ in range(len(received) // 8):
            i = rng.randrange(len(received))
            received.insert(max(0, i - rng.randint(0, 6)), received.pop(i))
        received += [-1, 0] if key == "none" else []
        e += [(key, i, b) for i, b in enumerate(expected)]
        r += [(key, i, b) for i, b in enumerate(received)]
        want |= {(key, i): p if key else None for i, p in enumerate(greedy(expected, received))}
    r.append(("long", 10**6, None))
    want["long", 10**6] = None
    rng.shuffle(r)
    E = spark.createDataFrame(e, "key string, place long, body long")
    got = matching.matched(E, spark.createDataFrame(r, "key string, arrival long, body long"), "key", chunk=16)
    rows = got.collect()
    assert {(x["key"], x["arrival"]): x["place"] for x in rows} == want and len(rows) == len(r)
    lost = {(x["key"], x["place"]) for x in matching.missing(E, got, "key").collect()}
    assert lost == {(k, i) for k, i, _ in e} - {(k, p) for (k, _), p in want.items() if p is not None}


def test_chunks_hold_no_copies_of_a_track(spark):
    """What is kept grows with the rows, however many chunks they are dealt over; places may have gaps, and two bodies."""
    rng = random.Random(11)
    e = [("a", i * 3, rng.randrange(2)) for i in range(4000)] + [("b", i // 2, f) for i, f in enumerate(rng.choices(range(3), k=60))]
    r = [("a", i, rng.randrange(2)) for i in range(3000)] + [("b", i, rng.randrange(4)) for i in range(40)]
    want = {}
    for key in "ab":
        at, own = 0, sorted((p, b) for k, p, b in e if k == key)
        for _, i, body in (x for x in r if x[0] == key):
            want[key, i] = next((p for p, b in own if p >= at and b == body), None)
            at = at if want[key, i] is None else want[key, i] + 1
    top = Path(logs.shared_dir(spark).removeprefix("file://").removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in top.rglob("*") if f.is_file())
    before = size()
    got = matching.matched(spark.createDataFrame(e, "key string, place long, body long"), spark.createDataFrame(r, "key string, arrival long, body long"), "key", chunk=4).collect()
    assert {(x["key"], x["arrival"]): x["place"] for x in got} == want and len(got) == len(r)
    assert size() - before < 10_000_000


def test_elapsed_cuts_over_chunks(spark):
    """Tracks dealt over many chunks are cut as if walked frame by frame, also where times go back or stand."""
    rng, rows, want = random.Random(3), [], {}
    for track, n, step in (("steady", 400, lambda: 21), ("uneven", 400, lambda: rng.choice([0, 1, 5, 300])), ("back", 400, lambda: rng.randint(-80, 100)), ("still", 40, lambda: 0), (None, 30, lambda: 70), ("one", 1, lambda: 0)):
        pts = start = rng.randint(-1000, 1000)
        group = 0
        for i in range(n):
            if pts - start >= 200:
                start, group = pts, group + 1
            rows.append((track, i, pts, b"x"))
            want[track, i] = group
            pts += step()
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "track string, frame_no long, pts_us long, payload binary")
    for chunk in (7, 64, 1 << 16):
        got = logs.cut_elapsed(df, 200, chunk).collect()
        assert {(r["track"], r["frame_no"]): r["grp"] for r in got} == want and len(got) == len(rows)
    assert logs.cut_elapsed(df.limit(0), 200).count() == 0
