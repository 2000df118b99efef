import random

import numpy as np

from tidemark.llm import substrings


def prose(rng, n):
    return " ".join("".join(rng.choice("aeinorsthl") for _ in range(rng.randint(2, 9))) for _ in range(n))


def brute_chunks(text: bytes):
    """The same cuts, byte by byte."""
    out, h, start = [], 0, 0
    for i, b in enumerate(text):
        h = (h * 2 + int(substrings.GEAR[b])) & 0xFFFFFFFF
        at_end = i == len(text) - 1
        inside = not at_end and text[i + 1] & 0xC0 == 0x80
        if at_end or (i >= substrings.WINDOW - 1 and not inside and (h >> 8 & 0xFFFF) < 65536 // substrings.MEAN):
            out.append((start, i + 1 - start))
            start = i + 1
    return out


def test_chunks_against_brute_force():
    rng = random.Random(2)
    texts = [b"", b"a", prose(rng, 400).encode(), ("é" * 300 + prose(rng, 50)).encode(), b" " * 500, prose(rng, 2000).encode()]
    c = substrings.chunked(texts)
    got = {}
    for d, s, z in zip(c["doc"].tolist(), c["start"].tolist(), c["size"].tolist(), strict=True):
        got.setdefault(d, []).append((s, z))
    assert got == {i: [x for x in brute_chunks(t) if x[1] >= substrings.SHORT] for i, t in enumerate(texts) if len(t) > 1}
    for d, s, own, gap in zip(c["doc"], c["start"], c["own"], c["gap"], strict=True):
        later = [x for x, _ in got[d] if x > s]
        assert own == sum(1 for i in range(s, later[0] if later else len(texts[d])) if texts[d][i : i + 1].strip() and not texts[d][max(0, i - 1) : i].strip())
    meta = substrings.packed(c)
    assert all((substrings.unpacked(meta, k) == c[k]).all() for k in substrings.BITS)


def test_insertions_shift_nothing():
    rng = random.Random(3)
    body = prose(rng, 1000).encode()
    other = body[:2000] + b" inserted " + body[2000:]
    sets = [{t[s : s + z] for s, z in brute_chunks(t)} for t in (body, other)]
    assert len(sets[0] - sets[1]) <= 3


def test_planted_passages(spark):
    rng = random.Random(4)
    passages = [prose(rng, 52) for _ in range(40)]
    rows, planted = [], set()
    for i in range(400):
        text = prose(rng, 150)
        if i % 4 == 0:
            p = passages[(i // 4) % 40]
            text = prose(rng, rng.randint(0, 90)) + " " + p + " " + text
            planted.add(i)
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.report(df).collect()}
    assert len(got) == 400
    assert {i for i, r in got.items() if r["repeated"]} == planted
    clean = {r["doc_id"]: r["text"] for r in substrings.deduplicated(df).collect()}
    for i, t in rows:
        assert len(t.encode()) - len(clean[i].encode()) == got[i]["removed_bytes"]
        if i not in planted or i < 160:  # the first of each passage stays whole
            assert clean[i] == t
        else:
            assert got[i]["removed_bytes"] > 60


def test_odd_rows(spark):
    rng = random.Random(5)
    long, p = prose(rng, 60_000), prose(rng, 200)
    rows = [(1, None), (2, ""), (3, p), (3, p), (None, p), (4, long), (5, long + " tail"), (6, p + "\n" + p), (7, prose(rng, 80)), (8, "é" * 4000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, key int, TEXT string")
    got = substrings.report(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert not by[1]["repeated"] and by[2]["n_bytes"] == 0 and not by[7]["repeated"]
    assert by[3]["repeated"] and by[3]["removed_bytes"] == 0 and by[None]["removed_bytes"] > 900
    assert by[4]["removed_bytes"] == 0 and by[5]["removed_bytes"] > 0.9 * len(long.encode())
    out = substrings.deduplicated(df)
    assert out.columns == df.columns and out.count() == len(rows)
    assert substrings.report(df.limit(0)).count() == 0
    both = spark.createDataFrame([(1, p), (2, "x " * 30 + p), (2, prose(rng, 300)), (2, None)], "doc_id long, text string")
    kept = [r[1] for r in substrings.deduplicated(both).collect()]
    assert sorted(len(t or "") for t in kept)[1] < 500 and both.collect()[2][1] in kept


def test_texts_under_one_doc_id(spark):
    """Different texts without a doc_id, or under an equal one, are documents of their own."""
    rng = random.Random(6)
    p, q, r = prose(rng, 120), prose(rng, 120), prose(rng, 120)
    mixed = lambda x: prose(rng, rng.randint(20, 90)) + " " + x + " " + prose(rng, rng.randint(20, 90))
    rows = [(None, mixed(p)) for _ in range(4)] + [(7, mixed(q)) for _ in range(4)] + [(1, mixed(r))] + [(None, mixed(r)) for _ in range(4)] + [(None, prose(rng, 150)), (8, prose(rng, 150))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    inside = lambda t: next((k for k, x in zip("pqr", (p, q, r), strict=True) if x in t), "")
    want = {t: inside(t) for _, t in rows}
    got = {(x["doc_id"], x["n_bytes"]): x for x in substrings.report(df).collect()}
    assert {k for k, x in got.items() if x["repeated"]} == {(i, len(t)) for i, t in rows if want[t]}
    assert all(x["n_passages"] == 1 for x in got.values() if x["repeated"])
    kept = [x["text"] for x in substrings.deduplicated(df).collect()]
    # One text of each group keeps the passage whole, and with r it is the one that has a doc_id.
    assert [sum(x in t for t in kept) for x in (p, q, r)] == [1, 1, 1] and rows[8][1] in kept
    removed = [x["removed_bytes"] for x in got.values() if x["removed_bytes"]]
    assert len(removed) == 3 + 3 + 4 and min(removed) > 300


def test_short_chunks_go_with_their_neighbours(spark):
    """Copies leave nothing behind, and what differs between repeated chunks stays."""
    rng = random.Random(8)
    texts = [prose(rng, 300) for _ in range(20)]
    c = substrings.chunked([t.encode() for t in texts], tails=True)
    assert sum((c["size"] + c["lead"]).tolist()) == sum(map(len, texts))
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.report(df).collect()}
    kept = {r["doc_id"]: r["text"] for r in substrings.deduplicated(df).collect()}
    for i, t in enumerate(texts):
        assert kept[i] == t and kept[100 + i] == ""
        assert got[100 + i]["removed_bytes"] == len(t) and got[100 + i]["longest_words"] == 300
    edited = [t[:900] + "#" + t[901:] for t in texts]
    df = spark.createDataFrame(rows[:20] + [(100 + i, t) for i, t in enumerate(edited)], "doc_id long, text string")
    assert all("#" in r["text"] for r in substrings.deduplicated(df).where("doc_id >= 100").collect())


def test_query_on_tables(spark):
    """Every repeated chunk of the small table, by brute force."""
    from tidemark.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    seen, docs = {}, {}
    for r in rows:
        t = r["text"].encode()
        docs[r["doc_id"]] = [t[s : s + z] for s, z in brute_chunks(t)]
        for c in docs[r["doc_id"]]:
            if len(c) >= substrings.SHORT:
                seen.setdefault(c, []).append(r["doc_id"])
    got = {r["doc_id"]: r for r in QUERIES["op6_substrings"](spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(docs)
    for d, chunks in docs.items():
        shared = [c for c in chunks if len(c) >= substrings.SHORT and len(set(seen[c])) > 1]
        if got[d]["repeated"]:
            assert shared
        if np.sum([len(c) for c in shared]) > 2000:
            assert got[d]["repeated"]


def test_periodic_texts_go_whole(spark):
    """No byte of a repeated text is left over, however often its own parts repeat."""
    for word in ("lorem ", "ab "):
        text = word * 2000
        df = spark.createDataFrame([(1, text), (2, text), (3, "other words here")], "doc_id long, text string")
        got = {r["doc_id"]: r for r in substrings.report(df).collect()}
        assert got[2]["repeated_bytes"] == got[2]["removed_bytes"] == len(text) and got[1]["removed_bytes"] == 0 and not got[3]["repeated"]
        assert {r["doc_id"]: r["text"] for r in substrings.deduplicated(df).collect()} == {1: text, 2: "", 3: "other words here"}


def test_passages_under_the_bound_stay(spark):
    """Of documents that share passages of 30, 40, 49, 50 and 60 words under a bound of 50, only the last two."""
    rng = random.Random(9)
    rows, want = [], set()
    for words in (30, 40, 49, 50, 60):
        for k in range(30):
            p = prose(rng, words)
            for copy in range(2):
                i = len(rows)
                # The passage's first and last words are not prolonged by what stands beside them.
                rows.append((i, prose(rng, rng.randint(5, 90)) + f" {i} " + p + f" {i} " + prose(rng, rng.randint(5, 90))))
                if words >= 50:
                    want.add(i)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.report(df).collect()}
    assert {i for i, r in got.items() if r["repeated"]} == want
    assert all((r["n_passages"] > 0) == (i in want) for i, r in got.items())
    clean = {r["doc_id"]: r["text"] for r in substrings.deduplicated(df).collect()}
    assert all(clean[i] == t for i, t in rows if i not in want or i % 2 == 0)
    assert all(len(clean[i]) < len(t) for i, t in rows if i in want and i % 2)


def test_passage_that_meets_longer_ones(spark):
    """A passage is found in the midst of a longer one, and where its first document holds less of it."""
    rng = random.Random(10)
    rows, want = [], set()
    for k in range(20):
        p = prose(rng, 300).split()
        part = p[100:152]
        mixed = lambda x: prose(rng, rng.randint(20, 60)) + " " + " ".join(x) + " " + prose(rng, rng.randint(20, 60))  # noqa: E731, B023
        i = 10 * k
        rows += [(i, mixed(part[5:30])), (i + 1, mixed(p)), (i + 2, mixed(p)), (i + 3, mixed(part)), (i + 4, mixed(part[:20] + part[21:]))]
        want |= {i + 1, i + 2, i + 3}
    got = {r["doc_id"] for r in substrings.report(spark.createDataFrame(rows, "doc_id long, text string")).where("repeated").collect()}
    assert got == want
