import hashlib
import random
import re

from pyspark.sql import functions as F

from tidemark.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, Text string, DOC_ID string"


def digests(text):
    found = re.findall(fp.PIECE, text)
    assert "".join(found) == text
    return {int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in found}


def encoded(keys):
    out = ""
    for i in range(24):
        mine = [k for k in keys if k >> 8 * (i // 8) & 7 == i % 8]
        x = c = 0
        for k in mine:
            x, c = x ^ k, c ^ (k % fp.PRIME)
        out += f"{len(mine):08x}{x:016x}{c:08x}"
    return out


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs):
    docs = sorted((d, t or "") for d, t in docs)
    out = {}
    for i, (d, t) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        a, b, c = digests(t), digests(edited), digests(after)
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), encoded(a), encoded(b), alike(a, b), alike(a, c), len(a))
    return out


def told(spark, docs):
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], SCHEMA)
    rows = fp.report(df).collect()
    return [(r["doc_id"], tuple(r[c] for c in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_pieces"))) for r in rows]


def prose(rng, sentences):
    return "".join("".join(rng.choices("abcdeé日 ", k=rng.randint(3, 120))) + rng.choice([". ", "! ", "\n", "\n\n", "?\t", " "]) for _ in range(sentences))


def test_against_brute_force(spark):
    rng = random.Random(2)
    docs = [(i * 7 - 50, prose(rng, rng.choice([0, 1, 5, 40, 400]))) for i in range(50)]
    docs += [(1000, None), (1001, ""), (1002, "x"), (1003, "abc"), (1004, "\n\n\n"), (1005, "y" * 5000), (1006, docs[3][1]), (1007, docs[3][1]), (1008, "𝄞 clef. " * 200), (1009, "tail?"), (10**15, "Last. " * 60)]
    got = told(spark, docs)
    assert len(got) == len(docs) and dict(got) == brute(docs)
    by = dict(got)
    assert by[1006][5] == 1.0 and by[1006][2] == by[1007][2] and by[1000][4:6] == (1.0, 1.0)


def test_very_long_texts_are_peeled_by_parts(spark):
    """Far more differing pieces than a sketch holds."""
    rng = random.Random(9)
    docs = [(1, prose(rng, 9000)), (2, prose(rng, 7000)), (3, "short.")]
    docs.append((4, docs[0][1]))
    assert dict(told(spark, docs)) == brute(docs)


def test_single_empty_and_repeated_rows(spark):
    assert told(spark, []) == []
    one = told(spark, [(5, "One. Two three.")])
    assert one == list(brute([(5, "One. Two three.")]).items()) and one[0][1][5] == 1.0
    rows = [(1, "aaa. bbb"), (1, "aaa. bbb"), (2, "ccc"), (2, "abc"), (None, "nul")]
    got = told(spark, rows)
    assert sorted(str(d) for d, _ in got) == ["1", "1", "2", "2", "None"] and got[0][1] != got[2][1]
    ones = [v for d, v in got if d == 1]
    assert ones[0] == ones[1] and ones[0][1] == hashlib.sha256(b"aaa. bab").hexdigest()  # of the two rows of 2 'abc' comes first
    none = [v for d, v in got if d is None][0]
    assert none[1] == hashlib.sha256(b"nul").hexdigest() and none[5] == 0.0


def test_changes_between_versions(spark):
    rng = random.Random(4)
    old = [f"Paragraph {i} " + "".join(rng.choices("abcdef ", k=150)) + ".\n" for i in range(300)]
    new = [p for i, p in enumerate(old) if i % 10] + ["At the end.\n"]
    new[5:5] = ["An insertion.\n"]
    df = spark.createDataFrame([(1, "".join(old), "".join(new)), (2, None, "a"), (3, "a", "a"), (4, None, None)], "id long, old string, new string")
    got = {r["id"]: r for r in fp.changes(df).collect()}
    assert got[1]["removed"] == old[::10] and got[1]["added"] == ["An insertion.\n", "At the end.\n"]
    assert abs(got[1]["likeness"] - 270 / 302) < 1e-12
    assert (got[2]["removed"], got[2]["added"], got[2]["likeness"]) == ([], ["a"], 0.0) and got[3]["likeness"] == got[4]["likeness"] == 1.0


def test_fingerprints_can_be_subtracted_later(spark):
    of = lambda numbers: {next(iter(digests(f"piece {n}"))) for n in numbers}
    a, b = of(range(10, 60)), of(range(14, 63))
    df = spark.createDataFrame([([*a], [*b])], "a array<long>, b array<long>")
    df = df.select(F.expr(fp.encoded(fp.sketch("a"))).alias("a"), F.expr(fp.encoded(fp.sketch("b"))).alias("b"))
    r = df.select(F.expr(fp.peeled(fp.subtracted(fp.decoded("a"), fp.decoded("b")))).alias("t")).first()["t"]
    assert r["done"] and set(r["only_a"]) == a - b and set(r["only_b"]) == b - a


def test_a_sketch_that_holds_too_much_says_so(spark):
    df = spark.createDataFrame([([next(iter(digests(f"piece {n}"))) for n in range(200)], [])], "a array<long>, b array<long>")
    assert not df.select(F.expr(fp.peeled(fp.subtracted(fp.sketch("a"), fp.sketch("b")))).alias("t")).first()["t"]["done"]
    for deepest in (0, 1, 5):  # also where the digests are told one by one in the end
        before, fp.DEEPEST = fp.DEEPEST, deepest
        try:
            r = fp.difference(df, "a", "b", "x", "y").first()
        finally:
            fp.DEEPEST = before
        assert sorted(r["x"]) == sorted(r["a"]) and r["y"] == []


def test_main_path_is_native(spark):
    plan = fp.report(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
