import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import divergence

SCHEMA = "doc_id long, text string, Text string, lang string, source string"


def brute(docs, least_docs, top):
    docs = [(t or "", lang or "", s or "") for t, lang, s in docs]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by, seen = defaultdict(Counter), defaultdict(Counter)
    for t, lang, s in docs:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(fold))
        by[lang, s].update(found)
        seen[lang].update(set(found))
    out = {}
    for lang in {x[1] for x in docs}:
        kept = [t for t, n in seen[lang].items() if n >= least_docs]
        groups = {s: by[g, s] for g, s in by if g == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s in groups:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s))
            found = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t])[:top]
            for part, rows in (("pair", pairs), ("term", found)):
                out |= {(lang, s, part, item): (-v, rank) for rank, (v, _, item) in enumerate(rows, 1)}
    return out


def told(spark, docs, **how):
    df = spark.createDataFrame([(i, t, "other", lang, s) for i, (t, lang, s) in enumerate(docs)], SCHEMA)
    rows = divergence.audit(df, **how).collect()
    return {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in rows}, len(rows)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["the", "The", "été", "É", "zü", "日本", "don't", "a1b", *[f"{a}{b}" for a in "klmnop" for b in "qrstuv"]]
    docs = []
    for i in range(220):
        source = rng.choice(["hot", "hot", "hot", f"s{rng.randint(0, 5)}", "", None])
        lean = vocabulary[: rng.randint(3, len(vocabulary))] if source != "hot" else vocabulary
        docs.append((" ".join(rng.choices(lean, k=rng.randint(0, 60))), rng.choice(["en", "fr", "", None]), source))
    docs += [(None, "en", "silent"), ("", "en", "blank"), ("unique words only here", "en", "lonely"), ("x", "zz", "only"), ("y", "zz", "two"), ("the " * 400_000, "en", "long"), docs[0], docs[0]]
    for least_docs, top in ((3, 50), (10, 4)):
        got, n = told(spark, docs, least_docs=least_docs, top=top)
        want = brute(docs, least_docs, top)
        assert got == want and n == len(want)
    assert ("zz", "only", "pair", "two") in got and got["zz", "only", "pair", "two"] == (0, 1)


def test_ties_by_bytes(spark):
    docs = [("b a é z", "en", s) for s in ("é", "z", "a", "B")] * 2
    got, _ = told(spark, docs, least_docs=1)
    assert [k[3] for k, v in sorted(got.items(), key=lambda x: x[1][1]) if k[1] == "a" and k[2] == "pair"] == ["B", "z", "é"]
    assert {v[0] for v in got.values()} == {0} and all(k[2] == "pair" for k in got)


def test_empty_table_and_both_joins(spark, monkeypatch):
    assert told(spark, []) == ({}, 0)
    docs = [(f"w{i % 7} w{i % 3} v", "en", f"s{i % 4}") for i in range(60)]
    broadcast, _ = told(spark, docs, least_docs=5)
    monkeypatch.setattr(divergence, "BROADCAST", 0)
    assert told(spark, docs, least_docs=5)[0] == broadcast == brute(docs, 5, 50)


def test_counts_of_any_size_are_exact(spark):
    n, total, terms = 10**13, 3 * 10**15, 10**6
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_slices_of_long_texts(monkeypatch):
    text = b"Ab1cd \xc3\xa9t\xc3\xa9-x " * 50
    whole = [t for some in divergence.terms(text) for t in some]
    monkeypatch.setattr(divergence, "SLICE", 7)
    assert [t for some in divergence.terms(text) for t in some] == whole and whole[:4] == [b"ab", b"cd", "été".encode(), b"x"]


def test_entries_pass_in_parts(monkeypatch):
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array(["en"] * 40), pa.array([f"s{i % 3}" for i in range(40)]), pa.array([f"a{chr(97 + i % 9)} b b".encode() for i in range(40)], pa.binary())], names=["lang", "source", "text"])

    def summed():
        out: Counter = Counter()
        for b in divergence._counted(iter([rows])):
            for *k, n, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out[tuple(k)] += n * 1000 + d
        return out

    whole = summed()
    monkeypatch.setattr(divergence, "HELD", 2)
    assert summed() == whole
