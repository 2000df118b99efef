import hashlib
import random
import re

import pytest

from tidemark.llm import decontaminate


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low) if w]


def brute(docs, bench, size):
    grams = {}
    for item, text in bench:
        w = words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - size + 1)):
                grams.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    lengths = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in grams:
                    hit |= set(range(i, i + n))
                    items |= grams[g]
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("blocks", [1, 4])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 12)
    rng = random.Random(blocks)
    text = lambda n: " ".join(rng.choice(["aa", "bb", "cc", "Dd", "é1", "x"]) for _ in range(n))
    bench = [(i, text(rng.choice([1, 3, 5, 8, 40]))) for i in range(12)] + [(3, text(9)), (None, "aa"), (20, None), (21, ""), (22, "!!"), (23, "zz"), (24, "zz")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)] + [(7, None), (8, ""), (None, bench[0][1]), (9, "zz-ZZ"), (9, "zz-ZZ"), (10, "q " * 30_000 + bench[4][1] + " q" * 30_000)]
    d = spark.createDataFrame([(*r, "k", 1) for r in docs], "doc_id long, text string, TEXT string, n_hit int")
    b = spark.createDataFrame([(*r, "k") for r in bench], "item_id long, text string, ITEM_ID string")
    total = sum(len(words(t)) for _, t in bench)
    got = decontaminate.report(d, b, size=5, block_words=total // blocks + 1).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(docs, bench, 5), key=str)
    assert decontaminate.report(d.limit(0), b).count() == 0
    assert decontaminate.report(d, b.limit(0)).where("contaminated").count() == 0


def test_cleaning(spark):
    bench = spark.createDataFrame([(1, "One two THREE four five six seven eight nine ten eleven")], "item_id long, text string")
    run = "one, two; three four five six seven eight nine ten eleven"
    rows = [(1, f"Keep this. {run}! And that."), (2, "nothing here"), (3, None), (4, run), (5, "one two three four")]
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, TEXT string, n_chars int")
    spans = decontaminate.clean(docs, bench)
    assert spans.columns == docs.columns
    assert {r[0]: r[1] for r in spans.collect()} == {1: "Keep this. ! And that.", 2: "nothing here", 3: None, 4: "", 5: "one two three four"}
    assert sorted(r[0] for r in decontaminate.clean(docs, bench, remove="documents").collect()) == [2, 3, 5]
    with pytest.raises(ValueError):
        decontaminate.clean(docs, bench, remove="everything")
