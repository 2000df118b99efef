import re
from itertools import permutations

import numpy as np
import pytest

from tidemark.llm import filters

DOCS = "doc_id long, lang string, text string, TEXT string, source string"
LABELS = "doc_id long, quality int, toxic int, note string"


def brute(docs, labels):
    """By the definition, document by document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    rows = [(d, lang or "", text or "") for d, lang, text in docs]
    fails = []
    for d, lang, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        f["E"] = d is not None and any(x is not None and x < d and u == t for x, _, u in rows)
        fails.append((lang, {k for k, v in f.items() if v}, d in good, d in bad))
    for part in {lang for _, lang, _ in rows}:
        mine = [x for x in fails if x[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                out[part, order, step] = (len(left), len(gone), sum(letter in x[1] for x in mine) - len(gone), sum(x[1] == {letter} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone))
    total = {}
    for (part, order, step), v in out.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + v[1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def told(spark, docs, labels):
    d = spark.createDataFrame([(i, lang, t, "A B", "s") for i, lang, t in docs], DOCS)
    rows = filters.audit(d, spark.createDataFrame([(*x, "n") for x in labels], LABELS)).collect()
    assert len(rows) == len({(r["part"], r["filter_order"], r["step"]) for r in rows})
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in rows}


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(120):
        some = list(rng.choice(words, rng.integers(0, 260)))
        sep = str(rng.choice([" ", "\n", "\t ", "\x0b", " "]))
        text = sep.join(some) + str(rng.choice(["", "#", " ABCDEF" * 40, " |"]))
        docs.append((i, str(rng.choice(["en", "fr", ""])), text))
    docs += [(200 + i, "de", docs[i % 9][2]) for i in range(30)]  # copies, in another part
    docs += [(None, None, docs[3][2]), (None, "en", None), (400, None, ""), (401, "en", ""), (401, "en", ""), (7, "fr", docs[7][2]), (500, "en", "x " * 200_000), (501, "en", " lead and trail "), (502, "en", "É " * 100)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 260, 2)] + [(4, 1, 1), (4, 0, None), (None, 1, 1), (9999, 1, 1), (3, None, 1)]
    assert told(spark, docs, labels) == brute(docs, labels)


def test_many_copies_and_ties(spark):
    """A third of all rows are one text; equal doc_ids are not smaller than each other."""
    text = " ".join(f"w{i}" for i in range(120))
    docs = [(i, "en", text) for i in range(300)] + [(0, "en", text), (0, "fr", text)] + [(1000 + i, "en", f"{text} {i}") for i in range(60)]
    got = told(spark, docs, [])
    assert got == brute(docs, []) and got["en", "ABCDE", 5][1] == 299 and got["fr", "EABCD", 1][1] == 0


def test_empty_tables(spark):
    assert told(spark, [], []) == {} and told(spark, [], [(1, 1, 1)]) == {}
    assert told(spark, [(1, "en", "a")], [])["en", "BACDE", 2] == (0, 1, 0, 1, 0, 0, 120)


def test_columns_are_asked_for(spark):
    with pytest.raises(ValueError, match="missing"):
        filters.audit(spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([], LABELS))


def test_table_of_first_failures():
    table = filters.first_failures()
    assert table.shape == (32, 120) and (table[0] == 5).all() and (table[31] == 0).all()
    for mask in range(32):
        for o, order in enumerate(filters.ORDERS):
            assert table[mask, o] == next((s for s, x in enumerate(order) if mask >> "ABCDE".index(x) & 1), 5)


def test_counts_pass_in_parts(monkeypatch):
    """A task that sees many parts passes its arrays on; their sum is the same."""
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array([f"p{i % 7}" for i in range(70)]), pa.array([i % 32 for i in range(70)], pa.int32()), pa.array([i % 4 for i in range(70)], pa.int32()), pa.array(range(70), pa.int64())], names=["part", "mask", "label", "n"])
    whole = {p: np.array(c) for b in filters._counted(iter([rows])) for p, c in zip(b["part"].to_pylist(), b["cells"].to_pylist(), strict=True)}
    monkeypatch.setattr(filters, "PARTS", 2)
    parts: dict = {}
    for b in filters._counted(rows.slice(i, 9) for i in range(0, 70, 9)):
        for p, c in zip(b["part"].to_pylist(), b["cells"].to_pylist(), strict=True):
            parts[p] = parts.get(p, 0) + np.array(c)
    assert set(parts) == set(whole) and all((parts[p] == whole[p]).all() for p in whole)
