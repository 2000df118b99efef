import itertools

import numpy as np
import pytest

from tidemark.llm import langid


@pytest.mark.parametrize("piece", [2, 3, 128])
def test_forward_backward_is_exact(piece, monkeypatch):
    monkeypatch.setattr(langid, "PIECE", piece)
    rng = np.random.default_rng(1)
    lengths = np.array([1, 6, 0, 4, 7, 2])
    emit, moves, starts = rng.normal(size=(20, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, pairs = langid.marginals(emit, lengths, moves, starts, pairs=True)
    want, two, at = np.zeros((20, 3)), np.zeros((3, 3)), 0
    for n in lengths:
        paths = list(itertools.product(range(3), repeat=int(n))) if n else []
        p = np.array([np.exp(starts[y[0]] + sum(emit[at + i, y[i]] for i in range(n)) + sum(moves[y[i - 1], y[i]] for i in range(1, n))) for y in paths])
        for y, q in zip(paths, p / p.sum() if n else [], strict=True):
            for i in range(n):
                want[at + i, y[i]] += q
                if i:
                    two[y[i - 1], y[i]] += q
        at += n
    assert np.allclose(got, want, atol=1e-4)
    assert np.allclose(pairs, two, atol=1e-3)


def test_held_out_accuracy(spark):
    from tidemark.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op2_langid"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"]]
    assert 200 < len(held) < 300
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_code_switching_and_odd_rows(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text").collect()
    spans = {k: [[w for w in (langid.word_of(c.encode()) for c in r["text"].split()) if w][:60] for r in rows if r["lang"] == k][:80] for k in ("en", "de")}
    field = langid.trained({k: [s for s in v[:60] if s] for k, v in spans.items()})
    mixed = b" ".join(spans["en"][70][:25] + spans["de"][70][:25])
    ((got, _),) = langid.label(field, [mixed], {}, [])
    tags = got.argmax(axis=1)
    assert (tags[:23] == field.labels.index("en")).mean() > 0.9
    assert (tags[-23:] == field.labels.index("de")).mean() > 0.9
    odd = [(1, None, "en"), (2, "", "en"), (3, "12 34 !!", "en"), (4, rows[0]["text"], None), (None, rows[1]["text"], rows[1]["lang"]), (5, "word " * 50_000, "en"), (5, "word " * 50_000, "en"), (6, "ça-va 1", "fr")]
    df = spark.createDataFrame([(*r, "x") for r in odd], "doc_id long, text string, lang string, LANG string")
    out = langid.report(df).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in out if r["doc_id"] in (1, 2, 3)) == [(1, "und"), (2, "und"), (3, "und")]
    assert len(out) == len(odd) and all(r["lang_pred"] != "und" for r in out if r["doc_id"] not in (1, 2, 3))
    assert langid.report(df.limit(0)).count() == 0
    nothing = langid.report(df.toDF("doc_id", "text", "lang", "LANG2").withColumn("lang", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast("string")))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    kept = langid.accepted(df)
    assert kept.columns == df.columns and kept.count() == 5


def test_equal_doc_ids_are_sampled_by_text(spark):
    rows = [(None, "the cat and the dog of the house number %d" % i, "en") for i in range(300)] + [(None, "der hund und die katze im haus nummer %d" % i, "de") for i in range(300)]
    rows += [(9, "le chat et le chien de la maison", "fr")] * 3000  # 9 is not held out
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spans = langid.sample(df, 20, 2, 5)
    assert set(spans) == {"en", "de", "fr"} and len(spans["en"]) > 5 and all(len(v) <= 80 for v in spans.values())
    got = langid.predicted(df.distinct(), langid.fitted(df))
    assert got.where("__lang <> lang").count() == 0


def test_forward_backward_equals_enumeration():
    """Marginals of all label sequences of short texts, one sequence at a time."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(4)
    for n, k in ((1, 3), (2, 2), (5, 3)):
        emit, moves, starts = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
        want = np.zeros((n, k))
        for seq in itertools.product(range(k), repeat=n):
            w = np.exp(starts[seq[0]] + sum(emit[i, s] for i, s in enumerate(seq)) + sum(moves[a, b] for a, b in itertools.pairwise(seq)))
            for i, s in enumerate(seq):
                want[i, s] += w
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose(langid.marginals(emit.astype(np.float32), np.array([n]), moves, starts), want, atol=1e-4)
