import re

import corpus_pipeline
import public_tokenizers
import pytest
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

from tidemark.llm import langid, secrets
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    return {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}


def plain_words(text):
    return [w for w in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def test_against_plain_version(spark, result):
    """Every stage's decision, made over on the driver; the trained models' verdicts are asked for one text at a time."""
    rows = [r.asDict() for r in table(spark, SF, "documents").collect()]
    field = langid.fitted(table(spark, SF, "documents"))

    def speaks(text):
        ((got, _),) = langid.label(field, [text.encode()], {}, [])
        return len(got) and got.sum(axis=0).max() / len(got) >= 0.5

    rows = [r for r in rows if speaks(r["text"])]
    comp = brute_components([r["doc_id"] for r in rows], [brute_fingerprint(r["text"], 5) for r in rows])
    rows = [r for r, c in zip(rows, comp, strict=True) if r["doc_id"] == c]
    windows = set()
    for b in table(spark, SF, "benchmark").collect():
        w = plain_words(b["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    rows = [r for r in rows if not any(tuple(w[i : i + n]) in windows for w in [plain_words(r["text"])] for n in sizes for i in range(len(w) - n + 1))]
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(docs).collect()}
    for r in rows:
        assert ("[SECRET]" in clean[r["doc_id"]]) == bool(re.search('token = "[0-9a-f]{40}"', r["text"]))
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: t.encode(x, add_special_tokens=False).ids for d, x in clean.items()}
    assert result == want


def test_stages_keep_columns(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "of the and to in is", "en", "s", 19), (3, "of the and to in is", None, None, None), (3, "of the and to in is", None, None, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            now = spark.createDataFrame(stage(spark, now, SF).collect(), stage(spark, now, SF).schema)
        assert [(r["doc_id"], r["n_tokens"]) for r in now.collect()] == ([] if empty else [(3, 6)])  # the row without doc_id is a copy


def test_clashing_names(spark):
    """Every stage keeps columns whose names differ in case only, and redacts the right one."""
    text = 'of the and to in is\ntoken = "' + "0123456789abcdef0123456789abcdef01234567" + '"'
    rows = [(1, text, "en", "s", len(text), "A", "B", -1), (2, "of the and to in is " * 3000, "en", "s", 60000, "A", "B", -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string, Lang string, N_CHARS int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = sorted(tuple(r) for r in corpus_pipeline.redact_secrets(spark, docs, SF).collect())
    assert got[1] == rows[1] and got[0][1] == 'of the and to in is\ntoken = "[SECRET]"' and got[0][4] == len(got[0][1]) and got[0][5:] == rows[0][5:]
    assert corpus_pipeline.encode(spark, docs, SF).columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
