import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import shards

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 65537])
def test_permutation(n):
    p, q = shards.Permutation(n, 1), shards.Permutation(n, 2)
    x = np.arange(n)
    y = p.walk(x)
    assert sorted(y.tolist()) == list(range(n))
    assert (p.walk(y, back=True) == x).all()
    if n >= 1000:
        assert (y != q.walk(x)).mean() > 0.99
        assert abs(np.corrcoef(x, y)[0, 1]) < 0.1


def stream(rows):
    """Texts' ids, each with the end, as the library encodes them."""
    own = shards.encoding(open(PATH, "rb").read())
    return [(i, [*own.encode_ordinary(t or ""), 50256]) for i, t in rows]


def numbered(out, got):
    """Records in the order of their numbers, without padding, joined."""
    records = list(shards.read(out))
    at = sorted(got, key=lambda r: r["number"])
    return [x for r in at for x in records[r["slot"]][: r["n_tokens"]].tolist()]


def test_round_trip(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = f"file://{tmp_path}/shards"
    got = shards.materialise(docs, PATH, out, key=7, length=64, per_shard=100).collect()
    records = list(shards.read(out))
    assert len(got) == len(records)
    assert sorted(r["slot"] for r in got) == sorted(r["number"] for r in got) == list(range(len(got)))
    want = stream([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert numbered(out, got) == [x for _, ids in want for x in ids]  # a single file: one partition, in order
    owner = [i for i, ids in want for _ in ids]
    for r in got:
        assert r["record_sha256"] == hashlib.sha256(records[r["slot"]].tobytes()).hexdigest()
        assert (r["shard"], r["byte_offset"]) == (r["slot"] // 100, r["slot"] % 100 * 128)
        assert r["doc_ids"] == list(dict.fromkeys(owner[r["number"] * 64 : r["number"] * 64 + 64]))
    assert [x.tolist() for x in shards.read(out, 333, 555)] == [x.tolist() for x in records[333:555]]
    again = shards.materialise(docs, PATH, out, key=7, length=64, per_shard=100)
    assert again.count() == len(got) and len(list((tmp_path / "shards").iterdir())) == math.ceil(len(got) / 100) + 1


def test_many_partitions_and_odd_rows(spark, tmp_path, monkeypatch):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x y z"), (3, "x y z"), (4, "word " * 20_000)] * 5
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, TEXT string, slot int").repartition(5)
    out = f"file://{tmp_path}/odd"
    got = shards.materialise(df, PATH, out, length=8, per_shard=5000).collect()
    flat, texts = numbered(out, got), []
    while flat:
        n = flat.index(50256) + 1
        texts.append(flat[:n])
        flat = flat[n:]
    assert sorted(texts) == sorted(ids for _, ids in stream(rows))
    assert sum(r["n_tokens"] < 8 for r in got) <= 5
    assert shards.materialise(df.limit(0), PATH, f"file://{tmp_path}/none").count() == 0
    assert list(shards.read(f"file://{tmp_path}/none")) == []


def test_query(spark):
    from tidemark.llm.queries import QUERIES

    got = QUERIES["op8_shards"](spark, "/root/testdata/sf0.001").collect()
    want = stream([(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])
    assert sum(r["n_tokens"] for r in got) == sum(len(ids) for _, ids in want)
    assert {d for r in got for d in r["doc_ids"]} == {i for i, _ in want}


def test_words_are_cut_as_the_vocabulary_says():
    """The pattern cuts as the vocabulary's own one does, at any run of spaces, ends of lines, letters, numbers and marks."""
    own = shards.encoding(open(PATH, "rb").read())
    plain = tiktoken.Encoding("plain", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", mergeable_ranks=own._mergeable_ranks, special_tokens={})
    assert "\\p{L}++" in own._pat_str
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u2003", "\u0085", "a", "Zoë", "'s", "'re", "'", "'x", "12", "½", "٣", ".", "--", "e\u0301", "\U0001f600", "\x00", "日本"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randrange(12)))
        assert own.encode_ordinary(text) == plain.encode_ordinary(text), repr(text)


def test_texts_are_cut_before_the_last_space_of_a_run():
    """A faster pattern without a look ahead gives the same ids, as texts are cut where a run of spaces gives its last one to a word."""
    vocabulary = open(PATH, "rb").read()
    own, cut = shards.encoding(vocabulary), shards.encoding(vocabulary, shards.CUT_PATTERN)
    assert "(?!" not in cut._pat_str
    for c in range(0x3100):  # white space is what the pattern calls so
        text = f"a{chr(c)}{chr(c)}{chr(c)}b {chr(c)}c{chr(c)} d{chr(c)}"
        assert shards.encoded(cut, text).tolist() == own.encode_ordinary(text), repr(text)
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\r\n", "\t", "\x1c", "\u00a0", "\u2003", "\u200b", "\u0085", "a", "Zoë", "'s", "'re", "'", "'x", "12", "½", "٣", ".", "--", "<|end|>", "e\u0301", "\U0001f600", "\x00", "日本"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert shards.encoded(cut, text).tolist() == own.encode_ordinary(text), repr(text)
