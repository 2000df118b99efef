import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \t\n", "Hello, WORLD! it's they'll 'd 1234 5x6", "<|endoftext|>a <|startoftext|><|endoftext|>b <|START|>", "naïve ÀÉÎ ß ŒUVRE ﬁ ẞ İstanbul ΑΣ ΣΑΣ",
    "é ́x a b c　d\x1ce\x85f\x0bg\x0ch", "日本語のテキスト ١٢٣ ²³ ½ ª º µ × ÷", "👩‍👩‍👧 🏳️‍🌈 ﻿x​z", "a\x00b\x01\x7f", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa " + "ha" * 300, "'s's't ''re 're've'm", "   ", "x" * 3000, "<|endoftext|>" * 3,
]


def want(texts):
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    out = []
    for x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        out.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def test_against_the_library(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    got = list(bpe.Encoder(bpe.prepared(PATH)).encode([r["text"].encode() for r in rows] + [t.encode() for t in ODD]))
    assert [(bpe.count(i), hashlib.sha256(i).hexdigest(), hashlib.sha256(d).hexdigest()) for i, d in got] == want([r["text"] for r in rows] + ODD)


@pytest.mark.parametrize("seed", range(4))
def test_random_strings(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(bpe, "CHUNKS", 50)
    monkeypatch.setattr(bpe, "PAIRS", 50)
    kinds = ["abcdefghijklmnopqrstuvwxyz", "aeinorst", "th'srevmld ", "éèüñßaeo ", "".join(map(chr, range(32, 127))), "".join(chr(rng.randrange(1, 0xD7FF)) for _ in range(60)) + " a"]
    texts = ["".join(rng.choice(kinds[i % 6]) for _ in range(rng.randint(0, 40))) for i in range(3000)]
    got = [(bpe.count(i), hashlib.sha256(i).hexdigest(), hashlib.sha256(d).hexdigest()) for i, d in bpe.Encoder(bpe.prepared(PATH)).encode([t.encode() for t in texts])]
    bad = [t for t, g, w in zip(texts, got, want(texts), strict=True) if g != w]
    assert not bad


def test_query_and_tables(spark):
    from tidemark.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op4_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert got == dict(zip([r["doc_id"] for r in rows], want([r["text"] for r in rows]), strict=True))
    odd = spark.createDataFrame([(1, None, 5, "k"), (1, None, 5, "k"), (None, "Hi there", 6, "k")], "doc_id long, text string, ids int, TEXT string")
    assert sorted((r["n_tokens"] for r in bpe.report(odd, PATH).collect())) == [0, 0, 2]
    assert bpe.report(odd.limit(0), PATH).count() == 0
    coded = bpe.decode(bpe.encode(odd, PATH), PATH)
    assert sorted((r["decoded"], len(r["ids"])) for r in coded.collect()) == [("", 0), ("", 0), ("hi</w> there</w>", 2)]
