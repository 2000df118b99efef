"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned for in whole texts.

Words are the maximal runs of digits, ASCII letters (A-Z lower-cased) and
non-ASCII characters. A window is `size` consecutive words of a benchmark item;
an item of fewer words, but not none, is one window. A word of a document is
hit if it lies in any occurrence of any window.

Defined results
* a null text has no words (0 words, nothing hit);
* a benchmark row whose text or item_id is null takes no part;
* repeated benchmark rows and items with equal windows are all named, each item_id once;
* repeated document rows give one result each; an empty benchmark hits nothing;
* a text of any length is scanned whole, as one row of a task; an empty table gives no rows;
* further columns, whatever their names, are ignored by `scan` and kept by `clean`.

Only n-grams whose size has been checked are broadcast: items are cut into
overlapping pieces (so that every window lies in one), and the pieces are dealt
into blocks of about `block_words` words. Documents pass every block in turn.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import project, text_bytes, written

#: Lower-cases A-Z and turns every byte that is no part of a word to a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
PIECE_WORDS = 10_000
BLOCK_WORDS = 2_000_000
#: Bytes of text that are looked at together.
SLICE = 8 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Windows:
    """The distinct windows of a block of items, by length, with the items they come from."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        vocab: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [vocab.setdefault(w, len(vocab)) for w in words]
            for i in range(max(1, len(ids) - size + 1) if ids else 0):
                found.setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.vocab, self.items, self.by_length = vocab, [], []
        lengths: dict[int, list[tuple[int, ...]]] = {}
        for w in found:
            lengths.setdefault(len(w), []).append(w)
        for length, ws in sorted(lengths.items()):
            rows = np.array(ws, dtype=np.int64)
            factor = np.uint64(0x9E3779B97F4A7C15)
            while True:
                keys = self.keys(rows.astype(np.uint64), factor)
                order = np.argsort(keys, kind="stable")
                if len(np.unique(keys)) == len(keys):
                    break
                factor += np.uint64(2)
            first = len(self.items)
            self.items += [sorted(found[ws[i]]) for i in order]
            self.by_length.append((length, factor, keys[order], rows[order], first))

    @staticmethod
    def keys(rows: np.ndarray, factor: np.uint64) -> np.ndarray:
        h = np.zeros(len(rows), dtype=np.uint64)
        for j in range(rows.shape[1]):
            h = h * factor + rows[:, j] + np.uint64(1)
        return h

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, positions, windows) of what occurs in ids; negative ids match nothing."""
        bad = np.concatenate([[0], np.cumsum(ids < 0)])
        for length, factor, keys, rows, first in self.by_length:
            if len(ids) < length:
                continue
            at = np.flatnonzero(bad[length:] == bad[: len(bad) - length])
            h = np.zeros(len(at), dtype=np.uint64)
            for j in range(length):
                h = h * factor + ids[at + j].astype(np.uint64) + np.uint64(1)
            k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero(keys[k] == h)
            at, k = at[hit], k[hit]
            same = np.ones(len(at), dtype=bool)
            for j in range(length):  # an equal key is only a candidate: compare the words
                same &= rows[k, j] == ids[at + j]
            if same.any():
                yield length, at[same], k[same] + first


def _scan(texts: list[bytes], windows: Windows) -> Iterator[tuple[int, np.ndarray, set[str]]]:
    """(words, mask of hit words, items) of each text."""
    get, ids, ends = windows.vocab.get, [], []
    for t in texts:
        ids += [get(w, -1) for w in words_of(t)]
        ends.append(len(ids))
        ids.append(-1)  # no window reaches into the next text
    arr = np.array(ids, dtype=np.int64)
    step = np.zeros(len(arr) + 1, dtype=np.int64)
    pairs = []
    for length, at, k in windows.occurrences(arr):
        np.add.at(step, at, 1)
        np.add.at(step, at + length, -1)
        pairs.append(np.unique(np.stack([np.searchsorted(ends, at, side="right"), k], axis=1), axis=0))
    mask = np.cumsum(step[:-1]) > 0
    items: dict[int, set[str]] = {}
    for p in pairs:
        for doc, k in p.tolist():
            items.setdefault(doc, set()).update(windows.items[k])
    start = 0
    for d, end in enumerate(ends):
        yield end - start, mask[start:end], items.get(d, set())
        start = end + 1


def without(text: bytes, mask: np.ndarray) -> bytes:
    """text without the bytes of the hit words; what lies between two of them that are neighbours goes too."""
    if not mask.any():
        return text
    spans = [m.span() for m in WORD.finditer(text)]
    out, last, n = [], 0, len(spans)
    i = 0
    while i < n:
        if mask[i]:
            j = i
            while j + 1 < n and mask[j + 1]:
                j += 1
            out.append(text[last : spans[i][0]])
            last = spans[j][1]
            i = j
        i += 1
    out.append(text[last:])
    return b"".join(out)


def slices(texts: list[bytes], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about most bytes; a longer text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def blocks(benchmark: DataFrame, size: int, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items' pieces, in blocks of about block_words words, one block on the driver at a time."""
    words = F.filter(F.split(F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    step = max(1, PIECE_WORDS - size + 1)
    pieces = (
        project(benchmark, ["item_id", "text"])
        .where("item_id is not null and text is not null")
        .select(F.col("item_id").cast("string").alias("item"), words.alias("words"))
        .where(F.size("words") > 0)
        .select("item", F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)), F.lit(step)), lambda s: F.slice("words", s + 1, PIECE_WORDS))).alias("piece", "words"))
        .select("item", "words")
        .distinct()  # rows may repeat
    )
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-total // block_words))
    for b in range(n):
        rows = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == b).collect()
        yield [(r["item"], [w.encode() for w in r["words"]]) for r in rows]


def _pass(docs: DataFrame, windows) -> DataFrame:
    """One block's pass: adds to the mask of hit words (packed bits) and to the items of every row."""
    out = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pickle.loads(windows.value)
        for batch in batches:
            names = batch.schema.names
            text = batch.column(names.index("__text"))
            for lo, hi in slices(text.to_pylist()):
                part = batch.slice(lo, hi - lo)
                cols = {n: part.column(i) for i, n in enumerate(names)}
                words, masks, items = [], [], []
                for (n, mask, its), had, old in zip(_scan(cols["__text"].to_pylist(), found), cols["__mask"].to_pylist(), cols["__items"].to_pylist(), strict=True):
                    if had:
                        mask = mask | np.unpackbits(np.frombuffer(had, dtype=np.uint8), count=n).astype(bool)
                    words.append(n)
                    masks.append(np.packbits(mask).tobytes() if mask.any() else b"")
                    items.append(sorted(its.union(old or ())))
                cols |= {"__words": pa.array(words, pa.int64()), "__mask": pa.array(masks, pa.binary()), "__items": pa.array(items, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return docs.mapInArrow(run, out)


def _scanned(docs: DataFrame, benchmark: DataFrame, size: int, block_words: int) -> DataFrame:
    """docs, having __text, with __words, __mask and __items."""
    spark = docs.sparkSession
    now = docs.withColumns({"__words": F.lit(None).cast("long"), "__mask": F.lit(None).cast("binary"), "__items": F.lit(None).cast("array<string>")})
    for b, items in enumerate(blocks(benchmark, size, block_words)):
        if b:
            now = written(now, "decontaminate")
        now = _pass(now, spark.sparkContext.broadcast(cloudpickle.dumps(Windows(items, size))))
    return now


def scan(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted), of each row of docs."""
    at = _scanned(project(docs, ["doc_id", "text"]).select("doc_id", text_bytes().alias("__text")), benchmark, size, block_words)
    return at.select("doc_id", F.col("__words").alias("n_words"), _ones("__mask").alias("n_hit"), F.col("__items").alias("item_ids"))


def _ones(column: str):
    """Bits set in a packed mask, from its hex digits."""
    digits = F.hex(F.col(column))
    weight = {1: "1248", 2: "3569AC", 3: "7BDE", 4: "F"}
    return sum((F.length(digits) - F.length(F.translate(digits, chars, ""))) * n for n, chars in weight.items()).cast("long")


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with all their columns, without what the benchmark holds.

    remove="documents" leaves out every document with a hit; remove="spans" cuts
    the hit words out of the texts. A null text stays null.
    """
    names = docs.columns
    inner = [f"__c{i}" for i in range(len(names))]
    text = inner[names.index("text")]
    placed = docs.toDF(*inner)
    at = _scanned(placed.withColumn("__text", F.coalesce(F.col(text), F.lit("")).cast("binary")), benchmark, size, block_words)
    if remove == "documents":
        return at.where(F.length("__mask") == 0).select(*inner).toDF(*names)
    if remove != "spans":
        raise ValueError("remove is 'spans' or 'documents'")

    @F.pandas_udf("binary")
    def cut(body: pd.Series, words: pd.Series, mask: pd.Series) -> pd.Series:
        bits = [np.unpackbits(np.frombuffer(m, dtype=np.uint8), count=int(n)).astype(bool) for n, m in zip(words, mask, strict=True)]
        return pd.Series([without(bytes(t), b) for t, b in zip(body, bits, strict=True)], dtype=object)

    kept = F.when(F.length("__mask") == 0, F.col(text)).otherwise(F.decode(cut("__text", "__words", "__mask"), "UTF-8"))
    return at.withColumn("__kept", kept).select(*[F.col("__kept") if c == text else F.col(c) for c in inner]).toDF(*names)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The contract's columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs, benchmark, **options)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
