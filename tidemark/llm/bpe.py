"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a slice of texts form a trie, which is walked depth
first. A node's state is the last token of the encoding of its prefix (and
where that token begins): of the tokens that end there, the one that may
follow the state at its beginning. "May follow" is a property of two tokens:
encoding their joined symbols gives just them. Words that share a prefix share
its states, so each is computed once. Words sorted by their symbols visit the
trie in that order, and only the states of the current path are kept.

Texts are cut at ASCII white space, which no word of the tokenizer crosses.
What is left, a chunk, is encoded once for as long as it is remembered. The
memory is bounded: when it is full, a new one begins, into which what is met
again moves over from the last one.

Defined results: a null or blank text has no tokens and decodes to the empty
text; bytes that are no UTF-8 count as U+FFFD; strings of special tokens are
those tokens, as the tokenizers library has it; repeated rows each give a row;
further columns are ignored (`report`) or kept (`encode`, `decode`); a text of any length is
encoded whole, as one row of a task; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import marshal
import re
import uuid
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import per_worker, project, text_bytes, trim
from tidemark.llm.decontaminate import slices

#: Chunks, words and pairs of tokens that a worker remembers.
CHUNKS, PAIRS = 150_000, 300_000
#: Chunks longer than this, in bytes, are not remembered.
LONG = 256
#: Bytes of text whose chunks are held together.
SLICE = 2 << 20
#: What a chunk without words comes to.
HOLLOW = (b"", b"")
#: Text for which the rules below are the same as the library's; other text goes through the library's own components.
PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]*")
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next one from U+0100."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(spare)) for b in range(256)]


def prepared(path: str) -> bytes:
    """The tables of a word-end BPE tokenizer file, for Encoder. Their size is the vocabulary's."""
    raw = Path(path).read_text()
    model = json.loads(raw)
    bpe, end = model["model"], model["model"]["end_of_word_suffix"]
    vocab = bpe["vocab"]
    merges = {}
    parts: dict[int, tuple[int, ...]] = {}
    symbols = byte_symbols()
    inner = [vocab[s] for s in symbols]
    last = [vocab[s + end] for s in symbols]
    for i in (*inner, *last):
        parts[i] = (i,)
    for rank, pair in enumerate(bpe["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        x, y, z = vocab[a], vocab[b], vocab[a + b]
        merges.setdefault(x << 20 | y, (rank, z))
        if z not in parts and x in parts and y in parts:
            parts[z] = parts[x] + parts[y]
    names = {i: t for t, i in vocab.items()}
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    names |= {i: t for t, i in special.items()}
    return marshal.dumps((raw, merges, parts, inner, last, names, special))


class Encoder:
    def __init__(self, tables: bytes):
        raw, self.merges, self.parts, self.inner, self.last, self.names, self.special = marshal.loads(tables)
        self.library = raw
        self.normalizer = self.splitter = None
        self.pairs: dict[int, bool] = {}
        #: Tokens by their symbols from the last to the first.
        self.ends: dict = {}
        for t, syms in self.parts.items():
            if self.bpe(syms) == [t]:  # one that its own symbols don't give occurs in no encoding
                node = self.ends
                for s in reversed(syms):
                    node = node.setdefault(s, {})
                node[-1] = t
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.marks = [s.encode() for s in self.special]
        #: (ids in decimal, decoded text) of chunks, of chunks of the memory before, and of words.
        self.chunks: dict[bytes, tuple[bytes, bytes]] = {}
        self.before: dict[bytes, tuple[bytes, bytes]] = {}
        self.known: dict[bytes, tuple[bytes, bytes]] = {}

    def bpe(self, symbols) -> list[int]:
        """Merges by rank, leftmost first; only for the symbols of one or two tokens."""
        out, merges = list(symbols), self.merges
        while len(out) > 1:
            best = min(((merges[p][0], i, merges[p][1]) for i in range(len(out) - 1) if (p := out[i] << 20 | out[i + 1]) in merges), default=None)
            if best is None:
                break
            out[best[1] : best[1] + 2] = [best[2]]
        return out

    def follows(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.bpe(self.parts[a] + self.parts[b]) == [a, b]
        return known

    def traverse(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """(word, token ids) of distinct words, in the order of a depth-first walk."""
        inner, last, ends, pairs, follows = self.inner, self.last, self.ends, self.pairs, self.follows
        path: list[int] = []  # symbols from the root to the present node
        state: list[int] = [-1]  # last token of each prefix
        begin: list[int] = [0]  # where it begins
        before = b""
        for word in sorted(words):
            n = len(word)
            # Keep what the last word's path shares; its last symbol is a word end, and so is shared with no other.
            keep, most = 0, min(len(before) - 1, n - 1)
            while keep < most and before[keep] == word[keep]:
                keep += 1
            del path[keep:], state[keep + 1 :], begin[keep + 1 :]
            for d in range(keep, n):
                path.append(last[word[d]] if d == n - 1 else inner[word[d]])
                node, i, found, at = ends, d, -1, 0
                while i >= 0:
                    node = node.get(path[i])
                    if node is None:
                        break
                    t = node.get(-1)
                    if t is not None:
                        p = state[i]
                        if p < 0:
                            found, at = t, i
                            break
                        ok = pairs.get(p << 20 | t)
                        if ok or ok is None and follows(p, t):
                            found, at = t, i
                            break
                    i -= 1
                state.append(found)
                begin.append(at)
            out, d = [], n
            while d:
                out.append(state[d])
                d = begin[d]
            out.reverse()
            before = word
            yield word, out

    def words(self, chunk: str) -> list:
        """The words of a chunk, as UTF-8; an int is the id of a special token."""
        if PLAIN.fullmatch(chunk):
            return [w.encode() for w in WORD.findall(chunk.lower())]
        if self.splitter is None:
            own = Tokenizer.from_str(self.library)
            self.normalizer, self.splitter = own.normalizer, own.pre_tokenizer
            self.bytes_of = {c: b for b, c in enumerate(byte_symbols())}
        got = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))
        return [bytes(self.bytes_of[c] for c in w) for w, _ in got]

    def learn(self, chunks: list[bytes]) -> None:
        """Encodes chunks that aren't remembered."""
        split: dict[bytes, list] = {}
        for c in chunks:
            if (had := self.before.pop(c, None)) is not None:
                self.chunks[c] = had
                continue
            s = c.decode("utf-8", "replace")
            if self.cut and b"<|" in c and any(m in c for m in self.marks):
                split[c] = [w for piece in self.cut.split(s) if piece for w in ([self.special[piece]] if piece in self.special else self.words(piece))]
            else:
                split[c] = self.words(s)
        known, names = self.known, self.names
        for w, ids in self.traverse(list({w for ws in split.values() for w in ws if type(w) is bytes and w not in known})):
            known[w] = (" ".join(map(str, ids)).encode(), " ".join([names[i] for i in ids]).encode())
        for c, ws in split.items():
            got = [known[w] if type(w) is bytes else (b"%d" % w, names[w].encode()) for w in ws]
            self.chunks[c] = got[0] if len(got) == 1 else (b" ".join([g[0] for g in got]), b" ".join([g[1] for g in got]))

    def encode(self, texts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """(ids in decimal, decoded text) of each text, each joined by spaces."""
        for lo, hi in slices(texts, SLICE):
            split = [t.split() for t in texts[lo:hi]]
            if len(self.chunks) > CHUNKS:
                self.chunks, self.before, self.known = {}, self.chunks, {}
            flat = list(chain.from_iterable(split))
            got = list(map(self.chunks.get, flat))
            if None in got:
                unknown = [i for i, g in enumerate(got) if g is None]
                new = list(dict.fromkeys([flat[i] for i in unknown]))
                self.learn(new)
                for i in unknown:
                    got[i] = self.chunks[flat[i]]
                for c in new:  # what is remembered has a bound in bytes, too
                    if len(c) > LONG:
                        del self.chunks[c]
            end = 0
            for cs in split:
                begin, end = end, end + len(cs)
                own = got[begin:end]
                if HOLLOW in own:  # white space that only Unicode knows
                    own = [g for g in own if g != HOLLOW]
                yield b" ".join([g[0] for g in own]), b" ".join([g[1] for g in own])


def count(ids: bytes) -> int:
    return ids.count(b" ") + 1 if ids else 0


def array(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all, how many of each) of rows of numbers in decimal."""
    return np.fromstring(b" ".join([i for i in ids if i]), dtype=np.int32, sep=" "), np.array([count(i) for i in ids], dtype=np.int64)


def report(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    tables, key = docs.sparkSession.sparkContext.broadcast(prepared(path)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(key, lambda: Encoder(tables.value))
        for batch in batches:
            n, a, b = [], [], []
            for ids, text in encoder.encode(batch.column(1).to_pylist()):
                n.append(count(ids))
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        batch = None
        trim()

    src = project(docs, ["doc_id", "text"]).select("doc_id", text_bytes().alias("body"))
    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with a further column of token ids (array of int); a column of that name is replaced."""
    tables, key = docs.sparkSession.sparkContext.broadcast(prepared(path)), uuid.uuid4().hex

    every = docs.columns
    use = [i for i, c in enumerate(every) if c != ids]
    names, inner = [every[i] for i in use], [f"__c{i}" for i in use]
    placed = docs.toDF(*[f"__c{i}" for i in range(len(every))]).select(*inner)
    src = placed.withColumn("__body", F.coalesce(F.col(inner[names.index(text)]), F.lit("")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(key, lambda: Encoder(tables.value))
        for batch in batches:
            bodies = batch.column(len(inner)).to_pylist()
            for lo, hi in slices(bodies, SLICE):
                got, n = array([i for i, _ in encoder.encode(bodies[lo:hi])])
                col = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(got))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(inner))), col], names=[*inner, "__ids"])
        batch = bodies = part = got = col = None
        trim()

    schema = src.drop("__body").withColumn("__ids", F.lit(None).cast("array<int>")).schema
    return src.mapInArrow(run, schema).toDF(*names, ids)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """encoded with the decoded text of its column of ids; null ids decode to null."""
    names = encoded.sparkSession.sparkContext.broadcast(marshal.loads(prepared(path))[5])

    @F.pandas_udf("string")
    def join(col: pd.Series) -> pd.Series:
        own = names.value
        return col.map(lambda a: None if a is None else " ".join([own[i] for i in a.tolist()]))

    return encoded.withColumn(text, join(F.col(ids)))
