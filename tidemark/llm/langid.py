"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a label. A word's features are its affixes and
character n-grams (hashed byte n-grams of the word with both ends marked: those
with a mark are affixes) and itself (the lexicon of the training words).
Transitions between labels are learned too, so a word takes its neighbours into
account and code-switched text is labelled piecewise. Forward-backward gives
each word's marginals; a text's language is the label with most of their mass,
its score that share.

Training takes a bounded sample: of each language about `sample_docs` texts,
chosen by a hash of doc_id and text (twice as many at most, and none twice), and of each up to `sample_spans` spans of
`span_words` words at hashed places. Spans of equal and of different languages
are joined into training sequences, so that switches are seen. Every language
with a text is learned. Whole texts are predicted, in pieces, whatever their length.

Defined results
* a text that is null or has no letter is `und` with score 0, and so is every
  text where nothing could be learned;
* rows with null lang are predicted but not learned from; a null doc_id counts
  as the empty text in the fold; repeated rows each give a row;
* a text of any length is labelled whole, piece by piece; an empty table gives no rows;
* of equal shares the language that sorts first wins; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fold, per_worker, project, trim
from tidemark.llm.decontaminate import slices

BUCKETS = 1 << 17
ORDERS = (1, 2, 3, 4)
PIECE = 128
#: Chunks whose emissions a worker remembers, and bytes of text it looks at together.
REMEMBERED, SLICE = 200_000, 2 << 20
#: Chunks longer than this, in bytes, are not remembered.
LONG = 256


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, first feature of each word) of marked byte n-grams and whole words."""
    buf = np.frombuffer(b"".join([b"\x02%b\x03" % w for w in words]), dtype=np.uint8).astype(np.uint64)
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    end = np.cumsum(n)
    begin = end - n
    owner = np.repeat(np.arange(len(words)), n)
    last = end[owner]
    ids, who = [], []
    at = np.arange(len(buf))
    h = np.zeros(len(buf), dtype=np.uint64)
    for k in range(1, max(ORDERS) + 1):
        ok = at + k <= last
        nxt = np.zeros(len(buf), dtype=np.uint64)
        nxt[ok] = buf[at[ok] + k - 1]
        h = h * np.uint64(0x100000001B3) + nxt + np.uint64(1)
        if k in ORDERS:
            ids.append(mix(h[ok] + np.uint64(k << 56)))
            who.append(owner[ok])
    power = np.cumprod(np.concatenate([[1], np.full(int(n.max()) - 1 if len(n) else 0, 0x9E3779B97F4A7C15, dtype=np.uint64)]).astype(np.uint64), dtype=np.uint64)
    whole = np.add.reduceat((buf + np.uint64(1)) * power[at - begin[owner]], begin) if len(words) else np.zeros(0, dtype=np.uint64)
    ids.append(mix(whole + np.uint64(99 << 56)))
    who.append(np.arange(len(words)))
    who, ids = np.concatenate(who), np.concatenate(ids)
    order = np.argsort(who, kind="stable")
    counts = np.bincount(who, minlength=len(words))
    return ids[order], np.cumsum(counts) - counts


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((h ^ (h >> np.uint64(29))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def word_of(chunk: bytes) -> bytes:
    """The chunk's letters, in lower case; empty if it has none."""
    s = chunk.decode("utf-8", "replace").lower()
    return (s if s.isalpha() else "".join([c for c in s if c.isalpha()])).encode()


@dataclass
class Field:
    """labels, feature weights [BUCKETS, L], transitions [L, L], starts [L]."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    starts: np.ndarray

    def emissions(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), len(self.labels)), dtype=np.float32)
        for lo in range(0, len(words), 20_000):
            part = words[lo : lo + 20_000]
            ids, first = features(part)
            out[lo : lo + len(part)] = np.add.reduceat(self.weights[ids], first, axis=0)
        return out


def marginals(emit: np.ndarray, lengths: np.ndarray, moves: np.ndarray, starts: np.ndarray, pairs: bool = False):
    """Forward-backward over sequences laid end to end: the words' label marginals [N, L].

    Sequences are cut into pieces of PIECE words. The pieces' transfer matrices are
    multiplied up side by side, boundary vectors pass from piece to piece, and the
    pieces are then filled in side by side. It is exact, and no long sequence is
    walked word by word. With pairs=True also the expected label pairs [L, L].
    """
    lengths = lengths[lengths > 0]
    n, labels = emit.shape
    if not n:
        return (np.zeros((0, labels)), np.zeros((labels, labels))) if pairs else np.zeros((0, labels))
    move = np.exp(moves - moves.max()).astype(np.float32)
    start = np.exp(starts - starts.max()).astype(np.float32)
    e = np.exp(emit - emit.max(axis=1, keepdims=True)).astype(np.float32)
    e = np.maximum(e, 1e-30)
    per = -(-lengths // PIECE)
    seq = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(seq)) - np.repeat(np.cumsum(per) - per, per)
    size = np.minimum(PIECE, lengths[seq] - nth * PIECE)
    place = (np.cumsum(lengths) - lengths)[seq] + nth * PIECE
    order = np.argsort(-size, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    size, place, first = size[order], place[order], (nth == 0)[order]
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(PIECE + 1)]  # pieces longer than t
    scale = lambda x: x / x.max(axis=-1, keepdims=True)
    # Transfer matrices.
    m = np.where(first[:, None, None], np.eye(labels, dtype=np.float32), move) * e[place][:, None, :]
    for t in range(1, PIECE):
        a = active[t]
        if not a:
            break
        step = (m[:a].reshape(-1, labels) @ move).reshape(a, labels, labels) * e[place[:a] + t][:, None, :]
        m[:a] = step / step.max(axis=(1, 2), keepdims=True)
    # Boundary vectors, from piece to piece of all sequences at once.
    into = np.ones((len(order), labels), dtype=np.float32)
    after = np.ones((len(order), labels), dtype=np.float32)
    begin = np.cumsum(per) - per
    into[rank[begin]] = start
    long = np.argsort(-per, kind="stable")
    more = [int(np.searchsorted(-per[long], -j, side="left")) for j in range(int(per.max()))]
    for j in range(1, int(per.max())):
        p = begin[long[: more[j]]] + j
        here, back = rank[p], rank[p - 1]
        into[here] = scale(np.einsum("pi,pij->pj", into[back], m[back]))
    for j in range(int(per.max()) - 1, 0, -1):
        p = begin[long[: more[j]]] + j
        here, back = rank[p], rank[p - 1]
        after[back] = scale(np.einsum("pij,pj->pi", m[here], after[here]))
    # Inside the pieces.
    alpha = np.empty_like(e)
    v = scale(np.where(first[:, None], into, into @ move) * e[place])
    alpha[place] = v
    for t in range(1, PIECE):
        a = active[t]
        if not a:
            break
        v = scale((v[:a] @ move) * e[place[:a] + t])
        alpha[place[:a] + t] = v
    b = after.copy()
    out = np.empty_like(e)
    expected = np.zeros((labels, labels))
    for t in range(PIECE - 1, -1, -1):
        a = active[t]
        if not a:
            continue
        inner = active[t + 1]
        if inner:
            b[:inner] = scale((e[place[:inner] + t + 1] * b[:inner]) @ move.T)
        out[place[:a] + t] = alpha[place[:a] + t] * b[:a]
    out /= out.sum(axis=1, keepdims=True)
    if not pairs:
        return out
    beta = out / np.maximum(alpha, 1e-30)  # up to a factor for each word
    inside = np.ones(n, dtype=bool)
    inside[np.cumsum(lengths) - lengths] = False
    right = np.flatnonzero(inside)
    two = alpha[right - 1][:, :, None] * move[None] * (e[right] * beta[right])[:, None, :]
    expected = (two / two.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return out, expected


def sample(docs: DataFrame, sample_docs: int, sample_spans: int, span_words: int) -> dict[str, list[list[bytes]]]:
    """Spans of words of each language: bounded by the parameters, whatever the size of docs, and however rows repeat."""
    known = docs.where("lang is not null and text is not null").withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit("sample")))
    counts = known.select("lang", "h").distinct().groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return {}
    scale = 1 << 30
    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], min(scale, max(1, scale * sample_docs // r["count"]))) for r in counts])
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    picked = known.where(F.pmod("h", F.lit(scale)) < share).select("h", "lang", words.alias("w"))
    place = lambda i: F.pmod(F.xxhash64("h", i), F.greatest(F.size("w") - span_words, F.lit(0)) + 1)
    each = picked.select("h", "lang", F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(sample_spans)), lambda i: F.slice("w", (place(i) + 1).cast("int"), span_words))).alias("spans"))
    # Rows that repeat are chosen together; each language's texts count once, and no more than twice the number asked for.
    once = each.groupBy("lang", "h").agg(F.min("spans").alias("spans"))
    spans = once.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= 2 * sample_docs).select("lang", "spans")
    out: dict[str, set] = {}
    for r in spans.collect():
        for s in r["spans"]:
            ws = tuple(w for w in (word_of(x.encode()) for x in s) if w)
            if ws:
                out.setdefault(r["lang"], set()).add(ws)
    return {k: [list(w) for w in sorted(v)] for k, v in sorted(out.items())}


def trained(spans: dict[str, list[list[bytes]]], epochs: int = 6, seed: int = 11, rate: float = 0.2) -> Field | None:
    """The field, by AdaGrad on the conditional log-likelihood of joined spans."""
    labels = sorted(spans)
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    n = len(labels)
    vocab: dict[bytes, int] = {}
    coded = {k: [np.array([vocab.setdefault(w, len(vocab)) for w in s]) for s in spans[k]] for k in labels}
    most = max(len(s) for s in coded.values())
    sequences = []
    for i, k in enumerate(labels):
        own = coded[k]
        for j in range(most):  # languages weigh alike
            words, tags = [own[j % len(own)]], [np.full(len(own[j % len(own)]), i)]
            for _ in range(int(rng.integers(0, 3)) if n > 1 and rng.random() < 0.4 else 0):
                o = int(rng.integers(n))
                s = coded[labels[o]][int(rng.integers(len(coded[labels[o]])))]
                s = s[: int(rng.integers(3, 31))]
                words.append(s)
                tags.append(np.full(len(s), o))
            sequences.append((np.concatenate(words), np.concatenate(tags)))
    ids, first = features(list(vocab))
    count = np.diff(np.r_[first, len(ids)])
    weights, moves, starts = np.zeros((BUCKETS, n), dtype=np.float32), np.zeros((n, n)), np.zeros(n)
    sq = [np.full_like(weights, 1e-2), np.full_like(moves, 1e-2), np.full_like(starts, 1e-2)]
    for _ in range(epochs):
        shuffled = rng.permutation(len(sequences))
        for lo in range(0, len(shuffled), 64):
            batch = [sequences[i] for i in shuffled[lo : lo + 64]]
            words, tags = np.concatenate([w for w, _ in batch]), np.concatenate([t for _, t in batch])
            lengths = np.array([len(w) for w, _ in batch])
            used, where = np.unique(words, return_inverse=True)
            flat = np.concatenate([np.arange(first[w], first[w] + count[w]) for w in used])
            feat, head = ids[flat], np.cumsum(count[used]) - count[used]
            emit = np.add.reduceat(weights[feat], head, axis=0)[where]
            got, expected = marginals(emit, lengths, moves, starts, pairs=True)
            gold = np.zeros_like(got)
            gold[np.arange(len(tags)), tags] = 1
            residual = np.zeros((len(used), n), dtype=np.float32)
            np.add.at(residual, where, gold - got)
            inside = np.ones(len(tags), dtype=bool)
            begin = np.cumsum(lengths) - lengths
            inside[begin] = False
            seen = np.zeros((n, n))
            np.add.at(seen, (tags[np.flatnonzero(inside) - 1], tags[inside]), 1)
            touched, to = np.unique(feat, return_inverse=True)
            g = np.zeros((len(touched), n), dtype=np.float32)
            np.add.at(g, to, np.repeat(residual, count[used], axis=0))
            g = g / len(batch) - 1e-4 * weights[touched]
            sq[0][touched] += g * g
            weights[touched] += rate * g / np.sqrt(sq[0][touched])
            for x, q, d in ((moves, sq[1], (seen - expected) / len(batch) - 1e-3 * moves), (starts, sq[2], (gold[begin] - got[begin]).sum(axis=0) / len(batch) - 1e-3 * starts)):
                q += d * d
                x += rate * d / np.sqrt(q)
    return Field(labels, weights, moves, starts)


def label(field: Field, texts: list[bytes], known: dict[bytes, int], emit: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words' marginals [n, L], places of the words among the chunks) of each text."""
    for lo, hi in slices(texts, SLICE):
        split = [t.split() for t in texts[lo:hi]]
        if max(len(known), sum(map(len, emit))) > REMEMBERED:
            known.clear()
            emit.clear()
        new = [c for c in {c for cs in split for c in cs} if c not in known]
        if new:
            words = [word_of(c) for c in new]
            some = [w for w in words if w]
            base = sum(map(len, emit))
            if some:
                emit.append(field.emissions(some))
            k = iter(range(base, base + len(some)))
            known.update((c, next(k) if w else -1) for c, w in zip(new, words, strict=True))
        table = np.concatenate(emit) if emit else np.zeros((0, len(field.labels)), dtype=np.float32)
        emit[:] = [table] if len(table) else []
        ids = [np.fromiter(map(known.__getitem__, cs), dtype=np.int64, count=len(cs)) for cs in split]
        at = [np.flatnonzero(i >= 0) for i in ids]
        flat = np.concatenate([i[a] for i, a in zip(ids, at, strict=True)])
        lengths = np.array([len(a) for a in at])
        got = marginals(table[flat], lengths, field.moves, field.starts)
        for c in new:
            if len(c) > LONG:
                del known[c]
        for a, end in zip(at, np.cumsum(lengths), strict=True):
            yield got[end - len(a) : end], a


def fitted(docs: DataFrame, sample_docs: int = 150, sample_spans: int = 6, span_words: int = 30) -> Field | None:
    """The field learned from the rows of docs outside the held-out fold."""
    return trained(sample(docs.where(fold(4) != 2), sample_docs, sample_spans, span_words))


def predicted(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """docs (any columns) with __lang and __score."""
    names = docs.columns
    inner = [f"__c{i}" for i in range(len(names))]
    model, key = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(field)), uuid.uuid4().hex
    src = docs.toDF(*inner).withColumn("__body", F.coalesce(F.col(inner[names.index(text)]), F.lit("")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, emit = per_worker(key, lambda: (cloudpickle.loads(model.value), {}, []))
        for batch in batches:
            langs, scores = [], []
            bodies = batch.column(len(inner)).to_pylist()
            for got, _ in label(own, bodies, known, emit) if own else ((np.zeros((0, 1)), None) for _ in bodies):
                if len(got):
                    mass = got.sum(axis=0, dtype=np.float64)
                    best = int(mass.argmax())
                    langs.append(own.labels[best])
                    scores.append(float(mass[best] / mass.sum()))
                else:
                    langs.append("und")
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(inner))), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*inner, "__lang", "__score"])
        batch = bodies = None
        trim()

    schema = src.drop("__body").withColumns({"__lang": F.lit("").cast("string"), "__score": F.lit(None).cast("double")}).schema
    return src.mapInArrow(run, schema).toDF(*names, "__lang", "__score")


def report(docs: DataFrame, **options) -> DataFrame:
    """The contract's columns: doc_id, held_out, lang_pred, score."""
    own = project(docs, ["doc_id", "text", "lang"])
    out = predicted(own.select("doc_id", "text"), fitted(own, **options))
    return out.select("doc_id", (fold(4) == 2).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


def accepted(docs: DataFrame, least_score: float = 0.5, **options) -> DataFrame:
    """The rows of docs, all columns, whose text has a language with at least least_score of its words."""
    names = docs.columns
    field = fitted(project(docs, ["doc_id", "text", "lang"]), **options)
    out = predicted(docs, field)
    inner = [f"__c{i}" for i in range(len(names))]
    return out.toDF(*inner, "__lang", "__score").where((F.col("__lang") != "und") & (F.col("__score") >= least_score)).select(*inner).toDF(*names)
