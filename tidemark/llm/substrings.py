"""Substring deduplication by content-defined chunks.

A gear rolling hash over the text's bytes sets the cuts: a cut depends on the
WINDOW bytes before it and on nothing else, so an insertion moves later chunks
but changes only the one or two it touches. Chunks get a 96-bit digest; a
digest found at more than one place is repeated. Repeated chunks that follow
each other form a run. A run of at least `min_bytes` and `min_words` words is a
repeated passage. A shorter one may end inside the chunks beside it: where those
would make up the words, the texts decide. Every place of a chunk that such a
passage must hold gives its windows of `min_words` words around it, and the run
is a passage if one of its windows is found at another place. Of a repeated
passage's chunks the first occurrence, in the order of doc_id, stays; the others
are removed.

Chunks under SHORT bytes say nothing by themselves: they are part of the next longer
chunk, and of its digest; those at the text's end are looked up as one. So each byte
of a text is in one chunk that is looked up, and goes or stays with it.

A digest's first and last document combine on the map side, and the join that
brings them back is on plain keys, so AQE splits a digest that many documents
hold. Runs are formed in one pass over sorted rows, not group by group. Windows
are counted on the map side before they meet; a place gives at most min_words
and a few of them.

Defined results
* rows equal in doc_id and text are one document, and each gets its result; other
  texts under the same doc_id, or under none, are documents of their own;
* a null doc_id sorts last; of equal doc_ids the hash of the text says which is first;
* a null or empty text has no chunks: 0 bytes, not repeated; an empty table gives no rows;
* a text of any length is cut whole, its chunks in a task's memory;
* equal rows of one task are cut once;
* `repeated` needs another document; copies within one document are removed too,
  but alone don't set it; further columns are ignored by `report`, kept by `deduplicated`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, project, written
from tidemark.llm.decontaminate import slices

#: Bytes that a cut depends on, a chunk's mean size, and the least size that is looked up by itself.
WINDOW, MEAN, SHORT = 24, 24, 8
#: Words by which a chunk's place in a run may be off, as words may begin before it.
SLACK = 2
#: What is told of a chunk beside its place, in one number: words in it with the short ones before it,
#: words beside to the left and right; each counted up to a bound.
BITS = {"span": (30, 28), "before": (15, 15), "after": (0, 15)}
GEAR = np.array([int.from_bytes(xxhash.xxh64(bytes([b]), seed=3).digest()[:4], "big") for b in range(256)], dtype=np.uint32)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def cuts(buf: np.ndarray) -> np.ndarray:
    """Mask of the bytes after which a chunk ends, wherever texts begin and end."""
    h = GEAR[buf]
    reach = 1
    while reach < 32:  # doubling: the hash of 2n bytes from two of n bytes
        h[reach:] += h[:-reach].copy() << np.uint32(reach)
        reach *= 2
    # Bits 8 to 23 depend on the last WINDOW bytes.
    cut = ((h >> np.uint32(8)) & np.uint32(0xFFFF)) < np.uint32(65536 // MEAN)
    cut[:-1] &= (buf[1:] & 0xC0) != 0x80  # never inside a character
    return cut


def chunked(texts: list[bytes], tails: bool = False) -> dict[str, np.ndarray]:
    """The chunks of SHORT bytes or more, with tails also the last one of each text.

    doc (place in texts), start, size, lead (bytes of the short chunks before it), gap and own (bytes and
    words up to the next one), and what BITS names.
    """
    n = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if not len(buf):
        return {k: np.zeros(0, dtype=np.int64) for k in ("doc", "start", "size", "lead", "own", "gap", "span", "before", "after")}
    text_end = np.cumsum(n)
    text_begin = text_end - n
    cut = cuts(buf)
    # What the hash took from the text before is not the text's own: no cut in the first WINDOW bytes.
    for k in range(WINDOW - 1):
        at = text_begin + k
        cut[at[at < text_end]] = False
    cut[text_end[n > 0] - 1] = True
    end = np.flatnonzero(cut) + 1
    start = np.concatenate([[0], end[:-1]])
    doc = np.searchsorted(text_end, start, side="right")
    gap = SPACE[buf]
    opens = ~gap
    opens[1:] &= gap[:-1]
    opens[text_begin[n > 0]] = ~gap[text_begin[n > 0]]
    total = np.concatenate([[0], np.cumsum(opens)])
    at_start, at_end, base = total[start], total[end], total[text_begin[doc]]
    # Beside a chunk a passage may reach to the far end of the next one that is looked up, or of the text;
    # to the left WINDOW bytes more, within which cuts still depend on what stands before the passage.
    long = end - start >= SHORT
    use = np.flatnonzero(long | (end == text_end[doc]) if tails else long)
    after = total[text_end[doc]] - at_end
    own, gap = total[text_end[doc]] - at_start, text_end[doc] - end
    same = doc[use[1:]] == doc[use[:-1]]
    left, right = use[:-1][same], use[1:][same]
    opened = text_begin[doc]  # where the short chunks before a chunk begin
    opened[right] = end[left]
    before = total[opened] - base
    before[right] = at_end[left] - total[np.maximum(opened[left] - WINDOW, text_begin[doc[left]])]
    after[left] = at_end[right] - at_end[left]
    own[left] = at_start[right] - at_start[left]
    gap[left] = start[right] - end[left]
    out = {"doc": doc, "start": start - text_begin[doc], "size": end - start, "lead": start - opened, "own": own, "gap": gap, "span": at_end - total[opened], "before": before, "after": after}
    return {k: v[use] for k, v in out.items()}


def packed(c: dict[str, np.ndarray]) -> np.ndarray:
    out = np.zeros(len(c["doc"]), dtype=np.int64)
    for k, (shift, bits) in BITS.items():
        out |= np.minimum(c[k], (1 << bits) - 1) << shift
    return out


def unpacked(meta: np.ndarray, k: str) -> np.ndarray:
    shift, bits = BITS[k]
    return meta >> shift & ((1 << bits) - 1)


def digests(texts: list[bytes], doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of each chunk's digest, as a long and an int."""
    h = xxhash.xxh3_128_digest
    raw = b"".join([h(texts[d][s : s + z]) for d, s, z in zip(doc.tolist(), start.tolist(), size.tolist(), strict=True)])
    a = np.frombuffer(raw, dtype=np.int64).reshape(-1, 2)
    return a[:, 0], a[:, 1].astype(np.int32)


def identity() -> Column:
    """What tells a document from others: its doc_id and its text."""
    return F.xxhash64("doc_id", "text")


def key() -> Column:
    """Says which document is first; null sorts last."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))


def twice_inside(c: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a chunk was in its text before, and whether it is there more than once."""
    order = np.lexsort((c["start"], b, a, c["doc"]))
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for v in (c["doc"], a, b):
        same &= v[order[1:]] == v[order[:-1]]
    again, twice = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    again[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return again, twice


def _chunks(docs: DataFrame, places: bool) -> DataFrame:
    """hi, lo (digest) and uid (document) of the chunks; with places also where they are, else the document's key.

    seen is 1 or 2 if a chunk is in its text more than once: 1 at the first place, 2 at later ones.
    """
    src = project(docs, ["doc_id", "text"]).where("text <> ''").select(key().alias("key"), identity().alias("uid"), F.col("text").cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            uids = batch.column(1).to_pylist()
            new = [i for i, u in enumerate(uids) if not (u in met or met.add(u))]
            if len(new) < len(uids):  # equal rows are one document
                batch = batch.take(pa.array(new, pa.int64()))
            texts = batch.column(2).to_pylist()
            for lo, hi in slices(texts, 4 << 20):
                c = chunked(texts[lo:hi], tails=True)
                c["start"], c["size"] = c["start"] - c["lead"], c["size"] + c["lead"]
                a, b = digests(texts[lo:hi], c["doc"], c["start"], c["size"])
                at = pa.array(c["doc"] + lo)
                cols = {"hi": pa.array(a), "lo": pa.array(b), "uid": batch.column(1).take(at)}
                if places:
                    again, twice = twice_inside(c, a, b)
                    cols |= {"seen": pa.array(again.astype(np.int8) + twice), "place": pa.array(c["start"] << 28 | c["size"]), "meta": pa.array(packed(c))}
                else:
                    cols["key"] = batch.column(0).take(at)
                yield pa.RecordBatch.from_pydict(cols)

    return src.mapInArrow(run, "hi long, lo int, uid long, " + ("seen byte, place long, meta long" if places else "key long"))


def anchored(pos: np.ndarray, words: np.ndarray, start: np.ndarray, end: np.ndarray, n: int, min_words: int) -> np.ndarray:
    """Which chunks of a run to look for elsewhere, if of the n words in and beside it min_words may be a passage.

    One that every such window holds, with as many bytes before it as its cuts depend on; if there is none, all.
    """
    first = n - min_words  # the last window's first word
    opened = start[0] if first < pos[0] else end[min(int(np.searchsorted(pos + words, first, side="right")), len(end) - 1)]
    inner = np.flatnonzero((pos >= first) & (pos + words <= min_words - SLACK) & (start >= opened + WINDOW + SHORT))
    return inner[[len(inner) // 2]] if len(inner) else np.arange(len(pos))


PASSAGE = "uid long, begin long, size long, words int, removed_bytes long, shared boolean, sure boolean, anchors array<struct<hi: long, lo: int, at: long, low: int, high: int>>"


def _runs(rows: DataFrame, min_bytes: int, min_words: int, spans: bool) -> DataFrame:
    """The runs that are passages (sure), or may be with the words beside them; with spans the places to remove.

    anchors, of the latter: the chunks to look for elsewhere, and the first words of windows, told from a chunk's first.
    """

    def settle(t: pa.Table) -> pa.RecordBatch:
        col = {n: t.column(n).to_numpy(zero_copy_only=False) for n in t.column_names}
        # Equal rows are one document: each of its places counts once.
        once = np.r_[True, (col["uid"][1:] != col["uid"][:-1]) | (col["place"][1:] != col["place"][:-1])]
        col = {n: v[once] for n, v in col.items()}
        own, start, size = col["uid"], col["place"] >> 28, col["place"] & ((1 << 28) - 1)
        end, words = start + size, unpacked(col["meta"], "span")
        fresh = np.r_[True, (own[1:] != own[:-1]) | (start[1:] != end[:-1])]
        head = np.flatnonzero(fresh)
        tail = np.r_[head[1:], len(own)] - 1
        reach = np.add.reduceat(words, head)
        before = unpacked(col["meta"][head], "before")
        may = reach + before + unpacked(col["meta"][tail], "after")
        use = np.flatnonzero((end[tail] - start[head] >= min_bytes) & (may >= min_words))
        sure = reach >= min_words
        anchors = []
        for r in use.tolist():
            part = slice(int(head[r]), int(tail[r]) + 1)
            if sure[r]:
                anchors.append(None)
                continue
            w = words[part]
            pos = before[r] + np.cumsum(w) - w
            low, high = np.maximum(-pos, w - min_words) - SLACK, np.minimum(may[r] - min_words - pos, 0) + SLACK
            anchors.append([
                {"hi": int(col["hi"][part][k]), "lo": int(col["lo"][part][k]), "at": int(start[part][k]), "low": int(low[k]), "high": int(high[k])}
                for k in anchored(pos, w, start[part], end[part], int(may[r]), min_words).tolist()
            ])
        gone = np.add.reduceat(size * col["later"], head)
        shape = pa.list_(pa.struct([("hi", pa.int64()), ("lo", pa.int32()), ("at", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]))
        arrays = {
            "uid": pa.array(own[head][use]), "begin": pa.array(start[head][use]), "size": pa.array((end[tail] - start[head])[use]), "words": pa.array(reach[use].astype(np.int32)),
            "removed_bytes": pa.array(gone[use]), "shared": pa.array(np.logical_or.reduceat(col["across"], head)[use]), "sure": pa.array(sure[use]), "anchors": pa.array(anchors, shape),
        }
        if spans:
            at = np.flatnonzero(np.isin(np.cumsum(fresh) - 1, use) & col["later"])
            edges = np.searchsorted(np.searchsorted(head, at, side="right") - 1, np.r_[use, len(head)])
            arrays["places"] = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(col["place"][at]))
        return pa.RecordBatch.from_pydict(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            own = held.column("uid").to_numpy()
            whole = int(np.searchsorted(own, own[-1], side="left")) if len(own) else 0
            if whole:  # a document's rows may go on in the next batch
                yield settle(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield settle(held)

    return rows.repartition("uid").sortWithinPartitions("uid", "place").mapInArrow(run, PASSAGE + (", places array<long>" if spans else ""))


def windows(text: bytes, asked: list[dict[str, int]], min_words: int) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Windows of min_words words that begin between low and high words after the first word of each asked place.

    Their first words, the asked places, and where they are in the words joined by one space.
    """
    parts = text.split()
    gap = SPACE[np.frombuffer(text, dtype=np.uint8)]
    begin = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
    joined = np.r_[0, np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)]
    first, place = [], []
    for a in asked:
        k = int(np.searchsorted(begin, a["at"]))
        some = np.arange(max(0, k + a["low"]), min(k + a["high"], len(parts) - min_words) + 1)
        first.append(some)
        place.append(np.full(len(some), a["at"]))
    at, p = np.concatenate(first), np.concatenate(place)
    return at, p, [b" ".join(parts)], joined[at], joined[at + min_words] - 1 - joined[at]


def _told(docs: DataFrame, rows: DataFrame, unsure: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """uid, begin, across of those runs whose windows are found elsewhere (across: in another document); and a table to discard."""
    anchors = unsure.select("uid", "begin", F.inline("anchors"))
    wanted = anchors.groupBy("hi", "lo").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    places = rows.select("hi", "lo", "uid", F.shiftright("place", 28).alias("at")).join(wanted, ["hi", "lo"])
    asked = places.groupBy("uid").agg(F.collect_set(F.struct("at", "low", "high")).alias("asked"))
    src = project(docs, ["doc_id", "text"]).select(identity().alias("uid"), F.col("text").cast("binary").alias("body")).join(asked, "uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for uid, body, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if uid in met:
                    continue
                met.add(uid)
                at, p, texts, start, size = windows(body, places, min_words)
                if len(at):
                    a, b = digests(texts, np.zeros(len(at), dtype=np.int64), start, size)
                    yield pa.RecordBatch.from_pydict({"hi": pa.array(a), "lo": pa.array(b), "uid": pa.array(np.full(len(at), uid)), "word": pa.array(at), "at": pa.array(p)})

    held = written(src.mapInArrow(run, "hi long, lo int, uid long, word long, at long"), "substring-windows")
    found = held.groupBy("hi", "lo").agg(F.min(F.struct("uid", "word")).alias("a"), F.max(F.struct("uid", "word")).alias("b")).where("a <> b")
    found = found.select("hi", "lo", F.expr("a.uid <> b.uid").alias("across"))
    seen = held.join(found, ["hi", "lo"]).groupBy("uid", "at").agg(F.max("across").alias("across"))
    return anchors.select("uid", "begin", "at").join(seen, ["uid", "at"]).groupBy("uid", "begin").agg(F.max("across").alias("across")), held


def _repeats(docs: DataFrame, min_bytes: int, min_words: int, spans: bool) -> DataFrame:
    """Of each document (uid) with repeated passages: what they come to, and with spans the places to remove."""
    known = _chunks(docs, places=False).groupBy("hi", "lo").agg(F.min(F.struct("key", "uid")).alias("first"), F.min("uid").alias("a"), F.max("uid").alias("b"))
    known = known.where("a <> b").select("hi", "lo", F.col("first.uid").alias("owner"))
    rows = _chunks(docs, places=True).join(known, ["hi", "lo"], "left").where("owner is not null or seen > 0")
    # A chunk's first place in its own document stays there, if the document is the digest's first.
    later = (F.col("seen") == 2) | (F.coalesce("owner", "uid") != F.col("uid"))
    rows = written(rows.select("hi", "lo", "uid", "place", "meta", later.alias("later"), F.col("owner").isNotNull().alias("across")), "substring-chunks")
    runs = written(_runs(rows, min_bytes, min_words, spans), "substring-runs")
    told, held = _told(docs, rows, runs.where("not sure"), min_words)
    kept = runs.join(told, ["uid", "begin"], "left").where("sure or across is not null")
    sums = [
        F.count("*").alias("n_passages"), F.sum("size").alias("repeated_bytes"), F.max(F.greatest("words", F.lit(min_words))).cast("long").alias("longest_words"),
        F.sum("removed_bytes").alias("removed_bytes"), F.max(F.coalesce("across", "shared")).alias("repeated"),
    ]
    out = written(kept.groupBy("uid").agg(*sums, *([F.flatten(F.collect_list("places")).alias("places")] if spans else [])), "substring-passages")
    for t in (rows, runs, held):
        discard(t)
    return out


def report(docs: DataFrame, min_bytes: int = 24, min_words: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_passages, repeated_bytes, longest_words, removed_bytes, repeated of every row."""
    own = project(docs, ["doc_id", "text"]).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), identity().alias("uid"))
    found = _repeats(docs, min_bytes, min_words, spans=False)
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_passages", "repeated_bytes", "longest_words", "removed_bytes")]
    return own.join(found, "uid", "left").select("doc_id", "n_bytes", *numbers, F.coalesce("repeated", F.lit(False)).alias("repeated"))


def without(text: bytes, places: list[int]) -> bytes:
    """text without the chunks at places."""
    out, at = [], 0
    for p in sorted(places):
        out.append(text[at : p >> 28])
        at = (p >> 28) + (p & ((1 << 28) - 1))
    return b"".join([*out, text[at:]])


def deduplicated(docs: DataFrame, min_bytes: int = 24, min_words: int = 50) -> DataFrame:
    """docs, all columns, without the repeated passages' later occurrences in their texts."""
    names = docs.columns
    inner = [f"__c{i}" for i in range(len(names))]
    text, own = inner[names.index("text")], inner[names.index("doc_id")]
    found = _repeats(docs, min_bytes, min_words, spans=True).where("removed_bytes > 0").select(F.col("uid").alias("__uid"), F.col("places").alias("__places"))

    @F.pandas_udf("binary")
    def cut(body: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([b if b is None or p is None else without(b, p.tolist()) for b, p in zip(body, places, strict=True)], dtype=object)

    at = docs.toDF(*inner).withColumn("__uid", F.xxhash64(own, text)).join(found, "__uid", "left")
    kept = F.when(F.col("__places").isNull(), F.col(text)).otherwise(F.decode(cut(F.col(text).cast("binary"), F.col("__places")), "UTF-8"))
    return at.withColumn("__kept", kept).select(*[F.col("__kept") if c == text else F.col(c) for c in inner]).toDF(*names)
