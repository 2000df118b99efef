"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint is 64 bits. Two that differ in at most 2r bits have a variant
in common that differs from each in at most r bits, so every distinct
fingerprint emits all its variants within r, the variants are shuffled, and
those that meet are verified. Whoever meets at one variant is within 2r of
each other, hence a group of any size is joined by a tree, never by all pairs.

The shuffle carries variants in packed form. Its key is a variant's first m
bits; all variants of a fingerprint that share those bits travel as one row
(key, fingerprint), and the task that owns the key writes them out: it knows
how many of the r flips the key has used. With m=8 and r=2, 2081 variants
travel as 37 rows. m follows the number of fingerprints, so that a task holds
some millions of variants. Keys with far more (near copies crowd there) are
dealt over several tasks by parities of the variant, and a task also works
through an oversized key in parts, so memory stays bounded.

Defined results
* a null or blank text has no words: fingerprint zero, linked like any other;
* fewer than `width` words make one shingle of the whole sequence;
* repeated rows (also equal doc_ids) each give a row; component_id is the
  smallest non-null doc_id of the component, null if it has none;
* a text of any length is hashed whole, as one row of a task;
* an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import project, text_bytes, written
from tidemark.llm.components import components

SEED = 42
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Variants that a task writes out at once, and that a key may have before it is dealt over several tasks.
PART = 1 << 21
HEAVY = 1 << 25
#: Spreads the eight bits of a byte over the eight bytes of a word, to count them side by side.
LANES = np.array([int.from_bytes(bytes((v >> j) & 1 for j in range(8)), "little") for v in range(256)], dtype=np.uint64)


def shingle_hashes(text: bytes, width: int) -> list[int]:
    words = text.translate(LOWER).split()
    n = len(words)
    joined = b" ".join(words)
    if n <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)] if n else []
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1)
    starts = (ends - np.fromiter(map(len, words), dtype=np.int64, count=n) - 1)[: n - width + 1].tolist()
    h = xxhash.xxh64_intdigest
    return [h(joined[s:e], SEED) for s, e in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """uint64 fingerprint of each text: bit i is set if over half the shingles' hashes have it."""
    out = np.zeros(len(texts), dtype=np.uint64)
    hashes: list[int] = []
    counts: list[tuple[int, int]] = []

    def settle() -> None:
        if not counts:
            return
        h = np.fromiter(hashes, dtype=np.uint64, count=len(hashes))
        n = np.array([c for _, c in counts])
        first = np.cumsum(n) - n
        blocks = -(-n // 255)  # a lane counts to 255
        owner = np.repeat(np.arange(len(n)), blocks)
        begin = first[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        lanes = np.add.reduceat(LANES[h.view(np.uint8).reshape(-1, 8)], begin, axis=0)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(len(owner), 64), np.cumsum(blocks) - blocks, axis=0, dtype=np.int64)
        bits = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
        out[[i for i, _ in counts]] = bits
        hashes.clear()
        counts.clear()

    for i, t in enumerate(texts):
        got = shingle_hashes(t, width)
        if got:
            hashes.extend(got)
            counts.append((i, len(got)))
        if len(hashes) > 200_000:
            settle()
    settle()
    return out


def fingerprinted(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fp, uid) of every row; fp is the fingerprint as a signed long, uid a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints(batch.column(2).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), batch.column(1)], names=["doc_id", "fp", "uid"])

    src = project(docs, ["doc_id", "text"]).select("doc_id", F.xxhash64("text").alias("uid"), text_bytes().alias("body"))
    kind = dict(src.dtypes)["doc_id"]
    return src.mapInArrow(run, f"doc_id {kind}, fp long, uid long")


def masks(bits: int, radius: int) -> list[int]:
    """All masks of so many bits with at most radius bits set."""
    return [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(bits), k)]


#: Fixed masks whose parities deal variants out; any would do.
PARITIES = [int.from_bytes(xxhash.xxh64(bytes([i]), seed=7).digest(), "big") for i in range(11)]


def parities(values: np.ndarray, n: int) -> np.ndarray:
    """n parity bits of each value; flips change them alike in every value."""
    out = np.zeros(len(values), dtype=np.int64)
    for i in range(n):
        out |= (np.bitwise_count(values & np.uint64(PARITIES[i])) & 1).astype(np.int64) << i
    return out


def rooted(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each node's component, for edges a-b among n nodes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        differ = root[a] != root[b]
        a, b = a[differ], b[differ]
    return root


def meetings(fps: np.ndarray, left: np.ndarray, low_bits: int, part: int, sub: int, subs_log: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index, index) of fingerprints that meet at a variant, a chain for each variant.

    left: the flips that each fingerprint has left for its low bits. part: the most variants
    written out at once. Only variants whose first subs_log parities are sub take part.
    """
    low = fps & np.uint64((1 << low_bits) - 1) if low_bits < 64 else fps
    flips = [np.array(masks(low_bits, r), dtype=np.uint64) for r in range(int(left.max()) + 1)]
    total = sum(int((left == r).sum()) * len(f) for r, f in enumerate(flips)) >> subs_log
    logs = min(len(PARITIES), subs_log + max(0, (max(1, total // part) - 1).bit_length()))
    own = parities(low, logs)
    kinds = [parities(f, logs) for f in flips]
    found = []
    for s in range(sub, 1 << logs, 1 << subs_log):
        who, what = [], []
        for r, f in enumerate(flips):
            mine = np.flatnonzero(left == r)
            if not len(mine):
                continue
            classes = own[mine]
            for c in np.unique(classes) if logs else [0]:
                rows = mine[classes == c] if logs else mine
                use = f[kinds[r] == (s ^ c)] if logs else f
                if len(use):
                    what.append((low[rows][:, None] ^ use[None, :]).ravel())
                    who.append(np.repeat(rows, len(use)))
        if not what:
            continue
        v, w = np.concatenate(what), np.concatenate(who)
        room = max(1, int(len(v) - 1).bit_length())
        # Sort digests that carry their place in the low bits; equal digests are candidates, equal variants meet.
        key = (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(room) << np.uint64(room) | np.arange(len(v), dtype=np.uint64)
        key.sort()
        digest = key >> np.uint64(room)
        near = np.zeros(len(key), dtype=bool)
        same = digest[1:] == digest[:-1]
        near[1:] |= same
        near[:-1] |= same
        at = (key[near] & np.uint64((1 << room) - 1)).astype(np.int64)
        order = np.lexsort((w[at], v[at]))
        at = at[order]
        equal = v[at[1:]] == v[at[:-1]]
        a, b = w[at[:-1]][equal], w[at[1:]][equal]
        found.append(np.unique(np.minimum(a, b) << 32 | np.maximum(a, b)))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
    return pairs >> 32, pairs & 0xFFFFFFFF


def tree(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, fingerprint) of a low, eight-fold tree over each component."""
    order = np.argsort(fps, kind="stable")
    rank = np.empty(len(fps), dtype=np.int64)
    rank[order] = np.arange(len(fps))
    root = rooted(rank[a], rank[b], len(fps))
    by = np.argsort(root, kind="stable")
    first = np.flatnonzero(np.r_[True, root[by][1:] != root[by][:-1]])
    begin = np.repeat(first, np.diff(np.r_[first, len(by)]))
    place = np.arange(len(by)) - begin
    child = place > 0
    up = begin + (place - 1) // 8
    sorted_fps = fps[order]
    return sorted_fps[by[child]], sorted_fps[by[up[child]]]


def links(fps: DataFrame, radius: int = 4, n: int | None = None) -> DataFrame:
    """Edges (u, v) that join all distinct fingerprints within radius bits of each other, as a forest for each key."""
    spark = fps.sparkSession
    half = radius // 2
    if radius % 2:
        raise ValueError("the radius is even: each side of a pair takes half")
    n = fps.count() if n is None else n
    per = len(masks(64, half))
    m = min(20, max(4, (max(1, n * per // PART) - 1).bit_length()))
    ball = F.array(*[F.lit(x) for x in masks(m, half)])
    key = F.shiftrightunsigned("fp", 64 - m)
    rows = fps.select("fp", F.explode(F.transform(ball, lambda x: key.bitwiseXOR(x))).alias("key"))
    left = F.lit(half) - F.bit_count(F.col("key").bitwiseXOR(key))
    sizes = [len(masks(64 - m, r)) for r in range(half + 1)]
    weight = sum((F.when(left == r, s).otherwise(0) for r, s in enumerate(sizes)), F.lit(0)).cast("long")
    crowded = rows.groupBy("key").agg(F.sum(weight).alias("w")).where(F.col("w") > HEAVY)
    logs = F.least(F.lit(len(PARITIES)), F.length(F.bin(F.floor(F.col("w") / HEAVY)))).cast("int")
    rows = rows.join(crowded.select("key", logs.alias("logs")), "key", "left").withColumn("logs", F.coalesce("logs", F.lit(0)))
    rows = rows.withColumn("sub", F.explode(F.sequence(F.lit(0), F.expr("shiftleft(1, logs)") - 1)))

    def run(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        k = np.uint64(group.column("key")[0].as_py())
        use = half - np.bitwise_count((fp >> np.uint64(64 - m)) ^ k).astype(np.int64)
        a, b = meetings(fp, use, 64 - m, PART, group.column("sub")[0].as_py(), group.column("logs")[0].as_py())
        u, v = tree(fp, a, b)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return spark_group(rows.repartition(_tasks(spark, n * len(masks(m, half))), "key", "sub"), run)


def _tasks(spark, rows: int) -> int:
    """Shuffle partitions for so many packed rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 400_000)


def spark_group(rows: DataFrame, run) -> DataFrame:
    return rows.groupBy("key", "sub").applyInArrow(run, "u long, v long")


def grouped(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, root) of all distinct fingerprints of marked (fp): root is some fingerprint of the component."""
    fps = written(marked.select("fp").distinct(), "simhash-distinct")
    roots = components(links(fps, radius, fps.count()))
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, fp of every row of docs."""
    marked = written(fingerprinted(docs, width), "simhash")
    at = grouped(marked, radius)
    firsts = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    least = at.join(firsts, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    named = at.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "fp")


def one_of_each(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """The rows of docs, all columns, without near copies: one row of each component stays.

    It is the one with the smallest doc_id (none sorts last), then the least hash of its text. Rows that share
    a doc_id but are no near copies of each other each stay; of rows equal in doc_id and text one does.
    """
    names = docs.columns
    inner = [f"__c{i}" for i in range(len(names))]
    key, text = inner[names.index("doc_id")], inner[names.index("text")]
    placed = docs.toDF(*inner)
    marked = written(fingerprinted(docs, width), "simhash")
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    firsts = marked.groupBy("fp").agg(F.min(who).alias("first"))
    keep = grouped(marked, radius).join(firsts, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("__id"), F.col("first.uid").alias("__uid"))
    kept = placed.join(keep, F.col(key).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__uid")))
    # Rows equal in both meet here, one for each task at most; which of their other columns stay is told by a hash.
    one = kept.groupBy("__id", "__uid").agg(F.min_by(F.struct(*inner), F.xxhash64(*[c for c in inner if dict(kept.dtypes)[c][:3] != "map"])).alias("__row"))
    return one.select("__row.*").toDF(*names)
