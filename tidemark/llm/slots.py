"""Binary codes for symbols, and tables of what followed in hashed contexts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import keep_freed, trim

#: Counts of a table travel in parts of so many, so that a place in a part is two bytes.
PART = 1 << 16


class Code:
    """A Huffman code as flat tables: symbol s has length[s] steps from first[s] on; a step is node * 2 + bit.

    odds: each node's log odds of a 1, from the counts themselves.
    """

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        weight = np.concatenate([np.maximum(counts, 1), np.zeros(max(0, n - 1), dtype=np.int64)]).astype(np.int64)
        leaves = np.argsort(weight[:n], kind="stable").tolist()
        w, parent, side = weight.tolist(), [0] * len(weight), [0] * len(weight)
        low, made = 0, n  # next leaf, next node that is not joined yet
        for new in range(n, 2 * n - 1):
            for bit in (0, 1):
                if low < n and (made >= new or w[leaves[low]] <= w[made]):
                    child, low = leaves[low], low + 1
                else:
                    child, made = made, made + 1
                parent[child], side[child] = new, bit
                w[new] += w[child]
        depth = [0] * len(weight)
        for i in range(2 * n - 3, -1, -1):
            depth[i] = depth[parent[i]] + 1
        up, bit, w = np.array(parent), np.array(side), np.array(w)
        self.length = np.array(depth[:n], dtype=np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.steps = np.zeros(int(self.length.sum()), dtype=np.int32)
        at, place = np.arange(n), self.first + self.length - 1
        for left in range(int(self.length.max(initial=0))):
            use = self.length > left
            self.steps[place[use] - left] = (2 * n - 2 - up[at[use]]) * 2 + bit[at[use]]
            at[use] = up[at[use]]
        ones, zeros = np.zeros(max(1, n - 1)), np.zeros(max(1, n - 1))
        for total, b in ((zeros, 0), (ones, 1)):
            mine = np.flatnonzero(bit[: 2 * n - 2] == b) if n > 1 else np.zeros(0, dtype=np.int64)
            total[2 * n - 2 - up[mine]] = w[mine]
        self.odds = np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds of a 1, in sixteenths, bounded; 0 where nothing is known."""
    return np.clip(np.rint(16 * np.log((ones + 0.4) / (zeros + 0.4))), -127, 127).astype(np.int8)


def mixed(contexts: np.ndarray, nodes: np.ndarray, bits: int) -> np.ndarray:
    """Slots of so many bits, of hashes of contexts and multiplied nodes (both uint32)."""
    h = contexts + nodes
    t = h >> np.uint32(15)
    h ^= t
    h *= np.uint32(0x2C1B3C6D)
    np.right_shift(h, np.uint32(13), out=t)
    h ^= t
    h *= np.uint32(0x297A2D39)
    h >>= np.uint32(32 - bits)
    return h.astype(np.int64)


def salted(nodes: np.ndarray) -> np.ndarray:
    return nodes.astype(np.uint32) * np.uint32(0x85EBCA6B)


def folded(h: np.ndarray) -> np.ndarray:
    """32 bits of 64."""
    return (h ^ (h >> np.uint64(32))).astype(np.uint32)


def gathered(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows, small batches joined to some of about most bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= most:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def slot_tables(rows: DataFrame, orders: int, bits: int, events: Callable[[], Callable[[pa.RecordBatch], Iterator[tuple]]]) -> np.ndarray:
    """Stretched probabilities [3, orders, slots]: of all counts, of all but one 0, of all but one 1.

    events() gives what turns a batch of rows into (slots [orders, n], bit, weight, or None where each weighs 1); it is made once for a task.
    A task adds up in arrays of fixed size, and sends the slots that it has used.
    """
    size = 1 << bits
    part = min(PART, 2 * size)
    parts = 2 * size // part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        of = events()
        total = np.zeros((orders, 2 * size), dtype=np.uint32)
        weighed = 0

        def sent(o: int, at: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            edges = np.searchsorted(at, np.arange(parts + 1) * part)
            for p in range(parts):
                a, k = (at[edges[p] : edges[p + 1]] - p * part).astype(np.uint16), n[edges[p] : edges[p + 1]]
                for use, kind in ((k < 256, np.uint8), (k >= 256, np.int64)):
                    if use.any():
                        yield pa.RecordBatch.from_pydict({"o": pa.array([o], pa.int32()), "part": pa.array([p], pa.int32()), "at": pa.array([a[use].tobytes()], pa.binary()), "n": pa.array([k[use].astype(kind).tobytes()], pa.binary())})

        def settle() -> Iterator[pa.RecordBatch]:
            for o in range(orders):
                at = np.flatnonzero(total[o])
                yield from sent(o, at, total[o][at])
            total[:] = 0

        for batch in gathered(batches):
            for slots, bit, weight in of(batch):
                many = None if weight is None else weight >= 1 << 24  # what is so frequent goes on its own, so that 32 bits hold the rest
                some = many is not None and many.any()
                small = np.uint32(1) if weight is None else (weight[~many] if some else weight).astype(np.uint32)
                for o in range(orders):
                    at = 2 * slots[o] + bit
                    np.add.at(total[o], at[~many] if some else at, small)
                    if some:
                        used, where = np.unique(at[many], return_inverse=True)
                        k = np.zeros(len(used), dtype=np.int64)
                        np.add.at(k, where, weight[many])
                        yield from sent(o, used, k)
                weighed += len(bit) if weight is None else int(small.sum(dtype=np.int64))
                if weighed >= 1 << 31:
                    yield from settle()
                    weighed = 0
        yield from settle()
        total = of = None
        trim()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of (o, part), so one part's counts are held at a time."""
        now, t = None, np.zeros(part, dtype=np.int64)

        def done() -> pa.RecordBatch:
            z, o = t[0::2], t[1::2]
            x = np.stack([stretched(z, o), stretched(np.maximum(z - 1, 0), o), stretched(z, np.maximum(o - 1, 0))])
            return pa.RecordBatch.from_pydict({"o": pa.array([now[0]], pa.int32()), "part": pa.array([now[1]], pa.int32()), "x": pa.array([x.tobytes()], pa.binary())})

        for batch in batches:
            for o, p, a, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (o, p):
                    if now:
                        yield done()
                    now = (o, p)
                    t[:] = 0
                at = np.frombuffer(a, dtype=np.uint16)
                t[at] += np.frombuffer(n, dtype=np.uint8 if len(n) == len(at) else np.int64)
        if now:
            yield done()

    counted = rows.mapInArrow(run, "o int, part int, at binary, n binary")
    summed = counted.repartition(min(64, orders * parts), "o", "part").sortWithinPartitions("o", "part").mapInArrow(add, "o int, part int, x binary")
    got = summed.toArrow()  # three bytes for each slot, of which there is a bounded number
    tables = np.zeros((3, orders, size), dtype=np.int8)
    for o, p, x in zip(got.column("o").to_pylist(), got.column("part").to_pylist(), got.column("x"), strict=True):
        tables[:, o, p * part // 2 : (p + 1) * part // 2] = np.frombuffer(x.as_buffer(), dtype=np.int8).reshape(3, -1)
    return tables
