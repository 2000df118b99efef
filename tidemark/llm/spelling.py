"""What it costs to spell a piece: a word and the white space byte after it, bit by bit.

Each byte is coded as the bits of a Huffman code. ORDERS hashed-context predictors
have a table of slots each, told by a hash of the context (bytes before, back to the
piece's begin) and the code's node. They are mixed by logistic regression over their
stretched probabilities, with weights that two gates pick and that add up: place in
the piece and kind of the byte before, depth of the node and how many of the longer
contexts are known. Weights are learned online over all distinct pieces, each occurrence
predicted from the others. A piece costs the same wherever it is spelled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep_freed
from tidemark.llm.slots import Code, folded, mixed, salted

#: Bytes of context of the predictors; the last one is the whole piece so far.
ORDERS = (1, 2, 3, 4, None)
END, BEFORE = 256, 257
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: White space but the plain space.
OTHER_SPACE = (b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
#: Bits of a natural logarithm.
BITS = np.float32(1 / np.log(2))
#: Places at which pieces may share symbols.
WIDTH = 24
#: Kinds of the byte before: none, white space and signs, digits, capitals, letters, bytes beyond ASCII.
KINDS = np.array([1 if c < 48 else 2 if c < 58 else 1 if c < 65 else 3 if c < 91 else 1 if c < 97 else 4 if c < 123 else 1 if c < 128 else 5 for c in range(256)] + [1, 0])
#: Places of the gates: place in the piece with the kind of the byte before, depth of the node with how many longer contexts are known.
PLACES, DEPTHS, KNOWN = 8, 12, len(ORDERS)
GATES = (PLACES * 6, DEPTHS * KNOWN)


def pieces_of(text: bytes) -> list[bytes]:
    """The text's pieces, named so that splitting is cheap.

    A word and a space is named by the word, a word and another white space byte by
    both, and the last word, with which the text's end is coded, by it and a space.
    """
    for c in OTHER_SPACE:
        if c in text:
            text = text.replace(c, c + b" ")
    out = text.split(b" ")
    out[-1] += b" "
    return out


def spelled(name: bytes) -> bytes:
    """A piece's own bytes; NUL stands for the end."""
    return name[:-1] + b"\0" if name[-1:] == b" " else name if name[-1:] in OTHER_SPACE else name + b" "


def binary(pieces: list[bytes] | pa.Array) -> pa.Array:
    return pieces if isinstance(pieces, pa.Array) else pa.array(pieces, pa.binary())


def packed(col: pa.Array, kind: type = np.uint8) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows, how many of each row) of an array of rows packed as bytes."""
    size = np.dtype(kind).itemsize
    edges = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) // size if len(col) else np.zeros(1, dtype=np.int64)
    return np.frombuffer(col.buffers()[2] or b"", dtype=kind, count=int(edges[-1]))[edges[0] :], np.diff(edges)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the texts' pieces as they stand, each with its white space, and how many each text has).

    They lie in the texts' own bytes; a text's last piece has no white space.
    """
    raw, n = packed(texts)
    spaces = np.flatnonzero((raw == 32) | (raw - np.uint8(9) < 5)) + 1
    ends = np.cumsum(n)
    last = np.searchsorted(spaces, ends, side="right") + np.arange(len(n))
    edges = np.zeros(len(spaces) + len(n) + 1, dtype=np.int32)
    inner = np.ones(len(edges), dtype=bool)
    inner[0] = inner[last + 1] = False
    edges[inner], edges[last + 1] = spaces, ends
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw)]), np.diff(last, prepend=-1)


def named(pieces: pa.Array) -> pa.Array:
    """The names, as in pieces_of, of pieces as they stand."""
    raw, n = packed(pieces)
    final = np.where(n > 0, np.take(raw, np.cumsum(n) - 1, mode="clip") if len(raw) else 0, 0)
    whole = (final >= 9) & (final <= 13)
    names = pc.binary_slice(pieces, 0, -1) if not (~whole & (final != 32)).any() else pc.if_else(pa.array(final == 32), pc.binary_slice(pieces, 0, -1), pc.binary_join_element_wise(pieces, pa.scalar(b" ", pa.binary()), pa.scalar(b"", pa.binary())))
    return pc.if_else(pa.array(whole), pieces, names)


def words_of(pieces: pa.Array) -> pa.Array:
    """The words, lower-cased, of pieces as they stand: white space stands at their ends only."""
    raw, n = packed(pieces)
    space = (raw == 32) | (raw - np.uint8(9) < 5)
    final = np.cumsum(n)
    n = n - (np.r_[False, space][final] & (n > 0))
    own = np.frombuffer(LOWER, dtype=np.uint8)[raw[~space]]
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.py_buffer(own)])


def symbols_of(pieces: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes and ends of all pieces, four BEFORE ahead of each; where each begins; symbols of each)."""
    own, n = packed(binary(pieces))
    edges = np.cumsum(n)
    begin = edges - n + 5 * np.arange(len(n)) + 4
    raw = np.full(len(own) + 5 * len(n), BEFORE, dtype=np.int64)
    raw[np.arange(len(own)) + np.repeat(begin - edges + n, n)] = own
    last = begin + n - 1
    final = np.where(n > 0, raw[last], 0)
    raw[begin + n] = 32  # the space that a name leaves out, if it does
    raw[last[final == 32]] = END
    whole = (final == 32) | (final >= 9) & (final <= 13)
    raw[(begin + n)[whole]] = BEFORE
    return raw, begin, n + ~whole


def batched(pieces: list[bytes] | pa.Array, most: int = 60_000) -> Iterator[tuple[int, int]]:
    """Ranges of pieces of about most bytes."""
    ends = np.cumsum(packed(binary(pieces))[1] + 1)
    lo = 0
    while lo < len(pieces):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def alike(pieces: pa.Array) -> np.ndarray:
    """How many symbols each of the sorted pieces shares with the one before, less than it has."""
    raw, begin, n = symbols_of(pieces)
    at = np.arange(WIDTH)
    first = np.where(at < n[:, None], np.take(raw.astype(np.int16), begin[:, None] + at, mode="clip"), np.int16(-1))
    shared = np.zeros(len(n), dtype=np.int64)
    same = first[1:] == first[:-1]
    shared[1:] = np.minimum(np.where(same.all(axis=1), WIDTH, (~same).argmax(axis=1)), np.minimum(n[1:], n[:-1]))
    shared = np.minimum(shared, n - 1)
    shared[1:][(n[1:] > WIDTH) | (n[:-1] > WIDTH)] = 0  # long pieces share nothing
    return shared


def cells(shared: np.ndarray) -> np.ndarray:
    """Whose symbol, as piece * WIDTH + place, stands at each shared place: that of the last piece before that has it for its own."""
    mine = np.arange(WIDTH)[None, :] >= shared[:, None]
    whose = np.maximum.accumulate(np.where(mine, np.arange(len(shared))[:, None], 0), axis=0)
    return (whose * WIDTH + np.arange(WIDTH))[~mine]


class Speller:
    """code, tables [3, orders, slots] of stretched probabilities (or the first of the three), weights by gate."""

    def __init__(self, code: Code, bits: int, tables: np.ndarray | None = None, weights: list[np.ndarray] | None = None):
        self.code, self.bits, self.tables = code, bits, tables
        self.weights = weights or [np.full((g, len(ORDERS)), 0.15, dtype=np.float32) for g in GATES]

    def events(self, pieces: list[bytes] | pa.Array, shared: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """piece, place, bit, slots [orders, events], gates' picks [gates but the last, events]; without each piece's first shared symbols."""
        raw, begin, n = symbols_of(pieces)
        owner = np.repeat(np.arange(len(pieces)), n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        at, v = begin[owner] + place, raw.astype(np.uint64) + np.uint64(1)
        power = np.cumprod(np.r_[np.uint64(1), np.full(int(n.max(initial=1)), 0x9E3779B97F4A7C15, dtype=np.uint64)], dtype=np.uint64)
        sums = np.cumsum(np.r_[np.uint64(0), v[at] * power[place]], dtype=np.uint64)
        so_far = sums[:-1] - np.repeat(sums[np.cumsum(n) - n], n) + place.astype(np.uint64)
        if shared is not None:
            own = np.flatnonzero(place >= np.repeat(shared, n))
            owner, place, at, so_far = owner[own], place[own], at[own], so_far[own]
        symbols = raw[at]
        bits = self.code.length[symbols]
        begin_at = np.cumsum(bits) - bits
        every = np.arange(int(bits.sum()))
        depth = every - np.repeat(begin_at, bits)
        step = np.take(self.code.steps, np.repeat(self.code.first[symbols] - begin_at, bits) + every, mode="clip")
        node = salted(step >> 1)
        slots = np.empty((len(ORDERS), len(every)), dtype=np.int64)
        rolled, k = np.zeros(len(at), dtype=np.uint64), 0
        for o, order in enumerate(ORDERS):
            h = so_far
            if order is not None:
                while k < order:  # orders rise, each goes on from the one before
                    k += 1
                    rolled = rolled * np.uint64(0x100000001B3) + v[at - k]
                h = rolled + np.uint64(order * 0x100000001B3**order % 2**64)
            slots[o] = mixed(np.repeat(folded(h * np.uint64(0xFF51AFD7ED558CCD)), bits), node, self.bits)
        gate = np.repeat((np.minimum(place, PLACES - 1) * 6 + KINDS[raw[at - 1]]) * GATES[1], bits) + np.minimum(depth, DEPTHS - 1) * KNOWN
        return {"piece": np.repeat(owner, bits), "place": np.repeat(place, bits), "bit": (step & 1).astype(np.int64), "slots": slots, "gate": gate}

    def inputs(self, e: dict[str, np.ndarray], without: bool) -> tuple[np.ndarray, np.ndarray]:
        """Stretched probabilities [orders, events] and the picks of both gates; without: the event itself is not counted."""
        x = np.empty((len(ORDERS), len(e["bit"])), dtype=np.int8)
        for o, s in enumerate(e["slots"]):
            np.take(self.tables[1:, o].reshape(-1) if without else self.tables[0, o], s + (e["bit"] << self.bits) if without else s, out=x[o], mode="clip")
        known = np.zeros(x.shape[1], dtype=np.int8)
        for v in x[1:]:
            known += v != 0
        return x, e["gate"] + known

    def logits(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Log odds of a 1: the weights of both gates add up."""
        both = (self.weights[0][:, None] + self.weights[1][None]).reshape(-1, len(ORDERS)).T.astype(np.float32) / np.float32(16)
        z = both[0][gate] * x[0]
        for w, v in zip(both[1:], x[1:], strict=True):
            z += w[gate] * v
        return z

    def costs(self, pieces: list[bytes] | pa.Array) -> np.ndarray:
        """Bits of each piece.

        A symbol's cost depends on the symbols before it in its piece alone, so
        pieces are sorted and a prefix shared with the one before costs what it did there.
        """
        pieces = binary(pieces)
        order = np.asarray(pc.array_sort_indices(pieces)).astype(np.int64)
        inorder = pieces.take(pa.array(order))
        out = np.zeros(len(pieces))
        for lo, hi in batched(inorder):
            own = inorder[lo:hi]
            shared = alike(own)
            e = self.events(own, shared)
            z = self.logits(*self.inputs(e, without=False))
            z *= 1 - 2 * e["bit"].astype(np.float32)
            loss = np.log(1 + np.exp(np.minimum(z, 80))) * BITS
            piece, place = e["piece"], e["place"]
            begin = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (place[1:] != place[:-1])])
            symbol = np.add.reduceat(loss, begin, dtype=np.float64)  # of each symbol that was not shared
            at, row = place[begin], piece[begin]
            head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])  # every piece has a symbol of its own
            total = np.add.reduceat(symbol, head)
            some = np.flatnonzero(shared)
            if len(some):
                grid = np.zeros(len(own) * WIDTH)
                short = at < WIDTH
                grid[row[short] * WIDTH + at[short]] = symbol[short]
                cell = cells(shared)
                total[some] += np.add.reduceat(grid[cell], np.cumsum(shared[some]) - shared[some])
            out[order[lo:hi]] = total
        return out

    def learn(self, pieces: list[bytes] | pa.Array, counts: np.ndarray, rate: float = 0.02) -> None:
        """A step of gradient for every few hundred pieces; a piece weighs the logarithm of its count."""
        for lo, hi in batched(pieces, 12_000):
            e = self.events(pieces[lo:hi])
            x, gate = self.inputs(e, without=True)
            weight = np.log2(1 + counts[lo:hi])[e["piece"]]
            wrong = weight * (e["bit"] - 1 / (1 + np.exp(-self.logits(x, gate))))
            n = np.bincount(gate, weights=weight, minlength=GATES[0] * GATES[1]).reshape(GATES)
            for o in range(len(ORDERS)):
                g = np.bincount(gate, weights=wrong * x[o], minlength=GATES[0] * GATES[1]).reshape(GATES) / 16
                self.weights[0][:, o] += rate * g.sum(axis=1) / np.sqrt(1 + n.sum(axis=1))
                self.weights[1][:, o] += rate * g.sum(axis=0) / np.sqrt(1 + n.sum(axis=0))


def piece_events(make: Callable[[], Speller]) -> Callable[[], Callable[[pa.RecordBatch], Iterator[tuple]]]:
    """What slots.slot_tables asks for, of rows (piece, n).

    Pieces are sorted, and a prefix that neighbours share is worked out once and weighs what they weigh together.
    """

    def opened():
        own = make()

        def of(batch: pa.RecordBatch) -> Iterator[tuple]:
            order = pc.array_sort_indices(batch.column(0))
            ps, n = batch.column(0).take(order), batch.column(1).take(order).to_numpy()
            for lo, hi in batched(ps):
                shared, k = alike(ps[lo:hi]), n[lo:hi]
                weight = np.repeat(k, WIDTH)
                np.add.at(weight, cells(shared), np.repeat(k, shared))
                e = own.events(ps[lo:hi], shared)
                piece, place = e["piece"], e["place"]
                yield e["slots"], e["bit"], np.where(place < WIDTH, np.take(weight, piece * WIDTH + place, mode="clip"), k[piece])

        return of

    return opened


def symbol_counts(pieces: DataFrame) -> np.ndarray:
    """How often each byte and the end occur; at most 257 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        total = np.zeros(257, dtype=np.int64)
        for batch in batches:
            ps, n = batch.column(0), batch.column(1).to_numpy()
            for lo, hi in batched(ps, 1 << 20):
                raw, begin, k = symbols_of(ps[lo:hi])
                mine = np.repeat(begin - np.cumsum(k) + k, k) + np.arange(int(k.sum()))
                total += np.bincount(raw[mine], weights=np.repeat(n[lo:hi], k), minlength=257).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"symbol": pa.array(np.arange(257)), "n": pa.array(total)})

    out = np.ones(257, dtype=np.int64)
    for r in pieces.mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        out[r["symbol"]] += r["n"]
    return out
