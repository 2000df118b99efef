"""Language-model scores by online logistic context mixing over bits.

A text is a row of pieces, a word and the white space byte after it. The most
frequent pieces are symbols of a Huffman code; any other is an escape symbol and
then spelled byte by byte (spelling.py). Each bit of a symbol is predicted by
hashed-context predictors: the code's node alone, the node after the piece before,
and after the two pieces before. Their stretched probabilities are combined by
logistic regression whose weights are picked by gates (depth of the node, which
contexts are known); the weights are learned online over all training texts, each
occurrence predicted from the others, and averaged over tasks.
Within a text they are refined as it goes on: what a block of events taught
changes the weights for the text's later blocks.

Long repeats: at anchors (a hash of the three pieces before picks about one place
in 32, and one in 48 follows where that picks none) one bit says whether the text
goes on, up to the next anchor, the way that most *other* training texts went on
from these pieces. If it does, that bit is all that the run costs. This bit too is
predicted from counts in its hashed context, and refined along the text.
The total is a proper code, so 2 to minus its bits is a probability.

What is gathered from the corpus: counts of all distinct pieces, slots that count
every bit of every training text, and all anchors with how texts went on there;
pieces and anchors grow with the corpus and stay in shuffled tables. Slot tables
grow with the training texts up to 2^SLOT_BITS slots for each predictor, as every
worker holds them; contexts that share a slot beyond that blur each other.

`base` is the unigram score of the contract. At most `head` of the most frequent
words are broadcast, the others' counts are joined by a shuffle.

Defined results: a null text is empty (one token, its end); a null doc_id counts
as the empty text in the fold; repeated rows each give a row and count each in
training (for each other they are other texts); without training texts every
probability is even; a text of any length is worked through in one task, its
symbols in memory; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, fold, keep_freed, per_worker, project, swept, text_bytes, trim, written
from tidemark.llm.slots import Code, folded, mixed, salted, slot_tables
from tidemark.llm.spelling import BITS, Speller, cut, named, packed, piece_events, symbol_counts, words_of

#: Most words, and pieces, that are broadcast; bytes of texts that are cut at once.
HEAD, SYMBOLS, SLICE = 1 << 18, 1 << 17, 16 << 20
#: Slots of each predictor at most, as powers of two: of symbols and of spelling.
SLOT_BITS, SPELL_BITS = 21, 20
#: Predictors of a symbol's bits, depth from which only the first is asked; places of the two gates: depth of the node, which contexts are known.
INPUTS, DEEP, DEPTHS, KNOWN = 3, 8, 8, 4
#: Pieces that are told apart as contexts, alone and in pairs; all others count by how they end.
ALONE, PAIRED = 8192, 512
#: Events after which the first blocks of a text end; later ones have the last size. Prior strength of what is refined.
BLOCKS, PRIOR, SHARE = (128, 256, 512, 1024, 2048, 4096), 64.0, 0.3
#: One in 2^ANCHOR places is an anchor; at most so many pieces pass without one.
ANCHOR, FORCED = 5, 48


def block_of(offset: np.ndarray) -> np.ndarray:
    """Which block of its text an event is in."""
    return np.where(offset < BLOCKS[-1], np.searchsorted(BLOCKS, offset, side="right"), len(BLOCKS) - 1 + offset // BLOCKS[-1])


def refined(z: np.ndarray, x: np.ndarray, bit: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bits of each text, whose events' shared log odds are z and inputs x [inputs, events]; n: events of each text.

    A text has weights of its own for the inputs and a constant, from 0 on, that are added. After each block they
    take a share of a Newton step, along the diagonal, towards what the text's blocks so far would have had.
    """
    texts = len(n)
    out = np.zeros(texts)
    if not len(z):
        return out
    begin_of = np.cumsum(n) - n
    blocks = np.where(n > 0, block_of(np.maximum(n, 1) - 1) + 1, 0)
    owner = np.repeat(np.arange(texts), blocks)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    edge = lambda t: np.where(t < len(BLOCKS), np.array([0, *BLOCKS])[np.minimum(t, len(BLOCKS))], (t - len(BLOCKS) + 1) * BLOCKS[-1])
    begin = begin_of[owner] + edge(turn)
    size = np.minimum(begin_of[owner] + n[owner], begin_of[owner] + edge(turn + 1)) - begin
    last = turn == blocks[owner] - 1  # teaches nothing: such blocks stand behind the others of their turn
    order = np.lexsort((owner, last, turn))
    begin, size, owner, turn, last = begin[order], size[order], owner[order], turn[order], last[order]
    ends = np.cumsum(size)
    if turn[-1]:  # else events are in order already
        pick = np.repeat(begin - (ends - size), size) + np.arange(len(z))
        z, bit, x = z[pick], bit[pick], x[:, pick]
    sign = (1 - 2 * bit).astype(np.float32)
    own, bend = np.zeros((len(x) + 1, texts), dtype=np.float32), np.full((len(x) + 1, texts), PRIOR, dtype=np.float32)
    edges = np.flatnonzero(np.r_[True, turn[1:] != turn[:-1], True])
    for p, q in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        a, b = int(ends[p] - size[p]), int(ends[q - 1])
        who, at = owner[p:q], z[a:b]
        if turn[p]:
            row = np.repeat(np.arange(q - p), size[p:q])
            at = at + np.take(own[-1, who], row, mode="clip")
            for k, v in enumerate(x):
                more = np.take(own[k, who], row, mode="clip")
                more *= v[a:b]
                at += more
        odd = at * sign[a:b]
        np.exp(np.minimum(odd, 80, out=odd), out=odd)  # of what was not coded
        starts = ends[p:q] - size[p:q] - a
        spent = 1 + odd
        out[who] += np.add.reduceat(np.log(spent, out=spent).astype(np.float64), starts) * BITS
        live = q - p - int(last[p:q].sum())
        if live:
            b, who, starts = int(ends[p + live - 1]), who[:live], starts[:live]
            odd = odd[: b - a]
            both = 1 + odd
            miss = odd / both
            wrong, curve = -sign[a:b] * miss, miss / both
            for k in range(len(x) + 1):
                v = x[k, a:b] if k < len(x) else None
                g, h = (wrong, curve) if v is None else (wrong * v, curve * v * v)
                bend[k, who] += np.add.reduceat(h, starts)
                own[k, who] += SHARE * np.add.reduceat(g, starts) / bend[k, who]
    return out


class Symbols:
    """The pieces that are symbols, by falling frequency; the last symbol is the escape.

    In a row of symbols a rare piece is a negative number, a hash of it.
    """

    def __init__(self, pieces: list[bytes], counts: list[int], escapes: int):
        self.pieces = pieces
        self.code = Code(np.array([*counts, escapes + 1], dtype=np.int64))
        # Below DEEP few contexts know anything: those bits are predicted from the node alone, so each symbol's cost the same everywhere.
        self.mixed_bits = np.minimum(self.code.length, DEEP)
        self.mixed_first = np.cumsum(self.mixed_bits) - self.mixed_bits
        #: Of each depth: the steps of symbols that have one there, else -1.
        self.steps_at = np.full((DEEP, len(self.code.length)), -1, dtype=np.int32)
        for d in range(DEEP):
            has = self.code.length > d
            self.steps_at[d, has] = self.code.steps[self.code.first[has] + d]
        self.mixed_steps = self.code.steps[np.repeat(self.code.first - self.mixed_first, self.mixed_bits) + np.arange(int(self.mixed_bits.sum()))]
        odds = self.code.odds[self.code.steps >> 1] * (1 - 2 * (self.code.steps & 1))
        spent = np.concatenate([[0.0], np.cumsum(np.log2(1 + np.exp(odds.astype(np.float64))))])
        self.tail = spent[self.code.first + self.code.length] - spent[self.code.first + self.mixed_bits]
        kind = np.array([xxhash.xxh32_intdigest(p.rstrip()[-2:]) for p in pieces] + [0], dtype=np.int64)
        rank = np.arange(len(kind))
        self.alone = np.where(rank < ALONE, rank, ALONE + kind % 1024).astype(np.uint64)
        self.paired = np.where(rank < PAIRED, rank, PAIRED + kind % 128).astype(np.uint64)
        self.alone[-1], self.paired[-1] = 1 << 20, 1 << 20

    def known(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < 0, len(self.pieces), ids)

    def contexts(self, symbols: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Hashes (uint32) [INPUTS - 1, symbols] of what stands before each symbol of texts of n symbols."""
        begin = (np.cumsum(n) - n)[n > 0]
        none = np.uint64(1 << 21)
        back = lambda v, k: np.concatenate([np.full(min(k, len(v)), none), v[: max(0, len(v) - k)]])
        alone, pair, far = back(self.alone[symbols], 1), back(self.paired[symbols], 1), back(self.paired[symbols], 2)
        alone[begin] = pair[begin] = far[begin] = none
        second = begin[n[n > 0] > 1] + 1
        far[second] = none
        return np.stack([folded(alone * np.uint64(0x9E3779B97F4A7C15)), folded((pair * np.uint64(0x100000001B3) + far + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD))])

    def events(self, symbols: np.ndarray, contexts: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
        """(events of each symbol, node, bit, depth, slots [INPUTS - 1, events]): the symbol's bits down to depth DEEP."""
        length = self.mixed_bits[symbols]
        ends = np.cumsum(length)
        at = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
        depth = at - np.repeat((ends - length).astype(np.int32), length)
        step = np.take(self.mixed_steps, np.repeat(self.mixed_first[symbols] - (ends - length), length) + at, mode="clip")
        node = step >> 1
        salt = salted(node)
        slots = [mixed(np.repeat(c, length), salt, bits) for c in contexts]
        return length, node, step & 1, depth, slots


    def counted(self, symbols: np.ndarray, contexts: np.ndarray, bits: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """(slots [INPUTS - 1, events], bits) of the same events, one depth after the other."""
        for steps in self.steps_at:
            step = np.take(steps, symbols, mode="clip")
            has = step >= 0
            if not has.all():
                symbols, contexts, step = symbols[has], contexts[:, has], step[has]
            if not len(step):
                return
            salt = salted(step >> 1)
            yield [mixed(c, salt, bits) for c in contexts], step & 1


class Model:
    """symbols, tables [3, INPUTS - 1, slots] (or the first of the three), and weights by gate: [DEPTHS + KNOWN, INPUTS]."""

    def __init__(self, symbols: Symbols, bits: int, tables: np.ndarray, weights: np.ndarray | None = None, runs: np.ndarray | None = None):
        self.symbols, self.bits, self.tables, self.runs = symbols, bits, tables, runs
        self.weights = np.zeros((DEPTHS + KNOWN, INPUTS)) if weights is None else weights
        if weights is None:
            self.weights[:DEPTHS] = 0.4

    def inputs(self, symbols: np.ndarray, contexts: np.ndarray, without: bool) -> tuple[np.ndarray, ...]:
        """(events of each symbol, bit, x [INPUTS, events], gate); without: the event itself is not counted."""
        length, node, bit, depth, slots = self.symbols.events(symbols, contexts, self.bits)
        x = np.empty((INPUTS, len(bit)), dtype=np.float32)
        np.take(self.symbols.code.odds, node, out=x[0], mode="clip")
        gate = np.minimum(depth, DEPTHS - 1) * KNOWN
        for o, s in enumerate(slots):
            got = np.take(self.tables[1:, o].reshape(-1), s + (bit.astype(np.int64) << self.bits), mode="clip") if without else np.take(self.tables[0, o], s, mode="clip")
            gate += (got != 0) << (1 - o)
            np.multiply(got, np.float32(1 / 16), out=x[o + 1])
        return length, bit, x, gate

    def logits(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        both = (self.weights[:DEPTHS, None] + self.weights[None, DEPTHS:]).reshape(-1, INPUTS).T.astype(np.float32)
        z = both[0][gate] * x[0]
        for w, v in zip(both[1:], x[1:], strict=True):
            z += w[gate] * v
        return z

    def learn(self, x: np.ndarray, bit: np.ndarray, gate: np.ndarray, rate: float = 0.02) -> None:
        wrong = bit.astype(np.float32) - 1 / (1 + np.exp(np.clip(-self.logits(x, gate), -80, 80)))
        n = np.bincount(gate, minlength=DEPTHS * KNOWN).reshape(DEPTHS, KNOWN)
        for k in range(INPUTS):
            g = np.bincount(gate, weights=wrong * x[k], minlength=DEPTHS * KNOWN).reshape(DEPTHS, KNOWN)
            self.weights[:DEPTHS, k] += rate * g.sum(axis=1) / np.sqrt(1 + n.sum(axis=1))
            self.weights[DEPTHS:, k] += rate * g.sum(axis=0) / np.sqrt(1 + n.sum(axis=0))


def scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def runs_of(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place in ids, pieces up to the next anchor or the text's end, hash of the three before, hash of the run) of each anchor."""
    none = np.zeros(0, dtype=np.int64)
    if len(ids) < 4:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    begin = np.repeat(np.cumsum(n) - n, n)
    at = np.arange(len(ids))
    v = ids.astype(np.int64).view(np.uint64) + np.uint64(1 << 32)
    h = np.zeros(len(ids), dtype=np.uint64)
    for k, mul in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9)):
        h[3:] += v[3 - k : len(v) - k] * np.uint64(mul)
    h = scrambled(h)
    may = at - begin >= 3
    natural = may & (h >> np.uint64(64 - ANCHOR) == 0)
    last = np.maximum.accumulate(np.where(natural, at, -1))
    since = at - np.maximum(last, begin + 3)
    anchors = np.flatnonzero(natural | (may & (since > 0) & (since % FORCED == 0)))
    if not len(anchors):
        return none, none, none.view(np.uint64), none.view(np.uint64)
    end = np.minimum(np.r_[anchors[1:], len(ids)], (begin + np.repeat(n, n))[anchors])
    length = end - anchors
    mark = np.zeros(len(ids) + 1, dtype=np.int64)
    mark[anchors] = np.arange(1, len(anchors) + 1)
    of = np.maximum.accumulate(mark[:-1]) - 1
    offset = np.where(of >= 0, at - anchors[np.maximum(of, 0)], 0)
    inside = (of >= 0) & (at < end[np.maximum(of, 0)])
    term = np.where(inside, scrambled(v * np.uint64(0xFF51AFD7ED558CCD) + (offset.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC4CEB9FE1A85EC53)), np.uint64(0))
    return anchors, length, h[anchors], np.add.reduceat(term, anchors)


def piece_counts(docs: DataFrame) -> DataFrame:
    """(piece, n) of all texts of docs (body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for lo, hi in portions(packed(texts)[1], 2 * SLICE):
                found = cut(texts[lo:hi])[0].dictionary_encode()
                n = np.bincount(found.indices, minlength=len(found.dictionary))
                yield pa.RecordBatch.from_arrays([named(found.dictionary), pa.array(n, pa.int64())], names=["piece", "n"])
        found = texts = batch = None
        trim()

    # A task has each piece a time or two: dealt out as they are, they pass no hash table first.
    return docs.select("body").mapInArrow(run, "piece binary, n long").repartition("piece").groupBy("piece").agg(F.sum("n").alias("n"))


def often(counts: DataFrame, n: str, most: int):
    """A condition that at most so many rows of counts meet: that n is over a threshold.

    The threshold comes from a histogram of n (sixteen steps to a doubling), so no
    sorted top reaches the driver from every task.
    """
    step = F.floor(F.log2(n) * 16)
    left, least = most, None
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("k")).orderBy(F.desc("step")).collect():
        left -= r["k"]
        if left < 0:
            break
        least = r["step"]
    return F.lit(False) if least is None else step >= least


def short(piece: str):
    """Pieces over a few dozen bytes are never broadcast, so that a number of them is a bound in bytes."""
    return F.length(piece) <= 64


def word_counts(pieces: DataFrame) -> DataFrame:
    """(word, c) from counts of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([words_of(batch.column(0)), batch.column(1)], names=["word", "n"])

    return pieces.select("piece", "n").mapInArrow(run, "word binary, n long").where("length(word) > 0").repartition("word").groupBy("word").agg(F.sum("n").alias("c"))


class Coder:
    """Texts as symbols, what their rare pieces cost to spell, and their words' counts."""

    def __init__(self, pieces: pa.Array, speller: Speller, words: pa.Array, counts: np.ndarray, under: float):
        self.pieces, self.speller, self.words = pieces, speller, words
        self.log = np.log10(np.r_[counts, 0] + 0.1) - np.log10(under)
        self.log[-1] = np.inf

    def coded(self, texts: pa.Array) -> list[pa.Array]:
        """Of each text: symbols, bits of the spelled pieces, words, those that are common, sum of their logarithms, the other words.

        What is told of a piece is told once for all places where it stands.
        """
        found, n = cut(texts)
        found = found.dictionary_encode()
        of, names, words = np.asarray(found.indices), named(found.dictionary), words_of(found.dictionary)
        ids = np.asarray(pc.index_in(names, value_set=self.pieces).fill_null(-1))
        rare = np.flatnonzero(ids < 0)
        names = names.take(pa.array(rare))
        spent = np.zeros(len(ids))
        spent[rare] = self.speller.costs(names)
        ids = ids.copy()
        ids[rare] = [-1 - (xxhash.xxh32_intdigest(p) >> 1) for p in names.to_numpy(zero_copy_only=False)]
        log = self.log[np.asarray(pc.index_in(words, value_set=self.words).fill_null(-1))]
        word = packed(words)[1] > 0
        common = word & np.isfinite(log)
        log[~common] = 0
        begin = np.cumsum(n) - n
        total = lambda v: np.add.reduceat(v[of], begin, dtype=np.float64 if v.dtype == np.float64 else np.int64)
        other = (word & ~common)[of]
        known, more = total(common), np.add.reduceat(other, begin, dtype=np.int64)
        edges = lambda k: pa.py_buffer(np.r_[0, np.cumsum(k)].astype(np.int32))
        return [
            pa.Array.from_buffers(pa.binary(), len(n), [None, edges(4 * n), pa.py_buffer(ids.astype(np.int32)[of])]), pa.array(total(spent)), pa.array(known + more), pa.array(known), pa.array(total(log)),
            pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(more)].astype(np.int32)), words.take(pa.array(of[other]))),
        ]


def lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, how many of each row) of an array of lists; null counts as empty."""
    n = np.asarray(col.value_lengths().fill_null(0)).astype(np.int64)
    return np.asarray(col.flatten()), n


def packed_ids(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same of an array of rows of int32, each packed as bytes, which Spark copies as they are."""
    return packed(col, np.int32)


def portions(n: np.ndarray, most: int = 30_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows that have about most values; a longer row is a range of its own."""
    lo = size = 0
    for i, k in enumerate(n.tolist()):
        if i > lo and size + k > most:
            yield lo, i
            lo, size = i, 0
        size += k
    if lo < len(n):
        yield lo, len(n)


def asked(coded: DataFrame) -> DataFrame:
    """uid, train, at (place and length of the run, packed), anchor, cont, and how often the own text, in training, has this anchor and run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = packed_ids(batch.column(2))
            uid, train = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            edge = np.r_[0, np.cumsum(n)]
            for lo, hi in portions(n, 1 << 18):
                own, k = ids[edge[lo] : edge[hi]], n[lo:hi]
                at, length, anchor, cont = runs_of(own, k)
                text = np.searchsorted(np.cumsum(k), at, side="right")
                place = at - (np.cumsum(k) - k)[text]
                times = []
                for key in ((anchor, text), (cont, anchor, text)):
                    order = np.lexsort(key)
                    fresh = np.r_[True, np.any([c[order][1:] != c[order][:-1] for c in key], axis=0)] if len(order) else np.zeros(0, dtype=bool)
                    group = np.cumsum(fresh) - 1
                    count = np.empty(len(order), dtype=np.int32)
                    count[order] = np.bincount(group)[group] if len(order) else 0
                    times.append(count)
                yield pa.RecordBatch.from_pydict({
                    "uid": pa.array(uid[lo:hi][text]), "train": pa.array(train[lo:hi][text].astype(bool)), "at": pa.array(place << 24 | length << 8),
                    "anchor": pa.array(anchor.view(np.int64)), "cont": pa.array(cont.view(np.int64)), "own": pa.array(np.where(train[lo:hi][text], times[1], 0).astype(np.int32)), "own_all": pa.array(np.where(train[lo:hi][text], times[0], 0).astype(np.int32)),
                })

    return coded.select("uid", "train", "ids").mapInArrow(run, "uid long, train boolean, at long, anchor long, cont long, own int, own_all int")


def followed(coded: DataFrame) -> DataFrame:
    """(uid, runs) of texts with anchors that other training texts have: place, length, kind and whether the run is theirs, packed."""
    rows = asked(coded)
    counts = rows.where("train").groupBy("anchor", "cont").agg(F.count("*").alias("n"))
    best = counts.groupBy("anchor").agg(F.sum("n").alias("n_all"), F.max(F.struct("n", "cont")).alias("best"))
    hold = F.col("best.cont") == F.col("cont")
    met = rows.drop("train").join(best, "anchor").select(
        "uid", "at", hold.alias("hold"), (F.col("best.n") - F.when(hold, F.col("own")).otherwise(0)).alias("n"), (F.col("n_all") - F.col("own_all")).alias("n_all")
    ).where("n > 0")
    kind = F.least(F.floor(F.log2("n")), F.lit(3)) * 3 + F.when(F.col("n") == F.col("n_all"), 0).when(2 * F.col("n") >= F.col("n_all"), 1).otherwise(2)
    packed = F.col("at") + (kind * 2).cast("long") + F.col("hold").cast("long")
    return met.groupBy("uid").agg(F.sort_array(F.collect_list(packed)).alias("runs"))


KINDS_OF_RUN = 12


def prepared(batch: pa.RecordBatch, ids_at: int, runs_at: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of rows: (first, last, ids, pieces of each row, which of them a run covers, runs, runs of each row)."""
    ids, n = packed_ids(batch.column(ids_at))
    runs, m = lists(batch.column(runs_at))
    edge, run_edge = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(m)]
    for lo, hi in portions(n):
        k, own = n[lo:hi], runs[run_edge[lo] : run_edge[hi]]
        held = own[(own & 1) == 1]
        text = np.repeat(np.arange(hi - lo), m[lo:hi])[(own & 1) == 1]
        a = (held >> 24) + (np.cumsum(k) - k)[text]
        mark = np.zeros(int(k.sum()) + 1, dtype=np.int64)
        np.add.at(mark, a, 1)
        np.add.at(mark, a + (held >> 8 & 0xFFFF), -1)
        yield lo, hi, ids[edge[lo] : edge[hi]], k, np.cumsum(mark[:-1]) > 0, own, m[lo:hi]


def learned(matched: DataFrame, model: Model) -> np.ndarray:
    """The mixers' weights, online over all training texts of each task, averaged by how many events they have seen."""
    sent, key = matched.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = per_worker(key, lambda: cloudpickle.loads(sent.value))
        keep_freed()
        own, seen = Model(shared.symbols, shared.bits, shared.tables, shared.weights.copy()), 0
        for batch in batches:
            for _, _, ids, n, covered, _, _ in prepared(batch, 0, 1):
                symbols = own.symbols.known(ids)
                contexts = own.symbols.contexts(symbols, n)
                _, bit, x, gate = own.inputs(symbols[~covered], contexts[:, ~covered], without=True)
                for lo in range(0, len(bit), 16_384):
                    own.learn(x[:, lo : lo + 16_384], bit[lo : lo + 16_384], gate[lo : lo + 16_384])
                seen += len(bit)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(own.weights.size)), "w": pa.array(own.weights.ravel() * seen), "n": pa.array(np.full(own.weights.size, seen, dtype=np.int64))})
        trim()

    out = model.weights.copy().ravel()
    for r in matched.where("train").select("ids", "runs").mapInArrow(run, "at long, w double, n long").groupBy("at").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).collect():
        if r["n"]:
            out[r["at"]] = r["w"] / r["n"]
    return out.reshape(model.weights.shape)


def spelling_learned(rare: DataFrame, speller: Speller) -> list[np.ndarray]:
    """The spelling mixers' weights, likewise, over all distinct rare pieces."""
    sent = rare.sparkSession.sparkContext.broadcast(cloudpickle.dumps(speller))
    shapes = [w.shape for w in speller.weights]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        own, seen = cloudpickle.loads(sent.value), 0
        for batch in batches:
            own.learn(batch.column(0), batch.column(1).to_numpy())
            seen += batch.num_rows
        flat = np.concatenate([w.ravel() for w in own.weights]).astype(np.float64)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(flat))), "w": pa.array(flat * seen), "n": pa.array(np.full(len(flat), seen, dtype=np.int64))})
        own = None
        trim()

    out = np.concatenate([w.ravel() for w in speller.weights]).astype(np.float64)
    for r in rare.mapInArrow(run, "at long, w double, n long").groupBy("at").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).collect():
        if r["n"]:
            out[r["at"]] = r["w"] / r["n"]
    ends = np.cumsum([a * b for a, b in shapes])
    return [out[e - a * b : e].reshape(a, b).astype(np.float32) for e, (a, b) in zip(ends.tolist(), shapes, strict=True)]


def speller_of(rare: DataFrame, distinct: int) -> Speller:
    """Learned from all rare training pieces (piece, n); its slots grow with their number, up to 2^SPELL_BITS."""
    bits = min(SPELL_BITS, max(14, distinct.bit_length() - 2))
    bare = Speller(Code(symbol_counts(rare)), bits)
    tables = slot_tables(rare, len(bare.weights[-1][0]), bits, piece_events(lambda: bare))
    weights = spelling_learned(rare, Speller(bare.code, bits, tables))
    return Speller(bare.code, bits, tables[:1].copy(), weights)


def symbol_tables(coded: DataFrame, symbols: Symbols, bits: int, n_pieces: int) -> np.ndarray:
    spark = coded.sparkSession
    sent, key = spark.sparkContext.broadcast(cloudpickle.dumps(symbols)), uuid.uuid4().hex

    def events():
        own = per_worker(key, lambda: cloudpickle.loads(sent.value))

        def of(batch: pa.RecordBatch) -> Iterator[tuple]:
            ids, n = packed_ids(batch.column(0))
            edge = np.r_[0, np.cumsum(n)]
            for lo, hi in portions(n, 1 << 16):
                s = own.known(ids[edge[lo] : edge[hi]])
                for slots, bit in own.counted(s, own.contexts(s, n[lo:hi]), bits):
                    yield slots, bit, None

        return of

    tasks = max(spark.sparkContext.defaultParallelism, n_pieces >> 26)  # each sends what it has added up: few tasks send less
    return slot_tables(coded.where("train").select("ids").coalesce(tasks), INPUTS - 1, bits, events)


def run_odds(matched: DataFrame) -> np.ndarray:
    """For each kind of anchor, log odds that a training text goes on as the others do."""
    each = matched.where("train and runs is not null").select(F.explode("runs").alias("r"))
    n = np.full((KINDS_OF_RUN, 2), 0.4)
    for r in each.groupBy(F.expr("cast(shiftright(r, 1) & 127 as int)").alias("kind"), F.expr("cast(r & 1 as int)").alias("hold")).count().collect():
        n[r["kind"], r["hold"]] += r["count"]
    return np.log(n[:, 1] / n[:, 0]).astype(np.float32)


def scored(matched: DataFrame, model: Model) -> DataFrame:
    """(uid, bits) of every row: its runs and symbols, without what is spelled."""
    sent, key = matched.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        own = per_worker(key, lambda: cloudpickle.loads(sent.value))
        for batch in batches:
            bits = np.zeros(batch.num_rows)
            for lo, hi, ids, n, covered, runs, m in prepared(batch, 1, 2):
                bits[lo:hi] = text_bits(own, ids, n, covered, runs, m)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], names=["uid", "bits"])
        trim()

    return matched.select("uid", "ids", "runs").mapInArrow(run, "uid long, bits double")


def text_bits(model: Model, ids: np.ndarray, n: np.ndarray, covered: np.ndarray, runs: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Bits of texts of n pieces (ids) each with m runs, of whose pieces some are covered by a run."""
    symbols = model.symbols.known(ids)
    contexts = model.symbols.contexts(symbols, n)
    length, bit, x, gate = model.inputs(symbols[~covered], contexts[:, ~covered], without=False)
    text = np.repeat(np.arange(len(n)), n)[~covered]
    events = np.bincount(text, weights=length, minlength=len(n)).astype(np.int64)
    odds = model.runs[runs >> 1 & 127]
    tail = np.bincount(text, weights=model.symbols.tail[symbols[~covered]], minlength=len(n))
    return tail + refined(model.logits(x, gate), x, bit, events) + refined(odds, odds[None], runs & 1, m)


def score(docs: DataFrame, head: int = HEAD, symbols: int = SYMBOLS) -> DataFrame:
    """The contract's columns, and the text's bits per byte (null if it is empty)."""
    spark = docs.sparkSession
    with swept(spark):
        own = project(docs, ["doc_id", "text"]).select("doc_id", (fold(10) != 0).alias("train"), text_bytes().alias("body"))
        train = own.where("train")
        pieces = written(piece_counts(train), "lm-pieces")
        words = written(word_counts(pieces), "lm-words")
        total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        n_pieces, kinds_of_piece = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        train_docs = train.count()
        tokens, kinds = total + train_docs, distinct + (train_docs > 0)
        under = tokens + 0.1 * (kinds + 1)
        got = words.where(short("word")).where(often(words.where(short("word")), "c", head)).toArrow()
        most, often_n = got.column("word").combine_chunks(), got.column("c").to_numpy()
        usual = short("piece") & often(pieces.where(short("piece")), "n", symbols)
        got = pieces.where(usual).orderBy(F.desc("n"), "piece").toArrow()
        symbol = got.column("piece").combine_chunks()
        names, counts = symbol.to_pylist(), got.column("n").to_pylist()
        speller = speller_of(pieces.where(~usual), kinds_of_piece - len(names))
        discard(pieces)
        sent, key = spark.sparkContext.broadcast(cloudpickle.dumps((symbol, speller, most, often_n, under))), uuid.uuid4().hex

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keep_freed()
            coder = per_worker(key, lambda: Coder(*cloudpickle.loads(sent.value)))
            for batch in batches:
                bodies = batch.column(2)
                size = packed(bodies)[1]
                for lo, hi in portions(size, SLICE):
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(i).slice(lo, hi - lo) for i in (0, 1)), pa.array(size[lo:hi]), *coder.coded(bodies[lo:hi])],
                        names=["doc_id", "train", "n_bytes", "ids", "spelled", "words", "common", "log", "rare"],
                    )
            trim()

        kind = dict(own.dtypes)["doc_id"]
        coded = own.mapInArrow(encode, f"doc_id {kind}, train boolean, n_bytes long, ids binary, spelled double, words long, common long, log double, rare array<binary>")
        coded = written(coded.withColumn("uid", F.monotonically_increasing_id()), "lm-coded")
        signs = Symbols(names, counts, n_pieces - sum(counts))
        bits = min(SLOT_BITS, max(14, n_pieces.bit_length() - 5))
        tables = symbol_tables(coded, signs, bits, n_pieces)
        slim = coded.select("uid", "train", "ids")
        matched = written(slim.join(followed(slim), "uid", "left"), "lm-matched")
        weights = learned(matched, Model(signs, bits, tables))
        model = Model(signs, bits, tables[:1].copy(), weights, run_odds(matched))
    rare = coded.select("uid", F.explode("rare").alias("word")).join(words.hint("shuffle_hash"), "word", "left")
    rare = rare.groupBy("uid").agg(F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.1) / under)).alias("rare_log"), F.count("c").alias("rare_known"))
    end_log = float(np.log10((train_docs + 0.1) / under))
    rows = coded.drop("rare", "ids").join(scored(matched, model), "uid").join(rare, "uid", "left")
    bits = F.col("bits") + F.col("spelled")
    return rows.select(
        "doc_id", (~F.col("train")).alias("held_out"), (F.col("words") + 1).alias("n_tokens"),
        (F.col("common") + F.coalesce("rare_known", F.lit(0)) + int(train_docs > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("log") + F.coalesce("rare_log", F.lit(0.0)) + F.lit(end_log)).alias("base_score"),
        (-bits * float(np.log10(2))).alias("score"), F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"),
    )
