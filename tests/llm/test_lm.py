import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemark.llm import lm, spelling
from tidemark.llm.slots import Code, stretched


def brute_base(rows):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = [[w for w in re.split("[\x20\x09-\x0d]+", lower(t)) if w] for _, t in rows]
    crc = lambda d: zlib.crc32(str(d).encode() if d is not None else b"")
    c = Counter()
    for (d, _), ws in zip(rows, words, strict=True):
        if crc(d) % 10:
            c.update(ws)
            c[None] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for (d, _), ws in zip(rows, words, strict=True):
        ts = [*ws, None]
        out.append((d, crc(d) % 10 == 0, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)))
    return out


def same(got, want):
    key = lambda r: tuple(str(x) for x in r[:4]) + (round(r[5], 4),)
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(g)[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9) for g, w in zip(got, want, strict=True))


def test_query_against_brute_force(spark):
    from tidemark.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = QUERIES["op9_lm"](spark, "/root/testdata/sf0.01").collect()
    same([tuple(r)[:6] for r in got], brute_base(rows))
    size = {d: len(t.encode()) for d, t in rows}
    held = [r for r in got if r["held_out"]]
    # It predicts texts that it has not seen: well under the bits of the bytes' own frequencies.
    n = Counter(b for _, t in rows for b in t.encode())
    flat = -sum(k / sum(n.values()) * math.log2(k / sum(n.values())) for k in n.values())
    bits = -sum(r["score"] for r in held) / math.log10(2) / sum(size[r["doc_id"]] for r in held)
    assert bits < 0.75 * flat
    assert all(r["score"] < 0 for r in got)


def test_small_head_and_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(["The cat sat\ton the mat", "the\x0bCat", None, "", "  ", "É é the a", "word " * 30_000, "x" * 20_000, "the cat sat on the mat"] * 3)]
    rows += [(None, "the dog"), (4, "the cat"), (4, "the cat")]
    df = spark.createDataFrame([(d, t, 1.0, "q") for d, t in rows], "doc_id long, text string, score double, TEXT string")
    for head, symbols in ((0, 0), (2, 3), (1000, 1000)):
        got = lm.score(df, head=head, symbols=symbols).collect()
        same([tuple(r)[:6] for r in got], brute_base(rows))
        assert all(r["score"] < 0 and (r["bits_per_byte"] is None) == (not r["n_tokens"] or not dict(rows).get(r["doc_id"], "x") and r["n_tokens"] == 1) for r in got if r["doc_id"] != 4)
    assert lm.score(df.limit(0)).count() == 0
    nothing = lm.score(df.where("doc_id = 4"))
    assert nothing.count() == 3


def a_model(rng, n=40):
    names = [bytes([97 + i % 26, 97 + i // 26]) for i in range(n)]
    signs = lm.Symbols(names, sorted(rng.integers(1, 500, size=n).tolist(), reverse=True), 30)
    tables = rng.integers(-40, 40, size=(1, lm.INPUTS - 1, 1 << 14)).astype(np.int8)
    tables[rng.random(tables.shape) < 0.3] = 0
    return lm.Model(signs, 14, tables, rng.normal(0.2, 0.1, size=(lm.DEPTHS + lm.KNOWN, lm.INPUTS)), rng.normal(size=lm.KINDS_OF_RUN).astype(np.float32))


def slow_bits(model, ids, runs):
    """Bit by bit, with what was learned refreshed where a block ends."""
    signs, total = model.symbols, 0.0
    symbols = signs.known(np.array(ids, dtype=np.int64))
    contexts = signs.contexts(symbols, np.array([len(ids)]))
    covered = set()
    for r in runs:
        if r & 1:
            covered |= set(range(r >> 24, (r >> 24) + (r >> 8 & 0xFFFF)))

    def coded(events):
        """events: (log odds, inputs, bit) of one text."""
        spent, k = 0.0, len(events[0][1]) + 1 if events else 0
        own, bend, g, h = [0.0] * k, [lm.PRIOR] * k, [0.0] * k, [0.0] * k
        edges = set(lm.BLOCKS)
        for i, (z, x, bit) in enumerate(events):
            if i in edges or i and i % lm.BLOCKS[-1] == 0:
                for j in range(k):
                    bend[j] += h[j]
                    own[j] += lm.SHARE * g[j] / bend[j]
                g, h = [0.0] * k, [0.0] * k
            x = [*x, 1.0]
            p = 1 / (1 + math.exp(-(z + sum(a * b for a, b in zip(own, x, strict=True)))))
            spent -= math.log2(p if bit else 1 - p)
            for j in range(k):
                g[j] += (bit - p) * x[j]
                h[j] += p * (1 - p) * x[j] ** 2
        return spent

    events = []
    for i, s in enumerate(symbols.tolist()):
        if i in covered:
            continue
        first, length = int(signs.code.first[s]), int(signs.code.length[s])
        for depth, step in enumerate(signs.code.steps[first : first + length].tolist()):
            node, bit = step >> 1, step & 1
            odds = float(signs.code.odds[node])
            if depth >= lm.DEEP:
                total += math.log2(1 + math.exp(-odds if bit else odds))
                continue
            x, known = [odds], 0
            for o in range(lm.INPUTS - 1):
                h = (int(contexts[o, i]) + node * 0x85EBCA6B) % 2**32
                h ^= h >> 15
                h = h * 0x2C1B3C6D % 2**32
                h ^= h >> 13
                h = h * 0x297A2D39 % 2**32
                got = int(model.tables[0, o, h >> 32 - model.bits])
                x.append(got / 16)
                known += (got != 0) << (lm.INPUTS - 2 - o)
            w = model.weights[min(depth, lm.DEPTHS - 1)] + model.weights[lm.DEPTHS + known]
            events.append((float(w @ np.array(x)), x, bit))
    return total + coded(events) + coded([(float(model.runs[r >> 1 & 127]), [float(model.runs[r >> 1 & 127])], r & 1) for r in runs])


def test_score_equals_a_bit_by_bit_version():
    rng = np.random.default_rng(1)
    model = a_model(rng)
    texts = [rng.integers(-1, 40, size=n).tolist() for n in (0, 1, 2, 3, 40, 700, 2500)]
    texts = [[i if i >= 0 else -77 for i in t] for t in texts]
    runs = [[] if len(t) < 50 else [p << 24 | 10 << 8 | int(rng.integers(12)) << 1 | int(rng.integers(2)) for p in range(5, len(t) - 10, 12)] for t in texts]
    covered = [np.zeros(len(t), dtype=bool) for t in texts]
    for c, rs in zip(covered, runs, strict=True):
        for r in rs:
            if r & 1:
                c[r >> 24 : (r >> 24) + 10] = True
    got = lm.text_bits(model, np.array([i for t in texts for i in t]), np.array([len(t) for t in texts]), np.concatenate(covered), np.array([r for rs in runs for r in rs]), np.array([len(rs) for rs in runs]))
    for g, t, rs in zip(got, texts, runs, strict=True):
        assert math.isclose(g, slow_bits(model, t, rs), rel_tol=2e-4, abs_tol=1e-6)


def test_the_symbols_are_a_distribution():
    """After any text, the probabilities of all next symbols add up to one."""
    model = a_model(np.random.default_rng(2))
    n = len(model.symbols.pieces)
    for begin in ([], [3], [5, -9, 7]):
        every = [[*begin, s if s < n else -9] for s in range(n + 1)]
        bits = lambda ts: lm.text_bits(model, np.array([i for t in ts for i in t], dtype=np.int64), np.array([len(t) for t in ts]), np.zeros(sum(map(len, ts)), dtype=bool), np.zeros(0, dtype=np.int64), np.zeros(len(ts), dtype=np.int64))
        assert math.isclose(np.exp2(bits([begin])[0] - bits(every)).sum(), 1, rel_tol=1e-3)


def test_spelling_is_a_distribution():
    """Over all third bytes of a piece, the probabilities add up to what the first two cost."""
    rng = np.random.default_rng(0)
    counts = np.ones(257, dtype=np.int64)
    counts[[97, 98, 32, 256]] = 1000
    own = spelling.Speller(Code(counts), 14, rng.integers(-40, 40, size=(1, len(spelling.ORDERS), 1 << 14)).astype(np.int8))
    total = 0.0
    for c in range(257):
        p = b"ab" + (b" " if c == 256 else b"" if c == 32 else bytes([c]))
        e = own.events([p])
        x, gate = own.inputs(e, without=False)
        z = own.logits(x, gate)
        loss = np.logaddexp(0, np.where(e["bit"] == 1, -z, z)) / np.log(2)
        total += np.exp2(-loss[e["place"] == 2].sum())
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_shared_prefixes_cost_the_same():
    rng = np.random.default_rng(3)
    own = spelling.Speller(Code(np.ones(257, dtype=np.int64)), 14, rng.integers(-40, 40, size=(1, len(spelling.ORDERS), 1 << 14)).astype(np.int8))
    names = list({bytes(rng.choice(list(b"ab\xff\x00"), size=rng.integers(0, 50))) + e for _ in range(3000) for e in (b"", b" ", b"\n")})
    got = own.costs(names)
    for i in rng.integers(len(names), size=300):
        assert math.isclose(own.costs([names[i]])[0], got[i], rel_tol=1e-5)


def test_codes_are_as_short_as_can_be():
    rng = np.random.default_rng(4)
    for counts in ([5], [1, 1], [9, 1, 1], rng.integers(1, 1000, size=300).tolist()):
        code = Code(np.array(counts))
        ways = {tuple(code.steps[f : f + n].tolist()) for f, n in zip(code.first.tolist(), code.length.tolist(), strict=True)}
        assert len(ways) == len(counts)
        heap, cost = sorted(counts), 0
        while len(heap) > 1:
            a = heap.pop(0) + heap.pop(0)
            cost += a
            heap = sorted([*heap, a])
        assert int((code.length * np.array(counts)).sum()) == cost


def test_slot_tables_against_a_count(spark):
    rng = np.random.default_rng(5)
    slots, bits = rng.integers(0, 1 << 10, size=5000), rng.integers(0, 2, size=5000)
    weights = np.where(rng.random(5000) < 0.01, 1 << 25, rng.integers(1, 300, size=5000))
    df = spark.createDataFrame([(int(s), int(b), int(w)) for s, b, w in zip(slots, bits, weights, strict=True)], "s long, b long, w long").repartition(5)

    def events():
        def of(batch):
            s, b, w = (c.to_numpy() for c in batch.columns)
            yield np.stack([s, s ^ 1]), b, w

        return of

    got = lm.slot_tables(df, 2, 10, events)
    n = np.zeros((2, 1 << 10), dtype=np.int64)
    np.add.at(n, (bits, slots), weights)
    assert (got[0, 0] == stretched(n[0], n[1])).all() and (got[0, 1] == got[0, 0][np.arange(1 << 10) ^ 1]).all()
    assert (got[1, 0] == stretched(np.maximum(n[0] - 1, 0), n[1])).all() and (got[2, 0] == stretched(n[0], np.maximum(n[1] - 1, 0))).all()


def test_pieces():
    for t in (b"", b" ", b"a", b"a b", b"a  b\n", b"\n\n ", b"\x0b\x0c a\xc3\xa9"):
        ps = [spelling.spelled(p) for p in spelling.pieces_of(t)]
        assert b"".join(ps) == t + b"\0" and all(p[-1:].isspace() for p in ps[:-1])
        raw, begin, n = spelling.symbols_of(spelling.pieces_of(t))
        back = b"".join(bytes([0 if c == spelling.END else c for c in raw[b : b + k].tolist()]) for b, k in zip(begin, n, strict=True))
        assert back == t + b"\0" and all((raw[b - 4 : b] == spelling.BEFORE).all() for b in begin)


def test_repeats_and_order_of_words_tell(spark):
    rng = np.random.default_rng(6)
    words = ["w" + "abcdefgh"[i % 8] * (1 + i // 40) + str(i) for i in range(200)]
    text = lambda: " ".join(rng.choice(words, size=300))
    rows = [(i, text()) for i in range(60)]
    train = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 10]
    copied = rows[train[0]][1]
    fresh = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 10 == 0)
    others = [i for i in range(200, 400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(fresh, copied), (others[0], " ".join(rng.permutation(copied.split()))), (others[1], text())]
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[fresh] > 0.4 * got[others[0]] and abs(got[others[0]] / got[others[1]] - 1) < 0.15
    assert got[train[0]] < 1.5 * got[fresh]  # a text's own words are not what predicts it


def test_shuffle_files_go_with_their_query(spark):
    """A step's shuffle files are gone when its result is there: they don't add up over the steps until the driver collects garbage."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = blocks.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(name)
    got = lm.score(spark.createDataFrame([(i, f"the cat {i} sat on the mat") for i in range(50)], "doc_id long, text string"))
    for _ in range(20):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(name) == setting
    assert got.count() == 50 and got.count() == 50  # what the caller runs is its own, as often as it likes


def test_packed_ids():
    rows = [[5, -7], [], [1 << 30], [], [2, 3, 4]]
    col = pa.array([np.array(r, dtype=np.int32).tobytes() for r in rows], pa.binary())
    for lo in range(6):
        for hi in range(lo, 6):
            ids, n = lm.packed_ids(col.slice(lo, hi - lo))
            assert ids.tolist() == [x for r in rows[lo:hi] for x in r] and n.tolist() == [len(r) for r in rows[lo:hi]]


def test_texts_are_cut_as_they_lie():
    """Pieces, names and words from the texts' own bytes are those that one text after the other gives."""
    rng = np.random.default_rng(7)
    texts = [b"", b" ", b"a", b"a b", b"a  b\n", b"\n\n ", b"\x0b\x0c A\xc3\xa9", b"\x00 \x00", b"x" * 300] + [bytes(rng.choice(list(b"abA \n\t\r\x00\xc3\xff"), size=rng.integers(0, 40)).tolist()) for _ in range(400)]
    whole = pa.array(texts, pa.binary())
    for lo, hi in ((0, len(texts)), (3, 200), (1, 2), (0, 1), (5, 5)):
        pieces, n = spelling.cut(whole[lo:hi])
        want = [spelling.pieces_of(t) for t in texts[lo:hi]]
        assert n.tolist() == [len(w) for w in want]
        assert spelling.named(pieces).to_pylist() == [p for w in want for p in w]
        assert spelling.words_of(pieces).to_pylist() == spelling.words_of(spelling.named(pieces)).to_pylist() == [p.translate(spelling.LOWER).rstrip() for w in want for p in w]


def test_each_piece_of_a_slice_is_spelled_once():
    asked = []

    class Counting(spelling.Speller):
        def costs(self, pieces):
            asked.extend(pieces.to_pylist())
            return super().costs(pieces)

    rng = np.random.default_rng(8)
    own = Counting(Code(np.ones(257, dtype=np.int64)), 14, rng.integers(-40, 40, size=(1, len(spelling.ORDERS), 1 << 14)).astype(np.int8))
    texts = [b"the Cat sat on the mat", b"cat the\tfoo cat", b"", b" ", b"the foo"]
    coder = lm.Coder(pa.array([b"the", b"on"], pa.binary()), own, pa.array([b"the", b"cat"], pa.binary()), np.array([9, 4]), 2.0)
    ids, spelled, words, common, log, rare = coder.coded(pa.array(texts, pa.binary()))
    assert len(asked) == len(set(asked))
    ids, n = lm.packed_ids(ids)
    edge = np.r_[0, np.cumsum(n)]
    for i, t in enumerate(texts):
        ps = spelling.pieces_of(t)
        ws = [w for w in t.lower().split() if w]
        known = [{b"the": 9, b"cat": 4}[w] for w in ws if w in (b"the", b"cat")]
        assert [k if k >= 0 else None for k in ids[edge[i] : edge[i + 1]].tolist()] == [{b"the": 0, b"on": 1}.get(p) for p in ps]
        assert math.isclose(spelled[i].as_py(), sum(own.costs(pa.array([p], pa.binary()))[0] for p in ps if p not in (b"the", b"on")), rel_tol=1e-5, abs_tol=1e-9)
        assert (words[i].as_py(), common[i].as_py(), rare[i].as_py()) == (len(ws), len(known), [w for w in ws if w not in (b"the", b"cat")])
        assert math.isclose(log[i].as_py(), sum(math.log10((c + 0.1) / 2.0) for c in known), abs_tol=1e-9)


def test_a_shared_prefix_is_counted_once_with_its_weight():
    rng = np.random.default_rng(9)
    own = spelling.Speller(Code(np.ones(257, dtype=np.int64)), 14)
    names = list({bytes(rng.choice(list(b"ab\xff"), size=rng.integers(0, 10 if rng.random() < 0.8 else 40)).tolist()) + e for _ in range(2000) for e in (b"", b" ", b"\n")})
    n = rng.integers(1, 1 << 26, size=len(names))
    got, want, events = np.zeros((5, 2 << 14), dtype=np.int64), np.zeros((5, 2 << 14), dtype=np.int64), 0
    for slots, bit, weight in spelling.piece_events(lambda: own)()(pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(n)], names=["piece", "n"])):
        events += len(bit)
        for o in range(5):
            np.add.at(got[o], 2 * slots[o] + bit, weight)
    e = own.events(names)
    for o in range(5):
        np.add.at(want[o], 2 * e["slots"][o] + e["bit"], n[e["piece"]])
    assert (got == want).all() and events < 0.9 * len(e["bit"])


def test_bits_counted_by_depth_are_the_same():
    rng = np.random.default_rng(10)
    signs = a_model(rng, 300).symbols
    n = np.array([0, 1, 2, 500])
    s = rng.integers(0, 301, size=int(n.sum()))
    contexts = signs.contexts(s, n)
    _, _, bit, _, slots = signs.events(s, contexts, 14)
    parts = list(signs.counted(s, contexts, 14))
    for o in range(lm.INPUTS - 1):
        assert sorted((2 * slots[o] + bit).tolist()) == sorted(np.concatenate([2 * p[o] + b for p, b in parts]).tolist())
