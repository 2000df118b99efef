"""Token-ID shards in training order.

Texts are encoded by a byte-level BPE. In each partition of the input the texts
follow each other, each closed with the end token, and are cut into sequences
of `length` ids; only a partition's last sequence is padded. A partition's
sequences are numbered after those of all partitions before it. A keyed Feistel
permutation of the smallest even number of bits that holds their number n,
walked until it falls below n, turns the number into a slot: a permutation of
0..n-1 that needs no table and no sort of the corpus. Shard s holds the slots
from s * per_shard on, in records of the same size (little endian), so a reader
finds slot k at byte (k % per_shard) * record size of shard k // per_shard,
reads on in sequence, and resumes from any slot.

Two passes encode the texts: one counts, one deals records to their shards.
Their partitions must be the same, so docs must be something that Spark reads
alike each time, as the files of a table are; `written_first` makes it so for
other frames. Both passes digest what each partition holds, and a partition that
changed stops the run. A shard is written by one task from at most per_shard
records, under a name of its attempt, and then renamed: a task that runs again,
or twice, leaves one whole file.

Defined results
* a null or empty text is its end token alone;
* repeated rows each have their tokens; a null doc_id stays null in doc_ids;
* a text of any length is encoded whole, as one row of a task;
* an empty table gives no shard; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import sys
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import per_worker, project, shared_dir, text_bytes, written

ROUNDS = 6
#: How the vocabulary's texts are cut into words; a fixed value of the vocabulary, written so that a run is never given back and tried again.
PATTERN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: The same for texts that end before the last white space of each run that a word follows: without a look ahead, which the library's engine is slow at.
CUT_PATTERN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
#: White space as the pattern has it, which is less than Python's.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN, CUT = re.compile(f"[{SPACE}][{SPACE}]"), re.compile(f"(?<=[{SPACE}])(?=[{SPACE}][^{SPACE}])")


class Permutation:
    """A keyed permutation of 0..n-1: balanced Feistel network with cycle-walking."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, ((max(1, n - 1)).bit_length() + 1) // 2)
        self.keys = [np.uint64(xxhash.xxh64_intdigest(b"%d" % r, seed=key & (1 << 64) - 1)) for r in range(ROUNDS)]

    def once(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for k in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ self.mix(left, k) & mask, left
            else:
                left, right = right, left ^ self.mix(right, k) & mask
        return left << half | right

    @staticmethod
    def mix(x: np.ndarray, k: np.uint64) -> np.ndarray:
        h = (x + k) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def walk(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        """Images of x (or what has them); steps that leave 0..n-1 are taken again."""
        x = self.once(x.astype(np.uint64), back)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self.once(x[out], back)
        return x.astype(np.int64)


def encoding(vocabulary: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    """From the contents of a file of ranks."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    # No text is read as the special token; without one, the library would look for it at every place.
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|end|>": max(ranks.values(), default=-1) + 1})


def encoded(cut: tiktoken.Encoding, text: str) -> np.ndarray:
    """The text's ids, by an encoding with CUT_PATTERN: as those of PATTERN, as words never cross such a cut."""
    parts = CUT.split(text) if RUN.search(text) else [text]
    ids = [cut.encode_to_numpy(p, disallowed_special=()) for p in parts]
    return ids[0] if len(ids) == 1 else np.concatenate(ids)


def packed(records: np.ndarray) -> bytes:
    """Records for the shuffle: low and high bytes apart, which compress far better."""
    return zstandard.compress(records.reshape(-1, 1).view(np.uint8).T.tobytes(), 1)


def unpacked(data: bytes, width: int) -> bytes:
    return np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(width, -1).T.tobytes()


class Stream:
    """A partition's tokens, and what it held."""

    def __init__(self, cut: tiktoken.Encoding):
        self.cut, self.total, self.digest = cut, 0, xxhash.xxh64()

    def tokens(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray]]:
        """(doc_id, ids without the end, which the total has) of each text."""
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                self.digest.update(b"%d:" % len(raw))
                self.digest.update(raw)
                ids = encoded(self.cut, raw.decode("utf-8", "replace"))
                self.total += len(ids) + 1
                yield doc, ids


def materialise(docs: DataFrame, vocabulary: str, out: str, key: int = 1, length: int = 512, per_shard: int = 4096, end: int = 50256, pad: int = 0, written_first: bool = True) -> DataFrame:
    """Writes the shards and a manifest under out (a URI every executor reaches).

    Returns slot, shard, byte_offset, number, n_tokens (without padding), doc_ids
    (whose tokens it holds, in order), record_sha256 of every record, as a table
    that has been written: the shards are there when this returns.
    """
    spark = docs.sparkSession
    src = project(docs, ["doc_id", "text"])
    if written_first:
        src = written(src, "shard-texts")
    kind = dict(src.dtypes)["doc_id"]
    src = src.select("doc_id", text_bytes().alias("body"))
    file, worker = spark.sparkContext.broadcast(Path(vocabulary).read_bytes()), uuid.uuid4().hex
    top = max(end, pad, len(file.value.splitlines()))
    dtype = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
    if sys.byteorder != "little":
        raise NotImplementedError("records are little endian")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Stream(per_worker(worker, lambda: encoding(file.value, CUT_PATTERN)))
        for _ in s.tokens(batches):
            pass
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "n": [-(-s.total // length)], "digest": [s.digest.hexdigest()]})

    starts, total = {}, 0
    for r in sorted(src.mapInArrow(tally, "part long, n long, digest string").collect()):  # a row for each partition
        starts[r["part"]] = (total, r["digest"])
        total += r["n"]
    place = spark.sparkContext.broadcast(starts)
    order = Permutation(max(1, total), key)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Stream(per_worker(worker, lambda: encoding(file.value, CUT_PATTERN)))
        start, digest = place.value[TaskContext.get().partitionId()]
        held, owners, number, close = bytearray(), [], start, dtype.type(end).tobytes()

        def records(last: bool) -> Iterator[pa.RecordBatch]:
            """A row for each shard that what is held has records for."""
            nonlocal held, owners, number
            ids = np.frombuffer(bytes(held), dtype=dtype)
            ends = np.cumsum([n for _, n in owners])
            k = -(-len(ids) // length) if last else len(ids) // length
            if not k:
                return
            full = np.full(k * length, pad, dtype=dtype)
            full[: min(len(ids), k * length)] = ids[: k * length]
            full = full.reshape(k, length)
            first = np.searchsorted(ends, np.arange(k) * length, side="right")
            final = np.searchsorted(ends, np.minimum((np.arange(k) + 1) * length, len(ids)) - 1, side="right")
            slot = order.walk(np.arange(number, number + k))
            by = np.argsort(slot, kind="stable")
            shard = slot[by] // per_shard
            edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            n = np.minimum(length, len(ids) - np.arange(k) * length)
            docs_of = [[d for d, _ in owners[a : b + 1]] for a, b in zip(first[by].tolist(), final[by].tolist(), strict=True)]
            offsets = pa.array(np.r_[edges, k].astype(np.int32))
            each = lambda v, kind=pa.int64(): pa.ListArray.from_arrays(offsets, pa.array(v, kind))
            z = [packed(full[by[a:b]]) for a, b in zip(edges.tolist(), [*edges[1:].tolist(), k], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[edges]), each(slot[by]), each(number + by), each(n[by]), each(docs_of, pa.list_(names[0])), pa.array(z, pa.binary())],
                names=["shard", "slot", "number", "n_tokens", "doc_ids", "ids"],
            )
            done = min(len(ids), k * length)
            owners = [(d, int(e) - max(done, int(e) - m)) for (d, m), e in zip(owners, ends, strict=True) if e > done]
            held, number = held[done * dtype.itemsize :], number + k

        names: list = []

        def typed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                names[:] = [b.column(0).type]
                yield b

        for doc, ids in s.tokens(typed(batches)):
            held += ids.astype(dtype).tobytes()
            held += close
            owners.append((doc, len(ids) + 1))
            if len(held) > 1 << 22:
                yield from records(last=False)
        yield from records(last=True)
        if s.digest.hexdigest() != digest:
            raise RuntimeError("a partition of docs changed between the passes; use written_first")

    dealt = src.mapInArrow(deal, f"shard long, slot array<long>, number array<long>, n_tokens array<long>, doc_ids array<array<{kind}>>, ids binary")

    def write(group: pa.Table) -> pa.Table:
        shard, size = group.column("shard")[0].as_py(), length * dtype.itemsize
        flat = {n: pa.concat_arrays([c.flatten() for c in group.column(n).chunks]) for n in ("slot", "number", "n_tokens", "doc_ids")}
        raw = b"".join([unpacked(i, dtype.itemsize) for i in group.column("ids").to_pylist()])
        by = np.argsort(flat["slot"].to_numpy(), kind="stable")
        flat = {n: v.take(pa.array(by)) for n, v in flat.items()}
        records = [raw[i * size : (i + 1) * size] for i in by.tolist()]
        store, base = fs.FileSystem.from_uri(out)
        store.create_dir(base, recursive=True)
        temporary = f"{base}/.shard-{shard:08d}-{uuid.uuid4().hex}"
        with store.open_output_stream(temporary) as f:
            for record in records:
                f.write(record)
        store.move(temporary, f"{base}/shard-{shard:08d}.bin")
        offset = (flat["slot"].to_numpy() - shard * per_shard) * size
        return pa.table({"slot": flat["slot"], "shard": pa.array([shard] * len(by), pa.int64())} | {n: flat[n] for n in ("number", "n_tokens", "doc_ids")} | {"byte_offset": pa.array(offset), "record_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in records], pa.string())})

    # Slots are a permutation: every shard but the last has per_shard records, so shards need no salt.
    schema = f"slot long, shard long, number long, n_tokens long, doc_ids array<{kind}>, byte_offset long, record_sha256 string"
    listed = written(dealt.groupBy("shard").applyInArrow(write, schema), "shard-manifest")
    store, base = fs.FileSystem.from_uri(out)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/manifest.json") as f:
        f.write(json.dumps({"records": total, "per_shard": per_shard, "length": length, "record_bytes": length * dtype.itemsize, "key": key, "rounds": ROUNDS, "end": end, "pad": pad}).encode())
    return listed


def read(out: str, start: int = 0, stop: int | None = None) -> Iterator[np.ndarray]:
    """The records of slots start..stop in order; resumes anywhere, reading on in sequence."""
    store, base = fs.FileSystem.from_uri(out)
    with store.open_input_stream(f"{base}/manifest.json") as f:
        about = json.loads(f.read())
    size, per, n = about["record_bytes"], about["per_shard"], about["records"]
    stop = n if stop is None else min(stop, n)
    dtype = np.dtype("<u2") if size == 2 * about["length"] else np.dtype("<u4")
    slot = start
    while slot < stop:
        with store.open_input_file(f"{base}/shard-{slot // per:08d}.bin") as f:
            f.seek(slot % per * size)
            for _ in range(min(stop, (slot // per + 1) * per) - slot):
                yield np.frombuffer(f.read(size), dtype=dtype)
                slot += 1


def report(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """materialise into a new folder beside the checkpoints."""
    return materialise(docs, vocabulary, f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}", **options)
