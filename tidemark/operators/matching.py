"""Received messages matched to expected ones by their bodies, in order, where bodies may repeat.

A message received is the next expected one, past the last match, that has its body; what is stepped over was lost, and one that
has no such place is none of the expected, or came out of order. That is a recurrence along a key. Bodies are told by numbers, and with each
one received comes the last place that it is expected at, so a walk goes over both sides once: it steps on until the body comes, and it never
looks for one that does not come any more. Chunks of rows are packed, and results told to them, apart; the walk along a key is one task, which
has two numbers for a row, and takes time as the rows do.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.logs import kept

#: Arrival numbers that one chunk spans.
CHUNK = 4096


def stepped(bodies: list, places: dict) -> tuple[np.ndarray, np.ndarray]:
    """A chunk as a function: from up to uppers[i] (and over the one before) it leads to values[i], from beyond the last to itself."""
    uppers = values = np.empty(0, dtype=np.int64)
    for body in bodies:
        own = places.get(body)
        if own is None:
            continue
        nth = np.searchsorted(own, values)
        values = np.where(nth < len(own), own[np.minimum(nth, len(own) - 1)] + 1, values)
        fresh = own[own > uppers[-1]] if len(uppers) else own
        uppers, values = np.concatenate([uppers, fresh]), np.concatenate([values, fresh + 1])
        last = np.append(values[1:] != values[:-1], True)
        uppers, values = uppers[last], values[last]
    return uppers, values


def matched(expected: DataFrame, received: DataFrame, key: str, chunk: int = CHUNK) -> DataFrame:
    """received (key, arrival, body) with place: the expected one's (key, place, body), from 0; null where it is none.

    Of equal arrivals the lesser body comes first; a null body or key matches nothing. A chunk's rows are packed as one row, and a key's
    places and bodies are held in the walk as 16 bytes each.
    """
    kind = dict(received.dtypes)
    there = expected.select(F.col(key).alias("k"), "body", F.col("place").cast("long").alias("place")).where("k is not null and body is not null and place >= 0")
    known = kept(there.groupBy("k", "body").agg(F.max("place").alias("last")).withColumn("code", F.monotonically_increasing_id()))
    came = received.select(F.col(key).alias("k"), "body", F.col("arrival").cast("long").alias("arrival")).join(known, ["k", "body"], "left")
    rows = F.array_sort(F.collect_list(F.struct("arrival", "body", F.coalesce("code", F.lit(-1)).alias("code"), F.coalesce("last", F.lit(-1)).alias("at"))))
    chunks = kept(came.groupBy("k", F.floor(F.col("arrival") / chunk).alias("chunk")).agg(rows.alias("rows")))
    block = there.join(known, ["k", "body"]).groupBy("k", F.floor(F.col("place") / CHUNK).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct(F.col("place").alias("at"), "code"))).alias("rows"))
    packed = lambda df, came: df.select("k", F.lit(came).alias("came"), "chunk", F.col("rows.code").alias("codes"), F.col("rows.at").alias("ats"))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, upto, nth = object(), 0, 0
        codes, places = array("q"), array("q")
        for batch in batches:
            found = []
            came = batch.column("came")
            for k, got, own, ats in zip(batch.column("k").to_pylist(), came.to_pylist(), batch.column("codes"), batch.column("ats"), strict=True):
                if k != now:
                    now, upto, nth, codes, places = k, 0, 0, array("q"), array("q")
                own, ats = own.values.to_numpy(), ats.values.to_numpy()
                if not got:
                    codes.frombytes(own.tobytes())
                    places.frombytes(ats.tobytes())
                    continue
                met = []
                for code, last in zip(own.tolist(), ats.tolist(), strict=True):
                    if last < upto:
                        met.append(None)
                        continue
                    nth = codes.index(code, nth)
                    met.append(places[nth])
                    upto = places[nth] + 1
                    while nth < len(places) and places[nth] < upto:
                        nth += 1
                found.append(met)
            mine = batch.filter(came)
            yield pa.RecordBatch.from_arrays([mine.column("k"), mine.column("chunk"), pa.array(found, pa.list_(pa.int64()))], names=["k", "chunk", "found"])

    both = packed(block, False).unionByName(packed(chunks, True))
    walk = both.repartition("k").sortWithinPartitions("k", "came", "chunk").mapInArrow(walked, f"k {kind[key]}, chunk long, found array<long>")
    told = chunks.join(walk.withColumnsRenamed({"k": "k2", "chunk": "c2"}), F.col("k").eqNullSafe(F.col("k2")) & F.col("chunk").eqNullSafe(F.col("c2")))
    out = told.select("k", F.explode(F.arrays_zip("rows", "found")).alias("r"))
    return out.select(F.col("k").alias(key), F.col("r.rows.arrival").alias("arrival"), F.col("r.rows.body").alias("body"), F.col("r.found").alias("place"))


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The expected ones that nothing was matched to."""
    return expected.join(found.where("place is not null").select(key, "place"), [key, "place"], "left_anti")
