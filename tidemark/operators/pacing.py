"""Pacing: one group at a time leaves a track's queue.

Group i, cut at c_i, leaves at r_0 = c_0 and then
r_i = max(c_i, min(r_{i-1} + min(max(rtt, GAP), CAP), c_{i+DEPTH})): after the one
before is acknowledged and GAP has passed, at CAP whatever happens, or when
more than DEPTH groups wait. It is a recurrence, so a track is walked in order.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values, in milliseconds: least gap between groups, longest hold; and groups that may wait.
GAP, CAP, DEPTH = 10, 250, 8


def release(groups: DataFrame, rtt: int) -> DataFrame:
    """track, grp, cut_ms, release_ms, wait_ms, unpaced of groups (track, grp, cut_ms).

    A track's groups are sorted and stream through one task, which holds DEPTH + 1 of them.
    """
    need = max(rtt, GAP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque = deque()
        track = last = None
        names = ["track", "grp", "cut_ms", "release_ms", "wait_ms", "unpaced"]

        def leave(limit: int | None):
            nonlocal last
            grp, cut = waiting.popleft()
            soonest = None if last is None else last + min(need, CAP)
            r = cut if last is None else max(cut, soonest if limit is None else min(soonest, limit))
            row = (track, grp, cut, r, r - cut, last is not None and r < last + need)
            last = r
            return row

        def sent(rows: list) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            rows = []
            for t, g, c in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if t != track:
                    while waiting:
                        rows.append(leave(None))
                    track, last = t, None
                waiting.append((g, c))
                if len(waiting) > DEPTH:
                    rows.append(leave(c))
            yield sent(rows)
        rows = []
        while waiting:
            rows.append(leave(None))
        yield sent(rows)

    src = groups.select("track", F.col("grp").cast("long"), F.col("cut_ms").cast("long")).repartition("track").sortWithinPartitions("track", "grp")
    return src.mapInArrow(run, "track string, grp long, cut_ms long, release_ms long, wait_ms long, unpaced boolean")


def summary(released: DataFrame) -> DataFrame:
    """A track's groups, longest wait and how many left before their turn."""
    return released.groupBy("track").agg(F.count("*").alias("groups"), F.max("wait_ms").alias("wait_max_ms"), F.sum("wait_ms").alias("wait_ms"), F.count_if("unpaced").alias("unpaced"))
