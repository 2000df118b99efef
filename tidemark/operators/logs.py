"""Ordered, per-track logs: numbering, group cuts, accounting.

What runs along a track (counts, maxima, the last value) is two-level: a window
inside chunks of the order column, and the chunks' own totals before it. A track
of any length is so dealt over as many tasks as it has chunks; only one row for
each chunk meets in a window. Rows without a key are a track of their own.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Values of the order column that one chunk spans.
CHUNK = 1 << 20
#: Frames of a track that are cut by elapsed time in one task.
ELAPSED_CHUNK = 1 << 16


def running(df: DataFrame, key: str, order: str, chunk: int = CHUNK, before: bool | set[str] = False, **out: tuple[str, Column]) -> DataFrame:
    """df with running values of each key in the order of an integer column, several in one pass.

    out: name=(kind, value); kind is sum, max or last (the last value that isn't null).
    Up to and with the row, or up to the row before (all of them, or those that before names). A sum of nothing is 0, else nothing is null.
    """
    names = list(out)
    held = [f"__v{i}" for i in range(len(names))]
    cut = df.withColumns({"__chunk": F.floor(F.col(order) / chunk), **{v: out[n][1] for v, n in zip(held, names, strict=True)}})
    earlier_ones = set(names) if before is True else before or set()
    inside = {n: Window.partitionBy(key, "__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1 if n in earlier_ones else 0) for n in names}
    earlier = Window.partitionBy("__key").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    over = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    total = {"sum": F.sum, "max": F.max, "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))}
    kinds = dict(zip(held, (out[n][0] for n in names), strict=True))
    totals = cut.groupBy(F.col(key).alias("__key"), F.col("__chunk").alias("__at")).agg(*[total[k](v).alias(v) for v, k in kinds.items()])
    starts = totals.select("__key", "__at", *[over[k](v).over(earlier).alias(f"{v}s") for v, k in kinds.items()])
    local = cut.withColumns({f"{v}l": over[k](v).over(inside[n]) for (v, k), n in zip(kinds.items(), names, strict=True)})
    met = local.join(starts, local[key].eqNullSafe(starts["__key"]) & local["__chunk"].eqNullSafe(starts["__at"]))
    both = {
        "sum": lambda v: F.coalesce(F.col(f"{v}l"), F.lit(0)) + F.coalesce(F.col(f"{v}s"), F.lit(0)),
        "max": lambda v: F.greatest(f"{v}l", f"{v}s"),
        "last": lambda v: F.coalesce(f"{v}l", f"{v}s"),
    }
    return met.withColumns({n: both[out[n][0]](v) for v, n in zip(held, names, strict=True)}).select(*[c for c in df.columns if c not in out], *names)


def running_sum(df: DataFrame, key: str, order: str, value: Column, out: str, chunk: int = CHUNK) -> DataFrame:
    """df with the sum of value over each key up to and with its row, in the order of an integer column."""
    return running(df, key, order, chunk, **{out: ("sum", value.cast("long"))})


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is named, and only on one machine."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """df worked out once, in the folder that driver and executors share: for what several branches of a query read."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def packets(events: DataFrame) -> DataFrame:
    """An event table as packets of tracks, not numbered yet."""
    return events.select(
        F.col("event_type").alias("track"), "event_id", (F.col("event_id") % 7 == 0).alias("keyframe"),
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)").alias("pts_us"), F.col("props").alias("payload"), "user_id", "value",
    )


def wire(events: DataFrame) -> DataFrame:
    """The deterministic wire view of an event table.

    track, frame_no (from 0), keyframe, pts_us (since 2024-01-01), payload, event_id, user_id, value.
    """
    return running_sum(packets(events), "track", "event_id", F.lit(1), "frame_no").withColumn("frame_no", F.col("frame_no") - 1)


def wire_by_keyframe(events: DataFrame) -> DataFrame:
    """wire() and cut_keyframes() in one pass: a track's first frame opens a group, whether a keyframe or not."""
    n = {"frame_no": ("sum", F.lit(1).cast("long")), "grp": ("sum", F.col("keyframe").cast("long")), "__less": ("max", F.lit(-1) * F.col("event_id"))}
    rows = running(packets(events), "track", "event_id", **n)
    opened = F.when(-F.col("__less") % 7 == 0, 1).otherwise(0)  # the first frame of the track has counted itself
    return rows.withColumns({"frame_no": F.col("frame_no") - 1, "grp": F.col("grp") - opened}).drop("__less")


def cut_keyframes(frames: DataFrame) -> DataFrame:
    """frames with grp: a track's first frame and every keyframe open a group."""
    opens = F.col("keyframe") | (F.col("frame_no") == 0)
    return running_sum(frames, "track", "frame_no", opens.cast("int"), "grp").withColumn("grp", F.col("grp") - 1)


def cut_fragments(frames: DataFrame) -> DataFrame:
    """frames with grp: every frame is a group of its own."""
    return frames.withColumn("grp", F.col("frame_no"))


def cut_regular(frames: DataFrame, ticks: int, step: int) -> DataFrame:
    """frames with grp for constant spacing: ceil(ticks / step) frames a group."""
    return frames.withColumn("grp", F.expr(f"frame_no div {-(-ticks // step)}"))


def interval_ticks(ms: int, num: int, den: int) -> int:
    """A duration in ticks of a time base, one at least."""
    return max(1, ms * max(1, den) // (max(1, num) * 1000))


def openings(records: np.ndarray, ticks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each record as an opening: the next one, the last one of its chain, and the chain's length. Records ascend; len(records) stands for none."""
    n = len(records)
    following = np.searchsorted(records, records + ticks)
    last, count = np.arange(n + 1), np.append(np.ones(n, dtype=np.int64), 0)
    step = np.append(following, n)
    while (step < n).any():  # each round doubles how far is looked ahead
        far = step < n
        last[far], count[far] = last[step[far]], count[far] + count[step[far]]
        step = step[step]
    return following, last[:n], count[:n]


def cut_elapsed(frames: DataFrame, ticks: int, chunk: int = ELAPSED_CHUNK) -> DataFrame:
    """frames with grp: a group opens once ticks have passed since the open group's first frame.

    Each opening re-bases the next, so this is no tumbling window. But within a chunk of a track, what follows an opening is told by the chunk alone,
    and only frames later than all before them in the chunk can open. So each chunk is a function from the open group's start to that at its end;
    a walk with a row for each chunk tells where chunks begin, and chunks are numbered apart. A track of any length is dealt over as many tasks.
    """
    at = F.floor(F.col("frame_no") / chunk)
    kinds = dict(frames.dtypes)
    schema = frames.schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def ordered(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """Rows in order, their times, and which are records."""
        rows = rows.sort_by("frame_no")
        pts = rows.column("pts_us").to_numpy().astype(np.int64)
        top = np.maximum.accumulate(pts)
        return rows, pts, np.flatnonzero(np.append(True, top[1:] > top[:-1]))

    def function(rows: pa.Table) -> pa.Table:
        rows, pts, records = ordered(rows)
        tops = pts[records]
        _, last, count = openings(tops, ticks)
        one = lambda v: pa.array([v.tolist()], pa.list_(pa.int64()))
        return pa.table({"track": rows.column("track").slice(0, 1), "chunk": rows.column("__chunk").slice(0, 1), "first": pa.array([int(pts[0])]), "tops": one(tops), "ends": one(tops[last]), "counts": one(count)})

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, start, group = object(), 0, 0
        for batch in batches:
            starts, groups = [], []
            for track, first, tops, ends, counts in zip(*(batch.column(c) for c in ("track", "first", "tops", "ends", "counts")), strict=True):
                if track.as_py() != now:
                    now, start, group = track.as_py(), first.as_py(), 0
                starts.append(start)
                groups.append(group)
                nth = int(np.searchsorted(tops.values.to_numpy(), start + ticks))
                if nth < len(tops):
                    start, group = ends[nth].as_py(), group + counts[nth].as_py()
            yield pa.RecordBatch.from_arrays([batch.column("track"), batch.column("chunk"), pa.array(starts, pa.int64()), pa.array(groups, pa.int64())], names=["track", "chunk", "start", "group"])

    def numbered(rows: pa.Table) -> pa.Table:
        rows, pts, records = ordered(rows)
        tops = pts[records]
        following, _, _ = openings(tops, ticks)
        opens, nth = np.zeros(len(pts), dtype=np.int64), int(np.searchsorted(tops, rows.column("__start")[0].as_py() + ticks))
        while nth < len(tops):
            opens[records[nth]] = 1
            nth = following[nth]
        grp = np.cumsum(opens) + rows.column("__group")[0].as_py()
        return rows.drop_columns(["__chunk", "__start", "__group"]).append_column("grp", pa.array(grp, pa.int64()))

    times = frames.select("track", at.alias("__chunk"), "frame_no", "pts_us")
    functions = times.groupBy("track", "__chunk").applyInArrow(function, f"track {kinds['track']}, chunk long, first long, tops array<long>, ends array<long>, counts array<long>")
    starts = functions.repartition("track").sortWithinPartitions("track", "chunk").mapInArrow(walked, f"track {kinds['track']}, chunk long, start long, group long")
    starts = starts.select(F.col("track").alias("__track"), F.col("chunk").alias("__c"), F.col("start").alias("__start"), F.col("group").alias("__group"))
    begun = frames.withColumn("__chunk", at).join(starts, F.col("track").eqNullSafe(F.col("__track")) & (F.col("__chunk") == F.col("__c"))).drop("__track", "__c")
    return begun.groupBy("track", "__chunk").applyInArrow(numbered, f"{schema}, grp long")


def group_rows(frames: DataFrame) -> DataFrame:
    """track, grp, packets, bytes, pts_start, pts_end (seconds) of every group."""
    return frames.groupBy("track", "grp").agg(
        F.count("*").alias("packets"), F.sum(F.octet_length("payload")).cast("long").alias("bytes"),
        (F.min("pts_us") / 1e6).alias("pts_start"), (F.max("pts_us") / 1e6).alias("pts_end"),
    )


def track_totals(groups: DataFrame) -> DataFrame:
    """Running totals of each track after each of its groups, of group_rows."""
    own = groups.select("track", "grp", F.col("packets").alias("p"), F.col("bytes").alias("b"), F.col("pts_end").alias("e"))
    return running(own, "track", "grp", groups=("sum", F.lit(1).cast("long")), packets=("sum", F.col("p")), bytes=("sum", F.col("b")), media=("max", F.col("e"))).drop("p", "b", "e")


def trailing_row(groups: DataFrame) -> DataFrame:
    """The total row: tracks, groups, packets, bytes, media."""
    per = groups.groupBy("track").agg(F.count("*").alias("groups"), F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"), F.max("pts_end").alias("media"))
    return per.agg(F.count("*").alias("tracks"), F.sum("groups").alias("groups"), F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"), F.max("media").alias("media"))


def monotone(frames: DataFrame) -> DataFrame:
    """frames with pts_out: the greatest pts so far on the track, so that none goes back."""
    return running(frames, "track", "frame_no", pts_out=("max", F.col("pts_us")))


def _gated(frames: DataFrame) -> Column:
    """Whether a frame's track waits for a keyframe: audio and data, where kind tells, begin anywhere."""
    return ~F.coalesce(F.col("kind").isin("audio", "data"), F.lit(False)) if "kind" in frames.columns else F.lit(True)


def join_gate(frames: DataFrame) -> DataFrame:
    """frames from each track's first keyframe on (in each epoch, where there is one); of audio and data, where kind tells, all."""
    keys = ["track", *(["epoch"] if "epoch" in frames.columns else [])]
    opens = F.col("keyframe") | ~_gated(frames)
    first = frames.where(opens).groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min("frame_no").alias("__first"))
    same = F.lit(True)
    for k in keys:
        same &= frames[k].eqNullSafe(first[f"__{k}"])
    return frames.join(first, same).where(F.col("frame_no") >= F.col("__first")).select(*[frames[c] for c in frames.columns])


def reordered(frames: DataFrame) -> DataFrame:
    """frames whose pts is no later than the one before on the track: an encoder that reorders is refused."""
    return running(frames, "track", "frame_no", before=True, __b=("last", F.col("pts_us"))).withColumnRenamed("__b", "before").where("pts_us <= before")


def decisive(frames: DataFrame) -> DataFrame:
    """Of each group whether a decoder can begin at it: what its first frame with a sample says; audio and data, where kind tells, always can."""
    sample = F.octet_length("payload") > 0
    first = F.min_by(F.when(sample, F.col("keyframe")), F.when(sample, F.col("frame_no")))
    free = F.bool_or(~_gated(frames))
    return frames.groupBy("track", "grp").agg((free | F.coalesce(first, F.lit(False))).alias("decodable"))
