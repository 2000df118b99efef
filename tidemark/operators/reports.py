"""What a publisher and a run tell: windows of queued groups, trailing sums, key sets, order within a call, the run's end.

Everything is grouped by (track, window) before it meets along a track, so what a window function sees is one row
for each window. Windows in which nothing was cut and nothing left have no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.logs import kept, running

#: A track's totals are told for windows of this length.
WINDOW_MS = 5000


def depths(released: DataFrame) -> DataFrame:
    """track, ms, depth after each change: groups that have been cut and wait. At one moment groups leave before others come."""
    waits = released.where("release_ms > cut_ms")
    came = waits.select("track", F.col("cut_ms").alias("ms"), F.lit(1).cast("long").alias("step"))
    left = waits.select("track", F.col("release_ms").alias("ms"), F.lit(-1).cast("long").alias("step"))
    # All changes of one kind at one moment are one row.
    both = came.unionByName(left).groupBy("track", "ms", "step").agg(F.sum("step").alias("by")).withColumn("at", 2 * F.col("ms") + (F.col("step") > 0).cast("long"))
    return running(both, "track", "at", depth=("sum", F.col("by"))).select("track", "ms", "at", "depth")


def publisher_rows(released: DataFrame, groups: DataFrame, window_ms: int = WINDOW_MS) -> DataFrame:
    """A track's totals at the end of each window, of paced groups (pacing.release) and group rows.

    groups, packets, bytes, media count what has been cut; appended and closed what has left, which is
    written whole; queued is the difference. queue_max, wait_max_ms and unpaced are of the window alone: the most that
    waited (what waited as it began included), the longest wait and the early leaves among what left in it.
    """
    told = released.join(groups.select("track", "grp", F.col("packets").alias("p"), F.col("bytes").alias("b"), F.col("pts_end").alias("e")), ["track", "grp"], "left")
    # A group is two changes: it is cut, and it leaves. What a window tells is carried along with them, so they are read in one pass.
    waits, none = (F.col("release_ms") > F.col("cut_ms")).cast("long"), F.lit(None)
    cut = F.struct(F.col("cut_ms").alias("ms"), (2 * F.col("cut_ms") + 1).alias("at"), waits.alias("by"), F.lit(1).alias("n"), "p", "b", "e", F.lit(0).alias("gone"), none.cast("long").alias("w"), F.lit(False).alias("u"))
    left = F.struct(F.col("release_ms").alias("ms"), (2 * F.col("release_ms")).alias("at"), (-waits).alias("by"), F.lit(0).alias("n"), *[none.cast(k).alias(c) for c, k in (("p", "long"), ("b", "long"), ("e", "double"))], F.lit(1).alias("gone"), F.col("wait_ms").alias("w"), F.col("unpaced").alias("u"))
    each = told.select("track", F.explode(F.array(cut, left)).alias("x")).select("track", "x.*")
    changes = kept(each.groupBy("track", "ms", "at").agg(*[F.sum(c).alias(c) for c in ("by", "n", "p", "b", "gone")], F.max("e").alias("e"), F.max("w").alias("w"), F.count_if("u").alias("u")))
    deep = running(changes, "track", "at", depth=("sum", F.col("by")))
    rows = kept(deep.groupBy("track", F.floor(F.col("ms") / window_ms).cast("long").alias("window")).agg(
        *[F.sum(c).alias(c) for c in ("n", "p", "b", "gone", "u")], F.max("e").alias("e"), F.max("w").alias("w"), F.max("depth").alias("top"), F.max_by("depth", "at").alias("now"),
    ))
    full = running(
        rows, "track", "window", before={"__was"}, groups=("sum", F.coalesce("n", F.lit(0))), packets=("sum", F.coalesce("p", F.lit(0))), bytes=("sum", F.coalesce("b", F.lit(0))),
        media=("max", F.col("e")), appended=("sum", F.coalesce("gone", F.lit(0))), __was=("last", F.col("now")),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return full.select(
        "track", "window", "groups", "packets", "bytes", "media", "appended", F.col("appended").alias("closed"), (F.col("groups") - F.col("appended")).alias("queued"),
        F.greatest(zero("top"), zero("__was")).alias("queue_max"), zero("w").alias("wait_max_ms"), zero("u").alias("unpaced"),
    )


def trailing(rows: DataFrame, inits: DataFrame) -> DataFrame:
    """The run's one row: sums of the tracks' last rows (publisher_rows), maxima and early leaves over all windows, bytes of the tracks' init (track, init)."""
    per = rows.groupBy("track").agg(
        *[F.max(c).alias(c) for c in ("groups", "packets", "bytes", "queue_max", "wait_max_ms")], F.sum("unpaced").alias("unpaced")
    )
    size = inits.groupBy("track").agg(F.sum(F.octet_length("init")).alias("init"))
    return per.join(size, "track", "left").agg(
        F.count("*").alias("tracks"), *[F.sum(c).alias(c) for c in ("groups", "packets", "bytes")], F.coalesce(F.sum("init"), F.lit(0)).cast("long").alias("init_bytes"),
        F.max("queue_max").alias("queue_max"), F.max("wait_max_ms").alias("wait_max_ms"), F.sum("unpaced").alias("unpaced"),
    )


def lines(rows: DataFrame) -> DataFrame:
    """One line of JSON for each row, its columns in their order; nulls are left out."""
    return rows.select(F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("line"))


def joined_at(firsts: DataFrame, groups: DataFrame) -> DataFrame:
    """firsts (track, first) with the media time at which the publisher's group begins, and whether it wrote that group."""
    own = groups.select("track", F.col("grp").alias("first"), "pts_start")
    return firsts.join(own, ["track", "first"], "left").select("track", "first", F.col("pts_start").alias("media"), F.col("pts_start").isNotNull().alias("written"))


def compared(left: DataFrame, right: DataFrame, by: str, key: str) -> DataFrame:
    """Of each `by` how many keys only one side has, and whether the sets are equal; repeats count once."""
    side = lambda df, n: df.select(by, key, F.lit(n).alias("side"))
    met = side(left, 1).unionByName(side(right, 2)).groupBy(by, key).agg(F.bool_or(F.col("side") == 1).alias("a"), F.bool_or(F.col("side") == 2).alias("b"))
    out = met.groupBy(by).agg(F.count_if(F.col("a") & ~F.col("b")).alias("only_left"), F.count_if(F.col("b") & ~F.col("a")).alias("only_right"))
    return out.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def messages_first(packets: DataFrame, call: str) -> DataFrame:
    """packets with their place in their call: messages before media, each kind track by track in the order of frames."""
    w = Window.partitionBy(call).orderBy(F.col("kind").eqNullSafe("data").cast("int").desc(), "track", "frame_no")
    return packets.withColumn("place", (F.row_number().over(w) - 1).cast("long"))


def run_over(tracks: DataFrame, finished: DataFrame, asks: DataFrame, answers: DataFrame) -> DataFrame:
    """Of each broadcast (tracks: broadcast, track) the tracks that go on, the asks (track, seq) without an answer, and whether the run is over."""
    on = tracks.join(finished.select("broadcast", "track").distinct(), ["broadcast", "track"], "left_anti").groupBy("broadcast").agg(F.count("*").alias("on"))
    open_ = asks.join(answers.select("broadcast", "track", "seq").distinct(), ["broadcast", "track", "seq"], "left_anti").groupBy("broadcast").agg(F.count("*").alias("open"))
    both = tracks.select("broadcast").distinct().join(on, "broadcast", "left").join(open_, "broadcast", "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    return both.select("broadcast", n("on").alias("unfinished"), n("open").alias("outstanding"), ((n("on") == 0) & (n("open") == 0)).alias("over"))
