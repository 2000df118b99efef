"""Batch twins of the reorder hold, over arrivals (track, arrival, seq [, decodable]).

arrival numbers a track's group arrivals from 1. Lateness is against a per-track
cursor of sequence numbers, never a watermark in time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.logs import running

#: Incident rows of a track that are spelled out; more are counted only.
INCIDENTS = 256


def earlier(rows: DataFrame) -> DataFrame:
    """rows with top: the greatest seq of the track's arrivals before."""
    return running(rows, "track", "arrival", before=True, top=("max", F.col("seq")))


def arrivals(groups: DataFrame) -> DataFrame:
    """A deterministic arrival order of groups (track, grp): displaced, with holes and second copies."""
    kept = groups.where("grp % 13 <> 0 or grp = 0").select("track", F.col("grp").alias("seq"))
    key = F.col("seq") + (F.col("seq") * 7) % 16
    first = kept.select("track", "seq", F.lit(0).alias("copy"), key.alias("key"))
    second = kept.where("seq % 11 = 0").select("track", "seq", F.lit(1).alias("copy"), (key + 17).alias("key"))
    w = Window.partitionBy("track").orderBy("key", "seq", "copy")
    return first.unionByName(second).select("track", "seq", "copy", F.row_number().over(w).cast("long").alias("arrival"))


def zero_patience(rows: DataFrame) -> DataFrame:
    """rows with late: an arrival at or under the greatest before it; the others are delivered."""
    return earlier(rows).withColumn("late", F.coalesce(F.col("seq") <= F.col("top"), F.lit(False))).drop("top")


def abandoned_holes(rows: DataFrame) -> DataFrame:
    """Holes (from, to) that a hold without patience steps over, in order: what is delivered is past the greatest before it."""
    told = earlier(rows).where("seq > top + 1")
    return told.select("track", (F.col("top") + 1).alias("from_seq"), (F.col("seq") - 1).alias("to_seq"))


def late_rows(rows: DataFrame) -> DataFrame:
    """Late arrivals with the cursor they fell under; of each track the first INCIDENTS only."""
    told = earlier(rows).withColumn("cursor", F.col("top") + 1)
    nth = running(told, "track", "arrival", n=("sum", F.coalesce(F.col("seq") < F.col("cursor"), F.lit(False)).cast("long")))
    return nth.where((F.col("seq") < F.col("cursor")) & (F.col("n") <= INCIDENTS)).select("track", F.col("seq").alias("grp"), "cursor", "arrival")


def first_copies(rows: DataFrame) -> DataFrame:
    """The first copy of every group, in sequence."""
    return rows.groupBy("track", "seq").agg(F.min("arrival").alias("arrival"))


def patient_holes(rows: DataFrame) -> DataFrame:
    """Holes that a hold with endless patience gives up on at the end."""
    told = running(first_copies(rows), "track", "seq", before=True, __b=("last", F.col("seq")))
    return told.where("seq > __b + 1").select("track", (F.col("__b") + 1).alias("from_seq"), (F.col("seq") - 1).alias("to_seq"), F.lit("end").alias("reason"))


def patient_counters(rows: DataFrame) -> DataFrame:
    """A track's counters under endless patience from the backlog."""
    per = rows.groupBy("track").agg(
        F.count("*").alias("received"), F.count_distinct("seq").alias("delivered"), F.min("seq").alias("first"), F.max("seq").alias("last"),
    )
    holes = patient_holes(rows).groupBy("track").agg(F.count("*").alias("holes"))
    return per.join(holes, "track", "left").select(
        "track", "received", "delivered", (F.col("received") - F.col("delivered")).alias("repeated"), F.lit(0).cast("long").alias("dropped_late"),
        F.coalesce("holes", F.lit(0)).alias("holes_abandoned_end"), F.col("delivered").alias("hold_max_groups"), (F.col("last") - F.col("first")).alias("reorder_max"), "first", "last",
    )


def live_join(rows: DataFrame) -> DataFrame:
    """rows (with decodable) and their fate at a live join: skipped, delivered, repeated or late.

    The cursor starts at the first arrival that a decoder can begin at. What arrived
    under it before is skipped. Afterwards groups go out in sequence, so an arrival
    under the cursor is late and a second copy of a group still held is repeated.
    """
    join = rows.where("decodable").groupBy("track").agg(F.min_by("seq", "arrival").alias("c"), F.min("arrival").alias("at"))
    told = rows.join(join, "track", "left")
    # A group has gone out once it and all from c on are there; behind a hole it is held to the end.
    firsts = told.where("seq >= c").groupBy("track", "seq").agg(F.min("arrival").alias("first"), F.first("c").alias("c"), F.first("at").alias("at"))
    nth = running(firsts, "track", "seq", __n=("sum", F.lit(1).cast("long")), out=("max", F.greatest("first", "at")))
    gone = nth.select("track", "seq", "first", F.when(F.col("seq") - F.col("c") == F.col("__n") - 1, F.col("out")).alias("out"))
    told = told.join(gone, ["track", "seq"], "left")
    fate = (
        F.when(F.col("c").isNull(), "delivered")
        .when((F.col("seq") < F.col("c")) & (F.col("arrival") > F.col("at")), "late")
        .when(F.col("seq") < F.col("c"), "skipped")
        .when(F.col("arrival") == F.col("first"), "delivered")
        .when(F.col("arrival") > F.col("out"), "late")
        .otherwise("repeated")
    )
    return told.select("track", "arrival", "seq", F.col("c").alias("joined_at"), fate.alias("fate"))


def conservation(rows: DataFrame) -> DataFrame:
    """Of each track what a hold without patience received, and what became of it, each counted by itself.

    received: all arrivals; delivered: groups that left, told apart by number; dropped_late: arrivals under the
    cursor; passed_over: numbers that holes gave up. balanced: every arrival has one fate, and what left and what
    was given up are all the numbers from the first to the last.
    """
    told = earlier(rows)
    came = rows.groupBy("track").agg(F.count("*").alias("received"), F.max("seq").alias("last"), F.min_by("seq", "arrival").alias("first"))
    left = told.where("top is null or seq > top").groupBy("track").agg(F.count_distinct("seq").alias("delivered"))
    late = told.where("seq <= top").groupBy("track").agg(F.count("*").alias("dropped_late"))
    holes = abandoned_holes(rows).groupBy("track").agg(F.sum(F.col("to_seq") - F.col("from_seq") + 1).alias("passed_over"))
    both = came.join(left, "track", "left").join(late, "track", "left").join(holes, "track", "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("delivered", "dropped_late", "passed_over")}
    fair = (F.col("received") == n["delivered"] + n["dropped_late"]) & (F.col("last") - F.col("first") + 1 == n["delivered"] + n["passed_over"])
    return both.select("track", "received", *[v.alias(c) for c, v in n.items()], fair.alias("balanced"))


def fetch_lookup(asks: DataFrame, kept: DataFrame) -> DataFrame:
    """Asks (track, seq) for groups outside the subscription: the retained group, or gone."""
    found = kept.select("track", F.col("grp").alias("seq"), "packets")
    return asks.join(found, ["track", "seq"], "left").select("track", "seq", "packets", F.when(F.col("packets").isNull(), "gone").otherwise("group").alias("answer"))


def shared_edge(starts: DataFrame) -> DataFrame:
    """track, grp, since, edge, spread: where a ladder's tracks are joined, so that all begin at one media time.

    starts (track, grp, pts_us) has the first frame's time of every group that is there, as of one moment for all tracks.
    The edge is the earliest start of the tracks' newest groups: every track has come that far. Each begins with its last
    group that starts no later, or with its first where it has none; spread is how far apart these begin.
    """
    newest = starts.groupBy("track").agg(F.max_by("pts_us", "grp").alias("top"))
    every = Window.partitionBy(F.lit(0))  # a row for each track of a broadcast
    edge = newest.select("track", F.min("top").over(every).alias("edge"))
    met = starts.join(edge, "track").withColumn("__by", F.col("pts_us") <= F.col("edge"))
    per = met.groupBy("track", "edge").agg(
        F.coalesce(F.max(F.when(F.col("__by"), F.col("grp"))), F.min("grp")).alias("grp"),
        F.coalesce(F.max_by(F.when(F.col("__by"), F.col("pts_us")), F.when(F.col("__by"), F.col("grp"))), F.min_by("pts_us", "grp")).alias("since"),
    )
    return per.select("track", "grp", "since", "edge", (F.max("since").over(every) - F.min("since").over(every)).alias("spread"))
