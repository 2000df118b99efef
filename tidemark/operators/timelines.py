"""Joins and measures over timelines: as-of, nearest, range anti-join, lateness, batches, drift, gaps.

As-of joins are one sort: both sides are laid together in time and a running
value is carried over, so no pair of rows is ever made only to be dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.logs import kept, running

#: Microseconds that a chunk of a timeline spans, a little over a day.
SPAN = 1 << 37


def asof(left: DataFrame, right: DataFrame, key: str, time: str, values: list[str], forward: bool = True) -> DataFrame:
    """left with right_<c> of the right row of the same key that is next in time (or last, backward); equal times meet.

    Times are whole numbers. Of right rows at one time the least values are taken. What is carried crosses chunks of time, so a key is dealt over tasks.
    """
    names = left.columns
    own = F.struct(*[F.col(c) for c in names])
    held = F.struct(F.col(time).alias(time), *[F.col(c).alias(c) for c in values if c != time])
    once = right.groupBy(key, time).agg(F.min(F.struct(*values)).alias("__v")).select(key, time, *[F.col(f"__v.{c}").alias(c) for c in values if c not in (key, time)])
    a = left.select(F.col(key).alias("__k"), F.col(time).alias("__t"), F.lit(0).alias("__s"), own.alias("__l"))
    b = once.select(F.col(key).alias("__k"), F.col(time).alias("__t"), F.lit(1).alias("__s"), held.alias("__r"))
    both = a.unionByName(b, allowMissingColumns=True)
    # Walking back in time, a right row stands before the left ones at its time, walking on likewise.
    order = -(2 * F.col("__t") + F.col("__s")) if forward else 2 * F.col("__t") + 1 - F.col("__s")
    met = running(both.withColumn("__o", order.cast("long")), "__k", "__o", 2 * SPAN, __m=("last", F.col("__r"))).where("__s = 0")
    return met.select("__l.*", *[F.col(f"__m.{c}").alias(f"right_{c}") for c in dict.fromkeys([time, *values])])


def nearest(left: DataFrame, right: DataFrame, key: str, time: str, value: str, within: int) -> DataFrame:
    """left with the nearest right value and its distance, at most within away; of equal ones the earlier."""
    back = asof(left, right, key, time, [value], forward=False).withColumnsRenamed({f"right_{time}": "__bt", f"right_{value}": "__bv"})
    both = asof(back, right, key, time, [value]).withColumnsRenamed({f"right_{time}": "__ft", f"right_{value}": "__fv"})
    b, f = F.col(time) - F.col("__bt"), F.col("__ft") - F.col(time)
    earlier = f.isNull() | (b <= f)
    out = both.withColumn("distance", F.when(earlier, b).otherwise(f)).withColumn("match", F.when(earlier, F.col("__bv")).otherwise(F.col("__fv")))
    return out.where(F.col("distance") <= within).drop("__bt", "__bv", "__ft", "__fv")


def unmet(spans: DataFrame, packets: DataFrame, key: str, slack: int) -> DataFrame:
    """Spans (key, start, end) in which, widened by slack, no packet (key, at) lies."""
    wide = spans.withColumn("at", F.col("start") - slack)
    met = asof(wide, packets.select(key, "at"), key, "at", ["at"])
    return met.where(F.col("right_at").isNull() | (F.col("right_at") > F.col("end") + slack)).drop("at", "right_at")


def matched_in_order(expected: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """expected (key, place, body) with the order it was received in, or null; bodies are unique in a key.

    in_order says whether it came after every expected one before it.
    """
    met = expected.join(received.select(key, "body", "arrival"), [key, "body"], "left")
    before = F.max("arrival").over(Window.partitionBy(key).orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    return met.withColumn("in_order", F.when(F.col("arrival").isNotNull(), F.coalesce(F.col("arrival") > before, F.lit(True))))


def above_floor(rows: DataFrame, key: str, time: str, late: str, reach: int) -> DataFrame:
    """rows with the lateness over the least within reach on either side in time."""
    # A row's reach begins in one chunk of time and ends in the next, a reach on either side long: what is least in it is least from its beginning
    # to the one chunk's end, or from the other's beginning to its end. Both are running values, so rows that lie close together cost no more.
    span = max(2 * reach, 1)

    def least(df: DataFrame, edge: Column, out: str, back: bool) -> DataFrame:
        """df (__r, and what was found before) with the least value of edge's chunk, from edge on or (not back) up to it."""
        seen = F.struct(F.col(f"__r.{time}").alias("t"), F.col(f"__r.{late}").alias("v"), F.lit(False).alias("asks"))
        asks = F.struct(edge.alias("t"), F.lit(None).cast(kind).alias("v"), F.lit(True).alias("asks"))
        each = df.withColumn("__e", F.explode(F.array(seen, asks))).select(
            F.col(f"__r.{key}").alias("__k"), F.floor(F.col("__e.t") / span).alias("__chunk"), F.col("__e.t").alias("__t"), F.col("__e.v").alias("__v"), F.col("__e.asks").alias("__asks"),
            *[F.when(F.col("__e.asks"), F.col(c)).alias(c) for c in df.columns],
        )
        w = Window.partitionBy("__k", "__chunk").orderBy(F.desc("__t") if back else F.asc("__t")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return each.withColumn(out, F.min("__v").over(w)).where("__asks").select(*df.columns, out)

    kind = dict(rows.dtypes)[late]
    before = least(rows.select(F.struct(*rows.columns).alias("__r")), F.col(f"__r.{time}") - reach, "__a", back=True)
    both = least(before, F.col(f"__r.{time}") + reach, "__b", back=False)
    return both.select("__r.*", (F.col(f"__r.{late}") - F.least("__a", "__b")).alias("above"))


def batches(rows: DataFrame, key: str, time: str, gap: int) -> DataFrame:
    """key, batch (from 0), packets: a packet that comes gap or more after the last one opens a batch."""
    once = kept(rows.groupBy(key, time).agg(F.count("*").alias("__n")).withColumn("__chunk", F.floor(F.col(time) / SPAN)))
    # Inside a chunk the packet before tells; of chunks, the one before's last packet.
    inside = Window.partitionBy(key, "__chunk").orderBy(time)
    opens = lambda at, last, w: F.coalesce((F.col(at) - F.lag(last).over(w) >= gap).cast("long"), F.lit(0))
    local = once.withColumn("__o", opens(time, time, inside))
    ends = local.groupBy(F.col(key).alias("__key"), F.col("__chunk").alias("__at")).agg(F.sum("__o").alias("__in"), F.min(time).alias("__a"), F.max(time).alias("__b"))
    along = Window.partitionBy("__key").orderBy("__at")
    ends = ends.withColumn("__f", opens("__a", "__b", along)).withColumn("__base", F.sum(F.col("__in") + F.col("__f")).over(along) - F.col("__in"))
    summed = local.withColumn("__l", F.sum("__o").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    met = summed.join(ends, summed[key].eqNullSafe(ends["__key"]) & (summed["__chunk"] == ends["__at"]))
    return met.groupBy(key, (F.col("__base") + F.col("__l")).alias("batch")).agg(F.sum("__n").alias("packets"))


def ranked(rows: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """key, n, median and nearest-rank percentiles of value, for any number of rows.

    Equal values are counted first, so what meets in a window is the distinct values.
    """
    counts = rows.groupBy(key, value).agg(F.count("*").alias("__c"))
    w = Window.partitionBy(key)
    upto = F.sum("__c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    at = counts.select(key, value, "__c", upto.alias("__to"), F.sum("__c").over(w).alias("__n"))
    rank = lambda k: F.min(F.when(F.col("__to") > k, F.col(value)))
    n = F.col("__n")
    cuts = [rank(F.least(n - 1, F.floor(n * s))).alias(name) for name, s in shares.items()]
    middle = (rank(F.expr("(__n - 1) div 2")) + rank(F.expr("__n div 2"))) / 2
    return at.groupBy(key).agg(F.max("__n").alias("n"), middle.alias("median"), *cuts, F.max(value).alias("greatest"))


def drift(rows: DataFrame, key: str, time: str, late: str, span: int) -> DataFrame:
    """Least lateness of the last span of time less that of the first."""
    ends = rows.groupBy(key).agg(F.min(time).alias("__a"), F.max(time).alias("__b"))
    met = rows.join(ends, key)
    first = F.min(F.when(F.col(time) <= F.col("__a") + span, F.col(late)))
    last = F.min(F.when(F.col(time) >= F.col("__b") - span, F.col(late)))
    return met.groupBy(key).agg((last - first).alias("drift"))


def widest_gap(rows: DataFrame, key: str, order: str, time: str) -> DataFrame:
    """The widest step of the running greatest time."""
    top = running(rows, key, order, before=True, __top=("max", F.col(time)))
    return top.groupBy(key).agg(F.max(F.col(time) - F.col("__top")).alias("widest"))


def report_windows(rows: DataFrame, key: str, order: str) -> DataFrame:
    """rows with window: a track's n-th row belongs to the n-th summary window."""
    nth = running(rows, key, order, window=("sum", F.lit(1).cast("long")))
    return nth.withColumn("window", (F.col("window") - 1).cast("int"))
