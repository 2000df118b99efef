"""Audit of how filters interact: what each one removes at each place of each order.

A document's failures are five bits, A to E. A table of 32 failure patterns by 120
orders tells at which step a document goes; per task, counts by part, label, order
and step are summed in arrays, and the tasks' arrays are summed by Spark.

Defined results. Null text is empty: it fails A, not B (0 < 0 is false), and counts as a copy of
other empty texts; null lang is the part ''. A null doc_id is compared with none, so it fails E
never and makes no other fail E. Rows that repeat a doc_id are documents each; equal doc_ids are not
smaller than each other. A document counts as good (toxic) if any of its labels rows has quality (toxic) 1;
rows of labels without a document, or without a doc_id, count nowhere. A very long text is one row's
words in memory, once. An empty table gives no rows. Further columns, also of clashing names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import project

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
#: Cells of one label: a step for each removal, and one behind the last for documents that stay.
WIDTH = len(ORDERS) * (STEPS + 1)
LABELS = 4
#: Parts whose arrays a task holds before it passes them on.
PARTS = 512
SPACE = r"[\x20\x09-\x0D]+"


def first_failures() -> np.ndarray:
    """For each failure pattern and order the step, from 0, of the first filter that fails; 5 where none does."""
    out = np.full((1 << STEPS, len(ORDERS)), STEPS, dtype=np.int64)
    for o, order in enumerate(ORDERS):
        for step in reversed(range(STEPS)):
            out[(np.arange(1 << STEPS) >> FILTERS.index(order[step])) & 1 == 1, o] = step
    return out


def failures(documents: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, and mask: bits 0 to 3 say that A to D fail."""
    docs = project(documents, ["doc_id", "lang", "text"])
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    # A word more at each end where the text begins or ends with white space: both are the empty word.
    cut = docs.withColumn("words", F.split("text", SPACE))
    sized = cut.select("doc_id", "part", "text", F.size("words").alias("w"), F.size(F.array_distinct("words")).alias("d"), (F.element_at("words", 1) == "").cast("int").alias("h"), ((F.size("words") > 1) & (F.element_at("words", -1) == "")).cast("int").alias("t"))
    told = sized.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), (F.col("w") - F.col("h") - F.col("t")).cast("long").alias("words"), (F.col("d") - F.greatest("h", "t")).cast("long").alias("distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("capitals"), F.length("text").cast("long").alias("chars"), F.col("text").rlike(r"[#$%&*|]").alias("odd"),
    )
    fails = [F.col("words") < 100, 100 * F.col("distinct") < 80 * F.col("words"), 100 * F.col("capitals") > 10 * F.col("chars"), F.col("odd")]
    mask = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    return told.select("doc_id", "part", "digest", mask.alias("mask"))


def patterns(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all five bits), label (1: good, 2: toxic), n documents; several rows may say the same.

    Copies meet as counts: a text's copies are summed by mask, part and label before
    they are shuffled by the text's digest, so a text of any number of copies is a few rows.
    """
    tags = project(labels, ["doc_id", "quality", "toxic"]).where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    tags = tags.select("doc_id", (F.coalesce("good", F.lit(False)).cast("int") + 2 * F.coalesce("bad", F.lit(False)).cast("int")).alias("label"))
    rows = failures(documents).join(tags, "doc_id", "left").withColumn("label", F.coalesce("label", F.lit(0)))
    cell = ["digest", "mask", "part", "label"]
    by_id = rows.groupBy("doc_id", *cell).agg(F.count("*").alias("n"))
    cells = by_id.groupBy(*cell).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("at_low"),
    )
    lowest = F.min("low").over(Window.partitionBy("digest"))
    split = cells.withColumn("lowest", lowest).withColumn("firsts", F.col("nameless") + F.when(F.col("low") == F.col("lowest"), F.col("at_low")).otherwise(0))
    both = F.array(F.struct(F.col("mask"), F.col("firsts").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")))
    return split.select("part", "label", F.explode(both).alias("b")).select("part", "b.mask", "label", "b.n").where("n > 0")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each part an array: documents by label, order and step of removal, and then by mask.

    Counts pass np.bincount as doubles, so an array is exact up to 2^53 documents.
    """
    table, spots = first_failures(), np.arange(len(ORDERS)) * (STEPS + 1)
    held: dict[str, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        cells = pa.array([a.tolist() for a in held.values()], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), cells], names=["part", "cells"])

    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        code, mask, label, n = parts.indices.to_numpy(), *(batch.column(c).to_numpy() for c in ("mask", "label", "n"))
        for k, part in enumerate(parts.dictionary.to_pylist()):
            here = code == k
            goes = (label[here, None].astype(np.int64) * WIDTH + spots + table[mask[here]]).ravel()
            removals = np.bincount(goes, weights=np.repeat(n[here], len(ORDERS)), minlength=LABELS * WIDTH)
            seen = np.bincount(mask[here], weights=n[here], minlength=1 << STEPS)
            held[part] = held.get(part, 0) + np.rint(np.concatenate([removals, seen])).astype(np.int64)
        if len(held) > PARTS:
            yield out()
            held.clear()
    if held:
        yield out()


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    partial = patterns(documents, labels).mapInArrow(_counted, "part string, cells array<long>")
    summed = partial.select("part", F.posexplode("cells").alias("at", "n")).groupBy("part", "at").agg(F.sum("n").alias("n"))
    cells = summed.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("c")).select("part", F.col("c.n").alias("c"))

    def cell(label: int, at: Column) -> Column:
        return F.element_at("c", at + (label * WIDTH + 1))

    seen = [F.element_at("c", LABELS * WIDTH + m + 1) for m in range(1 << STEPS)]
    fails = F.array(*[sum((seen[m] for m in range(1 << STEPS) if m >> i & 1), F.lit(0)) for i in range(STEPS)])
    alone = F.array(*[seen[1 << i] for i in range(STEPS)])
    each = cells.select("part", "c", fails.alias("fails"), alone.alias("alone"), F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) * STEPS - 1))).alias("i"))
    named = each.withColumns({"step": (F.expr(f"i % {STEPS}") + 1).cast("int"), "filter_order": F.element_at(F.array(*map(F.lit, ORDERS)), F.expr(f"cast(i div {STEPS} as int)") + 1)})
    named = named.withColumns({"filter": F.substring("filter_order", F.col("step"), F.lit(1)), "at": F.expr(f"cast(i div {STEPS} as int) * {STEPS + 1} + i % {STEPS}")})
    which = F.instr(F.lit(FILTERS), F.col("filter"))
    total = sum(seen, F.lit(0))
    counts = named.select(
        "part", "filter_order", "step", "filter", total.alias("total"), sum((cell(k, F.col("at")) for k in range(LABELS)), F.lit(0)).alias("removed"),
        (cell(1, F.col("at")) + cell(3, F.col("at"))).alias("good_lost"), (cell(2, F.col("at")) + cell(3, F.col("at"))).alias("toxic_lost"),
        F.element_at("fails", which).alias("fails"), F.element_at("alone", which).alias("unique_fails"),
    )
    along = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    out = counts.withColumns({"gone": F.sum("removed").over(along), "shapley": F.sum("removed").over(Window.partitionBy("part", "filter"))})
    return out.select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
