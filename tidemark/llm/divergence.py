"""Audit of how the sources of a language differ in their terms.

Shares of terms are smoothed, so a term that a source lacks has a share too: its
baseline. A pair of sources starts at the number of terms times the difference of
their baselines. An inverted index corrects it: what one source's posting changes
against any source without the term depends on its count alone, so postings are
grouped by count first; terms that two sources hold emit the pair's remaining
correction, if it is not zero. Pairs without a shared term cost nothing a term.

Shares are whole numbers of billionths; products that may pass 63 bits are decimals, so sums are exact.

Defined results. Null text, lang and source are empty; a source of which no term is kept
has a row for each other source all the same. A lang that keeps no term (V = 0) has value 0 for every pair. Repeated rows count each.
Ties take the item's bytes, ascending. A very long text is walked in slices of a megabyte. An empty table gives no rows.
Further columns, also of clashing names, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import project, text_bytes, trim, written

#: A kept term is in so many documents of its lang at least.
LEAST_DOCS = 30
#: Added to every count.
PRIOR = 5
SCALE = 1_000_000_000
#: Ranks of terms that are told.
TOP = 50
#: Entries that a task counts before it passes them on.
HELD = 1 << 18
#: Bytes of a text that are cut into terms at a time.
SLICE = 1 << 20
#: Groups (lang, source) up to which they are sent to every task; more are joined by shuffle.
BROADCAST = 20_000

#: Letters to lower case, and what is no part of a term to a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """A text's terms, some at a time."""
    text = text.translate(FOLD)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + SLICE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, count and documents, summed within a task as far as HELD allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in held.items():
            found = list(counts)
            one = lambda v: pa.array([v] * len(found), pa.string())  # noqa: E731, B023
            columns = [one(lang), one(source), pa.array(found, pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64()), pa.array([docs[t] for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(counts), set()
            for some in terms(text.as_py()):
                counts.update(some)
                seen.update(some)
            docs.update(seen)
            size += len(counts) - before
            if size > HELD:
                yield from out()
                size = 0
    yield from out()
    trim()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + PRIOR) / (total + PRIOR terms)); 1 where there are no terms."""
    wide = lambda c: c.cast("decimal(20,0)")
    over = F.greatest(total + PRIOR * terms, F.lit(1))
    return F.call_function("div", wide(count + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), wide(over)) + 1


def postings(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, source, n occurrences, in_lang occurrences: of the terms that a lang keeps, where they occur."""
    docs = project(documents, ["lang", "source", "text"])
    read = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), text_bytes().alias("text"))
    counts = read.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    return counts.withColumns({"in_docs": F.sum("docs").over(of_term), "in_lang": F.sum("n").over(of_term)}).where(F.col("in_docs") >= least_docs).select("lang", "term", "source", "n", "in_lang")


def groups(documents: DataFrame, index: DataFrame) -> DataFrame:
    """lang, source, total, terms, lang_total, zero (the share of a term that the source lacks) of every group that occurs."""
    docs = project(documents, ["lang", "source"])
    there = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    totals = index.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = index.groupBy("lang", "term").agg(F.first("in_lang").alias("n")).groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    full = there.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    return full.withColumn("zero", share(F.lit(0), F.col("total"), F.col("terms")))


def audit(documents: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank. The index and the groups are written in the shared folder."""
    index = written(postings(documents, least_docs), "divergence-index")
    there = written(groups(documents, index), "divergence-groups")
    small = F.broadcast if there.count() <= BROADCAST else lambda df: df
    entries = index.join(small(there), ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))

    far = lambda a, b: F.abs(F.col(a) - F.col(b))
    others = there.groupBy("lang").agg(F.collect_list(F.struct(F.col("source").alias("other"), F.col("zero").alias("other_zero"))).alias("others"))
    small_langs = F.broadcast if small is F.broadcast else lambda df: df
    pairs = there.join(small_langs(others), "lang").select("lang", "source", "zero", "terms", F.explode("others").alias("o")).select("lang", "source", "zero", "terms", "o.*").where("source <> other")

    # A source's postings against sources without the term: by count, as terms of equal counts change the same.
    steps = entries.groupBy("lang", "source", "zero", "p").agg(F.count("*").alias("times")).join(small_langs(others), "lang")
    alone = steps.select("lang", "source", "zero", "p", "times", F.explode("others").alias("o")).select("lang", "source", "zero", "p", "times", "o.*").where("source <> other")
    alone = alone.withColumn("c", F.col("times") * (far("p", "other_zero") - far("zero", "other_zero"))).where("c <> 0").select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), "c")

    # Terms that both hold: the rest.
    posting = entries.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "zero"))).alias("held"))
    met = posting.select("lang", "held", F.posexplode("held").alias("i", "x")).select("lang", "x", F.explode(F.slice("held", F.col("i") + 2, F.size("held"))).alias("y"))
    change = F.abs(F.col("x.p") - F.col("y.p")) + F.abs(F.col("x.zero") - F.col("y.zero")) - F.abs(F.col("x.p") - F.col("y.zero")) - F.abs(F.col("y.p") - F.col("x.zero"))
    shared = met.select("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b"), change.alias("c")).where("c <> 0")

    fixed = alone.unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("c").alias("c"))
    keyed = pairs.withColumns({"a": F.least("source", "other"), "b": F.greatest("source", "other")})
    valued = keyed.join(fixed, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), (F.col("terms") * far("zero", "other_zero") + F.coalesce("c", F.lit(0))).alias("value"))
    over = entries.withColumn("q", share(F.col("in_lang"), F.col("lang_total"), F.col("terms"))).where("p > q")
    told = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(valued).unionByName(ranked(told).where(F.col("rank") <= top))
