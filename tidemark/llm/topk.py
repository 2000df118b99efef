"""Exact top-k by inner product: dual-tree search over cover trees of queries and data.

A tree's node has a centre, the mean of its descendants, and a covering radius, the
distance of the furthest. Its children gather around seeds that are taken farthest
first until they cover it at half the radius (or the fan-out is reached), so seeds
are about as far apart as they cover. For a query node (a, s) and a data node (b, r) no inner
product exceeds <a,b> + s|b| + r|a| + sr: the pair is left out if that is under
the worst kth score of the node's queries. Pairs of leaves are multiplied out.

Data is dealt to the nearest of some centres, taken farthest first from a bounded
sample: the tree's top level, whose cells' radii are of all rows. A cell's rows are
dealt by number to parts of bounded size, so equal rows spread. Each query first
searches one part of the cell whose centre suits it best; its worst kth score there
then prunes whole cells, and starts the search in the parts of the others. A part
that more queries ask for than fit a block is searched block by block.

Components become floor(256 * x), x as double, and scores are exact integers as
long as they fit a long. Defined results
* vectors that are null, or hold null or non-finite components, take no part;
  an empty vector does, with scores 0, and shorter vectors count as padded with 0;
* a query's own row is told by its vec_id; rows that repeat another vec_id are
  candidates each; of query rows that repeat a vec_id the smallest vector asks;
* rows with null vec_id take no part; ties go to the smaller vec_id;
* an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import project, written

FAN, LEAF = 16, 256
#: Centres at most, rows for each, and rows of the sample that each is taken from.
CENTRES, ROWS, SAMPLED = 1024, 4096, 8
#: Rows of a part and of a block of queries at most, and numbers that either holds at most.
MOST, QUERIES, NUMBERS = 65_536, 32_768, 1 << 23
EXACT = 1 << 53


@dataclass
class Node:
    lo: int
    hi: int
    centre: np.ndarray
    radius: float
    norm: float
    children: list


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, Node | None]:
    """(order, root): node's descendants are points[order[lo:hi]]."""
    order = np.arange(len(points))
    if not len(points):
        return order, None

    def build(lo: int, hi: int) -> Node:
        own = points[order[lo:hi]]
        centre = own.mean(axis=0)
        away = np.sqrt(((own - centre) ** 2).sum(axis=1))
        node = Node(lo, hi, centre, float(away.max()), float(np.sqrt((centre**2).sum())), [])
        if hi - lo <= LEAF or node.radius == 0:
            return node
        nearest, dist, seeds = np.zeros(hi - lo, dtype=np.int64), np.full(hi - lo, np.inf), [int(away.argmax())]
        while True:
            d = np.sqrt(((own - own[seeds[-1]]) ** 2).sum(axis=1))
            closer = d < dist
            nearest[closer] = len(seeds) - 1
            dist = np.where(closer, d, dist)
            if len(seeds) == FAN or (len(seeds) > 1 and dist.max() <= node.radius / 2):
                break
            seeds.append(int(dist.argmax()))
        order[lo:hi] = order[lo:hi][np.argsort(nearest, kind="stable")]
        begin = lo
        for n in np.bincount(nearest, minlength=len(seeds)).tolist():
            if n:
                node.children.append(build(begin, begin + n))
                begin += n
        return node

    return order, build(0, len(points))


class Search:
    """The best k of data for each of queries (ids and integer vectors); what scores under a query's least is of no use."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int, least: np.ndarray | None = None):
        self.k, self.pairs = k, 0
        peak = max(int(np.abs(queries).max(initial=0)), 1) * max(int(np.abs(data).max(initial=0)), 1) * max(1, data.shape[1])
        self.exact = peak < EXACT
        fq, fd = queries.astype(np.float64), data.astype(np.float64)
        qo, self.q_root = cover_tree(fq)
        do, self.d_root = cover_tree(fd)
        self.query_ids, self.ids = query_ids[qo], ids[do]
        self.queries, self.data = (fq[qo], fd[do]) if self.exact else (queries[qo], data[do])
        self.best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))] * len(qo)
        self.worst = np.full(len(qo), -np.inf) if least is None else least[qo].astype(np.float64)
        if self.q_root and self.d_root:
            self.visit(self.q_root, self.d_root)

    def bound(self, q: Node, d: Node) -> float:
        top = float(q.centre @ d.centre) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
        return top + 1e-9 * abs(top) + 1e-3

    def visit(self, q: Node, d: Node) -> None:
        stack = [(self.bound(q, d), q, d)]
        while stack:
            top, q, d = stack.pop()
            if top < self.worst[q.lo : q.hi].min():
                continue
            if not q.children and not d.children:
                self.base(q, d)
                continue
            wide = d.children and (d.radius >= q.radius or not q.children)
            nxt = [(self.bound(q, c), q, c) for c in d.children] if wide else [(self.bound(c, d), c, d) for c in q.children]
            stack += sorted(nxt, key=lambda x: x[0])  # the most promising pair comes off first

    def base(self, q: Node, d: Node) -> None:
        self.pairs += (q.hi - q.lo) * (d.hi - d.lo)
        for lo in range(d.lo, d.hi, 4096):  # equal vectors make large leaves
            hi = min(d.hi, lo + 4096)
            for a in range(q.lo, q.hi, 1024):
                self.block(a, min(q.hi, a + 1024), lo, hi)

    def block(self, a: int, b: int, lo: int, hi: int) -> None:
        s = self.queries[a:b] @ self.data[lo:hi].T
        worst = self.worst[a:b]
        own = np.nonzero(np.isin(self.query_ids[a:b], self.ids[lo:hi]))[0]
        ok = np.ones_like(s, dtype=bool)
        if len(own):
            ok[own] = self.query_ids[a:b][own, None] != self.ids[None, lo:hi]
        spare = self.k + (int((~ok[own]).sum(axis=1).max()) if len(own) else 0)
        if hi - lo > 4 * spare and not np.isfinite(worst).all():
            # The block's own kth score is a bound as well; of more, where the query's own rows may be among them.
            mine = np.partition(s, hi - lo - spare, axis=1)[:, hi - lo - spare]
            worst = np.maximum(worst, mine)
        ok &= s >= worst[:, None]
        rows, cols = np.nonzero(ok)
        if not len(rows):
            return
        score, ids = s[rows, cols].astype(np.int64), self.ids[lo:hi][cols]
        touched = np.unique(rows)
        old = [(np.full(len(self.best[a + r][0]), r), *self.best[a + r]) for r in touched.tolist()]
        row = np.concatenate([rows, *(o[0] for o in old)])
        score = np.concatenate([score, *(o[1] for o in old)])
        ids = np.concatenate([ids, *(o[2] for o in old)])
        by = np.lexsort((ids, -score, row))
        row, score, ids = row[by], score[by], ids[by]
        first = np.searchsorted(row, touched)
        end = np.minimum(np.searchsorted(row, touched, side="right"), first + self.k)
        for r, f, e in zip(touched.tolist(), first.tolist(), end.tolist(), strict=True):
            self.best[a + r] = (score[f:e], ids[f:e])
            if e - f == self.k:
                self.worst[a + r] = max(self.worst[a + r], score[e - 1])

    def result(self) -> pa.Table:
        n = [len(s) for s, _ in self.best]
        none = np.zeros(0, dtype=np.int64)
        return pa.table({
            "query_id": pa.array(np.repeat(self.query_ids, n).astype(np.int64)),
            "vec_id": pa.array(np.concatenate([none, *(i for _, i in self.best)])),
            "score": pa.array(np.concatenate([none, *(s for s, _ in self.best)])),
        })


def matrix(col: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, padded with 0 to width."""
    flat = col.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks) if flat.num_chunks else pa.array([], col.type)
    n = np.asarray(flat.value_lengths().fill_null(0)).astype(np.int64)
    values = np.asarray(flat.flatten())
    out = np.zeros((len(n), width), dtype=np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of long) of the rows that take part."""
    own = project(vectors, ["vec_id", "embedding"]).where("vec_id is not null and embedding is not null")
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return own.where(~F.exists("embedding", bad)).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"))


def centres_of(data: DataFrame, n: int, width: int) -> np.ndarray:
    """Rows far apart, farthest first, of a sample bounded in rows and numbers."""
    most = max(1, min(CENTRES, n // ROWS, NUMBERS // width // SAMPLED))
    got = data.select("v", F.xxhash64("v", F.lit("centres")).alias("h")).distinct().orderBy("h", "v").limit(most * SAMPLED).select("v").toArrow()
    points = matrix(got.column("v"), width).astype(np.float64)
    if not len(points):
        return np.zeros((1, width))
    chosen, away = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < most and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def celled(data: DataFrame, centres: np.ndarray) -> DataFrame:
    """data with its cell, the nearest centre, and how far away that is."""
    sent = data.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        square = (own**2).sum(axis=1)
        for batch in batches:
            x = matrix(pa.chunked_array([batch.column(1)]), own.shape[1]).astype(np.float64)
            cell = np.concatenate([np.zeros(0, dtype=np.int64), *((square - 2 * x[i : i + 4096] @ own.T).argmin(axis=1) for i in range(0, len(x), 4096))])
            away = np.sqrt(((x - own[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=["vec_id", "v", "cell", "away"])

    return data.mapInArrow(run, "vec_id long, v array<long>, cell int, away double")


def reached(asked: DataFrame, centres: np.ndarray, radius: np.ndarray, parts: np.ndarray, first: bool) -> DataFrame:
    """asked (vec_id, v, least) for each part to search: (vec_id, v, least, cell, part).

    first: one part of the best cell. Else all parts of the cells that may hold a score of least or more.
    """
    sent = asked.sparkSession.sparkContext.broadcast((centres, radius, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, r, p = sent.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                x, ids = matrix(pa.chunked_array([part.column(1)]), c.shape[1]).astype(np.float64), part.column(0).to_numpy()
                score = x @ c.T
                if first:
                    cell = np.where(p > 0, score, -np.inf).argmax(axis=1)
                    row, at = np.arange(len(x)), ids % np.maximum(p[cell], 1)
                else:
                    top = score + np.sqrt((x**2).sum(axis=1))[:, None] * r
                    least = part.column(2).to_numpy(zero_copy_only=False)
                    hit, cell = np.nonzero((top + 1e-9 * np.abs(top) + 1e-3 >= least[:, None]) & (p > 0))
                    row, cell = np.repeat(hit, p[cell]), np.repeat(cell, p[cell])
                    n = p[cell]
                    at = np.arange(len(row)) - np.maximum.accumulate(np.where(np.r_[True, (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])], np.arange(len(row)), 0)) if len(row) else n
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(x.take(take) for x in part.columns), pa.array(cell.astype(np.int32)), pa.array(at.astype(np.int32))], names=["vec_id", "v", "least", "cell", "part"])

    return asked.select("vec_id", "v", "least").mapInArrow(run, "vec_id long, v array<long>, least double, cell int, part int")


def searched(queries: DataFrame, data: DataFrame, k: int, width: int, most: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each query (vec_id, v, least) in each part (cell, part) that it is sent to."""
    crowd = queries.groupBy(F.col("cell").alias("__c"), F.col("part").alias("__p")).agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"))
    met = queries.join(crowd, (F.col("cell") == F.col("__c")) & (F.col("part") == F.col("__p")))
    q = met.select("vec_id", "v", "least", "cell", "part", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"))
    d = data.join(crowd, (F.col("cell") == F.col("__c")) & (F.col("part") == F.col("__p"))).select("vec_id", "v", "cell", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def cell(asked: pa.Table, points: pa.Table) -> pa.Table:
        if not asked.num_rows or not points.num_rows:
            none = pa.array([], pa.int64())
            return pa.table({"query_id": none, "vec_id": none, "score": none})
        ids = lambda t: t.column("vec_id").to_numpy()
        return Search(ids(asked), matrix(asked.column("v"), width), ids(points), matrix(points.column("v"), width), k, asked.column("least").to_numpy()).result()

    keys = ("cell", "part", "block")
    return q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows for each row that is_query picks."""
    data = quantised(vectors)
    n, width = data.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = max(1, width)
    centres = centres_of(data, n, width)
    rows = written(celled(data, centres).withColumn("uid", F.monotonically_increasing_id()), "topk-cells")
    most = max(1, min(MOST, NUMBERS // width))
    radius, parts = np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for r in rows.groupBy("cell").agg(F.max("away").alias("away"), F.count("*").alias("n")).collect():  # a row for each centre
        radius[r["cell"]], parts[r["cell"]] = r["away"] * (1 + 1e-9), -(-r["n"] // most)
    number = F.element_at(F.lit(parts.tolist()).cast("array<long>"), F.col("cell") + 1)
    dealt = rows.select("vec_id", "v", "cell", F.pmod(F.xxhash64("uid"), number).cast("int").alias("part"))
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    block = max(1, min(QUERIES, NUMBERS // width))
    near = searched(reached(asked.withColumn("least", F.lit(float("-inf"))), centres, radius, parts, first=True), dealt, k, width, block)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    worst = near.groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n")).where(F.col("n") >= k)
    told = asked.join(worst, asked["vec_id"] == worst["query_id"], "left").select("vec_id", "v", F.coalesce(F.col("worst").cast("double"), F.lit(float("-inf"))).alias("least"))
    found = searched(reached(told, centres, radius, parts, first=False), dealt, k, width, block)
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
