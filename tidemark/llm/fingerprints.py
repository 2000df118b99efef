"""Fingerprints of documents that tell two versions' differences: invertible Bloom lookup sketches of paragraphs.

A paragraph here is a line; longer ones are cut at sentence ends, so that pieces have 128 characters and up to 512, and
the pieces, joined, are the text. Each distinct piece has a digest of 60 bits. A sketch is three rows of eight
cells; a digest goes to one cell of each row, where counts are added and digests and check values are
xored. Two texts' sketches are subtracted cell by cell: what both hold is gone, and cells that
hold one digest alone tell it, which empties others, and so on. If cells are left over, there was too much for
the sketch: it is tried again with many small sketches, each for some of the digests, as large together as both texts may need,
and only for the part that failed, up to DEEPEST times; what is left then is told digest by digest.

All of it is expressions on rows (no Python on executors). A fingerprint is the first sketch in hex, so equal texts have
equal fingerprints, and it can be subtracted from another one later on.

Defined results. Null text is empty; an empty text has no piece, its sketch is empty, and two empty texts are alike (1.0).
A repeated piece counts once. A null doc_id counts as the smallest id; rows of one doc_id have the same next document, and
where the next id has several rows, the one whose text (as far as it is needed) and then whose digests come first stands for it. A table
of one id is its own next document. Very long texts are worked out whole, a row's digests in memory. An empty table gives no rows.
Further columns, also of clashing names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import project, written

#: Within a line the shortest run of 128 to 512 characters up to a sentence's end, or else what is left of it, or 512.
PIECE = r"[^\n]{128,512}?[.!?][ \t]+|[^\n]{1,512}\n*|\n+"
ROWS, CELLS = 3, 8
#: Cells of a row in the later, smaller sketches, the digests that one is made for, and how many of them take one's place at most.
LATER, LOAD, SPLIT = 4, 4, 64
#: Check values are digests modulo this prime: no sum of digests passes for one by its bits.
PRIME = 4_294_967_291
#: Rounds of peeling; a chain in 24 cells is no longer.
ROUNDS = ROWS * CELLS
#: Times that a sketch that failed is made several.
DEEPEST = 5


def let(name: str, value: str, body: str) -> str:
    """body, where name stands for value, which is worked out once. Like all that follows up to difference(), SQL text."""
    return f"transform(array({value}), {name} -> {body})[0]"


def pieces(text: str) -> str:
    return f"regexp_extract_all({text}, r'{PIECE}', 0)"


def digest(piece: str) -> str:
    return f"cast(conv(substring(md5(cast({piece} as binary)), 1, 15), 16, 10) as bigint)"


def digests(text: str) -> str:
    """The distinct digests of a text's pieces."""
    return f"array_distinct(transform({pieces(text)}, p -> {digest('p')}))"


def _width(level: int) -> int:
    return LATER if level else CELLS


def _every(level: int) -> str:
    return f"sequence(0, {ROWS * _width(level) - 1})"


def _placed(d: str, level: int) -> str:
    """A digest with its check value, its cells as bits (one in each row), and the number that spreads it."""
    n = _width(level)
    bits = " | ".join(f"shiftleft({1 << n * r}, cast(shiftright(s, {8 * r}) & {n - 1} as int))" for r in range(ROWS))
    known = f"named_struct('d', {d}, 'check', {d} % {PRIME}L, 'cells', {bits}, 'spread', s)"
    return let("s", f"xxhash64({d}, {level})" if level else d, known)


def _with(cell: str, held: str, sign: str) -> str:
    """A cell after the digests of held that go to cell i."""
    mine = f"filter({held}, x -> getbit(x.cells, i) > 0Y)"
    return f"aggregate({mine}, {cell}, (c, x) -> named_struct('n', c.n {sign}, 'digest', c.digest ^ x.d, 'check', c.check ^ x.check))"


NONE = "named_struct('n', 0, 'digest', 0L, 'check', 0L)"


def sketch(held: str) -> str:
    """The first sketch of an array of digests: its cells, row by row."""
    return let("placed", f"transform({held}, d -> {_placed('d', 0)})", f"transform({_every(0)}, i -> {_with(NONE, 'placed', '+ 1')})")


def subtracted(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'digest', x.digest ^ y.digest, 'check', x.check ^ y.check))"


def peeled(cells: str, level: int = 0) -> str:
    """(only_a, only_b, done) of a difference of sketches: the digests that one side alone has; done if no cell is left over."""
    none = "cast(array() as array<bigint>)"
    lone = f"filter(state.cells, c -> (c.n = 1 or c.n = -1) and c.check = c.digest % {PRIME}L)"
    told = f"array_distinct(transform({lone}, c -> named_struct('digest', c.digest, 'sign', c.n)))"
    found = f"transform({told}, c -> named_struct('sign', c.sign, 'x', {_placed('c.digest', level)}))"
    mine = "filter(found, f -> getbit(f.x.cells, i) > 0Y)"
    without = f"aggregate({mine}, c, (k, f) -> named_struct('n', k.n - f.sign, 'digest', k.digest ^ f.x.d, 'check', k.check ^ f.x.check))"
    left = let("hit", "aggregate(found, 0, (m, f) -> m | f.x.cells)", f"transform(state.cells, (c, i) -> case when getbit(hit, i) > 0Y then {without} else c end)")
    side = lambda sign: f"transform(filter(found, f -> f.sign = {sign}), f -> f.x.d)"
    removed = f"named_struct('cells', {left}, 'only_a', state.only_a || {side(1)}, 'only_b', state.only_b || {side(-1)}, 'going', true)"
    stuck = "named_struct('cells', state.cells, 'only_a', state.only_a, 'only_b', state.only_b, 'going', false)"
    step = f"case when state.going then {let('found', found, f'case when size(found) > 0 then {removed} else {stuck} end')} else state end"
    begin = f"named_struct('cells', {cells}, 'only_a', {none}, 'only_b', {none}, 'going', true)"
    end = "named_struct('only_a', s.only_a, 'only_b', s.only_b, 'done', forall(s.cells, c -> c.n = 0 and c.digest = 0 and c.check = 0))"
    return f"aggregate(sequence(1, {ROUNDS}), {begin}, (state, nth) -> {step}, s -> {end})"


def _part(a: str, b: str, cells: str, level: int) -> str:
    """A part of the digests and what its sketch tells; one that is done needs them no more."""
    keep = lambda x: f"case when t.done then cast(array() as array<bigint>) else {x} end"
    return let("t", peeled(cells, level), f"named_struct('a', {keep(a)}, 'b', {keep(b)}, 'only_a', t.only_a, 'only_b', t.only_b, 'done', t.done)")


def _larger(parts: str, level: int) -> str:
    """Parts, of which each that is not done is several now, with a sketch each: enough if no digest is in both texts, SPLIT at most."""
    placed = lambda held: f"transform({held}, d -> {_placed('d', level)})"
    mine = lambda held: f"filter({held}, x -> pmod(shiftright(x.spread, {8 * ROWS}), m.n) = e)"
    cells = f"transform({_every(level)}, i -> {_with(_with(NONE, 'w.a', '+ 1'), 'w.b', '- 1')})"
    one = let("w", f"named_struct('a', {mine('m.a')}, 'b', {mine('m.b')})", _part("w.a.d", "w.b.d", cells, level))
    several = f"cast(least({SPLIT}, greatest(2, (size(p.a) + size(p.b)) div {LOAD})) as bigint)"
    split = let("m", f"named_struct('a', {placed('p.a')}, 'b', {placed('p.b')}, 'n', {several})", f"transform(sequence(0L, m.n - 1), e -> {one})")
    return f"flatten(transform({parts}, p -> case when p.done then array(p) else {split} end))"


def difference(df: DataFrame, a: str, b: str, only_a: str, only_b: str, a_cells: str | None = None, b_cells: str | None = None) -> DataFrame:
    """df with only_a and only_b: the digests that one of the columns a and b (arrays of distinct digests) alone has.

    a_cells, b_cells: their first sketches, where df has them.
    """
    df = df.withColumn("__parts", F.expr(f"array({_part(a, b, subtracted(a_cells or sketch(a), b_cells or sketch(b)), 0)})"))
    for level in range(1, DEEPEST + 1):
        df = df.withColumn("__parts", F.expr(_larger("__parts", level)))
    told = lambda mine, x, y: f"flatten(transform(__parts, p -> case when p.done then p.{mine} else array_except(p.{x}, p.{y}) end))"
    return df.withColumns({only_a: F.expr(told("only_a", "a", "b")), only_b: F.expr(told("only_b", "b", "a"))}).drop("__parts")


def likeness(n_a: Column, n_b: Column, apart: Column) -> Column:
    """Digests that both have, of those that either has: told by their numbers and that of the differing ones. 1 for two empty texts."""
    return F.when(n_a + n_b == 0, F.lit(1.0)).otherwise((n_a + n_b - apart).cast("double") / (n_a + n_b + apart))


def encoded(cells: str) -> str:
    """A sketch as text: for each cell eight hex digits of the count, sixteen of the digest, eight of the check value."""
    fixed = lambda c, n: f"lpad(lower(hex({c})), {n}, '0')"
    return f"array_join(transform({cells}, c -> {fixed('cast(c.n as bigint)', 8)} || {fixed('c.digest', 16)} || {fixed('c.check', 8)}), '')"


def decoded(fingerprint: str) -> str:
    """The sketch that encoded() wrote."""
    number = lambda at, n: f"cast(conv(substring({fingerprint}, i * 32 + {at}, {n}), 16, 10) as bigint)"
    return f"transform(sequence(0, {ROWS * CELLS - 1}), i -> named_struct('n', cast({number(1, 8)} as int), 'digest', {number(9, 16)}, 'check', {number(25, 8)}))"


def changes(versions: DataFrame) -> DataFrame:
    """versions (old, new: texts) with removed and added, the pieces that one version alone has, in its order, and likeness."""
    df = versions.withColumns({"__old": F.coalesce("old", F.lit("")), "__new": F.coalesce("new", F.lit(""))})
    df = df.withColumns({"__a": F.expr(digests("__old")), "__b": F.expr(digests("__new"))})
    df = difference(df, "__a", "__b", "__less", "__more")
    named = lambda text, d: F.expr(f"array_distinct(filter({pieces(text)}, p -> array_contains({d}, {digest('p')})))")
    return df.select(*versions.columns, named("__old", "__less").alias("removed"), named("__new", "__more").alias("added"), likeness(F.size("__a"), F.size("__b"), F.size("__less") + F.size("__more")).alias("likeness"))


def following(keyed: DataFrame) -> DataFrame:
    """k, for_k, for_chars: each distinct k is the next one of for_k (the first is the last one's), whose texts have so many characters at most.

    Ids are numbered by a range partitioning: a partition's rows are counted where they lie,
    and only the partitions' sizes are summed in one place.
    """
    placed = written(
        keyed.groupBy("k").agg(F.max(F.length("text")).alias("chars")).repartitionByRange("k").sortWithinPartitions("k").withColumn("at", F.monotonically_increasing_id()), "fingerprints-order"
    )
    sizes = placed.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("size"))
    before = Window.partitionBy(F.lit(0)).orderBy("part")
    starts = sizes.select("part", (F.sum("size").over(before) - F.col("size")).alias("start"), F.sum("size").over(Window.partitionBy(F.lit(0))).alias("total"))
    placed = placed.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(starts), "part")
    numbered = placed.select("k", "chars", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("nth"), "total")
    return numbered.select("k", "nth").join(numbered.select(F.col("k").alias("for_k"), F.col("chars").alias("for_chars"), F.expr("(nth + 1) % total").alias("nth")), "nth").drop("nth")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_pieces of every document.

    The edited text's last quarter is the next document's beginning, as many characters, or all it has.
    """
    docs = project(documents, ["doc_id", "text"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    least = F.lit("") if kind == "string" else F.lit(-(1 << 63 if kind == "bigint" else 1 << 31)).cast(kind)
    keyed = docs.select(F.coalesce("doc_id", least).alias("k"), F.col("doc_id").isNull().alias("nameless"), F.coalesce("text", F.lit("")).alias("text"))
    held = keyed.withColumn("held", F.expr(digests("text")))
    # Both joins read the same shuffle of the texts; what is shuffled again is beginnings and digests.
    head = held.join(following(keyed), "k").select("for_k", F.struct(F.expr("substring(text, 1, for_chars div 4)").alias("head"), "held", "nameless").alias("next"))
    head = head.repartition("for_k").groupBy(F.col("for_k").alias("k")).agg(F.min("next").alias("next"))
    met = held.join(head, "k").withColumn("n", F.length("text"))
    edited = met.withColumn("edited", F.expr("concat(substring(text, 1, n - n div 4), substring(next.head, 1, n div 4))"))
    both = edited.select(
        F.when(~F.col("nameless"), F.col("k")).alias("doc_id"), F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "held", F.col("next.held").alias("next"), F.expr(digests("edited")).alias("edited"),
    )
    both = both.withColumns({"cells": F.expr(sketch("held")), "edited_cells": F.expr(sketch("edited"))})
    both = difference(both, "held", "edited", "less", "more", "cells", "edited_cells").withColumn("from_edited", F.size("less") + F.size("more")).drop("less", "more")
    both = difference(both, "held", "next", "less", "more", "cells").withColumn("from_next", F.size("less") + F.size("more")).drop("less", "more")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", F.expr(encoded("cells")).alias("fingerprint"), F.expr(encoded("edited_cells")).alias("edited_fingerprint"),
        likeness(F.size("held"), F.size("edited"), F.col("from_edited")).alias("near_edited"), likeness(F.size("held"), F.size("next"), F.col("from_next")).alias("near_next"), F.size("held").cast("long").alias("n_pieces"),
    )
