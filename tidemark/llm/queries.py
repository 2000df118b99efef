"""The operN_* queries over the driver's tables, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, divergence, filters, fingerprints, langid, licences, lm, secrets, shards, simhash, substrings, topk
from tidemark.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op1_decontaminate"] = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM documents),
bw AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM bw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM dw, sizes WHERE len(ws) >= n)),
hit AS (SELECT DISTINCT doc_id, i, dg.n, item_id FROM dg JOIN win ON dg.g = win.g AND dg.n = win.n),
words AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


@query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


@query
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op10_topk"] = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(table(spark, sf_dir, "documents"))


@query
def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table's files give the same partitions in both passes; that is checked as well.
    return shards.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), key=20, written_first=False)


@query
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(table(spark, sf_dir, "documents"))


#: The cells are worked out by their definition; likeness from the sets of digests themselves, which peeling must recover.
ORACLES["op11_fingerprints"] = r"""
WITH o AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id), '') AS nt,
    lead(doc_id) OVER (ORDER BY doc_id) AS nid, min(doc_id) OVER () AS fid FROM documents),
e AS (
  SELECT doc_id, coalesce(nid, fid) AS next_id, length(t) AS n, t,
    substring(t, 1, length(t) - length(t) // 4) || substring(nt, 1, length(t) // 4) AS et FROM o),
v AS (SELECT doc_id, 'own' AS version, t FROM e UNION ALL SELECT doc_id, 'edited', et FROM e),
d AS (
  SELECT doc_id, version, list_distinct(list_transform(regexp_extract_all(t, '[^\n]{128,512}?[.!?][ \t]+|[^\n]{1,512}\n*|\n+'),
    lambda p: CAST('0x' || substring(md5(p), 1, 15) AS BIGINT))) AS k FROM v),
c AS (SELECT doc_id, version, k, unnest(range(24)) AS i FROM d),
s AS (
  SELECT doc_id, version, i, list_filter(k, lambda x: ((x >> CAST(8 * (i // 8) AS BIGINT)) & 7) = i % 8) AS m FROM c),
f AS (
  SELECT doc_id, version, string_agg(printf('%08x', len(m)) || printf('%016x', list_reduce(list_prepend(CAST(0 AS BIGINT), m), lambda a, x: xor(a, x)))
    || printf('%08x', list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(m, lambda x: x % 4294967291)), lambda a, x: xor(a, x))), '' ORDER BY i) AS fp
  FROM s GROUP BY doc_id, version)
SELECT e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(e.et) AS edited_sha256, fo.fp AS fingerprint, fe.fp AS edited_fingerprint,
  CASE WHEN len(a.k) + len(b.k) = 0 THEN 1.0 ELSE len(list_intersect(a.k, b.k)) / len(list_distinct(a.k || b.k)) END AS near_edited,
  CASE WHEN len(a.k) + len(x.k) = 0 THEN 1.0 ELSE len(list_intersect(a.k, x.k)) / len(list_distinct(a.k || x.k)) END AS near_next,
  CAST(len(a.k) AS BIGINT) AS n_pieces
FROM e JOIN f fo ON fo.doc_id = e.doc_id AND fo.version = 'own' JOIN f fe ON fe.doc_id = e.doc_id AND fe.version = 'edited'
  JOIN d a ON a.doc_id = e.doc_id AND a.version = 'own' JOIN d b ON b.doc_id = e.doc_id AND b.version = 'edited'
  JOIN d x ON x.doc_id = e.next_id AND x.version = 'own'
"""


@query
def op12_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filters"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT row_number() OVER () AS nth, part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
    len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM d LEFT JOIN l USING (doc_id)),
g AS (
  SELECT nth, part, good, bad, letter, fail, count(*) FILTER (WHERE fail) OVER (PARTITION BY nth) AS fails
  FROM f, LATERAL (VALUES ('A', a), ('B', b), ('C', c), ('D', d), ('E', e)) AS v(letter, fail)),
ls AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM ls p, ls q, ls r, ls s, ls t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
h AS (
  SELECT part, filter_order, instr(filter_order, letter) AS step, letter, nth, good, bad, fail, fails,
    min(CASE WHEN fail THEN instr(filter_order, letter) ELSE 6 END) OVER (PARTITION BY nth, filter_order) AS gone
  FROM g, o),
s AS (
  SELECT part, filter_order, step, letter, count(*) FILTER (WHERE gone > step) AS kept, count(*) FILTER (WHERE gone = step) AS removed,
    count(*) FILTER (WHERE fail AND gone < step) AS redundant, count(*) FILTER (WHERE fail AND fails = 1) AS unique_fails,
    count(*) FILTER (WHERE gone = step AND good = 1) AS good_lost, count(*) FILTER (WHERE gone = step AND bad = 1) AS toxic_lost
  FROM h GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM s
"""


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS nth, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT nth, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT nth) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS n FROM k GROUP BY lang),
full_ AS (SELECT g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0) AS n FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM full_ GROUP BY lang, source),
p AS (
  SELECT f.lang, f.source, f.term, f.n, 1 + (1000000000::HUGEINT * (f.n + 5)) // (s.total + 5 * v.v) AS p, 1 + (1000000000::HUGEINT * (f.lang_n + 5)) // (v.n + 5 * v.v) AS q
  FROM full_ f JOIN s USING (lang, source) JOIN v ON v.lang = f.lang),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, (SELECT coalesce(sum(abs(x.p - y.p)), 0) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""
