"""The reference-side queries over the driver's tables, each beside the SQL that checks it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import address, codec
from tidemark.operators import catalog, hold, logs, matching, pacing, relation, reports, timelines
from tidemark.plans.registry import ORACLES, QUERIES
from tidemark.sources import wirelog


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = "WITH " + COMMON + sql if sql.startswith(",") else sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The wire view, keyframe groups, their rows and their arrivals, for DuckDB.
COMMON = """wire AS (
  SELECT event_type AS track, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS frame_no, event_id % 7 = 0 AS keyframe,
    epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS pts_us, props AS payload, event_id, user_id, value FROM events),
kf AS (SELECT *, CAST(sum(CASE WHEN keyframe OR frame_no = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY track ORDER BY frame_no) - 1 AS BIGINT) AS grp FROM wire),
gr AS (SELECT track, grp, count(*) AS packets, CAST(sum(strlen(payload)) AS BIGINT) AS bytes, min(pts_us) / 1e6 AS pts_start, max(pts_us) / 1e6 AS pts_end FROM kf GROUP BY ALL),
kept AS (SELECT track, grp AS seq FROM gr WHERE grp % 13 <> 0 OR grp = 0),
copies AS (SELECT track, seq, 0 AS copy, seq + (seq * 7) % 16 AS k FROM kept UNION ALL SELECT track, seq, 1, seq + (seq * 7) % 16 + 17 FROM kept WHERE seq % 11 = 0),
arr AS (SELECT track, seq, copy, row_number() OVER (PARTITION BY track ORDER BY k, seq, copy) AS arrival FROM copies)
"""


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.wire(table(spark, sf_dir, "events"))


def keyframe_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.group_rows(logs.wire_by_keyframe(table(spark, sf_dir, "events")))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every branch of what is asked of arrivals reads the one table that is written here.
    return logs.kept(hold.arrivals(keyframe_groups(spark, sf_dir).select("track", "grp")))


@query(", x AS (SELECT 1) SELECT * FROM gr")
def group_rows_keyframe(spark, sf_dir):
    return keyframe_groups(spark, sf_dir)


@query()
def group_rows_elapsed(spark, sf_dir):
    return logs.group_rows(logs.cut_elapsed(wire(spark, sf_dir), 21_600_000_000))


ORACLES["group_rows_elapsed"] = "WITH RECURSIVE " + COMMON + """,
walk AS (
  SELECT track, frame_no, pts_us, pts_us AS start, CAST(0 AS BIGINT) AS grp FROM wire WHERE frame_no = 0
  UNION ALL
  SELECT w.track, w.frame_no, w.pts_us, CASE WHEN w.pts_us - p.start >= 21600000000 THEN w.pts_us ELSE p.start END, p.grp + CASE WHEN w.pts_us - p.start >= 21600000000 THEN 1 ELSE 0 END
  FROM walk p JOIN wire w ON w.track = p.track AND w.frame_no = p.frame_no + 1)
SELECT k.track, k.grp, count(*) AS packets, CAST(sum(strlen(payload)) AS BIGINT) AS bytes, min(k.pts_us) / 1e6 AS pts_start, max(k.pts_us) / 1e6 AS pts_end
FROM walk k JOIN wire w ON w.track = k.track AND w.frame_no = k.frame_no GROUP BY k.track, k.grp"""


@query(", x AS (SELECT track, frame_no // 9 AS grp, pts_us, payload FROM wire) SELECT track, grp, count(*) AS packets, CAST(sum(strlen(payload)) AS BIGINT) AS bytes, min(pts_us) / 1e6 AS pts_start, max(pts_us) / 1e6 AS pts_end FROM x GROUP BY track, grp")
def group_rows_regular(spark, sf_dir):
    return logs.group_rows(logs.cut_regular(wire(spark, sf_dir), logs.interval_ticks(180, 1, 48000), 1024))


@query(", x AS (SELECT 1) SELECT track, frame_no AS grp, count(*) AS packets, CAST(sum(strlen(payload)) AS BIGINT) AS bytes, min(pts_us) / 1e6 AS pts_start, max(pts_us) / 1e6 AS pts_end FROM wire GROUP BY track, frame_no")
def group_rows_fragment(spark, sf_dir):
    return logs.group_rows(logs.cut_fragments(wire(spark, sf_dir)))


# Relations. Broadcasts of renditions come from part: some heights are unknown, as an audio-only row's is.


def renditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select((F.col("p_partkey") % 60).cast("long").alias("broadcast"), F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("name"), F.when(F.col("p_size") % 10 != 0, F.col("p_size") * 36).cast("int").alias("height"), F.col("p_type").alias("codecs"))


REL = "rel AS (SELECT CAST(p_partkey % 60 AS BIGINT) AS broadcast, 'r' || p_partkey AS name, CASE WHEN p_size % 10 <> 0 THEN CAST(p_size * 36 AS INTEGER) END AS height, p_type AS codecs FROM part)"


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    tracks = F.transform(F.slice(F.array(F.lit(1), F.lit(2), F.lit(3)), F.lit(1), (F.col("n_nationkey") % 4).cast("int")), lambda i: F.concat(F.lit("a"), i.cast("string")))
    return n.select(F.col("n_nationkey").cast("long").alias("broadcast"), F.lit(1280).alias("width"), F.when(F.col("n_nationkey") % 2 == 0, 720).otherwise(534).alias("height"), tracks.alias("audio"))


@query("""WITH i AS (SELECT CAST(n_nationkey AS BIGINT) AS broadcast, CASE WHEN n_nationkey % 2 = 0 THEN 720 ELSE 534 END AS h, n_nationkey % 4 AS n FROM nation),
vid AS (SELECT broadcast, rung, w, CAST(2 * round_even(w * h / 1280 / 2, 0) AS INTEGER) AS vh FROM (SELECT *, CAST(split_part('854,640,426', ',', rung) AS INTEGER) AS w FROM (SELECT *, CAST(unnest(generate_series(1, 3)) AS INTEGER) AS rung FROM i))),
aud AS (SELECT broadcast, CAST(3 + k AS INTEGER) AS rung, 'a' || k AS audio_track FROM (SELECT *, unnest(generate_series(1, n)) AS k FROM i WHERE n > 0))
SELECT coalesce(v.broadcast, a.broadcast) AS broadcast, coalesce(v.rung, a.rung) AS rung, w AS video_width, vh AS video_height, audio_track, nullif(split_part('2000k,1000k,400k', ',', coalesce(v.rung, a.rung)), '') AS bitrate
FROM vid v FULL JOIN aud a ON v.broadcast = a.broadcast AND v.rung = a.rung""")
def ladder_full_join(spark, sf_dir):
    return relation.ladder(inputs(spark, sf_dir), 3, "854,640,426", "2000k,1000k,400k")


@query("WITH " + REL + " SELECT * FROM rel QUALIFY row_number() OVER (PARTITION BY broadcast ORDER BY height DESC NULLS LAST, name) = 1")
def widest_rung(spark, sf_dir):
    return relation.widest(renditions(spark, sf_dir))


@query("WITH " + REL + " SELECT v.broadcast, v.name AS video, a.name AS audio FROM rel v JOIN rel a ON v.broadcast = a.broadcast WHERE v.height = 720 - 36 * 5 AND a.height IS NULL")
def rung_by_height(spark, sf_dir):
    return relation.rung_with_sound(renditions(spark, sf_dir), 540)


@query("WITH " + REL + " SELECT broadcast, name, codecs FROM rel WHERE height IS NULL")
def audio_only_rows(spark, sf_dir):
    return renditions(spark, sf_dir).where(F.col("height").isNull()).select("broadcast", "name", "codecs")


@query("SELECT CAST(n_nationkey AS BIGINT) AS broadcast, CAST(i AS INTEGER) AS i, split_part('1920,1280,854,640', ',', i) AS width FROM nation, generate_series(1, 4) t(i)")
def series_cross(spark, sf_dir):
    out = relation.series(inputs(spark, sf_dir).select("broadcast"), 4)
    return out.withColumn("width", relation.listed("1920,1280,854,640", F.col("i")))


@query("SELECT CAST(n_nationkey AS BIGINT) AS broadcast, CAST(k AS INTEGER) AS index, 'a' || k AS track, CAST(3 + k AS INTEGER) AS rung FROM (SELECT n_nationkey, unnest(generate_series(1, n_nationkey % 4)) AS k FROM nation WHERE n_nationkey % 4 > 0)")
def unnest_ordinal(spark, sf_dir):
    return relation.unnested(inputs(spark, sf_dir), "audio", "track", "index").select("broadcast", "index", "track", (F.col("index") + 3).alias("rung"))


@query("SELECT CAST(n_nationkey AS BIGINT) AS broadcast, CASE WHEN n_nationkey % 4 >= 1 THEN 'a1' END AS first, CASE WHEN n_nationkey % 4 >= 3 THEN 'a3' END AS third FROM nation")
def stream_subscript(spark, sf_dir):
    return inputs(spark, sf_dir).select("broadcast", relation.cell("audio").alias("first"), relation.cell("audio", 3).alias("third"))


@query("WITH " + REL + " SELECT broadcast, name, coalesce(height, 0) AS height FROM rel WHERE coalesce(height, 0) >= 1000 AND codecs = 'ECONOMY'")
def parameters(spark, sf_dir):
    """Named parameters of a query, an unset one among them."""
    return spark.sql(
        "SELECT broadcast, name, coalesce(height, :missing, 0) AS height FROM {rel} WHERE coalesce(height, 0) >= :least AND codecs = :codec",
        args={"missing": None, "least": 1000, "codec": "ECONOMY"}, rel=renditions(spark, sf_dir),
    )


# Catalogs: a document for each nation, in the cases that row assignment tells apart.


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("broadcast"))
    k, none = F.col("broadcast"), F.lit(None)
    kind = F.when(k % 2 == 0, "cmaf").otherwise("legacy")
    t = lambda what, name, codec_, packaging, cond: n.where(cond).select(
        "broadcast", F.lit(what).alias("kind"), F.lit(name).alias("name"), F.lit(codec_).alias("codec"), packaging.alias("packaging"),
        F.concat(F.lit(name), F.lit(" ÿ")).cast("binary").alias("config"), F.when(packaging == "cmaf", F.repeat(F.lit(name), 30).cast("binary")).alias("init"),
        (F.lit(1280) if what == "video" else none.cast("int")).alias("width"), (F.lit(720 if name == "hd" else 360) if what == "video" else none.cast("int")).alias("height"),
        (F.lit(48000) if what == "audio" else none.cast("int")).alias("sample_rate"), (F.lit(2) if what == "audio" else none.cast("int")).alias("channels"),
        (F.lit(90000) if what == "data" else none.cast("int")).alias("timescale"),
    )
    parts = [
        t("video", "hd", "avc1.64001f", kind, k >= 0), t("video", "sd", "avc1.42c01e", kind, k >= 0), t("audio", "hd.audio", "mp4a.40.2", F.lit("cmaf"), k % 3 != 1),
        t("audio", "voice", "mp4a.40.2", F.lit("legacy"), k % 3 == 1), t("audio", "commentary", "mp4a.40.5", F.lit("legacy"), k % 3 == 2), t("data", "cues", "json", F.lit("legacy"), k % 4 == 0),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CATALOG = """n AS (SELECT CAST(n_nationkey AS BIGINT) AS b FROM nation),
t AS (
  SELECT b, 0 AS s, 'video' AS kind, 'hd' AS name, 'avc1.64001f' AS codec, CASE WHEN b % 2 = 0 THEN 'cmaf' ELSE 'legacy' END AS packaging, 0 AS "row" FROM n
  UNION ALL SELECT b, 0, 'video', 'sd', 'avc1.42c01e', CASE WHEN b % 2 = 0 THEN 'cmaf' ELSE 'legacy' END, 1 FROM n
  UNION ALL SELECT b, 1, 'audio', 'hd.audio', 'mp4a.40.2', 'cmaf', 0 FROM n WHERE b % 3 <> 1
  UNION ALL SELECT b, 1, 'audio', 'voice', 'mp4a.40.2', 'legacy', CASE WHEN b % 2 = 1 THEN 0 ELSE 2 END FROM n WHERE b % 3 = 1
  UNION ALL SELECT b, 1, 'audio', 'commentary', 'mp4a.40.5', 'legacy', CASE WHEN b % 2 = 1 THEN 0 ELSE 2 END FROM n WHERE b % 3 = 2
  UNION ALL SELECT b, 2, 'data', 'cues', 'json', 'legacy', 0 FROM n WHERE b % 4 = 0),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY b ORDER BY s, name) - 1 AS INTEGER) AS ordinal FROM t)"""


def catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.document(tracks(spark, sf_dir))


def found(documents: DataFrame) -> DataFrame:
    """The renditions of catalog documents, written once: sections and rows are made from several reads of them."""
    return logs.kept(catalog.renditions(logs.kept(documents)))


@query("WITH " + CATALOG + r""",
e AS (SELECT b, kind, name, '"' || name || '":{"codec":"' || codec || '","container":{"kind":"' || packaging || '"' ||
    CASE WHEN packaging = 'cmaf' THEN ',"init":"' || base64(encode(repeat(name, 30))) || '"' ELSE '' END || '},"description":"' || lower(hex(encode(name || ' ÿ'))) || '"' ||
    CASE kind WHEN 'video' THEN ',"codedWidth":1280,"codedHeight":' || CASE name WHEN 'hd' THEN '720' ELSE '360' END WHEN 'audio' THEN ',"sampleRate":48000,"numberOfChannels":2,"jitter":600' ELSE ',"timescale":90000' END || '}' AS j FROM t)
SELECT b AS broadcast, '{"video":{"renditions":{' || string_agg(j, ',' ORDER BY name) FILTER (kind = 'video') || '}},"audio":{"renditions":{' || coalesce(string_agg(j, ',' ORDER BY name) FILTER (kind = 'audio'), '') || '}}' ||
  CASE WHEN count(*) FILTER (kind = 'data') > 0 THEN ',"data":{"renditions":{' || string_agg(j, ',' ORDER BY name) FILTER (kind = 'data') || '}}' ELSE '' END || '}' AS document FROM e GROUP BY b""")
def catalog_document(spark, sf_dir):
    return catalogs(spark, sf_dir)


@query("WITH " + CATALOG + ' SELECT b AS broadcast, ordinal, kind, name, "row" FROM o')
def catalog_rows(spark, sf_dir):
    return catalog.assigned(found(catalogs(spark, sf_dir))).select("broadcast", "ordinal", "kind", "name", F.col("row").cast("int").alias("row"))


@query("WITH " + CATALOG + """ SELECT b AS broadcast, "row", min_by(name, ordinal) AS name, string_agg(codec, ',' ORDER BY ordinal) FILTER (kind <> 'data') AS codecs,
  max(CASE WHEN kind = 'video' THEN CASE name WHEN 'hd' THEN 720 ELSE 360 END END) AS height, coalesce(string_agg(name, ',' ORDER BY ordinal) FILTER (kind = 'audio'), '') AS audio,
  coalesce(string_agg(name, ',' ORDER BY ordinal) FILTER (kind = 'data'), '') AS data, CAST(NULL AS BIGINT) AS bandwidth FROM o GROUP BY b, "row" """)
def catalog_relation(spark, sf_dir):
    rel = catalog.relation(catalog.assigned(found(catalogs(spark, sf_dir))))
    return rel.select("broadcast", F.col("row").cast("int").alias("row"), "name", "codecs", "height", F.array_join("audio", ",").alias("audio"), F.array_join("data", ",").alias("data"), "bandwidth")


#: Documents, all but the last of which a reader refuses.
BROKEN = {
    1: '{"video":{"renditions":{"v":{"codec":"avc1.42c01e","container":{"kind":"cmaf","init":"AA=="}}}}}',
    2: '{"audio":{"renditions":{"a":{"codec":"opus"}}},"clock":{}}',
    3: '{"video":{"renditions":{"v":{"codec":"avc1.42c01e","container":{"kind":"loc"}}}}}',
    4: '{"data":{"renditions":{"d":{"codec":"json","container":{"kind":"legacy"},"timescale":0},"e":{"codec":"json","container":{"kind":"legacy"},"timescale":90000}}}}',
    5: '{"data":{"renditions":{"d":{"codec":"json","container":{"kind":"cmaf"},"timescale":1}}}}',
    6: '{"video":{"renditions":{"v":{"codec":"avc1.42c01e","description":"00","container":{"kind":"cmaf"}}}}}',
    7: '{"video":{"renditions":{"v":{"codec":"avc3","container":{"kind":"legacy"}}}}}',
}


@query("SELECT CAST(p_partkey AS BIGINT) AS broadcast, name, problem FROM part JOIN (VALUES (1, 'v', 'no description'), (2, 'a', 'no container'), (3, 'v', 'container not taken'), (4, 'd', 'timescale'), (5, 'd', 'data is legacy'), (6, 'v', 'no init')) t(k, name, problem) ON p_partkey % 8 = k")
def catalog_refusals(spark, sf_dir):
    docs = F.create_map(*[x for k, d in BROKEN.items() for x in (F.lit(k), F.lit(d))])
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("broadcast"), docs[(F.col("p_partkey") % 8).cast("int")].alias("document"))
    return catalog.problems(catalog.renditions(rows.where("document is not null")))


def pads(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 300).cast("long").alias("broadcast"), F.col("p_partkey").cast("long").alias("ordinal"), (F.col("p_size") % 3).cast("int").alias("row"),
        F.element_at(F.array(F.lit("video"), F.lit("audio"), F.lit("data")), (F.col("p_size") % 7 % 3 + 1).cast("int")).alias("kind"),
        F.when(F.col("p_size") % 2 == 0, 720).otherwise(360).alias("height"), F.when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("n"), F.col("p_partkey").cast("string"))).alias("name"),
    )
    return p


PADS = "p AS (SELECT CAST(p_partkey % 300 AS BIGINT) AS b, CAST(p_partkey AS BIGINT) AS ordinal, p_size % 3 AS r, ['video', 'audio', 'data'][p_size % 7 % 3 + 1] AS kind, CASE WHEN p_size % 2 = 0 THEN 720 ELSE 360 END AS height, CASE WHEN p_partkey % 4 = 1 THEN 'n' || p_partkey END AS name FROM part)"


@query("WITH " + PADS + """, w AS (SELECT *, count(*) OVER k AS n, row_number() OVER (PARTITION BY b, kind, name IS NULL ORDER BY ordinal) AS i, count(*) OVER (PARTITION BY b, kind, name IS NULL, height) AS same,
  bool_or(kind = 'video') OVER (PARTITION BY b, r) AS beside FROM p WINDOW k AS (PARTITION BY b, kind, name IS NULL))
SELECT b AS broadcast, ordinal, CASE WHEN name IS NOT NULL THEN name || CASE WHEN kind = 'audio' AND beside THEN '.audio' ELSE '' END
  WHEN kind = 'video' THEN CASE WHEN n = 1 THEN 'video' WHEN same > 1 THEN 'video.' || height || 'p.' || (i - 1) ELSE 'video.' || height || 'p' END
  ELSE kind || CASE WHEN i = 1 THEN '' ELSE '.' || (i - 1) END END AS track FROM w""")
def track_names(spark, sf_dir):
    return catalog.track_names(pads(spark, sf_dir)).select("broadcast", "ordinal", "track")


SPOKEN = """, w AS (SELECT track, CAST(event_id % 3 AS INTEGER) AS epoch, frame_no, keyframe AND track <> 'search' AS keyframe, payload, CASE track WHEN 'view' THEN 'audio' WHEN 'search' THEN 'data' ELSE 'video' END AS kind, event_id FROM wire)"""


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of all kinds in epochs; one track of data has no keyframe at all."""
    kind = F.when(F.col("track") == "view", "audio").when(F.col("track") == "search", "data").otherwise("video")
    return wire(spark, sf_dir).withColumns({"epoch": (F.col("event_id") % 3).cast("int"), "kind": kind, "keyframe": F.col("keyframe") & (F.col("track") != "search")})


@query(SPOKEN + ", f AS (SELECT track, epoch, min(frame_no) AS f FROM w WHERE keyframe OR kind <> 'video' GROUP BY ALL) SELECT w.track, w.epoch, w.frame_no, w.event_id FROM w JOIN f USING (track, epoch) WHERE w.frame_no >= f")
def join_gate_kinds(spark, sf_dir):
    return logs.join_gate(spoken(spark, sf_dir)).select("track", "epoch", "frame_no", "event_id")


@query(SPOKEN + " SELECT track, frame_no // 8 AS grp, bool_or(kind <> 'video') OR coalesce(arg_min(keyframe, frame_no) FILTER (strlen(payload) > 0), false) AS decodable FROM w GROUP BY ALL")
def decisive_frame_kinds(spark, sf_dir):
    return logs.decisive(spoken(spark, sf_dir).withColumn("grp", F.expr("frame_no div 8")))


@query("WITH RECURSIVE p AS (SELECT CAST(p_partkey // 8 AS BIGINT) AS b, CAST(p_partkey % 8 AS INTEGER) AS o, CASE p_partkey * 7 % 5 WHEN 0 THEN 'a' WHEN 1 THEN 'a-' || (p_partkey % 3) WHEN 2 THEN 'a b' WHEN 3 THEN '' ELSE 'a_b-1' END AS n FROM part), q AS (SELECT b, o, regexp_replace(n, '[^A-Za-z0-9_-]', '_', 'g') AS s, row_number() OVER (PARTITION BY b ORDER BY o) AS i FROM p), r AS (SELECT b, o, i, CASE WHEN s = '' THEN '-' || o ELSE s END AS port, [CASE WHEN s = '' THEN '-' || o ELSE s END] AS used FROM q WHERE i = 1 UNION ALL SELECT q.b, q.o, q.i, CASE WHEN s = '' OR list_contains(used, s) THEN s || '-' || q.o ELSE s END, list_append(used, CASE WHEN s = '' OR list_contains(used, s) THEN s || '-' || q.o ELSE s END) FROM r JOIN q ON q.b = r.b AND q.i = r.i + 1) SELECT b AS broadcast, o AS ordinal, port FROM r")
def port_names_clashing(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.when(k * 7 % 5 == 0, "a").when(k * 7 % 5 == 1, F.concat(F.lit("a-"), (k % 3).cast("string"))).when(k * 7 % 5 == 2, "a b").when(k * 7 % 5 == 3, "").otherwise("a_b-1")
    rows = table(spark, sf_dir, "part").select(F.expr("p_partkey div 8").cast("long").alias("broadcast"), (k % 8).cast("int").alias("ordinal"), name.alias("name"))
    return catalog.ports(rows).select("broadcast", "ordinal", "port")


@query("WITH p AS (SELECT CAST(p_partkey % 50 AS BIGINT) AS b, CAST(p_partkey AS INTEGER) AS ordinal, regexp_replace(p_name, '[^A-Za-z0-9_-]', '_', 'g') AS s FROM part) SELECT b AS broadcast, ordinal, CASE WHEN s = '' OR row_number() OVER (PARTITION BY b, s ORDER BY ordinal) > 1 THEN s || '-' || ordinal ELSE s END AS port FROM p")
def port_names(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).cast("long").alias("broadcast"), F.col("p_partkey").cast("int").alias("ordinal"), F.col("p_name").alias("name"))
    return catalog.ports(rows).select("broadcast", "ordinal", "port")


@query("WITH " + CATALOG + """, c AS (SELECT b, name, CASE WHEN b % 5 = 0 AND name = 'sd' THEN 'missing' WHEN b % 5 = 1 AND name = 'hd' THEN 'codec' WHEN b % 5 = 2 AND name = 'cues' THEN 'timescale' END AS reason FROM t) SELECT b AS broadcast, name, reason FROM c WHERE reason IS NOT NULL""")
def catalog_drift(spark, sf_dir):
    old = found(catalogs(spark, sf_dir))
    k = F.col("broadcast") % 5
    new = tracks(spark, sf_dir).where((k != 0) | (F.col("name") != "sd")).withColumn("codec", F.when((k == 1) & (F.col("name") == "hd"), "avc1.640028").otherwise(F.col("codec")))
    new = new.withColumn("timescale", F.when((k == 2) & (F.col("name") == "cues"), 48000).otherwise(F.col("timescale")))
    return catalog.drift(old, found(catalog.document(new)))


# Holds.


@query(", x AS (SELECT *, coalesce(seq <= max(seq) OVER (PARTITION BY track ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM arr) SELECT track, arrival, seq, late FROM x")
def hold_zero_patience(spark, sf_dir):
    return hold.zero_patience(arrivals(spark, sf_dir)).select("track", "arrival", "seq", "late")


@query(", d AS (SELECT track, seq, max(seq) OVER (PARTITION BY track ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM arr) SELECT track, top + 1 AS from_seq, seq - 1 AS to_seq FROM d WHERE seq > top + 1")
def hold_abandoned_holes(spark, sf_dir):
    return hold.abandoned_holes(arrivals(spark, sf_dir))


@query(", d AS (SELECT track, seq, lead(seq) OVER (PARTITION BY track ORDER BY seq) AS nxt FROM (SELECT DISTINCT track, seq FROM arr)) SELECT track, seq + 1 AS from_seq, nxt - 1 AS to_seq, 'end' AS reason FROM d WHERE nxt - seq > 1")
def hold_patient_holes(spark, sf_dir):
    return hold.patient_holes(arrivals(spark, sf_dir))


@query(""", d AS (SELECT DISTINCT track, seq FROM arr), h AS (SELECT track, count(*) AS holes FROM (SELECT track, lead(seq) OVER (PARTITION BY track ORDER BY seq) - seq AS step FROM d) WHERE step > 1 GROUP BY track)
SELECT track, count(*) AS received, count(DISTINCT seq) AS delivered, count(*) - count(DISTINCT seq) AS repeated, CAST(0 AS BIGINT) AS dropped_late, coalesce(any_value(holes), 0) AS holes_abandoned_end,
  count(DISTINCT seq) AS hold_max_groups, max(seq) - min(seq) AS reorder_max, min(seq) AS first, max(seq) AS last FROM arr LEFT JOIN h USING (track) GROUP BY track""")
def hold_counters(spark, sf_dir):
    return hold.patient_counters(arrivals(spark, sf_dir))


@query(""", j AS (SELECT track, min(arrival) AS att FROM arr WHERE seq % 5 = 3 GROUP BY track), c AS (SELECT track, att, seq AS c FROM j JOIN arr USING (track) WHERE arrival = att),
f AS (SELECT track, seq, min(arrival) AS first FROM arr GROUP BY ALL),
g AS (SELECT f.*, c.c, c.att, seq - c.c - (row_number() OVER w - 1) AS missing, max(greatest(first, att)) OVER w AS done FROM f JOIN c USING (track) WHERE seq >= c.c WINDOW w AS (PARTITION BY track ORDER BY seq))
SELECT a.track, a.arrival, a.seq, c.c AS joined_at, CASE WHEN a.seq < c.c THEN CASE WHEN a.arrival > c.att THEN 'late' ELSE 'skipped' END WHEN a.arrival = g.first THEN 'delivered' WHEN g.missing = 0 AND a.arrival > g.done THEN 'late' ELSE 'repeated' END AS fate
FROM arr a JOIN c USING (track) LEFT JOIN g ON g.track = a.track AND g.seq = a.seq""")
def live_join(spark, sf_dir):
    return hold.live_join(arrivals(spark, sf_dir).withColumn("decodable", F.col("seq") % 5 == 3))


@query(", x AS (SELECT 1) SELECT track, seq, min(arrival) AS arrival FROM arr GROUP BY track, seq")
def dedupe_first_copy(spark, sf_dir):
    return hold.first_copies(arrivals(spark, sf_dir))


@query(", d AS (SELECT *, max(seq) OVER (PARTITION BY track ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS cursor FROM arr) SELECT track, seq AS grp, cursor, arrival FROM d WHERE seq < cursor QUALIFY row_number() OVER (PARTITION BY track ORDER BY arrival) <= 256")
def late_rows(spark, sf_dir):
    return hold.late_rows(arrivals(spark, sf_dir))


@query(", d AS (SELECT track, seq, coalesce(seq <= max(seq) OVER (PARTITION BY track ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM arr), l AS (SELECT track, count(DISTINCT seq) AS n FROM d WHERE NOT late GROUP BY track) SELECT track, count(*) AS received, any_value(n) AS delivered, count(*) FILTER (late) AS dropped_late, max(seq) - (min(seq) FILTER (NOT late)) + 1 - any_value(n) AS passed_over, count(*) = any_value(n) + count(*) FILTER (late) AS balanced FROM d JOIN l USING (track) GROUP BY track")
def conservation(spark, sf_dir):
    return hold.conservation(arrivals(spark, sf_dir))


@query(""", h AS (SELECT track, seq + 1 AS seq FROM (SELECT track, seq, lead(seq) OVER (PARTITION BY track ORDER BY seq) AS nxt FROM (SELECT DISTINCT track, seq FROM arr)) WHERE nxt - seq > 1),
a AS (SELECT * FROM h UNION ALL SELECT track, max(grp) + 5 FROM gr GROUP BY track) SELECT a.track, a.seq, packets, CASE WHEN packets IS NULL THEN 'gone' ELSE 'group' END AS answer FROM a LEFT JOIN gr ON gr.track = a.track AND gr.grp = a.seq""")
def fetch_lookup(spark, sf_dir):
    groups = logs.kept(keyframe_groups(spark, sf_dir))
    asks = hold.patient_holes(logs.kept(hold.arrivals(groups))).select("track", F.col("from_seq").alias("seq"))
    return hold.fetch_lookup(asks.unionByName(groups.groupBy("track").agg((F.max("grp") + 5).alias("seq"))), groups)


@query(", x AS (SELECT 1) SELECT track, grp, arg_min(keyframe, frame_no) FILTER (strlen(payload) > 0) AS decodable FROM kf GROUP BY track, grp")
def decisive_frame(spark, sf_dir):
    return logs.decisive(logs.wire_by_keyframe(table(spark, sf_dir, "events")))


# Frames and messages.


@query(""", v AS (SELECT event_id, unnest([pts_us % 64, pts_us % 16384, pts_us % 1073741824, pts_us]) AS v, payload FROM wire)
SELECT event_id, v AS pts, CASE WHEN v < 64 THEN lpad(to_hex(v), 2, '0') WHEN v < 16384 THEN lpad(to_hex(v + 16384), 4, '0') WHEN v < 1073741824 THEN lpad(to_hex(v + 2147483648), 8, '0')
  ELSE lpad(to_hex(CAST(v AS UBIGINT) + 13835058055282163712::UBIGINT), 16, '0') END || hex(encode(payload)) AS frame, v AS back, payload AS body FROM v""")
def varint_roundtrip(spark, sf_dir):
    p = F.col("pts_us")
    rows = wire(spark, sf_dir).select("event_id", F.explode(F.array(p % 64, p % 16384, p % (1 << 30), p)).alias("pts"), "payload")
    framed = rows.select("event_id", "pts", codec.frame(F.col("pts"), F.col("payload").cast("binary")).alias("f"))
    return framed.select("event_id", "pts", F.hex("f").alias("frame"), codec.frame_pts(F.col("f")).alias("back"), codec.frame_body(F.col("f")).cast("string").alias("body"))


SHAKEN = ", s AS (SELECT track, frame_no, event_id, pts_us - (event_id % 5) * 500000000 AS pts_us FROM wire)"


def shaken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wire with pts that go back at times."""
    return wire(spark, sf_dir).withColumn("pts_us", F.col("pts_us") - F.col("event_id") % 5 * 500_000_000)


@query(SHAKEN + " SELECT track, frame_no, pts_us, max(pts_us) OVER (PARTITION BY track ORDER BY frame_no) AS pts_out FROM s")
def monotone_clamp(spark, sf_dir):
    return logs.monotone(shaken(spark, sf_dir)).select("track", "frame_no", "pts_us", "pts_out")


@query(SHAKEN + " SELECT track, frame_no, pts_us, b AS before FROM (SELECT *, lag(pts_us) OVER (PARTITION BY track ORDER BY frame_no) AS b FROM s) WHERE pts_us <= b")
def reorder_refusal(spark, sf_dir):
    return logs.reordered(shaken(spark, sf_dir)).select("track", "frame_no", "pts_us", "before")


@query(", x AS (SELECT track, min(frame_no) AS f FROM wire WHERE keyframe GROUP BY track) SELECT wire.track, frame_no, event_id FROM wire JOIN x USING (track) WHERE frame_no >= f")
def join_gate(spark, sf_dir):
    return logs.join_gate(wire(spark, sf_dir)).select("track", "frame_no", "event_id")


CONFIG = """c AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 95 >= 31 THEN p_partkey % 95 + 1 ELSE p_partkey % 95 END AS t FROM part),
x AS (SELECT p_partkey, t, CASE WHEN p_size % 9 = 0 THEN '' WHEN t < 31 THEN printf('%02X%02X', t * 8 + p_size % 8, p_partkey % 256) ELSE printf('%02X%02X', 248 + (t - 32) // 8, (t - 32) % 8 * 32 + p_size % 32) END AS config FROM c)"""


def hexed(*numbers: str) -> str:
    """Numbers under 256 as hex digits, two each; SQL text."""
    return " || ".join(f"lpad(hex({n}), 2, '0')" for n in numbers)


@query(f"WITH {CONFIG} SELECT CAST(p_partkey AS BIGINT) AS p_partkey, config, CASE WHEN config = '' THEN 'mp4a.40' ELSE 'mp4a.40.' || t END AS codec FROM x")
def aac_codec(spark, sf_dir):
    parts = table(spark, sf_dir, "part").selectExpr("cast(p_partkey as bigint) p_partkey", "p_size", "if(p_partkey % 95 >= 31, p_partkey % 95 + 1, p_partkey % 95) t")
    short, long = hexed("t * 8 + p_size % 8", "p_partkey % 256"), hexed("248 + (t - 32) div 8", "(t - 32) % 8 * 32 + p_size % 32")
    rows = parts.withColumn("config", F.expr(f"case when p_size % 9 = 0 then '' when t < 31 then {short} else {long} end"))
    return rows.select("p_partkey", "config", codec.aac_codec(codec.from_hex(F.col("config"))).alias("codec"))


NAMES = """n AS (SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_size, p_partkey % 256 AS a, p_size % 256 AS b, p_partkey * 7 % 256 AS c, p_size % 6 AS k FROM part)"""


@query(f"""WITH {NAMES} SELECT p_partkey, CASE k WHEN 0 THEN 'avc1.' || printf('%02X%02X%02X', a, b, c) WHEN 1 THEN 'avc3.' || printf('%02x%02x%02x', a, b, c) WHEN 2 THEN 'hev1.1.6.L' || p_size WHEN 3 THEN 'hvc1'
  WHEN 4 THEN 'av01.0.04M.08' ELSE 'mp4a.40.' || p_size END AS name, ['h264', 'h264', 'hevc', 'hevc', 'av1', 'aac'][k + 1] AS codec, CAST(CASE WHEN k < 2 THEN a END AS INTEGER) AS profile, CAST(CASE WHEN k < 2 THEN c END AS INTEGER) AS level FROM n""")
def codec_names(spark, sf_dir):
    six = hexed("p_partkey % 256", "p_size % 256", "p_partkey * 7 % 256")
    named = f"case p_size % 6 when 0 then 'avc1.' || {six} when 1 then 'avc3.' || lower({six}) when 2 then 'hev1.1.6.L' || p_size when 3 then 'hvc1' when 4 then 'av01.0.04M.08' else 'mp4a.40.' || p_size end"
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("p_partkey"), F.expr(named).alias("name"))
    pl = codec.avc_profile_level(F.col("name"))
    return rows.select("p_partkey", "name", codec.codec_of(F.col("name")).alias("codec"), pl["profile"].alias("profile"), pl["level"].alias("level"))


@query(", x AS (SELECT DISTINCT event_id FROM wire) SELECT event_id, lower(hex(encode(payload))) AS hex, base64(encode(payload)) AS base64, rtrim(translate(base64(encode(payload)), '+/', '-_'), '=') AS base64url, payload AS back FROM wire")
def byte_codecs(spark, sf_dir):
    raw = F.col("payload").cast("binary")
    rows = wire(spark, sf_dir).select("event_id", codec.to_hex(raw).alias("hex"), codec.to_base64(raw).alias("base64"), codec.to_base64url(raw).alias("base64url"))
    return rows.withColumn("back", F.when(codec.from_hex(F.col("hex")) == codec.from_base64(F.rtrim(F.col("base64"), F.lit("="))), codec.from_hex(F.col("hex")).cast("string")))


# Pacing and totals.

CUT = ", c AS (SELECT track, frame_no AS grp, pts_us // 50000000 AS cut FROM wire), l AS (SELECT *, lead(cut, 8) OVER (PARTITION BY track ORDER BY grp) AS deep FROM c)"
WALK = CUT + """, r AS (
  SELECT track, grp, cut, cut AS rel, false AS unpaced FROM l WHERE grp = 0
  UNION ALL
  SELECT l.track, l.grp, l.cut, greatest(l.cut, least(r.rel + 40, coalesce(l.deep, r.rel + 40))), greatest(l.cut, least(r.rel + 40, coalesce(l.deep, r.rel + 40))) < r.rel + 40
  FROM r JOIN l ON l.track = r.track AND l.grp = r.grp + 1)"""


def paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = logs.cut_fragments(wire(spark, sf_dir)).select("track", "grp", F.expr("pts_us div 50000000").alias("cut_ms"))
    return pacing.release(groups, rtt=40)


@query()
def pacer_release(spark, sf_dir):
    return paced(spark, sf_dir)


ORACLES["pacer_release"] = "WITH RECURSIVE " + COMMON + WALK + " SELECT track, grp, cut AS cut_ms, rel AS release_ms, rel - cut AS wait_ms, unpaced FROM r"


@query()
def pacer_summary(spark, sf_dir):
    return pacing.summary(paced(spark, sf_dir))


ORACLES["pacer_summary"] = "WITH RECURSIVE " + COMMON + WALK + " SELECT track, count(*) AS groups, max(rel - cut) AS wait_max_ms, CAST(sum(rel - cut) AS BIGINT) AS wait_ms, count(*) FILTER (unpaced) AS unpaced FROM r GROUP BY track"


@query(", x AS (SELECT 1) SELECT track, grp, count(*) OVER w AS groups, CAST(sum(packets) OVER w AS BIGINT) AS packets, CAST(sum(bytes) OVER w AS BIGINT) AS bytes, max(pts_end) OVER w AS media FROM gr WINDOW w AS (PARTITION BY track ORDER BY grp)")
def track_totals(spark, sf_dir):
    return logs.track_totals(keyframe_groups(spark, sf_dir))


@query(", x AS (SELECT 1) SELECT count(DISTINCT track) AS tracks, count(*) AS groups, CAST(sum(packets) AS BIGINT) AS packets, CAST(sum(bytes) AS BIGINT) AS bytes, max(pts_end) AS media FROM gr")
def trailing_total(spark, sf_dir):
    return logs.trailing_row(keyframe_groups(spark, sf_dir))


# Reports.

#: Paced groups with what they hold, in windows of 5000 ms, for DuckDB.
TOLD = WALK + """,
g AS (SELECT r.track, r.grp, r.cut, r.rel, r.rel - r.cut AS wait, r.unpaced, strlen(w.payload) AS bytes, w.pts_us / 1e6 AS pts_end FROM r JOIN wire w ON w.track = r.track AND w.frame_no = r.grp),
c1 AS (SELECT track, cut // 5000 AS w, count(*) AS n, sum(bytes) AS b, max(pts_end) AS e FROM g GROUP BY ALL), c2 AS (SELECT track, rel // 5000 AS w, count(*) AS gone, max(wait) AS wait, count(*) FILTER (unpaced) AS u FROM g GROUP BY ALL),
s AS (SELECT track, cut AS ms, 1 AS step FROM g WHERE wait > 0 UNION ALL SELECT track, rel, -1 FROM g WHERE wait > 0), d AS (SELECT track, ms, step, sum(step) OVER (PARTITION BY track ORDER BY ms, step RANGE UNBOUNDED PRECEDING) AS depth FROM s),
d1 AS (SELECT track, ms // 5000 AS w, max(depth) AS top, arg_max(depth, 2 * ms + step) AS now FROM d GROUP BY ALL),
j AS (SELECT track, w, n, b, e, gone, wait, u, top, now FROM c1 FULL JOIN c2 USING (track, w) LEFT JOIN d1 USING (track, w)),
rows AS (SELECT track, w AS "window", CAST(coalesce(sum(n) OVER o, 0) AS BIGINT) AS groups, CAST(coalesce(sum(n) OVER o, 0) AS BIGINT) AS packets, CAST(coalesce(sum(b) OVER o, 0) AS BIGINT) AS bytes, max(e) OVER o AS media, CAST(coalesce(sum(gone) OVER o, 0) AS BIGINT) AS appended,
  CAST(greatest(coalesce(top, 0), coalesce(last_value(now IGNORE NULLS) OVER (PARTITION BY track ORDER BY w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS BIGINT) AS queue_max, coalesce(wait, 0) AS wait_max_ms, coalesce(u, 0) AS unpaced
  FROM j WINDOW o AS (PARTITION BY track ORDER BY w))"""


def told(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = logs.kept(wire(spark, sf_dir))
    groups = logs.group_rows(logs.cut_fragments(frames))
    cut = frames.select("track", F.col("frame_no").alias("grp"), F.expr("pts_us div 50000000").alias("cut_ms"))
    return reports.publisher_rows(logs.kept(pacing.release(cut, rtt=40)), groups)


@query()
def publisher_windows(spark, sf_dir):
    return told(spark, sf_dir)


ORACLES["publisher_windows"] = "WITH RECURSIVE " + COMMON + TOLD + """ SELECT track, "window", groups, packets, bytes, media, appended, appended AS closed, groups - appended AS queued, queue_max, wait_max_ms, unpaced FROM rows"""


@query()
def publisher_trailing(spark, sf_dir):
    rows = logs.kept(told(spark, sf_dir))
    return reports.trailing(rows, rows.select("track").distinct().select("track", F.encode(F.repeat("track", 3), "UTF-8").alias("init")))


ORACLES["publisher_trailing"] = "WITH RECURSIVE " + COMMON + TOLD + """, p AS (SELECT track, max(groups) AS g, max(packets) AS p, max(bytes) AS b, max(queue_max) AS q, max(wait_max_ms) AS w, sum(unpaced) AS u FROM rows GROUP BY track)
SELECT count(*) AS tracks, CAST(sum(g) AS BIGINT) AS groups, CAST(sum(p) AS BIGINT) AS packets, CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(3 * strlen(track)) AS BIGINT) AS init_bytes, max(q) AS queue_max, max(w) AS wait_max_ms, CAST(sum(u) AS BIGINT) AS unpaced FROM p"""


@query(""", x AS (SELECT 1) SELECT '{"track":"' || track || '","grp":' || grp || ',"packets":' || packets || ',"bytes":' || bytes || '}' AS line FROM gr""")
def report_lines(spark, sf_dir):
    return reports.lines(keyframe_groups(spark, sf_dir).select("track", "grp", "packets", "bytes"))


@query(", j AS (SELECT track, arg_min(seq, arrival) AS f FROM arr WHERE seq % 5 = 3 GROUP BY track) SELECT j.track, f AS first, pts_start AS media, pts_start IS NOT NULL AS written FROM j LEFT JOIN gr ON gr.track = j.track AND gr.grp = f")
def join_media_time(spark, sf_dir):
    groups = logs.kept(keyframe_groups(spark, sf_dir))
    fates = hold.live_join(logs.kept(hold.arrivals(groups)).withColumn("decodable", F.col("seq") % 5 == 3))
    firsts = fates.where("fate = 'delivered'").groupBy("track").agg(F.min("seq").alias("first"))
    return reports.joined_at(firsts, groups)


@query(", k AS (SELECT track, grp, bool_or(s = 1) AS a, bool_or(s = 2) AS b FROM (SELECT track, grp, 1 AS s FROM gr UNION ALL SELECT track, seq, 2 FROM arr UNION ALL SELECT track, -1, 2 FROM gr WHERE track = 'view') GROUP BY track, grp) SELECT track, count(*) FILTER (a AND NOT b) AS only_left, count(*) FILTER (b AND NOT a) AS only_right, count(*) FILTER (a <> b) = 0 AS equal FROM k GROUP BY track")
def key_sets(spark, sf_dir):
    """Groups published and groups that arrived; one track got a group that nobody wrote."""
    groups = logs.kept(keyframe_groups(spark, sf_dir))
    odd = groups.where("track = 'view'").select("track", F.lit(-1).cast("long").alias("grp"))
    came = hold.arrivals(groups).select("track", F.col("seq").alias("grp")).unionByName(odd)
    return reports.compared(groups, came, "track", "grp")


@query(SPOKEN + " SELECT event_id // 50 AS call, track, frame_no, row_number() OVER (PARTITION BY event_id // 50 ORDER BY kind <> 'data', track, frame_no) - 1 AS place FROM w")
def messages_first(spark, sf_dir):
    rows = spoken(spark, sf_dir).withColumn("call", F.expr("event_id div 50"))
    return reports.messages_first(rows, "call").select("call", "track", "frame_no", "place")


@query("""SELECT conv_id, turn, role AS kind, CASE WHEN turn % 3 <> 0 THEN turn / 4 END AS start_pts FROM conversations UNION ALL SELECT conv_id, -1 - turn, NULL, NULL FROM conversations""")
def message_fields(spark, sf_dir):
    """Fields of messages, and of bodies that are no JSON."""
    c = table(spark, sf_dir, "conversations")
    body = F.to_json(F.struct(F.col("role").alias("kind"), F.when(F.col("turn") % 3 != 0, F.col("turn") / 4).alias("start_pts"), "text"))
    rows = c.select("conv_id", "turn", body.cast("binary").alias("body")).unionByName(c.select("conv_id", (-1 - F.col("turn")).alias("turn"), F.concat(F.lit("not json "), "role").cast("binary").alias("body")))
    return rows.select("conv_id", "turn", codec.message_kind(F.col("body")).alias("kind"), codec.message_start(F.col("body")).alias("start_pts"))


@query("""WITH t AS (SELECT CAST(n_nationkey AS BIGINT) AS b, unnest(generate_series(0, n_nationkey % 4)) AS k FROM nation), a AS (SELECT *, (b + k) % 3 <> 0 OR b % 2 = 0 AS done, b % 5 = 0 AND k = 1 AS open FROM t)
SELECT b AS broadcast, count(*) FILTER (NOT done) AS unfinished, count(*) FILTER (open) AS outstanding, bool_and(done AND NOT open) AS over FROM a GROUP BY b""")
def run_end(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("broadcast"))
    rows = n.withColumn("k", F.explode(F.sequence(F.lit(0), (F.col("broadcast") % 4).cast("int")))).withColumn("track", F.concat(F.lit("t"), F.col("k").cast("string")))
    asks = rows.select("broadcast", "track", F.lit(7).cast("long").alias("seq"), "k")
    answers = asks.where("broadcast % 5 <> 0 or k <> 1").select("broadcast", "track", "seq")
    return reports.run_over(rows.select("broadcast", "track"), rows.where("(broadcast + k) % 3 <> 0 or broadcast % 2 = 0"), asks.select("broadcast", "track", "seq"), answers)


@query("""SELECT CAST(p_partkey AS BIGINT) AS p_partkey, ['h264', 'hevc', 'av1', 'aac', 'opus'][p_partkey % 5 + 1] AS codec,
  CASE p_partkey % 5 WHEN 0 THEN p_size % 32 = 5 OR p_partkey // 5 % 32 = 5 WHEN 1 THEN p_size % 64 BETWEEN 16 AND 23 OR p_partkey // 5 % 64 BETWEEN 16 AND 23 WHEN 2 THEN p_size % 8 = 0 AND p_partkey % 3 <> 0 WHEN 3 THEN true END AS keyframe FROM part""")
def keyframe_samples(spark, sf_dir):
    """Samples of two units each, of types that the part's numbers tell; every third AV1 sample breaks off."""
    h264 = f"'00000001' || {hexed('96 + p_size % 32')} || 'AA000001' || {hexed('p_partkey div 5 % 32')} || '80'"
    hevc = f"'00000001' || {hexed('p_size % 64 * 2')} || '01AA000001' || {hexed('p_partkey div 5 % 64 * 2')} || '01'"
    av1 = f"'1200' || {hexed('(1 + p_size % 8) * 8 + 2')} || if(p_partkey % 3 = 0, '03', '02') || 'AABB'"
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("p_partkey"), F.expr("element_at(array('h264', 'hevc', 'av1', 'aac', 'opus'), cast(p_partkey % 5 as int) + 1)").alias("codec"),
        F.unhex(F.expr(f"case p_partkey % 5 when 0 then {h264} when 1 then {hevc} when 2 then {av1} else '21' end")).alias("sample"),
    )
    return rows.select("p_partkey", "codec", codec.keyframe(F.col("codec"), F.col("sample")).alias("keyframe"))


# Timelines.


@query(", s AS (SELECT track, grp, min(pts_us) AS a, max(pts_us) AS b FROM kf GROUP BY ALL), p AS (SELECT track, pts_us FROM kf WHERE grp % 13 <> 0) SELECT track, grp, a AS start, b AS \"end\" FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.track = s.track AND p.pts_us BETWEEN s.a - 2000 AND s.b + 2000)")
def range_anti_missing(spark, sf_dir):
    cut = logs.kept(logs.wire_by_keyframe(table(spark, sf_dir, "events")).select("track", "grp", "pts_us"))
    spans = cut.groupBy("track", "grp").agg(F.min("pts_us").alias("start"), F.max("pts_us").alias("end"))
    return timelines.unmet(spans, cut.where("grp % 13 <> 0").select("track", F.col("pts_us").alias("at")), "track", 2000)


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Messages and pictures, keyed by the user so that the join spreads."""
    w = wire(spark, sf_dir)
    pick = lambda t: w.where(F.col("track") == t).select("user_id", "event_id", "pts_us")
    return pick("signup"), pick("view")


USERS = ", m AS (SELECT user_id, event_id, pts_us FROM wire WHERE track = 'signup'), p AS (SELECT user_id, event_id, pts_us FROM wire WHERE track = 'view')"


@query(USERS + " SELECT m.user_id, m.event_id, m.pts_us, p.pts_us AS picture_pts, p.event_id - m.event_id AS lead FROM m ASOF LEFT JOIN p ON m.user_id = p.user_id AND m.pts_us <= p.pts_us")
def asof_forward_lead(spark, sf_dir):
    messages, pictures = sides(spark, sf_dir)
    met = timelines.asof(messages, pictures, "user_id", "pts_us", ["event_id"])
    return met.select("user_id", "event_id", "pts_us", F.col("right_pts_us").alias("picture_pts"), (F.col("right_event_id") - F.col("event_id")).alias("lead"))


@query(USERS + """, c AS (SELECT m.user_id, m.event_id, m.pts_us, p.event_id AS match, abs(p.pts_us - m.pts_us) AS distance, row_number() OVER (PARTITION BY m.event_id ORDER BY abs(p.pts_us - m.pts_us), p.pts_us, p.event_id) AS n
  FROM m JOIN p ON m.user_id = p.user_id WHERE abs(p.pts_us - m.pts_us) <= 43200000000) SELECT user_id, event_id, pts_us, distance, match FROM c WHERE n = 1""")
def nearest_match(spark, sf_dir):
    messages, pictures = sides(spark, sf_dir)
    return timelines.nearest(messages, pictures, "user_id", "pts_us", "event_id", 43_200_000_000)


@query("""WITH e AS (SELECT conv_id, turn AS place, md5(conv_id || ':' || turn) AS body FROM conversations), r AS (SELECT conv_id, body, row_number() OVER (PARTITION BY conv_id ORDER BY place + 3 * (place % 2), place) AS arrival FROM e WHERE (conv_id + place) % 5 <> 0),
m AS (SELECT e.conv_id, e.place, e.body, r.arrival, max(r.arrival) OVER (PARTITION BY e.conv_id ORDER BY e.place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM e LEFT JOIN r USING (conv_id, body))
SELECT conv_id, place, arrival, CASE WHEN arrival IS NOT NULL THEN coalesce(arrival > top, true) END AS in_order FROM m""")
def message_match(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    expected = c.select("conv_id", F.col("turn").alias("place"), F.md5(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).cast("binary")).alias("body"))
    w = Window.partitionBy("conv_id").orderBy(F.col("place") + 3 * (F.col("place") % 2), "place")
    received = expected.where("(conv_id + place) % 5 <> 0").select("conv_id", "body", F.row_number().over(w).cast("long").alias("arrival"))
    return timelines.matched_in_order(expected, received, "conv_id").select("conv_id", "place", "arrival", "in_order")


@query("WITH RECURSIVE " + COMMON + """, e AS (SELECT track, frame_no AS place, event_id * 31 % 97 % 23 AS body FROM wire),
r AS (SELECT track, event_id * 31 % 97 % 23 AS body, row_number() OVER (PARTITION BY track ORDER BY frame_no + frame_no * 5 % 8, frame_no) - 1 AS arrival FROM wire WHERE event_id % 7 <> 3),
g AS (SELECT DISTINCT track, CAST(-1 AS BIGINT) AS arrival, CAST(0 AS BIGINT) AS upto, CAST(NULL AS BIGINT) AS body, CAST(NULL AS BIGINT) AS place FROM r
  UNION ALL SELECT track, arrival, coalesce(m + 1, upto), body, m FROM (
    SELECT g.track, r.arrival, any_value(g.upto) AS upto, any_value(r.body) AS body, min(e.place) AS m FROM g JOIN r ON r.track = g.track AND r.arrival = g.arrival + 1
      LEFT JOIN e ON e.track = g.track AND e.body = r.body AND e.place >= g.upto GROUP BY g.track, r.arrival))
SELECT track, arrival, body, place FROM g WHERE arrival >= 0""")
def repeated_match(spark, sf_dir):
    """Bodies that repeat, received displaced and with losses, along whole tracks dealt over chunks."""
    rows = wire(spark, sf_dir).select("track", F.col("frame_no").alias("place"), (F.col("event_id") * 31 % 97 % 23).alias("body"), "event_id")
    w = Window.partitionBy("track").orderBy(F.col("place") + F.col("place") * 5 % 8, "place")
    received = rows.where("event_id % 7 <> 3").select("track", "body", (F.row_number().over(w) - 1).cast("long").alias("arrival"))
    return matching.matched(rows.select("track", "place", "body"), received, "track", chunk=256)


LATE = ", t AS (SELECT track, frame_no, pts_us, (event_id * 37) % 1000 AS late FROM wire)"


def lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire(spark, sf_dir).select("track", "frame_no", "pts_us", (F.col("event_id") * 37 % 1000).alias("late"))


@query(LATE + " SELECT track, frame_no, late, late - min(late) OVER (PARTITION BY track ORDER BY pts_us RANGE BETWEEN 5400000000 PRECEDING AND 5400000000 FOLLOWING) AS above FROM t")
def lateness_floor(spark, sf_dir):
    return timelines.above_floor(lateness(spark, sf_dir), "track", "pts_us", "late", 5_400_000_000).select("track", "frame_no", "late", "above")


@query(", b AS (SELECT track, sum(o) OVER (PARTITION BY track ORDER BY pts_us ROWS UNBOUNDED PRECEDING) AS batch FROM (SELECT track, pts_us, coalesce(CAST(pts_us - lag(pts_us) OVER (PARTITION BY track ORDER BY pts_us) >= 1800000000 AS BIGINT), 0) AS o FROM wire)) SELECT track, CAST(batch AS BIGINT) AS batch, count(*) AS packets FROM b GROUP BY ALL")
def arrival_batches(spark, sf_dir):
    return timelines.batches(logs.packets(table(spark, sf_dir, "events")).select("track", "pts_us"), "track", "pts_us", 1_800_000_000)


@query(LATE + ", o AS (SELECT track, list(late ORDER BY late) AS l, count(*) AS n FROM t GROUP BY track) SELECT track, n, (l[(n - 1) // 2 + 1] + l[n // 2 + 1]) / 2 AS median, l[CAST(least(n - 1, floor(n * 0.9)) AS BIGINT) + 1] AS p90, l[CAST(least(n - 1, floor(n * 0.99)) AS BIGINT) + 1] AS p99, l[n] AS greatest FROM o")
def lateness_percentiles(spark, sf_dir):
    return timelines.ranked(lateness(spark, sf_dir), "track", "late", {"p90": 0.9, "p99": 0.99})


@query(LATE + ", e AS (SELECT *, min(pts_us) OVER (PARTITION BY track) AS a, max(pts_us) OVER (PARTITION BY track) AS b FROM t) SELECT track, min(late) FILTER (pts_us >= b - 36000000000) - min(late) FILTER (pts_us <= a + 36000000000) AS drift FROM e GROUP BY track")
def drift(spark, sf_dir):
    return timelines.drift(lateness(spark, sf_dir), "track", "pts_us", "late", 36_000_000_000)


@query(SHAKEN + " SELECT track, max(g) AS widest FROM (SELECT track, pts_us - max(pts_us) OVER (PARTITION BY track ORDER BY frame_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM s) GROUP BY track")
def running_gap(spark, sf_dir):
    return timelines.widest_gap(shaken(spark, sf_dir), "track", "frame_no", "pts_us")


@query(', x AS (SELECT 1) SELECT track, grp, packets, CAST(row_number() OVER (PARTITION BY track ORDER BY grp) - 1 AS INTEGER) AS "window" FROM gr')
def summary_windows(spark, sf_dir):
    return timelines.report_windows(keyframe_groups(spark, sf_dir), "track", "grp").select("track", "grp", "packets", "window")


# Addresses.

#: Relay addresses out of pages' own, with a port for each third page, a token of its own for some, and a token to go with them.
RELAYS = """u AS (SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1) AS host,
    substring(split_part(split_part(url, '#', 1), '?', 1), instr(url, '://') + 4 + length(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1))) AS path,
    split_part(split_part(url, '#', 1), '?', 2) AS q, split_part(url, '#', 2) AS fragment, CASE WHEN page_id % 3 = 0 THEN 1000 + page_id % 60000 END AS port, CASE WHEN page_id % 5 = 0 THEN 't' || page_id % 7 END AS jwt FROM pages),
v AS (SELECT *, CASE WHEN jwt IS NULL THEN q WHEN q = '' THEN 'jwt=' || jwt ELSE q || '&jwt=' || jwt END AS query, ['', path, 'other', 't3'][page_id % 4 + 1] AS token FROM u),
r AS (SELECT *, scheme || '://' || host || CASE WHEN port IS NULL THEN '' ELSE ':' || port END AS origin, coalesce(jwt, path) AS own FROM v),
a AS (SELECT *, origin || '/' || path || CASE WHEN query = '' THEN '' ELSE '?' || query END || CASE WHEN fragment = '' THEN '' ELSE '#' || fragment END AS url FROM r)"""


def relays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, token, and the address's parts."""
    p = table(spark, sf_dir, "pages").select("page_id", address.parts(F.col("url")).alias("p"))
    p = p.withColumn("jwt", F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("jwt=t"), (F.col("page_id") % 7).cast("string"))))
    query = F.concat_ws("&", F.nullif(F.col("p.query"), F.lit("")), "jwt")
    port = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(":"), (1000 + F.col("page_id") % 60000).cast("string"))).otherwise("")
    mark = lambda m, c: F.when(c != "", F.concat(F.lit(m), c)).otherwise("")
    url = F.concat("p.origin", port, F.lit("/"), "p.path", mark("?", query), mark("#", F.col("p.fragment")))
    token = F.element_at(F.array(F.lit(""), F.col("p.path"), F.lit("other"), F.lit("t3")), (F.col("page_id") % 4 + 1).cast("int"))
    return p.select("page_id", url.alias("url"), token.alias("token")).withColumn("p", address.parts(F.col("url")))


@query(f"""WITH {RELAYS}, w AS (SELECT *, CASE WHEN fragment <> '' THEN 'fragment' WHEN token <> '' AND own <> '' AND token <> own THEN 'two tokens' END AS refused FROM a)
SELECT page_id, url, token, CASE WHEN refused IS NULL THEN CASE WHEN path = '' AND query = '' THEN CASE WHEN token = '' THEN '' ELSE '/' || token END ELSE '/' || path || CASE WHEN query = '' THEN '' ELSE '?' || query END END END AS path, refused FROM w""")
def url_session_path(spark, sf_dir):
    rows = relays(spark, sf_dir)
    return rows.select("page_id", "url", "token", address.session_path(F.col("p"), F.col("token")).alias("path"), address.refusal(F.col("p"), F.col("token")).alias("refused"))


@query(f"""WITH {RELAYS} SELECT page_id, origin || CASE WHEN path = '' THEN '' ELSE '/...' END || CASE WHEN query = '' THEN '' ELSE '?...' END || CASE WHEN fragment = '' THEN '' ELSE '#...' END AS shown, host, CAST(coalesce(port, 443) AS INTEGER) AS port,
  CASE WHEN length(url) <= 12 THEN length(url) || ' characters' ELSE url[:4] || '...' || url[-4:] END AS short, CASE WHEN length(token) <= 12 THEN length(token) || ' characters' ELSE token[:4] || '...' || token[-4:] END AS short_token FROM a""")
def url_parts(spark, sf_dir):
    rows = relays(spark, sf_dir)
    return rows.select("page_id", address.shown(F.col("p")).alias("shown"), "p.host", "p.port", address.shorten(F.col("url")).alias("short"), address.shorten(F.col("token")).alias("short_token"))


# The log as a source and sink.


def relay(spark: SparkSession) -> str:
    """A relay of a run's own, in the folder that driver and executors share."""
    return f"{logs.shared_dir(spark)}/relay-{uuid.uuid4().hex}"


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyframe groups in the log's columns, with the track's frame numbers."""
    kf = logs.wire_by_keyframe(table(spark, sf_dir, "events"))
    w = Window.partitionBy("track", "grp")
    return kf.select(
        "track", "grp", (F.col("frame_no") - F.min("frame_no").over(w)).alias("frame_in_group"), "pts_us", "keyframe", F.col("payload").cast("binary").alias("payload"),
        (F.col("frame_no") == F.max("frame_no").over(w)).alias("last"), "frame_no",
    )


def drained(stream: DataFrame, out: str, **trigger) -> DataFrame:
    """What a stream gives, up to now, of all that is there and was not given to an earlier call; written and read again with what was given then."""
    q = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(**trigger or {"processingTime": "0 seconds"}).start()
    try:
        q.awaitTermination() if trigger else q.processAllAvailable()
    finally:
        q.stop()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/rows")


@query(", x AS (SELECT 1) SELECT track, count(*) AS frames, count(DISTINCT grp) AS groups, CAST(sum(strlen(payload)) AS BIGINT) AS bytes, min(pts_us) AS since, max(pts_us) AS till, count(*) AS places, CAST(3 AS BIGINT) AS commits FROM kf GROUP BY track")
def log_stream(spark, sf_dir):
    """Three commits, the last of which lands before the stream is resumed, read in batches of four files at most."""
    top = relay(spark)
    rows = logs.kept(log_rows(spark, sf_dir))
    deal = lambda n: wirelog.append(rows.where(F.col("grp") % 3 == n).repartition("track"), top, "b")
    deal(0)
    deal(1)
    stream = wirelog.subscribe(spark, top, "b", start="backlog").frames(stream=True, max_files=4, progress=f"{top}/notes")
    drained(stream, f"{top}/got")
    deal(2)
    got = drained(stream, f"{top}/got")
    return got.groupBy("track").agg(
        F.count("*").alias("frames"), F.count_distinct("grp").alias("groups"), F.sum(F.octet_length("payload")).cast("long").alias("bytes"), F.min("pts_us").alias("since"), F.max("pts_us").alias("till"),
        F.count_distinct("landed").alias("places"), F.count_distinct(F.expr(f"shiftright(landed, {wirelog.ROWS_BITS})")).alias("commits"),
    )


@query(""", g AS (SELECT track, grp, min(pts_us) AS s FROM kf WHERE grp % 3 <> 1 OR track <> 'view' GROUP BY ALL), n AS (SELECT min(start) AS edge FROM (SELECT track, arg_max(s, grp) AS start FROM g GROUP BY track)),
j AS (SELECT track, edge, coalesce(max(grp) FILTER (s <= edge), min(grp)) AS grp FROM g, n GROUP BY ALL), k AS (SELECT j.track, j.grp, s AS since, edge FROM j JOIN g ON g.track = j.track AND g.grp = j.grp)
SELECT *, max(since) OVER () - min(since) OVER () AS spread FROM k""")
def shared_edge(spark, sf_dir):
    """Tracks that have come differently far are joined at one media time."""
    cut = logs.wire_by_keyframe(table(spark, sf_dir, "events")).where("grp % 3 <> 1 or track <> 'view'")
    return hold.shared_edge(cut.groupBy("track", "grp").agg(F.min("pts_us").alias("pts_us")))


@query(""", d AS (SELECT DISTINCT track, seq FROM arr), h AS (SELECT track, count(*) AS holes FROM (SELECT track, lead(seq) OVER (PARTITION BY track ORDER BY seq) - seq AS step FROM d) WHERE step > 1 GROUP BY track),
f AS (SELECT d.track, CAST(sum(packets) AS BIGINT) AS frames, CAST(sum(bytes) AS BIGINT) AS sent FROM d JOIN gr ON gr.track = d.track AND gr.grp = d.seq GROUP BY d.track)
SELECT track, count(*) AS received, count(DISTINCT seq) AS delivered, count(*) - count(DISTINCT seq) AS again, coalesce(any_value(holes), 0) AS holes_abandoned_end, min(seq) AS first_grp, max(seq) AS last_grp, any_value(frames) AS frames, any_value(sent) AS sent,
  true AS whole_groups FROM arr LEFT JOIN h USING (track) JOIN f USING (track) GROUP BY track""")
def hold_stream(spark, sf_dir):
    """Displaced and doubled groups as a log, in two commits, each followed by a run of the streaming hold that goes on from the one before; then each track is said to be finished."""
    top = relay(spark)
    came = arrivals(spark, sf_dir)
    parts = came.select("track", F.col("seq").alias("grp"), "arrival").join(log_rows(spark, sf_dir), ["track", "grp"])
    most = F.max("arrival").over(Window.partitionBy("track"))
    rows = logs.kept(parts.withColumn("nth", F.expr("arrival * 2") / (most + 1)))
    tracks = rows.select("track").distinct()
    wirelog.send_catalog(
        tracks.select(
            F.lit("video").alias("kind"), F.col("track").alias("name"), F.lit("avc1.64001f").alias("codec"), F.lit("legacy").alias("packaging"), *[F.lit(None).cast("binary").alias(c) for c in ("config", "init")],
            F.lit(640).alias("width"), F.lit(360).alias("height"), *[F.lit(None).cast("int").alias(c) for c in ("sample_rate", "channels", "timescale")],
        ), top, "b",
    )
    none = {c: F.lit(None).cast(k) for c, k in (("grp", "long"), ("frame_in_group", "long"), ("decodable", "boolean"), ("payload", "binary"))}
    finished = tracks.select("track", F.lit(0).cast("long").alias("arrival"), F.lit("finished").alias("event"), *[v.alias(c) for c, v in none.items()])
    finished.limit(0).write.mode("append").parquet(f"{top}/answers")
    answers = spark.readStream.schema(finished.schema).parquet(f"{top}/answers")
    held = wirelog.subscribe(spark, top, "b", start="backlog", hold_ms=10**9, join_ms=10**9, hold_mib=4096).ordered(answers, progress=f"{top}/notes")
    for n in range(2):
        wirelog.append(rows.where(F.floor("nth") == n).repartition("track").sortWithinPartitions("track", "arrival", "frame_in_group"), top, "b")
        drained(held, f"{top}/got", availableNow=True)
    finished.write.mode("append").parquet(f"{top}/answers")
    got = drained(held, f"{top}/got", availableNow=True)
    out = got.where("kind = 'frame'").groupBy("track").agg(F.count("*").alias("frames"), F.sum(F.octet_length("payload")).cast("long").alias("sent"))
    totals = got.where("kind = 'track' and final").select("track", "received", "delivered", (F.col("repeated") + F.col("dropped_late")).alias("again"), "holes_abandoned_end", "first_grp", "last_grp")
    back = got.where("kind = 'frame'").groupBy("track", "grp").agg(F.count("*").alias("n")).join(log_rows(spark, sf_dir).groupBy("track", "grp").agg(F.count("*").alias("m")), ["track", "grp"]).groupBy("track").agg(F.bool_and(F.col("n") == F.col("m")).alias("whole_groups"))
    return totals.join(out, "track").join(back, "track")
