import pytest
from pyspark.sql import functions as F

from tidemark.plans.queries import wire
from tidemark.sources import wirelog

SF = "/root/testdata/sf0.001"
TRACKS = [
    ("video", "view", "avc1.64001f", "legacy", None, None, 640, 360, None, None, None), ("audio", "click", "mp4a.40.2", "legacy", None, None, None, None, 48000, 2, None),
    ("data", "signup", "json", "legacy", None, None, None, None, None, None, 1000000),
]
SCHEMA = "kind string, name string, codec string, packaging string, config binary, init binary, width int, height int, sample_rate int, channels int, timescale int"


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    relay = "file://" + str(tmp_path_factory.mktemp("relay"))
    frames = wire(spark, SF).where("track in ('view', 'click', 'signup')")
    rows = wirelog.publish(frames, spark.createDataFrame(TRACKS, SCHEMA), relay, "live/demo", audio_group_ms=3_600_000)
    return relay, frames, rows


def test_rows_and_relation(spark, published):
    relay, frames, rows = published
    told = {(r["kind"], r["track"]): r for r in rows.collect()}
    assert told["trailing", None]["packets"] == frames.count() and told["trailing", None]["tracks"] == 3
    assert told["track", "signup"]["groups"] == told["track", "signup"]["packets"]
    sub = wirelog.subscribe(spark, relay, "live/demo", start="backlog")
    rel = sub.relation().collect()
    assert [(r["row"], r["name"], r["codecs"], r["video"], r["audio"], r["data"]) for r in rel] == [(0, "view", "avc1.64001f,mp4a.40.2", ["view"], ["click"], ["signup"])]


def test_every_frame_comes_back_and_tracks_are_pruned(spark, published):
    relay, frames, _ = published
    sub = wirelog.subscribe(spark, relay, "live/demo")
    got = sub.frames().select("track", "pts_us", F.col("payload").cast("string").alias("payload"))
    assert got.exceptAll(frames.select("track", "pts_us", "payload")).count() == 0 and got.count() == frames.count()
    assert sub.frames(["view"]).where("track <> 'view'").count() == 0
    reader = wirelog.LogReader(sub.location)
    list(reader.pushFilters([wirelog.EqualTo(("track",), "view")]))
    assert {p.track for p in reader.partitions()} == {"view"}
    asks = spark.createDataFrame([("view", 0), ("view", 10**6)], "track string, seq long")
    assert {(r["seq"], r["answer"]) for r in sub.missing(asks).collect()} == {(0, "group"), (10**6, "gone")}


def test_stream_reads_the_backlog(spark, published, tmp_path):
    relay, frames, _ = published
    src = wirelog.subscribe(spark, relay, "live/demo", start="backlog").frames(stream=True)
    q = src.writeStream.format("memory").queryName("wire").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.table("wire").count() == frames.count()


def test_stream_goes_on_and_begins_live(spark, published, tmp_path):
    """New files are read once each, by tasks; a live reader begins past what is there."""
    relay, frames, _ = published
    src = wirelog.subscribe(spark, relay, "live/demo").frames().where("track = 'click'").cache()
    n = src.count()
    base = f"{relay}/live/growing"
    wirelog.append(src, relay, "live/growing")
    names = {}
    for start in ("live", "backlog"):
        names[start] = wirelog.subscribe(spark, relay, "live/growing", start=start).frames(stream=True).writeStream.format("memory").queryName(f"from_{start}").option("checkpointLocation", str(tmp_path / start)).start()
    try:
        for q in names.values():
            q.processAllAvailable()
        wirelog.append(src, relay, "live/growing")
        for q in names.values():
            q.processAllAvailable()
    finally:
        for q in names.values():
            q.stop()
    assert spark.table("from_backlog").count() == 2 * n and spark.table("from_live").count() == n
    reader = wirelog.LogStreamReader(base, "backlog")
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(parts) >= 2 and all(isinstance(p, wirelog.Part) for p in parts)


def test_other_kinds_are_refused(spark, published):
    relay, frames, _ = published
    odd = spark.createDataFrame([("subtitles", *TRACKS[0][1:])], SCHEMA)
    with pytest.raises(ValueError, match="'view' is of kind 'subtitles'"):
        wirelog.publish(frames, odd, relay, "live/odd")


def test_parameters():
    with pytest.raises(ValueError, match="no such"):
        wirelog.checked(wirelog.PUBLISH, {"speed": 1})
    with pytest.raises(ValueError, match="whole number"):
        wirelog.checked(wirelog.SUBSCRIBE, {"hold_ms": 1.5})
    with pytest.raises(ValueError, match="rows"):
        wirelog.checked(wirelog.PUBLISH, {"rows": "all"})
    assert wirelog.checked(wirelog.SUBSCRIBE, {})["start"] == "live"


def test_stream_is_published(spark, published, tmp_path):
    relay, frames, _ = published
    src = wirelog.subscribe(spark, relay, "live/demo", start="backlog").frames(stream=True).where("track = 'view'")
    q = wirelog.publish_stream(src, relay, "live/copy", str(tmp_path / "cp"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    copy = wirelog.subscribe(spark, relay, "live/copy")
    assert copy.frames().count() == frames.where("track = 'view'").count()
    with pytest.raises(TimeoutError):
        copy.catalog(tries=2, pause_s=0)


def test_ordered_broadcast(spark, tmp_path):
    """Groups that land out of order leave in sequence, under the subscription's own hold; what a hole lacks is asked for and answered."""
    relay, rows = "file://" + str(tmp_path), []
    frames = spark.createDataFrame([("v", n, n * 1000, n % 4 == 0, b"%d" % n) for n in range(40)], "track string, frame_no long, pts_us long, keyframe boolean, payload binary")
    wirelog.publish(frames, spark.createDataFrame([(*TRACKS[0][:1], "v", *TRACKS[0][2:])], SCHEMA), relay, "whole")
    whole = wirelog.subscribe(spark, relay, "whole", start="backlog")
    assert whole.frames().where("last").count() == 10
    # The same broadcast again, as a log that lands group by group: 1, 0, 3, 2, ... and never 5.
    wirelog.publish(frames.where("frame_no < 0"), spark.createDataFrame([(*TRACKS[0][:1], "v", *TRACKS[0][2:])], SCHEMA), relay, "late")
    for i in [n for n in (1, 0, 3, 2, 4, 7, 6, 9, 8)]:
        wirelog.append(whole.frames().where(F.col("grp") == i), relay, "late")
    late = wirelog.subscribe(spark, relay, "late", start="backlog", hold_ms=600_000, join_ms=600_000)
    answers = str(tmp_path / "answers")
    asked = spark.createDataFrame([("v", 5), ("v", 99)], "track string, grp long")
    got = whole.answered(asked)
    assert {(r["event"], r["grp"]) for r in got.collect()} == {("frame", 5), ("end", 5), ("gone", 99)}
    got.where("grp = 5").coalesce(1).write.parquet(answers)
    stream = spark.readStream.schema(got.schema).parquet(answers)

    def keep(batch, nth):
        rows.extend(batch.collect())

    spark.conf.set("spark.sql.shuffle.partitions", "2")
    q = late.ordered(stream).writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(90)
    finally:
        q.stop()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    out = [(r["grp"], bytes(r["payload"])) for r in rows if r["kind"] == "frame"]
    assert out == [(n // 4, b"%d" % n) for n in range(40)]
