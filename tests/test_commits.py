"""The commit log: what a write leaves, what readers see of it, and streams over it."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.sources import wirelog
from tidemark.sources.commits import EVERY, CommitLog, File
from tidemark.sources.wirelog import LOG, LogStreamReader, LogStreamWriter, PacedReader

TRACK = ("video", "v", "avc1.64001f", "legacy", None, None, 640, 360, None, None, None)
SCHEMA = "kind string, name string, codec string, packaging string, config binary, init binary, width int, height int, sample_rate int, channels int, timescale int"


def rows(spark, groups, track="v", frames=2):
    """The log's rows of some groups, a second apart."""
    return spark.createDataFrame([(track, g, n, (g * frames + n) * 1_000_000, n == 0, b"%d/%d" % (g, n), n == frames - 1) for g in groups for n in range(frames)], LOG).coalesce(1)


@pytest.fixture
def relay(tmp_path):
    return f"file://{tmp_path}/relay"


def files(relay, broadcast="b"):
    top = f"{relay.removeprefix('file://')}/{broadcast}/log"
    return sorted(os.path.join(d, n) for d, _, names in os.walk(top) for n in names)


def drained(spark, relay, name, tmp_path, start="backlog", **options):
    """What a stream that goes on from its checkpoint reads of what is there now, batch by batch."""
    got = []
    q = wirelog.subscribe(spark, relay, "b", start=start).frames(stream=True, **options).writeStream.foreachBatch(lambda df, n: got.append(sorted((r["track"], r["grp"], r["frame_in_group"]) for r in df.collect()))).option("checkpointLocation", str(tmp_path / name)).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return [g for g in got if g]


def test_numbers_without_gaps_from_many_writers(relay):
    log = CommitLog(f"{relay}/b")
    log.append([])

    def write(k):
        for i in range(40):
            CommitLog(f"{relay}/b").append([File(f"log/{k}-{i}", "v", 2, 9, i, i, 0, 1)])

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert log.last() == 161 and {f.path for f in log.files()} == {f"log/{k}-{i}" for k in range(4) for i in range(40)}
    assert os.path.exists(f"{log.folder}/{EVERY:020d}.all")
    landed = [f.landed for f in log.files()]
    assert landed == sorted(set(landed)) and not [n for n in os.listdir(log.folder) if n.startswith(".")]


def test_a_write_is_seen_once_it_is_committed(spark, relay, tmp_path):
    """Half-written files are no data; a writer that was slow is not missed; starts: backlog, live, and resumed."""
    wirelog.append(rows(spark, [0]), relay, "b")
    assert drained(spark, relay, "backlog", tmp_path) == [[("v", 0, 0), ("v", 0, 1)]]
    assert drained(spark, relay, "live", tmp_path, "live") == []
    # A slow writer's file is there before another one's commit, and is committed after it.
    slow = wirelog.written(f"{relay}/b", "log/slow", iter(rows(spark, [7]).toArrow().to_batches()))
    os.utime(f"{relay.removeprefix('file://')}/b/{slow.files[0]['path']}", (1, 1))
    wirelog.append(rows(spark, [1]), relay, "b")
    sub = wirelog.subscribe(spark, relay, "b")
    assert {r["grp"] for r in sub.frames().collect()} == {0, 1}
    for name in ("backlog", "live"):
        assert drained(spark, relay, name, tmp_path, name) == [[("v", 1, 0), ("v", 1, 1)]]
    CommitLog(f"{relay}/b").append([File(**f) for f in slow.files])
    for name in ("backlog", "live"):
        assert drained(spark, relay, name, tmp_path, name) == [[("v", 7, 0), ("v", 7, 1)]]
    order = [r["grp"] for r in sub.frames().orderBy("landed").collect()]
    assert order == [0, 0, 1, 1, 7, 7] and sub.frames().select("landed").distinct().count() == 6


def test_a_write_that_fails_leaves_nothing(spark, relay):
    wirelog.append(rows(spark, [0]), relay, "b")
    before = files(relay)
    bad = rows(spark, [1, 2]).repartition(2, "grp").withColumn("grp", F.when(F.col("grp") == 2, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("grp")))
    with pytest.raises(Exception, match="broken"):
        wirelog.append(bad, relay, "b")
    with pytest.raises(Exception, match="no track"):
        wirelog.append(rows(spark, [1]).withColumn("track", F.lit(None).cast("string")), relay, "b")
    assert files(relay) == before and CommitLog(f"{relay}/b").last() == 1
    # What a killed writer leaves is swept.
    lost = wirelog.written(f"{relay}/b", "log/lost", iter(rows(spark, [9]).toArrow().to_batches()))
    log = CommitLog(f"{relay}/b")
    assert log.swept(3600, os.path.getmtime(files(relay)[0]) + 60) == []
    assert [p.rsplit("/", 1)[1] for p in log.swept(0, 1e12)] == [lost.files[0]["path"].rsplit("/", 1)[1]] and files(relay) == before


def test_a_batch_that_runs_again_adds_nothing(spark, relay):
    location = f"{relay}/b"
    sink = LogStreamWriter(location, "w")
    told = [wirelog.written(location, sink._folder(b), iter(rows(spark, [b]).toArrow().to_batches())) for b in (0, 0, 1)]
    sink.commit([told[0], None], 0)  # the second attempt's file is not among what tasks told
    assert len(files(relay)) == 2 and CommitLog(location).last() == 1
    again = wirelog.written(location, sink._folder(0), iter(rows(spark, [0]).toArrow().to_batches()))
    sink.commit([again], 0)
    sink.commit([told[2]], 1)
    assert CommitLog(location).last() == 2 and len(files(relay)) == 2
    sink.abort([], 1)
    assert len(files(relay)) == 2
    sink.abort([wirelog.written(location, sink._folder(2), iter(rows(spark, [5]).toArrow().to_batches()))], 2)
    assert len(files(relay)) == 2


def test_bounded_batches_and_pruning(spark, relay, tmp_path):
    for g in range(5):
        wirelog.append(rows(spark, [g]).unionByName(rows(spark, [g], "w")), relay, "b")
    bounded = {"max_files": 3, "progress": f"file://{tmp_path}/notes"}
    got = drained(spark, relay, "bounded", tmp_path, **bounded)
    assert [len(g) for g in got] == [6, 6, 6, 2] and sorted(x for g in got for x in g) == sorted((t, g, n) for t in "vw" for g in range(5) for n in range(2))
    wirelog.append(rows(spark, range(5, 12)), relay, "b")
    wirelog.append(rows(spark, [12]), relay, "b")
    got = drained(spark, relay, "bounded", tmp_path, **bounded)
    assert sorted({x[1] for g in got for x in g}) == list(range(5, 13)) and sum(map(len, got)) == 16
    location = f"{relay}/b"
    reader = LogStreamReader(location, "backlog", tracks=["w"])
    assert {p.track for p in reader.partitions(reader.initialOffset(), reader.latestOffset())} == {"w"}
    small = LogStreamReader(location, "backlog", max_bytes=1)
    small.initialOffset()
    assert small.latestOffset() == {"commit": 1, "file": 1}
    batch = wirelog.LogReader(location)
    list(batch.pushFilters([wirelog.GreaterThanOrEqual(("grp",), 3), wirelog.LessThanOrEqual(("grp",), 4)]))
    assert {p.file["low"] for p in batch.partitions()} == {3, 4}
    assert wirelog.subscribe(spark, relay, "b").frames(["w"]).where("grp > 3").count() == 2


def test_paced_replay(spark, relay, tmp_path):
    """Rows are given as the clock comes to their media time, so much of it in a batch, and on from the offset after a restart."""
    wirelog.append(rows(spark, range(10)), relay, "b")  # twenty frames, a second apart
    wirelog.append(rows(spark, range(3), "w").withColumn("pts_us", F.col("pts_us") + 500_000), relay, "b")
    now, notes = [1000.0], f"file://{tmp_path}/notes"
    reader = PacedReader(f"{relay}/b", speed=2.0, max_s=4.0, progress=notes, clock=lambda: now[0])

    def given(r, start):
        end = r.latestOffset()
        times = sorted(p for part in r.partitions(start, end) for b in r.read(part) for p in b.column("pts_us").to_pylist())
        r.commit(end)
        return end, [t / 1e6 for t in times]

    at = reader.initialOffset()
    at, got = given(reader, at)
    assert got == []
    now[0] += 1.2
    at, got = given(reader, at)
    assert got == [0, 0.5, 1, 1.5, 2]
    now[0] += 100
    at, got = given(reader, at)
    assert got == [2.5, 3, 3.5, 4, 4.5, 5, 5.5, 6]  # 2.4 to 6.4
    again = PacedReader(f"{relay}/b", speed=2.0, progress=notes, clock=lambda: now[0])
    wirelog.append(rows(spark, [50]), relay, "b")  # not there as the play began
    at, got = given(again, at)
    assert got == [float(n) for n in range(7, 20)]
    assert given(again, at)[1] == []
    played = drained(spark, relay, "paced", tmp_path, paced=True, speed=1e6, progress=f"{notes}-2")
    assert sum(map(len, played)) == 28


def test_a_publisher_comes_back_or_restarts(spark, relay, tmp_path):
    """A session that goes on is followed, frames that came already are not given twice; one that counts from anew fails the run."""
    video = spark.createDataFrame([TRACK], SCHEMA)
    frames = spark.createDataFrame([("v", n, n * 1000, n % 4 == 0, b"%d" % n) for n in range(12)], "track string, frame_no long, pts_us long, keyframe boolean, payload binary")
    wirelog.publish(frames, video, relay, "b")
    whole = wirelog.subscribe(spark, relay, "b").frames().orderBy("grp", "frame_in_group").collect()
    wirelog.publish(frames.where("frame_no < 0"), video, relay, "c")

    def run(broadcast, **how):
        out = []
        sub = wirelog.subscribe(spark, relay, broadcast, start="backlog", hold_ms=600_000, join_ms=0)
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        q = sub.ordered(progress=f"file://{tmp_path}/run").writeStream.foreachBatch(lambda df, n: out.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        try:
            assert q.awaitTermination(60)
        finally:
            q.stop()
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        return [bytes(r["payload"]) for r in out if r["kind"] == "frame"], {r["kind"] for r in out}

    log = spark.createDataFrame(whole).select(*[f.split(" ")[0] for f in LOG.split(", ")])
    wirelog.append(log.where("grp = 0 or (grp = 1 and frame_in_group < 2)"), relay, "c")
    got, _ = run("c")
    assert got == [b"%d" % n for n in range(6)]
    wirelog.append(log.where("grp >= 1"), relay, "c", session=True)  # from the broken group's first frame
    got, kinds = run("c")
    assert got == [b"%d" % n for n in range(6, 12)] and "hole" not in kinds
    wirelog.append(log.where("grp = 0"), relay, "c", session=True)
    with pytest.raises(Exception, match="the publisher has restarted: group 0 after 2"):
        run("c")
    # A catalog that is another one fails as the run begins.
    wirelog.send_catalog(spark.createDataFrame([(*TRACK[:2], "avc1.42001e", *TRACK[3:])], SCHEMA), relay, "c")
    with pytest.raises(ValueError, match="'v' is not what it was: codec"):
        run("c")


def test_catalog_is_sent_again_and_again(spark, relay, tmp_path):
    video = spark.createDataFrame([TRACK], SCHEMA)
    wirelog.append(rows(spark, [0]), relay, "b")
    for expected in (2, 4):
        q = wirelog.catalog_stream(video, relay, "b", str(tmp_path / "cp"), every_s=0.2)
        try:
            for _ in range(300):
                if sum(f.track == wirelog.CATALOG for f in CommitLog(f"{relay}/b").files()) >= expected:
                    break
                q.awaitTermination(0.1)
        finally:
            q.stop()
    sent = wirelog.subscribe(spark, relay, "b").resent().orderBy("grp").collect()
    assert [r["grp"] for r in sent] == list(range(len(sent))) and len(sent) >= 4 and len({r["document"] for r in sent}) == 1
    assert wirelog.subscribe(spark, relay, "b").frames().count() == 2  # the catalog is no track of the broadcast


def test_nothing_is_published_before_it_is_wanted(spark, relay):
    location, now = f"{relay}/b", [0.0]

    def sleep(s):
        now[0] += s
        if now[0] == 2.0:
            wirelog.subscribe(spark, relay, "b").want()
        if now[0] == 4.0:
            wirelog.subscribe(spark, relay, "b").want(["v"])

    wait = lambda hold_s: wirelog.wanted(location, hold_s, lambda: now[0], sleep)
    assert wait(0) == "time" and now[0] == 0
    assert wait(1.5) == "time" and now[0] == 1.5
    assert wait(2) == "time" and now[0] == 3.5  # the catalog was, a track not
    assert wait(10) == "wanted" and now[0] == 4.0
    assert wait(10) == "wanted" and now[0] == 4.0


def test_what_cannot_be_published_is_refused_by_name(spark, relay):
    frames = spark.createDataFrame([("v", 0, 0, True, b"x"), (None, 0, 0, True, b"x"), ("x", 0, 0, True, b"x")], "track string, frame_no long, pts_us long, keyframe boolean, payload binary")

    def tracks(*some):
        return spark.createDataFrame([(kind, name, codec, *TRACK[3:]) for kind, name, codec in some], SCHEMA)

    for some, why in [
        ([("video", "v", "vp09.00.10")], "'v' is video of codec 'vp09.00.10': h264"), ([("audio", "v", "opus")], "'v' is audio of codec 'opus': aac"), ([("data", "v", "cbor")], "'v' is data of codec 'cbor': json"),
        ([("video", "v", None)], "'v' is video of codec None"), ([("video", "v", "avc1.64001f"), ("data", "v", "json")], "'v' is named 2 times"), ([("video", None, "avc1.64001f")], "no name"),
        ([("video", "v", "avc1.64001f")], "frames of track"),
    ]:
        with pytest.raises(ValueError, match=why):
            wirelog.publish(frames, tracks(*some), relay, "b")
    assert files(relay) == []


def test_odd_track_names(spark, relay):
    name = "a b/c%2F[1]*+é"
    wirelog.append(rows(spark, [0], name), relay, "b")
    sub = wirelog.subscribe(spark, relay, "b")
    assert {r["track"] for r in sub.frames().collect()} == {name} and {r["track"] for r in wirelog.committed(spark, sub.location).collect()} == {name}
    assert sub.frames([name]).count() == 2


def test_a_ladder_is_joined_at_one_media_time(spark, relay, tmp_path):
    """Tracks that have come differently far begin with groups of one time, also when the run is resumed further on."""
    video = spark.createDataFrame([(TRACK[0], t, *TRACK[2:]) for t in "vw"], SCHEMA)
    wirelog.send_catalog(video, relay, "b")
    for g in range(6):
        wirelog.append(rows(spark, [g]), relay, "b")
    wirelog.append(rows(spark, range(4), "w"), relay, "b")
    sub = wirelog.subscribe(spark, relay, "b", join_ms=0)
    assert sub.edge() == {"v": 3, "w": 3}

    def run():
        out = []
        q = sub.ordered(progress=f"file://{tmp_path}/run", shared_edge=True).writeStream.foreachBatch(lambda df, n: out.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        try:
            assert q.awaitTermination(60)
        finally:
            q.stop()
        return {t: sorted({r["grp"] for r in out if r["kind"] == "frame" and r["track"] == t}) for t in "vw"}

    assert run() == {"v": [3, 4, 5], "w": [3]}
    wirelog.append(rows(spark, [4, 5, 6], "w").unionByName(rows(spark, [6])), relay, "b")
    assert run() == {"v": [6], "w": [4, 5, 6]}
