"""A broadcast as a directory: its catalog, and its tracks' groups as a wire log.

    <relay>/<broadcast>/catalog/       one line, the catalog document
    <relay>/<broadcast>/log/           Parquet files of frames, a folder for each write, in it one for each track
    <relay>/<broadcast>/commits/       which of the files are the log (see commits.py)
    <relay>/<broadcast>/wants/         what subscribers have asked for

`publish` writes one, `subscribe` reads one, in place of a relay; `last` marks the frame that ends a group. The data source
`tidemark_wire` reads the log in batches or as a stream, writes it in batches or from a stream, and reads no file of a track or of
groups that the query filters out. A write's files become part of the log all together, by its commit.
"""

from __future__ import annotations

import json
import re
import time
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.datasource import In as IsIn

from tidemark.operators import catalog, hold, logs
from tidemark.sources.commits import ROWS_BITS, CommitLog, File  # noqa: F401
from tidemark.streaming import ordered

LOG = "track string, grp long, frame_in_group long, pts_us long, keyframe boolean, payload binary, last boolean"
FIELDS = [f.split(" ")[0] for f in LOG.split(", ")]
ARROW = pa.schema([("grp", pa.int64()), ("frame_in_group", pa.int64()), ("pts_us", pa.int64()), ("keyframe", pa.bool_()), ("payload", pa.binary()), ("last", pa.bool_())])
#: What the source gives: the log, when a row landed (a number of its commit and of its place in it), and the publisher's session.
SCHEMA = LOG + ", landed long, session long"
#: The track that carries the catalog document, as often as it is sent.
CATALOG = "catalog.json"

#: Groups of a track that one task writes.
GROUPS = 4096
#: Files that a task writes at the same time.
OPEN = 64


class Part(InputPartition):
    """A file of the log; pts: the media time to give, from and up to; low: the first group to give."""

    def __init__(self, file: File, pts: tuple[int, int] | None = None, low: int | None = None):
        self.file, self.track, self.pts, self.low = asdict(file), file.track, pts, low


def batches(location: str, part: Part) -> Iterator[pa.RecordBatch]:
    store, base = fs.FileSystem.from_uri(location)
    file = File(**part.file)
    at = file.landed
    with store.open_input_file(f"{base}/{file.path}") as f:
        for b in pq.ParquetFile(f).iter_batches(columns=ARROW.names):
            n = b.num_rows
            columns = [pa.array([file.track] * n, pa.string()), *(b.column(c) for c in ARROW.names), pa.array(range(at, at + n), pa.int64()), pa.array([file.session] * n, pa.int64())]
            out = pa.RecordBatch.from_arrays(columns, names=[*FIELDS, "landed", "session"])
            if part.pts:
                out = out.filter(pc.and_(pc.greater_equal(b.column("pts_us"), part.pts[0]), pc.less(b.column("pts_us"), part.pts[1])))
            if part.low is not None:
                out = out.filter(pc.greater_equal(b.column("grp"), part.low))
            yield out
            at += n


class LogReader(DataSourceReader):
    """The log as of its last commit."""

    def __init__(self, location: str):
        self.location, self.tracks, self.low, self.high = location, None, None, None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("track",):
                self.tracks = {f.value}
            elif isinstance(f, IsIn) and f.attribute == ("track",):
                self.tracks = set(f.value)
            elif isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute == ("grp",):
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.low = f.value if self.low is None else max(self.low, f.value)
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.high = f.value if self.high is None else min(self.high, f.value)
            yield f  # Spark checks the rows again

    def partitions(self):
        found = [f for f in CommitLog(self.location).files() if self.tracks is None or f.track in self.tracks]
        found = [f for f in found if (self.low is None or f.high >= self.low) and (self.high is None or f.low <= self.high)]
        return [Part(f) for f in found] or [InputPartition(None)]

    def read(self, partition):
        if isinstance(partition, Part):
            yield from batches(self.location, partition)


class Progress:
    """What a stream's reader notes for itself beside the stream's checkpoint, which readers aren't told of."""

    def __init__(self, location: str | None):
        self.store, self.path = fs.FileSystem.from_uri(location) if location else (None, None)

    def get(self) -> dict | None:
        if self.store is None or self.store.get_file_info(f"{self.path}/reader.json").type != fs.FileType.File:
            return None
        with self.store.open_input_file(f"{self.path}/reader.json") as f:
            return json.loads(f.read())

    def put(self, what: dict) -> None:
        if self.store is not None:
            self.store.create_dir(self.path, recursive=True)
            with self.store.open_output_stream(f"{self.path}/.reader") as f:
                f.write(json.dumps(what).encode())
            self.store.move(f"{self.path}/.reader", f"{self.path}/reader.json")


class LogStreamReader(DataSourceStreamReader):
    """New commits are new data; start 'live' begins past what is there, 'backlog' at the log's first commit.

    An offset is the next file to read: the number of its commit and its place in it. Only file names and
    statistics pass the driver: each file is a partition, and a task reads it. tracks: others' files are never planned.
    edge: the first group of each track that is given; a stream begins at the first commit that has one of them.
    A batch has so many files and bytes at most (a file at least), where that is told; then the reader notes in progress where it is, as
    Spark asks it for a batch's end without saying where it begins. An availableNow trigger asks once for the end, so it takes no bound.
    """

    def __init__(self, location: str, start: str, tracks: list[str] | None = None, max_files: int | None = None, max_bytes: int | None = None, progress: str | None = None, edge: dict[str, int] | None = None):
        self.edge = edge or {}
        self.location, self.live, self.tracks, self.max_files, self.max_bytes = location, start == "live", tracks, max_files, max_bytes
        self.progress, self.reached, self.first = Progress(progress), None, None

    def _end(self, log: CommitLog) -> dict:
        return {"commit": log.last(max(0, self.reached["commit"] - 1) if self.reached else 0) + 1, "file": 0}

    def initialOffset(self):
        if self.first is None:
            log = CommitLog(self.location)
            last = log.last()
            if self.edge:
                last = min((f.number for f in log.files(last) if f.track in self.edge and self._mine(f)), default=last + 1) - 1
            self.first = {"commit": last + 1 if self.edge or self.live else max(1, log.read(last).began) if last else 1, "file": 0}
        return self.first

    def latestOffset(self):
        log = CommitLog(self.location)
        if self.max_files is None and self.max_bytes is None:
            return self._end(log)
        if self.reached is None:
            self.reached = self.progress.get() or self.initialOffset()
        last, files, size = log.last(max(0, self.reached["commit"] - 1)), 0, 0
        number, place = self.reached["commit"], self.reached["file"]
        while number <= last:
            found = log.read(number).files
            for nth in range(place, len(found)):
                if self._mine(found[nth]):
                    files, size = files + 1, size + found[nth].size
                    if files > 1 and (files > (self.max_files or files) or size > (self.max_bytes or size)):
                        self.reached = {"commit": number, "file": nth}
                        return self.reached
            number, place = number + 1, 0
        self.reached = {"commit": number, "file": place}
        return self.reached

    def _mine(self, file: File) -> bool:
        return (self.tracks is None or file.track in self.tracks) and file.high >= self.edge.get(file.track, file.high)

    def between(self, start: dict, end: dict) -> list[File]:
        log, low, high = CommitLog(self.location), (start["commit"], start["file"]), (end["commit"], end["file"])
        numbers = range(low[0], high[0] + (high[1] > 0))
        return [f for n in numbers for nth, f in enumerate(log.read(n).files) if low <= (n, nth) < high and self._mine(f)]

    def partitions(self, start, end):
        self.reached = end
        return [Part(f, low=self.edge.get(f.track)) for f in self.between(start, end)]

    def read(self, partition):
        yield from batches(self.location, partition)

    def commit(self, end):
        self.progress.put(end)


class PacedReader(DataSourceStreamReader):
    """The log as of the stream's beginning, played at its own pace: a row is given once the clock has come to its media time.

    An offset is the media time, in microseconds, up to which rows have been given, and the clock's milliseconds at which the play began;
    so a batch holds what the clock has passed since the one before, max_s of media time at most. speed: media seconds in a second.
    """

    def __init__(self, location: str, speed: float = 1.0, max_s: float | None = None, tracks: list[str] | None = None, progress: str | None = None, clock: Callable[[], float] = time.time):
        self.location, self.speed, self.max_us, self.tracks, self.clock = location, speed, max_s and int(max_s * 1_000_000), tracks, clock
        self.progress, self.reached, self.files, self.first = Progress(progress), None, None, None

    def _files(self, upto: int | None = None) -> list[File]:
        if self.files is None:
            self.files = [f for f in CommitLog(self.location).files(upto) if f.since is not None and (self.tracks is None or f.track in self.tracks)]
        return self.files

    def initialOffset(self):
        if self.first is None:
            last = CommitLog(self.location).last()
            zero = min((f.since for f in self._files(last)), default=0)
            self.first = {"pts": zero, "zero": zero, "began_ms": int(self.clock() * 1000), "log": last}
        return self.first

    def latestOffset(self):
        at = self.reached or self.progress.get() or self.initialOffset()
        end = max((f.till for f in self._files(at["log"])), default=at["pts"] - 1) + 1
        now = at["zero"] + int((self.clock() * 1000 - at["began_ms"]) * 1000 * self.speed)
        pts = max(at["pts"], min(end, now, at["pts"] + self.max_us if self.max_us else end))
        self.reached = at | {"pts": pts}
        return self.reached

    def partitions(self, start, end):
        self.reached = end
        low, high = start["pts"], end["pts"]
        return [Part(f, (low, high)) for f in self._files(end["log"]) if f.since < high and f.till >= low]

    def read(self, partition):
        yield from batches(self.location, partition)

    def commit(self, end):
        self.progress.put(end)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


def written(location: str, folder: str, rows: Iterator[pa.RecordBatch]) -> Written:
    """Writes rows, by track, to files of a folder of the log; a failure leaves none."""
    store, base = fs.FileSystem.from_uri(location)
    open_files: dict[str, tuple] = {}
    done: list[File] = []
    paths: list[str] = []

    def close(track: str) -> None:
        writer, stream, file = open_files.pop(track)
        writer.close()
        stream.close()
        file.size = store.get_file_info(f"{base}/{file.path}").size
        done.append(file)

    def opened(track: str) -> tuple:
        if track not in open_files:
            if len(open_files) >= OPEN:
                close(next(iter(open_files)))
            path = f"{folder}/track={quote(track, safe='')}/{uuid.uuid4().hex}.parquet"
            store.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
            paths.append(path)
            stream = store.open_output_stream(f"{base}/{path}")
            open_files[track] = (pq.ParquetWriter(stream, ARROW, compression="zstd"), stream, File(path, track, 0, 0, 0, 0, None, None))
        return open_files[track]

    try:
        for batch in rows:
            tracks = batch.column(batch.schema.names.index("track"))
            if tracks.null_count:
                raise ValueError("a row of the log has no track")
            body = pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index(c)).cast(ARROW.field(c).type) for c in ARROW.names], schema=ARROW)
            for track in pc.unique(tracks).to_pylist():
                mine = body.filter(pc.equal(tracks, track))
                writer, _, file = opened(track)
                writer.write_batch(mine)
                grp, pts = pc.min_max(mine.column("grp")), pc.min_max(mine.column("pts_us"))
                low, high = grp["min"].as_py() or 0, grp["max"].as_py() or 0
                file.low, file.high = (min(file.low, low), max(file.high, high)) if file.rows else (low, high)
                if pts["min"].is_valid:
                    file.since = pts["min"].as_py() if file.since is None else min(file.since, pts["min"].as_py())
                    file.till = pts["max"].as_py() if file.till is None else max(file.till, pts["max"].as_py())
                file.rows += mine.num_rows
        for track in list(open_files):
            close(track)
    except BaseException:
        for track in list(open_files):
            open_files.pop(track)[1].close()
        for path in paths:
            if store.get_file_info(f"{base}/{path}").type == fs.FileType.File:
                store.delete_file(f"{base}/{path}")
        raise
    return Written([asdict(f) for f in done])


def named(location: str, folder: str, messages: list[Written | None], keep: bool) -> list[File]:
    """The files that tasks have told of; others in the folder, or all if they aren't to be kept, are deleted."""
    files = [File(**f) for m in messages if m for f in m.files] if keep else []
    store, base = fs.FileSystem.from_uri(location)
    there = {f"{base}/{f.path}" for f in files}
    for i in store.get_file_info(fs.FileSelector(f"{base}/{folder}", recursive=True, allow_not_found=True)):
        if i.type == fs.FileType.File and i.path not in there:
            store.delete_file(i.path)
    return sorted(files, key=lambda f: (f.track, f.low, f.since or 0, f.path))


class LogWriter(DataSourceArrowWriter):
    """Tasks write files, the driver commits them all, or deletes them all."""

    def __init__(self, location: str, overwrite: bool, session: bool):
        self.location, self.overwrite, self.session, self.folder = location, overwrite, session, f"log/{uuid.uuid4().hex}"

    def write(self, iterator):
        return written(self.location, self.folder, iterator)

    def commit(self, messages):
        CommitLog(self.location).append(named(self.location, self.folder, messages, True), replace=self.overwrite, session=self.session)

    def abort(self, messages):
        named(self.location, self.folder, messages, False)


class LogStreamWriter(DataSourceStreamArrowWriter):
    """As LogWriter, a micro-batch at a time; one that runs again after its commit adds nothing.

    writer names the query that writes, and is the same after a restart. A micro-batch's folder is told by both and its number.
    """

    def __init__(self, location: str, writer: str):
        self.location, self.writer = location, writer

    def _folder(self, batch) -> str:
        return f"log/{quote(self.writer, safe='')}-{batch}"

    def write(self, iterator):
        batch = TaskContext.get().getLocalProperty("streaming.sql.batchId")
        return written(self.location, self._folder(batch), iterator)

    def commit(self, messages, batchId):
        log = CommitLog(self.location)
        last = log.last()
        if last and log.read(last).writers.get(self.writer, -1) >= batchId:  # committed before a restart: what is new is let go
            store, base = fs.FileSystem.from_uri(self.location)
            for m in messages:
                for f in m.files if m else []:
                    store.delete_file(f"{base}/{f['path']}")
            return
        log.append(named(self.location, self._folder(batchId), messages, True), writer=self.writer, batch=batchId)

    def abort(self, messages, batchId):
        """What a batch that ran again after its commit leaves is swept() later; the folder is left alone where it is committed."""
        log = CommitLog(self.location)
        last = log.last()
        if not last or log.read(last).writers.get(self.writer, -1) < batchId:
            named(self.location, self._folder(batchId), messages, False)


class WireSource(DataSource):
    """Options: path; start, tracks (a JSON list), max_files, max_mib and progress of a stream; paced with speed and max_s; session, writer of a sink."""

    @classmethod
    def name(cls):
        return "tidemark_wire"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return LogReader(self.options["path"])

    def streamReader(self, schema):
        get = self.options.get
        if not get("progress") and (get("max_files") or get("max_mib") or get("paced", "false") == "true"):
            raise ValueError("a bounded or paced stream needs progress, a folder beside its checkpoint")
        tracks = json.loads(get("tracks")) if get("tracks") else None
        if get("paced", "false") == "true":
            return PacedReader(self.options["path"], float(get("speed", "1")), float(get("max_s")) if get("max_s") else None, tracks, get("progress"))
        files, mib = (int(get(k)) if get(k) else None for k in ("max_files", "max_mib"))
        return LogStreamReader(self.options["path"], get("start", "live"), tracks, files, mib and mib << 20, get("progress"), json.loads(get("edge")) if get("edge") else None)

    def writer(self, schema, overwrite):
        return LogWriter(self.options["path"], overwrite, self.options.get("session", "false") == "true")

    def streamWriter(self, schema, overwrite):
        return LogStreamWriter(self.options["path"], self.options["writer"])


PUBLISH = {"cert": "", "token": "", "audio_group_ms": 200, "rows": "summary", "reconnect_s": 60, "hold_s": 10}
SUBSCRIBE = {"cert": "", "token": "", "start": "live", "hold_ms": None, "hold_mib": 64, "join_ms": 2000, "reconnect_s": 60}


def checked(known: dict, given: dict) -> dict:
    """Parameters with their defaults; unknown ones and wrong values are refused."""
    if unknown := sorted(set(given) - set(known)):
        raise ValueError(f"no such parameters: {', '.join(unknown)}")
    out = known | given
    for k in ("audio_group_ms", "reconnect_s", "hold_ms", "hold_mib", "join_ms"):
        v = out.get(k)
        if v is not None and (not isinstance(v, int) or isinstance(v, bool) or v < 0):
            raise ValueError(f"{k} is a whole number, 0 or more")
    if "rows" in out and out["rows"] not in ("summary", "groups", "none"):
        raise ValueError("rows is 'summary', 'groups' or 'none'")
    if "start" in out and out["start"] not in ("live", "backlog"):
        raise ValueError("start is 'live' or 'backlog'")
    return out


#: Codecs that are published, by kind: how their names in a catalog begin, and what they are called.
CODECS = {"video": (r"avc[13]\.", "h264"), "audio": (r"mp4a\.40\.", "aac"), "data": (r"json$", "json")}


def refused(tracks: DataFrame) -> list[str]:
    """Why a catalog cannot be published, by name of track; a few of the reasons."""
    known = F.lit(False)
    for kind, (begins, _) in CODECS.items():
        known |= (F.col("kind") == kind) & F.col("codec").rlike("^" + begins)
    odd = tracks.where(~F.coalesce(known, F.lit(False)) | F.col("name").isNull()).select("name", "kind", "codec").limit(3).collect()
    twice = tracks.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").limit(3).collect()
    out = [f"track {r['name']!r} is of kind {r['kind']!r}: video, audio or data can be published" for r in odd if r["kind"] not in CODECS]
    out += ["a track has no name" for r in odd if r["kind"] in CODECS and r["name"] is None]
    out += [f"track {r['name']!r} is {r['kind']} of codec {r['codec']!r}: {CODECS[r['kind']][1]} can be published" for r in odd if r["kind"] in CODECS and r["name"] is not None]
    return out + [f"track {r['name']!r} is named {r['n']} times" for r in twice]


def grouped(frames: DataFrame, tracks: DataFrame, audio_group_ms: int) -> DataFrame:
    """frames (track, frame_no, pts_us, keyframe, payload) cut into groups, in the log's columns.

    Video is cut at keyframes, audio by elapsed time (every frame where audio_group_ms is 0), messages one by one.
    Every audio packet is a keyframe, whatever the wire said.
    """
    known = frames.join(tracks.select(F.col("name").alias("track"), "kind"), "track")
    video = logs.cut_keyframes(known.where("kind = 'video'"))
    audio = known.where("kind = 'audio'").withColumn("keyframe", F.lit(True))
    audio = logs.cut_elapsed(audio, logs.interval_ticks(audio_group_ms, 1, 1_000_000)) if audio_group_ms else logs.cut_fragments(audio)
    data = logs.cut_fragments(known.where("kind = 'data'"))
    names = ["track", "grp", "frame_no", "pts_us", "keyframe", "payload"]
    cut = video.select(names).unionByName(audio.select(names)).unionByName(data.select(names))
    # A group's frames are numbered in a row, so its first and last tell the rest.
    of_group = Window.partitionBy("track", "grp")
    first, last = F.min("frame_no").over(of_group), F.max("frame_no").over(of_group)
    return cut.select("track", "grp", (F.col("frame_no") - first).alias("frame_in_group"), "pts_us", "keyframe", F.col("payload").cast("binary").alias("payload"), (F.col("frame_no") == last).alias("last"))


def publish(frames: DataFrame, tracks: DataFrame, relay: str, broadcast: str, **params) -> DataFrame:
    """Writes frames (track, frame_no, pts_us, keyframe, payload) and the catalog of tracks; returns report rows.

    A track of another kind or codec, one named twice and a frame of a track that the catalog doesn't name are refused by
    name, before anything is written. The log is replaced by one commit, which opens a new session:
    readers see the old one or the new one, and a stream that follows the old one is told that the publisher has restarted.
    """
    p = checked(PUBLISH, params)
    if why := refused(tracks):
        raise ValueError("; ".join(why))
    lost = frames.select("track").distinct().join(tracks.select(F.col("name").alias("track")), "track", "left_anti").limit(3).collect()
    if lost:
        raise ValueError("; ".join(f"frames of track {r['track']!r}, which the catalog doesn't name" for r in lost))
    spark, base = frames.sparkSession, f"{relay.rstrip('/')}/{broadcast}"
    spark.dataSource.register(WireSource)
    wire = grouped(frames, tracks, p["audio_group_ms"]).repartition("track", F.floor(F.col("grp") / GROUPS)).sortWithinPartitions("track", "grp", "frame_in_group")
    send_catalog(tracks, relay, broadcast)
    wire.select(*FIELDS).write.format("tidemark_wire").option("path", base).mode("overwrite").save()
    groups = logs.group_rows(committed(spark, base))
    total = logs.trailing_row(groups).withColumn("kind", F.lit("trailing"))
    if p["rows"] == "groups":
        return groups.withColumn("kind", F.lit("group")).unionByName(total, allowMissingColumns=True)
    if p["rows"] == "summary":
        per = groups.groupBy("track").agg(F.count("*").alias("groups"), F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"), F.max("pts_end").alias("media"))
        return per.withColumn("kind", F.lit("track")).unionByName(total, allowMissingColumns=True)
    return total


def committed(spark: SparkSession, location: str) -> DataFrame:
    """The log's columns as of now, read by Spark's own Parquet reader: columns and rows that a query doesn't need are not read."""
    paths = [re.sub(r"([\[\]{}*?])", r"\\\1", f"{location}/{f.path}") for f in CommitLog(location).files()]  # what Spark's readers take for a pattern
    if not paths:
        return spark.createDataFrame([], LOG)
    body = ", ".join(c for c in LOG.split(", ")[1:])
    raw = spark.read.schema(body).parquet(*paths)
    track = F.url_decode(F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), r"/track=([^/]*)/[^/]*$", 1)))
    return raw.select(track.alias("track"), *FIELDS[1:])


def send_catalog(tracks: DataFrame, relay: str, broadcast: str) -> None:
    base = f"{relay.rstrip('/')}/{broadcast}"
    catalog.document(tracks.withColumn("broadcast", F.lit(broadcast))).select("document").coalesce(1).write.mode("overwrite").text(f"{base}/catalog")


def append(frames: DataFrame, relay: str, broadcast: str, session: bool = False) -> None:
    """Adds frames (the log's columns) to a broadcast's log, by one commit; session: the publisher has come back."""
    frames.sparkSession.dataSource.register(WireSource)
    frames.select(*FIELDS).write.format("tidemark_wire").option("path", f"{relay.rstrip('/')}/{broadcast}").option("session", str(session).lower()).mode("append").save()


def publish_stream(frames: DataFrame, relay: str, broadcast: str, checkpoint: str, trigger: dict | None = None, tracks: DataFrame | None = None, hold_s: float = 0):
    """Adds a stream of frames (the log's columns) to a broadcast's log; returns the running query.

    A micro-batch is a commit, and is told by the checkpoint and its number, so one that runs again adds nothing. Where the log has been
    written before, starting is coming back: a new session is opened, and the catalog of tracks, if given, is sent again.
    hold_s: nothing is published before a subscriber wants it, or so many seconds have passed.
    """
    base = f"{relay.rstrip('/')}/{broadcast}"
    if tracks is not None:
        if why := refused(tracks):
            raise ValueError("; ".join(why))
        send_catalog(tracks, relay, broadcast)
    wanted(base, hold_s)
    frames.sparkSession.dataSource.register(WireSource)
    log = CommitLog(base)
    if log.last():
        log.append([], session=True)
    out = frames.select(*FIELDS).writeStream.format("tidemark_wire").option("path", base).option("writer", checkpoint.rsplit("/", 1)[-1] + f"-{zlib.crc32(checkpoint.encode()):08x}").option("checkpointLocation", checkpoint)
    return out.trigger(**trigger).start() if trigger else out.start()


def wanted(location: str, hold_s: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, every_s: float = 0.25) -> str:
    """Waits until a subscriber wants the catalog and then a track, both by one deadline; returns 'wanted' or 'time'."""
    store, base = fs.FileSystem.from_uri(location)
    until = clock() + hold_s
    for sign in ("catalog", "track="):
        while clock() < until:
            asked = store.get_file_info(fs.FileSelector(f"{base}/wants", allow_not_found=True))
            if any(i.base_name.startswith(sign) for i in asked):
                break
            sleep(every_s)
        else:
            return "time"
    return "wanted"


def catalog_stream(tracks: DataFrame, relay: str, broadcast: str, checkpoint: str, every_s: float = 3):
    """Sends the catalog document again every so often, as a track of the log, each time under one more group number."""
    spark, base = tracks.sparkSession, f"{relay.rstrip('/')}/{broadcast}"
    spark.dataSource.register(WireSource)
    document = catalog.document(tracks.withColumn("broadcast", F.lit(broadcast))).select("document").first()["document"]  # one small document
    first = Progress(f"{checkpoint}.first")
    if first.get() is None:
        first.put({"grp": max((f.high for f in CommitLog(base).files() if f.track == CATALOG), default=-1) + 1})
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("startTimestamp", 0).option("advanceMillisPerBatch", int(every_s * 1000)).load()
    grp = F.col("value") + first.get()["grp"]
    rows = ticks.select(
        F.lit(CATALOG).alias("track"), grp.alias("grp"), F.lit(0).cast("long").alias("frame_in_group"), (F.unix_micros("timestamp")).alias("pts_us"), F.lit(True).alias("keyframe"),
        F.lit(document).cast("binary").alias("payload"), F.lit(True).alias("last"),
    )
    out = rows.writeStream.format("tidemark_wire").option("path", base).option("writer", f"catalog-{zlib.crc32(checkpoint.encode()):08x}").option("checkpointLocation", checkpoint)
    return out.trigger(processingTime=f"{every_s} seconds").start()


@dataclass
class Subscription:
    spark: SparkSession
    location: str
    params: dict

    def catalog(self, tries: int = 40, pause_s: float = 0.25) -> DataFrame:
        """(broadcast, document), waiting so many times for a publisher that isn't there yet."""
        store, base = fs.FileSystem.from_uri(self.location)
        for _ in range(tries):
            if store.get_file_info(f"{base}/catalog/_SUCCESS").type == fs.FileType.File:
                break
            time.sleep(pause_s)
        else:
            raise TimeoutError(f"no catalog at {self.location}")
        return self.spark.read.text(f"{self.location}/catalog").select(F.lit(self.location).alias("broadcast"), F.col("value").alias("document"))

    def renditions(self) -> DataFrame:
        return catalog.assigned(catalog.renditions(self.catalog()))

    def relation(self) -> DataFrame:
        """A row for each rendition; an empty catalog, and one that a reader refuses, fail."""
        found = self.renditions()
        bad = catalog.problems(found).limit(3).collect()
        if bad:
            raise ValueError("; ".join(f"rendition '{r['name']}': {r['problem']}" for r in bad))
        rel = catalog.relation(found)
        if rel.isEmpty():
            raise ValueError("the catalog names no rendition")
        return rel

    def want(self, tracks: list[str] | None = None) -> None:
        """Tells the publisher that the catalog, and these tracks if any, are wanted."""
        store, base = fs.FileSystem.from_uri(self.location)
        store.create_dir(f"{base}/wants", recursive=True)
        for name in ["catalog", *[f"track={quote(t, safe='')}" for t in tracks or []]]:
            store.open_output_stream(f"{base}/wants/{name}").close()

    def resent(self) -> DataFrame:
        """(grp, document): the catalog as often as it was sent along the log; `catalog.last_document` tells the one that stands."""
        return self.frames([CATALOG]).select(F.lit(self.location).alias("broadcast"), "grp", F.col("payload").cast("string").alias("document"))

    def frames(self, tracks: list[str] | None = None, stream: bool = False, **options) -> DataFrame:
        """The wire log, of the tracks that the query reads. options: a stream's max_files, max_mib and progress; paced, with speed and max_s."""
        self.spark.dataSource.register(WireSource)
        self.spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        reader = (self.spark.readStream if stream else self.spark.read).format("tidemark_wire").option("path", self.location).option("start", self.params["start"])
        if stream and tracks is not None:
            reader = reader.option("tracks", json.dumps(tracks))
        for k, v in options.items():
            reader = reader.option(k, str(v).lower() if isinstance(v, bool) else v)
        out = reader.load()
        return out.where(F.col("track") != CATALOG) if tracks is None else out.where(F.col("track").isin(*tracks))

    def events(self, stream: bool = True, tracks: list[str] | None = None, **options) -> DataFrame:
        """The wire log as wire events: every frame, and a group's end behind its last one.

        Events arrive in the order of commits and of rows in them. A decoder can begin at any group of audio or of
        messages, and at one of video whose first frame with a sample is a keyframe; a frame without one says nothing.
        """
        video = [r["name"] for r in self.renditions().where("kind = 'video'").select("name").distinct().collect()]  # the catalog's, one document
        opens = F.when(F.octet_length("payload") > 0, F.col("keyframe") | ~F.col("track").isin(*video))
        at = F.col("landed") * 2
        frame = F.struct(at.alias("arrival"), F.lit("frame").alias("event"), "grp", "frame_in_group", opens.alias("decodable"), "payload", "session")
        end = F.struct((at + 1).alias("arrival"), F.lit("end").alias("event"), "grp", F.col("frame_in_group"), F.lit(None).cast("boolean").alias("decodable"), F.lit(None).cast("binary").alias("payload"), "session")
        both = F.when(F.coalesce("last", F.lit(False)), F.array(frame, end)).otherwise(F.array(frame))
        return self.frames(tracks, stream, **options).select("track", F.explode(both).alias("e")).select("track", "e.*")

    def unchanged(self, progress: str) -> None:
        """Refuses a catalog that has drifted from the one that this run began with, which is noted where progress says."""
        spark, path = self.spark, f"{progress}/catalog"
        store, base = fs.FileSystem.from_uri(path)
        if store.get_file_info(f"{base}/_SUCCESS").type != fs.FileType.File:
            self.catalog().select("document").coalesce(1).write.mode("overwrite").text(path)
            return
        before = spark.read.text(path).select(F.lit(self.location).alias("broadcast"), F.col("value").alias("document"))
        apart = catalog.drift(catalog.renditions(before), catalog.renditions(self.catalog())).limit(3).collect()
        if apart:
            raise ValueError("; ".join(f"track {r['name']!r} is not what it was: {r['reason']}" for r in apart))

    def edge(self, tracks: list[str] | None = None) -> dict[str, int]:
        """The group with which each track is joined, as of the last commit, so that all begin at one media time."""
        there = committed(self.spark, self.location).where(F.col("track") != CATALOG if tracks is None else F.col("track").isin(*tracks))
        starts = there.groupBy("track", "grp").agg(F.min("pts_us").alias("pts_us"))
        return {r["track"]: r["grp"] for r in hold.shared_edge(starts).collect()}  # a row for each track

    def ordered(self, answers: DataFrame | None = None, progress: str | None = None, tracks: list[str] | None = None, shared_edge: bool = False, **options) -> DataFrame:
        """The broadcast's tracks in sequence with report rows, as a stream: held as start, hold_ms, hold_mib and join_ms say.

        answers: a stream of further wire events, such as `answered` makes of the rows of kind ask, and each track's
        restarted and finished. Without a finished event a track's last hole stays open until the budget is spent.
        progress: where a run notes its catalog, which it must find unchanged when it is resumed, and where a bounded reader is. A
        publisher that comes back opens a session: groups in flight may come again, and one that counts from anew fails the run.
        shared_edge: the tracks are joined at one media time; which groups that are is noted in progress, and holds when the run is resumed.
        """
        if shared_edge:
            note = Progress(f"{progress}/edge")
            if note.get() is None:
                note.put(self.edge(tracks))
            options = {"edge": json.dumps(note.get()), **options}
        if progress is not None:
            self.unchanged(progress)
            options = {"progress": progress, **options}
        came = self.events(tracks=tracks, **options)
        if answers is not None:
            more = answers if "session" in answers.columns else answers.withColumn("session", F.lit(None).cast("long"))
            came = came.unionByName(more.select(*came.columns))
        p = self.params
        return ordered.ordered(came, start=p["start"], wait_ms=p["hold_ms"], mib=p["hold_mib"], settle_ms=p["join_ms"])

    def answered(self, asks: DataFrame) -> DataFrame:
        """Wire events that answer asks (track, grp): the retained group, frame by frame, with its end, or that it is gone."""
        asked = asks.select("track", "grp").distinct()
        found = self.events(stream=False).join(asked, ["track", "grp"], "left_semi").withColumn("session", F.lit(None).cast("long"))
        gone = asked.join(found.select("track", "grp").distinct(), ["track", "grp"], "left_anti")
        none = lambda kind: F.lit(None).cast(kind)
        told = gone.select("track", F.lit(0).cast("long").alias("arrival"), F.lit("gone").alias("event"), "grp", none("long").alias("frame_in_group"), none("boolean").alias("decodable"), none("binary").alias("payload"), none("long").alias("session"))
        return found.unionByName(told)

    def missing(self, asks: DataFrame) -> DataFrame:
        """Answers to asks (track, seq) for groups outside the subscription."""
        return hold.fetch_lookup(asks, logs.group_rows(self.frames()))


def subscribe(spark: SparkSession, relay: str, broadcast: str, **params) -> Subscription:
    return Subscription(spark, f"{relay.rstrip('/')}/{broadcast}", checked(SUBSCRIBE, params))
