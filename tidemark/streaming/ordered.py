"""A stream of wire events restored to sequence, track by track."""

from __future__ import annotations

import heapq
import json
import pickle
import tempfile
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.hold import COUNTS, MAXIMA, Group, Hold, Shelf, Spans

#: Wire events: frame, end, group (a fetched frame; its end follows), gone, restarted, finished. A column session may tell the publisher's session.
EVENTS = "track string, arrival long, event string, grp long, frame_in_group long, decodable boolean, payload binary"
ROWS = (
    "track string, kind string, grp long, payload binary, `cursor` long, from_grp long, to_grp long, reason string, held_groups long, held_bytes long, "
    + ", ".join(f"{c} long" for c in [*COUNTS, *MAXIMA]) + ", first_grp long, last_grp long, final boolean"
)
COLUMNS = [c.strip().split(" ")[0].strip("`") for c in ROWS.split(",")]
#: A track's totals are told this often.
REPORT_MS = 5000
#: Events that a task sorts at once; those laid aside that it reads at once, of each run; rows that it hands on at once. Of each so many bytes at most, or one.
RUN, READ, GIVEN = (1 << 14, 16 << 20), (1 << 8, 1 << 20), (1 << 12, 16 << 20)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def apply(hold: Hold, event: dict) -> None:
    """One wire event."""
    kind, seq = event["event"], event["grp"]
    payload = b"" if event["payload"] is None else bytes(event["payload"])
    decodable = None if pd.isna(event["decodable"]) else bool(event["decodable"])
    if kind in ("frame", "group"):
        session, nth = event.get("session"), event.get("frame_in_group")
        hold.arrived(None if pd.isna(session) else int(session), int(seq))
        hold.frame(int(seq), payload, decodable, None if pd.isna(nth) else int(nth))
    elif kind == "end":
        hold.end(int(seq))
    elif kind == "gone":
        hold.refuse(int(seq))
    elif kind == "restarted":
        hold.restart()
    elif kind == "finished":
        hold.finish()
    else:
        raise ValueError(f"no such wire event: {kind}")


def told(track: str, hold: Hold, now: float, last: bool) -> list[dict]:
    frames, rows, asks = hold.take(now)
    out = [{"kind": "frame", "grp": g, "payload": p} for g, p in frames]
    for r in rows:
        out.append({"kind": r["kind"], "grp": r.get("group"), "cursor": r.get("cursor"), "from_grp": r.get("from"), "to_grp": r.get("to"), "reason": r.get("reason"), "held_groups": r.get("held_groups"), "held_bytes": r.get("held_bytes")})
    out += [{"kind": "ask", "grp": a} for a in asks]
    t = hold.track_row(final=True) if last else hold.report(now, REPORT_MS)
    if t:
        out.append({"kind": "track", **{c: t[c] for c in [*COUNTS, *MAXIMA]}, "first_grp": t["first"], "last_grp": t["last"], "final": t["final"]})
    return [{"track": track, **r} for r in out]


def framed(rows: list[dict]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=COLUMNS).astype(object)
    return df.where(df.notna(), None)


def pieces(rows: Iterator[dict], count: int, size: int) -> Iterator[list[dict]]:
    """rows in lists of so many, and of so many bytes of payload, at most."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += len(row.get("payload") or b"")
        if len(out) >= count or held >= size:
            yield out
            out, held = [], 0
    if out:
        yield out


def in_order(came: Iterator[pd.DataFrame], run: tuple[int, int] | None = None) -> Iterator[dict]:
    """Events in the order of arrival, of equal ones as they came. They are sorted in runs; where there are several, runs are laid aside and merged."""

    def place(event: dict) -> tuple:
        at = event["arrival"]
        return pd.isna(at), at

    events = (event for rows in came for event in rows.to_dict("records"))
    runs = pieces(events, *(run or RUN))
    first, second = (sorted(r, key=place) for r in (next(runs, []), next(runs, [])))
    if not second:
        yield from first
        return
    with tempfile.TemporaryFile() as file:

        def aside(rows: list[dict]) -> tuple[int, int]:
            began = file.seek(0, 2)
            for piece in pieces(iter(rows), *READ):
                pickle.dump(piece, file)
            return began, file.tell()

        def read(at: int, end: int) -> Iterator[dict]:
            while at < end:
                file.seek(at)
                piece = pickle.load(file)
                at = file.tell()
                yield from piece

        spans = [aside(first), aside(second)]
        del first, second
        spans += [aside(sorted(r, key=place)) for r in runs]
        yield from heapq.merge(*(read(*span) for span in spans), key=place)


GROUP = "frames array<struct<nth: long, payload: binary>>, taken array<long>, sent long, over boolean, sync boolean, retaken boolean, again long"


class Ordering(StatefulProcessor):
    """The hold as a stateful processor: one state for each held group, one for the rest; its timer is the moment that the hold waits for."""

    def __init__(self, **options):
        self.options = options

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mind = handle.getValueState("mind", "data string")
        self.groups = handle.getMapState("groups", "grp long", GROUP)

    def _hold(self) -> Hold:
        kept = self.mind.get()
        if kept is None:
            return Hold(**self.options)

        def read(number: int) -> Group:
            frames, taken, *rest = self.groups.getValue((number,))
            return Group([(n, bytes(f)) for n, f in frames], Spans(taken), *rest)

        known = json.loads(kept[0])
        return Hold.of(known["hold"], Shelf(Spans(known["held"]), read))

    def _keep(self, hold: Hold) -> None:
        for number in hold.shelf.touched:
            if number in hold.shelf:
                g = hold.shelf.loaded[number]
                self.groups.updateValue((number,), (g.frames, g.taken.borders, g.sent, g.over, g.sync, g.retaken, g.again))
            else:
                self.groups.removeKey((number,))
        held = Spans()
        for number in hold.shelf:
            held.add(number)
        self.mind.update((json.dumps({"hold": hold.scalars(), "held": held.borders}),))
        for timer in list(self.handle.listTimers()):  # another would fire beside, not instead
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        if not hold.ended:
            self.handle.registerTimer(int(min(x for x in (hold.due(), (hold.reported or 0) + REPORT_MS) if x is not None)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        began = time.perf_counter()
        hold, now = self._hold(), float(timerValues.getCurrentProcessingTimeInMs())
        hold.call(now)

        def rows_out() -> Iterator[dict]:
            for event in in_order(rows):
                apply(hold, event)
                yield from told(key[0], hold, now, last=event["event"] == "finished")

        for out in pieces(rows_out(), *GIVEN):
            yield framed(out)
        hold.call(now, (time.perf_counter() - began) * 1000)
        self._keep(hold)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        hold, now = self._hold(), float(timerValues.getCurrentProcessingTimeInMs())
        out = told(key[0], hold, now, last=False)
        self._keep(hold)
        yield framed(out)

    def close(self) -> None:
        pass


def ordered(events: DataFrame, **options) -> DataFrame:
    """events (EVENTS, streaming) in sequence with report rows (ROWS). Options are Hold's."""
    Hold(**options)  # refuses what it doesn't know
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return events.groupBy("track").transformWithStateInPandas(statefulProcessor=Ordering(**options), outputStructType=ROWS, outputMode="append", timeMode="ProcessingTime")
