"""Pacing against a live clock: one group at a time is under way.

The next group leaves once the one before is delivered and GAP has passed since it
was finished; at CAP after that whatever happens, and at once if more than DEPTH
groups wait or nobody subscribes. A group that nobody took counts as delivered
UNTAKEN after it was finished. A group that waits goes on gathering frames.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

from tidemark.operators.pacing import CAP, DEPTH, GAP

#: Milliseconds after which a group that no subscriber took counts as delivered; a fixed value.
UNTAKEN = 50


@dataclass
class Waiting:
    grp: int
    cut: float
    frames: list = field(default_factory=list)
    closed: bool = False


class Pacer:
    def __init__(self):
        self.queue: deque[Waiting] = deque()
        self.flying: int | None = None
        self.finished: float | None = None
        self.taken = self.delivered = False
        self.queue_max = self.unpaced = 0
        self.wait_max = 0.0

    def open(self, grp: int, now: float) -> None:
        self.queue.append(Waiting(grp, now))
        self.queue_max = max(self.queue_max, len(self.queue))

    def write(self, frame: bytes) -> None:
        self.queue[-1].frames.append(frame)

    def close(self) -> None:
        self.queue[-1].closed = True

    def take(self, grp: int) -> None:
        """A subscriber has begun to take the group."""
        self.taken |= grp == self.flying

    def deliver(self, grp: int) -> None:
        """The relay has acknowledged the group."""
        self.delivered |= grp == self.flying

    def release(self, now: float, subscribed: bool = True) -> list[tuple[int, list]]:
        """(group, frames) that leave as of now."""
        out = []
        while self.queue and self.queue[0].closed:
            since = None if self.finished is None else now - self.finished
            done = self.flying is None or self.delivered or (not self.taken and since >= UNTAKEN)
            in_turn = since is None or done and since >= GAP
            if not (in_turn or not subscribed or since >= CAP or len(self.queue) > DEPTH):
                break
            g = self.queue.popleft()
            self.unpaced += subscribed and not in_turn
            self.wait_max = max(self.wait_max, now - g.cut)
            self.flying, self.finished, self.taken, self.delivered = g.grp, now, False, False
            out.append((g.grp, g.frames))
        return out

    def drain(self, now: float) -> list[tuple[int, list]]:
        """What is left, at the end."""
        for g in self.queue:
            g.closed = True
        return self.release(now, subscribed=False)
