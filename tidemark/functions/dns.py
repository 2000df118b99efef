"""DNS messages: a question's bytes, and the addresses in an answer."""

from __future__ import annotations

import ipaddress
import struct

# Fixed values of the protocol.
A, AAAA, IN, NXDOMAIN = 1, 28, 1, 3
LABEL, NAME, JUMPS = 63, 253, 16


def question(name: str, kind: int = A) -> bytes:
    """A recursive question for one name. Labels have 1 to 63 bytes, a name 253 at most."""
    plain = name.removesuffix(".")
    if not plain or len(plain.encode()) > NAME:
        raise ValueError(f"not a name: {name!r}")
    labels = [x.encode() for x in plain.split(".")]
    if any(not 1 <= len(x) <= LABEL for x in labels):
        raise ValueError(f"a label of {name!r} has no byte or more than {LABEL}")
    return struct.pack(">6H", 0, 0x0100, 1, 0, 0, 0) + b"".join(bytes([len(x)]) + x for x in labels) + b"\0" + struct.pack(">2H", kind, IN)


def _after_name(data: bytes, at: int) -> int:
    """Where a name that begins at at ends; a pointer ends it."""
    for _ in range(NAME):
        n = data[at]
        if n == 0:
            return at + 1
        if n >> 6 == 3:
            _checked_pointer(data, at)
            return at + 2
        at += 1 + n
    raise ValueError("a name without end")


def _checked_pointer(data: bytes, at: int) -> None:
    for _ in range(JUMPS):
        if data[at] >> 6 != 3:
            return
        at = (data[at] & 0x3F) << 8 | data[at + 1]
    raise ValueError("a name's pointers go round")


def addresses(answer: bytes) -> list[str]:
    """The addresses of an answer, IPv4 first; none where the name doesn't exist."""
    try:
        _, flags, questions, answers, _, _ = struct.unpack_from(">6H", answer)
        code = flags & 0xF
        if code == NXDOMAIN:
            return []
        if code:
            raise ValueError(f"the resolver answers with error {code}")
        at = 12
        for _ in range(questions):
            at = _after_name(answer, at) + 4
        found: list[bytes] = []
        for _ in range(answers):
            at = _after_name(answer, at)
            kind, _, _, size = struct.unpack_from(">2HIH", answer, at)
            data = answer[at + 10 : at + 10 + size]
            if (kind, size) in ((A, 4), (AAAA, 16)):
                if len(data) < size:
                    raise ValueError("the answer is cut short")
                found.append(data)
            at += 10 + size
    except (IndexError, struct.error):
        raise ValueError("the answer is cut short") from None
    return [str(ipaddress.ip_address(d)) for d in sorted(found, key=len)]
