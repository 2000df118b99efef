"""Scalars of frames, catalogs and codecs, as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

MOST = (1 << 62) - 1


def to_hex(data: Column) -> Column:
    """Lower-case hex digits."""
    return F.lower(F.hex(data))


def from_hex(text: Column) -> Column:
    """Bytes of hex digits, trimmed; an odd number of digits or another character is an error."""
    t = F.trim(text)
    bad = (F.length(t) % 2 != 0) | ~t.rlike("^[0-9A-Fa-f]*$")
    return F.when(bad, F.raise_error(F.concat(F.lit("not hex: "), t)).cast("binary")).otherwise(F.unhex(t))


def to_base64(data: Column) -> Column:
    """Standard alphabet, padded, in one line."""
    return F.regexp_replace(F.base64(data), "[\\r\\n]", "")


def from_base64(text: Column) -> Column:
    """Padding may be left out; one digit over a multiple of four is an error."""
    t = F.rtrim(F.trim(text), F.lit("="))
    bad = (F.length(t) % 4 == 1) | ~t.rlike("^[A-Za-z0-9+/]*$")
    return F.when(bad, F.raise_error(F.concat(F.lit("not base64: "), t)).cast("binary")).otherwise(F.unbase64(t))


def to_base64url(data: Column) -> Column:
    """URL alphabet without padding."""
    return F.translate(F.rtrim(to_base64(data), F.lit("=")), "+/", "-_")


def varint(value: Column) -> Column:
    """Bytes of a variable-length integer: the first two bits tell the size, 1, 2, 4 or 8 bytes."""
    def sized(n: int, mark: int) -> Column:
        return F.unhex(F.lpad(F.hex(value.bitwiseOR(F.lit(mark << (8 * n - 2)).cast("long"))), 2 * n, "0"))

    # The mark 3 of eight bytes is the sign's: as a long it is 3 << 62 less 1 << 64.
    eight = F.unhex(F.lpad(F.hex(value.bitwiseOR(F.lit((3 << 62) - (1 << 64)).cast("long"))), 16, "0"))
    over = (value < 0) | (value > MOST)
    return (
        F.when(over, F.raise_error(F.lit("a varint holds 62 bits")).cast("binary"))
        .when(value < 1 << 6, sized(1, 0)).when(value < 1 << 14, sized(2, 1)).when(value < 1 << 30, sized(4, 2)).otherwise(eight)
    )


def varint_size(frame: Column) -> Column:
    first = F.conv(F.hex(F.substring(frame, 1, 1)), 16, 10).cast("int")
    return F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4), F.lit(8)), F.shiftright(first, 6) + 1)


def frame(pts: Column, body: Column) -> Column:
    """A message's frame: its pts as a varint, then its body."""
    return F.concat(varint(pts), body)


def frame_pts(data: Column) -> Column:
    """The pts of a frame; a short frame is an error."""
    n = varint_size(data)
    short = (F.length(data) == 0) | (F.length(data) < n)
    digits = F.hex(F.substring(data, F.lit(1), n))
    first = F.conv(F.substring(digits, 1, 2), 16, 10).cast("int").bitwiseAND(0x3F)
    rest = F.concat(F.lpad(F.hex(first), 2, "0"), F.substring(digits, F.lit(3), 2 * n - 2))
    return F.when(short, F.raise_error(F.lit("a frame ends in its pts")).cast("long")).otherwise(F.conv(rest, 16, 10).cast("long"))


def frame_body(data: Column) -> Column:
    return F.substring(data, varint_size(data) + 1, F.length(data))


def message_timescale(num: Column, den: Column) -> Column:
    return F.when((num == 1) & (den > 0), den).otherwise(F.lit(1_000_000))


def seconds(ticks: Column, num: Column, den: Column) -> Column:
    return ticks * num / den


def aac_codec(config: Column) -> Column:
    """mp4a.40.N: the object type of an audio configuration; 31 escapes to 32 and six bits more."""
    bits = F.lpad(F.conv(F.hex(F.substring(config, 1, 2)), 16, 2), F.length(F.substring(config, 1, 2)) * 8, "0")
    plain = F.conv(F.substring(bits, 1, 5), 2, 10).cast("int")
    long = F.conv(F.substring(bits, 6, 6), 2, 10).cast("int") + 32
    return F.when(F.length(config) == 0, "mp4a.40").otherwise(F.concat(F.lit("mp4a.40."), F.when(plain == 31, long).otherwise(plain).cast("string")))


def codec_of(name: Column) -> Column:
    """The codec a name stands for; others are refused."""
    head = F.split_part(name, F.lit("."), F.lit(1))
    return (
        F.when(head.isin("avc1", "avc3"), "h264").when(head.isin("hev1", "hvc1"), "hevc").when(head == "av01", "av1")
        .when(name.startswith("mp4a.40."), "aac").otherwise(F.raise_error(F.concat(F.lit("codec not taken: "), name)).cast("string"))
    )


def avc_profile_level(name: Column) -> Column:
    """(profile, level): bytes 1 and 3 of the six hex digits after the first dot; else null."""
    digits = F.split_part(name, F.lit("."), F.lit(2))
    at = lambda i: F.conv(F.substring(digits, i, 2), 16, 10).cast("int")
    return F.when(digits.rlike("^[0-9A-Fa-f]{6}$"), F.struct(at(1).alias("profile"), at(5).alias("level")))


def aac_duration_us(rate: Column) -> Column:
    """Microseconds of a frame of 1024 samples; null without a rate."""
    return F.when(rate > 0, F.floor(F.lit(1024 * 1_000_000) / rate).cast("long"))


def _nal_heads(sample: Column) -> Column:
    """The first byte of each unit of an Annex B sample."""
    # The hex text is parted into bytes, so that a start code never begins in the middle of one.
    units = F.transform(F.split(F.regexp_replace(F.hex(sample), "(..)", "$1 "), "(?:00 )?00 00 01 "), lambda u: F.replace(u, F.lit(" "), F.lit("")))
    units = F.slice(units, 2, F.size(units))  # what stands before the first start code is no unit
    return F.transform(F.filter(units, lambda u: F.length(u) >= 2), lambda u: F.conv(F.substring(u, 1, 2), 16, 10).cast("int"))


def h264_keyframe(sample: Column) -> Column:
    """Whether an Annex B sample holds an IDR unit."""
    return F.exists(_nal_heads(sample), lambda h: h.bitwiseAND(31) == 5)


def hevc_keyframe(sample: Column) -> Column:
    """Whether an Annex B sample holds a random access unit (types 16 to 23)."""
    return F.exists(_nal_heads(sample), lambda h: F.shiftright(h, 1).bitwiseAND(63).between(16, 23))


def sequence_header(sample: bytes) -> bool:
    """Whether one of a sample's OBUs is a sequence header; a sample that breaks off is none."""
    at, found = 0, False
    while at < len(sample):
        head, at = sample[at], at + 1
        at += head >> 2 & 1
        size = shift = 0
        if head >> 1 & 1:
            while True:
                if at >= len(sample) or shift > 49:
                    return False
                byte, at = sample[at], at + 1
                size |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    break
        else:
            size = len(sample) - at
        at += size
        found |= head >> 3 & 15 == 1
    return found and at == len(sample)


def av1_keyframe(sample: Column) -> Column:
    """Whether an AV1 sample holds a sequence header."""

    def scanned(samples: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else sequence_header(s) for s in samples], dtype=object)

    return F.pandas_udf(scanned, BooleanType())(sample)


def keyframe(codec: Column, sample: Column) -> Column:
    """Whether a decoder can begin at a sample; audio always can, and an unknown codec's is null."""
    return F.when(codec == "aac", True).when(codec == "h264", h264_keyframe(sample)).when(codec == "hevc", hevc_keyframe(sample)).when(codec == "av1", av1_keyframe(sample))


def message_kind(body: Column) -> Column:
    """The kind field of a message; null where the body is no JSON object that has one."""
    return F.get_json_object(body.cast("string"), "$.kind")


def message_start(body: Column) -> Column:
    """The start_pts field of a message, in seconds."""
    return F.get_json_object(body.cast("string"), "$.start_pts").cast("double")


def strip_audio(name: Column) -> Column:
    return F.regexp_replace(name, "[.]audio$", "")


def numbered(base: Column, n: Column) -> Column:
    return F.when(n == 1, base).otherwise(F.concat(base, F.lit("."), (n - 1).cast("string")))


def rescale(ticks: Column, num: Column, den: Column, to_num: Column, to_den: Column) -> Column:
    """Ticks of one time base in another, to the nearest; halves go up."""
    top, low = ticks * num * to_den, den * to_num
    return F.floor((2 * top + low) / (2 * low)).cast("long")


def legacy_sample(data: Column) -> Column:
    """The sample of a frame with its pts in front; null where there is none."""
    body = frame_body(data)
    return F.when(F.length(body) > 0, body)
