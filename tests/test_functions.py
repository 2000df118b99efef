import struct

import pytest
from pyspark.sql import functions as F

from tidemark.functions import address, codec, dns
from tidemark.operators import catalog, logs


def one(spark, expr, **lits):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in lits.items()])
    return row.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("v", "want"), [(0, "00"), (63, "3F"), (64, "4040"), (16383, "7FFF"), (16384, "80004000"), (2**30 - 1, "BFFFFFFF"), (2**30, "C000000040000000"), (18623457, "811C2BE1"), (2**62 - 1, "FFFFFFFFFFFFFFFF"), (1790208000123457, "C0065C2F47EBE241")])
def test_varint(spark, v, want):
    got = one(spark, F.hex(codec.varint(F.col("v"))), v=v)
    assert got == want
    assert one(spark, codec.frame_pts(codec.frame(F.col("v"), F.lit(b"{}"))), v=v) == v


def test_varint_refuses(spark):
    for v in (-1, 2**62):
        with pytest.raises(Exception, match="62 bits"):
            one(spark, codec.varint(F.col("v")), v=v)
    for short in ("", "40", "9d7f3e"):
        with pytest.raises(Exception, match="ends in its pts"):
            one(spark, codec.frame_pts(F.unhex("h")), h=short)
    assert one(spark, codec.frame_pts(F.unhex("h")), h="9d7f3e7d7b7d") == 494878333
    assert bytes(one(spark, codec.frame_body(F.unhex("h")), h="9d7f3e7d7b7d")) == b"{}"


def test_bytes(spark):
    assert bytes(one(spark, codec.from_hex(F.col("h")), h=" 0aFF ")) == b"\x0a\xff"
    for bad in ("abc", "zz"):
        with pytest.raises(Exception, match="not hex"):
            one(spark, codec.from_hex(F.col("h")), h=bad)
    assert "\n" not in one(spark, codec.to_base64(F.col("b")), b=bytes(200))
    for text in ("AAE", "AAE="):
        assert bytes(one(spark, codec.from_base64(F.col("t")), t=text)) == b"\0\x01"
    for bad in ("A", "A*=="):
        with pytest.raises(Exception, match="not base64"):
            one(spark, codec.from_base64(F.col("t")), t=bad)


def test_ticks(spark):
    assert logs.interval_ticks(200, 1, 48000) == 9600 and logs.interval_ticks(0, 1, 48000) == 1 and logs.interval_ticks(200, 0, 0) == 1
    assert one(spark, codec.message_timescale(F.lit(1), F.lit(90000))) == 90000 and one(spark, codec.message_timescale(F.lit(1001), F.lit(30000))) == 1_000_000
    assert one(spark, codec.rescale(F.lit(3), F.lit(1), F.lit(2), F.lit(1), F.lit(1))) == 2
    assert one(spark, codec.aac_duration_us(F.lit(48000))) == 21333 and one(spark, codec.aac_duration_us(F.lit(0))) is None
    assert one(spark, codec.h264_keyframe(F.unhex(F.lit("0000000167AA0000000165BB")))) and not one(spark, codec.h264_keyframe(F.unhex(F.lit("000000014188"))))
    with pytest.raises(Exception, match="codec not taken"):
        one(spark, codec.codec_of(F.lit("opus")))


@pytest.mark.parametrize(("step", "starts"), [(200, [0, 10, 20, 30]), (1000, [0]), (100, [0, 5, 10, 15, 20, 25, 30, 35])])
def test_groups_of_aac(spark, step, starts):
    frames = spark.range(40).select(F.lit("a").alias("track"), F.col("id").alias("frame_no"), (F.col("id") * 1024).alias("pts_us"), F.lit("x").alias("payload"))
    ticks = logs.interval_ticks(step, 1, 48000)
    cut = logs.cut_elapsed(frames, ticks)
    assert sorted(r[0] for r in cut.groupBy("grp").agg(F.min("frame_no")).select("min(frame_no)").collect()) == starts
    same = logs.cut_regular(frames, ticks, 1024).select("frame_no", "grp")
    assert cut.select("frame_no", "grp").exceptAll(same).count() == 0


def test_running_sum_over_chunks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    got = logs.running_sum(df, "k", "o", F.lit(1), "n", chunk=7).collect()
    assert all(r["n"] == r["o"] // 3 + 1 for r in got)


def test_addresses_fail_by_name(spark):
    for url, token, why in (("https://r/a#b", "", "fragment"), ("https://r/a", "b", "two tokens"), ("r:x", "", "not a port")):
        with pytest.raises(Exception, match=why) as e:
            one(spark, address.session_path_or_fail(F.lit(url), F.lit(token)))
        assert "/a" not in str(e.value).split("relay '")[1].split("'")[0]


def test_dns():
    q = dns.question("relay.example")
    assert q.endswith(b"\x05relay\x07example\x00\x00\x01\x00\x01")
    for bad in ("", "a..b", "x" * 64 + ".com", ".".join(["abcdefgh"] * 30)):
        with pytest.raises(ValueError):
            dns.question(bad)
    rr = lambda kind, data: b"\xc0\x0c" + struct.pack(">2HIH", kind, 1, 60, len(data)) + data
    head = lambda n, code=0: struct.pack(">6H", 0, 0x8180 | code, 1, n, 0, 0) + q[12:]
    answer = head(3) + rr(28, bytes(15) + b"\x01") + rr(5, b"\x01a\x00") + rr(1, b"\x7f\0\0\1")
    assert dns.addresses(answer) == ["127.0.0.1", "::1"]
    assert dns.addresses(head(0, dns.NXDOMAIN)) == []
    for bad in (head(0, 2), answer[:-2], head(1) + b"\xc0"):
        with pytest.raises(ValueError):
            dns.addresses(bad)


def test_pick_and_last_document(spark):
    docs = spark.createDataFrame([("b", 1, '{"video":{"renditions":{"old":{"codec":"avc1"}}}}'), ("b", 2, '{"video":{"renditions":{"hd":{"codec":"avc1"},"sd":{"codec":"avc1"}}},"clock":{}}')], "broadcast string, grp long, document string")
    found = catalog.renditions(catalog.last_document(docs))
    assert [r["name"] for r in catalog.pick(found, index=1).collect()] == ["sd"] and catalog.pick(found, "hd").count() == 1
    with pytest.raises(ValueError, match="no track 'x'"):
        catalog.pick(found, "x")
    assert {r["priority"] for r in catalog.by_priority(found).collect()} == {60}
