"""Single cases of codecs, samples, catalogs and addresses, by value."""

import random
import re

from pyspark.sql import functions as F

from tidemark.functions import address, codec
from tidemark.operators import catalog
from tidemark.plans.queries import BROKEN

# What is put in, and what comes out.
SAMPLES = [
    ("h264", "0000000165aa", True), ("h264", "00000109f0000001419a", False), ("hevc", "000000014001000000012801", True), ("hevc", "000000010201", False), ("hevc", "0010000120", False), ("av1", "12000a020000", True),
    ("av1", "120032020000", False), ("av1", "0a05", False), ("aac", "21", True), ("opus", "00", None),
]
ADDRESSES = [
    ("quic://relay.example:4443", "", "", None), ("relay.example", "abc", "/abc", None), ("https://relay.example/tok", "", "/tok", None), ("https://relay.example/tok", "tok", "/tok", None),
    ("https://relay.example/tok", "other", None, "two tokens"), ("https://relay.example/root?jwt=t1", "t1", "/root?jwt=t1", None), ("https://relay.example/root?jwt=t1", "t2", None, "two tokens"),
    ("https://relay.example/?jwt=", "t", "/?jwt=", None), ("https://relay.example/a#b", "", None, "fragment"), ("https://relay.example/?Token=x", "", None, "token parameter"),
    ("relay.example:99999", "", None, "not a port"), ("https://[::1]:443/x", "", "/x", None), ("[::1]", "", "", None), ("https:///x", "", None, "no host"), ("relay.example:abc", "", None, "not a port"),
]
PARTS = [("quic://h:1/a?b#c", "quic://h:1/...?...#...", "h", 1, "abcdefghijklm", "abcd...jklm"), ("h", "h", "h", 443, "short", "5 characters"), ("https://[2001:db8::1]/t", "https://[2001:db8::1]/...", "2001:db8::1", 443, "twelve chars", "12 characters")]
CONFIGS = [("1190", "mp4a.40.2"), ("2b92", "mp4a.40.5"), ("f8c0", "mp4a.40.38"), ("", "mp4a.40")]
NAMES = [("avc1.64001f", "h264", 100, 31), ("avc3.42C01E", "h264", 66, 30), ("hev1.1.6.L93", "hevc", None, None), ("hvc1", "hevc", None, None), ("av01.0.04M.08", "av1", None, None), ("mp4a.40.2", "aac", None, None)]
PROBLEMS = {(1, "v", "no description"), (2, "a", "no container"), (3, "v", "container not taken"), (4, "d", "timescale"), (5, "d", "data is legacy"), (6, "v", "no init")}


def test_samples(spark):
    rows = spark.createDataFrame([(c, s) for c, s, _ in SAMPLES], "codec string, sample string")
    got = rows.select("codec", "sample", codec.keyframe(F.col("codec"), F.unhex("sample")).alias("k")).collect()
    assert {tuple(r) for r in got} == set(SAMPLES)


def test_addresses(spark):
    rows = spark.createDataFrame([a[:2] for a in ADDRESSES], "url string, token string").withColumn("p", address.parts(F.col("url")))
    got = rows.select("url", "token", address.session_path(F.col("p"), F.col("token")), address.refusal(F.col("p"), F.col("token"))).collect()
    assert {tuple(r) for r in got} == set(ADDRESSES)
    rows = spark.createDataFrame([(a[0], a[4]) for a in PARTS], "url string, token string").withColumn("p", address.parts(F.col("url")))
    got = rows.select("url", address.shown(F.col("p")), "p.host", "p.port", "token", address.shorten(F.col("token"))).collect()
    assert {tuple(r) for r in got} == set(PARTS)


def test_codec_names(spark):
    rows = spark.createDataFrame([c[:1] for c in CONFIGS], "config string")
    assert {tuple(r) for r in rows.select("config", codec.aac_codec(codec.from_hex(F.col("config")))).collect()} == set(CONFIGS)
    pl = codec.avc_profile_level(F.col("name"))
    rows = spark.createDataFrame([n[:1] for n in NAMES], "name string")
    assert {tuple(r) for r in rows.select("name", codec.codec_of(F.col("name")), pl["profile"], pl["level"]).collect()} == set(NAMES)


def test_refused_catalogs(spark):
    rows = spark.createDataFrame(list(BROKEN.items()), "broadcast long, document string")
    assert {tuple(r) for r in catalog.problems(catalog.renditions(rows)).collect()} == PROBLEMS


def test_ports_of_broadcasts_of_any_size(spark):
    """Ports as if told one after the other, also where an index's port is a later name, or the end of a longer one."""
    rng, rows, want = random.Random(2), [], {}
    end = lambda: rng.choice(["-1", "-3", "-12", "-007", "--4", "--", "-0", "-", "-99999999999999999999"])
    for b in [*range(60), None]:
        given = set()
        for o in sorted(rng.sample(range(-6, 24), 20)):
            name = None if rng.random() < 0.05 else rng.choice(["", "a", "a", "a b", "é"]) + "".join(end() for _ in range(rng.choice([0, 0, 1, 2, 3])))
            safe = re.sub("[^A-Za-z0-9_-]", "_", name or "")
            port = f"{safe}-{o}" if not safe or safe in given else safe
            given.add(port)
            rows.append((b, o, name))
            want[b, o] = port
    rng.shuffle(rows)
    got = catalog.ports(spark.createDataFrame(rows, "broadcast long, ordinal int, name string")).collect()
    assert {(r["broadcast"], r["ordinal"]): r["port"] for r in got} == want and len(got) == len(rows)


def test_ports_are_not_folded_by_broadcast(spark):
    """A fold over a broadcast's tracks looks at all that were given before, for each."""
    rows = spark.range(10).selectExpr("0L as broadcast", "cast(id as int) as ordinal", "'a' as name")
    plan = catalog.ports(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert not [a for a in plan.split("\n") if "collect_list" in a and "ordinal" in a]
