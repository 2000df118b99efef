"""Catalog documents: write, read, row assignment, names, ports, relation.

A broadcast's catalog is one small JSON document; a table of them has a column
`broadcast` that keeps them apart, and every step below works on all at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import codec

RENDITION = "struct<codec:string,container:struct<kind:string,init:string>,description:string,codedWidth:int,codedHeight:int,sampleRate:int,numberOfChannels:int,jitter:int,timescale:int>"
DOCUMENT = f"struct<video:struct<renditions:map<string,{RENDITION}>>,audio:struct<renditions:map<string,{RENDITION}>>,data:struct<renditions:map<string,{RENDITION}>>>"
SECTIONS = ["video", "audio", "data"]
#: Priorities of the tracks on the wire; fixed values.
PRIORITY = {"catalog": 100, "data": 90, "audio": 80, "video": 60}
AUDIO_JITTER = 600


def document(tracks: DataFrame) -> DataFrame:
    """(broadcast, document) of tracks (broadcast, kind, name, codec, packaging, config, init, width, height, sample_rate, channels, timescale).

    Maps are in the order of names, descriptions are hex, init segments base64;
    a broadcast without data tracks has no data section.
    """
    container = F.struct(F.col("packaging").alias("kind"), F.when(F.col("init").isNotNull(), codec.to_base64(F.col("init"))).alias("init"))
    base = [F.col("codec"), container.alias("container"), F.when(F.col("config").isNotNull(), codec.to_hex(F.col("config"))).alias("description")]
    own = {
        "video": [F.col("width").alias("codedWidth"), F.col("height").alias("codedHeight")],
        "audio": [F.col("sample_rate").alias("sampleRate"), F.col("channels").alias("numberOfChannels"), F.lit(AUDIO_JITTER).alias("jitter")],
        "data": [F.col("timescale")],
    }
    entry = F.coalesce(*[F.when(F.col("kind") == k, F.to_json(F.struct(*base, *own[k]))) for k in SECTIONS])
    named = tracks.select("broadcast", "kind", "name", entry.alias("entry"))
    listed = F.to_json(F.array("name"))
    quoted = F.substring(listed, F.lit(2), F.length(listed) - 2)
    pair = F.struct("name", F.concat(quoted, F.lit(":"), F.col("entry")).alias("text"))
    per = named.groupBy("broadcast").agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == k, pair))).alias(k) for k in SECTIONS])

    def section(k: str) -> Column:
        return F.concat(F.lit(f'"{k}":{{"renditions":{{'), F.array_join(F.transform(k, lambda e: e["text"]), ","), F.lit("}}"))

    data = F.when(F.size("data") > 0, F.concat(F.lit(","), section("data"))).otherwise("")
    return per.select("broadcast", F.concat(F.lit("{"), section("video"), F.lit(","), section("audio"), data, F.lit("}")).alias("document"))


def renditions(documents: DataFrame) -> DataFrame:
    """One row for each rendition of (broadcast, document): ordinal from 0 in reading order, kind, name and its fields.

    Sections are read in the order video, audio, data, each by name; other sections are passed over.
    """
    doc = documents.select("broadcast", F.from_json("document", DOCUMENT).alias("d"))
    parts = [
        doc.select("broadcast", F.lit(i).alias("section"), F.lit(k).alias("kind"), F.explode(F.map_entries(f"d.{k}.renditions")).alias("e")) for i, k in enumerate(SECTIONS)
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    flat = every.select(
        "broadcast", "section", "kind", F.col("e.key").alias("name"), F.col("e.value.codec").alias("codec"), F.col("e.value.container.kind").alias("packaging"),
        F.col("e.value.description").alias("description"), F.col("e.value.container.init").alias("init"), F.col("e.value.codedWidth").alias("width"),
        F.col("e.value.codedHeight").alias("height"), F.col("e.value.sampleRate").alias("sample_rate"), F.col("e.value.numberOfChannels").alias("channels"), F.col("e.value.timescale").alias("timescale"),
    )
    w = Window.partitionBy("broadcast").orderBy("section", "name")
    return flat.withColumn("ordinal", F.row_number().over(w) - 1).drop("section")


def problems(found: DataFrame) -> DataFrame:
    """(broadcast, name, problem) of every rendition that a reader refuses."""
    media = F.col("kind") != "data"
    why = (
        F.when(F.col("packaging").isNull(), "no container")
        .when(~F.col("packaging").isin("cmaf", "legacy"), "container not taken")
        .when(~media & (F.col("packaging") != "legacy"), "data is legacy")
        .when(~media & (F.col("timescale").isNull() | ~F.col("timescale").between(1, 2147483647)), "timescale")
        .when(media & (F.col("packaging") == "cmaf") & F.col("description").isNull(), "no description")
        .when(media & (F.col("packaging") == "cmaf") & F.col("init").isNull(), "no init")
    )
    return found.select("broadcast", "name", why.alias("problem")).where("problem is not null")


def assigned(found: DataFrame) -> DataFrame:
    """renditions with row: videos are rows 0.. in reading order, data is on row 0.

    An audio joins the video whose name it has before '.audio'; else a legacy one
    the first legacy video row that has no audio yet; else it opens a row of its own.
    Audios are taken in reading order, in a fold over the document's few tracks.
    """
    per = found.groupBy("broadcast").agg(F.array_sort(F.collect_list(F.struct("ordinal", "kind", "name", "packaging"))).alias("t"))
    videos = F.filter("t", lambda x: x["kind"] == "video")
    slots = F.transform(videos, lambda v, i: F.struct(i.cast("int").alias("row"), v["name"].alias("name"), (v["packaging"] == "legacy").alias("legacy")))
    state = "struct<next:int,taken:array<int>,out:array<struct<ordinal:int,row:int>>>"
    start = F.struct(F.size("v").alias("next"), F.array().cast("array<int>").alias("taken"), F.array().cast("array<struct<ordinal:int,row:int>>").alias("out")).cast(state)

    def step(acc: Column, x: Column) -> Column:
        named = F.filter("v", lambda v: x["name"].endswith(".audio") & (v["name"] == codec.strip_audio(x["name"])))
        free = F.filter("v", lambda v: v["legacy"] & ~F.array_contains(acc["taken"], v["row"]))
        paired = F.coalesce(F.get(named, F.lit(0))["row"], F.when(x["packaging"] == "legacy", F.get(free, F.lit(0))["row"]))
        row = F.coalesce(paired, acc["next"])
        return F.struct(
            F.when(paired.isNull(), acc["next"] + 1).otherwise(acc["next"]).alias("next"), F.array_append(acc["taken"], row).alias("taken"),
            F.array_append(acc["out"], F.struct(x["ordinal"].alias("ordinal"), row.alias("row"))).alias("out"),
        ).cast(state)

    audio = per.withColumn("v", slots).select("broadcast", F.explode(F.aggregate(F.filter("t", lambda x: x["kind"] == "audio"), start, step)["out"]).alias("o")).select("broadcast", F.col("o.ordinal").alias("ordinal"), F.col("o.row").alias("audio_row"))
    video = F.row_number().over(Window.partitionBy("broadcast", "kind").orderBy("ordinal")) - 1
    at = found.withColumn("__n", video).join(audio, ["broadcast", "ordinal"], "left")
    return at.withColumn("row", F.when(F.col("kind") == "video", F.col("__n")).when(F.col("kind") == "audio", F.col("audio_row")).otherwise(0)).drop("__n", "audio_row")


def relation(rows: DataFrame) -> DataFrame:
    """The broadcast as a relation: a row for each row number, with name, codecs and cells.

    name is the row's first media track's (else its first track's); codecs lists the
    media tracks' codecs, null if there is none. bandwidth is never known.
    """
    media = F.col("kind") != "data"
    listed = lambda cond, value: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("ordinal", value.alias("x"))))), lambda e: e["x"])
    name = F.coalesce(F.min_by("name", F.when(media, F.col("ordinal"))), F.min_by("name", "ordinal"))
    codecs = listed(media, F.col("codec"))
    cells = [listed(F.col("kind") == k, F.col("name")).alias(k) for k in SECTIONS]
    return rows.groupBy("broadcast", "row").agg(
        F.when(F.count_if(media) > 0, name).otherwise(F.min_by("name", "ordinal")).alias("name"), F.when(F.count_if(media) > 0, F.array_join(codecs, ",")).alias("codecs"),
        F.max("width").alias("width"), F.max("height").alias("height"), F.lit(None).cast("long").alias("bandwidth"), *cells,
    )


def ports(rows: DataFrame) -> DataFrame:
    """rows with port: the name in safe characters; empty or given to a port before, it gets the track's index.

    A track's ordinal is its own in a broadcast, which may have any number of tracks. All but the first track of a name clash. The first one
    clashes where its name is a port that an index made: that track is told by the name's own end, and had to clash itself, which the
    name's earlier ends tell in turn. So each such name asks for the tracks that its ends name, and is folded alone.
    """
    kind = dict(rows.dtypes)["ordinal"]
    safe = F.coalesce(F.regexp_replace("name", "[^A-Za-z0-9_-]", "_"), F.lit(""))
    own = rows.select(F.col("broadcast").alias("__b"), F.col("ordinal").alias("__o"), safe.alias("__s"))
    # A null ordinal comes first, as in any order.
    firsts = own.where("__s != ''").groupBy("__b", "__s").agg(F.min(F.struct(F.col("__o").isNotNull(), "__o"))["__o"].alias("__o"))

    # Each end '-<ordinal>' of a beginning of the name: where it begins (at) and ends (upto), and the track that would have made it.
    dashes = F.filter(F.sequence(F.lit(1), F.length("__s")), lambda i: F.substring(F.col("__s"), i, F.lit(1)) == "-")
    asking = firsts.where("__s rlike '-[0-9]+$'").select("*", F.explode(dashes).alias("__at"))
    index = F.expr(r"regexp_extract(substring(__s, __at + 1), '^(0|-?[1-9][0-9]*)(?=-|$)', 1)")
    ends = asking.withColumn("__i", index).where("__i != ''").select(
        F.struct("__b", "__o", "__s").alias("__asks"), "__at", (F.col("__at") + 1 + F.length("__i")).alias("__upto"), F.expr(f"try_cast(__i as {kind})").alias("__n"), F.expr("left(__s, __at - 1)").alias("__p"),
    )
    same = lambda x, y: F.col(x).eqNullSafe(F.col(y))
    first = firsts.select(F.col("__b").alias("__fb"), F.col("__o").alias("__fo"), F.col("__s").alias("__fs"))
    held = own.withColumnsRenamed({"__b": "__hb", "__o": "__ho", "__s": "__hs"})
    made = ends.join(held, F.col("__asks.__b").eqNullSafe(F.col("__hb")) & (F.col("__n") == F.col("__ho")) & (F.col("__p") == F.col("__hs")))
    made = made.join(first, same("__hb", "__fb") & same("__ho", "__fo") & same("__hs", "__fs"), "left").select("__asks", F.struct("__at", "__upto", "__n", F.col("__fs").isNull().alias("late")).alias("__e"))

    def told(by: Column, at: Column, n: Column) -> Column:
        """Whether an end that clashed, of an earlier track, makes the name up to here."""
        return F.exists(by, lambda e: (e["upto"] == at) & (n.isNull() | (e["n"] < n)))

    def fold(by: Column, e: Column) -> Column:
        return F.when(e["late"] | told(by, e["__at"], e["__n"]), F.array_append(by, F.struct(e["__upto"].alias("upto"), e["__n"].alias("n")))).otherwise(by)

    none = F.from_json(F.lit("[]"), f"array<struct<upto:int,n:{kind}>>")
    each = made.groupBy("__asks").agg(F.sort_array(F.collect_list("__e")).alias("__ends")).select("__asks.*", F.aggregate("__ends", none, fold).alias("__by"))
    taken = each.where(told(F.col("__by"), F.length("__s") + 1, F.col("__o"))).select(F.col("__b").alias("__tb"), F.col("__o").alias("__to"), F.col("__s").alias("__ts"))

    # Who keeps its name: the first of it, if no index has made it. Nothing is dealt by a name or a broadcast alone, of which there may be few.
    free = first.join(taken, same("__fb", "__tb") & same("__fo", "__to") & same("__fs", "__ts"), "left_anti")
    at = rows.withColumn("__s", safe).join(free, same("broadcast", "__fb") & same("ordinal", "__fo") & same("__s", "__fs"), "left")
    port = F.when(F.col("__fs").isNull(), F.concat("__s", F.lit("-"), F.col("ordinal").cast("string"))).otherwise(F.col("__s"))
    return at.withColumn("port", port).select(*rows.columns, "port")


def track_names(pads: DataFrame, base: str = "video", audio: str = "audio", data: str = "data") -> DataFrame:
    """pads (broadcast, ordinal, row, kind, height, name) with track.

    A name given stands. Unnamed videos are base alone, base.{height}p among several,
    with .{index} where a height is shared. Named audio beside a video gets .audio;
    unnamed audio and data are their kind's base, then base.1, base.2 and so on.
    """
    kind = Window.partitionBy("broadcast", "kind", F.col("name").isNull())
    n, nth = F.count("*").over(kind), F.row_number().over(kind.orderBy("ordinal"))
    shared = F.count("*").over(Window.partitionBy("broadcast", "kind", F.col("name").isNull(), "height"))
    beside = F.max(F.col("kind") == "video").over(Window.partitionBy("broadcast", "row"))
    height = F.concat(F.lit(base + "."), F.col("height").cast("string"), F.lit("p"))
    video = F.when(n == 1, base).when(shared > 1, F.concat(height, F.lit("."), (nth - 1).cast("string"))).otherwise(height)
    own = F.when(F.col("kind") == "video", video).when(F.col("kind") == "audio", codec.numbered(F.lit(audio), nth)).otherwise(codec.numbered(F.lit(data), nth))
    named = F.when((F.col("kind") == "audio") & beside, F.concat("name", F.lit(".audio"))).otherwise(F.col("name"))
    return pads.withColumn("track", F.when(F.col("name").isNull(), own).otherwise(named))


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Why a reader doesn't go on after a reconnect: tracks (broadcast, name) missing or changed."""
    fields = ["codec", "init", "description", "kind", "timescale"]
    there = new.select("broadcast", "name", *[F.col(c).alias(f"new_{c}") for c in fields])
    missing = old.join(there, ["broadcast", "name"], "left_anti").select("broadcast", "name", F.lit("missing").alias("reason"))
    changed = F.coalesce(*[F.when(~F.col(c).eqNullSafe(F.col(f"new_{c}")), c) for c in fields])
    return missing.unionByName(old.join(there, ["broadcast", "name"]).select("broadcast", "name", changed.alias("reason")).where("reason is not null"))


def pick(found: DataFrame, track: str | None = None, index: int = 0) -> DataFrame:
    """The rendition by its name, or by its place in the listing; none is an error."""
    own = found.where(F.col("name") == track) if track is not None else found.where(F.col("ordinal") == index)
    wanted = f"track {track!r}" if track is not None else f"rendition {index}"
    if own.isEmpty():
        raise ValueError(f"the catalog has no {wanted}")
    return own


def last_document(documents: DataFrame) -> DataFrame:
    """The catalog that stands: of (broadcast, grp, document) the latest group's."""
    return documents.groupBy("broadcast").agg(F.max_by("document", "grp").alias("document"))


def by_priority(tracks: DataFrame) -> DataFrame:
    """tracks with the priority they have on the wire."""
    kinds = F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv])
    return tracks.withColumn("priority", kinds[F.col("kind")])
