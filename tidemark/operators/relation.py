"""Queries over broadcast relations: rungs, ladders, series, ordinals, parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cell(column: str, n: int = 1) -> Column:
    """The n-th stream of a cell, from 1; null where there is none."""
    return F.try_element_at(F.col(column), F.lit(n))


def listed(values: str, n: Column) -> Column:
    """The n-th item, from 1, of a comma-separated parameter; null beyond it."""
    return F.try_element_at(F.split(F.lit(values), ","), n.cast("int"))


def series(df: DataFrame, n: int, out: str = "i") -> DataFrame:
    """df crossed with 1..n."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(n))))


def unnested(df: DataFrame, column: str, item: str, index: str) -> DataFrame:
    """A row for each item of an array column, with its place from 1."""
    return df.select("*", F.posexplode(column).alias(index, item)).withColumn(index, F.col(index) + 1)


def scaled_height(width: Column, source_width: Column, source_height: Column) -> Column:
    """The even height that keeps the aspect: halves round to even."""
    return (2 * F.bround(width * source_height / source_width / 2, 0)).cast("int")


def widest(rel: DataFrame) -> DataFrame:
    """Each broadcast's widest rung: heights descending, unknown ones last, then by name."""
    w = Window.partitionBy("broadcast").orderBy(F.desc_nulls_last("height"), "name")
    return rel.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def rung_with_sound(rel: DataFrame, height: int) -> DataFrame:
    """A rung by height, beside each audio-only row of its broadcast."""
    video = rel.where(F.col("height") == height).select("broadcast", F.col("name").alias("video"))
    audio = rel.where(F.col("height").isNull()).select("broadcast", F.col("name").alias("audio"))
    return video.join(audio, "broadcast")


def ladder(inputs: DataFrame, rungs: int, widths: str, bitrates: str) -> DataFrame:
    """Rungs of inputs (broadcast, width, height, audio) fully joined with their audio tracks.

    Rung i scales to the i-th width; audio track n is rung rungs + n, so that it stands on a row of its own.
    """
    vid = series(inputs, rungs, "rung").withColumn("w", listed(widths, F.col("rung")).cast("int"))
    vid = vid.select("broadcast", "rung", F.col("w").alias("video_width"), scaled_height(F.col("w"), F.col("width"), F.col("height")).alias("video_height"))
    aud = unnested(inputs, "audio", "track", "index").select("broadcast", (F.lit(rungs) + F.col("index")).alias("rung"), F.col("track").alias("audio_track"))
    both = vid.join(aud, ["broadcast", "rung"], "full")
    return both.withColumn("options", F.create_map(F.lit("video_bitrate"), listed(bitrates, F.col("rung")))).withColumn("bitrate", F.col("options")["video_bitrate"]).drop("options")
