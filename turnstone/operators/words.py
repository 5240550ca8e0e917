"""Timed words: clamping, durations, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.functions.text import join_words


def duration(start: Column, end: Column) -> Column:
    return F.greatest(F.lit(0.0), end - start)


def clamp_words(words: DataFrame, durations: DataFrame | None = None) -> DataFrame:
    """Words (interview_id, idx, start, end, ...) whose starts never fall and whose ends never precede them, both
    within the recording's duration where that is known (interview_id, duration)."""
    so_far = Window.partitionBy("interview_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    known = words.withColumn("__limit", F.lit(float("inf"))) if durations is None else None
    if known is None:
        limits = durations.select("interview_id", F.col("duration").alias("__limit"))
        known = words.join(limits, "interview_id", "left").withColumn("__limit", F.coalesce("__limit", F.lit(float("inf"))))
    start = F.least(F.greatest(F.lit(0.0), F.max("start").over(so_far)), F.col("__limit"))
    known = known.withColumn("start", start)
    return known.withColumn("end", F.least(F.greatest("end", "start"), F.col("__limit"))).drop("__limit")


def turns_from_segments(segments: DataFrame) -> DataFrame:
    """Segments with a speaker and a positive length, as turns."""
    kept = segments.where((F.coalesce("speaker", F.lit("")) != "") & (F.col("end") > F.col("start")))
    rank = F.row_number().over(Window.partitionBy("interview_id").orderBy("segment_index")) - 1
    return kept.select("interview_id", rank.alias("turn_ix"), "start", "end", "speaker")


def ordered(key: str, value: str) -> Column:
    """An aggregate: value as an array in the order of key."""
    return F.array_sort(F.collect_list(F.struct(key, value)))[value]


def transcript_text(segments: DataFrame) -> DataFrame:
    """interview_id and the text of all its segments that have any."""
    kept = segments.where(F.coalesce("text", F.lit("")) != "")
    return kept.groupBy("interview_id").agg(F.array_join(ordered("segment_index", "text"), " ").alias("text"))


def segment_words(words: DataFrame) -> DataFrame:
    """interview_id, segment_index and the segment's text, joined from its words."""
    return words.groupBy("interview_id", "segment_index").agg(join_words(ordered("idx", "text")).alias("text"))
