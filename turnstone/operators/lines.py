"""Readable lines and cues from the words of segments.

Packing is sequential: a break resets what the next break depends on. But a pause always breaks, so the stretches between
pauses are packed apart, in any number of tasks; and only lines that are too short look at the line before them. Short loops
over numbers, in Arrow batches, find where lines start and which of them join; the words themselves stay in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstone.functions.text import ends_sentence, join_words, no_space_between
from turnstone.session import materialize, ship, spread


@dataclass(frozen=True)
class LineLimits:
    """When a line ends."""

    max_chars: int = 42
    max_duration: float = 7.0
    max_gap: float = 0.8
    min_chars_for_sentence_break: int = 12
    min_duration: float = 0.25


def line_starts(starts: Sequence[float], ends: Sequence[float], sizes: Sequence[int], tight: Sequence[bool], stops: Sequence[bool], limits: LineLimits) -> tuple[list[int], list[int]]:
    """Places of words at which a line starts, and each line's characters.

    sizes: each word's characters; tight: whether it follows the one before without a space; stops: whether it ends a sentence."""
    gap, span, most, enough = limits.max_gap, limits.max_duration, limits.max_chars, limits.min_chars_for_sentence_break
    cuts: list[int] = []
    held: list[int] = []
    begin = last = chars = 0
    stopped = False
    for k, (start, end, size, close, stop) in enumerate(zip(starts, ends, sizes, tight, stops, strict=True)):
        if k and not (start - last > gap or end - begin > span or (stopped and chars >= enough) or chars + 1 + size > most):
            chars += size + (not close)
        else:
            if k:
                held.append(chars)
            cuts.append(k)
            begin, chars = start, size
        last, stopped = end, stop
    return cuts, held + [chars] * bool(cuts)


def merge_slivers(starts: Sequence[float], ends: Sequence[float], chars: Sequence[int], tight: Sequence[bool], limits: LineLimits) -> list[int]:
    """Places of lines that stay, once lines that are too short have joined the line before them, if both together still fit."""
    kept: list[int] = []
    held = 0
    for k, size in enumerate(chars):
        short = max(0.0, ends[k] - starts[k]) < limits.min_duration
        if kept and short and held + size + 1 <= limits.max_chars and ends[k] - starts[kept[-1]] <= limits.max_duration:
            held += size + (not tight[k])
        else:
            kept.append(k)
            held = size
    return kept


def _lists(columns: Sequence[pa.Array]) -> tuple[list[list], np.ndarray]:
    """The values of list columns that are alike in shape, one list a column, and where each row begins in them (one more entry)."""
    bounds = np.concatenate(([0], np.cumsum(columns[0].value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
    flat = [c.flatten() for c in columns]
    return [c.to_pylist() if c.null_count else c.to_numpy(zero_copy_only=False).tolist() for c in flat], bounds


def pack_lines(words: DataFrame, limits: LineLimits = LineLimits(), merge: bool = True) -> DataFrame:
    """Words (interview_id, segment_index, idx, start, end, text) as lines: interview_id, segment_index,
    line_in_segment, start, end, text, words, speaker (of the segment's first word, where words have one).

    A line ends before a word that comes after a pause, would make it too long in time or characters, or follows a
    sentence's end once there is enough text. merge: slivers are folded backwards, over pauses too.

    Words are dealt by the stretches between pauses, so a segment of any length is packed in many tasks; lines are then
    brought together by recording, in which a line and the slivers right behind it are folded by themselves."""

    @F.arrow_udf("array<struct<at:int,chars:int>>")
    def cut(starts: pa.Array, ends: pa.Array, sizes: pa.Array, tight: pa.Array, stops: pa.Array) -> pa.Array:
        columns, bounds = _lists((starts, ends, sizes, tight, stops))
        found = [line_starts(*(c[a:b] for c in columns), limits) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        flat = [pa.array([x for row in found for x in row[k]], pa.int32()) for k in (0, 1)]
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32()), pa.StructArray.from_arrays(flat, ["at", "chars"]))

    @F.arrow_udf("array<int>")
    def fold(starts: pa.Array, ends: pa.Array, chars: pa.Array, tight: pa.Array) -> pa.Array:
        columns, bounds = _lists((starts, ends, chars, tight))
        return pa.array([merge_slivers(*(c[a:b] for c in columns), limits) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.list_(pa.int32()))

    ship(words.sparkSession)
    key = ["interview_id", "segment_index"]
    inside = Window.partitionBy(*key).orderBy("idx")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag("text").over(inside)
    pause = F.coalesce(F.col("start") - F.lag("end").over(inside) > limits.max_gap, F.lit(False))
    marked = words.select(
        *key, "idx", "start", "end", "text",
        F.sum(pause.cast("int")).over(upto).alias("stretch"),
        ((F.col("text") == "") | F.coalesce(no_space_between(before, F.col("text")), F.lit(False))).alias("tight"),
        (F.first("speaker").over(upto) if "speaker" in words.columns else F.lit(None).cast("string")).alias("speaker"),
    )
    word = F.struct("idx", "start", "end", "text").alias("word")
    held = F.array_sort(F.collect_list(F.struct("idx", word, "tight", F.length("text").alias("size"), ends_sentence(F.col("text")).alias("stops"))))
    grouped = marked.groupBy(*key, "stretch").agg(held.alias("held"), F.first("speaker").alias("speaker"))  # where they lie in order
    stretches = spread(grouped, *key, "stretch")
    numbers = [F.col(f"held.{name}") for name in ("word.start", "word.end", "size", "tight", "stops")]
    cuts = stretches.withColumn("cuts", cut(*numbers))
    place = lambda k: F.get(F.col("cuts"), k)
    flat = cuts.select(*key, "stretch", "speaker", "held", "cuts", F.explode(F.sequence(F.lit(0), F.size("cuts") - 1)).alias("k"))
    size = F.coalesce(place(F.col("k") + 1)["at"], F.size("held")) - place(F.col("k"))["at"]
    flat = flat.select(*key, "stretch", "speaker", "k", place(F.col("k"))["chars"].alias("chars"), F.slice("held", place(F.col("k"))["at"] + 1, size).alias("held"))
    first, last = F.get("held", F.lit(0)), F.element_at("held", -1)
    made = flat.select(*key, "stretch", "k", "speaker", "chars", first["word"]["start"].alias("start"), last["word"]["end"].alias("end"), first["tight"].alias("tight"), F.col("held.word").alias("words"))
    if merge:
        order = Window.partitionBy("interview_id").orderBy("segment_index", "stretch", "k")
        behind = (F.greatest(F.lit(0.0), F.col("end") - F.col("start")) < limits.min_duration) & F.col("segment_index").eqNullSafe(F.lag("segment_index").over(order))
        runs = made.withColumn("run", F.sum((~behind).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        part = lambda name: F.col("parts")[name]
        parts = F.array_sort(F.collect_list(F.struct("stretch", "k", "start", "end", "chars", "tight", "words")))
        runs = runs.groupBy("interview_id", "run").agg(F.first("segment_index").alias("segment_index"), F.first("speaker").alias("speaker"), parts.alias("parts"))
        runs = runs.withColumn("kept", fold(*map(part, ("start", "end", "chars", "tight"))))
        runs = runs.select("interview_id", "run", "segment_index", "speaker", "parts", "kept", F.explode(F.sequence(F.lit(0), F.size("kept") - 1)).alias("k"))
        at = F.get("kept", F.col("k"))
        runs = runs.withColumn("parts", F.slice("parts", at + 1, F.coalesce(F.get("kept", F.col("k") + 1), F.size("parts")) - at))
        made = runs.select(
            *key, F.col("run").alias("stretch"), "k", "speaker", F.get("parts", F.lit(0))["start"].alias("start"), F.array_max(part("end")).alias("end"), F.flatten(part("words")).alias("words")
        )
    made = spread(made, "interview_id")  # serves the numbers here and those of recordings, lines and cues later
    number = F.row_number().over(Window.partitionBy(*key).orderBy("stretch", "k")) - 1
    return made.select(*key, number.alias("line_in_segment"), "start", "end", join_words(F.col("words.text")).alias("text"), "words", "speaker")


def build_lines(words: DataFrame, segments: DataFrame | None = None, limits: LineLimits = LineLimits()) -> DataFrame:
    """interview_id, line_ix, segment_index, start, end, text, speaker, words.

    Lines never cross segments. Without segments, speakers are those of the words, and words are shuffled once; with
    them, theirs are taken, and a segment without words but with a text is one line of its own times."""
    key = ["interview_id", "segment_index"]
    every = pack_lines(words, limits)
    if segments is not None:
        named = every.drop("speaker").join(segments.select(*key, "speaker"), key, "left")
        bare = segments.where(F.coalesce("text", F.lit("")) != "").join(words.select(*key).distinct(), key, "left_anti")
        none = F.array().cast(named.schema["words"].dataType).alias("words")
        every = named.unionByName(bare.select(*key, F.lit(0).alias("line_in_segment"), "start", "end", "text", none, "speaker")).repartition("interview_id")
    order = Window.partitionBy("interview_id").orderBy("segment_index", "line_in_segment")
    return every.select("interview_id", (F.row_number().over(order) - 1).alias("line_ix"), "segment_index", "start", "end", "text", "speaker", "words")


def lines_for_width(lines: DataFrame, words: DataFrame, segments: DataFrame | None, width: int) -> DataFrame:
    """A recording's own lines where all fit the width, else lines packed anew with this width and the other limits
    as they are by default. Only words of recordings that need it are packed anew; which do not is stored, as ids. The columns
    are those of lines, which are read twice: give stored lines where they are dear to make."""
    fit = lines.groupBy("interview_id").agg(F.bool_and(F.length("text") <= width).alias("fit"))
    good = materialize(fit.where("fit").select("interview_id"), "fitting")
    open_ = lambda df: df.join(good, "interview_id", "left_anti")
    rebuilt = build_lines(open_(words), segments if segments is None else open_(segments), LineLimits(max_chars=width))
    return lines.join(good, "interview_id", "left_semi").unionByName(rebuilt.select(*lines.columns)).repartition("interview_id")


def number_cues(lines: DataFrame, max_lines: int = 2) -> DataFrame:
    """Lines with cue_ix: at most max_lines lines of one segment make a cue."""
    inside = Window.partitionBy("interview_id", "segment_index").orderBy("line_ix")
    part = F.floor((F.row_number().over(inside) - 1) / max(1, max_lines))
    order = Window.partitionBy("interview_id").orderBy("segment_index", "__part")
    return lines.withColumn("__part", part).withColumn("cue_ix", F.dense_rank().over(order) - 1).drop("__part")
