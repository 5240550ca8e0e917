"""Statistics of transcripts: confidence bands, alignment, run summaries, talk time, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bands of a recording without any score, and the lead without words that is worth a warning.
NO_SCORES = {"Good": 0.9, "Neutral": 0.7, "Bad": 0.5}
BANDS = {"Good": 0.75, "Neutral": 0.50, "Bad": 0.25}
LEAD_WARNING_SECONDS = 30.0


def mean_confidence(words: DataFrame, *key: str, scale: int = 1, digits: int = 4) -> DataFrame:
    """Mean of the known confidences, rounded; null where none is known. Confidences may be given as whole
    numbers of 1 / scale: sums are then exact in any order."""
    mean = F.sum("confidence").cast("double") / F.count("confidence") / scale
    return words.groupBy(*key).agg(F.round(F.when(F.count("confidence") > 0, mean), digits).alias("mean_confidence"))


def score_bands(words: DataFrame) -> DataFrame:
    """interview_id, good, neutral, bad: the sorted, rounded scores at place floor(n * share), the last at most.

    A score's place follows from counts of equal scores, so no recording's scores are gathered in a row."""
    scored = words.select("interview_id", F.round("confidence", 4).alias("score"))
    equal = scored.groupBy("interview_id", "score").agg(F.count("score").alias("times"))
    up = Window.partitionBy("interview_id").orderBy(F.asc_nulls_first("score")).rowsBetween(Window.unboundedPreceding, 0)
    placed = equal.select("*", F.sum("times").over(up).alias("upto"), F.sum("times").over(Window.partitionBy("interview_id")).alias("n"))

    def band(name: str) -> Column:
        place = F.least(F.floor(F.col("n") * BANDS[name]), F.col("n") - 1)
        here = (F.col("upto") > place) & (F.col("upto") - F.col("times") <= place)
        return F.coalesce(F.round(F.max(F.when(here, F.col("score"))), 3), F.lit(NO_SCORES[name])).alias(name.lower())

    return placed.groupBy("interview_id").agg(*map(band, BANDS))


def alignment_stats(words: DataFrame, segments: DataFrame) -> DataFrame:
    """Per recording: segments, those with a measured word, the others, their share in per cent, words, measured words."""
    key = ["interview_id", "segment_index"]
    inside = words.groupBy(*key).agg(F.count(F.lit(1)).alias("words"), F.count_if(F.col("source") == "measured").alias("measured"))
    both = segments.select(*key).join(inside, key, "left")
    return (
        both.groupBy("interview_id")
        .agg(
            F.count(F.lit(1)).alias("total_segments"),
            F.count_if(F.coalesce("measured", F.lit(0)) > 0).alias("successful_alignments"),
            F.coalesce(F.sum("words"), F.lit(0)).alias("total_words"),
            F.coalesce(F.sum("measured"), F.lit(0)).alias("words_with_measured_timings"),
        )
        .withColumn("failed_alignments", F.col("total_segments") - F.col("successful_alignments"))
        .withColumn("success_rate", F.round(F.col("successful_alignments") / F.col("total_segments") * 100, 1))
    )


def run_summary(words: DataFrame, interviews: DataFrame) -> DataFrame:
    """interviews (interview_id, duration, ...) with first_word_at, last_word_at and a warning for a long lead."""
    ends = words.groupBy("interview_id").agg(F.round(F.min_by("start", "idx"), 2).alias("first_word_at"), F.round(F.max_by("end", "idx"), 2).alias("last_word_at"))
    whole = lambda c: F.format_string("%d", F.bround(c, 0).cast("long"))
    text = F.concat(F.lit("no words in the first "), whole(F.col("first_word_at")), F.lit("s of "), whole(F.col("duration")), F.lit("s"))
    found = interviews.join(ends, "interview_id", "left").withColumn("audio_seconds", F.round("duration", 2))
    return found.withColumn("warning", F.when(F.col("first_word_at") > LEAD_WARNING_SECONDS, text))


def transcript_counts(words: DataFrame, segments: DataFrame, lines: DataFrame) -> DataFrame:
    """interview_id, segments, lines, words."""
    counted = None
    for name, table in (("segments", segments), ("lines", lines), ("words", words)):
        part = table.groupBy("interview_id").agg(F.count(F.lit(1)).alias(name))
        counted = part if counted is None else counted.join(part, "interview_id", "full_outer")
    return counted.na.fill(0, ["segments", "lines", "words"])


def talk_time(segments: DataFrame) -> DataFrame:
    """Seconds spoken by each speaker of a recording."""
    return segments.groupBy("interview_id", "speaker").agg(F.sum(F.col("end") - F.col("start")).alias("seconds"))


def low_scores(words: DataFrame, below: float = 0.6) -> DataFrame:
    return words.where(F.col("confidence").isNotNull() & (F.col("confidence") < below))


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """outcome and its number of work items."""
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("items"))
