"""Shaping what speech and speaker models return: chunks, hypotheses, raw turns. The models themselves are given."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.session import ship

# Seconds of a chunk and of the overlap of two, the reach of full and of local attention.
CHUNK_SECONDS = 480.0
OVERLAP_SECONDS = 15.0
LOCAL_FROM_SECONDS = 1200.0
MIN_TURN_SECONDS = 0.0


def long_audio_strategy(duration: Column, mode: Column, chunk_seconds: float = CHUNK_SECONDS) -> Column:
    """chunk, local or full, by the setting and the recording's length."""
    return F.when((mode == "chunk") & (duration > chunk_seconds), "chunk").when((mode == "local") & (duration > LOCAL_FROM_SECONDS), "local").otherwise("full")


def plan_chunks(interviews: DataFrame, chunk: float = CHUNK_SECONDS, overlap: float = OVERLAP_SECONDS) -> DataFrame:
    """interview_id, chunk_ix, chunk_start, chunk_end: overlapping chunks from 0 on, while they start in the recording."""
    step = max(1.0, chunk - overlap)
    starts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("duration") / step) - 1, F.lit(0)).cast("int")), lambda i: i * F.lit(step))
    flat = interviews.where("duration > 0").select("interview_id", "duration", F.posexplode(starts).alias("chunk_ix", "chunk_start"))
    return flat.select("interview_id", "chunk_ix", "chunk_start", F.least(F.col("chunk_start") + chunk, "duration").alias("chunk_end"))


def stitch_chunks(chunk_words: DataFrame, chunks: DataFrame, chunk: float = CHUNK_SECONDS, overlap: float = OVERLAP_SECONDS) -> DataFrame:
    """Words of chunks (interview_id, chunk_ix, idx, start, end within the chunk) on the recording's time.

    Each overlap is cut in its middle by the word's start, so that every instant belongs to one chunk; first and
    last are those of the plan. idx is numbered anew."""
    whole = Window.partitionBy("interview_id")
    plan = chunks.select("interview_id", "chunk_ix", "chunk_start", (F.col("chunk_ix") == F.min("chunk_ix").over(whole)).alias("first"), (F.col("chunk_ix") == F.max("chunk_ix").over(whole)).alias("last"))
    half = overlap / 2
    low = F.when(F.col("first"), F.lit(0.0)).otherwise(F.lit(half))
    high = F.when(F.col("last"), F.lit(float("inf"))).otherwise(F.lit(chunk - half))
    kept = chunk_words.join(plan, ["interview_id", "chunk_ix"]).where((F.col("start") >= low) & (F.col("start") < high))
    moved = kept.withColumn("start", F.col("start") + F.col("chunk_start")).withColumn("end", F.col("end") + F.col("chunk_start"))
    order = Window.partitionBy("interview_id").orderBy("chunk_ix", "idx")
    return moved.withColumn("idx", (F.row_number().over(order) - 1).cast("int")).drop("chunk_start", "first", "last")


def word_text(*names: Column) -> Column:
    """The first name that is not blank, trimmed; else empty."""
    return F.coalesce(*[F.nullif(F.trim(n), F.lit("")) for n in names], F.lit(""))


def hypothesis_words(hypotheses: DataFrame) -> DataFrame:
    """Words of hypotheses (interview_id, raw: array<word, segment, char, text, start, end>, scores: array<string>).

    Blank words go, but use up their score. Scores count only if there are as many as raw words and all are numbers."""
    numbers = F.transform("scores", lambda s: s.try_cast("double"))
    sound = (F.size("scores") == F.size("raw")) & F.forall(numbers, lambda x: x.isNotNull())
    flat = hypotheses.withColumn("numbers", F.when(sound, numbers)).select("interview_id", "numbers", F.posexplode("raw").alias("place", "w"))
    text = word_text(F.col("w.word"), F.col("w.segment"), F.col("w.char"), F.col("w.text"))
    order = Window.partitionBy("interview_id").orderBy("place")
    words = flat.select("interview_id", "place", text.alias("text"), F.coalesce("w.start", F.lit(0.0)).alias("start"), F.coalesce("w.end", F.lit(0.0)).alias("end"), F.get("numbers", "place").alias("confidence"))
    kept = words.where("text <> ''")
    return kept.select("interview_id", (F.row_number().over(order) - 1).cast("int").alias("idx"), "text", "start", "end", "confidence", F.lit("measured").alias("source"))


def hypothesis_warnings(hypotheses: DataFrame) -> DataFrame:
    """interview_id and its sorted, distinct warnings about scores and missing words."""
    n, m = F.coalesce(F.size("scores"), F.lit(0)), F.coalesce(F.size("raw"), F.lit(0))
    off = F.when((n > 0) & (n != m), F.format_string("word_confidence length %d != word count %d; scores discarded", n, m))
    bad = F.when((n > 0) & (n == m) & F.exists("scores", lambda s: s.try_cast("double").isNull()), F.lit("word_confidence was not numeric; scores discarded"))
    none = F.when(m == 0, F.lit("model returned no word timestamps"))
    rows = hypotheses.select("interview_id", F.explode(F.array_compact(F.array(off, bad, none))).alias("warning"))
    return rows.groupBy("interview_id").agg(F.array_sort(F.collect_set("warning")).alias("warnings"))


def clear_attribution(words: DataFrame) -> DataFrame:
    return words.withColumn("speaker", F.lit(None).cast("string")).withColumn("turn_ix", F.lit(None).cast("int")).withColumn("segment_index", F.lit(-1))


def speaker_label(speaker: Column, prefix: str = "S") -> Column:
    """The last run of digits, plus one, as S01; a name without digits stays."""
    number = F.element_at(F.regexp_extract_all(speaker, F.lit(r"(\d+)"), F.lit(1)), -1)
    return F.when(F.rlike(speaker, F.lit(r"\d")), F.concat(F.lit(prefix), F.format_string("%02d", number.try_cast("long") + 1))).otherwise(speaker)


def _json_label(value: Column) -> Column:
    """Of a JSON value what speaker_label takes: whole numbers as such; numbers with a fraction and truth values are
    names as they are (is_name)."""
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    text = F.try_variant_get(value, "$", "string")
    is_number = F.rlike(kind, F.lit("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"))
    whole = is_number & (number == F.floor(number))
    return F.struct(F.when(whole, number.cast("long").cast("string")).when(kind == "BOOLEAN", F.initcap(text)).otherwise(text).alias("label"), F.coalesce((is_number & ~whole) | (kind == "BOOLEAN"), F.lit(False)).alias("is_name"))


def _read_turns(raw: DataFrame) -> DataFrame:
    text = F.trim("raw")
    entry = F.try_parse_json(F.when(F.rlike(text, F.lit(r"^[{\[]")), text))
    fields = F.filter(F.split(F.regexp_replace(text, r'^\[|\]$|["()]', " "), r"[\s,]+"), lambda f: f != "")
    is_object = F.startswith(text, F.lit("{"))
    number = lambda *names: F.coalesce(*[F.try_variant_get(entry, f"$.{n}", "string") for n in names])
    parts = F.size(fields) >= 3
    start = F.when(is_object, number("start", "begin", "start_time")).when(parts, F.get(fields, F.lit(0)))
    end = F.when(is_object, number("end", "end_time")).when(parts, F.get(fields, F.lit(1)))
    value = F.coalesce(*[F.try_variant_get(entry, at, "variant") for at in ("$.speaker", "$.speaker_index", "$.label", "$[2]")])
    plain = F.struct(F.when(parts & ~is_object, F.get(fields, F.lit(2))).alias("label"), F.lit(False).alias("is_name"))
    label = F.when(value.isNotNull(), _json_label(value)).otherwise(plain)
    return raw.select("*", start.try_cast("double").alias("start"), end.try_cast("double").alias("end"), label.alias("named"))


def parse_raw_turns(raw: DataFrame) -> DataFrame:
    """Raw turns (interview_id, raw, and ord, their place, if there is one) as interview_id, ord, start, end, label,
    is_name; those that can't be read are left out (see unread_turns).

    Three shapes are read: an object with start/begin/start_time, end/end_time and speaker/speaker_index/label; an
    array of three; and three fields parted by blanks or commas."""
    own = ["ord"] if "ord" in raw.columns else []
    read = _read_turns(raw.select("interview_id", "raw", *own)).where("start IS NOT NULL AND end IS NOT NULL")
    return read.select("interview_id", *own, "start", "end", "named.label", "named.is_name")


def unread_turns(raw: DataFrame) -> DataFrame:
    """interview_id and warning of each raw turn that can't be read."""
    lost = _read_turns(raw.select("interview_id", "raw")).where("start IS NULL OR end IS NULL")
    return lost.select("interview_id", F.concat(F.lit("unrecognised diarization segment: "), F.coalesce("raw", F.lit("None"))).alias("warning"))


def diarized_turns(parsed: DataFrame, durations: DataFrame | None = None, least: float = MIN_TURN_SECONDS) -> DataFrame:
    """Parsed turns within the recording, long enough, labelled and numbered by start and end; ties stay in the order
    of ord where there is one, or else go by speaker."""
    limited = parsed.withColumn("limit", F.lit(float("inf")))
    if durations is not None:
        known = durations.select("interview_id", F.when(F.col("duration") > 0, F.col("duration")).alias("limit"))
        limited = parsed.join(known, "interview_id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    start = F.greatest(F.lit(0.0), F.least("start", "limit"))
    turns = limited.withColumn("start", start).withColumn("end", F.greatest("start", F.least("end", "limit"))).where(F.col("end") - F.col("start") >= least)
    named = F.when(F.col("is_name"), F.col("label")).otherwise(speaker_label(F.col("label"))) if "is_name" in parsed.columns else speaker_label(F.col("label"))
    turns = turns.withColumn("speaker", named)
    order = Window.partitionBy("interview_id").orderBy("start", "end", *(["ord"] if "ord" in parsed.columns else []), "speaker")
    return turns.select("interview_id", (F.row_number().over(order) - 1).cast("int").alias("turn_ix"), "start", "end", "speaker")


def diarization_meta(turns: DataFrame, runs: DataFrame) -> DataFrame:
    """Of each run (interview_id, elapsed, duration, failed, enabled): turns, speakers, real-time factor, and a status
    only where diarization failed or was off. A failure leaves no turns and its words without speakers."""
    counted = turns.groupBy("interview_id").agg(F.count(F.lit(1)).alias("turns"), F.array_sort(F.collect_set("speaker")).alias("speakers"))
    status = F.when(~F.col("enabled"), "disabled").when(F.col("failed"), "failed")
    factor = F.when(F.col("duration") > 0, F.round(F.col("elapsed") / F.col("duration"), 5))
    return runs.join(counted, "interview_id", "left").select(
        "interview_id", F.coalesce("turns", F.lit(0)).alias("turns"), F.coalesce("speakers", F.array().cast("array<string>")).alias("speakers"), factor.alias("rtf"), status.alias("status")
    )


def transcribe(items: DataFrame, start: Callable[[], Callable[[dict], list[dict]]]) -> DataFrame:
    """Work items with outcome (ok, failed or fatal), message and words, by a speech model.

    `start` loads the model once a task and gives a function from an item to its words. One item's failure is its
    outcome, not the task's; after an error that spoils the process, the task's other items are not tried."""
    from turnstone.operators.worklist import is_unrecoverable_message

    words = "array<struct<idx:int,text:string,start:double,end:double,confidence:double>>"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema) + f", outcome string, message string, words {words}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, spoiled = None, False
        for batch in batches:
            out = []
            for item in batch.to_dict("records"):
                found, outcome, message = [], "skipped", None
                if not spoiled:
                    try:
                        model = model or start()
                        found = [{"idx": i, **w} for i, w in enumerate(model(item))]
                        outcome, message = ("ok", None) if found else ("failed", "no speech recognised")
                    except Exception as error:  # noqa: BLE001  any failure is this item's outcome
                        message = f"{type(error).__name__}: {error}"
                        spoiled = is_unrecoverable_message(message)
                        outcome = "fatal" if spoiled else "failed"
                out.append({**item, "outcome": outcome, "message": message, "words": found})
            yield pd.DataFrame(out, columns=[*batch.columns, "outcome", "message", "words"])

    ship(items.sparkSession)
    return items.mapInPandas(run, schema)
