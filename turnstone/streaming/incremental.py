"""Incremental work: new items against what is done, and pauses in word streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnstone.session import seconds_left


def process_new_items(items: DataFrame, done: Callable[[], DataFrame], work: Callable[[DataFrame], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run `work` on every micro-batch of items (id, ...) that are not done yet.

    The done set is read anew for each batch, so a batch that is repeated after a failure does no work twice.
    available_now: what there is, then an end; query.stop() ends a run that goes on."""

    def batch(rows: DataFrame, _: int) -> None:
        work(rows.dropDuplicates(["id"]).join(done().select("id").distinct(), "id", "left_anti"))

    writer = items.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_until(query: StreamingQuery, minutes: float = 0) -> bool:
    """Wait for a stream's end, or stop it shortly before a job's minutes are over (see seconds_left); whether it
    ended by itself. A batch that is stopped is done again by the next run from the same checkpoint."""
    left = seconds_left(minutes)
    if left == float("inf"):
        query.awaitTermination()
        return True
    ended = bool(query.awaitTermination(max(0.001, left)))
    if not ended:
        query.stop()
    return ended


def speech_islands(words: DataFrame, pause: str = "800 milliseconds", late: str = "10 seconds") -> DataFrame:
    """Words with an event time (interview_id, ts) grouped wherever they pause: start, end and number of words."""
    marked = words.withWatermark("ts", late)
    spans = marked.groupBy("interview_id", F.session_window("ts", pause).alias("span")).agg(F.count(F.lit(1)).alias("n_words"))
    return spans.select("interview_id", F.col("span.start").alias("start"), F.col("span.end").alias("end"), "n_words")


def rolling_talk(words: DataFrame, window: str = "1 minute", late: str = "10 seconds") -> DataFrame:
    """Words and mean confidence by speaker and window of event time."""
    marked = words.withWatermark("ts", late)
    return marked.groupBy(F.window("ts", window).alias("span"), "speaker").agg(F.count(F.lit(1)).alias("n_words"), F.avg("confidence").alias("mean_confidence"))
