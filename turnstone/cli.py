"""python -m turnstone.cli run|status: fuse stored words and turns into files, or list what is finished."""

from __future__ import annotations

import argparse
import json
import time
from dataclasses import replace

from pyspark.sql import functions as F

from turnstone.operators import lines
from turnstone.operators.worklist import pending
from turnstone.plans.recording import fuse
from turnstone.session import drop_tables, get_session, materialize, seconds_left, timed
from turnstone.sources import files, listing


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="turnstone")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="write json/ and vtts/ for recordings that have none yet")
    run.add_argument("--words", required=True, help="Parquet: interview_id, idx, text, start, end, confidence, source")
    run.add_argument("--turns", required=True, help="Parquet: interview_id, turn_ix, start, end, speaker")
    run.add_argument("--max-files", type=int, default=0)
    run.add_argument("--language", default="en")
    run.add_argument("--max-lines", type=int, default=2)
    run.add_argument("--highlight", action="store_true")
    run.add_argument("--max-width", type=int, default=0, help="characters of a line; recordings whose lines fit keep them")
    run.add_argument("--skip-list", help="a JSON array of recordings to leave out")
    run.add_argument("--source", choices=("auto", "smb", "json", "local"), help="only recordings that are listed there")
    run.add_argument("--input", help="the folder of recordings, or the mounted share, for --source local and smb")
    run.add_argument("--config-json", help="the work list for --source json")
    run.add_argument("--outcomes", help="Parquet: outcome of every transcribed item; a fatal one makes the exit code 1")
    run.add_argument("--deadline-minutes", type=float, default=0, help="begin no new batch ten minutes before so many are over")
    run.add_argument("--batch-files", type=int, default=100, help="recordings of a batch, with a deadline")
    for command in (run, commands.add_parser("status", help="finished recordings")):
        command.add_argument("--out", required=True, help="a folder that all executors see")
    return top


def stored_items(spark, words, given):
    """Recordings that have words: ord, id, interview_id; with a source only those listed there, in its order."""
    stored = words.select("interview_id").distinct().withColumn("id", F.col("interview_id").cast("string"))
    if not given.source:
        return stored.withColumn("ord", F.col("interview_id"))
    source = listing.resolve_source(given.source, bool(given.config_json))
    listed = listing.work_items(spark, source, given.config_json if source == "json" else given.input)
    return stored.join(listed.groupBy("id").agg(F.min("ord").alias("ord")), "id")


def write_batch(words, turns, chosen, given) -> tuple[int, int]:
    """Fuse the chosen recordings and write their files: files, and recordings that lack one."""
    made = fuse(words.join(chosen, "interview_id", "left_semi"), turns.join(chosen, "interview_id", "left_semi"))
    if given.max_width:
        made = replace(made, lines=lines.lines_for_width(made.lines, made.words, None, given.max_width))
    both = made.json(given.language).join(made.vtt(given.max_lines, given.highlight), "interview_id")
    named = both.withColumn("interview_id", F.col("interview_id").cast("string"))
    written = files.write_files(named, given.out, {"json": ("json", ".json"), "vtt": ("vtts", ".vtt")}, "interview_id")
    count, failed = written.agg(F.sum("files"), F.count_if(F.col("files") < 2)).first()
    return count or 0, failed


def main(args: list[str] | None = None) -> int:
    """0, or 1 where an outcome is fatal; a recording that fails by itself is counted and changes no exit code."""
    began = time.monotonic()
    given = parser().parse_args(args)
    spark = get_session()
    done = listing.completed(spark, f"{given.out}/json")
    if given.command == "status":
        print(f"{listing.status(spark, f'{given.out}/json').first()['finished']} finished")
        for row in done.orderBy("id").toLocalIterator():
            print(row["id"])
        return 0
    seconds: dict[str, float] = {}
    words, turns = spark.read.parquet(given.words), spark.read.parquet(given.turns)
    with timed(seconds, "list"):
        if given.skip_list:
            done = done.union(listing.skip_list(spark, given.skip_list)).distinct()
        todo = materialize(pending(stored_items(spark, words, given), done, given.max_files), "todo")
    written = failed = 0
    rest = todo
    while True:
        batch = rest.orderBy("ord").limit(given.batch_files) if given.deadline_minutes else rest
        size, until = batch.agg(F.count(F.lit(1)), F.max("ord")).first()
        if not size or seconds_left(given.deadline_minutes, began) <= 0:
            break
        with timed(seconds, "write"):
            more, bad = write_batch(words, turns, rest.where(F.col("ord") <= until).select("interview_id"), given)
        written, failed, rest = written + more, failed + bad, rest.where(F.col("ord") > until)
    print(f"{written} files")
    print(json.dumps({"failed": failed, "left": rest.count(), "seconds": {k: round(v, 1) for k, v in seconds.items()}}))
    drop_tables(spark)
    fatal = bool(given.outcomes) and not spark.read.parquet(given.outcomes).where("outcome = 'fatal'").isEmpty()
    return int(fatal)


if __name__ == "__main__":
    raise SystemExit(main())
