"""Lists that others read as one JSON file: work lists, finished recordings, the published index."""

from __future__ import annotations

import json
import shutil
import uuid
from pathlib import Path
from textwrap import indent

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.operators.publish import merge_counts, merge_index
from turnstone.session import ship
from turnstone.sources.publishing import join_parts, publish


def raw_entries(spark: SparkSession, path: str) -> DataFrame:
    """ord, name and entry (JSON, with all its fields) of a file's JSON array; none where it is missing or unreadable."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "ord int, name string, entry string")
    flat = text.select(F.posexplode(F.from_json("value", "array<string>")).alias("ord", "entry")).where("entry IS NOT NULL")
    return flat.select("ord", F.get_json_object("entry", "$.name").alias("name"), "entry")


@F.pandas_udf(T.StringType())
def _entry_text(entries: pd.Series) -> pd.Series:
    """Each JSON text as an indented entry of an array, after a comma and a line end."""
    return entries.map(lambda e: ",\n" + indent(json.dumps(json.loads(e), indent=2), "  "))


def write_array(rows: DataFrame, path: str, *order: str, entry: str = "entry") -> int:
    """Write a column of JSON texts, sorted, as one indented JSON array; the number of entries.

    Tasks write the sorted parts beside the file, and one task puts them together; nothing passes the driver. The file at
    path, on a mounted folder, is replaced only once the new one is whole, so rows may come from the file itself."""
    target = Path(path).absolute()
    target.parent.mkdir(parents=True, exist_ok=True)
    parts = target.with_name(f".{uuid.uuid4().hex}.parts")
    ship(rows.sparkSession)
    seen = Observation()
    counted = rows.orderBy(*order).select(entry).observe(seen, F.count(F.lit(1)).alias("n"))
    try:
        publish(counted.select(F.format_string("part-%09d", F.spark_partition_id()).alias("path"), _entry_text(entry).alias("content")), str(parts))
        join_parts(rows.sparkSession, str(parts), str(target), b"[", b"\n]", 1)
    finally:
        shutil.rmtree(parts, ignore_errors=True)
    return int(seen.get["n"])


def write_work_list(entries: DataFrame, path: str) -> int:
    """Write entries (ord and any columns) in order; a field that is null is left out."""
    fields = F.to_json(F.struct(*[c for c in entries.columns if c != "ord"]))
    return write_array(entries.select("ord", fields.alias("entry")), path, "ord")


def write_names(done: DataFrame, path: str) -> int:
    """Write the ids of recordings as a sorted array, as `listing.skip_list` reads it."""
    text = F.regexp_replace(F.to_json(F.array("id")), r"^\[|\]$", "")
    return write_array(done.select("id", text.alias("entry")), path, "id")


def publish_index(new: DataFrame, path: str) -> dict[str, int]:
    """Merge rows (ord, name, ...) into the index at path (see `publish.merge_index`); new, updated and total.

    Entries that stay keep all their fields; one that is replaced is the new row alone. An index that can't be read
    counts as empty."""
    fields = F.to_json(F.struct(*[c for c in new.columns if c != "ord"]))
    fresh = new.select("ord", "name", fields.alias("entry"))
    published = raw_entries(new.sparkSession, path)
    counts = merge_counts(published, fresh).first().asDict()
    write_array(merge_index(published, fresh), path, "is_new", "ord")
    return counts
