"""Listings and small JSON inputs, as DataFrames."""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.functions.text import basename, slug, stem
from turnstone.operators.ordinals import number_rows

# Suffixes of recordings.
AUDIO_SUFFIXES = (".mp3", ".wav", ".m4a", ".flac", ".ogg", ".mp4", ".mkv", ".mov")
PREPARED = ".prepared.wav"
#: What stands before a path in a file system.
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?/+"


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """path of every file under root. Only names are read: contents are pruned from the scan."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(root).select("path")


def find_recordings(spark: SparkSession, root: str, exclude: str | None = None) -> DataFrame:
    """ord and path of recordings under root, by the parts of their paths; prepared copies, by their suffix as it is
    written, and what is inside an excluded folder are left out."""
    files = list_files(spark, root)
    lower = F.lower("path")
    kept = F.lit(False)
    for suffix in AUDIO_SUFFIXES:
        kept = kept | F.endswith(lower, F.lit(suffix))
    kept = kept & ~F.endswith("path", F.lit(PREPARED))
    if exclude:
        folder = re.sub(_SCHEME, "/", exclude) if re.match(_SCHEME, exclude) else os.path.abspath(exclude)
        kept = kept & ~F.startswith(F.regexp_replace("path", _SCHEME, "/"), F.lit(os.path.normpath(folder).rstrip("/") + "/"))
    return numbered(files.where(kept), F.split("path", "/"))


def numbered(rows: DataFrame, column: str | Column) -> DataFrame:
    """rows with ord, their place in the column's order, found by ranges and not in one task."""
    return number_rows(rows, column, name="ord")


def completed(spark: SparkSession, json_dir: str) -> DataFrame:
    """id of every finished recording: the stems of json_dir/*.json; none where the folder is missing."""
    try:
        return list_files(spark, json_dir, "*.json").select(stem(F.col("path")).alias("id")).distinct()
    except AnalysisException:
        return spark.createDataFrame([], "id string")


def status(spark: SparkSession, json_dir: str) -> DataFrame:
    """finished: how many recordings are; `completed` has which."""
    return completed(spark, json_dir).agg(F.count(F.lit(1)).alias("finished"))


def skip_list(spark: SparkSession, path: str) -> DataFrame:
    """id of a JSON array of names; none where the file is missing or can't be read."""
    try:
        rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("id"))
        return rows.where("id IS NOT NULL").distinct()
    except AnalysisException:
        return spark.createDataFrame([], "id string")


ENTRY = "struct<name:string,id:string,audio:string,audio_url:string,url:string,vtt:string>"


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a JSON file, with ord: an array, or an object that holds one as items or entries; otherwise none."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "ord int, name string, id string, audio string, audio_url string, url string, vtt string")
    return entries_of(text, "value")


def entries_of(rows: DataFrame, column: str) -> DataFrame:
    """Entries of JSON documents in a column."""
    many = f"array<{ENTRY}>"
    boxed = F.from_json(column, f"struct<items:{many},entries:{many}>")
    plain = F.when(F.startswith(F.ltrim(F.col(column)), F.lit("[")), F.from_json(column, many))
    found = rows.select(F.posexplode(F.coalesce(plain, boxed["items"], boxed["entries"])).alias("ord", "e"))
    return found.select("ord", "e.*")


def published_names(spark: SparkSession, path: str) -> DataFrame:
    return read_entries(spark, path).where("coalesce(name, '') <> ''").select("name").distinct()


def sheet_folders(spark: SparkSession, path: str, column: str = "as", limit: int = 0) -> DataFrame:
    """Folder names of a CSV export's column, where each first comes; blank cells read as 'nan', as they always did."""
    from turnstone.operators.worklist import distinct_folders

    rows = spark.read.csv(path, header=True)
    if column not in rows.columns:
        return spark.createDataFrame([], "folder string, ord long")
    placed = rows.select(F.monotonically_increasing_id().alias("ord"), F.coalesce(column, F.lit("nan")).alias("value"))
    return distinct_folders(placed, limit)


def resolve_source(source: str | None = None, from_json: bool = False) -> str:
    """Where recordings come from: the source that is named, or else json if wanted, or else smb."""
    return source if source and source != "auto" else "json" if from_json else "smb"


def work_items(spark: SparkSession, source: str, where: str, folders: list[str] | None = None) -> DataFrame:
    """Items (ord, id, kind, ...) of a folder (local), a JSON work list (json) or the folders of a mounted share (smb)."""
    from turnstone.operators import worklist

    if source == "local":
        return worklist.items_from_paths(find_recordings(spark, where))
    if source == "json":
        return worklist.items_from_entries(read_entries(spark, where))
    if source != "smb":
        raise ValueError(f"unknown source: {source}")
    from turnstone.session import ship
    from turnstone.sources.folders import FolderSource

    ship(spark)
    spark.dataSource.register(FolderSource)
    found = spark.read.format("audio_folders").options(root=where, folders=",".join(folders or [])).load()
    named = numbered(found, "remote_path")
    return named.select("ord", slug(stem(F.col("name"))).alias("id"), F.lit("smb").alias("kind"), "remote_path", "folder")


def count_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """files: the number under root with one of the suffixes, as they are written."""
    files = list_files(spark, root)
    wanted = F.lit(not suffixes)
    for suffix in suffixes:
        wanted = wanted | F.endswith("path", F.lit(suffix))
    return files.where(wanted).agg(F.count(basename(F.col("path"))).alias("files"))
