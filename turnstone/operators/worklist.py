"""Work lists: what there is, what is done, what is next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.functions.text import filename_from_url, folder_name, slug, stem

# Parts of messages after which a process can't go on.
UNRECOVERABLE = ("illegal memory access", "device-side assert", "CUDA error", "CUDA_ERROR", "cuDNN error")


def _given(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def items_from_entries(entries: DataFrame) -> DataFrame:
    """Configured entries (ord, name, id, audio, audio_url) as items to fetch: ord, id, kind, url, name, filename.
    The recording is audio, else audio_url; the name is name, else id; without either there is no item."""
    named = entries.select("ord", _given(F.col("audio"), F.col("audio_url")).alias("url"), _given(F.col("name"), F.col("id")).alias("name"))
    kept = named.where("url IS NOT NULL AND name IS NOT NULL")
    return kept.select("ord", slug(F.col("name")).alias("id"), F.lit("url").alias("kind"), "url", "name", filename_from_url(F.col("url"), F.col("name")).alias("filename"))


def items_from_paths(paths: DataFrame, ordinal: str = "ord") -> DataFrame:
    """Files (ord, path) as local items; the id is the plain stem."""
    return paths.select(F.col(ordinal).alias("ord"), stem(F.col("path")).alias("id"), F.lit("local").alias("kind"), "path")


def is_temporary(kind: Column) -> Column:
    """Whether a fetched copy may go after use."""
    return F.coalesce(kind, F.lit("local")) != "local"


def distinct_folders(values: DataFrame, limit: int = 0) -> DataFrame:
    """Folder names of a sheet's column (ord, value), each where it first comes, the first `limit` (0: all)."""
    names = values.select("ord", folder_name(F.trim("value")).alias("folder")).where("folder <> ''")
    first = names.groupBy("folder").agg(F.min("ord").alias("ord"))
    return first.orderBy("ord").limit(limit) if limit else first


def pending(items: DataFrame, done: DataFrame, limit: int = 0, limit_first: bool = False) -> DataFrame:
    """Items (ord, id, ...) that are not done (id), the first `limit` of them (0: all).

    limit_first: the limit holds for all items, before those done are left out; a run whose first items are all
    done then has nothing to do."""
    cut = lambda df: df.orderBy("ord").limit(limit) if limit else df
    names = done.select("id").distinct()
    return cut(items).join(names, "id", "left_anti") if limit_first else cut(items.join(names, "id", "left_anti"))


def is_unrecoverable(message: Column) -> Column:
    found = [F.contains(message, F.lit(m)) for m in UNRECOVERABLE]
    any_of = found[0]
    for f in found[1:]:
        any_of = any_of | f
    return F.coalesce(any_of, F.lit(False))


def is_unrecoverable_message(message: str) -> bool:
    return any(m in message for m in UNRECOVERABLE)


def valid_downloads(entries: DataFrame, limit: int = 0) -> DataFrame:
    """The older download list: the first `limit` entries, of which those with audio and a name; file by the older rule."""
    from turnstone.functions.text import stream_filename

    first = entries.orderBy("ord").limit(limit) if limit else entries
    kept = first.where("coalesce(audio, '') <> '' AND coalesce(name, '') <> ''")
    return kept.select("ord", "name", F.col("audio").alias("url"), F.col("name").alias("folder"), stream_filename(F.col("audio"), F.col("name")).alias("filename"))
