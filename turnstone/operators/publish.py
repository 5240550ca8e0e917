"""Publishing: links of what was written, and the merge into the published index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstone.functions.text import published_url, stem


def file_links(json_files: DataFrame, vtt_files: DataFrame, base: str) -> DataFrame:
    """name, json_url, vtt_url of everything that has either file (path); a missing side is null."""
    side = lambda files, kind, suffix: files.select(stem(F.col("path")).alias("name")).distinct().select("name", published_url(base, kind, F.col("name"), suffix).alias(f"{kind.rstrip('s')}_url"))
    return side(json_files, "json", ".json").join(side(vtt_files, "vtts", ".vtt"), "name", "full_outer")


def link_entries(entries: DataFrame, links: DataFrame) -> DataFrame:
    """Processed entries (ord, name, folder, audio) that have a link, as index rows: ord, name, audio, url, vtt."""
    by_folder = links.select(F.col("name").alias("folder"), "json_url", "vtt_url")
    both = entries.withColumn("folder", F.coalesce("folder", "name")).join(by_folder, "folder", "left")
    text = lambda c: F.coalesce(c, F.lit(""))
    rows = both.select("ord", "name", text("audio").alias("audio"), text("json_url").alias("url"), text("vtt_url").alias("vtt"))
    return rows.where("url <> '' OR vtt <> ''")


def merge_index(published: DataFrame, new: DataFrame) -> DataFrame:
    """The index (ord, name, ...) with new rows of the same columns: a name that is there is replaced in its place by
    the last new row of that name; other new rows, also repeated and nameless ones, follow in their order.
    is_new and ord tell where a row stands."""
    own = [c for c in published.columns if c not in {"ord", "name"}]
    last = Window.partitionBy("name").orderBy(F.desc("ord"))
    newest = new.where("coalesce(name, '') <> ''").withColumn("__r", F.row_number().over(last)).where("__r = 1")
    newest = newest.select("name", F.struct(*own).alias("fresh"))
    kept = published.join(newest, "name", "left")
    merged = kept.select("ord", "name", *[F.when(F.col("fresh").isNotNull(), F.col(f"fresh.{c}")).otherwise(F.col(c)).alias(c) for c in own], F.lit(False).alias("is_new"))
    taken = published.where("coalesce(name, '') <> ''").select("name").distinct()
    added = new.join(taken, "name", "left_anti").select("ord", "name", *own, F.lit(True).alias("is_new"))
    return merged.unionByName(added)


def merge_counts(published: DataFrame, new: DataFrame) -> DataFrame:
    """new, updated, total of a merge."""
    merged = merge_index(published, new).select(F.lit("index").alias("side"), "is_new")
    rows = merged.union(new.select(F.lit("given"), F.lit(False)))
    added, given, total = F.count_if("is_new"), F.count_if(F.col("side") == "given"), F.count_if(F.col("side") == "index")
    return rows.agg(added.alias("new"), (given - added).alias("updated"), total.alias("total"))
