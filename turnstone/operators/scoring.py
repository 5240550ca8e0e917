"""Transcripts against references: word and character error rates, and a status for every word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.functions.edits import KINDS, align, char_distance
from turnstone.functions.text import normalize_for_scoring, split_words
from turnstone.session import materialize, ship


def reference_tokens(references: DataFrame) -> DataFrame:
    """interview_id, idx and token: the normalised, non-empty tokens of reference_text, in the order of idx."""
    flat = references.select("interview_id", F.posexplode(split_words(F.col("reference_text"))).alias("idx", "word"))
    return flat.select("interview_id", "idx", normalize_for_scoring("word").alias("token")).where("token <> ''")


def scored_words(words: DataFrame) -> DataFrame:
    """Words with their normalised token, which may be empty."""
    return words.withColumn("token", normalize_for_scoring("text"))


def _aligned(said: pa.Table, heard: pa.Table) -> pa.Table:
    """The operations of one recording, from its reference's and its words' tokens (key, idx, token)."""
    said, heard = (side.sort_by("idx").combine_chunks() for side in (said, heard))
    kinds, rows, columns = align(said["token"].to_pylist(), heard["token"].to_pylist()) if said.num_rows else (np.zeros(0, np.int8), *[np.zeros(0, np.int32)] * 2)
    ref, hyp = pa.array(rows, mask=rows < 0), pa.array(columns, mask=columns < 0)
    key = (said if said.num_rows else heard)["interview_id"].combine_chunks().take(pa.array(np.zeros(len(kinds), np.int64)))
    names = pa.DictionaryArray.from_arrays(pa.array(kinds), pa.array(KINDS)).cast(pa.string())
    place = pa.array(np.arange(len(kinds), dtype=np.int32))
    taken = [said["token"].combine_chunks().take(ref), heard["token"].combine_chunks().take(hyp), heard["idx"].combine_chunks().cast(pa.int64()).take(hyp)]
    return pa.Table.from_arrays([key, place, names, ref, hyp, *taken], ["interview_id", "place", "kind", "ref_index", "hyp_index", "reference", "token", "idx"])


def operations(words: DataFrame, references: DataFrame) -> DataFrame:
    """One row an edit operation of every recording with a reference: interview_id, place, kind (match, substitution, deletion,
    insertion), ref_index and hyp_index (places among the non-empty tokens), reference and token, and idx of the word.

    words: see scored_words. Tokens of both sides are brought together by recording, as rows, and no cell holds
    more than one of them; recordings of any length are aligned, in time of their length times their errors."""
    ship(words.sparkSession)
    heard = words.where("token <> ''").select("interview_id", "idx", "token")
    said = reference_tokens(references)
    key, number = (heard.schema[c].dataType.simpleString() for c in ("interview_id", "idx"))
    said = said.select(F.col("interview_id").cast(key).alias("interview_id"), "idx", "token")
    made = said.groupBy("interview_id").cogroup(heard.groupBy("interview_id")).applyInArrow(
        _aligned, f"interview_id {key}, place int, kind string, ref_index int, hyp_index int, reference string, token string, idx long"
    )
    return made.withColumn("idx", F.col("idx").cast(number))


def tag_words(words: DataFrame, found: DataFrame) -> DataFrame:
    """words with status and reference, where an operation (see operations) touches them."""
    status = F.when(F.col("kind") == "match", "correct").otherwise(F.col("kind"))
    touched = found.where("idx IS NOT NULL").select("interview_id", "idx", status.alias("status"), "reference")
    own = [c for c in words.columns if c not in {"status", "reference"}]
    return words.select(*own).join(touched, ["interview_id", "idx"], "left").select(*own, "status", "reference")


def error_rates(words: DataFrame, references: DataFrame) -> DataFrame:
    """One row a recording with a reference: words, hits, errors, rates and mean confidences, to 4 places."""
    tokens = scored_words(words)
    found = materialize(operations(tokens, references), "operations")
    tagged = tag_words(tokens, found)
    mean = lambda c: F.round(F.avg(c.try_cast("decimal(20,12)")), 4).cast("double")  # noqa: E731  the same in any order
    means = tagged.groupBy("interview_id").agg(
        mean(F.col("confidence")).alias("mean_confidence"),
        mean(F.when(F.col("status") == "correct", F.col("confidence"))).alias("mean_confidence_correct"),
        mean(F.when(F.col("status") == "substitution", F.col("confidence"))).alias("mean_confidence_incorrect"),
    )
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("place", F.col(c).alias("t"))))), lambda t: t["t"]), "")
    counted = found.groupBy("interview_id").agg(
        F.count("ref_index").alias("reference_words"),
        F.count("hyp_index").alias("hypothesis_words"),
        *[F.count_if(F.col("kind") == k).alias(n) for k, n in (("match", "hits"), ("substitution", "substitutions"), ("deletion", "deletions"), ("insertion", "insertions"))],
        joined("reference").alias("said"),
        joined("token").alias("heard"),
    )
    counted = counted.withColumn("ref_chars", F.length("said")).withColumn("char_edits", char_distance("said", "heard"))
    errors = F.col("substitutions") + F.col("deletions") + F.col("insertions")
    rated = counted.select(
        "*",
        F.round(errors / F.col("reference_words"), 4).alias("wer"),
        F.round(F.col("hits") / F.col("reference_words"), 4).alias("word_accuracy"),
        F.round(F.col("char_edits") / F.greatest(F.lit(1), "ref_chars"), 4).alias("cer"),
    )
    return rated.drop("ref_chars", "char_edits", "said", "heard").join(means, "interview_id", "left")
