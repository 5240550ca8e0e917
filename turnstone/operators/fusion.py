"""Speakers for words: the turn with the largest overlap, or else a near one; then segments and their statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstone.functions.text import join_words
from turnstone.operators.ordinals import free_name
from turnstone.operators.words import ordered
from turnstone.session import ship, spread

MAX_GAP = 1.0
#: Words are dealt into slices of so many seconds of their recording, which are swept one by one.
SLICE_SECONDS = 1800.0
#: Pairs of words and turns that a sweep looks at together.
PAIRS = 1 << 20


def _slice(time):
    return F.floor(time / SLICE_SECONDS)


def turns_by_slice(words: DataFrame, turns: DataFrame, max_gap: float = MAX_GAP) -> DataFrame:
    """Turns with rank (their place by start, end and original place) and slice, one row for each slice that needs them.

    A slice needs every turn that comes within max_gap of one of its words, which may reach out of it as far as the
    recording's longest word, and the last turn that begins before all later ones it does not need: so the lowest rank
    that ends after a word, and what ranks beside it, are the same in the slice as in the whole recording."""
    one = Window.partitionBy("interview_id").orderBy("start", "end", "turn_ix")
    ranked = turns.select("interview_id", "turn_ix", "start", "end", "speaker", (F.row_number().over(one) - 1).alias("rank"), F.lead("start").over(one).alias("next"))
    facts = words.groupBy("interview_id").agg(F.greatest(F.lit(0.0), F.max(F.col("end") - F.col("start"))).alias("longest"), F.max("start").alias("last_start"))
    known = ranked.where("start IS NOT NULL AND end IS NOT NULL").join(facts, "interview_id")
    early = lambda t: F.col(t) - max_gap - F.col("longest")
    until = F.least(F.col("last_start"), F.greatest(F.col("end") + max_gap, F.coalesce(early("next"), "last_start")))
    first = _slice(F.greatest(F.lit(0.0), early("start")))
    copied = known.withColumn("slice", F.explode(F.when(first <= _slice(until), F.sequence(first, _slice(until)))))
    return copied.select("interview_id", "slice", "rank", F.col("start").alias("ts"), F.col("end").alias("te"), F.col("turn_ix").alias("turn"), F.col("speaker").alias("name"))


def sweep(ws: np.ndarray, we: np.ndarray, ts: np.ndarray, te: np.ndarray, rank: np.ndarray, max_gap: float) -> tuple[np.ndarray, np.ndarray]:
    """Of words (start, end) the place of each one's turn, -1 if it has none, and the overlap, 0 for one that is only near.

    Turns come by rank, so by start, and the running maximum of their ends rises: two searches give the turns that can
    overlap a word, and one the lowest rank that ends at or after its start, beside which near turns are looked for."""
    reach = np.maximum.accumulate(te)
    low, high = np.searchsorted(reach, ws, "right"), np.searchsorted(ts, we, "left")
    sizes = np.where(we > ws, np.maximum(0, high - low), 0)
    turn, overlap = np.full(len(ws), -1, np.int64), np.zeros(len(ws))
    some = np.flatnonzero(sizes)
    bounds = np.cumsum(sizes[some])
    begin = 0
    while begin < len(some):
        stop = max(begin + 1, int(np.searchsorted(bounds, (bounds[begin - 1] if begin else 0) + PAIRS, "right")))
        mine, counts = some[begin:stop], sizes[some[begin:stop]]
        firsts = np.cumsum(counts) - counts
        word = np.repeat(mine, counts)
        at = low[word] + np.arange(len(word)) - np.repeat(firsts, counts)
        shared = np.where(te[at] > ts[at], np.minimum(we[word], te[at]) - np.maximum(ws[word], ts[at]), 0)
        best = np.maximum.reduceat(shared, firsts)
        top = np.flatnonzero(shared == np.repeat(best, counts))
        lowest = top[np.searchsorted(top, firsts)]  # ties go to the lower rank
        good = best > 0
        turn[mine[good]], overlap[mine[good]] = at[lowest[good]], best[good]
        begin = stop
    left = np.flatnonzero(turn < 0)
    if len(left) and len(ts):
        ahead = np.searchsorted(reach, ws[left], "left")
        cursor = np.where(ahead < len(rank), rank[np.minimum(ahead, len(rank) - 1)], rank[-1] + 1)
        found, away = np.full(len(left), -1, np.int64), np.full(len(left), np.inf)
        for step in (-1, 0, 1):
            place = np.minimum(np.searchsorted(rank, cursor + step), len(rank) - 1)
            gap = np.maximum(0.0, np.maximum(ts[place] - we[left], ws[left] - te[place]))
            nearer = (rank[place] == cursor + step) & (gap < away)
            found[nearer], away[nearer] = place[nearer], gap[nearer]
        turn[left] = np.where(away <= max_gap, found, -1)
    return turn, overlap


def _runs(*columns: pa.Array) -> np.ndarray:
    """Places at which rows begin that are alike in the columns, and the number of rows."""
    return np.unique(np.concatenate([[0], *(pc.run_end_encode(c).run_ends.to_numpy() for c in columns)]))


def assign_speakers(words: DataFrame, turns: DataFrame, max_gap: float = MAX_GAP) -> DataFrame:
    """words with turn_ix, speaker, overlap (0 if by proximity, null if none) and by_proximity.

    words: interview_id, idx, start, end, ..., with starts that never fall (see clamp_words); turns: interview_id,
    turn_ix, start, end, speaker. A word's turn is the one that overlaps it most, the lower rank of equals; without any, the
    nearest of the lowest rank that ends at or after its start and that rank's neighbours, if no more than max_gap away. A longer
    turn further back is not looked at.

    Words are shuffled once, by recording and slice, and each slice is swept beside copies of the turns it needs, so a
    recording of any length is spread over tasks. In a sorted task a slice's turns come by rank, then its words; batches of
    many slices go to Python, or parts of one. Words without times, and turns without them, meet nothing."""
    own = [c for c in words.columns if c not in {"turn_ix", "speaker", "overlap", "by_proximity"}]
    part, beside, met = (free_name(words, stem) for stem in ("slice", "beside", "met"))
    kinds = {f.name: f.dataType for f in words.schema}
    turn_kind = turns.schema["turn_ix"].dataType.simpleString()
    name_kind = turns.schema["speaker"].dataType.simpleString()
    near = spread(turns_by_slice(words, turns, max_gap), "rank")  # few rows; never partitioned as words are, which a union could lose rows by
    none = [F.col("interview_id").cast(kinds[c]).alias(c) if c == "interview_id" else F.lit(None).cast(kinds[c]).alias(c) for c in own]
    copies = near.select(*none, F.col("slice").alias(part), F.struct("rank", F.col("ts").cast("double").alias("ts"), F.col("te").cast("double").alias("te"), "turn", "name").alias(beside))
    dealt = words.select(*own, F.coalesce(_slice(F.greatest(F.lit(0.0), "start")), F.lit(0)).alias(part), F.lit(None).cast(copies.schema[beside].dataType).alias(beside))

    @F.arrow_udf(f"struct<turn_ix:{turn_kind},speaker:{name_kind},overlap:double,by_proximity:boolean>")
    def meet(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        last, held = None, None  # what the batch before ended with: its recording and slice, and that slice's turns
        for ids, slices, starts, ends, spoken in batches:
            bounds, is_turn = _runs(ids, slices), spoken.is_valid().to_numpy(zero_copy_only=False)
            goes_on = len(ids) and last is not None and last[0].equals(ids[0]) and last[1].equals(slices[0])
            fresh = spoken.filter(spoken.is_valid())
            pool = pa.concat_arrays([held, fresh]) if goes_on else fresh
            until = np.concatenate(([0], np.cumsum(is_turn))) + len(pool) - len(fresh)
            rank, ts, te, turns_at, names = pool.flatten()
            rank, ts, te = rank.to_numpy(), ts.to_numpy(), te.to_numpy()
            ws, we = (c.to_numpy(zero_copy_only=False).astype(float) for c in (starts, ends))
            turn, overlap = np.full(len(ids), -1, np.int64), np.zeros(len(ids))
            begin = 0
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                begin, stop = until[a] if a else 0, until[b]
                first = a + int(is_turn[a:b].sum())
                if begin < stop and first < b:
                    found, overlap[first:b] = sweep(ws[first:b], we[first:b], ts[begin:stop], te[begin:stop], rank[begin:stop], max_gap)
                    turn[first:b] = np.where(found < 0, -1, found + begin)
            if len(ids):
                last, held = (ids[-1], slices[-1]), pool.slice(begin)
            at = pa.array(turn, mask=turn < 0)
            values = [turns_at.take(at), names.take(at), pa.array(overlap, mask=turn < 0), pa.array((turn >= 0) & (overlap == 0))]
            yield pa.StructArray.from_arrays(values, ["turn_ix", "speaker", "overlap", "by_proximity"], mask=pa.array(is_turn))

    ship(words.sparkSession)
    meet = meet.asNondeterministic()  # what it gives hangs on the rows before: Spark must neither drop the sort nor filter first
    both = spread(dealt.unionByName(copies), "interview_id", part).sortWithinPartitions("interview_id", part, F.col(beside).isNull(), F.col(beside)["rank"])
    swept = both.withColumn(met, meet("interview_id", part, "start", "end", beside)).where(F.col(met).isNotNull())
    return swept.select(*own, *(F.col(met)[c].alias(c) for c in ("turn_ix", "speaker", "overlap", "by_proximity")))


def mark_segments(assigned: DataFrame) -> DataFrame:
    """Assigned words with segment_index: it rises wherever the turn changes; no turn is a turn of its own kind."""
    order = Window.partitionBy("interview_id").orderBy("idx")
    changed = (F.row_number().over(order) == 1) | ~F.col("turn_ix").eqNullSafe(F.lag("turn_ix").over(order))
    marked = spread(assigned, "interview_id").withColumn("__new", changed.cast("int"))
    rows = order.rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("segment_index", (F.sum("__new").over(rows) - 1).cast("int")).drop("__new")


def segments(marked: DataFrame) -> DataFrame:
    """interview_id, segment_index, start (of the first word), end (of the last), text, speaker, n_words."""
    return marked.groupBy("interview_id", "segment_index").agg(
        F.min_by("start", "idx").alias("start"),
        F.max_by("end", "idx").alias("end"),
        join_words(ordered("idx", "text")).alias("text"),
        F.min_by("speaker", "idx").alias("speaker"),
        F.count(F.lit(1)).alias("n_words"),
    )


def fusion_stats(assigned: DataFrame, turns: DataFrame, interviews: DataFrame | None = None) -> DataFrame:
    """One row a recording: its counts of words and turns, fractions to 4 places, and sorted speakers.

    Recordings are those of `interviews` (interview_id), or else of words and turns. Without words, no turn counts
    as empty and no speaker is listed; without turns, every word is unassigned and no speaker is listed."""
    length = F.greatest(F.greatest(F.lit(0.0), F.col("end") - F.col("start")), F.lit(1e-6))
    share = F.when(F.col("turn_ix").isNotNull(), F.least(F.lit(1.0), F.col("overlap") / length))
    words = assigned.groupBy("interview_id").agg(
        F.count(F.lit(1)).alias("words_total"),
        F.count("turn_ix").alias("words_assigned"),
        F.count_if(F.col("by_proximity")).alias("words_assigned_by_proximity"),
        F.count_distinct("turn_ix").alias("used"),
        F.avg(share).alias("share"),
    )
    spoken = turns.groupBy("interview_id").agg(F.count(F.lit(1)).alias("turns"), F.array_sort(F.collect_set("speaker")).alias("names"))
    every = interviews.select("interview_id").distinct() if interviews is not None else words.select("interview_id").union(spoken.select("interview_id")).repartition("interview_id").distinct()
    both = every.join(words, "interview_id", "left").join(spoken, "interview_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    some = F.col("words_total").isNotNull()
    return both.select(
        "interview_id",
        zero("words_total").alias("words_total"),
        zero("words_assigned").alias("words_assigned"),
        (zero("words_total") - zero("words_assigned")).alias("words_unassigned"),
        zero("words_assigned_by_proximity").alias("words_assigned_by_proximity"),
        zero("turns").alias("turns_total"),
        F.when(some, zero("turns") - zero("used")).otherwise(F.lit(0)).cast("long").alias("turns_without_words"),
        F.coalesce(F.round(F.col("words_assigned") / F.col("words_total"), 4), F.lit(0.0)).alias("assigned_fraction"),
        F.coalesce(F.round("share", 4), F.lit(0.0)).alias("mean_overlap_fraction"),
        F.when(some & F.col("names").isNotNull(), F.col("names")).otherwise(F.array().cast("array<string>")).alias("speakers"),
    )
