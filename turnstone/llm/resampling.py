"""Target-distribution importance resampling: documents drawn as often as their n-grams are usual in a target."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm.arrow import annotate, pieces, raw
from turnstone.operators.ordinals import free_name, number_rows
from turnstone.session import materialize, ship

#: Longest run of words that is a feature, buckets that features are hashed into, and the seed of the draw.
ORDER = 1
BUCKETS = 10_000
SEED = "2024"
PERCENT = 10
LEAST_WORDS = 20
#: A worker forgets its dictionary once it has so many words; they are numbered and hashed anew.
MAX_WORDS = 1 << 20

#: A-Z as a-z, and every byte that is in no word as a blank.
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20 for b in range(256))


class _Dictionary(dict):
    """Word -> id, counted up; spelled has each id's word and crc its CRC-32."""

    def __init__(self) -> None:
        super().__init__()
        self.spelled: list[bytes] = []
        self.crc = np.zeros(1 << 12, np.uint32)

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self.spelled)
        self.spelled.append(word)
        if place == len(self.crc):
            self.crc = np.concatenate((self.crc, np.zeros_like(self.crc)))
        self.crc[place] = zlib.crc32(word)
        return place


class Features:
    """Hashes the n-grams of texts by an integer dictionary of words.

    Words are numbered, an n-gram is a tuple of numbers (that of its first words and its last word's, in one integer),
    and of the tuples of a piece of texts each distinct one is hashed once: CRC-32 goes on from the first words' value
    over a blank and the last word, which is the CRC-32 of the whole n-gram's bytes. The values are then joined back to
    all places of the tuple. Single words are hashed once for all pieces that the worker sees.
    """

    def __init__(self, order: int = ORDER, buckets: int = BUCKETS) -> None:
        self.order, self.buckets = order, buckets
        self.words = _Dictionary()

    def __call__(self, texts: Sequence[bytes | None]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Words of each text, and for each n the texts and the buckets of all n-grams, repeats too."""
        if len(self.words) > MAX_WORDS:
            self.words = _Dictionary()
        held = [(t or b"").translate(_PLAIN).split() for t in texts]
        sizes = np.fromiter(map(len, held), np.int64, len(held))
        number = self.words.__getitem__
        ids = np.fromiter((number(w) for some in held for w in some), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(held)), sizes)
        tuples, crcs = ids, self.words.crc[ids]
        found = [(owner, crcs % np.uint32(self.buckets))]
        base = len(self.words) + 1
        for n in range(2, self.order + 1):
            whole = owner[n - 1 :] == owner[: max(0, len(owner) - n + 1)]
            packed = np.where(whole, tuples[: len(whole)] * base + ids[n - 1 :][: len(whole)], -1)
            distinct, first, back = np.unique(packed, return_index=True, return_inverse=True)
            values = np.fromiter(
                (zlib.crc32(b" " + self.words.spelled[ids[i + n - 1]], int(crcs[i])) if p >= 0 else 0 for p, i in zip(distinct.tolist(), first.tolist(), strict=True)), np.uint32, len(distinct)
            )
            tuples, crcs = back.reshape(-1), values[back.reshape(-1)]
            found.append((owner[: len(whole)][whole], crcs[whole] % np.uint32(self.buckets)))
        return sizes, found


def bucket_counts(texts: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n: the features of all texts that fall into each bucket with any. A task sends a row a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(order, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            column = raw(batch.column(0))
            for begin, end in pieces(column):
                for _, places in features(column[begin:end])[1]:
                    total += np.bincount(places, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    ship(texts.sparkSession)
    return texts.select(F.col(f"`{text}`")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain: 1000 times the logarithm of how much more usual it is in the target, with one added to each
    bucket, rounded down. An array of `buckets` numbers, whatever the input."""
    counted = lambda rows, column, name: bucket_counts(rows, column, order, buckets).select("bucket", F.col("n").cast("double").alias(name))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(counted(docs, text, "s"), "bucket", "left").join(counted(target, target_text, "t"), "bucket", "left").fillna(0.0)
    both = materialize(both, "buckets")
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    rows = both.crossJoin(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).collect()  # `buckets` rows beside one
    found = np.zeros(buckets, np.int64)
    found[[r.bucket for r in rows]] = [r.gain for r in rows]
    return found


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())]


def _weigher(gain: np.ndarray, order: int) -> Callable[[list[bytes | None]], list[list]]:
    features = Features(order, len(gain))

    def weigh_texts(texts: list[bytes | None]) -> list[list]:
        sizes, found = features(texts)
        counts, weights = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for owner, places in found:
            counts += np.bincount(owner, minlength=len(texts))
            sums = np.concatenate(([0], np.cumsum(gain[places])))  # owners rise
            weights += np.diff(sums[np.searchsorted(owner, np.arange(len(texts) + 1))])
        return [sizes.tolist(), counts.tolist(), weights.tolist()]

    return weigh_texts


def weigh(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", order: int = ORDER, buckets: int = BUCKETS, keep: Sequence[str] | None = None) -> DataFrame:
    """docs' columns (or those in keep) with n_words, n_features and weight, the sum of its features' gains.

    Texts are read twice, once for the counts and once for the weights, and never shuffled: what is exchanged is a count a
    bucket and task. A null or empty text has no features and weight 0; an empty target makes all gains what is rare
    in docs; columns named like a result are replaced."""
    gain = gains(docs, target, text, target_text, order, buckets)
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # `buckets` numbers
    return annotate(docs, text, lambda: _weigher(shared.value, order), FIELDS, keep)


def gumbel_score(key: Column, weight: Column, seed: str = SEED) -> Column:
    """weight with noise of the key, so that the highest scores are a draw without replacement; a null key is an empty one."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    even = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return weight + F.floor(-1000 * F.log(-F.log(even))).cast("long")


def draw(weighed: DataFrame, key: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """weighed with score and rank: of the rows with at least least_words words the highest `percent` hundredths by score
    have ranks from 1, the others null.

    Ties go to the smaller key, then to fewer features and the smaller weight; null keys come last. Rows are ordered by ranges,
    not in one task; a hot score or key is parted by what follows it in the order."""
    kept = [c for c in weighed.columns if c not in {"score", "rank"}]
    scored = weighed.select(*[F.col(f"`{c}`") for c in kept], gumbel_score(F.col(f"`{key}`"), F.col("weight"), seed).alias("score"))
    row = free_name(scored, "row")
    scored = materialize(scored.withColumn(row, F.monotonically_increasing_id()), "scored")
    long_enough = F.col("n_words") >= least_words
    size = scored.agg(F.count_if(long_enough).alias("n")).first().n
    order = [F.desc(long_enough), F.desc("score"), F.asc_nulls_last(f"`{key}`"), F.asc("n_features"), F.asc("weight"), F.asc(row)]
    placed = number_rows(scored, *order, name="rank", first=1)
    drawn = long_enough & (F.col("rank") <= size * percent // 100)
    return placed.withColumn("rank", F.when(drawn, F.col("rank"))).drop(row)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of docs with all their columns, n_words, n_features, weight, score and rank; options: see weigh, draw."""
    drawing = {k: options.pop(k) for k in ("percent", "least_words", "seed") if k in options}
    return draw(weigh(docs, target, **options), key, **drawing).where("rank IS NOT NULL")


def report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_features, weight, score, rank."""
    found = draw(weigh(docs.select("doc_id", "text"), target, keep=["doc_id"]))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 has no function here: its table is made by the rule of its polynomial, and it is folded over a word's bytes.
ORACLE_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT range AS b, range::BIGINT AS v, 0 AS k FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8
),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8),
plain AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
),
wanted AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
),
spoken AS (SELECT doc_id, unnest(words) AS word FROM plain),
asked AS (SELECT unnest(words) AS word FROM wanted),
vocabulary AS (SELECT word FROM spoken UNION SELECT word FROM asked),
letters AS (SELECT word, hex(encode(word)) AS h FROM vocabulary),
hashed AS (
  SELECT word, xor(list_reduce(
    list_transform(range(0, length(h), 2), lambda i: ('0x' || substr(h, i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket
  FROM letters, crc_table
),
s_counts AS (SELECT bucket, count(*)::DOUBLE AS s FROM spoken JOIN hashed USING (word) GROUP BY bucket),
t_counts AS (SELECT bucket, count(*)::DOUBLE AS t FROM asked JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*)::DOUBLE FROM spoken) AS all_s, (SELECT count(*)::DOUBLE FROM asked) AS all_t),
gain AS (
  SELECT b.range AS bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((coalesce(s, 0) + 1) * (all_t + 10000))))::BIGINT AS gain
  FROM range(10000) b LEFT JOIN s_counts ON s_counts.bucket = b.range LEFT JOIN t_counts ON t_counts.bucket = b.range, totals
),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM spoken JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM plain LEFT JOIN weights USING (doc_id)
),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, r.rank FROM scored s
LEFT JOIN (SELECT * FROM ranked WHERE rank <= (SELECT 10 * count(*) // 100 FROM ranked)) r USING (doc_id)
"""
