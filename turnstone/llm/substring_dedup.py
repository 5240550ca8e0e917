"""Substring dedup: words covered by a window of words that also starts earlier in the corpus are removed."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from turnstone.llm import sketch
from turnstone.llm.arrow import raw
from turnstone.llm.hashing import U, split_words, window_hashes, word_hashes
from turnstone.llm.sketch import Layout
from turnstone.session import ship

WINDOW = 20
#: Words of the grams among which each window has its anchor, the one of least hash.
GRAM = 6
#: Documents are dealt into chunks of about so many bytes of text.
CHUNK_BYTES = 1 << 20
#: The sketch: rows, cells of each a byte of text (no bound) and an anchor, about.
ROWS = 2
CELLS_PER_BYTE = 0.08
CELLS_PER_ANCHOR = 4
#: Bits of a packed place that hold the start; a text has at most half as many words as bytes, and one more.
PLACE_BITS = 26
_NULL_IDS = -(1 << 62)
_LAST = U(2**64 - 1)


def _sliding(pick, values: np.ndarray, size: int) -> np.ndarray:
    """pick (minimum or maximum) over values[i : i + size], for every i; the last places see what is there."""
    out, span = values, 1
    while span < size:
        step = min(span, size - span)
        wider = out.copy()
        pick(out[:-step], out[step:], out=wider[:-step])
        out, span = wider, span + step
    return out


class Anchors:
    """The anchors of all windows of some texts.

    A window's anchor is the gram of least hash inside it. Equal windows have equal anchors, at the same distance
    from their starts, so windows that start at several places have as many anchors: the count of a window's anchor is never
    below the window's own. One word in eight or so starts an anchor, so it is anchors that are sketched.
    """

    def __init__(self, texts: list[bytes | None], size: int):
        self.words = split_words(texts)
        self.size, gram = size, min(GRAM, size)
        self.span = size - gram + 1
        self.hashes = word_hashes(self.words)
        bounds, n = self.words.bounds, len(self.hashes)
        at, grams = window_hashes(self.hashes, bounds, gram)
        self.grams = np.full(n, _LAST, U)
        self.grams[at] = grams & ~U(1)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.starts = np.flatnonzero(text[: n - size + 1] == text[size - 1 :]) if n >= size else np.zeros(0, np.int64)
        least = np.zeros(n + self.span - 1, U)
        least[self.starts + self.span - 1] = _sliding(np.minimum, self.grams, self.span)[self.starts]
        self.places = np.flatnonzero((_sliding(np.maximum, least, self.span)[:n] == self.grams) & (self.grams != 0))

    def names(self, which: int = 0) -> np.ndarray:
        """The hashes of the windows themselves."""
        words = self.hashes if not which else word_hashes(self.words, which)
        return window_hashes(words, self.words.bounds, self.size, which)[1]

    def likely(self, hot: np.ndarray) -> np.ndarray:
        """Which windows have an anchor that is hot; hot goes with places."""
        marked = self.grams.copy()
        marked[self.places[hot]] |= U(1)
        return np.flatnonzero(_sliding(np.minimum, marked, self.span)[self.starts] & U(1))


def _ordered(table: pa.Table) -> tuple[pa.Table, list[bytes | None]]:
    """A chunk's documents in an order that doesn't depend on how they came, and their texts."""
    table = table.sort_by([("key", "ascending"), ("text", "ascending")]).combine_chunks()
    return table, raw(table["text"])


def _anchor_grams(size: int):
    def grams(table: pa.Table) -> np.ndarray:
        found = Anchors(raw(table["text"]), size)
        return found.grams[found.places]

    return grams


def _hot(found: Anchors, layout: Layout, side: pa.Table) -> np.ndarray:
    """Which anchors of a chunk are estimated repeated."""
    return sketch.at_least(layout, found.grams[found.places], side)[0]


def _occurrences(layout: Layout, size: int):
    """The windows of a chunk that are estimated repeated: 96 bits of hash, document and start."""
    names = pa.schema([("a", pa.int64()), ("b", pa.int32()), ("key", pa.int64()), ("start", pa.int32())])

    def emit(docs: pa.Table, side: pa.Table) -> pa.Table:
        if not docs.num_rows or not side.num_rows:
            return names.empty_table()
        docs, texts = _ordered(docs)
        found = Anchors(texts, size)
        likely = found.likely(_hot(found, layout, side))
        if not len(likely):
            return names.empty_table()
        doc = np.searchsorted(found.words.bounds, found.starts[likely], side="right") - 1
        return pa.Table.from_arrays(
            [
                pa.array(found.names()[likely].view(np.int64)),
                pa.array((found.names(1)[likely] >> U(32)).astype(np.uint32).view(np.int32)),
                pa.array(docs["key"].to_numpy()[doc]),
                pa.array((found.starts[likely] - found.words.bounds[doc]).astype(np.int32)),
            ],
            schema=names,
        )

    return emit


def _remove(layout: Layout, size: int, names: pa.Schema):
    """A chunk's documents without the words of windows that are estimated repeated and are not the first of theirs."""

    def remove(docs: pa.Table, side: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return names.empty_table()
        docs, texts = _ordered(docs)
        found = Anchors(texts, size)
        gone = np.zeros(len(found.hashes) + 1, np.int32)
        bounds = found.words.bounds
        if len(found.places):
            likely = found.likely(_hot(found, layout, side))
            starts, low = found.starts[likely], (found.names()[likely] & U(0xFFFFFFFF)).astype(np.int64)
            doc = np.searchsorted(bounds, starts, side="right") - 1
            firsts = side.filter(pa.compute.is_valid(side["key"]))
            # a first place: the document, numbered within the chunk, then its start and 32 bits of the window's hash
            keys = docs["key"].to_numpy()
            known, number = np.unique(keys, return_inverse=True)
            owner = np.searchsorted(known, firsts["key"].to_numpy())
            marks = np.stack((owner, firsts["mark"].to_numpy()), 1)
            mine = np.stack((number[doc], ((starts - bounds[doc]) << 32) | low), 1)
            _, at = np.unique(np.concatenate((marks, mine)), axis=0, return_inverse=True)
            first = np.zeros(len(marks) + len(mine), bool)
            first[at[: len(marks)]] = True
            later = starts[~first[at[len(marks) :]]]
            gone[later] += 1
            np.subtract.at(gone, later + size, 1)
        stays = np.cumsum(gone[:-1]) == 0
        kept = []
        for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
            tokens = (text or b"").split()
            kept.append(b" ".join(tokens if stays[a:b].all() else compress(tokens, stays[a:b])))
        sums = np.concatenate(([0], np.cumsum(~stays)))
        made = [pa.array(np.diff(bounds), pa.int64()), pa.array(sums[bounds[1:]] - sums[bounds[:-1]], pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.Table.from_arrays([docs[names.names[0]], *made], schema=names)

    return remove


def _first_places(rows: DataFrame, low: int | None, high: int | None, longest: int | None) -> DataFrame:
    """key and mark (start, and 32 bits of hash) of where each window starts for the first time.

    rows: a, b, key, start. A window's first place is a minimum, so occurrences are brought together by partial
    aggregation, however many there are. A place is one number where ids and lengths allow, which keeps the shuffle
    small, or else a pair.
    """
    if low is not None and low >= 0 and high < 1 << (63 - PLACE_BITS) and (longest or 0) < 2 << PLACE_BITS:
        place = F.shiftleft("key", PLACE_BITS).bitwiseOR(F.col("start").cast("long"))
        packed = rows.select("a", "b", place.alias("place")).groupBy("a", "b").agg(F.min("place").alias("place"))
        start = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
        first = packed.select("a", F.shiftright("place", PLACE_BITS).alias("key"), start.alias("start"))
    else:
        first = rows.groupBy("a", "b").agg(F.min(F.struct("key", "start")).alias("first")).select("a", "first.key", "first.start")
    mark = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("a").bitwiseAND(F.lit(0xFFFFFFFF)))
    return first.select("key", mark.alias("mark"))


def _document_key() -> Column:
    """doc_id; rows without one have keys below all ids, by a hash of their text."""
    hidden = F.lit(_NULL_IDS) - F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))
    return F.coalesce(F.col("doc_id").cast("long"), hidden)


def remove_repeats(docs: DataFrame, size: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns in `keep`) with n_words, n_removed and kept_text.

    Every word of text that lies in a window of `size` words whose sequence also starts earlier is removed:
    earlier is a smaller doc_id, or the same and a smaller start. Windows are judged on the input. kept_text has
    the other words, joined by one space.

    Documents are dealt into chunks by a hash of their id, once; all passes read the same exchange. First pass: each
    chunk counts its windows' anchors in a count-min sketch; the chunks' sketches are merged by shard, and the shard
    answers each chunk with a bit an anchor: estimated repeated or not. The sketch is as wide as the corpus asks for and
    no task holds more than a shard. Second pass: exact grouping, by 96 bits of hash, of the windows estimated repeated;
    estimates are never too low, so none is lost, and windows wrongly taken along are seen to be their own first. Third
    pass: a chunk learns its own first places and drops what its other windows cover.

    A null text has no words and an empty kept_text; texts under `size` words stay whole; texts of any length are
    whole; rows that repeat a doc_id share its places, so equal rows keep the same words; null doc_ids come before all
    others (ids are above -2 ** 62), in the order of a hash of their text; an empty table gives no rows; columns named
    like a result are replaced.
    """
    ship(docs.sparkSession)
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    new = {f.name for f in fields}
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    keyed = docs.select(_document_key().alias("key"), "text")
    total, low, high, longest = keyed.agg(F.sum(F.octet_length("text")), F.min("key"), F.max("key"), F.max(F.octet_length("text"))).first()
    layout = Layout(total or 0, CHUNK_BYTES, CELLS_PER_BYTE, CELLS_PER_ANCHOR, ROWS, (2,))
    chunk = F.pmod(F.xxhash64("key"), F.lit(layout.chunks)).alias("chunk")
    dealt = keyed.select(chunk, "key", "text")
    answers = sketch.answers(dealt, layout, _anchor_grams(size))
    rows = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_occurrences(layout, size), "a long, b int, key long, start int")
    firsts = _first_places(rows, low, high, longest).select(chunk, "key", "mark")
    side = answers.unionByName(firsts, allowMissingColumns=True)
    if kept in ([], ["doc_id"]):  # all that is needed is in the key, and the exchange of the first passes serves again
        sent, first = dealt, T.StructField("key", T.LongType())
        given = [F.when(F.col("key") > _NULL_IDS, F.col("key")).cast(docs.schema["doc_id"].dataType).alias("doc_id")] if kept else []
    else:
        own = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("own")
        whole = docs.select(_document_key().alias("key"), "text", own)
        sent, first = whole.select(chunk, "key", "text", "own"), whole.schema["own"]
        given = [F.col(f"own.`{c}`") for c in kept]
    schema = T.StructType([first, *fields])
    names = pa.schema([pa.field(first.name, to_arrow_type(first.dataType)), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
    out = sent.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(_remove(layout, size, names), schema)
    return out.select(*given, *[f.name for f in fields])


def report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256."""
    found = remove_repeats(docs.select("doc_id", "text"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
win AS (SELECT doc_id, i AS start, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS seq
  FROM w, LATERAL (SELECT unnest(range(1, len(words) - {WINDOW - 2})) AS i) AS s),
late AS (SELECT doc_id, start FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY seq ORDER BY doc_id, start) AS r FROM win) WHERE r > 1),
hit AS (SELECT DISTINCT doc_id, start + k AS i FROM late, LATERAL (SELECT unnest(range(0, {WINDOW})) AS k) AS s),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM word WHERE (doc_id, i) NOT IN (SELECT (doc_id, i) FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
