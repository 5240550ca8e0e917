"""Source divergence audit: how differently the sources of a language use its terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.llm.arrow import raw
from turnstone.session import materialize, ship

#: A term is kept with so many documents of its language; each count has so much added; listed terms a group.
LEAST_DOCS = 30
PRIOR = 5
TOP_TERMS = 50
#: A task sends on its counts once it holds so many terms; texts are split into words in pieces of about so many bytes.
MAX_HELD = 300_000
PIECE = 1 << 20
#: Postings in a block of terms, about, in which pairs of sources are corrected together.
BLOCK_POSTINGS = 300_000

#: A-Z as a-z, and every byte that is in no term as a blank.
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def _words(text: bytes) -> Iterator[list[bytes]]:
    plain = text.translate(_PLAIN)
    begin = 0
    while begin < len(plain):
        end = plain.find(b" ", begin + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[begin:end].split()
        begin = end


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it) of every group, and a row with the term '' and
    zeros for each group, also without terms. Nulls are read as ''. Each task adds up before anything is exchanged."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (group_lang, group_source), (times, docs_with) in held.items():
                terms = [b"", *times]
                columns = [pa.array([group_lang] * len(terms)), pa.array([group_source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([0, *times.values()], pa.int64()), pa.array([0, *(docs_with[t] for t in times)], pa.int64())], ["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            for one, group_lang, group_source in zip(raw(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                key = (group_lang, group_source)
                times, docs_with = held.get(key) or held.setdefault(key, (Counter(), Counter()))
                before, mine = len(times), set()
                for terms in _words(one):
                    times.update(terms)
                    mine.update(terms)
                docs_with.update(mine)
                size += len(times) - before
                if size > MAX_HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    ship(docs.sparkSession)
    read = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    sums = docs.select(read(text).alias("text"), read(lang).alias("lang"), read(source).alias("source")).mapInArrow(tally, "lang string, source string, term string, n long, docs long")
    return sums.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str | Column, total: str | Column, terms: str | Column) -> Column:
    """1 + floor(10 ** 9 * (count + PRIOR) / (total + PRIOR * terms)) in whole numbers: three decimal places at a time, so nothing
    overflows below 9 * 10 ** 15 words. Null where there are no terms."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    whole = col(total) + PRIOR * col(terms)
    divided = lambda a: F.call_function("div", a, whole)
    rest, value = col(count) + PRIOR, F.lit(0)
    for _ in range(3):
        rest = rest * F.lit(1000).cast("long")
        value, rest = value * 1000 + divided(rest), rest % whole
    return F.when(col(terms) > 0, value + 1)


def _overlaps(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pair of sources in a block of terms: what both-sided terms differ by, less what the one-sided prices of
    both and the constant of terms in neither have for them."""
    table = pa.Table.from_batches(list(batches))
    names, source = np.unique(np.array(table.column("source").to_pylist(), object), return_inverse=True)
    term = np.asarray(pc.rank(table.column("term").combine_chunks(), tiebreaker="dense"))
    p, zero = (table.column(c).to_numpy() for c in ("p", "zero"))
    order = np.lexsort((source, term))
    source, term, p, zero = source[order], term[order], p[order], zero[order]
    ends = np.searchsorted(term, term, side="right")  # a posting's later ones of its term have higher sources
    by_source = np.argsort(source, kind="stable")
    bounds = np.searchsorted(source[by_source], np.arange(len(names) + 1))
    for one in range(len(names) - 1):
        mine = by_source[bounds[one] : bounds[one + 1]]
        sizes = ends[mine] - mine - 1
        at = np.repeat(mine, sizes)
        met = at + 1 + np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        both = np.abs(p[at] - p[met]) - np.abs(p[at] - zero[met]) - np.abs(p[met] - zero[at]) + np.abs(zero[at] - zero[met])
        total = np.zeros(len(names), np.int64)
        np.add.at(total, source[met], both)
        others = np.unique(source[met])
        if len(others):
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * len(others)), pa.array([names[one]] * len(others)), pa.array(names[others].tolist()), pa.array(total[others])], ["lang", "a", "b", "both"])


def price_postings(counted: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """postings: lang, source, term, n, p (the group's share), q (the language's), of kept terms; groups: lang, source, zero (the share of
    a term without occurrences), terms (kept ones of the language), support (those that the group has), postings (of
    all the language's groups)."""
    kept = counted.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("whole")).where(F.col("docs") >= least_docs)
    some = materialize(counted.join(kept.select("lang", "term", "whole"), ["lang", "term"]), "kept")
    terms = some.groupBy("lang", "term").agg(F.max("whole").alias("whole")).groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("whole").alias("lang_total"))
    sizes = some.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("support"))
    many = sizes.groupBy("lang").agg(F.sum("support").alias("postings"))
    groups = counted.where("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left").join(terms, "lang", "left").join(many, "lang", "left")
    groups = groups.fillna(0, ["total", "support", "terms", "lang_total", "postings"])
    groups = materialize(groups.withColumn("zero", share(F.lit(0).cast("long"), "total", "terms")), "groups")
    priced = some.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", share("n", "total", "terms").alias("p"), share("whole", "lang_total", "terms").alias("q"), "zero", "postings"
    )
    return materialize(priced, "postings"), groups


def one_sided(postings: DataFrame, pairs: DataFrame) -> DataFrame:
    """lang, source, item and price: the sum over the terms of source of how far their shares are from item's share of a
    term it lacks.

    A group's terms count only by their share: its histogram's running counts and sums, read off at the share asked for, in one
    sort of a group's histogram, which has at most the square root of twice its words, and of the questions to it."""
    histogram = postings.groupBy("lang", "source", "n").agg(F.max("p").alias("at"), F.count(F.lit(1)).alias("times"))
    marks = histogram.select("lang", "source", "at", F.lit(None).cast("string").alias("item"), "times")
    asks = pairs.select("lang", "source", F.col("other_zero").alias("at"), "item", F.lit(0).cast("long").alias("times"))
    merged = materialize(marks.union(asks), "prices")
    group = Window.partitionBy("lang", "source")
    below = group.orderBy("at", F.col("item").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    worth = F.col("times") * F.col("at")
    read = merged.select(
        "lang", "source", "item", "at", F.sum("times").over(below).alias("n"), F.sum(worth).over(below).alias("s"), F.sum("times").over(group).alias("all_n"), F.sum(worth).over(group).alias("all_s")
    )
    price = F.col("at") * F.col("n") - F.col("s") + (F.col("all_s") - F.col("s")) - F.col("at") * (F.col("all_n") - F.col("n"))
    return read.where("item IS NOT NULL").select("lang", "source", "item", price.alias("price"))


def divergent_pairs(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the language) and value, the sum over kept terms of the shares' distances.

    By supports: terms in one group only are priced from its histogram, terms in both are taken out of those prices again and added
    as they are, in blocks of terms that give one row a pair, and each of the rest has the same distance."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"), F.col("support").alias("other_support"))
    pairs = materialize(groups.join(other, "lang").where("source <> item"), "pairs")  # what is returned has a row for each
    prices = materialize(one_sided(postings, pairs.where("terms > 0")), "one_sided")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("postings") / BLOCK_POSTINGS)).cast("int")
    dealt = postings.select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "source", "term", "p", "zero")
    ship(postings.sparkSession)
    corrected = dealt.groupBy("lang", "block").applyInArrow(_overlaps, "lang string, a string, b string, both long")
    corrected = materialize(corrected.groupBy("lang", "a", "b").agg(F.sum("both").alias("both")), "overlaps")
    back = prices.select("lang", F.col("source").alias("item"), F.col("item").alias("source"), F.col("price").alias("back"))
    found = pairs.withColumn("a", F.least("source", "item")).withColumn("b", F.greatest("source", "item"))
    found = found.join(prices, ["lang", "source", "item"], "left").join(back, ["lang", "source", "item"], "left").join(corrected, ["lang", "a", "b"], "left")
    neither = (F.col("terms") - F.col("support") - F.col("other_support")) * F.abs(F.col("zero") - F.col("other_zero"))
    value = F.coalesce("price", F.lit(0)) + F.coalesce("back", F.lit(0)) + F.coalesce("both", F.lit(0)) + F.coalesce(neither, F.lit(0))
    return found.select("lang", "source", "item", value.cast("long").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: for every group (lang, source) its distances to the language's other
    sources (part pair), and the terms whose share in it is most above that in the language (part term, the first top_terms).

    Ranks start at 1 and fall with value, ties by item as bytes. Null text, lang and source are ''. A language without
    kept terms has pairs of value 0 and no terms; a single source has no pairs; an empty table gives no rows; repeated rows
    count each; other columns are not read, whatever their names. Texts are read once and whole; a hot source is added up in every
    task before the exchange."""
    postings, groups = price_postings(materialize(term_counts(docs, text, lang, source), "terms"), least_docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    pairs = materialize(ranked(divergent_pairs(postings, groups), "pair"), "ranked")
    terms = postings.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pairs.union(ranked(terms, "term").where(F.col("rank") <= top_terms))


def report(docs: DataFrame) -> DataFrame:
    """One row a group, part and item: lang, source, part, item, value, rank."""
    return audit(docs)


ORACLE_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
),
occurring AS (SELECT d, lang, source, unnest(terms) AS term FROM words),
kept AS (SELECT lang, term, count(*) AS whole FROM occurring GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
sizes AS (SELECT lang, count(*) AS v, sum(whole) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM words),
counts AS (SELECT lang, source, term, count(*) AS n FROM occurring GROUP BY lang, source, term),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.whole::HUGEINT AS whole, s.v::HUGEINT AS v, s.total::HUGEINT AS total
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
priced AS (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v)::HUGEINT AS p,
    1 + 1000000000 * (whole + 5) // (total + 5 * v) AS q FROM grid
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM priced x JOIN priced y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
),
terms AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM priced WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER FROM terms
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
