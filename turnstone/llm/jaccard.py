"""N-gram Jaccard join: documents whose sets of word shingles are alike, by token-combination prefixes."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm import sketch
from turnstone.llm.arrow import pieces, raw, release
from turnstone.llm.components import components, roots
from turnstone.llm.hashing import U, mix, split_words, window_hashes, word_hashes
from turnstone.session import materialize, ship

SHINGLE = 5
#: Least similarity, in hundredths.
SIMILARITY = 80
#: Tokens (shingles) whose estimated document frequency is above this are frequent: they are indexed in pairs.
FREQUENT = 32
#: Sets up to this size are indexed by single tokens only; beyond, frequent tokens fall into about a quarter as many
#: classes as a set has tokens, and pairs are made within a class.
SMALL_SET = 63
#: Documents are dealt into chunks of about so many bytes of text, each of which asks the sketch for its tokens.
CHUNK_BYTES = 1 << 22
#: Sketch cells a byte of text (no bound) and a token, about. One row does: a token wrongly taken for repeated is a key without a partner.
CELLS_PER_BYTE = 0.4
CELLS_PER_TOKEN = 3
#: Documents this alike to a pivot, in hundredths, are its family and are compared among themselves.
KIN = 30
#: Documents and tokens of a family in a block, about.
BLOCK = 512
BLOCK_TOKENS = 1_000_000
#: Rounds in which open groups are looked for that lie wholly in another.
ROUNDS = 3

_KEYS = [U(0x9FB21C651E98DF25), U(0xA24BAED4963EE407), U(0xC2B2AE3D27D4EB4F)]


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; fewer words than `size` make one shingle, none an empty set."""
    words = split_words(texts, lower=True)
    starts, hashes = window_hashes(word_hashes(words), words.bounds, size, short=True)
    cuts = np.searchsorted(starts, words.bounds)
    return [np.unique(hashes[cuts[i] : cuts[i + 1]]) for i in range(len(texts))]


def _sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """shingle_sets of any number of texts, made in pieces."""
    return [s for a, b in pieces(texts) for s in shingle_sets(texts[a:b])]


def _tokens(table: pa.Table) -> np.ndarray:
    return np.concatenate(_sets(raw(table["text"])))


def required(n: int) -> int:
    """Tokens that a set of n shares with any set as similar as SIMILARITY."""
    return -(-n * SIMILARITY // 100)


def schemes(n: int) -> list[int]:
    """The index schemes of a set of n tokens: those of all sizes it can be similar to. 0: single tokens; s: pairs of
    frequent tokens in 2 ** (s - 2) classes."""
    sizes = (required(n), n, n * 100 // SIMILARITY)
    return sorted({0 if m <= SMALL_SET else m.bit_length() for m in sizes})


def signatures(tokens: np.ndarray, repeated: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The index keys of a set (sorted hashes): two sets of SIMILARITY or more share one.

    The global order is by frequency class (once, some times, frequent), then by hash. Of a set of n that shares t
    tokens at least, the prefix holds n - t + 1 tokens more than sharing could avoid: a single token counts 1, a class
    of frequent tokens its number less 1, since a shared key takes two of the class. If two sets shared no key, the
    set whose prefix ends first would miss n - t + 1 of its tokens in the other, so they'd share fewer than t. Tokens
    that are certainly in one document only count, but are no keys. Similar sets share one scheme at least, and within
    a scheme keys are made alike.
    """
    n = len(tokens)
    need = n - required(n) + 1
    if n - int(repeated.sum()) >= need:
        return np.zeros(0, U)
    rank = repeated.astype(np.int8) + frequent
    order = np.argsort(rank, kind="stable")  # tokens come sorted
    out = []
    for scheme in schemes(n):
        if not scheme:
            chosen = order[:need]
            out.append(mix(tokens[chosen][repeated[chosen]] ^ _KEYS[0]))
            continue
        classes = 1 << (scheme - 2)
        single = rank[order] < 2
        kinds = (tokens[order] & U(classes - 1)).astype(np.int64)
        worth = np.ones(n, np.int64)
        others = np.flatnonzero(~single)
        worth[others[np.unique(kinds[others], return_index=True)[1]]] = 0
        end = int(np.searchsorted(np.cumsum(worth), need)) + 1
        mine = tokens[order[:end]]
        out.append(mix(mine[single[:end] & repeated[order[:end]]] ^ _KEYS[1] ^ U(scheme)))
        pairs = np.flatnonzero(~single[:end])
        pairs = pairs[np.lexsort((mine[pairs], kinds[pairs]))]
        bounds = np.concatenate((np.flatnonzero(np.diff(kinds[pairs], prepend=-1)), [len(pairs)]))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1:
                i, j = np.triu_indices(b - a, 1)
                held = mine[pairs[a:b]]
                out.append(mix(mix(held[i] ^ _KEYS[2] ^ U(scheme)) * U(3) + held[j]))
    return np.unique(np.concatenate(out))


def similar(a: np.ndarray, b: np.ndarray, least: int = SIMILARITY) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= least * (len(a) + len(b) - both)


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all similar sets of two blocks. Intersections are products of incidence matrices over the
    tokens that both blocks hold, `columns` tokens at a time."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    both = np.zeros((len(left), len(right)), np.float32)  # whole numbers: exact
    flat = [np.concatenate(side) if side else np.zeros(0, U) for side in (left, right)]
    shared = np.intersect1d(flat[0], flat[1])
    rows, cols = [], []
    for side, tokens, size in zip((left, right), flat, sizes, strict=True):
        at = np.minimum(np.searchsorted(shared, tokens), max(0, len(shared) - 1))
        known = shared[at] == tokens if len(shared) else np.zeros(len(tokens), bool)
        rows.append(np.repeat(np.arange(len(side)), size)[known])
        cols.append(at[known])
    for begin in range(0, len(shared), columns):
        grids = []
        for side, row, col in zip((left, right), rows, cols, strict=True):
            grid = np.zeros((len(side), columns), np.float32)
            here = (col >= begin) & (col < begin + columns)
            grid[row[here], col[here] - begin] = 1
            grids.append(grid)
        both += grids[0] @ grids[1].T
    union = sizes[0][:, None] + sizes[1][None] - both
    return np.nonzero((union > 0) & (100 * both >= SIMILARITY * union))


def _index_chunk(layout: sketch.Layout, names: pa.Schema):
    """Sets and keys of a chunk's documents."""

    def index(held: pa.Table, side: pa.Table) -> pa.Table:
        if not held.num_rows:
            return names.empty_table()
        texts = raw(held["text"])
        sets = _sets(texts)
        flat = np.concatenate(sets)
        cuts = np.cumsum([0, *map(len, sets)])
        repeated, frequent = sketch.at_least(layout, flat, side)
        spans = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        keys = [signatures(s, repeated[at], frequent[at]) if len(s) else s for s, at in zip(sets, spans, strict=True)]
        mixed = np.concatenate(([U(0)], np.cumsum(mix(flat ^ _KEYS[0]))))
        plain = np.concatenate(([U(0)], np.cumsum(flat)))
        set_names = [(sums[cuts[1:]] - sums[cuts[:-1]]).view(np.int64) for sums in (plain, mixed)]
        sizes = np.cumsum([0, *map(len, keys)])
        listed = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))
        keyed = pa.array([t if len(k) else None for t, k in zip(texts, keys, strict=True)], pa.binary())
        release()
        return pa.Table.from_arrays([held["doc_id"], pa.array(np.diff(cuts), pa.int64()), *map(pa.array, set_names), listed, keyed], schema=names)

    return index


def index_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, s1, s2 (the set's name), keys, and text where a document has keys.

    Documents are dealt into chunks by a hash of id and text; a chunk counts its tokens in a count-min sketch as wide as
    the corpus asks for, whose shards answer with two bits a token: estimated repeated, and estimated frequent.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    layout = sketch.Layout(total, CHUNK_BYTES, CELLS_PER_BYTE, CELLS_PER_TOKEN, 1, (2, FREQUENT + 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(layout.chunks)).alias("chunk"), "doc_id", "text")
    answers = sketch.answers(dealt, layout, _tokens)
    whole = ("doc_id", "n_shingles", "s1", "s2")
    names = pa.schema([*((n, pa.int64()) for n in whole), ("keys", pa.list_(pa.int64())), ("text", pa.binary())])
    indexed = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_index_chunk(layout, names), "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>, text binary")
    return materialize(indexed, "shingles")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents that are kin at least, with linked: whether their shingle sets are alike.

    texts: doc_id, text. A text travels with its b; that of a common a is joined last, from the side that is
    unique."""
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[tuple[int, int], np.ndarray] = OrderedDict()
        for batch in batches:
            a = batch.column(0).to_pylist()
            text_a, text_b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found, linked = [], []
            for begin, end in pieces(text_b):
                for i, mine in enumerate(shingle_sets(text_b[begin:end]), begin):
                    key = (a[i], hash(text_a[i]))
                    other = known.get(key)
                    if other is None:
                        other = known[key] = shingle_sets([text_a[i]])[0]
                        if len(known) > 256:
                            known.popitem(last=False)
                    if similar(mine, other, KIN):
                        found.append(i)
                        linked.append(similar(mine, other))
            kept = [batch.column(k).take(pa.array(found, pa.int64())) for k in range(2)]
            release()
            yield pa.RecordBatch.from_arrays([*kept, pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return materialize(joined.mapInArrow(check, "a long, b long, linked boolean"), "compared")


def _block_links(table: pa.Table) -> pa.Table:
    """Links (a, b) between components, from comparing the outer rows of a block with the others, or, where all
    are outer, with one another. A component gives one link at most."""
    table = table.combine_chunks()
    outer = table["outer"].to_numpy(zero_copy_only=False)
    parts, held = table["component"].to_numpy(), table["text"].to_pylist()
    sides = [np.flatnonzero(outer), np.flatnonzero(~outer)]
    sets = [_sets([held[k] for k in p]) for p in sides]
    if not sets[1]:
        sides[1], sets[1] = sides[0], sets[0]
    i, j = similar_pairs(*sets)
    i, j = parts[sides[0][i]], parts[sides[1][j]]
    names, at = np.unique(np.concatenate((i[i != j], j[i != j])), return_inverse=True)
    n = int((i != j).sum())
    up = roots(len(names), at[:n], at[n:])
    moved = np.flatnonzero(up != np.arange(len(names)))
    return pa.table({"a": pa.array(names[up[moved]], pa.int64()), "b": pa.array(names[moved], pa.int64())})


def _open_families(members: DataFrame) -> DataFrame:
    """members (family, doc_id, component, n_shingles) of families with several components, with their family's
    number of blocks and its largest component (home)."""
    parts = members.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("tokens"))
    sums = [F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.sum("tokens").alias("tokens"), F.max_by("component", F.struct("n", "component")).alias("home")]
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("tokens") / BLOCK_TOKENS)).cast("int")
    families = parts.groupBy("family").agg(*sums).where("parts > 1").select("family", "home", blocks.alias("blocks"))
    return materialize(members.join(families, "family"), "open")


def connect_families(members: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """labels once all members of each family (members: family, doc_id, n_shingles) are compared or connected.

    Members are dealt into blocks. A block is compared within itself: a row a member, whatever the family's size.
    Families of one block, and those that this connects, are done; of others, members outside the largest component
    are then compared with the other blocks, a row a block on the other side. So what a family sends grows with its
    size, and only what stays unconnected in families of many blocks is sent more than twice.
    """

    def marked() -> DataFrame:
        known = labels.select(F.col("node").alias("doc_id"), "component")
        found = members.join(known, "doc_id", "left").select("family", "doc_id", F.coalesce("component", "doc_id").alias("component"), "n_shingles")
        return _open_families(found)

    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("blocks")).cast("int")
    first = marked()
    rows = first.select("family", place.alias("i"), "doc_id", "component", F.lit(True).alias("outer")).join(texts, "doc_id")
    rows = rows.select("family", "i", "component", "outer", "text")
    labels = _relabel(labels, materialize(rows.groupBy("family", "i").applyInArrow(_block_links, "a long, b long"), "within"))
    members = first.where("blocks > 1").select("family", "doc_id", "n_shingles")
    if members.isEmpty():
        return labels
    second = marked().where("blocks > 1")
    if second.isEmpty():
        return labels
    outside = second.where("component <> home").groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("tokens"))
    need = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("tokens") / BLOCK_TOKENS)).cast("int")
    placed = second.join(outside.select("family", need.alias("outer_blocks")), "family").join(texts, "doc_id")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = placed.where("component <> home").select("family", F.pmod(F.xxhash64("doc_id"), F.col("outer_blocks")).cast("int").alias("i"), upto("blocks").alias("j"), "component", F.lit(True).alias("outer"), "text")
    other = placed.select("family", upto("outer_blocks").alias("i"), place.alias("j"), "component", F.lit(False).alias("outer"), "text")
    rows = one.select("family", "i", "j", "component", "outer", "text").union(other.select("family", "i", "j", "component", "outer", "text"))
    return _relabel(labels, materialize(rows.groupBy("family", "i", "j").applyInArrow(_block_links, "a long, b long"), "across"))


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, component) once links (a, b) between documents or components have joined components."""
    if links.isEmpty():
        return labels
    top = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_top"))
    lifted = links.join(top("a"), "a", "left").join(top("b"), "b", "left").select(F.coalesce("a_top", "a").alias("a"), F.coalesce("b_top", "b").alias("b"))
    moved = components(lifted)
    fresh = moved.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("via"))
    old = labels.select("node", F.col("component").alias("via")).union(fresh)
    up = moved.select(F.col("node").alias("via"), "component")
    return materialize(old.join(up, "via", "left").select("node", F.coalesce("component", "via").alias("component")), "labels")


def link_components(indexed: DataFrame) -> DataFrame:
    """node and component of every document that is linked with another.

    1. Equal sets are linked and one document stands for each. 2. In a group of documents that share a key, the
    smallest is the pivot and is compared with all others: one pair a member, so a group costs in proportion to
    its size. 3. Documents that are at least kin to a pivot are its family, whose members are compared in blocks
    (connect_families). 4. What is left are groups with members of different families and different components. Those
    that lie in others go (maximal_groups), and the rest are families once more, of any size. In the end every pair that shares a key is compared or
    known to be connected. Nothing is capped.
    """
    held = indexed.where("doc_id IS NOT NULL AND size(keys) > 0")
    named = held.select("doc_id", "s1", "s2", "n_shingles")
    firsts = materialize(named.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("first")), "firsts")
    copies = named.join(firsts, ["s1", "s2", "n_shingles"]).select(F.col("first").alias("a"), F.col("doc_id").alias("b")).where("a <> b")

    single = firsts.select(F.col("first").alias("doc_id")).distinct()
    rows = held.select("doc_id", "keys").join(single, "doc_id", "left_semi").select(F.explode("keys").alias("key"), "doc_id").distinct()
    pivots = rows.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last")).where("pivot < last")
    groups = materialize(rows.join(pivots.select("key", "pivot"), "key"), "groups")
    # rows that repeat an id and a set come once; an id with several sets keeps all of them
    texts = held.select("doc_id", "s1", "n_shingles", "text").join(groups.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = materialize(texts.dropDuplicates(["doc_id", "s1", "n_shingles"]).drop("s1"), "texts")
    sizes = texts.groupBy("doc_id").agg(F.sum("n_shingles").alias("n_shingles"))
    texts = texts.drop("n_shingles")
    pairs = groups.where("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    kin = compared(pairs, texts)
    labels = components(copies.union(kin.where("linked").select("a", "b")))

    heads = kin.groupBy("b").agg(F.min("a").alias("family"))
    leading = heads.select(F.col("family").alias("b")).distinct().join(heads.select("b"), "b", "left_anti").select("b", F.col("b").alias("family"))
    # a pivot that is in another's family leads its own no longer: its members follow it there
    up = heads.select(F.col("b").alias("family"), F.col("family").alias("higher"))
    families = heads.join(up, "family", "left").select("b", F.coalesce("higher", "family").alias("family")).union(leading)
    families = materialize(families.select(F.col("b").alias("doc_id"), "family"), "families")
    led = families.join(families.where("doc_id = family").select("family"), "family", "left_semi")
    led = materialize(led.join(sizes, "doc_id").select("doc_id", "family", "n_shingles"), "kin")
    labels = connect_families(led, texts, labels)

    known = labels.select(F.col("node").alias("doc_id"), "component")
    named = groups.where("doc_id <> pivot").select("key", "doc_id").join(led.select("doc_id", "family"), "doc_id", "left").join(known, "doc_id", "left")
    named = named.select("key", "doc_id", F.coalesce("family", "doc_id").alias("family"), F.coalesce("component", "doc_id").alias("component"))
    ends = [f(c).alias(f"{n}_{c}") for c in ("family", "component") for n, f in (("least", F.min), ("most", F.max))]
    unsettled = named.groupBy("key").agg(*ends).where("least_family < most_family AND least_component < most_component")
    left = materialize(named.join(unsettled.select("key"), "key").select("key", "doc_id"), "left")
    if left.isEmpty():
        return labels
    members = maximal_groups(left).select(F.col("key").alias("family"), "doc_id")
    return connect_families(materialize(members.join(sizes, "doc_id"), "members"), texts, labels)


def maximal_groups(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """rows (key, doc_id; distinct) of fewer groups, such that any two documents of one group are still in one.

    A passage that documents share gives a key for many of its shingles, whose groups are the same or lie in one another.
    Of groups with the same members (by 128 bits of hash) one stays. Then, for each group, the largest one is taken that two of its
    documents share, other two in each round, and the group goes if all of its documents are in that one."""
    mark = lambda k: F.bit_xor(F.xxhash64("doc_id", F.lit(k))).alias(f"x{k}")
    names = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), mark(1), mark(2))
    rows = materialize(rows.join(names.groupBy("n", "x1", "x2").agg(F.min("key").alias("key")).select("key", "n"), "key"), "open")
    for salt in range(rounds):
        order = F.xxhash64("doc_id", F.lit(salt))
        pairs = rows.groupBy("key", "n").agg(F.min_by("doc_id", order).alias("a"), F.max_by("doc_id", order).alias("b"))
        own = rows.select(F.col("doc_id").alias("a"), F.col("key").alias("top"), F.col("n").alias("most"))
        wider = pairs.join(own, "a").where("most > n OR (most = n AND top > key)")
        both = wider.join(rows.select(F.col("doc_id").alias("b"), F.col("key").alias("top")), ["b", "top"])
        tops = both.groupBy("key").agg(F.max(F.struct("most", "top")).alias("best")).select("key", F.col("best.top").alias("top"))
        inside = rows.join(tops, "key").join(rows.select(F.col("key").alias("top"), "doc_id"), ["top", "doc_id"])
        gone = materialize(inside.groupBy("key", "n").agg(F.count(F.lit(1)).alias("both")).where("both = n").select("key"), "inside")
        if gone.isEmpty():
            break
        rows = materialize(rows.join(gone, "key", "left_anti"), "open")
    return rows.select("key", "doc_id")


def join_similar(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id.

    A document's set holds its distinct shingles of SHINGLE words (lower-cased A-Z, parted by ASCII white space).
    Documents link when 100 times their sets' intersection is SIMILARITY times their union or more; component_id
    is the smallest doc_id reachable by links.

    A document of fewer words is one shingle; one without words or text has an empty set and links with nothing;
    rows that repeat a doc_id are one node, linked by any of its texts, and a null doc_id links with nothing;
    copies are one set; texts of any length are whole; an empty table gives no rows; further columns are ignored.
    """
    ship(docs.sparkSession)
    indexed = index_documents(docs, text)
    labels = link_components(indexed).withColumnsRenamed({"node": "doc_id", "component": "component_id"})
    found = indexed.select("doc_id", "n_shingles").join(labels, "doc_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without those that have a smaller doc_id in their component."""
    found = join_similar(docs.select("doc_id", "text"))
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, seq FROM (
  SELECT doc_id, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS seq FROM w, LATERAL (SELECT unnest(range(1, greatest(len(words) - {SHINGLE - 2}, 2))) AS i) AS s WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_in AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.seq = y.seq AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM both_in JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= {SIMILARITY} * (p.n + q.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT node, b FROM reach JOIN link ON other = a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = d.doc_id
"""
