"""Mixing sources to target weights: budgets flow down a tree, then each leaf is read in seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.session import materialize

#: Tokens are runs of characters other than ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"
#: Hex digits of the order key that name a bucket; a leaf's order is summed by bucket, then within one bucket.
BUCKET_DIGITS = 3
#: Plans of at most so many leaves are broadcast; larger ones are joined by shuffle, each leaf dealt over SALTS parts.
BROADCAST_LEAVES = 50_000
SALTS = 64

LEVELS = ("domain", "lang", "source")
DOMAINS = ("books", "code", "web")
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"books": 5, "code": 2, "web": 3},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {},
}
#: Budget as hundredths of the input's tokens, and how often a document may be read.
BUDGET_PERCENT = 60
MAX_EPOCHS = 2
SEED = 17


def domain_of(source: Column) -> Column:
    """The domain that a source belongs to, by its last character; empty names count as 'web'."""
    at = F.pmod(F.ascii(F.right(F.coalesce(source, F.lit("")), F.lit(1))), F.lit(len(DOMAINS)))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), (at + 1).cast("int"))


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    known = weights.get(level, {})
    return reduce(lambda c, kv: F.when(F.col(level) == kv[0], kv[1]).otherwise(c), known.items(), F.lit(1)).cast("long")


def allocate(leaves: DataFrame, budget: int, weights: Mapping[str, Mapping[str, int]], levels: Sequence[str]) -> DataFrame:
    """leaves (levels, capacity) with their budget, in whole tokens.

    From the root down, a node's budget is shared among its children by weight, no child getting more than its
    subtree holds; what a full child leaves goes to its siblings by weight. A shortage thus stays among siblings
    while they have room, and only reaches the ancestors' level when a whole subtree is full. Shares are rounded
    down. Products of weights and tokens must fit in 64 bits.
    """
    plan = leaves.groupBy(*levels[:1]).agg(F.sum("capacity").alias("capacity")).withColumn("given", F.lit(budget).cast("long"))
    for depth, level in enumerate(levels):
        if depth:
            nodes = leaves.groupBy(*levels[: depth + 1]).agg(F.sum("capacity").alias("capacity"))
            plan = nodes.join(plan.select(*levels[:depth], F.col("budget").alias("given")), list(levels[:depth]))
        parent = Window.partitionBy(*levels[:depth]) if depth else Window.partitionBy(F.lit(0))
        order = [F.col("capacity") / F.col("weight"), F.col(level)]
        before = parent.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        onward = parent.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
        shares = plan.withColumn("weight", _weight(level, weights)).select(
            "*",
            F.coalesce(F.sum("capacity").over(before), F.lit(0)).alias("used"),
            F.sum("weight").over(onward).alias("claims"),
        )
        full = F.col("capacity") * F.col("claims") <= F.col("weight") * (F.col("given") - F.col("used"))
        marked = shares.withColumn("full", full)
        marked = marked.select(
            "*",
            F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(parent), F.lit(0)).alias("held"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).over(parent).alias("open"),
        )
        share = F.floor(F.expr("(weight * (given - held)) div open"))
        plan = marked.select(*levels[: depth + 1], "capacity", F.when(F.col("full"), F.col("capacity")).otherwise(share).alias("budget"))
    return plan


def order_name(doc_id: Column, text: Column) -> Column:
    """What a document's place in an order is made from: its id, or, without one, a hash of its text."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.xxhash64(text).cast("string")))


def order_key(seed: int, epoch: Column, name: Column) -> Column:
    """Where a document stands in an epoch's seeded order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name).cast("binary"))


def _with_plan(rows: DataFrame, plan: DataFrame, levels: Sequence[str], small: bool) -> DataFrame:
    """rows with their leaf's plan."""
    if small:
        return rows.join(F.broadcast(plan), list(levels))
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int"))
    return salted.join(plan.withColumn("__salt", salt), [*levels, "__salt"]).drop("__salt")


def mixing_plan(
    sizes: DataFrame,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    levels: Sequence[str] = LEVELS,
    budget: int | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> tuple[DataFrame, bool]:
    """One row a leaf with its whole epochs and where its last epoch is cut, and whether the plan is small.

    sizes: levels, doc_id, name (see order_name), n_tokens. budget: tokens (None: BUDGET_PERCENT of all).
    A leaf's last epoch orders documents by order_key; tokens are summed by the key's first digits, over at most
    16 ** BUCKET_DIGITS buckets a leaf, and only the bucket that holds the cut is ordered by document. So no task
    orders a leaf, however much of the input it holds.
    """
    leaves = materialize(sizes.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")), "leaves")
    total, n_leaves = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count(F.lit(1))).first()
    small = n_leaves <= BROADCAST_LEAVES
    goal = total * BUDGET_PERCENT // 100 if budget is None else budget
    caps = leaves.select(*levels, (F.col("tokens") * max_epochs).alias("capacity"))
    plan = allocate(caps, goal, weights, levels).select(*levels, "budget").join(leaves, list(levels))
    epochs = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0))
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    plan = materialize(plan, "budgets")

    keyed = _with_plan(sizes, plan.where("rest > 0").select(*levels, "epochs", "rest"), levels, small)
    keyed = keyed.withColumn("key", order_key(seed, F.col("epochs"), F.col("name")))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    running = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = keyed.groupBy(*levels, "bucket", "rest").agg(F.sum("n_tokens").alias("held"))
    ends = sums.withColumn("end", F.sum("held").over(running))
    cuts = ends.where("end >= rest AND end - held < rest").select(*levels, "bucket", (F.col("end") - F.col("held")).alias("before"))
    last = _with_plan(keyed, materialize(cuts, "cuts"), [*levels, "bucket"], small)
    inside = Window.partitionBy(*levels, "bucket").orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("end", F.col("before") + F.sum("n_tokens").over(inside))
    cut = last.where(F.col("end") - F.col("n_tokens") < F.col("rest")).groupBy(*levels).agg(
        F.max("key").alias("cut_key"), F.max(F.col("end") - F.col("n_tokens")).alias("cut_start")
    )
    return materialize(plan.join(cut, list(levels), "left"), "plan"), small


def select_documents(rows: DataFrame, plan: DataFrame, small: bool, levels: Sequence[str] = LEVELS, seed: int = SEED) -> DataFrame:
    """rows (levels, name, ...) with n_copies and in_last_epoch, those that are read at least once."""
    found = _with_plan(rows, plan.select(*levels, "epochs", "rest", "cut_key", "cut_start"), levels, small)
    key = order_key(seed, F.col("epochs"), F.col("name"))
    found = found.withColumn("__key", F.when(F.col("cut_key").isNotNull(), key))
    taken = F.coalesce(F.col("__key") <= F.col("cut_key"), F.lit(False))
    found = found.withColumn("in_last_epoch", taken).withColumn("at_cut", F.coalesce(F.col("__key") == F.col("cut_key"), F.lit(False)))
    found = found.withColumn("n_copies", F.col("epochs") + F.col("in_last_epoch").cast("long"))
    return found.where("n_copies > 0").drop("__key")


def _leveled(docs: DataFrame, *more: Column) -> DataFrame:
    """Each document's leaf and order name, and `more`; nulls are the empty name."""
    return docs.select(
        domain_of(F.col("source")).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        order_name(F.col("doc_id"), F.col("text")).alias("name"), *more,
    )


def _sizes(docs: DataFrame) -> DataFrame:
    return _leveled(docs, F.col("doc_id"), token_count(F.col("text")).alias("n_tokens"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture: doc_id, domain, lang, source, n_tokens, n_copies, n_taken.

    n_copies: how many epochs read the document; n_taken: the tokens they take of it, the last document of a
    leaf's last epoch giving only its first tokens. Weights, levels, budget, epochs and seed: see mixing_plan.

    A null source or language is a leaf of its own with an empty name; null or empty texts hold no tokens; a null
    doc_id is ordered by a hash of its text; rows that repeat a doc_id are taken together, so they can exceed the
    budget by what they hold; an empty table gives no rows; further columns are ignored.
    """
    sizes = materialize(_sizes(docs), "sizes")
    plan, small = mixing_plan(sizes, **options)
    found = select_documents(sizes, plan, small, seed=options.get("seed", SEED))
    part = F.when(F.col("at_cut"), F.least("n_tokens", F.col("rest") - F.col("cut_start"))).otherwise(F.col("n_tokens"))
    taken = F.col("epochs") * F.col("n_tokens") + F.when(F.col("in_last_epoch"), part).otherwise(F.lit(0))
    return found.select("doc_id", "domain", "lang", "source", "n_tokens", "n_copies", taken.alias("n_taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """docs themselves, those that the mixture reads, with n_copies. Texts are not shuffled while the plan is small."""
    plan, small = mixing_plan(materialize(_sizes(docs), "sizes"), **options)
    own = [c for c in docs.columns if c != "n_copies"]
    found = select_documents(_leveled(docs, F.struct(*[F.col(f"`{c}`") for c in own]).alias("own")), plan, small, seed=options.get("seed", SEED))
    return found.select(*[F.col(f"own.`{c}`") for c in own], "n_copies")


def _level_sql(depth: int) -> str:
    """The oracle's allocation among the nodes at a depth."""
    names = LEVELS[: depth + 1]
    cols, above = ", ".join(names), ", ".join(names[:-1])
    level = names[-1]
    weight = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
    weight = f"CASE {level} {weight} ELSE 1 END" if weight else "1"
    given = f"p{depth - 1}.budget" if depth else "(SELECT goal FROM total)"
    source = f"JOIN p{depth - 1} USING ({above})" if depth else ""
    part = f"PARTITION BY {above}" if depth else ""
    return f"""
n{depth} AS (SELECT {cols}, CAST(sum(tokens) * {MAX_EPOCHS} AS BIGINT) AS capacity FROM leaves GROUP BY {cols}),
g{depth} AS (SELECT {cols}, n{depth}.capacity, CAST({given} AS BIGINT) AS given, CAST({weight} AS BIGINT) AS weight FROM n{depth} {source}),
s{depth} AS (SELECT *, coalesce(sum(capacity) OVER ({part} ORDER BY capacity / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
  sum(weight) OVER ({part} ORDER BY capacity / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS claims FROM g{depth}),
f{depth} AS (SELECT *, capacity * claims <= weight * (given - used) AS is_full FROM s{depth}),
h{depth} AS (SELECT *, coalesce(sum(CASE WHEN is_full THEN capacity END) OVER ({part}), 0) AS held,
  sum(CASE WHEN NOT is_full THEN weight END) OVER ({part}) AS open FROM f{depth}),
p{depth} AS (SELECT {cols}, capacity, CASE WHEN is_full THEN capacity ELSE (weight * (given - held)) // open END AS budget FROM h{depth})"""


ORACLE_SQL = f"""
WITH sizes AS (
  SELECT doc_id, CASE ascii(right(coalesce(source, ''), 1)) % 3 WHEN 0 THEN 'books' WHEN 1 THEN 'code' ELSE 'web' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM sizes GROUP BY domain, lang, source),
total AS (SELECT CAST(sum(tokens) * {BUDGET_PERCENT} // 100 AS BIGINT) AS goal FROM leaves),
{",".join(map(_level_sql, range(3)))},
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
  budget - CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END * tokens AS rest FROM p2 JOIN leaves USING (domain, lang, source)),
keyed AS (SELECT *, md5('{SEED}:' || CAST(CAST(epochs AS BIGINT) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)) AS key FROM sizes JOIN plan USING (domain, lang, source)),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS start FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs + CASE WHEN start < rest THEN 1 ELSE 0 END AS BIGINT) AS n_copies,
  CAST(epochs * n_tokens + CASE WHEN start < rest THEN least(n_tokens, rest - start) ELSE 0 END AS BIGINT) AS n_taken
FROM placed WHERE epochs + CASE WHEN start < rest THEN 1 ELSE 0 END > 0
"""
