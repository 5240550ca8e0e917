"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm.arrow import annotate
from turnstone.operators.ordinals import free_name
from turnstone.session import materialize

WINDOW = 10
#: Windows that an automaton holds at most, with each item that has one: a kilobyte or so each in every Python worker.
#: This is a bound on memory, to be raised with it; a benchmark that needs more takes several scans, one after another.
MAX_WINDOWS = 400_000
#: Distinct words that an automaton can tell apart.
CODES = 32**4
_UNKNOWN = "\0" * 4

#: Bytes of a word stay or become lower case, all others become a space, so offsets stay as they are.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

HITS = [T.StructField("n_words", T.LongType()), T.StructField("hit_words", T.ArrayType(T.IntegerType())), T.StructField("item_ids", T.ArrayType(T.StringType()))]
SPANS = T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
FIELDS = [*HITS, SPANS]


def normal(text: bytes | None) -> bytes:
    """The text lower-cased (A-Z) with every byte outside words turned into a space; as long as the text."""
    return text.translate(_NORMAL) if text else b""


def item_windows(items: Iterable[tuple[str, bytes]], size: int = WINDOW, most: int = MAX_WINDOWS) -> Iterator[dict[tuple[bytes, ...], list[str]]]:
    """The items' windows (their words) with the ids of the items that hold them, in groups of `most` at most."""
    found: dict[tuple[bytes, ...], list[str]] = {}
    held = n_words = 0
    for item_id, text in items:
        words = normal(text).split()
        n = min(size, len(words))
        for i in range(len(words) - n + 1) if n else ():
            ids = found.setdefault(tuple(words[i : i + n]), [])
            if item_id not in ids[-1:]:
                ids.append(item_id)
                held += 1
            n_words += n if i == 0 else 1  # words that may be new here
            if held >= most or n_words + size > CODES:
                yield found
                found, held, n_words = {}, 0, 0
    if found:
        yield found


def _code(k: int) -> str:
    """A word's number as four letters, each from 32 of its own, so that no node has many children and no match can
    begin inside a word."""
    return "".join([chr(33 + 32 * place + (k >> 5 * place) % 32) for place in range(4)])


_built: dict[str, tuple] = {}


def automaton(name: str, windows: dict[tuple[bytes, ...], list[str]]):
    """The benchmark's words, each with a code of four letters, and the automaton over windows as strings of codes,
    built once a worker process."""
    if name not in _built:
        import ahocorasick

        codes: dict[bytes, str] = {}
        made = ahocorasick.Automaton()
        for words, ids in windows.items():
            made.add_word("".join([codes.setdefault(w, _code(len(codes))) for w in words]), (len(words), ids))
        made.make_automaton()
        _built.clear()
        _built[name] = (codes, made)
    return _built[name]


def spans(text: bytes, hits: list[int]) -> list[dict[str, int]]:
    """Runs of hit words as ranges of code points of the original text; hits are in order."""
    if not hits:
        return []
    data = np.frombuffer(normal(text), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([False], data, [False])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    words = np.array(hits)
    first = np.flatnonzero(np.diff(words, prepend=-2) > 1)
    last = np.concatenate((first[1:], [len(words)])) - 1
    return [{"start": a, "end": b} for a, b in zip(points[starts[words[first]]].tolist(), points[ends[words[last]]].tolist(), strict=True)]


def scanner(windows: dict[tuple[bytes, ...], list[str]], name: str = "") -> Callable[[list[bytes | None]], list[list]]:
    """A function from texts to n_words, hit_words, item_ids and hit_spans."""
    codes, made = automaton(name or uuid.uuid4().hex, windows) if windows else ({}, None)

    def scan(texts: list[bytes | None]) -> list[list]:
        out: list[list] = [[], [], [], []]
        for text in texts:
            words = normal(text).split()
            ids: set[str] = set()
            hits: list[int] = []
            if made and words:
                steps = None
                for end, (n, its) in made.iter("".join([codes.get(w, _UNKNOWN) for w in words])):
                    if steps is None:
                        steps = np.zeros(len(words) + 1, np.int32)
                    last = end // 4
                    steps[last - n + 1] += 1
                    steps[last + 1] -= 1
                    ids.update(its)
                if steps is not None:
                    hits = np.flatnonzero(np.cumsum(steps[:-1])).tolist()
            out[0].append(len(words))
            out[1].append(hits)
            out[2].append(sorted(ids))
            out[3].append(spans(text, hits) if hits else [])
        return out

    return scan


def scan_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    keep: list[str] | None = None,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """docs with n_words, hit_words (indexes), item_ids and hit_spans (code points of the original text).

    Each text is normalised once and its words, as codes, are scanned once by the automaton; hits are mapped back to
    words and to the original. No shuffle. The automaton is broadcast up to max_windows windows; of a larger benchmark
    groups of so many are scanned one after another, each on the written result of the one before, and hits are united
    by word, so results are the same with any bound.

    Null or wordless texts have no words and no hits; items with a null id or text are left out; rows of items
    that share an id count as one item; repeated documents are scanned alike; texts of any length are scanned whole; an
    empty benchmark hits nothing; columns of docs named like a result are replaced.
    """
    context = docs.sparkSession.sparkContext
    items = benchmark.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("binary").alias("text")
    )
    names = [f.name for f in FIELDS]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    out, last = docs, None
    for windows in item_windows(((r["id"], bytes(r["text"])) for r in items.toLocalIterator()), size, max_windows):
        if last is not None:
            out = _add_hits(out, text, last, kept)
        last = context.broadcast((uuid.uuid4().hex, windows))
    if last is None or out is docs:
        return annotate(docs, text, lambda: scanner(*reversed(last.value)) if last else scanner({}), FIELDS, kept)
    out = _add_hits(out, text, last, kept)
    found = annotate(out.select("row", "text", *[f"hits.{f.name}" for f in HITS]), "text", lambda: lambda texts, hits: [[spans(t, h) for t, h in zip(texts, hits, strict=True)]], [SPANS], ["row", *names[:3]], ["hit_words"])
    return found.select(*[F.col(f"row.`{c}`") for c in kept], *names)


def _add_hits(docs: DataFrame, text: str, windows, kept: list[str]) -> DataFrame:
    """row (the columns to keep), text and hits, united with those that docs has already."""
    if docs.columns != ["row", "text", "hits"]:
        docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0)]).alias("row"), F.col(f"`{text}`").alias("text"), F.lit(None).cast(T.StructType(HITS)).alias("hits"))
    found = annotate(docs, "text", lambda: lambda texts: scanner(*reversed(windows.value))(texts)[:3], HITS)
    both = lambda c: F.array_sort(F.array_union(F.coalesce(f"hits.{c}", F.array().cast(dict((f.name, f.dataType) for f in HITS)[c])), F.col(c)))
    return materialize(found.select("row", "text", F.struct("n_words", both("hit_words").alias("hit_words"), both("item_ids").alias("item_ids")).alias("hits")), "hits")


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan_benchmark(docs, benchmark, keep=["doc_id"], **options)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of the benchmark, with the columns they came with."""
    names = {f.name for f in FIELDS}
    hidden = {c: free_name(docs, f"own_{c.lower()}") for c in docs.columns if c.lower() in names}
    found = scan_benchmark(docs.withColumnsRenamed(hidden), benchmark, **options)
    kept = found.where(F.size("hit_words") == 0).drop(*names)
    return kept.withColumnsRenamed({v: k for k, v in hidden.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])


_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Windows of every length that items have, in items and in documents, joined as texts.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS words FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS words, least({WINDOW}, len({_WORDS})) AS n FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(words[k:k + n - 1], ' ') AS seq FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS k FROM i WHERE n > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (SELECT doc_id, n, k, array_to_string(words[k:k + n - 1], ' ') AS seq FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS k FROM d, sizes)),
hits AS (SELECT doc_id, n, k, item_id FROM doc_windows JOIN item_windows USING (n, seq)),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
