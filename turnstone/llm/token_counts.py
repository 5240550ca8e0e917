"""Token counts: frequent pre-token lengths from a broadcast table, the rest from each worker's cache."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm.arrow import annotate, pieces, raw
from turnstone.session import ship

#: Entries of the broadcast table at most, and the documents it is gathered from at most.
TABLE_ENTRIES = 50_000
SAMPLE_DOCUMENTS = 4_000
SAMPLE_SEED = 7
#: Entries that a worker keeps of pre-tokens outside the table.
CACHE_ENTRIES = 200_000
#: Longer pre-tokens are encoded each time, not kept.
CACHE_CHARS = 64
TOKEN_LIMIT = 4096

#: A piece of the vocabulary never holds a space after another character, nor a line feed: no merge crosses these cuts.
_PRE_TOKEN = re.compile(r"\n| *[^ \n]+| +")

FIELDS = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("over_limit", T.BooleanType()),
]

_models: dict[str, object] = {}
_caches: dict[str, dict[str, int]] = {}


def pre_tokens(text: str) -> list[str]:
    """The text cut where no token can cross. A space stands before the text, as the library puts one there."""
    return _PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []


def model(path: str):
    """The tokenizer, once a worker process."""
    if path not in _models:
        import sentencepiece

        found = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (found.id_to_piece(i) for i in range(found.get_piece_size()))
        if any("\n" in p or "▁" in p.lstrip("▁") for p in names):
            raise ValueError(f"{path}: tokens cross spaces; its texts can't be cut into pre-tokens")
        if found.encode("a ﬁ  b ", out_type=str)[-1] != "▁" or len(found.encode("\n")) != 2:
            raise ValueError(f"{path}: it rewrites its input or puts no space first")
        _models[path] = found
    return _models[path]


def lengths(path: str, tokens: list[str]) -> list[int]:
    """Each pre-token's number of tokens. A line feed before it keeps the library from adding a space; it costs two."""
    return [len(ids) - 2 for ids in model(path).encode(["\n" + t for t in tokens], num_threads=1)]


def counter(path: str, table: dict[str, int]) -> Callable[[list[bytes | None]], list[list]]:
    """A function from texts to n_bytes, n_tokens and over_limit."""
    cache = _caches.setdefault(path, {})

    def count(texts: list[bytes | None]) -> list[list]:
        out: list[list] = [[], [], []]
        rest: list[Counter] = []
        for text in texts:
            tokens = pre_tokens(text.decode()) if text else []
            missed = [t for t in tokens if t not in table]
            out[0].append(len(text) if text else 0)
            out[1].append(sum(map(table.__getitem__, tokens)) if not missed else sum([table.get(t, 0) for t in tokens]))
            rest.append(Counter(missed))
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        new = list({t for c in rest for t in c if t not in cache})
        own = dict(zip(new, lengths(path, new), strict=True))
        for i, c in enumerate(rest):
            out[1][i] += sum(n * (cache[t] if t in cache else own[t]) for t, n in c.items())
        cache.update((t, n) for t, n in own.items() if len(t) <= CACHE_CHARS)
        out[2] = [n > TOKEN_LIMIT for n in out[1]]
        return out

    return count


def frequent_lengths(
    docs: DataFrame, path: str, text: str = "text", entries: int = TABLE_ENTRIES, sample: int = SAMPLE_DOCUMENTS
) -> dict[str, int]:
    """The most frequent pre-tokens of a bounded sample of documents, with their lengths.

    It only decides which lengths come from the broadcast table: counts are the same with any table, so it is no
    statistic of the result, and counting all pre-tokens for it would take the shuffle that this method spares. The
    sample holds about `sample` rows, each dealt by itself, so copies don't come or go together; `entries` bounds
    what the driver gets.
    """
    share = min(1.0, sample / max(1, docs.count()))
    chosen = docs.select(text).sample(share, SAMPLE_SEED)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            texts = raw(batch.column(0))
            for begin, end in pieces(texts):
                for t in texts[begin:end]:
                    seen.update(pre_tokens(t.decode()) if t else ())
                if len(seen) > 8 * entries:
                    seen = Counter(dict(seen.most_common(4 * entries)))
        top = [(t, n) for t, n in seen.most_common(2 * entries) if len(t) <= CACHE_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["token", "n"])

    ship(docs.sparkSession)
    best = chosen.mapInArrow(tally, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    tokens = [r["token"] for r in best.orderBy(F.desc("n"), "token").limit(entries).select("token").collect()]
    return dict(zip(tokens, lengths(path, tokens), strict=True))


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", table: dict[str, int] | None = None, keep: list[str] | None = None
) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit of each whole text, for a SentencePiece model with byte fallback.

    Map side only. A pre-token's length comes from the broadcast table (at most TABLE_ENTRIES short strings), else
    from the worker's bounded cache, else from the library; no pre-token is shuffled. `path` must exist on every
    executor. The sum equals the library's count for the whole text: see _PRE_TOKEN.

    A null or empty text has 0 bytes and 0 tokens; very long texts are cut the same way; repeated rows give
    repeated results; an empty table gives none; columns named like a result are replaced.
    """
    found = frequent_lengths(docs, path, text) if table is None else table
    shared = docs.sparkSession.sparkContext.broadcast(found)
    return annotate(docs, text, lambda: counter(path, shared.value), FIELDS, keep)
