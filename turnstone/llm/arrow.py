"""Running a function of texts over Arrow batches, beside the rows' other columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from turnstone.session import ship

#: Texts are worked on in pieces of about so many bytes, to bound memory; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def pieces(texts: Sequence[bytes | None], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `limit` bytes of text each."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def release() -> None:
    """Give back to the system what a worker has freed: workers are used again, and would keep the most that they ever held
    beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def raw(column: pa.Array) -> list[bytes | None]:
    """A string column's UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def annotate(
    df: DataFrame,
    text: str,
    start: Callable[[], Callable[[list[bytes | None]], list[list]]],
    fields: Sequence[T.StructField],
    keep: Sequence[str] | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """df's columns (or only those in `keep`) and `fields`, computed from each row's `text`.

    `start` runs once a task and gives the function that maps texts (UTF-8, or None) to one list of values
    a field; it is also given the values of the columns in `extra`. A column of df with the name of a new field is replaced.
    """
    new = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    sent = list(dict.fromkeys([*kept, text, *extra]))
    schema = T.StructType([df.schema[c] for c in kept] + list(fields))
    arrow_fields = [pa.field(f.name, to_arrow_type(f.dataType), f.nullable) for f in fields]
    at, more = sent.index(text), [sent.index(c) for c in extra]
    n_kept = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            texts = raw(batch.column(at))
            names = pa.schema([*(batch.schema.field(i) for i in range(n_kept)), *arrow_fields])
            for begin, end in pieces(texts):
                columns = [batch.column(i).slice(begin, end - begin) for i in range(n_kept)]
                columns += [pa.array(v, f.type) for v, f in zip(work(texts[begin:end], *(batch.column(i).slice(begin, end - begin).to_pylist() for i in more)), arrow_fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=names)
            release()

    ship(df.sparkSession)
    return df.select(*[df[f"`{c}`"] for c in sent]).mapInArrow(run, schema)
