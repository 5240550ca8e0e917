"""Fetching items, and writing one named file a row."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.request import urlopen

import pandas as pd
from pyspark.sql import DataFrame

from turnstone.session import ship
from turnstone.sources.playlists import download, is_playlist

FETCH_SECONDS = 600
#: Fixed value: a download of no more bytes has failed (for fetch_items' least_bytes).
EMPTY_BYTES = 1000


def _copy_url(item: dict, target: Path) -> None:
    if is_playlist(item["url"]):
        return download(item["url"], target)
    with urlopen(item["url"], timeout=FETCH_SECONDS) as source, target.open("wb") as out:  # noqa: S310
        shutil.copyfileobj(source, out)


FETCHERS: dict[str, Callable[[dict, Path], None]] = {"url": _copy_url}


def fetch_items(items: DataFrame, dest: str, fetchers: dict[str, Callable[[dict, Path], None]] | None = None, least_bytes: int = 0) -> DataFrame:
    """Items (id, kind, path, url, filename) with local_path and error.

    A local file is used where it is; others are fetched by their kind's function into dest, a folder that all
    executors see, by a temporary name first. A missing file, an unknown kind or a fetched file of no more than
    least_bytes is that item's error."""
    known = FETCHERS | (fetchers or {})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema) + ", local_path string, error string"

    def one(item: dict) -> str:
        kind = item.get("kind") or "local"
        if kind == "local":
            if not os.path.exists(item["path"]):
                raise FileNotFoundError(item["path"])
            return item["path"]
        if kind not in known:
            raise ValueError(f"unknown source kind: {kind}")
        target = Path(dest) / (item.get("filename") or item["id"])
        target.parent.mkdir(parents=True, exist_ok=True)
        part = target.with_name(target.name + ".part")
        known[kind](item, part)
        if least_bytes and part.stat().st_size <= least_bytes:
            part.unlink()
            raise ValueError(f"only {least_bytes} bytes or fewer: {target.name}")
        part.replace(target)
        return str(target)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for item in batch.to_dict("records"):
                try:
                    out.append({**item, "local_path": one(item), "error": None})
                except Exception as error:  # noqa: BLE001  any failure is this item's error
                    out.append({**item, "local_path": None, "error": f"{type(error).__name__}: {error}"})
            yield pd.DataFrame(out, columns=[*batch.columns, "local_path", "error"])

    ship(items.sparkSession)
    return items.mapInPandas(run, schema)


def write_files(rows: DataFrame, root: str, kinds: dict[str, tuple[str, str]], name: str = "name") -> DataFrame:
    """Write each row's texts as root/<folder>/<name><suffix>, kinds: column -> (folder, suffix).

    root is a folder that all executors see. A file appears under its name only when it is whole, so a task that
    runs again does no harm. Gives name and the number of files; it writes when the result is used."""
    columns = list(kinds)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = []
            for row in batch.to_dict("records"):
                written = 0
                for column in columns:
                    if row[column] is None:
                        continue
                    folder, suffix = kinds[column]
                    target = Path(root) / folder / f"{row[name]}{suffix}"
                    target.parent.mkdir(parents=True, exist_ok=True)
                    part = target.with_name(f".{uuid.uuid4().hex}.part")
                    part.write_text(row[column], encoding="utf-8", newline="")
                    os.replace(part, target)
                    written += 1
                counts.append(written)
            yield pd.DataFrame({name: batch[name], "files": counts})

    ship(rows.sparkSession)
    return rows.select(name, *columns).mapInPandas(run, f"{name} {rows.schema[name].dataType.simpleString()}, files int")
