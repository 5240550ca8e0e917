"""A data source that lists shared folders, one partition a folder, through a client that is given."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from turnstone.sources.listing import AUDIO_SUFFIXES


class Folder(InputPartition):
    def __init__(self, name: str):
        self.name = name


def local_client(root: str):
    """Lists a mounted share: folders, and the files of one."""
    base = Path(root)

    def listed(folder: str | None) -> list[tuple[str, bool]]:
        return sorted((p.name, p.is_dir()) for p in (base / folder if folder else base).iterdir())

    return listed


class FolderSource(DataSource):
    """spark.read.format("audio_folders").option("root", ...).option("folders", "a,b").load()

    Without folders, all of root's. A folder that can't be listed is left out. client: a module:function that maps
    a root to a lister, as local_client does. spark.readStream gives the recordings that are new: see FolderStream."""

    @classmethod
    def name(cls) -> str:
        return "audio_folders"

    def schema(self) -> str:
        return "folder string, name string, remote_path string"

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FolderStream(self.options)


class _Shares:
    """The folders that options name, and how they are listed."""

    def __init__(self, options):
        self.root, self.folders = options["root"], options.get("folders")
        self.client = options.get("client", "turnstone.sources.folders:local_client")

    def lister(self):
        from importlib import import_module

        module, _, function = self.client.partition(":")
        return getattr(import_module(module), function)(self.root)

    def names(self) -> list[str]:
        return [f for f in (self.folders or "").split(",") if f] or [n for n, is_dir in self.lister()(None) if is_dir]

    def recordings(self, folder: str) -> list[str]:
        """Names of a folder's recordings; none where it can't be listed."""
        try:
            found = self.lister()(folder)
        except OSError:
            return []
        return [name for name, is_dir in found if not is_dir and name.lower().endswith(AUDIO_SUFFIXES)]

    def row(self, folder: str, name: str) -> tuple[str, str, str]:
        return folder, name, f"{self.root}/{folder}/{name}"


class FolderReader(_Shares, DataSourceReader):
    def partitions(self) -> list[Folder]:
        return [Folder(n) for n in self.names()]

    def read(self, partition: Folder) -> Iterator[tuple[str, str, str]]:
        for name in self.recordings(partition.name):
            yield self.row(partition.name, name)


class NewFiles(InputPartition):
    def __init__(self, folder: str, batch: int):
        self.folder, self.batch = folder, batch


class FolderStream(_Shares, DataSourceStreamReader):
    """New recordings of the folders, each once. Offsets count batches of a ledger, a folder that driver and executors see
    (option ledger): a batch is the names that no earlier one has, by folder, and it is written down before it is an
    offset. So a batch that is read again after a restart holds the same files, and of what is known only one folder's names are
    held at a time. A folder that can't be listed is looked at again next time."""

    def __init__(self, options):
        super().__init__(options)
        if not options.get("ledger"):
            raise ValueError("option ledger: a folder for the names that have been given")
        self.ledger = Path(options["ledger"])

    def _names(self, folder: str) -> Path:
        return self.ledger / "folders" / hashlib.sha256(folder.encode()).hexdigest()

    def _batches(self) -> Path:
        return self.ledger / "batches"

    def _last(self) -> int:
        return max((int(p.stem) for p in self._batches().glob("*.json")), default=0)

    @staticmethod
    def _write(path: Path, value: list[str]) -> None:
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_suffix(".part")
        part.write_text(json.dumps(value), encoding="utf-8")
        part.replace(path)

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        last = self._last()
        fresh = []
        for folder in self.names():
            own = self._names(folder)
            known = {n for p in own.glob("*.json") if int(p.stem) <= last for n in json.loads(p.read_text(encoding="utf-8"))}
            found = sorted(set(self.recordings(folder)) - known)
            if found:
                self._write(own / f"{last + 1}.json", found)
                fresh.append(folder)
        if fresh:
            self._write(self._batches() / f"{last + 1}.json", fresh)
        return {"batch": last + bool(fresh)}

    def partitions(self, start: dict, end: dict) -> list[NewFiles]:
        return [NewFiles(folder, n) for n in range(start["batch"] + 1, end["batch"] + 1) for folder in json.loads((self._batches() / f"{n}.json").read_text(encoding="utf-8"))]

    def read(self, partition: NewFiles) -> Iterator[tuple[str, str, str]]:
        for name in json.loads((self._names(partition.folder) / f"{partition.batch}.json").read_text(encoding="utf-8")):
            yield self.row(partition.folder, name)

    def commit(self, end: dict) -> None:
        pass
