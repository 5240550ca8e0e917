"""Files that appear all together or not at all: a data source writer whose tasks stage and whose commit publishes."""

from __future__ import annotations

import json
import os
import shutil
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from turnstone.session import ship

_STAGED, _DECIDED = ".staged-", "commit.json"


@dataclass
class Staged(WriterCommitMessage):
    """What a task has staged: its own folder. Attempts that failed or were done twice are in folders that no message names."""

    folder: str


class PublishedFiles(DataSource):
    """Rows (path, content) as files under the folder `root`, which driver and executors see; content of rows with one path is
    appended in the order in which its task has them."""

    @classmethod
    def name(cls) -> str:
        return "published_files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> Publisher:
        return Publisher(self.options["root"])


class Publisher(DataSourceWriter):
    def __init__(self, root: str):
        self.root = root
        self.staged = f"{_STAGED}{uuid.uuid4().hex}"
        Path(root, self.staged).mkdir(parents=True)

    def write(self, rows: Iterator[Row]) -> Staged:
        own = uuid.uuid4().hex
        folder = Path(self.root, self.staged, own)
        folder.mkdir()  # not where the run has been given up meanwhile
        for row in rows:
            target = folder / row.path
            if not target.resolve().is_relative_to(folder.resolve()) or row.path.startswith(_STAGED):
                raise ValueError(f"no path inside the folder: {row.path}")
            target.parent.mkdir(parents=True, exist_ok=True)
            with target.open("ab") as out:
                out.write(row.content or b"")
        return Staged(own)

    def commit(self, messages: list[Staged]) -> None:
        """Write down what is to be published, and from then on it will be: a commit that is cut short is finished by
        the next one, or by finish_commits."""
        staged = Path(self.root, self.staged)
        part = staged / f"{_DECIDED}.part"
        part.write_text(json.dumps([m.folder for m in messages if m is not None]))
        part.replace(staged / _DECIDED)
        finish_commits(self.root)

    def abort(self, messages: list[Staged]) -> None:
        """What a task still writes while the run is given up stays hidden, and is never published: see forget."""
        shutil.rmtree(Path(self.root, self.staged), ignore_errors=True)


def finish_commits(root: str) -> int:
    """Move what decided commits have staged to its place; the number of commits. Moving again what was moved does no harm."""
    found = sorted(Path(root).glob(f"{_STAGED}*/{_DECIDED}"))
    for decided in found:
        for name in json.loads(decided.read_text()):
            folder = decided.parent / name
            for path in [p for p in folder.rglob("*") if p.is_file()]:
                target = Path(root, path.relative_to(folder))
                target.parent.mkdir(parents=True, exist_ok=True)
                os.replace(path, target)
        shutil.rmtree(decided.parent)
    return len(found)


def forget(root: str, seconds: float = 86_400.0) -> int:
    """Delete what runs have staged that were given up, and that nobody has touched for so long; the number of runs."""
    old = [p for p in Path(root).glob(f"{_STAGED}*") if not (p / _DECIDED).exists() and time.time() - p.stat().st_mtime > seconds]
    for folder in old:
        shutil.rmtree(folder, ignore_errors=True)
    return len(old)


def publish(rows: DataFrame, root: str) -> None:
    """Write rows (path, content) as files under root: if any task fails for good, none of them appears."""
    spark = rows.sparkSession
    ship(spark)
    spark.dataSource.register(PublishedFiles)
    Path(root).mkdir(parents=True, exist_ok=True)
    rows.select("path", F.col("content").cast("binary").alias("content")).write.format("published_files").mode("append").option("root", root).save()


def publish_files(rows: DataFrame, root: str, kinds: dict[str, tuple[str, str]], name: str = "name") -> None:
    """Each row's texts as root/<folder>/<name><suffix>, kinds: column -> (folder, suffix), all together or not at all;
    texts that are null make no file. `files.write_files` writes the same files one by one."""
    made = [F.struct(F.concat(F.lit(f"{folder}/"), F.col(name).cast("string"), F.lit(suffix)).alias("path"), F.col(column).alias("content")) for column, (folder, suffix) in kinds.items()]
    publish(rows.select(F.inline(F.array(*made))).where("content IS NOT NULL"), root)


def join_parts(spark: SparkSession, folder: str, target: str, before: bytes, after: bytes, skip: int) -> None:
    """Put the files of a folder together, in the order of their names, as the file target: one task copies them, piece by
    piece, and the driver sees none of it. Of the first file `skip` bytes are left out."""

    def copy(batches):
        for batch in batches:
            part = Path(target).with_name(f".{uuid.uuid4().hex}.part")
            try:
                with part.open("wb") as out:
                    out.write(before)
                    paths = sorted(p for p in Path(folder).iterdir() if p.is_file())
                    for k, path in enumerate(paths):
                        with path.open("rb") as held:
                            held.seek(0 if k else skip)
                            shutil.copyfileobj(held, out)
                    out.write(after if paths else after.lstrip())
                os.replace(part, target)
            finally:
                part.unlink(missing_ok=True)
            yield batch

    ship(spark)
    spark.range(1, numPartitions=1).mapInArrow(copy, "id long").write.format("noop").mode("overwrite").save()
