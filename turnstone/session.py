"""Session helpers: building a session, shipping the package, shared scratch tables."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent


def get_session(app: str = "turnstone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for; an existing session is returned as it is."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.unionOutputPartitioning": "false",  # with adaptive execution it can lose rows
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once for each Spark application."""
    context = spark.sparkContext
    if getattr(context, "_turnstone_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="turnstone-")) / "turnstone.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(ROOT.rglob("*.py")):
            out.write(path, path.relative_to(ROOT.parent))
    context.addPyFile(str(archive))
    context._turnstone_shipped = True


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over all of spark.sql.shuffle.partitions: adaptive execution would put rows that cost much work a byte
    into about one task more than there are cores, so that half the cores idle in the second wave."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. On one machine it may be unset."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir", None) or getattr(context, "_turnstone_dir", None)
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="turnstone-shared-", dir=os.environ.get("TMPDIR", "/tmp"))
        context._turnstone_dir = found
    return found.rstrip("/")


def _tables(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/turnstone/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: its lineage is cut and it survives lost executors."""
    spark = df.sparkSession
    path = f"{_tables(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables that this application has materialized, once no result reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_tables(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def timed(seconds: dict[str, float], stage: str) -> Iterator[None]:
    """Add the wall-clock seconds of a block to seconds[stage], also where the block fails."""
    began = time.monotonic()
    try:
        yield
    finally:
        seconds[stage] = seconds.get(stage, 0.0) + time.monotonic() - began


#: Fixed value: seconds before a job's end from which no new work is begun.
SPARE_SECONDS = 600.0


def seconds_left(minutes: float, began: float | None = None) -> float:
    """Seconds in which work may still be begun, of a job of so many minutes that began at time.monotonic() `began`
    (now, if not given); without minutes there is no end."""
    if not minutes:
        return float("inf")
    now = time.monotonic()
    return (now if began is None else began) + minutes * 60 - SPARE_SECONDS - now
