"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/corpus/{name}-{uuid.uuid4().hex}"


#: Folders of the tables that ``materialise`` makes inside ``scratch``; each thread of the driver has its own.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Collects the folders of tables made inside, for ``drop_tables`` once nothing reads them."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)


def drop_tables(spark: SparkSession, folders: list[str]) -> None:
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    while folders:
        path = jvm.org.apache.hadoop.fs.Path(folders.pop())
        path.getFileSystem(conf).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet and read again: cuts the lineage, and a lost executor loses nothing of it."""
    path = new_path(df.sparkSession, name)
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by ``materialise`` that nothing reads any more."""
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    drop_tables(df.sparkSession, [f for f in folders if "/corpus/" in f])


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames that are no longer referenced.

    Its cleaner acts when the driver collects garbage, which a job of a few large stages may not see in time. Python tells the
    JVM of dropped frames from another thread, hence the short waits.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark._jvm.System.gc()
        time.sleep(0.3)
