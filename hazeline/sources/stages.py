"""Stage persistence and tabular sinks.

``staged`` writes what a later step reads more than once; inside ``scratch`` these tables go when the block ends. A ``Run`` keeps named stages: each is
entered in a manifest after it has been written, so a run that died is taken up behind its last finished stage.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or the checkpoint folder set on the context.

    Only a local session, as in tests, may fall back to a temporary folder, one for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="hazeline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/stages/{name}-{uuid.uuid4().hex}"


#: Folders of the tables that ``staged`` makes inside ``scratch``; each thread of the driver has its own.
_made: ContextVar[list[str] | None] = ContextVar("stages_made", default=None)


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a folder on any store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def remove(spark: SparkSession, path: str) -> None:
    store, at = _file_system(spark, path)
    store.delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end every table that ``staged`` made inside; what reads them must have been written by then."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: computed once, and kept if an executor is lost."""
    path = stage_path(df.sparkSession, name)
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return read_stage(df.sparkSession, path, df.schema)


def write_stage(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
) -> None:
    """Parquet by partition; ranges of rows to each task, sorted so that row groups can be skipped."""
    if cluster_by:
        # ranges, so that a partition is written by few tasks and a hot one by several
        df = df.repartitionByRange(*partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_stage(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A text for the files below the paths: it changes with their names, lengths and times, not with their order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    row = files.agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()
    # a scan leaves empty files out, the listing does not
    names = hashlib.sha256("\n".join(sorted(files.inputFiles())).encode()).hexdigest()
    return f"{names}:{row.h}"


class Run:
    """Named stages below one folder.

    A stage is a Parquet table in a folder of its own and, once that is complete, an entry in the manifest with the table's place, its schema
    and the key it was made for. A stage with an entry for its key is read, any other is made. Tables without an entry are what a
    killed run left, or were made for another key; ``remove_stale`` deletes them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _entry(self, name: str) -> dict | None:
        store, at = _file_system(self.spark, f"{self.folder}/manifest/{name}/_SUCCESS")
        if not store.exists(at):
            return None
        row = self.spark.read.text(f"{self.folder}/manifest/{name}").first()
        return json.loads(row.value) if row else None

    def finished(self, name: str, key: str) -> bool:
        entry = self._entry(name)
        return entry is not None and entry["key"] == key

    def read(self, name: str) -> DataFrame:
        entry = self._entry(name)
        return read_stage(self.spark, entry["path"], T.StructType.fromJson(entry["schema"]))

    def stage(
        self, name: str, key: str, make: Callable[[], DataFrame], partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
    ) -> DataFrame:
        """The stage's table, made now unless it is finished for this key."""
        if not self.finished(name, key):
            df = make()
            path = f"{self.folder}/tables/{name}-{uuid.uuid4().hex}"
            write_stage(df, path, partition_by, cluster_by)
            entry = json.dumps({"key": key, "path": path, "schema": df.schema.jsonValue()})
            # the entry is the commit: the table above is complete
            self.spark.createDataFrame([(entry,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/manifest/{name}")
        return self.read(name)

    def remove_stale(self) -> list[str]:
        """Deletes tables that no entry names, and returns their folders' names."""
        gone = []
        store, tables = _file_system(self.spark, f"{self.folder}/tables")
        _, manifest = _file_system(self.spark, f"{self.folder}/manifest")
        names = [f.getPath().getName() for f in store.listStatus(manifest)] if store.exists(manifest) else []
        kept = {entry["path"].rpartition("/")[2] for entry in map(self._entry, names) if entry}
        for f in store.listStatus(tables) if store.exists(tables) else []:
            if f.getPath().getName() not in kept:
                store.delete(f.getPath(), True)
                gone.append(f.getPath().getName())
        return gone
