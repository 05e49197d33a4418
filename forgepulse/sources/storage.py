"""File-system helpers that work on any storage Spark can write to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The most tasks Spark lists folders by, and its default: in effect a task for each folder.
LISTING_TASKS, A_TASK_EACH = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000"


def list_by_few_tasks(spark: SparkSession) -> None:
    """Lets each of a few tasks list many folders, unless the session has its own number."""
    if spark.conf.get(LISTING_TASKS) == A_TASK_EACH:
        spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))


def _open(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _open(spark, path)
    return files.exists(location)


def child_names(spark: SparkSession, path: str) -> list[str]:
    files, location = _open(spark, path)
    if not files.exists(location):
        return []
    return [status.getPath().getName() for status in files.listStatus(location)]


def drop_folder(spark: SparkSession, path: str) -> None:
    files, location = _open(spark, path)
    files.delete(location, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, location = _open(spark, path)
    stream = files.create(location, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str, beside: str) -> bool:
    """Writes a whole file under a name nobody has taken, or returns False; readers never see
    a part of it. `beside` is a name in the same folder for the time of writing."""
    write_text(spark, beside, text)
    files, location = _open(spark, path)
    if not files.exists(location) and files.rename(_open(spark, beside)[1], location):
        return True
    drop_folder(spark, beside)
    return False


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 at which the folder or file was last changed."""
    files, location = _open(spark, path)
    return files.getFileStatus(location).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    files, location = _open(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as `spark.checkpoint.dir` names it.

    Where it is unset, a local session (one machine) takes a folder below its warehouse; on
    a cluster nothing else is known to be shared, so none is guessed.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


class Scratch:
    """A folder of its own for results that are read more than once.

    Writing them cuts the lineage, survives the loss of executors, and gives the
    planner real sizes to choose join strategies by.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_root(spark)}/forgepulse-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(
        self, df: DataFrame, partition_by: Sequence[str] = (), name: str | None = None
    ) -> DataFrame:
        path = self.path(name or uuid.uuid4().hex)
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def inner(self) -> Scratch:
        """A folder within this one, so that an operator can be used twice with one scratch."""
        folder = Scratch(self.spark)
        folder.root = self.path(uuid.uuid4().hex)
        return folder

    def discard(self, *names: str) -> None:
        """Deletes results kept under these names, which nothing reads any more."""
        for name in names:
            drop_folder(self.spark, self.path(name))

    def drop(self) -> None:
        drop_folder(self.spark, self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()
