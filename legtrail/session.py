"""Session settings for local runs, and the shared folder for written intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Session for tests and benchmarks; on a cluster use the session the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("legtrail")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: ``spark.checkpoint.dir``.

    A local session (tests) that has none is given a temporary one; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = tempfile.mkdtemp(prefix="legtrail-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Name of a folder under the shared one that nobody has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/legtrail-{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str = "staged") -> DataFrame:
    """The same rows, written once as a table in the shared folder and read back.

    Fixes rows that several later steps read, cuts their lineage, and outlives lost executors.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(target) if entry.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that is in it, if it is there."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


class Scratch:
    """A folder under the shared one for tables that only one run needs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.tables = spark, new_folder(spark, "scratch"), 0

    def staged(self, df: DataFrame, purpose: str) -> DataFrame:
        """As :func:`staged`, inside this folder."""
        self.tables += 1
        path = f"{self.folder}/{purpose}-{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def measured(self, df: DataFrame, purpose: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """As :meth:`staged`, and aggregates over the rows, which come out of the pass that writes them."""
        observed = Observation(purpose)
        named = [metric.alias(name) for name, metric in metrics.items()]
        return self.staged(df.observe(observed, *named), purpose), observed.get

    def remove(self) -> None:
        remove(self.spark, self.folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A :class:`Scratch` whose folder is removed at the end, also after a failure."""
    held = Scratch(spark)
    try:
        yield held
    finally:
        held.remove()


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, but typed."""
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(0).select(*nothing)
