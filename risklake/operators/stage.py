"""Written intermediate tables: they cut lineage and survive the loss of executors."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def stage_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``, or a new temporary one in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="risklake-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: tables staged by this process and not deleted yet
_staged: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    _staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def deleting_staged(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``stage`` writes inside, at the end. Nothing that reads them may be used after it."""
    before = len(_staged)
    try:
        yield
    finally:
        jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in _staged[before:]:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(configuration).delete(path, True)
        del _staged[before:]


#: how many tasks a core gets of an input that ``spark.sql.files.maxPartitionBytes`` alone would not cut
WAVES = 4


@contextmanager
def even_splits(spark: SparkSession) -> Iterator[None]:
    """Cut the files read inside into ``WAVES`` tasks a core at least, so that the last ones to run leave few cores idle.

    By default Spark aims at one task a core, and whole files seldom fill those evenly: a few more tasks than cores take
    twice the time. The largest size of a split stays the session's, and so does a higher number of its own.
    """
    setting = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(max(WAVES * spark.sparkContext.defaultParallelism, int(before or 0))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
