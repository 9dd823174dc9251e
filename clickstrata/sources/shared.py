"""Tables in the cluster's shared folder.

A table written there ends the lineage of what reads it: a lost executor costs a re-read, not
a recomputation, and every reader still prunes columns.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one where none is set, as in local tests."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="clickstrata-")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name, folder)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder below the shared one that is gone, with its tables, at the end."""
    folder = fresh_path(spark, name)
    try:
        yield folder
    finally:
        remove(spark, folder)
