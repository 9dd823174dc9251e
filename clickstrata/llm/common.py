"""What several operators of this package need."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from clickstrata.sources.shared import fresh_path

#: Words a worker remembers at once; its memory is emptied when it holds more.
REMEMBERED_WORDS = 300_000

#: Bytes to bytes: A-Z become a-z, all else stays (no letter of UTF-8 above ASCII is touched).
LOWER = bytes(range(256)).lower()

#: The same, and every byte outside ``[0-9a-z]`` and UTF-8's upper half becomes a space.
WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in LOWER
)


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver imported it from.

    A worker that has the package by other means (``--py-files``, an installation) uses that.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (*paths, root) if p)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a whole stored table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).select(*columns)


def fresh_name(name: str, df: DataFrame) -> str:
    """A column name like ``name`` that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: With it, a query's shuffle files go when the query ends, not when memory runs low.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back; what was shuffled to make it is not kept."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a batch that the JVM and a Python worker hand to each other; both hold whole batches.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile hands ``BATCH_ROWS`` rows to Python at once, or as few as are asked for."""
    before = spark.conf.get(_BATCH)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


class Workspace:
    """Tables of one computation, in a folder of its own in the cluster's shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, fresh_path(spark, name)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, fresh_path(self.spark, name, self.folder))

    def result(self, df: DataFrame) -> DataFrame:
        """A table that outlives the workspace."""
        return stored(df, f"{self.folder}-result")

    def remove(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[Workspace]:
    """A workspace whose tables are removed at the end; results written by it stay."""
    work = Workspace(spark, name)
    try:
        yield work
    finally:
        work.remove()


def texts_of(column) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8, one at a time; a null has no text."""
    for value in column:
        text = value.as_py()
        yield text.encode("utf-8", "surrogatepass") if text else b""


class WordHashes(dict):
    """64-bit hashes of words, each computed once while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finisher of a public hash function)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingle_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for each ``n`` consecutive words, in order; none if there are fewer."""
    count = len(word_hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i : i + count]
    return mixed(total)


def chunks(items: Iterable, size: int) -> Iterator[list]:
    """Lists of at most ``size`` items."""
    block: list = []
    for item in items:
        block.append(item)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block
