"""Helpers shared by the corpus operators: shared-folder tables, Arrow batch bounds, column lookup."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch handed to Python; bounds a worker's memory whatever the length of the texts.
ARROW_ROWS, ARROW_BYTES = 2000, 16 << 20


#: Ids (8 bytes each) up to which they are broadcast to meet longer rows; beyond, both sides are dealt by id.
FEW_IDS = 2_000_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares: spark.checkpoint.dir, or one of our own where that is unset and all run on this machine (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="lodestrata-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, and a lost executor loses none of it."""
    return Scratch(df.sparkSession).table(df, name)


class Scratch:
    """Tables of one job in the shared folder, removed when they are no longer read."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.held = spark, []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` and read it back; the shuffle files of the writing job go with its end."""
        path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def drop(self, *keep: DataFrame) -> None:
        """Remove the tables that are not among `keep`."""
        jvm, conf, rest = self.spark._jvm, self.spark._jsc.hadoopConfiguration(), []
        for df, path in self.held:
            if any(df is x for x in keep):
                rest.append((df, path))
            else:
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(conf).delete(at, True)
        self.held = rest


def dealt(rows: DataFrame, ids: DataFrame, key: str | list[str], how: str) -> DataFrame:
    """`rows` joined with the few columns of `ids` by `key`: `ids`, a written table of numbers, is broadcast while it holds
    few values, so that long rows do not move to meet it; else both are dealt by key."""
    return rows.join(F.broadcast(ids) if ids.count() * len(ids.columns) <= FEW_IDS else ids.hint("merge"), key, how)


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows and bytes unless the session already asks for smaller ones."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def in_parts(batch: pa.RecordBatch, text: int, rows: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most `rows` rows and, but for a single longer text, `most` bytes in the column `text`."""
    sizes = pc.binary_length(batch.column(text)).to_pylist()
    at = held = 0
    for k, size in enumerate(sizes):
        if k > at and (k - at >= rows or held + (size or 0) > most):
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += size or 0
    if at < len(sizes):
        yield batch.slice(at)


def single_threaded() -> None:
    """Keep native libraries in a Python worker to the one core that Spark gave its task."""
    for key in ("TOKENIZERS_PARALLELISM", "OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
        os.environ.setdefault(key, "false" if key[0] == "T" else "1")


def giving_back(rows: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`rows`, a map over a task's batches, after which the worker hands what it has freed back to the system: else it keeps
    that while it waits for its next task, beside the JVM and the other workers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
            if trim:
                trim(0)

    return run


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
