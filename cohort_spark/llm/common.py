"""Helpers shared by the training-data operators."""
from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffles_cleaned

#: The white space of word and line contracts: [\x20\x09-\x0D], fixed.
BLANKS = " \t\n\x0b\x0c\r"
#: A-Z and a-z, for ASCII-only lower-casing.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (lineage is cut;
    a lost executor re-reads the table)."""
    path = shared_path(df.sparkSession, name)
    out = df.write.option("compression", "zstd")
    with shuffles_cleaned(df.sparkSession):
        (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partitions: what grows with the cluster and the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


#: What empties the tables that operators keep in a Python worker, by owner; true if there was something.
_TABLES: dict[str, Callable[[], bool]] = {}


def worker_table(owner: str, empty: Callable[[], bool]) -> None:
    _TABLES[owner] = empty


def working_for(owner: str | None = None, trim: bool = False) -> None:
    """Called by tasks as they start: Spark reuses Python workers, so what an earlier operator's
    tasks left in this one is emptied, all but the table of ``owner``; then, or to ``trim``, memory
    that Arrow and the C library keep for later is given back."""
    emptied = [empty() for name, empty in _TABLES.items() if name != owner]
    if not (trim or any(emptied)):
        return
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def tidy(task: Callable, owner: str | None = None) -> Callable:
    """A task over Arrow batches that leaves its worker as lean at its end: idle workers stay beside
    the executor's later tasks."""
    def run(batches):
        working_for(owner)
        try:
            yield from task(batches)
        finally:
            working_for(owner, trim=True)

    return run


def slices(batches, rows: int = 1000):
    """Arrow batches of at most ``rows`` rows, so a task holds few whole texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fs_of(uri: str):
    """pyarrow file system and path of a shared folder (file, hdfs, s3, gs ...)."""
    from pyarrow import fs

    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)
