"""A table that a stream upserts by key, in the folder of a Parquet table.

Every micro-batch writes its changed rows to ``delta=<batch id>`` (overwritten when the batch is
replayed after a failure, so a row is never counted twice); a reader takes the row of the latest
batch for each key.  After ``compact_every`` batches the rows so far are written to
``base=<batch id>``, the folders before it are no longer read and ``vacuum`` deletes them.  A
folder without its ``_SUCCESS`` file is not there.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class UpsertTable:
    """Rows of ``schema`` by ``keys`` in ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], compact_every: int = 16):
        self.spark, self.path, self.schema, self.keys, self.compact_every = spark, path.rstrip("/"), schema, keys, compact_every

    def _folders(self) -> dict[str, list[int]]:
        """Finished ``base`` and ``delta`` numbers, ascending."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found: dict[str, list[int]] = {"base": [], "delta": []}
        if fs.exists(top):
            for status in fs.listStatus(top):
                kind, _, number = status.getPath().getName().partition("=")
                if kind in found and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                    found[kind].append(int(number))
        return {k: sorted(v) for k, v in found.items()}

    def _rows(self, upto: int | None = None, below: int | None = None) -> DataFrame:
        """The latest row of each key, from the newest base (under ``below``) and the deltas after it."""
        there = self._folders()
        bases = [n for n in there["base"] if below is None or n < below]
        base = bases[-1] if bases else -1
        parts = [("base", base)] * bool(bases) + [("delta", n) for n in there["delta"] if n > base and (upto is None or n <= upto)]
        frames = [self.spark.read.schema(self.schema).parquet(f"{self.path}/{kind}={n}").withColumn("_batch", F.lit(n).cast("long")) for kind, n in parts]
        if not frames:
            return self.spark.createDataFrame([], self.schema)
        rows = reduce(DataFrame.unionByName, frames)  # at most compact_every folders and a base
        latest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*self.schema.names), "_batch").alias("r"))
        return latest.select("r.*")

    def read(self) -> DataFrame:
        return self._rows()

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch`` in update mode."""
        batch.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/delta={batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            self._rows(upto=batch_id, below=batch_id).write.mode("overwrite").parquet(f"{self.path}/base={batch_id}")

    def vacuum(self, keep_bases: int = 2) -> None:
        """Delete what the newest ``keep_bases`` bases make needless; readers of older ones must be done."""
        there = self._folders()
        if len(there["base"]) < keep_bases:
            return
        oldest = there["base"][-keep_bases]
        jvm = self.spark.sparkContext._jvm
        for kind, numbers in there.items():
            for n in numbers:
                if n < oldest or kind == "delta" and n == oldest:
                    gone = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}={n}")
                    gone.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)

    def start(self, updates: DataFrame, checkpoint: str | None = None, **trigger):
        """Start the query that upserts ``updates`` (a stream); its checkpoint lies beside the table."""
        from .queries import checkpoint_beside
        return (updates.writeStream.outputMode("update").foreachBatch(self.write_batch)
                .option("checkpointLocation", checkpoint or checkpoint_beside(self.path))
                .trigger(**(trigger or {"availableNow": True})).start())
