"""Session helpers: one place that builds a SparkSession and finds the
shared checkpoint folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared filesystem path set by whoever runs the job).  Only when nothing is
configured -- local tests, the bench -- do we pick a scratch folder.
"""
from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "cohort_spark") -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes."""
    from pyspark import SparkConf
    # a submit names its own master; local threads only where nothing does
    master = master or os.environ.get("COHORT_SPARK_MASTER") or SparkConf().get("spark.master", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    # on a cluster the submit sizes shuffles and the driver
    local = master.startswith("local")
    if partitions or "COHORT_SPARK_PARTITIONS" in os.environ or local:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions or os.environ.get("COHORT_SPARK_PARTITIONS", "8")))
    if local:
        builder = builder.config("spark.driver.memory", os.environ.get("COHORT_SPARK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a scratch one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins.  The scratch fallback exists for local runs and tests only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share: "
                           f"on {sc.master} a machine-local folder would lose data")
    path = tempfile.mkdtemp(prefix="cohort-spark-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Used before iterative work (model folds, repeated scans of one derived
    table) so a lost executor recomputes from the checkpoint, not the source.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str, default: str):
    before = spark.conf.get(name, default)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_cleaned(spark: SparkSession):
    """Within it, a query's shuffle files go when the query is done: right for queries whose result
    is written and read back, as nothing computes from their shuffles again."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")


def small_methods(spark: SparkSession):
    """Within it, a stage whose generated method is beyond 8000 bytes of bytecode (the JVM never
    compiles those) runs as split projections, which it does compile: right for wide rows."""
    return _setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000", "65535")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:8]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared filesystem that nothing reads any more."""
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: lineage is cut (a lost executor re-reads the table) and later
    jobs keep Parquet column pruning and filter pushdown."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with shuffles_cleaned(spark), small_methods(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
