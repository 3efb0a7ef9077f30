"""Session settings and the shared scratch folder.

Everything that has to outlive a stage (fitted parameter tables, landed files,
stream checkpoints) goes to the folder that ``spark.checkpoint.dir`` names, so
a lost executor never takes state with it.
"""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the library is written for; callers may override any of them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "wattmill", master: str | None = None, **overrides: str) -> SparkSession:
    """A session with :data:`DEFAULTS`; ``overrides`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in overrides.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may do
    without: there a folder below the warehouse serves until the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
        folder = f"{warehouse}/scratch-{uuid.uuid4().hex}"
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        current = context.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root` for one written table."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and cut its lineage."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as one parquet table in the shared folder and read it back.

    Unlike :func:`pin` the result stays columnar, so later scans prune columns
    and push filters down. Used where several passes follow over large data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove one written table once its last reader is done."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A plain scan with fewer splits than cores, dealt out to all of them.

    A file with a single row group is a single split and would keep everything
    that follows on one core. Larger inputs have splits enough and are left as they are.
    Where each row costs much, ``rows`` bounds how many of them a split holds, so the longest task does not grow with the input.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        wanted = max(wanted, -(-df.count() // rows))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
