"""Session helpers shared by queries, benchmarks and the command line."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder all nodes see: the one ``spark.checkpoint.dir`` names.

    Where it is unset, a scratch folder serves a local master only; on a cluster
    other nodes could not read it, so that is an error.
    """
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError(f"set spark.checkpoint.dir to a folder all nodes of {master} share")
    made = tempfile.mkdtemp(prefix="corpusloom-shared-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, so that lost executors never force a rebuild."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder and read again: neither a lost executor nor a second use makes them anew."""
    folder = f"{shared_folder(rows.sparkSession)}/{name}-{uuid4().hex}"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def small_batches(spark: SparkSession, rows: int = 1_024) -> None:
    """From now on the session's Arrow batches have at most ``rows`` rows, fewer where it asks for fewer.

    Spark's own 10,000 whole texts are held by the executor, outside its heap, and by the
    Python worker at the same time. Results are the same, whatever the size.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def hold_splits(spark: SparkSession) -> Callable[[], None]:
    """From now on the session cuts files as for the cores it has now; gives what ends that, if it was not so before.

    Spark cuts the files of a scan by the cores it has when the scan starts, which
    executors that come or go change. What a pass tells of splits is of use to a later
    pass only if that meets the same splits.
    """
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is not None:
        return lambda: None
    spark.conf.set(name, spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism)
    return lambda: spark.conf.unset(name)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core before CPU-heavy work.

    A large input already has more partitions than cores and passes through
    untouched; only a small one (one file, one row group) is redistributed. For
    plans without a shuffle only: counting partitions would run a shuffle's stages.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
