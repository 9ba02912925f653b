"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage in iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cadence") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CADENCE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def one_thread_a_task(spark: SparkSession) -> None:
    """Matrix products in Python workers that are started from now on use one thread: an
    executor runs a task on every core, and the threads of all of them wait for each other."""
    for name in ("OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS", "OMP_NUM_THREADS"):
        spark.sparkContext.environment.setdefault(name, "1")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    is always used when present. Only when nothing is set and the master is
    local is a scratch folder created; on a cluster that is an error. Every query
    calls this first, so the threads of its tasks are limited here, too.
    """
    one_thread_a_task(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="cadence-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


_STATIC, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
_KEPT = "spark.cadence.broadcast"  # the session's own settings


def measured_broadcasts(spark: SparkSession, on: bool = True) -> None:
    """Whether a join sends a side through the driver only if the rows themselves, as
    counted by their shuffle, are within the session's limit. A plan's estimate comes from
    the sizes of compressed files and misses by a multiple of what is exploded, repeated or
    decoded from them. ``on=False`` gives the session its own settings back."""
    kept = spark.conf.get(_KEPT, None)
    if on and kept is None:
        limit, measured = spark.conf.get(_STATIC), spark.conf.get(_MEASURED, None)
        spark.conf.set(_KEPT, f"{limit} {measured or ''}")
        spark.conf.set(_MEASURED, measured or limit)
        spark.conf.set(_STATIC, "-1")
    elif not on and kept is not None:
        limit, _, measured = kept.partition(" ")
        spark.conf.set(_STATIC, limit)
        if measured:
            spark.conf.set(_MEASURED, measured)
        else:
            spark.conf.unset(_MEASURED)
        spark.conf.unset(_KEPT)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable, survives
    executor loss) and return a DataFrame reading it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``cut_lineage``, in compressed columns: for frames as large as an input."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
