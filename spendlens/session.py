"""SparkSession helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for a local/test session. On a cluster the launcher's own settings win:
# ``get_spark`` only fills keys that are not set yet.
_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "12g",
    # Plan strings (built for every execution) of nested cached feature plans can reach
    # gigabytes; keep them bounded.
    "spark.sql.maxPlanStringLength": "50000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "spendlens", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("SPENDLENS_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    share_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


PLAN_STRING_LIMIT = "50000"


def bound_plan_strings(spark: SparkSession) -> None:
    """Cap plan-string length when the session still has Spark's (unbounded) default."""
    current = spark.conf.get("spark.sql.maxPlanStringLength", None)
    try:
        unbounded = current is None or int(str(current).rstrip("bB") or 0) > 100_000_000
    except ValueError:
        unbounded = False
    if unbounded:
        spark.conf.set("spark.sql.maxPlanStringLength", PLAN_STRING_LIMIT)


BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` in this session, so that a Python worker's
    memory does not follow the length of the texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.isdigit() or int(now) > BATCH_BYTES:  # a unit stands for something larger
        spark.conf.set(key, str(BATCH_BYTES))


READ_ROWS = 256


def bounded_reads(spark: SparkSession) -> None:
    """Parquet is read at most ``READ_ROWS`` rows at a time in this session: a row of a term
    store is some 50 KB, and a reader holds all rows it reads at once."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    if int(spark.conf.get(key)) > READ_ROWS:
        spark.conf.set(key, str(READ_ROWS))


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package where it is on a shared or local disk (a cluster
    without one gets it with ``--py-files``)."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        env["PYTHONPATH"] = os.pathsep.join([here, *paths])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can reach; it is
    read from the session and used as is. Only when it is unset (local tests) a scratch
    folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="spendlens-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of fitted state by a reliable checkpoint (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: a lineage cut whose files
    survive lost executors."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a folder that others may append to at the same time: a file enters it when its
    task ends, and the folder of files under way, which all writers share, is left standing."""
    (df.write.mode("append")
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .option("mapreduce.fileoutputcommitter.cleanup.skipped", "true")
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path))
