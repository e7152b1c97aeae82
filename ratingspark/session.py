"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC for epoch -> date, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast
# conversion from measured sizes).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE coalesce / split the shuffle output of persisted plans too
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ratingspark", extra: dict | None = None) -> SparkSession:
    # Only an explicit master is set here: under spark-submit the cluster
    # master comes from the submit arguments (a master set in code would
    # override it), and a plain `python` launch defaults to local[*].
    master = master or os.environ.get("SPARK_MASTER")
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if os.environ.get("SPARK_DRIVER_MEMORY"):
        conf["spark.driver.memory"] = os.environ["SPARK_DRIVER_MEMORY"]
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_settings(spark)
    return spark


def apply_session_settings(spark: SparkSession) -> None:
    """Pin the runtime settings the operators' semantics depend on."""
    workers_find_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.
    That reaches workers that share the driver's files (local mode); on a
    cluster the package is shipped with --py-files or installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by whoever runs the job (a shared
    file system); only a local-mode session without one gets a fresh
    scratch folder, as tests do.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
        d = tempfile.mkdtemp(prefix="ratingspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df, how: str = "table"):
    """Materialize ``df`` in the shared checkpoint folder and return a frame
    that reads it back, so later plans start from a scan.

    ``how='table'`` (default) writes parquet (zstd: titles and genres shrink
    most): one job, and later reads get column pruning and filter pushdown. ``how='checkpoint'`` uses Spark's
    reliable RDD checkpoint (the frame is persisted first so the checkpoint
    write does not recompute it). A local checkpoint is never used: the data
    must survive the loss of the executor that computed it.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    if how == "checkpoint":
        from pyspark import StorageLevel
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        out = df.checkpoint(eager=True)
        df.unpersist()
        return out
    path = f"{base}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


class ScratchTables:
    """Tables in the shared checkpoint folder whose owner drops them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/scratch/{uuid.uuid4().hex}"
        self.made: list[str] = []   # paths, in the order they were written
        self.count = 0

    def write(self, df):
        """``df`` written and read back."""
        self.count += 1
        path = f"{self.base}/t{self.count}"
        df.write.parquet(path)
        self.made.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, paths: list[str]) -> None:
        """Delete tables that nothing will read again."""
        jvm = self.spark._jvm
        for path in list(paths):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
            self.made.remove(path)
