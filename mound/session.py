"""Session helpers.

Library code never creates its own session: it takes the one it is
given.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: dict[str, list[str]] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("mound")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset (local tests) a scratch folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
            "(written tables and checkpoints must survive the loss of an executor)")
    path = tempfile.mkdtemp(prefix="mound-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder.

    Only a name is made up here; Spark's writers create the folder in
    whatever file system the checkpoint folder lives in.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if spark.sparkContext.master.startswith("local[") and base.startswith("file:/") and not base.startswith("file://"):
        base = base[len("file:"):]  # one machine: a plain path
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = _hadoop_path(spark, path)
    return system.exists(target)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    target, system = _hadoop_path(spark, path)
    return system.getContentSummary(target).getLength()


def broadcast_bytes(spark: SparkSession) -> int:
    """The bound below which Spark broadcasts a join's side; -1 where it never does."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def release_scratch(spark: SparkSession) -> int:
    """Delete every folder that ``scratch_path`` has named in this application.

    Call it when no result that reads a written intermediate is needed any
    more.  Returns the number of folders named.
    """
    sc = spark.sparkContext
    paths = _SCRATCH.pop(sc.applicationId, [])
    for path in paths:
        target, system = _hadoop_path(spark, path)
        system.delete(target, True)
    return len(paths)


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back.

    Used where one intermediate table feeds several branches of a plan:
    Catalyst prunes each branch differently, so it would otherwise recompute
    (re-scan) the intermediate once per branch.  The written table is read
    with column pruning, cuts the lineage (a lost executor does not trigger a
    re-scan of the source) and costs a single job.  Unlike
    ``Dataset.checkpoint`` it does not compute the input twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
