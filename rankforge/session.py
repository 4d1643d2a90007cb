"""Session construction and shared-storage helpers.

Intermediate tables (fold checkpoints, score files, lineage cuts) are written
under the folder the cluster names in ``spark.checkpoint.dir``.  We read that
setting from the running session and only invent a local folder when the
session is a ``local[...]`` one with no checkpoint dir (tests, the driver's
single-node runs).  On a cluster without a checkpoint dir we refuse to fall
back to a machine-local temp folder.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


#: Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 8 << 20


def get_session(cores: int | str = "*", shuffle_partitions: int = 8,
                app: str = "rankforge", driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the bench; cluster jobs bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (set for local sessions only)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder "
            "(HDFS/S3/ABFS) for checkpoints and intermediate tables")
    local = tempfile.mkdtemp(prefix="rankforge-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/rankforge/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet to a fresh path of the shared folder and read
    back: cuts the lineage as a checkpoint does, but computes the rows once."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replaced(df: DataFrame, name: str, before: str | None = None) -> tuple[DataFrame, str]:
    """As ``stored``, with its path; the table at ``before``, which only ``df`` still reads, is deleted after it."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if before:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(df.schema).parquet(path), path


def together(spark: SparkSession, work: list[Callable], most: int = 4) -> list:
    """Results of ``work``, ``most`` at a time: their jobs run side by side, so that short stages of one fill the gaps of another."""
    with ThreadPoolExecutor(max_workers=most) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(w)) for w in work]]


def default_buckets(spark: SparkSession, floor: int = 64, cap: int = 16384) -> int:
    """Number of range buckets for distributed ranks: ~4 per shuffle partition.

    ``floor`` and ``cap`` bound the offsets table (strata x buckets rows, which
    is broadcast); beyond the cap a bucket's sort grows with the data and spills.
    They choose the plan, never the rows.
    """
    try:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present in practice
        parts = 200
    return max(floor, min(cap, 4 * parts))


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors, once per session: functions that
    run there are found by import, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_rankforge_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="rankforge-code-")) / "rankforge_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    sc.addPyFile(str(target))
    sc._rankforge_shipped = True


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package.

    Asks the session for Arrow batches of at most ``BATCH_BYTES``: a batch is held by
    the JVM and by the Python worker of every running task, several times over
    while it grows.
    """
    spark = df.sparkSession
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df.mapInArrow(run, schema)
