"""Session helpers and the shared scratch area that cuts lineage.

Iterative operators write their state as Parquet tables below the folder that the session
names in ``spark.checkpoint.dir``. A written table survives the loss of executors, is computed
once, and gives the next plan exact sizes.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("crateloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers once per context, wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_crateloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="crateloom-ship-")
    archive = shutil.make_archive(f"{folder}/crateloom_package", "zip", root.parent, root.name)
    context.addPyFile(archive)
    context._crateloom_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for a local master without any."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="crateloom-"))
    return context.getCheckpointDir().rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit
        pass


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """Even partitions for a stage whose work per byte is high; AQE would merge them by bytes."""
    return df.repartition(parallelism(df.sparkSession))


def spread_scan(df: DataFrame) -> DataFrame:
    """``spread`` for a plain file scan, only where it has fewer splits than the cluster has cores."""
    few = df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism
    return spread(df) if few else df


def materialize(df: DataFrame, even: bool = False, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the scratch area and read it back, without its lineage; ``by`` partitions the files."""
    spark = df.sparkSession
    df = spread(df) if even else df
    path = f"{scratch_root(spark)}/crateloom-{uuid.uuid4().hex}"
    (df.hint("rebalance", *by).write.partitionBy(*by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    atexit.register(_delete, spark, path)
    return out


def materialize_observed(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """``materialize`` with aggregates of the rows that the same job takes while it writes them."""
    seen = Observation()
    return materialize(df.observe(seen, *[c.alias(n) for n, c in measures.items()])), seen.get


def release(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that no later plan reads."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            _delete(df.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
