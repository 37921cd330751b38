"""Session building, table access and the folder for materialised steps."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(cpus: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators expect; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quire")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, however the driver came to import it."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, have]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; columns are pruned by whatever selects from it."""
    importable(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether a data folder has the table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. On one machine without that setting it is a folder of our own, which goes with
    the process; on a cluster without it there is none, and that is an error."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="quire-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = "file://" + own
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: a step that several branches use is computed once, and outlives a lost executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession) -> int:
    """Tasks that Python-heavy work is spread over: three waves of the cores known to the session."""
    importable(spark)
    return max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Rows up to which a side that is already computed may be broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 20_000


def hinted(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it has at most so many rows. df must be cheap to count (a step already cut)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
