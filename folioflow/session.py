"""Session settings and table reading shared by queries, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = 8, shuffle_partitions: int = 8, app: str = "folioflow") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session is given from outside."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of this process below the shared one.
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; in local mode one of the session's own."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    system = spark.sparkContext._jvm.System
    found = system.getProperty("folioflow.shared") or "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    system.setProperty("folioflow.shared", found)
    return found


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one. It stays until ``release_scratch``, since results are read from it."""
    _made.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def release_scratch(spark: SparkSession) -> None:
    """Deletes the folders that this process made; call it once their frames have been written or collected."""
    while _made:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
