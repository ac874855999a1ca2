"""Session set-up and the shared folder for data that must outlive a stage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_local_root: str | None = None


def local_session(cores: int | str = 8, app_name: str = "streamlog") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a folder that
    is removed when Python exits.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="streamlog-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/streamlog/{app}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that a store no longer needs; nothing happens if it isn't there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place) if f.isDirectory()]


def drop_named(spark: SparkSession, name: str) -> None:
    """Remove all scratch tables of this name."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/streamlog/{spark.sparkContext.applicationId}")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, f"{name}-*")) or []:
        files.delete(found.getPath(), True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote under the shared folder; call it when it is done."""
    remove(spark, f"{shared_root(spark)}/streamlog/{spark.sparkContext.applicationId}")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet") -> DataFrame:
    """A stored table; without rows if its folder isn't there."""
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, keeps column pruning for later passes, and gives the
    planner the true size of the table, which is what decides on a broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
