"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tripfunnel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects.

    ``spark.sql.shuffle.partitions`` is left to the caller (cluster size
    decides it); AQE then coalesces small partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # A busy user's session rows are merged in every task before they are shuffled.
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp in the library is read and rendered in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _checkpoint_root(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below the cluster's shared checkpoint folder.

    Only a local master without ``spark.checkpoint.dir`` falls back to a
    temporary folder: on a cluster that would be invisible to the executors.
    """
    root = _checkpoint_root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tripfunnel-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in its terms: whatever store Spark itself reads from."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none if it is not there."""
    files, where = _file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where) if f.isDirectory()] if files.exists(where) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of the library's own with all it has."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.mkdirs(where)


def has_file(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def file_count(spark: SparkSession, path: str) -> int:
    """Number of files directly below ``path``."""
    files, where = _file_system(spark, path)
    return sum(f.isFile() for f in files.listStatus(where))
