"""Session set-up and the shared folder used for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tierline", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own session in."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tierline-warehouse-"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tierline-shared-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application so it can be expired as one."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tierline/{application}/{label}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    files, target = _files(spark, path)
    if files.exists(target) and not files.delete(target, True):
        raise OSError(f"could not delete {path}")


def rename(spark: SparkSession, path: str, name: str) -> None:
    """Give a file or folder another name in the same file system."""
    files, source = _files(spark, path)
    if not files.rename(source, _files(spark, name)[1]):
        raise OSError(f"could not rename {path}")


def move_files(spark: SparkSession, path: str, folder: str) -> None:
    """Move the data files of one folder, where it is still there, into another."""
    files, source = _files(spark, path)
    for status in files.listStatus(source) if files.exists(source) else []:
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            rename(spark, f"{path}/{name}", f"{folder}/{name}")


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and keeps the copy columnar so that later
    passes read only the columns they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
