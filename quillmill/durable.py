"""Written tables that cut lineage and survive the loss of executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets a scratch folder. On a cluster a
    machine-local folder would be lost with its machine, so the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="quillmill-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the checkpoint folder.

    That part is deleted when the application ends.
    """
    context = spark.sparkContext
    root = f"{checkpoint_folder(spark)}/quillmill/{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the checkpoint folder and read it back.

    Values that depend on how rows were laid out (partition ids, scan positions) are
    fixed by the write: a lost executor cannot make a later pass see other values.
    Reading Parquet back also lets each later pass read only the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
