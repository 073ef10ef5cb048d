"""Session helpers: the shared folder for checkpoints and the size limit of one task's group."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Largest group (rows of one feature, stratum or class) that an operator hands to a single task.
# Larger groups take the path that splits them.
MAX_GROUP_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting it is a folder below ``spark.sql.warehouse.dir``, which a cluster shares as well.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a table that is written and read back."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: for rows that are read again and again, column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written to ``path``, a folder made by ``scratch_path``, wherever Spark keeps it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context, wherever they were started."""
    context = spark.sparkContext
    if getattr(context, "_tabscope_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tabscope-")  # read by this driver only, which serves the file to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "tabscope.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._tabscope_shipped = True
