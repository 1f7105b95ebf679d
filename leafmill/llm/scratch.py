"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session (or of its context); a temporary folder only for a local master (tests).

    The local folder is kept here rather than set on the session, whose configuration may refuse the key.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="leafmill-")
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the session's JVM ends."""
    text = f"{shared_folder(spark)}/leafmill-{uuid.uuid4().hex}-{name}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(text)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return text


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once and read them back, so that later steps start from files that outlive executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
