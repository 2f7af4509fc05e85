"""Sessions, and tables that end a plan's lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def session(name: str = "tidemark", master: str | None = None) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; the master is the caller's or the cluster's."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    return (builder.master(master) if master else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, in the cluster's default file system if it names none.

    Only a session on one machine, as in tests, may have none and gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        folder = _OWN[0]
    if ":" in folder:
        return folder
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.FileSystem.get(spark._jsc.hadoopConfiguration()).makeQualified(hadoop.Path(folder)).toString()


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """The rows as a written table in the shared folder, so later plans start from it and lost executors cost nothing."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
