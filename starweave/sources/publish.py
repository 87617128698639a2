"""Small files that appear whole or not at all: the commit step of protocols between jobs."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def publish(spark: SparkSession, path: str, text: str, millis: int | None = None) -> bool:
    """Write ``text`` to ``path`` by one rename; a file that is there already stays, and False says so.

    Until the rename the text lies in a hidden file beside it, which no Spark reader lists. ``millis`` sets the
    file's time, by which a file stream orders what it finds.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target):
        return False
    draft = hadoop.Path(target.getParent(), f"._{target.getName()}.{uuid.uuid4().hex}")
    out = system.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if millis is not None:
        system.setTimes(draft, millis, -1)
    if system.rename(draft, target):
        return True
    system.delete(draft, False)
    if not system.exists(target):
        raise OSError(f"cannot publish {path}")
    return False


def published(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name → text of the files that were published into ``folder``; none if there is no such folder."""
    try:
        files = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
        return {r["name"]: r["value"] for r in files.collect()}  # manifests: one small file per plan
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return {}
