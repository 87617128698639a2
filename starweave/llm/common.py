"""What the operators share: kept tables, document identity, and ranks without a global sort."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.session import scratch_path

#: Bytes of an Arrow batch that a Python worker gets of texts, see ``small_batches``.
BATCH_BYTES = 4 << 20
#: The words of a text: runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session hold ``BATCH_BYTES`` at most, or one row that is larger.

    Rows are else counted only up to a size that is many times larger, and every task has a batch of texts up to four times: in
    Spark's buffers and the worker's, on the way there and back, all of it outside the heap. The value counts when a plan runs, so
    it is not set back; a smaller one stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < _bytes(spark, name) <= BATCH_BYTES:  # below 1: no limit
        spark.conf.set(name, str(BATCH_BYTES))


def _bytes(spark: SparkSession, name: str) -> int:
    """A setting in bytes, which may be spelled with a unit."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", spark.conf.get(name).strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index((unit or "b")[0])


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; pure ASCII texts take the vectorised way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, although ``body`` uses it within loops."""
    return F.transform(F.array(value), body)[0]


def ranked(df: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
    """``df`` with the position of each row in the order of ``keys``, from 0.

    Rows are range-partitioned and sorted where they lie; the start of each partition is a
    prefix sum over one count per partition. The result is a kept table, so positions stay
    the same when tasks are run again.
    """
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = keep(placed.withColumn("_at", F.monotonically_increasing_id()), into)
    part = F.shiftright("_at", 33)
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("_part")).agg(F.count("*")).collect())
    starts, total = [], 0
    for number, rows in counts:  # one row per partition
        starts.append((number, total))
        total += rows
    starts = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(into, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_at", "_start")
    )


def identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: Sequence[str] = ()
) -> DataFrame:
    """``docs`` as (rid, doc_id, text, *more): ``rid`` is unique and ascends with ``doc_id``.

    Where ids are unique and not null, ``rid`` is the id. Otherwise every row is a document
    of its own, in the order of id (null first) and text digest.
    """
    own = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    docs = docs.select(*own, *more)
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    top = counts.agg(F.max("n"), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    if (top[0] or 1) == 1 and not top[1]:
        return docs.select(F.col("doc_id").alias("rid"), "doc_id", "text", *more)
    digested = docs.withColumn("_digest", F.md5("text"))
    return ranked(digested, ["doc_id", "_digest"], "rid").select("rid", "doc_id", "text", *more)


def file_system(uri: str):
    """The pyarrow file system of a folder, and the folder's path in it; for use in tasks."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    if isinstance(system, fs.LocalFileSystem):
        system = fs.LocalFileSystem(use_mmap=True)
    return system, path
