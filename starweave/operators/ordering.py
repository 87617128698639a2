"""Positions within groups of any size, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    files: Sequence[str],
    row: str,
    into: str,
    total: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the rows of each group from 0, by ``files`` columns and then ``row``.

    A file is cut into blocks of ``block_rows`` row positions; rows are numbered inside
    their block, and a running sum over block counts gives each block its start. No
    window ever holds more than a block of rows or the block counts of one group.
    """
    group, files = list(group), list(files)
    key = [*group, *files, "_block"]
    # never NULL: else the join below pushes "is not null" down to the scan, with all that ``row`` is made of
    block = F.coalesce(F.floor(F.col(row) / block_rows).cast("long"), F.lit(-1))
    blocked = df.withColumn("_block", block)
    counts = blocked.groupBy(*key).agg(F.count("*").alias("_n"))
    in_group = Window.partitionBy(*group) if group else Window.partitionBy()
    before = in_group.orderBy(*files, "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = {"_start": F.coalesce(F.sum("_n").over(before), F.lit(0))}
    if total:
        starts[total] = F.sum("_n").over(in_group)
    counts = counts.withColumns(starts).drop("_n")
    in_block = F.row_number().over(Window.partitionBy(*key).orderBy(row)) - 1
    return (
        blocked.withColumn("_at", in_block)
        .join(counts, key)
        .withColumn(into, (F.col("_start") + F.col("_at")).cast("long"))
        .drop("_block", "_at", "_start")
    )
