"""Equi-joins that stay balanced when one key holds a large share of the rows.

AQE splits oversized join partitions too, but only for some join shapes and only by
bytes; where a join fans out, the rows are spread here by key and row identity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# A key is hot above this many rows, whatever the size of the table.
HOT_ROWS = 100_000
# Hot keys up to this number are held on the driver and broadcast.
FEW_KEYS = 10_000
# A side of a join up to this many narrow rows (ids and cells) is broadcast.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class HotKeys:
    """The keys to spread with their rows, ``_rows``; a part holds ``limit`` of them."""

    table: DataFrame
    limit: int
    few: bool

    def only(self, column: str, value: str) -> HotKeys:
        """The keys with this value in a column, which they are left without."""
        return HotKeys(self.table.where(F.col(column) == value).drop(column), self.limit, self.few)


def hot_keys(df: DataFrame, on: Sequence[str], limit: int = HOT_ROWS) -> HotKeys | None:
    """Find the hot keys of ``df``: one job, one aggregate with map-side combining."""
    hot = df.groupBy(*on).agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit)
    rows = hot.limit(FEW_KEYS + 1).collect()
    if not rows:
        return None
    if len(rows) <= FEW_KEYS:
        return HotKeys(df.sparkSession.createDataFrame(rows, hot.schema), limit, True)
    return HotKeys(cut_lineage(hot), limit, False)


def few_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has ``limit`` rows at most; counting stops soon behind it."""
    return df.select(F.lit(1)).limit(limit + 1).count() <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a narrow side of a checked size."""
    return F.broadcast(df) if few_rows(df, limit) else df


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    *,
    salt_by: Sequence[str | Column],
    hot: HotKeys | None,
) -> DataFrame:
    """``left ⋈ right`` where rows of a hot left key go to many tasks.

    ``salt_by`` must tell equal-key rows of the left side apart and be a plain function
    of the row, so that a re-run task sends every row to the same place. The right side
    of a hot key is repeated once per part; ``how`` may be inner or any left join.
    """
    on = list(on)
    if hot is None:
        return left.join(right, on, how)
    names = [f"_hot_{name}" for name in on]
    parts = F.ceil(F.col("_rows") / hot.limit).cast("int").alias("_parts")
    table = hot.table.select(*[F.col(c).alias(n) for c, n in zip(on, names)], parts)

    def with_parts(df: DataFrame) -> DataFrame:
        same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(on, names)]
        return df.join(F.broadcast(table) if hot.few else table, same, "left").drop(*names)

    spread = (
        with_parts(left)
        .withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.coalesce("_parts", F.lit(1))).cast("int"))
        .drop("_parts")
    )
    repeated = (
        with_parts(right)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_parts")
    )
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def repeat_rows(df: DataFrame, copies: str, chunk: int = 10_000) -> DataFrame:
    """Emit every row ``copies`` times, dropping that column.

    Large counts are cut into chunks that are spread over the cluster before the
    chunks are unrolled, so no single task writes all copies of one row.
    """
    chunks = F.ceil(F.col(copies) / chunk).cast("long")
    cut = df.withColumn("_chunk", F.explode(F.sequence(F.lit(1).cast("long"), chunks)))
    cut = cut.repartition(F.xxhash64(*cut.columns))
    size = F.least(F.lit(chunk).cast("long"), F.col(copies) - (F.col("_chunk") - 1) * chunk)
    return cut.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop(
        "_chunk", "_copy", copies
    )
