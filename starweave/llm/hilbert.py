"""Sharding along a Hilbert curve: shards are runs of the curve through quantised metadata.

Language, source and size are cut into ``2 ** BITS`` quantile cells each; the cell of a document is a
point, and its index on the Hilbert curve the first sort key. Neighbours on the curve are
neighbours in every dimension, so a run of it, a shard, spans a small box and a filter on
any of the dimensions skips most shards. Names are cut by their whole values, also where they begin alike. The law is ``rows``: counts of shards are at most one apart.

Positions come from a range partitioning and prefix sums (``common.ranked``), so ties, such as a source that
holds a third of all rows, are cut like any others.

Defined results: null metadata sorts before all else; a null text has no bytes and the checksum of
an empty one. Rows that repeat an id, or are equal, are placed each. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, ranked

BITS = 6
SHARDS = 40
OVERHEAD = 16


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def name_cuts(meta: DataFrame, name: str, bits: int = BITS) -> list[str | None]:
    """The values of a string column in which a ``2 ** bits``-th part of its rows ends, null first.

    Distinct values with their counts are range-partitioned and summed up where they lie; the start of each
    partition is a prefix sum over one total per partition.
    """
    counts = meta.groupBy(name).agg(F.count("*").alias("_n"))
    placed = counts.repartitionByRange(name).sortWithinPartitions(name)
    placed = keep(placed.withColumn("_part", F.spark_partition_id()), "names")
    starts, rows = [], 0
    for part, n in sorted(tuple(r) for r in placed.groupBy("_part").agg(F.sum("_n")).collect()):  # one row per partition
        starts.append((part, rows))
        rows += n
    starts = meta.sparkSession.createDataFrame(starts, "_part int, _start long")
    own = F.sum("_n").over(Window.partitionBy("_part").orderBy(name))
    ends = placed.withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn("_end", F.col("_start") + F.col("_own"))
    cells = 1 << bits
    cut = F.expr(f"least({cells - 1}, _end * {cells} div {max(rows, 1)}L) > (_end - _n) * {cells} div {max(rows, 1)}L")
    # at most one row per cell
    return sorted((r[0] for r in ends.where(cut).select(name).collect()), key=lambda v: (v is not None, v or ""))


def name_cell(name: str, cuts: list[str | None]) -> Column:
    """How many of the cuts are not above the value of ``name``."""
    known = [F.lit(c) for c in cuts if c is not None]
    below = F.size(F.filter(F.array(*known), lambda c: c <= F.col(name))) if known else F.lit(0)
    return (below + len(cuts) - len(known)).cast("long")


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of points (one per column of ``cells``, dimensions by row).

    The axes are turned into the transposed index by Gray-code steps from the top bit down,
    as in Skilling, "Programming the Hilbert curve" (2004).
    """
    x = cells.astype(np.int64).copy()
    dims = len(x)
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:
        low = bit - 1
        for d in range(dims):
            flip = (x[d] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] ^= swap
        bit >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    fix, bit = np.zeros_like(x[0]), top
    while bit > 1:
        fix = np.where((x[-1] & bit) != 0, fix ^ (bit - 1), fix)
        bit >>= 1
    x ^= fix
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[d] >> b) & 1)
    return index


def with_curve(meta: DataFrame, names: list[str], dims: list[str], bits: int = BITS, into: str = "curve") -> DataFrame:
    """``meta`` with the curve index of its string columns ``names`` and numeric columns ``dims``, cut at their quantiles."""
    grid = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = meta.agg(*(F.percentile_approx(d, F.lit(grid).cast("array<double>"), F.lit(10_000)) for d in dims)).first()
    bounds = [None] * len(names) + [np.unique(np.array(c or [], np.int64)) for c in cuts]

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        cells = [c.to_numpy() if b is None else np.searchsorted(b, c.to_numpy(), "right") for b, c in zip(bounds, columns)]
        return pd.Series(curve_index(np.array(cells), bits))

    return meta.withColumn(into, index(*(name_cell(n, name_cuts(meta, n, bits)) for n in names), *dims))


def shards(docs: DataFrame, count: int = SHARDS) -> DataFrame:
    """(doc_id, lang, source, size, text_crc32, curve, shard, slot) for ``docs`` (doc_id, text, lang, source)."""
    meta = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_crc32"),
    )
    meta = keep(meta, "meta")
    placed = with_curve(meta, ["lang", "source"], ["size"])
    keys = ["curve", "lang", "source", "size", "text_crc32", "doc_id"]
    placed = ranked(placed, keys, "_position")
    rows = meta.count()
    # shard k has the positions from k * rows div count on; an empty table has no position
    placed = placed.withColumn("shard", F.expr(f"CAST(((_position + 1) * {count} - 1) div {max(rows, 1)}L AS INT)"))
    start = F.expr(f"shard * {rows}L div {count}")
    return placed.withColumn("slot", (F.col("_position") - start).cast("long")).select(
        "doc_id", "lang", "source", "size", "text_crc32", "curve", "shard", "slot"
    )


def spans(placed: DataFrame) -> DataFrame:
    """The box of each shard: what a reader needs to skip shards by language, source or size."""
    edge = [f(c).alias(f"{n}_{c}") for c in ("lang", "source", "size") for n, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), *edge)
