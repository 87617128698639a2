"""Order, split, permutation and dealing of partitions.

A cell table has one row per catalog file, so it is metadata: the driver that lists the
files can hold it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.healpix import split_of_cell

VAL_PARTITIONS = 8  # fixed value: cells reserved for validation by position
SPLITS = ("train", "val")
BROADCAST_CELLS = 100_000


def check_split(split: str) -> str:
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, got {split!r}")
    return split


def hash_split(cells: DataFrame, split: str) -> DataFrame:
    """Cells whose order-4 ancestor hashes into the split."""
    kept = split_of_cell(F.col("norder").cast("int"), F.col("npix")) == check_split(split)
    return cells.where(kept)


def reserved(count: int, reserve: int = VAL_PARTITIONS) -> int:
    """How many of ``count`` cells validation gets."""
    return min(reserve, max(1, count // 5)) if reserve else 0


def positional_split(cells: DataFrame, split: str, reserve: int = VAL_PARTITIONS) -> DataFrame:
    """The first cells in (order, pixel) order are validation, at most a fifth of them."""
    check_split(split)
    if not reserve:
        return cells
    first = cells.orderBy("norder", "npix").limit(reserved(cells.count(), reserve))
    if split == "val":
        return first
    return cells.join(first.select("norder", "npix"), ["norder", "npix"], "left_anti")


def permutation(count: int, seed: int, epoch: int) -> list[int]:
    """Which cell stands at each place of the epoch."""
    return np.random.default_rng([seed, epoch]).permutation(count).tolist()


def permute_cells(cells: DataFrame, seed: int, epoch: int) -> DataFrame:
    """Add ``cell_rank``: the cell's place in this epoch's order."""
    rows = cells.select("norder", "npix").orderBy("norder", "npix").collect()
    ranked = [(*rows[at], rank) for rank, at in enumerate(permutation(len(rows), seed, epoch))]
    ranks = cells.sparkSession.createDataFrame(ranked, "norder tinyint, npix bigint, cell_rank int")
    return cells.join(small(ranks, len(ranked)), ["norder", "npix"])


def deal_cells(cells: DataFrame, shard: int, num_shards: int) -> DataFrame:
    """Round-robin share of one rank; ranks differ by one cell at most, none is dropped."""
    if num_shards <= 1:
        return cells
    return cells.where(F.col("cell_rank") % num_shards == shard)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a cell table whose row count is known to be small."""
    return F.broadcast(df) if rows <= BROADCAST_CELLS else df
