"""Which anchor cell emits the unmatched rows of a partner partition: exactly one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.healpix import crc_bucket, split_of_cell
from ..session import cut_lineage

PARTNER = ["source", "partner_norder", "partner_npix"]


def references(partner_cells: DataFrame, listings: DataFrame) -> DataFrame:
    """(anchor cell, partner partition, path); every partition must have a file.

    ``listings``: source, partner_norder, partner_npix, path.
    """
    refs = cut_lineage(partner_cells.join(listings, PARTNER, "left"))
    missing = refs.where(F.col("path").isNull()).orderBy(*PARTNER).first()
    if missing is not None:
        cell = (missing["partner_norder"], missing["partner_npix"])
        raise ValueError(f"index references missing {missing['source']} partition {cell}")
    return refs


def elect_owners(candidates: DataFrame) -> DataFrame:
    """Among the sorted cells that reference a partition, the one its path hashes to.

    A window, not a collected list: one partition may be referenced by any number of cells.
    """
    by_path = Window.partitionBy(*PARTNER, "path")
    place = F.row_number().over(by_path.orderBy("norder", "npix")) - 1
    count = F.count("*").over(by_path)
    return (
        candidates.withColumns({"_place": place, "_count": count})
        .where(F.col("_place") == crc_bucket(F.col("path"), F.col("_count")))
        .drop("_place", "_count")
    )


def graph_owners(refs: DataFrame, split: str, eligible: list[str]) -> DataFrame:
    """Owners of one split: partition and anchor cell must both lie in it."""

    def inside(order: str, pixel: str):
        return split_of_cell(F.col(order).cast("int"), F.col(pixel)) == split

    return elect_owners(
        refs.where(F.col("source").isin(eligible))
        .where(inside("partner_norder", "partner_npix"))
        .where(inside("norder", "npix"))
    )


def pair_owners(refs: DataFrame) -> DataFrame:
    """Owners over all cells, whatever the split."""
    return elect_owners(refs)
