"""Which anchor partition meets which partner partition; cells may be of different order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.healpix import ancestor


def _with_ancestors(cells: DataFrame, prefix: str, down_to_self: bool) -> DataFrame:
    """Each cell once per order from 0 to its own (or to just above it)."""
    top = F.col("norder").cast("int") if down_to_self else F.col("norder").cast("int") - 1
    return (
        cells.where(top >= 0)
        .withColumn("key_order", F.explode(F.sequence(F.lit(0), top)))
        .select(
            "key_order",
            ancestor(F.col("npix"), F.col("norder").cast("int"), F.col("key_order")).alias("key_pixel"),
            F.col("norder").alias(f"{prefix}_order"),
            F.col("npix").alias(f"{prefix}_pixel"),
        )
    )


def _as_key(cells: DataFrame, prefix: str) -> DataFrame:
    return cells.select(
        F.col("norder").cast("int").alias("key_order"),
        F.col("npix").alias("key_pixel"),
        F.col("norder").alias(f"{prefix}_order"),
        F.col("npix").alias(f"{prefix}_pixel"),
    )


def align_cells(anchor_cells: DataFrame, partner_cells: DataFrame) -> DataFrame:
    """Pairs of overlapping cells, keyed by the finer of the two (the aligned cell).

    Containment is an equi-join on ancestors: at most 30 rows per cell, no range join.
    """
    key = ["key_order", "key_pixel"]
    columns = ["anchor_order", "anchor_pixel", "partner_order", "partner_pixel"]
    inside_partner = _with_ancestors(anchor_cells, "anchor", True).join(
        _as_key(partner_cells, "partner"), key
    )
    inside_anchor = _with_ancestors(partner_cells, "partner", False).join(
        _as_key(anchor_cells, "anchor"), key
    )
    finer_anchor = F.col("anchor_order") >= F.col("partner_order")
    return (
        inside_partner.select(*columns)
        .unionByName(inside_anchor.select(*columns))
        .select(
            F.when(finer_anchor, F.col("anchor_order")).otherwise(F.col("partner_order")).alias("aligned_order"),
            F.when(finer_anchor, F.col("anchor_pixel")).otherwise(F.col("partner_pixel")).alias("aligned_pixel"),
            *columns,
        )
    )


def check_alignment(aligned: DataFrame) -> None:
    """An aligned cell must come from one pair only (no overlapping cells in a catalog)."""
    clash = aligned.groupBy("aligned_order", "aligned_pixel").count().where(F.col("count") > 1).first()
    if clash is not None:
        cell = (clash["aligned_order"], clash["aligned_pixel"])
        raise ValueError(f"crossmatch partition {cell} maps to two cells")
