"""Edge layout ↔ wide layout of the match index, and their consistency checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import finite
from ..schemas import BLOCK_FIELDS, WIDE_VERSION, wide_schema

ANCHOR_KEY = ["anchor_order", "anchor_pixel", "anchor_id"]


def quoted(name: str) -> str:
    """Source names may hold characters that need back-ticks."""
    return f"`{name}`"


def index_sources(edges: DataFrame) -> list[str]:
    """The distinct partner sources, sorted."""
    rows = edges.select("partner_source").distinct().collect()  # they become columns
    return sorted(str(row[0]) for row in rows)


def _block(prefix: str = "partner_") -> Column:
    """The six fields of one match, as a struct that compares field by field."""
    names = {"separation_arcsec": "separation_arcsec", "match_radius_arcsec": "match_radius_arcsec"}
    return F.struct(
        *[
            F.col(names.get(name, prefix + name)).cast(kind).alias(name)
            for name, kind in BLOCK_FIELDS
        ]
    )


def singleton_columns(edges: DataFrame) -> list[Column]:
    """Smallest and largest value, and NULL count, of the table-wide constants."""
    columns = ("index_schema_version", "anchor_source", "anchor_revision", "epoch_treatment")
    parts = [F.count("*").alias("rows")]
    for c in [c for c in columns if c in edges.columns]:
        parts += [
            F.min(c).alias(f"{c}_low"),
            F.max(c).alias(f"{c}_high"),
            F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
        ]
    return parts


def singletons(edges: DataFrame) -> DataFrame:
    return edges.agg(*singleton_columns(edges))


def source_revisions(edges: DataFrame) -> DataFrame:
    """Smallest and largest revision of each source; they must be the same."""
    return edges.groupBy("partner_source").agg(
        F.min("partner_revision").alias("revision_low"),
        F.max("partner_revision").alias("revision_high"),
    )


def partner_conflicts(edges: DataFrame) -> DataFrame:
    """Anchors with two different partner ids in one source."""
    return (
        edges.groupBy(*ANCHOR_KEY, "partner_source")
        .agg(F.min("partner_id").alias("id_low"), F.max("partner_id").alias("id_high"))
        .where(F.col("id_low") != F.col("id_high"))
    )


def block_conflicts(edges: DataFrame) -> DataFrame:
    """Anchors with two matches in one source that differ in any field; copies are fine."""
    return (
        edges.groupBy(*ANCHOR_KEY, "partner_source")
        .agg(F.min(_block()).alias("low"), F.max(_block()).alias("high"))
        .where(~F.col("low").eqNullSafe(F.col("high")))
        .select(*ANCHOR_KEY, "partner_source")
    )


def bad_separation(separation: Column, radius: Column) -> Column:
    """TRUE unless 0 ≤ separation ≤ radius, both finite, and radius > 0."""
    s, r = separation.cast("double"), radius.cast("double")
    good = finite(separation) & finite(radius) & (r > 0) & (s >= 0) & (s <= r)
    return ~F.coalesce(good, F.lit(False))


def check_edges(edges: DataFrame) -> dict[str, str]:
    """Refuse edges that are not positional, lie outside their radius or lack an id.

    Returns the one revision of each source; a source with several is refused. Loading and
    merging both run it.
    """
    other_kind = ~F.col("join_kind").eqNullSafe(F.lit("positional"))
    one = edges.agg(
        F.min(F.when(other_kind, F.coalesce("join_kind", F.lit("NULL")))).alias("join_kind"),
        F.count_if(bad_separation(F.col("separation_arcsec"), F.col("match_radius_arcsec"))).alias("bad"),
        F.count_if(F.col("anchor_id").isNull() | F.col("partner_id").isNull()).alias("nameless"),
    ).first()
    if one["join_kind"] is not None:
        raise ValueError(f"unknown join kind {one['join_kind']!r}")
    if one["bad"]:
        raise ValueError(f"invalid positional match: {one['bad']} edges are not within their radius")
    if one["nameless"]:
        raise ValueError(f"{one['nameless']} edges lack an anchor or partner id")
    return revisions_of(edges)


def revisions_of(edges: DataFrame) -> dict[str, str]:
    """The pinned revision of each source."""
    rows = source_revisions(edges).collect()  # one per source
    for row in rows:
        if row["revision_low"] != row["revision_high"]:
            raise ValueError(f"source {row['partner_source']!r} mixes revisions")
    return {str(row["partner_source"]): str(row["revision_low"]) for row in rows}


def check_pivot(edges: DataFrame) -> None:
    """Refuse edges that cannot share one wide index."""
    one = singletons(edges).first()
    for c in ("anchor_source", "anchor_revision", "epoch_treatment"):
        if one["rows"] == 0 or one[f"{c}_nulls"] or one[f"{c}_low"] != one[f"{c}_high"]:
            raise ValueError(f"indexes to merge disagree on {c}")
    check_edges(edges)
    clash = block_conflicts(edges).first()
    if clash is not None:
        raise ValueError(f"two {clash['partner_source']!r} matches for anchor {clash['anchor_id']!r}")


def pivot_edges(
    edges: DataFrame, sources: Sequence[str] | None = None, *, check: bool = True
) -> DataFrame:
    """Edges → one row per anchor with a column block per source, NULL where absent.

    One aggregation with map-side combining; after ``check`` all values of a block are
    equal, so ``min`` picks the only one.
    """
    if check:
        check_pivot(edges)
    sources = index_sources(edges) if sources is None else sorted(sources)
    block = _block()
    wide = edges.groupBy(*ANCHOR_KEY).agg(
        F.min("anchor_source").alias("anchor_source"),
        F.min("anchor_revision").alias("anchor_revision"),
        F.min("epoch_treatment").alias("epoch_treatment"),
        *[
            F.min(F.when(F.col("partner_source") == s, block)).alias(f"_block_{i}")
            for i, s in enumerate(sources)
        ],
    )
    values = {"index_schema_version": F.lit(WIDE_VERSION)}
    for i, s in enumerate(sources):
        for name, _ in BLOCK_FIELDS:
            values[f"{s}_{name}"] = F.col(f"_block_{i}").getField(name)
    return wide.select(
        *[
            values.get(f.name, F.col(quoted(f.name))).cast(f.dataType).alias(f.name)
            for f in wide_schema(sources).fields
        ]
    )


def wide_sources(wide: DataFrame) -> list[str]:
    """Sources of a wide index, read off its ``…_id`` columns."""
    return sorted(c[: -len("_id")] for c in wide.columns if c.endswith("_id") and c != "anchor_id")


def unpivot_edges(wide: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """Wide rows → one row per present block, in the order of the sources."""
    sources = wide_sources(wide) if sources is None else list(sources)
    blocks = F.array(
        *[
            F.struct(
                F.lit(s).alias("partner_source"),
                *[
                    F.col(quoted(f"{s}_{name}")).cast(kind).alias(
                        name if name.endswith("arcsec") else f"partner_{name}"
                    )
                    for name, kind in BLOCK_FIELDS
                ],
            )
            for s in sources
        ]
    )
    kept = [f for f in wide.columns if f.startswith("anchor_") or f == "epoch_treatment"]
    extra = [c for c in wide.columns if c.startswith("_row_")]
    present = F.filter(blocks, lambda b: b.getField("partner_id").isNotNull())
    return wide.select(*kept, *extra, F.explode(present).alias("_b")).select(*kept, *extra, "_b.*")
