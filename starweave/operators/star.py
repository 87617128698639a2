"""One record per anchor row with every available spoke attached, plus unmatched spoke rows.

The anchor rows carry images and are by far the widest, so they cross the network once:
each spoke is first joined to the narrow edges and keyed by anchor, then all spokes are
left-joined to the anchor rows on that one key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.ids import id_text
from ..sources.adapters import HubAdapter, SpokeAdapter, base_fields, with_fields
from .membership import among, without_ids
from .skew import HOT_ROWS, few_rows, hot_keys, small_side, spread_join

ANCHOR_KEY = ["norder", "npix", "anchor_id"]
PARTNER_KEY = ["partner_norder", "partner_npix", "partner_id"]
CELL_POINTER = ["norder", "npix", "source", "partner_id"]

# The order records are streamed in; the columns identify a record.
ORDER = ["cell_rank", "phase", "source", "part_order", "part_pixel", "row_index"]
UNMATCHED, ANCHOR = 0, 1


@dataclass(frozen=True)
class Spoke:
    """Rows of one partner catalog: the adapter's columns, ``norder``, ``npix``, ``row_index``."""

    adapter: SpokeAdapter
    rows: DataFrame

    def keyed(self) -> DataFrame:
        """The rows with their normalised id and their own cell under partner names."""
        return self.rows.withColumn("partner_id", self.adapter.partner_id(self.rows)).withColumnsRenamed(
            {"norder": "partner_norder", "npix": "partner_npix"}
        )


def narrow_ids(spokes: dict[str, Spoke]) -> DataFrame | None:
    """(source, partition, id) of every spoke row; reads no payload column."""
    result = None
    for name, spoke in sorted(spokes.items()):
        ids = spoke.keyed().select(F.lit(name).alias("source"), *PARTNER_KEY)
        result = ids if result is None else result.unionByName(ids)
    return result


def lookups(edges: DataFrame, partner_cells: DataFrame, ids: DataFrame) -> DataFrame:
    """CELL_POINTER and ``copies``: how many rows each pointer of an anchor cell finds.

    A pointer is looked up in all partitions its anchor cell refers to, not only its own. The ids are joined first and
    the partitions compared afterwards, so a pointer meets its own rows and never a list of partitions. Rows that no
    edge points to, mostly by far the most, are left where they are read.
    """
    wanted = edges.select(*CELL_POINTER).distinct()
    counts = among(ids, edges).groupBy("source", *PARTNER_KEY).agg(F.count("*").alias("copies"))
    there = wanted.join(counts, ["source", "partner_id"]).join(*_listed(partner_cells, ["source"]))
    found = there.groupBy(*CELL_POINTER).agg(F.sum("copies").alias("copies"))
    return wanted.join(found, CELL_POINTER, "left").withColumn("copies", F.coalesce("copies", F.lit(0)))


def _listed(partner_cells: DataFrame, more: list[str]) -> tuple[DataFrame, list[str], str]:
    """What ``join`` needs to keep rows whose partner partition is listed for their anchor cell."""
    key = ["norder", "npix", *more, "partner_norder", "partner_npix"]
    return partner_cells.select(*key), key, "left_semi"


def duplicate_partners(found: DataFrame) -> DataFrame:
    """Of ``lookups``, the pointers that find more than one row."""
    return found.where("copies > 1")


def refuse_duplicates(found: DataFrame) -> None:
    twice = duplicate_partners(found).first()
    if twice is not None:
        raise ValueError(f"duplicate {twice['source']} id {twice['partner_id']!r} in fetched partitions")


def missing_partners(edges: DataFrame, found: DataFrame) -> DataFrame:
    """Edges whose pointer, by ``lookups``, finds nothing."""
    return edges.join(found.where("copies = 0").select(*CELL_POINTER), CELL_POINTER, "left_semi")


def meet(edges: DataFrame, partner_cells: DataFrame, rows: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``edges`` of one source with the partner rows they point to, in the partitions listed for their anchor cells.

    Few edges are broadcast, so the partner rows stay where they are read and only matched ones go on. Otherwise the edges
    and the rows that a sieve of their ids lets pass are shuffled by id; neither way makes more rows than there are edges and copies of partners.
    """
    edges = edges.select(*ANCHOR_KEY, "partner_id")
    if few_rows(edges):
        met = rows.join(F.broadcast(edges), "partner_id")
    else:
        hot = hot_keys(edges, ["partner_id"], hot_rows)
        met = spread_join(edges, among(rows, edges), ["partner_id"], "inner", salt_by=ANCHOR_KEY, hot=hot)
    return met.join(*_listed(partner_cells, []))


def attach(
    hub: DataFrame,
    hub_adapter: HubAdapter,
    edges: DataFrame,
    partner_cells: DataFrame,
    spokes: dict[str, Spoke],
    *,
    check: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Anchor records: the ORDER columns, the base fields and all attached fields.

    ``hub`` has the adapter's columns, ``norder``, ``npix``, ``cell_rank``, ``row_index``.
    """
    hub = hub.withColumn("anchor_id", id_text(hub, hub_adapter.id_column))
    if check and spokes:
        refuse_duplicates(lookups(edges, partner_cells, narrow_ids(spokes)))
    hot_anchors = hot_keys(hub, ANCHOR_KEY, hot_rows)

    joined = hub
    fields: dict[str, list[Column]] = {}
    for n, (source, spoke) in enumerate(sorted(spokes.items())):
        rows = spoke.keyed()
        outputs = spoke.adapter.outputs(rows)
        own, cells = (df.where(F.col("source") == source) for df in (edges, partner_cells))
        matched = meet(own, cells, rows.drop("row_index", "path"), hot_rows=hot_rows)
        matched = matched.select(*ANCHOR_KEY, F.struct(*outputs).alias(f"_spoke_{n}"))
        joined = spread_join(
            joined, matched, ANCHOR_KEY, "left", salt_by=["row_index"], hot=hot_anchors
        )
        for name in matched.schema[f"_spoke_{n}"].dataType.names:
            # of two sources with the same field, the later one that has a value counts
            fields.setdefault(name, []).insert(0, F.col(f"_spoke_{n}").getField(name))
    joined, hub_fields = with_fields(joined, hub_adapter.outputs, "_hub")
    return joined.select(
        "cell_rank",
        F.lit(ANCHOR).alias("phase"),
        F.lit("").alias("source"),
        F.col("norder").cast("int").alias("part_order"),
        F.col("npix").alias("part_pixel"),
        "row_index",
        *base_fields(F.col("anchor_id")),
        *hub_fields,
        *[F.coalesce(*values).alias(name) for name, values in fields.items()],
    )


def unmatched(
    spoke: Spoke, source: str, matched_ids: DataFrame, owners: DataFrame, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows of owned partitions that no edge anywhere points to, as records of their own.

    ``owners``: source, partner_norder, partner_npix, cell_rank.
    """
    mine = owners.where(F.col("source") == source).select("partner_norder", "partner_npix", "cell_rank")
    rows = spoke.keyed().join(small_side(mine), ["partner_norder", "partner_npix"])
    ids = matched_ids.where(F.col("source") == source).select("partner_id")
    salt = ["partner_norder", "partner_npix", "row_index"]
    left = without_ids(rows, ids, salt_by=salt, hot_rows=hot_rows)
    left, fields = with_fields(left, spoke.adapter.outputs, "_fields")
    no_id = F.raise_error(F.lit(f"a row of {source} has no id")).cast("string")
    return left.select(
        "cell_rank",
        F.lit(UNMATCHED).alias("phase"),
        F.lit(source).alias("source"),
        F.col("partner_norder").cast("int").alias("part_order"),
        F.col("partner_npix").alias("part_pixel"),
        "row_index",
        *base_fields(F.concat(F.lit(f"{source}:"), F.coalesce("partner_id", no_id))),
        *fields,
    )


def assemble(
    hub: DataFrame,
    hub_adapter: HubAdapter,
    edges: DataFrame,
    partner_cells: DataFrame,
    spokes: dict[str, Spoke],
    unmatched_spokes: dict[str, Spoke],
    matched_ids: DataFrame,
    owners: DataFrame,
    *,
    check: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All records of a stream: anchors with their spokes, and every unmatched spoke row once."""
    records = attach(
        hub, hub_adapter, edges, partner_cells, spokes, check=check, hot_rows=hot_rows
    )
    eligible = {s: k for s, k in unmatched_spokes.items() if k.adapter.emits_unmatched}
    if not eligible:
        return records
    for source, spoke in sorted(eligible.items()):
        alone = unmatched(spoke, source, matched_ids, owners, hot_rows=hot_rows)
        records = records.unionByName(alone, allowMissingColumns=True)
    return records


def after(records: DataFrame, position: Row | tuple | None, order: list[str] = ORDER) -> DataFrame:
    """The records that come strictly later in the order: exact resume from any record."""
    if position is None:
        return records
    later, equal = F.lit(False), F.lit(True)
    for name, value in zip(order, position):
        later = later | (equal & (F.col(name) > F.lit(value)))
        equal = equal & (F.col(name) == F.lit(value))
    return records.where(later)
