"""Positional crossmatch: the nearest partner of every anchor row within a radius.

Spark has no spatial join, so the search is an equi-join on the cells of a cubic grid
around the unit sphere. Cells are four radii wide: an anchor looks into every cell its
search ball touches, mostly one or two. That is exact at the poles, across ra = 0/360
and at catalog partition edges, with no margin data.

Crowded cells are never joined pair by pair. A cell in which both sides have more than
``leaf_rows`` rows, or the partners more than ``hot_rows``, is split four ways per axis, again
and again; an anchor walks down only into those parts that can still hold its nearest partner.
In all other cells there are at most ``leaf_rows`` pairs to a row, so they are joined as they
are, by one shuffle of the partners. Copies of one position cost nothing where cells are
crowded: only the smallest partner id of a position can win the tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.healpix import with_pixel
from ..functions.ids import normalize_id
from ..functions.numeric import finite
from ..functions.sphere import chord, separation_arcsec, unit_vector
from ..schemas import EDGE_SCHEMA, EDGE_VERSION
from ..session import cut_lineage
from .alignment import align_cells
from .skew import HOT_ROWS, hot_keys, repeat_rows, spread_join

CELLS_PER_RADIUS = 4.0  # width of a top cell, in search radii
SPLIT = 4.0  # a crowded cell is cut so many times per axis
LEAF_ROWS = 64
# Cells this small hold positions that no double-precision separation tells apart.
SMALLEST_CELL = 2.0**-60

CELL = ["cx", "cy", "cz"]
ANCHOR_POINT = ["anchor_id", "anchor_order", "anchor_pixel", "hx", "hy", "hz"]


def with_cell(df: DataFrame, order: int, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Add the HEALPix cell (``norder``, ``npix``) of each row's position."""
    return with_pixel(df, order, "npix", ra, dec).withColumn("norder", F.lit(order).cast("tinyint"))


def _grid(values: Sequence[str | Column], edge: float) -> list[Column]:
    cells = [F.floor((F.col(v) if isinstance(v, str) else v) / edge).cast("long") for v in values]
    return [_never_null(cell).alias(c) for cell, c in zip(cells, CELL)]


def _never_null(value: Column) -> Column:
    """A value of a row that has a position, which Spark is told of.

    Else joins push "is not null" down to the scan, with the position nested into each of these predicates;
    they make one method so large that the JVM never compiles it.
    """
    return F.coalesce(value, F.lit(0))


def _points(df: DataFrame, id_column: str, strip: bool, axes: Sequence[str]) -> DataFrame:
    """Narrow rows (id, cell, unit vector); a row without a position matches nothing."""
    ra, dec = F.col("ra").cast("double"), F.col("dec").cast("double")
    x, y, z = unit_vector(ra, dec)
    return df.where(finite(F.col("ra")) & finite(F.col("dec"))).select(
        normalize_id(df, id_column, strip).alias("id"),
        F.col("norder").cast("tinyint").alias("order"),
        F.col("npix").cast("long").alias("pixel"),
        *[_never_null(c).alias(a) for c, a in zip((x, y, z), axes)],
    )


def _squared_distance() -> Column:
    dx, dy, dz = F.col("hx") - F.col("sx"), F.col("hy") - F.col("sy"), F.col("hz") - F.col("sz")
    return dx * dx + dy * dy + dz * dz


def _box_distance(nearest: bool) -> Column:
    """Squared distance from an anchor to the nearest (farthest) point of a cell's extent.

    Rounding is monotone, so the nearest value never exceeds the distance to a real row.
    """
    total = None
    for axis in "xyz":
        h, low, high = F.col(f"h{axis}"), F.col(f"lo_{axis}"), F.col(f"hi_{axis}")
        if nearest:
            gap = F.greatest(low - h, h - high, F.lit(0.0))
        else:
            gap = F.greatest(F.abs(h - low), F.abs(h - high))
        total = gap * gap if total is None else total + gap * gap
    return total


def _reach(points: DataFrame, edge: float, length: float) -> DataFrame:
    """One row per anchor and top cell that its search ball touches."""
    pad = length * (1 + 1e-9) + 1e-15
    for axis, cell in zip(("hx", "hy", "hz"), CELL):
        low = F.floor((F.col(axis) - pad) / edge).cast("long")
        high = F.floor((F.col(axis) + pad) / edge).cast("long")
        points = points.withColumn(cell, F.explode(F.sequence(low, high)))
    return points


def _sizes(frontier: DataFrame, spokes: DataFrame) -> DataFrame:
    """Per cell the rows of both sides, and the copies that an anchor has at most."""
    return (
        frontier.select(*CELL, F.lit(1).alias("a"), F.lit(0).alias("p"), "copies")
        .unionByName(spokes.select(*CELL, F.lit(0).alias("a"), F.lit(1).alias("p"), F.lit(0).alias("copies")))
        .groupBy(*CELL)
        .agg(F.sum("a").alias("a"), F.sum("p").alias("p"), F.max("copies").alias("copies"))
    )


def _crowded(leaf_rows: int, hot_rows: int) -> Column:
    """Cells with too many pairs to a row, or too many partners for a task; without anchors none is."""
    a, p = F.col("a"), F.col("p")
    return (a > 0) & (p > leaf_rows) & ((a > leaf_rows) | (p > hot_rows))


def nearest_pairs(
    anchors: DataFrame,
    partners: DataFrame,
    radius_arcsec: float,
    *,
    leaf_rows: int = LEAF_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Nearest partner per anchor point: anchor columns, ``copies``, ``d2``, partner columns.

    Inputs are the narrow points of ``_points``. Ties go to the smallest partner id.
    """
    length = chord(radius_arcsec)
    limit = length * length
    edge = min(max(CELLS_PER_RADIUS * length, 2.0**-40), 4.0)

    hub = (
        anchors.withColumnsRenamed({"id": "anchor_id", "order": "anchor_order", "pixel": "anchor_pixel"})
        .groupBy(*ANCHOR_POINT)
        .agg(F.count("*").alias("copies"))
    )
    frontier = _reach(hub, edge, length).withColumn("bound", F.lit(limit))
    cells = _grid(("sx", "sy", "sz"), edge)
    spokes = partners.select("sx", "sy", "sz", F.struct("id", "order", "pixel").alias("partner"), *cells)

    def sized() -> tuple[DataFrame, Row]:
        """Rows per cell, and the extremes of the cells that both sides have: one job."""
        sizes = _sizes(frontier, spokes).withColumn("crowded", _crowded(leaf_rows, hot_rows))
        return sizes, sizes.agg(
            F.count_if("crowded").alias("crowded"),
            F.max(F.when(F.col("crowded"), F.col("p"))).alias("partners"),
            F.max("a").alias("anchors"),
            F.max("copies").alias("copies"),
            F.max("p").alias("most"),
        ).first()

    sizes, size = sized()
    copies = size["copies"] or 0
    if size["crowded"] or (size["most"] or 0) > hot_rows:
        # copies of a position count as one, which may be all the crowd there was
        spokes = spokes.groupBy("sx", "sy", "sz", *CELL).agg(F.min("partner").alias("partner"))
        sizes, size = sized()

    pairs = []
    while True:
        hot = hot_keys(frontier, CELL, hot_rows) if (size["anchors"] or 0) > hot_rows else None
        last = not size["crowded"] or edge / SPLIT < SMALLEST_CELL
        if last:
            leaves = spokes
        else:
            crowded = cut_lineage(sizes.where("crowded").select(*CELL))
            spoke_hot = hot_keys(spokes, CELL, hot_rows) if size["partners"] > hot_rows else None
            spread = {"salt_by": ["sx", "sy", "sz"], "hot": spoke_hot}
            leaves = spread_join(spokes, crowded, CELL, "left_anti", **spread)
        pairs.append(
            spread_join(frontier, leaves, CELL, "inner", salt_by=ANCHOR_POINT, hot=hot)
            .withColumn("d2", _squared_distance())
            .where(F.col("d2") <= F.col("bound"))
            .select(*ANCHOR_POINT, "copies", "d2", "partner")
        )
        if last:
            break

        # walk one level down: the parts of the crowded cells, summed up by extent
        inner = spread_join(spokes, crowded, CELL, "left_semi", **spread)
        edge /= SPLIT
        below = [c.alias(f"n{n}") for c, n in zip(_grid(("sx", "sy", "sz"), edge), CELL)]
        parts = inner.groupBy(*CELL, *below).agg(
            *[F.min(f"s{a}").alias(f"lo_{a}") for a in "xyz"],
            *[F.max(f"s{a}").alias(f"hi_{a}") for a in "xyz"],
        )
        seen = spread_join(frontier, parts, CELL, "inner", salt_by=ANCHOR_POINT, hot=hot).select(
            *ANCHOR_POINT,
            "copies",
            "bound",
            *[F.col(f"n{c}").alias(c) for c in CELL],
            _box_distance(nearest=True).alias("low"),
            _box_distance(nearest=False).alias("high"),
        )
        best = F.min("high").over(Window.partitionBy(*ANCHOR_POINT))
        frontier = cut_lineage(
            seen.where(F.col("low") <= F.col("bound"))
            .withColumn("bound", F.least("bound", best))
            .where(F.col("low") <= F.col("bound"))
            .drop("low", "high")
        )
        spokes = cut_lineage(inner.drop(*CELL).select("*", *_grid(("sx", "sy", "sz"), edge)))
        sizes, size = sized()

    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionByName(more)
    nearest = (
        found.groupBy(*ANCHOR_POINT, "copies")
        .agg(F.min(F.struct("d2", "partner")).alias("best"))
        .select(
            *ANCHOR_POINT[:3],
            "copies",
            F.col("best.d2").alias("d2"),
            F.col("best.partner.id").alias("partner_id"),
            F.col("best.partner.order").alias("partner_order"),
            F.col("best.partner.pixel").alias("partner_pixel"),
        )
    )
    if copies > 1:
        return repeat_rows(nearest, "copies")
    return nearest.drop("copies")


def crossmatch(
    anchor: DataFrame,
    partner: DataFrame,
    *,
    anchor_source: str,
    anchor_revision: str,
    partner_source: str,
    partner_revision: str,
    anchor_id_column: str = "object_id",
    anchor_strip_id: bool = False,
    partner_id_column: str = "object_id",
    partner_strip_id: bool = False,
    radius_arcsec: float = 1.0,
    epoch_treatment: str = "icrs_j2000_static",
    cell: tuple[int, int] | None = None,
    limit_partitions: int | None = None,
    leaf_rows: int = LEAF_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One edge row per anchor row with a partner within the radius (layout 2).

    Both inputs need ``ra``, ``dec``, their id column and their cell ``norder``, ``npix``;
    only those columns are read. ``cell`` or ``limit_partitions`` narrows the anchor to
    some of the partitions that meet the partner catalog.
    """
    if radius_arcsec <= 0:
        raise ValueError("radius_arcsec must be positive")
    if not anchor_revision or not partner_revision:
        raise ValueError("source revisions must be pinned")
    if cell is not None and limit_partitions is not None:
        raise ValueError("give a cell or a number of partitions, not both")
    if cell is not None or limit_partitions is not None:
        anchor = _narrow(anchor, partner, cell, limit_partitions)

    edges = nearest_pairs(
        _points(anchor, anchor_id_column, anchor_strip_id, ("hx", "hy", "hz")),
        _points(partner, partner_id_column, partner_strip_id, ("sx", "sy", "sz")),
        radius_arcsec,
        leaf_rows=leaf_rows,
        hot_rows=hot_rows,
    )
    constants = {
        "index_schema_version": F.lit(EDGE_VERSION),
        "anchor_source": F.lit(anchor_source),
        "anchor_revision": F.lit(anchor_revision),
        "partner_source": F.lit(partner_source),
        "partner_revision": F.lit(partner_revision),
        "join_kind": F.lit("positional"),
        # a pair on the rim may round past the radius, which index loading would reject
        "separation_arcsec": F.least(separation_arcsec(F.col("d2")), F.lit(float(radius_arcsec))),
        "match_radius_arcsec": F.lit(float(radius_arcsec)),
        "epoch_treatment": F.lit(epoch_treatment),
    }
    return edges.select(
        *[
            constants.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in EDGE_SCHEMA.fields
        ]
    )


def _narrow(
    anchor: DataFrame, partner: DataFrame, cell: tuple[int, int] | None, count: int | None
) -> DataFrame:
    """Keep the anchor partitions asked for, among those that meet the partner catalog."""
    meeting = align_cells(
        anchor.select("norder", "npix").distinct(), partner.select("norder", "npix").distinct()
    ).select(F.col("anchor_order").alias("norder"), F.col("anchor_pixel").alias("npix")).distinct()
    if cell is not None:
        order, pixel = cell
        wanted = (F.col("norder") == order) & (F.col("npix") == pixel)
        if meeting.where(wanted).isEmpty():
            raise ValueError(f"anchor cell {cell} does not meet the spoke")
        return anchor.where(wanted)
    chosen = meeting.orderBy("norder", "npix").limit(count)
    return anchor.join(chosen, ["norder", "npix"], "left_semi")
