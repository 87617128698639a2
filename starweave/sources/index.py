"""Reading and writing match indexes; every layout becomes the same edge DataFrame."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import strip
from ..operators.layout import (
    bad_separation,
    check_edges,
    partner_conflicts,
    quoted,
    revisions_of,
    singleton_columns,
    unpivot_edges,
    wide_sources,
)
from ..schemas import EDGE_SCHEMA, EDGE_VERSION, PAIR_SCHEMA, WIDE_VERSION

MATCH_INDEX_ENV = "STARWEAVE_MATCH_INDEX"

# Tags that resume state is checked against; they name the record order.
PAIR_ASSEMBLY = "crossmatch_only_v3"
GRAPH_ASSEMBLY = "legacy_north_source_graph_v1"

# What the oldest layout leaves out.
PAIR_ANCHOR_SOURCE = "legacy_north"
PAIR_SOURCE = "desi"

CELL = ["norder", "npix"]
PARTNER_CELL = ["partner_norder", "partner_npix"]


@dataclass(frozen=True)
class MatchIndex:
    """A loaded index.

    ``edges``: norder, npix, anchor_id, source, partner_id — one row per match.
    ``partner_cells``: norder, npix, source, partner_norder, partner_npix — the partner
    partitions to read for an anchor cell. ``anchor_cells``: norder, npix.
    """

    schema_version: int
    anchor_source: str
    anchor_revision: str
    partner_revisions: dict[str, str]
    edges: DataFrame
    partner_cells: DataFrame
    anchor_cells: DataFrame

    @property
    def is_graph(self) -> bool:
        """Does this index need the multi-source stream rather than the pair stream?"""
        versions = (EDGE_VERSION, WIDE_VERSION)
        return self.schema_version in versions and set(self.partner_revisions) != {PAIR_SOURCE}

    @property
    def assembly(self) -> str:
        return GRAPH_ASSEMBLY if self.is_graph else PAIR_ASSEMBLY

    @property
    def revisions(self) -> dict[str, str]:
        return {"anchor": self.anchor_revision, **self.partner_revisions}

    def of_source(self, source: str) -> DataFrame:
        return self.edges.where(F.col("source") == source)

    def matched_ids(self) -> DataFrame:
        """Distinct (source, partner_id) over all cells: the rows that are not unmatched."""
        return self.edges.select("source", "partner_id").distinct()

    def match_map(self) -> DataFrame:
        """One row per anchor cell and id with a ``source → partner id`` map."""
        entries = F.sort_array(F.collect_set(F.struct("source", "partner_id")))
        return self.edges.groupBy(*CELL, "anchor_id").agg(F.map_from_entries(entries).alias("partners"))

    def partner_cell_ranges(self) -> DataFrame:
        """norder, npix, source, partner_norder, first, last: the partner cells of each anchor cell as ranges.

        Neighbouring cells of one order become one row, each pair of ranges has a gap between, and no anchor
        cell's partners are gathered in one value, however many there are.
        """
        group = [*CELL, "source", "partner_norder"]
        place = F.row_number().over(Window.partitionBy(*group).orderBy("partner_npix"))
        island = (F.col("partner_npix") - place).alias("_island")
        ranges = self.partner_cells.select(*group, "partner_npix", island).groupBy(*group, "_island")
        return ranges.agg(F.min("partner_npix").alias("first"), F.max("partner_npix").alias("last")).drop("_island")

    def partner_cell_sets(self) -> DataFrame:
        """One row per anchor cell and source with its sorted ranges (partner_norder, first, last) of partner cells."""
        ranges = F.sort_array(F.collect_list(F.struct("partner_norder", "first", "last")))
        return self.partner_cell_ranges().groupBy(*CELL, "source").agg(ranges.alias("ranges"))


def resolve_match_index(match_index: str | None = None) -> str | None:
    """The explicit path, else the environment's, else None."""
    return match_index or os.environ.get(MATCH_INDEX_ENV) or None


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One parquet table, or every ``*.parquet`` in a directory and nothing else.

    Adds ``_row_at`` (file, position), the order in which a later row overrides.
    """
    path = str(path)
    try:
        table = spark.read.parquet(f"{path.rstrip('/')}/*.parquet")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        try:
            table = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
        except AnalysisException as empty:
            if "UNABLE_TO_INFER_SCHEMA" in str(empty):
                raise ValueError(f"no spoke parquets in {path}") from empty
            raise
    return table.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("_row_at"))


def load_index(spark: SparkSession, path: str) -> MatchIndex:
    """Load an index of any layout, which its columns tell."""
    return index_from(read_index(spark, path))


def index_from(table: DataFrame) -> MatchIndex:
    """Normalise and check an index table; without ``_row_at`` the row order is unknown."""
    if "_row_at" not in table.columns:
        # no order is given: the largest value wins where the layout lets a row override
        table = table.withColumn("_row_at", F.lit(None).cast("struct<file_path:string,row_index:bigint>"))
    names = set(table.columns)
    if set(PAIR_SCHEMA.names) <= names:
        return _from_pairs(table)
    if "partner_source" not in names:
        return _from_wide(table)
    missing = sorted(set(EDGE_SCHEMA.names) - names)
    if missing:
        raise ValueError(f"match index is missing columns {missing}")
    return _from_edges(table)


def _normal(table: DataFrame) -> DataFrame:
    return table.select(
        F.col("anchor_order").cast("tinyint").alias("norder"),
        F.col("anchor_pixel").cast("long").alias("npix"),
        F.col("anchor_id").cast("string").alias("anchor_id"),
        F.col("partner_source").cast("string").alias("source"),
        # stripped as the adapters strip the ids of partner rows
        strip(F.col("partner_id").cast("string")).alias("partner_id"),
        F.col("partner_order").cast("tinyint").alias("partner_norder"),
        F.col("partner_pixel").cast("long").alias("partner_npix"),
        "_row_at",
    )


def _last_wins(rows: DataFrame) -> DataFrame:
    """A later row replaces an earlier one of the same anchor and source."""
    last = F.max(F.struct("_row_at", "partner_id"))
    return rows.groupBy(*CELL, "anchor_id", "source").agg(last["partner_id"].alias("partner_id"))


def _build(version: int, header: tuple[str, str], revisions: dict, rows: DataFrame, edges: DataFrame, cells: DataFrame) -> MatchIndex:
    return MatchIndex(
        version,
        *header,
        dict(sorted(revisions.items())),
        edges.select(*CELL, "anchor_id", "source", "partner_id"),
        rows.select(*CELL, "source", *PARTNER_CELL).distinct(),
        cells,
    )


def _from_pairs(table: DataFrame) -> MatchIndex:
    rows = _normal(
        table.select(
            F.col("image_order").alias("anchor_order"),
            F.col("image_pixel").alias("anchor_pixel"),
            F.col("image_id").alias("anchor_id"),
            F.lit(PAIR_SOURCE).alias("partner_source"),
            F.col("spectrum_id").alias("partner_id"),
            F.col("spectrum_order").alias("partner_order"),
            F.col("spectrum_pixel").alias("partner_pixel"),
            "_row_at",
        )
    )
    cells = rows.select(*CELL).distinct()
    return _build(1, (PAIR_ANCHOR_SOURCE, ""), {PAIR_SOURCE: ""}, rows, _last_wins(rows), cells)


def _check_header(one: Row, version: int) -> tuple[str, str]:
    low, high = one["index_schema_version_low"], one["index_schema_version_high"]
    if one["index_schema_version_nulls"] or (low, high) != (version, version):
        raise ValueError(f"match index mixes schema versions {sorted({str(low), str(high)})}")
    for c in ("anchor_source", "anchor_revision"):
        if one[f"{c}_nulls"] or one[f"{c}_low"] != one[f"{c}_high"]:
            raise ValueError("match index must have one pinned anchor source/revision")
    return str(one["anchor_source_low"]), str(one["anchor_revision_low"])


def _from_edges(table: DataFrame) -> MatchIndex:
    header = _check_header(table.agg(*singleton_columns(table)).first(), EDGE_VERSION)
    revisions = check_edges(table)
    clash = partner_conflicts(table).first()
    if clash is not None:
        raise ValueError(f"multiple {clash['partner_source']!r} partners for anchor {clash['anchor_id']!r}")
    rows = _normal(table)
    edges = rows.select(*CELL, "anchor_id", "source", "partner_id").distinct()
    return _build(EDGE_VERSION, header, revisions, rows, edges, rows.select(*CELL).distinct())


def _from_wide(table: DataFrame) -> MatchIndex:
    sources = wide_sources(table)
    one = table.agg(
        *singleton_columns(table),
        *[
            F.min(
                F.when(
                    F.col(quoted(f"{s}_id")).isNotNull()
                    & bad_separation(
                        F.col(quoted(f"{s}_separation_arcsec")), F.col(quoted(f"{s}_match_radius_arcsec"))
                    ),
                    F.col("anchor_id"),
                )
            ).alias(f"_{i}")
            for i, s in enumerate(sources)
        ]
    ).first()
    header = _check_header(one, WIDE_VERSION)
    if not sources:
        raise ValueError("wide match index has no spoke columns")
    for i, s in enumerate(sources):
        if one[f"_{i}"] is not None:
            raise ValueError(f"invalid {s} match for anchor {one[f'_{i}']!r}")
    long = unpivot_edges(table, sources)
    revisions = revisions_of(long)
    clash = partner_conflicts(long).first()
    if clash is not None:
        raise ValueError(f"multiple {clash['partner_source']!r} partners for anchor {clash['anchor_id']!r}")
    rows = _normal(long)
    # an anchor without any spoke still makes its cell part of the corpus
    cells = table.select(
        F.col("anchor_order").cast("tinyint").alias("norder"), F.col("anchor_pixel").cast("long").alias("npix")
    ).distinct()
    return _build(WIDE_VERSION, header, revisions, rows, _last_wins(rows), cells)


def pair_view(index: MatchIndex) -> tuple[DataFrame, DataFrame]:
    """Edges and partner cells of an index that has the single pair source only."""
    unsupported = sorted(set(index.partner_revisions) - {PAIR_SOURCE})
    if unsupported:
        raise ValueError(f"{PAIR_ASSEMBLY} cannot stream sources {unsupported}")
    return index.edges, index.partner_cells


def assembly_and_revisions(spark: SparkSession, match_index: str | None = None) -> tuple[str, dict]:
    """Resume tag and pinned revisions; an index that is not there means the pair stream."""
    resolved = resolve_match_index(match_index)
    if resolved is None:
        return PAIR_ASSEMBLY, {}
    try:
        index = load_index(spark, resolved)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return PAIR_ASSEMBLY, {}
        raise
    return index.assembly, index.revisions


def write_index(table: DataFrame, path: str) -> int:
    """Write an index as a parquet directory and return its row count."""
    table.write.mode("overwrite").parquet(str(path))
    return table.sparkSession.read.parquet(str(path)).count()
