"""Registered queries and their SQL twins. All run over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions import arrays, healpix, ids, numeric, sphere
from starweave.operators import layout, pair, star
from starweave.operators.alignment import align_cells
from starweave.operators.crossmatch import crossmatch, with_cell
from starweave.operators.membership import among
from starweave.operators.ordering import number_rows
from starweave.operators.star import Spoke
from starweave.plans import cells as plan
from starweave.plans.ownership import graph_owners, pair_owners, references
from starweave.session import cut_lineage, scratch_path
from starweave.sources import adapters as adapt
from starweave.sources.catalog import Catalog, Registry, write_catalog
from starweave.sources.index import index_from, load_index, write_index
from starweave.streaming.stream import Stream, open_stream
from starweave.streaming.structured import run_available, stream_cells, write_cell_plan

from . import oracle, sky
from .oracle import HUB, PAIR, STAR, nearest, query, spoke
from .sky import HUB_ORDER, HUB_SOURCE, REVISION, SOURCES, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None, name: str | None = None):
    def keep(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLE[key] = sql
        return function

    return keep


# ---------------------------------------------------------------- crossmatch and cells


@register(query(PAIR, "SELECT anchor_id, partner_id, round(separation, 4) AS separation FROM e_desi"))
def crossmatch_nearest(spark, sf):
    return sky.edges(spark, sf, "desi").select(
        "anchor_id", "partner_id", F.round(F.col("separation_arcsec").cast("double"), 4).alias("separation")
    )


def _edge_columns(revision: str = "r1") -> str:
    return f"""CAST(2 AS SMALLINT) AS index_schema_version, '{HUB_SOURCE}' AS anchor_source, 'r1' AS anchor_revision,
 CAST(norder AS TINYINT) AS anchor_order, npix AS anchor_pixel, anchor_id, source AS partner_source, '{revision}' AS partner_revision,
 CAST(partner_norder AS TINYINT) AS partner_order, partner_npix AS partner_pixel, partner_id, 'positional' AS join_kind,
 round(separation, 3) AS separation_arcsec, CAST(1 AS DOUBLE) AS match_radius_arcsec, 'icrs_j2000_static' AS epoch_treatment"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "separation_arcsec": F.round(F.col("separation_arcsec").cast("double"), 3),
            "match_radius_arcsec": F.col("match_radius_arcsec").cast("double"),
        }
    )


@register(query(STAR, f"SELECT {_edge_columns()} FROM edges"))
def crossmatch_edges_v2(spark, sf):
    edges = [sky.edges(spark, sf, s) for s in SOURCES]
    return _rounded(edges[0].unionByName(edges[1]).unionByName(edges[2]))


def _embedding_sky(spark, sf) -> DataFrame:
    """Directions in the first three embedding axes."""
    e = F.col("embedding")
    x, y, z = (e[i].cast("double") for i in range(3))
    ra = F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))
    dec = F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))
    df = table(spark, sf, "embeddings").select("vec_id", "label", ra.alias("ra"), dec.alias("dec"))
    return with_cell(df.withColumn("object_id", F.col("vec_id").cast("string")), HUB_ORDER)


_EMBEDDING = """v AS MATERIALIZED (SELECT CAST(vec_id AS VARCHAR) AS object_id, CAST(vec_id AS VARCHAR) AS partner_id, label, 0 AS norder, 0 AS npix, 0.0 AS dec,
 a / n AS vx, b / n AS vy, c / n AS vz FROM (SELECT *, sqrt(a * a + b * b + c * c) AS n FROM
 (SELECT vec_id, label, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS c FROM embeddings))),
vh AS (SELECT * FROM v WHERE label < 5), vs AS (SELECT * FROM v WHERE label >= 5)"""


@register(
    query(
        _EMBEDDING + ",\n" + nearest("e", "vh", "vs", "e", limit=repr(sphere.chord(36000.0) ** 2)),
        "SELECT anchor_id, partner_id, round(separation, 3) AS separation FROM e",
    )
)
def crossmatch_wide_radius(spark, sf):
    """Ten degrees: every cell is crowded and the search walks down the grid."""
    points = _embedding_sky(spark, sf)
    pairs = crossmatch(
        points.where("label < 5"),
        points.where("label >= 5"),
        anchor_source="low",
        anchor_revision="r1",
        partner_source="high",
        partner_revision="r1",
        radius_arcsec=36000.0,
    )
    # a FLOAT separation of degrees has fewer digits than the check: recompute it
    place = points.select("object_id", *[c.alias(a) for c, a in zip(sphere.unit_vector(F.col("ra"), F.col("dec")), "xyz")])
    a, b = place.alias("a"), place.alias("b")
    d2 = sum(((F.col(f"a.{i}") - F.col(f"b.{i}")) * (F.col(f"a.{i}") - F.col(f"b.{i}")) for i in "xyz"), F.lit(0.0))
    return (
        pairs.select("anchor_id", "partner_id")
        .join(a, F.col("anchor_id") == F.col("a.object_id"))
        .join(b, F.col("partner_id") == F.col("b.object_id"))
        .select("anchor_id", "partner_id", F.round(sphere.separation_arcsec(d2), 3).alias("separation"))
    )


@register(
    query(
        PAIR,
        """SELECT anchor_id, partner_id FROM e_desi WHERE (norder, npix) IN (SELECT norder, npix FROM
 (SELECT DISTINCT h.norder, h.npix FROM hub h JOIN desi s ON h.npix = s.npix >> 2) ORDER BY norder, npix LIMIT 25)""",
    )
)
def crossmatch_partition_limit(spark, sf):
    """A smoke build over the first 25 partitions that meet the spoke."""
    return crossmatch(
        sky.hub(spark, sf),
        sky.desi(spark, sf),
        anchor_source=HUB_SOURCE,
        anchor_revision=REVISION,
        partner_source="desi",
        partner_revision=REVISION,
        limit_partitions=25,
    ).select("anchor_id", "partner_id")


@register(
    query(
        PAIR,
        """SELECT CAST(5 AS TINYINT) AS aligned_order, s.npix AS aligned_pixel, CAST(4 AS TINYINT) AS anchor_order, h.npix AS anchor_pixel,
 CAST(5 AS TINYINT) AS partner_order, s.npix AS partner_pixel
 FROM (SELECT DISTINCT npix FROM hub) h JOIN (SELECT DISTINCT npix FROM desi) s ON h.npix = s.npix >> 2""",
    )
)
def partner_alignment(spark, sf):
    return align_cells(
        sky.hub(spark, sf).select("norder", "npix").distinct(),
        sky.desi(spark, sf).select("norder", "npix").distinct(),
    )


@register(
    query(
        HUB,
        f"""SELECT object_id, _healpix_29, _healpix_29 >> 50 AS pixel_4, _healpix_29 >> 46 AS pixel_6,
 {oracle.split('6', '(_healpix_29 >> 46)')} AS split FROM hub""",
    )
)
def healpix_cells(spark, sf):
    index = F.col("_healpix_29")
    six = healpix.cell_of_index(index, 6)
    return sky.hub(spark, sf).select(
        "object_id",
        "_healpix_29",
        healpix.ancestor(index, 29, 4).alias("pixel_4"),
        six.alias("pixel_6"),
        healpix.split_of_cell(F.lit(6), six).alias("split"),
    )


@register(
    query(
        HUB + ",\n" + spoke("desi"),
        """SELECT s.partner_id AS order_id, round(2 * degrees(asin(least(1.0, sqrt((h.vx - s.vx) * (h.vx - s.vx) + (h.vy - s.vy) * (h.vy - s.vy) + (h.vz - s.vz) * (h.vz - s.vz)) / 2))) * 3600, 4) AS separation
 FROM desi s JOIN hub h ON h.c_custkey = s.o_custkey""",
    )
)
def angular_separation(spark, sf):
    """Separation of each order from its customer, over a keyed join."""
    size = sky.SPOKES["desi"][1]
    orders = sky.table(spark, sf, "orders")
    mine = sphere.unit_vector(*sky.observed_position(F.col("o_custkey"), F.col("o_orderkey"), size))
    theirs = sphere.unit_vector(*sky.anchor_position(F.col("c_custkey")))
    d2 = sum(((a - b) * (a - b) for a, b in zip(theirs, mine)), F.lit(0.0))
    return orders.join(table(spark, sf, "customer").select("c_custkey"), F.col("c_custkey") == F.col("o_custkey")).select(
        F.concat(F.lit("o"), "o_orderkey").alias("order_id"),
        F.round(sphere.separation_arcsec(d2), 4).alias("separation"),
    )


# ---------------------------------------------------------------------- index layouts

_WIDE = ", ".join(
    f"""max(CASE WHEN source = '{s}' THEN 'r1' END) AS {s}_revision, max(CASE WHEN source = '{s}' THEN partner_id END) AS {s}_id,
 CAST(max(CASE WHEN source = '{s}' THEN partner_norder END) AS TINYINT) AS {s}_order, max(CASE WHEN source = '{s}' THEN partner_npix END) AS {s}_pixel,
 round(max(CASE WHEN source = '{s}' THEN separation END), 3) AS {s}_separation_arcsec, max(CASE WHEN source = '{s}' THEN CAST(1 AS DOUBLE) END) AS {s}_match_radius_arcsec"""
    for s in SOURCES
)


@register(
    query(
        STAR,
        f"""SELECT CAST(3 AS SMALLINT) AS index_schema_version, '{HUB_SOURCE}' AS anchor_source, 'r1' AS anchor_revision, CAST(norder AS TINYINT) AS anchor_order,
 npix AS anchor_pixel, anchor_id, {_WIDE}, 'icrs_j2000_static' AS epoch_treatment FROM edges GROUP BY norder, npix, anchor_id""",
    )
)
def wide_pivot_v3(spark, sf):
    wide = layout.pivot_edges(sky.index_table(spark, sf))
    return wide.withColumns(
        {
            c: F.round(F.col(c).cast("double"), 3)
            for c in wide.columns
            if c.endswith("_separation_arcsec") or c.endswith("_match_radius_arcsec")
        }
    )


@register(
    query(
        STAR,
        """SELECT anchor_id, source AS partner_source, partner_id, CAST(partner_norder AS TINYINT) AS partner_order, partner_npix AS partner_pixel,
 'r1' AS partner_revision, round(separation, 3) AS separation_arcsec FROM edges""",
    )
)
def unpivot_edges(spark, sf):
    wide = layout.pivot_edges(sky.index_table(spark, sf), SOURCES, check=False)
    long = layout.unpivot_edges(wide)
    return long.select(
        "anchor_id",
        "partner_source",
        "partner_id",
        "partner_order",
        "partner_pixel",
        "partner_revision",
        F.round(F.col("separation_arcsec").cast("double"), 3).alias("separation_arcsec"),
    )


@register(query(STAR, "SELECT count(*) AS edges, 0::BIGINT AS only_edge_layout, 0::BIGINT AS only_wide_layout FROM edges"))
def graph_roundtrip_diff(spark, sf):
    """Both layouts must load to the same graph."""
    path = scratch_path(spark, "wide.parquet")
    write_index(layout.pivot_edges(sky.index_table(spark, sf)), path)
    left, right = sky.index(spark, sf).edges, load_index(spark, path).edges
    key = left.columns
    both = left.withColumn("l", F.lit(1)).join(right.withColumn("r", F.lit(1)), key, "full")
    return both.agg(
        F.count("*").alias("edges"),
        F.count_if(F.col("r").isNull()).alias("only_edge_layout"),
        F.count_if(F.col("l").isNull()).alias("only_wide_layout"),
    )


_PAIR_V1 = """SELECT CAST(norder AS TINYINT) AS norder, npix, anchor_id, 'desi' AS source, partner_id FROM e_desi"""


@register(query(PAIR, _PAIR_V1))
def legacy_index_v1(spark, sf):
    """The six-column layout loads to the same matches."""
    v1 = sky.index_table(spark, sf).where("partner_source = 'desi'").select(
        F.col("anchor_order").alias("image_order"),
        F.col("anchor_pixel").alias("image_pixel"),
        F.col("anchor_id").alias("image_id"),
        F.col("partner_order").alias("spectrum_order"),
        F.col("partner_pixel").alias("spectrum_pixel"),
        F.col("partner_id").alias("spectrum_id"),
    )
    return index_from(v1).edges


@register(query(STAR, "SELECT CAST(norder AS TINYINT) AS norder, npix, anchor_id, source, partner_id FROM edges"))
def index_directory_load(spark, sf):
    """A directory of one index per spoke is one graph."""
    return sky.index(spark, sf).edges


@register(
    query(
        STAR,
        """SELECT CAST(norder AS TINYINT) AS norder, npix, anchor_id,
 '{' || string_agg('"' || source || '":"' || partner_id || '"', ',' ORDER BY source) || '}' AS partners FROM edges GROUP BY norder, npix, anchor_id""",
    )
)
def match_map_json(spark, sf):
    maps = sky.index(spark, sf).match_map()
    return maps.select("norder", "npix", "anchor_id", F.to_json("partners").alias("partners"))


@register(
    query(
        STAR,
        """SELECT CAST(norder AS TINYINT) AS norder, npix, source, string_agg(cell, ' ' ORDER BY partner_norder, partner_npix) AS cells FROM
 (SELECT DISTINCT norder, npix, source, partner_norder, partner_npix, partner_norder || '/' || partner_npix AS cell FROM edges) GROUP BY norder, npix, source""",
    )
)
def partner_cells_set(spark, sf):
    """The ranges of partner cells, spelled out cell by cell."""
    sets = sky.index(spark, sf).partner_cell_sets()
    named = lambda r: F.transform(F.sequence(r["first"], r["last"]), lambda c: F.concat_ws("/", r["partner_norder"], c))
    return sets.select("norder", "npix", "source", F.array_join(F.flatten(F.transform("ranges", named)), " ").alias("cells"))


@register(
    query(
        STAR,
        """SELECT CAST(norder AS TINYINT) AS norder, npix, source, CAST(partner_norder AS TINYINT) AS partner_norder, min(partner_npix) AS first, max(partner_npix) AS last FROM
 (SELECT *, partner_npix - row_number() OVER (PARTITION BY norder, npix, source, partner_norder ORDER BY partner_npix) AS island FROM
  (SELECT DISTINCT norder, npix, source, partner_norder, partner_npix FROM edges)) GROUP BY norder, npix, source, partner_norder, island""",
    )
)
def partner_cell_ranges(spark, sf):
    return sky.index(spark, sf).partner_cell_ranges()


@register(query(STAR, "SELECT DISTINCT source, partner_id FROM edges"))
def matched_ids_distinct(spark, sf):
    return sky.index(spark, sf).matched_ids()


def _two_revisions(spark, sf) -> DataFrame:
    """Edges against all orders, and against the finished ones under another revision."""
    again = sky.edges(spark, sf, "desi", sky.desi(spark, sf).where("o_orderstatus = 'F'"), revision="r2")
    return cut_lineage(sky.index_table(spark, sf).unionByName(again))


_TWO = (
    STAR
    + ",\ndone AS MATERIALIZED (SELECT * FROM desi WHERE o_orderstatus = 'F'),\n"
    + nearest("e_done", "hub", "done", "desi")
    + ",\ntwo AS MATERIALIZED (SELECT *, 'r1' AS revision FROM edges UNION ALL SELECT *, 'r2' FROM e_done)"
)


@register(
    query(
        _TWO,
        f"""SELECT count(*) AS rows, CAST(2 AS SMALLINT) AS version_low, CAST(2 AS SMALLINT) AS version_high, '{HUB_SOURCE}' AS source_low,
 '{HUB_SOURCE}' AS source_high, 'r1' AS revision_low, 'r1' AS revision_high, 0::BIGINT AS nulls FROM two""",
    )
)
def index_singletons(spark, sf):
    one = layout.singletons(_two_revisions(spark, sf))
    return one.select(
        "rows",
        F.col("index_schema_version_low").alias("version_low"),
        F.col("index_schema_version_high").alias("version_high"),
        F.col("anchor_source_low").alias("source_low"),
        F.col("anchor_source_high").alias("source_high"),
        F.col("anchor_revision_low").alias("revision_low"),
        F.col("anchor_revision_high").alias("revision_high"),
        (F.col("anchor_source_nulls") + F.col("anchor_revision_nulls")).alias("nulls"),
    )


@register(query(_TWO, "SELECT source AS partner_source, min(revision) AS revision_low, max(revision) AS revision_high FROM two GROUP BY source"))
def index_source_revisions(spark, sf):
    return layout.source_revisions(_two_revisions(spark, sf))


@register(
    query(
        _TWO,
        """SELECT CAST(norder AS TINYINT) AS anchor_order, npix AS anchor_pixel, anchor_id, source AS partner_source, min(partner_id) AS id_low, max(partner_id) AS id_high
 FROM two GROUP BY ALL HAVING min(partner_id) <> max(partner_id)""".replace("GROUP BY ALL", "GROUP BY norder, npix, anchor_id, source"),
    )
)
def index_partner_conflicts(spark, sf):
    return layout.partner_conflicts(_two_revisions(spark, sf))


@register(
    query(
        _TWO,
        """SELECT CAST(norder AS TINYINT) AS anchor_order, npix AS anchor_pixel, anchor_id, source AS partner_source
 FROM two GROUP BY norder, npix, anchor_id, source HAVING count(DISTINCT (partner_id, revision)) > 1""",
    )
)
def index_block_conflicts(spark, sf):
    return layout.block_conflicts(_two_revisions(spark, sf))


# -------------------------------------------------------------------------------- star

_HUB_FIELDS = """c_acctbal / 10000 AS ebv, c_acctbal AS flux_g, c_acctbal + 1 AS flux_r, c_acctbal + 2 AS flux_z,
 CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal / 5000 END AS z_spec, c_acctbal AS fiberflux_g, c_acctbal * 2 AS fiberflux_r, c_acctbal * 3 AS fiberflux_z,
 CASE WHEN c_acctbal > 0 THEN c_acctbal END AS psfdepth_g, CASE WHEN c_acctbal - 100 > 0 THEN c_acctbal - 100 END AS psfdepth_r,
 CASE WHEN c_acctbal - 200 > 0 THEN c_acctbal - 200 END AS psfdepth_z,
 CASE WHEN c_acctbal / 1000 > 0 AND c_acctbal / 1000 < 5 THEN c_acctbal / 1000 END AS psf_des_g,
 CASE WHEN c_custkey % 7 > 0 AND c_custkey % 7 < 5 THEN CAST(c_custkey % 7 AS DOUBLE) END AS psf_des_r,
 CASE WHEN c_mktsegment = 'BUILDING' THEN 1.1::DOUBLE END AS psf_building"""
_DESI_FIELDS = """CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS spectrum_first, o_totalprice / 100000 AS Z, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 1e7 END AS ZERR,
 CASE o_orderstatus WHEN 'P' THEN TRUE WHEN 'F' THEN FALSE END AS ZWARN"""
_SDSS_WARN = "CASE WHEN event_id % 4 <> 0 THEN event_type = 'click' END"
_SDSS_FIELDS = f"""1 + CAST(CAST(value - 50 AS FLOAT) > 0 AS INT) + CAST(CAST(-value AS FLOAT) > 0 AS INT) AS sdss_samples,
 CASE WHEN NOT coalesce({_SDSS_WARN}, FALSE) AND (value - 20) / 100 >= 0 THEN (value - 20) / 100 END AS sdss_Z, value / 1000 AS sdss_Z_ERR, {_SDSS_WARN} AS sdss_ZWARNING"""
_PROVABGS_FIELDS = """CASE WHEN s_suppkey > 3 AND s_acctbal / 500 > 0 AND s_acctbal / 500 < 15 THEN s_acctbal / 500 END AS provabgs_LOG_MSTAR,
 CASE WHEN s_suppkey > 3 AND s_acctbal / 4000 >= 0 AND s_acctbal / 4000 < 2 THEN s_acctbal / 4000 END AS provabgs_Z_HP,
 CASE WHEN s_suppkey > 3 AND s_acctbal / 80000 >= 0 AND s_acctbal / 80000 < 0.1::DOUBLE THEN s_acctbal / 80000 END AS provabgs_Z_MW,
 CASE WHEN s_suppkey > 3 AND s_acctbal / 600 >= 0 AND s_acctbal / 600 <= 14 THEN s_acctbal / 600 END AS provabgs_TAGE_MW,
 CASE WHEN s_suppkey > 3 AND s_acctbal >= 0 AND s_acctbal < 1e4 THEN s_acctbal END AS provabgs_AVG_SFR"""
_FIELDS = {"desi": _DESI_FIELDS, "sdss": _SDSS_FIELDS, "provabgs": _PROVABGS_FIELDS}
_FIELD_NAMES = {
    "desi": ["spectrum_first", "Z", "ZERR", "ZWARN"],
    "sdss": ["sdss_samples", "sdss_Z", "sdss_Z_ERR", "sdss_ZWARNING"],
    "provabgs": [f"provabgs_{n}" for n in adapt.PROVABGS_RANGES],
}
_HUB_NAMES = (
    ["ebv", "flux_g", "flux_r", "flux_z", "z_spec", "fiberflux_g", "fiberflux_r", "fiberflux_z"]
    + ["psfdepth_g", "psfdepth_r", "psfdepth_z", "psf_des_g", "psf_des_r", "psf_building"]
)


def _flat(records: DataFrame) -> list[Column]:
    """Record fields as scalars: first flux of the spectra, sizes, known bands."""
    first = records.columns
    out = [F.col(c) for c in _HUB_NAMES if c in first]
    if "psf_fwhm" in first:
        for band, name in (("des-g", "psf_des_g"), ("des-r", "psf_des_r"), ("BUILDING", "psf_building")):
            out.append(F.try_element_at("psf_fwhm", F.lit(band)).alias(name))
    if "spectrum" in first:
        out.append(F.col("spectrum.flux")[0].cast("double").alias("spectrum_first"))
    if "sdss_spectrum" in first:
        out.append(F.when(F.col("sdss_spectrum").isNotNull(), F.size("sdss_spectrum.flux")).alias("sdss_samples"))
    named = [n for s in SOURCES for n in _FIELD_NAMES[s] if n not in ("spectrum_first", "sdss_samples")]
    return out + [F.col(n) for n in named if n in first]


def _with_ranks(df: DataFrame, sf: str) -> DataFrame:
    """Number the anchor cells in catalog order (a permuted epoch is not SQL)."""
    spark = df.sparkSession
    ranked = number_rows(_cells(spark, sf), [], ["norder"], "npix", into="cell_rank")
    return df.join(ranked.withColumn("cell_rank", F.col("cell_rank").cast("int")), ["norder", "npix"])


_RANKS = "ranks AS MATERIALIZED (SELECT norder, npix, CAST(row_number() OVER (ORDER BY norder, npix) - 1 AS INT) AS cell_rank FROM (SELECT DISTINCT norder, npix FROM hub))"

_ATTACHED = STAR + ",\n" + ",\n".join(
    f"a_{s} AS (SELECT e.anchor_id, {_FIELDS[s]} FROM e_{s} e JOIN {s} USING (partner_id))" for s in SOURCES
)


@register(
    query(
        _ATTACHED,
        f"""SELECT object_id, ra, dec, _healpix_29, {_HUB_FIELDS}, {', '.join(n for s in SOURCES for n in _FIELD_NAMES[s])}
 FROM hub LEFT JOIN a_desi ON a_desi.anchor_id = object_id LEFT JOIN a_sdss ON a_sdss.anchor_id = object_id LEFT JOIN a_provabgs ON a_provabgs.anchor_id = object_id""",
    )
)
def star_left_attach(spark, sf):
    """Every customer with its nearest order, event and supplier attached."""
    index = sky.index(spark, sf)
    records = star.attach(
        sky.hub(spark, sf).withColumn("cell_rank", F.lit(0)),
        sky.hub_reader(),
        index.edges,
        index.partner_cells,
        sky.spokes(spark, sf),
    )
    return records.select("object_id", "ra", "dec", "_healpix_29", *_flat(records))


@register(query(STAR, "SELECT partner_id, o_totalprice / 100000 AS redshift FROM desi WHERE partner_id IN (SELECT partner_id FROM e_desi)"))
def spoke_semi(spark, sf):
    keyed = sky.spoke(spark, sf, "desi").keyed()
    wanted = sky.index(spark, sf).of_source("desi").select("partner_id")
    return keyed.join(wanted, "partner_id", "left_semi").select("partner_id", F.col("Z").alias("redshift"))


@register(query(STAR, f"SELECT 'desi:' || partner_id AS object_id, ra, dec, {_DESI_FIELDS} FROM desi WHERE partner_id NOT IN (SELECT partner_id FROM e_desi)"))
def spoke_anti_unmatched(spark, sf):
    """Orders no customer was matched to, as records of their own."""
    source = sky.spoke(spark, sf, "desi")
    cells = source.rows.select(F.col("norder").alias("partner_norder"), F.col("npix").alias("partner_npix")).distinct()
    owners = cells.select(F.lit("desi").alias("source"), "*", F.lit(0).alias("cell_rank"))
    records = star.unmatched(source, "desi", sky.index(spark, sf).matched_ids(), owners)
    return records.select("object_id", "ra", "dec", *_flat(records))


def _path(source: str) -> str:
    return f"'{source}/Norder={sky.SPOKES[source][0]}/Npix=' || partner_npix || '.parquet'"


_REFS = (
    STAR
    + ",\nrefs AS MATERIALIZED ("
    + " UNION ALL ".join(
        f"SELECT DISTINCT norder, npix, source, partner_norder, partner_npix, {_path(s)} AS path FROM e_{s}" for s in SOURCES
    )
    + ")"
)


def _owner_sql(name: str, refs: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT norder, npix, source, partner_norder, partner_npix, path FROM (SELECT *,
 row_number() OVER (PARTITION BY path ORDER BY norder, npix) - 1 AS place, count(*) OVER (PARTITION BY path) AS n FROM {refs})
 WHERE place = {oracle.crc32('path')} % n)"""


_GRAPH_OWNERS = (
    _REFS
    + f",\nsplits AS MATERIALIZED (SELECT norder, npix, {oracle.split('norder', 'npix')} AS split FROM (SELECT norder, npix FROM refs UNION SELECT partner_norder, partner_npix FROM refs UNION SELECT norder, npix FROM hub))"
    + """,\nin_train AS (SELECT r.* FROM refs r JOIN splits a ON (r.norder, r.npix) = (a.norder, a.npix)
 JOIN splits b ON (r.partner_norder, r.partner_npix) = (b.norder, b.npix) WHERE a.split = 'train' AND b.split = 'train' AND source IN ('desi', 'sdss'))"""
    + ",\n"
    + _owner_sql("owners", "in_train")
)
_OWNER_COLUMNS = "CAST(norder AS TINYINT) AS norder, npix, source, CAST(partner_norder AS TINYINT) AS partner_norder, partner_npix, path"


def _refs(spark, sf) -> DataFrame:
    return references(sky.index(spark, sf).partner_cells, sky.listings(spark, sf))


_OWNER_NAMES = ["norder", "npix", "source", "partner_norder", "partner_npix", "path"]


@register(query(_GRAPH_OWNERS, f"SELECT {_OWNER_COLUMNS} FROM owners"))
def partition_owner_graph(spark, sf):
    return graph_owners(_refs(spark, sf), "train", ["desi", "sdss"]).select(*_OWNER_NAMES)


@register(query(_REFS + ",\n" + _owner_sql("owners", "(SELECT * FROM refs WHERE source = 'desi')"), f"SELECT {_OWNER_COLUMNS} FROM owners"))
def partition_owner_pair(spark, sf):
    return pair_owners(_refs(spark, sf).where("source = 'desi'")).select(*_OWNER_NAMES)


@register(
    query(
        _REFS,
        """SELECT source, path, count(*) AS cells, min(norder || '/' || lpad(CAST(npix AS VARCHAR), 6, '0')) AS first_cell FROM refs GROUP BY source, path""",
    )
)
def partition_references(spark, sf):
    """How many anchor cells read each partner partition."""
    cell = F.concat_ws("/", "norder", F.lpad(F.col("npix").cast("string"), 6, "0"))
    return _refs(spark, sf).groupBy("source", "path").agg(F.count("*").alias("cells"), F.min(cell).alias("first_cell"))


def _train_stream(spark, sf) -> Stream:
    """The train epoch of the derived sky, in the cells' own order; pages plan their leading cells only."""
    index = sky.index(spark, sf)
    ranked = cut_lineage(_with_ranks(plan.hash_split(index.anchor_cells, "train").select("norder", "npix"), sf))
    refs = cut_lineage(_refs(spark, sf))
    owners = cut_lineage(_with_ranks(graph_owners(refs, "train", ["desi", "sdss"]), sf))
    edges = cut_lineage(index.edges.join(ranked, ["norder", "npix"], "left_semi"))
    all_spokes = sky.spokes(spark, sf)
    star.refuse_duplicates(star.lookups(edges, index.partner_cells, star.narrow_ids(all_spokes)))

    def own(chosen) -> DataFrame:
        cells = spark.createDataFrame([(c[0], c[1], c[3]) for c in chosen], "norder tinyint, npix bigint, cell_rank int")
        return plan.small(cells, len(chosen))

    def assemble(chosen) -> DataFrame:
        here = own(chosen).drop("cell_rank")
        return star.assemble(
            sky.hub(spark, sf).join(own(chosen), ["norder", "npix"]),
            sky.hub_reader(),
            edges.join(here, ["norder", "npix"], "left_semi"),
            index.partner_cells.join(here, ["norder", "npix"], "left_semi"),
            all_spokes,
            all_spokes,
            index.matched_ids(),
            owners.join(here, ["norder", "npix"], "left_semi").select("source", "partner_norder", "partner_npix", "cell_rank"),
            check=False,
        )

    def at_least(chosen) -> int:
        return sky.hub(spark, sf).join(own(chosen), ["norder", "npix"], "left_semi").count()

    rows = sorted(ranked.collect(), key=lambda r: r["cell_rank"])
    cells = tuple((r["norder"], r["npix"], "", r["cell_rank"]) for r in rows)
    return Stream(spark, assemble, at_least, star.ORDER, cells, {"sky": sf})


def _train_records(spark, sf) -> DataFrame:
    return _train_stream(spark, sf).records


_TRAIN = (
    _GRAPH_OWNERS
    + ",\n"
    + _RANKS
    + """,\nindexed AS (SELECT DISTINCT norder, npix FROM edges), train_hub AS (SELECT h.*, cell_rank FROM hub h JOIN ranks USING (norder, npix)
 JOIN splits USING (norder, npix) SEMI JOIN indexed USING (norder, npix) WHERE split = 'train')"""
    + ",\nrecords AS MATERIALIZED (SELECT cell_rank, 1 AS phase, '' AS source, norder AS part_order, npix AS part_pixel, row_index, object_id, ra, dec FROM train_hub"
    + "".join(
        f"""\n UNION ALL SELECT r.cell_rank, 0, '{s}', s.norder, s.npix, s.row_index, '{s}:' || s.partner_id, s.ra, s.dec FROM {s} s
 JOIN owners o ON o.source = '{s}' AND (o.partner_norder, o.partner_npix) = (s.norder, s.npix) JOIN ranks r ON (r.norder, r.npix) = (o.norder, o.npix)
 WHERE s.partner_id NOT IN (SELECT partner_id FROM e_{s})"""
        for s in ("desi", "sdss")
    )
    + ")"
)
_RECORD_NAMES = [*star.ORDER, "object_id", "ra", "dec"]


@register(query(_TRAIN, f"SELECT {', '.join(_RECORD_NAMES)} FROM records"))
def hub_plus_unmatched(spark, sf):
    """The train stream: anchors of indexed cells and each unmatched spoke row once."""
    return _train_records(spark, sf).select(*_RECORD_NAMES)


_AFTER = "(cell_rank, phase, source, part_order, part_pixel, row_index)"


@register(query(_TRAIN, f"SELECT object_id, cell_rank, phase FROM records WHERE {_AFTER} > (40, 1, '', 4, 0, 0) ORDER BY {_AFTER} LIMIT 500"))
def stream_page(spark, sf):
    """A page of 500 records behind a stored position: the leading cells are planned, top-k of their records."""
    page = _train_stream(spark, sf).after((40, 1, "", 4, 0, 0)).page(500)
    return page.select("object_id", "cell_rank", "phase")


@register(query(_TRAIN, f"SELECT object_id, cell_rank, row_number() OVER (PARTITION BY cell_rank ORDER BY phase, source, part_order, part_pixel, row_index) - 1 AS place FROM records"))
def stream_positions(spark, sf):
    """Each record's place in its cell, numbered block by block."""
    records = _train_records(spark, sf).select(*star.ORDER, "object_id")
    numbered = number_rows(
        records, ["cell_rank"], ["phase", "source", "part_order", "part_pixel"], "row_index", into="place"
    )
    return numbered.select("object_id", "cell_rank", "place")


def _later_catalog(spark, sf) -> Spoke:
    """The order catalog of a later revision, without the open orders."""
    rows = sky.desi(spark, sf).where("o_orderstatus <> 'O'")
    adapter = sky.adapters()["desi"]
    return Spoke(adapter, rows.drop("o_orderstatus"))


@register(query(STAR, "SELECT CAST(e.norder AS TINYINT) AS norder, e.npix, anchor_id, source, partner_id FROM e_desi e JOIN desi s USING (partner_id) WHERE o_orderstatus = 'O'"))
def missing_partner_report(spark, sf):
    """Index and catalog revision disagree: which edges point to nothing."""
    index = sky.index(spark, sf)
    edges = index.of_source("desi")
    ids_ = star.narrow_ids({"desi": _later_catalog(spark, sf)})
    return star.missing_partners(edges, star.lookups(edges, index.partner_cells, ids_)).select(
        "norder", "npix", "anchor_id", "source", "partner_id"
    )


@register(
    query(
        STAR,
        """SELECT CAST(norder AS TINYINT) AS norder, npix, source, partner_id, count(*) AS copies FROM e_desi e
 JOIN lineitem ON partner_id = 'o' || l_orderkey GROUP BY norder, npix, source, partner_id HAVING count(*) > 1""",
    )
)
def duplicate_partner_report(spark, sf):
    """A spoke with one row per order line repeats its ids: which needed ones."""
    edges = sky.index(spark, sf).of_source("desi")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("o"), "l_orderkey").alias("partner_id"))
    lines = among(lines, edges)  # lines that no edge points to are not located
    located = sky.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    order, size = sky.SPOKES["desi"]
    placed = sky.placed(
        lines.join(located, "o_orderkey"), sky.observed_position(F.col("o_custkey"), F.col("o_orderkey"), size), order
    )
    rows = placed.select(
        F.lit("desi").alias("source"),
        F.col("norder").alias("partner_norder"),
        F.col("npix").alias("partner_npix"),
        "partner_id",
    )
    return star.duplicate_partners(star.lookups(edges, sky.index(spark, sf).partner_cells, rows))


# -------------------------------------------------------------------------------- pair


def _pair_inputs(spark, sf):
    index = sky.index(spark, sf)
    edges = index.of_source("desi")
    cells = index.partner_cells.where("source = 'desi'").drop("source")
    return edges, cells


@register(
    query(
        PAIR,
        """SELECT h.object_id, s.partner_id, s.o_totalprice / 100000 AS redshift FROM hub h LEFT JOIN e_desi e ON e.anchor_id = h.object_id
 LEFT JOIN (SELECT * FROM desi WHERE o_orderstatus <> 'O') s ON s.partner_id = e.partner_id WHERE e.anchor_id IS NULL OR s.partner_id IS NOT NULL""",
    )
)
def pair_join(spark, sf):
    """Indexed anchors whose partner is gone are dropped; never indexed ones stay."""
    edges, cells = _pair_inputs(spark, sf)
    joined = pair.join_pairs(sky.hub(spark, sf), edges, cells, _later_catalog(spark, sf).rows)
    return joined.select(
        "object_id", F.col("partner.object_id").alias("partner_id"), F.col("partner.Z").alias("redshift")
    )


_SLOTS = (
    _REFS
    + ",\n"
    + _owner_sql("owners", "(SELECT * FROM refs WHERE source = 'desi')")
    + ",\n"
    + _RANKS
    + """,\nlone AS (SELECT o.norder, o.npix, s.partner_id, s.ra, s.dec, s.o_totalprice, s.o_orderkey, s.o_orderstatus,
 row_number() OVER (PARTITION BY o.norder, o.npix ORDER BY s.norder, s.npix, s.row_index) - 1 AS item, count(*) OVER (PARTITION BY o.norder, o.npix) AS u
 FROM desi s JOIN owners o ON (o.partner_norder, o.partner_npix) = (s.norder, s.npix) WHERE s.partner_id NOT IN (SELECT partner_id FROM e_desi)),
images AS (SELECT norder, npix, count(*) AS n FROM hub GROUP BY norder, npix),
slots AS MATERIALIZED (SELECT l.*, least(item * greatest(1, coalesce(n, 0) // u), coalesce(n, 0)) AS slot FROM lone l LEFT JOIN images USING (norder, npix))"""
)


def _pair_owners(spark, sf) -> DataFrame:
    owners = pair_owners(_refs(spark, sf).where("source = 'desi'"))
    return _with_ranks(owners, sf).select("partner_norder", "partner_npix", "norder", "npix", "cell_rank")


@register(query(_SLOTS, "SELECT CAST(norder AS TINYINT) AS norder, npix, partner_id, item, slot FROM slots"))
def pair_interleave(spark, sf):
    """Where the unmatched orders of a cell stand between its customers."""
    edges, _ = _pair_inputs(spark, sf)
    alone = pair.unmatched_spectra(sky.spoke(spark, sf, "desi").rows, edges, _pair_owners(spark, sf))
    counts = sky.hub(spark, sf).groupBy("norder", "npix").agg(F.count("*").alias("rows"))
    return pair.interleave_slots(alone, counts).select("norder", "npix", "partner_id", "item", "slot")


@register(
    query(
        _SLOTS,
        f"""SELECT cell_rank, slot, phase, item, object_id, Z, ZERR, ZWARN, ebv FROM (
 SELECT cell_rank, slot, 0 AS phase, item, partner_id AS object_id, o_totalprice / 100000 AS Z, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 1e7 END AS ZERR,
 CASE o_orderstatus WHEN 'P' THEN TRUE WHEN 'F' THEN FALSE END AS ZWARN, NULL::DOUBLE AS ebv FROM slots JOIN ranks USING (norder, npix)
 UNION ALL SELECT cell_rank, place, 1, place, object_id, Z, ZERR, ZWARN, c_acctbal / 10000 FROM
 (SELECT h.*, row_number() OVER (PARTITION BY norder, npix ORDER BY row_index) - 1 AS place FROM hub h) JOIN ranks USING (norder, npix)
 LEFT JOIN (SELECT anchor_id, {_DESI_FIELDS} FROM e_desi JOIN desi USING (partner_id)) ON anchor_id = object_id)""",
    )
)
def pair_records(spark, sf):
    """The single-spoke stream with its interleaved order."""
    edges, cells = _pair_inputs(spark, sf)
    hub = number_rows(sky.hub(spark, sf), ["norder", "npix"], [], "row_index", into="at")
    hub = hub.drop("row_index").withColumnRenamed("at", "row_index")
    records = pair.pair_records(
        _with_ranks(hub, sf),
        edges,
        cells,
        sky.spoke(spark, sf, "desi").rows,
        edges,
        _pair_owners(spark, sf),
        sky.hub(spark, sf).groupBy("norder", "npix").agg(F.count("*").alias("rows")),
        image_shape=sky.HUB_SHAPE,
    )
    return records.select(*pair.ORDER, "object_id", "Z", "ZERR", "ZWARN", "ebv")


# ------------------------------------------------------------------- cells and shards


def _cells(spark, sf) -> DataFrame:
    return sky.hub(spark, sf).select("norder", "npix").distinct()


_CELLS = HUB + ",\ncells AS MATERIALIZED (SELECT DISTINCT CAST(norder AS TINYINT) AS norder, npix FROM hub)"


@register(query(_CELLS, f"SELECT norder, npix, {oracle.split('norder', 'npix')} AS split FROM cells"))
def split_by_crc(spark, sf):
    parts = [plan.hash_split(_cells(spark, sf), s).withColumn("split", F.lit(s)) for s in plan.SPLITS]
    return parts[0].unionByName(parts[1])


@register(
    query(
        _CELLS,
        """SELECT norder, npix, CASE WHEN place <= least(8, greatest(1, n // 5)) THEN 'val' ELSE 'train' END AS split FROM
 (SELECT *, row_number() OVER (ORDER BY norder, npix) AS place, count(*) OVER () AS n FROM cells)""",
    )
)
def positional_split(spark, sf):
    parts = [plan.positional_split(_cells(spark, sf), s).withColumn("split", F.lit(s)) for s in plan.SPLITS]
    return parts[0].unionByName(parts[1])


@register(
    query(
        _CELLS,
        """SELECT 'cell' AS kind, norder, npix AS at, 1::BIGINT AS n FROM cells
 UNION ALL SELECT 'rank', NULL, row_number() OVER () - 1, 1 FROM cells""",
    )
)
def permute_cells(spark, sf):
    """All cells in a seeded order: every cell once and every rank once; tests list the order itself."""
    ranked = cut_lineage(plan.permute_cells(_cells(spark, sf), seed=7, epoch=0))
    cells = ranked.groupBy("norder", F.col("npix").alias("at")).agg(F.count("*").alias("n"))
    ranks = ranked.groupBy(F.col("cell_rank").cast("long").alias("at")).agg(F.count("*").alias("n"))
    cells = cells.select(F.lit("cell").alias("kind"), "norder", "at", "n")
    return cells.unionByName(ranks.select(F.lit("rank").alias("kind"), F.lit(None).cast("tinyint").alias("norder"), "at", "n"))


@register(
    query(
        _CELLS,
        "SELECT norder, npix, CAST(place - 1 AS INT) AS cell_rank, CAST((place - 1) % 8 AS INT) AS shard FROM (SELECT *, row_number() OVER (ORDER BY norder, npix) AS place FROM cells)",
    )
)
def deal_ranks(spark, sf):
    """Eight ranks, each with its round-robin share."""
    ranked = _with_ranks(_cells(spark, sf), sf)
    deals = [plan.deal_cells(ranked, i, 8).withColumn("shard", F.lit(i)) for i in range(8)]
    result = deals[0]
    for deal in deals[1:]:
        result = result.unionByName(deal)
    return result


# --------------------------------------------------------------- ids and quality rules


@register(
    """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS plain, CAST(p_partkey AS VARCHAR) AS from_bytes, p_name AS padded,
 '  ' || p_brand || ' ' AS kept, 'it''s ' || p_partkey AS escaped FROM part"""
)
def normalize_ids(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("b'    "), "p_partkey", F.lit("'")).alias("literal"),
        F.concat(F.lit("  "), "p_partkey", F.lit(" \t")).cast("binary").alias("bytes"),
        F.concat(F.lit(" \t\n"), "p_name", F.lit("  ")).alias("text"),
        F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("raw"),
        F.concat(F.lit("b'it\\'s \\x"), F.hex(F.substring(F.col("p_partkey").cast("string"), 1, 1)), F.substring(F.col("p_partkey").cast("string"), 2, 20), F.lit("'")).alias("escape"),
    )
    return part.select(
        "p_partkey",
        ids.normalize_id(part, "literal", True).alias("plain"),
        ids.normalize_id(part, "bytes", True).alias("from_bytes"),
        ids.normalize_id(part, "text", True).alias("padded"),
        ids.normalize_id(part, "raw", False).alias("kept"),
        ids.normalize_id(part, "escape", True).alias("escaped"),
    )


@register(
    """SELECT event_id, CASE WHEN isfinite(v) THEN v END AS finite, CASE WHEN isfinite(v) AND v > 0 AND v < 30 THEN v END AS in_range,
 CASE WHEN isfinite(v) AND v IN (0.0, 1.0) THEN v END AS zero_or_one FROM
 (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN NULL WHEN 3 THEN CAST(user_id % 2 AS DOUBLE) ELSE value END AS v FROM events)"""
)
def finite_range_predicates(spark, sf):
    """NaN, infinity and NULL are none of them in range."""
    kind = F.col("event_id") % 5
    v = (
        F.when(kind == 0, F.lit(float("nan")))
        .when(kind == 1, F.lit(float("inf")))
        .when(kind == 3, (F.col("user_id") % 2).cast("double"))
        .when(kind == 4, F.col("value"))
    )
    events = table(spark, sf, "events").select("event_id", v.alias("v"))
    return events.select(
        "event_id",
        numeric.keep_if(F.col("v")).alias("finite"),
        numeric.keep_if(F.col("v"), numeric.between(0, 30, low_open=True, high_open=True)).alias("in_range"),
        numeric.keep_if(F.col("v"), lambda x: x.isin(0.0, 1.0)).alias("zero_or_one"),
    )


@register(query(HUB, f"SELECT object_id, {_HUB_FIELDS} FROM hub"))
def hub_quality_fields(spark, sf):
    held, fields = adapt.with_fields(sky.hub(spark, sf), sky.hub_reader().outputs, "_f")
    records = held.select("object_id", *fields)
    return records.select("object_id", *_flat(records))


def _adapter_rows(spark, sf, source) -> DataFrame:
    keyed = sky.spoke(spark, sf, source).keyed()
    held, fields = adapt.with_fields(keyed, sky.adapters()[source].outputs, "_f")
    records = held.select("partner_id", *fields)
    return records.select("partner_id", *_flat(records))


@register(query(spoke("desi"), f"SELECT partner_id, {_DESI_FIELDS} FROM desi"))
def desi_adapter(spark, sf):
    return _adapter_rows(spark, sf, "desi")


@register(query(spoke("sdss"), f"SELECT partner_id, {_SDSS_FIELDS} FROM sdss"))
def sdss_adapter(spark, sf):
    """Samples with wavelength ≤ 0 leave all three arrays."""
    return _adapter_rows(spark, sf, "sdss")


@register(query(spoke("provabgs"), f"SELECT partner_id, {_PROVABGS_FIELDS} FROM provabgs"))
def provabgs_adapter(spark, sf):
    return _adapter_rows(spark, sf, "provabgs")


def _mag(i: int) -> str:
    return f"(l_quantity + {i} * 5)"


_HSC = ", ".join(
    [
        f"CASE WHEN {_mag(i)} > 10 AND {_mag(i)} < 30 AND l_discount + {i} * l_tax < 0.1::DOUBLE THEN {_mag(i)} END AS hsc_{b}_cmodel_mag"
        for i, b in enumerate(adapt.HSC_BANDS)
    ]
    + ["CASE WHEN l_linenumber - 1 IN (0, 1) THEN CAST(l_linenumber - 1 AS DOUBLE) END AS hsc_extendedness"]
    + [
        f"CASE WHEN l_partkey % 3 <> {i} THEN l_extendedprice * {k} END AS hsc_i_sdssshape_{kind}{m}"
        for i, m in enumerate(adapt.HSC_MOMENTS)
        for k, kind in ((1, "shape"), (2, "psf_shape"))
    ]
)


@register(f"SELECT l_orderkey, l_linenumber, {_HSC} FROM lineitem")
def hsc_adapter(spark, sf):
    """Magnitudes count only with a small error, which is not kept itself."""
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    columns = {f"{b}_cmodel_mag": quantity + i * 5 for i, b in enumerate(adapt.HSC_BANDS)}
    columns |= {f"{b}_cmodel_magerr": F.col("l_discount") + i * F.col("l_tax") for i, b in enumerate(adapt.HSC_BANDS)}
    columns["i_extendedness_value"] = (F.col("l_linenumber") - 1).cast("double")
    for i, m in enumerate(adapt.HSC_MOMENTS):
        shown = F.col("l_partkey") % 3 != i
        columns[f"i_sdssshape_shape{m}"] = F.when(shown, price)
        columns[f"i_sdssshape_psf_shape{m}"] = F.when(shown, price * 2).otherwise(F.lit(float("nan")))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in columns.items()])
    return rows.select("l_orderkey", "l_linenumber", *adapt.hsc_scalars(rows))


def _answer(i: int) -> str:
    return f"((l_quantity * {i + 1} % 60) / 50 - 0.1::DOUBLE)"


@register(
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f'CASE WHEN {_answer(i)} >= 0 AND {_answer(i)} <= 1 THEN {_answer(i)} END AS "gwh_{n}"'
        for i, n in enumerate(adapt.MORPHOLOGY_FIELDS)
    )
    + " FROM lineitem"
)
def galaxies_adapter(spark, sf):
    """34 vote fractions, each kept only within [0, 1]."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *[
            ((F.col("l_quantity") * (i + 1) % 60) / 50 - F.lit(0.1)).alias(n)
            for i, n in enumerate(adapt.MORPHOLOGY_FIELDS)
        ],
    )
    return rows.select("l_orderkey", "l_linenumber", *adapt.morphology_outputs(rows))


@register(
    """SELECT l_orderkey, l_linenumber, k AS band, max_by(v, i) AS seeing FROM (SELECT l_orderkey, l_linenumber, unnest([l_returnflag, l_linestatus, 'A']) AS k,
 unnest([l_quantity / 10, l_tax * 50, l_discount * 40]) AS v, unnest([1, 2, 3]) AS i, n FROM (SELECT *, row_number() OVER () AS n FROM lineitem)) WHERE v > 0 AND v < 5 GROUP BY l_orderkey, l_linenumber, n, k"""
)
def band_keyed_map(spark, sf):
    """Values keyed by band name; of equal bands the last valid one stays."""
    bands = F.array("l_returnflag", "l_linestatus", F.lit("A"))
    values = F.array(F.col("l_quantity") / 10, F.col("l_tax") * 50, F.col("l_discount") * 40)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.explode(arrays.band_map(bands, values, 0.0, 5.0)).alias("band", "seeing")
    )


@register("SELECT vec_id, len(embedding) = 64 AS dense, label % 2 = 0 AS cube FROM embeddings")
def shape_check(spark, sf):
    """A 4×4×4 cube passes, a ragged one does not."""
    rows = table(spark, sf, "embeddings")
    sizes = F.sequence(F.lit(0), F.lit(3))
    flat = F.col("embedding")
    plane = F.transform(
        sizes,
        lambda i: F.transform(sizes, lambda j: F.slice(flat, i * 16 + j * 4 + 1, F.when(F.col("label") % 2 == 0, 4).otherwise(4 - (i == 3).cast("int")))),
    )
    return rows.select(
        "vec_id", arrays.has_shape(flat, (64,)).alias("dense"), arrays.has_shape(plane, (4, 4, 4)).alias("cube")
    )


@register("SELECT o_orderkey, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS first, CAST(CAST(4001.0 AS FLOAT) AS DOUBLE) AS last_wavelength, o_totalprice > 100000 AS masked FROM orders")
def nested_projection(spark, sf):
    """Leaves of a written struct column: the parquet scan reads no other leaf."""
    path = scratch_path(spark, "spectra")
    sky.desi(spark, sf).select(F.col("row_index").alias("o_orderkey"), "spectrum").write.parquet(path)
    part = arrays.spectrum_part(F.col("spectrum"))
    rows = spark.read.parquet(path).select("o_orderkey", part.alias("part"))
    return rows.select(
        "o_orderkey",
        F.col("part.flux")[0].cast("double").alias("first"),
        F.col("part.lambda")[1].cast("double").alias("last_wavelength"),
        F.col("part.mask")[0].alias("masked"),
    )


@register("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_match_map(spark, sf):
    """Invalid JSON fails the query."""
    parsed = F.from_json("props", "map<string,bigint>", {"mode": "FAILFAST"})
    return table(spark, sf, "events").select("event_id", F.try_element_at(parsed, F.lit("k")).alias("k"))


@register("SELECT doc_id, lang, source, NULL::INT AS quality, NULL::INT AS toxic FROM documents UNION ALL BY NAME SELECT doc_id, quality, toxic FROM labels")
def union_missing_columns(spark, sf):
    """A catalog whose files have other columns, and another width of the id, is read as one table."""
    base = scratch_path(spark, "mixed")
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf, "labels").select(F.col("doc_id").cast("int").alias("doc_id"), "quality", "toxic")
    for number, part in enumerate((documents, labels)):
        part.write.parquet(f"{base}/Norder=0/Dir=0/Npix={number}.parquet")
    columns = ["doc_id", "lang", "source", "quality", "toxic"]
    return Catalog.open(spark, base).scan(columns).select(*columns)


# -------------------------------------------------------------------- files, end to end


@lru_cache(maxsize=64)
def _catalog_root(application: str, sf: str, name: str) -> str:
    """One catalog as files, written once per session."""
    spark = SparkSession.active()
    root = f"{scratch_path(spark, 'catalogs')}/{name}"
    write_catalog(sky.hub(spark, sf) if name == HUB_SOURCE else sky.ROWS[name](spark, sf).drop("o_orderstatus"), root)
    return root


def _catalogs(spark, sf, sources=SOURCES) -> Registry:
    """The anchor catalog and those of some sources."""
    registry = Registry(pinned=False)
    for name in (HUB_SOURCE, *sources):
        registry.register(name, _catalog_root(spark.sparkContext.applicationId, sf, name))
    return registry


@register(query(HUB, "SELECT CAST(norder AS TINYINT) AS norder, npix, count(*) AS rows FROM hub GROUP BY norder, npix"))
def catalog_listing(spark, sf):
    """Write a partitioned catalog, list its files, count rows from the footers."""
    registry = _catalogs(spark, sf, ())
    return registry.open(spark, HUB_SOURCE, "").row_counts().select("norder", "npix", "rows")


_FLOAT = "CAST(CAST(c_acctbal + {} AS FLOAT) AS DOUBLE)"
_PIXELS = f"3 * ({' + '.join(_FLOAT.format(k) for k in range(4))}) AS pixels"
_BY_RECORD = "".join(
    f"""\n LEFT JOIN (SELECT anchor_id AS object_id, {_FIELDS[s]} FROM e_{s} JOIN {s} USING (partner_id)
  UNION ALL SELECT '{s}:' || partner_id, {_FIELDS[s]} FROM {s}) USING (object_id)"""
    for s in SOURCES
)
_GRAPH_BODY = f"""SELECT r.object_id, phase, r.source, pixels, {', '.join(_HUB_NAMES)}, {', '.join(n for s in SOURCES for n in _FIELD_NAMES[s])} FROM records r
 LEFT JOIN (SELECT object_id, {_HUB_FIELDS}, {_PIXELS} FROM hub) USING (object_id){_BY_RECORD}"""


@register(query(_TRAIN, _GRAPH_BODY))
def open_stream_graph(spark, sf):
    """Catalog files and index on disk → one epoch of the train stream, with the fields of all sources and the sum of all pixels."""
    registry = _catalogs(spark, sf)
    stream = open_stream(spark, registry, seed=7, match_index=sky.index_path(spark, sf), image_shape=sky.HUB_SHAPE)
    flux = F.flatten(F.flatten("image.flux"))
    pixels = F.aggregate(flux, F.lit(0.0), lambda total, x: total + x).alias("pixels")
    return stream.records.select("object_id", "phase", "source", pixels, *_flat(stream.records))


@register(
    query(
        _REFS,
        f"""SELECT object_id, 1 AS phase, ebv, pixels, spectrum_first, Z, ZERR, ZWARN FROM (SELECT *, c_acctbal / 10000 AS ebv, {_PIXELS} FROM hub)
 SEMI JOIN e_desi USING (norder, npix) LEFT JOIN (SELECT anchor_id, {_DESI_FIELDS} FROM e_desi JOIN desi USING (partner_id)) ON anchor_id = object_id
 UNION ALL SELECT partner_id, 0, NULL, NULL, {_DESI_FIELDS} FROM desi s WHERE partner_id NOT IN (SELECT partner_id FROM e_desi)
 AND EXISTS (FROM refs r WHERE r.source = 'desi' AND (r.partner_norder, r.partner_npix) = (s.norder, s.npix))""",
    )
)
def open_stream_pair(spark, sf):
    """Train and validation of the single-spoke stream together: every image, and every lone spectrum once (its cell depends on file paths)."""
    registry, found = _catalogs(spark, sf, ("desi",)), None
    flux = F.flatten(F.flatten("image.flux"))
    pixels = F.aggregate(flux, F.lit(0.0), lambda total, x: total + x).alias("pixels")
    for split in plan.SPLITS:
        index = sky.source_index_path(spark, sf, "desi")
        records = open_stream(spark, registry, split=split, seed=7, match_index=index, image_shape=sky.HUB_SHAPE).records
        first = F.col("spectrum.flux")[0].cast("double").alias("spectrum_first")
        part = records.select("object_id", "phase", "ebv", pixels, first, "Z", "ZERR", "ZWARN")
        found = part if found is None else found.unionByName(part)
    return found


_HSC_SHAPE = (2, 2, 2)
_CUTOUT = " + ".join(f"CAST(CAST(o_totalprice + {k} AS FLOAT) AS DOUBLE)" for k in range(8))
_HSC_SQL = ", ".join(
    [f"CASE WHEN o_orderkey % 7 <> 0 THEN {_CUTOUT} END AS hsc_pixels"]
    + [
        f"CASE WHEN {m} > 10 AND {m} < 30 AND (o_orderkey % 5) * 0.03::DOUBLE + {i * 0.01!r}::DOUBLE < 0.1::DOUBLE THEN {m} END AS hsc_{b}_cmodel_mag"
        for i, b in enumerate(adapt.HSC_BANDS)
        for m in [f"(o_totalprice / 10000 + {2 * i})"]
    ]
    + ["CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey % 3 AS DOUBLE) END AS hsc_extendedness"]
    + [
        f"{value} AS hsc_i_sdssshape_{kind}{m}"
        for i, m in enumerate(adapt.HSC_MOMENTS)
        for kind, value in (("shape", f"o_totalprice * {i + 1}"), ("psf_shape", "CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END"))
    ]
)


def _vote(i: int) -> str:
    return f"((s_suppkey * {i + 1} % 60) / 50 - 0.1::DOUBLE)"


_VOTES_SQL = ", ".join(
    f'CASE WHEN {_vote(i)} >= 0 AND {_vote(i)} <= 1 THEN {_vote(i)} END AS "gwh_{n}"' for i, n in enumerate(adapt.MORPHOLOGY_FIELDS)
)


def _cutouts(spark, sf) -> DataFrame:
    """Orders as an imaging survey: cutouts, some missing, and magnitudes with errors."""
    key, price = F.col("row_index"), F.col("o_totalprice")
    rows = sky.desi(spark, sf).drop("spectrum", "ZERR", "ZWARN", "o_orderstatus")
    rows = rows.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_index"), "o_totalprice"), "row_index")
    plane = lambda k: F.array(F.array(price + k, price + k + 1), F.array(price + k + 2, price + k + 3))
    image = F.struct(F.array(plane(0), plane(4)).alias("flux"), F.array(F.lit("hsc-g"), F.lit("hsc-r")).alias("band"))
    columns = {"image": F.when(key % 7 != 0, image), "i_extendedness_value": (key % 3).cast("double")}
    for i, b in enumerate(adapt.HSC_BANDS):
        columns |= {f"{b}_cmodel_mag": price / 10000 + 2 * i, f"{b}_cmodel_magerr": (key % 5) * 0.03 + i * 0.01}
    for i, m in enumerate(adapt.HSC_MOMENTS):
        columns[f"i_sdssshape_shape{m}"] = price * (i + 1)
        columns[f"i_sdssshape_psf_shape{m}"] = F.when(key % 2 == 1, price).otherwise(F.lit(float("nan")))
    return rows.withColumns(columns).drop("o_totalprice", "Z")


def _votes(spark, sf) -> DataFrame:
    """Suppliers as classified galaxies, whose padded id is ``dr8_id``."""
    rows = sky.provabgs(spark, sf)
    key = F.col("row_index")
    votes = [((key * (i + 1) % 60) / 50 - F.lit(0.1)).alias(n) for i, n in enumerate(adapt.MORPHOLOGY_FIELDS)]
    name = F.concat(F.lit(" "), "object_id", F.lit(" ")).alias("dr8_id")
    return rows.select(name, "ra", "dec", "_healpix_29", "norder", "npix", "row_index", *votes)


_CUTOUT_SQL = query(
    STAR
    + f""",\nhsc_refs AS MATERIALIZED (SELECT DISTINCT partner_norder, partner_npix FROM e_desi WHERE {oracle.split('norder', 'npix')} = {oracle.split('partner_norder', 'partner_npix')}),
both_cells AS (SELECT norder, npix FROM e_desi UNION SELECT norder, npix FROM e_provabgs)""",
    f"""SELECT object_id, 1 AS phase, {_PIXELS}, a.* EXCLUDE (anchor_id), b.* EXCLUDE (anchor_id) FROM hub SEMI JOIN both_cells USING (norder, npix)
 LEFT JOIN (SELECT anchor_id, {_HSC_SQL} FROM e_desi JOIN desi USING (partner_id)) a ON a.anchor_id = object_id
 LEFT JOIN (SELECT anchor_id, {_VOTES_SQL} FROM e_provabgs JOIN provabgs USING (partner_id)) b ON b.anchor_id = object_id
 UNION ALL BY NAME SELECT 'hsc:' || partner_id AS object_id, 0 AS phase, {_HSC_SQL} FROM desi SEMI JOIN hsc_refs ON (partner_norder, partner_npix) = (norder, npix)
 WHERE partner_id NOT IN (SELECT partner_id FROM e_desi)""",
)


@register(_CUTOUT_SQL)
def open_stream_cutouts(spark, sf):
    """Imaging and classified spokes from files: cutouts and votes of every record of both splits; ids come from ``dr8_id``."""
    root, index = scratch_path(spark, "cutouts"), scratch_path(spark, "cutout_index")
    registry = _catalogs(spark, sf, ())
    for source, of, rows in (("hsc", "desi", _cutouts(spark, sf)), ("galaxies_votes", "provabgs", _votes(spark, sf))):
        write_catalog(rows, f"{root}/{source}")
        registry.register(source, f"{root}/{source}")
        edges = spark.read.parquet(sky.source_index_path(spark, sf, of))
        edges.withColumn("partner_source", F.lit(source)).write.parquet(f"{index}/{source}.parquet")
    total = lambda image: F.aggregate(F.flatten(F.flatten(image)), F.lit(0.0), lambda t, x: t + x)
    found = None
    for split in plan.SPLITS:
        records = open_stream(
            spark, registry, split=split, seed=7, match_index=index, image_shape=sky.HUB_SHAPE, adapters=adapt.spoke_adapters(_HSC_SHAPE)
        ).records
        fields = [c for c in records.columns if c.startswith(("hsc_", "gwh_")) and c != "hsc_image"]
        sums = [total("image.flux").alias("pixels"), total("hsc_image.flux").alias("hsc_pixels")]
        part = records.select("object_id", "phase", *sums, *[F.col(f"`{c}`") for c in fields])
        found = part if found is None else found.unionByName(part)
    return found


@register(query(_TRAIN, "SELECT object_id, phase, source FROM records"))
def structured_stream_cells(spark, sf):
    """The train stream as a Structured Streaming query, stopped and restarted once."""
    registry = _catalogs(spark, sf)
    stream = open_stream(spark, registry, seed=7, match_index=sky.index_path(spark, sf), image_shape=sky.HUB_SHAPE)
    folder, out, marks = (scratch_path(spark, n) for n in ("plan", "out", "marks"))
    for half in range(2):
        part = stream.shard(2, half)
        write_cell_plan(part, folder, cells_per_batch=part.n_shards // 2 + 1)
        done = stream_cells(stream, folder, out, marks)
    return done.select("object_id", "phase", "source")


@register(
    """SELECT user_id, event_type, count(*) AS events, round(sum(value), 6) AS total FROM events SEMI JOIN customer ON c_custkey = user_id GROUP BY user_id, event_type"""
)
def structured_stream_resume(spark, sf):
    """Events in five files as a stream that is lost in its third batch, behind its write, and run again."""
    events, out, marks = (scratch_path(spark, n) for n in ("events", "out", "marks"))
    table(spark, sf, "events").repartition(5, "event_id").write.parquet(events)
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    lost = [False]

    def write_batch(batch: DataFrame, number: int) -> None:
        batch.join(customers, "user_id", "left_semi").write.mode("overwrite").parquet(f"{out}/batch={number}")
        if number == 2 and not lost[0]:
            lost[0] = True
            raise RuntimeError("the driver is lost")

    schema = table(spark, sf, "events").schema
    try:
        run_available(spark, events, schema, marks, write_batch, "parquet")
    except StreamingQueryException:
        run_available(spark, events, schema, marks, write_batch, "parquet")
    return spark.read.parquet(out).groupBy("user_id", "event_type").agg(
        F.count("*").alias("events"), F.round(F.sum("value"), 6).alias("total")
    )
