"""Sky catalogs derived from the relational tables, whole table by whole table.

Customers are the anchor objects, spread over the sky by an irrational rotation of their
key. Orders, events and suppliers are observations of "their" customer a second of arc or
so off, so each catalog has matched and unmatched rows. Every expression here has a twin
in ``oracle.py``; the constants must stay equal.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.healpix import cell_of_index, with_pixel
from starweave.operators.crossmatch import crossmatch
from starweave.operators.star import Spoke
from starweave.session import scratch_path
from starweave.sources.adapters import HubAdapter, hub_adapter, spoke_adapters
from starweave.sources.index import MatchIndex, load_index

RA_STEP, DEC_STEP = 0.6180339887498949, 0.7548776662466927
RA_JITTER, DEC_JITTER = 0.5698402909980532, 0.3247179572447460
HUB_SHAPE = (3, 2, 2)
HUB_ORDER = 4
# source → (cell order, size of the position error in degrees)
SPOKES = {"desi": (5, 0.001), "sdss": (4, 0.0014), "provabgs": (4, 0.0008)}
SOURCES = sorted(SPOKES)
REVISION = "r1"
HUB_SOURCE = "customers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fraction(value: Column) -> Column:
    return value - F.floor(value)


def anchor_position(key: Column) -> tuple[Column, Column]:
    return 360.0 * fraction(key * RA_STEP), 180.0 * fraction(key * DEC_STEP + 0.5) - 90.0


def observed_position(owner: Column, key: Column, size: float) -> tuple[Column, Column]:
    ra, dec = anchor_position(owner)
    off_dec = dec + (fraction(key * DEC_JITTER) - 0.5) * size
    return ra + (fraction(key * RA_JITTER) - 0.5) * size, F.greatest(F.lit(-90.0), F.least(F.lit(90.0), off_dec))


def placed(df: DataFrame, position: tuple[Column, Column], order: int) -> DataFrame:
    """Add the position, the order-29 index and the catalog cell."""
    df = df.withColumns({"ra": position[0], "dec": position[1]})
    df = with_pixel(df, 29, "_healpix_29")
    return df.withColumns(
        {"norder": F.lit(order).cast("tinyint"), "npix": cell_of_index(F.col("_healpix_29"), order)}
    )


def hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the anchor catalog; ``row_index`` follows the customer key."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    plane = F.array(F.array(balance, balance + 1), F.array(balance + 2, balance + 3))
    image = F.struct(
        F.array(plane, plane, plane).alias("flux"),
        F.array(F.lit("des-g"), F.lit("des-r"), F.col("c_mktsegment")).alias("band"),
        F.array(balance / 1000, (key % 7).cast("double"), F.lit(1.1)).alias("psf_fwhm"),
    )
    df = placed(table(spark, sf_dir, "customer"), anchor_position(key), HUB_ORDER)
    return df.select(
        F.concat(F.lit("c"), key).alias("object_id"),
        "ra",
        "dec",
        "_healpix_29",
        image.alias("image"),
        (balance / 10000).alias("ebv"),
        *[(balance + i).alias(f"flux_{b}") for i, b in enumerate("grz")],
        F.when(key % 5 != 0, balance / 5000).alias("z_spec"),
        *[(balance * (i + 1)).alias(f"fiberflux_{b}") for i, b in enumerate("grz")],
        *[(balance - 100.0 * i).alias(f"psfdepth_{b}") for i, b in enumerate("grz")],
        "norder",
        "npix",
        key.alias("row_index"),
    )


def desi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as spectra."""
    order, size = SPOKES["desi"]
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    spectrum = F.struct(
        F.array(price, price / 2).alias("flux"),
        F.array(F.lit(4000.0), F.lit(4001.0)).alias("lambda"),
        F.array(price > 100000, F.lit(False)).alias("mask"),
        F.array(price, price).alias("ivar"),
    )
    df = table(spark, sf_dir, "orders")
    df = placed(df, observed_position(F.col("o_custkey"), key, size), order)
    return df.select(
        F.concat(F.lit("o"), key).alias("object_id"),
        "ra",
        "dec",
        "_healpix_29",
        spectrum.alias("spectrum"),
        (price / 100000).alias("Z"),
        F.when(key % 3 != 0, price / 1e7).alias("ZERR"),
        F.when(F.col("o_orderstatus") == "P", True).when(F.col("o_orderstatus") == "F", False).alias("ZWARN"),
        "norder",
        "npix",
        key.alias("row_index"),
        "o_orderstatus",
    )


def sdss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as spectra with padded binary ids and some non-positive wavelengths."""
    order, size = SPOKES["sdss"]
    key, value = F.col("event_id"), F.col("value")
    spectrum = F.struct(
        F.array(value, value + 1, value + 2).alias("flux"),
        F.array(value - 50, F.lit(4000.0), -value).alias("lambda"),
        F.array(value > 10, F.lit(False), F.lit(True)).alias("mask"),
    )
    df = table(spark, sf_dir, "events")
    df = placed(df, observed_position(F.col("user_id"), key, size), order)
    return df.select(
        F.concat(F.lit("  e"), key, F.lit(" ")).cast("binary").alias("object_id"),
        "ra",
        "dec",
        "_healpix_29",
        spectrum.alias("spectrum"),
        ((value - 20) / 100).alias("Z"),
        (value / 1000).alias("Z_ERR"),
        F.when(key % 4 != 0, F.col("event_type") == "click").alias("ZWARNING"),
        "norder",
        "npix",
        key.alias("row_index"),
    )


def provabgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as derived galaxy properties."""
    order, size = SPOKES["provabgs"]
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    df = table(spark, sf_dir, "supplier")
    df = placed(df, observed_position(key, key, size), order)
    return df.select(
        F.concat(F.lit("s"), key).alias("object_id"),
        "ra",
        "dec",
        "_healpix_29",
        (balance / 500).alias("LOG_MSTAR"),
        (balance / 4000).alias("Z_HP"),
        (balance / 80000).alias("Z_MW"),
        (balance / 600).alias("TAGE_MW"),
        balance.alias("AVG_SFR"),
        (key - 3).cast("double").alias("TSNR2_BGS"),
        "norder",
        "npix",
        key.alias("row_index"),
    )


ROWS = {"desi": desi, "sdss": sdss, "provabgs": provabgs}


def adapters():
    return spoke_adapters()


def hub_reader() -> HubAdapter:
    return hub_adapter(HUB_SHAPE)


def spoke(spark: SparkSession, sf_dir: str, source: str) -> Spoke:
    """A spoke restricted to the columns its adapter reads."""
    adapter = adapters()[source]
    rows = ROWS[source](spark, sf_dir)
    heads = list(dict.fromkeys(c.partition(".")[0] for c in adapter.read_columns))
    return Spoke(adapter, rows.select(*heads, "norder", "npix", "row_index"))


def spokes(spark: SparkSession, sf_dir: str) -> dict[str, Spoke]:
    return {s: spoke(spark, sf_dir, s) for s in SOURCES}


def edges(spark: SparkSession, sf_dir: str, source: str, partner: DataFrame | None = None, revision: str = REVISION) -> DataFrame:
    return crossmatch(
        hub(spark, sf_dir),
        ROWS[source](spark, sf_dir) if partner is None else partner,
        anchor_source=HUB_SOURCE,
        anchor_revision=REVISION,
        partner_source=source,
        partner_revision=revision,
        partner_strip_id=True,
    )


@lru_cache(maxsize=16)
def _index_path(application: str, sf_dir: str) -> str:
    return scratch_path(SparkSession.active(), "index")


@lru_cache(maxsize=64)
def _source_index_path(application: str, sf_dir: str, source: str) -> str:
    """Build the index of one spoke once per session, as the offline step does."""
    path = f"{_index_path(application, sf_dir)}/{source}.parquet"
    edges(SparkSession.active(), sf_dir, source).write.parquet(path)
    return path


def source_index_path(spark: SparkSession, sf_dir: str, source: str) -> str:
    return _source_index_path(spark.sparkContext.applicationId, sf_dir, source)


def index_path(spark: SparkSession, sf_dir: str) -> str:
    """The folder with the indexes of all three spokes."""
    for source in SOURCES:
        source_index_path(spark, sf_dir, source)
    return _index_path(spark.sparkContext.applicationId, sf_dir)


def index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edge index (layout 2) as written."""
    return spark.read.parquet(f"{index_path(spark, sf_dir)}/*.parquet")


def index(spark: SparkSession, sf_dir: str) -> MatchIndex:
    return load_index(spark, index_path(spark, sf_dir))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, partner cell, path) of the spoke catalogs; paths as a store would name them."""
    result = None
    for source in SOURCES:
        cells = ROWS[source](spark, sf_dir).select(
            F.lit(source).alias("source"),
            F.col("norder").alias("partner_norder"),
            F.col("npix").alias("partner_npix"),
        ).distinct()
        result = cells if result is None else result.unionByName(cells)
    path = F.concat_ws("/", "source", F.concat(F.lit("Norder="), "partner_norder"), F.concat(F.lit("Npix="), "partner_npix", F.lit(".parquet")))
    return result.withColumn("path", path)
