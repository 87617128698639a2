"""What each catalog contributes to a record: columns to read, quality rules, output fields.

A field whose rule fails is NULL, never a default. New catalogs register a SpokeAdapter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import band_map, dense_cube, positive_wavelengths, spectrum_part
from ..functions.ids import id_text
from ..functions.numeric import between, finite, keep_if, positive

# ---- fixed values: field names and shapes of the published catalogs -------------------

POSITION = ("ra", "dec", "_healpix_29")
IMAGE_SHAPE = (3, 152, 152)
HSC_IMAGE_SHAPE = (5, 160, 160)
SPECTRUM_COLUMNS = ("spectrum.flux", "spectrum.lambda", "spectrum.mask")

IMAGE_SCALARS = ("ebv", "flux_g", "flux_r", "flux_z", "z_spec")
APERTURE_FLUXES = ("fiberflux_g", "fiberflux_r", "fiberflux_z")
DEPTHS = ("psfdepth_g", "psfdepth_r", "psfdepth_z")

HSC_BANDS = "grizy"
HSC_MOMENTS = ("11", "22", "12")
HSC_MAX_MAGERR = 0.1

PROVABGS_RANGES = {
    "LOG_MSTAR": between(0, 15, low_open=True, high_open=True),
    "Z_HP": between(0, 2, high_open=True),
    "Z_MW": between(0, 0.1, high_open=True),
    "TAGE_MW": between(0, 14),
    "AVG_SFR": between(0, 1e4, high_open=True),
}

MORPHOLOGY_FIELDS = (
    "smooth-or-featured_smooth_fraction",
    "smooth-or-featured_featured-or-disk_fraction",
    "smooth-or-featured_artifact_fraction",
    "disk-edge-on_yes_fraction",
    "disk-edge-on_no_fraction",
    "has-spiral-arms_yes_fraction",
    "has-spiral-arms_no_fraction",
    "bar_strong_fraction",
    "bar_weak_fraction",
    "bar_no_fraction",
    "bulge-size_dominant_fraction",
    "bulge-size_large_fraction",
    "bulge-size_moderate_fraction",
    "bulge-size_small_fraction",
    "bulge-size_none_fraction",
    "how-rounded_round_fraction",
    "how-rounded_in-between_fraction",
    "how-rounded_cigar-shaped_fraction",
    "edge-on-bulge_boxy_fraction",
    "edge-on-bulge_none_fraction",
    "edge-on-bulge_rounded_fraction",
    "spiral-winding_tight_fraction",
    "spiral-winding_medium_fraction",
    "spiral-winding_loose_fraction",
    "spiral-arm-count_1_fraction",
    "spiral-arm-count_2_fraction",
    "spiral-arm-count_3_fraction",
    "spiral-arm-count_4_fraction",
    "spiral-arm-count_more-than-4_fraction",
    "spiral-arm-count_cant-tell_fraction",
    "merging_none_fraction",
    "merging_minor-disturbance_fraction",
    "merging_major-disturbance_fraction",
    "merging_merger_fraction",
)

# ---------------------------------------------------------------------------------------


def pick(df: DataFrame, name: str) -> Column:
    """A column, or NULL where the catalog does not have it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("double")


def scalar(df: DataFrame, name: str, rule=None, prefix: str = "") -> Column:
    return keep_if(pick(df, name), rule).alias(prefix + name)


def base_fields(object_id: Column) -> list[Column]:
    """The four fields every record has."""
    return [object_id.alias("object_id"), *[F.col(c) for c in POSITION]]


Outputs = Callable[[DataFrame], list[Column]]


@dataclass(frozen=True)
class SpokeAdapter:
    """How one partner catalog is read and attached."""

    name: str
    columns: Sequence[str]
    outputs: Outputs
    id_column: str = "object_id"
    emits_unmatched: bool = False
    literal_ids: bool = False

    @property
    def read_columns(self) -> list[str]:
        return [self.id_column, *POSITION, *self.columns]

    def partner_id(self, df: DataFrame) -> Column:
        """The join id: text, always stripped."""
        return id_text(df, self.id_column, trim=True, literal=self.literal_ids)


@dataclass(frozen=True)
class HubAdapter:
    """How the anchor catalog is read."""

    columns: Sequence[str]
    outputs: Outputs
    id_column: str = "object_id"

    @property
    def read_columns(self) -> list[str]:
        return [self.id_column, *POSITION, *self.columns]


def with_fields(df: DataFrame, outputs: Outputs, into: str) -> tuple[DataFrame, list[Column]]:
    """Evaluate output fields beside the raw columns, whose names they may share."""
    held = df.withColumn(into, F.struct(*outputs(df)))
    return held, [F.col(into).getField(n).alias(n) for n in held.schema[into].dataType.names]


def image_part(image: Column, shape: Sequence[int]) -> Column:
    return F.struct(
        dense_cube(image.getField("flux"), shape).alias("flux"),
        image.getField("band").cast("array<string>").alias("band"),
    )


def image_scalars(df: DataFrame) -> list[Column]:
    return [
        *[scalar(df, c) for c in IMAGE_SCALARS],
        *[scalar(df, c) for c in APERTURE_FLUXES],
        *[scalar(df, c, positive) for c in DEPTHS],
    ]


def image_outputs(shape: Sequence[int] = IMAGE_SHAPE) -> Outputs:
    def outputs(df: DataFrame) -> list[Column]:
        image = F.col("image")
        leaves = df.schema["image"].dataType.names
        fields = [image_part(image, shape).alias("image"), *image_scalars(df)]
        if "psf_fwhm" in leaves:
            seeing = band_map(image.getField("band"), image.getField("psf_fwhm"), 0.0, 5.0)
            fields.append(seeing.alias("psf_fwhm"))
        return fields

    return outputs


def psf_columns(bands: Sequence[str]) -> list[Column]:
    """``psf_fwhm_<band>`` fields out of the band-keyed map."""
    return [F.try_element_at("psf_fwhm", F.lit(b)).alias(f"psf_fwhm_{b}") for b in bands]


def flag(df: DataFrame, name: str) -> Column:
    return pick(df, name).cast("boolean")


def desi_outputs(df: DataFrame) -> list[Column]:
    return [
        spectrum_part(F.col("spectrum")).alias("spectrum"),
        scalar(df, "Z"),
        scalar(df, "ZERR"),
        flag(df, "ZWARN").alias("ZWARN"),
    ]


def sdss_outputs(df: DataFrame) -> list[Column]:
    warned = F.coalesce(flag(df, "ZWARNING"), F.lit(False))
    redshift = pick(df, "Z")
    return [
        positive_wavelengths(spectrum_part(F.col("spectrum"))).alias("sdss_spectrum"),
        F.when(~warned, keep_if(redshift, lambda z: z >= 0)).alias("sdss_Z"),
        scalar(df, "Z_ERR", prefix="sdss_"),
        flag(df, "ZWARNING").alias("sdss_ZWARNING"),
    ]


def hsc_scalars(df: DataFrame) -> list[Column]:
    fields = []
    for band in HSC_BANDS:
        magnitude, error = f"{band}_cmodel_mag", pick(df, f"{band}_cmodel_magerr")
        sharp = finite(error) & (error.cast("double") < HSC_MAX_MAGERR)
        in_range = keep_if(pick(df, magnitude), between(10, 30, low_open=True, high_open=True))
        fields.append(F.when(sharp, in_range).alias(f"hsc_{magnitude}"))
    fields.append(
        keep_if(pick(df, "i_extendedness_value"), lambda v: v.isin(0.0, 1.0)).alias("hsc_extendedness")
    )
    for moment in HSC_MOMENTS:
        for kind in ("shape", "psf_shape"):
            fields.append(scalar(df, f"i_sdssshape_{kind}{moment}", prefix="hsc_"))
    return fields


def hsc_outputs(shape: Sequence[int] = HSC_IMAGE_SHAPE) -> Outputs:
    def outputs(df: DataFrame) -> list[Column]:
        image = F.col("image")
        cutout = F.when(image.isNotNull(), image_part(image, shape))
        return [cutout.alias("hsc_image"), *hsc_scalars(df)]

    return outputs


def provabgs_outputs(df: DataFrame) -> list[Column]:
    signal = pick(df, "TSNR2_BGS")
    usable = finite(signal) & (signal.cast("double") > 0)
    return [
        F.when(usable, keep_if(pick(df, name), rule)).alias(f"provabgs_{name}")
        for name, rule in PROVABGS_RANGES.items()
    ]


def morphology_outputs(df: DataFrame) -> list[Column]:
    return [scalar(df, name, between(0, 1), prefix="gwh_") for name in MORPHOLOGY_FIELDS]


def hub_adapter(shape: Sequence[int] = IMAGE_SHAPE) -> HubAdapter:
    return HubAdapter(("image", *IMAGE_SCALARS, *APERTURE_FLUXES, *DEPTHS), image_outputs(shape))


def spoke_adapters(hsc_shape: Sequence[int] = HSC_IMAGE_SHAPE) -> dict[str, SpokeAdapter]:
    """The adapters of the published catalogs."""
    hsc_columns = (
        "image.flux",
        "image.band",
        *[f"{b}_cmodel_mag" for b in HSC_BANDS],
        *[f"{b}_cmodel_magerr" for b in HSC_BANDS],
        "i_extendedness_value",
        *[f"i_sdssshape_shape{m}" for m in HSC_MOMENTS],
        *[f"i_sdssshape_psf_shape{m}" for m in HSC_MOMENTS],
    )
    adapters = [
        SpokeAdapter("desi", (*SPECTRUM_COLUMNS, "Z", "ZERR", "ZWARN"), desi_outputs, emits_unmatched=True),
        SpokeAdapter(
            "sdss",
            (*SPECTRUM_COLUMNS, "Z", "Z_ERR", "ZWARNING"),
            sdss_outputs,
            emits_unmatched=True,
            literal_ids=True,
        ),
        SpokeAdapter("hsc", hsc_columns, hsc_outputs(hsc_shape), emits_unmatched=True),
        SpokeAdapter("provabgs", (*PROVABGS_RANGES, "TSNR2_BGS"), provabgs_outputs),
    ]
    return {a.name: a for a in adapters}


def adapter_for(source: str, adapters: dict[str, SpokeAdapter]) -> SpokeAdapter:
    """The adapter of a source; ``galaxies`` and ``galaxies_*`` share the morphology one."""
    if source in adapters:
        return adapters[source]
    if source == "galaxies" or source.startswith("galaxies_"):
        return SpokeAdapter(source, MORPHOLOGY_FIELDS, morphology_outputs, id_column="dr8_id")
    raise ValueError(f"unknown source adapter {source!r}")
