"""Nested-array checks and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import finite

# The leaves of a spectrum that are read.
SPECTRUM_LEAVES = ("flux", "lambda", "mask")
LEAF_TYPES = {"flux": "array<float>", "lambda": "array<float>", "mask": "array<boolean>"}


def has_shape(cube: Column, shape: Sequence[int]) -> Column:
    """TRUE when a nested array is dense with exactly these sizes."""
    fits = F.size(cube) == shape[0]
    if len(shape) > 1:
        fits = fits & F.forall(cube, lambda part: has_shape(part, shape[1:]))
    return F.coalesce(fits, F.lit(False))


def dense_cube(cube: Column, shape: Sequence[int]) -> Column:
    """The cube as FLOAT; another shape fails the job."""
    kind = "array<" * len(shape) + "float" + ">" * len(shape)
    wanted = ", ".join(map(str, shape))
    return F.when(has_shape(cube, shape), cube.cast(kind)).otherwise(
        F.raise_error(F.lit(f"image flux does not have the expected shape ({wanted})"))
    )


def spectrum_part(spectrum: Column) -> Column:
    """The three leaves of a spectrum, typed; a missing leaf fails the job."""
    leaves = {leaf: spectrum.getField(leaf) for leaf in SPECTRUM_LEAVES}
    complete = F.lit(True)
    for leaf in leaves.values():
        complete = complete & leaf.isNotNull()
    missing = F.concat_ws(
        ", ", *[F.when(value.isNull(), F.lit(leaf)) for leaf, value in leaves.items()]
    )
    part = F.struct(*[value.cast(LEAF_TYPES[leaf]).alias(leaf) for leaf, value in leaves.items()])
    return F.when(complete, part).otherwise(
        F.raise_error(F.concat(F.lit("spectrum row is missing "), missing))
    )


def positive_wavelengths(spectrum: Column) -> Column:
    """Keep the samples with wavelength > 0 in all leaves; none left fails the job."""
    samples = F.arrays_zip(*[spectrum.getField(leaf).alias(leaf) for leaf in SPECTRUM_LEAVES])
    # NaN > 0 holds in Spark, so it is ruled out by hand
    kept = F.filter(
        samples, lambda s: (s.getField("lambda") > 0) & ~F.isnan(s.getField("lambda"))
    )
    # a field of an array of structs is the array of that field
    part = F.struct(*[kept.getField(leaf).alias(leaf) for leaf in SPECTRUM_LEAVES])
    return F.when(F.size(kept) > 0, part).otherwise(
        F.raise_error(F.lit("spectrum has no positive wavelengths"))
    )


def band_map(bands: Column, values: Column, low: float, high: float) -> Column:
    """``band → value`` for the finite values in the open range; the last of equal bands wins.

    Lists of different length give NULL: positions could not be trusted.
    """
    pairs = F.transform(
        F.arrays_zip(bands.cast("array<string>").alias("band"), values.cast("array<double>").alias("value")),
        lambda pair: F.struct(pair.getField("band").alias("band"), pair.getField("value").alias("value")),
    )
    valid = F.filter(
        pairs,
        lambda p: finite(p.getField("value")) & (p.getField("value") > low) & (p.getField("value") < high),
    )
    last = F.filter(
        valid,
        lambda p, i: ~F.exists(
            F.slice(valid, i + 2, F.size(valid)), lambda later: later.getField("band") == p.getField("band")
        ),
    )
    return F.when(F.size(bands) == F.size(values), F.map_from_entries(last))
