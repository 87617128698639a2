"""The single-spoke stream: image rows with their spectrum, and unmatched spectra between them.

It differs from the star in four ways: an indexed partner that is missing drops the image
row, the last of several equal partner ids counts, unmatched ids carry no source prefix,
and unmatched rows are spread evenly between the image rows of a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import id_text
from ..session import cut_lineage
from ..sources.adapters import Outputs, base_fields, desi_outputs, image_outputs, with_fields
from .membership import among, without_ids
from .ordering import BLOCK_ROWS, number_rows
from .skew import HOT_ROWS, few_rows, hot_keys, small_side, spread_join

ANCHOR_KEY = ["norder", "npix", "anchor_id"]
PARTNER_KEY = ["partner_norder", "partner_npix", "partner_id"]
CELL = ["norder", "npix"]

# slot: the image row an entry stands before; phase: unmatched first
ORDER = ["cell_rank", "slot", "phase", "item"]

DESI_FIELDS = ["spectrum", "Z", "ZERR", "ZWARN"]


def _spectra_keys(spectra: DataFrame, id_column: str) -> DataFrame:
    return spectra.withColumn("partner_id", id_text(spectra, id_column)).withColumnsRenamed(
        {"norder": "partner_norder", "npix": "partner_npix", "row_index": "partner_row"}
    )


def locate(edges: DataFrame, partner_cells: DataFrame, keyed: DataFrame) -> DataFrame:
    """Edges with the place of their partner row; of equal ids the last place counts.

    Works on ids and places only, so no spectrum is moved.
    """
    needed = edges.select(*CELL, "partner_id").distinct()
    places = keyed.groupBy(*PARTNER_KEY).agg(F.max("partner_row").alias("partner_row"))
    last = F.max(F.struct("partner_norder", "partner_npix", "partner_row"))
    listed = [*CELL, "partner_norder", "partner_npix"]
    found = (
        needed.join(places, "partner_id")  # by id first: no list of partitions is multiplied
        .join(partner_cells.select(*listed), listed, "left_semi")
        .groupBy(*CELL, "partner_id")
        .agg(last.alias("at"))
        .select(*CELL, "partner_id", "at.*")
    )
    return edges.select(*ANCHOR_KEY, "partner_id").join(found, [*CELL, "partner_id"], "left")


def join_pairs(
    images: DataFrame,
    edges: DataFrame,
    partner_cells: DataFrame,
    spectra: DataFrame,
    *,
    image_id: str = "object_id",
    spectrum_id: str = "object_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Image rows with a struct ``partner`` of their spectrum row, NULL where not indexed.

    An image whose index entry points to a missing spectrum is dropped.
    """
    images = images.withColumn("anchor_id", id_text(images, image_id))
    keyed = among(_spectra_keys(spectra, spectrum_id), edges)
    located = cut_lineage(locate(edges, partner_cells, keyed).where(F.col("partner_row").isNotNull()))
    place = ["partner_norder", "partner_npix", "partner_row"]
    payload = keyed.select(*place, F.struct(*[F.col(f"`{c}`") for c in spectra.columns if c in keyed.columns]).alias("partner"))
    if few_rows(located):  # the spectra stay where they are read
        attached = payload.join(F.broadcast(located), place)
    else:
        hot = hot_keys(located, place, hot_rows)
        attached = spread_join(located, payload, place, "inner", salt_by=ANCHOR_KEY, hot=hot)
    attached = attached.select(*ANCHOR_KEY, "partner")
    indexed = edges.select(*ANCHOR_KEY).distinct().join(attached, ANCHOR_KEY, "left").withColumn("indexed", F.lit(True))
    hot = hot_keys(images, ANCHOR_KEY, hot_rows)
    joined = spread_join(images, indexed, ANCHOR_KEY, "left", salt_by=["row_index"], hot=hot)
    return joined.where(F.col("indexed").isNull() | F.col("partner").isNotNull()).drop("indexed")


def unmatched_spectra(
    spectra: DataFrame,
    matched_ids: DataFrame,
    owners: DataFrame,
    *,
    spectrum_id: str = "object_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Spectra of owned partitions that no edge points to, with their owner cell."""
    keyed = _spectra_keys(spectra, spectrum_id)
    mine = owners.select("partner_norder", "partner_npix", *CELL, "cell_rank")
    rows = keyed.join(small_side(mine), ["partner_norder", "partner_npix"])
    salt = ["partner_norder", "partner_npix", "partner_row"]
    return without_ids(rows, matched_ids.select("partner_id"), salt_by=salt, hot_rows=hot_rows)


def interleave_slots(unmatched: DataFrame, image_counts: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Give the k-th unmatched row of a cell its slot ``min(k·stride, images)``.

    ``stride = max(1, images // unmatched)``; rows beyond the last image trail the cell.
    """
    numbered = number_rows(
        unmatched,
        CELL,
        ["partner_norder", "partner_npix"],
        "partner_row",
        into="item",
        total="unmatched",
        block_rows=block_rows,
    )
    images = F.coalesce(F.col("images"), F.lit(0)).cast("long")
    stride = F.greatest(F.lit(1).cast("long"), F.expr("coalesce(images, 0) div unmatched"))
    return (
        numbered.join(image_counts.select(*CELL, F.col("rows").alias("images")), CELL, "left")
        .withColumn("slot", F.least(F.col("item") * stride, images))
        .drop("images", "unmatched")
    )


def pair_records(
    images: DataFrame,
    edges: DataFrame,
    partner_cells: DataFrame,
    spectra: DataFrame,
    matched_ids: DataFrame,
    owners: DataFrame,
    image_counts: DataFrame,
    *,
    image_shape: tuple[int, ...],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The decoded records of the pair stream with their ORDER columns."""
    joined = join_pairs(images, edges, partner_cells, spectra, hot_rows=hot_rows)
    # a partner column of the same name replaces the image catalog's
    fields = [f for f in DESI_FIELDS if f in joined.schema["partner"].dataType.names]
    joined = joined.withColumns({f: F.col("partner").getField(f) for f in fields}).drop("partner")
    place = {"slot": F.col("row_index"), "phase": F.lit(1), "item": F.col("row_index")}
    pairs = _decode(joined, F.col("anchor_id"), image_shape).withColumns(place).drop("row_index")

    alone = unmatched_spectra(spectra, matched_ids, owners, hot_rows=hot_rows)
    alone = interleave_slots(alone, image_counts)
    lone = _decode(alone, F.col("partner_id"), None).withColumn("phase", F.lit(0))
    records = pairs.unionByName(lone, allowMissingColumns=True)
    return records.select(*ORDER, *[c for c in records.columns if c not in ORDER])


def _decode(df: DataFrame, object_id: Column, image_shape: tuple[int, ...] | None) -> DataFrame:
    """A union row → record: whatever of image and spectrum is there; neither is an error."""
    image = F.col("image") if image_shape and "image" in df.columns else None
    spectrum = F.col("spectrum") if "spectrum" in df.columns else None
    has_image = F.lit(False) if image is None else F.coalesce(image.getField("band").isNotNull(), F.lit(False))
    has_spectrum = (
        F.lit(False) if spectrum is None else F.coalesce(spectrum.getField("flux").isNotNull(), F.lit(False))
    )
    empty = F.raise_error(F.concat(F.lit("row "), object_id, F.lit(" has neither image nor spectrum")))
    fields = [F.when(has_image | has_spectrum, object_id).otherwise(empty).alias("object_id")]
    fields += base_fields(object_id)[1:]
    for present, outputs, into in (
        (has_image, None if image is None else image_outputs(image_shape), "_image_fields"),
        (has_spectrum, None if spectrum is None else desi_outputs, "_spectrum_fields"),
    ):
        if outputs is not None:
            df, found = with_fields(df, _where(present, outputs), into)
            fields += found
    kept = [c for c in ("cell_rank", "row_index", "slot", "item") if c in df.columns]
    return df.select(*kept, *fields)


def _where(present: Column, outputs: Outputs) -> Outputs:
    """The same fields, NULL unless their part of the row is present."""

    def guarded(df: DataFrame) -> list[Column]:
        held = F.when(present, F.struct(*outputs(df)))
        names = df.select(held.alias("f")).schema["f"].dataType.names
        return [held.getField(n).alias(n) for n in names]

    return guarded
