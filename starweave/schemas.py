"""Fixed schemas of the three match-index layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Column names and types of the edge index (layout 2).
EDGE_SCHEMA = T.StructType(
    [
        T.StructField("index_schema_version", T.ShortType()),
        T.StructField("anchor_source", T.StringType()),
        T.StructField("anchor_revision", T.StringType()),
        T.StructField("anchor_order", T.ByteType()),
        T.StructField("anchor_pixel", T.LongType()),
        T.StructField("anchor_id", T.StringType()),
        T.StructField("partner_source", T.StringType()),
        T.StructField("partner_revision", T.StringType()),
        T.StructField("partner_order", T.ByteType()),
        T.StructField("partner_pixel", T.LongType()),
        T.StructField("partner_id", T.StringType()),
        T.StructField("join_kind", T.StringType()),
        T.StructField("separation_arcsec", T.FloatType()),
        T.StructField("match_radius_arcsec", T.FloatType()),
        T.StructField("epoch_treatment", T.StringType()),
    ]
)

# The six columns of the oldest, pair-only index (layout 1).
PAIR_SCHEMA = T.StructType(
    [
        T.StructField("image_order", T.ByteType()),
        T.StructField("image_pixel", T.LongType()),
        T.StructField("image_id", T.StringType()),
        T.StructField("spectrum_order", T.ByteType()),
        T.StructField("spectrum_pixel", T.LongType()),
        T.StructField("spectrum_id", T.StringType()),
    ]
)

EDGE_VERSION = 2
WIDE_VERSION = 3

ANCHOR_FIELDS = EDGE_SCHEMA.fields[:6]

# The column block each spoke has in the wide index (layout 3).
BLOCK_FIELDS = [
    ("revision", T.StringType()),
    ("id", T.StringType()),
    ("order", T.ByteType()),
    ("pixel", T.LongType()),
    ("separation_arcsec", T.FloatType()),
    ("match_radius_arcsec", T.FloatType()),
]


def wide_schema(sources: Sequence[str]) -> T.StructType:
    """Layout 3: the anchor fields, one block per source, the epoch treatment."""
    blocks = [T.StructField(f"{s}_{name}", kind) for s in sources for name, kind in BLOCK_FIELDS]
    return T.StructType([*ANCHOR_FIELDS, *blocks, T.StructField("epoch_treatment", T.StringType())])
