"""Nested HEALPix cells as column expressions (Górski et al. 2005)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The split is decided at this order, one bucket of so many is validation.
SPLIT_ORDER = 4
SPLIT_BUCKETS = 20
INDEX_ORDER = 29
NO_PIXEL = -1


#: Shifts that move bit i of a 32-bit number to bit 2i, and the bits that stay behind each: the halves part, then their halves.
_SPREADS = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread(bits: str, shift: int, stay: int) -> Column:
    return F.col(bits).bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(stay).cast("long"))


def with_pixel(df: DataFrame, order: int, into: str, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Add the nested pixel of a position in degrees, as BIGINT; -1 where there is no position.

    Built up in steps: intermediate values are used several times, and one nested
    expression would repeat them all in the generated code.
    """
    side = 1 << order
    low = F.lit(side - 1).cast("long")
    lon, lat = F.col(ra), F.col(dec)
    turn = (lon - F.floor(lon / 360.0) * 360.0) / 90.0
    pixel = F.col("_face") * (side * side) + F.col("_even") + F.col("_odd") * 2
    known = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    steps = [
        {
            "_z": F.sin(F.radians(lat)),
            "_turn": turn,
            # 1-|z| cancels close to the pole; the half angle form does not
            "_scale": side * F.sqrt(F.lit(6.0)) * F.abs(F.sin(F.radians(90.0 - F.abs(lat)) / 2.0)),
        },
        # a negative ra of rounding size wraps to exactly one full turn
        {"_turn": F.when(F.col("_turn") >= 4.0, F.lit(0.0)).otherwise(F.col("_turn"))},
        {
            "_belt": F.abs(F.col("_z")) <= 2.0 / 3.0,
            # equatorial belt: ascending and descending cell edges
            "_up": F.floor(side * (0.5 + F.col("_turn") - 0.75 * F.col("_z"))).cast("long"),
            "_down": F.floor(side * (0.5 + F.col("_turn") + 0.75 * F.col("_z"))).cast("long"),
            # polar caps: the face is the quadrant, rows shrink towards the pole
            "_quad": F.least(F.lit(3), F.floor("_turn")).cast("long"),
        },
        {
            "_up_face": F.shiftright("_up", order),
            "_down_face": F.shiftright("_down", order),
            "_part": F.col("_turn") - F.col("_quad"),
        },
        {
            "_cap_up": F.least(F.floor(F.col("_part") * F.col("_scale")).cast("long"), low),
            "_cap_down": F.least(F.floor((1.0 - F.col("_part")) * F.col("_scale")).cast("long"), low),
        },
        {
            "_face": F.when(
                F.col("_belt"),
                F.when(F.col("_up_face") == F.col("_down_face"), F.col("_up_face").bitwiseOR(F.lit(4)))
                .when(F.col("_up_face") < F.col("_down_face"), F.col("_up_face"))
                .otherwise(F.col("_down_face") + 8),
            ).otherwise(F.when(lat >= 0, F.col("_quad")).otherwise(F.col("_quad") + 8)),
            "_x": F.when(F.col("_belt"), F.col("_down").bitwiseAND(low))
            .when(lat >= 0, low - F.col("_cap_down"))
            .otherwise(F.col("_cap_up")),
            "_y": F.when(F.col("_belt"), low - F.col("_up").bitwiseAND(low))
            .when(lat >= 0, low - F.col("_cap_up"))
            .otherwise(F.col("_cap_down")),
        },
        # not NULL, so that no step has to look for it: the generated code stays short enough to be compiled
        {"_even": F.coalesce("_x", F.lit(0).cast("long")), "_odd": F.coalesce("_y", F.lit(0).cast("long"))},
        *[{name: _spread(name, *by) for name in ("_even", "_odd")} for by in _SPREADS],
        # never NULL: else a later join on the pixel pushes "is not null" down to the scan,
        # with all these steps nested into one huge predicate
        {into: F.coalesce(F.when(known, pixel.cast("long")), F.lit(NO_PIXEL).cast("long"))},
    ]
    made = set()
    for step in steps:
        made |= set(step)
        df = df.withColumns(step)
    return df.drop(*(made - {into}))


def ancestor(pixel: Column, order: Column | int, at: Column | int) -> Column:
    """The pixel of order ``at`` that contains ``pixel`` of a finer (or equal) order."""
    order = F.lit(order) if isinstance(order, int) else order
    at = F.lit(at) if isinstance(at, int) else at
    return F.call_function("shiftright", pixel.cast("long"), (F.lit(2) * (order - at)).cast("int"))


def cell_of_index(index29: Column, order: int) -> Column:
    """The order-``order`` pixel of an order-29 index."""
    return F.shiftright(index29, 2 * (INDEX_ORDER - order))


def crc_bucket(text: Column, buckets: Column | int) -> Column:
    """``crc32(text) mod buckets``: the same on every engine and in every run."""
    return F.pmod(F.crc32(text), F.lit(buckets) if isinstance(buckets, int) else buckets)


def split_of_cell(order: Column, pixel: Column) -> Column:
    """``'val'`` or ``'train'``: cells share the split of their order-4 ancestor."""
    bucket = crc_bucket(ancestor(pixel, order, SPLIT_ORDER).cast("string"), SPLIT_BUCKETS)
    message = F.concat(
        F.lit("HEALPix order "), order.cast("string"), F.lit(f" is below split order {SPLIT_ORDER}")
    )
    return (
        F.when(order < SPLIT_ORDER, F.raise_error(message))
        .when(bucket == 0, F.lit("val"))
        .otherwise(F.lit("train"))
    )
