"""Identifier normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What Python's str.strip() removes: Unicode white space and four separators.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# One unit of a bytes literal: an escape or a plain ASCII character.
_UNIT = r"\\x[0-9a-fA-F]{2}|\\[0-7]{1,3}|\\[\x20-\x7e]|[\x20-\x26\x28-\x5b\x5d-\x7e\t]"
_LITERAL = rf"^b'((?:{_UNIT})*)'[ \t]*$"
# Single-character escapes of a bytes literal and their codes.
_ESCAPES = {"\\": 92, "'": 39, '"': 34, "a": 7, "b": 8, "f": 12, "n": 10, "r": 13, "t": 9, "v": 11}


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` knows only blanks)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def _unit_hex(unit: Column) -> Column:
    second = F.substring(unit, 2, 1)
    result = F.when(unit.startswith("\\x"), F.substring(unit, 3, 2))
    octal = F.lpad(F.conv(F.substring(unit, 2, 3), 8, 16), 2, "0")
    result = result.when(unit.rlike(r"^\\[0-7]"), octal)
    for character, code in _ESCAPES.items():
        result = result.when(unit == f"\\{character}", F.lit(f"{code:02X}"))
    # an unknown escape keeps its backslash
    result = result.when(unit.startswith("\\"), F.concat(F.lit("5C"), F.hex(second)))
    return result.otherwise(F.hex(unit))


def decode_literal(text: Column) -> Column:
    """``"b'…'"`` as written by str(bytes) → its content; any other text unchanged."""
    inner = F.regexp_extract(text, _LITERAL, 1)
    units = F.regexp_extract_all(inner, F.lit(f"({_UNIT})"), F.lit(1))
    escaped = F.decode(F.unhex(F.array_join(F.transform(units, _unit_hex), "")), "UTF-8")
    return F.when(
        text.rlike(_LITERAL), F.when(F.contains(inner, F.lit("\\")), escaped).otherwise(inner)
    ).otherwise(text)


def id_text(df: DataFrame, column: str, *, trim: bool = False, literal: bool = False) -> Column:
    """An id column as STRING: bytes as UTF-8, optionally literal-decoded and stripped."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.BinaryType):
        text = F.decode(value, "UTF-8")
    else:
        text = value.cast("string")
        if literal:
            text = decode_literal(text)
    return strip(text) if trim else text


def normalize_id(df: DataFrame, column: str, strip_id: bool = False) -> Column:
    """Index-building form: literal decoding and stripping come together or not at all."""
    return id_text(df, column, trim=strip_id, literal=strip_id)
