"""Which rows have an id that is, or is not, in a set, without moving the rows that surely have none of it.

A set of a checked size is broadcast. A larger one becomes a sieve: every id sets four bits of one 64-bit word, words are
or-ed together by an aggregate, and the words are broadcast in place of the ids, at 16 bits an id. A row that
misses a bit is surely not in the set and stays where it is read; the others, which are the members and a few
per cent more, go through the exact join. Beyond ``SIEVE_IDS`` both sides are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import BROADCAST_ROWS, HOT_ROWS, few_rows, hot_keys, spread_join

ID_BITS, SET_BITS = 16, 4
#: As many ids make a sieve of at most 16 MB of words.
SIEVE_IDS = 8_000_000


def _bits(column: str) -> Column:
    """``SET_BITS`` bits of a word, by the id's hash."""
    one, h = F.lit(1).cast("long"), F.xxhash64(column)
    mask = F.lit(0).cast("long")
    for k in range(SET_BITS):
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return mask


def _word(column: str, words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), column), F.lit(words)).alias("_word")


def sieve(ids: DataFrame, column: str, words: int) -> DataFrame:
    """(_word, _set): the words in which ids have set bits."""
    return ids.groupBy(_word(column, words)).agg(F.bit_or(_bits(column)).alias("_set"))


def possible(rows: DataFrame, column: str, table: DataFrame, words: int) -> DataFrame:
    """``rows`` with ``_possible``: all bits of the id are set in the sieve."""
    own = rows.select("*", _word(column, words), _bits(column).alias("_bits"))
    met = own.join(F.broadcast(table), "_word", "left")  # a bounded number of words, see without_ids
    held = F.coalesce(F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))
    return met.withColumn("_possible", held).drop("_word", "_set", "_bits")


def among(
    rows: DataFrame, ids: DataFrame, *, column: str = "partner_id", few: int = BROADCAST_ROWS, most: int = SIEVE_IDS
) -> DataFrame:
    """The ``rows`` that an inner join with ``ids`` may need: those with one of the ids, and some others where ids are many.

    To be put before such a join, or an aggregate by id in front of it. Columns that are computed of the rows are best added behind
    it: Catalyst does not move a join below them.
    """
    ids = ids.select(column)
    if few_rows(ids, few):
        return rows.join(F.broadcast(ids), column, "left_semi").select(*rows.columns)
    count = ids.limit(most + 1).count()
    if count > most:
        return rows
    words = -(-count * ID_BITS // 64)
    return possible(rows, column, sieve(ids, column, words), words).where("_possible").select(*rows.columns)


def without_ids(
    rows: DataFrame,
    ids: DataFrame,
    *,
    salt_by: Sequence[str],
    column: str = "partner_id",
    hot_rows: int = HOT_ROWS,
    few: int = BROADCAST_ROWS,
    most: int = SIEVE_IDS,
) -> DataFrame:
    """The ``rows`` whose id is none of ``ids``. An anti-join, because ``NOT IN`` would also drop rows whose id is NULL."""
    if few_rows(ids, few):
        return rows.join(F.broadcast(ids), column, "left_anti").select(*rows.columns)

    def exact(some: DataFrame) -> DataFrame:
        hot = hot_keys(some.select(column), [column], hot_rows)
        return spread_join(some, ids, [column], "left_anti", salt_by=salt_by, hot=hot).select(*rows.columns)

    count = ids.limit(most + 1).count()
    if count > most:
        return exact(rows)
    words = -(-count * ID_BITS // 64)
    marked = possible(rows, column, sieve(ids, column, words), words)
    absent = marked.where(~F.col("_possible")).select(*rows.columns)
    return absent.unionByName(exact(marked.where("_possible").select(*rows.columns)))
