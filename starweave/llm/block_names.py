"""Exact deduplication by deterministic block naming.

Texts are lower-cased (A-Z only) and cut into blocks of ``BLOCK_BYTES`` bytes. The distinct blocks are
sorted, by a hash and then by themselves, and the place of a block in that order is its integer name. Then adjacent names are
paired, the distinct pairs are sorted and named likewise, and so on, until each document has one name. A last name
without a partner is paired with null. The hash only deals the order out evenly, whatever texts begin with; blocks that share
it are told apart. So documents of one level have the same
name exactly if their texts are equal, and documents of different levels differ in length.

Rows that hold equal blocks meet in two steps: first within ``salts`` slices of the rows, each of which
sends its first place on, then over slices. With the square root of the row number as ``salts``, a block that fills a third
of all rows puts no more than about that root into any group. Names go back to rows by a join on
the first places, whose hot keys are a slice's rows.

Defined results: null counts as the empty text, and empty texts are equal to each other. Rows that repeat
an id are documents of their own (``common.identified``); of equal texts the last in that order stays. An empty
table gives no rows. Extra columns are ignored, whatever their names. Blocks are bytes, so a text of any length costs time in proportion.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import identified, keep, let, lower_ascii

BLOCK_BYTES = 1024


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def blocks(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """(rid, pos, n, block): the ``n`` blocks of each of ``docs`` (rid, text); an empty text has one, which is empty."""

    def cut(data: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.octet_length(data) - 1) / size).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(data, k * size + 1, F.lit(size)))

    pieces = docs.select("rid", let(normalised(F.col("text")).cast("binary"), cut).alias("pieces"))
    pieces = pieces.select("rid", F.size("pieces").cast("long").alias("n"), F.posexplode("pieces").alias("pos", "block"))
    return pieces.select("rid", F.col("pos").cast("long").alias("pos"), "n", "block")


def named(rows: DataFrame, key: Sequence[str], salts: int) -> DataFrame:
    """(rid, pos, n, name) of ``rows`` (rid, pos, n, *key): equal keys get equal integers, in the order of hash and key."""
    place = F.struct("rid", "pos", "n")
    spread = rows.select(*key, place.alias("place"), F.pmod(F.xxhash64("rid", "pos"), F.lit(salts)).alias("salt"))
    marked = spread.withColumn("first", F.min("place").over(Window.partitionBy(*key, "salt")))
    heads = marked.where("place = first").select(*key, "first")
    heads = heads.withColumn("hash", F.xxhash64(*key))
    ordered = heads.repartitionByRange("hash").sortWithinPartitions("hash", *key)
    placed = ordered.withColumn("at", F.monotonically_increasing_id())
    names = placed.select("first", F.min("at").over(Window.partitionBy("hash", *key)).alias("name"))
    return marked.select("place", "first").join(names, "first").select("place.*", "name")


def pairs(names: DataFrame) -> DataFrame:
    """(rid, pos, n, one, two): adjacent names of documents that have several."""
    even = F.col("pos") % 2 == 0
    return (
        names.where("n > 1")
        .groupBy("rid", F.shiftright("pos", 1).alias("pos"), F.floor((F.col("n") + 1) / 2).alias("n"))
        .agg(F.max(F.when(even, F.col("name"))).alias("one"), F.max(F.when(~even, F.col("name"))).alias("two"))
    )


def identities(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """(rid, level, name) of each of ``docs`` (rid, text); texts are equal exactly if level and name are."""
    salts = isqrt(docs.count()) + 1
    names = keep(named(blocks(docs, size), ["block"], salts), "names")
    most = names.agg(F.max("n")).first()[0] or 1
    found = []
    for level in range((most - 1).bit_length() + 1):
        if level:
            names = keep(named(pairs(names), ["one", "two"], salts), "names")
        found.append(names.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def deduplicated(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """(rid, doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs`` (doc_id, text)."""
    docs = identified(docs)
    digests = docs.select("rid", "doc_id", F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256"))
    known = keep(digests.join(identities(docs, size), "rid"), "known")
    groups = known.groupBy("level", "name").agg(
        F.max(F.struct("rid", "doc_id")).alias("last"), F.count("*").alias("group_size")
    )
    return known.join(groups, ["level", "name"]).select(
        "rid", "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("last.rid")).alias("kept"), "text_sha256",
    )
