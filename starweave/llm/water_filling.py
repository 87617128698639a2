"""Mixing sources to target weights by capped water-filling.

The mix takes ``share`` of all words. Sources divide it by weight; a source stops at ``epochs`` times its
size, and what it cannot take is divided again among the others, until none is above its stop.
Every document is then taken whole as often as its source's target holds the source, and the
rest of the target is drawn from the documents in a seeded order, the last of them in part:
the words taken from a source are its target, rounded.

The seeded order is cut into buckets by the leading digits of a digest. Prefix sums run over
the buckets of a source, and over the rows of the one bucket in which its draw ends; no task
holds a source. One number per source and round of filling is all that reaches the driver, as sums.

Defined results: a null or blank text has size 0 and is taken 0 times; a source whose documents
are all blank has the target 0. A null source is a source of its own, last in order. Rows that
repeat an id are separate documents. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, identified, keep, ranked

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = "mix"
#: Leading hex digits of the digest that name a bucket.
DIGITS = 3


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, target) of ``sizes`` (source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = ranked(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_place")
    cycle = F.array(*(F.lit(w) for w in weights))
    sources = sources.withColumn("weight", cycle[(F.col("_place") % len(weights)).cast("int")])
    sources = keep(sources.select("source", "source_size", "weight"), "sources")
    stop = epochs * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full, stopped = 0.0, F.lit(False), -1
    while True:
        # a source that was above its stop once stays there: the level only rises
        full = full | (F.col("weight") * F.lit(level) > stop)
        count, taken, weight = sources.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, stop)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if count == stopped or not weight:
            break
        stopped, level = count, (share * total - (taken or 0)) / weight
        full = F.col("weight") * F.lit(level) > stop
    target = F.when(full, stop.cast("double")).otherwise(F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights=WEIGHTS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per row of ``docs`` (doc_id, text, source).

    ``taken`` counts words, repeats included: it never exceeds ``epochs`` times ``size``.
    """
    taken = drawn(identified(docs, more=["source"]), share, epochs, weights, seed)
    return taken.drop("rid")


def mixed(docs: DataFrame, more: Sequence[str] = (), **settings) -> DataFrame:
    """The mix itself: rows of ``docs`` (doc_id, text, source, *more), as often as they are taken.

    Where a document is taken in part, its row holds the first words of the text, joined by one space.
    """
    docs = identified(docs, more=["source", *more])
    taken = drawn(docs, **settings).where("taken > 0").select("rid", "size", "taken")
    rows = docs.join(keep(taken, "taken"), "rid")
    left = F.col("taken") % F.col("size")
    times = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = F.when(left > 0, F.array(left)).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_part", F.explode(F.concat(F.array_repeat(F.lit(0).cast("long"), times), rest)))
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("_part").cast("int"))
    return rows.select(
        "doc_id", F.when(F.col("_part") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"), "source", *more
    )


def drawn(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights=WEIGHTS, seed: str = SEED) -> DataFrame:
    """``mix`` of rows that ``identified`` has numbered, with their rid."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = docs.select("rid", "doc_id", "source", size_of(F.col("text")).alias("size"), digest.alias("_digest"))
    sized = keep(sized, "sized")
    levels = keep(targets(sized, share, epochs, weights), "targets")
    whole = F.floor(F.try_divide("target", "source_size"))
    rest = F.round("target").cast("long") - whole * F.col("source_size")
    levels = levels.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.coalesce(whole, F.lit(0)).alias("_whole"),
        F.coalesce(rest, F.lit(0)).alias("_rest"),
    )
    rows = sized.join(levels, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("_bucket", F.left("_digest", F.lit(DIGITS)))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    buckets = buckets.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    buckets = buckets.withColumnsRenamed({"source": "_of", "_bucket": "_in"})
    rows = rows.join(buckets, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_bucket") == F.col("_in")))
    cut = (F.col("_start") < F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_sum"))
    order = ["_digest", "doc_id", "size", "rid"]
    inside = Window.partitionBy("source", "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ended = rows.where(cut).withColumn("_before", F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    others = rows.where(~cut).withColumn("_before", F.col("_start"))
    # a bucket before the end is drawn whole, one behind it not at all
    extra = F.when(cut, F.greatest(F.lit(0), F.least("size", F.col("_rest") - F.col("_before"))))
    extra = extra.otherwise(F.when(F.col("_start") < F.col("_rest"), F.col("size")).otherwise(0))
    taken = (F.col("_whole") * F.col("size") + extra).cast("long")
    return ended.union(others).select("rid", "doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
