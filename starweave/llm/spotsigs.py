"""SpotSigs document fingerprints: what follows the common words of a text.

Each occurrence of an anchor, a common word of its language, heads a chain of the next ``CHAIN`` content words
(words that are no anchors); anchor and chain form a spot signature. With ``stretch``, as the query has it, a
chain of the next ``CHAIN`` words also starts at each word from which ``stretch`` words, or all up to the end of the
text, are all anchors or all none. So what a text is signed by depends on the place alone: an edit
changes the signatures that reach into it and, at the old end of the text, ``stretch`` words at most.
Without ``stretch`` only spot signatures count, and a text that has none has a chain at every word.
The fingerprint is the sorted set of signatures, 8 hex digits each, so two
fingerprints can be compared without their texts. Likeness is the Jaccard similarity of
the sets, pruned: sets whose lengths alone rule out the demanded similarity are not intersected,
and ``matches`` brings together only sets in the same or a neighbouring partition of lengths.

Defined results: null and empty texts have the empty fingerprint; two equal fingerprints have
likeness 1, also empty ones. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import identified, let

CHAIN = 2
#: As many words in a row without an anchor, or of anchors alone, head a chain of their own.
STRETCH = 8
#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is it that for as with on by at be this are from or an a was he not "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le la les de des et un une du en que qui dans pour par sur au est pas ne se ce il avec "
    "el los las de y que en un una por con para su al lo como más se no del"
).split()
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def signatures(text: Column, stretch: int | None = None) -> Column:
    """The sorted set of spot signatures of a text, as array<int>; with ``stretch`` also those of even stretches."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")
    anchors = sorted(set(ANCHORS))

    def split_up(w: Column) -> Column:
        at = F.filter(F.transform(w, lambda x, i: F.when(x.isin(anchors), i)), lambda i: i.isNotNull())
        between = F.filter(F.transform(w, lambda x, i: F.when(~x.isin(anchors), i)), lambda i: i.isNotNull())
        fields = [w.alias("w"), at.alias("at"), F.filter(w, lambda x: ~x.isin(anchors)).alias("content")]
        return F.struct(*fields, *([between.alias("between")] if stretch else []))

    def chains(s: Column) -> Column:
        # the k-th anchor at word i has i - k content words before it
        chain = lambda i, k: [F.get(s["content"], i - k + j) for j in range(CHAIN)]
        spot = F.transform(
            s["at"],
            lambda i, k: F.when(i - k + CHAIN <= F.size(s["content"]), F.hash(F.get(s["w"], i), *chain(i, k))),
        )
        spot = F.filter(spot, lambda x: x.isNotNull())
        following = lambda i: F.hash(*(F.get(s["w"], i + j) for j in range(CHAIN + 1)))
        if stretch:
            even = F.concat(_stretched(s["between"], F.size(s["w"]), stretch), _stretched(s["at"], F.size(s["w"]), stretch))
            return F.concat(spot, F.transform(even, following))
        plain = F.transform(s["w"], lambda x, i: following(i))
        return let(spot, lambda found: F.when(F.size(found) > 0, found).otherwise(plain))

    return F.array_sort(F.array_distinct(let(let(words, split_up), chains)))


def _stretched(at: Column, n: Column, stretch: int) -> Column:
    """Those of the ascending word places ``at`` from which ``stretch`` places, or all up to the ``n`` of the text, are in it."""

    def holds(i: Column, k: Column) -> Column:
        steps = F.least(F.lit(stretch - 1), n - 1 - i)
        return F.coalesce(F.get(at, k + steps) == i + steps, F.lit(False))

    return F.filter(at, holds)


def spelled(signs: Column) -> Column:
    """A fingerprint as a string."""
    return F.array_join(F.transform(signs, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 where their lengths prune it below ``at_least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    jaccard = let(both, lambda n: n / (F.size(a) + F.size(b) - n))
    pruned = (small == 0) | (small < at_least * large)
    return F.when(a == b, 1.0).when(pruned, 0.0).otherwise(jaccard)


def followed(docs: DataFrame) -> DataFrame:
    """``docs`` (rid, ...) with ``next``, the row behind each in the order of rid; the first follows the last.

    Rows move once, into ranges of rid that hold about as many rows each. The first row of a range goes
    to the range before it as well, so that each range finds all its followers at home.
    """
    spark = docs.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx("rid", F.lit(grid).cast("array<double>"), F.lit(20_000)).alias("b")).first().b
    part = _range_of(F.col("rid"), sorted(set(bounds or [])))
    # one row per range
    heads = sorted(docs.groupBy(part.alias("p")).agg(F.min("rid").alias("rid")).collect())
    before = [(head.rid, heads[k - 1].p) for k, head in enumerate(heads)]
    guests = spark.createDataFrame(before, "rid long, _to int")
    own, guest = F.struct(part.alias("p"), F.lit(False).alias("guest")), F.struct(F.col("_to").alias("p"), F.lit(True).alias("guest"))
    homes = F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, guest))
    placed = docs.join(F.broadcast(guests), "rid", "left").withColumn("_home", F.explode(homes)).drop("_to")
    names = [c for c in docs.columns if c != "rid"]
    ordered = Window.partitionBy("_home.p").orderBy("_home.guest", "rid")
    lead = F.lead(F.struct(*names)).over(ordered).alias("next")
    return placed.select("*", lead).where("not _home.guest").drop("_home")


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are below ``value``: a search in blocks, then within one."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*(F.lit(b[0]).cast("long") for b in blocks))
    below = lambda xs: F.size(F.filter(xs, lambda x: x < value))
    block = F.greatest(below(heads) - 1, F.lit(0))
    return let(block, lambda k: k * width + below(F.array(*(F.array(*(F.lit(x).cast("long") for x in b)) for b in blocks))[k])).cast("int")


def edited_fingerprints(docs: DataFrame, stretch: int | None = None) -> DataFrame:
    """Fingerprints of texts and of their edited forms, and how alike they are.

    The edited text ends, in place of its last quarter, with as many first characters of the next
    text (or all of it). Columns: doc_id, n_chars, edited, signs, edited_signs, near_edited, near_next.
    """
    texts = identified(docs).select("rid", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = followed(texts.withColumn("signs", signatures(F.col("text"), stretch)))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - quarter), F.left(F.col("next.text"), quarter))
    made = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "signs", "next.signs")
    made = made.toDF("doc_id", "n_chars", "edited", "signs", "next_signs")
    made = made.withColumn("edited_signs", signatures(F.col("edited"), stretch))
    return made.withColumns(
        {
            "near_edited": likeness(F.col("signs"), F.col("edited_signs")),
            "near_next": likeness(F.col("signs"), F.col("next_signs")),
        }
    )


def matches(asked: DataFrame, corpus: DataFrame, at_least: float) -> DataFrame:
    """(query, rid, likeness): rows of ``corpus`` at least that like a stated set of queries; both (rid, signs).

    Lengths fall into partitions whose bounds grow by 1 / ``at_least``, so a match lies in the
    same or a neighbouring one. A pair must share one of the first signatures of each, as many
    as can all be missed by no match; signatures are ordered by their hash. Empty fingerprints share none
and match nothing, not even each other.
    """
    part = F.floor(F.log(F.size("signs").cast("double")) / math.log(1 / at_least) + 1e-9)
    few = F.size("signs") - F.ceil(F.size("signs") * at_least - 1e-9) + 1
    heads = lambda df: df.where(F.size("signs") > 0).select(
        "rid", "signs", part.alias("part"), F.explode(F.slice("signs", 1, few.cast("int"))).alias("sign")
    )
    left = heads(asked).select(F.col("rid").alias("query"), F.col("signs").alias("own"), "part", "sign")
    left = left.withColumn("part", F.explode(F.array(*(F.col("part") + d for d in (-1, 0, 1)))))
    near = likeness(F.col("own"), F.col("signs"), at_least)
    small, large = F.least(F.size("own"), F.size("signs")), F.greatest(F.size("own"), F.size("signs"))
    met = left.join(heads(corpus), ["part", "sign"]).where(small >= at_least * large)
    found = met.select("query", "rid", near.alias("likeness")).where(F.col("likeness") >= at_least)
    return found.distinct()
