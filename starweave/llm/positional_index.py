"""Benchmark decontamination over a distributed positional inverted index.

Benchmark items become phrases: every ``width`` words in a row, or the whole of a shorter item.
The index holds (term, rid, pos) postings of the corpus, for the terms that are asked for.
A phrase starts from its rarest term (rarity is counted over the whole corpus): each posting
gives a start, offset-adjusted, that the second rarest term must confirm by an equi-join on
(term, rid, pos). What is left is compared word by word with the document.
``near_matches`` allows the two rarest terms to stand up to ``slack`` words off.

No list is gathered per term: postings stay rows, so a frequent term is many rows over many
tasks. Only what a single document holds meets in one row.

Defined results: null and empty texts have no words and no hits; an item without words has no
phrase. Null item ids name no item, though their words still hit. Documents that repeat an id are judged one
by one (``common.identified``). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import identified, keep, let, lower_ascii

WIDTH = 13
#: A document is contaminated if at least one in this many of its words is hit.
ONE_IN = 20
#: Whatever is not a letter or digit of ASCII, after lower-casing, or any code point above it.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def phrases(items: DataFrame, width: int = WIDTH, item_col: str = "item_id") -> DataFrame:
    """(pid, phrase, items): the distinct phrases and the items, as strings, that hold each."""
    words = items.select(F.col(item_col).cast("string").alias("item"), terms(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    cut = words.where(F.size("words") > 0).select(
        "item", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, width))).alias("phrase")
    )
    found = cut.groupBy("phrase").agg(F.collect_set("item").alias("items"))
    return found.select(F.xxhash64("phrase").alias("pid"), "phrase", "items")


def rarest(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """(pid, one, two): the rarest and second rarest (n, term, offset) of phrases whose terms all occur.

    ``two`` is null where a phrase has a single word.
    """
    spelled = asked.select("pid", F.size("phrase").alias("length"), F.posexplode("phrase").alias("offset", "term"))
    wanted = keep(spelled.select("term").distinct(), "terms")
    seen = docs.select(F.explode(terms(F.col("text"))).alias("term"))
    counts = keep(seen.join(wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n")), "counts")
    ordered = F.array_sort(F.collect_list(F.struct("n", "term", "offset")))
    best = spelled.join(counts, "term").groupBy("pid", "length").agg(ordered.alias("by"))
    return best.where(F.size("by") == F.col("length")).select(
        "pid", F.col("by")[0].alias("one"), F.get("by", F.lit(1)).alias("two")
    )


def postings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, rid, pos) of the terms in ``wanted``: the stored index."""
    spread = docs.select("rid", F.posexplode(terms(F.col("text"))).alias("pos", "term"))
    return keep(spread.join(wanted, "term").select("term", "rid", "pos"), "postings")


def _starts(index: DataFrame, chosen: DataFrame, which: str) -> DataFrame:
    """(pid, rid, start): where a phrase starts if a posting is its term ``which``."""
    asked = chosen.select("*", F.col(f"{which}.term").alias("term"), F.col(f"{which}.offset").alias("offset"))
    found = index.join(asked.where("term is not null"), "term").withColumn("start", F.col("pos") - F.col("offset"))
    return found.where("start >= 0").drop("term", "pos", "offset")


def _index(docs: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    chosen = keep(rarest(asked, docs), "rarest")
    wanted = chosen.select("one.term").union(chosen.select("two.term")).where("term is not null").distinct()
    return chosen, postings(docs, keep(wanted, "wanted"))


def phrase_starts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(pid, rid, start) of all places where both rarest terms of a phrase stand as it demands."""
    chosen, index = _index(docs, asked)
    first = _starts(index, chosen, "one").select(
        "pid", "rid", "start", F.col("two.term").alias("term"), (F.col("start") + F.col("two.offset")).alias("pos")
    )
    alone = first.where("term is null").select("pid", "rid", "start")
    return first.join(index, ["term", "rid", "pos"]).select("pid", "rid", "start").union(alone)


def near_matches(docs: DataFrame, asked: DataFrame, slack: int) -> DataFrame:
    """(pid, rid, start, off): proximity matches, the second rarest term up to ``slack`` words off its place.

    ``docs`` has rid and text. Starts are put in cells of ``slack`` + 1 words and compared with
    the same and both neighbouring cells, so the join stays an equi-join.
    """
    chosen, index = _index(docs, asked)
    cell = F.floor(F.col("start") / (slack + 1))
    one = _starts(index, chosen, "one").select("pid", "rid", "start", cell.alias("cell"))
    two = _starts(index, chosen, "two").select("pid", "rid", F.col("start").alias("other"), cell.alias("cell"))
    two = two.withColumn("cell", F.explode(F.array(*(F.col("cell") + d for d in (-1, 0, 1)))))
    off = F.abs(F.col("other") - F.col("start"))
    return (
        one.join(two, ["pid", "rid", "cell"])
        .where(off <= slack)
        .groupBy("pid", "rid", "start")
        .agg(F.min(off).alias("off"))
    )


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, more: Sequence[str] = ()) -> DataFrame:
    """(doc_id, text, *more, n_words, n_hit, items, contaminated) of every row of ``docs``.

    ``items`` are the item ids, as sorted strings, with a phrase in the text.
    """
    docs = identified(docs, more=more)
    asked = keep(phrases(items, width), "phrases")
    places = phrase_starts(docs, asked).distinct().join(asked, "pid")
    listed = places.groupBy("rid").agg(F.collect_list(F.struct("start", "phrase", "items")).alias("places"))

    def judged(row: Column) -> Column:
        words = row["words"]
        fits = lambda p: F.slice(words, p["start"] + 1, F.size(p["phrase"])) == p["phrase"]
        return let(
            F.filter(row["places"], fits),
            lambda true: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.size(F.array_distinct(F.flatten(F.transform(true, _covered)))).cast("long").alias("n_hit"),
                F.array_sort(F.array_distinct(F.flatten(F.transform(true, lambda p: p["items"])))).alias("items"),
            ),
        )

    none = F.array().cast(listed.schema["places"].dataType)
    given = F.struct(terms(F.col("text")).alias("words"), F.coalesce("places", none).alias("places"))
    found = docs.join(listed, "rid", "left").select("doc_id", "text", *more, let(given, judged).alias("j"))
    return found.select("doc_id", "text", *more, "j.*").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))
    )


def _covered(place: Column) -> Column:
    return F.sequence(place["start"], place["start"] + F.size(place["phrase"]) - 1)
