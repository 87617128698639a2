"""MinHash near-dedup with odd sketches.

Each text becomes its set of word shingles, ``BANDS * ROWS`` MinHash samples of the set, and two
odd sketches: bitmaps in which every sample, or every shingle, flips one bit. What two texts share cancels
in the XOR of their bitmaps. For the samples its population count estimates how many differ, most precisely
where few do; for the whole sets it is never more than the shingles that only one text has, so
a pair of short texts is mostly decided by it. A bitmap takes 64 bytes a text.

Texts with equal sets collapse first. Bands of samples then name buckets, and

1. in steps, every member of a bucket outside its centre's component is paired with the centre, which a seed picks, and
   pairs whose sketches differ too much are dropped. Each text's nearest pairs are confirmed on the full sets first, then
   those that still join two components. Buckets whose members lie in one component take no further part;
2. texts in buckets that still hold several components are posted under their rarest shingles, so many
   that any two linked texts share one; pairs across components that meet there, and whose sizes,
   places in the lists and sketches allow a link, are confirmed on the full sets, and components are drawn again.

So no link between members of one bucket is lost, whatever the bucket's size, and a member of a large group meets one
centre per seed and bucket, mostly the same. What the second part compares are texts that no centre joined: it takes pairs of
their components that the sketches cannot tell apart, which for texts of a few hundred words are hardly more than the links.
Two texts at the threshold (0.8) share none of 40 bands of 6 with a probability
of 5e-6, and fail the sketch test with 1e-7.

Defined results: null, empty and blank texts have no shingles and are linked with nothing. A
text of fewer words than a shingle has one shingle, all its words. Rows that repeat an id are
documents of their own (``common.identified``). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import identified, keep, small_batches
from .components import components
from .hashing import GOLDEN, U, mix, word_chunks
from .recompression import packed_texts

BANDS, ROWS = 40, 6
BITS = 512
#: Seeds by which buckets pick their centres, step by step.
STEPS = ((0,), (1, 2), (3, 4, 5))
SHINGLE = 5
PERCENT = 80
#: Pairs with a centre that a text has confirmed at a time; the last time takes all that are left.
PICKS = (1, None)

_SAMPLES = BANDS * ROWS
_SEEDS = np.random.default_rng(7).integers(1, 2**32, (2, _SAMPLES), dtype=np.uint64).astype(np.uint32)
_SEEDS[0] |= np.uint32(1)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of ``size`` words in a row."""
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    value = np.full(n - width + 1, U(width))
    for k in range(width):
        value = mix(value * GOLDEN + words[k : n - width + 1 + k])
    return np.unique(value)


def min_samples(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> U(32)).astype(np.uint32)
    best = np.full(_SAMPLES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 2048):
        values = low[k : k + 2048] * _SEEDS[0][:, None] + _SEEDS[1][:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    grid = samples.reshape(BANDS, ROWS).astype(U)
    key = mix(np.arange(1, BANDS + 1, dtype=U))
    for k in range(ROWS):
        key = mix(key * GOLDEN + grid[:, k])
    return key


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    flips = mix(samples.astype(U) * GOLDEN + np.arange(_SAMPLES, dtype=U)) % U(BITS)
    bits = (np.bincount(flips.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def set_sketch(shingles: np.ndarray) -> np.ndarray:
    """The odd sketch of the whole set."""
    bits = (np.bincount((shingles % U(BITS)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def most_flips(percent: int) -> int:
    """The XOR population count that a pair at the threshold exceeds with a chance of about 1e-7."""
    # of the samples, a binomial number differs; each of those flips two bits
    share = 1 - percent / 100
    differ = _SAMPLES * share + 5.2 * np.sqrt(_SAMPLES * share * (1 - share))
    mean = BITS / 2 * (1 - np.exp(-2 * 2 * differ / BITS))
    return int(np.ceil(mean + 1.5 * np.sqrt(BITS) / 2))


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(rid, doc_id, n, set_a, set_b, bands, sketch, whole) of every row of ``docs`` (rid, doc_id, text)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, counts in word_chunks(batch.column(2), lower=True):
                ends = np.cumsum(counts)
                n, set_a, set_b, bands, flips, whole = [], [], [], [], [], []
                for begin, end in zip(ends - counts, ends):
                    found = shingle_set(hashes[begin:end], shingle)
                    n.append(len(found))
                    set_a.append(int(mix(found).sum(dtype=U)))
                    set_b.append(int(mix(found ^ GOLDEN).sum(dtype=U)))
                    samples = min_samples(found) if len(found) else None
                    bands.append(band_keys(samples).view(np.int64) if len(found) else np.zeros(0, np.int64))
                    flips.append(odd_sketch(samples) if len(found) else np.zeros(BITS // 64, np.int64))
                    whole.append(set_sketch(found))
                yield pa.RecordBatch.from_pydict(
                    {
                        "rid": batch.column(0).slice(first, last - first),
                        "doc_id": batch.column(1).slice(first, last - first),
                        "n": pa.array(n, pa.int64()),
                        "set_a": pa.array(np.array(set_a, U).view(np.int64)),
                        "set_b": pa.array(np.array(set_b, U).view(np.int64)),
                        "bands": _lists(bands),
                        "sketch": _lists(flips),
                        "whole": _lists(whole),
                    }
                )

    schema = "rid long, doc_id long, n long, set_a long, set_b long, bands array<long>, sketch array<long>, whole array<long>"
    return docs.select("rid", "doc_id", "text").mapInArrow(emit, schema)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(arrays)))


def _flips(left: str, right: str, kind: str) -> Column:
    return sum(F.bit_count(F.col(f"{left}.{kind}{k}").bitwiseXOR(F.col(f"{right}.{kind}{k}"))) for k in range(BITS // 64))


def _alike(left: str, right: str, percent: int) -> Column:
    """Sizes and sketches of two rows allow a similarity of ``percent``."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    # a link leaves (100 - percent) / (100 + percent) of both sizes unshared at most, and flips no more bits
    sets = (100 + percent) * _flips(left, right, "w") <= (100 - percent) * (n + m)
    return sizes & sets & (_flips(left, right, "s") <= most_flips(percent))


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach ``percent``; ``texts`` is (rid, packed)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets(column: pa.Array) -> Iterator[np.ndarray]:
            known, code = {}, column.dictionary_encode()
            for at in code.indices:
                if at not in known:
                    known[at] = shingle_set(_words(code.dictionary[at.as_py()]), shingle)
                    if len(known) > 500:
                        known = {at: known[at]}
                yield known[at]

        for batch in batches:
            good = []
            for one, two in zip(sets(batch.column(2)), sets(batch.column(3))):
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = texts.select(F.col("rid").alias("a"), F.col("packed").alias("text_a"))
    right = texts.select(F.col("rid").alias("b"), F.col("packed").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(emit, "a long, b long")


def postings(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(rid, n, shingle, place): the rarest shingles of each of ``texts`` (rid, packed), as many as all links share one of.

    Two texts that reach ``percent`` share a shingle among the first n - ceil(percent * n / 100) + 1 of
    each, in any common order; rare ones first makes such a meeting rare.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = shingle_set(_words(packed), shingle)
                rids, n = np.full(len(found), rid), np.full(len(found), len(found))
                yield pa.RecordBatch.from_pydict({"rid": rids, "n": n, "shingle": found.view(np.int64)})

    spread = texts.select("rid", "packed").mapInArrow(emit, "rid long, n long, shingle long")
    spread = keep(spread, "spread")
    counts = spread.groupBy("shingle").agg(F.count("*").alias("texts"))
    spread = spread.join(counts, "shingle")
    rare_first = Window.partitionBy("rid").orderBy("texts", "shingle")
    placed = spread.withColumn("place", F.row_number().over(rare_first).cast("long"))
    wanted = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    return placed.where((F.col("texts") > 1) & (F.col("place") <= wanted)).drop("texts")


def _candidates(posted: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) in different components that share a posting and whose sizes, places and sketches allow a link.

    In each list the rows of its largest component are met by the other rows only, not by each other.
    """
    sizes = posted.groupBy("shingle", "component").agg(F.count("*").alias("rows"))
    largest = sizes.groupBy("shingle").agg(F.max_by("component", F.struct("rows", "component")).alias("largest"), F.count("*").alias("parts"))
    mixed = posted.join(largest.where("parts > 1").drop("parts"), "shingle")
    x, y = mixed.where("component <> largest").alias("x"), mixed.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    ahead = 1 + F.least(n - F.col("x.place"), m - F.col("y.place"))  # they share no more than this
    met = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.component") != F.col("y.component"))
        & ((100 + percent) * ahead >= percent * (n + m))
        & _alike("x", "y", percent),
    )
    return met.select(F.least("x.rid", "y.rid").alias("a"), F.greatest("x.rid", "y.rid").alias("b")).distinct()


def _words(packed: pa.Scalar) -> np.ndarray:
    import zstandard

    text = pa.array([zstandard.ZstdDecompressor().decompress(packed.as_py()).decode()])
    return next(word_chunks(text, lower=True))[2]


def _across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose texts lie in different components."""
    a = label.select(F.col("id").alias("a"), F.col("component").alias("_a"))
    b = label.select(F.col("id").alias("b"), F.col("component").alias("_b"))
    return pairs.join(a, "a").join(b, "b").where("_a <> _b").drop("_a", "_b")


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (id, component) after the components that ``links`` (a, b) join have become one."""
    a = label.select(F.col("id").alias("a"), F.col("component").alias("_a"))
    b = label.select(F.col("id").alias("b"), F.col("component").alias("_b"))
    edges = links.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    top = components(edges).select(F.col("id").alias("component"), F.col("component").alias("_top"))
    return label.join(top, "component", "left").select("id", F.coalesce("_top", "component").alias("component"))


def _stars(crowded: DataFrame, signs: DataFrame, seeds: Sequence[int], percent: int) -> DataFrame:
    """(a, b, flips): members of the buckets ``crowded`` (key, rep, component) with their centres in other components, if alike."""
    centre = [F.min_by(F.struct("rep", "component"), F.xxhash64("rep", F.lit(seed))) for seed in seeds]
    # bands of one seed mostly agree on the centre of a group
    buckets = crowded.groupBy("key").agg(F.array(*centre).alias("centres"))
    met = crowded.join(buckets, "key").select("rep", "component", F.explode("centres").alias("centre"))
    met = met.where("component <> centre.component").select(F.col("rep").alias("a"), F.col("centre.rep").alias("b")).distinct()
    x, y = signs.alias("x"), signs.alias("y")
    met = met.join(x, F.col("a") == F.col("x.id")).join(y, (F.col("b") == F.col("y.id")) & _alike("x", "y", percent))
    return met.select("a", "b", _flips("x", "y", "s").alias("flips"))


def _still_mixed(crowded: DataFrame, label: DataFrame) -> DataFrame:
    """The buckets ``crowded`` (key, rep) that hold several components, with those."""
    known = crowded.select("key", "rep").join(label.withColumnRenamed("id", "rep"), "rep")
    mixed = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return known.join(mixed.where("low < high").select("key"), "key").select("key", "rep", "component")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(rid, doc_id, n_shingles, component, component_id, kept) for every row of ``docs``.

    ``component`` is the smallest rid reachable over links of at least ``percent``; of each
    component the row with that rid is kept.
    """
    return linked(identified(docs), shingle, percent)


def deduplicated(docs: DataFrame, more: Sequence[str], shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, *more) that are kept: one of each component."""
    docs = identified(docs, more=more)
    kept = keep(linked(docs, shingle, percent).where("kept").select("rid"), "kept")
    return docs.join(kept, "rid", "left_semi").select("doc_id", "text", *more)


def linked(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``near_duplicates`` of rows that ``identified`` has numbered."""
    small_batches(docs.sparkSession)
    drawn = keep(sketches(docs, shingle), "sketches")
    same = ["set_a", "set_b", "n"]
    unique = drawn.where("n > 0").groupBy(*same).agg(
        F.min("rid").alias("rep"), *(F.first(c).alias(c) for c in ("bands", "sketch", "whole"))
    )
    unique = keep(unique, "unique")
    members = unique.select("rep", F.posexplode("bands").alias("band", "key")).drop("band")
    buckets = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    crowded = members.join(buckets.select("key"), "key").withColumn("component", F.col("rep"))
    crowded = keep(crowded, "crowded")

    words = [F.col(c)[k].alias(f"{c[0]}{k}") for c in ("sketch", "whole") for k in range(BITS // 64)]
    signs = unique.select(F.col("rep").alias("id"), "n", *words)
    involved = crowded.select(F.col("rep").alias("rid")).distinct()
    texts = keep(packed_texts(docs).join(involved, "rid"), "texts")
    label = involved.select(F.col("rid").alias("id"), F.col("rid").alias("component"))
    for seeds in STEPS:
        stars = keep(_stars(crowded, signs, seeds, percent), "stars")
        for picks in PICKS:
            nearest = Window.partitionBy("a").orderBy("flips", "b")
            ranked = stars.withColumn("rank", F.row_number().over(nearest))
            taken = ranked if picks is None else ranked.where(F.col("rank") <= picks)
            good = keep(confirmed(taken.select("a", "b"), texts, shingle, percent), "links")
            label = keep(_merged(label, good), "labels")
            if picks is not None:  # links within a component need no test
                stars = keep(_across(ranked.where(F.col("rank") > picks).drop("rank"), label), "stars")
        crowded = keep(_still_mixed(crowded, label), "crowded")

    wanted = crowded.select(F.col("rep").alias("rid")).distinct()
    posted = postings(texts.join(wanted, "rid"), shingle, percent)
    labelled = posted.join(label.withColumnRenamed("id", "rid"), "rid").join(signs.drop("n"), F.col("rid") == F.col("id"))
    labelled = keep(labelled.drop("id"), "labelled")
    across = keep(_candidates(labelled, percent), "across")
    second = keep(confirmed(across, texts, shingle, percent), "links")
    final = _merged(label, second)

    sets = unique.select(*same, "rep")
    placed = drawn.select("rid", "doc_id", *same).join(sets, same, "left")
    placed = placed.join(final.withColumnRenamed("id", "rep"), "rep", "left")
    placed = placed.withColumn("component", F.coalesce("component", "rep", "rid"))
    heads = drawn.select(F.col("rid").alias("component"), F.col("doc_id").alias("component_id"))
    return placed.join(heads, "component").select(
        "rid", "doc_id", F.col("n").alias("n_shingles"), "component", "component_id",
        (F.col("rid") == F.col("component")).alias("kept"),
    )
