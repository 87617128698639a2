"""Spelling variants: which words of a corpus differ by one edit, and which is the usual form.

Words are counted over whole texts. A near pair is one inserted, deleted or replaced code point apart, so
the shorter word (length m) has an edit in its first or in its second half, and the pair agrees
on everything outside that half. Words that agree so meet in a group. A group of more than ``CROWD`` words is not compared
but halved again where its words do not agree yet, down to a single code point, where a group holds one
word per letter and per pair of letters at most. Nothing is capped: a crowded prefix or ending only takes more rounds.

Within a group the parts that may differ form a sorted list, which is scanned for each of its entries by dynamic programming.
Of the edit matrix only a band of three cells a row can stay within one edit. An entry of the list reuses the rows of the prefix that it
shares with the one before it, and where a row exceeds one edit in every cell the scan goes on behind the
last entry with that prefix.

Defined results: null and empty texts have no words. A null id counts as an empty one in the checksum that picks
the words to damage. Rows that repeat an id count each. Of near words that are equally frequent the smallest in code-point
order is the form. An empty table, or one without words frequent enough, gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep

LETTERS = "a-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One in so many words of a document loses a code point.
DAMAGED = 97
#: A form is at least so many times as frequent as the word.
TIMES = 2
#: Groups of more words are halved.
CROWD = 200
#: Words that a task counts before it hands them on.
HELD = 400_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def vocabulary(docs: DataFrame, length: int = LEAST_LENGTH, least: int = LEAST_COUNT, damaged: int = DAMAGED) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) with ``length`` code points and ``least`` occurrences or more."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{LETTERS}]{{{length},}}").findall
        held: dict[str, int] = {}
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for doc, data in zip(batch.column(0), texts):
                data = data.as_py()
                if not data:
                    continue
                doc = doc.as_py()
                seed = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for run, n in Counter(find(data.translate(_LOWER).decode())).items():
                    h = zlib.crc32(run.encode(), seed)
                    if h % damaged == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < length:
                            continue
                    held[run] = held.get(run, 0) + n
                if len(held) > HELD:
                    yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})
                    held = {}
        if held:
            yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(emit, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def _rows() -> list[int]:
    """What follows each row of the banded matrix: by row and by which of the three query letters the next letter equals.

    A row belongs to a prefix of d code points of the list's word and holds the costs of turning it into the first
    d - 1, d and d + 1 of the query, 2 being more than one edit. Its number is 8 * (9 * first + 3 * second + third).
    """
    following = []
    for left, middle, right in product(range(3), repeat=3):
        for equal in range(8):
            first = min(left + 1 - (equal & 1), middle + 1, 2)
            second = min(middle + 1 - (equal >> 1 & 1), right + 1, first + 1, 2)
            third = min(right + 1 - (equal >> 2), second + 1, 2)
            following.append(8 * (9 * first + 3 * second + third))
    return following


_NEXT = _rows()
_START, _LOST = 8 * (9 * 2 + 3 * 0 + 1), 8 * 26


def close_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """The index pairs, smaller first, of sorted distinct ``words`` that are exactly one edit apart."""
    number, following = len(words), _NEXT
    shared = [0] * number  # code points in common with the word before
    for k in range(1, number):
        one, two = words[k - 1], words[k]
        while shared[k] < min(len(one), len(two)) and one[shared[k]] == two[shared[k]]:
            shared[k] += 1
    past = [number] * number  # the next word that shares less with the one before it
    for k in range(number - 2, 0, -1):
        past[k] = k + 1
        while past[k] < number and shared[past[k]] >= shared[k]:
            past[k] = past[past[k]]
    width = max(map(len, words), default=0)
    rows = [_START] * (width + 1)
    for start, query in enumerate(words):
        # cells beyond the query's end meet no letter, and none before it depends on them
        padded = "\0" + query + "\0" * (width + 2)
        at, depth = start + 1, 0
        while at < number:
            word = words[at]
            if depth > shared[at]:
                depth = shared[at]
            row = rows[depth]
            for letter in word[depth:]:
                row = following[row + (padded[depth] == letter) + 2 * (padded[depth + 1] == letter) + 4 * (padded[depth + 2] == letter)]
                depth += 1
                if row == _LOST:
                    break
                rows[depth] = row
            at += 1
            if row == _LOST:
                while at < number and shared[at] >= depth:
                    at = past[at]
            elif abs(len(query) - len(word)) < 2 and row // 8 // 3 ** (len(word) - len(query) + 1) % 3 == 1:
                yield start, at - 1


_GROUP = ["m", "lo", "hi", "head", "tail"]


def _halved(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, longer, m, lo, hi) once for each half of the places lo to hi, with what lies outside of it."""
    middle = F.shiftright(F.col("lo") + F.col("hi"), 1)
    halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    rows = rows.select("word", "n", "longer", "m", F.explode(halves).alias("half")).select("word", "n", "longer", "m", "half.*")
    rows = rows.where("lo < hi")
    tail = F.col("m") - F.col("hi")
    size = F.char_length("word")
    cut: Column = F.substring("word", F.col("lo") + 1, size - tail - F.col("lo"))
    return rows.select(
        "*", F.substring("word", F.lit(1), F.col("lo")).alias("head"), F.substring("word", size - tail + 1, tail).alias("tail"), cut.alias("part")
    )


def groups(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(m, lo, hi, head, tail, part, word, n, longer): ``words`` (word, n) in groups that hold every near pair.

    In a group words of ``m`` code points, and of one more (``longer``), agree on ``head`` and ``tail`` and differ in ``part``.
    """
    own = F.array(F.struct(F.lit(False).alias("longer"), F.char_length("word").alias("m")), F.struct(F.lit(True).alias("longer"), (F.char_length("word") - 1).alias("m")))
    rows = words.select("word", "n", F.explode(own).alias("own")).select("word", "n", "own.*").where("m > 0")
    rows = rows.withColumn("lo", F.lit(0)).withColumn("hi", F.col("m"))
    found = None
    while True:
        rows = _halved(rows)
        sizes = rows.groupBy(*_GROUP).agg(F.count("*").alias("size"), F.count(F.when(~F.col("longer"), 1)).alias("short"))
        sizes = sizes.where("size > 1 and short > 0").drop("short")
        rows = keep(rows.join(sizes, _GROUP), "groups")
        done = (F.col("size") <= crowd) | (F.col("hi") - F.col("lo") == 1)
        ready = rows.where(done).drop("size")
        found = ready if found is None else found.union(ready)
        rows = rows.where(~done).select("word", "n", "longer", "m", "lo", "hi")
        if not rows.head(1):
            return found


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n, near, near_n): every pair of ``words`` (word, n) that is one edit apart, both ways round."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns))

        out: list[tuple] = []
        for _, group in groupby(rows(), key=lambda r: r[:5]):
            members = list(group)
            for i, j in close_pairs([r[5] for r in members]):
                (*_, one, n, longer), (*_, two, m, longest) = members[i], members[j]
                if not (longer and longest):
                    out += [(one, n, two, m), (two, m, one, n)]
            if len(out) > 50_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    placed = groups(words, crowd).select(*_GROUP, "part", "word", "n", "longer")
    placed = placed.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "part")
    return placed.mapInArrow(emit, "word string, n long, near string, near_n long").distinct()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 4
    kinds = (pa.string(), pa.int64()) * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n", "near", "near_n"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where each of ``forms`` (word, form) ends when forms are followed; pointers double in every round."""
    up = keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = keep(up.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not up.where("moved").head(1):
            return up.drop("moved")
        up = up.drop("moved")


def variants(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n), which are distinct."""
    words = keep(words, "words")
    rarest_first = F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))
    best = near_words(words, crowd).groupBy("word").agg(F.count("*").alias("n_near"), F.min(rarest_first).alias("best"))
    usual = -F.col("best.n") >= TIMES * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", F.when(usual, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(usual, -F.col("best.n")).alias("form_n"),
    )
    found = keep(found, "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
