"""Exact deduplication against a dictionary of texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from starweave.llm import block_names

SCHEMA = "doc_id long, text string, rid string, name string, pos long, n string, level int, place string, block long"


def _texts():
    rng = random.Random(3)
    say = lambda n: "".join(rng.choice("abcDé 日\n") for _ in range(n))
    long = say(400_000)
    texts = [None, "", "", " ", "a", "A", "É", "é", long, long[:-1], long + "x", long.upper().lower(), long]
    for n in (7, 8, 9, 15, 16, 17, 64, 65):  # around the edges of blocks of 8 bytes
        base = "".join(rng.choice("ab") for _ in range(n))
        texts += [base, base.upper(), base[:-1] + "c", base + "a", "c" + base[1:]]
    return texts + ["same text, " * 30] * 40 + [say(rng.randrange(60)) for _ in range(50)]


def _lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").encode()


def _want(rows):
    last, size = {}, {}
    for doc, text, *_ in rows:
        x = _lower(text)
        last[x], size[x] = max(doc, last.get(x, doc)), size.get(x, 0) + 1
    out = {}
    for doc, text, *_ in rows:
        x = _lower(text)
        out[doc] = (last[x], size[x], last[x] == doc, hashlib.sha256(x).hexdigest())
    return out


@pytest.mark.parametrize("size", [8, block_names.BLOCK_BYTES])
def test_groups(spark, size):
    rows = [(k * 3 - 20, text, "r", "n", None, "x", 1, "p", 2) for k, text in enumerate(_texts())]
    if size == 8:  # 17 and more levels of names only once
        rows = [r for r in rows if len(r[1] or "") < 10_000]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = block_names.deduplicated(docs, size).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == _want(rows) and len(got) == len(rows)


def test_names_are_places_in_the_order(spark, monkeypatch):
    words = [None, "", "b", "a", "b", "c", "a", "b"]
    rows = spark.createDataFrame([(k, 0, 1, w) for k, w in enumerate(words)], "rid long, pos long, n long, key string")
    by_hash = [r.key for r in rows.select("key", F.xxhash64("key").alias("h")).distinct().orderBy("h", "key").collect()]
    by_key = sorted(set(words), key=lambda w: (w is not None, w or ""))
    for salts, order in ((1, by_hash), (4, by_hash), (4, by_key)):
        if order is by_key:  # all hashes collide: the keys alone tell names apart
            plain = F.xxhash64
            monkeypatch.setattr(block_names.F, "xxhash64", lambda *c: plain(*c) if c == ("rid", "pos") else F.lit(7).cast("long"))
        got = {r.rid: r.name for r in block_names.named(rows, ["key"], salts).collect()}
        names = {}
        for k, w in enumerate(words):
            assert names.setdefault(w, got[k]) == got[k]
        assert [names[w] for w in order] == sorted(set(names.values())) and len(set(names.values())) == len(names)


def test_a_common_block_is_dealt_out(spark):
    """No group of the first step holds more than a slice of the copies, and one row of each slice goes on."""
    copies, salts = 4000, 64
    rows = spark.range(copies).select("id", F.lit(0).alias("pos"), F.lit(1).alias("n"), F.lit("x" * 100).alias("block"))
    sliced = rows.withColumnRenamed("id", "rid").groupBy(F.pmod(F.xxhash64("rid", "pos"), F.lit(salts))).count()
    assert sliced.agg(F.max("count")).first()[0] < 3 * copies / salts
    assert block_names.named(rows.withColumnRenamed("id", "rid"), ["block"], salts).select("name").distinct().count() == 1


def test_odd_rows(spark):
    rows = [(1, "Ab"), (1, "aB"), (None, "ab"), (None, None), (2, ""), (1, "Ab")]
    got = block_names.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.group_size, r.kept) for r in got) == [(2, False), (2, True), (4, False), (4, False), (4, False), (4, True)]
    assert {r.keep_id for r in got if r.group_size == 4} == {1} and {r.keep_id for r in got if r.group_size == 2} == {2}
    assert block_names.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
