"""Crossmatch against brute force, skewed joins, numbering, pixel and id functions."""

import ast
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starweave.functions.healpix import with_pixel
from starweave.functions.ids import normalize_id
from starweave.functions.sphere import chord
from starweave.operators import membership, star
from starweave.operators.crossmatch import crossmatch, with_cell
from starweave.operators.membership import possible, sieve, without_ids
from starweave.operators.ordering import number_rows
from starweave.operators.skew import hot_keys, repeat_rows, spread_join

PINS = {"anchor_source": "a", "anchor_revision": "1", "partner_source": "p", "partner_revision": "2"}


def vectors(df):
    ra, dec = np.radians(df.ra.to_numpy()), np.radians(df.dec.to_numpy())
    return np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], 1)


def brute(hub, spoke, radius):
    found, points = {}, vectors(spoke)
    for name, at in zip(hub.object_id, vectors(hub)):
        d2 = ((points - at) ** 2).sum(1)
        near = np.where(d2 <= chord(radius) ** 2)[0]
        if len(near):
            found[name] = spoke.object_id[min(near, key=lambda j: (d2[j], spoke.object_id[j]))]
    return found


def catalog(kind, n, prefix, seed):
    rng = np.random.default_rng(seed)
    if kind == "uniform":
        ra, dec = rng.uniform(0, 360, n), rng.uniform(-90, 90, n)
    else:  # a dense clump across ra = 0
        ra, dec = rng.normal(0, 5e-5, n) % 360, rng.normal(0, 5e-5, n)
    return pd.DataFrame({"object_id": [f"{prefix}{i:04d}" for i in range(n)], "ra": ra, "dec": dec})


@pytest.mark.parametrize(("kind", "radius", "leaf"), [("uniform", 36000.0, 64), ("clump", 1.0, 64)])
def test_crossmatch_is_exact(spark, kind, radius, leaf):
    hub, spoke = catalog(kind, 300, "h", 1), catalog(kind, 300, "s", 2)
    # copies of every position: the smallest id must win
    spoke = pd.concat([spoke.assign(object_id="z" + spoke.object_id), spoke], ignore_index=True)
    edges = crossmatch(
        with_cell(spark.createDataFrame(hub), 6), with_cell(spark.createDataFrame(spoke), 5), radius_arcsec=radius, leaf_rows=leaf, **PINS
    )
    assert {r.anchor_id: r.partner_id for r in edges.collect()} == brute(hub, spoke, radius)


def test_cells_crowded_on_one_side_are_joined_as_they_are(spark, monkeypatch):
    hub, spoke = catalog("clump", 3, "h", 1), catalog("clump", 300, "s", 2)
    monkeypatch.setattr("starweave.operators.crossmatch.cut_lineage", None)  # no walk: few pairs to a row
    edges = crossmatch(with_cell(spark.createDataFrame(hub), 6), with_cell(spark.createDataFrame(spoke), 5), **PINS)
    assert {r.anchor_id: r.partner_id for r in edges.collect()} == brute(hub, spoke, 1.0)


def test_positions_are_not_nested_into_pushed_filters(spark):
    sky = spark.range(50).selectExpr("concat('s', id) AS object_id", "id * 7.0D % 360 AS ra", "id * 3.0D - 70 AS dec")
    plan = crossmatch(with_cell(sky, 6), with_cell(sky, 5), **PINS)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert filters and not any("COS(" in line or "FLOOR(" in line for line in filters)
    rows = sky.select((F.col("ra") * 2 + 1).cast("long").alias("row"), "object_id")
    plan = number_rows(rows, [], [], "row", into="at")._jdf.queryExecution().optimizedPlan().toString()
    assert not any("FLOOR(" in line for line in plan.split("\n") if "Filter" in line)


def test_crossmatch_keeps_copies_and_checks_arguments(spark):
    hub = with_cell(spark.createDataFrame([("h", 10.0, 20.0)] * 5, "object_id string, ra double, dec double"), 6)
    assert crossmatch(hub, hub, **PINS).count() == 5
    with pytest.raises(ValueError, match="radius"):
        crossmatch(hub, hub, radius_arcsec=0, **PINS)
    with pytest.raises(ValueError, match="pinned"):
        crossmatch(hub, hub, **{**PINS, "partner_revision": ""})
    with pytest.raises(ValueError, match="does not meet"):
        crossmatch(hub, hub, cell=(6, 1), **PINS)
    plan = crossmatch(hub, hub, **PINS)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_spread_join_equals_plain_join(spark, how, few):
    left = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"))
    right = spark.range(25).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    hot = hot_keys(left, ["k"], limit=10)
    assert hot is not None and hot.table.count() == 51 and hot.few
    if not few:
        hot = replace(hot, few=False)
    spread = spread_join(left, right, ["k"], how, salt_by=["id"], hot=hot)
    plain = left.join(right, ["k"], how)
    key = lambda r: (r["id"], repr(r))
    assert sorted(spread.select(*plain.columns).collect(), key=key) == sorted(plain.collect(), key=key)


@pytest.mark.parametrize("way", [{}, {"few": 10}, {"few": 10, "most": 20}])
def test_rows_without_ids(spark, way):
    """By broadcast, by the sieve and by shuffling both sides: the same rows; a null id is in no set."""
    ids = spark.range(0, 3000, 3).select(F.concat(F.lit("i"), "id").alias("partner_id"))
    rows = spark.range(4000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("i"), F.col("id") % 3500)).alias("partner_id"))
    got = {r.id for r in without_ids(rows, ids, salt_by=["id"], hot_rows=1, **way).collect()}
    assert got == {k for k in range(4000) if k % 7 == 0 or k % 3500 % 3 or k % 3500 >= 3000}


def test_sieve_keeps_members_and_few_others(spark):
    ids = spark.range(20_000).select(F.col("id").alias("partner_id"))
    rows = spark.range(40_000).select(F.col("id").alias("partner_id"))
    marked = possible(rows, "partner_id", sieve(ids, "partner_id", 5000), 5000)
    assert marked.where("_possible and partner_id < 20000").count() == 20_000
    assert marked.where("_possible and partner_id >= 20000").count() < 1500
    # what is surely absent goes on without an exchange
    plan = marked.where(~F.col("_possible"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(partner_id" not in plan


@pytest.mark.parametrize("few", [10, 200_000])
def test_only_wanted_rows_are_counted(spark, few, monkeypatch):
    """Rows that no edge points to are neither shuffled to be counted nor to be joined with many edges."""
    monkeypatch.setattr(membership.few_rows, "__defaults__", (few,))
    monkeypatch.setattr(membership.among, "__kwdefaults__", membership.among.__kwdefaults__ | {"few": few})
    key = F.col("id")
    name = F.concat(F.lit("p"), key).alias("partner_id")
    edges = spark.range(500).select(
        F.lit(4).alias("norder"), (key % 3).alias("npix"), F.concat(F.lit("a"), key).alias("anchor_id"), F.lit("p").alias("source"), name
    )
    cells = spark.createDataFrame([(4, n, "p", 5, 7) for n in range(3)], "norder int, npix long, source string, partner_norder int, partner_npix long")
    place = [F.lit("p").alias("source"), F.lit(5).alias("partner_norder"), F.lit(7).cast("long").alias("partner_npix")]
    rows = spark.range(20_000).select(*place, name)
    passed = membership.among(rows, edges)
    assert 500 <= passed.count() < 1500 and passed.join(edges, "partner_id").count() == 500
    rows = rows.unionByName(spark.range(5).select(*place, name))
    counted = []
    monkeypatch.setattr(star, "among", lambda *args: counted.append(membership.among(*args)) or counted[-1])
    found = {r.partner_id: r.copies for r in star.lookups(edges, cells, rows).collect()}
    assert found == {f"p{k}": 2 if k < 5 else 1 for k in range(500)}
    met = star.meet(edges, cells.drop("source"), rows.drop("source")).collect()
    assert len(met) == 505 and all(r.anchor_id[1:] == r.partner_id[1:] for r in met)
    assert counted and all(df.count() < 1500 for df in counted)


def test_pointers_meet_their_own_rows_only(spark):
    """No pointer is multiplied by the partitions that its anchor cell refers to, and few edges leave the rows in place."""
    cells = spark.range(50).select(F.lit(3).alias("norder"), F.lit(1).alias("npix"), F.lit("s").alias("source"), F.lit(5).alias("partner_norder"), F.col("id").alias("partner_npix"))
    edges = spark.range(40).select(F.lit(3).alias("norder"), F.lit(1).alias("npix"), F.col("id").alias("anchor_id"), F.lit("s").alias("source"), F.concat(F.lit("p"), F.col("id") % 30).alias("partner_id"))
    rows = spark.range(200).select(F.lit(5).alias("partner_norder"), (F.col("id") % 60).alias("partner_npix"), F.concat(F.lit("p"), F.col("id") % 100).alias("partner_id"), "id")
    here = {}
    for k in range(200):
        if k % 60 < 50:
            here.setdefault(f"p{k % 100}", []).append(k)
    want = sorted((a, k) for a in range(40) for k in here.get(f"p{a % 30}", []))
    met = star.meet(edges, cells, rows)
    assert sorted((r.anchor_id, r.id) for r in met.collect()) == want
    assert "hashpartitioning(partner_id" not in met._jdf.queryExecution().executedPlan().toString()
    ids = rows.select(F.lit("s").alias("source"), "partner_norder", "partner_npix", "partner_id")
    found = {r.partner_id: r.copies for r in star.lookups(edges, cells, ids).collect()}
    assert found == {f"p{k}": len(here.get(f"p{k}", [])) for k in range(30)}


def test_numbering_and_repeating(spark):
    df = spark.range(200).select((F.col("id") % 2).alias("g"), (F.col("id") % 5).alias("f"), (F.col("id") * 3).alias("r"))
    got = {(r.g, r.f, r.r): (r.at, r.n) for r in number_rows(df, ["g"], ["f"], "r", "at", "n", block_rows=16).collect()}
    for g in (0, 1):
        order = sorted(k for k in got if k[0] == g)
        assert [got[k] for k in order] == [(i, 100) for i in range(100)]
    copies = spark.createDataFrame([("a", 25), ("b", 1)], "x string, n long")
    assert {r["x"]: r["count"] for r in repeat_rows(copies, "n", chunk=10).groupBy("x").count().collect()} == {"a": 25, "b": 1}


def test_pixels_match_published_values(spark):
    rows = [(0.0, 0.0), (45.0, 41.8), (0.0, 90.0), (360.0, -90.0), (-1e-20, 10.0)]
    df = spark.createDataFrame(rows, "ra double, dec double")
    four = [r["p"] for r in with_pixel(df, 4, "p").collect()]
    assert four == [1130, 63, 255, 2048, 1228]
    deep = with_pixel(with_pixel(df, 29, "d"), 6, "p").collect()
    assert all(r["d"] >> 46 == r["p"] for r in deep)


@pytest.mark.parametrize("text", ["b'    42'", "b'a\\\\b\\x41\\n'", "b'it\\'s'", "b''", "b'\\101\\t'", "b'bad", "  x\t"])
def test_ids_like_python(spark, text):
    df = spark.createDataFrame([(text,)], "v string")
    try:
        want = ast.literal_eval(text).decode()
    except (SyntaxError, ValueError, AttributeError):
        want = text
    assert df.select(normalize_id(df, "v", True)).first()[0] == want.strip()
    assert df.select(normalize_id(df, "v", False)).first()[0] == text


def test_pixels_are_made_of_whole_numbers(spark):
    """Missing, endless and wrapped positions have the pixels they always had, and no pixel goes through its digits as a text."""
    inf, nan = float("inf"), float("nan")
    odd = [(None, 1.0), (1.0, None), (nan, 5.0), (5.0, nan), (inf, 2.0), (2.0, inf), (-1e-20, 0.0), (360.0, 90.0), (725.0, -90.0), (0.0, 89.9999999)]
    want = [-1, 2594073385365405695, 1372475556631677955, 288230376151711743, 1369361726766582979, 288230376151711743, 1273017494670060202, 288230376151711743, 2305843009213693952, 288230376151711742]
    wide = spark.createDataFrame(odd, "ra double, dec double").coalesce(1)
    pixels = with_pixel(wide, 29, "pixel").select("pixel")
    assert [r.pixel for r in pixels.collect()] == want and not pixels.schema["pixel"].nullable
    assert "conv(" not in pixels._jdf.queryExecution().optimizedPlan().toString()
