"""Footprints and reach of cells, and the files that an index build opens."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from small_sky import HUB, Sky

from starweave import build_index
from starweave.functions.healpix import with_pixel
from starweave.operators import crossmatch as module
from starweave.plans.coverage import cell_radius, centres, intervals, overlapping, within_reach
from starweave.sources.catalog import Catalog, write_catalog


def test_intervals_are_sorted_and_disjoint():
    cells = [(29, 5), (28, 1), (29, 3), (29, 4), (27, 3), (28, 1), (29, 100)]
    start, end = intervals(cells)
    covered = sorted({p for o, c in cells for p in range(c << 2 * (29 - o), (c + 1) << 2 * (29 - o))})
    assert [p for a, b in zip(start, end) for p in range(a, b)] == covered
    assert (start[1:] > end[:-1]).all()
    assert intervals([])[0].tolist() == []


def test_overlap_is_that_of_the_pixels():
    rng = np.random.default_rng(3)
    draw = lambda n: [(int(o), int(rng.integers(0, 12 * 4**o))) for o in rng.integers(0, 4, n)]
    cells, others = draw(200), draw(12)
    deep = lambda c: set(range(c[1] << 2 * (3 - c[0]), (c[1] + 1) << 2 * (3 - c[0])))
    want = [any(deep(c) & deep(o) for o in others) for c in cells]
    assert overlapping(cells, others).tolist() == want and 0 < sum(want) < 200
    assert not overlapping(cells, []).any() and not within_reach(cells, [], 1.0).any() and within_reach([], cells, 1.0).tolist() == []


@pytest.mark.parametrize("order", [0, 1, 3, 6, 11])
def test_centres_and_radii(spark, order):
    """A centre lies in its pixel, and random positions within the radius of their pixel's centre."""
    rng = np.random.default_rng(order)
    pixels = np.unique(rng.integers(0, 12 * 4**order, 300)).tolist()
    vector = centres([(order, p) for p in pixels])
    rows = [(p, float(np.degrees(np.arctan2(v[1], v[0])) % 360), float(np.degrees(np.arcsin(v[2])))) for p, v in zip(pixels, vector)]
    found = with_pixel(spark.createDataFrame(rows, "p long, ra double, dec double"), order, "found")
    assert found.where("p <> found").count() == 0
    z, ra = rng.uniform(-1, 1, 20_000), rng.uniform(0, 360, 20_000)
    points = spark.createDataFrame([(float(r), float(np.degrees(np.arcsin(x)))) for r, x in zip(ra, z)], "ra double, dec double")
    where = with_pixel(points, order, "p").toPandas()
    at = np.stack([np.cos(np.radians(where.dec)) * np.cos(np.radians(where.ra)), np.cos(np.radians(where.dec)) * np.sin(np.radians(where.ra)), np.sin(np.radians(where.dec))], 1)
    angle = np.arccos(np.clip((at * centres([(order, p) for p in where.p])).sum(axis=1), -1, 1))
    assert angle.max() <= cell_radius(order) and angle.max() > cell_radius(order) / 2


@pytest.fixture(scope="module")
def sky(tmp_path_factory):
    return Sky(tmp_path_factory.mktemp("sky")).write()


def _cells(paths):
    return {int(re.search(r"Npix=(\d+)", p)[1]) for p in paths}


def test_only_files_within_reach_are_opened(spark, sky, monkeypatch, tmp_path):
    anchor = Catalog.open(spark, sky.registry.url(HUB, ""))
    partner = Catalog.open(spark, sky.registry.url("desi", ""))
    ours, theirs = build_index.chosen_files(anchor, partner, 1.0)
    assert _cells(ours) == _cells(theirs) == {8, 21, 25, 50}
    ours, theirs = build_index.chosen_files(anchor, partner, 1.0, cell=(5, 50))
    assert _cells(ours) == {50} and 50 in _cells(theirs) and len(_cells(theirs)) < 4
    ours, _ = build_index.chosen_files(anchor, partner, 1.0, count=2)
    assert _cells(ours) == {8, 21}
    with pytest.raises(ValueError, match="does not meet"):
        build_index.chosen_files(anchor, partner, 1.0, cell=(5, 51))
    read = []
    plain = module.crossmatch
    monkeypatch.setattr(build_index, "crossmatch", lambda a, p, **k: (read.append((a.inputFiles(), p.inputFiles())), plain(a, p, **k))[1])
    flags = ["--anchor-catalog", sky.registry.url(HUB, ""), "--anchor-source", HUB, "--anchor-revision", "a", "--partner-catalog", sky.registry.url("desi", "")]
    flags += ["--partner-source", "desi", "--partner-revision", "p", "--out", str(tmp_path / "edges.parquet"), "--cell", "5/50"]
    build_index.build(spark, build_index.parser().parse_args(flags))
    assert _cells(read[0][0]) == {50} and len(_cells(read[0][1])) < 4


def test_overlapping_cells_of_one_catalog_are_refused(spark, sky, monkeypatch, tmp_path):
    plain = Catalog.open

    def open_with_a_parent(session, url):
        catalog = plain(session, url)
        more = catalog.files.where("npix = 50").select((F.col("norder") - 1).cast("tinyint").alias("norder"), F.shiftright("npix", 2).alias("npix"), "path")
        return Catalog(session, catalog.url, catalog.files.union(more), catalog.schema, catalog.later) if "desi" in url else catalog

    monkeypatch.setattr(build_index.Catalog, "open", open_with_a_parent)
    flags = ["--anchor-catalog", sky.registry.url(HUB, ""), "--anchor-source", HUB, "--anchor-revision", "a", "--partner-catalog", sky.registry.url("desi", "")]
    flags += ["--partner-source", "desi", "--partner-revision", "p", "--out", str(tmp_path / "edges.parquet")]
    with pytest.raises(ValueError, match="maps to two cells"):
        build_index.build(spark, build_index.parser().parse_args(flags))


def test_cells_are_read_off_file_names_undecoded(spark, tmp_path):
    root = f"{tmp_path}/Norder=9 a+b%20c/é"
    rows = [(f"r{k}", order, pixel, k) for k, (order, pixel) in enumerate([(5, 7), (5, 12_287), (4, 7), (5, 7)])]
    write_catalog(spark.createDataFrame(rows, "object_id string, norder tinyint, npix long, row_index long"), root)
    catalog = Catalog.open(spark, root)
    found = catalog.scan(["object_id"]).select("object_id", "norder", "npix", "path").collect()
    assert sorted(tuple(r)[:3] for r in found) == [r[:3] for r in rows]
    tail = lambda path: path.partition("c/é/")[2]
    assert {(r.norder, r.npix, tail(r.path)) for r in found} == {(order, pixel, tail(path)) for order, pixel, path in catalog.listing()}
    plan = catalog.scan(["object_id"]).select("object_id", "norder", "npix")._jdf.queryExecution().optimizedPlan().toString()
    assert "file_path" in plan and "decode" not in plan.lower()
