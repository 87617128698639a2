"""Rules that hold across layouts: file order within a partition, encoded paths, edge checks."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from starweave.operators.layout import check_edges, index_sources
from starweave.plans import cells
from starweave.sources.catalog import LISTING_TASKS, Catalog
from starweave.sources.index import index_from


def _edges(spark, **changes):
    row = {
        "index_schema_version": 2, "anchor_source": "hub", "anchor_revision": "r", "anchor_order": 4, "anchor_pixel": 1,
        "anchor_id": "x", "partner_source": "s", "partner_revision": "r", "partner_order": 4, "partner_pixel": 1,
        "partner_id": " y ", "join_kind": "positional", "separation_arcsec": 0.5, "match_radius_arcsec": 1.0,
        "epoch_treatment": "static",
    }
    row |= changes
    types = {str: "string", int: "bigint", float: "double", type(None): "string"}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in row.items()))


def test_partition_of_several_files_under_an_encoded_path(spark, tmp_path):
    base = tmp_path / "a b+c%"
    for part in range(3):
        rows = spark.range(part * 10, part * 10 + 5).select(F.col("id").alias("ra")).coalesce(1)
        rows.write.mode("append").parquet(str(base / "Norder=2" / "Dir=0" / "Npix=7.parquet"))
    catalog = Catalog.open(spark, str(base))
    assert [(r.norder, r.npix) for r in catalog.files.collect()] == [(2, 7)]
    whole = catalog.scan(["ra"]).collect()
    chosen = catalog.scan(["ra"], [r.path for r in catalog.files.collect()]).collect()
    places = [r.row_index for r in whole]
    assert len(whole) == 15 and len(set(places)) == 15
    assert {(r.ra, r.row_index) for r in chosen} == {(r.ra, r.row_index) for r in whole}


def test_catalogs_are_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    for npix in range(100):
        folder = tmp_path / "Norder=2" / "Dir=0" / f"Npix={npix}.parquet"
        folder.mkdir(parents=True)
        pq.write_table(pa.table({"id": [npix]}), folder / "part-0.parquet")
    context = spark.sparkContext
    context.setJobGroup("listing", "")
    catalog = Catalog.open(spark, str(tmp_path))
    paths = sorted(r.path for r in catalog.files.collect())
    part = catalog.scan(["id"], paths[:90])
    context.setJobGroup("", "")
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages) <= LISTING_TASKS * context.defaultParallelism < 90
    assert part.count() == 90
    monkeypatch.setattr(DataFrameReader, "parquet", lambda *args, **options: pytest.fail("all files are listed again"))
    assert catalog.scan(["id"]).count() == catalog.scan(["id"], paths).count() == 100


@pytest.mark.parametrize(
    "changes", [{"join_kind": "lineage"}, {"separation_arcsec": 5.0}, {"partner_id": None}, {"anchor_id": None}]
)
def test_bad_edges_are_refused(spark, changes):
    with pytest.raises(ValueError):
        check_edges(_edges(spark, **changes))


def test_two_revisions_are_refused(spark):
    with pytest.raises(ValueError, match="mixes revisions"):
        check_edges(_edges(spark).union(_edges(spark, partner_revision="q")))


def test_padded_ids_are_stripped(spark):
    assert [r.partner_id for r in index_from(_edges(spark)).edges.collect()] == ["y"]


def test_any_number_of_sources(spark):
    edges = spark.range(1500).select(F.concat(F.lit("s"), "id").alias("partner_source"))
    assert len(index_sources(edges)) == 1500


def test_permutation_is_the_listed_one(spark):
    grid = spark.createDataFrame([(4, k) for k in range(25)], "norder tinyint, npix bigint")
    ranked = cells.permute_cells(grid, 7, 0).orderBy("cell_rank").collect()
    assert [r.npix for r in ranked] == cells.permutation(25, 7, 0)
