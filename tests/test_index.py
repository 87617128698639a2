"""Index layouts: loading, checks, pivot and back, both command lines, owners."""

import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from small_sky import HUB, Sky, anchor_name, edge, matches, partner_name, write_edges

from starweave import build_index, merge_index
from starweave.operators.layout import pivot_edges
from starweave.plans.cells import hash_split, permutation, reserved
from starweave.plans.ownership import elect_owners
from starweave.schemas import EDGE_SCHEMA, PAIR_SCHEMA, wide_schema
from starweave.sources.index import GRAPH_ASSEMBLY, MatchIndex, assembly_and_revisions, load_index, pair_view

MATCHES = [(8, 0, "desi", "k17"), (8, 0, "hsc", "h4"), (8, 3, "hsc", "h9"), (50, 1, "desi", "k2"), (50, 0, "desi", "k5")]
EDGES = [edge(*m) for m in MATCHES]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_wide_index_loads_to_the_same_graph(spark, tmp_path):
    spokes, out = tmp_path / "spokes", str(tmp_path / "merged" / "wide.parquet")
    for source in ("desi", "hsc"):
        write_edges(spokes / f"{source}.parquet", [e for e in EDGES if e["partner_source"] == source])
    (spokes / "notes.txt").write_text("no index")
    assert merge_index.main(["--spokes", str(spokes), "--out", out]) == 0
    wide = spark.read.parquet(out)
    assert wide.schema.names == wide_schema(["desi", "hsc"]).names
    partners = {(p, n): {} for p, n, *_ in MATCHES}
    for p, n, source, partner in MATCHES:
        partners[p, n][source] = partner
    got = {(r["anchor_pixel"], r["anchor_id"]): (r["desi_id"], r["hsc_id"]) for r in wide.collect()}
    assert got == {(p, anchor_name(p, n)): (found.get("desi"), found.get("hsc")) for (p, n), found in partners.items()}
    a, b = load_index(spark, str(spokes)), load_index(spark, out)
    assert (a.schema_version, b.schema_version) == (2, 3)
    assert rows(a.edges) == rows(b.edges) and rows(a.partner_cells) == rows(b.partner_cells)
    revisions = {"desi": "rev-desi", "hsc": "rev-hsc"}
    assert a.partner_revisions == b.partner_revisions == revisions
    assert assembly_and_revisions(spark, out) == (GRAPH_ASSEMBLY, {"anchor": "rev-a", **revisions})
    with pytest.raises(ValueError, match="cannot stream"):
        pair_view(a)


@pytest.mark.parametrize(
    ("bad", "message"),
    [
        (edge(21, 0, "desi", "k8", join_kind="lineage"), "unknown join kind"),
        (edge(21, 0, "sdss", "q", separation_arcsec=1.75), "invalid positional"),
        (edge(21, 0, "desi", "k8", partner_revision="rev-old"), "mixes revisions"),
        (edge(8, 0, "desi", "k18"), "multiple 'desi' partners"),
    ],
)
def test_bad_rows_are_refused(spark, tmp_path, bad, message):
    with pytest.raises(ValueError, match=message):
        load_index(spark, write_edges(tmp_path / "e.parquet", [*EDGES, bad]))


def test_conflicting_match_is_not_merged_away(spark):
    table = spark.createDataFrame([tuple(e.values()) for e in [*EDGES, edge(8, 0, "desi", "k18")]], EDGE_SCHEMA)
    with pytest.raises(ValueError, match="two 'desi' matches"):
        pivot_edges(table)


def test_empty_directory(spark, tmp_path):
    with pytest.raises(ValueError, match="no spoke parquets"):
        load_index(spark, str(tmp_path))


def test_built_indexes_hold_the_edges_of_the_rule(spark, tmp_path):
    Sky(tmp_path).write()
    for source in ("desi", "sdss"):
        told = {"anchor-catalog": tmp_path / "hub folder", "anchor-source": HUB, "anchor-revision": "rev-a"}
        told |= {"partner-catalog": tmp_path / source, "partner-source": source, "partner-revision": "rev-p"}
        told |= {"workers": 2, "out": tmp_path / "built" / f"{source}.parquet"}
        line = [word for name, value in told.items() for word in (f"--{name}", str(value))]
        assert build_index.main([*line, "--partner-strip-id"]) == 0
    built = load_index(spark, str(tmp_path / "built"))
    wanted = [(5, p, anchor_name(p, n), s, partner_name(s, p, n)) for s, p, n in matches() if s != "provabgs"]
    assert rows(built.edges) == sorted(wanted, key=repr)


def test_pair_index_last_row_wins(spark, tmp_path):
    table = [(5, 8, "m1", 5, 3, "old"), (5, 8, "m4", 5, 2, "t4"), (5, 50, "m6", 5, 3, "t6"), (5, 8, "m1", 5, 3, "new")]
    columns = [pa.array(c) for c in zip(*table)]
    pq.write_table(pa.table(columns, names=PAIR_SCHEMA.names), tmp_path / "index.parquet")
    edges, cells = pair_view(load_index(spark, str(tmp_path)))
    last = {(order, pixel, image): spectrum for order, pixel, image, _, _, spectrum in table}
    assert rows(edges) == sorted(((*key, "desi", spectrum) for key, spectrum in last.items()), key=repr)
    assert rows(cells) == sorted({(o, p, "desi", so, sp) for o, p, _, so, sp, _ in table}, key=repr)


def test_permutation_split_and_owner(spark):
    assert permutation(165, 7, 0)[:8] == [137, 70, 2, 132, 90, 64, 135, 89]
    assert permutation(165, 7, 1)[:8] == [69, 8, 117, 115, 144, 94, 38, 62]
    assert [reserved(n) for n in (165, 5, 1)] == [8, 1, 1]
    cells = spark.range(3072).selectExpr("cast(4 as tinyint) norder", "id as npix")
    val = [r["npix"] for r in hash_split(cells, "val").orderBy("npix").collect()]
    assert len(val) == 135 and val[:4] == [6, 37, 40, 82]
    refs = spark.createDataFrame(
        [(6, p, "desi", 6, 1, "path") for p in (2, 1)],
        "norder tinyint, npix bigint, source string, partner_norder tinyint, partner_npix bigint, path string",
    )
    assert elect_owners(refs).first()["npix"] == [1, 2][zlib.crc32(b"path") % 2]


def test_partner_cells_are_ranges_with_gaps_between(spark):
    """Ranges split at gaps, orders, sources and anchor cells, and spell the same set of cells; repeats count once."""
    cells = [(5, 8, "desi", 6, c) for c in (4, 5, 5, 6, 9, 11, 12)] + [(5, 8, "desi", 7, 7), (5, 8, "sdss", 6, 7), (5, 9, "desi", 6, 7), (5, 9, "desi", 6, 0)]
    listed = spark.createDataFrame(cells, "norder tinyint, npix long, source string, partner_norder tinyint, partner_npix long").distinct()
    index = MatchIndex(2, HUB, "rev-a", {}, listed, listed, listed)
    ranges = rows(index.partner_cell_ranges())
    assert ranges == sorted(
        [(5, 8, "desi", 6, 4, 6), (5, 8, "desi", 6, 9, 9), (5, 8, "desi", 6, 11, 12), (5, 8, "desi", 7, 7, 7), (5, 8, "sdss", 6, 7, 7)]
        + [(5, 9, "desi", 6, 0, 0), (5, 9, "desi", 6, 7, 7)],
        key=repr,
    )
    sets = {(r["npix"], r["source"]): [tuple(x) for x in r["ranges"]] for r in index.partner_cell_sets().collect()}
    assert sets[8, "desi"] == [(6, 4, 6), (6, 9, 9), (6, 11, 12), (7, 7, 7)] and len(sets) == 3
    nothing = MatchIndex(2, HUB, "rev-a", {}, listed, listed.limit(0), listed)
    assert rows(nothing.partner_cell_ranges()) == []
