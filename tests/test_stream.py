"""End-to-end behaviour of both streams on the small sky."""

import json
import re

import pytest
from small_sky import ANCHORS, FOLDERS, HUB, SHAPE, Sky, flux, redshift

from starweave.sources import publish as commit
from starweave.sources.catalog import Registry
from starweave.sources.index import MATCH_INDEX_ENV, resolve_match_index
from starweave.streaming import stream as module
from starweave.streaming.stream import open_stream
from starweave.streaming.structured import cell_plans, stream_cells, write_cell_plan

TRAIN = [8, 21, 50]


@pytest.fixture(scope="module")
def sky(tmp_path_factory):
    return Sky(tmp_path_factory.mktemp("sky")).write()


@pytest.fixture(scope="module")
def stream(spark, sky):
    return open_stream(spark, sky.registry, match_index=sky.index("star"), image_shape=SHAPE)


@pytest.fixture(scope="module")
def rows(stream):
    return list(stream)


def ids(rows):
    return [r["object_id"] for r in rows]


def pixels(stream):
    return [cell[1] for cell in stream.chosen]


def opened(df):
    """The cells of all catalog files that a plan reads."""
    return {int(p) for f in df.inputFiles() for p in re.findall(r"Npix=(\d+)", f)}


def test_records_follow_the_rule(sky, stream, rows):
    assert sorted(pixels(stream)) == TRAIN and stream.n_shards == 3
    wanted = {}
    for pixel in pixels(stream):
        wanted |= sky.cell_records(pixel)
    assert ids(rows) == list(wanted)
    field = {"desi": "spectrum", "sdss": "sdss_spectrum", "provabgs": "provabgs_LOG_MSTAR"}
    for row in rows:
        assert {s for s, f in field.items() if row[f] is not None} == wanted[row["object_id"]]
        if row["object_id"].startswith("hub-"):
            pixel, n = map(int, row["object_id"].split("-")[1:])
            assert row["image"]["flux"] == flux(pixel, n)
            assert row["psf_fwhm"]["des-g"] == pytest.approx(1 + n / 4)
            if row["spectrum"] is not None:
                assert row["Z"] == pytest.approx(redshift(pixel, n)) and row["ZWARN"] == (pixel == 50)
                assert row["spectrum"]["flux"][0] == pixel and "ivar" not in row["spectrum"].asDict()
        else:
            assert row["image"] is None


def test_resume_opens_only_what_is_left(stream, rows):
    keys = [stream.position_of(r) for r in rows]
    assert len(set(keys)) == len(rows) and keys == sorted(keys)
    first = len([r for r in rows if r["cell_rank"] == 0])
    at_hub = ids(rows).index("hub-8-2")  # the last row of a partition's first file
    for k in {0, first - 1, at_hub, len(rows) - 1}:
        rest = stream.resume(json.loads(json.dumps(stream.state(keys[k]))))
        assert ids(rest.ordered().collect()) == ids(rows)[k + 1 :]
        assert opened(rest.records) == set(pixels(stream)[rows[k]["cell_rank"] :])
    page = stream.after(keys[1]).page(2)
    assert ids(page.collect()) == ids(rows)[2:4] and len(opened(page)) < 3
    with pytest.raises(ValueError, match="seed"):
        stream.resume({**stream.state(), "seed": 1})


def test_a_record_number_opens_one_cell(spark, sky, stream, rows, monkeypatch):
    index = sky.index("pair", ("desi",))
    pair = open_stream(spark, sky.registry, match_index=index, image_shape=SHAPE)
    for one in (stream, pair):
        whole = one.ordered().select("object_id", "cell_rank").collect()
        order, first = ids(whole), [r["cell_rank"] for r in whole].index(1)
        assert sum(one.counts.values()) == len(order)
        for n in (first, first + 1, len(order)) if one is pair else (0, first - 1, len(order) - 1):
            rest = one.at(n)
            assert ids(rest.ordered().collect()) == order[n:], n
            rank = rest.position[0] if n < len(order) else len(one.chosen)
            assert opened(rest.records) == set(pixels(one)[rank:])
    seen = []
    plain = stream.assemble
    watched = module.replace(stream, assemble=lambda cells: (seen.append(len(cells)), plain(cells))[1])
    assert watched.counts == stream.counts
    seen.clear()
    watched.at(len(rows) - 2)
    assert seen == [1]
    with pytest.raises(ValueError, match="0 or more"):
        stream.at(-1)


def test_shards_are_disjoint_complete_and_read_their_cells(stream, rows):
    found = []
    for i in range(2):
        part = stream.shard(2, i)
        assert pixels(part) == pixels(stream)[i::2] and opened(part.records) == set(pixels(part))
        found += ids(part.records.collect())
    assert sorted(found) == sorted(ids(rows))


def test_iteration_plans_in_groups(stream, rows, monkeypatch):
    monkeypatch.setattr(module, "GROUP_CELLS", 2)
    assert ids(stream.after(stream.position_of(rows[3]))) == ids(rows)[4:]


def test_ranks_deal_the_cells(spark, sky, stream):
    where = {"match_index": sky.index("star"), "image_shape": SHAPE, "num_shards": 2}
    deals = [pixels(open_stream(spark, sky.registry, shard=i, **where)) for i in range(2)]
    assert deals == [pixels(stream)[0::2], pixels(stream)[1::2]]


def test_validation_split(spark, sky):
    val = open_stream(spark, sky.registry, split="val", match_index=sky.index("star"), image_shape=SHAPE)
    assert ids(val) == list(sky.cell_records(25))
    with pytest.raises(ValueError, match="split"):
        open_stream(spark, sky.registry, split="test", match_index=sky.index("star"))


def test_missing_partner_warns_and_keeps_the_anchor(spark, sky):
    torn = Sky(sky.root, renamed={"sdss-21-3": "gone"}, registry=sky.registry)
    stream = open_stream(spark, sky.registry, match_index=torn.index("torn"), image_shape=SHAPE)
    with pytest.warns(RuntimeWarning, match="missing sdss id 'gone'"):
        assert stream.warn_missing() == 1
    with pytest.warns(RuntimeWarning, match="1 edges point to missing sdss rows"):
        by_id = {r["object_id"]: r for r in stream.only([c[3] for c in stream.chosen if c[1] == 21])}
    assert list(by_id) == list(torn.cell_records(21))
    # no longer pointed to, so it is unmatched now
    assert by_id["hub-21-3"]["sdss_spectrum"] is None and "sdss:sdss-21-3" in by_id


def test_duplicate_partner(spark, tmp_path):
    sky = Sky(tmp_path, twice=("desi-50-0",), renamed={"desi-8-2": "gone"}).write()
    with pytest.raises(ValueError, match="duplicate desi id 'desi-50-0'"):
        open_stream(spark, sky.registry, match_index=sky.index("star"), image_shape=SHAPE)
    # the pair stream takes the last one instead, and drops images whose spectrum is gone
    pair, by_id = sky.index("pair", ("desi",)), {}
    for split in ("train", "val"):
        part = open_stream(spark, sky.registry, split=split, match_index=pair, image_shape=SHAPE)
        by_id |= {r["object_id"]: r for r in part.records.collect()}
    assert by_id["hub-50-0"]["Z"] == pytest.approx(redshift(50, 0) + 0.5)
    assert "hub-8-2" not in by_id and "hub-8-1" in by_id and "desi-8-2" in by_id


def test_pair_stream(spark, sky):
    index = sky.index("pair", ("desi",))
    val, train = (open_stream(spark, sky.registry, split=s, match_index=index, image_shape=SHAPE) for s in ("val", "train"))
    assert val.fingerprint["assembly"] == "crossmatch_only_v3"
    assert pixels(val) == [8] and sorted(pixels(train)) == [21, 25, 50]
    # one unmatched spectrum leads each cell and keeps its bare id
    wanted = [i for p in pixels(train) for i in (f"desi-{p}-x0", *(f"hub-{p}-{n}" for n in range(ANCHORS[p])))]
    rows = list(train)
    assert ids(rows) == wanted
    for row in rows:
        paired = not row["object_id"].startswith("hub-") or int(row["object_id"][-1]) % 2 == 0
        assert (row["spectrum"] is not None) == paired
        assert (row["image"] is None) == row["object_id"].startswith("desi-")
    rest = train.after(train.position_of(rows[6]))
    assert ids(rest.ordered().collect()) == wanted[7:] and opened(rest.records) < {21, 25, 50}
    assert ids(rest.page(3).collect()) == wanted[7:10]


def test_partitions_of_several_files_count_on(spark, tmp_path):
    """A catalog whose partitions are folders of two files gives the order of the one whose are not."""
    from starweave.sources.catalog import Catalog

    def records(root, folders):
        (tmp_path / root).mkdir()
        sky = Sky(tmp_path / root, folders=folders, registry=Registry(pinned=False)).write()
        stream = open_stream(spark, sky.registry, match_index=sky.index("pair", ("desi",)), image_shape=SHAPE)
        places = Catalog.open(spark, sky.registry.url(HUB, "")).scan(["object_id"])
        return stream, {(r.npix, r.row_index): r.object_id for r in places.collect()}

    (one, alone), (two, several) = records("one", ()), records("two", FOLDERS)
    assert alone == several and {n for p, n in several if p == 8} == set(range(ANCHORS[8]))
    order = lambda s: [(s.chosen[r.cell_rank][1], r.slot, r.phase, r.item, r.object_id) for r in s.records.collect()]
    assert sorted(order(one)) == sorted(order(two))


def test_files_with_more_columns_and_wider_types(spark, tmp_path):
    from starweave.sources.catalog import Catalog

    cells = tmp_path / "Norder=3" / "Dir=0"
    spark.range(3).selectExpr("cast(id as int) as n", "'a' as object_id", "cast(id as float) as x").coalesce(1).write.parquet(str(cells / "Npix=1.parquet"))
    spark.range(2).selectExpr("id + 5000000000 as n", "'b' as object_id", "id / 3 as x", "id as more").coalesce(1).write.parquet(str(cells / "Npix=2.parquet"))
    spark.range(1).selectExpr("'c' as object_id").coalesce(1).write.parquet(str(cells / "Npix=3.parquet"))
    catalog = Catalog.open(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in catalog.schema} == {"n": "bigint", "object_id": "string", "x": "double", "more": "bigint"}
    want = {("a", k, float(k), None) for k in range(3)} | {("b", k + 5000000000, k / 3, k) for k in range(2)} | {("c", None, None, None)}
    for files in (None, [r.path for r in catalog.files.collect()]):
        rows = catalog.scan(["object_id", "n", "x", "more"], files).collect()
        assert {(r.object_id, r.n, r.x, r.more) for r in rows} == want and len(rows) == 6


def test_structured_streaming_restarts_without_loss(stream, rows, tmp_path):
    plan, out, marks = (str(tmp_path / n) for n in ("plan", "out", "marks"))
    first, second = stream.shard(2, 0), stream.shard(2, 1)
    for _ in range(2):  # a program that is run again writes and emits nothing twice
        assert write_cell_plan(first, plan, cells_per_batch=1) == 2
        done = ids(stream_cells(stream, plan, out, marks).collect())
        assert sorted(done) == sorted(r["object_id"] for r in rows if r["cell_rank"] % 2 == 0)
    with pytest.raises(ValueError, match="some of these cells"):
        write_cell_plan(stream, plan)
    write_cell_plan(second, plan)
    assert sorted(ids(stream_cells(stream, plan, out, marks).collect())) == sorted(ids(rows))


class Lost(Exception):
    """The driver is gone."""


@pytest.mark.parametrize("behind", [False, True])
def test_a_driver_lost_at_any_write_changes_nothing(stream, rows, tmp_path, monkeypatch, behind):
    """Stopped before or behind each commit of the plan in turn, and run again: the plan of a run that was not stopped."""
    plain, left = commit.publish, [0]

    def stopping(*args):
        if left[0] == 0 and not behind:
            raise Lost
        plain(*args)
        if left[0] == 0:
            raise Lost
        left[0] -= 1

    def files(name):
        return {f.name: f.read_text() for f in (tmp_path / name).glob("[0-9]*.json")}

    write_cell_plan(stream, str(tmp_path / "whole"), cells_per_batch=1)
    assert [int(name.split("-")[0]) for name in sorted(files("whole"))] == [0, 1, 2]
    for stop in range(4):  # a manifest and three files
        plan = str(tmp_path / f"plan-{stop}")
        left[0] = stop
        monkeypatch.setattr(commit, "publish", stopping)
        with pytest.raises(Lost):
            write_cell_plan(stream, plan, cells_per_batch=1)
        monkeypatch.setattr(commit, "publish", plain)
        before = files(f"plan-{stop}")
        assert before.items() <= files("whole").items() and len(before) == max(0, stop - (not behind))
        assert len(cell_plans(stream.spark, plan)) == (stop > 0 or behind)
        if stop == 2:  # the reader completes a committed plan itself
            out, marks = (str(tmp_path / n) for n in ("out", "marks"))
            assert sorted(ids(stream_cells(stream, plan, out, marks).collect())) == sorted(ids(rows))
        else:
            write_cell_plan(stream, plan, cells_per_batch=1)
        assert files(f"plan-{stop}") == files("whole") and len(cell_plans(stream.spark, plan)) == 1


def test_a_batch_that_is_lost_is_written_again(stream, rows, tmp_path, monkeypatch):
    plan, out, marks = (str(tmp_path / n) for n in ("plan", "out", "marks"))
    write_cell_plan(stream, plan, cells_per_batch=1)
    plain, calls = module.Stream.only, []

    def second_fails(self, ranks):
        calls.append(list(ranks))
        if len(calls) == 2:
            raise Lost
        return plain(self, ranks)

    monkeypatch.setattr(module.Stream, "only", second_fails)
    with pytest.raises(Exception, match="Lost"):
        stream_cells(stream, plan, out, marks)
    done = stream_cells(stream, plan, out, marks)
    assert calls == [[0], [1], [1], [2]] and sorted(ids(done.collect())) == sorted(ids(rows))
    # with a new checkpoint all cells are written again, to the same folders
    again = stream_cells(stream, plan, out, str(tmp_path / "other marks"))
    assert sorted(ids(again.collect())) == sorted(ids(rows))


def test_another_stream_is_refused(spark, sky, stream, rows, tmp_path):
    plan, out, marks = (str(tmp_path / n) for n in ("plan", "out", "marks"))
    with pytest.raises(ValueError, match="no plan"):
        stream_cells(stream, plan, out, marks)
    write_cell_plan(stream, plan)
    other = open_stream(spark, sky.registry, match_index=sky.index("star"), image_shape=SHAPE, seed=5)
    for changed in (other, stream.after(stream.position_of(rows[1]))):
        with pytest.raises(ValueError, match="another stream"):
            stream_cells(changed, plan, out, marks)
        with pytest.raises(ValueError, match="another stream"):
            write_cell_plan(changed, plan)
    with pytest.raises(ValueError, match="does not have"):
        stream_cells(stream.shard(2, 0), plan, out, marks)


def test_index_resolution(monkeypatch, spark):
    monkeypatch.delenv(MATCH_INDEX_ENV, raising=False)
    assert resolve_match_index() is None
    with pytest.raises(ValueError, match="match_index"):
        open_stream(spark, None)
    monkeypatch.setenv(MATCH_INDEX_ENV, "/set/in/env.parquet")
    assert resolve_match_index() == "/set/in/env.parquet"
    assert resolve_match_index("/given.parquet") == "/given.parquet"
