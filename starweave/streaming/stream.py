"""One finite, deterministic epoch of a corpus: open, order, shard, page, resume."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.healpix import split_of_cell
from ..operators import pair, star
from ..operators.star import Spoke
from ..plans import cells as plan
from ..plans.ownership import graph_owners, pair_owners, references
from ..sources.adapters import IMAGE_SHAPE, HubAdapter, SpokeAdapter, adapter_for, hub_adapter, spoke_adapters
from ..session import cut_lineage
from ..sources.catalog import Catalog, Registry
from ..sources.index import (
    GRAPH_ASSEMBLY,
    MATCH_INDEX_ENV,
    PAIR_ASSEMBLY,
    PAIR_SOURCE,
    MatchIndex,
    load_index,
    pair_view,
    resolve_match_index,
)

CELL_SCHEMA = "norder tinyint, npix bigint, path string, cell_rank int"


# Cells that iteration plans together: bounds what is shuffled before the first record.
GROUP_CELLS = 64

# A cell of the epoch on the driver: norder, npix, path, cell_rank.
Cell = tuple[int, int, str, int]


@dataclass(frozen=True)
class Stream:
    """A planned epoch. ``order`` names the columns that sort its records.

    Records are planned from the cells that are wanted, so that a resumed stream, a shard, a page or
    a micro-batch opens the files of its own cells only.
    """

    spark: SparkSession
    assemble: Callable[[list[Cell]], DataFrame]  # all records of some cells
    at_least: Callable[[list[Cell]], int]  # a number of records that these cells reach
    order: list[str]
    chosen: tuple[Cell, ...]  # by rank; one per catalog file, so metadata
    fingerprint: dict
    missing: DataFrame | None = None
    position: tuple | None = None
    shard_of: tuple[int, int] = (0, 1)

    @property
    def n_shards(self) -> int:
        """One per anchor cell."""
        return len(self.chosen)

    @cached_property
    def cells(self) -> DataFrame:
        return _cell_table(self.spark, self.chosen)

    @cached_property
    def records(self) -> DataFrame:
        """The records that are left, in no order."""
        return self._of(self._outstanding())

    def _outstanding(self) -> list[Cell]:
        first = -1 if self.position is None else self.position[0]
        return [c for c in self.chosen if c[3] >= first]

    def _of(self, cells: list[Cell]) -> DataFrame:
        return star.after(self.assemble(cells), self.position, self.order)

    def ordered(self) -> DataFrame:
        return self.records.orderBy(*self.order)

    def page(self, limit: int) -> DataFrame:
        """The next ``limit`` records: a top-k over the leading cells that hold so many."""
        cells, count = self._outstanding(), 1
        while count < len(cells):
            # all records of the cell that the position lies in may be behind it
            whole = cells[:count] if self.position is None else cells[1:count]
            if self.at_least(whole) >= limit:
                break
            count *= 2
        return self._of(cells[:count]).orderBy(*self.order).limit(limit)

    def after(self, position: Row | tuple | None) -> Stream:
        """The rest of the stream behind a record's position."""
        return self if position is None else replace(self, position=tuple(position))

    @cached_property
    def counts(self) -> dict[int, int]:
        """Records per cell, by rank: one pass that reads ids and no payload."""
        counted = self.assemble(list(self.chosen)).groupBy("cell_rank").count()
        return {c[3]: 0 for c in self.chosen} | {r["cell_rank"]: r["count"] for r in counted.collect()}

    def at(self, number: int) -> Stream:
        """The stream from its record ``number`` on, counted from 0 over all its cells; only the cell that holds it is opened."""
        if number < 0:
            raise ValueError("a record's number is 0 or more")
        for cell in self.chosen:
            rank, count = cell[3], self.counts[cell[3]]
            if number < count:
                if number == 0:
                    return replace(self, position=self._start(rank))
                before = self.assemble([cell]).select(*self.order).orderBy(*self.order).offset(number - 1).limit(1)
                return replace(self, position=tuple(before.first()))
            number -= count
        return replace(self, position=self._start(1 + max((c[3] for c in self.chosen), default=-1)))

    def _start(self, rank: int) -> tuple:
        """A position in front of all records of a cell; no later column of the order is below zero."""
        return (rank, *("" if name == "source" else -1 for name in self.order[1:]))

    def position_of(self, record: Row) -> tuple:
        return tuple(record[c] for c in self.order)

    def shard(self, num_shards: int, index: int) -> Stream:
        """Every ``num_shards``-th cell of this rank, starting at ``index``."""
        return replace(self, chosen=self.chosen[index::num_shards], shard_of=(index, num_shards))

    def only(self, ranks: Iterable[int]) -> Stream:
        """The cells with these ranks."""
        wanted = set(ranks)
        return replace(self, chosen=tuple(c for c in self.chosen if c[3] in wanted))

    def state(self, position: Row | tuple | None = None) -> dict:
        """What a consumer has to store to continue behind ``position``."""
        at = self.position if position is None else tuple(position)
        return {**self.fingerprint, "sub_shard": list(self.shard_of), "position": at}

    def resume(self, state: dict) -> Stream:
        """Continue from a stored state; one of another corpus or order is refused."""
        mine = {**self.fingerprint, "sub_shard": list(self.shard_of)}
        changed = sorted(k for k, v in mine.items() if state.get(k) != v)
        if changed:
            raise ValueError(f"resume state does not fit this stream: {changed} differ")
        position = state.get("position")
        return self.after(None if position is None else tuple(position))

    def warn_missing(self, show: int | None = None) -> int:
        """Warn about edges whose partner is gone; their anchors stay without that spoke.

        One warning per source gives the count; single edges are named, all or the first ``show``.
        """
        if self.missing is None:
            return 0
        counts = sorted(tuple(r) for r in self.missing.groupBy("source").count().collect())
        for source, count in counts:
            warnings.warn(f"{count} edges point to missing {source} rows", RuntimeWarning, stacklevel=2)
        named = self.missing.orderBy("norder", "npix", "anchor_id", "source")
        named = named if show is None else named.limit(show)
        for row in named.toLocalIterator() if counts else ():
            warnings.warn(
                f"missing {row['source']} id {row['partner_id']!r}: anchor {row['anchor_id']!r} stays without it",
                RuntimeWarning,
                stacklevel=2,
            )
        return sum(count for _, count in counts)

    def __iter__(self) -> Iterator[Row]:
        """Records in order, one cell at a time on the driver; missing partners are counted in warnings.

        Cells are planned in groups. A cell goes to the partition of its place in the group and is
        sorted there, so nothing is sorted as a whole.
        """
        self.warn_missing(show=0)
        cells = self._outstanding()
        for start in range(0, len(cells), GROUP_CELLS):
            group = cells[start : start + GROUP_CELLS]
            place = F.array_position(F.array(*[F.lit(c[3]) for c in group]), F.col("cell_rank")) - 1
            placed = self._of(group).repartitionById(len(group), place.cast("int"))
            yield from placed.sortWithinPartitions(*self.order).toLocalIterator(prefetchPartitions=True)


def _cell_table(spark: SparkSession, cells: Iterable[Cell]) -> DataFrame:
    return spark.createDataFrame(list(cells), CELL_SCHEMA)


def _listings(spark: SparkSession, catalogs: dict) -> DataFrame:
    result = None
    for source, catalog in sorted(catalogs.items()):
        rows = catalog.files.select(
            F.lit(source).alias("source"),
            F.col("norder").alias("partner_norder"),
            F.col("npix").alias("partner_npix"),
            "path",
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def _paths(*tables: DataFrame) -> list[dict[str, list[str]]]:
    """Per table, the partition files of each source; metadata, so held on the driver."""
    rows = None
    for n, table in enumerate(tables):
        one = table.select(F.lit(n).alias("table"), "source", "path").distinct()
        rows = one if rows is None else rows.unionByName(one)
    found: list[dict[str, list[str]]] = [{} for _ in tables]
    for row in rows.collect():
        found[row["table"]].setdefault(row["source"], []).append(row["path"])
    return found


def open_stream(
    spark: SparkSession,
    registry: Registry,
    *,
    split: str = "train",
    seed: int = 0,
    epoch: int = 0,
    shard: int = 0,
    num_shards: int = 1,
    match_index: str | None = None,
    hub: HubAdapter | None = None,
    adapters: dict[str, SpokeAdapter] | None = None,
    image_shape: tuple[int, ...] = IMAGE_SHAPE,
    check: bool = True,
) -> Stream:
    """Open one epoch of the corpus that a match index defines.

    The anchor catalog is registered under the index's anchor source.
    """
    path = resolve_match_index(match_index)
    if path is None:
        raise ValueError(f"streaming requires match_index or ${MATCH_INDEX_ENV}")
    plan.check_split(split)
    index = load_index(spark, path)
    fingerprint = {
        "assembly": index.assembly,
        "revisions": index.revisions,
        "split": split,
        "seed": seed,
        "epoch": epoch,
        "shard": shard,
        "num_shards": num_shards,
    }
    where = (split, seed, epoch, shard, num_shards)
    if index.is_graph:
        hub = hub or hub_adapter(image_shape)
        adapters = spoke_adapters() if adapters is None else adapters
        stream = _graph_stream(spark, registry, index, where, hub, adapters, check, fingerprint)
    else:
        stream = _pair_stream(spark, registry, index, where, image_shape, fingerprint)
    print(
        f"[data] open_stream {index.assembly} split={split} epoch={epoch} "
        f"shard={shard}/{num_shards} n_shards={stream.n_shards}",
        flush=True,
    )
    return stream


def _rank_cells(
    index: MatchIndex, anchors: Catalog, split: str, seed: int, epoch: int, shard: int, num_shards: int
) -> tuple[Cell, ...]:
    """This rank's cells with their files, by their place in the epoch.

    One row per anchor partition: metadata, so held on the driver.
    """
    listed = index.anchor_cells.join(anchors.files, ["norder", "npix"], "left")
    if index.is_graph:
        order = F.col("norder").cast("int")
        listed = listed.withColumn("split", split_of_cell(order, F.col("npix")))
    rows = sorted(listed.collect(), key=lambda r: (r["norder"], r["npix"]))
    missing = [(r["norder"], r["npix"]) for r in rows if r["path"] is None]
    if missing:
        raise ValueError(
            f"match index references {len(missing)} anchor partitions absent from "
            f"{anchors.url} (first: {missing[0]})"
        )
    if index.is_graph:
        rows = [r for r in rows if r["split"] == split]
    else:
        first = plan.reserved(len(rows))
        rows = rows[:first] if split == "val" else rows[first:]
    return tuple(
        (rows[at]["norder"], rows[at]["npix"], rows[at]["path"], rank)
        for rank, at in enumerate(plan.permutation(len(rows), seed, epoch))
        if num_shards <= 1 or rank % num_shards == shard
    )


def _graph_stream(spark, registry, index: MatchIndex, where, hub, adapters, check, fingerprint) -> Stream:
    anchors = registry.open(spark, index.anchor_source, index.anchor_revision)
    catalogs = {
        source: registry.open(spark, source, revision)
        for source, revision in index.partner_revisions.items()
    }
    used = {s: adapter_for(s, adapters) for s in catalogs}
    cells = _rank_cells(index, anchors, *where)
    ranks, own_cells = _ranks(spark, cells)

    refs = references(index.partner_cells, _listings(spark, catalogs))
    eligible = [s for s, a in used.items() if a.emits_unmatched]
    owners = cut_lineage(graph_owners(refs, where[0], eligible).join(ranks, ["norder", "npix"]))
    mine = cut_lineage(refs.join(own_cells, ["norder", "npix"], "left_semi"))
    edges = cut_lineage(index.edges.join(own_cells, ["norder", "npix"], "left_semi"))

    def spokes(paths: dict[str, list[str]]) -> dict[str, Spoke]:
        return {
            s: Spoke(used[s], catalogs[s].scan(used[s].read_columns, chosen))
            for s, chosen in paths.items()
        }

    def assemble(chosen: list[Cell]) -> DataFrame:
        ranks, own_cells = _ranks(spark, chosen)
        fetched = mine.join(own_cells, ["norder", "npix"], "left_semi")
        owned = owners.join(own_cells, ["norder", "npix"], "left_semi")
        matched_files, owned_files = _paths(fetched, owned)
        return star.assemble(
            anchors.scan(hub.read_columns, [c[2] for c in chosen]).drop("path").join(ranks, ["norder", "npix"]),
            hub,
            edges.join(own_cells, ["norder", "npix"], "left_semi"),
            fetched.drop("path"),
            spokes({s: matched_files.get(s, []) for s in used}),
            spokes(owned_files),
            index.matched_ids(),
            owned.select("source", "partner_norder", "partner_npix", "cell_rank"),
            check=False,  # all cells were checked when the stream was opened
        )

    def at_least(chosen: list[Cell]) -> int:
        return anchors.scan([], [c[2] for c in chosen]).count()  # each anchor row is a record

    (all_files,) = _paths(mine)
    ids = star.narrow_ids(spokes({s: all_files.get(s, []) for s in used}))
    missing = None
    if used:
        # one pass over the ids finds both; what is in order leaves no row
        odd = cut_lineage(star.lookups(edges, mine.drop("path"), ids).where("copies <> 1"))
        if check:
            star.refuse_duplicates(odd)
        missing = star.missing_partners(edges, odd)
    return Stream(spark, assemble, at_least, star.ORDER, cells, fingerprint, missing)


def _ranks(spark: SparkSession, cells: Iterable[Cell]) -> tuple[DataFrame, DataFrame]:
    """(norder, npix, cell_rank) of some cells, and the same without the rank."""
    cells = list(cells)
    ranks = plan.small(_cell_table(spark, cells).select("norder", "npix", "cell_rank"), len(cells))
    return ranks, ranks.drop("cell_rank")


def _pair_stream(spark, registry, index: MatchIndex, where, image_shape, fingerprint) -> Stream:
    edges, partner_cells = pair_view(index)
    anchors = registry.open(spark, index.anchor_source, index.anchor_revision)
    spectra = registry.open(spark, PAIR_SOURCE, index.partner_revisions[PAIR_SOURCE])
    cells = _rank_cells(index, anchors, *where)
    ranks, own_cells = _ranks(spark, cells)

    refs = references(partner_cells, _listings(spark, {PAIR_SOURCE: spectra}))
    owners = cut_lineage(pair_owners(refs).join(ranks, ["norder", "npix"]))
    mine = cut_lineage(refs.join(own_cells, ["norder", "npix"], "left_semi"))
    edges = cut_lineage(edges.join(own_cells, ["norder", "npix"], "left_semi"))

    def assemble(chosen: list[Cell]) -> DataFrame:
        ranks, own_cells = _ranks(spark, chosen)
        fetched = mine.join(own_cells, ["norder", "npix"], "left_semi")
        (paths,) = _paths(fetched)
        images = anchors.scan(_own_columns(anchors), [c[2] for c in chosen]).drop("path")
        return pair.pair_records(
            images.join(ranks, ["norder", "npix"]),
            edges.join(own_cells, ["norder", "npix"], "left_semi"),
            fetched.select("norder", "npix", "partner_norder", "partner_npix"),
            spectra.scan(_own_columns(spectra), paths.get(PAIR_SOURCE, [])).drop("path"),
            index.matched_ids(),
            owners.join(own_cells, ["norder", "npix"], "left_semi").select(
                "partner_norder", "partner_npix", "norder", "npix", "cell_rank"
            ),
            images.groupBy("norder", "npix").agg(F.count("*").alias("rows")),
            image_shape=image_shape,
        )

    def at_least(chosen: list[Cell]) -> int:
        # an image whose spectrum is gone is dropped, so only images without an edge are sure
        _, own_cells = _ranks(spark, chosen)
        images = anchors.scan([], [c[2] for c in chosen]).count()
        return images - edges.join(own_cells, ["norder", "npix"], "left_semi").count()

    return Stream(spark, assemble, at_least, pair.ORDER, cells, fingerprint)


def _own_columns(catalog: Catalog) -> list[str]:
    """All published columns; Catalyst drops those no record field uses."""
    return [c for c in catalog.schema.names if c not in ("norder", "npix", "path", "row_index")]


__all__ = ["GRAPH_ASSEMBLY", "PAIR_ASSEMBLY", "Stream", "open_stream"]
