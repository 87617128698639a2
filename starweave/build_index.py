"""Build the edge index of one partner catalog against the anchor catalog.

    python -m starweave.build_index --anchor-catalog A --anchor-source a --anchor-revision r1 \
        --partner-catalog P --partner-source p --partner-revision r2 --out p.parquet
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators.alignment import align_cells, check_alignment
from .operators.crossmatch import crossmatch
from .plans.coverage import overlapping, within_reach
from .sources.catalog import Catalog
from .sources.index import write_index


def parse_cell(value: str) -> tuple[int, int]:
    order, slash, pixel = value.partition("/")
    if not (slash and order.isdigit() and pixel.isdigit()):
        raise argparse.ArgumentTypeError("cell must be ORDER/PIXEL")
    return int(order), int(pixel)


def parser() -> argparse.ArgumentParser:
    flags = argparse.ArgumentParser(description=__doc__)
    for side in ("anchor", "partner"):
        flags.add_argument(f"--{side}-catalog", required=True)
        flags.add_argument(f"--{side}-source", required=True)
        flags.add_argument(f"--{side}-revision", required=True)
        flags.add_argument(f"--{side}-id-column", default="object_id")
        flags.add_argument(f"--{side}-strip-id", action="store_true")
    flags.add_argument("--radius-arcsec", type=float, default=1.0)
    flags.add_argument("--epoch-treatment", default="icrs_j2000_static")
    some = flags.add_mutually_exclusive_group()
    some.add_argument("--cell", type=parse_cell)
    some.add_argument("--limit-partitions", type=int)
    flags.add_argument("--workers", type=int, default=16, help="tasks the scans are cut into, at least")
    flags.add_argument("--out", required=True)
    return flags


def chosen_files(
    anchor: Catalog, partner: Catalog, radius_arcsec: float, cell: tuple[int, int] | None = None, count: int | None = None
) -> tuple[list[str], list[str]]:
    """The files of both catalogs that can hold a pair, by their cells; with ``cell`` or ``count`` for some anchor cells only."""
    ours, theirs = anchor.listing(), partner.listing()
    cells, others = [c[:2] for c in ours], [c[:2] for c in theirs]
    if cell is None and count is None:
        wanted = within_reach(cells, others, radius_arcsec)
    else:
        wanted = overlapping(cells, others)
        if cell is not None:
            if not any(w for w, c in zip(wanted, cells) if c == cell):
                raise ValueError(f"anchor cell {cell} does not meet the spoke")
            wanted = [c == cell for c in cells]
        else:
            first = set(sorted({c for w, c in zip(wanted, cells) if w})[:count])
            wanted = [c in first for c in cells]
    kept = [c for w, c in zip(wanted, ours) if w]
    near = within_reach(others, [c[:2] for c in kept], radius_arcsec)
    return [c[2] for c in kept], [c[2] for w, c in zip(near, theirs) if w]


def build(spark: SparkSession, args: argparse.Namespace) -> int:
    spark.conf.set("spark.sql.files.minPartitionNum", str(args.workers))
    anchor = Catalog.open(spark, args.anchor_catalog)
    partner = Catalog.open(spark, args.partner_catalog)
    check_alignment(align_cells(anchor.files, partner.files))
    ours, theirs = chosen_files(anchor, partner, args.radius_arcsec, args.cell, args.limit_partitions)
    edges = crossmatch(
        anchor.scan([args.anchor_id_column, "ra", "dec"], ours),
        partner.scan([args.partner_id_column, "ra", "dec"], theirs),
        anchor_source=args.anchor_source,
        anchor_revision=args.anchor_revision,
        anchor_id_column=args.anchor_id_column,
        anchor_strip_id=args.anchor_strip_id,
        partner_source=args.partner_source,
        partner_revision=args.partner_revision,
        partner_id_column=args.partner_id_column,
        partner_strip_id=args.partner_strip_id,
        radius_arcsec=args.radius_arcsec,
        epoch_treatment=args.epoch_treatment,
    )
    return write_index(edges, args.out)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("build-index").getOrCreate()
    print(f"wrote {build(spark, args)} matches -> {args.out}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
