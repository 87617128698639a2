"""Merge a directory of edge indexes into one row per anchor object.

    python -m starweave.merge_index --spokes north/ --out merged/index.parquet
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators.layout import pivot_edges
from .sources.index import read_index, write_index


def merge(spark: SparkSession, spokes: str, out: str) -> int:
    edges = read_index(spark, spokes).drop("_row_at")
    return write_index(pivot_edges(edges).orderBy("anchor_order", "anchor_pixel", "anchor_id"), out)


def main(argv: list[str] | None = None) -> int:
    flags = argparse.ArgumentParser(description=__doc__)
    flags.add_argument("--spokes", required=True)
    flags.add_argument("--out", required=True)
    args = flags.parse_args(argv)
    spark = SparkSession.builder.appName("merge-index").getOrCreate()
    print(f"wrote {merge(spark, args.spokes, args.out)} anchors -> {args.out}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
