"""The same stream as a Structured Streaming query with a restartable checkpoint.

The source is the cell plan: small files of cells, written in the epoch's order. A
micro-batch takes the next file, plans the records of its cells alone as ordinary Spark
work and writes them below the place of its first cell. A restart continues with the first
unfinished file; a repeated batch overwrites its own folder, so every record arrives
exactly once.

A plan is committed by one manifest, which appears whole and is never changed. The plan files follow from it: they
bear its key and the place of their first cell in their names, each appears by one rename, and one that is there is
left alone. So a driver may be lost at any line: before the manifest nothing has happened, and after it
the next run, of the writer or of the reader, adds the files that are missing and no other.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources import publish as commit
from .stream import CELL_SCHEMA, Cell, Stream

_CELL = ("norder", "npix", "path", "cell_rank")


@dataclass(frozen=True)
class CellPlan:
    """What a manifest says: the cells of a stream in their order, ``per_batch`` to a file."""

    key: str
    told: str
    millis: int
    per_batch: int
    cells: tuple[Cell, ...]

    @property
    def ranks(self) -> list[int]:
        return [cell[3] for cell in self.cells]

    def publish(self, spark: SparkSession, folder: str) -> None:
        """Add the plan files that are missing; their times follow the order of the cells."""
        for number, start in enumerate(range(0, len(self.cells), self.per_batch)):
            group = self.cells[start : start + self.per_batch]
            lines = [json.dumps(dict(zip(_CELL, cell))) for cell in group]
            name = f"{group[0][3]:08d}-{self.key}.json"
            commit.publish(spark, f"{folder}/{name}", "\n".join(lines) + "\n", self.millis + number)


def _told(stream: Stream) -> str:
    """What must be equal for two streams to have the same records: corpus, epoch, and where it starts."""
    return json.dumps({**stream.fingerprint, "position": stream.position}, sort_keys=True, default=str)


def write_cell_plan(stream: Stream, folder: str, *, cells_per_batch: int = 64) -> int:
    """Write the plan, one file per micro-batch; file times follow the epoch's order.

    A plan that is there already is not written again, only completed, so a program may run again from its
    start. Plans of other shards of the same stream may be added; one of another stream, or of cells
    that are planned already, is refused. ``<folder>-plans`` holds the manifests.
    """
    spark, folder = stream.spark, folder.rstrip("/")
    told, cells = _told(stream), stream.chosen
    named = json.dumps([told, [cell[3] for cell in cells], cells_per_batch])
    plan = CellPlan(hashlib.sha1(named.encode()).hexdigest(), told, int(time.time() * 1000), cells_per_batch, cells)
    known = cell_plans(spark, folder)
    mine = next((p for p in known if p.key == plan.key), None)
    if mine is None and cells:
        if any(p.told != told for p in known):
            raise ValueError(f"{folder} holds the plan of another stream")
        if set(plan.ranks) & {rank for p in known for rank in p.ranks}:
            raise ValueError(f"{folder} holds a plan of some of these cells")
        commit.publish(spark, f"{folder}-plans/{plan.key}.json", json.dumps(vars(plan)))
    (mine or plan).publish(spark, folder)
    return len(cells)


def cell_plans(spark: SparkSession, folder: str) -> list[CellPlan]:
    """The committed plans of a folder; one row per cell, so metadata."""
    texts = commit.published(spark, f"{folder.rstrip('/')}-plans").values()
    plans = [CellPlan(**json.loads(text)) for text in texts]
    plans = [CellPlan(p.key, p.told, p.millis, p.per_batch, tuple(map(tuple, p.cells))) for p in plans]
    return sorted(plans, key=lambda p: (p.millis, p.key))


def stream_cells(stream: Stream, plan_folder: str, out: str, checkpoint: str) -> DataFrame:
    """Run all outstanding cells of the committed plans and return the records written so far.

    A plan of another stream is refused, and so is a ``stream`` that lacks some of the planned cells.
    """
    spark, folder = stream.spark, plan_folder.rstrip("/")
    plans = cell_plans(spark, folder)
    if not plans:
        raise ValueError(f"{folder} holds no plan")
    if any(p.told != _told(stream) for p in plans):
        raise ValueError(f"{folder} holds the plan of another stream")
    if {rank for p in plans for rank in p.ranks} - {cell[3] for cell in stream.chosen}:
        raise ValueError(f"{folder} plans cells that this stream does not have")
    for plan in plans:
        plan.publish(spark, folder)

    def write_batch(batch: DataFrame, number: int) -> None:
        ranks = [r["cell_rank"] for r in batch.select("cell_rank").collect()]  # those of one plan file
        # named by the cells and not by the batch, so a new checkpoint repeats the same folders
        stream.only(ranks).records.write.mode("overwrite").parquet(f"{out}/first_cell={min(ranks)}")

    run_available(spark, folder, CELL_SCHEMA, checkpoint, write_batch)
    return spark.read.parquet(out)


def run_available(
    spark: SparkSession,
    folder: str,
    schema: str,
    checkpoint: str,
    write_batch: Callable[[DataFrame, int], None],
    form: str = "json",
) -> None:
    """Process every file not yet committed in the checkpoint, one per batch, then stop."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).format(form).load(folder)
    query = (
        source.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
