"""A small sky written from one rule, and the edges and records that follow from the rule."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.pandas.types import to_arrow_schema

from starweave.schemas import EDGE_SCHEMA
from starweave.sources.adapters import PROVABGS_RANGES, hub_adapter
from starweave.sources.catalog import Registry

HUB, ORDER, SHAPE = "north_survey", 5, (2, 3, 3)
BANDS = ["des-g", "des-z"]
#: Rows of the anchor catalog per cell. Cell 25 lies in the validation split, the others in train.
ANCHORS = {8: 5, 21: 4, 25: 3, 50: 2}
#: Cells whose anchor partition is a folder of two files.
FOLDERS = (8, 50)
#: Anchor n of a cell has a partner of a source where n is a multiple of this.
STEP = {"desi": 2, "sdss": 3, "provabgs": 4}
#: Rows per cell that nothing points to; the last source's are never records.
LONE = {"desi": 1, "sdss": 2, "provabgs": 1}


@dataclass
class Sky:
    root: Path
    #: Partner ids as the index has them, where they differ from the rule.
    renamed: dict[str, str] = field(default_factory=dict)
    #: Partner rows that are written a second time, with a redshift 0.5 higher.
    twice: tuple[str, ...] = ()
    registry: Registry = field(default_factory=lambda: Registry(pinned=False))
    folders: tuple[int, ...] = FOLDERS

    def write(self) -> Sky:
        for pixel, count in ANCHORS.items():
            rows = [anchor_row(pixel, n) for n in range(count)]
            where = self.root / "hub folder"  # a path that needs encoding
            if pixel in self.folders:
                folder = cell_path(where, pixel)
                folder.mkdir(parents=True)
                half = (count + 1) // 2
                put(folder / "part-0.parquet", rows[:half])
                put(folder / "part-1.parquet", rows[half:])
            else:
                put(cell_path(where, pixel), rows)
            for source in STEP:
                rows = [partner_row(source, pixel, f"x{k}", 0.3 + k / 9) for k in range(LONE[source])]
                rows += [partner_row(source, pixel, n) for n in reversed(range(count)) if n % STEP[source] == 0]
                again = [{**r, "Z": r["Z"] + 0.5} for r in rows if r["object_id"] in self.twice]
                put(cell_path(self.root / source, pixel), rows + again)
        self.registry.register(HUB, str(self.root / "hub folder"))
        for source in STEP:
            self.registry.register(source, str(self.root / source))
        return self

    def edges(self, sources=tuple(STEP)) -> list[dict]:
        found = []
        for source, pixel, n in matches():
            if source in sources:
                own = partner_name(source, pixel, n)
                blank = " " if pixel == 21 else ""
                found.append(edge(pixel, n, source, blank + self.renamed.get(own, own) + blank))
        return found

    def index(self, name: str, sources=tuple(STEP)) -> str:
        return write_edges(self.root / name / "edges.parquet", self.edges(sources))

    def cell_records(self, pixel: int) -> dict[str, set[str]]:
        """Record id → sources attached, in the order of the stream."""
        named = {self.renamed.get(partner_name(*m), partner_name(*m)) for m in matches()}
        records = {}
        for source in ("desi", "sdss"):
            own = [partner_name(source, pixel, f"x{k}") for k in range(LONE[source])]
            own += [partner_name(source, pixel, n) for n in reversed(range(ANCHORS[pixel])) if n % STEP[source] == 0]
            records |= {f"{source}:{name}": {source} for name in own if name not in named}
        for n in range(ANCHORS[pixel]):
            there = {s for s, p, k in matches() if (p, k) == (pixel, n) and partner_name(s, p, k) not in self.renamed}
            records[anchor_name(pixel, n)] = there
        return records


def matches() -> list[tuple[str, int, int]]:
    return [(s, p, n) for p, count in ANCHORS.items() for s in STEP for n in range(count) if n % STEP[s] == 0]


def anchor_name(pixel: int, n: int) -> str:
    return f"hub-{pixel}-{n}"


def partner_name(source: str, pixel: int, n: int | str) -> str:
    return f"{source}-{pixel}-{n}"


def place(pixel: int, n: int, aside: float = 0.0) -> dict:
    """A degree or more between anchors; ``aside`` moves a row away from all of them."""
    child = (pixel << 2 * (29 - ORDER)) + n
    return {"ra": 3.0 * pixel + 1.5 * n, "dec": aside - 12.0 + pixel / 2, "_healpix_29": child}


def flux(pixel: int, n: int) -> list:
    bands, high, wide = SHAPE
    return [[[float(pixel + n + b + y * wide + x) for x in range(wide)] for y in range(high)] for b in range(bands)]


def redshift(pixel: int, n: int | str) -> float:
    return 0.05 if isinstance(n, str) else pixel / 100 + n / 1000


def anchor_row(pixel: int, n: int) -> dict:
    image = {"flux": flux(pixel, n), "band": BANDS, "psf_fwhm": [1.0 + n / 4, 2.0]}
    scalars = {name: 1.0 + k for k, name in enumerate(hub_adapter(SHAPE).columns) if name != "image"}
    return {"object_id": anchor_name(pixel, n), **place(pixel, n), "image": image, **scalars}


def partner_row(source: str, pixel: int, n: int | str, aside: float = 0.0) -> dict:
    name = partner_name(source, pixel, n)
    row = {"object_id": name, **place(pixel, 0 if isinstance(n, str) else n, aside), "Z": redshift(pixel, n)}
    if source == "provabgs":
        return {**row, **{c: 0.15 for c in PROVABGS_RANGES}, "LOG_MSTAR": 9.0 + pixel / 50, "TSNR2_BGS": 7.0}
    spectrum = {"flux": [float(pixel), 0.5, 2.5], "lambda": [3600.0, 3601.5, 3603.0], "mask": [False, True, False], "ivar": [4.0] * 3}
    row |= {"spectrum": spectrum}
    if source == "sdss":
        return {**row, "object_id": f"  {name}".encode(), "Z_ERR": 0.002, "ZWARNING": False}
    return {**row, "ZERR": 0.001, "ZWARN": pixel == 50}


def edge(pixel: int, n: int, source: str, partner: str, **other) -> dict:
    values = (2, HUB, "rev-a", ORDER, pixel, anchor_name(pixel, n), source, f"rev-{source}", ORDER, pixel, partner)
    values += ("positional", 0.25, 1.5, "icrs_j2000_static")
    return dict(zip(EDGE_SCHEMA.names, values)) | other


def cell_path(base: Path, pixel: int) -> Path:
    return base / f"Norder={ORDER}" / "Dir=0" / f"Npix={pixel}.parquet"


def put(path: Path, rows: list[dict], schema=None) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), path)


def write_edges(path: Path, rows: list[dict]) -> str:
    put(path, rows, to_arrow_schema(EDGE_SCHEMA))
    return str(path)
