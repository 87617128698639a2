"""Parquet sky catalogs in the HATS layout: one file ``Norder=k/Dir=d/Npix=m.parquet`` per cell."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTING = "norder tinyint, npix bigint, path string"
#: Tasks per core that list the folders of a catalog.
LISTING_TASKS = 4

#: Numbers by width: a column that files disagree on is read as the wider one.
_WIDTHS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def plain_path(file: Column) -> Column:
    """A path as it is given to readers: listings and file metadata encode it as a URI."""
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def place_in_catalog(file: Column) -> Column:
    """The end of a path that tells the files of a catalog apart, however its start is spelled."""
    return F.regexp_extract(file, "Norder=.*$", 0)


def partition_path(file: Column) -> Column:
    """The ``…/Npix=m.parquet`` part of a file path; a partition may also be a folder."""
    leaf = F.substring_index(F.substring_index(file, "/Npix=", -1), "/", 1)
    return F.concat(F.substring_index(file, "/Npix=", 1), F.lit("/Npix="), leaf)


def partition_of(file: str) -> str:
    """``partition_path(plain_path(…))`` of a listed file, on the driver."""
    parts = unquote(file).split("/Npix=")
    return f"{parts[0]}/Npix={parts[-1].partition('/')[0]}"


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core: Spark's own choice is a task for each of up to 10,000 folders."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cell_of_path(path: Column) -> tuple[Column, Column]:
    """Order and pixel out of a partition's path, or of a file's as Spark names it: neither name holds what a URI encodes.

    Rows are many, and this is done for each of them in every scan, so the path is not decoded for it.
    """
    order = F.substring_index(F.substring_index(path, "/Norder=", -1), "/", 1)
    pixel = F.substring_index(F.substring_index(path, "/Npix=", -1), ".", 1)
    return order.cast("tinyint"), pixel.cast("bigint")


def project(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Top-level columns and ``struct.leaf`` paths; a struct keeps only the leaves asked for.

    Catalyst prunes the parquet schema to those leaves. A NULL struct stays NULL.
    """
    leaves: dict[str, list[str]] = {}
    plain = set(df.columns)
    for name in columns:
        head, dot, leaf = name.partition(".")
        if name in plain or not dot:
            leaves.setdefault(name, [])
        else:
            leaves.setdefault(head, []).append(leaf)
    result = []
    for name, parts in leaves.items():
        column = F.col(f"`{name}`")
        if parts:
            kept = F.struct(*[column.getField(leaf).alias(leaf) for leaf in parts])
            column = F.when(column.isNotNull(), kept)
        result.append(column.alias(name))
    return result


@dataclass(frozen=True)
class Catalog:
    """A catalog opened for reading; its file listing is metadata and lives on the driver."""

    spark: SparkSession
    url: str
    files: DataFrame  # (norder, npix, path), one row per partition
    schema: T.StructType
    later: tuple[tuple[str, int], ...] = ()  # (file, rows in the partition's files before it) of second and later files

    @classmethod
    def open(cls, spark: SparkSession, url: str) -> Catalog:
        """Open a catalog, or the primary catalog of a collection."""
        base = url.rstrip("/")
        try:
            lines = spark.read.text(f"{base}/collection.properties")
            primary = lines.where(F.col("value").rlike(r"^\s*hats_primary_table_url\s*="))
            row = primary.select(F.trim(F.substring_index("value", "=", -1)).alias("name")).first()
            if row is None:
                raise ValueError(f"collection {base} names no primary catalog")
            base = f"{base}/{row['name']}"
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
        table = cls._read_all(spark, base)
        names = sorted(table.inputFiles())
        rows = sorted({(partition_of(f),) for f in names})
        path = F.col("path")
        order, pixel = cell_of_path(path)
        files = spark.createDataFrame(rows, "path string").select(order.alias("norder"), pixel.alias("npix"), "path")
        catalog = cls(spark, base, files, table.schema, cls._starts(spark, names))
        # the listing made above serves all scans of the whole catalog
        vars(catalog).update(table=table, partitions=frozenset(path for (path,) in rows))
        return catalog

    @cached_property
    def table(self) -> DataFrame:
        """All files, listed once."""
        return self._read_all(self.spark, self.url, self.schema)

    @cached_property
    def partitions(self) -> frozenset[str]:
        """The paths of all partitions."""
        return frozenset(_by_partition(self.table.inputFiles()))

    @staticmethod
    def _starts(spark: SparkSession, names: list[str]) -> tuple[tuple[str, int], ...]:
        """Where the second and later files of partitions start, by the row counts in the footers of those partitions' files."""
        rows = [(path, unquote(f)) for path, held in sorted(_by_partition(names).items()) if len(held) > 1 for f in held]
        if not rows:
            return ()
        name = plain_path(F.col("_metadata.file_path"))
        with _few_listing_tasks(spark):  # no column is read
            counts = spark.read.parquet(*[f for _, f in rows]).groupBy(place_in_catalog(name)).count()
        known, starts, last, total = dict(tuple(r) for r in counts.collect()), [], None, 0
        for path, file in rows:
            place = file[file.rindex("Norder=") :]
            if path == last:
                starts.append((place, total))
            else:
                last, total = path, 0
            total += known.get(place, 0)
        return tuple(sorted(starts))

    def listing(self) -> list[tuple[int, int, str]]:
        """(norder, npix, path) of every partition, by cell."""
        return sorted((r["norder"], r["npix"], r["path"]) for r in self.files.collect())

    @classmethod
    def _read_all(cls, spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
        """All files below ``base``, with ``schema`` or the columns of all of them."""
        for tree in (f"{base}/dataset/Norder=*/Dir=*/Npix=*.parquet", f"{base}/Norder=*/Dir=*/Npix=*.parquet"):
            with _few_listing_tasks(spark):
                try:
                    if schema is not None:
                        return spark.read.schema(schema).parquet(tree)
                    return spark.read.option("mergeSchema", "true").parquet(tree)
                except Exception as error:  # the analyser's or the job's own error, by the way that footers are read
                    if "PATH_NOT_FOUND" in str(error):
                        absent = error
                        continue
                    if schema is not None or "CANNOT_MERGE" not in str(error):
                        raise
                    first = spark.read.parquet(tree)
                    files = sorted(unquote(f) for f in first.inputFiles())
                    return spark.read.schema(merged_schema(spark, files, first.schema)).parquet(tree)
        raise absent

    def scan(self, columns: Sequence[str], files: Iterable[str] | None = None) -> DataFrame:
        """Selected columns plus ``norder``, ``npix``, ``path`` and the row's place in its partition.

        In a partition of several files, later files go on counting where the one before ends.
        With ``files`` only those partitions are opened at all.
        """
        table = self.table
        if files is not None:
            chosen = sorted(set(files))
            if not chosen:
                return self.empty(columns)
            if chosen != sorted(self.partitions):
                with _few_listing_tasks(self.spark):
                    table = self.spark.read.schema(self.schema).parquet(*chosen)
        raw = F.col("_metadata.file_path")
        file = plain_path(raw)
        path = partition_path(file)
        order, pixel = cell_of_path(raw)
        rows = table.select(
            *project(table, columns),
            order.alias("norder"),
            pixel.alias("npix"),
            path.alias("path"),
            F.col("_metadata.row_index").alias("row_index"),
            *([place_in_catalog(file).alias("_file")] if self.later else []),
        )
        if not self.later:
            return rows
        # one row per file, as many as the driver has listed
        numbers = F.broadcast(self.spark.createDataFrame(list(self.later), "_file string, _number long"))
        place = F.col("row_index") + F.coalesce("_number", F.lit(0))
        return rows.join(numbers, "_file", "left").withColumn("row_index", place).drop("_file", "_number")

    def empty(self, columns: Sequence[str]) -> DataFrame:
        return self.scan(columns).limit(0)

    def row_counts(self) -> DataFrame:
        """Rows per partition; no column is read, only file footers and page headers."""
        table = self.scan([])
        return table.groupBy("norder", "npix", "path").agg(F.count("*").alias("rows"))


def _by_partition(names: Iterable[str]) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for name in names:
        found.setdefault(partition_of(name), []).append(name)
    return found


def union_schema(left: T.StructType, right: T.StructType) -> T.StructType:
    """All columns of both; of two numbers with one name the wider counts, else the right one."""
    fields = {f.name: f for f in left.fields}
    for field in right.fields:
        known = fields.get(field.name)
        fields[field.name] = field if known is None else T.StructField(field.name, _wider(known.dataType, field.dataType), True)
    return T.StructType(list(fields.values()))


def _wider(left: T.DataType, right: T.DataType) -> T.DataType:
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return union_schema(left, right)
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return T.ArrayType(_wider(left.elementType, right.elementType), True)
    if left in _WIDTHS and right in _WIDTHS:
        wide = max(left, right, key=_WIDTHS.index)
        whole = {type(t) for t in (left, right)} & {T.IntegerType, T.LongType}
        return T.DoubleType() if whole and wide == T.FloatType() else wide
    return right


def merged_schema(spark: SparkSession, files: list[str], first: T.StructType) -> T.StructType:
    """The columns of all ``files``, numbers as wide as in any of them; ``first`` is the schema of one.

    Spark merges the footers in parallel. Where types differ it refuses, and the list is halved, so a few files that
    differ cost a few merges.
    """
    if len(files) < 2:
        return spark.read.parquet(*files).schema if files else first
    try:
        return spark.read.option("mergeSchema", "true").parquet(*files).schema
    except Exception as error:  # the analyser's or the job's own error, by the way that footers are read
        if "CANNOT_MERGE" not in str(error):
            raise
    half = len(files) // 2
    return union_schema(merged_schema(spark, files[:half], first), merged_schema(spark, files[half:], first))


@dataclass
class Registry:
    """Where catalogs live: ``source → (base url, sub-folder, id column)``.

    ``pinned`` appends ``@revision`` to the base, as revision-addressed stores expect.
    """

    entries: dict[str, tuple[str, str | None, str]] = field(default_factory=dict)
    pinned: bool = True

    def register(self, source: str, url: str, subdir: str | None = None, id_column: str = "object_id") -> Registry:
        self.entries[source] = (url, subdir, id_column)
        return self

    def _entry(self, source: str) -> tuple[str, str | None, str]:
        if source not in self.entries:
            raise ValueError(f"no catalog registered for source {source!r}")
        return self.entries[source]

    def url(self, source: str, revision: str) -> str:
        base, subdir, _ = self._entry(source)
        if self.pinned and revision:
            base = f"{base}@{revision}"
        return f"{base}/{subdir}" if subdir else base

    def id_column(self, source: str) -> str:
        return self._entry(source)[2]

    def open(self, spark: SparkSession, source: str, revision: str) -> Catalog:
        return Catalog.open(spark, self.url(source, revision))


def write_catalog(df: DataFrame, base: str) -> None:
    """Write rows with ``norder`` and ``npix`` as a HATS-style tree, in ``row_index`` order.

    Spark names the files, so a cell is the folder ``Npix=m.parquet`` holding one file;
    the order of the cells bounds how large that file gets.
    """
    cells = df.withColumns(
        {"_n": F.col("norder"), "_d": F.floor(F.col("npix") / 10_000) * 10_000, "_p": F.concat("npix", F.lit(".parquet"))}
    ).drop("norder", "npix")
    order = [c for c in ("row_index",) if c in df.columns]
    # a fixed number: AQE would merge small partitions and write all files from one task
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism, 8)
    (
        cells.repartition(tasks, "_n", "_p")
        .sortWithinPartitions("_n", "_p", *order)
        .drop(*order)
        .withColumnsRenamed({"_n": "Norder", "_d": "Dir", "_p": "Npix"})
        .write.partitionBy("Norder", "Dir", "Npix")
        .mode("overwrite")
        .parquet(base)
    )
