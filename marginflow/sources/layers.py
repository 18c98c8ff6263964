"""Reading and writing whole layers (a folder with one table per name)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marginflow.functions.text import is_null_token
from marginflow.sources import files
from marginflow.sources.schemas import TABLE_DDL


class MissingTable(FileNotFoundError):
    """A contract table is absent; nothing downstream may run."""


# Margins of a cell are data here; the CSV writer would trim them by default
CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, ddl: str | StructType) -> DataFrame:
    """Typed scan of CSV that this library wrote; of other files use ``CsvScan``."""
    return spark.read.schema(ddl).options(**CSV_OPTIONS, mode="PERMISSIVE").csv(path)


#: Place of a row in its file, a struct (file, block, row): rows sort as they were ingested.
INGEST = "_ingest"
_RECORD = "_corrupt_record"


def with_ordinal(df: DataFrame, fmt: str) -> DataFrame:
    """A file scan with ``INGEST``. Parquet numbers its rows; of a CSV file the blocks are known
    and rows are read in order within each. Must be applied to the scan itself."""
    place = F.col("_metadata.file_path").alias("file")
    if fmt == "parquet":
        return df.select("*", F.struct(place, F.lit(0).cast("long").alias("block"),
                                       F.col("_metadata.row_index").alias("row")).alias(INGEST))
    return df.select("*", F.struct(place, F.col("_metadata.file_block_start").alias("block"),
                                   F.monotonically_increasing_id().alias("row")).alias(INGEST))


class CsvScan:
    """A CSV table read as text and typed cell by cell, so that nothing is lost unseen.

    ``table`` has the declared types; a cell that does not fit is NULL there and listed in
    ``bad_cells``. Cells that say "missing" (a null token) are no fault. Lines with more or fewer
    cells than columns cannot be told apart by column: they are only in ``bad_rows``.
    """

    def __init__(self, spark: SparkSession, path: str, ddl: str | StructType,
                 options: Mapping[str, object] | None = None):
        self.schema = ddl if isinstance(ddl, StructType) else StructType.fromDDL(ddl)
        text = StructType([StructField(f.name, StringType()) for f in self.schema])
        # cells of all columns are counted in every line, also where few columns are asked for
        lines = (spark.read.schema(text.add(_RECORD, StringType()))
                 .options(**{**CSV_OPTIONS, **(options or {})}, mode="PERMISSIVE",
                          columnNameOfCorruptRecord=_RECORD, columnPruning=False).csv(path))
        self._lines = with_ordinal(lines, "csv")
        # always true; Spark refuses to read nothing but the record itself
        cell = F.coalesce(F.octet_length(self.schema[0].name), F.lit(0)) >= 0
        self._fits = F.col(_RECORD).isNull() & cell
        self._odd = F.col(_RECORD).isNotNull() & cell

    def _typed(self, field: StructField) -> Column:
        cell = F.col(field.name)
        if isinstance(field.dataType, StringType):
            return cell
        return F.when(~is_null_token(cell), cell.try_cast(field.dataType))

    @property
    def ordered(self) -> DataFrame:
        """``table`` and the ordinal of every row."""
        return self._lines.filter(self._fits).select(
            *[self._typed(f).alias(f.name) for f in self.schema], INGEST)

    @property
    def table(self) -> DataFrame:
        return self.ordered.drop(INGEST)

    @property
    def bad_cells(self) -> DataFrame:
        """(file, block, row, column_name, value) of every cell that does not fit its type."""
        faults = [F.when(self._typed(f).isNull() & ~is_null_token(F.col(f.name))
                         & F.col(f.name).isNotNull(),
                         F.struct(F.lit(f.name).alias("column_name"),
                                  F.col(f.name).alias("value")))
                  for f in self.schema if not isinstance(f.dataType, StringType)]
        found = F.array_compact(F.array(*faults)) if faults else F.expr(
            "CAST(array() AS array<struct<column_name:string,value:string>>)")
        return (self._lines.filter(self._fits)
                .select(f"{INGEST}.*", F.inline(found)))

    @property
    def bad_rows(self) -> DataFrame:
        """(file, block, row, record) of every line of the wrong width."""
        return self._lines.filter(self._odd).select(
            f"{INGEST}.*", F.col(_RECORD).alias("record"))

    def faults(self) -> DataFrame:
        """(column_name, faults) of the columns with faults; wrong widths count as ``*``. One
        scan."""
        wide = self._odd
        counts = [F.struct(F.lit("*").alias("column_name"), F.count_if(wide).alias("faults"))]
        counts += [F.struct(F.lit(f.name).alias("column_name"), F.count_if(
            ~wide & self._typed(f).isNull() & ~is_null_token(F.col(f.name))
            & F.col(f.name).isNotNull()).alias("faults"))
            for f in self.schema if not isinstance(f.dataType, StringType)]
        return (self._lines.agg(F.array(*counts).alias("c")).select(F.inline("c"))
                .filter("faults > 0"))


class FileLayer(dict):
    """Tables by name. ``ordered`` gives one with the ordinal of its rows, ``scans`` the CSV
    scans that know what did not fit."""

    first_wins = True

    def __init__(self, tables: Mapping[str, DataFrame], ordered: Mapping[str, DataFrame],
                 scans: Mapping[str, CsvScan]):
        super().__init__(tables)
        self._ordered, self.scans = dict(ordered), dict(scans)

    def ordered(self, name: str) -> DataFrame:
        return self._ordered[name]


def read_layer(spark: SparkSession, folder: str, tables: Iterable[str] = tuple(TABLE_DDL),
               fmt: str = "csv") -> FileLayer:
    """All tables of a layer, lazily. Raises ``MissingTable`` if any is absent."""
    paths = {t: f"{folder}/{t}" + (".csv" if fmt == "csv" else "") for t in tables}
    absent = [p for p in paths.values() if not files.exists(spark, p)]
    if absent:
        raise MissingTable(", ".join(absent))
    if fmt == "csv":
        scans = {t: CsvScan(spark, p, TABLE_DDL[t]) for t, p in paths.items()}
        return FileLayer({t: s.table for t, s in scans.items()},
                         {t: s.ordered for t, s in scans.items()}, scans)
    found = {t: spark.read.parquet(p) for t, p in paths.items()}
    return FileLayer(found, {t: with_ordinal(df, "parquet") for t, df in found.items()}, {})


def quarantine_counts(scans: Mapping[str, CsvScan]) -> DataFrame:
    """(table_name, column_name, faults): what did not fit, per table and column."""
    return reduce(DataFrame.unionByName, [
        scan.faults().select(F.lit(name).alias("table_name"), "column_name", "faults")
        for name, scan in scans.items()])


def write_quarantine(scans: Mapping[str, CsvScan], folder: str) -> None:
    """Keep the faulty cells and lines aside, as ``folder/cells`` and ``folder/rows`` by table,
    with the place they came from."""
    for kind in ("cells", "rows"):
        aside = reduce(DataFrame.unionByName, [
            (scan.bad_cells if kind == "cells" else scan.bad_rows)
            .withColumn("table_name", F.lit(name)) for name, scan in scans.items()])
        aside.write.mode("overwrite").partitionBy("table_name").parquet(f"{folder}/{kind}")


def write_layer(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Replace every table of a layer."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.options(**CSV_OPTIONS).csv(f"{folder}/{name}.csv")
        else:
            writer.parquet(f"{folder}/{name}")


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Expose a layer to Spark SQL as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows), one scan per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t, df in tables.items()
    ]
    out = counts[0]
    for nxt in counts[1:]:
        out = out.unionByName(nxt)
    return out
