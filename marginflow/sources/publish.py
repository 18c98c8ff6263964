"""All-or-nothing publication of a layer.

Every publication writes its tables into a version folder of its own; readers follow a pointer
file that names one version. The pointer is replaced in one step after the last table is written,
so a run that dies between two tables leaves the former version readable, whole and unmixed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from marginflow.sources import files
from marginflow.sources.layers import MissingTable
from marginflow.sources.scratch import PACKED, freed

POINTER = "CURRENT"


def history(spark: SparkSession, folder: str) -> list[str]:
    """Names of the versions that were published and are kept, the current one first."""
    path = f"{folder}/{POINTER}"
    return files.read_text(spark, path).split() if files.exists(spark, path) else []


def current(spark: SparkSession, folder: str) -> str | None:
    """Name of the version that readers see; None before the first publication."""
    return next(iter(history(spark, folder)), None)


def _number(version: str) -> int:
    return int(version[1:].split("-")[0])


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the current version. A reader that holds them goes on reading that version
    when another one is published, as long as it is kept."""
    version = current(spark, folder)
    if version is None:
        raise MissingTable(f"{folder} was never published")
    path = f"{folder}/{version}"
    return {name: spark.read.parquet(f"{path}/{name}") for name in files.names(spark, path)}


class Publication:
    """A new version while it is being written."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        before = current(spark, self.folder)
        number = _number(before) + 1 if before else 1
        self.version = f"v{number:08d}-{uuid.uuid4().hex[:8]}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write one table and give it as it is stored; nobody else sees it yet."""
        path = f"{self.folder}/{self.version}/{name}"
        with freed(self.spark):
            df.write.options(**PACKED).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def switch(self, keep: int = 2) -> str:
        """Make this version the current one and keep ``keep`` published ones with it. What is
        older goes, and with it what runs before the last one left unfinished."""
        kept = [self.version, *history(self.spark, self.folder)][:keep]
        files.replace_text(self.spark, f"{self.folder}/{POINTER}", "\n".join(kept))
        for name in files.names(self.spark, self.folder):
            if name.startswith("v") and name not in kept and _number(name) < _number(self.version):
                files.delete(self.spark, f"{self.folder}/{name}")
        return self.version

    def discard(self) -> None:
        """Give this version up, and the folder if nothing was ever published in it."""
        files.delete(self.spark, f"{self.folder}/{self.version}")
        if not files.names(self.spark, self.folder):
            files.delete(self.spark, self.folder)


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str,
            accept: Callable[[Mapping[str, DataFrame]], None] | None = None,
            keep: int = 2) -> dict[str, DataFrame]:
    """Write all tables as a new version, let ``accept`` look at the written tables (it raises
    to refuse them), and switch. Refused versions are deleted; the former one stays current."""
    fresh = Publication(spark, folder)
    try:
        written = {name: fresh.write(name, df) for name, df in tables.items()}
        if accept is not None:
            accept(written)
    except Exception:
        fresh.discard()
        raise
    fresh.switch(keep)
    return written
