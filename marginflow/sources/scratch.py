"""Durable intermediate tables.

``durable`` writes a DataFrame as Parquet and reads it back. That cuts the lineage, survives
the loss of executors, fixes non-deterministic columns such as row numbers, keeps column
pruning, and gives Catalyst true file sizes to choose a join strategy from.

What a table was shuffled through is deleted once it is written, and its columns are packed
tightly, so the disk holds little more than the tables that are still to be read.

Tables lie in the folder that the cluster names in ``spark.checkpoint.dir``; where it names
none, in the SQL warehouse. A folder of a single machine is refused unless all of Spark runs there.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from marginflow.sources import files


# How stored tables are packed; every Parquet reader finds the codec in the files
PACKED = {"compression": "zstd"}
# Tables that only this library reads again; sorted and small numbers take fewer bytes
SCRATCH = PACKED | {"parquet.writer.version": "v2"}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _open = threading.Lock(), [0, None]  # how many ask for it now, and what was set before


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in this block are deleted when each write is done, not
    when the driver happens to collect its garbage. The setting of the session comes back."""
    with _lock:
        if not _open[0]:
            _open[1] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _open[0] += 1
    try:
        yield
    finally:
        with _lock:
            _open[0] -= 1
            if not _open[0]:
                if _open[1] is None:
                    spark.conf.unset(CLEANUP)
                else:
                    spark.conf.set(CLEANUP, _open[1])


class LocalFolder(RuntimeError):
    """Executors on several machines would each write to a folder of their own."""


def shared_folder(spark: SparkSession) -> str:
    """Where all executors can write. The folder in ``spark.checkpoint.dir`` is trusted to be
    shared, whatever its scheme; the warehouse is not if it is a local path of many machines."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    single = spark.sparkContext.master.startswith("local")
    if not single and ("://" not in warehouse or warehouse.startswith("file:")):
        raise LocalFolder(f"{warehouse} is a folder of one machine; set spark.checkpoint.dir")
    return f"{warehouse}/_scratch"


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/marginflow-{spark.sparkContext.applicationId}"


def durable(df: DataFrame, label: str = "table") -> DataFrame:
    """Write the rows once and return a DataFrame over the written files."""
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with freed(spark):
        df.write.options(**SCRATCH).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._durable_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete durable tables that nothing will read again, such as those of a past round."""
    for df in tables:
        path = getattr(df, "_durable_path", None)
        if path is not None:
            files.delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Delete every durable table this application wrote."""
    files.delete(spark, application_folder(spark))
