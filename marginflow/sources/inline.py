"""Small reference tables built from the fixed values in ``settings``.

They are SQL ``VALUES``, a local relation whose exact size Catalyst knows, so it broadcasts them
on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from marginflow import settings as S
from marginflow.sources.schemas import TABLE_DDL


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def values_table(spark: SparkSession, rows: Sequence[Sequence[object]], ddl: str) -> DataFrame:
    """A few fixed rows with declared column types; numbers may be given as text."""
    columns = [part.strip().split(" ", 1) for part in ddl.replace("(18,4)", "(18.4)")
               .replace("(6,4)", "(6.4)").split(",")]
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    typed = ", ".join(f"CAST({name} AS {kind.replace('.', ',')}) AS {name}"
                      for name, kind in columns)
    names = ", ".join(name for name, _ in columns)
    return spark.sql(f"SELECT {typed} FROM VALUES {body} AS t({names})")


def category_economics(spark: SparkSession) -> DataFrame:
    return values_table(spark, S.CATEGORY_ECONOMICS, TABLE_DDL["ref_category_economics"])


def rate_card(spark: SparkSession) -> DataFrame:
    rows = [(zone, weight, leg, cost)
            for zone, weight, forward, reverse in S.RATE_CARD
            for leg, cost in (("forward", forward), ("reverse", reverse))]
    return values_table(spark, rows, TABLE_DDL["ref_logistics_rate_card"])


def return_reasons(spark: SparkSession) -> DataFrame:
    return values_table(spark, S.RETURN_REASONS, TABLE_DDL["dim_return_reason"])


def kpi_register(spark: SparkSession) -> DataFrame:
    rows = [(name, label, group, unit, place)
            for place, (name, label, group, unit) in enumerate(S.KPI_REGISTER, start=1)]
    return values_table(spark, rows, "kpi_name string, kpi_label string, kpi_group string, "
                                     "kpi_unit string, kpi_sort int")
