"""Sinks: typed tables as Parquet, or the tab-separated lines of the lexical formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def tsv(table: DataFrame) -> DataFrame:
    """One column ``value``: all columns tab-separated, arrays spread, nulls empty."""
    parts = [F.array_join(f.name, "\t") if isinstance(f.dataType, ArrayType) else F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in table.schema]
    line = parts[0]
    for field, part in zip(table.schema.fields[1:], parts[1:], strict=True):
        # An empty array leaves no empty column behind.
        gap = F.when(F.size(field.name) > 0, "\t").otherwise("") if isinstance(field.dataType, ArrayType) else F.lit("\t")
        line = F.concat(line, gap, part)
    return table.select(line.alias("value"))


def write_tsv(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    tsv(table).write.mode(mode).text(path)


def write_parquet(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    table.write.mode(mode).parquet(path)
