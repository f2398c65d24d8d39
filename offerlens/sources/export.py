"""A source written as warehouse tables and parameter files.

The inverse of :mod:`offerlens.sources.warehouse`: any source with the engine's table
methods becomes catalog tables under the original names, partitioned by country and
cycle, and header CSV files.  Runs then start from those.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.functions.cycles import format_cycle
from offerlens.sources.staging import new_stage_path
from offerlens.sources.warehouse import (CYCLE_COLUMNS, OFFER_FILE_NAMES, PARAMETER_FILES,
                                         WAREHOUSE, ParameterFiles, WarehouseTables)

# Tables that differ between countries; the product table is shared.
SHARED = ("DWH_DPRODUCTO",)


def write_table(df: DataFrame, schema: str, name: str, countries: list[str], folder: str) -> None:
    """One table under its original names.  Rows are clustered by partition first, and
    adaptive execution splits a partition that is far larger than others."""
    texts = df.withColumns({c: format_cycle(c) for c in CYCLE_COLUMNS if c in df.columns})
    out = texts.select(*[F.col(dst).alias(src) for src, dst in WAREHOUSE[name].items() if dst in df.columns])
    keys = []
    if name not in SHARED:
        out = out.withColumn("CodPais", F.explode(F.array(*map(F.lit, countries))))
        keys.append("CodPais")
    if "AnioCampana" in out.columns:
        keys.append("AnioCampana")
    writer = (out.select(*[c for c in out.columns if c not in keys], *keys).hint("rebalance", *keys) if keys else out).write
    writer = writer.format("parquet").option("path", f"{folder}/{name.lower()}")
    (writer.partitionBy(*keys) if keys else writer).saveAsTable(f"{schema}.{name}")


def source_frames(tables, lo: int, hi: int) -> dict[str, Callable[[], DataFrame]]:
    """The seven tables of a source: sales and status of a window of cycles, the price
    list of all cycles."""
    return {
        "DWH_FVTAPROEBECAM": lambda: tables.sales(lo, hi), "DWH_FSTAEBECAM": lambda: tables.status(lo, hi),
        "DWH_DEBELISTA": tables.sellers, "DWH_DGEOGRAFIACAMPANA": tables.geography,
        "DWH_DTIPOOFERTA": tables.offer_kinds, "DWH_DMATRIZCAMPANA": tables.catalog,
        "DWH_DPRODUCTO": tables.products,
    }


def write_tables(spark: SparkSession, tables, schema: str, folder: str, lo: int, hi: int,
                 countries: list[str]) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{folder}'")
    for name, build in source_frames(tables, lo, hi).items():
        write_table(build(), schema, name, countries, folder)


def write_file(df: DataFrame, name: str, path: str) -> None:
    """One parameter file: a header, then the fields of a line as they are, without quotes."""
    declared = [f.split(" ")[0] for f in PARAMETER_FILES[name].split(", ")]
    fields = [F.coalesce(F.col(OFFER_FILE_NAMES[n]).cast("string"), F.lit("")) for n in declared]
    # One column with a separator that never occurs, so that the writer quotes nothing.
    (df.select(F.concat_ws(",", *fields).alias(",".join(declared)))
     .write.options(header=True, sep="\u0001", quote="", escapeQuotes=False).csv(path))


class WrittenFiles(ParameterFiles):
    """Parameter files of another source, each written when it is first read."""

    def __init__(self, spark: SparkSession, folder: str, country: str,
                 source: dict[str, Callable[[], DataFrame]], files: dict[str, str] | None = None):
        super().__init__(spark, folder, country, dict(files or {}))
        self.source, self._names = source, dict(files or {})

    def lines(self, name: str) -> DataFrame:
        if name not in self._open:
            # A folder for each attempt: what a failed one left behind is not in the way.
            self.files[name] = f"{uuid.uuid4().hex}/{self._names.get(name, name + '.csv')}"
            write_file(self.source[name](), name, self.path(name))
        return super().lines(name)


class WrittenTables(WarehouseTables):
    """Warehouse tables of another source, each written when it is first read."""

    def __init__(self, spark: SparkSession, schema: str, country: str, files: ParameterFiles,
                 source: dict[str, Callable[[], DataFrame]], countries: list[str],
                 configured_days: bool = False):
        super().__init__(spark, schema, country, files, configured_days)
        self.source, self.countries, self.written = source, countries, set()

    def _table(self, name: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
        if name not in self.written:
            write_table(self.source[name](), self.schema, name, self.countries,
                        new_stage_path(self.spark, "warehouse"))
            self.written.add(name)
        return super()._table(name, lo, hi)
