"""Result tables: overwrite, partition overwrite, self overwrite, optional read, run log."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_text
from offerlens.params import RunParams
from offerlens.sources.staging import cut

LOG_SCHEMA = ("country string, process_cycle string, target_cycle string, kind string, load int, "
              "engine int, profile string, peer_grouping int, personalisation string, "
              "message string, logged_at timestamp, status boolean, run_id string, step string")


@contextmanager
def _dynamic_partitions(spark: SparkSession):
    """Replace only the partitions that are written (a session setting: inserts
    into catalog tables take it from nowhere else)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Repository:
    """Named result tables in one catalog schema.

    ``location`` places new tables under a folder instead of the warehouse.
    """

    def __init__(self, spark: SparkSession, schema: str = "default", location: str | None = None):
        self.spark, self.schema, self.location = spark, schema, location

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def read(self, table: str, columns: str) -> DataFrame:
        """The given columns of a table, which may be missing or have drifted.

        A missing table has no rows.  Columns are found by name, without regard to case or
        order; one that the table lacks is null, one of another type is cast (null where a
        value cannot be), and what the table has beyond them is left out.
        """
        if not self.spark.catalog.tableExists(self.name(table)):
            return self.spark.createDataFrame([], columns)
        df, wanted = self.spark.table(self.name(table)), self.spark.createDataFrame([], columns).schema
        have = {c.lower(): c for c in df.columns}
        return df.select(*[
            (F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType))
            .alias(f.name) for f in wanted])

    def _writer(self, df: DataFrame, table: str, mode: str):
        writer = df.write.mode(mode).format("parquet")
        return writer.option("path", f"{self.location}/{table}") if self.location else writer

    def save(self, df: DataFrame, table: str, partitions: list[str] | None = None,
             skip: bool = False, overwrite_self: bool = False) -> DataFrame:
        """Write a result and return the stored table.

        Without partitions the table is replaced.  With partitions only those
        present in ``df`` are replaced, and the table is created when absent;
        rows are clustered by partition value first, with room for Spark to
        split large ones, so each partition gets few, well-sized files.
        ``overwrite_self`` is for results computed from the table itself: they
        are staged before the old partitions go.  ``skip`` only reads.
        """
        full = self.name(table)
        if skip:
            return self.spark.table(full)
        if not partitions:
            self._writer(df, table, "overwrite").saveAsTable(full)
            return self.spark.table(full)
        keys = [p.lower() for p in partitions]
        lowered = df.toDF(*[c.lower() for c in df.columns])
        ordered = lowered.select(*[c for c in lowered.columns if c not in keys], *keys)
        if overwrite_self:
            ordered = cut(ordered, f"self-{table}")
        # REBALANCE lets AQE split a partition value that is far larger than others
        spread = ordered.hint("rebalance", *keys)
        if self.spark.catalog.tableExists(full):
            with _dynamic_partitions(self.spark):
                spread.write.mode("overwrite").insertInto(full)
            self.spark.catalog.refreshTable(full)
        else:
            self._writer(spread, table, "errorifexists").partitionBy(*keys).saveAsTable(full)
        return self.spark.table(full)


class RunLog:
    """Log entries of one step of a run, stored as one file at its end.

    The log table is partitioned by run and step, and a step replaces what it stored
    before: a run that failed and is tried again under its id leaves one set of rows, and
    a retried write leaves no row twice.
    """

    def __init__(self, run_id: str, run: RunParams, step: str = "run"):
        self.run_id, self.run, self.step = run_id, run, step
        self._entries: list[tuple] = []

    def _push(self, message: str, status: bool) -> None:
        r = self.run
        self._entries.append((
            r.country, cycle_text(r.process_cycle), cycle_text(r.target_cycle), r.kind, r.load,
            r.engine, r.profile, r.peer_grouping, r.personalisation, message,
            dt.datetime.now(), status, self.run_id, self.step))

    def ok(self, message: str) -> None:
        self._push(message, True)

    def error(self, message: str) -> None:
        self._push(message, False)

    def flush(self, repository: Repository, table: str) -> DataFrame:
        """Store all entries so far; they are kept, so a later flush holds them too."""
        df = repository.spark.createDataFrame(self._entries, LOG_SCHEMA).coalesce(1)
        return repository.save(df, table, ["run_id", "step"])
