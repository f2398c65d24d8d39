"""Sales and prices laid out by cycle.

The line file has no date: which cycle a line belongs to is known only from its order.
So the join of lines and orders is made once and stored, and every later read of sales or
prices opens the cycles it asks for, partitioned by cycle, and nothing else.  A store that
is kept in a folder holds all cycles and serves all runs; when cycles are added or change,
``refresh`` replaces those and leaves the others.  A store for one session lays out the
cycles that are asked for: the rows of all others pass no further than the join.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.sources.staging import new_stage_path

MONEY = "decimal(18,2)"
SALES = ("ref_cycle int, seller_id bigint, item_id bigint, offer_kind string, territory int, invoice bigint, "
         f"sales_code string, units int, net {MONEY}, unit_price double, known_seller boolean, cycle int")
PRICES = (f"item_id bigint, offer_kind string, sales_code string, price {MONEY}, normal_price {MONEY}, "
          "vehicle string, cycle int")
LINES = ("ref_cycle int, seller_id bigint, item_id bigint, offer_kind string, territory int, invoice bigint, "
         f"units int, net {MONEY}, unit_price double, known_seller boolean, cycle int")
SOLD = f"item_id bigint, offer_kind string, normal_price {MONEY}"


class FactStore:
    """Three tables below ``folder``: sales and prices by cycle, and the items ever sold.

    ``lines(lo, hi)`` gives the rows of ``LINES`` of some cycles, ``items()`` an item's
    sales code, normal price and vehicle.  Without a folder the store is a set of stage
    tables, and ``windows`` names the cycles that runs will ask for, which are laid out together.
    """

    def __init__(self, spark: SparkSession, lines: Callable[..., DataFrame],
                 items: Callable[[], DataFrame], folder: str | None = None,
                 windows: list[tuple[int, int]] | None = None):
        self.spark, self.lines, self.items, self._folder = spark, lines, items, folder
        self._windows = [] if windows is None else windows
        self._laid_out: list[tuple[int | None, int | None]] = []

    def _path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def _complete(self, folder: str) -> bool:
        """The table of sold items is written last."""
        try:
            self.spark.read.schema(SOLD).parquet(f"{folder}/sold").schema
            return True
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    @cached_property
    def folder(self) -> str:
        """The folder of the store; one that is kept is filled at the first use."""
        if self._folder is None:
            return new_stage_path(self.spark, "facts")
        if not self._complete(self._folder):
            self._fill(self._folder, self.lines(), None, None)
            self._fill_sold(self._folder)
        return self._folder

    def refresh(self, lo: int, hi: int | None = None) -> "FactStore":
        """Replace the cycles ``lo`` to ``hi`` by what the sources say now."""
        self._lay_out(None, None)
        self._fill(self.folder, self.lines(lo, hi), lo, hi)
        self._fill_sold(self.folder)
        self.__dict__.pop("_sold", None)
        return self

    # ---- a store for one session ---------------------------------------------
    @cached_property
    def _joined(self) -> DataFrame:
        """Lines of all cycles as they come from the join with their orders."""
        path = new_stage_path(self.spark, "lines")
        self.lines().write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(LINES).parquet(path)

    def _lay_out(self, lo: int | None, hi: int | None) -> None:
        """Sales and prices of the cycles asked for, as far as they are not there yet."""
        if self._folder is not None:
            return
        if lo is not None and hi is not None:
            lo, hi = next(((a, b) for a, b in self._windows if a <= lo and hi <= b), (lo, hi))
        for a, b in _without(lo, hi, self._laid_out):
            rows = self._cycles(self._joined, a, b, nulls=True)
            self._fill(self.folder, rows, a, b)
            self._laid_out.append((a, b))

    @cached_property
    def _sold(self) -> str:
        """The folder of the items ever sold."""
        if self._folder is not None or self._laid_out == [(None, None)]:
            if not self._complete(self.folder):
                self._fill_sold(self.folder)
            return self._path("sold")
        path = new_stage_path(self.spark, "sold")
        (self._joined.select("item_id", "offer_kind").distinct()
         .join(self.items().select("item_id", "normal_price"), "item_id")
         .select("item_id", "offer_kind", "normal_price").distinct().write.parquet(path))
        return path

    # ---- layout --------------------------------------------------------------
    def _fill(self, folder: str, lines: DataFrame, lo: int | None, hi: int | None) -> None:
        mode = {"partitionOverwriteMode": "dynamic"}
        # One exchange by cycle, in which adaptive execution splits a cycle that is far
        # larger than others: a cycle is a few files of a good size, not one per task.
        (lines.join(self.items().select("item_id", "sales_code"), "item_id")
         .hint("rebalance", "cycle").write.options(**mode).mode("overwrite")
         .partitionBy("cycle").parquet(f"{folder}/sales"))
        fresh = self._cycles(self.spark.read.schema(SALES).parquet(f"{folder}/sales"), lo, hi, nulls=True)
        prices = (fresh.groupBy("cycle", "item_id", "offer_kind").agg(F.min("unit_price").alias("unit_price"))
                  .join(self.items(), "item_id")
                  .select("item_id", "offer_kind", "sales_code",
                          (F.floor(F.col("unit_price") / 100) * 100).cast(MONEY).alias("price"),
                          "normal_price", "vehicle", "cycle"))
        (prices.hint("rebalance", "cycle").write.options(**mode).mode("overwrite")
         .partitionBy("cycle").parquet(f"{folder}/prices"))

    def _fill_sold(self, folder: str) -> None:
        (self.spark.read.schema(PRICES).parquet(f"{folder}/prices")
         .select("item_id", "offer_kind", "normal_price").distinct()
         .write.mode("overwrite").parquet(f"{folder}/sold"))

    @staticmethod
    def _cycles(df: DataFrame, lo: int | None, hi: int | None, nulls: bool = False) -> DataFrame:
        """Rows of the cycles ``lo`` to ``hi``; with ``nulls`` those of no cycle come before all."""
        if lo is not None:
            df = df.where(F.col("cycle") >= lo)
        if hi is None:
            return df
        last = F.col("cycle") <= hi
        return df.where(last | F.col("cycle").isNull() if nulls and lo is None else last)

    def _read(self, table: str, schema: str, lo: int | None, hi: int | None) -> DataFrame:
        self._lay_out(lo, hi)
        return self._cycles(self.spark.read.schema(schema).parquet(self._path(table)), lo, hi)

    def sales(self, lo: int | None = None, hi: int | None = None) -> DataFrame:
        return self._read("sales", SALES, lo, hi)

    def prices(self, lo: int | None = None, hi: int | None = None) -> DataFrame:
        return self._read("prices", PRICES, lo, hi)

    def sold(self) -> DataFrame:
        """Items ever sold: item, offer kind, normal price."""
        return self.spark.read.schema(SOLD).parquet(self._sold)


def _without(lo: int | None, hi: int | None, there: list[tuple[int | None, int | None]]) -> list[tuple]:
    """What is left of the cycles ``lo`` to ``hi`` (None: no bound) without those that are there."""
    left = [(lo, hi)]
    for a, b in there:
        parts = []
        for x, y in left:
            if (b is not None and x is not None and x > b) or (a is not None and y is not None and y < a):
                parts.append((x, y))
                continue
            if a is not None and (x is None or x < a):
                parts.append((x, a - 1))
            if b is not None and (y is None or y > b):
                parts.append((b + 1, y))
        left = parts
    return left
