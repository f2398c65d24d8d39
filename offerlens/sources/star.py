"""Business tables derived from the star schema of orders and line items.

Each method returns one business table (sales, catalogue, seller status, ...)
as a lazy DataFrame.  Methods that cover history take a cycle range.  On ``orders``
it becomes a date range; sales and prices come from a store by cycle (see
:mod:`offerlens.sources.facts`), for which the lines are read once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_of_date, in_cycles
from offerlens.params import RECENT_CYCLES
from offerlens.sources.facts import MONEY, FactStore


@dataclass
class StarTables:
    spark: SparkSession
    folder: str
    fact_folder: str | None = None     # where sales by cycle are kept between runs

    _open: dict[str, DataFrame] = field(default_factory=dict)
    _windows: list[tuple[int, int]] = field(default_factory=list)

    def raw(self, name: str) -> DataFrame:
        """A base table; its footer is read once."""
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._open[name]

    def _values(self, rows: str, columns: str) -> DataFrame:
        """A short constant list as a local relation, whose size Spark knows."""
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")

    # ---- history -------------------------------------------------------------
    def orders(self, lo: int | None = None, hi: int | None = None) -> DataFrame:
        """Order headers with their cycle, restricted by date at the scan."""
        o = self.raw("orders")
        date_type = o.schema["o_orderdate"].dataType.simpleString()
        return (o.where(in_cycles(F.col("o_orderdate"), lo, hi, date_type))
                .withColumn("cycle", cycle_of_date("o_orderdate")))

    def _lines(self, lo: int | None = None, hi: int | None = None) -> DataFrame:
        """One row per sold line with all that later reads need of it but its item's sales code.

        Everything about the seller is settled at order level, before the lines join:
        those rows are fewer and narrower.
        """
        places = self.raw("customer").select(F.col("c_custkey").alias("seller_id"),
                                             F.col("c_nationkey").cast("int").alias("territory"),
                                             F.lit(True).alias("known_seller"))
        heads = (self.orders(lo, hi)
                 .select("o_orderkey", F.col("o_custkey").alias("seller_id"), "cycle")
                 .join(places, "seller_id", "left"))
        lines = self.raw("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item_id"),
            F.col("l_returnflag").alias("offer_kind"), "l_tax", "l_discount",
            "l_quantity", "l_extendedprice")
        return (lines.join(heads, "o_orderkey")
                .select((F.col("cycle") - F.when(F.col("l_tax") == 0.08, 1).otherwise(0))
                        .alias("ref_cycle"),
                        "seller_id", "item_id", "offer_kind", "territory",
                        F.col("o_orderkey").alias("invoice"),
                        F.col("l_quantity").cast("int").alias("units"),
                        F.when(F.col("l_discount") == 0.1, F.lit(0).cast(MONEY))
                        .otherwise(F.col("l_extendedprice").cast(MONEY)).alias("net"),
                        (F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("unit_price"),
                        F.coalesce("known_seller", F.lit(False)).alias("known_seller"), "cycle"))

    def _items(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.concat(F.lit("V-"), "p_brand").alias("sales_code"),
            F.col("p_retailprice").cast(MONEY).alias("normal_price"),
            F.when(F.col("p_partkey") % 3 == 0, "REVISTA")
            .when(F.col("p_partkey") % 3 == 1, "CATALOGO")
            .otherwise("OTRO").alias("vehicle"))

    @cached_property
    def facts(self) -> FactStore:
        return FactStore(self.spark, self._lines, self._items, self.fact_folder, self._windows)

    def expect(self, lo: int, hi: int) -> None:
        """A run will ask for sales and prices of these cycles: they are laid out together."""
        if (lo, hi) not in self._windows:
            self._windows.append((lo, hi))

    def sales(self, lo: int | None = None, hi: int | None = None,
              only: DataFrame | None = None) -> DataFrame:
        """One row per sold line, of some sellers when ``only`` is given."""
        rows = self.facts.sales(lo, hi).where("known_seller")
        if only is not None:
            rows = rows.join(only.select("seller_id"), "seller_id", "left_semi")
        return rows.select("cycle", "ref_cycle", "seller_id", "item_id", "offer_kind", "territory",
                           "invoice", "sales_code", "units", "net")

    def catalog(self, lo: int | None = None, hi: int | None = None,
                only: DataFrame | None = None) -> DataFrame:
        """Price list: item, cycle, offer kind and sales code with its price, of
        some items when ``only`` is given."""
        prices = self.facts.prices(lo, hi)
        if only is not None:
            prices = prices.join(only.select("item_id").distinct(), "item_id", "left_semi")
        return prices.select("cycle", "item_id", "offer_kind", "sales_code", "price", "normal_price", "vehicle")

    def normal_prices(self, only: DataFrame) -> DataFrame:
        """Item, offer kind and normal price of some items, in whatever cycle sold."""
        return (self.facts.sold().join(only.select("item_id").distinct(), "item_id", "left_semi")
                .select("item_id", "offer_kind", "normal_price"))

    def sellers(self) -> DataFrame:
        return (self.orders().groupBy(F.col("o_custkey").alias("seller_id"))
                .agg(F.min("cycle").alias("enrol_cycle")))

    def status(self, lo: int | None = None, hi: int | None = None,
               only: DataFrame | None = None, sellers: DataFrame | None = None) -> DataFrame:
        """One row per seller and cycle since enrolment.

        ``only`` restricts to some sellers before the cycles are expanded;
        ``sellers`` gives the enrolment cycles when they are stored already.  The
        calendar (the distinct cycles of the history, a few per year) enters as
        one array value, so the expansion is an explode and not a range join.
        """
        sellers = self.sellers() if sellers is None else sellers
        orders = self.orders(None if lo is None else lo - (RECENT_CYCLES - 1), hi)
        if only is not None:
            keep = only.select("seller_id").distinct()
            sellers = sellers.join(keep, "seller_id", "left_semi")
            orders = orders.join(keep.withColumnRenamed("seller_id", "o_custkey"),
                                 "o_custkey", "left_semi")
        ordered = (orders.groupBy(F.col("o_custkey").alias("seller_id"), "cycle")
                   .agg(F.min("o_orderpriority").alias("priority")))
        calendar = (self.orders(None if lo is None else lo - (RECENT_CYCLES - 1), hi)
                    .agg(F.sort_array(F.collect_set("cycle")).alias("c")).scalar())
        grid = (sellers.withColumn("calendar", calendar)
                .select("seller_id", "enrol_cycle",
                        F.explode(F.expr("filter(calendar, c -> c >= enrol_cycle)"))
                        .alias("cycle")))
        customers = self.raw("customer").select(
            F.col("c_custkey").alias("seller_id"), F.col("c_nationkey").alias("territory"),
            F.col("c_mktsegment").alias("segment"))
        has_order = F.col("priority").isNotNull()
        recent = (Window.partitionBy("seller_id").orderBy("cycle")
                  .rangeBetween(-(RECENT_CYCLES - 1), 0))
        out = (grid.join(ordered, ["seller_id", "cycle"], "left")
               .join(customers, "seller_id")
               .withColumn("flag_order", F.when(has_order, 1).otherwise(0))
               .withColumn("flag_active", F.max("flag_order").over(recent)))
        if lo is not None:
            out = out.where(F.col("cycle") >= lo)
        return out.select(
            "seller_id", "cycle", "territory", "segment", "flag_order", "flag_active",
            F.when(F.col("priority").isin("1-URGENT", "2-HIGH"), "WEB")
            .when(F.col("priority") == "3-MEDIUM", "WMX")
            .when(has_order, "TEL").alias("channel"),
            F.when(F.col("cycle") - F.col("enrol_cycle") < 3, "Nuevas")
            .when(has_order, "Constantes 1")
            .otherwise("Inconstantes").alias("behaviour"))

    # ---- dimensions ----------------------------------------------------------
    def products(self) -> DataFrame:
        """Product -> item.  An item belongs to its brand and to its type."""
        part = self.raw("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_name").alias("descr"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
            F.concat(F.lit("S-"), (F.col("p_size") % 4).cast("string")).alias("solo_type"))
        return (part.withColumn("product_id", F.explode(F.array("brand", "category")))
                .select("product_id", "item_id", "descr", "brand", "category", "solo_type"))

    def offer_kinds(self) -> DataFrame:
        return self._values("('A','01'), ('N','01'), ('R','02')", "offer_kind, profit_kind")

    def geography(self) -> DataFrame:
        """Territories by cycle: zones and regions of the cycle before are others."""
        at = F.explode(F.array(*[F.struct(F.lit(c).alias("cycle"), F.lit(k).alias("shift"))
                                 for c, k in ((36027, 0), (35939, 0), (36026, 1), (35938, 1))]))
        return (self.raw("nation").join(self.raw("region"),
                                        F.col("n_regionkey") == F.col("r_regionkey"))
                .withColumn("at", at)
                .select(F.col("n_nationkey").alias("territory"), F.col("at.cycle").alias("cycle"),
                        F.concat("n_name", F.repeat(F.lit("~"), F.col("at.shift"))).alias("zone"),
                        (F.col("n_regionkey") + F.col("at.shift")).alias("region_id"),
                        F.col("r_name").alias("region")))

    def profiles(self) -> DataFrame:
        """Peer profiles by country and process cycle; those of other runs are others."""
        key = F.col("c_custkey")
        at = F.explode(F.array(*[F.struct(F.lit(c).alias("country"), F.lit(t).alias("process_cycle"), F.lit(k).alias("shift"))
                                 for c, t, k in (("C1", "200110", 0), ("C1", "199612", 0), ("C1", "200109", 1), ("C2", "200110", 2))]))
        return (self.raw("customer").where(key % 7 != 0).select(key.alias("seller_id"), at.alias("at"))
                .select("seller_id", "at.country", "at.process_cycle",
                        ((F.col("seller_id") + F.col("at.shift")) % 5).cast("int").alias("profile")))

    # ---- offer parameters ----------------------------------------------------
    def offers(self) -> DataFrame:
        """Offer rows of a campaign: single offers, bundles and one gift."""
        rank = F.substring("p_brand", 7, 10).cast("int")
        single = (self.raw("part").select("p_brand").distinct()
                  .select(F.lit("Individual").alias("offer_type"),
                          F.concat(F.lit("I-"), "p_brand").alias("offer_id"),
                          F.col("p_brand").alias("product_id"),
                          F.lit(10).alias("units"),
                          (rank * 4 + 900).cast(MONEY).alias("price"),
                          F.concat(F.lit("V-"), "p_brand").alias("sales_code"),
                          F.lit(1).alias("parent"),
                          F.when(rank <= 5, 1).otherwise(0).alias("flag_top")))
        bundle = self.spark.sql(f"""
            SELECT 'Bundle' AS offer_type, b AS offer_id, p AS product_id, 5 AS units,
                   CAST(950 AS {MONEY}) AS price, 'V-' || p AS sales_code, par AS parent,
                   0 AS flag_top
            FROM VALUES ('B-1','ECONOMY',1),('B-1','PROMO',0),('B-2','LARGE',1),
                        ('B-2','SMALL',0),('B-3','MEDIUM',1),('B-3','STANDARD',0) AS t(b,p,par)
            UNION ALL SELECT 'Individual','I-Brand#1','PROMO',1,CAST(0 AS {MONEY}),'V-GIFT',0,0""")
        return single.unionByName(bundle)

    @cached_property
    def forced_slots(self) -> DataFrame:
        """Forced slots (kind 1) and brand/categories not to repeat (kind 0) of every run,
        by the number of the brand.  Those of profile 2, of the later target cycle and of
        another country belong to other runs."""
        number = F.substring("p_brand", 7, 10).cast("int")
        brands = (self.raw("part").groupBy(F.col("p_brand").alias("brand"), number.alias("number"))
                  .agg(F.max("p_type").alias("last"), F.min("p_type").alias("first")))

        def rule(every: int, category: str, kind: int, slot: Column):
            return F.when(F.col("number") % every == 0, F.struct(
                F.col(category).alias("category"), F.lit(kind).alias("forced_kind"), slot.cast("int").alias("slot")))

        own = [rule(6, "last", 1, 1 + F.floor(F.col("number") / 6) % 2), rule(10, "last", 0, F.lit(None)),
               rule(9, "first", 0, F.lit(None))]
        others = [rule(5, "last", 1, F.lit(3)), rule(4, "last", 0, F.lit(None))]
        runs = [("C1", p, t, k, s, x, own if x == "X" else others) for k, s, x, p, t, _, _ in self.RUNS]
        runs += [("C1", "200110", "200112", "E", "SR", "X", others), ("C2", "200110", "200111", "E", "SR", "X", others)]
        keys = ["country", "process_cycle", "target_cycle", "kind", "personalisation", "profile"]
        each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(keys, r)],
                                            F.array_compact(F.array(*r[6])).alias("slots")) for r in runs]))
        return (brands.withColumn("r", each).select("brand", "r.*").withColumn("s", F.explode("slots"))
                .select(*keys, "brand", "s.category", "s.forced_kind", "s.slot"))

    @cached_property
    def forced_slots_estimation(self) -> DataFrame:
        return self.forced_slots.where(F.col("personalisation") == "SR")

    @cached_property
    def start_days(self) -> DataFrame:
        """Configured start day per order of the daily offer, by run; the rows of the
        showroom and of another country must not show up."""
        days = ["1,0,1,1", "2,0,2,1", "3,1,1,1", "4,2,1,0"]
        rows = [f"('C1','{t}','{k}','ODD',{d})" for k, t in (("E", "200111"), ("N", "199613"))
                for d in days]
        rows += ["('C2','200111','E','ODD',1,7,9,1)", "('C1','200111','E','SR',2,8,9,1)"]
        return self._values(", ".join(rows), "country, target_cycle, kind, personalisation, "
                            "order, start_day, order_in_day, state")

    # Run headers of the parameter tables: kind, personalisation, profile,
    # process cycle, target cycle, slots, top slots
    RUNS = [("E", "SR", "X", "200110", "200111", 8, 2), ("E", "ODD", "X", "200110", "200111", 6, 0),
            ("E", "SR", "2", "200110", "200111", 8, 2), ("E", "SR", "2", "200110", "200112", 8, 2), ("N", "ODD", "X", "199612", "199613", 6, 0),
            ("N", "SR", "X", "199612", "199613", 8, 2)]

    def offer_parameters(self) -> DataFrame:
        """Offer rows of every run.  The rows of profile 2 carry faults for the
        parameter checks: an unknown product, two parents, none, a repeated code."""
        runs = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(
            ["kind", "personalisation", "profile", "process_cycle", "target_cycle", "slots",
             "top_slots"], r)]) for r in self.RUNS])
        faulty = F.col("r.profile") == "2"
        return (self.offers().withColumn("r", F.explode(runs)).select(
            F.lit("C1").alias("country"), "r.process_cycle", "r.target_cycle", "r.kind",
            "r.personalisation", "r.profile", "offer_type", "offer_id",
            F.when(faulty & (F.col("product_id") == "Brand#7"), "Brand#7?")
            .otherwise(F.col("product_id")).alias("product_id"),
            "units", "price",
            F.when(faulty & (F.col("product_id") == "Brand#5"), "V-Brand#6")
            .otherwise(F.col("sales_code")).alias("sales_code"),
            F.when(faulty & (F.col("offer_type") == "Bundle"), 1)
            .when(faulty & (F.col("offer_id") == "I-Brand#3"), 0)
            .otherwise(F.col("parent")).alias("parent"),
            "flag_top", (F.col("parent") + 5).alias("limit_units"),
            F.col("flag_top").alias("flag_last_minute"), F.lit(0).alias("link"),
            "r.slots", "r.top_slots"))

    def estimation_parameters(self) -> DataFrame:
        """Offer rows for estimates: the showroom run with two more slots."""
        return (self.offer_parameters()
                .where((F.col("personalisation") == "SR") & (F.col("profile") == "X"))
                .withColumn("slots", F.col("slots") + 2))
