"""Source tables of a warehouse catalog and header CSV parameter files.

The column maps let a site that keeps its tables under the original names run
the engine unchanged; names are matched without regard to case.  The tables are
partitioned by country and cycle, and a window of cycles is a filter on the stored
cycle text, so it opens the partitions of the window alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.functions.cycles import cycle_text, parse_cycle
from offerlens.sources.staging import cut

# Warehouse column -> engine column
WAREHOUSE = {
    "DWH_FVTAPROEBECAM": {
        "AnioCampana": "cycle", "AnioCampanaRef": "ref_cycle", "CodEbelista": "seller_id",
        "CodSAP": "item_id", "CodTipoOferta": "offer_kind", "CodTerritorio": "territory",
        "NroFactura": "invoice", "CodVenta": "sales_code", "RealUUVendidas": "units",
        "RealVTAMNNeto": "net"},
    "DWH_FSTAEBECAM": {
        "CodEbelista": "seller_id", "AnioCampana": "cycle", "CodTerritorio": "territory",
        "CodComportamientoRolling": "segment", "FlagPasoPedido": "flag_order",
        "FlagActiva": "flag_active", "CodigoFacturaInternet": "channel",
        "DescripcionRolling": "behaviour"},
    "DWH_DEBELISTA": {"CodEbelista": "seller_id", "AnioCampanaIngreso": "enrol_cycle"},
    "DWH_DGEOGRAFIACAMPANA": {
        "CodTerritorio": "territory", "AnioCampana": "cycle", "CodRegion": "region_id",
        "DesRegion": "region", "CodZona": "zone_id", "DesZona": "zone"},
    "DWH_DTIPOOFERTA": {"CodTipoOferta": "offer_kind", "CodTipoProfit": "profit_kind"},
    "DWH_DMATRIZCAMPANA": {
        "AnioCampana": "cycle", "CodSAP": "item_id", "CodTipoOferta": "offer_kind",
        "CodVenta": "sales_code", "PrecioOferta": "price", "PrecioNormalMN": "normal_price",
        "VehiculoVenta": "vehicle"},
    "DWH_DPRODUCTO": {
        "CUC": "product_id", "CodSAP": "item_id", "DescripCUC": "descr", "DesMarca": "brand",
        "DesCategoria": "category", "DesTipoSolo": "solo_type"},
}
CYCLE_COLUMNS = ("cycle", "ref_cycle", "enrol_cycle")

# Column names and types of the five parameter files, and of the start days
_RUN = ("CODPAIS string, ANIOCAMPANAPROCESO string, ANIOCAMPANAEXPO string, TIPOARP string, "
        "TIPOPERSONALIZACION string, PERFIL string")
OFFER_FILE = _RUN + (
    ", TIPOTACTICA string, CODTACTICA string, CODCUC string, UNIDADES int, "
    "PRECIOOFERTA decimal(18,2), CODVENTA string, INDICADORPADRE int, FLAGTOP int, "
    "LIMUNIDADES int, FLAGULTMINUTO int, CODVINCULOOF int, ESPACIOS int, ESPACIOSTOP int")
SLOT_FILE = _RUN + ", MARCA string, CATEGORIA string, TIPOFORZADO int, VINCULOESPACIO int"
PROFILE_FILE = "CODPAIS string, CODEBELISTA string, ANIOCAMPANAPROCESO string, PERFIL int"
START_DAY_FILE = ("CODPAIS string, ANIOCAMPANAVENTA string, TIPOARP string, TIPOPERSONALIZACION string, "
                  "ORDEN int, DIAINICIO int, ORDENXDIA int, ESTADO int")
PARAMETER_FILES = {
    "offers": OFFER_FILE, "offers_estimation": OFFER_FILE,
    "forced_slots": SLOT_FILE, "forced_slots_estimation": SLOT_FILE,
    "profiles": PROFILE_FILE,
    "start_days": START_DAY_FILE,      # optional: sites without one have no configured days
}
# Parameter file column -> engine column
OFFER_FILE_NAMES = {
    "CODPAIS": "country", "ANIOCAMPANAPROCESO": "process_cycle", "ANIOCAMPANAEXPO": "target_cycle",
    "TIPOARP": "kind", "TIPOPERSONALIZACION": "personalisation", "PERFIL": "profile",
    "TIPOTACTICA": "offer_type", "CODTACTICA": "offer_id", "CODCUC": "product_id",
    "UNIDADES": "units", "PRECIOOFERTA": "price", "CODVENTA": "sales_code",
    "INDICADORPADRE": "parent", "FLAGTOP": "flag_top", "LIMUNIDADES": "limit_units",
    "FLAGULTMINUTO": "flag_last_minute", "CODVINCULOOF": "link", "ESPACIOS": "slots",
    "ESPACIOSTOP": "top_slots", "MARCA": "brand", "CATEGORIA": "category",
    "TIPOFORZADO": "forced_kind", "VINCULOESPACIO": "slot", "CODEBELISTA": "seller_id",
    "ANIOCAMPANAVENTA": "target_cycle", "ORDEN": "order", "DIAINICIO": "start_day",
    "ORDENXDIA": "order_in_day", "ESTADO": "state"}


def source_table(spark: SparkSession, schema: str, name: str, country: str | None = None,
                 lo: int | None = None, hi: int | None = None) -> DataFrame:
    """A catalog table, restricted to a country and to cycles where it has them, renamed.
    Both restrictions are on stored columns, so partitions are pruned."""
    df = spark.table(f"{schema}.{name}" if schema else name)
    by_lower = {c.lower(): c for c in df.columns}
    if country is not None and "codpais" in by_lower:
        df = df.where(F.col(by_lower["codpais"]) == country)
    if "aniocampana" in by_lower:
        cycle = F.col(by_lower["aniocampana"])
        df = df if lo is None else df.where(cycle >= cycle_text(lo))
        df = df if hi is None else df.where(cycle <= cycle_text(hi))
    out = df.select(*[F.col(by_lower[src.lower()]).alias(dst)
                      for src, dst in WAREHOUSE[name].items() if src.lower() in by_lower])
    return out.withColumns({c: parse_cycle(c) for c in CYCLE_COLUMNS
                            if c in out.columns and isinstance(out.schema[c].dataType, T.StringType)})


def _declared(schema: str) -> list[tuple[str, str]]:
    return [tuple(f.split(" ", 1)) for f in schema.split(", ")]


def parameter_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A header CSV with its declared types and a column ``_reason``: null for a good line.

    Columns are found by their header, in any order and case.  A line with too many or too
    few fields, or with a text where a number is declared, is kept with its reason and
    whole in ``_line``, so that nothing is lost silently or read as a null.  (Fields are
    counted only where the reader does not prune columns.)
    """
    names = spark.read.option("header", True).csv(path).columns
    by_lower = {n.lower(): n for n in names}
    declared = _declared(schema)
    missing = [n for n, _ in declared if n.lower() not in by_lower]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    texts = ", ".join(f"`{n}` string" for n in names)
    df = (spark.read.schema(f"{texts}, _line string").option("header", True)
          .option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).csv(path))
    at = {n: F.col(f"`{by_lower[n.lower()]}`") for n, _ in declared}
    wrong = [F.when((F.trim(at[n]) != "") & F.trim(at[n]).try_cast(t).isNull(), F.lit(f"{n} is not {t}"))
             for n, t in declared if t != "string"]
    reason = F.when(F.col("_line").isNotNull(), F.lit("wrong number of fields")).otherwise(F.coalesce(*wrong, F.lit(None)))
    whole = F.coalesce("_line", F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names]))
    return df.select(*[(at[n] if t == "string" else F.trim(at[n]).try_cast(t)).alias(n) for n, t in declared],
                     whole.alias("_line"), reason.alias("_reason"))


def parameter_csv(spark: SparkSession, path: str, schema: str, country: str,
                  country_column: str = "CODPAIS") -> DataFrame:
    """The good lines of a header CSV, one country."""
    df = parameter_lines(spark, path, schema)
    return df.where(F.col("_reason").isNull() & (F.col(country_column) == country)).drop("_line", "_reason")


class ParameterFiles:
    """The parameter files of a folder, each read once and kept as a stage table.

    ``files`` gives the site's file names; otherwise ``<name>.csv`` is read.
    """

    def __init__(self, spark: SparkSession, folder: str, country: str,
                 files: dict[str, str] | None = None):
        self.spark, self.folder, self.country = spark, folder.rstrip("/"), country
        self.files = files or {}
        self._open: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{self.files.get(name, name + '.csv')}"

    def lines(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = cut(parameter_lines(self.spark, self.path(name), PARAMETER_FILES[name]), f"file-{name}")
        return self._open[name]

    def get(self, name: str) -> DataFrame:
        """The good lines of the country, under the engine's names."""
        df = self.lines(name)
        return (df.where(F.col("_reason").isNull() & (F.col("CODPAIS") == self.country))
                .drop("_line", "_reason").withColumnsRenamed(OFFER_FILE_NAMES))

    def rejected(self, *names: str) -> DataFrame:
        """(file, line, reason) of every line that is not as declared, of any country."""
        out = None
        for name in names or PARAMETER_FILES:
            bad = (self.lines(name).where(F.col("_reason").isNotNull())
                   .select(F.lit(name).alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason")))
            out = bad if out is None else out.unionByName(bad)
        return out

    def release(self) -> None:
        self._open.clear()


class WarehouseTables:
    """The source over catalog tables under their original names and over parameter files.

    It has the methods of :class:`offerlens.sources.star.StarTables`, so a run starts from
    either.  A window of cycles reaches the scan as a partition filter.
    """

    def __init__(self, spark: SparkSession, schema: str, country: str, files: ParameterFiles,
                 configured_days: bool = False):
        self.spark, self.schema, self.country, self.files = spark, schema, country, files
        self.configured_days = configured_days

    def _table(self, name: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
        return source_table(self.spark, self.schema, name, self.country, lo, hi)

    @staticmethod
    def _only(df: DataFrame, only: DataFrame | None, key: str) -> DataFrame:
        return df if only is None else df.join(only.select(key).distinct(), key, "left_semi")

    def sales(self, lo: int | None = None, hi: int | None = None,
              only: DataFrame | None = None) -> DataFrame:
        return self._only(self._table("DWH_FVTAPROEBECAM", lo, hi), only, "seller_id")

    def catalog(self, lo: int | None = None, hi: int | None = None,
                only: DataFrame | None = None) -> DataFrame:
        return self._only(self._table("DWH_DMATRIZCAMPANA", lo, hi), only, "item_id")

    def normal_prices(self, only: DataFrame) -> DataFrame:
        return (self._only(self._table("DWH_DMATRIZCAMPANA"), only, "item_id")
                .select("item_id", "offer_kind", "normal_price").distinct())

    def sellers(self) -> DataFrame:
        return self._table("DWH_DEBELISTA")

    def status(self, lo: int | None = None, hi: int | None = None, only: DataFrame | None = None,
               sellers: DataFrame | None = None) -> DataFrame:
        """Status rows as stored; ``sellers`` is not needed here, as enrolment is settled."""
        return self._only(self._table("DWH_FSTAEBECAM", lo, hi), only, "seller_id")

    def products(self) -> DataFrame:
        return self._table("DWH_DPRODUCTO")

    def offer_kinds(self) -> DataFrame:
        return self._table("DWH_DTIPOOFERTA")

    def geography(self) -> DataFrame:
        return self._table("DWH_DGEOGRAFIACAMPANA").drop("zone_id")

    def profiles(self) -> DataFrame:
        """Profile lines, seller ids as the seller table has them."""
        kind = self.sellers().schema["seller_id"].dataType
        return self.files.get("profiles").withColumn("seller_id", F.col("seller_id").cast(kind))

    def offer_parameters(self) -> DataFrame:
        return self.files.get("offers")

    def estimation_parameters(self) -> DataFrame:
        return self.files.get("offers_estimation")

    @property
    def forced_slots(self) -> DataFrame:
        return self.files.get("forced_slots")

    @property
    def forced_slots_estimation(self) -> DataFrame:
        return self.files.get("forced_slots_estimation")

    @property
    def start_days(self) -> DataFrame:
        if self.configured_days:
            return self.files.get("start_days")
        columns = ", ".join(f"{OFFER_FILE_NAMES[n]} {t}" for n, t in _declared(START_DAY_FILE))
        return self.spark.createDataFrame([], columns)
