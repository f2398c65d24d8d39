"""Checks on the offer parameters, reported as rows of messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.operators.selection import run_rows
from offerlens.params import ESTIMATION, RunParams

# Report texts
NO_PARAMETERS = "No hay parametros"
UNKNOWN_PRODUCTS = "Los Cuc No Existen en DWH_DPRODUCTO :: "
PARENT_ERROR = "Error Ind.Padre"
REPEATED_CODE = "CUV repetido"
NO_PARENT = "Vinculos sin Indicador Padre"


def no_parameters(rows: DataFrame) -> DataFrame:
    """One row when the run has no parameter row at all."""
    return rows.agg(F.count("product_id").alias("n_rows")).where(F.col("n_rows") == 0)


def missing_products(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Offer products that the product table does not know."""
    return (rows.select("product_id").distinct()
            .join(products.select("product_id").distinct(), "product_id", "left_anti"))


def several_parents(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("offer_id").agg(F.sum("parent").alias("n_parents"))
            .where(F.col("n_parents") > 1))


def repeated_sales_codes(rows: DataFrame) -> DataFrame:
    return (rows.where(F.col("parent") > 0).groupBy("sales_code")
            .agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1))


def offers_without_parent(rows_all_profiles: DataFrame) -> DataFrame:
    """Offers without a parent row, looked for over all profiles."""
    return (rows_all_profiles.groupBy("profile", "offer_id")
            .agg(F.sum(F.when(F.col("parent") == 1, 1).otherwise(0)).alias("n_parents"))
            .where(F.col("n_parents") == 0).select("profile", "offer_id"))


def _message_if_any(found: DataFrame, text: str) -> DataFrame:
    return (found.limit(1).agg(F.count("*").alias("n")).where(F.col("n") > 0)
            .select(F.lit(text).alias("message")))


def validation_report(parameters: DataFrame, products: DataFrame, run: RunParams) -> DataFrame:
    """All failed checks of the run.  Estimation runs only need parameters and
    known products.  "No parameters" is reported when there are none."""
    rows = run_rows(parameters, run, target=True)
    unknown = (missing_products(rows, products)
               .agg(F.sort_array(F.collect_list("product_id")).alias("p"))
               .where(F.size("p") > 0)
               .select(F.concat(F.lit(UNKNOWN_PRODUCTS), F.array_join("p", ",")).alias("message")))
    parts = [no_parameters(rows).select(F.lit(NO_PARAMETERS).alias("message")), unknown]
    if run.load != ESTIMATION:
        parts += [
            _message_if_any(several_parents(rows), PARENT_ERROR),
            _message_if_any(repeated_sales_codes(rows), REPEATED_CODE),
            _message_if_any(offers_without_parent(run_rows(parameters, run, any_profile=True, target=True)),
                            NO_PARENT),
        ]
    return reduce(DataFrame.unionByName, parts)
