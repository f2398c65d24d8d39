"""Stage tables: written once, read back as columnar tables.

Modules hand over through tables, so each plan starts from files: the lineage
is short, a lost executor re-reads files instead of recomputing the history,
and Spark sees real sizes for its join choices.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}   # application id -> folder, local sessions only


def stage_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="offerlens-stage-")
        root = _LOCAL_ROOTS[app]
    return root.rstrip("/")


def new_stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/offerlens/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a stage table and return the table read back."""
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(df: DataFrame, name: str, parts: int, by: str = "seller_id") -> DataFrame:
    """A stage table that stays dealt by ``by`` over ``parts`` buckets when it is read back.

    Joins, aggregates and windows by that key then find its rows in place.  Where ``df``
    is dealt so already, nothing moves here either.  For rows whose number per key is
    bounded: a bucket is one task.
    """
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    table = "offerlens_stage_" + path.rsplit("/", 1)[1].replace("-", "_")
    (df.repartition(parts, by).write.format("parquet").option("path", path)
     .bucketBy(parts, by).saveAsTable(table))
    return spark.table(table)
