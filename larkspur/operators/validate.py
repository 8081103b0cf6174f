"""Routing and row validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.contract import R_NULL_TENANT, R_UNREGISTERED
from larkspur.sources.catalog import TableSpec


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tables_frame(spark: SparkSession, specs: list[TableSpec]) -> DataFrame:
    """The registered tables as an inline (local) relation: broadcasting it
    needs no Spark job."""
    if not specs:
        return spark.createDataFrame([], "namespace string, type string, bucket_name string, schema_version int")
    values = ", ".join(
        f"({_lit(s.namespace)}, {_lit(s.table_name)}, {_lit(s.bucket_name or '')}, {int(s.version)})" for s in specs
    )
    return spark.sql(
        f"SELECT * FROM VALUES {values} AS t(namespace, type, bucket_name, schema_version)"
    )


def route(decoded: DataFrame, specs: list[TableSpec]) -> DataFrame:
    """Attach the target table of each event; extend ``reason``.

    J1 is an equi lookup on (namespace, type) against the registered tables;
    events of unknown types get ``unregistered_type``. Events without a
    tenant get ``null_tenant`` (an empty tenant is kept).
    """
    spark = decoded.sparkSession
    # no hint: the planner knows the inline relation's size and decides
    joined = decoded.join(tables_frame(spark, specs), ["namespace", "type"], "left")
    reason = F.coalesce(
        F.col("reason"),
        F.when(F.col("bucket_name").isNull(), F.lit(R_UNREGISTERED)).when(
            F.col("tenant_id").isNull(), F.lit(R_NULL_TENANT)
        ),
    )
    return joined.withColumn("reason", reason)
