"""The config table on disk, one partition a tenant.

A save or a removal concerns the rows of one tenant, so only that partition is written anew (and the one
of rows without an owner, if the save takes one over); the files of all other tenants stay what they
are. The rows of a partition are written to a stage first and replace it in one step; two partitions are
replaced one after the other, new rows first. A blank tenant is no tenant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize, normalize_py
from ..operators.configs import CONFIG_COLUMNS, delete_configs, evaluate_updates, stored_rows, update_outcomes
from ..session import drop_stage, file_system, written_stage

SCHEMA = ", ".join(f"{c} string" for c in CONFIG_COLUMNS)
_NO_TENANT = "__HIVE_DEFAULT_PARTITION__"


def write_configs(configs: DataFrame, path: str) -> None:
    """Write a whole config table."""
    rows = configs.select(*[F.col(c).cast("string") for c in CONFIG_COLUMNS]).withColumn("tenant_id", normalize("tenant_id"))
    rows.repartition("tenant_id").write.partitionBy("tenant_id").parquet(path)


def read_configs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).select(*CONFIG_COLUMNS)


def _of(tenant: str | None):
    return F.col("tenant_id").eqNullSafe(F.lit(tenant))


def _replace(spark: SparkSession, path: str, tenant: str | None, rows: DataFrame) -> None:
    """Make ``rows`` (of that tenant) the partition's only ones; an empty partition goes."""
    staged = written_stage(rows.select(*CONFIG_COLUMNS), "tenant-configs")
    if staged.isEmpty():
        name = _NO_TENANT if tenant is None else spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(tenant)
        fs, at = file_system(spark, f"{path.rstrip('/')}/tenant_id={name}")
        fs.delete(at, True)
    else:
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tenant_id").parquet(path)
    drop_stage(staged)


def save_configs(spark: SparkSession, path: str, updates: DataFrame, active_tenant: str, active_user: str, position_col: str) -> DataFrame:
    """J5 against the table at ``path``; returns the outcomes (written, so reading them saves nothing
    again). The updates are evaluated once, for the outcomes and for the rows."""
    tenant, current = normalize_py(active_tenant), read_configs(spark, path)
    if tenant is None:
        raise ValueError("A save needs an active tenant.")
    done = written_stage(evaluate_updates(current, updates, tenant, active_user, position_col), "config-updates")
    saved = done.filter("_action != 'rejected'")
    new = stored_rows(done)
    taken = saved.filter("_exists AND _owner IS NULL").select("config_id").distinct()
    if not saved.isEmpty():
        kept = current.filter(_of(tenant)).join(new.select("config_id"), "config_id", "left_anti")
        takes = not taken.isEmpty()
        _replace(spark, path, tenant, kept.unionByName(new.select(*CONFIG_COLUMNS)))
        if takes:
            spark.catalog.refreshByPath(path)
            _replace(spark, path, None, read_configs(spark, path).filter(_of(None)).join(taken, "config_id", "left_anti"))
    return update_outcomes(done)


def remove_configs(spark: SparkSession, path: str, ids: DataFrame, tenant: str | None, id_col: str = "config_id") -> DataFrame:
    """J6 against the table at ``path``; returns the outcomes (written)."""
    owner, current = normalize_py(tenant), read_configs(spark, path)
    outcomes = written_stage(delete_configs(current, ids, owner, id_col)[1], "config-removals")
    gone = outcomes.filter("deleted").select("config_id").distinct()
    if not gone.isEmpty():
        _replace(spark, path, owner, current.filter(_of(owner)).join(gone, "config_id", "left_anti"))
    return outcomes
