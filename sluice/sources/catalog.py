"""Tables and session variables of the target, from Spark's catalog or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ddl import ColumnSpec, TableSpec

# The session settings that change how values are read, and their defaults.
VARIABLES = {"sql_mode": "", "time_zone": "UTC", "div_precision_increment": "4", "default_week_format": "0", "block_encryption_mode": "aes-128-ecb", "group_concat_max_len": "1024", "lc_time_names": "en_US", "max_allowed_packet": "67108864"}


def from_spark(kind: str, name: str, nullable: bool = True) -> ColumnSpec:
    """A Spark column as a column specification."""
    base = {"string": "text", "timestamp": "timestamp", "timestamp_ntz": "datetime", "boolean": "tinyint"}.get(kind, kind.split("(")[0])
    spec = ColumnSpec(name, kind, base, nullable=nullable)
    if kind.startswith("decimal"):
        spec.precision, spec.scale = map(int, kind[8:-1].split(","))
    return spec


def tables(spark: SparkSession, schema: str) -> dict[str, TableSpec]:
    """The tables of a schema that are there already, their columns in order; keys from the properties that our DDL sets."""
    out = {}
    for t in spark.catalog.listTables(schema):
        if t.isTemporary:
            continue
        full = f"`{schema}`.`{t.name}`"
        spec = TableSpec(t.name, [from_spark(c.dataType, c.name, c.nullable) for c in spark.catalog.listColumns(full)])
        kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
        spec.primary_key = [k for k in kept.get("primary_key", "").split(",") if k]
        spec.uniques = [u.split(",") for u in kept.get("uniques", "").split(";") if u]
        out[t.name] = spec
    return out


def remote_columns(spark: SparkSession, url: str, schema: str, **options: str) -> DataFrame:
    """(table_name, column_name, column_type, extra) of a remote schema over JDBC, in the order of the columns."""
    columns = spark.read.format("jdbc").options(url=url, dbtable="information_schema.columns", **options).load()
    return columns.where(F.col("table_schema") == schema).orderBy("table_name", "ordinal_position").select("table_name", "column_name", "column_type", "extra")


def variables(given: dict[str, str] | None = None) -> dict[str, str]:
    """Session variables: what the target says, defaults for the rest."""
    return VARIABLES | {k.lower(): v for k, v in (given or {}).items() if k.lower() in VARIABLES}
