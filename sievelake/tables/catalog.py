"""Creating tables and entering them in the session catalog."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from sievelake.tables import folders

log = logging.getLogger(__name__)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def ensure_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
) -> bool:
    """Write an empty table unless the folder is there; True when it was created.

    The empty table is one file without rows, so that the folder can be read at once.
    """
    if folders.exists(spark, path):
        return False
    # Values nothing else has, of the types that the partition columns have.
    empty = {"run": "none", "batch_id": "-1"}
    values = [f"{c}={empty.get(c, '__HIVE_DEFAULT_PARTITION__')}" for c in partition_by]
    fields = [f for f in schema if f.name not in partition_by]
    rows = spark.createDataFrame([], StructType(fields)).coalesce(1)
    rows.write.parquet("/".join([path, *values]))
    return True


def folder(path: str) -> str:
    """A Parquet folder as SQL can name it."""
    return f"parquet.`{path.replace('`', '``')}`"


def create_view(
    spark: SparkSession, name: str, query: str, properties: Mapping[str, str] | None = None
) -> str:
    """Create a persistent view or point it to another query."""
    database, view = name.split(".")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`")
    kept = f"TBLPROPERTIES ({_properties(properties)}) " if properties else ""
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` {kept}AS {query}")
    return name


def set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_properties(properties)})")


def properties_of(spark: SparkSession, name: str) -> dict[str, str]:
    """Properties of a table or view; none if there is no such name."""
    if not spark.catalog.tableExists(name):
        return {}
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    replace: bool = False,
) -> str:
    """Enter an external table over ``path``, and find its partitions; returns its name.

    A table that is registered elsewhere stays where it is, with a warning, unless
    ``replace`` points it to the new folder. No data is ever deleted. This is for folders
    written by batch jobs; ``batches.open_view`` shows those a stream is still writing.
    """
    full = f"`{database}`.`{name}`"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`")
    if spark.catalog.tableExists(f"{database}.{name}"):
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").filter("col_name = 'Location'")
        there = details.first()["data_type"].split(":", 1)[-1].rstrip("/")
        here = path.split(":", 1)[-1].rstrip("/")
        if there.lstrip("/") != here.lstrip("/"):
            if replace:
                spark.sql(f"DROP TABLE {full}")
            else:
                log.warning("%s is registered at %s, not at %s", full, there, path)
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({_columns(schema)}) USING parquet "
        f"{partitions} LOCATION {_quoted(path)}"
    )
    if partition_by:
        spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
    if properties:
        set_properties(spark, full, properties)
    return full
