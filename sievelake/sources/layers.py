"""Layer tables as batch frames or append streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sievelake.operators.silver import valid_only
from sievelake.schemas import SILVER


def table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Batch scan of a layer, in the declared column order."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def table_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of rows appended to a layer.

    A batch folder appears whole and is never written again, so every row arrives exactly
    once; rewritten copies live in other folders and are never picked up.
    """
    # The folders' own columns, which no reader gets, are declared before the first batch.
    reader = spark.readStream.schema(
        StructType([*schema.fields, StructField("run", StringType()), StructField("batch_id", LongType())])
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path).select(*schema.fieldNames())


def valid_silver_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of valid cleaned rows; the filter reaches the Parquet scan."""
    return valid_only(table_stream(spark, path, SILVER, max_files_per_trigger))
