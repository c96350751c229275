"""Declared schemas. Every field is nullable: a rejected row keeps its place with nulls."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT = StringType()
TIME = TimestampType()
COUNT = LongType()
METADATA = MapType(TEXT, TEXT)


def _schema(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


REGISTRY = _schema(
    source=TEXT, url=TEXT, format=TEXT, category=TEXT, update_frequency=TEXT, description=TEXT
)

# JSON inside a message; the timestamp is ISO text.
MESSAGE_VALUE = _schema(
    domain=TEXT,
    category=TEXT,
    source=TEXT,
    source_format=TEXT,
    raw_entry=TEXT,
    ingestion_timestamp=TEXT,
    metadata=METADATA,
)

# Columns of the message transport, as the Kafka source names them.
TRANSPORT = _schema(
    key=BinaryType(),
    value=BinaryType(),
    topic=TEXT,
    partition=IntegerType(),
    offset=COUNT,
    timestamp=TIME,
    timestampType=IntegerType(),
)

BRONZE = _schema(
    domain=TEXT,
    category=TEXT,
    source=TEXT,
    source_format=TEXT,
    raw_entry=TEXT,
    ingestion_timestamp=TIME,
    metadata=METADATA,
    kafka_topic=TEXT,
    kafka_partition=COUNT,
    kafka_offset=COUNT,
    kafka_timestamp=TIME,
    bronze_timestamp=TIME,
    ingestion_date=DateType(),
)

SILVER = _schema(
    domain=TEXT,
    category=TEXT,
    source=TEXT,
    source_format=TEXT,
    raw_entry=TEXT,
    ingestion_timestamp=TIME,
    bronze_timestamp=TIME,
    silver_timestamp=TIME,
    metadata=METADATA,
    is_valid=TEXT,
    validation_errors=TEXT,
    ingestion_date=DateType(),
    bronze_offset=COUNT,
)

GOLD = _schema(
    domain=TEXT,
    category=TEXT,
    source_list=TEXT,
    source_count=COUNT,
    first_seen=TIME,
    last_seen=TIME,
    last_updated=TIME,
    is_active=TEXT,
    metadata=METADATA,
    domain_hash=COUNT,
)

# Mergeable per-domain state: folding any grouping of these rows gives the same result.
GOLD_PARTIAL = _schema(
    domain=TEXT,
    has_malware=BooleanType(),
    sources=ArrayType(TEXT),
    first_seen=TIME,
    last_seen=TIME,
    earliest=_schema(
        seen=TIME, source=TEXT, offset=COUNT, entries=ArrayType(_schema(key=TEXT, value=TEXT))
    ),
    updated=TIME,
)

# Columns a layer must not leave empty.
REQUIRED = {
    "bronze": [
        "domain",
        "category",
        "source",
        "source_format",
        "raw_entry",
        "ingestion_timestamp",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "bronze_timestamp",
        "ingestion_date",
    ],
    "silver": [
        "domain",
        "category",
        "source",
        "source_format",
        "raw_entry",
        "ingestion_timestamp",
        "bronze_timestamp",
        "silver_timestamp",
        "is_valid",
        "ingestion_date",
        "bronze_offset",
    ],
    "gold": [
        "domain",
        "category",
        "source_list",
        "source_count",
        "first_seen",
        "last_seen",
        "last_updated",
        "is_active",
    ],
}
