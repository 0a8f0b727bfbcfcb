"""Schemas of the event store and of the small log tables beside it."""

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType,
    TimestampType,
)


def _struct(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


RAW = _struct(
    event_time=StringType(),
    event_type=StringType(),
    product_id=LongType(),
    category_id=StringType(),
    category_code=StringType(),
    brand=StringType(),
    price=DoubleType(),
    user_id=LongType(),
    user_session=StringType(),
)

# The nine columns that identify an event within its source.
IDENTITY = [
    "event_time", "event_type", "product_id", "user_id", "user_session", "price",
    "category_id", "category_code", "brand",
]

EVENTS = _struct(
    event_time=TimestampType(),
    event_type=StringType(),
    product_id=LongType(),
    category_id=StringType(),
    category_code=StringType(),
    brand=StringType(),
    price=DoubleType(),
    user_id=LongType(),
    user_session=StringType(),
    date=DateType(),
    hour=IntegerType(),
    day_of_week=IntegerType(),
    day_name=StringType(),
    month=IntegerType(),
    year=IntegerType(),
    category_level1=StringType(),
    category_level2=StringType(),
    category_level3=StringType(),
    source_file=StringType(),
)

MANIFEST = _struct(
    source_file=StringType(),
    load_id=LongType(),
    fingerprint=StringType(),
    row_limit=LongType(),
    rows_loaded=LongType(),
    updated_at=TimestampType(),
)

RUN_LOG = _struct(
    id=LongType(),
    pipeline_name=StringType(),
    source_file=StringType(),
    table_name=StringType(),
    rows_read=LongType(),
    rows_inserted=LongType(),
    duplicates_removed=LongType(),
    rows_rejected=LongType(),
    execution_seconds=DoubleType(),
    status=StringType(),
    error_message=StringType(),
    created_at=TimestampType(),
)

QUALITY_LOG = _struct(
    id=LongType(),
    source_file=StringType(),
    total_records=LongType(),
    completeness_score=DoubleType(),
    valid_sessions_rate=DoubleType(),
    price_outlier_rate=DoubleType(),
    status=StringType(),
    details=StringType(),
    checked_at=TimestampType(),
)

REGISTRY = _struct(
    model_name=StringType(),
    version=StringType(),
    algorithm=StringType(),
    metrics=MapType(StringType(), DoubleType()),
    parameters=MapType(StringType(), StringType()),
    artifact_path=StringType(),
    feature_schema_version=StringType(),
    trained_at=TimestampType(),
)
