"""Column layouts of events, result tables and the streaming-progress log."""

from __future__ import annotations

from pyspark.sql import types as T

# Allowed symbols of the result tables.
ANOMALY_TYPES = ["HIGH_FREQUENCY", "BOT_LIKE", "SPAM", "OTHER"]
FUNNEL_STAGES = ["VIEW", "MULTI_VIEW", "ADD_TO_CART", "PURCHASE"]
CHECK_RESULTS = ["PASS", "FAIL", "WARNING"]
RUN_STATUSES = ["RUNNING", "SUCCESS", "FAILED", "SKIPPED"]
ALERT_SEVERITIES = ["WARNING", "CRITICAL"]

# Header variants of the raw CSV files, most usual first.
TIMESTAMP_NAMES = ["Timestamp", "timestamp", "event_ts", "EventTs", "eventTs"]
SESSION_NAMES = ["Session ID", "session_id", "sessionId", "SessionID"]
ITEM_NAMES = ["Item ID", "item_id", "itemId", "ItemID"]
CATEGORY_NAMES = ["Category", "category"]
PRICE_NAMES = ["Price"]
QUANTITY_NAMES = ["Quantity"]

MONEY = T.DecimalType(12, 2)
TOTAL = T.DecimalType(15, 2)

# Names and types of the columns of events and result tables.
_LONG, _INT, _DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
_TEXT, _FLAG, _DATE, _TIME = T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TEXT) for name in names])


CLICK = _struct(
    session_id=_LONG,
    event_ts=_TIME,
    item_id=_LONG,
    category=_TEXT,
    event_type=_TEXT,
    event_id=_TEXT,
    ingest_ts=_TIME,
    source=_TEXT,
)
PURCHASE = _struct(
    session_id=_LONG,
    event_ts=_TIME,
    item_id=_LONG,
    price=MONEY,
    quantity=_INT,
    event_type=_TEXT,
    event_id=_TEXT,
    ingest_ts=_TIME,
    source=_TEXT,
)
EVENT_SCHEMAS = {"click": CLICK, "purchase": PURCHASE}

CLICK_CSV = _texts("Session ID", "Timestamp", "Item ID", "Category")
PURCHASE_CSV = _texts("Session ID", "Timestamp", "Item ID", "Price", "Quantity")

ANOMALY = _struct(
    event_id=_TEXT,
    event_ts=_LONG,
    session_id=_LONG,
    detected_at=_TIME,
    window_start=_TIME,
    window_end=_TIME,
    first_event_ts=_TIME,
    last_event_ts=_TIME,
    click_count=_LONG,
    unique_items=_LONG,
    anomaly_score=_DOUBLE,
    anomaly_type=_TEXT,
    kafka_ingest_ts=_TIME,
    spark_process_ts=_TIME,
    source=_TEXT,
)
DAILY_METRICS = _struct(
    metric_date=_DATE,
    total_clicks=_LONG,
    total_purchases=_LONG,
    unique_sessions=_LONG,
    unique_items=_LONG,
    conversion_rate=_DOUBLE,
    avg_session_duration_sec=_DOUBLE,
    avg_clicks_per_session=_DOUBLE,
    total_revenue=TOTAL,
    avg_order_value=_DOUBLE,
)
SESSION_FUNNEL = _struct(
    metric_date=_DATE,
    funnel_stage=_TEXT,
    session_count=_LONG,
    percentage=_DOUBLE,
    drop_rate=_DOUBLE,
)
POPULAR_ITEMS = _struct(
    metric_date=_DATE,
    item_id=_LONG,
    category=_TEXT,
    click_count=_LONG,
    purchase_count=_LONG,
    revenue=TOTAL,
    rank=_INT,
    click_to_purchase_ratio=_DOUBLE,
)
POPULAR_CATEGORIES = _struct(
    metric_date=_DATE,
    category=_TEXT,
    click_count=_LONG,
    purchase_count=_LONG,
    unique_items=_LONG,
    revenue=TOTAL,
    rank=_INT,
)
SESSION_SUMMARY = _struct(
    session_id=_LONG,
    metric_date=_DATE,
    first_event_ts=_TIME,
    last_event_ts=_TIME,
    duration_sec=_INT,
    click_count=_LONG,
    purchase_count=_LONG,
    unique_items_viewed=_LONG,
    unique_items_purchased=_LONG,
    total_spent=TOTAL,
    is_converted=_FLAG,
    is_anomaly=_FLAG,
    categories_viewed=T.ArrayType(_TEXT),
)
QUALITY_CHECKS = _struct(
    check_date=_DATE,
    check_type=_TEXT,
    table_name=_TEXT,
    check_result=_TEXT,
    expected_value=_DOUBLE,
    actual_value=_DOUBLE,
    message=_TEXT,
)
PIPELINE_RUNS = _struct(
    run_id=_TEXT,
    pipeline_name=_TEXT,
    run_date=_DATE,
    start_time=_TIME,
    end_time=_TIME,
    status=_TEXT,
    records_processed=_LONG,
    error_message=_TEXT,
    recorded_at=_TIME,
)
ALERT_HISTORY = _struct(
    alert_hash=_TEXT,
    time_bucket=_TIME,
    severity=_TEXT,
    topic_name=_TEXT,
    partition_offsets=T.MapType(_TEXT, _LONG),
    message=_TEXT,
    notified_at=_TIME,
)

# One line of the progress log. Offsets stay JSON text: their form depends on
# the source; Kafka's is topic -> partition -> offset.
TOPIC_OFFSETS = T.MapType(_TEXT, T.MapType(_TEXT, _LONG))
PROGRESS = _struct(
    event=_TEXT,
    id=_TEXT,
    run_id=_TEXT,
    runId=_TEXT,
    name=_TEXT,
    batchId=_LONG,
    timestamp=_TEXT,
    numInputRows=_LONG,
    processedRowsPerSecond=_DOUBLE,
    durationMs=_struct(triggerExecution=_LONG),
    sources=T.ArrayType(
        _struct(
            description=_TEXT,
            startOffset=_TEXT,
            endOffset=_TEXT,
            metrics=T.MapType(_TEXT, _TEXT),
        )
    ),
    stateOperators=T.ArrayType(_struct(numRowsTotal=_LONG)),
    exception=_TEXT,
    error_class=_TEXT,
)

# Record layouts on the topics.
CLICK_AVRO = """{"type": "record", "name": "Click", "fields": [
  {"name": "session_id", "type": "long"},
  {"name": "event_ts", "type": {"type": "long", "logicalType": "timestamp-millis"}},
  {"name": "item_id", "type": "long"},
  {"name": "category", "type": ["null", "string"], "default": null},
  {"name": "event_type", "type": "string", "default": "click"},
  {"name": "event_id", "type": "string", "default": ""},
  {"name": "ingest_ts", "type": {"type": "long", "logicalType": "timestamp-millis"}, "default": 0},
  {"name": "source", "type": "string", "default": "producer"}]}"""

PURCHASE_AVRO = """{"type": "record", "name": "Purchase", "fields": [
  {"name": "session_id", "type": "long"},
  {"name": "event_ts", "type": {"type": "long", "logicalType": "timestamp-millis"}},
  {"name": "item_id", "type": "long"},
  {"name": "price", "type": "double"},
  {"name": "quantity", "type": "int"},
  {"name": "event_type", "type": "string", "default": "purchase"},
  {"name": "event_id", "type": "string", "default": ""},
  {"name": "ingest_ts", "type": {"type": "long", "logicalType": "timestamp-millis"}, "default": 0},
  {"name": "source", "type": "string", "default": "producer"}]}"""
