"""Topic configuration: one frozen dataclass tree per topic.

Everything the rules and sinks need to know about a topic (schema, vocabularies, limits,
destination, maintenance settings) is a value here, so that two topics can disagree about, say, the
spelling of an event type without any code changing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The column that leads the directories of all tables below one root.
DESTINATION = "destination_table"

# A long column with this metadata holds epoch milliseconds and is parsed by the timestamp cascade.
TIMESTAMP_MILLIS = {"logical": "timestamp-millis"}

# The schema used for topics without a declared one.
FALLBACK_SCHEMA = T.StructType(
    [
        T.StructField("cob", T.StringType(), False),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("timestamp", T.LongType(), True, TIMESTAMP_MILLIS),
        T.StructField("data", T.StringType(), True),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType(), True), True, {"default": {}}),
    ]
)

# Transaction events: the numbers stay text so that the numeric rules can name what is wrong.
COMMERCE_SCHEMA = T.StructType(
    [
        T.StructField("cob", T.StringType(), False),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("timestamp", T.LongType(), True, TIMESTAMP_MILLIS),
        T.StructField("amount", T.StringType(), True),
        T.StructField("quantity", T.StringType(), True),
        T.StructField("unit_price", T.StringType(), True),
        T.StructField("product_id", T.StringType(), True),
        T.StructField("currency", T.StringType(), True),
        T.StructField("session_id", T.StringType(), True),
    ]
)

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("cob", T.StringType(), False),
        T.StructField("order_id", T.StringType(), True),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("order_status", T.StringType(), True),
        T.StructField("timestamp", T.LongType(), True, TIMESTAMP_MILLIS),
        T.StructField("total_amount", T.DoubleType(), True),
        T.StructField("currency", T.StringType(), True),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("product_id", T.StringType(), True),
                        T.StructField("quantity", T.IntegerType(), True),
                        T.StructField("unit_price", T.DoubleType(), True),
                    ]
                ),
                True,
            ),
            True,
        ),
    ]
)


@dataclass(frozen=True)
class RuleSettings:
    """Limits and vocabularies of the business rules.  Fixed values: they decide accept or reject."""

    enabled: tuple[str, ...] | None = None  # None = every rule
    required: tuple[str, ...] = ("user_id", "event_type")
    event_type_pattern: str = r"^[A-Z_]+\z"
    user_id_pattern: str = r"^[a-zA-Z0-9-]{8,}\z"
    product_id_pattern: str = r"^[A-Z0-9_-]{6,20}\z"
    currencies: tuple[str, ...] = ("USD", "EUR", "GBP", "JPY", "CAD", "AUD")
    cob_max_age_months: int = 60
    timestamp_max_age_days: int = 5 * 365
    timestamp_max_ahead_hours: int = 24
    amount_max: float = 1_000_000.0
    quantity_max: int = 10_000
    amount_tolerance: float = 0.01
    priced_types: tuple[str, ...] = ("PURCHASE", "ORDER")
    session_types: tuple[str, ...] = ("USER_ACTION",)
    product_types: tuple[str, ...] = ("PRODUCT_VIEW", "ADD_TO_CART", "PURCHASE")
    money_types: tuple[str, ...] = ("PAYMENT", "REFUND")


@dataclass(frozen=True)
class TableOptions:
    enable_optimize: bool = True
    optimize_interval: int = 10  # batches
    enable_vacuum: bool = False
    vacuum_retention_hours: int = 168
    enable_schema_evolution: bool = True


@dataclass(frozen=True)
class Destination:
    bucket: str
    path: str
    table_name: str
    partition_columns: tuple[str, ...] = ("cob_date",)
    file_format: str = "parquet"  # "delta" also works where that package is installed
    options: TableOptions = field(default_factory=TableOptions)

    def location(self, root: str | None = None) -> str:
        """Path of the table: below ``root`` if given, where the destination is the leading partition of
        all tables, else on the object store."""
        if root is None:
            return f"s3a://{self.bucket}/{self.path}"
        if not re.fullmatch(r"[\w.-]+", self.table_name):
            raise ValueError(f"a table name must be letters, digits, points, dashes and underscores: {self.table_name!r}")
        return f"{root.rstrip('/')}/{DESTINATION}={self.table_name}"


@dataclass(frozen=True)
class Processing:
    batch_size: int = 1000
    flush_interval_seconds: int = 60
    max_retries: int = 3
    dedup: str | None = None  # "offset" or "content": drop second deliveries before parsing


@dataclass(frozen=True)
class TopicConfig:
    name: str
    topic: str
    destination: Destination
    schema: T.StructType = field(default_factory=lambda: FALLBACK_SCHEMA)
    schema_file: str | None = None
    processing: Processing = field(default_factory=Processing)
    rules: RuleSettings = field(default_factory=RuleSettings)
    lenient: bool = False


USER_EVENTS = TopicConfig(
    name="user-events",
    topic="user.events.v1",
    destination=Destination("data-lake", "events/user-events", "user_events"),
)

ORDER_EVENTS = TopicConfig(
    name="order-events",
    topic="orders.lifecycle.v2",
    schema=ORDER_SCHEMA,
    schema_file="schemas/order-events-schema.json",
    destination=Destination(
        "data-lake",
        "orders/lifecycle-events",
        "order_events",
        partition_columns=("year", "month", "day", "order_status"),
        options=TableOptions(optimize_interval=5, enable_vacuum=True),
    ),
    processing=Processing(batch_size=500, flush_interval_seconds=30, max_retries=5),
    rules=RuleSettings(
        enabled=("cob_format", "cob_future", "cob_too_old", "required", "timestamp_too_old", "timestamp_future"),
        required=("order_id", "order_status"),
    ),
)

COMMERCE_EVENTS = TopicConfig(
    name="commerce-events",
    topic="commerce.events.v1",
    schema=COMMERCE_SCHEMA,
    destination=Destination("data-lake", "events/commerce", "commerce_events", partition_columns=("year", "month")),
)

DEFAULT_TOPICS = (USER_EVENTS, ORDER_EVENTS, COMMERCE_EVENTS)


def topic_table(spark: SparkSession, topics: tuple[TopicConfig, ...] = DEFAULT_TOPICS) -> DataFrame:
    """The configuration as a small DataFrame: routing, batching and maintenance settings."""
    rows = [
        (
            t.topic,
            t.name,
            t.destination.table_name,
            t.destination.location(),
            t.processing.batch_size,
            t.processing.max_retries,
            t.destination.options.enable_optimize,
            t.destination.options.optimize_interval,
            t.destination.options.enable_vacuum,
            t.destination.options.vacuum_retention_hours,
        )
        for t in topics
    ]
    return spark.createDataFrame(
        rows,
        "topic string, config_name string, table_name string, table_path string, batch_size int, max_retries int, "
        "enable_optimize boolean, optimize_interval int, enable_vacuum boolean, vacuum_retention_hours int",
    )
