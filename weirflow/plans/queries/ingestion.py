"""Sources, routing and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.config import COMMERCE_EVENTS, USER_EVENTS
from weirflow.functions import keys
from weirflow.operators.batches import batch_assignment
from weirflow.operators.dedup import dedup_offset
from weirflow.operators.route import route
from weirflow.operators.rules import accepted
from weirflow.operators.sinks import write_batch
from weirflow.plans.flow import accepted_rows, checked_messages
from weirflow.plans.queries.messages_sql import CC, CE, OE, PE, UC, UE, sql
from weirflow.plans.queries.registry import AS_OF, AS_OF_2001, query
from weirflow.plans.upkeep import read_as_text
from weirflow.session import scratch_path
from weirflow.sources import catalog
from weirflow.sources import envelopes as src


def plain(df: DataFrame) -> DataFrame:
    """Envelopes with the time as epoch milliseconds and without headers, for comparison."""
    return df.select("topic", "partition", "offset", "key", "value", F.unix_millis("timestamp").alias("timestamp_ms"))


@query("envelope_from_events", sql(UE, select='SELECT topic, partition, "offset", key, value, (epoch_us(ts) // 1000) AS timestamp_ms FROM ue'))
def envelope_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(src.user_event_envelopes(spark, sf_dir))


@query("envelope_from_lineitem", sql(CE, select='SELECT topic, partition, "offset", key, value, (epoch_us(ts) // 1000) AS timestamp_ms FROM ce'))
def envelope_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(src.commerce_envelopes(spark, sf_dir))


@query("envelope_from_orders", sql(OE, select='SELECT topic, partition, "offset", key, value, (epoch_us(ts) // 1000) AS timestamp_ms FROM oe'))
def envelope_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(src.order_envelopes(spark, sf_dir))


@query(
    "topic_routing",
    sql(
        UE, CE, OE, PE,
        select="""
    , t AS (SELECT topic FROM ue UNION ALL SELECT topic FROM ce UNION ALL SELECT topic FROM oe UNION ALL SELECT topic FROM pe),
    cfg(topic, table_name, table_path) AS (VALUES ('user.events.v1', 'user_events', 's3a://data-lake/events/user-events'),
      ('orders.lifecycle.v2', 'order_events', 's3a://data-lake/orders/lifecycle-events'), ('commerce.events.v1', 'commerce_events', 's3a://data-lake/events/commerce'))
    SELECT t.topic, table_name, table_path, CASE WHEN table_name IS NULL THEN 'No configuration found for topic: ' || t.topic END AS route_error, count(*) AS messages
    FROM t LEFT JOIN cfg ON t.topic = cfg.topic GROUP BY ALL""",
    ),
)
def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of four topics, one of which nobody configured."""
    topics = (src.user_event_envelopes, src.commerce_envelopes, src.order_envelopes, src.page_event_envelopes)
    first, *rest = [make(spark, sf_dir).select("topic") for make in topics]
    for df in rest:
        first = first.unionByName(df)
    return route(first).groupBy("topic", "table_name", "table_path", "route_error").agg(F.count("*").alias("messages"))


@query(
    "events_by_type_daily",
    sql(
        CC,
        select="""
    SELECT event_type, count(*) AS events, round(avg(nprice), 4) AS avg_price FROM cc
    WHERE reject_rule IS NULL AND strftime(make_timestamp(ms * 1000), '%Y-%m') = '2000-03' GROUP BY event_type""",
    ),
)
def events_by_type_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's question to the lake: events and mean price per type in a period, read from the table
    by its partition columns."""
    table = read_as_text(spark, commerce_table(spark, sf_dir), ("year", "month"))
    return (
        table.filter((F.col("year") == "2000") & (F.col("month") == "03"))
        .groupBy("event_type")
        .agg(F.count("*").alias("events"), F.round(F.avg(F.col("unit_price").try_cast("double")), 4).alias("avg_price"))
    )


def commerce_table(spark: SparkSession, sf_dir: str) -> str:
    """The commerce events written to their table."""
    path = scratch_path(spark, "commerce")
    rows = accepted_rows(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001)
    write_batch(rows, path, COMMERCE_EVENTS.destination.partition_columns, batch_id=1)
    return path


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema catalog with one version per part and one subject per brand."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(
        keys.schema_subject(schema_path()).alias("subject"),
        (F.col("p_partkey") + 1).alias("version"),
        F.col("p_partkey").alias("schema_id"),
        F.concat(F.lit('{"type":"'), F.col("p_type"), F.lit('","size":'), F.col("p_size").cast("string"), F.lit("}")).alias("schema"),
    )


def schema_path():
    """Where the schema of a part's brand would lie; several spellings of file names."""
    brand = F.lower(F.replace("p_brand", F.lit("#"), F.lit("-")))
    n = F.col("p_partkey")
    return (
        F.when(n % 4 == 0, F.concat(F.lit("schemas/v1.2/"), brand, F.lit("-schema.json")))
        .when(n % 4 == 1, F.concat(brand, F.lit("-schema.avsc")))
        .when(n % 4 == 2, F.concat(F.lit("/etc/schemas/"), brand))
        .otherwise(F.concat(F.lit("schemas/"), brand, F.lit(".events-schema.json")))
    )


_PATHS_SQL = """
parts AS (SELECT *, lower(replace(p_brand, '#', '-')) AS b FROM part),
paths AS (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 'schemas/v1.2/' || b || '-schema.json' WHEN 1 THEN b || '-schema.avsc'
  WHEN 2 THEN '/etc/schemas/' || b ELSE 'schemas/' || b || '.events-schema.json' END AS path FROM parts),
subj AS (SELECT *, regexp_replace(regexp_replace(regexp_extract(path, '[^/]*$'), '^(.+)\\.[^.]*$', '\\1'), '-schema$', '') || '-value' AS subject FROM paths)
"""


@query("schema_subject", sql(_PATHS_SQL, select="SELECT p_partkey, path, subject FROM subj"))
def schema_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", schema_path().alias("path"))
    return part.withColumn("subject", keys.schema_subject(F.col("path")))


@query(
    "schema_latest",
    sql(
        _PATHS_SQL,
        select="""
    SELECT subject, max(p_partkey) + 1 AS version, max(p_partkey) AS schema_id,
      '{"type":"' || arg_max(p_type, p_partkey) || '","size":' || arg_max(p_size, p_partkey) || '}' AS schema FROM subj GROUP BY subject""",
    ),
)
def schema_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.latest(part_catalog(spark, sf_dir))


@query("schema_subjects", sql(_PATHS_SQL, select="SELECT DISTINCT subject FROM subj"))
def schema_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.subjects(part_catalog(spark, sf_dir))


@query(
    "catalog_register",
    sql(
        _PATHS_SQL,
        select="""
    , c AS (SELECT subject, p_partkey + 1 AS version, p_partkey AS schema_id, '{"type":"' || p_type || '","size":' || p_size || '}' AS schema FROM subj),
    f AS (SELECT * FROM c ORDER BY schema_id LIMIT 1)
    SELECT f.subject, max(c.version) AS version, max(c.schema_id) AS schema_id, f.schema, false AS is_new FROM c JOIN f ON c.subject = f.subject AND c.schema = f.schema GROUP BY f.subject, f.schema
    UNION ALL SELECT f.subject, (SELECT max(c.version) FROM c JOIN f ON c.subject = f.subject) + 1, (SELECT max(schema_id) FROM c) + 1, '{"type":"new"}', true FROM f""",
    ),
)
def catalog_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registering a schema that its subject has, and one that it has not."""
    known = part_catalog(spark, sf_dir)
    first = known.orderBy("schema_id").first()
    again = catalog.register(known, first["subject"], first["schema"])
    return again.union(catalog.register(known, first["subject"], '{"type":"new"}'))


_STRATEGY_NAMES = ("time_based", "Topic_Partition", "nobody", "")


@query(
    "partition_strategy",
    sql(
        UE,
        select=" UNION ALL ".join(
            f"SELECT '{n}' AS strategy, count(DISTINCT " + ("topic || strftime(ts, '/year=%Y/month=%m/day=%d/hour=%H')" if n == "time_based" else "topic || '/partition=' || partition") + ") AS keys, count(*) AS messages FROM ue"
            for n in _STRATEGY_NAMES
        ),
    ),
)
def partition_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directories by the strategy of a name in any case; unknown names mean the default."""
    messages = src.user_event_envelopes(spark, sf_dir)
    one = lambda n: messages.agg(F.lit(n).alias("strategy"), F.countDistinct(keys.partition_key(n, AS_OF)).alias("keys"), F.count("*").alias("messages"))
    first, *rest = map(one, _STRATEGY_NAMES)
    for part in rest:
        first = first.union(part)
    return first


_KEY_QUERY_SQL = {
    "DEFAULT": """SELECT partition, "offset", topic || '/partition=' || partition AS partition_key FROM ue""",
    "TIME_BASED": """SELECT partition, "offset", topic || strftime(ts, '/year=%Y/month=%m/day=%d/hour=%H') AS partition_key FROM ue""",
}
_KEY_QUERY_SQL["TOPIC_PARTITION"] = _KEY_QUERY_SQL["DEFAULT"]


def _register_keys() -> None:
    for name, strategy in (("partition_key_default", "DEFAULT"), ("partition_key_time", "TIME_BASED"), ("partition_key_topic", "TOPIC_PARTITION")):

        def run(spark: SparkSession, sf_dir: str, strategy: str = strategy) -> DataFrame:
            key = keys.partition_key(strategy, AS_OF)
            return src.user_event_envelopes(spark, sf_dir).select("partition", "offset", key.alias("partition_key"))

        query(name, sql(UE, select=_KEY_QUERY_SQL[strategy]))(run)


_register_keys()


@query(
    "batch_assignment",
    sql(
        UE, OE,
        select="""
    , m AS (SELECT 'user.events.v1_user_events' AS destination, 1000 AS n, partition, "offset" FROM ue
            UNION ALL SELECT 'orders.lifecycle.v2_order_events', 500, partition, "offset" FROM oe)
    SELECT destination, partition, "offset", (row_number() OVER (PARTITION BY destination ORDER BY partition, "offset") - 1) // n AS batch_no FROM m""",
    ),
)
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = src.user_events_with_replays(spark, sf_dir).drop("delivery").unionByName(src.order_envelopes(spark, sf_dir))
    return batch_assignment(messages)


@query("dedup_offset", sql(UE, select='SELECT topic, partition, "offset", value FROM ue'))
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_offset(src.user_events_with_replays(spark, sf_dir)).select("topic", "partition", "offset", "value")


@query(
    "accepted_by_event_type",
    sql(UC, select="SELECT event_type, count(*) AS events, min(ms) AS first_ms, max(ms) AS last_ms FROM uc WHERE reject_rule IS NULL GROUP BY event_type"),
)
def accepted_by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: messages parsed, checked and counted per event type."""
    rows = accepted(checked_messages(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF))
    stamp = F.col("rec.timestamp")
    return rows.groupBy(F.col("rec.event_type").alias("event_type")).agg(
        F.count("*").alias("events"), F.min(stamp).alias("first_ms"), F.max(stamp).alias("last_ms")
    )
