"""Message sources.  Whatever the transport, a message is one row of the envelope schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    ]
)

ENVELOPE_COLUMNS = [f.name for f in ENVELOPE]


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], max_offsets: int | None = None, **options) -> DataFrame:
    """Subscribe to topics from the earliest offset.  Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    headers = F.map_from_entries(
        F.transform("headers", lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    )
    return (
        reader.options(**options)
        .load()
        .select(
            "topic",
            "partition",
            "offset",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "timestamp",
            headers.alias("headers"),
        )
    )


def file_stream(spark: SparkSession, path: str, max_files: int | None = None, file_format: str = "parquet") -> DataFrame:
    """Read envelopes that some other job lands as files."""
    reader = spark.readStream.schema(ENVELOPE).format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def file_batch(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(ENVELOPE).format(file_format).load(path)


# ---------------------------------------------------------------------------------------------
# Envelopes derived from the analytics tables: the same messages a producer of those rows would
# send, including the mistakes producers make.  All of it is projection, so it scales with the scan.
# ---------------------------------------------------------------------------------------------


PARTITIONS = "spark.weirflow.source.partitions"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows to as many tasks as the setting ``spark.weirflow.source.partitions`` says; by default
    the splits of the files stay as they are.

    Parsing costs far more than reading, and a file with one row group keeps one core busy.  The
    setting is for inputs of a few such files; it is a shuffle, so large tables go without it.
    """
    n = df.sparkSession.conf.get(PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _padded(number: Column, width: int) -> Column:
    """``%0<width>d`` of a number; only negative ones and null need Java's formatter, which costs several times as much."""
    text = number.cast("string")
    few = F.lpad(text, width, "0")
    return F.when(number.isNull() | (number < 0), F.format_string(f"%0{width}d", number)).when(number < 10**width, few).otherwise(text)


def _no_headers() -> Column:
    return F.create_map().cast("map<string,string>")


def user_event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as messages of topic ``user.events.v1``: JSON, CSV, cut JSON and faulty values."""
    e = _table(spark, sf_dir, "events")
    n = F.col("event_id")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    stamp = (
        F.when(n % 67 == 23, F.lit("1500000000000"))
        .when(n % 3 == 0, millis)
        .when(n % 3 == 1, F.concat(iso, F.lit("Z")))
        .otherwise(iso)
    )
    user = F.when(n % 83 == 11, F.concat(F.lit("u"), "user_id")).otherwise(
        F.concat(F.lit("user-"), _padded(F.col("user_id"), 5))
    )
    kind = F.when(n % 89 == 7, F.col("event_type")).otherwise(F.upper("event_type"))
    cob = (
        F.when(n % 79 == 13, F.lit("2024-03-01"))
        .when(n % 73 == 17, F.lit("2024/01/15"))
        .when(n % 71 == 19, F.lit("2018-12-31"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    money = F.col("value").cast("decimal(12,2)").cast("string")
    no_user = n % 97 == 5

    cob_pair = (
        F.when(n % 61 == 3, F.concat(F.lit('"cob_date":'), _quoted(cob), F.lit(",")))
        .when(n % 59 == 4, F.lit(""))
        .otherwise(F.concat(F.lit('"cob":'), _quoted(cob), F.lit(",")))
    )
    json = F.concat(
        F.lit("{"),
        cob_pair,
        F.lit('"data":"value='),
        money,
        F.lit('","event_type":'),
        _quoted(kind),
        F.lit(',"note":"not in the schema","properties":'),
        F.col("props"),
        F.lit(',"timestamp":'),
        F.when(stamp.rlike(r"^\d+$"), stamp).otherwise(_quoted(stamp)),
        F.lit(',"user_id":'),
        F.when(no_user, F.lit("null")).otherwise(_quoted(user)),
        F.lit("}"),
    )
    csv = F.concat(
        cob, F.lit(", "), F.when(no_user, F.lit("null")).otherwise(user), F.lit(" ,"), kind, F.lit(","), stamp,
        F.lit(',"value='), money, F.lit(', from csv"'),
    )
    value = (
        F.when(n % 211 == 0, F.lit(""))
        .when(n % 223 == 1, F.lit(None).cast("string"))
        .when(n % 227 == 2, F.lit("[1, 2, 3]"))
        .when(n % 10 == 0, csv)
        .when(n % 10 == 1, F.left("_json", F.length("_json") - 9))
        .otherwise(F.col("_json"))
    )
    return e.withColumn("_json", json).select(
        F.lit("user.events.v1").alias("topic"),
        (n % 8).cast("int").alias("partition"),
        F.floor(n / 8).cast("long").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _no_headers().alias("headers"),
    )


def user_events_with_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user events plus a second delivery of every hundredth offset of each partition."""
    first = user_event_envelopes(spark, sf_dir)
    return first.withColumn("delivery", F.explode(F.when(F.col("offset") % 100 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))


# Fixed values of the derived messages, in the order in which a row picks them.
COMMERCE_TYPES = (
    "PURCHASE", "ORDER", "PAYMENT", "REFUND", "USER_ACTION", "PRODUCT_VIEW",
    "ADD_TO_CART", "PAGE_VIEW", "SECURITY_ALERT", "LOGIN_FAILED", "LOGIN", "FRAUD_DETECTED",
)
COMMERCE_CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CAD", "AUD", "CHF")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def commerce_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as messages of topic ``commerce.events.v1``, one JSON object per line."""
    li = _table(spark, sf_dir, "lineitem")
    order, part, line, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber"), F.col("l_suppkey")
    cents = F.col("l_extendedprice").cast("decimal(14,2)")
    units = F.col("l_quantity").cast("int")
    price = (cents / units).cast("decimal(14,2)")
    honest = price * units
    amount = (
        F.when(order % 41 == 5, F.lit("-12.50"))
        .when(order % 43 == 6, F.lit("1000000.01"))
        .when(order % 47 == 7, F.lit("NaN"))
        .when(order % 53 == 8, F.lit(None).cast("string"))
        .when(order % 59 == 9, (honest + F.lit(1)).cast("decimal(14,2)").cast("string"))
        .otherwise(honest.cast("decimal(14,2)").cast("string"))
    )
    quantity = (
        F.when(order % 61 == 10, F.lit("-1"))
        .when(order % 67 == 11, F.lit("10001"))
        .when(order % 71 == 12, F.lit("1.0"))
        .when(order % 73 == 13, F.lit(" 7 "))
        .otherwise(units.cast("string"))
    )
    product = (
        F.when(part % 37 == 3, F.lit(None).cast("string"))
        .when(part % 31 == 4, F.concat(F.lit("p-"), part.cast("string")))
        .otherwise(F.concat(F.lit("PROD-"), _padded(part, 6)))
    )
    session = F.when(supp % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("s-"), supp.cast("string")))
    body = F.to_json(
        F.struct(
            amount.alias("amount"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("cob"),
            _pick(COMMERCE_CURRENCIES, part % 7).alias("currency"),
            _pick(COMMERCE_TYPES, (part + line) % 12).alias("event_type"),
            product.alias("product_id"),
            quantity.alias("quantity"),
            session.alias("session_id"),
            F.unix_millis((F.col("l_shipdate") + F.make_dt_interval(hours=(order % 24).cast("int"))).cast("timestamp")).alias("timestamp"),
            price.cast("string").alias("unit_price"),
            F.concat(F.lit("user-"), _padded(order, 5)).alias("user_id"),
        )
    )
    return li.select(
        F.lit("commerce.events.v1").alias("topic"),
        (order % 16).cast("int").alias("partition"),
        (F.floor(order / 16) * 8 + line).cast("long").alias("offset"),
        order.cast("string").alias("key"),
        body.alias("value"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        _no_headers().alias("headers"),
    )


ORDER_STATUS = {"F": "delivered", "O": "created", "P": "paid"}


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as messages of topic ``orders.lifecycle.v2`` with a nested array of items."""
    o = _table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = F.when(k % 23 == 1, F.lit("lost"))
    for code, word in ORDER_STATUS.items():
        status = status.when(F.col("o_orderstatus") == code, F.lit(word))
    price = F.col("o_totalprice").cast("decimal(14,2)")
    total = F.when(k % 29 == 2, F.lit("-5")).when(k % 31 == 3, F.lit('"12.50"')).otherwise(price.cast("string"))
    currency = F.when(k % 37 == 4, F.lit("usd")).otherwise(_pick(COMMERCE_CURRENCIES, k % 7))
    stamp = F.when(k % 41 == 5, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    item = lambda i: F.concat(
        F.lit('{"product_id":"PROD-'),
        (k % 1000 + i).cast("string"),
        F.lit('"'),
        F.when((k % 43 == 6) & (i == 2), F.lit("")).otherwise(
            F.concat(
                F.lit(',"quantity":'),
                F.when((k % 47 == 7) & (i == 1), F.lit("0")).when((k % 53 == 8) & (i == 1), F.lit("2.5")).otherwise(i.cast("string")),
            )
        ),
        F.lit(',"unit_price":'),
        (price / 10 + i).cast("decimal(14,2)").cast("string"),
        F.lit("}"),
    )
    # One to three items, written out: a transform of an array would have the whole message interpreted.
    items = F.concat(F.lit("["), F.concat_ws(",", *[F.when(k % 3 + 1 >= i, item(F.lit(i))) for i in (1, 2, 3)]), F.lit("]"))
    value = F.concat(
        F.lit('{"cob":'),
        _quoted(F.date_format("o_orderdate", "yyyy-MM-dd")),
        F.lit(',"currency":'),
        _quoted(currency),
        F.when(k % 59 == 9, F.lit("")).otherwise(F.concat(F.lit(',"customer_id":"CUST-'), F.col("o_custkey").cast("string"), F.lit('"'))),
        F.lit(',"items":'),
        items,
        F.lit(',"order_id":"ORD-'),
        k.cast("string"),
        F.lit('","order_status":'),
        _quoted(status),
        F.lit(',"timestamp":'),
        _quoted(stamp),
        F.lit(',"total_amount":'),
        total,
        F.lit("}"),
    )
    return o.select(
        F.lit("orders.lifecycle.v2").alias("topic"),
        (k % 12).cast("int").alias("partition"),
        F.floor(k / 12).cast("long").alias("offset"),
        F.col("o_custkey").cast("string").alias("key"),
        value.alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        _no_headers().alias("headers"),
    )


def page_event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as page events for the JSON Schema check; some break one keyword each."""
    n = F.col("event_id")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    user = F.when(n % 17 == 3, F.lit("")).when(n % 19 == 4, F.concat(F.lit(',"user_id":'), F.col("user_id").cast("string"))).otherwise(
        F.concat(F.lit(',"user_id":'), _quoted(F.concat(F.lit("user-"), _padded(F.col("user_id"), 5))))
    )
    text = F.concat(
        F.lit('{"event_type":'),
        _quoted(F.col("event_type")),
        F.lit(',"page_url":"https://shop.example.com/'),
        F.when(n % 23 == 5, F.lit("a b")).otherwise(F.concat(F.lit("p/"), n.cast("string"))),
        F.lit('","properties":'),
        F.when(n % 37 == 8, F.lit('"none"')).otherwise(F.col("props")),
        F.when(n % 31 == 7, F.lit(',"referrer":null')).otherwise(F.lit("")),
        F.lit(',"session_id":"s-'),
        (n % 100).cast("string"),
        F.lit('","timestamp":"'),
        iso,
        F.when(n % 29 == 6, F.lit('"')).otherwise(F.lit('Z"')),
        user,
        F.lit("}"),
    )
    value = F.when(n % 41 == 9, F.left(text, F.length(text) - 4)).when(n % 43 == 10, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return _table(spark, sf_dir, "events").select(
        F.lit("page.events.v1").alias("topic"),
        (n % 8).cast("int").alias("partition"),
        F.floor(n / 8).cast("long").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _no_headers().alias("headers"),
    )
