"""Format detection, records, conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.config import COMMERCE_EVENTS, ORDER_EVENTS, USER_EVENTS
from weirflow.functions import times, values
from weirflow.functions.fingerprints import offset_fingerprint
from weirflow.operators import parse as p
from weirflow.plans.queries.messages_sql import ASOF_MS, CP, OP, PE, UE, UP, sql
from weirflow.plans.queries.registry import AS_OF, AS_OF_2001, query
from weirflow.sources import envelopes as src


def _parsed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.parse(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF)


_USER_FIELDS = ["partition", "offset", "rec.cob", "rec.user_id", "rec.event_type", "rec.timestamp", "rec.data"]


@query("format_detect", sql(UP, select="SELECT format, count(*) AS messages FROM up GROUP BY format"))
def format_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = src.user_event_envelopes(spark, sf_dir)
    return df.groupBy(p.detect_format(F.col("value")).alias("format")).agg(F.count("*").alias("messages"))


@query(
    "parse_json",
    sql(UP, select="""SELECT partition, "offset", cob, user_id, event_type, ms AS timestamp, data, k FROM up WHERE format = 'JSON' AND parse_error IS NULL"""),
)
def parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.parsed_only(_parsed_users(spark, sf_dir)).filter(F.col("format") == p.JSON)
    return rows.select(*_USER_FIELDS, F.col("rec.properties")["k"].alias("k"))


@query(
    "parse_csv",
    sql(UP, select="""SELECT partition, "offset", cob, user_id, event_type, ms AS timestamp, data FROM up WHERE format = 'CSV' AND parse_error IS NULL"""),
)
def parse_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.parsed_only(_parsed_users(spark, sf_dir)).filter(F.col("format") == p.CSV).select(*_USER_FIELDS)


@query("parse_failures", sql(UP, select="""SELECT partition, "offset", format, parse_error, value FROM up WHERE parse_error IS NOT NULL"""))
def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.parse_failures(_parsed_users(spark, sf_dir)).select("partition", "offset", "format", "parse_error", "value")


@query(
    "parse_nested_items",
    sql(
        OP,
        select="""
    SELECT order_id, total_amount, json_extract_string(i, '$.product_id') AS product_id, CAST(json_extract_string(i, '$.quantity') AS INTEGER) AS quantity,
      CAST(json_extract_string(i, '$.unit_price') AS DOUBLE) AS unit_price FROM (SELECT order_id, total_amount, unnest(items) AS i FROM op WHERE parse_error IS NULL)""",
    ),
)
def parse_nested_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = p.parsed_only(p.parse(src.order_envelopes(spark, sf_dir), ORDER_EVENTS, AS_OF_2001))
    return parsed.select("rec.order_id", "rec.total_amount", F.inline("rec.items"))


_NUMBER_TEXTS_SQL = """
nt0 AS (SELECT event_id AS n, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS m, CAST(user_id AS VARCHAR) AS u, event_type FROM events),
nt AS (SELECT n, event_type, CASE n % 11 WHEN 0 THEN m WHEN 1 THEN u WHEN 2 THEN '-' || u WHEN 3 THEN ' ' || u || ' ' WHEN 4 THEN m || 'd' WHEN 5 THEN 'NaN'
   WHEN 6 THEN m || 'e3' WHEN 7 THEN 'true' WHEN 8 THEN u || 'x' WHEN 9 THEN '99999999999' ELSE '' END AS t FROM nt0)
"""


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` numbers in eleven spellings, good and bad."""
    n, u = F.col("event_id"), F.col("user_id").cast("string")
    m = F.col("value").cast("decimal(12,2)").cast("string")
    text = (
        F.when(n % 11 == 0, m).when(n % 11 == 1, u).when(n % 11 == 2, F.concat(F.lit("-"), u))
        .when(n % 11 == 3, F.concat(F.lit(" "), u, F.lit(" "))).when(n % 11 == 4, F.concat(m, F.lit("d"))).when(n % 11 == 5, F.lit("NaN"))
        .when(n % 11 == 6, F.concat(m, F.lit("e3"))).when(n % 11 == 7, F.lit("true")).when(n % 11 == 8, F.concat(u, F.lit("x")))
        .when(n % 11 == 9, F.lit("99999999999")).otherwise(F.lit(""))
    )
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", text.alias("t"))


_LENIENT_NUMBER = "(CASE WHEN regexp_full_match(trim(t), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(trim(t) AS DOUBLE) END)"


@query(
    "coerce_lenient",
    sql(
        _NUMBER_TEXTS_SQL,
        select=f"""
    SELECT n AS event_id, t, CAST(CASE WHEN {_LENIENT_NUMBER} IS NULL THEN 0 ELSE least(greatest(trunc({_LENIENT_NUMBER}), -2147483648), 2147483647) END AS INTEGER) AS as_int,
      CAST(coalesce(trunc({_LENIENT_NUMBER}), 0) AS BIGINT) AS as_long, coalesce({_LENIENT_NUMBER}, 0.0) AS as_double,
      lower(trim(t)) = 'true' OR coalesce({_LENIENT_NUMBER} <> 0, false) AS as_boolean FROM nt""",
    ),
)
def coerce_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    return number_texts(spark, sf_dir).select(
        "event_id", "t",
        values.lenient(t, T.IntegerType()).alias("as_int"), values.lenient(t, T.LongType()).alias("as_long"),
        values.lenient(t, T.DoubleType()).alias("as_double"), values.lenient(t, T.BooleanType()).alias("as_boolean"),
    )


@query(
    "coerce_strict",
    sql(
        _NUMBER_TEXTS_SQL,
        select=r"""
    SELECT n AS event_id, t, CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN TRY_CAST(t AS INTEGER) END AS as_int,
      CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN TRY_CAST(t AS BIGINT) END AS as_long,
      CASE WHEN t = 'NaN' THEN 'number' WHEN TRY_CAST(regexp_replace(trim(t), '([0-9])d$', '\1') AS DOUBLE) IS NOT NULL THEN 'number' ELSE 'error' END AS double_outcome,
      CASE WHEN t <> 'NaN' THEN TRY_CAST(regexp_replace(trim(t), '([0-9])d$', '\1') AS DOUBLE) END AS as_double,
      lower(t) = 'true' AS as_boolean FROM nt""",
    ),
)
def coerce_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    number = values.strict(t, T.DoubleType(), from_csv=True)
    return number_texts(spark, sf_dir).select(
        "event_id", "t",
        values.strict(t, T.IntegerType(), True).alias("as_int"), values.strict(t, T.LongType(), True).alias("as_long"),
        F.when(number.isNull(), F.lit("error")).otherwise(F.lit("number")).alias("double_outcome"),
        F.when(~F.isnan(number), number).alias("as_double"), values.strict(t, T.BooleanType(), True).alias("as_boolean"),
    )


@query(
    "decode_bytes",
    """
    WITH b AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '*' || text ELSE to_base64(encode(text)) END AS encoded FROM documents)
    SELECT b.doc_id, CASE WHEN b.doc_id % 5 <> 0 THEN d.text END AS text, CASE WHEN b.doc_id % 5 <> 0 THEN strlen(d.text) END AS n_bytes
    FROM b JOIN documents d USING (doc_id)""",
)
def decode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through base64 and back; every fifth is no base64."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("*"), "text")).otherwise(F.base64(F.encode("text", "UTF-8"))).alias("encoded"),
    )
    data = values.base64_bytes(F.col("encoded"))
    return docs.select("doc_id", F.decode(data, "UTF-8").alias("text"), F.octet_length(data).cast("bigint").alias("n_bytes"))


@query(
    "timestamp_cascade",
    sql(
        r"""
st0 AS (SELECT event_id AS n, ts, CASE event_id % 9 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN CAST((epoch_us(ts) // 1000) AS VARCHAR) WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
   WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M') WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') WHEN 5 THEN strftime(ts, '%Y-%m-%d') WHEN 6 THEN strftime(ts, '%Y')
   WHEN 7 THEN 'yesterday' ELSE NULL END AS stamp FROM events)""",
        select=f"""
    SELECT n AS event_id, stamp, CASE n % 9 WHEN 0 THEN epoch_ms(date_trunc('second', ts)) WHEN 1 THEN (epoch_us(ts) // 1000) WHEN 2 THEN (epoch_us(ts) // 1000) WHEN 3 THEN epoch_ms(date_trunc('minute', ts))
      WHEN 4 THEN epoch_ms(date_trunc('second', ts)) - 7200000 WHEN 6 THEN 2024 WHEN 8 THEN NULL ELSE {ASOF_MS} END AS millis FROM st0""",
    ),
)
def timestamp_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    form = lambda pattern: F.date_format("ts", pattern)
    stamp = (
        F.when(n % 9 == 0, form("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(n % 9 == 1, F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
        .when(n % 9 == 2, form("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).when(n % 9 == 3, form("yyyy-MM-dd'T'HH:mm"))
        .when(n % 9 == 4, form("yyyy-MM-dd'T'HH:mm:ss'+02:00'")).when(n % 9 == 5, form("yyyy-MM-dd")).when(n % 9 == 6, form("yyyy"))
        .when(n % 9 == 7, F.lit("yesterday"))
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", stamp.alias("stamp"))
    return events.withColumn("millis", times.timestamp_cascade(F.col("stamp"), AS_OF))


@query(
    "cob_fill_json",
    sql(UP, select="""
    SELECT cob, CASE WHEN value LIKE '%"cob":%' THEN 'cob' WHEN value LIKE '%"cob_date":%' THEN 'cob_date' ELSE 'today' END AS taken_from, count(*) AS messages
    FROM up WHERE format = 'JSON' AND parse_error IS NULL GROUP BY ALL"""),
)
def cob_fill_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.parsed_only(_parsed_users(spark, sf_dir)).filter(F.col("format") == p.JSON)
    taken = F.when(F.col("value").contains('"cob":'), F.lit("cob")).when(F.col("value").contains('"cob_date":'), F.lit("cob_date")).otherwise(F.lit("today"))
    return rows.groupBy(F.col("rec.cob").alias("cob"), taken.alias("taken_from")).agg(F.count("*").alias("messages"))


@query(
    "wire_header",
    """
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'too_short' WHEN 1 THEN 'bad_magic' WHEN 2 THEN 'not_base64' ELSE 'framed' END AS wire_kind,
      CASE WHEN event_id % 5 > 2 THEN user_id * 65537 END AS schema_id, CASE WHEN event_id % 5 > 2 THEN event_type END AS body FROM events""",
)
def wire_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events framed as a registry client frames them; some frames are broken.  A header holds the low four
    bytes of an id, as ``ByteBuffer.putInt`` writes them."""
    n = F.col("event_id")
    number = F.right(F.lpad(F.hex(F.col("user_id") * 65537), 16, "0"), F.lit(8))
    frame = lambda magic: F.base64(F.unhex(F.concat(F.lit(magic), number, F.hex(F.encode("event_type", "UTF-8")))))
    value = F.when(n % 5 == 0, F.base64(F.unhex(F.lit("0000")))).when(n % 5 == 1, frame("01")).when(n % 5 == 2, F.lit('{"not":"base64"}')).otherwise(frame("00"))
    framed = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", value.alias("value"))
    return p.wire_header(framed).select("event_id", "wire_kind", "schema_id", F.decode("payload", "UTF-8").alias("body"))


@query(
    "parse_variant",
    sql(PE, select="""
    , v AS (SELECT partition, "offset", CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' THEN CAST(value AS JSON) END AS doc FROM pe)
    SELECT partition, "offset", doc IS NOT NULL AS is_object, json_extract_string(doc, '$.event_type') AS event_type,
      CAST(json_extract_string(doc, '$.properties.k') AS BIGINT) AS k FROM v"""),
)
def parse_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = p.parse_variant(src.page_event_envelopes(spark, sf_dir))
    return docs.select(
        "partition", "offset", F.col("doc").isNotNull().alias("is_object"),
        F.try_variant_get("doc", "$.event_type", "string").alias("event_type"), F.try_variant_get("doc", "$.properties.k", "bigint").alias("k"),
    )


@query(
    "to_table_rows",
    sql(CP, select="""
    SELECT user_id, event_type, ms AS timestamp, amount, quantity, unit_price, product_id, currency, session_id, CAST(996710400000 AS BIGINT) AS processed_timestamp, cob AS cob_date, cob FROM cp"""),
)
def to_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.to_table_rows(p.parsed_only(p.parse(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001)), AS_OF_2001)


@query(
    "position_fingerprint",
    sql(UE, select="""SELECT partition, "offset", sha256(topic || ':' || partition || ':' || "offset") AS position_hash FROM ue"""),
)
def position_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:


    df = src.user_event_envelopes(spark, sf_dir)
    return df.select("partition", "offset", offset_fingerprint(F.col("topic"), F.col("partition"), F.col("offset")).alias("position_hash"))
