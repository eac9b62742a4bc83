"""Sinks, schemas, duplicates, table checks and maintenance."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirflow.config import COMMERCE_EVENTS, ORDER_EVENTS, USER_EVENTS, topic_table
from weirflow.functions.fingerprints import canonical_text
from weirflow.operators import dedup, maintenance, quality, schemas, sinks
from weirflow.operators import enrich as e
from weirflow.operators import rules as r
from weirflow.operators.parse import parse, parsed_only
from weirflow.plans import upkeep
from weirflow.plans.flow import accepted_rows, checked_messages, write_messages
from weirflow.plans.queries.messages_sql import CC, CE, OE, OP, PE, UC, UP, sql
from weirflow.plans.queries.registry import AS_OF, AS_OF_2001, query
from weirflow.session import scratch_path
from weirflow.sources import envelopes as src

# ---- sinks ----------------------------------------------------------------------------------


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_rows(src.order_envelopes(spark, sf_dir), ORDER_EVENTS, AS_OF_2001)


def _written_orders(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = scratch_path(spark, name)
    sinks.write_batch(_order_rows(spark, sf_dir), path, ("year", "order_status"), batch_id=7)
    return path


@query(
    "sink_roundtrip",
    sql(OP, select="""SELECT CAST(left(cob, 4) AS INTEGER) AS year, order_status, count(*) AS orders, round(sum(total_amount), 2) AS total FROM oc WHERE reject_rule IS NULL GROUP BY ALL"""),
)
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the order table, write the same batch again as after a crash, and read it back."""
    path = _written_orders(spark, sf_dir, "sink-roundtrip")
    sinks.write_batch(_order_rows(spark, sf_dir), path, ("year", "order_status"), batch_id=7)
    table = sinks.read_table(spark, path)
    return table.groupBy(F.col("year").cast("int").alias("year"), "order_status").agg(F.count("*").alias("orders"), F.round(F.sum("total_amount"), 2).alias("total"))


@query("snapshot_read_stats", sql(OP, select="SELECT count(*) AS rows, 33 AS columns, min(ms) AS first_ms, max(ms) AS last_ms FROM oc WHERE reject_rule IS NULL"))
def snapshot_read_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sinks.read_table(spark, _written_orders(spark, sf_dir, "snapshot"))
    return table.agg(F.count("*").alias("rows"), F.lit(len(table.columns)).alias("columns"), F.min("timestamp").alias("first_ms"), F.max("timestamp").alias("last_ms"))


@query(
    "jsonl_roundtrip",
    sql(CE, select="""SELECT partition, count(*) AS lines, min("offset") AS first_offset, max("offset") AS last_offset, count(json_extract_string(value, '$.amount')) AS with_amount FROM ce GROUP BY partition"""),
)
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines by topic and partition, read back with a schema."""
    path = scratch_path(spark, "jsonl")
    records = e.with_record_metadata(src.commerce_envelopes(spark, sf_dir), AS_OF_2001)
    sinks.write_jsonl(records, path, ("topic", "partition"))
    back = sinks.read_jsonl(spark, path, "amount string, _metadata struct<kafka_offset: bigint, processor_version: string>, topic string, partition int")
    offset = F.col("_metadata.kafka_offset")
    return back.groupBy("partition").agg(
        F.count("*").alias("lines"), F.min(offset).alias("first_offset"), F.max(offset).alias("last_offset"), F.count("amount").alias("with_amount")
    )


@query(
    "writer_stats",
    sql(OP, select="SELECT CAST(left(cob, 4) AS INTEGER) AS year, order_status, count(*) AS records, true AS has_files FROM oc WHERE reject_rule IS NULL GROUP BY ALL"),
)
def writer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and times of files differ between runs; that there are files and bytes does not."""
    table = sinks.read_table(spark, _written_orders(spark, sf_dir, "writer-stats"))
    stats = sinks.writer_stats(table, ["year", "order_status"])
    return stats.select(F.col("year").cast("int").alias("year"), "order_status", "records", ((F.col("files") > 0) & (F.col("bytes") > 0) & F.col("last_write").isNotNull()).alias("has_files"))


@query(
    "table_layout",
    sql(OP, select="SELECT count(DISTINCT left(cob, 4) || order_status) AS directories, 1 AS commits, true AS has_files FROM oc WHERE reject_rule IS NULL"),
)
def table_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_orders(spark, sf_dir, "layout")
    report = quality.layout_report(sinks.file_inventory(spark, path).filter(F.col("path").endswith(".parquet")), commits=1)
    return report.select("directories", "commits", ((F.col("data_files") >= F.col("directories")) & (F.col("bytes") > 0) & (F.col("files_per_commit") == F.col("data_files"))).alias("has_files"))


@query(
    "compaction_rewrite",
    sql(OP, select="""SELECT left(cob, 4) AS year, substr(cob, 6, 2) AS month, order_status, CAST(1 + "offset" % 3 AS BIGINT) AS ingest_batch, count(*) AS orders, true AS fewer_files
        FROM oc WHERE reject_rule IS NULL GROUP BY ALL"""),
)
def compaction_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches written by the flow's writer, then merged: the same rows and partition values."""
    table, output, place = scratch_path(spark, "batches"), scratch_path(spark, "merged"), ("year", "month", "order_status")
    orders = src.order_envelopes(spark, sf_dir)
    for batch in range(3):
        rows = accepted_rows(orders.filter(F.col("offset") % 3 == batch), ORDER_EVENTS, AS_OF_2001)
        sinks.write_batch(rows, table, place, batch_id=batch + 1)
    merged = upkeep.compact(spark, table, output, place)
    files = lambda path: sinks.file_inventory(spark, path).filter(F.col("path").endswith(".parquet")).agg(F.count("*").alias("n"))
    fewer = files(table).withColumnRenamed("n", "before").join(files(output).withColumnRenamed("n", "after"), F.lit(True)).select((F.col("after") < F.col("before")).alias("fewer_files"))
    counted = merged.groupBy("year", "month", "order_status", sinks.BATCH).agg(F.count("*").alias("orders"))
    return counted.join(F.broadcast(fewer), F.lit(True))  # one row


@query(
    "flow_dedup",
    sql(OP, select="SELECT order_status, count(*) AS orders FROM oc WHERE reject_rule IS NULL GROUP BY order_status"),
)
def flow_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order delivered twice in one batch; the flow that drops second deliveries writes each once."""
    orders, root = src.order_envelopes(spark, sf_dir), scratch_path(spark, "twice")
    topic = replace(ORDER_EVENTS, processing=replace(ORDER_EVENTS.processing, dedup="offset"))
    write_messages(orders.unionByName(orders), root, 1, (topic,), AS_OF_2001)
    return sinks.read_table(spark, topic.destination.location(root)).groupBy("order_status").agg(F.count("*").alias("orders"))


# ---- schemas --------------------------------------------------------------------------------

_FIELDS_SQL = """
, m AS (SELECT topic, value FROM pe UNION ALL SELECT topic, value FROM ce UNION ALL SELECT topic, value FROM oe),
d AS (SELECT topic, CAST(value AS JSON) AS doc FROM m WHERE json_valid(value) AND json_type(value) = 'OBJECT'),
k AS (SELECT topic, doc, unnest(json_keys(doc)) AS field FROM d),
t AS (SELECT topic, field, json_type(doc, '$.' || field) AS kind FROM k),
c AS (SELECT topic, field, count(*) AS present, count(*) FILTER (kind = 'NULL') AS nulls, count(*) FILTER (kind <> 'NULL') AS nn, count(*) FILTER (kind IN ('BIGINT', 'UBIGINT')) AS w, count(*) FILTER (kind = 'DOUBLE') AS f,
  count(*) FILTER (kind = 'BOOLEAN') AS b, count(*) FILTER (kind = 'OBJECT') AS o, count(*) FILTER (kind = 'ARRAY') AS a FROM t GROUP BY topic, field),
ft AS (SELECT topic, field, present, nulls, CASE WHEN nn = 0 THEN 'STRING' WHEN w = nn THEN 'BIGINT' WHEN w + f = nn THEN 'DOUBLE' WHEN b = nn THEN 'BOOLEAN' WHEN o = nn THEN 'OBJECT' WHEN a = nn THEN 'ARRAY' ELSE 'STRING' END AS type FROM c)
"""


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = src.page_event_envelopes(spark, sf_dir).select("topic", "value")
    for make in (src.commerce_envelopes, src.order_envelopes):
        messages = messages.unionByName(make(spark, sf_dir).select("topic", "value"))
    return schemas.field_table(messages)


@query("infer_schema", sql(PE, CE, OE, select=_FIELDS_SQL + "SELECT topic, field, present, nulls, type FROM ft"))
def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(spark, sf_dir)


@query(
    "schema_compat",
    sql(PE, CE, OE, select=_FIELDS_SQL + """
    , q AS (SELECT topic, field, type, nulls = 0 AND present = max(present) OVER (PARTITION BY topic) AS required FROM ft),
    a AS (SELECT * FROM q WHERE topic = 'page.events.v1'), b AS (SELECT * FROM q WHERE topic = 'commerce.events.v1'),
    j AS (SELECT coalesce(a.field, b.field) AS field, a.type AS old_type, b.type AS new_type, a.required AS old_required, b.required AS new_required FROM a FULL JOIN b ON a.field = b.field),
    v AS (SELECT *, CASE WHEN old_type IS NULL THEN NOT new_required WHEN new_type IS NULL THEN true ELSE new_type = old_type OR (new_type = 'DOUBLE' AND old_type = 'BIGINT') END AS backward,
      CASE WHEN new_type IS NULL THEN NOT old_required WHEN old_type IS NULL THEN true ELSE new_type = old_type OR (old_type = 'DOUBLE' AND new_type = 'BIGINT') END AS forward FROM j)
    SELECT field, old_type, new_type, CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed' WHEN old_type <> new_type THEN 'changed' ELSE 'same' END AS change, backward, forward, backward AND forward AS "full" FROM v"""),
)
def schema_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Could readers of page events and of commerce events swap topics?"""
    fields = _fields(spark, sf_dir)
    most = F.max("present").over(Window.partitionBy("topic"))
    table = fields.withColumn("required", (F.col("nulls") == 0) & (F.col("present") == most))
    return schemas.compatibility(table.filter("topic = 'page.events.v1'"), table.filter("topic = 'commerce.events.v1'"))


@query("inferred_type", sql(OE, select=_FIELDS_SQL.replace("SELECT topic, value FROM pe UNION ALL SELECT topic, value FROM ce UNION ALL ", "") + "SELECT field, type FROM ft"))
def inferred_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged nested type of all order messages, as a table of its top-level fields."""
    schema = schemas.to_struct_type(schemas.inferred_ddl(src.order_envelopes(spark, sf_dir)).first()[0])
    names = {"struct": "OBJECT", "array": "ARRAY", "decimal": "DOUBLE"}
    rows = [(f.name, names.get(f.dataType.typeName(), f.dataType.simpleString().upper())) for f in schema.fields]
    return spark.createDataFrame(rows, "field string, type string")


@query(
    "schema_evolve",
    sql(UC, CC, select="""
    , u AS (SELECT user_id, event_type, NULL AS amount, data FROM uc WHERE reject_rule IS NULL UNION ALL SELECT user_id, event_type, amount, NULL FROM cc WHERE reject_rule IS NULL)
    SELECT event_type, count(*) AS rows, count(amount) AS with_amount, count(data) AS with_data FROM u GROUP BY event_type"""),
)
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose later rows have columns the earlier ones lack."""
    old = r.accepted(checked_messages(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF)).select("rec.*")
    new = r.accepted(checked_messages(src.commerce_envelopes(spark, sf_dir), COMMERCE_EVENTS, AS_OF_2001)).select("rec.*")
    return schemas.evolve(old, new).groupBy("event_type").agg(F.count("*").alias("rows"), F.count("amount").alias("with_amount"), F.count("data").alias("with_data"))


# ---- duplicates and table checks ------------------------------------------------------------


@query(
    "duplicate_report",
    sql(UP, select="""
    , x AS (SELECT * FROM up WHERE parse_error IS NULL UNION ALL SELECT * FROM up WHERE parse_error IS NULL AND "offset" % 100 = 0),
    y AS (SELECT nullif(coalesce('user_' || user_id, '') || coalesce('_' || ms, ''), '') AS key, topic || '/' || partition || '/' || "offset" AS position FROM x),
    z AS (SELECT count(*) AS total_messages, count(DISTINCT key) AS unique_messages, count(DISTINCT position) AS unique_offsets, count(key) AS keyed FROM y)
    SELECT total_messages, unique_messages, unique_offsets, keyed - unique_messages AS duplicate_messages, round((keyed - unique_messages) / total_messages, 8) AS duplicate_rate, keyed - unique_messages <= total_messages // 100 AS passed FROM z"""),
)
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsed_only(parse(src.user_events_with_replays(spark, sf_dir), USER_EVENTS, AS_OF))
    flat = rows.select("rec.user_id", "rec.timestamp", "topic", "partition", "offset")
    return dedup.duplicate_report(flat, dedup.POSITION).withColumn("duplicate_rate", F.round("duplicate_rate", 8))


@query(
    "fingerprint_dedup",
    sql(UP, select=r"""
    , x AS (SELECT topic, partition, "offset", value FROM up UNION ALL SELECT topic, partition, "offset", value FROM up WHERE "offset" % 100 = 0),
    y AS (SELECT *, sha256(CASE WHEN (value LIKE '{%' OR value LIKE '[%') AND json_valid(value) THEN regexp_replace(value, '("(?:[^"\\]|\\.)*")|[ \t\r\n]+', '\1', 'g') ELSE value END) AS fingerprint FROM x),
    w AS (SELECT *, row_number() OVER (PARTITION BY topic, fingerprint ORDER BY partition, "offset") AS rn, count(*) OVER (PARTITION BY topic, fingerprint) AS copies FROM y)
    SELECT topic, fingerprint, partition, "offset", copies FROM w WHERE rn = 1"""),
)
def fingerprint_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second deliveries are laid out differently but mean the same."""
    twice = src.user_events_with_replays(spark, sf_dir)
    loose = F.when((F.col("delivery") == 2) & F.col("value").endswith("}"), F.concat(F.lit(" "), F.replace("value", F.lit('":'), F.lit('" :  ')), F.lit("\n"))).otherwise(F.col("value"))
    laid_out = twice.withColumn("value", loose).select("topic", "partition", "offset", "value")
    return dedup.dedup_content(laid_out, ["topic"]).select("topic", "fingerprint", "partition", "offset", "copies")


@query(
    "canonical_documents",
    r"""SELECT doc_id, length(trim(text, chr(9) || chr(10) || chr(13) || ' ')) AS canonical_length, sha256(trim(text, chr(9) || chr(10) || chr(13) || ' ')) AS fingerprint FROM documents""",
)
def canonical_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of long free texts, whole."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", canonical_text(F.col("text")).alias("text"))
    return docs.select("doc_id", F.length("text").cast("bigint").alias("canonical_length"), F.sha2("text", 256).alias("fingerprint"))


@query(
    "metadata_quality",
    sql(UP, select="""SELECT count(*) AS total_rows, count(*) FILTER ("offset" % 7 <> 0) AS with_metadata, count(*) FILTER ("offset" % 7 <> 0) AS complete_metadata, count(*) FILTER ("offset" % 7 <> 0) AS expected_version,
    count(*) FILTER ("offset" % 7 <> 0) AS iso_timestamp, count(*) FILTER (doc IS NOT NULL) AS with_original_data FROM up2"""),
)
def metadata_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines of which every seventh offset was written without metadata."""
    records = e.with_record_metadata(src.user_event_envelopes(spark, sf_dir), AS_OF)
    line = F.when(F.col("offset") % 7 == 0, F.col("value")).otherwise(F.col("record"))
    return quality.metadata_quality(records.select(line.alias("value")))


_FILES_SQL = """
p0 AS (SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'user-events' WHEN 1 THEN 'order-events' ELSE 'audit' END AS t, o_orderdate AS d, left(md5(CAST(o_orderkey AS VARCHAR)), 8) AS h FROM orders),
p AS (SELECT k, 'topics/' || t || CASE WHEN k % 5 < 2 THEN strftime(d, '/year=%Y/month=%m/day=%d/hour=%H') WHEN k % 5 < 4 THEN '/partition=' || (k % 6) ELSE '' END || '/' ||
  CASE WHEN k % 11 = 3 THEN 'part-' || k || '.json' ELSE strftime(d, '%Y%m%dT%H%M%S') || '000_' || h || '.jsonl' END AS path FROM p0)
"""


@query(
    "path_classify",
    sql(_FILES_SQL, select=r"""
    , m AS (SELECT path, CASE WHEN regexp_matches(path, '/(user-events|order-events)/year=\d{4}/month=\d{2}/day=\d{2}/hour=\d{2}/[^/]*\.jsonl$') THEN 'time-based' WHEN regexp_matches(path, '/(user-events|order-events)/partition=\d+/[^/]*\.jsonl$') THEN 'default' ELSE 'other' END AS layout,
      CASE WHEN path LIKE '%user-events%' THEN 'user-events' WHEN path LIKE '%order-events%' THEN 'order-events' END AS path_topic, regexp_extract(path, '\.([^./]*)$', 1) AS extension,
      regexp_extract(path, '^(.*)/[^/]*$', 1) AS directory, regexp_matches(path, '/\d{8}T\d{6}[^/]*_[a-f0-9]{8}\.jsonl$') AS valid_name FROM p)
    SELECT layout, path_topic, extension, count(*) AS files, count(DISTINCT directory) AS directories, count(*) FILTER (valid_name) AS valid_names, round(count(*) FILTER (valid_name) / count(*), 6) AS valid_share,
      count(*) FILTER (valid_name) / count(*) > 0.8 AS names_ok FROM m GROUP BY ALL"""),
)
def path_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    topic = F.when(k % 3 == 0, F.lit("user-events")).when(k % 3 == 1, F.lit("order-events")).otherwise(F.lit("audit"))
    folder = F.when(k % 5 < 2, F.date_format(d, "'/year='yyyy'/month='MM'/day='dd'/hour='HH")).when(k % 5 < 4, F.concat(F.lit("/partition="), (k % 6).cast("string"))).otherwise(F.lit(""))
    name = F.when(k % 11 == 3, F.concat(F.lit("part-"), k.cast("string"), F.lit(".json"))).otherwise(
        F.concat(F.date_format(d, "yyyyMMdd'T'HHmmss"), F.lit("000_"), F.left(F.md5(k.cast("string")), F.lit(8)), F.lit(".jsonl"))
    )
    files = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.concat(F.lit("topics/"), topic, folder, F.lit("/"), name).alias("path"))
    return quality.path_report(files, ("user-events", "order-events"))


# ---- maintenance ----------------------------------------------------------------------------

TABLES = tuple(t.destination.location() for t in (USER_EVENTS, ORDER_EVENTS, COMMERCE_EVENTS)) + ("s3a://data-lake/unknown",)


def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One commit per order; a few of them compactions and vacuums."""
    k = F.col("o_orderkey")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.element_at(F.array(*[F.lit(t) for t in TABLES]), (F.col("o_custkey") % 4 + 1).cast("int")).alias("table_path"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(k % 80000).cast("decimal(18,6)"))).cast("timestamp").alias("committed_at"),
        F.when(k % 97 == 0, F.lit("OPTIMIZE")).when(k % 211 == 0, F.lit("VACUUM")).otherwise(F.lit("WRITE")).alias("operation"),
    )


_HISTORY_SQL = f"""
h AS (SELECT (['{"', '".join(TABLES)}'])[CAST(o_custkey % 4 AS INTEGER) + 1] AS table_path, o_orderdate + to_seconds(CAST(o_orderkey % 80000 AS INTEGER)) AS at_time,
  CASE WHEN o_orderkey % 97 = 0 THEN 'OPTIMIZE' WHEN o_orderkey % 211 = 0 THEN 'VACUUM' ELSE 'WRITE' END AS operation FROM orders),
runs AS (SELECT table_path, max(at_time) FILTER (operation = 'OPTIMIZE') AS lo, max(at_time) FILTER (operation = 'VACUUM') AS lv FROM h GROUP BY table_path),
stats AS (SELECT r.table_path, count(*) FILTER (operation = 'WRITE' AND (lo IS NULL OR at_time > lo)) AS batches, any_value(lo) AS lo, any_value(lv) AS lv FROM runs r JOIN h ON h.table_path = r.table_path GROUP BY r.table_path),
settings(table_path, opt, every, vac, keep) AS (VALUES ('{TABLES[0]}', true, 10, false, 168), ('{TABLES[1]}', true, 5, true, 168), ('{TABLES[2]}', true, 10, false, 168))
"""


@query("maintenance_stats", sql(_HISTORY_SQL, select="SELECT table_path, batches AS batches_since_optimize, epoch_us(lo) // 1000 AS last_optimize_ms, epoch_us(lv) // 1000 AS last_vacuum_ms FROM stats"))
def maintenance_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = maintenance.maintenance_stats(commit_history(spark, sf_dir))
    return stats.select(
        "table_path", "batches_since_optimize", F.unix_millis("last_optimize").alias("last_optimize_ms"), F.unix_millis("last_vacuum").alias("last_vacuum_ms")
    )


@query("optimize_due", sql(_HISTORY_SQL, select="SELECT table_path, batches AS batches_since_optimize, every AS optimize_interval, opt AND batches >= every AS due FROM stats JOIN settings USING (table_path)"))
def optimize_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.optimize_due(maintenance.maintenance_stats(commit_history(spark, sf_dir)), topic_table(spark))


@query(
    "vacuum_due",
    sql(_HISTORY_SQL, select="""SELECT table_path, epoch_us(lv) // 1000 AS last_vacuum_ms, keep AS vacuum_retention_hours, vac AND (lv IS NULL OR 996710400000 - epoch_us(lv) // 1000 >= keep * 3600000) AS due
    FROM stats JOIN settings USING (table_path)"""),
)
def vacuum_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = maintenance.vacuum_due(maintenance.maintenance_stats(commit_history(spark, sf_dir)), topic_table(spark), AS_OF_2001)
    return due.withColumn("last_vacuum_ms", F.unix_millis("last_vacuum")).drop("last_vacuum")


def file_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One data file per order in monthly partitions; the price in cents is its size."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    table = F.element_at(F.array(*[F.lit(t) for t in TABLES]), (F.col("o_custkey") % 4 + 1).cast("int"))
    partition = F.date_format(d, "'year='yyyy'/month='MM")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        table.alias("table_path"),
        partition.alias("partition"),
        F.concat(table, F.lit("/"), partition, F.format_string("/part-%09d.parquet", k)).alias("path"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size"),
        d.cast("timestamp").alias("modified_at"),
        (F.col("o_orderstatus") != "F").alias("is_live"),
    )


_FILE_TABLE_SQL = f"""
ft0 AS (SELECT *, (['{"', '".join(TABLES)}'])[CAST(o_custkey % 4 AS INTEGER) + 1] AS table_path, strftime(o_orderdate, 'year=%Y/month=%m') AS part FROM orders),
ft AS (SELECT table_path, part, table_path || '/' || part || printf('/part-%09d.parquet', o_orderkey) AS path, CAST(round(o_totalprice * 100) AS BIGINT) AS size, o_orderdate AS modified, o_orderstatus <> 'F' AS live FROM ft0)
"""


@query(
    "compaction_plan",
    sql(_FILE_TABLE_SQL, select="""
    , g AS (SELECT * FROM ft WHERE size < 40000000)
    SELECT table_path, part AS partition, path, size, CAST(coalesce(sum(size) OVER (PARTITION BY table_path, part ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 40000000 AS bin_no FROM g"""),
)
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.compaction_plan(file_table(spark, sf_dir), target_bytes=40_000_000)


@query(
    "compaction_bins",
    sql(_FILE_TABLE_SQL, select="""
    , g AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY table_path, part ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 134217728 AS bin_no FROM ft)
    SELECT table_path, part AS partition, bin_no, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM g GROUP BY table_path, part, bin_no HAVING count(*) > 1"""),
)
def compaction_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.bins_to_merge(maintenance.compaction_plan(file_table(spark, sf_dir)))


@query(
    "vacuum_candidates",
    sql(_FILE_TABLE_SQL, select="SELECT table_path, path, size FROM ft WHERE NOT live AND modified < TIMESTAMP '2001-07-26 00:00:00'"),
)
def vacuum_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = file_table(spark, sf_dir)
    old = maintenance.vacuum_candidates(files, files.filter("is_live"), AS_OF_2001)
    return old.select("table_path", "path", "size")
