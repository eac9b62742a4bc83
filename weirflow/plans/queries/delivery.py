"""Delivery: flush boundaries, many destinations, breakers in the flow, indexes and ledgers over jobs."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.config import COMMERCE_EVENTS, DESTINATION, ORDER_EVENTS, USER_EVENTS
from weirflow.functions import keys
from weirflow.functions.breaker import BreakerSettings
from weirflow.operators import breaker, enrich, lattice, quality, retries, seen, sinks, sketches
from weirflow.operators.dlq import dlq_envelope
from weirflow.operators.flushes import flush_boundaries
from weirflow.plans import ledger
from weirflow.plans.flow import DLQ_PATH, accepted_rows, dead_letters, write_messages
from weirflow.plans.queries.messages_sql import CE, OP, PE, UC, UE, sql
from weirflow.plans.queries.registry import AS_OF, AS_OF_2001, query
from weirflow.plans.queries.reliability import _ERRORS_SQL, error_log, replay_sql
from weirflow.session import scratch_path, stored
from weirflow.sources import envelopes as src
from weirflow.streaming.ingest import ALL_AVAILABLE, ingest

# ---- flushes --------------------------------------------------------------------------------

FLUSH_ROWS, FLUSH_MS = 8, 14_400_000  # small, so that small tables have flushes of both causes


@query(
    "flush_boundaries",
    f"""
    WITH RECURSIVE {UE.strip()},
    m AS (SELECT row_number() OVER (ORDER BY ts, partition, "offset") AS pos, epoch_us(ts) // 1000 AS at_ms, partition AS k FROM ue),
    f AS (SELECT pos, lead(pos, {FLUSH_ROWS - 1}) OVER (PARTITION BY k ORDER BY pos) AS filled FROM m),
    s AS (SELECT pos - 1 AS pos, min(filled) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS by_size FROM f),
    c AS (SELECT pos, at_ms FROM m UNION ALL SELECT 0, min(at_ms) FROM m),
    d AS (SELECT pos, at_ms + {FLUSH_MS} AS at_ms, 0 AS is_row FROM c UNION ALL SELECT pos, at_ms, 1 FROM m),
    w AS (SELECT pos, is_row, 1 + sum(is_row) OVER (ORDER BY at_ms, is_row ROWS UNBOUNDED PRECEDING) AS due FROM d),
    p AS (SELECT c.pos, s.by_size, CASE WHEN w.due <= (SELECT max(pos) FROM m) THEN w.due END AS by_time FROM c JOIN w ON w.pos = c.pos AND w.is_row = 0 LEFT JOIN s ON s.pos = c.pos),
    run(flush_no, after_pos, last_pos, cause) AS (
      SELECT CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), ''
      UNION ALL
      SELECT flush_no + 1, last_pos, CAST(coalesce(least(by_size, by_time), (SELECT max(pos) FROM m)) AS BIGINT),
        CASE WHEN by_size <= coalesce(by_time, by_size) THEN 'size' WHEN by_time IS NOT NULL THEN 'time' ELSE 'stop' END
      FROM run JOIN p ON p.pos = run.last_pos WHERE last_pos < (SELECT max(pos) FROM m))
    SELECT flush_no, CAST(last_pos - after_pos AS BIGINT) AS rows, cause, a.at_ms AS first_ms, b.at_ms AS last_ms
    FROM run JOIN m a ON a.pos = after_pos + 1 JOIN m b ON b.pos = last_pos WHERE flush_no >= 0""",
)
def flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a writer of the user events flushes that holds 8 rows a directory or four hours."""
    messages = src.user_event_envelopes(spark, sf_dir)
    return flush_boundaries(messages, keys.partition_key("DEFAULT", AS_OF), "timestamp", ["partition", "offset"], FLUSH_ROWS, FLUSH_MS)


# ---- many destinations ----------------------------------------------------------------------

MANY = 200


def many_topics(n: int = MANY):
    """``n`` topics with the settings of the user events and a table each."""
    return tuple(
        replace(USER_EVENTS, name=f"user-events-{k}", topic=f"user.events.{k}", destination=replace(USER_EVENTS.destination, path=f"events/user-{k}", table_name=f"user_events_{k}"))
        for k in range(n)
    )


def many_messages(spark: SparkSession, sf_dir: str, n: int = MANY) -> DataFrame:
    """The user events, dealt by their key to more topics than are configured."""
    number = F.col("key").cast("bigint") % (n + 3)
    return src.user_event_envelopes(spark, sf_dir).withColumn("topic", F.concat(F.lit("user.events."), number.cast("string")))


@query(
    "many_destinations",
    sql(UC, select=f"""
    , t AS (SELECT CAST(key AS BIGINT) % {MANY + 3} AS k, reject_rule FROM uc)
    SELECT CASE WHEN k >= {MANY} THEN 'unrouted' WHEN reject_rule IS NULL THEN 'table' ELSE 'dead letter' END AS output, 'user.events.' || k AS topic, count(*) AS messages FROM t GROUP BY ALL"""),
)
def many_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two hundred tables and the dead letters hold after one batch, read back from the files."""
    root, topics = scratch_path(spark, "many"), many_topics()
    write_messages(many_messages(spark, sf_dir), root, 1, topics, AS_OF)
    rows = spark.read.option("basePath", root).parquet(f"{root}/{DESTINATION}=*")
    tables = rows.groupBy(F.lit("table").alias("output"), F.col("_kafka_topic").alias("topic")).agg(F.count("*").alias("messages"))
    kind = F.when(F.col("error_reason") == "route", "unrouted").otherwise("dead letter")
    letters = sinks.read_table(spark, f"{root}/{DLQ_PATH}").groupBy(kind.alias("output"), F.col("original_topic").alias("topic")).agg(F.count("*").alias("messages"))
    return tables.union(letters)


# ---- ledgers of an ingestion ----------------------------------------------------------------


@query(
    "ingest_runs",
    sql(UC, PE, select="""SELECT topic, true AS success, count(*) AS processed, count(reject_rule) AS failed, count(*) - count(reject_rule) AS table_rows FROM uc GROUP BY topic
    UNION ALL SELECT topic, true, count(*), count(*), 0 FROM pe GROUP BY topic"""),
)
def ingest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is stopped after its first files and started again; what its runs say of each topic, and
    what the table holds."""
    landing, root, checkpoint = (scratch_path(spark, n) for n in ("landing", "lake", "offsets"))
    messages = stored(src.user_event_envelopes(spark, sf_dir).unionByName(src.page_event_envelopes(spark, sf_dir)), "messages")
    for part in range(2):
        before = len(spark.read.schema(src.ENVELOPE).parquet(landing).inputFiles()) if part else 0
        # As many files as the messages need, so that no few tasks write or read them; a run takes half of them at a time.
        messages.filter(F.col("offset") % 2 == part).hint("rebalance").write.mode("append").parquet(landing)
        landed = len(spark.read.schema(src.ENVELOPE).parquet(landing).inputFiles()) - before
        stream = src.file_stream(spark, landing, max_files=max(1, -(-landed // 2)))
        ingest(stream, root, checkpoint, (USER_EVENTS,), AS_OF, ALL_AVAILABLE).awaitTermination()
    runs = ledger.run_results(spark, root).groupBy("topic", "success").agg(F.sum("processed").alias("processed"), F.sum("failed").alias("failed"))
    rows = sinks.read_table(spark, USER_EVENTS.destination.location(root)).groupBy(F.col("_kafka_topic").alias("topic")).agg(F.count("*").alias("table_rows"))
    return runs.join(rows, "topic", "left").withColumn("table_rows", F.coalesce("table_rows", F.lit(0)))


@query(
    "file_ledger",
    sql(UC, select="SELECT 'user_events' AS table_name, 2 AS batches, count(*) AS rows, true AS as_listed, true AS optimized, count(*) AS compacted_rows FROM uc WHERE reject_rule IS NULL"),
)
def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second of which makes a compaction due: the ledger's files against a listing."""
    root = scratch_path(spark, "lake")
    place = replace(USER_EVENTS.destination, options=replace(USER_EVENTS.destination.options, optimize_interval=2))
    topics = (replace(USER_EVENTS, destination=place),)
    messages = src.user_event_envelopes(spark, sf_dir)
    done = {}
    for batch in range(2):
        write_messages(messages.filter(F.col("offset") % 2 == batch), root, batch, topics, AS_OF)
        done = ledger.after_flush(spark, root, batch, topics, AS_OF + dt.timedelta(minutes=batch))
    known = ledger.inventory(spark, root, place.table_name)
    listed = sinks.file_inventory(spark, place.location(root)).filter(F.col("path").endswith(".parquet"))
    differ = known.select("path", "size").exceptAll(listed.select("path", "size")).union(listed.select("path", "size").exceptAll(known.select("path", "size")))
    batches = F.countDistinct(F.regexp_extract("path", rf"/{sinks.BATCH}=(\d+)/", 1)).cast("int")
    compacted = sinks.read_table(spark, f"{root}/compacted/{place.table_name}").agg(F.count("*").alias("compacted_rows"))
    return (
        known.agg(F.lit(place.table_name).alias("table_name"), batches.alias("batches"), F.sum("rows").alias("rows"))
        .join(differ.agg((F.count("*") == 0).alias("as_listed")), F.lit(True))  # one row each
        .withColumn("optimized", F.lit(done.get(place.table_name, {}).get("OPTIMIZE", False)))
        .join(compacted, F.lit(True))
    )


# ---- an index of contents over jobs ---------------------------------------------------------

_FINGERPRINT = r"""sha256(CASE WHEN (value LIKE '{%' OR value LIKE '[%') AND json_valid(value) THEN regexp_replace(value, '("(?:[^"\\]|\\.)*")|[ \t\r\n]+', '\1', 'g') ELSE value END)"""


@query(
    "dedup_against_index",
    sql(UE, select=f"""
    , f AS (SELECT topic, "offset", coalesce({_FINGERPRINT}, '') AS fp FROM ue),
    g AS (SELECT topic, fp, bool_or("offset" % 3 <> 0) AS early FROM f GROUP BY ALL)
    SELECT topic, 1 AS job, count(*) FILTER (early) AS contents FROM g GROUP BY topic
    UNION ALL SELECT topic, 2, count(*) FILTER (NOT early) FROM g GROUP BY topic
    UNION ALL SELECT topic, 3, 0 FROM g GROUP BY topic UNION ALL SELECT topic, 4, count(*) FROM g GROUP BY topic"""),
)
def dedup_against_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four jobs over deliveries that overlap: the first has two thirds of the messages, the others have all,
    the third one laid out in another way; the last one comes when the index has forgotten the others."""
    index = scratch_path(spark, "index")
    messages = stored(src.user_events_with_replays(spark, sf_dir).drop("delivery", "headers"), "deliveries")
    loose = F.when(F.col("value").endswith("}") & F.try_parse_json("value").isNotNull(), F.concat(F.lit(" "), "value", F.lit("\n"))).otherwise(F.col("value"))
    jobs = (
        (messages.filter(F.col("offset") % 3 != 0), AS_OF),
        (messages, AS_OF + dt.timedelta(days=1)),
        (messages.withColumn("value", loose), AS_OF + dt.timedelta(days=2)),
        (messages, AS_OF + dt.timedelta(days=30)),
    )
    counts = []
    for number, (delivered, at) in enumerate(jobs, 1):
        taken = seen.take_in(delivered, index, number, at)
        counts.append(taken.groupBy("topic").agg(F.lit(number).alias("job"), F.count("*").alias("contents")))
    topics = messages.select("topic").distinct()
    out = topics.select("topic", F.explode(F.sequence(F.lit(1), F.lit(len(jobs)))).alias("job"))
    found = counts[0]
    for part in counts[1:]:
        found = found.union(part)
    return out.join(found, ["topic", "job"], "left").select("topic", "job", F.coalesce("contents", F.lit(0)).alias("contents"))


# ---- retries of dead letters ----------------------------------------------------------------

_RELAXED = "reject_rule IN ('product_required', 'event_type_format') AND regexp_full_match(user_id, '[a-zA-Z0-9-]{8,}') AND ms >= 1706745600000 - 157680000000"


@query(
    "retry_ledger",
    sql(UC, select=f"""
    , l AS (SELECT *, coalesce({_RELAXED}, false) AS mends, CAST('0x' || left(md5(topic || '/' || partition || '/' || "offset" || ':1'), 8) AS BIGINT) / 4294967296.0::DOUBLE AS draw FROM uc WHERE reject_rule IS NOT NULL),
    d AS (SELECT *, 1000 + CAST(trunc(250 * (draw - 0.5::DOUBLE)) AS BIGINT) <= 1000 AS early FROM l),
    r AS (SELECT 1 AS round, 1 AS attempt, 'still_failing' AS outcome FROM d
      UNION ALL SELECT 2, 2, CASE WHEN mends THEN 'accepted' ELSE 'still_failing' END FROM d WHERE early
      UNION ALL SELECT 3, CASE WHEN early THEN 3 ELSE 2 END, CASE WHEN mends THEN 'accepted' WHEN early THEN 'given_up' ELSE 'still_failing' END FROM d WHERE NOT (early AND mends)
      UNION ALL SELECT 4, 3, 'given_up' FROM d WHERE NOT early AND NOT mends)
    SELECT round, attempt, outcome, count(*) AS letters FROM r GROUP BY ALL"""),
)
def retry_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rounds over the dead letters: at once and under the old rules, after a second (when part of them is
    due) and twice much later under relaxed ones.  The third round runs twice, as after a crash."""
    path = scratch_path(spark, "retries")
    letters = stored(dead_letters(src.user_event_envelopes(spark, sf_dir), USER_EVENTS, AS_OF), "letters")
    relaxed = replace(USER_EVENTS, rules=replace(USER_EVENTS.rules, event_type_pattern=r"^[A-Za-z_]+\z", product_types=("NONE",)))
    rounds = ((1, USER_EVENTS, 0), (2, relaxed, 1), (3, relaxed, 3600), (3, relaxed, 3600), (4, relaxed, 7200))
    for number, rules, seconds in rounds:
        retries.retry_round(letters, path, number, rules, AS_OF + dt.timedelta(seconds=seconds))
    return retries.ledger_rows(spark, path).groupBy("round", "attempt", "outcome").agg(F.count("*").alias("letters"))


# ---- breakers in the flow -------------------------------------------------------------------

_ERROR_CALLS = f"""{_ERRORS_SQL.strip()},
calls AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'topic-main' ELSE 'topic-' || (user_id % 9) END AS service, event_id AS call_id, epoch_us(ts) // 1000 AS at_ms, event_type IN ('error', 'click') AS failed,
  regexp_matches(lm, 'schema|unauthorized|authentication') OR regexp_matches(lower(c), 'security|validation') OR lower(c) = 'nonretriableexception' AS trips FROM events JOIN el USING (event_id))
"""


def topic_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of ten topics, one with a third of them; what the listener met is in the log of errors."""
    u = F.col("user_id")
    topic = F.when(u % 3 == 0, F.lit("topic-main")).otherwise(F.concat(F.lit("topic-"), (u % 9).cast("string")))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        topic.alias("service"), F.col("event_id").alias("call_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"), F.col("event_type").isin("error", "click").alias("failed")
    )


def _listener_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = topic_calls(spark, sf_dir)
    errors_met = error_log(spark, sf_dir).withColumnRenamed("event_id", "call_id")
    marked = breaker.with_trips(calls, errors_met)
    # Two batches: the second begins where the breakers of the first stood.
    settings = BreakerSettings(failure_threshold=5, open_ms=3_600_000)
    half = marked.agg(F.expr("percentile_approx(at_ms, 0.5)").alias("half"))
    cut = marked.join(F.broadcast(half), F.lit(True))  # one row
    early, late = (stored(cut.filter(c).drop("half"), "calls") for c in ("at_ms < half", "at_ms >= half"))
    ends = stored(breaker.breaker_ends(early, settings), "breakers")
    return breaker.breaker_replay(early, settings).union(breaker.breaker_replay(late, settings, before=ends))


@query("topic_breaker_errors", replay_sql(3_600_000, "trips", _ERROR_CALLS))
def topic_breaker_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listener's breakers fed by the log of errors, over two batches."""
    return _listener_replay(spark, sf_dir)


@query(
    "breaker_letters",
    f"""WITH replayed AS ({replay_sql(3_600_000, "trips", _ERROR_CALLS)})
    SELECT service AS original_topic, service || '-dlq' AS dlq_topic, 'breaker_open' AS error_reason, count(*) AS letters FROM replayed WHERE NOT allowed GROUP BY service""",
)
def breaker_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that met an open breaker, as dead letters."""
    replayed = stored(_listener_replay(spark, sf_dir), "replayed")
    n = F.col("event_id")
    messages = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("user_id", "_u").select(
        n.alias("call_id"),
        F.when(F.col("_u") % 3 == 0, F.lit("topic-main")).otherwise(F.concat(F.lit("topic-"), (F.col("_u") % 9).cast("string"))).alias("topic"),
        (n % 8).cast("int").alias("partition"), F.floor(n / 8).alias("offset"), F.col("_u").cast("string").alias("key"), F.col("props").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"),
    )
    letters = dlq_envelope(breaker.blocked_messages(messages, replayed), AS_OF)
    return letters.groupBy("original_topic", "dlq_topic", "error_reason").agg(F.count("*").alias("letters"))


# ---- sketches -------------------------------------------------------------------------------

QUANTILES = (0.5, 0.9, 0.95, 0.99)
RANK_ERROR, COUNT_ERROR = 0.02, 0.05  # beyond the sketches' stated errors


@query(
    "latency_rollup",
    """SELECT event_type AS operation, CAST(q.quantile AS DOUBLE) AS quantile, count(*) AS samples, true AS rolled_up, true AS direct
    FROM events, (SELECT unnest([0.5, 0.9, 0.95, 0.99]) AS quantile) q GROUP BY ALL""",
)
def latency_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the whole period merged from sketches of five minutes, and from sketches of the whole: whether
    the exact ranks of both lie within the stated error."""
    timings = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("operation"), "value", F.col("ts").cast("timestamp").alias("ts"))
    short = stored(sketches.quantile_sketches(timings, ["operation"], F.window("ts", "5 minutes")["start"], "value"), "sketches")
    daily = sketches.merged_quantiles(short, ["operation"], F.date_trunc("day", "window_start"))
    rolled = sketches.quantiles_of(sketches.merged_quantiles(daily, ["operation"]), QUANTILES).withColumnRenamed("value", "rolled")
    whole = sketches.quantile_sketches(timings, ["operation"], F.lit(0), "value").drop("window_start")
    both = rolled.join(sketches.quantiles_of(whole, QUANTILES).select("operation", "quantile", F.col("value").alias("whole")), ["operation", "quantile"])
    ranked = timings.join(F.broadcast(both), "operation").groupBy("operation", "quantile", F.col("n").alias("samples"))  # a row an operation and quantile
    near = lambda c: F.abs(F.count_if(F.col("value") <= F.col(c)) / F.count("*") - F.col("quantile")) <= RANK_ERROR + 1 / F.count("*")
    return ranked.agg(near("rolled").alias("rolled_up"), near("whole").alias("direct"))


@query(
    "activity_sketches",
    """
    WITH l AS (SELECT 'events.' || event_type AS topic, user_id, ts < TIMESTAMP '2024-01-16' AS first FROM events),
    u AS (SELECT topic, user_id, bool_or(first) AS a, bool_or(NOT first) AS b, count(*) AS n FROM l GROUP BY ALL)
    SELECT topic, CAST(sum(n) AS BIGINT) AS messages, count(*) AS users, count(*) FILTER (a AND b) AS in_both, true AS users_close, true AS in_both_close FROM u GROUP BY topic""",
)
def activity_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each topic over the whole log, and of both its halves, from sketches of an hour, beside the
    exact counts."""
    log = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.concat(F.lit("events."), "event_type").alias("topic"), "user_id", F.col("ts").cast("timestamp").alias("ts"))
    hours = stored(sketches.distinct_sketches(log, ["topic"], F.date_trunc("hour", "ts"), "user_id"), "sketches")
    cut = F.lit(dt.datetime(2024, 1, 16))
    whole = sketches.union_of(hours, ["topic"]).select("topic", F.col("rows").alias("messages"), F.theta_sketch_estimate("sketch").alias("estimate"))
    halves = [sketches.union_of(hours.filter(c), ["topic"]) for c in (F.col("window_start") < cut, F.col("window_start") >= cut)]
    common = sketches.overlap(*halves, ["topic"]).select("topic", F.col("both").alias("both_estimate"))
    per_user = log.groupBy("topic", "user_id").agg(F.bool_or(F.col("ts") < cut).alias("a"), F.bool_or(F.col("ts") >= cut).alias("b"))
    exact = per_user.groupBy("topic").agg(F.count("*").alias("users"), F.count_if(F.col("a") & F.col("b")).alias("in_both"))
    joined = exact.join(whole, "topic").join(common, "topic", "left")
    near = lambda a, b, of: F.abs(F.col(a) - F.coalesce(b, F.lit(0))) <= COUNT_ERROR * F.col(of) + 1
    return joined.select("topic", "messages", "users", "in_both", near("users", "estimate", "users").alias("users_close"), near("in_both", "both_estimate", "users").alias("in_both_close"))


# ---- schemas in depth -----------------------------------------------------------------------


def generations(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Order lines as three generations of a producer wrote them."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part, n = F.col("l_partkey"), F.col("l_linenumber")
    first = line.filter(n == 1).select(
        F.lit(1).alias("generation"), F.col("l_orderkey").cast("int").alias("id"), F.array(F.struct(part.cast("int").alias("part"), n.cast("int").alias("qty"))).alias("items"),
        F.struct(F.col("l_suppkey").cast("int").alias("id")).alias("seller"), F.struct(part.cast("int").alias("code")).alias("note"),
    )
    second = line.filter(n == 2).select(
        F.lit(2).alias("generation"), F.col("l_orderkey").cast("bigint").alias("id"),
        F.array(F.struct(F.col("l_quantity").cast("double").alias("qty"), part.cast("bigint").alias("part"), F.col("l_linestatus").alias("mode"))).alias("items"),
        F.struct(F.col("l_suppkey").cast("bigint").alias("id"), F.struct(F.col("l_returnflag").alias("flag")).alias("mark")).alias("seller"), F.create_map(F.lit("line"), n.cast("int")).alias("tags"),
    )
    third = line.filter(n > 2).select(F.lit(3).alias("generation"), F.concat(F.lit("o-"), "l_orderkey").alias("id"), F.concat_ws("-", "l_returnflag", "l_linestatus").alias("note"), F.create_map(F.lit("line"), n.cast("double")).alias("tags"))
    return [first, second, third]


@query(
    "schema_merge_nested",
    """
    WITH g AS (SELECT least(l_linenumber, 3) AS generation, CASE WHEN l_linenumber > 2 THEN 'o-' ELSE '' END || l_orderkey AS id, CASE WHEN l_linenumber < 3 THEN CAST(l_partkey AS BIGINT) END AS part,
        CASE l_linenumber WHEN 1 THEN 1.0 WHEN 2 THEN CAST(l_quantity AS DOUBLE) END AS qty, CASE l_linenumber WHEN 2 THEN l_linestatus END AS mode, CASE WHEN l_linenumber < 3 THEN l_suppkey END AS seller, CASE l_linenumber WHEN 2 THEN l_returnflag END AS flag,
        CASE WHEN l_linenumber = 1 THEN '{"code":' || l_partkey || '}' WHEN l_linenumber > 2 THEN l_returnflag || '-' || l_linestatus END AS note, CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS DOUBLE) END AS line FROM lineitem)
    SELECT CAST(generation AS INTEGER) AS generation, count(*) AS lines, min(id) AS first_id, CAST(sum(part) AS BIGINT) AS parts, sum(qty) AS qty, count(mode) AS modes, CAST(sum(seller) AS BIGINT) AS sellers, count(flag) AS flags, min(note) AS first_note, sum(line) AS line
    FROM g GROUP BY generation""",
)
def schema_merge_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations of files, whose ids, quantities and notes change their types and whose structs, arrays
    and maps change inside, read as one table."""
    paths = []
    for generation in generations(spark, sf_dir):
        paths.append(scratch_path(spark, "generation"))
        generation.write.parquet(paths[-1])
    table = lattice.merge_generations([spark.read.parquet(p) for p in paths])
    item = F.col("items")[0]
    return table.groupBy("generation").agg(
        F.count("*").alias("lines"), F.min("id").alias("first_id"), F.sum(item["part"]).alias("parts"), F.sum(item["qty"]).alias("qty"), F.count(item["mode"]).alias("modes"),
        F.sum("seller.id").alias("sellers"), F.count("seller.mark.flag").alias("flags"), F.min("note").alias("first_note"), F.sum(F.col("tags")["line"]).alias("line"),
    )


@query(
    "enhanced_records",
    sql(CE, OP, select="""SELECT 'commerce-events_enhanced' AS schema_name, 11 AS fields, count(*) AS records, count(*) AS in_place FROM ce UNION ALL SELECT 'order-events_enhanced', 9, count(*), count(*) FROM op"""),
)
def enhanced_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with metadata, read back by the schema that the metadata adds to: how many say where they lay."""
    out = []
    for topic, messages in ((COMMERCE_EVENTS, src.commerce_envelopes(spark, sf_dir)), (ORDER_EVENTS, src.order_envelopes(spark, sf_dir))):
        name, schema = enrich.enhanced_schema(topic.name, topic.schema)
        read = enrich.with_record_metadata(messages, AS_OF_2001).withColumn("read", F.from_json("record", schema))
        meta = F.col("read")["_metadata"]
        same = (meta["kafka_topic"] == F.col("topic")) & (meta["kafka_partition"] == F.col("partition")) & (meta["kafka_offset"] == F.col("offset"))
        out.append(read.agg(F.lit(name).alias("schema_name"), F.lit(len(schema)).alias("fields"), F.count("*").alias("records"), F.count_if(same).alias("in_place")))
    return out[0].union(out[1])


@query(
    "required_columns",
    sql(OP, select="""
    , n AS (SELECT * FROM oc WHERE reject_rule IS NULL),
    c AS (SELECT unnest(['order_id', 'customer_id', 'status', 'amount', 'timestamp', '_kafka_topic', '_kafka_partition', '_kafka_offset', 'year', 'month', 'day']) AS column_name)
    SELECT column_name, column_name NOT IN ('status', 'amount') AS present,
      CASE column_name WHEN 'order_id' THEN count(order_id) WHEN 'customer_id' THEN count(customer_id) WHEN 'status' THEN 0 WHEN 'amount' THEN 0 ELSE count(*) END AS filled FROM c, n GROUP BY column_name"""),
)
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that order tables should have: whether they are there, and in how many rows they hold a value."""
    return quality.column_report(accepted_rows(src.order_envelopes(spark, sf_dir), ORDER_EVENTS, AS_OF_2001), quality.ORDER_TABLE_COLUMNS)
