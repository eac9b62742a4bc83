"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.session import configure, scratch_path


def travels(module_name: str) -> None:
    """Send the functions of a module along with the tasks, so that executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for tables that every task needs."""
    holder = sys.modules.setdefault("_weirflow_worker", types.ModuleType("_weirflow_worker"))
    return holder.__dict__.setdefault(name, {})


def give_back() -> None:
    """What this worker no longer uses goes back to the machine; the C library would keep most of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def let_go() -> None:
    """What earlier tasks have left and this one has not asked for goes.  For steps that make nothing to keep:
    a worker that was busy with another stage would hold the things of that one beside theirs."""
    store, context = worker_store("things"), TaskContext.get()
    task = context.taskAttemptId() if context else None
    left = [k for k, (_, last) in store.items() if last != task]
    for old in left:
        del store[old]
    if left:
        give_back()


def made_once(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a worker.  Before something new is made, what earlier tasks have left
    and this one has not asked for goes, so a worker that serves many stages holds the things of one."""
    store, context = worker_store("things"), TaskContext.get()
    task = context.taskAttemptId() if context else None
    if key not in store:
        let_go()
        store[key] = (make(), task)
        give_back()  # what only the making needed
    thing = store[key][0]
    store[key] = (thing, task)
    return thing


def sent(spark: SparkSession, thing: object) -> Callable[[], object]:
    """``thing`` as a broadcast that brings the code of its class along; what is returned gives it back
    in a task.  A worker unpacks it once (see :func:`made_once`)."""
    held, name = spark.sparkContext.broadcast(cloudpickle.dumps(thing)), uuid.uuid4().hex

    def received() -> object:
        return made_once(name, lambda: pickle.loads(held.value))

    return received


travels(__name__)


# Rows and bytes that go to a Python worker at a time: texts are long, and their ids and window
# features longer.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "2m"}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators of this package want."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return configure(spark)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later passes see the same rows, at no
    further cost, also after executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that moves both sides by their keys, whatever size Spark takes them for.

    Spark sizes a table by its compressed files and does not count the rows that an explode makes, so it
    may send one through the driver that is many times larger than what its threshold allows.
    """
    return df.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` but for ``names``, whatever their case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def own_prefix(*tables: DataFrame) -> str:
    """A beginning that no column of ``tables`` has, for the names of helper columns."""
    names = [c for t in tables for c in t.columns]
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in names), default=0))


def texts(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def remainder(id_column: str, n: int) -> Column:
    """crc32 of the id as text modulo ``n``: splits that do not depend on the rest of the data.
    A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % n


# --- bounded prefilters ---------------------------------------------------------------------------

BITMAP_ROWS = 32768  # bits of one row that bitmap_construct_agg makes (fixed by Spark)


def key_bitmap(keys: DataFrame, key: Column, bits: int, name: str) -> DataFrame:
    """Bits set at the hashes of ``key``: a table of at most ``bits / 8`` bytes, whatever the input.

    A clear bit proves that a key is absent.  With more keys than bits the filter lets more through,
    which costs time and changes no result.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    marks = keys.select(F.bitmap_bucket_number(spot).alias("_bucket"), F.bitmap_bit_position(spot).alias("_bit"))
    return write_table(marks.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map")), name)


def add_bitmap_test(df: DataFrame, key: Column, bits: int, bitmap: DataFrame, out: str) -> DataFrame:
    """Add boolean ``out``: whether the bit of ``key`` is set.  The bitmap's size is bounded, so it is
    broadcast; the rows do not move."""
    p = own_prefix(df)
    spot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    place = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring(F.col(f"{p}map"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2))
    placed = df.withColumn(f"{p}spot", F.bitmap_bucket_number(spot))
    joined = placed.join(F.broadcast(bitmap.toDF(f"{p}spot", f"{p}map")), f"{p}spot", "left")
    return joined.withColumn(out, F.coalesce(bit == 1, F.lit(False))).drop(f"{p}spot", f"{p}map")


DROP_BITS = 1 << 25


def drop_rows(docs: DataFrame, losers: DataFrame, repeats: DataFrame, id_column: str, text: str, bits: int = DROP_BITS) -> DataFrame:
    """``docs`` without the rows that ``losers`` names by (id, mark), mark being xxhash64 of the text, and
    with one row each of those that ``repeats`` names; null ids are compared too.

    A bitmap of bounded size tells most rows that stay from the others, and they stay where they are;
    only rows whose bit is set are joined, so the texts that move are those that go, and a few more.
    Of rows that repeat an id and text the one whose columns have the least hash stays.
    """
    p = own_prefix(docs)
    i, m, gone, maybe = f"{p}id", f"{p}mark", f"{p}gone", f"{p}maybe"
    listed = losers.select("id", "mark", F.lit(True).alias(gone)).union(repeats.select("id", "mark", F.lit(False)))
    named = write_table(listed.toDF(i, m, gone).groupBy(i, m).agg(F.max(gone).alias(gone)), "losers")
    bitmap = key_bitmap(named, F.struct(i, m), bits, "losers-bitmap")
    marked = docs.withColumns({i: F.col(id_column), m: F.xxhash64(texts(text))})
    tested = add_bitmap_test(marked, F.struct(i, m), bits, bitmap, maybe)
    same = F.col(f"a.{i}").eqNullSafe(F.col(f"b.{i}")) & (F.col(f"a.{m}") == F.col(f"b.{m}"))
    doubtful = tested.filter(maybe).alias("a").join(named.alias("b"), same, "left").select("a.*", f"b.{gone}")
    alone = doubtful.filter(F.col(gone).isNull()).select(*docs.columns)
    comparable = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    row = F.min_by(F.struct(*docs.columns), F.xxhash64(*comparable)).alias(f"{p}row")
    one = doubtful.filter(~F.col(gone)).groupBy(i, m).agg(row).select(f"{p}row.*")
    return tested.filter(~F.col(maybe)).select(*docs.columns).union(alone).union(one)


def repeated(rows: DataFrame) -> DataFrame:
    """(id, mark) that ``rows`` has more than once."""
    return rows.groupBy("id", "mark").agg(F.count("*").alias("n")).filter("n > 1").select("id", "mark")
