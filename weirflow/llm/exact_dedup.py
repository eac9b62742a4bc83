"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Three narrow passes over the documents.  The first counts lengths, the second counts (length, prefix
hash) among crowded lengths, the third hashes whole texts of what is still crowded.  What survives a
pass is kept as a bitmap of bounded size, so no pass moves a text and the sets of survivors need no
join.  Only the last regrouping is exact, and it is complete: equal texts have equal lengths and
prefixes, so they pass all filters together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import add_bitmap_test, drop_rows, key_bitmap, own_prefix, repeated, texts, without, write_table

PREFIX_CHARS = 64
LENGTH_BITS = 1 << 20
PREFIX_BITS = 1 << 25
OUTPUT = ["keep_id", "group_size", "kept"]


def _keyed(docs: DataFrame, text: str, p: str, prefix_chars: int, length_bits: int, prefix_bits: int) -> DataFrame:
    """``docs`` with the keys length, prefix and full, named with ``p``; full is null where a text is known to be unique."""
    length, prefix, n = f"{p}length", f"{p}prefix", f"{p}n"
    measured = docs.withColumns({length: F.octet_length(texts(text)).cast("bigint"), prefix: F.xxhash64(F.substring(texts(text), 1, prefix_chars))})

    def crowded(rows: DataFrame, *key: str) -> DataFrame:
        return rows.groupBy(*key).agg(F.count("*").alias(n)).filter(F.col(n) > 1)

    lengths = key_bitmap(crowded(measured, length), F.col(length), length_bits, "dedup-lengths")
    by_length = add_bitmap_test(measured, F.col(length), length_bits, lengths, f"{p}crowded")
    spot = F.struct(length, prefix)
    prefixes = key_bitmap(crowded(by_length.filter(f"{p}crowded"), length, prefix), spot, prefix_bits, "dedup-prefixes")
    by_prefix = add_bitmap_test(by_length, spot, prefix_bits, prefixes, f"{p}doubtful")
    full = F.when(F.col(f"{p}crowded") & F.col(f"{p}doubtful"), F.sha2(texts(text), 256))
    return by_prefix.withColumn(f"{p}full", full).drop(f"{p}crowded", f"{p}doubtful")


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX_CHARS, length_bits: int = LENGTH_BITS, prefix_bits: int = PREFIX_BITS
) -> DataFrame:
    """All rows and columns of ``docs`` with keep_id, group_size and kept.

    Of equal texts the row with the largest id stays (``keep_id``).  A null text counts as empty, and
    empty texts are equal to each other.  Rows without an id never stay beside one with an id; if no
    row of a group has one, keep_id is null and all of them are kept.  A row that is there twice under
    one id counts twice and is kept twice.  An empty table gives an empty table.  Select only what is
    needed from the result: columns that nobody reads, texts too, are not moved.
    """
    source = docs.select(*without(docs, OUTPUT))
    p = own_prefix(source)
    key = [f"{p}length", f"{p}prefix", f"{p}full"]
    keyed = _keyed(source, text, p, prefix_chars, length_bits, prefix_bits)
    found = (
        keyed.filter(F.col(f"{p}full").isNotNull())
        .groupBy(*key)
        .agg(F.max(id_column).alias(f"{p}keep"), F.count("*").alias(f"{p}n"))
        .filter(F.col(f"{p}n") > 1)
        .select(*key, f"{p}keep", f"{p}n")
    )
    groups = write_table(found, "dedup-groups")  # so that the join has its own shuffle, which Spark can split at a hot group
    alone = F.col(f"{p}n").isNull()
    keep = F.when(alone, F.col(id_column)).otherwise(F.col(f"{p}keep"))
    return (
        keyed.join(groups, key, "left")
        .withColumn("keep_id", keep)
        .withColumn("group_size", F.coalesce(f"{p}n", F.lit(1)).cast("bigint"))
        .withColumn("kept", F.col(id_column).eqNullSafe(F.col("keep_id")))
        .select(*source.columns, *OUTPUT)
    )


def drop_exact(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; same columns.

    It is a row with the id that :func:`exact_groups` keeps.  If several rows have it, or if no row of
    the group has an id, the one of them whose columns have the least hash stays.
    """
    marked = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(texts(text)).alias("mark"))
    groups = write_table(exact_groups(marked, "id", "text").filter("group_size > 1").select("id", "mark", "kept"), "dedup-crowded")
    return drop_rows(docs, groups.filter("not kept"), repeated(groups.filter("kept")), id_column, text)
