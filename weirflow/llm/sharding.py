"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``virtual`` points of a ring; a row goes to the next point clockwise from the hash of
its id, and if that shard is full, on clockwise to the first one that is not.  Rows are placed in ring
order.  That order is followed on counts, not on rows: the ring is cut into ``BINS * PARTS`` cells of
fixed number, Spark counts the rows of each cell, the walk over the counts says which ranks of a cell
go to which shard, and each row finds its rank in its own cell.  What the driver holds is bounded by
the number of cells, whatever the input; a cell is a few ten-thousandths of the rows.  Where one id holds
many rows, and its cells more than ``HOT_ROWS``, their rows are ranked over many tasks.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import own_prefix, texts, without, write_table

SHARDS = 40
VIRTUAL = 16
BINS = 1 << 14
PARTS = 4  # rows of one id that differ in content spread over so many cells
HOT_ROWS = 1_000_000  # rows that one task ranks
OUTPUT = ["shard", "slot"]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard.  Without slack they add up to the rows, so counts differ by one at most."""
    if slack > 0:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(bin, shard) of all virtual nodes, in ring order.  The points of a shard do not depend on how
    many shards there are."""
    return sorted((xxhash.xxh64_intdigest(f"{s}/{v}") >> 50, s) for s in range(shards) for v in range(virtual))


def place(cells: list[tuple[int, int, int]], shards: int, slack: float = 0.0, virtual: int = VIRTUAL) -> list[tuple[int, int, int, int, int, int]]:
    """Counts (bin, part, rows) -> (bin, part, first rank, last rank, shard, slot of the first rank).

    Pieces are at most the cells and the shards together: each ends a cell or fills a shard.
    """
    points = ring(shards, virtual)
    bins = [b for b, _ in points]
    room = capacities(sum(n for *_, n in cells), shards, slack)
    used = [0] * shards
    onward = list(range(len(points)))  # from a point of a full shard to a later one

    def free(k: int) -> int:
        seen = []
        while room[points[k][1]] == used[points[k][1]] or onward[k] != k:
            seen.append(k)
            k = onward[k] if onward[k] != k else (k + 1) % len(points)
        for s in seen:
            onward[s] = k
        return k

    pieces = []
    for b, part, rows in sorted(cells):
        at, rank = bisect_left(bins, b) % len(points), 1
        while rank <= rows:
            at = free(at)
            shard = points[at][1]
            take = min(rows - rank + 1, room[shard] - used[shard])
            pieces.append((b, part, rank, rank + take - 1, shard, used[shard]))
            used[shard] += take
            rank += take
    return pieces


def _hot_ranks(rows: DataFrame, cell: list[str], order: list[str], p: str, chunks: int) -> DataFrame:
    """``rows`` with their rank in their cell, where a cell is too large for a task: ranges of the order,
    each ranked on its own after the rows of those before it.  Equal rows are told apart by a salt, which is
    written first, so that a task that runs again finds the same one."""
    salt, chunk, n, before = f"{p}salt", f"{p}chunk", f"{p}n", f"{p}before"
    salted = write_table(rows.withColumn(salt, F.xxhash64(F.monotonically_increasing_id())), "shard-hot")
    dealt = write_table(salted.repartitionByRange(chunks, *cell, *order, salt).withColumn(chunk, F.spark_partition_id()), "shard-chunks")
    earlier = Window.partitionBy(*cell).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*cell, chunk).agg(F.count("*").alias(n))
    offsets = counts.select(*cell, chunk, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(*cell, chunk).orderBy(*order, salt)
    ranked = dealt.join(offsets, [*cell, chunk]).withColumn(f"{p}rank", F.col(before) + F.row_number().over(inside))
    return ranked.drop(salt, chunk, before)


def assign(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text", slack: float = 0.0, virtual: int = VIRTUAL) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    No shard gets more than (1 + slack) times the mean; without slack counts are at most one apart.
    The place of a row follows from all ids and contents, not from the layout of the table: a null id
    or text counts as empty.  Repeated rows are rows of their own with places of their own.  An empty
    table gives an empty table; with fewer rows than shards some shards stay empty.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    source = docs.select(*without(docs, OUTPUT))
    key = F.xxhash64(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    content = F.xxhash64(texts(text), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    p = own_prefix(source)
    cell = [f"{p}bin", f"{p}part"]
    placed = source.withColumns({cell[0]: F.shiftrightunsigned(key, 50).cast("int"), f"{p}order": content, cell[1]: F.pmod(content, F.lit(PARTS)).cast("int")})
    cells = [tuple(r) for r in placed.groupBy(*cell).count().collect()]  # at most BINS * PARTS rows
    pieces = pd.DataFrame(place(cells, shards, slack, virtual), columns=[*cell, f"{p}from", f"{p}to", "shard", f"{p}slot"])
    table = docs.sparkSession.createDataFrame(pieces, f"{p}bin int, {p}part int, {p}from bigint, {p}to bigint, shard int, {p}slot bigint")
    order = [f"{p}order", id_column]
    hot = {b * PARTS + part: n for b, part, n in cells if n > HOT_ROWS}
    is_hot = (F.col(cell[0]) * PARTS + F.col(cell[1])).isin(list(hot))
    inside = Window.partitionBy(*cell).orderBy(*order)
    ranked = (placed.filter(~is_hot) if hot else placed).withColumn(f"{p}rank", F.row_number().over(inside).cast("bigint"))
    if hot:
        ranked = ranked.unionByName(_hot_ranks(placed.filter(is_hot), cell, order, p, math.ceil(sum(hot.values()) / HOT_ROWS)))
    here = F.col(f"{p}rank").between(F.col(f"{p}from"), F.col(f"{p}to"))
    # At most BINS * PARTS + shards rows of 40 bytes: small enough to broadcast at any size of input.
    joined = ranked.join(F.broadcast(table), cell).filter(here)
    return joined.withColumn("slot", F.col(f"{p}slot") + F.col(f"{p}rank") - F.col(f"{p}from")).select(*source.columns, *OUTPUT)


def shard_report(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, size (UTF-8 bytes of the text plus 16), text_crc32, law, shard, slot and
    grown_shard (null: it is told only under the law ``key``)."""
    sized = docs.select(
        id_column, text, (F.octet_length(texts(text)) + 16).cast("bigint").alias("size"), F.crc32(texts(text)).alias("text_crc32")
    )
    done = assign(sized, shards, id_column, text)
    return done.select(id_column, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
