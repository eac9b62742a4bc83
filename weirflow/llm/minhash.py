"""MinHash near-duplicates with circulant signatures: two permutations give all coordinates.

Shingles are numbers of 32 bits.  The first permutation scatters them, which breaks whatever structure
they have.  The second one, shifted circularly by k places, ranks them for coordinate k: the coordinate
is the least rank, over the set, of (place + k) mod 2^32.  So one table of two permutations replaces one
independent permutation for each coordinate.  Both are bijections of the 32-bit numbers made of odd
multiplications and xor-shifts.  ``ROWS`` coordinates make a band, ``BANDS`` bands a signature; sets that
agree in a band are candidates, and :mod:`setlinks` checks them exactly on their full sets.

Two sets of similarity j agree in a band with the chance j^5, at 0.85 in none of 26 with the chance
(1 - 0.85^5)^26, 2.4 in ten million; closer pairs are missed more seldom.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from weirflow.llm.common import texts, travels, write_table
from weirflow.llm.setlinks import named_sets, odd_sketch, set_links, set_print, shingle_set

SHINGLE = 3
ABOVE, BELOW = 85, 100  # linked: BELOW * |A and B| >= ABOVE * |A or B|
BANDS, ROWS = 26, 5
_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)
_BLOCK = 256  # shingles ranked at a time, so that the table of ranks stays in a core's cache

travels(__name__)


def scattered(numbers: np.ndarray) -> np.ndarray:
    """The first permutation of the 32-bit numbers."""
    x = numbers.astype(np.uint32)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def ranked(places: np.ndarray) -> np.ndarray:
    """The second permutation, in place."""
    places ^= places >> np.uint32(15)
    places *= np.uint32(0x2C1B3C6D)
    places ^= places >> np.uint32(12)
    places *= np.uint32(0x297A2D39)
    places ^= places >> np.uint32(15)
    return places


def signature(own: np.ndarray) -> np.ndarray:
    """All coordinates of a set of 64-bit hashes, from the two permutations."""
    places = scattered(own >> np.uint64(32))
    least = np.full(len(_SHIFTS), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(places), _BLOCK):
        ranks = ranked(np.add.outer(places[k : k + _BLOCK], _SHIFTS))  # sums wrap, which is the circular shift
        np.minimum(least, ranks.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One number for each band of a signature."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


_SKETCH = StructType([StructField("fp", BinaryType()), StructField("n", LongType()), StructField("odd", ArrayType(LongType())), StructField("keys", ArrayType(LongType()))])


@F.pandas_udf(_SKETCH)
def _sketches(column: pd.Series, sizes: pd.Series) -> pd.DataFrame:
    rows = []
    for text, size in zip(column, sizes):
        own = shingle_set(text, size)
        keys = band_keys(signature(own)) if len(own) else np.zeros(0, np.int64)
        rows.append((set_print(own), len(own), odd_sketch(own), keys))
    return pd.DataFrame(rows, columns=["fp", "n", "odd", "keys"])


def sketched(docs: DataFrame, id_column: str, text: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(id, mark, fp, n) of each row, and (fp, mark, n, odd, keys) of each distinct set; written."""
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(texts(text)).alias("mark"), _sketches(texts(text), F.lit(shingle)).alias("s"))
    rows = write_table(rows.select("id", "mark", "s.*"), "minhash-rows")
    one = rows.groupBy("fp").agg(F.min("mark").alias("mark"))
    sets = rows.join(one, ["fp", "mark"], "left_semi").select("fp", "mark", "n", "odd", "keys").dropDuplicates(["fp"])
    return rows.select("id", "mark", "fp", "n"), write_table(sets, "minhash-sets")


def near_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, above: int = ABOVE, below: int = BELOW) -> DataFrame:
    """Per row: the id, ``n_shingles`` (size of its set of word shingles), ``component_id`` (the least id that can be
    reached over links, its own included) and ``kept`` (whether that is its own).

    Rows are linked if their sets have a Jaccard similarity of ``above / below`` or more.  Null and empty texts, and
    texts of white space, have an empty set and are linked with nothing, not even with each other.  Equal texts are
    linked.  A null id names a component only if all its ids are null, and is kept then.  Repeated rows stay
    repeated; an empty table gives an empty table.  Other columns of ``docs`` are not read.
    """
    rows, sets = sketched(docs, id_column, text, shingle)
    named = named_sets(rows, set_links(docs, text, sets.filter("n > 0"), shingle, above, below))
    joined = rows.join(named, "fp")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    found = joined.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return found.withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
