"""Links between sets of word shingles, from buckets of candidates, checked exactly on full sets.

Sets come with the keys of the buckets that they fall into; sets of one bucket are candidates.  What is
wanted are links with the same components as all linked candidates, without writing all pairs of a bucket:

1. Each member of a bucket is compared with one leader, the member that shares buckets with most others.
   A group of copies gives links by its size.
2. Buckets whose members are now in one component are done.  In the others the members outside the
   bucket's largest component are compared with the members of other components.  The comparison of
   step 2 is a bound inside the join: two sets whose odd sketches differ in more bits than linked sets
   may cannot be linked, so only pairs that are close leave the join.

The odd sketch of a set has ``SKETCH_BITS`` bits, each the parity of the number of elements that hash to
it.  An element in only one of two sets flips one bit, so the sketches differ in at most as many bits as
the sets differ in elements: the bound drops no link.  Every pair that is left is compared on full sets.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from weirflow.llm.common import DROP_BITS, add_bitmap_test, key_bitmap, let_go, shuffled, texts, travels, write_table
from weirflow.llm.components import components

SEED = 42
SKETCH_BITS = 1024

travels(__name__)


def shingle_hashes(text: str, shingle: int, seed: int = SEED) -> np.ndarray:
    """The XXH64 of the word shingles of one whole text, repeats included: A-Z lower-cased, words between
    white space of ASCII; with fewer words the whole sequence is one shingle, without words there is none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the white space of ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops)), np.uint64, len(starts))


def shingle_set(text: str, shingle: int, seed: int = SEED) -> np.ndarray:
    """The sorted distinct hashes of :func:`shingle_hashes`."""
    return np.unique(shingle_hashes(text, shingle, seed))


def odd_sketch(own: np.ndarray) -> np.ndarray:
    """The parities of a set as ``SKETCH_BITS`` / 64 signed numbers."""
    spots = (own >> np.uint64(20)).astype(np.int64) % SKETCH_BITS
    return np.packbits((np.bincount(spots, minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def set_print(own: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return xxhash.xxh3_128_digest(own.tobytes(), SEED)


@F.pandas_udf(ArrayType(LongType()))
def _sets(column: pd.Series, sizes: pd.Series) -> pd.Series:
    let_go()
    return pd.Series([shingle_set(text, size).view(np.int64) for text, size in zip(column, sizes)])


def _may_link(a: str, b: str, above: int, below: int) -> Column:
    """Whether sets of sizes and sketches ``a`` and ``b`` can have |A and B| / |A or B| >= above / below:
    that is so if they differ in at most (|A| + |B|) (below - above) / (below + above) elements."""
    total = F.col(f"{a}_n") + F.col(f"{b}_n")
    bits = [F.bit_count(F.get(F.col(f"{a}_odd"), F.lit(k)).bitwiseXOR(F.get(F.col(f"{b}_odd"), F.lit(k)))) for k in range(SKETCH_BITS // 64)]
    differ = reduce(lambda x, y: x + y, bits).cast("bigint")
    least = F.greatest(F.abs(F.col(f"{a}_n") - F.col(f"{b}_n")), differ)
    return least * (below + above) <= total * (below - above)


def verified(docs: DataFrame, text: str, sets: DataFrame, pairs: DataFrame, shingle: int, above: int, below: int) -> DataFrame:
    """The ``pairs`` (hi, lo) whose shingle sets have the Jaccard similarity ``above / below``.

    ``sets`` is (fp, mark, ...), mark being xxhash64 of one text with that set.  Only texts in a pair are
    read again, and only their sets move.
    """
    pairs = write_table(pairs.select("hi", "lo").distinct(), "links-pairs")
    wanted = pairs.select(F.col("hi").alias("fp")).union(pairs.select("lo")).distinct().join(sets.select("fp", "mark"), "fp")
    wanted = write_table(wanted, "links-wanted")
    bitmap = key_bitmap(wanted, F.col("mark"), DROP_BITS, "links-bitmap")
    tested = add_bitmap_test(docs.select(F.col(text).alias("text"), F.xxhash64(texts(text)).alias("mark")), F.col("mark"), DROP_BITS, bitmap, "maybe")
    # One text of each set; the few texts of one mark that differ are told apart by their set's print.
    found = tested.filter("maybe").join(wanted, "mark").groupBy("fp", "mark").agg(F.min("text").alias("text"))
    own = write_table(found.select("fp", _sets(texts("text"), F.lit(shingle)).alias("own")), "links-sets")
    both = pairs.join(own.toDF("hi", "x"), "hi").join(own.toDF("lo", "y"), "lo")
    common = F.size(F.array_intersect("x", "y"))
    alike = common * below >= (F.size("x") + F.size("y") - common) * above
    return write_table(both.filter(alike).select("hi", "lo"), "links")


def set_links(docs: DataFrame, text: str, sets: DataFrame, shingle: int, above: int, below: int) -> DataFrame:
    """Links (hi, lo) between sets of a similarity of ``above / below`` or more, with the components of all such
    links between sets that share a key.

    ``sets`` is one row a distinct set: fp, mark (see :func:`verified`), n (its size), odd
    (its odd sketch) and keys (an array).  Sets without keys are linked with nothing.
    """
    entries = shuffled(sets.select("fp", F.explode("keys").alias("key")))
    crowded = entries.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members = shuffled(write_table(entries.join(crowded, "key"), "links-members"))  # few bytes a row in a file, where groups are large
    # The leader of a bucket is its member that meets most others in all its buckets.
    known = members.groupBy("fp").agg(F.sum("members").alias("met"))
    known = write_table(known.join(sets.select("fp", "n", "odd"), "fp"), "links-known")
    led = members.join(known.select("fp", "met"), "fp").groupBy("key").agg(F.max(F.struct("met", "fp"))["fp"].alias("leader"))
    near = members.join(led, "key").filter("fp <> leader").select("fp", "leader").distinct()
    side = lambda name: known.select(F.col("fp").alias(name), F.col("n").alias(f"{name}_n"), F.col("odd").alias(f"{name}_odd"))
    near = near.join(side("fp"), "fp").join(side("leader"), "leader").filter(_may_link("fp", "leader", above, below))
    ordered = [F.greatest("fp", "leader").alias("hi"), F.least("fp", "leader").alias("lo")]
    first = verified(docs, text, sets, near.select(*ordered), shingle, above, below)

    roots = components(first).toDF("fp", "root")
    rooted = members.join(roots, "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    parts = rooted.groupBy("key", "root").agg(F.count("*").alias("size"))
    open_keys = parts.groupBy("key").agg(F.max(F.struct("size", "root"))["root"].alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    left = write_table(rooted.join(open_keys.select("key", "main"), "key"), "links-open")
    a = left.filter("root <> main").select("key", F.col("fp").alias("a"), F.col("root").alias("a_root"))
    b = left.select(F.col("key").alias("b_key"), F.col("fp").alias("b"), F.col("root").alias("b_root"), (F.col("root") == F.col("main")).alias("b_main"))
    a, b = a.join(side("a"), "a"), b.join(side("b"), "b")
    apart = (F.col("a_root") != F.col("b_root")) & (F.col("b_main") | (F.col("a") < F.col("b")))
    across = a.join(b, (F.col("key") == F.col("b_key")) & apart & _may_link("a", "b", above, below))
    across = across.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    return first.union(verified(docs, text, sets, across, shingle, above, below))


def named_sets(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(fp, component_id): the least id of ``rows`` (id, fp) in the component of each set."""
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links).toDF("fp", "root")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = write_table(rooted, "links-roots")
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
