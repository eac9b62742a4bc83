"""Secret scan: candidates by pattern, false positives removed by a random forest, in DataFrame functions.

Candidates are runs of 12 or more characters of keys and digests with a digit in them, key headers, and
what is assigned to a secret's name: six or more printable characters up to the closing quote, or without
a quote up to a blank, with or without digits.  The text is cut by the same pattern that extracts them,
so each candidate has the text before and after it at the cost of two passes of the pattern, whatever
their number.  Features are the length,
transitions between kinds of characters, the share of letters in dictionary words, whether the place
is a path, and neighbouring words; the dictionary is what the neighbourhoods of all candidates hold.

The forest is grown level by level on labelled findings: each level is one grouping of the (bounded)
labelled sample by tree, node, feature and bin, and the driver sees these sums only, never findings.
Trees are then expressions that Spark compiles into the scan.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import texts, write_table

CANDIDATE = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----|(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{12,}={0,2}"
# Values of a secret's name; the short lookbehinds before the long ones tell most places at once.
_NAMED = r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?:orization)?|credential)[\w\-]{0,32}[\"']?\s{0,8}(?:=>|:=|=|:)\s{0,8}(?:(?i:bearer|basic)\s{1,8})?"
_PLACE = r"(?<=[=:>\s\"'])(?:(?<=[=:>]\s{0,8}[\"']?)|(?<=(?i:bearer|basic)\s{1,8}[\"']?))"
_VALUES = (
    *(rf"(?<={q})(?<={_NAMED}{q})[^{q}\r\n]{{6,}}+(?={q})" for q in "\"'"),
    rf"(?<=[?&][\w\-]{{0,32}}{_NAMED})[^\s\"'<>&#]{{5,}}[^\s\"'<>&#,.;:)\]}}]",
    rf"(?<={_NAMED}[\"']?)(?!(?i:bearer|basic)\s)[^\s\"'<>]{{5,}}[^\s\"'<>,.;:)\]}}]",
)
VALUE = f"{_PLACE}(?:{'|'.join(_VALUES)})"
SCAN = f"{VALUE}|{CANDIDATE}"  # Java only: lookbehinds of several lengths
NEAR = 64  # characters of each side that are kept
# Formats of issuers, names that secrets are assigned to, and words beside digests and numbers that are public.
ISSUED = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^xox[abprs]-|^sk_live_|^-----BEGIN "
ASSIGNED = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth(orization)?|credential)[\w\-]*[\"']?\s*(=|:=|:|=>)\s*((bearer|basic)\s+)?[\"']?$"
SENSITIVE = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|key|auth|credential|login)"
PUBLIC = r"(?i)(commit|sha-?\d*|md5|hash|digest|checksum|uuid|guid|isbn|iban|card|phone|order|invoice|version|revision)"
_FOLDER = r"(?:[A-Za-z]?[a-z_\-]+\d{0,4}|\d{1,4})/"
FOLDERS = f"^/?{_FOLDER}{_FOLDER}|^/{_FOLDER}"  # two folders tell a path; a repeated group would take a stack frame for each
FEATURES = ("length", "transitions", "digits", "upper", "distinct", "coverage", "hex", "path", "assigned", "sensitive", "public", "quoted")
TREES, DEPTH, BINS = 8, 4, 16
SAMPLE = 20_000  # expected labelled findings that the forest is grown on
DICTIONARY_MIN = 3  # times that a word must be met beside candidates


def candidates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", near: int = NEAR) -> DataFrame:
    """(id, ordinal, candidate, before, after) of all candidates in whole texts."""
    whole = texts(text)
    found = docs.select(F.col(id_column).alias("id"), F.regexp_extract_all(whole, F.lit(SCAN), F.lit(0)).alias("c"), F.split(whole, SCAN, -1).alias("p"))
    sides = F.transform("c", lambda c, k: F.struct(k.alias("ordinal"), c.alias("candidate"), F.right(F.get("p", k), F.lit(near)).alias("before"), F.left(F.get("p", k + 1), F.lit(near)).alias("after")))
    return found.filter(F.size("c") > 0).select("id", F.explode(sides).alias("f")).select("id", "f.*")


def _letters(column: Column) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(r"(\p{L}{3,})"), F.lit(1))


def with_coverage(found: DataFrame) -> DataFrame:
    """Add ``coverage``: the share of a candidate that is dictionary words.

    The dictionary is the words of three or more letters met at least ``DICTIONARY_MIN`` times beside
    candidates.  Runs of letters are looked up once per distinct candidate.
    """
    words = found.select(F.explode(_letters(F.concat_ws(" ", "before", "after"))).alias("word"))
    dictionary = words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= DICTIONARY_MIN).select("word")
    distinct = found.select("candidate").distinct()
    runs = distinct.select("candidate", F.explode(_letters(F.col("candidate"))).alias("word"))
    covered = runs.join(dictionary, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered"))
    return found.join(covered, "candidate", "left").withColumn("coverage", F.coalesce(F.col("covered"), F.lit(0)) / F.length("candidate")).drop("covered")


def with_features(found: DataFrame) -> DataFrame:
    """Add the columns of ``FEATURES``, all double."""
    c, n = F.col("candidate"), F.length("candidate")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9"), "[^aA9]", "-")
    share = lambda pattern: (n - F.length(F.regexp_replace(c, pattern, ""))) / n
    # In an address before its query, beside a slash, a dot or an extension, or folders with names like words.
    in_path = F.col("before").rlike(r"(://[^\s?#]*|[/\\.@])$") | F.col("after").rlike(r"^([/\\@]|\.\w)") | c.rlike(FOLDERS)
    flags = {
        "hex": c.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "path": in_path,
        "assigned": F.col("before").rlike(ASSIGNED),
        "sensitive": F.col("before").rlike(SENSITIVE),
        "public": F.concat_ws(" ", "before", "after").rlike(PUBLIC),
        "quoted": F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']"),
    }
    numbers = {
        "length": F.least(n, F.lit(256)).cast("double"),
        "transitions": (F.length(F.regexp_replace(kinds, r"(.)\1*", "x")) - 1) / n,
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "coverage": F.col("coverage").cast("double"),
    }
    return found.withColumns({k: v.cast("double") for k, v in {**numbers, **flags}.items()})


def weak_label(found: DataFrame) -> Column:
    """Labels of findings whose case is plain: 1 for an issuer's format or a value assigned to a
    secret's name, 0 for numbers, paths, addresses, digests that are named as such and words of the
    dictionary that follow a name without quotes; else null."""
    plain_number = F.col("candidate").rlike("^[0-9+_/-]+$")
    word = F.col("candidate").rlike("^[A-Z]?[a-z]+$") & (F.col("quoted") == 0) & F.col("before").rlike(r":\s+$")  # may be prose
    return (
        F.when(F.col("candidate").rlike(ISSUED), 1)
        .when(word, F.when(F.col("coverage") >= 1, 0))
        .when(plain_number, 0)
        .when((F.col("assigned") == 1) & (F.col("public") == 0), 1)
        .when(F.col("path") == 1, 0)
        .when((F.col("public") == 1) & (F.col("sensitive") == 0), 0)
    )


# --- the forest -----------------------------------------------------------------------------------


def _route(tree: dict, node: int, leaf) -> Column:
    """The expression of a (sub)tree; ``leaf`` turns a leaf's node number into a column."""
    if node not in tree:
        return leaf(node)
    feature, threshold = tree[node]
    return F.when(F.col(feature) <= threshold, _route(tree, 2 * node, leaf)).otherwise(_route(tree, 2 * node + 1, leaf))


def _gini(ones: float, all_: float) -> float:
    p = ones / all_ if all_ else 0.0
    return all_ * 2 * p * (1 - p)


def _best_split(sums: dict[str, dict[int, tuple[float, float]]], allowed) -> tuple[str, int] | None:
    """The (feature, last bin on the left) that lowers the Gini impurity most."""
    best, choice = 1e-9, None
    for feature in sorted(sums):
        if not allowed(feature):
            continue
        bins = sums[feature]
        all_, ones = sum(b[0] for b in bins.values()), sum(b[1] for b in bins.values())
        left_all = left_ones = 0.0
        for b in sorted(bins)[:-1]:
            left_all, left_ones = left_all + bins[b][0], left_ones + bins[b][1]
            gain = _gini(ones, all_) - _gini(left_ones, left_all) - _gini(ones - left_ones, all_ - left_all)
            if gain > best:
                best, choice = gain, (feature, b)
    return choice


def grow(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, sample: int = SAMPLE) -> tuple[list[dict], list[dict]]:
    """Findings with features and ``label`` (0 or 1) -> (splits by node, leaf values by node) of each tree.

    About ``sample`` rows of each label at most are drawn by a hash; each tree weighs them as a
    bootstrap would, by another hash.  What the driver collects is bounded by trees, nodes, features
    and bins.  Without labels every leaf is one half.
    """
    mark = F.xxhash64("id", "ordinal", "candidate")
    counts = {r["label"]: r["count"] for r in labelled.filter("label is not null").groupBy("label").count().collect()}
    if not counts:
        return [{} for _ in range(trees)], [{1: 0.5} for _ in range(trees)]
    chance = F.pmod(mark, F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("label") == 1, min(1.0, sample / counts.get(1, 1))).otherwise(min(1.0, sample / counts.get(0, 1)))
    balance = F.when(F.col("label") == 1, 1.0 / counts.get(1, 1)).otherwise(1.0 / counts.get(0, 1))
    drawn = labelled.filter(F.col("label").isNotNull() & (chance < share))
    cuts_of = drawn.agg(*(F.percentile_approx(f, [k / BINS for k in range(1, BINS)], 1000).alias(f) for f in FEATURES)).first()
    cuts = {f: sorted(set(cuts_of[f] or [])) for f in FEATURES}
    binned = {f: sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)) for f in FEATURES}
    tree_of = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    rows = drawn.select("label", mark.alias("mark"), (balance * 1e4).alias("balance"), *FEATURES, F.map_from_arrays(F.array(*map(F.lit, FEATURES)), F.array(*binned.values())).alias("bins"))
    bagged = rows.withColumn("tree", tree_of).withColumn("u", F.pmod(F.xxhash64("mark", "tree"), F.lit(1000)))
    # Poisson weights with mean one: 0, 1, 2 or 3 with chances 0.368, 0.368, 0.184 and the rest.
    weight = F.when(F.col("u") < 368, 0).when(F.col("u") < 736, 1).when(F.col("u") < 920, 2).otherwise(3)
    sample_rows = write_table(bagged.withColumn("w", weight * F.col("balance")).filter("w > 0"), "secret-sample")

    splits: list[dict] = [{} for _ in range(trees)]
    leaves: list[dict] = [{} for _ in range(trees)]
    for level in range(depth + 1):
        node = F.lit(0)
        for t in range(trees):
            node = F.when(F.col("tree") == t, _route(splits[t], 1, F.lit)).otherwise(node)
        placed = sample_rows.withColumn("node", node).filter(F.col("node") >= 2**level)
        totals = placed.groupBy("tree", "node").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("label")).alias("ones")).collect()
        for r in totals:
            leaves[r["tree"]][r["node"]] = r["ones"] / r["n"]
        if level == depth:
            break
        sums: dict = defaultdict(lambda: defaultdict(dict))
        by_bin = placed.select("tree", "node", "w", "label", F.explode("bins").alias("feature", "bin")).groupBy("tree", "node", "feature", "bin")
        for r in by_bin.agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("label")).alias("ones")).collect():
            sums[r["tree"], r["node"]][r["feature"]][r["bin"]] = (r["n"], r["ones"])
        for (t, k), own in sums.items():
            # Each node looks at about half of the features.
            choice = _best_split(own, lambda f: zlib.crc32(f"{t}/{k}/{f}".encode()) % 2 == 0)
            if choice:
                feature, b = choice
                splits[t][k] = (feature, cuts[feature][b])
                leaves[t].setdefault(2 * k, leaves[t][k]), leaves[t].setdefault(2 * k + 1, leaves[t][k])
    return splits, leaves


def forest_score(forest: tuple[list[dict], list[dict]]) -> Column:
    """The mean of the trees' leaf values, as one expression over the feature columns."""
    splits, leaves = forest
    values = [_route(s, 1, lambda node, own=own: F.lit(float(own.get(node, 0.5)))) for s, own in zip(splits, leaves)]
    return sum(values[1:], values[0]) / len(values)


def findings(docs: DataFrame, id_column: str = "doc_id", text: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate of whole texts: the id, ordinal (from 0 in its text), candidate, before,
    after, the features, ``score`` (0 to 1) and ``is_secret`` (score of one half or more).

    ``labelled`` is (id, ordinal, label): findings that people have judged; without it plain cases
    are labelled by :func:`weak_label`.  Null and empty texts have no candidates, and copies have
    theirs each.  An empty table gives no rows.
    """
    found = write_table(candidates(docs, id_column, text), "secret-candidates")
    rows = write_table(with_features(with_coverage(found)), "secret-features")
    marked = rows.withColumn("label", weak_label(rows)) if labelled is None else rows.join(labelled.select("id", "ordinal", F.col("label").cast("int")), ["id", "ordinal"], "left")
    score = forest_score(grow(marked))
    return rows.withColumn("score", score).withColumn("is_secret", F.col("score") >= 0.5).withColumnRenamed("id", id_column)


def secret_report(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The findings without the secrets: the id, ordinal, sha-256 of the candidate, its length, score
    and decision."""
    return findings(docs, id_column, text).select(
        id_column, F.col("ordinal").cast("int").alias("ordinal"), F.sha2("candidate", 256).alias("candidate_sha256"), F.length("candidate").alias("n_chars"), F.round("score", 9).alias("score"), "is_secret"
    )
