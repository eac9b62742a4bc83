"""JSON Schema checks as Columns over a VARIANT document.

Supported keywords (draft 4): ``type``, ``required``, ``enum``, ``pattern``, ``minimum``,
``format`` (date-time, uri, ipv4), ``additionalProperties: false``, and nested ``properties`` and
``items``.  A schema is compiled once on the driver into a list of named conditions.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.once import compute_once

log = logging.getLogger(__name__)

# How the JSON types appear in schema_of_variant, and the format patterns.
TYPE_PREFIXES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "boolean": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
    "null": ("VOID",),
}
# Integers beyond 64 bits are decimals without a fraction (up to 38 digits; longer ones are doubles).
LARGE_INTEGER = r"^DECIMAL\((19|[23][0-9]),0\)"
FORMATS = {
    "date-time": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,12})?(Z|[+-][0-9]{2}:?[0-9]{2})\z",
    "uri": r"^[^\s<>\"{}|\\^`]*\z",
    "ipv4": r"^((25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.|\z)){4}(?<!\.)\z",
}

# The two schemas of events, a contract with their producers.
USER_EVENT_SCHEMA = {
    "type": "object",
    "properties": {
        "user_id": {"type": "string"},
        "event_type": {"type": "string", "enum": ["click", "view", "signup", "login", "logout"]},
        "timestamp": {"type": "string", "format": "date-time"},
        "page_url": {"type": "string", "format": "uri"},
        "session_id": {"type": "string"},
        "properties": {"type": "object"},
    },
    "required": ["user_id", "event_type", "timestamp"],
    "additionalProperties": False,
}

ORDER_EVENT_SCHEMA = {
    "type": "object",
    "properties": {
        "order_id": {"type": "string"},
        "customer_id": {"type": "string"},
        "order_status": {"type": "string", "enum": ["created", "paid", "shipped", "delivered", "cancelled"]},
        "timestamp": {"type": "string", "format": "date-time"},
        "total_amount": {"type": "number", "minimum": 0},
        "currency": {"type": "string", "pattern": "^[A-Z]{3}$"},
        "items": {
            "type": "array",
            "items": {
                "type": "object",
                "properties": {
                    "product_id": {"type": "string"},
                    "quantity": {"type": "integer", "minimum": 1},
                    "unit_price": {"type": "number", "minimum": 0},
                },
                "required": ["product_id", "quantity", "unit_price"],
            },
        },
    },
    "required": ["order_id", "customer_id", "order_status", "timestamp"],
    "additionalProperties": False,
}


def _step(name: str) -> str:
    escaped = name.replace("'", "\\'")
    return f"$['{escaped}']"


class _Node:
    """A place in the document: its VARIANT, its type text, and its members once they are columns."""

    def __init__(self, value: Column, kind: Column, members: dict[str, _Node] | None = None):
        self.value, self.kind, self.members = value, kind, members

    def member(self, name: str) -> _Node:
        if self.members is not None and name in self.members:
            return self.members[name]
        child = F.try_variant_get(self.value, _step(name), "variant")
        return _Node(child, F.schema_of_variant(child))

    def is_type(self, names: str | list[str]) -> Column:
        hit = F.lit(False)
        for name in [names] if isinstance(names, str) else names:
            for prefix in TYPE_PREFIXES[name]:
                hit = hit | self.kind.startswith(prefix)
            if name == "integer":
                hit = hit | self.kind.rlike(LARGE_INTEGER)
        return hit

    def equals(self, wanted) -> Column:
        """Whether the value is the JSON value ``wanted``; numbers are compared as numbers."""
        if wanted is None:
            return self.kind == "VOID"
        if isinstance(wanted, bool):
            return F.when(self.kind == "BOOLEAN", F.try_variant_get(self.value, "$", "boolean") == wanted)
        if isinstance(wanted, int):
            exact = F.try_variant_get(self.value, "$", "decimal(38,0)") == F.lit(str(wanted)).cast("decimal(38,0)")
            return F.when(self.is_type("integer"), exact).when(self.is_type("number"), self.number() == float(wanted))
        if isinstance(wanted, float):
            return self.number() == wanted
        if isinstance(wanted, str):
            return self.text() == wanted
        return F.to_json(self.value) == json.dumps(wanted, sort_keys=True, separators=(",", ":"), ensure_ascii=False)

    def text(self) -> Column:
        return F.when(self.kind == "STRING", F.try_variant_get(self.value, "$", "string"))

    def number(self) -> Column:
        return F.when(self.is_type("number"), F.try_variant_get(self.value, "$", "double"))


def _java_pattern(pattern: str) -> str:
    return pattern[:-1] + r"\z" if pattern.endswith("$") and not pattern.endswith(r"\$") else pattern


def _names(schema: dict) -> list[str]:
    return list(dict.fromkeys([*schema.get("properties", {}), *schema.get("required", [])]))


def _conditions(schema: dict, node: _Node, label: str, elements: dict[str, Column]) -> list[tuple[str, Column]]:
    """(keyword label, failed) for one schema node; a missing node fails nothing.

    ``elements`` holds the prepared array elements by label.
    """
    found: list[tuple[str, Column]] = []
    if "type" in schema:
        found.append((f"{label}:type", ~node.is_type(schema["type"])))
    if "enum" in schema:
        words = [v for v in schema["enum"] if isinstance(v, str)]
        hit = F.coalesce(node.text().isin(*words), F.lit(False)) if words else F.lit(False)
        for other in (v for v in schema["enum"] if not isinstance(v, str)):
            hit = hit | F.coalesce(node.equals(other), F.lit(False))
        found.append((f"{label}:enum", ~hit))
    if "pattern" in schema:
        found.append((f"{label}:pattern", ~node.text().rlike(_java_pattern(schema["pattern"]))))
    if "minimum" in schema:
        found.append((f"{label}:minimum", node.number() < schema["minimum"]))
    if schema.get("format") in FORMATS:
        found.append((f"{label}:format", ~node.text().rlike(FORMATS[schema["format"]])))
    is_object = node.is_type("object")
    for name in schema.get("required", []):
        found.append((f"{label}.{name}:required", is_object & node.member(name).value.isNull()))
    if schema.get("additionalProperties") is False:
        allowed = F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>")
        keys = F.json_object_keys(F.to_json(node.value))
        found.append((f"{label}:additionalProperties", is_object & (F.size(F.array_except(keys, allowed)) > 0)))
    for name, sub in schema.get("properties", {}).items():
        child = node.member(name)
        found += [(key, child.value.isNotNull() & failed) for key, failed in _conditions(sub, child, f"{label}.{name}", elements)]
    if isinstance(schema.get("items"), dict):
        inner, place = schema["items"], f"{label}[]"
        if place in elements:
            array, as_node = elements[place], lambda x: _element_node(inner, x)
        else:
            array, as_node = F.try_variant_get(node.value, "$", "array<variant>"), lambda x: _Node(x, F.schema_of_variant(x))
        nothing = _Node(F.lit(None).cast("variant"), F.lit(None).cast("string"))
        for key, _ in _conditions(inner, nothing, place, {}):
            found.append((key, F.exists(array, _element_check(inner, place, key, as_node))))
    return found


def _element_node(schema: dict, x: Column) -> _Node:
    members = {n: _Node(x["members"][n], x["kinds"][n]) for n in _names(schema)}
    return _Node(x["value"], x["kind"], members)


def _element_check(schema: dict, label: str, key: str, as_node):
    return lambda x: F.coalesce(dict(_conditions(schema, as_node(x), label, {}))[key], F.lit(False))


def _lookup(node: Column, name: str) -> Column:
    return F.try_variant_get(node, _step(name), "variant")


def _with_members(names: list[str]):
    def run(x: Column) -> Column:
        members = F.struct(*[_lookup(x, n).alias(n) for n in names])
        return F.struct(x.alias("value"), F.schema_of_variant(x).alias("kind"), members.alias("members"))

    return run


def _with_kinds(names: list[str]):
    def run(x: Column) -> Column:
        kinds = F.struct(*[F.schema_of_variant(x["members"][n]).alias(n) for n in names])
        return F.struct(x["value"].alias("value"), x["kind"].alias("kind"), x["members"].alias("members"), kinds.alias("kinds"))

    return run


def _prepare(df: DataFrame, schema: dict) -> tuple[DataFrame, _Node, dict[str, Column]]:
    """Put the members of the document, and those of its arrays' elements, into columns: each is
    looked up once per row, however many keywords test it."""
    names = _names(schema)
    df = df.withColumn("_kind", F.schema_of_variant("_doc"))
    if not names:
        return df, _Node(F.col("_doc"), F.col("_kind")), {}
    df = df.withColumn("_members", F.struct(*[_lookup(F.col("_doc"), n).alias(n) for n in names]))
    df = df.withColumn("_kinds", F.struct(*[F.schema_of_variant(F.col("_members")[n]).alias(n) for n in names]))
    elements = {}
    for name, sub in schema.get("properties", {}).items():
        inner = sub.get("items")
        inner_names = _names(inner) if isinstance(inner, dict) else []
        if not inner_names:
            continue
        out = f"_elements_{len(elements)}"
        array = F.try_variant_get(F.col("_members")[name], "$", "array<variant>")
        df = df.withColumn(out, F.transform(array, _with_members(inner_names))).withColumn(out, F.transform(out, _with_kinds(inner_names)))
        elements[f"$.{name}[]"] = F.col(out)
    members = {n: _Node(F.col("_members")[n], F.col("_kinds")[n]) for n in names}
    return df, _Node(F.col("_doc"), F.col("_kind"), members), elements


def load_schema(path: str | None) -> dict | None:
    """Read a schema file from any file system that Spark knows; only a file that is really not there
    means that any object is accepted."""
    if path is None:
        return None
    spark = SparkSession.active()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        log.warning("there is no schema file %s; messages of its topic are not checked against one", path)
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def check_schema(df: DataFrame, schema: dict | None, value: str = "value") -> DataFrame:
    """Add ``schema_errors`` (labels in schema order) and ``schema_valid``.

    Text that is no JSON at all gets the single error ``malformed``.
    """
    schema = schema or {"type": "object"}
    prepared, root, elements = _prepare(df.withColumn("_doc", F.try_parse_json(value)), schema)
    errors = [F.when(failed, F.lit(label)) for label, failed in _conditions(schema, root, "$", elements)]
    found = F.when(F.col("_doc").isNull(), F.array(F.lit("malformed"))).otherwise(F.array_compact(F.array(*errors)))
    helpers = [c for c in prepared.columns if c not in df.columns]
    return compute_once(prepared, {"schema_errors": found}).withColumn("schema_valid", F.size("schema_errors") == 0).drop(*helpers)
