"""Schemas that grow in depth: the least type that holds two, and reading old files by it.

Scalars widen along int, bigint, double, string; decimals, dates, times and booleans meet other scalars in
string.  Structs take the fields of both and merge those that they share, arrays merge their elements, maps
their keys and values.  A nested type meets a scalar, or another kind of nested type, in string, as JSON.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDTH = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if isinstance(a, T.NullType) or a == b:
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merged_type(a.keyType, b.keyType), merged_type(a.valueType, b.valueType), True)
    if isinstance(a, _WIDTH) and isinstance(b, _WIDTH):
        wide = max(a, b, key=lambda t: _WIDTH.index(type(t)))
        # A float does not hold all ints, a double is the next that holds both.
        return T.DoubleType() if isinstance(wide, T.FloatType) and type(a) is not type(b) else wide
    return T.StringType()


def merged_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of ``a`` in their order, then those that only ``b`` has; all may be null."""
    theirs = {f.name: f for f in b.fields}
    fields = [T.StructField(f.name, merged_type(f.dataType, theirs.pop(f.name).dataType) if f.name in theirs else f.dataType, True, f.metadata) for f in a.fields]
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True, f.metadata) for f in theirs.values()])


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    return reduce(merged_schema, schemas)


def as_type(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of type ``have`` as ``want``, a type that holds it; fields that it lacks are null."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name: f for f in have.fields}
        members = [as_type(value[f.name], own[f.name].dataType, f.dataType) if f.name in own else F.lit(None).cast(f.dataType) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*[m.alias(f.name) for m, f in zip(members, want.fields)]))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: as_type(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: as_type(v, have.valueType, want.valueType))
    if isinstance(want, T.StringType) and isinstance(have, _NESTED):
        return F.to_json(value)
    return value.cast(want)


def read_as(df: DataFrame, want: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``want``: a projection, so old files are not rewritten."""
    own = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(as_type(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])


def merge_generations(generations: list[DataFrame]) -> DataFrame:
    """The rows of all generations of a table under their common schema."""
    want = common_schema([g.schema for g in generations])
    return reduce(DataFrame.unionByName, [read_as(g, want) for g in generations])


def changes(old: T.StructType, new: T.StructType, at: str = "") -> list[tuple[str, str, str | None, str | None]]:
    """(field, change, old type, new type) in depth, in the order of the merged schema; same ones are left out."""
    found: list[tuple[str, str, str | None, str | None]] = []
    a, b = ({f.name: f.dataType for f in s.fields} for s in (old, new))
    for name in [*a, *[n for n in b if n not in a]]:
        path, x, y = f"{at}{name}", a.get(name), b.get(name)
        if x is None or y is None:
            found.append((path, "added" if x is None else "removed", x and x.simpleString(), y and y.simpleString()))
            continue
        mark = path
        while isinstance(x, T.ArrayType) and isinstance(y, T.ArrayType):
            x, y, mark = x.elementType, y.elementType, f"{mark}[]"
        if isinstance(x, T.StructType) and isinstance(y, T.StructType):
            found += changes(x, y, f"{mark}.")
        elif x != y:
            found.append((mark, "widened" if merged_type(x, y) == y else "changed", x.simpleString(), y.simpleString()))
    return found
