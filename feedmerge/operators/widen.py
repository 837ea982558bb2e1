"""One type that holds what runs of drifting types hold.

The types form a lattice: integers widen to longer ones, numbers to double, dates to timestamps,
structs to the union of their fields, arrays and maps by their parts, and whatever has no other
type in common to text, nested values as JSON. ``widest`` is commutative but for the order of struct
fields, associative and idempotent, so the order of runs does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = (*INTEGERS, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
NESTED = (T.StructType, T.ArrayType, T.MapType)


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type of the lattice that both fit in.

    Longs beyond 2^53 and decimals lose digits when doubles join them.
    """
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _widest_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType))
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for chain in (INTEGERS, TIMES):
        if isinstance(a, chain) and isinstance(b, chain):
            return max(a, b, key=lambda t: chain.index(type(t)))
    if isinstance(a, NUMBERS) and isinstance(b, NUMBERS):
        return T.DoubleType()
    return T.StringType()


def _widest_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of both, those of ``a`` first; names that differ in case only are one field."""
    fields: dict[str, T.StructField] = {}
    for f in (*a.fields, *b.fields):
        known = fields.get(f.name.lower(), f)
        fields[f.name.lower()] = T.StructField(known.name, widest(known.dataType, f.dataType))
    return T.StructType(list(fields.values()))


def widen_column(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of type ``have`` as ``want``, which has to be as wide; null stays null."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        names = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            old = names.get(f.name.lower())
            part = widen_column(value.getField(old.name), old.dataType, f.dataType) if old else F.lit(None).cast(f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda v: widen_column(v, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keys = F.transform(F.map_keys(value), lambda k: widen_column(k, have.keyType, want.keyType))
        values = F.transform(F.map_values(value), lambda v: widen_column(v, have.valueType, want.valueType))
        return F.map_from_arrays(keys, values)
    if isinstance(have, NESTED) and isinstance(want, T.StringType):
        return F.to_json(value)
    return value.cast(want)


def widen(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in the columns of ``schema``, which has to be as wide; missing columns are null."""
    if widest(schema, df.schema) != widest(schema, schema):
        raise ValueError(f"the schema is narrower than the rows: {df.schema.simpleString()}")
    names = {f.name.lower(): f for f in df.schema.fields}
    shown = []
    for f in schema.fields:
        old = names.get(f.name.lower())
        value = widen_column(F.col(f"`{old.name.replace('`', '``')}`"), old.dataType, f.dataType) if old else F.lit(None).cast(f.dataType)
        shown.append(value.alias(f.name))
    return df.select(*shown)
