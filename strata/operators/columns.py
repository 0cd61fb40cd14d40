"""Matching the columns of an incoming frame to those of an existing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.site import quote

_INTEGRALS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Whole numbers that a float (24 bits) and a double (53 bits) hold without loss.
_EXACT_IN = {
    T.FloatType: (T.ByteType, T.ShortType),
    T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType),
}
_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def can_widen(source: T.DataType, target: T.DataType) -> bool:
    """True where every value of ``source`` has an equal value of ``target``'s type."""
    if source.simpleString() == target.simpleString() or isinstance(source, T.NullType):
        return True
    if isinstance(target, T.StringType):
        return isinstance(source, T.AtomicType)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return isinstance(source, T.DateType)
    if isinstance(target, T.DecimalType):
        if isinstance(source, T.DecimalType):
            whole, scale = source.precision - source.scale, source.scale
        else:
            whole, scale = _INTEGRAL_DIGITS.get(type(source), 99), 0
        return whole <= target.precision - target.scale and scale <= target.scale
    if type(source) in _INTEGRALS and type(target) in _INTEGRALS:
        return _INTEGRALS.index(type(source)) <= _INTEGRALS.index(type(target))
    return type(source) in _EXACT_IN.get(type(target), ())


def can_narrow(source: T.DataType, target: T.DataType) -> bool:
    """True for whole numbers into a smaller type, where a value that doesn't fit is an error."""
    return type(source) in _INTEGRALS and type(target) in _INTEGRALS


def _narrowed(column: Column, target: T.DataType, name: str) -> Column:
    cast = column.try_cast(target)
    overflow = F.raise_error(
        F.concat(F.lit(f"Column {name}: "), column.cast("string"), F.lit(f" overflows {target.simpleString()}."))
    )
    return F.when(cast.isNotNull() | column.isNull(), cast).otherwise(overflow.cast(target))


def by_lower_name(schema: T.StructType) -> dict[str, T.StructField]:
    """Fields by case-folded name, as Spark resolves them by default."""
    fields = {field.name.lower(): field for field in schema}
    if len(fields) != len(schema):
        raise ValueError(f"Duplicate column names: {', '.join(schema.names)}")
    return fields


def merged(target: T.DataType, source: T.DataType) -> T.DataType:
    """The target's type with the fields that only the source's structs have, at their ends."""
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        known, brought = by_lower_name(target), by_lower_name(source)
        fields = [
            T.StructField(f.name, merged(f.dataType, brought[key].dataType) if key in brought else f.dataType)
            for key, f in known.items()
        ]
        return T.StructType(
            fields + [T.StructField(f.name, f.dataType) for key, f in brought.items() if key not in known]
        )
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return T.ArrayType(merged(target.elementType, source.elementType))
    if isinstance(target, T.MapType) and isinstance(source, T.MapType):
        return T.MapType(target.keyType, merged(target.valueType, source.valueType))
    return target


def _can_conform(source: T.DataType, target: T.DataType) -> bool:
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        known = by_lower_name(target)
        return all(
            key in known and _can_conform(f.dataType, known[key].dataType)
            for key, f in by_lower_name(source).items()
        )
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return _can_conform(source.elementType, target.elementType)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        same_keys = source.keyType.simpleString() == target.keyType.simpleString()
        return same_keys and _can_conform(source.valueType, target.valueType)
    return can_widen(source, target)


def _conformed(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """The column under the target's type, fields by name, missing ones NULL."""
    if source.simpleString() == target.simpleString():
        return column
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        brought = by_lower_name(source)
        fields = []
        for f in target:
            inner = brought.get(f.name.lower())
            value = (
                _conformed(column.getField(inner.name), inner.dataType, f.dataType)
                if inner
                else F.lit(None).cast(f.dataType)
            )
            fields.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(column, lambda x: _conformed(x, source.elementType, target.elementType))
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        return F.transform_values(
            column, lambda _, x: _conformed(x, source.valueType, target.valueType)
        )
    return column.cast(target)


def aligned(
    df: DataFrame,
    target: T.StructType,
    fill_missing: bool,
    narrow: bool = False,
    nested: bool = False,
) -> list[Column | str]:
    """Columns of ``df`` under the target's names, types and order.

    Target columns that ``df`` lacks are NULL or left out. With ``narrow``, whole numbers may go
    into a smaller type, and one that doesn't fit fails the job. With ``nested``, fields inside
    structs match by name too.
    """
    incoming = by_lower_name(df.schema)
    columns: list[Column | str] = []
    for field in target:
        source = incoming.get(field.name.lower())
        if source is None:
            if fill_missing:
                columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        name = quote(source.name)
        if not can_widen(source.dataType, field.dataType):
            if narrow and can_narrow(source.dataType, field.dataType):
                columns.append(_narrowed(F.col(name), field.dataType, field.name).alias(field.name))
                continue
            if nested and _can_conform(source.dataType, field.dataType):
                made = _conformed(F.col(name), source.dataType, field.dataType)
                columns.append(made.alias(field.name))
                continue
            raise ValueError(
                f"Column {field.name}: cannot store {source.dataType.simpleString()} "
                f"as {field.dataType.simpleString()}."
            )
        if source == field:
            columns.append(name)
        else:
            columns.append(F.col(name).cast(field.dataType).alias(field.name))
    return columns
