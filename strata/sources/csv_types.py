"""Types of CSV columns from one reading of the text.

The text is read once, as strings, into a columnar stage. One aggregation over that tells, for each
column, which kinds of values it has; kinds join to the narrowest type that holds them all, and the
stage's columns are cast to it. The types are those of Spark's own inference, with two exceptions
where that depends on the order of the rows: a column that mixes bare numbers and times is text,
and a decimal column has room for the whole range of a type that some of its values need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a value can be, and numbers that Spark's reader knows by name.
INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << n for n in range(8))
NAMED_NUMBERS = ("NaN", "Inf", "-Inf", "Infinity", "-Infinity", "+Infinity", "+NaN", "-NaN")
#: Digits of a decimal at most, and of those that hold an int and a long.
MOST_DIGITS, INT_DIGITS, LONG_DIGITS = 38, 10, 20


def _value(column: str) -> Column:
    """The field, NULL where the reader takes it for missing."""
    return F.nullif(F.col(column), F.lit(""))


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, r"^[+-]?0*|\.$", ""))


def _kind(value: Column) -> Column:
    whole = value.rlike("^[+-]?[0-9]+$")
    decimal = value.rlike(r"^[+-]?[0-9]+\.?$") & (_digits(value) <= MOST_DIGITS)
    double = value.try_cast("double").isNotNull() & (
        ~value.rlike(r"(?i)^[\x00-\x20]*[+-]?(nan|inf|infinity)[\x00-\x20]*$") | value.isin(*NAMED_NUMBERS)
    )
    date = value.rlike("^-?[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull()
    kinds = (
        (whole & value.try_cast("int").isNotNull(), INT),
        (whole & value.try_cast("bigint").isNotNull(), LONG),
        (decimal, DECIMAL),
        (double, DOUBLE),
        (date, DATE),
        (value.try_cast("timestamp").isNotNull(), TIMESTAMP),
        (F.lower(value).isin("true", "false"), BOOLEAN),
    )
    made = F.when(value.isNull(), F.lit(None).cast("int"))
    for condition, kind in kinds:
        made = made.when(condition, F.lit(kind))
    return made.otherwise(F.lit(TEXT))


def joined(kinds: int | None, digits: int | None) -> T.DataType:
    """The narrowest type for values of these kinds; digits: of the longest decimal."""
    kinds = kinds or TEXT
    if not kinds & ~(INT | LONG | DECIMAL | DOUBLE):
        if kinds & DOUBLE:
            return T.DoubleType()
        if kinds & DECIMAL:
            room = (LONG_DIGITS if kinds & LONG else INT_DIGITS if kinds & INT else 1, digits or 1)
            return T.DecimalType(max(room), 0)
        return T.LongType() if kinds & LONG else T.IntegerType()
    if not kinds & ~(DATE | TIMESTAMP):
        return T.TimestampType() if kinds & TIMESTAMP else T.DateType()
    return T.BooleanType() if kinds == BOOLEAN else T.StringType()


def infer(texts: DataFrame) -> T.StructType:
    """The types of columns of strings, from all rows, in one aggregation."""
    quoted = [f"`{name.replace('`', '``')}`" for name in texts.columns]
    found = []
    for n, name in enumerate(quoted):
        value = _value(name)
        kind = _kind(value)
        found.append(F.bit_or(kind).alias(f"kinds{n}"))
        found.append(F.max(F.when(kind == DECIMAL, _digits(value))).alias(f"digits{n}"))
    row = texts.agg(*found).first()
    kinds = [joined(row[f"kinds{n}"], row[f"digits{n}"]) for n in range(len(quoted))]
    return T.StructType([T.StructField(c, kind) for c, kind in zip(texts.columns, kinds, strict=True)])


def typed(texts: DataFrame) -> DataFrame:
    """Columns of strings as the types that hold all their values."""
    columns = []
    for field in infer(texts):
        name = f"`{field.name.replace('`', '``')}`"
        is_text = isinstance(field.dataType, T.StringType)
        column = F.col(name) if is_text else _value(name).try_cast(field.dataType)
        if isinstance(field.dataType, T.DecimalType):
            column = F.regexp_replace(_value(name), r"\.$", "").cast(field.dataType)
        columns.append(column.alias(field.name))
    return texts.select(*columns)
