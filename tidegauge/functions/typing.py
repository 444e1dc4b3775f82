"""Loose input to declared types, and why a row is refused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clock import in_seconds, instant


def typed(df: DataFrame, field: T.StructField) -> Column:
    """The column in its declared type: NULL if the key is missing or does not convert."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    col, held = F.col(field.name), df.schema[field.name].dataType
    if held == field.dataType:
        out = col
    elif isinstance(field.dataType, T.IntegralType) and not isinstance(held, T.IntegralType):
        # "4200.0" is a whole number too, but a direct cast of the text refuses it; 4200.7 is none
        number = col.try_cast("double")
        out = F.when(number == F.floor(number), number).try_cast(field.dataType)
    elif isinstance(field.dataType, T.StringType):
        out = col.cast("string")
    else:
        out = col.try_cast(field.dataType)
    if isinstance(field.dataType, T.DoubleType):
        out = F.when(F.abs(out) < float("inf"), out)  # neither NaN, which sorts above, nor infinity
    return out.alias(field.name)


def reject_reason(
    df: DataFrame, required: Sequence[str], schema: T.StructType, unit: str = "s"
) -> Column:
    """Name of the first failing column in schema order, NULL for a good row.

    A column fails if it is required and NULL, or if it holds something that does not
    convert to its declared type: text that is no number, a fraction in a whole-number
    field, NaN or an infinity. An epoch in `unit` that is no instant fails as well.
    """
    checks = []
    for field in schema.fields:
        name = field.name
        value = typed(df, field)
        if name == "timestamp":
            value = instant(in_seconds(value, unit))
        if name in required:
            checks.append(F.when(value.isNull(), F.lit(name)))
        elif name in df.columns and (
            df.schema[name].dataType != field.dataType or isinstance(field.dataType, T.DoubleType)
        ):
            checks.append(F.when(F.col(name).isNotNull() & value.isNull(), F.lit(name)))
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")
