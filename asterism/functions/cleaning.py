"""Line breaks out of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from .casting import quoted

NEWLINE = "\n"
ANY_LINE_BREAK = "\r\n|\r|\n"


def _blanked(col: Column, pattern: str) -> Column:
    """A space for every match; a plain line feed needs no regular expression."""
    if pattern == NEWLINE:
        return F.replace(col, F.lit(NEWLINE), F.lit(" "))
    return F.regexp_replace(col, pattern, " ")


def clean_newlines(df: DataFrame, pattern: str = NEWLINE) -> DataFrame:
    """Replace line breaks by a space in every top-level string column."""
    return df.select(
        [
            _blanked(F.col(quoted(field.name)), pattern).alias(field.name)
            if isinstance(field.dataType, StringType)
            else F.col(quoted(field.name))
            for field in df.schema.fields
        ]
    )


def _has_text(data_type: DataType) -> bool:
    if isinstance(data_type, StructType):
        return any(_has_text(field.dataType) for field in data_type.fields)
    if isinstance(data_type, ArrayType):
        return _has_text(data_type.elementType)
    if isinstance(data_type, MapType):
        return _has_text(data_type.valueType)
    return isinstance(data_type, StringType)


def _cleaned(col: Column, data_type: DataType, pattern: str) -> Column:
    if not _has_text(data_type):
        return col
    if isinstance(data_type, StructType):
        parts = [
            _cleaned(col.getField(field.name), field.dataType, pattern).alias(field.name)
            for field in data_type.fields
        ]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(data_type, ArrayType):
        return F.transform(col, lambda item: _cleaned(item, data_type.elementType, pattern))
    if isinstance(data_type, MapType):
        return F.transform_values(col, lambda _, value: _cleaned(value, data_type.valueType, pattern))
    return _blanked(col, pattern)


def clean_newlines_nested(df: DataFrame, pattern: str = NEWLINE) -> DataFrame:
    """As ``clean_newlines``, also inside structs, arrays and map values; map keys stay."""
    return df.select(
        [
            _cleaned(F.col(quoted(field.name)), field.dataType, pattern).alias(field.name)
            for field in df.schema.fields
        ]
    )
