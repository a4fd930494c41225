"""Operators on headers and projections. They rename and select only, so the scan stays pruned."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.names import clean_name
from tablelift.functions.text import FIELD_SEPARATOR, as_text, encode_field


def _no_collision(before: list[str], after: list[str]) -> None:
    doubled = {name for name, times in Counter(after).items() if times > 1}
    if doubled:
        clashes = {
            name: [old for old, new in zip(before, after, strict=True) if new == name] for name in sorted(doubled)
        }
        raise ValueError(f"several columns end up with the same name: {clashes}")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Clean every header; two headers with one clean form are an error that names both."""
    names = [clean_name(name) for name in df.columns]
    _no_collision(df.columns, names)
    return df.toDF(*names)


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by an explicit map. Both sides are cleaned first; keys that match no column are ignored."""
    cleaned = {clean_name(old): clean_name(new) for old, new in mapping.items()}
    names = [cleaned.get(name, name) for name in df.columns]
    _no_collision(df.columns, names)
    return df.toDF(*names)


def project_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns in the target's order."""
    return df.select(*[F.col(f"`{name}`") for name in columns])


def keep_last_columns(df: DataFrame) -> DataFrame:
    """One column per name: where a name repeats, the last one's value at the first one's place."""
    by_position = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    last = {name: i for i, name in enumerate(df.columns)}
    return by_position.select(*[F.col(f"c{i}").alias(name) for name, i in last.items()])


def cast_all_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(
        *[as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def encode_tsv(df: DataFrame, columns: Iterable[str] | None = None, name: str = "line") -> DataFrame:
    """Add the bulk-load text line of ``columns`` (all by default) as one more column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = [encode_field(as_text(F.col(f"`{c}`"), types[c])) for c in columns or df.columns]
    return df.withColumn(name, F.concat_ws(FIELD_SEPARATOR, *fields))


# The target's name for each frame type; anything else is TEXT.
TARGET_TYPES = {
    T.ByteType: "SMALLINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION",
    T.StringType: "TEXT",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimeType: "TIME",
    T.BinaryType: "BYTEA",
}


def target_type(data_type: T.DataType) -> str:
    """The target column type of a Spark type."""
    if isinstance(data_type, T.DecimalType):
        return f"NUMERIC({data_type.precision},{data_type.scale})"
    return TARGET_TYPES.get(type(data_type), "TEXT")


def target_ddl(schema: T.StructType) -> dict[str, str]:
    """Column name to target type, in order."""
    return {field.name: target_type(field.dataType) for field in schema.fields}


def cast_for_target(df: DataFrame) -> DataFrame:
    """Cast what the target types need: zoned timestamps to plain ones, typeless and nested values to text."""

    def fitted(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.TimeType):
            value = value.cast("string")
        elif target_type(field.dataType) == "TEXT" and not isinstance(field.dataType, T.StringType):
            value = as_text(value, field.dataType)
        return value.alias(field.name)

    return df.select(*[fitted(field) for field in df.schema.fields])
