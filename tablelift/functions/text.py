"""Text forms: bulk-load fields and lines, templates, and table names out of SQL text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The bulk-load text format.
FIELD_SEPARATOR = "\t"
NULL_MARKER = "\\N"
ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]

# How a table name is found in SQL text, and what stands for none.
TABLE_WORD = r"(?iU)(?:FROM|INTO|UPDATE)\s+(\w+)"
TABLE_QUALIFIED = r"(?iU)FROM\s+(\w+\.\w+|\w+)"
NO_TABLE = "unknown"

# Fixed value: a template is cut into ${NAME} markers, text without a dollar sign, and single dollar signs.
TEMPLATE_TOKEN = r"(?U)(\$\{\w+\}|[^$]+|\$)"


def as_text(value: Column, data_type: T.DataType) -> Column:
    """The text form of a value; nested values become JSON and bytes become ``\\x`` hex."""
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.to_json(value)
    if isinstance(data_type, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(value)))
    return value.cast("string")


def encode_field(text: Column) -> Column:
    """One field of a bulk-load line: special characters escaped, null as ``\\N``."""
    for raw, escaped in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return F.coalesce(text, F.lit(NULL_MARKER))


def sql_table_name(sql: Column) -> Column:
    """The first table a statement names, in lower case; the schema part if there is one."""
    return F.lower(_found(sql, TABLE_WORD))


def sql_table_name_qualified(sql: Column) -> Column:
    """The first table after FROM as written, with its schema."""
    return _found(sql, TABLE_QUALIFIED)


def _found(sql: Column, pattern: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(sql, pattern, 1), F.lit("")), F.lit(NO_TABLE))


def expand_template(template: Column, values: Column) -> Column:
    """Replace ``${NAME}`` by the map entry of that name, in one pass; unknown names stay."""
    tokens = F.regexp_extract_all(template, F.lit(TEMPLATE_TOKEN), F.lit(1))

    def filled(token: Column) -> Column:
        name = F.regexp_extract(token, r"^\$\{(.*)\}$", 1)
        return F.when(token.startswith("${"), F.coalesce(F.try_element_at(values, name), token)).otherwise(token)

    return F.array_join(F.transform(tokens, filled), "")
