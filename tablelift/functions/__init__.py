from tablelift.functions.names import clean_name, standardize_name
from tablelift.functions.text import (
    as_text,
    encode_field,
    expand_template,
    sql_table_name,
    sql_table_name_qualified,
)

__all__ = [
    "as_text",
    "clean_name",
    "encode_field",
    "expand_template",
    "sql_table_name",
    "sql_table_name_qualified",
    "standardize_name",
]
