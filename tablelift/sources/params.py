"""Named parameters in query text that goes to a database."""

from __future__ import annotations

import datetime
import decimal
import re
from collections.abc import Mapping
from typing import Any

# Fixed value: quoted text and comments are passed over; ``::`` is a cast; ``:name`` is a parameter.
_MARKER = re.compile(r"('(?:[^']|'')*'|\"[^\"]*\"|--[^\n]*|/\*.*?\*/|::)|:([A-Za-z_]\w*)", re.S)


def sql_literal(value: Any) -> str:
    """A Python value as SQL text."""
    match value:
        case None:
            return "NULL"
        case bool():
            return "TRUE" if value else "FALSE"
        case int() | float() | decimal.Decimal():
            return str(value)
        case datetime.datetime():
            return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
        case datetime.date():
            return f"DATE '{value.isoformat()}'"
        case str():
            return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no SQL literal for a parameter of type {type(value).__name__}")


def bind_params(query: str, params: Mapping[str, Any] | None) -> str:
    """Fill ``:name`` markers with literals, for readers that take no bound parameters."""
    given = {name.lower(): value for name, value in (params or {}).items()}

    def filled(found: re.Match) -> str:
        passed, name = found.groups()
        if passed is not None:
            return passed
        if name.lower() not in given:
            raise ValueError(f"the query uses :{name}, which is not among the parameters {sorted(given)}")
        return sql_literal(given[name.lower()])

    return _MARKER.sub(filled, query) if given else query
