"""Reading a copy configuration: variables, numbers, flags and cross-references."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping
from typing import Any

# Fixed value: how a variable is written.
VARIABLE = re.compile(r"\$\{(\w+)\}")
TRUE_WORDS = {"true", "yes", "on", "1"}
# What a load's config must have in a mode.
NEEDED = {"chunked": ("chunk_key",), "stream": ("checkpoint", "key")}
REPEATED = "the name is used by several extractions"
FALSE_WORDS = {"false", "no", "off", "0", ""}


def expand_settings(settings: Any, values: Mapping[str, str]) -> Any:
    """A copy of nested settings with ``${NAME}`` filled from ``values``; unknown names stay as written."""
    match settings:
        case str():
            return VARIABLE.sub(lambda marker: str(values.get(marker[1], marker[0])), settings)
        case Mapping():
            return {key: expand_settings(value, values) for key, value in settings.items()}
        case list() | tuple():
            return [expand_settings(value, values) for value in settings]
        case _:
            return settings


def as_bool(value: Any) -> bool:
    """A flag given as a boolean, a number or a word."""
    word = str(value).strip().lower()
    if word in TRUE_WORDS:
        return True
    if word in FALSE_WORDS:
        return False
    raise ValueError(f"{value!r} is neither true nor false")


def as_size(value: Any, name: str = "size") -> int:
    """A positive whole number, also when it comes as text."""
    size = int(str(value).strip())
    if size < 1:
        raise ValueError(f"{name} must be at least 1, not {value!r}")
    return size


def check_config(
    config: Mapping[str, Any], sources: Collection[str], targets: Collection[str]
) -> list[tuple[str, str]]:
    """What is wrong with a configuration, as (name, problem) pairs; nothing is read or written."""
    extractions, loads = config.get("extractions") or [], config.get("loads") or []
    names = [e.get("name", "unnamed") for e in extractions]
    fed = {load.get("source") for load in loads}
    found = [(n, REPEATED) for n in sorted({n for n in names if names.count(n) > 1})]
    for extraction in extractions:
        name = extraction.get("name", "unnamed")
        if str(extraction.get("source")).lower() not in sources:
            found.append((name, f"unknown source {extraction.get('source')!r}"))
        if name not in fed:
            found.append((name, "no load uses this extraction"))
    for load in loads:
        name = load.get("name", "unnamed")
        if str(load.get("target")).lower() not in targets:
            found.append((name, f"unknown target {load.get('target')!r}"))
        if load.get("source") not in names:
            found.append((name, f"the extraction {load.get('source')!r} does not exist"))
        needed = NEEDED.get(config.get("mode", "batch"), ())
        if load.get("mode") == "upsert" and not needed:
            needed = ("keys",)
        found += [(name, f"the load's config needs {setting!r}") for setting in needed if not (load.get("config") or {}).get(setting)]
    return found
