"""Canonical JSON text and a small subset of JSON Schema."""

from __future__ import annotations

import json
import math
import re
from typing import Any

REFERENCE = "$ref"


class Invalid(ValueError):
    """Text that has no canonical form."""

DEPTH = 200  # levels of objects and lists; deeper values are refused
_HALF_PAIR = re.compile("[\ud800-\udfff]")


def parse(text: str) -> Any:
    """The value of a JSON text; repeated keys and numbers that are not finite are refused."""
    def object_of(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
        found = dict(pairs)
        if len(found) < len(pairs):
            raise Invalid("repeated key")
        return found

    def constant(name: str) -> Any:
        raise Invalid(f"{name} is no JSON number")

    try:
        value = json.loads(text, object_pairs_hook=object_of, parse_constant=constant)
    except RecursionError as error:
        raise Invalid("nested too deeply") from error
    except json.JSONDecodeError as error:
        raise Invalid("no JSON") from error
    except ValueError as error:  # an integer of thousands of digits
        raise Invalid("number out of range") from error
    _refuse_odd(value)
    return value


def _refuse_odd(value: Any) -> None:
    """Values nested beyond DEPTH, and texts with half a surrogate pair, which UTF-8 cannot hold."""
    level, depth = [value], 0
    while level:
        if depth > DEPTH:
            raise Invalid("nested too deeply")
        below = []
        for here in level:
            if isinstance(here, dict):
                below += [*here, *here.values()]
            elif isinstance(here, list):
                below += here
            elif isinstance(here, str) and _HALF_PAIR.search(here):
                raise Invalid("half a surrogate pair")
        level, depth = below, depth + 1


def dump(value: Any) -> str:
    """Keys in order of their UTF-16 units, no blanks, shortest numbers, only needed escapes."""
    if isinstance(value, dict):
        items = sorted(value.items(), key=lambda item: item[0].encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join([f"{dump(k)}:{dump(v)}" for k, v in items]) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(dump, value)) + "]"
    if isinstance(value, float):
        return _number(value)
    return json.dumps(value, ensure_ascii=False)


def _number(value: float) -> str:
    if not math.isfinite(value):
        raise Invalid("number out of range")
    if value == int(value) and abs(value) < 1e21:
        return str(int(value))
    text = repr(value)
    if "e" not in text:
        return text
    digits, exponent = text.split("e")
    power = int(exponent)
    if -7 < power < 0:
        return f"{value:.{len(digits.replace('.', '').lstrip('-')) - 1 - power}f}"
    return f"{digits}e{'+' if power > 0 else ''}{power}"


def references(value: Any) -> list[str]:
    """The ids of all ``{"$ref": id}`` inside a value, each once, in order."""
    found: dict[str, None] = {}
    todo = [value]
    while todo:
        here = todo.pop()
        if isinstance(here, dict):
            if _is_reference(here):
                found[here[REFERENCE]] = None
            todo.extend(here.values())
        elif isinstance(here, list):
            todo.extend(here)
    return sorted(found)


def _is_reference(value: Any) -> bool:
    return isinstance(value, dict) and set(value) == {REFERENCE} and isinstance(value[REFERENCE], str)


_TYPES = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
}


def violations(value: Any, schema: dict[str, Any], path: str = "$") -> list[str]:
    """What a value breaks of a schema, in order; a reference stands for a value of any kind.

    Known words: type, enum, required, properties, additionalProperties (false),
    items, minimum, maximum, minLength, maxLength, pattern.
    """
    if path != "$" and _is_reference(value):
        return []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and dump(value) not in map(dump, schema["enum"]):
        found.append(f"{path}: not one of the listed values")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{path}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{path}.{k}: not expected")
    elif isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{path}[{i}]")
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            found.append(f"{path}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            found.append(f"{path}: too long")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            found.append(f"{path}: does not match")
    elif _TYPES["number"](value):
        if value < schema.get("minimum", value):
            found.append(f"{path}: too small")
        if value > schema.get("maximum", value):
            found.append(f"{path}: too large")
    return found
