"""Strict JSON objects: one cheap typed pass, and VARIANT only where types are in doubt.

Two things a plain ``from_json`` gets wrong matter here:

* It accepts text after the first JSON value.  The text is therefore parsed as
  the first element of an array whose second element repeats the text's hash.
  Trailing text, a premature ``]`` or more elements all lose the hash from its
  place.
* It reads 7 as ``'7'`` and cannot tell an absent field from a null one.
  VARIANT can, at several times the price.  All fields are read as text first;
  only a row with a field that *might* not be a string (it is null, or looks
  like another JSON type) is parsed a second time for its JSON types.  A field
  whose quoted name stands nowhere in a text without escapes is absent, so a
  row that merely lacks it needs no second parse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What schema_of_variant() calls the JSON types.
STRING, NULL, BOOLEAN, INTEGER = "STRING", "VOID", "BOOLEAN", "BIGINT"

INTEGER_PATTERN = r"^-?\d{1,19}$"

# The reader's leniencies that JSON does not have.
_STRICT = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"

# The functions below take and give SQL text where they are building blocks of
# longer expressions: one parsed text is far cheaper to build than a tree of
# Column calls.


def may_be_other_type(text: str) -> str:
    """Could this text, read from a JSON value, come from something else than a string?"""
    return (
        f"(substring({text}, 1, 1) IN ('{{', '[') OR {text} IN ('true', 'false')"
        f" OR (substring({text}, 1, 1) BETWEEN '-' AND '9' AND {text} RLIKE '^[0-9.eE+-]+$'))"
    )


class JsonObject:
    """The JSON object in a text column, attached to a DataFrame as helper columns.

    ``typed`` names the fields whose JSON type is asked for; those in
    ``optional`` are treated the same when null and when absent, and those in
    ``integers`` when a whole number is written as a number and as a string.
    """

    def __init__(
        self, text: str, fields: Sequence[str], typed: Sequence[str] | None = None, optional: Sequence[str] = (),
        integers: Sequence[str] = (),
    ):
        self.text_column = text
        self.fields = tuple(fields)
        self.typed = self.fields if typed is None else tuple(typed)
        self.optional = frozenset(optional)
        self.integers = frozenset(integers)

    def _doubtful(self, name: str) -> str:
        value = f"{self._helper('first')}.{name}"
        doubt = may_be_other_type(value)
        if name in self.integers:
            doubt = f"({doubt} AND NOT {value} RLIKE r'{INTEGER_PATTERN}')"
        if name in self.optional:
            return f"coalesce({doubt}, false)"
        named = f"""contains({self.text_column}, '"{name}"') OR contains({self.text_column}, r'\\')"""
        return f"coalesce({doubt}, {self._helper('first')} IS NULL OR {named})"

    def _helper(self, name: str) -> str:
        return f"__{self.text_column}_{name}"

    def attach(self, df: DataFrame) -> DataFrame:
        """Add the helper columns; each stage of them is evaluated once per row."""
        text, columns = self.text_column, df.columns
        parts, first, sealed, variant, valid = (
            self._helper(h) for h in ("parts", "first", "sealed", "variant", "valid")
        )
        seal = f"CAST(xxhash64({text}) AS STRING)"
        wrapped = f"""concat('[', {text}, ',{{"seal":"', {seal}, '"}}]')"""
        schema = ",".join(f"`{name}`:string" for name in (*self.fields, "seal"))
        doubts = [f"NOT {sealed}", *map(self._doubtful, self.typed)]
        # Without a variant every typed field is a string, or is optional and has none.
        kinds = [
            f"""CASE WHEN {valid} AND {first} IS NOT NULL THEN
                CASE WHEN {variant} IS NOT NULL
                     THEN schema_of_variant(try_variant_get({variant}, '$[0].{name}', 'variant'))
                     WHEN {first}.{name} IS NOT NULL THEN '{STRING}' END
                END AS {self._helper(f"kind_{name}")}"""
            for name in self.typed
        ]
        return (
            df.selectExpr("*", f"from_json({wrapped}, 'array<struct<{schema}>>', {_STRICT}) AS {parts}")
            .selectExpr(
                "*",
                f"try_element_at({parts}, 1) AS {first}",
                f"coalesce(size({parts}) = 2 AND try_element_at({parts}, 2).seal = {seal}, false) AS {sealed}",
            )
            # Text that is valid but no object has no parts; the variant decides.
            .selectExpr("*", f"try_parse_json(CASE WHEN {' OR '.join(doubts)} THEN {wrapped} END) AS {variant}")
            .selectExpr(
                "*",
                f"""{sealed} OR (coalesce(try_variant_get({variant}, '$[1].seal', 'string') = {seal}, false)
                    AND try_variant_get({variant}, '$[2]', 'variant') IS NULL) AS {valid}""",
            )
            .selectExpr(
                *columns,
                valid,
                f"""{valid} AND coalesce(is_variant_null(try_variant_get({variant}, '$[0]', 'variant')), false)
                    AS {self._helper("null")}""",
                f"{valid} AND {first} IS NOT NULL AS {self._helper('object')}",
                *[f"CASE WHEN {valid} THEN {first}.{name} END AS {self.raw(name)}" for name in self.fields],
                *kinds,
            )
        )

    def is_valid(self) -> str:
        """The text is exactly one JSON value, of any type."""
        return self._helper("valid")

    def is_null(self) -> str:
        """The text is the JSON value null."""
        return self._helper("null")

    def is_object(self) -> str:
        return self._helper("object")

    def raw(self, name: str) -> str:
        """A string's value, or the JSON text of any other type."""
        return self._helper(f"raw_{name}")

    def kind(self, name: str) -> str:
        """The field's JSON type: SQL null when absent, ``VOID`` for JSON null."""
        return self._helper(f"kind_{name}")

    def string(self, name: str) -> str:
        """The field if it is a string; null for any other type."""
        return f"CASE WHEN {self.kind(name)} = '{STRING}' THEN {self.raw(name)} END"


def evaluated_once(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` as a one-element generator, which keeps its expressions in one place.

    Catalyst moves a filter below a projection by substituting expressions: a
    filter on a column computed from parsed JSON would parse the text again for
    each reference.  Filters on generated columns stay above the generator.
    """
    return df.select(F.inline(F.array(F.struct(*(df.columns if columns is None else columns)))))


def is_number(kind: str) -> str:
    return f"({kind} IN ('{INTEGER}', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL'))"


def is_array(kind: str) -> str:
    return f"startswith({kind}, 'ARRAY')"


def is_truthy(kind: str, raw: str) -> str:
    """False for absent, null, ``false``, 0 and ``""``; true for everything else."""
    return f"""coalesce(CASE
        WHEN {kind} = '{STRING}' THEN {raw} <> ''
        WHEN {kind} = '{BOOLEAN}' THEN {raw} = 'true'
        WHEN {kind} = '{NULL}' THEN false
        WHEN {is_number(kind)} THEN try_cast({raw} AS DOUBLE) <> 0
        ELSE {kind} IS NOT NULL END, false)"""


def as_json(kind: str, raw: str) -> str:
    """The field as JSON text again; null when absent."""
    return f"""CASE WHEN {kind} = '{STRING}' THEN {quoted(raw)} WHEN {kind} = '{NULL}' THEN 'null'
        WHEN {kind} IS NOT NULL THEN {raw} END"""


def as_key(kind: str, raw: str) -> str:
    """A message key for any JSON value: text as it is, other types as their text form."""
    return f"""CASE WHEN startswith({kind}, 'OBJECT') THEN '[object Object]'
        WHEN {is_array(kind)} THEN array_join(from_json({raw}, 'array<string>'), ',', '')
        WHEN {kind} <> '{NULL}' THEN {raw} END"""


def quoted(text: str) -> str:
    """A JSON string literal."""
    return f"regexp_extract(to_json(array({text})), '(?s)^.(.*).$', 1)"


def splice(json_object: str, name: str, raw_json: str) -> str:
    """Append a field holding ``raw_json`` verbatim to a non-empty JSON object text."""
    return f"""concat(left({json_object}, length({json_object}) - 1), ',"{name}":', {raw_json}, '}}')"""
