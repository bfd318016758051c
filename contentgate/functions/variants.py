"""Reading union-typed JSON values held in VARIANT columns.

``try_variant_get`` happily casts "false" to FALSE and a list to its text, so every
read that depends on the JSON type asks ``schema_of_variant`` first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING, ARRAY, OBJECT, BOOLEAN, NULL = "STRING", "ARRAY", "OBJECT", "BOOLEAN", "VOID"
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")


def kind_of(value: Column) -> Column:
    """The outer type name of a JSON value (STRING, ARRAY, …, see above); NULL when absent."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def is_kind(value: Column, *kinds: str) -> Column:
    """Never NULL: an absent value is of no kind."""
    return F.coalesce(kind_of(value).isin(*kinds), F.lit(False))


def field(value: Column, name: str) -> Column:
    """A member of an object as VARIANT; NULL when missing or not an object."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def as_string(value: Column) -> Column:
    """The text of a JSON string; NULL for every other JSON type."""
    return F.when(is_kind(value, STRING), F.try_variant_get(value, "$", "string"))


def as_double(value: Column) -> Column:
    """A JSON number; NULL for every other JSON type, numeric strings included."""
    return F.when(is_kind(value, *NUMBERS), F.try_variant_get(value, "$", "double"))


def truthy_text(value: Column) -> Column:
    """The text form of a truthy value; NULL for null, false, 0, "" and missing.

    Fixed values: the text forms that count as false.
    """
    text = F.try_variant_get(value, "$", "string")
    falsy_number = F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False))
    kind = kind_of(value)
    return (
        F.when(kind == STRING, F.nullif(text, F.lit("")))
        .when(kind.isin(ARRAY, OBJECT), text)
        .when(kind == BOOLEAN, F.nullif(text, F.lit("false")))
        .when(kind.isin(*NUMBERS) & ~falsy_number, text)
    )


def elements(value: Column) -> Column:
    """A JSON list as array<variant>; NULL when the value is not a list."""
    return F.try_variant_get(value, "$", "array<variant>")
