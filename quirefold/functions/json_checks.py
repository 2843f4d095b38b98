"""Strict JSON parsing and type-aware access, as native column expressions.

A VARIANT path read converts ("12" reads as the number 12), so every read of a
field whose JSON type matters is paired with a type test.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_wrapped(text: Column) -> Column:
    """VARIANT of the one-element array ``[text]``, NULL if that is not JSON."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def is_single_value(wrapped: Column, text: Column) -> Column:
    """True if ``text`` is exactly one JSON value, given ``wrapped = parse_wrapped(text)``.

    The parser stops at the end of the first value and ignores what follows. Inside
    the brackets that can only hide trailing text if the text brings a ``]`` of its
    own; such text must also parse as a member of an object.
    """
    second = F.try_variant_get(wrapped, "$[1]", "variant")
    as_member = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    # a first value is there unless the brackets hold white space alone; reading it would copy the whole value
    alone = wrapped.isNotNull() & ~text.rlike(r"^[ \t\n\r]*(\]|\z)") & second.isNull()
    exact = F.when(F.contains(text, F.lit("]")), alone & as_member.isNotNull()).otherwise(alone)
    return F.coalesce(exact, F.lit(False))


def is_object(text: Column) -> Column:
    """True if valid JSON text is an object."""
    return text.rlike(r"^[ \t\n\r]*\{")


def json_type(variant: Column, path: str) -> Column:
    """JSON type at ``path``: BIGINT, DECIMAL(..), DOUBLE, STRING, BOOLEAN, VOID (JSON null),
    ARRAY<..>, OBJECT<..>; NULL where the path is absent."""
    return F.schema_of_variant(F.try_variant_get(variant, path, "variant"))


def json_string(variant: Column, path: str) -> Column:
    """The string at ``path``; NULL if absent or not a JSON string."""
    # only strings convert to binary, so this is the read and the type test in one
    return F.try_variant_get(variant, path, "binary").cast("string")


def json_text(variant: Column, path: str) -> Column:
    """The scalar at ``path`` as text, of whatever type."""
    return F.try_variant_get(variant, path, "string")


def json_long(variant: Column, path: str) -> Column:
    """The number at ``path`` as a 64-bit integer; gate it with ``json_type``."""
    return F.try_variant_get(variant, path, "bigint")


def json_double(variant: Column, path: str) -> Column:
    return F.try_variant_get(variant, path, "double")


def is_number_type(kind: Column) -> Column:
    return (kind == "BIGINT") | (kind == "DOUBLE") | F.startswith(kind, F.lit("DECIMAL"))


def is_true_false(variant: Column, path: str, wanted: bool) -> Column:
    """True if the field is the JSON literal true (or false), not something that converts to it."""
    value = F.try_variant_get(variant, path, "boolean")
    return F.coalesce((json_type(variant, path) == "BOOLEAN") & (value == F.lit(wanted)), F.lit(False))


def is_empty_like(text: Column) -> Column:
    """True for the text of a JSON value that counts as 'nothing given':
    null or absent, false, zero, and empty string, array or object."""
    return text.isNull() | text.isin("", "false", "[]", "{}") | text.rlike(r"^-?0(\.0+)?(E-?\d+)?$")


def compact_json(*cols: str) -> Column:
    """Compact JSON object of the named columns, in the given order."""
    return F.to_json(F.struct(*cols))
