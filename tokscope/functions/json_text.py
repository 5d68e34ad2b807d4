"""JSON texts whose keys keep their order.

A VARIANT stores an object's keys sorted, so it can tell what a value is, but not in which order it was written. Here the order and
the nested texts come from the JSON string itself (``json_object_keys``, a map of raw texts), and the VARIANT of the same string
gives each value's kind. Expressions only; everything stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = r'"(?:[^"\\]|\\.)*"|[,:]|[^",:]+'


def elements(array: Column) -> Column:
    """The raw texts of a JSON array's elements; null if it isn't an array."""
    return F.from_json(array, "array<string>")


def keys(obj: Column) -> Column:
    """An object's keys in written order; an empty array for anything else."""
    return F.coalesce(F.json_object_keys(obj), F.array().cast("array<string>"))


def has(obj: Column, key: str) -> Column:
    return F.array_contains(keys(obj), key)


def raw(obj: Column, key: Column | str) -> Column:
    """The text of a value: nested ones as JSON, strings as they are, null for JSON null."""
    return F.element_at(F.from_json(obj, "map<string,string>"), F.lit(key) if isinstance(key, str) else key)


def kind(obj: Column, key: Column | str) -> Column:
    """The kind of a value: VOID, BOOLEAN, STRING, OBJECT<...>, ARRAY<...>, or a number's."""
    value = F.element_at(F.try_parse_json(obj).cast("map<string,variant>"), F.lit(key) if isinstance(key, str) else key)
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def spaced(text: Column) -> Column:
    """A compact JSON text with ``", "`` and ``": "`` between its parts; strings are left alone."""
    parts = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(x.isin(",", ":"), F.concat(x, F.lit(" "))).otherwise(x)), "")


def printed(text: Column, of_kind: Column) -> Column:
    """A value in text: lists and objects as JSON, true, false and null as Python prints them."""
    return (F.when(of_kind.startswith("OBJECT") | of_kind.startswith("ARRAY"), spaced(text))
            .when(of_kind == "BOOLEAN", F.initcap(text)).otherwise(F.coalesce(text, F.lit("None"))))


def printed_list(text: Column, of_kind: Column) -> Column:
    """As :func:`printed`, but a list of strings as Python prints one."""
    words = F.concat(F.lit("['"), F.array_join(elements(text), "', '"), F.lit("']"))
    return F.when(of_kind == "ARRAY<STRING>", words).otherwise(printed(text, of_kind))
