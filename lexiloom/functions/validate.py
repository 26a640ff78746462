"""Validation of a translation against its source: the source's types are the contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.parse import has_key, kind_of, member
from lexiloom.functions.text import is_blank, let, strip

#: Listed one by one: Java looks single characters up in a table, and goes through ranges one after the other.
CONTROL = "[" + "".join(f"\\x{i:02x}" for i in range(32) if chr(i) not in "\t\n\r") + "]"


def tabs(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\t"), F.lit("")))


def control_error(name: str, text: Column, source: Column, may: Column | None = None) -> Column:
    """An error for control characters (looked for where there may be some), or for more tabs than the source has."""
    found = text.rlike(CONTROL) if may is None else may & text.rlike(CONTROL)
    more = F.contains(text, F.lit("\t")) & (tabs(text) > tabs(F.coalesce(source, F.lit(""))))
    return F.when(found, F.lit(f"field '{name}': control character")).when(more, F.lit(f"field '{name}': more tabs than the source"))


def _may_hold_control(json_text: Column) -> Column:
    """Whether strings of a JSON text can hold control characters: they are escaped in it, as \\u, \\b or \\f."""
    return F.contains(json_text, F.lit("\\u")) | F.contains(json_text, F.lit("\\b")) | F.contains(json_text, F.lit("\\f"))


def _shaped(value: Column, kind: T.DataType) -> Column:
    """A VARIANT in the shape of the source field: numbers and booleans as JSON text for strings, JSON text of a list as that list."""
    if isinstance(kind, T.StringType):
        return F.when(kind_of(value).isin("string", "number", "boolean"), F.try_variant_get(value, "$", "string"))
    if isinstance(kind, T.ArrayType):
        decoded = F.when(kind_of(value) == "string", F.try_parse_json(F.try_variant_get(value, "$", "string"))).otherwise(value)
        lists = let(decoded, lambda d: F.when(kind_of(d) == "array", d))
        return F.try_variant_get(lists, "$", "array<string>") if isinstance(kind.elementType, T.StringType) else F.from_json(F.to_json(lists), kind)
    return F.from_json(F.to_json(value), kind) if isinstance(kind, (T.StructType, T.MapType)) else F.try_variant_get(value, "$", kind.simpleString())


def field_value(parsed: Column, name: str, kind: T.DataType) -> Column:
    return let(member(parsed, name), lambda v: _shaped(v, kind))


def field_error(parsed: Column, name: str, source: Column, kind: T.DataType) -> Column:
    """The first error of one field, or null."""
    absent = lambda v: F.when(v.isNull() & ~has_key(parsed, name), F.lit(f"missing field '{name}'"))  # noqa: E731  what is found needs no second look
    missing = let(member(parsed, name), absent)
    if isinstance(kind, T.StringType):

        def wrong(v: Column) -> Column:
            shape = F.when(v.isNull(), F.lit(f"field '{name}': expected a string")).when(is_blank(v) & ~is_blank(source), F.lit(f"field '{name}': empty translation"))
            return F.coalesce(shape, control_error(name, v, source, _may_hold_control(parsed)))

    elif isinstance(kind, T.ArrayType):

        def wrong(v: Column) -> Column:
            shape = F.when(v.isNull(), F.lit(f"field '{name}': expected a list")).when(
                F.size(v) != F.size(source), F.concat(F.lit(f"field '{name}': expected "), F.size(source).cast("string"), F.lit(" items, got "), F.size(v).cast("string"))
            )
            if not isinstance(kind.elementType, T.StringType):
                return shape
            blank = F.when(F.exists(v, lambda x: F.coalesce(strip(x) == "", F.lit(False))), F.lit(f"field '{name}': list contains an empty item"))
            item = F.zip_with(v, source, lambda x, y: control_error(name, F.coalesce(x, F.lit("")), y))  # item by item: a tab may not move
            return F.coalesce(shape, blank, F.get(F.filter(item, lambda e: e.isNotNull()), F.lit(0)))

    elif isinstance(kind, T.StructType):
        keys = F.json_object_keys(F.to_json(member(parsed, name)))
        lost = F.array_sort(F.array_except(F.array(*[F.lit(f.name) for f in kind.fields]), keys))
        shape = F.when(keys.isNull(), F.lit(f"field '{name}': expected an object")).when(F.size(lost) > 0, F.concat(F.lit(f"field '{name}': missing keys "), F.array_join(lost, ",")))
        return F.coalesce(missing, F.when(source.isNotNull(), shape))
    else:
        return missing
    return let(member(parsed, name), lambda v: F.coalesce(absent(v), F.when(source.isNotNull(), let(_shaped(v, kind), wrong))))


def translation_error(parsed: Column, source: Column, kind: T.StructType) -> Column:
    """The error of the first failing field in source order; null if the translation is usable."""
    return F.coalesce(*[field_error(parsed, f.name, source[f.name], f.dataType) for f in kind.fields])


def cleaned(parsed: Column, kind: T.StructType) -> Column:
    """The translation as a struct in the shape of its source."""
    return F.struct(*[field_value(parsed, f.name, f.dataType).cast(f.dataType).alias(f.name) for f in kind.fields])
