"""Prompt templates compiled to one concatenation.

A placeholder is `{name}`.  Known ones are replaced in one pass, so braces in
replaced text are left alone; unknown ones and other braces stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.text import as_text

_PLACE = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


def placeholders(template: str) -> list[str]:
    return sorted(set(_PLACE.findall(template)))


def unfilled(template: str, known: Mapping | set) -> list[str]:
    return [p for p in placeholders(template) if p not in known]


def render(template: str, values: Mapping[str, Column]) -> Column:
    """The template with each known placeholder replaced by its string column; null as empty."""
    parts, at = [], 0
    for m in _PLACE.finditer(template):
        if m[1] in values:
            parts += [F.lit(template[at : m.start()]), F.coalesce(values[m[1]].cast("string"), F.lit(""))]
            at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def unfilled_in(text: Column, known: list[str]) -> Column:
    """Sorted distinct placeholder names in a text column other than the known ones."""
    names = F.array_distinct(F.regexp_extract_all(text, F.lit(r"\{([A-Za-z_][A-Za-z0-9_]*)\}"), F.lit(1)))
    return F.array_sort(F.array_except(names, F.array(*[F.lit(k) for k in known]) if known else F.array().cast("array<string>")))


def skeleton(source: Column, kind: T.StructType) -> Column:
    """A JSON object in the shape of a source struct with a hint for each string to write."""
    hint = lambda name: F.lit(f"<translated {name}>")

    def of(value: Column, name: str, k: T.DataType) -> Column:
        if isinstance(k, T.ArrayType):
            return F.transform(F.coalesce(value, F.array().cast(k)), lambda x, i: F.concat(F.lit("<translated item "), (i + 1).cast("string"), F.lit(">")))
        if isinstance(k, T.StructType):
            return F.struct(*[of(value[f.name], f.name, f.dataType).alias(f.name) for f in k.fields])
        return hint(name)

    return F.to_json(F.struct(*[of(source[f.name], f.name, f.dataType).alias(f.name) for f in kind.fields]))


def json_skeleton(source: Column) -> Column:
    """The same for a JSON object of any shape, as text."""
    name = lambda k: F.to_json(F.array(k))  # noqa: E731  a quoted name in brackets
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    plain = lambda k: F.regexp_replace(name(k), r'^\["|"\]$', "")
    hint = lambda k: quoted(F.concat(F.lit("<translated "), plain(k), F.lit(">")))

    def of(key: Column, value: Column) -> Column:
        size = F.json_array_length(value)
        items = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.lit('"<translated item '), i.cast("string"), F.lit('>"'))), ",")
        parts = F.array_join(F.transform(F.json_object_keys(value), lambda k: F.concat(quoted(plain(k)), F.lit(":"), hint(k))), ",")
        shape = F.when(F.startswith(value, F.lit("[")) & (size > 0), F.concat(F.lit("["), items, F.lit("]"))).when(F.startswith(value, F.lit("[")), "[]")
        return F.concat(quoted(plain(key)), F.lit(":"), shape.when(F.startswith(value, F.lit("{")), F.concat(F.lit("{"), F.coalesce(parts, F.lit("")), F.lit("}"))).otherwise(hint(key)))

    members = F.map_entries(F.try_variant_get(F.try_parse_json(source), "$", "map<string,variant>"))
    return F.concat(F.lit("{"), F.array_join(F.transform(members, lambda e: of(e["key"], F.to_json(e["value"]))), ","), F.lit("}"))


# The names that prompts of every stage can use, besides the fields.
COMMON = ("target_language", "language", "language_code", "target_script", "source_json", "field_names", "field_names_json", "output_schema_json")


def common_values(source_json: Column, names: Column, schema: Column, language: Column, script: Column, code: Column) -> dict[str, Column]:
    """COMMON as columns, from the source as JSON, its field names and the skeleton."""
    values = (language, language, code, script, source_json, F.array_join(names, ", "), F.to_json(names), schema)
    return dict(zip(COMMON, values, strict=True))


def prompt_values(source: Column, kind: T.StructType, language: Column, script: Column, code: Column) -> dict[str, Column]:
    """What a translation prompt can name: each field and COMMON."""
    fields = {f.name.replace(".", "_"): as_text(source[f.name], f.dataType) for f in kind.fields}
    names = F.array(*[F.lit(f.name) for f in kind.fields])
    return fields | common_values(F.to_json(source, {"ignoreNullFields": "false"}), names, skeleton(source, kind), language, script, code)


def record_values(template: str, source: Column, translation: Column, language: Column, script: Column, code: Column, more: Mapping[str, Column]) -> dict[str, Column]:
    """What a prompt about a record can name: COMMON, `more`, its fields, and `<field>_translation`; source and translation are JSON.

    Records of one stage can have different fields, so a placeholder that is no
    field of a record stays as it is there.
    """
    fixed = common_values(source, F.json_object_keys(source), json_skeleton(source), language, script, code) | dict(more)
    out = {}
    for name in placeholders(template):
        if name in fixed:
            out[name] = fixed[name]
            continue
        member = lambda text, key: F.get_json_object(text, f"$['{key}']")
        found = [member(source, name)]
        if name.endswith("_translation"):
            found.append(member(translation, name.removesuffix("_translation")))
        out[name] = F.coalesce(*found, F.lit("{" + name + "}"))
    return out
