"""JSON in one form: what Python's json.dumps(row, sort_keys=True, ensure_ascii=False, default=str) writes.

The writer is an expression made from the schema, so it runs where the data is:
keys in order at every level, `, ` and `: ` between, nulls kept, floats in the
shortest form that reads back, dates and decimals as strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.text import let

# The short escapes of JSON.
ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}


def quoted(text: Column) -> Column:
    """A JSON string; other control characters are \\u00xx."""

    def escaped(t: Column) -> Column:
        for sign, short in ESCAPES.items():
            t = F.replace(t, F.lit(sign), F.lit(short))
        for code in range(0x20):
            if chr(code) not in ESCAPES:
                t = F.replace(t, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
        return t

    odd = let(text, lambda t: F.when(t.rlike(r'[\x00-\x1f"\\]'), escaped(t)).otherwise(t))
    return F.concat(F.lit('"'), odd, F.lit('"'))


def shortest(x: Column) -> Column:
    """A double as Python prints it: the fewest digits that read back as the same double."""

    def spelt(form: Column) -> Column:
        """From a mantissa and an exponent, such as 1.50e-07."""
        digits = F.rtrim(F.replace(F.substring_index(form, "e", 1), F.lit("."), F.lit("")), F.lit("0"))
        return let(F.struct(digits.alias("d"), F.substring_index(form, "e", -1).cast("int").alias("e")), placed)

    def placed(n: Column) -> Column:
        d, e, size = n["d"], n["e"], F.length(n["d"])
        zeros = lambda k: F.repeat(F.lit("0"), k)
        after = lambda k: F.substring(d, k + 1, size)
        whole = F.concat(d, zeros(e - size + 1), F.lit(".0"))
        mixed = F.concat(F.substring(d, F.lit(1), e + 1), F.lit("."), after(e + 1))
        small = F.concat(F.lit("0."), zeros(-e - 1), d)
        rest = F.when(size > 1, F.concat(F.lit("."), after(F.lit(1)))).otherwise("")
        power = F.concat(F.substring(d, 1, 1), rest, F.when(e < 0, "e-").otherwise("e+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
        return F.when((e < -4) | (e >= 16), power).when(e >= size - 1, whole).when(e >= 0, mixed).otherwise(small)

    size = F.abs(x)
    forms = [F.format_string(f"%.{n}e", size) for n in range(17)]
    form = F.coalesce(*[F.when(f.cast("double") == size, f) for f in forms[:-1]], forms[-1])
    minus = F.when(F.startswith(x.cast("string"), F.lit("-")), "-").otherwise("")
    return F.when(F.isnan(x), "NaN").when(size == float("inf"), F.concat(minus, F.lit("Infinity"))).when(x == 0, F.concat(minus, F.lit("0.0"))).otherwise(F.concat(minus, spelt(form)))


def canonical(value: Column, kind: T.DataType) -> Column:
    """The JSON text of a value of a type; a TypeError for types that JSON has no form for."""
    if isinstance(kind, T.StringType):
        text = quoted(value)
    elif isinstance(kind, T.BooleanType) or isinstance(kind, T.IntegralType):
        text = value.cast("string")
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        text = let(value.cast("double"), shortest)
    elif isinstance(kind, (T.DecimalType, T.DateType)):
        text = quoted(value.cast("string"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        exact = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        text = quoted(F.when(F.endswith(exact, F.lit(".000000")), F.substring(exact, 1, 19)).otherwise(exact))
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: canonical(x, kind.elementType)), ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        pair = lambda e: F.concat(quoted(e["key"].cast("string")), F.lit(": "), canonical(e["value"], kind.valueType))
        entries = F.array_sort(F.map_entries(value), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        text = F.concat(F.lit("{"), F.array_join(F.transform(entries, pair), ", "), F.lit("}"))
    elif isinstance(kind, T.StructType):
        return F.when(value.isNull(), "null").otherwise(canonical_object({f.name: (value[f.name], f.dataType) for f in kind.fields}))
    elif isinstance(kind, T.NullType):
        return F.lit("null")
    else:
        raise TypeError(f"no JSON form of {kind.simpleString()}")
    return F.when(value.isNull(), "null").otherwise(text)


def canonical_object(fields: dict[str, tuple[Column, T.DataType]]) -> Column:
    """A JSON object of columns, by name."""
    import json

    parts: list[Column] = []
    for name in sorted(fields):
        column, kind = fields[name]
        parts += [F.lit(f"{', ' if parts else ''}{json.dumps(name, ensure_ascii=False)}: "), canonical(column, kind)]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def canonical_row(schema: T.StructType, columns: list[str] | None = None) -> Column:
    """A row as a JSON object of its columns."""
    return canonical_object({c: (F.col(f"`{c}`"), schema[c].dataType) for c in columns or schema.fieldNames()})
