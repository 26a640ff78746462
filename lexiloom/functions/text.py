"""Text functions as Spark expressions."""

from __future__ import annotations

import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as str.strip knows it; code fences and the names after them.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
FENCE, FENCED = "```", ("json", "JSON")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def is_blank(text: Column) -> Column:
    """Whether there is nothing but white space; most texts tell by their first character."""
    return F.substring(text, 1, 1).isin("", *SPACES) & (strip(text) == "")


def strip_fences(text: Column) -> Column:
    """The inside of a code fence that wraps the whole text, else the text; both stripped."""
    n = 2 * len(FENCE)

    def opened(inside: Column) -> Column:
        named = F.substring(inside, 1, len(FENCED[0])).isin(*FENCED)
        return strip(F.when(named, F.substring(inside, F.lit(len(FENCED[0]) + 1), F.length(inside))).otherwise(inside))

    def outer(bare: Column) -> Column:
        wrapped = F.startswith(bare, F.lit(FENCE)) & F.endswith(bare, F.lit(FENCE)) & (F.length(bare) >= n)
        return F.when(wrapped, let(F.substring(bare, F.lit(len(FENCE) + 1), F.length(bare) - n), opened)).otherwise(bare)

    return let(strip(text), outer)


def as_text(value: Column, kind: T.DataType) -> Column:
    """A value in a prompt: strings verbatim, whole numbers without a fraction, the rest as JSON."""
    if isinstance(kind, T.StringType):
        return F.coalesce(value, F.lit(""))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        return F.coalesce(F.when(whole, value.cast("long").cast("string")).otherwise(value.cast("string")), F.lit(""))
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.to_json(value, {"ignoreNullFields": "false"}), F.lit(""))
    return F.coalesce(value.cast("string"), F.lit(""))


def cell(value: Column, kind: T.DataType) -> Column:
    """A value in a spreadsheet: null empty, scalars as text, the rest as JSON."""
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        value = F.to_json(value, {"ignoreNullFields": "false"})
    return F.coalesce(value.cast("string"), F.lit(""))


def slug(title: Column, length: int = 60) -> Column:
    """Lower case, other than a-z and 0-9 as single hyphens, none at the ends, cut."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, length)


def file_safe(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9._-]+", "_")


def request_key(ordinal: Column, *parts: Column, length: int = 120) -> Column:
    """A key that is safe in file names and unique by its ordinal."""
    body = F.concat_ws("-", *[F.regexp_replace(p.cast("string"), "[^A-Za-z0-9_.-]+", "_") for p in parts])
    return F.substring(F.concat_ws("-", F.format_string("%06d", ordinal), body), 1, length)


def attempt_key(key: Column, attempt: Column) -> Column:
    return F.concat(key, F.lit("--a"), attempt.cast("string"))


def record_id(benchmark: Column, config: Column, split: Column, row_id: Column, language: Column, group: Column) -> Column:
    return F.concat_ws("|", benchmark, config, split, row_id, language, F.concat(F.lit("g"), group.cast("string")))


def normalise(text: Column) -> Column:
    """Lines end in \\n and not in blanks, spaces are plain, at most one line in a row is empty, nothing surrounds the text."""
    lines = F.split(F.replace(text, F.lit("\xa0"), F.lit(" ")), r"\r?\n")
    return strip(F.regexp_replace(F.array_join(F.transform(lines, lambda x: F.rtrim(x, F.lit(" \t"))), "\n"), r"\n{3,}", "\n\n"))


# The character references that unescape_basic decodes.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&middot;": "·", "&copy;": "©", "&amp;": "&"}


def unescape_basic(text: Column) -> Column:
    """Decode the references of REFERENCES; `&amp;` last, so nothing is decoded twice."""
    for name, sign in REFERENCES.items():
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


@F.pandas_udf(T.StringType())
def unescape(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Decode all HTML character references."""
    for s in texts:
        yield s.map(html.unescape, na_action="ignore")


#: The pieces of a fragment: what is left out whole, a tag, or text between tags.
PIECE = r"(?s)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<[^>]+>|[^<]+|<"


# The headings of the parts of a panel.
ANSWER = r"<strong>\s*Answer\s*:?\s*</strong>\s*:?\s*"
SOLUTION = r"<strong>\s*Solution\s*:?\s*</strong>\s*:?\s*"


def _plain(piece: Column, before: Column, after: Column) -> Column:
    """What a piece stands for in plain text, between the pieces before and after it."""
    name = F.lower(F.regexp_extract(piece, r"^<(/?\w+)", 1))
    language = F.coalesce(F.nullif(F.regexp_extract(piece, r'data-language="([^"]*)"', 1), F.lit("")), F.regexp_extract(after, r'^<code class="language-(\w+)"', 1))
    space, line = F.trim(piece, F.lit(SPACES)) == "", F.startswith(after, F.lit('<span class="line">'))
    closed = before.isin("</p>", "</li>", "</div>")  # white space after these is none of the text
    text = F.when(closed, F.ltrim(piece, F.lit(SPACES))).when(space & line & (before == "</span>"), "\n").otherwise(piece)
    mark = F.when(name == "pre", F.concat(F.lit("\n\n```"), language, F.lit("\n"))).when(name == "/pre", "\n```\n\n").when(name == "br", "\n").when(name == "li", "- ").when(name.isin("/p", "/li", "/div"), "\n\n").when((name == "/span") & line, "\n").otherwise("")
    return F.when(piece == "<", piece).when(F.startswith(piece, F.lit("<")), mark).otherwise(text)


def strip_tags(fragment: Column, decode=unescape_basic) -> Column:
    """HTML fragment to plain text: paragraphs and items apart, `pre` as fenced code, other tags dropped."""
    at = lambda pieces, i: F.coalesce(F.get(pieces, i), F.lit(""))
    plain = let(F.regexp_extract_all(fragment, F.lit(PIECE), F.lit(0)), lambda pieces: F.array_join(F.transform(pieces, lambda p, i: _plain(p, at(pieces, i - 1), at(pieces, i + 1))), ""))
    return normalise(decode(plain))


def split_answer(panel: Column) -> Column:
    """struct(answer, solution): from the answer mark to the solution mark, else to the end of its paragraph."""
    halves = F.split(panel, ANSWER, 2)
    rest = F.get(halves, F.lit(1))
    by_mark, by_paragraph = F.split(rest, SOLUTION, 2), F.split(rest, "</p>", 2)
    answer = F.when(F.size(by_mark) > 1, by_mark[0]).otherwise(by_paragraph[0])
    solution = F.when(F.size(by_mark) > 1, F.get(by_mark, F.lit(1))).otherwise(F.coalesce(F.get(by_paragraph, F.lit(1)), F.lit("")))
    return F.struct(F.when(F.size(halves) > 1, answer).otherwise(F.lit("")).alias("answer"), F.when(F.size(halves) > 1, solution).otherwise(panel).alias("solution"))


def split_uri(uri: Column) -> Column:
    """struct(scheme, bucket, key) of an object address."""
    pattern = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/?(.*)$"
    return F.struct(*[F.regexp_extract(uri, pattern, i).alias(n) for i, n in enumerate(("scheme", "bucket", "key"), 1)])


def state_name(state: Column) -> Column:
    """The last part of a dotted state name."""
    return F.substring_index(state, ".", -1)


def qualified_model(model: Column, mode: Column, provider_model: Column, prefix: str = "vertex_ai/") -> Column:
    """The name sent to a provider: the explicit one, else a bare name gets a prefix in parallel mode."""
    bare = F.when(F.instr(model, "/") > 0, model).otherwise(F.concat(F.lit(prefix), model))
    return F.when(mode == "parallel", F.coalesce(provider_model, bare)).otherwise(model)
