"""Chat formatting with Spark expressions only.

A conversation becomes one string of runs, each `<s>[ROLE]role[/ROLE]` text
`</s>`; the texts of adjacent turns of one role share a run, with `[TURN]`
between them.  Control strings inside roles and texts get a backslash after
their first sign (one more, if they have some), so no control string is left
inside them and the change can be undone.  The loss mask is a list of spans of
the string's UTF-8 bytes: the text of each assistant turn.

Work is linear in the turns of a conversation: runs are cut from the sorted
array at the turns that begin one, and sums of lengths run in chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import let

#: Lengths that are summed up in one array.
CHUNK = 128

# The control strings of the template, as first sign and rest.
FIRST = r"[<\[]"
REST = r"/?s>|/?INST\]|/?ROLE\]|TURN\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({FIRST})(\\*)({REST})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({FIRST})\\(\\*)({REST})", "$1$2$3")


def merged_runs(turns: Column) -> Column:
    """array<struct<..., role, text>> to array<struct<role, texts>>, adjacent turns of one role merged."""

    def cut(t: Column) -> Column:
        begins = lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])
        first = F.filter(F.sequence(F.lit(0), F.size(t) - 1), begins)

        def runs(at: Column) -> Column:
            part = lambda i, k: F.slice(t, i + 1, F.coalesce(F.get(at, k + 1), F.size(t)) - i)
            return F.transform(F.transform(at, part), lambda p: F.struct(F.get(p, F.lit(0))["role"].alias("role"), F.transform(p, lambda x: x["text"]).alias("texts")))

        return let(first, runs)

    return let(turns, cut)


def running_sums(lengths: Column) -> Column:
    """For each of an array of longs the sum of those before it: sums of chunks are added to sums within chunks."""
    add = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    sums = lambda part: F.aggregate(part, F.array(F.lit(0).cast("long")), add)

    def all_(parts: Column) -> Column:
        before = sums(F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x)))
        return let(before, lambda base: F.flatten(F.transform(parts, lambda p, k: F.transform(F.slice(sums(p), 1, F.size(p)), lambda x: x + F.get(base, k)))))

    def chunks(whole: Column) -> Column:
        last = F.floor((F.size(whole) - 1) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(whole, c * CHUNK + 1, CHUNK))

    return let(lengths, lambda whole: let(chunks(whole), all_))


def _segments(runs: Column, trained: str) -> Column:
    """The string in pieces: array<struct<s, loss>>."""
    piece = lambda s, loss: F.struct(s.alias("s"), loss.alias("loss"))
    no = F.lit(False)

    def run(r: Column) -> Column:
        texts = F.transform(r["texts"], lambda t, i: F.array(piece(F.when(i > 0, F.lit("[TURN]")).otherwise(F.lit("")), no), piece(escape(t), r["role"] == trained)))
        return F.concat(F.array(piece(F.concat(F.lit("<s>[ROLE]"), escape(r["role"]), F.lit("[/ROLE]")), no)), F.flatten(texts), F.array(piece(F.lit("</s>"), no)))

    return F.flatten(F.transform(runs, run))


def format_conversations(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row for each conv_id: conv_id, formatted, loss_spans (array of start from 0 and length, in UTF-8 bytes).

    `turns` has conv_id, turn, role and text; other columns are ignored.  Turns
    are in order of turn (null first), ties in order of role, then text; repeated
    rows are turns of their own.  Null roles and texts are empty.  Rows with a
    null conv_id are one conversation.  An empty table gives no rows.
    """
    clean = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def made(segments: Column) -> Column:
        size = F.transform(segments, lambda x: F.octet_length(x["s"]).cast("long"))
        spans = let(running_sums(size), lambda at: F.filter(F.transform(segments, lambda x, i: F.when(x["loss"], F.struct(F.get(at, i).alias("start"), F.octet_length(x["s"]).cast("long").alias("length")))), lambda s: s.isNotNull()))
        return F.struct(F.array_join(F.transform(segments, lambda x: x["s"]), "").alias("formatted"), spans.alias("loss_spans"))

    return one.select("conv_id", F.inline(F.array(let(_segments(merged_runs(F.col("turns")), trained), made))))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns and the trained text, from formatted strings and their masks: conv_id, turns, loss_text, formatted."""
    runs = F.split("formatted", "</s>")
    runs = F.slice(runs, 1, F.size(runs) - 1)

    def turns(run: Column) -> Column:
        at = F.instr(run, "[/ROLE]")
        role = unescape(F.substring(run, F.lit(len("<s>[ROLE]") + 1), at - F.lit(len("<s>[ROLE]") + 1)))
        body = F.substring(run, at + F.lit(len("[/ROLE]")), F.length(run))
        return F.transform(F.split(body, r"\[TURN\]"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    under = lambda data: F.transform("loss_spans", lambda s: unescape(F.decode(F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")))
    loss = let(F.encode("formatted", "UTF-8"), under)
    return formatted.select("conv_id", F.flatten(F.transform(runs, turns)).alias("turns"), F.array_join(loss, "").alias("loss_text"), "formatted")


def op3(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = read_back(format_conversations(rows.unionByName(extra)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) = role, false) AS same,
  length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|TURN\])', '\1\\\2\3', 'g')) AS n_text,
  length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|TURN\])', '\1\\\2\3', 'g')) AS n_role FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n_text + CASE WHEN same THEN 6 ELSE 20 + n_role END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
