"""Queries of identity, fan-out, prompts, parsing, validation, inference and routing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions import canonical, contracts, hashing, judgement, parse, template, text, validate
from lexiloom.operators import batches, calls, fanout, identity, inference, routing
from lexiloom.plans import fixture, stages
from lexiloom.plans.catalogue import query
from lexiloom.plans.fixture import BASE, table
from lexiloom.sources import config as configs
from lexiloom.sources import versions
from lexiloom.sources.shared import new_path, stored

PROMPT = "Translate into {language} ({script}). Keep {braces}.\n{text}"
PROMPT_SQL = "('Translate into ' || language || ' (' || script || '). Keep {braces}.' || chr(10) || coalesce(text, ''))"
TEXT = T.StructType([T.StructField("text", T.StringType())])


def requests(spark, sf_dir):
    items = fixture.items(spark, sf_dir, texts=True)
    prompt = template.render(PROMPT, {"language": F.col("language"), "script": F.col("script"), "text": F.col("text")})
    return items.withColumns({"prompt": prompt, "key": F.col("record_id")})


@query(f"""WITH {BASE} SELECT language, count(*)::BIGINT AS n_items, count(*)::BIGINT AS n_valid,
  sum(CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END)::BIGINT AS n_attempts, sum(length(coalesce(text, '')) + length(language) + 3)::BIGINT AS translated_chars
FROM items GROUP BY language""")
def translate_summary(spark, sf_dir):
    """Fan out, render, send the prompts to a model, parse, validate, ask again what failed, and sum by language; every answer is logged."""
    asked = requests(spark, sf_dir).select("key", "language", "prompt")
    model = fixture.model(fixture.translator)
    plan = inference.phases(inference.Phase("primary", "batch", "m", 2, model), inference.Phase("fallback", "parallel", "m", 1, model))

    def error_of(response):
        source = F.struct(F.substr("prompt", F.locate("\n", F.col("prompt")) + 1).alias("text"))
        return text.let(parse.json_object(response), lambda p: F.coalesce(p["error"], validate.translation_error(p["value"], source, TEXT)))

    _, final = inference.run_with_retries(asked, plan, error_of, inference.Answers(new_path(spark, "answers"), ["language"]), prompts=False)
    bare = F.col("ok") & F.startswith("text", F.lit("{")) & F.endswith("text", F.lit("}"))  # was parsed as it is
    size = F.length(F.get_json_object(F.when(bare, F.col("text")).otherwise(parse.json_object(F.col("text"))["value"]), "$.text"))
    return final.groupBy("language").agg(F.count(F.lit(1)).alias("n_items"), F.count_if("ok").cast("long").alias("n_valid"), F.sum("attempt").cast("long").alias("n_attempts"), F.sum(size).cast("long").alias("translated_chars"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_index, concat_ws('|', 'docs', 'default', lang, doc_id::VARCHAR, 'Hindi', 'g0') AS record_id FROM documents")
def row_identity(spark, sf_dir):
    d = identity.row_index(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["doc_id"])
    rid = text.record_id(F.lit("docs"), F.lit("default"), F.col("lang"), F.col("doc_id").cast("string"), F.lit("Hindi"), F.lit(0))
    return d.select("doc_id", "row_index", rid.alias("record_id"))


@query("SELECT doc_id, CASE WHEN k > 0 THEN source || '#' || k ELSE source END AS row_id FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k FROM documents)")
def dup_id_disambiguation(spark, sf_dir):
    return identity.disambiguate(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", ["doc_id"]).select("doc_id", "row_id")


@query(f"""WITH h AS (SELECT doc_id, sha1(from_hex('{hashing.NAMESPACE.hex}') || encode('docs|default|' || lang || '|' || doc_id::VARCHAR)) AS h FROM documents)
SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  substr('89ab', ((strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1)::INT, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS row_uuid FROM h""")
def uuid5_row_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", hashing.uuid5(F.concat_ws("|", F.lit("docs"), F.lit("default"), "lang", F.col("doc_id").cast("string"))).alias("row_uuid"))


@query(f"WITH {BASE} SELECT split, language, count(*)::BIGINT AS n_items, count(DISTINCT record_id)::BIGINT AS n_records FROM items GROUP BY split, language")
def fanout_counts(spark, sf_dir):
    return fixture.items(spark, sf_dir).groupBy("split", "language").agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("record_id").alias("n_records"))


@query("SELECT doc_id, substr(printf('%06d', doc_id) || '-' || regexp_replace(source, '[^A-Za-z0-9_.-]+', '_', 'g') || '-' || regexp_replace(lang || ' / x', '[^A-Za-z0-9_.-]+', '_', 'g'), 1, 120) AS request_key FROM documents")
def request_keys(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.request_key(F.col("doc_id"), F.col("source"), F.concat("lang", F.lit(" / x"))).alias("request_key"))


@query(f"""WITH {BASE}, x AS (SELECT language FROM lang UNION ALL VALUES ('English'), ('Klingon'))
SELECT x.language, coalesce(l.code, x.language) AS code, coalesce(l.script, CASE x.language WHEN 'English' THEN 'Latin' ELSE x.language END) AS script, d.n_docs
FROM x LEFT JOIN lang l USING (language) CROSS JOIN (SELECT count(*)::BIGINT AS n_docs FROM documents) d""")
def language_lookup(spark, sf_dir):
    names = [*fanout.LANGUAGES, "English", "Klingon"]
    x = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("language", F.explode(F.array(*[F.lit(k) for k in names])))
    return x.select("language", fanout.language_code(F.col("language")).alias("code"), fanout.language_script(F.col("language")).alias("script"), "n_docs")


SPEC = {"default/click": ["value"], "view": ["value", "props"], "default": ["props"]}


@query("""SELECT event_type AS split, CASE event_type WHEN 'click' THEN 'default/click' WHEN 'view' THEN 'view' ELSE 'default' END AS matched,
  CASE event_type WHEN 'click' THEN 'value' WHEN 'view' THEN 'value,props' ELSE 'props' END AS fields, count(*)::BIGINT AS n_events FROM events GROUP BY event_type""")
def field_group_resolution(spark, sf_dir):
    units = table(spark, sf_dir, "events").groupBy(F.lit("default").alias("config"), F.col("event_type").alias("split")).agg(F.count(F.lit(1)).alias("n_events"))
    spec = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.array(*[F.lit(x) for x in v]).alias("fields")) for k, v in SPEC.items()])))
    got = identity.resolve_groups(units, spec)
    return got.join(units, ["config", "split"]).select("split", "matched", F.array_join("fields", ",").alias("fields"), "n_events")


@query(f"WITH {BASE} SELECT record_id, length({PROMPT_SQL})::BIGINT AS prompt_chars, substr(sha256({PROMPT_SQL}), 1, 16) AS prompt_hash FROM items")
def template_render(spark, sf_dir):
    return requests(spark, sf_dir).select("record_id", F.length("prompt").cast("long").alias("prompt_chars"), F.substring(hashing.prompt_hash(F.col("prompt")), 1, 16).alias("prompt_hash"))


@query(r"""SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all('{known} {b} ' || coalesce(text, '') || ' {n' || doc_id % 3 || '} {not closed', '\{([A-Za-z_][A-Za-z0-9_]*)\}', 1)), lambda x: x <> 'known')), ',') AS unfilled FROM documents""")
def missing_placeholders(spark, sf_dir):
    t = F.concat(F.lit("{known} {b} "), F.coalesce("text", F.lit("")), F.lit(" {n"), (F.col("doc_id") % 3).cast("string"), F.lit("} {not closed"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(template.unfilled_in(t, ["known"]), ",").alias("unfilled"))


JUDGE_PROMPT = "{target_language} {target_script} ({language_code}): {source} -> {source_translation}; {field_names} {translation_json} {pass_threshold} {nothing}"


@query(f"""WITH {BASE}, d AS (SELECT doc_id, source FROM documents)
SELECT record_id, sha256(i.language || ' ' || i.script || ' (' || i.language_code || '): ' || d.source || ' -> [' || i.language || '] ' || d.source || '; source {{"source":"[' || i.language || '] ' || d.source || '"}} 98 {{nothing}}') AS prompt_hash
FROM items i JOIN d USING (doc_id)""")
def judge_prompt(spark, sf_dir):
    """A judge's prompt from records alone: fields, their translations and the names of every stage; other names stay."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    r = fixture.items(spark, sf_dir).join(d, "doc_id")
    one = lambda text: F.to_json(F.struct(text.alias("source")))
    r = r.select("record_id", "language", "language_code", "script", one(F.col("source")).alias("source"), one(F.concat(F.lit("["), F.col("language"), F.lit("] "), F.col("source"))).alias("translation"))
    values = template.record_values(JUDGE_PROMPT, F.col("source"), F.col("translation"), F.col("language"), F.col("script"), F.col("language_code"), {"translation_json": F.col("translation"), "pass_threshold": F.lit("98")})
    return r.select("record_id", hashing.prompt_hash(template.render(JUDGE_PROMPT, values)).alias("prompt_hash"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '{"score":' || doc_id % 11 || ',"error_analysis":[{"severity":"major"}]}' ELSE '{"score":' || (doc_id % 11)::DOUBLE || ',"pass":' || CASE doc_id % 3 WHEN 1 THEN 'false' ELSE 'null' END || ',"reasoning":"' || CASE doc_id % 3 WHEN 1 THEN lang ELSE '' END || '"}' END AS audit,
  CASE doc_id % 3 WHEN 0 THEN '[{"severity":"major"}]' ELSE '[]' END AS errors FROM documents""")
def audit_payload(spark, sf_dir):
    """What a corrector is told: the judge's whole object, or score, pass and reasoning."""
    i = F.col("doc_id")
    parsed = F.when(i % 3 == 0, F.concat(F.lit('{"score":'), (i % 11).cast("string"), F.lit(',"error_analysis":[{"severity":"major"}]}'))).when(i % 3 == 1, F.lit("{}"))
    d = table(spark, sf_dir, "documents").select("doc_id", judgement.audit_payload(parsed, (i % 11).cast("double"), F.when(i % 3 == 1, False), F.when(i % 3 == 1, F.col("lang"))).alias("audit"))
    return d.select("doc_id", "audit", judgement.audit_errors(F.col("audit")).alias("errors"))


@query("""SELECT doc_id, '{"request":{"contents":[{"role":"user","parts":[{"text":"Translate ' || source || ' (' || lang || ')"}]}],"generationConfig":{"temperature":0.2,"maxOutputTokens":8192,"responseMimeType":"application/json"' ||
  '}}}' AS line, 'Translate ' || source || ' (' || lang || ')' AS prompt FROM documents""")
def batch_lines(spark, sf_dir):
    """Request lines of a batch, and the prompt read back from the line that a prediction repeats."""
    prompt = F.concat(F.lit("Translate "), F.col("source"), F.lit(" ("), F.col("lang"), F.lit(")"))
    d = table(spark, sf_dir, "documents").select("doc_id", routing.encode_request(prompt, 0.2, 8192).alias("line"))
    return d.select("doc_id", "line", routing.echoed_prompt(F.col("line")).alias("prompt"))


@query(r"""WITH e AS (SELECT doc_id, length(coalesce(text, '')) AS n, length(coalesce(text, '')) - length(replace(coalesce(text, ''), ' ', '')) AS w, length(coalesce(text, '')) - length(replace(coalesce(text, ''), 'e', '')) AS r FROM documents)
SELECT doc_id, n AS input_tokens, greatest(w - r, 0) AS output_tokens, r AS reasoning_tokens, n + greatest(w - r, 0) + r AS total_tokens FROM e""")
def interactive_usage(spark, sf_dir):
    """Counts of calls whose completions include the reasoning: characters, spaces and letters of the texts."""
    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    count = lambda x: (F.length("text") - F.length(F.replace("text", F.lit(x), F.lit("")))).cast("long")
    return d.select("doc_id", routing.interactive_usage(F.length("text").cast("long"), count(" "), count("e")).alias("u")).select("doc_id", "u.*")


@query("""SELECT doc_id, printf('%06d', doc_id) || '-' || regexp_replace(source, '[^A-Za-z0-9_.-]+', '_', 'g') || '--a' || (doc_id % 3 + 1) AS key, regexp_replace(lang || '/' || source || ' x', '[^A-Za-z0-9._-]+', '_', 'g') AS file,
  CASE WHEN contains(source, '.') THEN regexp_extract(source, '[^.]*$') ELSE source END AS state FROM documents""")
def attempt_keys(spark, sf_dir):
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    return d.select("doc_id", text.attempt_key(text.request_key(i, F.col("source")), i % 3 + 1).alias("key"), text.file_safe(F.concat("lang", F.lit("/"), "source", F.lit(" x"))).alias("file"), text.state_name(F.col("source")).alias("state"))


@query("""SELECT vec_id, CASE WHEN embedding IS NULL THEN '{"items":[]}' ELSE '{"items":[' || coalesce(array_to_string(list_transform(range(1, len(embedding) + 1), lambda i: '"<translated item ' || i || '>"'), ','), '') || ']}' END AS skeleton FROM embeddings""")
def output_skeleton(spark, sf_dir):
    kind = T.StructType([T.StructField("items", T.ArrayType(T.StringType()))])
    return table(spark, sf_dir, "embeddings").select("vec_id", template.skeleton(F.struct(F.col("embedding").cast("array<string>").alias("items")), kind).alias("skeleton"))


def _wrapped(column="text"):
    """A JSON object with the text, bare, fenced, in prose, cut short, as a list, or blank, by id."""
    body = F.to_json(F.struct(F.coalesce(F.col(column), F.lit("")).alias("a")))
    fence = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    forms = [body, fence, F.concat(F.lit("Sure:\n"), body, F.lit("\nDone.")), F.expr("substring(_b, 1, length(_b) - 1)"), F.concat(F.lit("["), body, F.lit("]")), F.lit(" \n")]
    return body, forms


@query("""SELECT doc_id % 6 AS form, count(*)::BIGINT AS n, sum(CASE WHEN doc_id % 6 < 3 THEN 1 ELSE 0 END)::BIGINT AS n_objects,
  sum(CASE WHEN doc_id % 6 < 3 THEN length(coalesce(text, '')) ELSE 0 END)::BIGINT AS chars,
  CASE doc_id % 6 WHEN 3 THEN 'no JSON object found in response' WHEN 4 THEN 'expected a JSON object' WHEN 5 THEN 'empty response' ELSE '' END AS error FROM documents GROUP BY 1, 5""")
def parse_json_tolerant(spark, sf_dir):
    body, forms = _wrapped()
    d = table(spark, sf_dir, "documents").withColumn("_b", body)
    chosen = F.coalesce(*[F.when(F.col("doc_id") % 6 == i, f) for i, f in enumerate(forms)])
    d = d.select("doc_id", parse.json_object(chosen).alias("p"))
    size = F.length(F.get_json_object("p.value", "$.a"))
    return d.groupBy((F.col("doc_id") % 6).alias("form"), F.coalesce("p.error", F.lit("")).alias("error")).agg(F.count(F.lit(1)).alias("n"), F.count("p.value").alias("n_objects"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("chars"))


@query("SELECT doc_id, 3::BIGINT AS n_sections, length(trim(coalesce(text, ''), ' \t\n\r'))::BIGINT AS question_chars, 'last' AS note FROM documents")
def parse_sections(spark, sf_dir):
    clean = F.concat(F.lit("preamble\n### note\nfirst\n### question\n"), F.coalesce("text", F.lit("")), F.lit("\n### answer\nyes\n### note\nlast\n"))
    s = parse.sections(clean)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(s).cast("long").alias("n_sections"), F.length(F.coalesce(s["question"], F.lit(""))).cast("long").alias("question_chars"), s["note"].alias("note"))


@query("""SELECT CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'missing field ''text''' WHEN 2 THEN CASE WHEN trim(coalesce(text, ''), ' \t\n\r') <> '' THEN 'field ''text'': empty translation' ELSE '' END
  WHEN 3 THEN 'field ''text'': expected a string' ELSE 'field ''tags'': expected 2 items, got 1' END AS error, count(*)::BIGINT AS n FROM documents GROUP BY 1""")
def validate_translation(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))])
    source = F.struct("text", F.array(F.lit("a"), F.col("lang")).alias("tags"))
    two, one = F.array(F.lit("x"), F.lit("y")).alias("tags"), F.array(F.lit("x")).alias("tags")
    good = F.to_json(F.struct("text", two))
    forms = [good, F.to_json(F.struct(two)), F.to_json(F.struct(F.lit(" ").alias("text"), two)), F.to_json(F.struct(F.array("text").alias("text"), two)), F.to_json(F.struct("text", one))]
    chosen = F.coalesce(*[F.when(F.col("doc_id") % 5 == i, f) for i, f in enumerate(forms)])
    error = F.coalesce(validate.translation_error(chosen, source, kind), F.lit(""))
    return d.select(error.alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CASE doc_id % 3 WHEN 0 THEN 'field ''text'': control character' WHEN 1 THEN 'field ''text'': more tabs than the source' ELSE '' END AS error, count(*)::BIGINT AS n FROM documents GROUP BY 1""")
def control_char_guard(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    bad = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("\x08oxed"))).when(F.col("doc_id") % 3 == 1, F.concat("text", F.lit("\text"))).otherwise(F.col("text"))
    return d.select(F.coalesce(validate.control_error("text", bad, F.col("text")), F.lit("")).alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(r"""WITH e AS (SELECT doc_id, length(coalesce(text, '')) % 11 AS k, length(coalesce(text, '')) % 6 AS f, coalesce(text, '') AS t FROM documents)
SELECT doc_id, CASE WHEN f IN (3, 4, 5) THEN NULL ELSE k::DOUBLE END AS score, CASE WHEN f IN (3, 4, 5) THEN NULL WHEN f = 0 THEN k >= 7 WHEN f = 1 THEN false ELSE true END AS passed,
  CASE f WHEN 3 THEN 'missing a score field' WHEN 4 THEN 'field ''score'': not a number' WHEN 5 THEN 'score is not within 0 to 10' ELSE '' END AS error, CASE WHEN f = 0 THEN 'because ' || t END AS feedback FROM e""")
def validate_judgement(spark, sf_dir):
    """Verdicts of six forms about the texts, by their lengths."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("n", F.length("t"))
    k, f = F.col("n") % 11, F.col("n") % 6
    o = lambda *c: F.to_json(F.struct(*c))
    why = F.concat(F.lit("because "), "t").alias("feedback")
    forms = [
        o(k.alias("score"), why), o(k.alias("rating"), F.lit("NO").alias("verdict"), F.array(F.lit("x")).alias("issues")), o(k.cast("string").alias("overall_score"), F.lit(True).alias("pass")),
        o(why), o(F.lit("high").alias("score"), k.alias("rating"), why), o((k + 20).alias("score"), why),
    ]
    chosen = F.coalesce(*[F.when(f == i, x) for i, x in enumerate(forms)])
    j = d.select("doc_id", f.alias("f"), judgement.judgement(chosen, 7.0, 10.0).alias("j"))
    return j.select("doc_id", "j.score", "j.passed", F.coalesce("j.error", F.lit("")).alias("error"), F.when(F.col("f") == 0, F.col("j.feedback")).alias("feedback"))


def _lines(spark, sf_dir):
    """Predictions of four in five documents' texts as prompts, some twice, with the place they came back in."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("prompt"))
    back = d.withColumn("times", F.when(F.col("doc_id") % 5 == 0, 0).when(F.col("doc_id") % 10 == 1, 2).otherwise(1)).withColumn("copy", F.explode(F.sequence(F.lit(0), F.greatest("times", F.lit(1)) - 1)))
    back = back.where("times > 0")
    return d.select(F.col("doc_id").alias("key"), "prompt", F.col("doc_id").alias("ordinal")), back.select("prompt", F.struct(F.lit(0) - F.col("doc_id"), "copy").alias("position"), F.col("doc_id").alias("answered"))


ROUTE_SQL = """WITH r AS (SELECT doc_id AS key, coalesce(text, '') AS p, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS k FROM documents),
l AS (SELECT doc_id AS answered, p, row_number() OVER (PARTITION BY p ORDER BY -doc_id, copy) AS k FROM (
  SELECT doc_id, coalesce(text, '') AS p, unnest(range(0, CASE WHEN doc_id % 5 = 0 THEN 0 WHEN doc_id % 10 = 1 THEN 2 ELSE 1 END)) AS copy FROM documents)) """


@query(ROUTE_SQL + "SELECT r.key, l.answered FROM l JOIN r ON l.p = r.p AND l.k = r.k")
def route_predictions(spark, sf_dir):
    requests_, lines = _lines(spark, sf_dir)
    return routing.match_by_prompt(requests_, lines)[0].select("key", "answered")


@query(ROUTE_SQL + "SELECT l.answered, count(*)::BIGINT AS n FROM l LEFT JOIN r ON l.p = r.p AND l.k = r.k WHERE r.key IS NULL GROUP BY l.answered")
def unmatched_predictions(spark, sf_dir):
    requests_, lines = _lines(spark, sf_dir)
    return routing.match_by_prompt(requests_, lines)[1].groupBy("answered").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id AS key, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'v2' END AS text, CASE WHEN doc_id % 4 = 0 THEN 'no result returned by backend' END AS error, doc_id % 4 <> 0 AS ok FROM documents""")
def result_join_default_error(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"))
    got = d.where("key % 4 <> 0").withColumn("v", F.explode(F.array(F.lit(2), F.lit(1)))).select("key", F.concat(F.lit("v"), F.col("v").cast("string")).alias("text"), F.lit(None).cast("string").alias("error"), "v")
    return routing.join_results(d, got, "v").select("key", "text", "error", "ok")


@query(r"""WITH e AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, CASE n % 4 WHEN 0 THEN 'answer ' || t ELSE NULL END AS text,
  CASE n % 4 WHEN 1 THEN 'batch error: ' || substr('quota for ' || t, 1, 500) WHEN 2 THEN 'empty response (finishReason=SAFETY)' WHEN 3 THEN 'batch line has no ''response''' END AS error,
  CASE n % 4 WHEN 0 THEN n + 17 ELSE 0 END AS total_tokens FROM e""")
def decode_predictions(spark, sf_dir):
    """Prediction lines of four kinds about the texts, by their lengths."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("n", F.length("t").cast("long"))
    quoted = lambda x: canonical.quoted(x)
    answered = F.concat(F.lit('{"response": {"candidates": [{"finishReason": "STOP", "content": {"parts": [{"text": "hm", "thought": true}, {"text": "answer "}, {"text": '), quoted(F.col("t")), F.lit('}]}}], "usageMetadata": {"promptTokenCount": '), F.col("n").cast("string"), F.lit(', "candidatesTokenCount": 10, "thoughtsTokenCount": 7}}}'))
    refused = F.concat(F.lit('{"status": '), quoted(F.concat(F.lit("quota for "), "t")), F.lit("}"))
    k = F.col("n") % 4
    line = F.when(k == 0, answered).when(k == 1, refused).when(k == 2, F.lit('{"response": {"candidates": [{"finish_reason": "SAFETY"}]}}')).otherwise(F.lit('{"response": {}}'))
    return d.select("doc_id", routing.decode_line(line).alias("r")).select("doc_id", "r.text", "r.error", "r.usage.total_tokens")


@query("""SELECT CASE WHEN doc_id % 6 = 0 THEN 4 WHEN doc_id % 3 = 0 THEN 3 WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS attempt,
  CASE WHEN doc_id % 6 = 0 THEN 'fallback' ELSE 'primary' END AS phase, count(*)::BIGINT AS n_final, count(*)::BIGINT AS n_ok FROM documents GROUP BY 1, 2""")
def retry_fixpoint(spark, sf_dir):
    """Attempts 1 to 3 of the primary phase, then the fallback; a document's id says which attempt succeeds."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "doc_id", F.lit("p").alias("prompt"))
    due = lambda key: next(n for m, n in ((6, 4), (3, 3), (2, 2), (1, 1)) if int(key) % m == 0)
    model = fixture.model(lambda key, prompt, attempt: "fine" if attempt >= due(key) else " ")
    plan = inference.phases(inference.Phase("primary", "batch", "m", 3, model), inference.Phase("fallback", "parallel", "m", 1, model))
    _, final = inference.run_with_retries(d, plan, lambda t: F.lit(None).cast("string"), inference.Answers(new_path(spark, "answers")))
    return final.groupBy(F.col("attempt").cast("long").alias("attempt"), "phase").agg(F.count(F.lit(1)).alias("n_final"), F.count_if("ok").cast("long").alias("n_ok"))


@query("""WITH r(run) AS (VALUES (1), (2), (3), (4))
SELECT run, lang, count(*)::BIGINT AS n_due, CASE WHEN run = 1 OR (run = 2 AND lang <> 'en') OR (run = 3 AND lang = 'de') THEN count(*) ELSE 0 END::BIGINT AS n_asked,
  sum(length(coalesce(text, '')) + CASE WHEN run >= 3 AND lang = 'de' THEN 9 ELSE 6 END)::BIGINT AS chars_answered
FROM documents CROSS JOIN r WHERE run > 1 OR lang = 'en' GROUP BY run, lang""")
def resume_plan(spark, sf_dir):
    """Four runs over one log: a part of the rows, all, all with another prompt for some, and the same again; each asks what is new."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "lang", F.coalesce("text", F.lit("")).alias("body"))
    log = inference.Answers(new_path(spark, "answers"), ["lang"])
    plan = [inference.Phase("primary", "batch", "m", 1, fixture.model(lambda key, prompt, attempt: prompt))]
    render = lambda df, changed: df.select("key", "lang", F.concat(F.when((F.col("lang") == "de") & F.lit(changed), "Rewrite: ").otherwise("Write "), "body").alias("prompt"))
    out, before = None, None
    for run, rows in enumerate([render(d.where("lang = 'en'"), False), render(d, False), render(d, True), render(d, True)], 1):
        _, final = inference.run_with_retries(rows, plan, lambda t: F.lit(None).cast("string"), log)
        logged = log.read(spark, 1, inference.infer_schema(rows, log.keep)).groupBy("lang").agg(F.count(F.lit(1)).alias("logged"))
        logged = stored(logged, "logged")
        asked = logged.join(before.withColumnRenamed("logged", "earlier"), "lang", "left") if before else logged.withColumn("earlier", F.lit(0))
        answered = final.groupBy("lang").agg(F.count(F.lit(1)).alias("n_due"), F.sum(F.length("text")).alias("chars_answered"))
        one = answered.join(asked, "lang").select(F.lit(run).alias("run"), "lang", "n_due", (F.col("logged") - F.coalesce("earlier", F.lit(0))).alias("n_asked"), "chars_answered")
        out, before = (one if out is None else out.unionByName(one)), logged
    return out


@query("""SELECT lang, count(*)::BIGINT AS n_answers, sum(length(coalesce(text, '')))::BIGINT AS prompt_chars, sum(length(coalesce(text, '')) % 97)::BIGINT AS total_tokens,
  count(CASE WHEN coalesce(text, '') = '' THEN 1 END)::BIGINT AS n_failed FROM documents GROUP BY lang""")
def windowed_calls(spark, sf_dir):
    """Single calls from a bounded window in each task; a call about an empty text raises, which gives an error row."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "lang", F.coalesce("text", F.lit("")).alias("prompt"))
    model = calls.Calls(fixture.count_characters, workers=32, retries=1, pause=0.001)
    attempts, _ = inference.run_with_retries(d, [inference.Phase("primary", "parallel", "m", 1, model)], lambda t: F.lit(None).cast("string"), inference.Answers(new_path(spark, "answers"), ["lang"]))
    size = F.coalesce(F.col("text").cast("long"), F.lit(0))
    return attempts.groupBy("lang").agg(F.count(F.lit(1)).alias("n_answers"), F.sum(size).alias("prompt_chars"), F.sum(F.coalesce("total_tokens", F.lit(0))).alias("total_tokens"), F.count_if(F.col("error") == "ValueError: empty").alias("n_failed"))


@query("""SELECT 'default' AS dataset_config, lang AS split, count(*)::BIGINT AS n, sum(length(coalesce(text, '')) + CASE WHEN lang = 'en' THEN 1 ELSE 0 END)::BIGINT AS chars, 4::BIGINT AS last_version FROM documents GROUP BY lang""")
def unit_commits(spark, sf_dir):
    """Units of a table committed one after the other, one of them twice; all are there, the last commit of each."""
    d = table(spark, sf_dir, "documents").select(F.lit("default").alias("dataset_config"), F.col("lang").alias("split"), F.length(F.coalesce("text", F.lit(""))).alias("chars"))
    others = sorted(r["split"] for r in d.select("split").distinct().collect())  # the languages
    t = new_path(spark, "units")
    versions.commit(d.where("split = 'en'"), t, [("default", "en")])
    versions.commit(d.where("split <> 'en'"), t, [("default", s) for s in others if s != "en"])
    versions.commit(d.where("split = 'en'").limit(0), t, [("default", "en")])
    versions.commit(d.where("split = 'en'").withColumn("chars", F.col("chars") + 1), t, [("default", "en")])
    n = F.lit(versions.version(spark, t)["number"]).cast("long")
    return versions.read(spark, t).groupBy("dataset_config", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").cast("long").alias("chars")).withColumn("last_version", n)


@query("SELECT count(*)::BIGINT AS n_requests, count(DISTINCT coalesce(text, ''))::BIGINT AS n_asked, sum(length(coalesce(text, '')))::BIGINT AS chars_answered FROM documents")
def dedup_before_inference(spark, sf_dir):
    """Each distinct prompt is answered once and the answers are joined back."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("prompt"))
    asked, back = inference.distinct_prompts(d)
    answers = asked.select(F.col("key").alias("asked"), F.length("prompt").alias("size"))
    return back.join(answers, "asked").agg(F.count(F.lit(1)).alias("n_requests"), F.count_distinct("asked").alias("n_asked"), F.sum("size").cast("long").alias("chars_answered"))


@query("""WITH c AS (SELECT conv_id, string_agg(coalesce(role, '') || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS p, count(*)::BIGINT AS n_turns FROM conversations GROUP BY conv_id)
SELECT conv_id, n_turns, length('Reply to:' || chr(10) || p)::BIGINT AS prompt_chars, sha256('Reply to:' || chr(10) || p) AS prompt_hash FROM c""")
def conversation_prompt(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    line = F.concat(F.coalesce("role", F.lit("")), F.lit(": "), F.coalesce("text", F.lit("")))
    c = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("t"))
    prompt = template.render("Reply to:\n{turns}", {"turns": F.array_join("t.line", "\n")})
    return c.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.length(prompt).cast("long").alias("prompt_chars"), hashing.prompt_hash(prompt).alias("prompt_hash"))


@query("SELECT doc_id, contains(coalesce(text, ''), source) AS extractive, (strpos(coalesce(text, ''), lang) - 1)::BIGINT AS answer_at FROM documents")
def dq_extractive(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    return d.select("doc_id", contracts.extractive(F.col("text"), F.array("source")).alias("extractive"), contracts.answer_offset(F.col("text"), F.col("lang")).alias("answer_at"))


@query(r"""WITH c AS (SELECT conv_id, turn, coalesce(text, '') || chr(10) || '#### ' || turn AS a, regexp_replace(coalesce(text, ''), '[aeiou], ', chr(10), 'g') || chr(10) || '#### ' || (turn - turn % 4) AS b FROM conversations)
SELECT conv_id, turn, len(string_split(a, chr(10))) = len(string_split(b, chr(10))) AND string_split(a, chr(10))[-1] = string_split(b, chr(10))[-1] AS same_lines FROM c""")
def dq_line_contract(spark, sf_dir):
    """Conversations and copies in which some commas end lines and some last lines have another number."""
    c = table(spark, sf_dir, "conversations").withColumn("text", F.coalesce("text", F.lit("")))
    a, b = F.concat("text", F.lit("\n#### "), F.col("turn").cast("string")), F.concat(F.regexp_replace("text", "[aeiou], ", "\n"), F.lit("\n#### "), (F.col("turn") - F.col("turn") % 4).cast("string"))
    return c.select("conv_id", "turn", contracts.same_lines(a, b).alias("same_lines"))


@query(r"""SELECT doc_id, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), 'th', 'h')))::BIGINT AS blanks, length(coalesce(text, '')) - length(replace(coalesce(text, ''), '%%%', '%%')) = 1 AS one_blank FROM documents""")
def dq_blank_count(spark, sf_dir):
    """How often a mark stands in each text, and whether another stands there once; null texts are empty."""
    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    return d.select("doc_id", contracts.blanks(F.col("text"), "th").alias("blanks"), contracts.one_blank(F.col("text"), "%%%").alias("one_blank"))


@query(r"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), ' ') AS w FROM documents)
SELECT doc_id, len(list_filter(w, lambda x: regexp_matches(x, '^[0-9][0-9.,:/%-]*$') AND regexp_matches(x, '[13579]'))) = 0 AS numbers_kept,
  contains(t, 'a') AND contains(t, 'b') AND contains(t, 'c') AND contains(t, 'd') AS options_kept, len(w) = len(string_split(t, '. ')) AS same_length FROM w""")
def dq_lists(spark, sf_dir):
    """Words of texts beside copies with other digits, letters as options, words beside sentences."""
    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    words = F.split("text", " ", -1)
    options = F.col("text")
    for x in "abcd":
        options = F.replace(options, F.lit(x), F.lit(f"({x.upper()})"))
    kept = contracts.numbers_kept(words, F.transform(words, lambda w: F.regexp_replace(w, "[13579]", "0")))
    return d.select("doc_id", kept.alias("numbers_kept"), contracts.options_kept(options).alias("options_kept"), contracts.same_length(words, F.split("text", r"\. ", -1)).alias("same_length"))


@query("""WITH m(model, mode, provider_model) AS (VALUES ('m-1', 'parallel', NULL), ('m-1', 'batch', NULL), ('x/m-1', 'parallel', NULL), ('m-1', 'parallel', 'p/q'))
SELECT lang, model, mode, CASE WHEN mode = 'batch' THEN model ELSE coalesce(provider_model, CASE WHEN contains(model, '/') THEN model ELSE 'vertex_ai/' || model END) END AS sent, n FROM m CROSS JOIN (SELECT lang, count(*)::BIGINT AS n FROM documents GROUP BY lang)""")
def model_resolution(spark, sf_dir):
    cases = [("m-1", "parallel", None), ("m-1", "batch", None), ("x/m-1", "parallel", None), ("m-1", "parallel", "p/q")]
    rows = F.array(*[F.struct(F.lit(a).alias("model"), F.lit(b).alias("mode"), F.lit(c).cast("string").alias("given")) for a, b, c in cases])
    d = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select("lang", "n", F.inline(rows))
    return d.select("lang", "model", "mode", text.qualified_model(F.col("model"), F.col("mode"), F.col("given")).alias("sent"), "n")


@query("""SELECT lang, count(*)::BIGINT AS n, sum(length('Say: ' || coalesce(text, '')))::BIGINT AS chars, sum(length('Say: ' || coalesce(text, '')) % 1000)::BIGINT AS input_tokens, 0::BIGINT AS n_failed FROM documents GROUP BY lang""")
def batch_jobs(spark, sf_dir):
    """Prompts through files of requests, jobs of at most 400 of them, and prediction lines that are matched back by their prompts."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "lang", F.concat(F.lit("Say: "), F.coalesce("text", F.lit(""))).alias("prompt"))

    def jobs(model, source, target, names, settings):
        line = F.col("value")
        size = F.length(routing.echoed_prompt(line)).cast("string")
        answer = F.concat(F.lit(', "response": {"candidates": [{"content": {"parts": [{"text": "'), size, F.lit('"}]}}], "usageMetadata": {"promptTokenCount": '), (F.length(routing.echoed_prompt(line)) % 1000).cast("string"), F.lit("}}}"))
        asked = spark.read.option("lineSep", "\n").option("basePath", source).text([f"{source}/{name}" for name in names])
        asked.select("chunk", F.concat(F.substring(line, F.lit(1), F.length(line) - 1), answer)).write.partitionBy("chunk").option("lineSep", "\n").text(target)

    plan = [inference.Phase("primary", "batch", "m", 1, batches.FileJobs(jobs, size=400, wave=512), {"temperature": 0.2})]
    _, final = inference.run_with_retries(d, plan, lambda t: F.lit(None).cast("string"), inference.Answers(new_path(spark, "answers")))
    return final.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("text").cast("long")).alias("chars"), F.sum("input_tokens").alias("input_tokens"), F.count_if(~F.col("ok")).cast("long").alias("n_failed"))


_RUN_ID = "'docs|default|' || lang || '|' || doc_id || '|Hindi|g0'"


@query(f"""WITH r AS (SELECT lang AS split, doc_id, {fixture._hex(f"md5({_RUN_ID})", 4)} % 101 AS score FROM documents)
SELECT 'translate' AS stage, 0::BIGINT AS round, split, count(*)::BIGINT AS n, count(*)::BIGINT AS n_valid, sum(CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END)::BIGINT AS n_attempts FROM r GROUP BY split
UNION ALL SELECT 'judge', 1, split, count(*), count(*), count(*) FROM r GROUP BY split
UNION ALL SELECT 'correct', 1, split, count(*), count(*), count(*) FROM r WHERE score < 60 GROUP BY split
UNION ALL SELECT 'judge', 2, split, count(*), count(*), count(*) FROM r WHERE score < 60 GROUP BY split""")
def stages_by_unit(spark, sf_dir):
    """A whole run over the documents, a language a unit: one unit first, then all, so the second run asks about the others only; judged, corrected, judged."""
    import tempfile
    from pathlib import Path

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    splits = sorted(r["lang"] for r in docs.select("lang").distinct().collect())  # a row for each language
    with tempfile.TemporaryDirectory() as folder:  # prompts, read on the driver
        for name, field in (("translate", "source_json"), ("judge", "translation_json"), ("correct", "previous_translation_json")):
            Path(folder, f"{name}.md").write_text(f"TASK {name} {{{field}}}")
        stage = lambda n: {"prompt": f"{n}.md", "model": "gemini-2.5-flash", "inference": {"mode": "parallel"}, "max_attempts": 2}
        given = {"benchmark": "docs", "source": {"type": "local", "files": {s: "none" for s in splits}}, "languages": {"Hindi": "hi"}, "fields": [["text"]], "output": {"root": new_path(spark, "run")}}
        given["stages"] = {"translate": stage("translate"), "judge": stage("judge") | {"score_scale": 100, "pass_threshold": 60}, "correct": stage("correct") | {"max_score": 59}}
        run = stages.Run(spark, configs.parse(given, Path(folder)), {m: fixture.model(fixture.task) for m in configs.MODES}, load=lambda unit: docs.where(F.col("lang") == unit.split))
        run.only = [("default", splits[0])]
        stages.translate(run)
        run.only = None
        stages.chain(run)
    r = stages.records_of(run).groupBy("stage", F.col("round").cast("long").alias("round"), "split")
    return r.agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").cast("long").alias("n_valid"), F.sum("attempts").cast("long").alias("n_attempts"))
