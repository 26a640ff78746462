"""Queries of source preparation, pages, splitting and verification."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions import canonical, contracts, exact, hashing, text
from lexiloom.operators import asof, identity, passages, preparation, records
from lexiloom.plans.catalogue import query
from lexiloom.plans.fixture import table
from lexiloom.sources import writers

count = lambda name="n": F.count(F.lit(1)).alias(name)


@query("""SELECT lang, count(*)::BIGINT AS n, sum((source <> 'src0')::INT)::BIGINT AS n_other, max(length(text))::BIGINT AS longest, count(DISTINCT doc_id) = count(*) AS is_unique,
  sum((trim(coalesce(text, ''), ' \t\n\r') = '')::INT)::BIGINT AS n_blank, sum((trim(text, ' \t\n\r') <> text)::INT)::BIGINT AS edited FROM documents GROUP BY lang""")
def prep_filters(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    blank = text.is_blank(F.coalesce("text", F.lit("")))
    return d.groupBy("lang").agg(
        count(), F.count_if(~F.col("source").eqNullSafe("src0")).cast("long").alias("n_other"), F.max(F.length("text")).cast("long").alias("longest"), (F.count_distinct("doc_id") == F.count(F.lit(1))).alias("is_unique"),
        F.count_if(blank).cast("long").alias("n_blank"), F.count_if(text.strip(F.col("text")) != F.col("text")).cast("long").alias("edited"),
    )


@query("SELECT lang AS value, count(*)::BIGINT AS n FROM documents WHERE lang = 'en' GROUP BY lang UNION ALL SELECT 'rest', count(*)::BIGINT FROM documents WHERE lang IS DISTINCT FROM 'en'")
def keep_and_drop(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    keep = preparation.value_counts(preparation.keep_equal(d, "lang", "en"), "lang").select(F.col("lang").alias("value"), "n")
    return keep.union(preparation.drop_equal(d, "lang", "en").agg(F.lit("rest").alias("value"), count()))


@query("(SELECT 'source' AS what, source AS value, count(*)::BIGINT AS n FROM documents GROUP BY source ORDER BY n DESC, value LIMIT 6) UNION ALL (SELECT 'event', event_type, count(*)::BIGINT AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 3)")
def value_counts_topk(spark, sf_dir):
    one = preparation.top_values(table(spark, sf_dir, "documents"), "source", 6).select(F.lit("source").alias("what"), F.col("source").alias("value"), "n")
    return one.union(preparation.top_values(table(spark, sf_dir, "events"), "event_type", 3).select(F.lit("event").alias("what"), F.col("event_type").alias("value"), "n"))


_STRIP = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', '', 'g'), '<br\\s*/?>', chr(10), 'g'),
  '</p>\\s*|</li>\\s*|</div>\\s*', chr(10) || chr(10), 'g'), '<li[^>]*>', '- ', 'g'), '<[^>]+>', '', 'g')"""
_DECODE = _STRIP
for _name, _sign in text.REFERENCES.items():
    _DECODE = f"replace({_DECODE}, '{_name}', '{_sign.replace(chr(39), chr(39) * 2)}')"
_NORMAL = f"""regexp_replace(regexp_replace(replace({_DECODE}, chr(160), ' '), '[ \\t]+\\n', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"""


@query(f"SELECT page_id, length(trim({_NORMAL}, ' \t\n\r'))::BIGINT AS n_chars, sha256(trim({_NORMAL}, ' \t\n\r')) AS text_hash FROM pages")
def html_strip(spark, sf_dir):
    t = text.strip_tags(F.coalesce("html", F.lit("")))
    return table(spark, sf_dir, "pages").select("page_id", F.length(t).cast("long").alias("n_chars"), F.sha2(t, 256).alias("text_hash"))


@query(r"""WITH t AS (SELECT page_id, unnest(regexp_extract_all(coalesce(html, ''), '(<h1\b|<p\b)', 1)) AS tag, generate_subscripts(regexp_extract_all(coalesce(html, ''), '(<h1\b|<p\b)', 1), 1) AS i FROM pages),
s AS (SELECT *, sum((tag = '<h1')::INT) OVER (PARTITION BY page_id ORDER BY i) AS section FROM t)
SELECT page_id, section::BIGINT AS section, count(*)::BIGINT AS n_paragraphs FROM s WHERE tag = '<p' GROUP BY page_id, section""")
def html_section_asof(spark, sf_dir):
    s = preparation.section_of(table(spark, sf_dir, "pages"), "page_id", "html", "h1", "p")
    return s.groupBy("page_id", F.col("section").cast("long").alias("section")).agg(count("n_paragraphs"))


@query(r"""WITH t AS (SELECT page_id, unnest(regexp_extract_all(coalesce(html, ''), '(<div\b|</div>)', 1)) AS tag, generate_subscripts(regexp_extract_all(coalesce(html, ''), '(<div\b|</div>)', 1), 1) AS i FROM pages),
s AS (SELECT *, sum(CASE WHEN tag = '</div>' THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY i) AS depth FROM t)
SELECT page_id, max(depth)::BIGINT AS deepest, (min(i) FILTER (depth = 0) - 1)::BIGINT AS closed_at FROM s GROUP BY page_id""")
def html_div_depth(spark, sf_dir):
    depth = preparation.div_depth(table(spark, sf_dir, "pages"), "page_id", "html").withColumn("closing", F.when(F.col("depth") == 0, F.col("place")))
    return depth.groupBy("page_id").agg(F.max("depth").alias("deepest"), F.min("closing").cast("long").alias("closed_at"))


@query("""WITH s AS (SELECT page_id, substr(regexp_replace(regexp_replace(lower(split_part(url, '?', 1)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60) AS slug FROM pages),
r AS (SELECT page_id, slug, row_number() OVER (PARTITION BY slug ORDER BY page_id) AS k FROM s) SELECT page_id, CASE WHEN k > 1 THEN slug || '-' || k ELSE slug END AS id FROM r""")
def slug_with_suffix(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", text.slug(F.substring_index("url", "?", 1)).alias("slug"))
    return identity.numbered_slugs(p, "slug", ["page_id"]).select("page_id", "id")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def struct_flatten(spark, sf_dir):
    e = preparation.typed_json(table(spark, sf_dir, "events").select("event_id", "props"), "props", T.StructType([T.StructField("k", T.LongType())]))
    return preparation.flatten_struct(e, "props")


@query("SELECT doc_id, lang || '-' || printf('%04d', row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) AS id FROM documents")
def positional_ids(spark, sf_dir):
    d = identity.row_index(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["doc_id"], within=["lang"])
    return preparation.positional_id(d, F.col("lang")).select("doc_id", "id")


@query("""SELECT coalesce(nullif(lang, ''), '_blank') AS value, count(*)::BIGINT AS rows, sum((doc_id % 3 = 0)::INT)::BIGINT AS queued,
  sum(octet_length(encode(lang)) + octet_length(encode(coalesce(text, ''))) + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END)::BIGINT AS bytes FROM documents GROUP BY 1""")
def split_by_value_index(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("lang", "text", F.when(F.col("doc_id") % 3 == 0, "x").otherwise("").alias("review_reason"))
    return writers.split_index(d, "lang")


@query("""SELECT lang AS value, sum((doc_id % 50 = 0)::INT)::BIGINT AS missing, sum((doc_id % 50 = 0)::INT)::BIGINT AS extra FROM documents GROUP BY lang HAVING sum((doc_id % 50 = 0)::INT) > 0""")
def row_digest_verify(spark, sf_dir):
    """Every fiftieth row of the copy is altered."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    copy = d.withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text")))
    return writers.verify_split(d, copy, "lang", ["doc_id", "lang", "text"])


@query("SELECT doc_id, sha256(doc_id::VARCHAR || chr(31) || lang || chr(31) || coalesce(text, '') || chr(31)) AS digest FROM documents")
def row_digests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hashing.row_digest([F.col("doc_id"), F.col("lang"), F.col("text")]).alias("digest"))


def _fraction_sql():
    from lexiloom.plans.fixture import _hex

    return _hex("sha256('human-review-v1|docs|' || doc_id)", 8) + "::DOUBLE / 4294967296"


@query(f"SELECT doc_id, {_fraction_sql()} AS fraction, {_fraction_sql()} < 0.25 AS sampled FROM documents")
def hash_sample_rates(spark, sf_dir):
    f = hashing.sample_fraction("human-review-v1", F.concat(F.lit("docs|"), F.col("doc_id").cast("string")))
    return table(spark, sf_dir, "documents").select("doc_id", f.alias("fraction"), (f < 0.25).alias("sampled"))


@query("SELECT (k // 300)::BIGINT AS chunk, count(*)::BIGINT AS n, min(doc_id) AS first_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents) GROUP BY 1")
def chunk_assignment(spark, sf_dir):
    d = identity.row_index(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])
    return d.groupBy(preparation.chunk_of(F.col("row_index"), 300).alias("chunk")).agg(count(), F.min("doc_id").alias("first_id"))


@query(r"""WITH h AS (SELECT page_id, coalesce(html, '') AS h FROM pages), r AS (SELECT page_id, h, strpos(h, '<h1>') AS pos, substr(h, strpos(h, '<h1>') + 4) AS rest FROM h)
SELECT page_id, CASE WHEN pos = 0 THEN '' ELSE ltrim(split_part(rest, '</p>', 1)) END AS answer, CASE WHEN pos = 0 THEN h WHEN strpos(rest, '</p>') = 0 THEN '' ELSE substr(rest, strpos(rest, '</p>') + 4) END AS solution FROM r""")
def answer_split(spark, sf_dir):
    """Pages whose main heading is made the answer mark: the answer ends with its paragraph."""
    panel = F.regexp_replace(F.coalesce("html", F.lit("")), "<h1>", "<strong>Answer:</strong> ")
    return table(spark, sf_dir, "pages").select("page_id", text.split_answer(panel).alias("s")).select("page_id", "s.answer", "s.solution")


@query("SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/]*)', 1) AS bucket, regexp_extract(url, '://[^/]*/(.*)$', 1) AS key FROM pages")
def uri_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.split_uri(F.col("url")).alias("u")).select("page_id", "u.*")


@query("SELECT b.item_id, count(d.doc_id)::BIGINT AS n_docs FROM benchmark b LEFT JOIN (SELECT DISTINCT doc_id, text FROM documents) d ON contains(d.text, b.text) GROUP BY b.item_id")
def contamination_lookup(spark, sf_dir):
    """Documents that hold a benchmark passage whole."""
    b = table(spark, sf_dir, "benchmark")
    found = passages.held_passages(table(spark, sf_dir, "documents"), b).groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"))
    return b.select("item_id").join(found, "item_id", "left").select("item_id", F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"))


@query("SELECT b.item_id, d.doc_id, (strpos(d.text, b.text) - 1)::BIGINT AS answer_at, true AS extractive FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def dq_passage_offsets(spark, sf_dir):
    """Where benchmark passages stand in the documents that hold them."""
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return passages.held_passages(d, b).select("item_id", "doc_id", F.col("at").alias("answer_at"), F.lit(True).alias("extractive"))


@query("""SELECT count(*)::BIGINT AS n_rows, count(DISTINCT text)::BIGINT AS n_distinct, count(*) = count(DISTINCT text) AS is_unique, max(length(text))::BIGINT AS longest, sum((trim(text, ' \t\n\r') <> text)::INT)::BIGINT AS edited FROM documents""")
def prep_reports(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return preparation.uniqueness(d, "text").crossJoin(preparation.longest(d, "text")).crossJoin(preparation.edited_by_strip(d, "text"))  # a row each


@query("SELECT doc_id FROM documents WHERE doc_id % 7 = 0 OR trim(coalesce(text, ''), ' \t\n\r') = '' ORDER BY doc_id LIMIT 5")
def blank_id_report(spark, sf_dir):
    """The first ids with a blank column, of a table whose every seventh text is blank."""
    d = table(spark, sf_dir, "documents").withColumn("text", F.when(F.col("doc_id") % 7 == 0, "  ").otherwise(F.col("text")))
    return preparation.blank_ids(d, "doc_id", ["text"])


@query(r"""WITH t AS (SELECT page_id, unnest(regexp_extract_all(coalesce(html, ''), '(<div\b|</div>)', 1)) AS tag, generate_subscripts(regexp_extract_all(coalesce(html, ''), '(<div\b|</div>)', 1), 1) AS i FROM pages),
s AS (SELECT *, sum(CASE WHEN tag = '</div>' THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY i) AS depth FROM t)
SELECT page_id, (min(i) FILTER (depth = 0) - 1)::BIGINT AS closed_at FROM s GROUP BY page_id""")
def html_first_close(spark, sf_dir):
    """Where the first div of each page closes; null where it never does."""
    return preparation.first_close(preparation.div_depth(table(spark, sf_dir, "pages"), "page_id", "html"), "page_id").select("page_id", F.col("closed_at").cast("long").alias("closed_at"))


@query("SELECT doc_id, source || '' AS name, n_chars AS size FROM documents")
def column_rename(spark, sf_dir):
    return preparation.rename(table(spark, sf_dir, "documents"), {"doc_id": "doc_id", "source": "name", "n_chars": "size"})


@query("""WITH e AS (SELECT event_id, user_id, ts - INTERVAL 9131 DAY AS ts FROM events),
o AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey, o_orderdate)
SELECT e.event_id, o.o_orderkey, date_diff('second', o.o_orderdate, e.ts)::BIGINT // 86400 AS days_since FROM e ASOF LEFT JOIN o ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate""")
def asof_last_order(spark, sf_dir):
    """Each event with the customer's last order before it, events put 25 years back into the time of the orders."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.expr("ts - INTERVAL 9131 DAYS").alias("ts"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderkey")
    got = asof.asof_join(e, o, ["user_id"], "ts", "o_orderdate")
    return got.select("event_id", "o_orderkey", F.expr("timestampdiff(SECOND, o_orderdate, ts) div 86400").alias("days_since"))


_PAGE_TEXT = f"trim({_NORMAL}, ' \t\n\r')"


@query(rf"""WITH t AS (SELECT page_id, url, {_PAGE_TEXT} AS problem FROM pages), s AS (SELECT page_id, problem, 'page ' || lower(regexp_extract(url, '://([^/]*)', 1)) AS title, page_id % 4 + 1 AS tier FROM t),
g AS (SELECT *, regexp_replace(title, '[^a-z0-9]+', '-', 'g') AS slug FROM s), n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY page_id) AS k FROM g)
SELECT page_id, 'problem-tier' || tier || '-' || slug || CASE WHEN k > 1 THEN '-' || k ELSE '' END AS id, tier::INT AS tier, title, sha256(problem) AS problem_sha256, page_id || ' & more' AS answer, 'Since ' || page_id || '.' AS solution FROM n""")
def page_records(spark, sf_dir):
    """Records from pages of problems: the whole of a page of the table, with its own nested elements, is a problem's panel."""
    p = table(spark, sf_dir, "pages")
    i, host = F.col("page_id").cast("string"), F.lower(F.regexp_extract("url", "://([^/]*)", 1))
    scroll = lambda shown, inside: [F.lit(f'<div style="display: {shown};" class="problem-content-scroll x">'), *inside, F.lit("</div>")]
    page = F.concat(
        F.lit('<h3 class="display-4">before any tier</h3><h2 id="tier-'), (F.col("page_id") % 4 + 1).cast("string"), F.lit('" class="t">Tier</h2><div><h3 class="display-4">Page <i>'), host, F.lit("</i></h3><div>"), *scroll("block", [F.coalesce("html", F.lit(""))]),
        *scroll("none", [F.lit("<p><strong>Answer:</strong> "), i, F.lit(" &amp; more.</p><p><strong>Solution</strong>: <div>Since <b>"), i, F.lit("</b>.</div></p>")]), F.lit("</div></div>"),
    )
    got = records.page_records(p.select("page_id", page.alias("page")), "page_id", "page")
    return got.select("page_id", "id", "tier", F.lower("title").alias("title"), F.sha2("problem", 256).alias("problem_sha256"), "answer", "solution")


@query("""WITH a AS (SELECT lang, doc_id, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS k FROM documents),
e AS (SELECT lang, min(k) FILTER (text IS DISTINCT FROM other) AS first_at, count(*) FILTER (text IS DISTINCT FROM other) AS n_differ FROM (
  SELECT x.lang, x.k, x.text, y.text AS other FROM a x JOIN a y ON x.lang = y.lang AND y.k = CASE WHEN x.lang <> 'en' THEN x.k WHEN x.k % 100 = 3 THEN greatest(x.k - 1, 0) WHEN x.k % 100 = 2 THEN x.k + 1 ELSE x.k END) GROUP BY lang)
SELECT lang AS value, first_at::BIGINT AS first_at, n_differ::BIGINT AS n_differ, 0::BIGINT AS n_missing, 0::BIGINT AS n_extra FROM e WHERE n_differ > 0""")
def ordered_verify(spark, sf_dir):
    """A copy in which neighbours of one language are exchanged here and there: the same rows in another order."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    k = F.col("row_index") % 100
    moved = F.when(F.col("lang") != "en", F.col("row_index")).when(k == 2, F.col("row_index") + 1).when(k == 3, F.col("row_index") - 1).otherwise(F.col("row_index"))
    copy = identity.row_index(d, ["doc_id"], ["lang"]).withColumn("place", moved)
    last = copy.groupBy("lang").agg(F.max("row_index").alias("last"))
    copy = copy.join(F.broadcast(last), "lang").withColumn("place", F.when((F.col("place") > F.col("last")), F.col("row_index")).otherwise(F.col("place")))
    return writers.verify_order(d.select("lang", "text", "doc_id"), copy.select("lang", "text", "place"), "lang", ["text"], ["doc_id"], ["place"])


@query("""SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n, sum(round(l_extendedprice * (1 - l_discount), 8)::DECIMAL(28, 8))::DOUBLE AS revenue,
  sum(round(l_discount, 8)::DECIMAL(28, 8))::DOUBLE / count(*) AS mean_discount FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def exact_sums(spark, sf_dir):
    """Money summed as whole numbers of a smallest unit, whatever the partitions."""
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(count(), exact.exact_sum(price).alias("revenue"), exact.exact_mean("l_discount").alias("mean_discount"))


@query("""SELECT doc_id, sha256('{"doc_id": ' || doc_id || ', "half": ' || (doc_id / 2.0)::DOUBLE || ', "lang": "' || lang || '", "nested": {"a": [' || coalesce('"' || source || '"', 'null') || ', null], "b": ' || CASE WHEN n_chars > 500 THEN 'true' ELSE 'false' END || '}}') AS digest FROM documents""")
def canonical_json(spark, sf_dir):
    """Digests of rows as JSON with sorted keys at every level."""
    d = table(spark, sf_dir, "documents")
    nested = F.struct((F.col("n_chars") > 500).alias("b"), F.array("source", F.lit(None).cast("string")).alias("a"))
    rows = d.select("doc_id", nested.alias("nested"), "lang", (F.col("doc_id") / 2.0).alias("half"))
    return rows.select("doc_id", F.sha2(canonical.canonical_row(rows.schema), 256).alias("digest"))


@query("""SELECT lang, count(*)::BIGINT AS n FROM documents WHERE lang IN ('en', 'fr', 'xx') GROUP BY lang""")
def keep_in_set(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return preparation.value_counts(preparation.keep_in(d, "lang", ["en", "fr", "xx"]), "lang")


@query("""WITH k AS (SELECT source, text, lang, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k FROM documents)
SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (lang IS DISTINCT FROM 'en')::BIGINT AS not_held, count(*) FILTER (trim(coalesce(text, ''), ' \t\n\r') = '')::BIGINT AS blank,
  count(*) FILTER (k > 0)::BIGINT AS suffixed, 0::BIGINT AS repeated FROM k""")
def prepared_facts(spark, sf_dir):
    """Ids made unique show as such: sources as ids of documents."""
    d = identity.disambiguate(table(spark, sf_dir, "documents").select("doc_id", "source", "text", "lang"), "source", ["doc_id"])
    return preparation.prepared_facts(d, "row_id", ["text"], F.col("lang") == "en")
