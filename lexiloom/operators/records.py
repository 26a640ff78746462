"""Pages of problems to records: headings, titles and panels as spans of characters.

A page becomes rows, one for each piece of it (a tag or what stands between
two); running sums of their lengths give the place of each, and of the steps of
panel tags their depth.  An opening tag and the next piece at its depth, which
must be a closing tag, are a span, so elements within a panel do not end it.
What comes after a title, up to the next title or heading, is its block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.text import normalise, slug, split_answer, strip_tags, unescape_basic
from lexiloom.operators.identity import numbered_slugs

PIECE = r"(?s)<!--.*?-->|<[^<>]*>|[^<]+|<"


@dataclass(frozen=True)
class Layout:
    """The tags of a page, as patterns that match them whole; group 1 of `heading` is its number."""

    # The layout of the pages that are read by default.
    heading: str = r'<h2 id="tier-(\d+)"[^>]*>'
    title: str = r'<h3 class="display-4"[^>]*>'
    title_end: str = "</h3>"
    panel: str = r'<div style="display: (?:block|none);" class="problem-content-scroll[^"]*">'
    element: str = "div"


def pieces(pages: DataFrame, key: str, page: str) -> DataFrame:
    """key, place (number of the piece), piece, start and end (characters); null pages have none."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(page, F.lit(PIECE), F.lit(0))).alias("place", "piece"))
    until = Window.partitionBy(key).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("end", F.sum(F.length("piece")).over(until)).withColumn("start", F.col("end") - F.length("piece"))


def spans(parts: DataFrame, key: str, element: str) -> DataFrame:
    """Each opening tag of an element with the place and start of the closing tag that balances it: null if there is none."""
    step = F.when(F.col("piece").rlike(rf"^<{element}\b"), 1).when(F.col("piece") == f"</{element}>", -1)
    tags = parts.withColumn("step", step).where("step IS NOT NULL")
    depth = F.sum("step").over(Window.partitionBy(key).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    level = tags.withColumn("level", depth + F.when(F.col("step") < 0, 1).otherwise(0))
    after = Window.partitionBy(key, "level").orderBy("place")
    closed = level.withColumns({"next": F.lead("step").over(after), "close_place": F.lead("place").over(after), "close_start": F.lead("start").over(after)}).where("step = 1")
    ends = lambda c: F.when(F.col("next") == -1, F.col(c)).alias(c)
    return closed.select(key, "place", "piece", F.col("end").alias("open_end"), "level", ends("close_place"), ends("close_start"))


def page_records(pages: DataFrame, key: str, page: str, layout: Layout | None = None, prefix: str = "problem", decode=unescape_basic) -> DataFrame:
    """One record for each title of a page: key, id, tier, title, problem, answer, solution.

    The first two panels after a title, before the next title or heading, are its
    problem and its solution.  Titles before the first heading are not records.  A
    title with fewer panels, and a panel that never closes, is an error.  Ids are
    prefix-tier<n>-<slug>, repeats of a slug numbered from 2 in order of key and
    place over all pages.
    """
    at, parts = layout or Layout(), pieces(pages, key, page)
    is_a = lambda pattern: F.col("piece").rlike(f"^(?:{pattern})$")
    down = Window.partitionBy(key).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    block = F.last(F.when(is_a(at.title), F.col("place")).when(is_a(at.heading), -1), ignorenulls=True).over(down)  # the title that a piece comes after
    tier = F.last(F.when(is_a(at.heading), F.regexp_extract("piece", at.heading, 1).cast("int")), ignorenulls=True).over(down)
    marked = parts.where(F.startswith("piece", F.lit("<"))).withColumns({"block": block, "tier": tier}).where("block >= 0 AND tier IS NOT NULL")
    closes = spans(parts, key, at.element).where(is_a(at.panel)).select(key, "place", F.struct("place", "open_end", "close_start").alias("panel"))
    first = lambda name: F.max(F.when(F.col("place") == F.col("block"), F.col(name))).alias(name)
    grouped = marked.join(closes, [key, "place"], "left").groupBy(key, "block").agg(first("tier"), first("end"), F.min(F.when(F.col("piece") == at.title_end, F.col("start"))).alias("title_end"), F.array_sort(F.collect_list("panel")).alias("panels"))
    return _texts(grouped, pages, key, page, prefix, decode)


def _texts(blocks: DataFrame, pages: DataFrame, key: str, page: str, prefix: str, decode) -> DataFrame:
    """The records' texts, cut from the page."""
    rows = blocks.join(pages.select(key, F.col(page).alias("page")), key)
    cut = lambda a, b: F.substring(F.col("page"), (a + 1).cast("int"), (b - a).cast("int"))

    def panel(i: int) -> Column:
        p = F.get("panels", F.lit(i))
        none = F.raise_error(F.concat(F.lit(f"no panel {i + 1} of 2 for a title of page "), F.col(key).cast("string")))
        never = F.raise_error(F.concat(F.lit("a panel never closes on page "), F.col(key).cast("string")))
        return F.when(p.isNull(), none).when(p["close_start"].isNull(), never).otherwise(cut(p["open_end"], p["close_start"]))

    rows = rows.withColumns({"title": normalise(decode(F.regexp_replace(cut(F.col("end"), F.col("title_end")), "<[^>]+>", ""))), "problem": panel(0), "parts": split_answer(panel(1))})
    named = numbered_slugs(rows.withColumn("slug", slug(F.col("title"))), "slug", [key, "block"])
    answer = F.regexp_replace(strip_tags(F.col("parts.answer"), decode), r"\.+$", "")
    return named.select(key, F.concat_ws("-", F.lit(prefix), F.concat(F.lit("tier"), "tier"), "id").alias("id"), "tier", "title", strip_tags(F.col("problem"), decode).alias("problem"), answer.alias("answer"), strip_tags(F.col("parts.solution"), decode).alias("solution"))
