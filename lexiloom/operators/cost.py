"""Prices, usage sums and cost reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.exact import exact_sum

TOKENS = ("input_tokens", "output_tokens", "reasoning_tokens", "total_tokens")
BATCH_DISCOUNT = 0.5
# Built-in prices, USD for a million tokens in and out.
PRICES = {
    "gemini-2.5-pro": (1.25, 10.00),
    "gemini-2.5-flash-lite": (0.10, 0.40),
    "gemini-2.5-flash": (0.30, 2.50),
    "gemini-2.0-flash-lite": (0.075, 0.30),
    "gemini-2.0-flash": (0.10, 0.40),
}


def price_table(spark: SparkSession, overrides: dict[str, dict] | None = None) -> DataFrame:
    """price_key, input_per_1m, output_per_1m, batch_discount; overrides replace built-in prices."""
    table = {k: (a, b, BATCH_DISCOUNT) for k, (a, b) in PRICES.items()}
    for k, v in (overrides or {}).items():
        table[k] = (float(v["input_per_1m"]), float(v["output_per_1m"]), float(v.get("batch_discount", BATCH_DISCOUNT)))
    rows = F.array(*[F.struct(F.lit(k).alias("price_key"), F.lit(a).alias("input_per_1m"), F.lit(b).alias("output_per_1m"), F.lit(d).alias("batch_discount")) for k, (a, b, d) in table.items()])
    return spark.range(1).select(F.inline(rows))


def spellings(model: Column) -> Column:
    """The model name with its leading path parts removed one by one."""
    parts = F.split(F.trim(model), "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))


def match_prices(models: DataFrame, prices: DataFrame) -> DataFrame:
    """model with its price: an exact spelling, the longest first, else the longest key that its last part starts with; null if none."""
    names = models.select("model").distinct().withColumn("s", spellings(F.col("model")))
    rank = F.array_position("s", F.col("price_key"))
    hit = (rank > 0) | F.startswith(F.element_at("s", -1), F.col("price_key"))
    found = names.join(F.broadcast(prices), hit)  # one row for each configured price
    order = F.struct(F.when(rank > 0, -rank).otherwise(F.lit(-1_000_000)).alias("exact"), F.length("price_key").alias("n"))
    best = found.groupBy("model").agg(F.max_by(F.struct(*prices.columns), order).alias("p")).select("model", "p.*")
    return models.join(best, "model", "left")


def cost_of(batch: Column) -> Column:
    """USD of a row with token counts and a price; thinking is billed as output; 0 without a price."""
    c = (F.col("input_tokens") * F.col("input_per_1m") + (F.col("output_tokens") + F.col("reasoning_tokens")) * F.col("output_per_1m")) / 1_000_000
    return F.coalesce(F.when(batch, c * F.col("batch_discount")).otherwise(c), F.lit(0.0))


def estimate(usage: DataFrame, prices: DataFrame, batch: Column) -> DataFrame:
    """Add cost_usd and cost_source to rows with model and token counts."""
    out = match_prices(usage, prices)
    source = F.when(F.col("price_key").isNull(), "unknown").otherwise("price_table")
    return out.withColumns({"cost_usd": F.round(cost_of(batch), 8), "cost_source": source}).drop(*prices.columns)


def totals() -> list[Column]:
    """Sums of a usage table; requests are the rows with usage."""
    return [F.count("total_tokens").alias("requests"), *[F.coalesce(F.sum(t), F.lit(0)).cast("long").alias(t) for t in TOKENS], F.coalesce(exact_sum("cost_usd"), F.lit(0.0)).alias("cost_usd")]


def summarise(usage: DataFrame, keys: list[str]) -> DataFrame:
    """The grand total and a row for each group, in one pass; `grouped` tells them apart."""
    return usage.groupingSets([[F.col(k) for k in keys], []], *[F.col(k) for k in keys]).agg((F.grouping_id() == 0).alias("grouped"), *totals())


def roll_up(usage: DataFrame) -> DataFrame:
    """By stage (with its round), unit and language, and the run: level, key and totals."""
    stage = F.when(F.coalesce("round", F.lit(0)) > 0, F.concat_ws("_r", "stage", F.col("round").cast("string"))).otherwise(F.coalesce("stage", F.lit("unknown")))
    u = usage.withColumns({"stage_key": stage, "unit": F.concat_ws("/", "dataset_config", "split"), "language": F.coalesce(F.nullif("language", F.lit("")), F.lit("unknown"))})
    level = F.when(F.grouping("stage_key") == 0, "stage").when(F.grouping("unit") == 0, "unit").when(F.grouping("language") == 0, "language").otherwise("run")
    key = F.coalesce("stage_key", "unit", "language", F.lit("run"))
    out = u.groupingSets([["stage_key"], ["unit"], ["language"], []], "stage_key", "unit", "language").agg(level.alias("level"), *totals())
    return out.select("level", key.alias("key"), "requests", *TOKENS, "cost_usd")


def merge(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sum totals that were summed before."""
    return parts.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in ("requests", *TOKENS)], exact_sum("cost_usd").alias("cost_usd"))


def reprice(by_mode: DataFrame, groups: DataFrame, prices: DataFrame, policy: str = "gaps") -> tuple[DataFrame, DataFrame]:
    """Costs of stages from their token counts, by mode; and of their groups, scaled by the stage's blend of modes.

    `by_mode` has stage, model, mode, token counts and cost_usd; `groups` has
    stage, grp, token counts and cost_usd.  "gaps" prices stages that cost nothing
    so far, "force" all, "off" none.
    """
    if policy not in ("gaps", "force", "off"):
        raise ValueError(f"no repricing policy {policy!r}")
    p = match_prices(by_mode, prices)
    p = p.withColumns({"new": cost_of(F.col("mode") == "batch"), "flat": cost_of(F.lit(False)), "used": sum((F.col(t) for t in TOKENS[:3]), F.lit(0))})
    stage = p.groupBy("stage", "model").agg(exact_sum("cost_usd").alias("old"), exact_sum("new", 12).alias("new"), exact_sum("flat", 12).alias("flat"), F.sum("used").alias("used"), F.max("price_key").alias("price_key"), F.max("input_per_1m").alias("input_per_1m"), F.max("output_per_1m").alias("output_per_1m"))
    due = F.lit(policy != "off") & (F.col("used") > 0) & F.col("price_key").isNotNull() & (F.lit(policy == "force") | (F.col("old") <= 0))
    stage = stage.withColumn("due", due).withColumn("factor", F.when(F.col("flat") != 0, F.col("new") / F.col("flat")).otherwise(F.lit(1.0)))
    out = stage.select("stage", "model", F.when(F.col("due"), F.round("new", 6)).otherwise(F.col("old")).alias("cost_usd"), F.when(F.col("due"), "repriced").otherwise("recorded").alias("cost_source"))
    g = groups.join(stage.select("stage", "due", "factor", "input_per_1m", "output_per_1m"), "stage")
    flat = (F.col("input_tokens") * F.col("input_per_1m") + (F.col("output_tokens") + F.col("reasoning_tokens")) * F.col("output_per_1m")) / 1_000_000
    return out, g.select("stage", "grp", F.when(F.col("due"), F.round(flat * F.col("factor"), 6)).otherwise(F.col("cost_usd")).alias("cost_usd"))


def repriced(usage: DataFrame, prices: DataFrame, policy: str = "gaps") -> DataFrame:
    """Usage rows of stages and rounds at the prices given: of stages that cost nothing so far ("gaps"), of all ("force"), or as recorded ("off"); rows without a price keep their cost."""
    if policy not in ("gaps", "force", "off"):
        raise ValueError(f"no repricing policy {policy!r}")
    if policy == "off":
        return usage
    stages = usage.groupBy("stage", "round").agg((F.coalesce(exact_sum("cost_usd"), F.lit(0.0)) <= 0).alias("_free"))
    new = match_prices(usage.join(stages, ["stage", "round"]), prices)
    due = (F.col("_free") | F.lit(policy == "force")) & F.col("price_key").isNotNull()
    return new.withColumn("cost_usd", F.when(due, F.round(cost_of(F.col("mode") == "batch"), 8)).otherwise(F.col("cost_usd"))).drop("_free", *prices.columns)


def report_lines(rolled: DataFrame) -> DataFrame:
    """One line of text for each row of a roll-up."""
    n = lambda c, w: F.lpad(F.format_number(c, 0), w, " ")
    line = F.concat(F.rpad("key", 24, " "), F.lpad(F.col("requests").cast("string"), 9, " "), F.lit(" req  in "), n("input_tokens", 12), F.lit("  out "), n("output_tokens", 12), F.lit("  think "), n("reasoning_tokens", 11), F.lit("  $"), F.format_number("cost_usd", 4))
    return rolled.select("level", "key", line.alias("line"))
