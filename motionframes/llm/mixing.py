"""Mixing sources to target weights: budgets down a tree, then a token prefix of seeded epochs in each leaf."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionframes.llm.common import WORD, saved, table

#: The levels of the tree, from the root.
LEVELS = ("mix_domain", "mix_lang", "mix_source")


@dataclass(frozen=True)
class Mix:
    """share: tokens wanted, as a part of all; max_epochs: how often a leaf may be read; weights: SQL over the names of a level."""

    share: float = 0.8
    max_epochs: int = 2
    seed: int = 17
    domain: str = "concat('d', ascii(right(coalesce(source, ''), 1)) % 3)"
    weights: tuple[str, str, str] = (
        "CASE mix_domain WHEN 'd0' THEN 0.5D WHEN 'd1' THEN 0.3D ELSE 0.2D END",
        "CASE mix_lang WHEN 'en' THEN 0.55D ELSE 0.15D END",
        "1D",
    )
    #: Rows of a leaf that share a bucket of the epoch's order, about.
    bucket_rows: int = 50_000


def _level(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Splits each parent's budget among its children: by weight, but no child above what it holds.

    Children are met in the order of what they hold a weight; the water level is what the others leave
    to the first child that can't be filled, which is the largest such figure. So a shortage goes to
    siblings first, and only what a whole subtree lacks was taken off it a level above.
    """
    order = [F.col("holds") / F.col("weight"), F.col("name")]
    among = Window.partitionBy(*parent)
    before = F.coalesce(F.sum("holds").over(among.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(among.orderBy(*order).rowsBetween(0, Window.unboundedFollowing))
    share = nodes.withColumn("share", (F.col("budget") - before) / rest)
    return share.withColumn("budget", F.least("holds", F.col("weight") * F.max("share").over(among))).drop("share", "weight", "holds", "name")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves (the LEVELS, tokens) plus budget in whole tokens; a weight of zero or less, or null, gives a branch nothing."""
    for n, sql in enumerate(mix.weights):
        leaves = leaves.withColumn(f"w{n}", F.expr(sql))
    live = leaves.where("w0 > 0 AND w1 > 0 AND w2 > 0 AND tokens > 0").withColumn("holds", F.col("tokens") * float(mix.max_epochs))
    holds = F.sum(F.when(F.expr("w0 > 0 AND w1 > 0 AND w2 > 0"), F.col("tokens") * float(mix.max_epochs)))
    root = leaves.agg(F.least(holds, F.sum("tokens") * mix.share).alias("budget")).withColumn("root", F.lit(0))
    above, found = ["root"], root
    for n in range(len(LEVELS)):
        keys = list(LEVELS[: n + 1])
        nodes = live.groupBy(*keys).agg(F.sum("holds").alias("holds"), F.first(f"w{n}").alias("weight"))
        nodes = nodes.withColumns({"root": F.lit(0), "name": F.col(LEVELS[n])}).join(found, above)
        found, above = _level(nodes, above), ["root", *keys]
    return leaves.join(found, list(LEVELS), "left").select(*LEVELS, "tokens", F.round(F.coalesce("budget", F.lit(0.0))).cast("long").alias("budget"))


def _leafed(docs: DataFrame, mix: Mix) -> DataFrame:
    return docs.withColumns(
        {
            "mix_domain": F.expr(mix.domain),
            "mix_lang": F.coalesce("lang", F.lit("")),
            "mix_source": F.coalesce("source", F.lit("")),
            "mix_tokens": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        }
    )


def _key(mix: Mix, epoch: Column) -> Column:
    """A row's place in an epoch: a new order in each."""
    return F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.lit(mix.seed), epoch).cast("binary"))


def plan(docs: DataFrame, mix: Mix) -> DataFrame:
    """A row for each leaf: budget, whole epochs, tokens of the begun epoch, and the bucket of its order where they end."""
    leaves = saved(docs.groupBy(*LEVELS).agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("rows")), "mix-leaves")
    digits, most = 1, leaves.agg(F.max("rows")).first()[0] or 0
    while most > mix.bucket_rows * 16**digits and digits < 8:
        digits += 1
    budgets = leaf_budgets(leaves, mix).withColumns(
        {
            "mix_full": F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int"),
            "mix_part": F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0),
        }
    )
    budgets = saved(budgets, "mix-budgets")
    keyed = docs.select(*LEVELS, "doc_id", "mix_tokens").join(budgets, list(LEVELS)).where("mix_part > 0")
    buckets = keyed.groupBy(*LEVELS, F.substring(_key(mix, F.col("mix_full")), 1, digits).alias("bucket")).agg(
        F.sum("mix_tokens").alias("size"), F.first("mix_part").alias("mix_part")
    )
    until = F.sum("size").over(Window.partitionBy(*LEVELS).orderBy("bucket"))
    cut = buckets.withColumn("until", until).where(F.col("until") >= F.col("mix_part"))
    cut = cut.groupBy(*LEVELS).agg(F.min(F.struct("bucket", (F.col("mix_part") - F.col("until") + F.col("size")).alias("left"))).alias("c"))
    return saved(
        budgets.join(cut, list(LEVELS), "left").select(
            *LEVELS, "tokens", "budget", "mix_full", F.col("c.bucket").alias("mix_bucket"), F.col("c.left").alias("mix_left"), F.lit(digits).alias("mix_digits")
        ),
        "mix-plan",
    )


def mixed(docs: DataFrame, mix: Mix, narrow: bool = False) -> DataFrame:
    """The chosen rows of docs (doc_id, text, lang, source and any others), each once an epoch, plus mix_epoch and the leaf's columns.

    A null lang or source is a branch named ''; a row without words costs nothing and comes with its
    place in the order; repeated rows are rows of their own (those with equal doc_id and leaf in the begun
    epoch are told apart by their tokens only). An empty table gives no rows. Column names starting with mix_ are reserved.

    Rows meet one row of their leaf's plan, a small table, so a leaf with a third of all rows isn't gathered
    anywhere. Only the bucket in which a leaf's budget ends is put in order.
    """
    leafed = _leafed(docs, mix)
    if narrow:
        leafed = saved(leafed.select("doc_id", *LEVELS, "mix_tokens"), "mix-rows")
    held = leafed.join(plan(leafed, mix), list(LEVELS)).withColumn("mix_key", _key(mix, F.col("mix_full")))
    bucket = F.substring("mix_key", F.lit(1), F.col("mix_digits"))
    whole = held.where("mix_full > 0").withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("mix_full") - 1)))
    below = held.where(bucket < F.col("mix_bucket")).withColumn("mix_epoch", F.col("mix_full"))
    order = Window.partitionBy(*LEVELS).orderBy("mix_key", "mix_tokens")
    start = F.sum("mix_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("mix_tokens")
    last = held.where(bucket == F.col("mix_bucket")).withColumn("mix_start", start).where("mix_start < mix_left").drop("mix_start").withColumn("mix_epoch", F.col("mix_full"))
    return whole.unionByName(below).unionByName(last).drop("mix_key", "mix_full", "mix_bucket", "mix_left", "mix_digits")


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    chosen = mixed(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"), Mix(), narrow=True)
    return chosen.select(
        "doc_id",
        F.col("mix_domain").alias("domain"),
        F.col("mix_lang").alias("lang"),
        F.col("mix_source").alias("source"),
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_epoch").alias("epoch"),
        F.col("tokens").alias("leaf_tokens"),
        F.col("budget").alias("leaf_budget"),
    )


def mix_sql(documents: str = "documents") -> str:
    """The common tables of a mix over a table with doc_id, text, lang and source; the last is m."""
    levels = ("domain", "lang", "source")
    weight = {
        "domain": "CASE domain WHEN 'd0' THEN 0.5::DOUBLE WHEN 'd1' THEN 0.3 ELSE 0.2 END",
        "lang": "CASE lang WHEN 'en' THEN 0.55::DOUBLE ELSE 0.15 END",
        "source": "1::DOUBLE",
    }
    steps, above, parent = [], "b0", []
    for n, level in enumerate(levels):
        keys = list(levels[: n + 1])
        names, on = ", ".join(keys), " AND ".join(f"l.{k} = b.{k}" for k in parent) or "true"
        among = f"PARTITION BY {', '.join(parent)}" if parent else ""
        steps.append(f"""
n{n} AS (SELECT {', '.join('l.' + k for k in keys)}, sum(l.tokens * 2.0::DOUBLE) AS holds, any_value(b.budget) AS budget, {weight[level].replace(level, f'any_value(l.{level})', 1) if level != 'source' else weight[level]} AS w
  FROM leaves l JOIN {above} b ON {on} WHERE l.tokens > 0 GROUP BY {', '.join('l.' + k for k in keys)}),
s{n} AS (SELECT *, (budget - coalesce(sum(holds) OVER ({among} ORDER BY holds / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER ({among} ORDER BY holds / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM n{n}),
b{n + 1} AS (SELECT {names}, least(holds, w * max(share) OVER ({among})) AS budget FROM s{n})""")
        above, parent = f"b{n + 1}", keys
    return f"""d AS (SELECT doc_id, 'd' || (CASE WHEN coalesce(source, '') = '' THEN 0 ELSE ascii(right(source, 1)) % 3 END) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM {documents}),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
b0 AS (SELECT least(sum(tokens) * 2.0::DOUBLE, sum(tokens) * 0.8::DOUBLE) AS budget FROM leaves), {', '.join(steps)},
lb AS (SELECT l.*, round(coalesce(b.budget, 0))::BIGINT AS budget FROM leaves l LEFT JOIN b3 b USING (domain, lang, source)),
f AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole FROM lb),
k AS (SELECT d.*, f.tokens, f.budget, f.whole,
  sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
    ORDER BY md5(d.doc_id || '|17|' || f.whole), n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS start
  FROM d JOIN f USING (domain, lang, source)),
m AS (SELECT doc_id, domain, lang, source, n_tokens, unnest(range(whole))::INT AS epoch, tokens AS leaf_tokens, budget AS leaf_budget FROM k
  UNION ALL SELECT doc_id, domain, lang, source, n_tokens, whole::INT, tokens, budget FROM k WHERE tokens > 0 AND start < budget - whole * tokens)"""


OP4_SQL = f"WITH {mix_sql()} SELECT * FROM m"
