"""URL filter: given host and path rules, then mined association rules.

Given rules fit a host and all its subdomains if the path starts with the
rule's path; the longest wins.  They are indexed by host: each distinct host
looks up its own suffixes, and a page then only tries the paths of those rules.

Pages without a rule are judged by token combinations.  A URL becomes tokens
(host labels, path segments, query keys).  FP-growth mines the combinations
that go with blocked labels; those with enough support, confidence and lift
are kept, shorter ones instead of longer ones that are no surer.  Each mined
rule is indexed under its rarest token, so a URL meets only rules of which it
has that token, and is then compared with the rest of the combination.

Only DataFrame functions and ``pyspark.ml`` are used.

Defined results: a null URL or one without ``://`` has an empty host and path,
no rule and the verdict allow; equal rules of one length go by verdict, block
first; repeated pages are judged alike; without labels nothing is mined; an
empty table gives no rows; other columns are kept, those named like a result
are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sizes import broadcast_if_small
from ..functions.storage import materialise
from .words import shielded

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.005
#: Labelled URLs a combination must have at least, however few labels there are.
MIN_COUNT = 10
MIN_CONFIDENCE = 0.6
MIN_LIFT = 2.0
BLOCK, ALLOW = "label:block", "label:allow"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens: host labels, path segments (numbers as one), query keys."""
    host, path = host_and_path(url)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("path:"), F.regexp_replace(F.lower(x), "[0-9]+", "0")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.regexp_extract(x, "^([^=]*)", 1)))
    both = F.array_distinct(F.concat(labels, segments, keys))
    return F.coalesce(F.filter(both, lambda x: ~x.isin("host:", "path:", "query:")), F.array().cast("array<string>"))


def with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` and ``given`` (its verdict) of the longest fitting rule(host, path, verdict) to pages with host and path."""
    suffix = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    hosts = pages.filter("host <> ''").select("host").distinct().withColumn("labels", F.split("host", r"\."))
    asked = hosts.select("host", F.explode(suffix).alias("_rule_host"))
    given = rules.select(F.col("host").alias("_rule_host"), F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.col("verdict"), F.concat("host", "path").alias("rule"), "path").alias("r"))
    known = asked.join(broadcast_if_small(given), "_rule_host").groupBy("host").agg(F.collect_list("r").alias("_rules"))
    fits = F.array_max(F.filter("_rules", lambda r: F.startswith(F.col("path"), r["path"])))
    return (pages.join(broadcast_if_small(known), "host", "left").withColumn("_best", fits)
            .withColumns({"rule": F.col("_best.rule"), "given": F.col("_best.verdict")}).drop("_best", "_rules"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_lift: float = MIN_LIFT) -> DataFrame:
    """(tokens, confidence, support) of the combinations that go with blocking; ``labelled`` has url and blocked."""
    baskets = materialise(labelled.filter("blocked is not null").select(
        F.array_append(tokens(F.col("url")), F.when(F.col("blocked"), BLOCK).otherwise(ALLOW)).alias("items")))
    n = baskets.count()
    if n < MIN_COUNT:
        return baskets.sparkSession.createDataFrame([], "tokens array<string>, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, MIN_COUNT / n), minConfidence=min_confidence).fit(baskets)
    sure = materialise(model.associationRules.filter(
        (F.element_at("consequent", 1) == BLOCK) & (F.col("lift") >= min_lift)
        & ~F.array_contains("antecedent", ALLOW)).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    # A combination is left out where a smaller one within it is at least as sure.
    part = sure.select(F.col("tokens").alias("_less"), F.col("confidence").alias("_sure"), F.element_at("tokens", 1).alias("_t"))
    own = sure.select("*", F.explode("tokens").alias("_t"))
    worse = own.join(part, "_t").filter((F.size("_less") < F.size("tokens")) & (F.size(F.array_except("_less", "tokens")) == 0)
                                        & (F.col("_sure") >= F.col("confidence"))).select("tokens").distinct()
    return sure.join(worse, "tokens", "left_anti")


def with_mined(pages: DataFrame, mined: DataFrame) -> DataFrame:
    """Adds ``confidence``: that of the surest mined rule whose tokens the URL has."""
    urls = pages.select("url").distinct().select("url", tokens(F.col("url")).alias("_own"))
    mined = materialise(mined)
    often = (urls.select(F.explode("_own").alias("token")).join(
        broadcast_if_small(mined.select(F.explode("tokens").alias("token")).distinct()), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    ranked = mined.select("tokens", "confidence", F.explode("tokens").alias("token")).join(broadcast_if_small(often), "token", "left")
    posted = ranked.groupBy("tokens", "confidence").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), F.col("token"))).alias("token"))
    met = urls.select("url", "_own", F.explode("_own").alias("token")).join(broadcast_if_small(posted), "token").filter(
        F.size(F.array_except("tokens", "_own")) == 0)
    best = met.groupBy("url").agg(F.max("confidence").alias("confidence"))
    return pages.join(broadcast_if_small(best), "url", "left")


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Adds host, path, rule, confidence and verdict to pages with url."""
    spark: SparkSession = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")
    host, path = host_and_path(F.col("url"))
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "confidence", "given")]
    mine_, back = shielded(pages.select(*[F.col(f"`{c}`") for c in own]), ("url",))
    cut = mine_.withColumns({"host": host, "path": path})
    found = with_rules(cut, rules)
    if labelled is None:
        found = found.withColumn("confidence", F.lit(None).cast("double"))
    else:
        found = with_mined(found, mine(labelled))
    verdict = F.coalesce("given", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return found.select(*back, "host", "path", "rule", "confidence", verdict.alias("verdict"))
