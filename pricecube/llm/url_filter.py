"""URL filtering: fixed host and path rules, and association rules learnt from
the pages that those rules label.

A URL is a basket of tokens (host labels counted from the right, path segments,
query keys, scheme, fragment).  FP-growth over all labelled pages finds the
token combinations that go with a verdict; rules below the support and the
confidence asked for are pruned, and so is any rule whose part already gives
the verdict.  Tokens that are on just the same labelled pages can stand for each
other in every rule, so FP-growth sees one of them: a long address that many pages
share is not a pattern for each subset of its parts.  A token that gives the verdict
alone is a rule that prunes all wider ones, so FP-growth does without it.  An inverted
index from token to rule then finds the rules whose tokens a URL has in full.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_ascii, table, written

#: (verdict, rule): host up to the first slash, then the path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: The support is a share of the labelled pages of the rules' verdict, so however many
#: others one host brings, it stays as it is.
SUPPORT, CONFIDENCE = 0.02, 0.8
#: A combination on fewer pages of the verdict than this supports nothing; without it
#: every combination on any page of a small table would count.
LEAST_PAGES = 5
#: All path segments, host labels and query keys become tokens, however many.
PARTS = None
VERDICT = "verdict="
AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return fold_ascii(F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 2), F.lit(""))


def fixed_rule(host_col: Column, path_col: Column, rules, value) -> Column:
    """``value(verdict, rule)`` of the longest rule that fits, or null."""
    out = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith(slash + rest)
        out = F.when(fits, F.lit(value(verdict, rule))).otherwise(out)
    return out.cast("string")


def tokens(url: Column, host_col: Column, path_col: Column) -> Column:
    """Digits count as ``0``, so that numbered pages share their tokens."""

    def numbered(prefix: str, parts: Column) -> Column:
        parts = F.filter(parts, lambda p: p != "")
        return F.transform(parts, lambda p, i: F.concat(F.lit(prefix), i.cast("string"), F.lit("="), F.regexp_replace(p, "[0-9]+", "0")))

    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda p: F.concat(F.lit("query="), F.split_part(p, F.lit("="), F.lit(1))))
    scheme = F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"(?s)^(.*?)://", 1)))
    fragment = F.array(F.concat(F.lit("fragment="), F.regexp_extract(url, r"(?s)#(.*)$", 1)))
    labels = numbered("host", F.reverse(F.split(host_col, r"\.")))
    return F.array_distinct(F.concat(scheme, labels, numbered("path", F.split(path_col, "/")), keys, fragment))


def alike(baskets: DataFrame, verdict: str, least: int) -> tuple[dict[str, str], dict[str, tuple[int, int]]]:
    """The tokens on at least ``least`` pages of the verdict, each with the first of
    those that are on just the same labelled pages (a page counts by its hash; sums
    of those tell sets of pages apart); and for each first one its pages of the
    verdict and all its pages.

    No other token can be in a rule.  With ``least`` a share of the verdict's pages,
    they are at most such a page's mean number of tokens over that share.
    """
    page = F.xxhash64("tokens").cast("decimal(20,0)")
    held = (
        baskets.select("verdict", page.alias("page"), F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.count_if(F.col("verdict") == verdict).alias("n"), F.count(F.lit(1)).alias("pages"), F.sum("page").alias("which"))
        .where(F.col("n") >= least)
        .collect()
    )
    first: dict[tuple, str] = {}
    stands = {r.token: first.setdefault((r.pages, r.which), r.token) for r in sorted(held)}
    return stands, {r.token: (r.n, r.pages) for r in held if stands[r.token] == r.token}


def standing(tokens_col: Column, stands: dict[str, str]) -> Column:
    """What stands for the tokens, once each; tokens in no rule are left out."""
    known = F.create_map(*[F.lit(x) for pair in stands.items() for x in pair]).cast("map<string,string>")
    return F.array_distinct(F.filter(F.transform(tokens_col, lambda t: F.try_element_at(known, t)), lambda t: t.isNotNull()))


def learn(baskets: DataFrame, verdict: str, support: float, confidence: float) -> tuple[DataFrame, dict[str, str]]:
    """(rule_id, tokens, confidence, support) from (tokens, verdict) rows, and what
    stands for each token in the rules."""
    total, judged = baskets.agg(F.count(F.lit(1)), F.count_if(F.col("verdict") == verdict)).first()
    least = min(total, max(math.ceil(support * judged), LEAST_PAGES))
    stands, pages = alike(baskets, verdict, least)
    alone = [([t], n / m, n / total) for t, (n, m) in pages.items() if n / m >= confidence]
    single = baskets.sparkSession.createDataFrame(alone, "tokens array<string>, confidence double, support double")
    ruled = {t for (t,), *_ in alone}
    mixed = {t: s for t, s in stands.items() if s not in ruled}
    items = baskets.select(F.concat(standing(F.col("tokens"), mixed), F.array(F.concat(F.lit(VERDICT), "verdict"))).alias("items"))
    # Half a page less, so that rounding does not ask for one more.
    share = max(least - 0.5, 0.0) / max(total, 1)
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(items)
    found = model.associationRules.where(F.col("consequent") == F.array(F.lit(VERDICT + verdict)))
    found = written(
        found.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support").withColumn("rule_id", F.xxhash64("tokens")),
        "rules",
    )
    # A rule says nothing new if a part of its tokens gives the verdict too.
    part = found.select(F.col("rule_id").alias("part_id"), F.col("tokens").alias("part"), F.explode("tokens").alias("token"))
    wider = (
        found.select("rule_id", "tokens", F.explode("tokens").alias("token"))
        .join(part, "token")
        .where((F.size("part") < F.size("tokens")) & (F.size(F.array_intersect("part", "tokens")) == F.size("part")))
    )
    found = found.join(wider.select("rule_id").distinct(), "rule_id", "left_anti")
    return found.unionByName(single.withColumn("rule_id", F.xxhash64("tokens"))), stands


def url_filter(pages: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict), a row per input row.

    The longest fixed rule that fits decides; a page that none fits is blocked
    if a learnt rule matches it, and else allowed.  Null urls and those without
    ``://`` have empty host and path and match no rule.  Null or repeated ids do
    not matter; other columns are ignored.  Without any labelled page nothing is
    learnt.
    """
    split = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    judged = split.withColumns(
        {
            "rule": fixed_rule(F.col("host"), F.col("path"), rules, lambda v, r: r),
            "by_rule": fixed_rule(F.col("host"), F.col("path"), rules, lambda v, r: v),
        }
    )
    basket = tokens(F.col("url"), F.col("host"), F.col("path"))
    labelled = judged.where(F.col("rule").isNotNull()).select(basket.alias("tokens"), F.col("by_rule").alias("verdict"))
    blocking, stands = learn(labelled, "block", support, confidence)
    index = blocking.select("rule_id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    # Each distinct url is matched once, however often it occurs.
    unruled = judged.where(F.col("rule").isNull() & F.col("url").isNotNull() & (F.col("host") != "")).select("url", "host", "path").distinct()
    matched = (
        unruled.select("url", F.explode(standing(basket, stands)).alias("token"))
        .join(index, "token")
        .groupBy("url", "rule_id", "n")
        .agg(F.count(F.lit(1)).alias("found"))
        .where("found = n")
        .groupBy("url")
        .agg(F.count(F.lit(1)).alias("learnt_rules"))
    )
    return judged.join(matched, "url", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when((F.col("learnt_rules") > 0) & F.col("rule").isNull(), "block"), F.lit("allow")).alias("verdict"),
    )


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))
