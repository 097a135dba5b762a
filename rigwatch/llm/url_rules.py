"""URL filters: fixed host/path rules, then association rules mined from labelled urls.

FP-growth finds sets of url tokens (host suffixes, path segments, query keys) that occur together
with a bad label. A rule is kept if its support is high enough and if its confidence lies above the
share of bad urls by more than chance: the lower bound of its Wilson interval, at an error level
divided by the number of rules tried, must pass that share. So labels that don't depend on the
urls give no rules. A rule that a shorter one implies, with no less confidence, is dropped. A url is
matched through an inverted index from tokens to rules: a rule fires if all of its tokens are found.

Defined results: a null url, or one without ``://``, has empty host and path and no tokens, so it
gets the default verdict ``allow``; without labels, or without rules, all others do too; equal urls
get equal verdicts; null labels are left out; further columns are kept, but for those with the name
of a result, which the result replaces.
"""

from __future__ import annotations

import string
from statistics import NormalDist

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigwatch.session import materialise

# Fixed values: (verdict, host, path).
BASE_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
              ("allow", "com", "/fr/"), ("block", "com", "/de/")]
BAD = "=bad"
MIN_SUPPORT = 0.002      # bad urls under a rule, as a share of the labelled urls
MIN_BAD = 5              # and their number
ERROR = 0.05             # chance of any rule where labels don't depend on urls
RESULTS = ["host", "path", "rule", "verdict", "confidence"]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def base_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fixed rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(BASE_RULES, key=lambda r: len(r[1] + r[2])):  # a longer one overrides
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host suffixes, path segments without digits, and query keys."""
    labels = F.split(host_of(url), r"\.")
    suffixes = F.transform(labels, lambda _, i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))
    segments = F.transform(F.split(F.lower(path_of(url)), "/"), lambda s: F.concat(F.lit("p:"), F.regexp_replace(s, "[0-9]+", "")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda s: F.concat(F.lit("q:"), F.lower(F.split_part(s, F.lit("="), F.lit(1)))))
    return F.array_distinct(F.filter(F.concat(suffixes, segments, keys), lambda t: F.char_length(t) > 2))


def above(confidence: Column, n: Column, share: float, rules: int) -> Column:
    """Whether a confidence seen on ``n`` urls is above a share, when so many rules are tried."""
    z = NormalDist().inv_cdf(1 - ERROR / rules)
    spread = z * F.sqrt(confidence * (1 - confidence) / n + z * z / (4 * n * n))
    return (confidence + z * z / (2 * n) - spread) / (1 + z * z / n) > share


def mine_rules(labelled: DataFrame) -> DataFrame:
    """``rule_id, tokens, n, confidence`` from rows of ``url, bad``; ``n``: labelled urls with these tokens."""
    spark = labelled.sparkSession
    rows = materialise(labelled.where("bad is not null").select(F.col("bad"), tokens_of(F.col("url")).alias("tokens")), "url-labelled")
    total, bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    if bad < MIN_BAD:
        return spark.createDataFrame([], "rule_id long, tokens array<string>, n long, confidence double")
    items = F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens"))
    model = FPGrowth(itemsCol="items", minSupport=max(MIN_SUPPORT, MIN_BAD / total)).fit(rows.select(items.alias("items")))
    sets = materialise(model.freqItemsets.select(F.sort_array("items").alias("items"), "freq"), "url-sets")  # mined once
    under = sets.where(F.array_contains("items", BAD)).select(F.array_remove("items", BAD).alias("items"), F.col("freq").alias("bad")).where("size(items) > 0")
    tried = materialise(under.join(sets, "items").select(F.col("items").alias("tokens"), F.col("freq").alias("n"), (F.col("bad") / F.col("freq")).alias("confidence")), "url-tried")
    good = materialise(tried.where(above(F.col("confidence"), F.col("n"), bad / total, max(1, tried.count()))), "url-rules")
    shorter = F.transform("tokens", lambda t: F.array_remove("tokens", t))
    parts = good.select("tokens", "confidence", F.explode(shorter).alias("part"))
    also = good.select(F.col("tokens").alias("part"), F.col("confidence").alias("by_part"))
    implied = parts.join(also, "part").where("by_part >= confidence").select("tokens")
    return materialise(good.join(implied, "tokens", "left_anti").select(F.xxhash64("tokens").alias("rule_id"), "tokens", "n", "confidence"), "url-kept")


def fired(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, confidence``: the strongest rule of each distinct url on which one fires."""
    index = rules.select("rule_id", "confidence", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    tokens = urls.select("url").where("url is not null").distinct().select("url", F.explode(tokens_of(F.col("url"))).alias("token"))
    hits = tokens.join(index, "token").groupBy("url", "rule_id", "confidence", "n").agg(F.count(F.lit(1)).alias("found"))
    return hits.where("found = n").groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` and the ``confidence`` of the strongest mined rule that fires."""
    strongest = fired(pages.select(F.col(url).alias("url")), rules).select(F.col("url").alias("_url_fired"), F.col("confidence").alias("_url_confidence"))
    joined = pages.join(strongest, pages[url] == F.col("_url_fired"), "left")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, verdict = base_rule(host, path)
    mined = F.when(F.col("_url_confidence").isNotNull(), "block").otherwise("allow")
    return joined.select(*[c for c in pages.columns if c not in RESULTS], host.alias("host"), path.alias("path"), rule.alias("rule"),
                         F.coalesce(verdict, mined).alias("verdict"), F.col("_url_confidence").alias("confidence"))
