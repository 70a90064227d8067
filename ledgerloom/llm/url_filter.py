"""URL filters: curated rules first, then association rules mined from labelled pages.

Each URL becomes a set of tokens: parts of the host (`h:`), of the path (`p:`) and query keys (`q:`). FP-growth over
labelled pages finds the combinations that come with a bad label; those with enough support and confidence are rules, and of
two that say the same the more general one stays. A rule is filed under the token that is rarest among the URLs; a URL looks up the rules of its
tokens and is blocked if all tokens of one are present. Everything is DataFrame operations.

Whole sets are mined, however long the URL. Before, tokens that stand in too few bad URLs to be part of a rule are dropped, and of
tokens that always stand together one is kept for all, so that what is mined grows with the tokens that matter. What a
rule then says of the one holds for the others, as they come with it wherever a label is known.

Defined results: a null URL or one without `://` has an empty host and path, no rule and no tokens, and is allowed.
Labels that are null count as good. Pages without labels train nothing; without labelled pages nothing is
blocked by the method. Columns named like the result's are replaced. Repeated pages and labels count as often as they stand there, and are each judged.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

SUPPORT = 0.002  # least share of mined sets that hold a rule's tokens and the label
COUNT = 5  # and their least number
CONFIDENCE = 0.8
BAD = "label:bad"


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add `host` and `path`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    lower = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return pages.withColumns({"host": F.coalesce(lower, F.lit("")), "path": F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))})


def tokens(url: str = "url") -> Column:
    """The set of tokens of a URL whose `host` and `path` are known."""
    def words(prefix: str, text: Column) -> Column:
        found = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
        return F.transform(found, lambda w: F.concat(F.lit(prefix), F.regexp_replace(w, "^[0-9]+$", "#")))

    query = F.split(F.regexp_extract(F.col(url), r"(?s)://[^?#]*\?([^#]*)", 1), "&")
    keys = F.filter(F.transform(query, lambda q: F.regexp_extract(q, "(?s)^([^=]*)", 1)), lambda k: k != "")
    return F.array_distinct(F.concat(words("h:", F.col("host")), words("p:", F.col("path")),
                                     F.transform(keys, lambda k: F.concat(F.lit("q:"), F.lower(k)))))


def mine(labelled: DataFrame, support: float = SUPPORT, count: int = COUNT, confidence: float = CONFIDENCE) -> DataFrame:
    """Rules (rule_id, antecedent, confidence, lift, support) from rows of (tokens, bad)."""
    sets = stored(labelled.select(F.monotonically_increasing_id().alias("row"), "bad", "tokens"), "url-sets")
    n = sets.count()
    least = max(support, min(1.0, count / n) if n else 1.0)
    # A token of a rule stands in at least so many bad URLs; tokens with equal sums of row hashes stand in the same URLs.
    each = sets.select("row", "bad", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count_if("bad").alias("n_bad"), F.count("*").alias("n"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("rows"))
    useful = each.filter(F.col("n_bad") >= F.lit(least * n - 1e-6)).groupBy("n", "rows").agg(F.min("token").alias("token")).select("token")
    items = sets.select("row", F.explode("tokens").alias("token")).join(useful, "token").groupBy("row").agg(F.collect_set("token").alias("found"))
    found = F.coalesce("found", F.array().cast("array<string>"))
    sets = stored(sets.join(items, "row", "left").select(
        F.when(F.col("bad"), F.concat(found, F.array(F.lit(BAD)))).otherwise(found).alias("items")), "url-items")
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(sets)
    rules = model.associationRules.filter(F.array_contains("consequent", BAD)).select(
        F.array_sort("antecedent").alias("antecedent"), "confidence", "lift", "support")
    rules = stored(rules.withColumn("rule_id", F.xxhash64("antecedent")), "url-rules")
    # A rule whose tokens hold those of another adds nothing: what it blocks is blocked.
    each = rules.select("rule_id", F.col("antecedent").alias("inner"), F.explode("antecedent").alias("token"))
    first = each.groupBy("rule_id").agg(F.min("token").alias("token"), F.first("inner").alias("inner"))
    wider = rules.select(F.col("rule_id").alias("outer_id"), F.col("antecedent").alias("outer"), F.explode("antecedent").alias("token"))
    covered = wider.join(first, "token").filter(
        (F.size("outer") > F.size("inner")) & (F.size(F.array_except("inner", "outer")) == 0)).select(F.col("outer_id").alias("rule_id"))
    return rules.join(covered.distinct(), "rule_id", "left_anti")


def blocked(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The `url`s among rows of (url, tokens) that a rule matches, through an index of the rules by token."""
    often = rules.select("rule_id", "antecedent", F.explode("antecedent").alias("token"))
    tokens_in_use = often.select("token").distinct()
    held = urls.select(F.explode("tokens").alias("token")).join(tokens_in_use, "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct("n", "token"))["token"].alias("token")
    # A rule with a token that no URL has matches none.
    index = often.join(held, "token").groupBy("rule_id").agg(rarest, F.first("antecedent").alias("antecedent"))
    hits = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    return hits.filter(F.size(F.array_except("antecedent", "tokens")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", label_key: str = "doc_id",
          **limits) -> DataFrame:
    """Every page with `host`, `path`, `rule` (its curated rule, else null) and `verdict` (allow or block).

    `rules` are few (verdict, host, path); the longest that fits wins, of equally long ones the one of the longer host. A label
    belongs to the page whose key it has.
    """
    known = labels.select(F.col(label_key).alias(key), (F.coalesce(F.col("quality") == 0, F.lit(False))
                                                        | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    full = parsed(pages.drop("host", "path", "rule", "verdict", "matched"))
    labelled = full.select(key, "url", "host", "path").join(known, key).select(tokens().alias("tokens"), "bad")
    mined = mine(labelled, **limits)
    # Equal URLs are looked up once; the hot ones are combined before they are shuffled.
    urls = full.filter("host <> ''").select("url", "host", "path").distinct().withColumn("tokens", tokens())
    bad = blocked(urls, mined).withColumn("matched", F.lit(True))
    rule = verdict = F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    method = F.when(F.col("matched"), F.lit("block")).otherwise(F.lit("allow"))
    return (full.join(bad, "url", "left").withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(verdict, method)).drop("matched"))
