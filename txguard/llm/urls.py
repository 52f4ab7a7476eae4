"""URL filter: listed rules first, then association rules mined from labels.

A URL's tokens are the labels of its host (`h:`), the segments of its path (`p:`, numbers as `#`, endings apart as `e:`),
and the names of its parameters (`q:`). FP-growth finds the token combinations of at least SUPPORT of the
toxic URLs, and no fewer than LEAST of them; those that hold at least CONFIDENCE toxic ones among all labelled URLs
with that combination become rules to block. A combination is looked up by its rarest token.
Tokens that occur in exactly the same labelled URLs are one item, as a combination with some of them says what one with all of
them says: a template of any length is a single item. Items that are rules by themselves are not combined, and rules
that hold another rule are left out, as they block nothing more. What is left to combine are tokens that vary independently.
An item is named by the first of its tokens; a URL with any of them has it.

A null URL, or one without `://`, has an empty host and path and no tokens, and is allowed. Rows are judged one by one;
repeated labels of one id count as one, toxic if one is; with fewer than LEAST toxic URLs there are no mined rules. Equally rare
items of a rule are looked up by the first. Very long URLs have as many tokens as they have parts. Empty tables
give no rows. Only page_id, url, doc_id and toxic are read, so other columns may have any name.
"""

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.plans.workspace import stored

SUPPORT, LEAST, CONFIDENCE = 0.01, 20, 0.8

# fixed values: verdict, host and path of the listed rules
LISTED = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _rest(url: Column) -> Column:
    """What follows the first ://, null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    names = F.transform(segments, lambda s: F.regexp_replace(F.regexp_replace(s, r"\.[A-Za-z]+$", ""), "[0-9]+", "#"))
    endings = F.filter(F.transform(segments, lambda s: F.regexp_extract(s, r"(\.[A-Za-z]+)$", 1)), lambda s: s != "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda s: s != ""), lambda s: F.regexp_extract(s, "^[^=]*", 0))
    hosts = F.filter(F.split(host_of(url), r"\."), lambda s: s != "")
    parts = [(hosts, "h:"), (names, "p:"), (endings, "e:"), (keys, "q:")]
    every = F.concat(*[F.transform(c, lambda s, m=m: F.concat(F.lit(m), s)) for c, m in parts])
    return F.coalesce(F.array_sort(F.array_distinct(every)), F.array().cast("array<string>"))


def listed_rule(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """The longest listed rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, own, start in sorted(rules or LISTED, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule, verdict = F.when(fits, own + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, rule) where all items of a rule are among the tokens. sets: id, tokens; rules: rule, items, key."""
    every = sets.select("id", "tokens", F.explode("tokens").alias("key"))
    return every.join(rules, "key").where(F.size(F.array_except("items", "tokens")) == 0).select("id", "rule")


def _items(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """id, tokens: the items of the sets' tokens, sorted; tokens without an item do not count. sets: id, tokens."""
    found = sets.select("id", F.explode("tokens").alias("token")).join(classes, "token")
    return found.groupBy("id").agg(F.array_sort(F.collect_set("item")).alias("tokens"))


def _named(found: DataFrame) -> DataFrame:
    return found.withColumn("items", F.array_sort("items")).withColumn("rule", F.array_join("items", " "))


def mine(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules (rule, items, key, toxic, confidence) from URLs (tokens, bad), and the items of tokens (token, item)."""
    spark = labelled.sparkSession
    sets = labelled.groupBy("tokens").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("int")).alias("toxic"))
    sets = stored(sets.withColumn("id", F.xxhash64(F.to_json("tokens"))).where(F.size("tokens") > 0), "url-sets")
    toxic = sets.agg(F.sum("toxic")).first()[0] or 0
    if toxic < LEAST:
        empty = "rule string, items array<string>, key string, toxic bigint, confidence double"
        return spark.createDataFrame([], empty), spark.createDataFrame([], "token string, item string")
    least = max(SUPPORT * toxic, LEAST)

    whose = F.struct(F.bit_xor("id"), F.sum(F.col("id").cast("decimal(20,0)")), F.count("*"))
    counted = sets.select(F.explode("tokens").alias("token"), "id", "n", "toxic").groupBy("token").agg(
        whose.alias("sets"), F.sum("n").alias("often"), F.sum("toxic").alias("toxic")
    )
    counted = stored(counted.where(F.col("toxic") >= least), "url-tokens")
    alike = counted.groupBy("sets").agg(F.min("token").alias("item"))
    classes = stored(counted.join(alike, "sets").select("token", "item"), "url-classes")
    single = counted.join(alike, F.col("token") == F.col("item")).select(
        "item", "often", "toxic", (F.col("toxic") / F.col("often")).alias("confidence")
    )
    alone = single.where(F.col("confidence") >= CONFIDENCE)
    rules = _named(alone.select(F.array("item").alias("items"), F.col("item").alias("key"), "toxic", "confidence"))

    rest = classes.join(alone, "item", "left_anti")
    numbers = stored(_items(sets, rest).join(sets.select("id", "n", "toxic"), "id"), "url-items")
    baskets = numbers.where("toxic > 0").select(F.explode(F.array_repeat("tokens", F.col("toxic").cast("int"))).alias("items"))
    n = baskets.count()
    if n >= least:
        model = FPGrowth(itemsCol="items", minSupport=(math.ceil(least) - 0.5) / n).fit(baskets)
        found = _named(model.freqItemsets.where(F.size("items") > 1).select("items"))
        keys = found.select("rule", F.explode("items").alias("item")).join(single, "item")
        keys = keys.groupBy("rule").agg(F.min(F.struct("often", "item"))["item"].alias("key"))
        found = stored(found.join(keys, "rule"), "url-combinations")
        counts = matches(numbers, found).join(numbers.select("id", "n", "toxic"), "id")
        counts = counts.groupBy("rule").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
        counts = counts.select("rule", "toxic", (F.col("toxic") / F.col("n")).alias("confidence"))
        sure = stored(found.join(counts.where(F.col("confidence") >= CONFIDENCE), "rule"), "url-sure")
        within = matches(sure.select(F.col("rule").alias("id"), F.col("items").alias("tokens")), sure).where("id <> rule")
        rules = rules.unionByName(sure.join(within.select(F.col("id").alias("rule")), "rule", "left_anti"))
    return stored(rules, "url-rules"), classes


def judged(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, mined (the rule that blocked it, if a mined one did) of each row of `pages`.

    labels: doc_id (a page's id) and toxic.
    """
    bad = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("bad"))
    rows = pages.select("page_id", "url")
    labelled = rows.join(bad, rows["page_id"] == bad["doc_id"]).select(tokens_of(F.col("url")).alias("tokens"), "bad")
    rules, classes = mine(labelled)
    sets = rows.select(tokens_of(F.col("url")).alias("tokens")).distinct()
    sets = sets.withColumn("id", F.to_json("tokens"))
    blocked = matches(_items(sets, classes), rules).groupBy("id").agg(F.min("rule").alias("mined"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"))
    out = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                      F.to_json(tokens_of(F.col("url"))).alias("id"))
    out = out.join(blocked, "id", "left").withColumn("rule", rule).withColumn("listed", verdict)
    by_method = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("listed", by_method).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("mined")).alias("mined"),
    )
