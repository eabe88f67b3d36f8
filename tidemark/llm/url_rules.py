"""URL filter: fixed host and path rules, then association rules mined from labelled urls.

FP-growth finds combinations of url tokens that go with a label; rules that are frequent,
confident and better than every more general rule are kept. An inverted index lists each
rule under its rarest token, so a url only meets rules that share that token with it.
DataFrame and MLlib functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import checkpointed

# Fixed by the contract: rules as host and path, and their verdicts.
FIXED_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.9
# How much more likely than in general a rule's label has to be.
MIN_LIFT = 1.05
# A token that a larger share of the labelled urls holds tells nothing and is not mined.
COMMON = 0.98
# Rules that are sent to every executor; more are joined by shuffle.
BROADCAST_RULES = 50_000
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts() -> tuple[Column, Column]:
    """Host and path of ``url``: both empty without ``://``; A-Z are lower-cased, in the host only."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fixed_rule(rules: dict[str, str] = FIXED_RULES) -> Column:
    """The longest rule that fits ``host`` and ``path``, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        host, path = rule.split("/", 1)
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def tokens() -> Column:
    """Distinct tokens of ``url, host, path``: scheme, host, its endings, path parts, query names.

    Numbers are alike; a token says where it stands.
    """
    labels = F.split("host", r"\.")
    endings = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.concat(F.lit("host:"), F.array_join(F.slice(labels, k, F.size(labels)), ".")),
    )
    parts = F.transform(F.split(F.regexp_replace("path", "[0-9]+", "0"), "/"), lambda p: F.concat(F.lit("path:"), p))
    names = F.transform(F.expr(r"regexp_extract_all(url, '[?&]([^=&#]+)', 1)"), lambda q: F.concat(F.lit("query:"), q))
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract("url", r"^([^:/?#]*):", 1))))
    every = F.array_distinct(F.concat(scheme, endings, parts, names))
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(every)


def _prepared(pages: DataFrame) -> DataFrame:
    host, path = url_parts()
    return pages.withColumn("host", host).withColumn("path", path)


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules ``antecedent, key, verdict, confidence, support`` from rows of ``tokens, verdict``.

    A rule is dropped when leaving out one of its tokens gives a rule of the same verdict that
    is as confident. ``key`` is its rarest token.
    """
    n = labelled.count()
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "antecedent array<string>, key string, verdict string, confidence double, support double")
    if not n:
        return empty
    often = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    # At most (tokens a url) / min_support tokens are frequent; the common ones are fewer than that.
    useful = often.filter((F.col("n") >= min_support * n) & (F.col("n") <= COMMON * n))
    # A scalar subquery instead of a join: rows need no number of their own, and nothing is shuffled.
    wanted = useful.agg(F.collect_list("token")).scalar()
    kept = labelled.select(F.concat(F.array_intersect("tokens", wanted), F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(kept)
    found = model.associationRules.filter(F.col("consequent")[0].startswith("=") & (F.col("lift") >= min_lift))
    found = found.select(
        F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], 2, 99).alias("verdict"), "confidence", "support"
    ).filter(~F.exists("antecedent", lambda x: x.startswith("=")))
    found = checkpointed(found)
    shorter = found.select(
        "antecedent", "verdict", "confidence",
        F.explode(F.transform("antecedent", lambda x: F.array_except("antecedent", F.array(x)))).alias("general"),
    )
    general = found.select(F.col("antecedent").alias("general"), "verdict", F.col("confidence").alias("before"))
    useless = shorter.join(general, ["general", "verdict"]).filter(F.col("before") >= F.col("confidence")).select("antecedent", "verdict")
    kept_rules = found.join(useless.distinct(), ["antecedent", "verdict"], "left_anti")
    rarest = (
        kept_rules.select("antecedent", "verdict", F.explode("antecedent").alias("token"))
        .join(useful, "token")
        .groupBy("antecedent", "verdict")
        .agg(F.min(F.struct("n", "token"))["token"].alias("key"))
    )
    return checkpointed(kept_rules.join(rarest, ["antecedent", "verdict"]).select("antecedent", "key", "verdict", "confidence", "support"))


def matched(urls: DataFrame, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``url`` and its best rule, for rows of distinct ``url, tokens``; a url without one is left out.

    The most confident rule wins, then the better supported, the longer, and block before allow.
    """
    index = F.broadcast(rules) if rules.count() <= broadcast_rules else rules
    pairs = urls.select("url", "tokens", F.explode("tokens").alias("key")).join(index, "key")
    holds = pairs.filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    rank = F.struct("confidence", "support", F.size("antecedent").alias("size"), "verdict", F.array_join("antecedent", " ").alias("mined_rule"))
    return holds.groupBy("url").agg(F.max(rank).alias("best"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: dict[str, str] = FIXED_RULES, default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, fixed rule, verdict, the mined rule that fits best.

    ``labels`` (page_id, verdict) may repeat and conflict: all count. Fixed rules decide first,
    then mined ones, else ``default``. A null url or one without ``://`` has empty host and
    path and gets the default. Repeated rows give a row each; other columns are ignored.
    """
    known = _prepared(pages.select("page_id", "url")).select("page_id", "url", "host", "path")
    marked = labels.filter(F.col("page_id").isNotNull() & F.col("verdict").isin("allow", "block")).select("page_id", "verdict")
    mined = mine(known.filter(F.col("host") != "").join(marked, "page_id").select(tokens().alias("tokens"), "verdict"))
    distinct = _prepared(pages.select("url").filter(F.col("url").isNotNull()).distinct()).select("url", tokens().alias("tokens"))
    best = matched(distinct, mined)
    fixed = reduce(lambda out, r: out.when(F.col("rule") == r, F.lit(rules[r])), rules, F.when(F.lit(False), F.lit("")))
    return (
        known.join(best, "url", "left")
        .withColumn("rule", fixed_rule(rules))
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce(fixed, F.col("best.verdict"), F.lit(default)).alias("verdict"),
            F.col("best.mined_rule").alias("mined_rule"), F.col("best.confidence").alias("confidence"),
        )
    )
