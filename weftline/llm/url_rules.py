"""URL filtering by mined association rules.

Given rules (host suffix and path prefix, block or allow) decide the URLs that they
fit. Those decisions are the labels: every decided URL becomes a basket of its tokens
and its verdict, Spark's FP-growth finds the frequent token sets over all of them,
and rules "tokens -> verdict" with enough support and confidence are kept. They judge
the URLs that no given rule fits. Rules match through an inverted index: a rule is
filed under its rarest token, a URL looks up its tokens and keeps the rules whose
tokens it has. The rule of the highest confidence, then support, then fewest tokens
wins; without a match the verdict is allow.

A third of all URLs may share a host: baskets are counted by FP-growth's own groups,
and rules are broadcast once their count is known to be small, else AQE splits the
hot token of the join. Null URLs, and those without ``://``, have an empty host and
path and no host or path tokens; they are judged by what tokens remain, that is
allowed. Repeated rows and repeated ids are judged one by one. An empty table, or one
in which no URL is labelled, mines no rules. Other columns play no part.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import broadcast_if_few, saved

#: The given rules, (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
MAX_TOKENS = 3
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``; only A-Z are lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Scheme, host labels, path segments and query names; digits count as one token.

    A token starts with the part it is from, so equal words of two parts differ.
    """
    def tagged(tag: str, words: Column) -> Column:
        plain = F.transform(words, lambda w: F.regexp_replace(w, "[0-9]+", "#"))
        return F.transform(F.filter(plain, lambda w: w != ""), lambda w: F.concat(F.lit(tag), w))

    whole = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(whole, r"(?s)\A[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    scheme = F.regexp_extract(whole, r"\A([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    fragment = F.when(F.contains(whole, F.lit("#")), F.lit("#")).otherwise(F.lit(""))
    return F.array_distinct(F.concat(
        tagged("scheme:", F.array(F.lower(scheme))),
        tagged("host:", F.split(host, r"\.")),
        tagged("path:", F.split(path, "[/.]")),
        tagged("query:", names),
        tagged("end:", F.array(fragment)),
    ))


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for domain, prefix, what in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(
            path, F.lit(prefix)
        )
        name = F.when(fits, F.lit(domain + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """(tokens, verdict) rows to rules (antecedent, verdict, confidence, support).

    A rule is dropped if a rule on fewer of its tokens has the same verdict and at
    least its confidence: it would add nothing.
    """
    spark = labelled.sparkSession
    baskets = labelled.select(
        F.array_append("tokens", F.concat(F.lit("verdict:"), "verdict")).alias("items")
    )
    if baskets.limit(1).count() == 0:
        return spark.createDataFrame(
            [], "antecedent array<string>, verdict string, confidence double, support double"
        )
    model = FPGrowth(
        itemsCol="items", minSupport=min_support, minConfidence=min_confidence
    ).fit(baskets)
    found = model.associationRules.where(
        F.startswith(F.element_at("consequent", 1), F.lit("verdict:"))
        & ~F.exists("antecedent", lambda t: F.startswith(t, F.lit("verdict:")))
        & (F.size("antecedent") <= max_tokens)
    ).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(F.element_at("consequent", 1), len("verdict:") + 1, 100).alias("verdict"),
        "confidence",
        "support",
    )
    rules = saved(found)
    return saved(_without_longer_equals(rules))


def _without_longer_equals(rules: DataFrame) -> DataFrame:
    """Equi-joined on the antecedents with one token, or two, taken out."""
    shorter = rules.select(
        F.col("antecedent").alias("s_antecedent"),
        F.col("verdict").alias("s_verdict"),
        F.col("confidence").alias("s_confidence"),
    )
    singles = F.transform("antecedent", lambda t: F.array(t))
    pairs = F.transform("antecedent", lambda t: F.array_remove("antecedent", t))
    parts = rules.where(F.size("antecedent") > 1).select(
        "antecedent", "verdict", "confidence",
        F.explode(F.array_distinct(F.concat(singles, pairs))).alias("s_antecedent"),
    )
    beaten = parts.join(
        shorter.withColumnRenamed("s_verdict", "other"), "s_antecedent"
    ).where((F.col("verdict") == F.col("other")) & (F.col("s_confidence") >= F.col("confidence")))
    return rules.join(
        beaten.select("antecedent", "verdict").distinct(), ["antecedent", "verdict"], "left_anti"
    )


def _indexed(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """Each rule under its token of fewest labelled URLs."""
    frequency = labelled.select(F.explode("tokens").alias("token")).groupBy("token").count()
    filed = rules.select("*", F.explode("antecedent").alias("token")).join(frequency, "token")
    by = ["antecedent", "verdict", "confidence", "support"]
    return filed.groupBy(*by).agg(F.min_by("token", F.struct("count", "token")).alias("token"))


def judge(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules=RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the mined ``reason`` where one decides."""
    parts = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        host(F.col(url)).alias("host"),
        path(F.col(url)).alias("path"),
    )
    name, verdict = given_rule(F.col("host"), F.col("path"), rules)
    urls = parts.select(
        "page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"),
        tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"),
    )
    labelled = urls.where("rule is not null").select("tokens", "verdict")
    mined = mine_rules(labelled, min_support, min_confidence)
    index = broadcast_if_few(_indexed(mined, labelled).select(
        F.col("token").alias("r_token"),
        F.col("antecedent").alias("r_tokens"),
        F.struct(
            "confidence", "support", (-F.size("antecedent")).alias("short"),
            F.col("verdict").alias("verdict"),
            F.concat_ws(" ", F.array_sort("antecedent")).alias("reason"),
        ).alias("found"),
    ))
    # A URL without a given rule is judged once per distinct (host, path, tokens).
    open_urls = urls.where("rule is null").select("tokens").distinct()
    matched = (
        open_urls.select("tokens", F.explode("tokens").alias("token"))
        .join(index, F.col("token") == F.col("r_token"))
        .where(F.size(F.array_except("r_tokens", "tokens")) == 0)
        .groupBy("tokens")
        .agg(F.max("found").alias("found"))
        .select(F.col("tokens").alias("m_tokens"), "found")
    )
    matched = broadcast_if_few(saved(matched))
    judged = urls.join(
        matched, urls["rule"].isNull() & (urls["tokens"] == matched["m_tokens"]), "left"
    )
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce(urls["verdict"], "found.verdict", F.lit("allow")).alias("verdict"),
        F.col("found.reason").alias("reason"),
    )
