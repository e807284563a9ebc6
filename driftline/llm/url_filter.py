"""Operator 9: URL filters with Spark expressions: rules by host and path, else logistic regression.

The model sees hashed character n-grams of host and path and is trained from a small labelled URL table.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

from driftline.llm.common import constant

#: Fixed values: (host, path prefix, verdict).
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)
#: Words of addresses that advertise, gamble or sell what is unwanted, and of ordinary ones, for the labelled table.
BAD = "casino poker betting slots jackpot roulette blackjack lottery sweepstakes viagra pills pharmacy payday loans porn xxx adult escort adserver banner popup clickbait warez replica giveaway".split()
GOOD = "news blog docs library school museum weather recipes travel history science garden music forum wiki sports culture politics economy research university hospital council theatre cinema books poetry maps archive journal magazine letters photos gallery tutorial manual reference support contact team careers events calendar community help".split()
BUCKETS, SIZES = 1 << 14, (3, 4)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for a null url or one without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host + path, its verdict) of the longest rule that fits; null where none does."""
    best = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = lambda h, p: ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
    rule = verdict = None
    for h, p, v in best:
        rule = F.when(fits(h, p), h + p) if rule is None else rule.when(fits(h, p), h + p)
        verdict = F.when(fits(h, p), v) if verdict is None else verdict.when(fits(h, p), v)
    return (rule, verdict) if best else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of ^host$ and of the path."""
    s = F.concat(F.lit("^"), host, F.lit("$"), path)
    each = [F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i, n=n: F.substr(s, i, F.lit(n))) for n in SIZES]
    return F.concat(*each)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label (1 to block). Each word stands in hosts and in paths, among neutral parts."""
    forms = ("https://{w}.site.com/a/{k}", "http://www.my{w}.net/en/{k}", "https://page{k}.org/{w}/index.html", "https://m.home.info/list/{k}/{w}")
    rows = [(form.format(w=w, k=k), label) for label, ws in ((1, BAD), (0, GOOD)) for k, w in enumerate(ws) for form in forms]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {y})" for u, y in rows) + " AS t(url, label)")


def buckets(host: Column, path: Column) -> Column:
    """The distinct hash buckets of a URL's n-grams."""
    return F.array_distinct(F.transform(grams(host, path), lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int")))


def train(labelled: DataFrame) -> tuple[list[float], float]:
    """Weights of the hashed n-grams and the intercept; labelled is small: url, label."""
    rows = labelled.select(buckets(host_of(F.col("url")), path_of(F.col("url"))).alias("on"), F.col("label").cast("double").alias("label"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda k: F.array_contains("on", k).cast("double"))
    model = LogisticRegression(regParam=0.01, maxIter=60).fit(rows.select(array_to_vector(dense).alias("features"), "label").coalesce(1))
    return [float(w) for w in model.coefficients.toArray()], float(model.intercept)


def judge(pages: DataFrame, labelled: DataFrame, url: str = "url", threshold: float = 0.5, rules=RULES) -> DataFrame:
    """pages with host, path, rule, verdict (allow or block) and p_block.

    The longest rule that fits decides, else whether p_block reaches the threshold. A null url, or one without
    ://, has an empty host and path and is allowed; one with an empty host and a path is judged by the path. Repeated rows are judged each; existing columns of these
    names are replaced; no shuffle of pages.
    """
    weights, intercept = train(labelled)
    table, h, p = constant(weights, "double"), F.col("host"), F.col("path")
    rule, verdict = rule_of(h, p, rules)
    score = F.aggregate(buckets(h, p), F.lit(intercept), lambda a, k: a + F.get(table, k))
    prob = F.when((h == "") & (p == ""), 0.0).otherwise(1 / (1 + F.exp(-score)))
    split = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    return split.withColumn("rule", rule).withColumn("p_block", prob).withColumn("verdict", F.coalesce(verdict, F.when(F.col("p_block") >= threshold, "block").otherwise("allow")))
