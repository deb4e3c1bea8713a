"""URL filters with DataFrame and SQL functions only (operator 9).

Rules (host and path prefixes) decide where one fits; every other url is judged by a logistic
regression on hashed character n-grams of host and path, trained from a small labelled table.
Training is batch gradient descent as DataFrame operations: each step joins the feature rows
with the current weights and sums gradients a bucket. The labelled table is bounded by
``MAX_TRAINING`` rows and weights by ``BUCKETS``, so what reaches the driver has a fixed size.

Edge cases: null urls and urls without ``://`` have empty host and path, match no rule and are
judged by the intercept alone; urls of any length are read whole; repeated rows stay; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

BUCKETS = 1 << 14
GRAM = 4
STEPS = 20
RATE = 8.0
DECAY = 1e-3
MAX_TRAINING = 10_000

#: Words of a small labelled table, from common knowledge of what sites and blocklists are called.
GOOD_WORDS = (
    "news", "library", "docs", "garden", "recipes", "history", "science", "school", "weather", "museum", "theatre", "travel", "music", "maps", "sport",
    "books", "health", "city", "park", "art", "study", "open", "film", "data", "wiki", "forum", "code", "press", "university", "hospital",
)
BAD_WORDS = (
    "casino", "poker", "bets", "lottery", "prize", "porn", "adult", "escort", "pills", "viagra",
    "cheap", "replica", "loan", "payday", "spam", "phish", "malware", "warez", "tracker", "popup",
)
ENDS = ("example.com", "example.net", "example.org")
SUBDOMAINS = ("", "www.", "m.", "blog.")
PATHS = ("/en/12", "/de/345.html", "/fr/56/", "/es/789", "/en/archive/2020/78", "")


def labelled(step: int, joint: str) -> list[tuple[str, int]]:
    """(url, bad): each word joined with the one ``step`` places on. Ends, subdomains and paths are dealt alike to good and bad."""
    rows = []
    for bad, words in enumerate((GOOD_WORDS, BAD_WORDS)):
        for i, word in enumerate(words):
            name = word + joint + words[(i + step) % len(words)]
            rows += [(f"https://{SUBDOMAINS[(i + j) % 4]}{name}.{end}{PATHS[(i + 2 * j) % 6]}", bad) for j, end in enumerate(ENDS)]
    return rows


def training_table(spark: SparkSession) -> DataFrame:
    """url, bad: 300 rows of names with and without a hyphen. Other steps are held out for measuring."""
    rows = labelled(1, "-") + labelled(2, "")
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {bad})" for u, bad in rows) + " AS t(url, bad)")


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower())
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def buckets_of(host: Column, path: Column, buckets: int = BUCKETS, gram: int = GRAM) -> Column:
    """Array of hashed character n-grams: host between ^ and $, path after a mark of its own, and bucket 0 as intercept.

    Distinct buckets, so a long path can't outweigh a host by repetition.
    """

    def of(s: Column, seed: int) -> Column:
        last = F.length(s) - gram + 1
        return F.when(last < 1, F.array().cast("array<int>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: (F.pmod(F.xxhash64(F.substring(s, i, F.lit(gram)), F.lit(seed)), F.lit(buckets - 1)) + 1).cast("int")))

    marked = F.when(host == "", "").otherwise(F.concat(F.lit("^"), host, F.lit("$")))
    return F.array_distinct(F.concat(F.array(F.lit(0)), of(marked, 1), of(path, 2)))


def probability(x: Column, weights: list[float]) -> Column:
    """The model's probability that a url with buckets ``x`` is bad. The weights are one folded array literal."""
    w = F.from_json(F.lit("[" + ",".join(map(repr, weights)) + "]"), "array<double>")
    z = F.aggregate(x, F.lit(0.0), lambda a, b: a + F.get(w, b)) / F.sqrt(F.size(x))
    return 1 / (1 + F.exp(-z))


def train(labelled: DataFrame, buckets: int = BUCKETS, steps: int = STEPS, rate: float = RATE) -> list[float]:
    """Weights by bucket from (url, bad) rows. Each step is one aggregate over the feature rows."""
    n = labelled.limit(MAX_TRAINING + 1).count()
    if n > MAX_TRAINING:
        raise ValueError(f"the labelled table has more than {MAX_TRAINING} rows")
    weights = [0.0] * buckets
    if not n:
        return weights
    host, path = parts(F.col("url"))
    x = labelled.select(F.col("bad").cast("double").alias("y"), buckets_of(host, path, buckets).alias("x")).coalesce(1).cache()
    for _ in range(steps):
        error = x.select("x", (F.col("y") - probability(F.col("x"), weights)).alias("e"))
        slope = error.select(F.explode("x").alias("b"), (F.col("e") / F.sqrt(F.size("x"))).alias("g")).groupBy("b").agg(F.sum("g").alias("g"))
        for r in slope.collect():  # at most one row a bucket
            weights[r.b] += rate * (r.g / n * 10 - DECAY * weights[r.b])
    x.unpersist()
    return weights


def judge(pages: DataFrame, weights: list[float], rules=RULES) -> DataFrame:
    """page_id, host, path, rule, score (the model's probability that the url is bad), verdict."""
    host, path = parts(F.col("url"))
    cut = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    x = buckets_of(F.col("host"), F.col("path"), len(weights))
    score = probability(x, weights)
    return cut.select("page_id", "host", "path", rule.alias("rule"), score.alias("score"), F.coalesce(verdict, F.when(score > 0.5, "block").otherwise("allow")).alias("verdict"))
