"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

Made of DataFrame functions only. A small labelled table of URLs is turned into hashed n-gram features once; training is
full-batch gradient descent in which Spark computes margins and sums the gradient per bucket, and the driver holds
nothing but the weights, a vector of BUCKETS numbers whatever the data. Scoring adds the weights of a URL's n-grams in
place, without a join or a shuffle.

Defined results: a null URL, or one without ://, has an empty host and path; no rule fits it and the model judges it by
its bias. Hosts are lower-cased in A-Z only. Rules compare whole labels, so org does not fit myorg. If the labelled
table is empty or holds one verdict only, the model gives that verdict, or allow. Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.store import ascii_lower, materialize

BUCKETS = 4096
SIZES = (3, 4)
#: Training rows taken of each verdict at most.
LABELLED_PER_VERDICT = 3000
ROUNDS = 12
RATE = 0.5
RIDGE = 1e-4


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as a struct of its name and verdict; null if none does."""
    fitting = F.lit(None)
    for rule in sorted(rules, key=lambda rule: len(rule.name)):
        on_host = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
        chosen = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        fitting = F.when(on_host & F.startswith(path, F.lit(rule.path)), chosen).otherwise(fitting)
    return fitting


def grams(text: Column, field: str, size: int) -> Column:
    """Buckets of the n-grams of a text between boundary marks; none if it is shorter."""
    marked = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    places = F.when(F.length(marked) >= size, F.sequence(F.lit(1), F.length(marked) - size + 1))
    hashed = F.transform(
        places, lambda at: F.pmod(F.xxhash64(F.lit(f"{field}{size}"), F.substring(marked, at, F.lit(size))), F.lit(BUCKETS))
    )
    return F.coalesce(hashed, F.array().cast("array<bigint>"))


def features(host: Column, path: Column) -> Column:
    """The distinct buckets of a URL; empty fields have none."""
    parts = [F.when(text != "", grams(text, field, n)).otherwise(F.array().cast("array<bigint>"))
             for field, text in (("host", host), ("path", path)) for n in SIZES]
    return F.array_distinct(F.concat(*parts)).cast("array<int>")


@dataclass(frozen=True)
class UrlModel:
    weights: tuple[float, ...]
    bias: float

    def block_probability(self, buckets: Column) -> Column:
        table = F.expr(f"array({', '.join(f'{w!r}D' for w in self.weights)})")
        total = F.aggregate(buckets, F.lit(0.0), lambda sum_, at: sum_ + F.get(table, at))
        norm = F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double"))
        return 1 / (1 + F.exp(-(total / norm + self.bias)))


def train(labelled: DataFrame, per_verdict: int = LABELLED_PER_VERDICT, rounds: int = ROUNDS) -> UrlModel:
    """Fit on at most so many rows (url, verdict) of each verdict, the first by hash, so that copies add nothing."""
    urls = labelled.select("url", "verdict").filter("url is not null").distinct()
    chosen = None
    for verdict in ("allow", "block"):
        part = urls.filter(F.col("verdict") == verdict).orderBy(F.xxhash64("url"), "url").limit(per_verdict)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = materialize(
        chosen.select(
            features(host_of(F.col("url")), path_of(F.col("url"))).alias("buckets"),
            (F.col("verdict") == "block").cast("double").alias("target"),
        ).withColumn("norm", F.sqrt(F.greatest(F.size("buckets"), F.lit(1)).cast("double")))
    )
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    weights, bias = [0.0] * BUCKETS, 0.0
    if positive in (0.0, float(n)):
        return UrlModel(tuple(weights), math.inf if n and positive else -math.inf)
    squares, bias_square = [0.0] * BUCKETS, 0.0
    weight_of = (0.5 * n / positive, 0.5 * n / (n - positive))  # both verdicts count alike
    balance = F.when(F.col("target") == 1, weight_of[0]).otherwise(weight_of[1])
    for _ in range(rounds):
        model = UrlModel(tuple(weights), bias)
        slope = (model.block_probability(F.col("buckets")) - F.col("target")) * balance
        errors = rows.select("buckets", "norm", slope.alias("slope"))
        # Bucket -1 stands for the bias; sums are rounded, so their order cannot change the model.
        bucket = F.explode(F.concat(F.array(F.lit(-1)), F.col("buckets")))
        slopes = errors.select(bucket.alias("bucket"), "slope", "norm")
        share = F.when(F.col("bucket") < 0, F.col("slope")).otherwise(F.col("slope") / F.col("norm"))
        for at, sum_ in slopes.groupBy("bucket").agg(F.round(F.sum(share), 7)).collect():
            if at < 0:
                bias_square += (sum_ / n) ** 2
                bias -= RATE * (sum_ / n) / math.sqrt(bias_square + 1e-12)
            else:
                slope_at = sum_ / n + RIDGE * weights[at]
                squares[at] += slope_at**2
                weights[at] -= RATE * slope_at / math.sqrt(squares[at] + 1e-12)
    return UrlModel(tuple(round(w, 6) for w in weights), round(bias, 6))


def with_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, url, host, path, fit: the rule that decides, if any."""
    parsed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parsed.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))


def labelled_by_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The labelled table at hand: URLs a rule decides, with its verdict."""
    return with_rules(pages, rules).filter("fit is not null").select("url", F.col("fit.verdict").alias("verdict"))


def judge(pages: DataFrame, model: UrlModel, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability of every row."""
    ruled = with_rules(pages, rules)
    if math.isinf(model.bias):
        probability = F.lit(1.0 if model.bias > 0 else 0.0)
    else:
        probability = F.round(model.block_probability(features(F.col("host"), F.col("path"))), 6)
    scored = ruled.withColumn("block_probability", probability)
    learned = F.when(F.col("block_probability") > 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", learned).alias("verdict"), "block_probability",
    )
