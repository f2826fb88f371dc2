"""URL filters: host and path rules, and gradient-boosted trees on lexical features for urls that no rule decides."""

from __future__ import annotations

import json

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import kept_table

#: Fixed rules: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
SAMPLE = 20_000
"""The trees are trained on so many labelled urls at most, taken by their hash."""
SUFFIXES = 1024
"""Host suffixes are counted in so many hash buckets, so that their statistics are of bounded size."""
TREES = 20
DEPTH = 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "fragment", "hyphens", "suffix_rate", "suffix_weight", "domain_rate", "domain_weight")


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased. Null or without ``://``: empty."""
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """``(rule, verdict)`` of the longest rule that fits: its host or a subdomain of it, and a path that starts with the rule's. Null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1:])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _bucket(host: Column, labels: int) -> Column:
    """Bucket of the last labels of a host."""
    return F.pmod(F.xxhash64(F.lit(labels), F.substring_index(host, ".", -labels)), F.lit(SUFFIXES)).cast("int")


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that the url's text gives."""
    text = F.coalesce(url, F.lit(""))
    size = F.length(text)
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(c == "", 0.0).otherwise((size - F.length(F.replace(text, c, F.lit("")))) / size))
    entropy = F.aggregate(share, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    count = lambda column, sign: F.length(column) - F.length(F.replace(column, F.lit(sign), F.lit("")))
    return {
        "length": size,
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": count(path, "/"),
        "labels": count(host, ".") + 1,
        "digit_ratio": F.when(size > 0, F.length(F.regexp_replace(text, "[^0-9]", "")) / size).otherwise(0.0),
        "entropy": F.when(size > 0, entropy).otherwise(0.0),
        "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "fragment": F.contains(text, F.lit("#")).cast("int"),
        "hyphens": count(text, "-"),
    }


def parsed(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """``page_id, url, host, path, rule, decided``: every url with the rule that decides it, or nulls."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    base = base.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    return base.select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("decided"))


def suffix_statistics(labelled: DataFrame) -> dict[int, tuple[list[float], list[float]]]:
    """For suffixes of one and two labels: smoothed share of blocked urls and log count of each bucket, over all labelled urls.

    At most 2 x SUFFIXES rows reach the driver.
    """
    sides = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), _bucket(F.col("host"), k).alias("b")) for k in (1, 2)))).alias("s")
    counted = labelled.select(sides, (F.col("decided") == "block").cast("long").alias("bad")).groupBy("s.k", "s.b").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    out = {k: ([0.5] * SUFFIXES, [0.0] * SUFFIXES) for k in (1, 2)}
    for r in counted.withColumn("rate", (F.col("bad") + 1.0) / (F.col("n") + 2.0)).withColumn("weight", F.log1p("n")).collect():
        out[r["k"]][0][r["b"]], out[r["k"]][1][r["b"]] = r["rate"], r["weight"]
    return out


def _with_features(urls: DataFrame, statistics: dict[int, tuple[list[float], list[float]]]) -> DataFrame:
    columns = lexical(F.col("url"), F.col("host"), F.col("path"))
    for k, name in ((1, "suffix"), (2, "domain")):
        for values, part in zip(statistics[k], ("rate", "weight"), strict=True):
            table = F.from_json(F.lit(json.dumps(values)), "array<double>")  # folded into one constant
            columns[f"{name}_{part}"] = F.element_at(table, _bucket(F.col("host"), k) + 1)
    return urls.select("*", *(columns[name].cast("double").alias(f"f_{name}") for name in FEATURES))


def fit(labelled: DataFrame):
    """``(statistics, trees)`` from labelled urls (``url, host, path, decided``: allow or block).

    Suffix statistics count every labelled url; the trees see SAMPLE of them at most. With one verdict or none among the labels there are no trees, but that
    verdict (or allow).
    """
    statistics = suffix_statistics(labelled)
    sample = _with_features(labelled.select("url", "host", "path", "decided").orderBy(F.xxhash64("url"), "url").limit(SAMPLE), statistics)
    sample = kept_table(sample.withColumn("label", (F.col("decided") == "block").cast("double")), "labelled")
    found = [r["decided"] for r in sample.select("decided").distinct().orderBy("decided").collect()]
    if len(found) < 2:
        return statistics, (found or ["allow"])[0]
    vectors = VectorAssembler(inputCols=[f"f_{name}" for name in FEATURES], outputCol="features").transform(sample)
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1)
    return statistics, trees.fit(vectors.select("features", "label").coalesce(4))


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page: the rule's verdict, else that of trees trained on the urls that rules decide.

    ``score`` is the trees' probability of block (null where a rule decides, or where the labels had one verdict only). Null urls and urls without
    ``://`` have an empty host and path, so no rule fits them. Repeated rows and null ids stay; no rows give no rows.
    """
    urls = parsed(pages, rules)
    statistics, trees = fit(urls.where("decided is not null"))
    if isinstance(trees, str):
        scored = urls.withColumn("score", F.lit(None).cast("double")).withColumn("guess", F.lit(trees))
    else:
        vectors = VectorAssembler(inputCols=[f"f_{name}" for name in FEATURES], outputCol="features").transform(_with_features(urls, statistics))

        scored = trees.transform(vectors).withColumn("score", vector_to_array("probability")[1])
        scored = scored.withColumn("guess", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    score = F.when(F.col("decided").isNull(), F.col("score")).alias("score")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", "guess").alias("verdict"), score)
