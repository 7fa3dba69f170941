"""URL verdicts: host and path rules first, boosted trees on lexical features for the rest.

Features: lengths, path depth, labels of the host, digit ratio, entropy of the
characters, numbers of parameters and hyphens, and the smoothed share of
blocked URLs among the labelled ones with the same host suffix and with the
same first path segment.  The statistics cover all labelled URLs; the trees
(MLlib, trained on the executors) are fitted on about ``MOST_TRAINED`` of
them, drawn by a hash of the URL.

A null url, or one without ``://``, has an empty host and path.  Without
labelled URLs every verdict is ``allow``; with labels of one kind only, that
kind.  Repeated rows get the same verdict; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import materialize

#: Fixed values: (rule, verdict); a rule is a host and the beginning of a path.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
MOST_TRAINED = 20_000
TREES, DEPTH, SEED = 10, 4, 7
PRIOR_WEIGHT = 20.0
NUMBERS = ("url_length", "host_length", "path_length", "labels", "depth", "digit_ratio", "entropy", "params", "hyphens")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1),
                       string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule(rules=RULES) -> Column:
    """The longest rule that fits columns host and path, else null."""
    chain = None
    for text, _ in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(slash + rest)
        chain = F.when(fits, text) if chain is None else chain.when(fits, text)
    return chain


def _times(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with lexical features, host suffix and first path segment."""
    url = F.coalesce(F.col("url"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    share = F.transform(F.array_distinct(F.split(url, "")),
                        lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return (urls.withColumn("url_length", F.length(url)).withColumn("host_length", F.length("host"))
            .withColumn("path_length", F.length("path")).withColumn("labels", _times(F.col("host"), "[.]"))
            .withColumn("depth", _times(F.col("path"), "/")).withColumn("digit_ratio", _times(url, "[0-9]") / size)
            .withColumn("entropy", entropy)
            .withColumn("params", F.when(query != "", _times(query, "&") + 1).otherwise(0))
            .withColumn("hyphens", _times(url, "-"))
            .withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1))
            .withColumn("segment", F.regexp_extract("path", "^/([^/]*)", 1)))


def _with_rates(rows: DataFrame, labelled: DataFrame, prior: float) -> DataFrame:
    """Add, for suffix and segment, the smoothed share of blocked labelled URLs."""
    for name in ("suffix", "segment"):
        rate = labelled.groupBy(name).agg(
            ((F.sum("label") + PRIOR_WEIGHT * prior) / (F.count("*") + PRIOR_WEIGHT)).alias(f"{name}_rate"))
        rows = rows.join(rate, name, "left").fillna(prior, [f"{name}_rate"])
    return rows


def judge(urls: DataFrame, label: Column) -> DataFrame:
    """``urls`` (url, host, path, ...) with ``blocked`` (0.0 or 1.0); ``label`` is 1 or 0 where known, else null."""
    names = urls.columns
    inner = urls.select(F.struct(*names).alias("own"), label.cast("double").alias("label"), "url", "host", "path")
    rows = materialize(features(inner), "url_features")
    labelled = rows.filter("label is not null")
    counts = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = counts["n"], counts["blocked"] or 0.0
    if not n or blocked in (0, n):
        return rows.select("own.*", F.lit(1.0 if n and blocked else 0.0).alias("blocked"))
    inputs = [*NUMBERS, "suffix_rate", "segment_rate"]
    assemble = VectorAssembler(inputCols=inputs, outputCol="features")
    draw = F.pmod(F.xxhash64("url"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    train = _with_rates(labelled.filter(draw < F.lit(MOST_TRAINED / n)), labelled, blocked / n)
    train = materialize(train.select(*inputs, "label"), "url_training")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(assemble.transform(train))
    judged = model.transform(assemble.transform(_with_rates(rows, labelled, blocked / n)))
    return judged.select("own.*", F.col("prediction").alias("blocked"))


def verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict: the rule's verdict, else that of trees trained on what the rules decide."""
    urls = pages.select("page_id", "url", host(pages["url"]).alias("host"), path(pages["url"]).alias("path"))
    urls = urls.withColumn("rule", rule(rules))
    known = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in r]), F.col("rule"))
    judged = judge(urls, F.when(F.col("rule").isNotNull(), (known == "block").cast("int")))
    learnt = F.when(F.col("blocked") > 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule",
                         F.when(F.col("rule").isNull(), learnt).otherwise(known).alias("verdict"))
