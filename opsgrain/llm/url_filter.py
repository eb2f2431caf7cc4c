"""Operator 10, URL filters (native: DataFrame functions and JVM MLlib only).

``judge_urls`` parses each URL, applies a curated rule list (longest rule
wins), and judges the rest with gradient-boosted trees on lexical features.
The trees are trained on the URLs that the rules label.

Defined results: a null URL or one without ``://`` has an empty host and path
and is judged by the trees from its lexical features; without any labelled
URL every unlisted URL is allowed, and with labels of one kind only it gets
that kind.  Rules of equal length: block wins.  Repeated rows are judged alike
and all returned.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.common import lower_ascii, stored


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: Fixed values of the query's contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

FEATURES = [
    "url_chars", "host_chars", "host_labels", "depth", "digit_ratio", "letter_ratio",
    "entropy", "n_params", "hyphens", "suffix_block_rate",
]


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (after the first ``://``, up to ``/ ? #``, A-Z lowered)
    and ``path`` (then up to ``? #``)."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    return (
        df.withColumn("_rest", F.coalesce(rest, F.lit("")))
        .withColumn("host", lower_ascii(F.regexp_extract("_rest", "^[^/?#]*", 0)))
        .withColumn("path", F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1))
    )


def with_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest rule that fits host
    and path (null where none does).  The rule list is a literal of the plan."""
    fits = [
        F.when(
            ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path),
            F.struct(F.lit(len(r.host + r.path)).alias("n"), F.lit(r.verdict).alias("verdict"), F.lit(r.host + r.path).alias("rule")),
        )
        for r in rules
    ]
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,verdict:string,rule:string>")
    return df.withColumn("_best", best).withColumn("rule", F.col("_best.rule")).withColumn("rule_verdict", F.col("_best.verdict"))


def with_lexical_features(df: DataFrame, url: str = "url") -> DataFrame:
    """Lexical features of the whole URL; all finite, none null."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.length("_u").cast("double")
    query = F.regexp_extract("_u", r"^[^?#]*\?([^#]*)", 1)
    # equal characters stand together after sorting, so each run is one character's count
    runs = F.regexp_extract_all(F.array_join(F.array_sort(F.split("_u", "")), ""), F.lit(r"(?s)(.)\1*"), F.lit(0))
    plogp = F.aggregate("_runs", F.lit(0.0), lambda a, r: a + F.length(r) * F.log2(F.length(r).cast("double")))
    return (
        df.withColumn("_u", u)
        .withColumn("_runs", runs)
        .withColumn("url_chars", n)
        .withColumn("host_chars", F.length("host").cast("double"))
        .withColumn("host_labels", F.when(F.col("host") == "", 0.0).otherwise(F.size(F.split("host", r"\.")).cast("double")))
        .withColumn("suffix", F.substring_index("host", ".", -1))
        .withColumn("depth", F.size(F.array_remove(F.split("path", "/"), "")).cast("double"))
        .withColumn("digit_ratio", F.when(n > 0, F.regexp_count("_u", F.lit("[0-9]")) / n).otherwise(0.0))
        .withColumn("letter_ratio", F.when(n > 0, F.regexp_count("_u", F.lit("[A-Za-z]")) / n).otherwise(0.0))
        .withColumn("entropy", F.when(n > 0, F.log2(n) - plogp / n).otherwise(0.0))
        .withColumn("n_params", F.size(F.array_remove(F.split(query, "&"), "")).cast("double"))
        .withColumn("hyphens", F.regexp_count("_u", F.lit("-")).cast("double"))
    )


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, max_train: int = 50_000, trees: int = 12,
               depth: int = 4, smoothing: float = 20.0) -> DataFrame:
    """Every row of ``pages(page_id, url)`` with host, path, rule, verdict and
    ``block_probability``.

    ``max_train`` bounds the labelled URLs that the trees are fitted on (a
    hash sample of about that many; all of them where there are fewer).  The
    suffix statistics cover all labelled URLs and are shrunk by ``smoothing``
    pseudo-rows of the overall block rate."""
    spark = pages.sparkSession
    rows = with_lexical_features(with_rule(with_host_path(pages.select("page_id", "url")), rules))
    base = [f for f in FEATURES if f != "suffix_block_rate"]
    rows = stored(rows.select("page_id", "url", "host", "path", "rule", "rule_verdict", "suffix", *base), "url-features")
    labelled = rows.where("rule_verdict is not null").withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    total = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")).first()
    if total["n"] == 0 or total["blocked"] in (0.0, float(total["n"])):
        only = "block" if total["n"] and total["blocked"] else "allow"
        return rows.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(only)).alias("verdict"),
                           F.lit(float(only == "block")).alias("block_probability"))
    rate = total["blocked"] / total["n"]
    suffixes = stored(
        labelled.groupBy("suffix").agg(((F.sum("label") + smoothing * rate) / (F.count("*") + smoothing)).alias("suffix_block_rate")),
        "url-suffixes",
    )
    ready = rows.join(suffixes, "suffix", "left").fillna(rate, ["suffix_block_rate"])
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(ready)
    share = min(1.0, max_train / total["n"])
    train = ready.where("rule_verdict is not null").where(
        F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    ).select("features", (F.col("rule_verdict") == "block").cast("double").alias("label"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7).fit(train)
    scored = model.transform(ready).withColumn("block_probability", vector_to_array("probability")[1])
    verdict = F.coalesce("rule_verdict", F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_probability")
