"""Operator 2, host-level quality rules (native: DataFrame functions only).

Each document is measured inside its own row (no shuffle of texts).  Rule
failures are then counted per host, each host's failure rate is shrunk towards
an empirical beta prior fitted over all hosts, and the host verdicts are
joined back to the narrow per-document table.

Defined results: null and empty texts have no words and fail the base rules; a
null host has no host evidence, so its documents stand on their own rules;
repeated rows are separate documents; without any host the prior is flat.
Equal 8-word windows are found by a 96-bit hash inside one document.  Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.common import stored

SPACES = "[\\x20\\x09-\\x0D]"
WINDOW = 8


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``: only the ends of the split can be empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES + "+"), "")


def _window_hashes(words: str, hashed) -> Column:
    n = F.size(words)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: hashed(F.slice(words, i, WINDOW)))


def _let(value: Column, result) -> Column:
    """``result(value)``, with ``value`` computed once however often it is used there."""
    return F.transform(F.array(value), result)[0]


def _covered(words: str) -> Column:
    """Words that lie in a window found twice or more.  Equal windows are
    neighbours after sorting by (hash, start)."""
    wide = _window_hashes(words, lambda w: F.struct(F.xxhash64(w).alias("h"), F.hash(w).alias("g")))
    sorted_ = F.array_sort(F.transform(wide, lambda x, i: F.struct(x["h"].alias("h"), x["g"].alias("g"), i.alias("i"))))

    def with_next(e: Column) -> Column:
        return F.zip_with(e, F.slice(e, 2, F.greatest(F.size(e), F.lit(1))),
                          lambda a, b: F.struct(a["i"].alias("i"), F.coalesce((a["h"] == b["h"]) & (a["g"] == b["g"]), F.lit(False)).alias("same")))

    def repeated(after: Column) -> Column:
        before = F.concat(F.array(F.struct(F.lit(-1).alias("i"), F.lit(False).alias("same"))), F.slice(after, 1, F.greatest(F.size(after) - 1, F.lit(1))))
        return F.array_sort(F.filter(F.zip_with(after, before, lambda a, p: F.when(a["same"] | p["same"], a["i"])), lambda i: i.isNotNull()))

    starts = _let(_let(sorted_, with_next), repeated)
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(starts, zero,
                       lambda a, s: F.struct(s.alias("last"), (a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n")),
                       lambda a: a["n"])


def measure(documents: DataFrame) -> DataFrame:
    """Per-document counts and the base verdict; one row per input row."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    m = (
        documents.select("doc_id", F.col("source").alias("host"), "text", words_of(F.col("text")).alias("_w"))
        .select(
            "doc_id", "host", "_w",
            F.size("_w").cast("bigint").alias("n_words"),
            F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
            F.coalesce(F.regexp_count("text", F.lit("[#*$%&|<>]")), F.lit(0)).cast("bigint").alias("n_symbols"),
            lines.alias("_l"),
            _window_hashes("_w", F.xxhash64).alias("_h"),
        )
        .select(
            "doc_id", "host", "n_words", "word_chars", "n_symbols",
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
            F.when(F.size(F.array_distinct("_h")) < F.size("_h"), _covered("_w")).otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"),
        )
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return m.withColumn("base_failed", failed)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Moment fit of Beta(a, b) to the hosts' failure rates, from three sums
    over all hosts.  A spread no wider than chance gives a strong prior (1e6
    pseudo-documents); no host at all gives the flat prior (1, 1)."""
    r = F.col("failed") / F.col("docs")
    s = hosts.agg(F.count("*").alias("k"), F.avg(r).alias("m"), F.var_samp(r).alias("v"), F.avg(1 / F.col("docs")).alias("inv")).first()
    if not s["k"]:
        return 1.0, 1.0
    m, v, inv = s["m"], s["v"] or 0.0, s["inv"]
    if m <= 0.0 or m >= 1.0:
        m = min(max(m, 1e-6), 1 - 1e-6)
    spread = v - m * (1 - m) * inv  # what is left beyond binomial noise
    strength = min(max(m * (1 - m) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6
    return m * strength, (1 - m) * strength


def host_verdicts(measured: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """One row per host: documents, failures, the shrunk failure rate, and
    whether the host is accepted (shrunk rate at most ``max_rate``)."""
    hosts = stored(
        measured.where("host is not null").groupBy("host")
        .agg(F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("bigint")).alias("failed")),
        "host-counts",
    )
    a, b = beta_prior(hosts)
    rate = (F.col("failed") + a) / (F.col("docs") + (a + b))
    return hosts.withColumn("shrunk_rate", rate).withColumn("host_accepted", rate <= max_rate)


def apply_host_rules(documents: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """Documents with their counts, base verdict, host rate and ``kept``."""
    measured = stored(measure(documents), "host-rules")
    hosts = stored(host_verdicts(measured, max_rate), "host-verdicts")
    joined = measured.join(hosts, "host", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce("host_accepted", F.lit(True)))
