"""Temporal matching operators.

None of these is a correlated top-1 sub-query: that form plans as a nested-loop
join plus a global sort in Spark.  Each one is a union + window, or a bucketed
equi-join, so the work is hash-partitioned by the business key *and* a time
bucket: a hot key (one container or location holding a large share of all rows)
is still split across many tasks, one per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_SECONDS = 3600


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(seconds)).cast("bigint")


def nearest_after_many(
    left: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    channels: Sequence[tuple],
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """E01 as-of forward match against several right tables in one pass.

    ``channels`` holds ``(out, right, right_ts, tiebreak, values)`` tuples.  For
    every ``left`` row and channel, the first ``right`` row with equal ``keys``
    and ``right_ts >= left_ts``, ordered by (right_ts, *tiebreak), is returned
    in column ``out`` as a struct ``(ts, *tiebreak, *values)`` (NULL if none).
    ``keys`` carry the same names on both sides; NULL keys never match.

    Plan: one window over ``left ∪ rights`` partitioned by (keys, time bucket)
    finds matches inside the left row's bucket, one running ``last`` per
    channel.  Left rows whose bucket holds no later right row take a carry-over:
    the first right row of the nearest later bucket, from a second window over
    the per-(key, bucket) minimum, a table bounded by keys × buckets, not rows.
    A hot key is therefore split into as many tasks as it has buckets.
    """
    keys = list(keys)
    n = len(channels)
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()
    rights = []
    for i, (_, right, right_ts, tiebreak, values) in enumerate(channels):
        fields = [F.col(right_ts).alias("ts")] + [F.col(c) for c in tiebreak] + [F.col(c) for c in values]
        rights.append(
            right.filter(key_ok & F.col(right_ts).isNotNull()).select(
                *keys,
                F.col(right_ts).alias("_ts"),
                _bucket(F.col(right_ts), bucket_seconds).alias("_b"),
                F.lit(1).alias("_side"),
                F.struct(*fields).alias(f"_m{i}"),
            )
        )
    left_cols = left.columns
    lft = left.select("*", F.col(left_ts).alias("_ts"), _bucket(F.col(left_ts), bucket_seconds).alias("_b"),
                      F.lit(0).alias("_side"))
    u = lft
    for r in rights:
        u = u.unionByName(r, allowMissingColumns=True)
    order = [F.col("_ts").desc(), F.col("_side").desc()] + [F.col(f"_m{i}").desc() for i in range(n)]
    w = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_bucket = u.select(
        *left_cols, "_b", "_side",
        *[F.last(f"_m{i}", ignorenulls=True).over(w).alias(f"_in{i}") for i in range(n)],
    ).filter(F.col("_side") == 0).drop("_side")

    per_bucket = rights[0].drop("_ts", "_side")
    for r in rights[1:]:
        per_bucket = per_bucket.unionByName(r.drop("_ts", "_side"), allowMissingColumns=True)
    per_bucket = per_bucket.groupBy(*keys, "_b").agg(*[F.min(f"_m{i}").alias(f"_f{i}") for i in range(n)]) \
        .withColumn("_side", F.lit(1))
    left_buckets = lft.select(*keys, "_b").dropDuplicates().withColumn("_side", F.lit(0))
    wc = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_b").desc(), F.col("_side").asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carry = (
        left_buckets.unionByName(per_bucket, allowMissingColumns=True)
        .select(*keys, "_b", "_side", *[F.last(f"_f{i}", ignorenulls=True).over(wc).alias(f"_c{i}") for i in range(n)])
        .filter(F.col("_side") == 0)
        .drop("_side")
    )
    joined = in_bucket.join(carry, on=[*keys, "_b"], how="left")
    outs = [F.coalesce(F.col(f"_in{i}"), F.col(f"_c{i}")).alias(ch[0]) for i, ch in enumerate(channels)]
    return joined.select(*left_cols, *outs)


def nearest_after(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    tiebreak: Sequence[str],
    values: Sequence[str],
    out: str,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """E01 with one right table (see ``nearest_after_many``)."""
    return nearest_after_many(left, keys, left_ts, [(out, right, right_ts, tiebreak, values)], bucket_seconds)


def nearest_after_wild(
    left: DataFrame,
    right: DataFrame,
    row_id: str,
    keys: Sequence[str],
    soft_key: str,
    left_ts: str,
    right_ts: str,
    tiebreak: Sequence[str],
    values: Sequence[str],
    out: str,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """As E01 with a null-tolerant secondary key
    (``l.soft = r.soft OR l.soft IS NULL OR r.soft IS NULL``).

    Split into exact equi passes, each computed from ``left`` directly (no
    chaining): (a) same soft key, for left rows that have one; (b) one window
    on ``keys`` with two channels, right rows without a soft key and all right
    rows.  Left rows with a soft key take ``least(a, b.wild)``; rows without one
    take ``b.all``.  (a) is joined back on the unique ``row_id``.
    """
    r_keyed = right.filter(F.col(soft_key).isNotNull())
    r_wild = right.filter(F.col(soft_key).isNull())
    same = nearest_after(left.filter(F.col(soft_key).isNotNull()).select(row_id, *keys, soft_key, left_ts),
                         r_keyed, [*keys, soft_key], left_ts, right_ts, tiebreak, values, "_a", bucket_seconds)
    both = nearest_after_many(left, keys, left_ts, [("_w", r_wild, right_ts, tiebreak, values),
                                                    ("_all", right, right_ts, tiebreak, values)], bucket_seconds)
    j = both.join(same.select(row_id, "_a"), on=row_id, how="left")
    res = F.when(F.col(soft_key).isNull(), F.col("_all")).otherwise(F.least(F.col("_a"), F.col("_w")))
    return j.select(*left.columns, res.alias(out))


def interval_lookup(
    points: DataFrame,
    intervals: DataFrame,
    point_id: str,
    keys: Sequence[tuple[str, str]],
    ts: str,
    start: str,
    end: str,
    tiebreak: str,
    stream: Sequence[str],
    values: Sequence[str],
    out: str,
    match: tuple[str, str] | None = None,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    matches_only: bool = False,
) -> DataFrame:
    """For each point, the interval on the same ``keys`` with
    ``start <= ts <= end``, the latest-starting one (ties: smallest
    ``tiebreak``).  Adds struct column ``out`` of ``values`` (NULL if none).

    Intervals of one (keys, ``stream``) must have ends that rise with their
    starts, as rank-paired sessions of one user have.  Then only the last one
    started before a point can contain it.  Each point gets one row per stream
    active in its (keys, time bucket), a running ``last`` finds that interval,
    and the point keeps the best of its streams: the work follows points times
    streams present, not points times intervals.

    ``match`` is (point column, interval column): a point with a value meets
    streams of that value only, a point without one meets all.  The interval
    column must belong to ``stream``."""
    n = range(len(keys))
    k = [f"_k{i}" for i in n]
    st = [f"_s{i}" for i in range(len(stream))]
    rank = F.struct(F.col("_s"), (-F.col("_tb")).alias("t"))
    iv = intervals.select(
        *[F.col(ik).alias(f"_k{i}") for i, (_, ik) in enumerate(keys)], *[F.col(c).alias(a) for c, a in zip(stream, st)],
        F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(tiebreak).alias("_tb"), F.struct(*values).alias("_v"),
    ).dropna(subset=k).withColumn(
        "_b", F.explode(F.sequence(_bucket(F.col("_s"), bucket_seconds), _bucket(F.col("_e"), bucket_seconds))))
    # intervals of one stream that start together stand in one row
    held = iv.groupBy(*k, "_b", *st, "_s").agg(F.collect_list(F.struct(rank.alias("r"), F.col("_e").alias("e"), F.col("_v").alias("v"))).alias("_iv"))
    active = iv.select(*k, "_b", *st).distinct()
    p = points.select(
        F.col(point_id).alias("_pid"), *[F.col(pk).alias(f"_k{i}") for i, (pk, _) in enumerate(keys)], F.col(ts).alias("_t"),
        *([F.col(match[0]).alias("_m")] if match else []),
    ).withColumn("_b", _bucket(F.col("_t"), bucket_seconds))
    if match:
        own = st[list(stream).index(match[1])]
        typed = p.filter(F.col("_m").isNotNull()).join(active, [*[p[c] == active[c] for c in k], p["_b"] == active["_b"], p["_m"] == active[own]]) \
            .select("_pid", "_t", *[active[c] for c in k], active["_b"], *st)
        p = typed.unionByName(p.filter(F.col("_m").isNull()).drop("_m").join(active, [*k, "_b"]).select("_pid", "_t", *k, "_b", *st))
    else:
        p = p.join(active, [*k, "_b"])
    none = F.lit(None)
    both = p.select(*k, "_b", *st, F.col("_t").alias("_at"), F.lit(1).alias("_o"), "_pid", none.cast(held.schema["_iv"].dataType).alias("_iv")).unionByName(
        held.select(*k, "_b", *st, F.col("_s").alias("_at"), F.lit(0).alias("_o"), none.cast(p.schema["_pid"].dataType).alias("_pid"), "_iv"))
    w = Window.partitionBy(*k, "_b", *st).orderBy("_at", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_last", F.last("_iv", ignorenulls=True).over(w)).filter("_o = 1") \
        .withColumn("_hit", F.array_max(F.filter("_last", lambda x: x["e"] >= F.col("_at")))).filter("_hit is not null")
    best = found.groupBy("_pid").agg(F.max("_hit")["v"].alias(out)).withColumnRenamed("_pid", point_id)
    return best if matches_only else points.join(best, on=point_id, how="left")


def pair_sessions(
    sign_ins: DataFrame,
    sign_outs: DataFrame,
    keys: Sequence[str],
    ts: str = "TimeStamp",
    pk: str = "PrimaryKey",
    user: str = "UserName",
) -> DataFrame:
    """The n-th sign-in pairs with the n-th sign-out per (keys, day),
    kept only when the sign-out is later.  NULL users are dropped; NULL keys
    never match.  Returns keys, SignInPrimaryKey, SignOutPrimaryKey,
    SignInTime, SignOutTime, SessionDate.
    """
    keys = list(keys)

    def ranked(df: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys, "_day").orderBy(F.col(ts), F.col(pk))
        return (
            df.filter(F.col(user).isNotNull())
            .withColumn("_day", F.to_date(F.col(ts)))
            .withColumn("_rank", F.row_number().over(w))
        )

    i = ranked(sign_ins).select(*keys, "_day", "_rank", F.col(pk).alias("SignInPrimaryKey"), F.col(ts).alias("SignInTime"))
    o = ranked(sign_outs).select(*keys, "_day", "_rank", F.col(pk).alias("SignOutPrimaryKey"), F.col(ts).alias("SignOutTime"))
    return (
        i.join(o, on=[*keys, "_day", "_rank"], how="inner")
        .filter(F.col("SignOutTime") > F.col("SignInTime"))
        .withColumnRenamed("_day", "SessionDate")
        .drop("_rank")
    )


def mode_by(df: DataFrame, key: str, value: str, ts: str) -> DataFrame:
    """E07 shape: most frequent ``value`` per ``key``; ties by last seen
    (latest first), then by value ascending.  Returns key, value, SeenRows,
    LastSeenTime.  Counting is a map-side-combined aggregate, so a hot key
    reaches the ranking step as one row per distinct value.
    """
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("SeenRows"), F.max(ts).alias("LastSeenTime"))
    w = Window.partitionBy(key).orderBy(F.col("SeenRows").desc(), F.col("LastSeenTime").desc(), F.col(value).asc())
    return counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")
