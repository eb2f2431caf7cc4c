"""The one-table matchers of the work-event grain against the separate ones."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from opsgrain.operators import events as E
from opsgrain.operators import timeline as TL
from opsgrain.operators.temporal import mode_by, pair_sessions
from opsgrain.sources.adapter import Tables

SMALL = "/root/testdata/sf0.001"


class Fixture:
    """Hand-made tables: nulls in every key, ties, repeated times, a hot
    container and empty kinds."""

    def __init__(self, spark, seed: int, n: int = 500, empty: bool = False):
        rnd = random.Random(seed)
        start = dt.datetime(2026, 1, 1, 6)

        def rows(kind):
            out = []
            for k in range(0 if empty else n):
                at = start + dt.timedelta(seconds=rnd.choice([rnd.randrange(20_000), 600 * rnd.randrange(40)]), days=rnd.random() < 0.1)
                out.append((
                    kind, 10 * k + len(kind), None if rnd.random() < 0.03 else at, rnd.choice(["Pick", "PutAway", None]), rnd.choice([1, 1, 1, 2, 3, None]),
                    rnd.choice(["P1", "P2", "P2", "P3", None]), rnd.choice(["C1", "C1", "C1", "C2", "C3", None]), rnd.choice(["u1", "u2", "u3", None]),
                    rnd.choice(["Pick", "PutAway", "", None]), rnd.choice(["00:00:12.5", "n/a", None]), k, rnd.choice([k % 50, None]), rnd.choice([f"S{k % 40}", None]),
                    rnd.choice([at + dt.timedelta(seconds=30), None]), rnd.randrange(5), rnd.choice([rnd.randrange(5), None]), rnd.choice([k % 90, None]),
                    rnd.choice([at, None]), rnd.choice(["P1", None]), rnd.randrange(4), rnd.randrange(9)))
            return spark.createDataFrame(out, "Kind string, " + ", ".join(f"{c} {ty}" for c, ty in TL.COLUMNS.items())).drop("Kind").cache()

        for kind, name in TL.TABLES.items():
            setattr(self, name, rows(kind))


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def separate(t):
    """E18 from the separate matchers."""
    lm = E.location_map(t.bin_presented, t.open_bin, t.close_bin)
    ws = E.work_sessions(t.sign_in, t.sign_out, lm)
    return E.session_events(ws).unionByName(E.bin_events(t.bin_presented, ws, t.pick, t.close_bin)).unionByName(E.line_events(t.pick)).unionByName(E.order_events(t.order_rows, t.pick))


@pytest.mark.parametrize("seed", [1, 2])
def test_grain_equals_the_separate_matchers(spark, seed):
    t = Fixture(spark, seed)
    got, want = rows(E.work_events(t)), rows(separate(t))
    assert got == want and len(got) > 1000


def test_matchers_equal_brute_force(spark):
    t = Fixture(spark, 3, 200)
    bins, picks, closes = (x.collect() for x in (t.bin_presented, t.pick, t.close_bin))
    ins, outs = t.sign_in.collect(), t.sign_out.collect()
    pairs = []
    for key in {(r.WorkType, r.LocationPrimaryKey, r.UserName, r.TimeStamp.date()) for r in ins if r.TimeStamp}:
        if None in key:
            continue
        a, b = (sorted((r.TimeStamp, r.PrimaryKey) for r in side if r.TimeStamp and (r.WorkType, r.LocationPrimaryKey, r.UserName, r.TimeStamp.date()) == key) for side in (ins, outs))
        pairs += [(*key[:3], i, o) for i, o in zip(a, b, strict=False) if o[0] > i[0]]
    sessions = TL.paired_sessions(TL.typed(t, "SignIn", "SignOut"))
    assert sorted(map(repr, pairs)) == sorted(repr((r.WorkType, r.LocationPrimaryKey, r.UserName, (r.SignInTime, r.SignInPrimaryKey), (r.SignOutTime, r.SignOutPrimaryKey))) for r in sessions.collect())
    want = {}
    for r in bins:
        inside = [s for s in pairs if r.TimeStamp and r.LocationPrimaryKey is not None and s[1] == r.LocationPrimaryKey and s[3][0] <= r.TimeStamp <= s[4][0] and (r.LocationTaskType is None or s[0] == r.LocationTaskType)]
        user = max(inside, key=lambda s: (s[3][0], -s[3][1]))[2] if inside else None
        later = [(p.TimeStamp, p.PrimaryKey, p.UserName) for p in picks if p.UserName and r.TimeStamp and p.TimeStamp and p.TimeStamp >= r.TimeStamp and p.ContainerBarcode == r.ContainerBarcode is not None]
        shut = [c.TimeStamp for c in closes if r.TimeStamp and c.TimeStamp and c.TimeStamp >= r.TimeStamp and c.ContainerBarcode == r.ContainerBarcode is not None and
                (None in (c.LocationPrimaryKey, r.LocationPrimaryKey) or c.LocationPrimaryKey == r.LocationPrimaryKey)]
        want[r.PrimaryKey] = (user, min(later)[2] if later else None, min(shut, default=None))
    for bucket in (60, 3600, 10**7):
        found = TL.with_session_user(t.bin_presented.select(*E.BIN_COLUMNS), sessions, bucket_seconds=bucket)
        found = TL.with_later_events(found, TL.typed(t, "Pick", "CloseBin"), TL.typed(t, "BinPresented", "Pick", "CloseBin"), bucket)
        assert {r.PrimaryKey: (r.session_user, r.pick_user, r.CloseTime) for r in found.collect()} == want


def test_mode_and_orders_equal_the_separate_forms(spark):
    t = Fixture(spark, 4)
    seen = TL.typed(t, "BinPresented", "OpenBin", "CloseBin")
    known = seen.where("LocationPrimaryKey is not null and LocationBarcode is not null")
    assert rows(TL.barcode_of_location(seen)) == rows(mode_by(known, "LocationPrimaryKey", "LocationBarcode", "TimeStamp").select("LocationPrimaryKey", "LocationBarcode"))
    one = t.order_rows.where("CompletedDate is not null")
    cols = ["PrimaryKey", "OrderPrimaryKey", "OrderNumber", "has_pick"]
    twice = Fixture(spark, 4)
    twice.order_rows = twice.order_rows.unionAll(twice.order_rows.limit(20))
    for x in (t, twice):
        assert rows(TL.orders_with_pick_flag(TL.typed(x, "Order", "Pick")).select(*cols)) == rows(E.orders_with_pick_flag(x.order_rows.where("CompletedDate is not null"), x.pick).select(*cols))
    assert one.count() > 100
    s = pair_sessions(t.sign_in, t.sign_out, ["WorkType", "LocationPrimaryKey", "UserName"])
    assert rows(s.select("SignInPrimaryKey", "SignOutPrimaryKey")) == rows(TL.paired_sessions(TL.typed(t, "SignIn", "SignOut")).select("SignInPrimaryKey", "SignOutPrimaryKey"))


def test_empty_tables(spark):
    assert E.work_events(Fixture(spark, 1, empty=True)).count() == 0


def test_typed_rows_are_the_tables_rows(spark):
    t = Tables(spark, SMALL)
    both = t.typed(*TL.TABLES)
    for kind, name in TL.TABLES.items():
        table = getattr(t, name)
        cols = [c for c in TL.COLUMNS if c in table.columns]
        assert rows(both.where(F.col("Kind") == kind).select(*cols)) == rows(table.select(*[F.col(c).cast(TL.COLUMNS[c]) for c in cols]))


def test_plan_of_the_grain(spark):
    plan = E.work_events(Tables(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 8
    assert len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)) <= 15
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
