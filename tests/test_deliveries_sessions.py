import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from colloqua.operators.deliveries import keep_first_delivery, new_deliveries, surplus_deliveries
from colloqua.operators.islands import blocked_islands
from colloqua.operators.sessions import bitmap_runs, close_bitmap, sessions

MSG = "row_id long, room_name string, msg_svr_id string, msg string, create_time timestamp, extra string"
T0 = dt.datetime(2024, 1, 1)


def rows(spark, data):
    return spark.createDataFrame(
        [(i, room, ident, msg, None if t is None else T0 + dt.timedelta(seconds=t), "e") for i, room, ident, msg, t in data], MSG)


def test_deliveries(spark):
    df = rows(spark, [
        (1, "r", "a", "x", 5), (2, "r", " a　", "x", 3), (3, "r", "a", "x", None), (4, "r", "a", "y", 1),
        (5, "r", "b", None, 1), (6, "r", "b​", None, 1), (7, "r", None, "x", 1), (8, "r", "\t ", "x", 1),
        (9, None, "a", "x", 9), (10, None, "a", "x", 8), (11, "q", "a", "x", 9)])
    assert {r.row_id for r in keep_first_delivery(df).collect()} == {2, 4, 5, 7, 8, 10, 11}
    assert {r.row_id for r in surplus_deliveries(df).collect()} == {1, 3, 6, 9}
    assert keep_first_delivery(df).columns == df.columns
    assert keep_first_delivery(df.limit(0)).count() == 0 and surplus_deliveries(df.limit(0)).count() == 0


def test_long_texts_are_told_apart(spark):
    long = "x" * 100_000
    df = rows(spark, [(1, "r", "a", long, 5), (2, "r", "a", long, 3), (3, "r", "a", long + "y", 1), (4, "r", "a", "x" * 64, 1), (5, "r", "a", "x" * 65, 1), (6, "r", "a", "x" * 65, 2), (7, "r", "a", "", 1), (8, "r", "a", None, 1)])
    assert {r.row_id for r in surplus_deliveries(df).collect()} == {1, 6}
    assert {r.row_id for r in new_deliveries(df.where("row_id in (1, 3, 6, 7, 8)"), df.where("row_id in (2, 5, 8)")).collect()} == {3, 7}


def test_new_batch_against_stored(spark):
    stored = rows(spark, [(1, "r", "a", "x", 5), (2, "r", "b", None, 5), (3, None, "c", "x", 5)])
    batch = rows(spark, [(4, "r", "a ", "x", 9), (5, "r", "b", None, 9), (6, None, "c", "x", 9), (7, "r", None, "x", 9),
                         (8, "r", "d", "x", 9), (9, "r", "d", "x", 8), (10, "r", "a", "other", 9)])
    assert {r.row_id for r in new_deliveries(batch, stored).collect()} == {7, 9, 10}


def test_closing_fills_pauses_up_to_reach():
    rng = random.Random(3)
    for _ in range(200):
        reach, at = rng.randrange(0, 40), sorted(rng.sample(range(400), rng.randrange(1, 30)))
        at = [a - at[0] for a in at]
        want, start = [], at[0]
        for a, b in zip(at, [*at[1:], 10**9]):
            if b - a > reach + 1:
                want.append((start, a))
                start = b
        first, last = bitmap_runs(close_bitmap(sum(1 << a for a in at), reach))
        assert list(zip(first.tolist(), last.tolist())) == want


@pytest.mark.parametrize("gap", [1, 2, 60, 1800])
def test_sessions_against_brute_force(spark, gap):
    rng = random.Random(gap)
    data = []
    for who in ("a", "b", "hot", None, " "):
        t = rng.randrange(10**6)
        for _ in range(300 if who == "hot" else 60):
            t += rng.choice([0, 0.25, 0.5, gap - 0.5, gap, gap, gap + 0.25, gap + 1, gap * 3, 90000])
            data.append((who, t))
    rng.shuffle(data)
    df = spark.createDataFrame([(w, T0 + dt.timedelta(seconds=t), 1) for w, t in data] + [("a", None, 1)],
                               "talker string, create_time timestamp, start_us long")
    want = []
    for who in ("a", "b", "hot"):
        at = sorted(int(t * 10**6) for w, t in data if w == who)
        run = [at[0]]
        for a in [*at[1:], None]:
            if a is None or a - run[-1] > gap * 10**6:
                want.append((who, run[0], run[-1], len(run)))
                run = []
            run.append(a)
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds()) * 10**6
    got = sorted((r.talker, r.start_us - base, r.end_us - base, r.n_events) for r in sessions(df, gap_seconds=gap).collect())
    assert got == sorted(want)
    assert sessions(df.limit(0), gap_seconds=gap).count() == 0


def test_blocked_islands_against_plain_window(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), i, rng.randrange(500), rng.choice("xy")) for i in range(600)]
    df = spark.createDataFrame(data, "k string, id long, t long, v string")
    joins = lambda p, c: (p["v"] == c["v"]) & (c["t"] - p["t"] <= 3)
    got = blocked_islands(df, ["k"], ["t", "id"], F.expr("t div 7"), ["v"], joins,
                          {"n": (F.count("*"), F.sum), "lo": (F.min("id"), F.min)})
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.withColumn("p", F.lag(F.struct("v", "t")).over(w))
    plain = plain.withColumn("g", F.sum(F.when((F.col("p.v") == F.col("v")) & (F.col("t") - F.col("p.t") <= 3), 0).otherwise(1)).over(w))
    plain = plain.groupBy("k", "g").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.min("t").alias("a"), F.max("t").alias("b"))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select("k", "n", "lo", "first.t", "last.t").collect())) == sorted(map(key, plain.select("k", "n", "lo", "a", "b").collect()))
