"""Streaming forms run over finite tables."""

import datetime as dt
import random
from collections import defaultdict

import duckdb
from oracle import assert_same

from colloqua.plans import reference_queries
from colloqua.streaming.messages import closed_stream, run_to_end, stream_replies

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "row_id long, room_name string, is_sender int, msg string, create_time timestamp"


def sessions(rows, gap=120):
    """Brute force: (room, side, start, end, n_rows, msg)."""
    sides, out = defaultdict(list), []
    for seq, room, side, msg, at in rows:
        if at is not None:
            sides[room, side].append((at, seq, msg or ""))
    for (room, side), said in sides.items():
        run = []
        for row in [*sorted(said), None]:
            if run and (row is None or row[0] - run[-1][0] > dt.timedelta(seconds=gap)):
                us = lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
                out.append((room, side, us(run[0][0]), us(run[-1][0]) + gap * 1_000_000, len(run), "\n".join(r[2] for r in run)))
                run = []
            run.append(row)
    return sorted(out, key=str)


def found(spark, tmp_path, name, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{name}/messages.parquet")
    return sorted(map(tuple, reference_queries.stream_sessionize(spark, f"{tmp_path}/{name}").collect()), key=str)


def test_every_session_is_written(spark, tmp_path):
    rng = random.Random(3)
    # Steps of 7 seconds never lie exactly the gap apart; the last ten minutes hold many sessions.
    rows = [(i, rng.choice("abc"), rng.randrange(2), f"m{i}", T0 + dt.timedelta(seconds=7 * rng.randrange(260))) for i in range(120)]
    rows += [(200, None, 0, "x", T0), (201, "a", 5, "x", T0), (202, "a", None, "x", T0), (203, "a", 0, "x", None), (204, "d", 1, None, T0), (205, "d", 1, "late", T0 + dt.timedelta(days=3))]
    got = found(spark, tmp_path, "live", rows[:120])
    assert got == sessions(rows[:120])
    assert sum(s[3] > max(s[3] for s in got) - 600_000_000 for s in got) > 3
    assert found(spark, tmp_path, "far", rows) == sessions(rows)
    assert found(spark, tmp_path, "none", []) == []


def test_first_replies_like_sql(spark, tmp_path):
    rng, gap = random.Random(5), dt.timedelta(seconds=300)
    edge = T0 + dt.timedelta(hours=1)  # a block ends here
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([0, 1, 2, None]), "x", T0 + dt.timedelta(seconds=100 * rng.randrange(120))) for i in range(400)]
    us = dt.timedelta(microseconds=1)
    for i, (room, at, reply) in enumerate([("at", edge - us, edge - us + gap), ("past", edge - us, edge + gap), ("on", edge, edge + gap), ("same", edge, edge), ("old", edge - 8_000_000 * gap, edge - 8_000_000 * gap + us)]):
        rows += [(500 + 2 * i, room, 0, "x", at), (501 + 2 * i, room, 1, None, reply)]
    rows += [(600, "twice", 0, "x", T0), (600, "twice", 0, "x", T0), (None, "twice", 0, "x", T0), (602, "twice", 1, "y", T0 + gap), (603, "twice", 1, "z", T0 + gap / 2), (604, "twice", 1, "z", None)]
    for name, some in (("some", rows), ("none", []), ("asked", [r for r in rows if r[2] != 1])):
        spark.createDataFrame(some, SCHEMA).write.parquet(f"{tmp_path}/{name}/messages.parquet")
        con = duckdb.connect()
        con.sql("SET timezone = 'UTC'")
        con.sql(f"CREATE VIEW messages AS SELECT * FROM '{tmp_path}/{name}/messages.parquet/*.parquet'")
        assert_same(reference_queries.stream_asof(spark, f"{tmp_path}/{name}"), con, reference_queries.ORACLES["stream_asof"])


def test_a_flood_of_replies_is_one_row_for_each_question(spark, tmp_path):
    rows = [(i, "a", i % 2, f"m{i}", T0 + dt.timedelta(microseconds=i // 4)) for i in range(4000)]
    plain = reference_queries._stream_rows(spark.createDataFrame(rows, SCHEMA))
    found = run_to_end(stream_replies(closed_stream(plain, f"{tmp_path}")), f"{tmp_path}").collect()
    start = (T0 - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    want = [("a", start + i // 4, i, f"m{i}", start + i // 4 + 1, f"m{i // 4 * 4 + 5}") for i in range(0, 3996, 2)]
    assert sorted(map(tuple, found)) == want
