"""Queries over the general operators: sessions, repeated deliveries, timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloqua.functions.blanks import INVISIBLE
from colloqua.operators.deliveries import keep_first_delivery, new_deliveries, surplus_deliveries
from colloqua.operators.sessions import sessions
from colloqua.operators.timestamps import normalise_timestamps
from colloqua.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "messages").select(
        "row_id", "room_name", "msg_svr_id", "msg", "create_time", "talker"
    )
    found = sessions(keep_first_delivery(messages), "talker", "create_time", 1800)
    second = lambda c: F.expr(f"({c} - pmod({c}, 1000000)) div 1000000")
    return found.select(
        "talker", second("start_us").alias("start_s"), second("end_us").alias("end_s"), "n_events"
    ).select("talker", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"), "n_events")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "messages").select("row_id", "room_name", "msg_svr_id", "msg", "create_time")
    return surplus_deliveries(messages).select("row_id")


def p4_new_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the later half of the batches that the earlier half hasn't delivered."""
    messages = table(spark, sf_dir, "messages").select(
        "row_id", "room_name", "msg_svr_id", "msg", "create_time", "batch_id"
    )
    middle = messages.agg(F.expr("(min(batch_id) + max(batch_id)) div 2")).first()[0]  # one number
    stored = messages.where(F.col("batch_id") <= F.lit(middle))
    batch = messages.where(F.col("batch_id") > F.lit(middle))
    return new_deliveries(batch, stored).select("row_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "raw_messages").select("raw_id", "room_name", "create_time", "export_zone")
    rooms = table(spark, sf_dir, "rooms").select("room_name", "zone_name")
    return normalise_timestamps(raw, rooms).where("utc_us IS NOT NULL").select("raw_id", "utc_us")


QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p4_new_in_batch": p4_new_in_batch, "p7_found": p7_found}

#: DuckDB: rows with the number of their delivery among those of one message (1: kept).
DELIVERIES = f"""
    keyed AS (SELECT *, regexp_replace(msg_svr_id, '^[{INVISIBLE}]+|[{INVISIBLE}]+$', '', 'g') AS ident FROM messages),
    ranked AS (SELECT *, CASE WHEN ident IS NULL OR ident = '' THEN 1 ELSE row_number() OVER (
        PARTITION BY room_name, ident, msg ORDER BY create_time NULLS LAST, row_id) END AS delivery FROM keyed)
"""

ORACLES = {
    "p2_found": f"""WITH {DELIVERIES},
        ev AS (SELECT talker, epoch_us(create_time) AS us FROM ranked
            WHERE delivery = 1 AND create_time IS NOT NULL AND regexp_matches(talker, '[^{INVISIBLE}]')),
        flagged AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 1800000000 THEN 0 ELSE 1 END AS brk
            FROM ev WINDOW w AS (PARTITION BY talker ORDER BY us)),
        grouped AS (SELECT *, sum(brk) OVER (PARTITION BY talker ORDER BY us ROWS UNBOUNDED PRECEDING) AS g FROM flagged)
        SELECT talker, min(us) // 1000000 AS start_s, max(us) // 1000000 AS end_s,
            max(us) // 1000000 - min(us) // 1000000 AS duration_s, count(*) AS n_events
        FROM grouped GROUP BY talker, g""",
    "p4_found": f"WITH {DELIVERIES} SELECT row_id FROM ranked WHERE delivery > 1",
    "p4_new_in_batch": f"""WITH {DELIVERIES.replace("FROM messages)", "FROM messages WHERE batch_id > (SELECT (min(batch_id) + max(batch_id)) // 2 FROM messages))")},
        old AS (SELECT DISTINCT room_name, msg, regexp_replace(msg_svr_id, '^[{INVISIBLE}]+|[{INVISIBLE}]+$', '', 'g') AS ident
            FROM messages WHERE batch_id <= (SELECT (min(batch_id) + max(batch_id)) // 2 FROM messages))
        SELECT row_id FROM ranked r WHERE delivery = 1 AND NOT EXISTS (SELECT 1 FROM old o WHERE o.ident <> ''
            AND o.ident = r.ident AND o.room_name IS NOT DISTINCT FROM r.room_name AND o.msg IS NOT DISTINCT FROM r.msg)""",
}
