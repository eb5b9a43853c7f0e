"""Queries over the operators for training data, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloqua.llm.conversations import rebuild_conversations, rebuild_messages
from colloqua.llm.leakage import find_leaks, find_passages
from colloqua.llm.personal import find_personal_data, masked
from colloqua.llm.repeats import width_table, collapse_repeats
from colloqua.llm.samelook import one_form, same_look_classes, same_look_pairs
from colloqua.llm.tokenize import encode_corpus
from colloqua.llm.turns import speaker_turns
from colloqua.operators.deliveries import keep_first_delivery
from colloqua.plans.dealt_queries import DELIVERIES, INVISIBLE
from colloqua.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = speaker_turns(table(spark, sf_dir, "call_segments"), table(spark, sf_dir, "calls"))
    return turns.select(
        "call_id", "turn_no", "speaker", F.round(F.col("start_s") * 1000).cast("long").alias("start_ms"), "bare_text"
    )


#: The table, key and text of each column in which personal data is looked for.
PERSONAL = (("messages", "row_id", "msg"), ("chatml_messages", "cm_id", "chat_content"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        find_personal_data(table(spark, sf_dir, name).select(key, text), key, text).select(
            F.lit(name).alias("tab_name"), "row_key", "kind"
        )
        for name, key, text in PERSONAL
    ]
    return parts[0].unionByName(parts[1]).distinct()


def p3_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of both tables with placeholders."""
    parts = [
        table(spark, sf_dir, name).select(
            F.lit(name).alias("tab_name"), F.col(key).alias("row_key"), masked(F.col(text)).alias("masked")
        )
        for name, key, text in PERSONAL
    ]
    return parts[0].unionByName(parts[1])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "messages").select(
        "row_id", "room_name", "msg_svr_id", "msg", "create_time", "is_sender"
    )
    second = lambda c: F.expr(f"({c} - pmod({c}, 1000000)) div 1000000")
    return (
        collapse_repeats(keep_first_delivery(messages))
        .where("n_events >= 2")
        .select("first_row_id", "last_row_id", "n_events", (second("last_us") - second("first_us")).alias("duration_s"))
    )


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "messages").select(
        "row_id", "room_name", "msg_svr_id", "msg", "create_time", "is_sender", "talker"
    )
    return keep_first_delivery(messages)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rebuild_conversations(_delivered(spark, sf_dir))
    return found.select(
        F.col("room").alias("room_name"),
        F.col("first_id").alias("first_row_id"),
        F.col("last_id").alias("last_row_id"),
        "n_msgs",
        "n_turns",
    )


def p6_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's messages in order, with speaker roles."""
    found = rebuild_messages(_delivered(spark, sf_dir))
    return found.select(
        F.col("room").alias("room_name"), F.col("first_id").alias("first_row_id"), F.col("pos").cast("long").alias("pos"),
        F.col("id").alias("row_id"), "role", F.col("text").alias("content"),
    )


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "eval_items"))


def p9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each leaked passage lies in its document and its item."""
    return find_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_look_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that looks like a different one, with its class."""
    return same_look_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p10_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in the one form of its look."""
    return one_form(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "form")


QUERIES = {
    "p1_found": p1_found,
    "p3_found": p3_found,
    "p3_masked": p3_masked,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_messages": p6_messages,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_passages": p9_passages,
    "p10_found": p10_found,
    "p10_classes": p10_classes,
    "p10_forms": p10_forms,
}

def _one_slip(a: str, b: str) -> str:
    """SQL: ``a`` and ``b`` are equal but for one letter changed, put in or left out."""
    same = f"coalesce(list_min([i for i in range(1, least(length({a}), length({b})) + 1) if {a}[i] <> {b}[i]]) - 1, least(length({a}), length({b})))"
    return (
        f"(CASE WHEN abs(length({a}) - length({b})) > 1 THEN false WHEN length({a}) = length({b}) THEN {a}[{same} + 2:] = {b}[{same} + 2:] "
        f"WHEN length({a}) > length({b}) THEN {a}[{same} + 2:] = {b}[{same} + 1:] ELSE {a}[{same} + 1:] = {b}[{same} + 2:] END)"
    )


_WIDE, _PLAIN = (x.replace("'", "''") for x in width_table())
_BARE = f"regexp_replace(low, '[\\p{{P}}\\p{{Sm}}\\p{{Sk}}{INVISIBLE}]+', '', 'g')"

#: DuckDB: the visible rows of conversations whose rows are all sound, in order.
SHOWN = f"""WITH {DELIVERIES},
        ev AS (SELECT *, epoch_us(create_time) AS us, coalesce(regexp_matches(msg, '[^{INVISIBLE}]'), false) AS seen,
            coalesce(is_sender IN (0, 1), false) AND coalesce(regexp_matches(talker, '[^{INVISIBLE}]'), false) AS sound
            FROM ranked WHERE delivery = 1 AND create_time IS NOT NULL),
        flagged AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 3600000000 THEN 0 ELSE 1 END AS brk
            FROM ev WINDOW w AS (PARTITION BY room_name ORDER BY us, row_id)),
        grouped AS (SELECT *, sum(brk) OVER (PARTITION BY room_name ORDER BY us, row_id ROWS UNBOUNDED PRECEDING) AS g FROM flagged),
        good AS (SELECT room_name AS room, g AS conv FROM grouped GROUP BY room_name, g HAVING bool_and(sound)),
        shown AS (SELECT *, row_number() OVER v AS pos, CASE WHEN lag(is_sender) OVER v = is_sender THEN 0 ELSE 1 END AS turn
            FROM grouped JOIN good ON room IS NOT DISTINCT FROM room_name AND conv = g WHERE seen
            WINDOW v AS (PARTITION BY room_name, g ORDER BY us, row_id))
"""

ORACLES = {
    "p5_found": f"""WITH {DELIVERIES},
        low AS (SELECT room_name, row_id, is_sender, epoch_us(create_time) AS us, lower(translate(msg, '{_WIDE}', '{_PLAIN}')) AS low FROM ranked
            WHERE delivery = 1 AND create_time IS NOT NULL AND regexp_matches(msg, '[^{INVISIBLE}]')),
        bare AS (SELECT *, CASE WHEN {_BARE} <> '' THEN {_BARE} ELSE regexp_replace(low, '[{INVISIBLE}]+', '', 'g') END AS t FROM low),
        ev AS (SELECT *, array_to_string([t[i] for i in range(1, length(t) + 1) if i = 1 OR t[i] <> t[i - 1] OR regexp_matches(t[i], '\\p{{Nd}}')], '') AS sq,
            regexp_replace(t, '[^\\p{{Nd}}]+', '', 'g') AS digits, length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS size FROM bare),
        pairs AS (SELECT *, lag(is_sender) OVER w AS ps, lag(t) OVER w AS pt, lag(sq) OVER w AS psq, lag(digits) OVER w AS pd, lag(size) OVER w AS pn
            FROM ev WINDOW w AS (PARTITION BY room_name ORDER BY us, row_id)),
        flagged AS (SELECT *, CASE WHEN ps = is_sender AND (t = pt OR (digits = pd AND (sq = psq OR (greatest(size, pn) >= 8
            AND ({_one_slip("t", "pt")} OR {_one_slip("sq", "psq")}))))) THEN 0 ELSE 1 END AS brk FROM pairs),
        grouped AS (SELECT *, sum(brk) OVER (PARTITION BY room_name ORDER BY us, row_id ROWS UNBOUNDED PRECEDING) AS g FROM flagged)
        SELECT arg_min(row_id, (us, row_id)) AS first_row_id, arg_max(row_id, (us, row_id)) AS last_row_id, count(*) AS n_events,
            max(us) // 1000000 - min(us) // 1000000 AS duration_s
        FROM grouped GROUP BY room_name, g HAVING count(*) >= 2""",
    "p6_found": f"""{SHOWN} SELECT room_name, arg_min(row_id, pos) AS first_row_id, arg_max(row_id, pos) AS last_row_id,
            count(*) AS n_msgs, CAST(sum(turn) AS BIGINT) AS n_turns
        FROM shown GROUP BY room_name, g
        HAVING min(pos) FILTER (WHERE is_sender = 0) < max(pos) FILTER (WHERE is_sender = 1)""",
    "p6_messages": f"""{SHOWN}, kept AS (SELECT room_name AS kept_room, g AS kept_g, arg_min(row_id, pos) AS first_row_id FROM shown GROUP BY room_name, g
            HAVING min(pos) FILTER (WHERE is_sender = 0) < max(pos) FILTER (WHERE is_sender = 1))
        SELECT room_name, first_row_id, pos, row_id, CASE WHEN is_sender = 0 THEN 'user' ELSE 'assistant' END AS role, msg AS content
        FROM shown JOIN kept ON kept_room IS NOT DISTINCT FROM room_name AND kept_g = g""",
}
