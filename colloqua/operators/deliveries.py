"""Messages delivered more than once: keep exactly one copy of each.

Rows are deliveries of one message if room, identifier (without surrounding
blanks) and text are equal, a null text being equal to a null text. A null or
blank identifier identifies nothing, so such rows are all kept.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloqua.functions.blanks import has_visible, strip_blanks


def delivery_key(msg_svr_id: Column) -> Column:
    """The identifier without surrounding blanks; null if it identifies nothing."""
    return F.when(has_visible(msg_svr_id), strip_blanks(msg_svr_id))


def text_identity(text: Column) -> Column:
    """A text for comparison in at most 65 bytes: itself, or a mark and its SHA-256 where it is longer than 64; null stays null."""
    return F.when(F.octet_length(text) > 64, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def keep_first_delivery(
    df: DataFrame,
    room: str = "room_name",
    ident: str = "msg_svr_id",
    text: str = "msg",
    arrival: str = "create_time",
    tie: str = "row_id",
) -> DataFrame:
    """One row of each delivered message: earliest ``arrival`` (null last), then smallest ``tie``.

    Plan: one window partitioned by the message identity and ranked by arrival,
    of which only rank 1 is asked for. Spark turns that into a group limit that
    runs before the exchange, so a message that makes up a third of the table
    leaves each map task as a single row: a hot identifier needs no salt. Rows
    without identifier get a number of their own as identity, which spreads them.

    Nulls: a null room equals a null room, a null text a null text; a null tie
    sorts first. Repeated rows are deliveries like others. An empty table gives
    an empty table. Extra columns pass through; helper columns are named
    ``__dlv_*`` and dropped.
    """
    keyed = df.withColumn("__dlv_key", delivery_key(F.col(ident))).withColumn(
        "__dlv_alone", F.when(F.col("__dlv_key").isNull(), F.monotonically_increasing_id())
    )
    order = Window.partitionBy(room, "__dlv_key", text, "__dlv_alone").orderBy(
        F.col(arrival).asc_nulls_last(), F.col(tie).asc_nulls_first()
    )
    return (
        keyed.withColumn("__dlv_rank", F.row_number().over(order))
        .where("__dlv_rank = 1")
        .drop("__dlv_key", "__dlv_alone", "__dlv_rank")
    )


def surplus_deliveries(df: DataFrame, tie: str = "row_id", **names: str) -> DataFrame:
    """Rows of ``df`` that :func:`keep_first_delivery` doesn't keep.

    The kept rows' keys are anti-joined with all rows on the unique row key,
    which no hot message can skew. ``tie`` has to be unique; rows sharing a
    ``tie`` count as one row.
    """
    needed = {names.get(k, d) for k, d in
              (("room", "room_name"), ("ident", "msg_svr_id"), ("text", "msg"), ("arrival", "create_time"))}
    # Only keys are ranked and moved, so that a long text goes as its hash.
    text = names.get("text", "msg")
    keys = df.select(tie, *sorted(needed)).withColumn(text, text_identity(F.col(text)))
    kept = keep_first_delivery(keys, tie=tie, **names)
    kept = kept.select(F.col(tie).alias("__kept"))
    return df.join(kept, df[tie].eqNullSafe(kept["__kept"]), "left_anti")


def new_deliveries(
    batch: DataFrame,
    stored: DataFrame,
    room: str = "room_name",
    ident: str = "msg_svr_id",
    text: str = "msg",
    **names: str,
) -> DataFrame:
    """First deliveries in ``batch`` of messages that ``stored`` doesn't hold yet.

    For batches that arrive one after the other: the batch is reduced first, then
    anti-joined with the stored identifiers, of which only the key columns are read.
    """
    first = keep_first_delivery(batch, room=room, ident=ident, text=text, **names)
    first = first.withColumns({"__new_key": delivery_key(F.col(ident)), "__new_text": text_identity(F.col(text))})
    known = (
        stored.select(
            F.col(room).alias("__st_room"),
            delivery_key(F.col(ident)).alias("__st_key"),
            text_identity(F.col(text)).alias("__st_text"),
        )
        .where(F.col("__st_key").isNotNull())
        .distinct()
    )
    same = functools.reduce(
        Column.__and__,
        [
            first["__new_key"] == known["__st_key"],
            first[room].eqNullSafe(known["__st_room"]),
            first["__new_text"].eqNullSafe(known["__st_text"]),
        ],
    )
    return first.join(known, same, "left_anti").drop("__new_key", "__new_text")
