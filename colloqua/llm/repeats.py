"""Repeated consecutive events in sequences: each run becomes one event with count and duration."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloqua.functions.blanks import INVISIBLE, has_visible
from colloqua.operators.islands import blocked_islands

#: Time block of a sequence; neighbours across blocks are compared through the blocks' ends.
BLOCK_SECONDS = 3600


def width_table() -> tuple[str, str]:
    """Full- and half-width forms with one plain counterpart, made from the Unicode data."""
    pairs = []
    for code in range(0xFF00, 0xFFF0):
        plain = unicodedata.normalize("NFKC", chr(code))
        if unicodedata.east_asian_width(chr(code)) in "FH" and len(plain) == 1 and plain != chr(code):
            pairs.append((chr(code), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def comparable(text: Column) -> Column:
    """Text without width, case, blanks and punctuation; a text of punctuation only keeps it."""
    wide, plain = width_table()
    folded = F.lower(F.translate(text, wide, plain))
    bare = F.regexp_replace(folded, rf"[\p{{P}}\p{{Sm}}\p{{Sk}}{INVISIBLE}]+", "")
    return F.when(F.length(bare) > 0, bare).otherwise(F.regexp_replace(folded, f"[{INVISIBLE}]+", ""))


def squeezed(text: Column) -> Column:
    """A character drawn out counts once; digits stay."""
    return F.regexp_replace(text, r"([^\p{Nd}])\1+", "$1")


def near_same(a: Column, b: Column, least: int = 8) -> Column:
    """Whether two comparable texts are one message: equal, drawn out, or one slip of a letter apart.

    A slip (one letter put in, left out or changed) counts if one of the texts has
    ``least`` letters and digits; other digits always make another message.
    """
    digits = lambda c: F.regexp_replace(c, r"\P{Nd}+", "")
    size = lambda c: F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))
    close = F.abs(F.length(squeezed(a)) - F.length(squeezed(b))) <= 1
    slip = (F.levenshtein(a, b, 1) >= 0) & (F.levenshtein(a, b, 1) <= 1)
    slip |= close & (F.levenshtein(squeezed(a), squeezed(b), 1) >= 0)
    return (a == b) | (
        (digits(a) == digits(b))
        & ((squeezed(a) == squeezed(b)) | ((F.greatest(size(a), size(b)) >= least) & slip))
    )


def collapse_repeats(
    df: DataFrame,
    sequence: str = "room_name",
    side: str = "is_sender",
    text: str = "msg",
    at: str = "create_time",
    tie: str = "row_id",
) -> DataFrame:
    """``sequence, side, first_row_id, last_row_id, n_events, first_us, last_us`` of each run.

    A run is a longest stretch of neighbours, by ``at`` and ``tie`` in one
    ``sequence``, each of which repeats its predecessor: the same non-null side
    and nearly the same text (:func:`near_same`). Rows without time or without
    anything visible in the text are left out. A null sequence is one sequence;
    rows with a null side are runs of their own. A run of one has n_events 1.

    Plan: lag and running sum over (sequence, hour), then over the hours' first
    and last runs only (:func:`colloqua.operators.islands.blocked_islands`), so
    a sequence with a third of all rows is spread over its hours.
    """
    rows = df.where(F.col(at).isNotNull() & has_visible(F.col(text))).select(
        F.col(sequence).alias("__seq"),
        F.unix_micros(F.col(at).cast("timestamp")).alias("us"),
        F.col(tie).alias("id"),
        F.col(side).alias("side"),
        comparable(F.col(text)).alias("text"),
    )
    block = F.expr(f"(us - pmod(us, {BLOCK_SECONDS * 1_000_000})) div {BLOCK_SECONDS * 1_000_000}")
    runs = blocked_islands(
        rows,
        ["__seq"],
        ["us", "id"],
        block,
        ["side", "text"],
        lambda p, c: (p["side"] == c["side"]) & near_same(p["text"], c["text"]),
        {"n_events": (F.count("*"), F.sum)},
    )
    return runs.select(
        F.col("__seq").alias(sequence),
        F.col("first.side").alias(side),
        F.col("first.id").alias("first_row_id"),
        F.col("last.id").alias("last_row_id"),
        "n_events",
        F.col("first.us").alias("first_us"),
        F.col("last.us").alias("last_us"),
    )
