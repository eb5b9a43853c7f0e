"""From message rows to question-answer dialogues: bursts, replies, context, packing.

Rooms are cut into time blocks throughout, so that one busy room is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloqua.functions import dialogue as D
from colloqua.operators.islands import blocked_islands
from colloqua.session import staged

BLOCK_SECONDS = 3600
#: Rows of a room that are one block of the context window, besides the rows before it that it looks back to.
BLOCK_ROWS = 1000
_US = 1_000_000


def _block(us: str = "us") -> Column:
    step = BLOCK_SECONDS * _US
    return F.expr(f"({us} - pmod({us}, {step})) div {step}")


def ordered_rows(df: DataFrame, room: str, side: str, text: str, at: str, seq: str) -> DataFrame:
    """``room, us, seq, side, msg`` of rows with a time."""
    return df.where(F.col(at).isNotNull()).select(
        F.col(room).alias("room"),
        F.unix_micros(F.col(at).cast("timestamp")).alias("us"),
        F.col(seq).alias("seq"),
        F.col(side).alias("side"),
        F.col(text).alias("msg"),
    )


def merge_bursts(rows: DataFrame, gap_seconds: float = 120, most: int = 2048) -> DataFrame:
    """A1: ``room, us, seq, side, msg, n_rows, end_us`` of each burst.

    Neighbours join if the side is the same, the pause is at most the gap and the
    two texts with a line break are at most ``most`` long; the burst's text is
    cut there. Other fields are the first row's.
    """
    gap = int(gap_seconds * _US)
    runs = blocked_islands(
        rows.withColumn("size", F.length("msg")),
        ["room"],
        ["us", "seq"],
        _block(),
        ["side", "size"],
        lambda p, c: (p["side"].eqNullSafe(c["side"])) & (c["us"] - p["us"] <= gap) & (p["size"] + 1 + c["size"] <= most),
        {
            "said": (F.collect_list(F.struct("us", "seq", "msg")), lambda c: F.flatten(F.collect_list(c))),
            "n_rows": (F.count("*"), F.sum),
        },
    )
    text = F.array_join(F.transform(F.array_sort("said"), lambda s: s["msg"]), "\n")
    return runs.select(
        "room", F.col("first.us").alias("us"), F.col("first.seq").alias("seq"), F.col("first.side").alias("side"),
        F.substring(text, 1, most).alias("msg"), "n_rows", F.col("last.us").alias("end_us"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__k``, the room as a key that is never null, and ``__blk``, the block of time.

    Windows and joins on a key that may be null don't share a partitioning; this one does.
    """
    return rows.withColumns({"__k": F.struct("room"), "__blk": _block()})


def _replied(keyed: DataFrame, window_seconds: float) -> DataFrame:
    """:func:`next_reply` of keyed rows, still partitioned by key and block."""
    reach = int(window_seconds * _US)
    step = BLOCK_SECONDS * _US
    back = -(-reach // step)
    here = F.col("__blk")
    blocks = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(back)), lambda k: here - k),
        lambda b: (b == here) | (F.col("us") - (b + 1) * step <= reach),
    )
    spread = keyed.withColumn("__to", F.explode(blocks)).withColumn("__own", F.col("__to") == here).drop("__blk").withColumnRenamed("__to", "__blk")
    w = Window.partitionBy("__k", "__blk").orderBy(F.col("us").desc(), F.col("seq").desc())
    answer = F.when(F.col("side") == 1, F.struct("us", "msg"))
    found = F.last(answer, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    out = spread.withColumn("__reply", found).where("__own").drop("__own")
    near = F.col("__reply.us") - F.col("us") <= reach
    return out.withColumns({"reply_us": F.when(near, F.col("__reply.us")), "reply": F.when(near, F.col("__reply.msg"))}).drop("__reply")


def next_reply(rows: DataFrame, window_seconds: float = 300) -> DataFrame:
    """``rows`` with ``reply_us, reply``: the first later row of side 1 within the window, else null.

    A row stands in its block and, if it comes within the window of the block's
    start, as a look-ahead in the block before; time is descending, so that the
    nearest follower is a running value.
    """
    return _replied(_keyed(rows), window_seconds).drop("__k", "__blk")


def _numbered(keyed: DataFrame, rows: DataFrame, to: str) -> DataFrame:
    """Keyed rows numbered from 1 in their room: place in the block plus the rows of earlier blocks, counted in ``rows``."""
    w = Window.partitionBy("__k").orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    counts = _keyed(rows.select("room", "us")).groupBy("__k", "__blk").agg(F.count("*").alias("__n"))
    before = counts.select(
        F.col("__k").alias("__r"), F.col("__blk").alias("__b"), F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before")
    )
    own = F.row_number().over(Window.partitionBy("__k", "__blk").orderBy("us", "seq"))
    placed = keyed.withColumn("__own", own)
    joined = placed.join(before, (placed["__k"] == before["__r"]) & (placed["__blk"] == before["__b"]))
    return joined.withColumn(to, F.col("__before") + F.col("__own")).drop("__own", "__r", "__b", "__before")


def row_numbers(rows: DataFrame, to: str = "idx") -> DataFrame:
    """``rows`` numbered from 1 in their room by time: place in the block plus the rows of earlier blocks."""
    return _numbered(_keyed(rows), rows, to).drop("__k", "__blk")


def _with_context(numbered: DataFrame, n: int, wanted: Column) -> DataFrame:
    """The ``wanted`` ones of numbered rows with ``context``, the ``n`` rows before.

    A room's rows are cut into blocks of ``BLOCK_ROWS``, whatever their times; the
    last ``n`` of a block stand in the next one too.
    """
    last = (F.col("__idx") - 1 + n) / F.lit(BLOCK_ROWS)
    first = F.floor((F.col("__idx") - 1) / F.lit(BLOCK_ROWS)).cast("long")
    spread = numbered.withColumn("__first", first).withColumn("__to", F.explode(F.sequence("__first", F.floor(last).cast("long"))))
    w = Window.partitionBy("__k", "__to").orderBy("__idx").rowsBetween(-n, -1)
    context = F.collect_list(F.struct("us", "seq", "side", "msg")).over(w)
    return spread.withColumn("context", context).where((F.col("__to") == F.col("__first")) & wanted).drop("__first", "__to")


def previous_rows(rows: DataFrame, n: int = 10) -> DataFrame:
    """``rows`` with ``context``: up to ``n`` earlier rows of the room, oldest first."""
    rows = staged(rows, "rows")  # read twice: whole, and for the numbers of rows
    numbered = _numbered(_keyed(rows), rows, "__idx")
    return _with_context(numbered, n, F.lit(True)).drop("__k", "__blk", "__idx")


def build_dialogues(
    bursts: DataFrame, window_seconds: float = 300, limit: int = 2048, n_context: int = 10, prompt: str = "*"
) -> DataFrame:
    """``room, us, seq, messages`` of each valid dialogue: context, user row, first reply in the window.

    The context takes its oldest messages within half the limit (W3). A dialogue
    that isn't valid is dropped; one that is too long is reduced (fn14) and has
    to be valid still.

    Plan: bursts are written once. One exchange by room and block of time serves
    replies and numbers, a second one by room and block of rows the context,
    which only rows with a reply take along.
    """
    rows = staged(bursts.select("room", "us", F.col("seq").cast("long").alias("seq"), F.col("side").cast("int").alias("side"), "msg"), "bursts")
    replied = _replied(_keyed(rows), window_seconds)
    asks = (F.col("side") != 1) & F.col("reply").isNotNull()
    replied = replied.withColumn("reply", F.when(asks, F.col("reply"))).drop("reply_us")
    asked = _with_context(_numbered(replied, rows, "__idx"), n_context, asks)
    role = lambda m: F.when(m["side"] == 1, "assistant").otherwise("user")
    context = F.transform("context", lambda m: D.message(role(m), m["msg"]))
    budget = D.budget_prefix(context, F.lit(limit // 2))
    ends = F.array(D.message(F.lit("user"), F.col("msg")), D.message(F.lit("assistant"), F.col("reply")))
    packed = evaluated_once(asked, "messages", D.with_system(F.concat(budget, ends), prompt), ["room", "us", "seq"])
    valid = packed.where(D.is_valid_dialogue(F.col("messages")))
    fit = F.when(D.total_length(F.col("messages")) <= limit, F.col("messages")).otherwise(
        D.greedy_reduce(F.col("messages"), F.lit(limit))
    )
    return evaluated_once(valid, "messages", fit, ["room", "us", "seq"]).where(D.is_valid_dialogue(F.col("messages")))


def evaluated_once(df: DataFrame, name: str, value: Column, keep: list[str]) -> DataFrame:
    """``keep`` and ``value``, evaluated once a row.

    As the output of a generator it isn't put in again wherever a later filter
    names it, which for nested array expressions would multiply the work.
    """
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def split_conversations(rows: DataFrame) -> DataFrame:
    """A4: ``room, start_us, start_seq, end_us, n, roles`` of conversations of two rows or more.

    A conversation begins at a user row whose predecessor is an assistant row.
    """
    roles = F.array_join(F.transform("said", lambda s: F.when(s["side"] == 1, "a").otherwise("u")), "")
    return conversations(rows.withColumn("msg", F.lit(None).cast("string"))).where("n >= 2").select(
        "room", F.col("us").alias("start_us"), F.col("seq").alias("start_seq"), "end_us", "n", roles.alias("roles")
    )


def conversations(rows: DataFrame) -> DataFrame:
    """A4: ``room, us, seq, end_us, n, said`` of each conversation, ``said`` with ``us, seq, side, msg`` of its rows in order."""
    runs = blocked_islands(
        rows, ["room"], ["us", "seq"], _block(), ["side"],
        lambda p, c: (F.coalesce(p["side"], F.lit(0)) != 1) | (c["side"] == 1),
        {
            "said": (F.collect_list(F.struct("us", "seq", "side", "msg")), lambda c: F.flatten(F.collect_list(c))),
            "n": (F.count("*"), F.sum),
        },
    )
    return runs.select("room", F.col("first.us").alias("us"), F.col("first.seq").alias("seq"), F.col("last.us").alias("end_us"), "n", F.array_sort("said").alias("said"))
