"""Rebuilding conversations from message rows with keyed streaming state.

The state is keyed by a bucket of rooms and a time block, so that a hot room is
spread over its blocks and small rooms share a key. Rows that arrive, late ones
included, are appended to the list in their key's state. Timers on the event-time
watermark, one for each gap's length of time at most, look through it: stretches
of talk whose end the watermark has passed by the gap are cut out and emitted, as
a validated conversation if they lie inside their block, else as an edge piece,
and what is still open goes on. Edge pieces, at most two a room and block and a
few numbers each, are put together across blocks when the output is read.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from colloqua.functions.blanks import has_visible
from colloqua.session import shared_path

#: Length of a time block; many gaps long, so that most conversations lie inside one.
BLOCK_SECONDS = 6 * 3600
#: Keys a block's rooms are spread over in a live stream, unless given; kept with a stream from its first start on.
BUCKETS = 16
#: Rows a key of a finite table has on average, which its number of buckets is made for.
ROWS_A_KEY = 2000
_CLOSING = -1  # the bucket of the row that closes a finite input; no room has it
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SAID = "array<struct<us:bigint,id:bigint,side:int,text:string>>"
PIECE = (
    "room string, first_us long, last_us long, edge boolean, sound boolean, n_msgs long, n_turns long, "
    "first_id long, last_id long, first_side int, last_side int, asked boolean, replied boolean, answered boolean, "
    f"said {SAID}"
)
ROW = "room string, bucket int, at timestamp, us long, id long, side int, sound boolean, visible boolean, text string"


def message_rows(
    df: DataFrame,
    room: str = "room_name",
    side: str = "is_sender",
    talker: str = "talker",
    text: str = "msg",
    at: str = "create_time",
    tie: str = "row_id",
    with_text: bool = False,
) -> DataFrame:
    """The columns the state needs. Rows without time are left out.

    ``sound``: the side is 0 or 1 and the talker isn't blank. ``bucket`` is a hash
    of the room. The text comes along only where it is asked for.
    """
    return df.where(F.col(at).isNotNull()).select(
        F.col(room).cast("string").alias("room"),
        F.pmod(F.xxhash64(F.col(room).cast("string")), F.lit(1 << 30)).cast("int").alias("bucket"),
        F.col(at).cast("timestamp").alias("at"),
        F.unix_micros(F.col(at).cast("timestamp")).alias("us"),
        F.col(tie).cast("long").alias("id"),
        F.col(side).cast("int").alias("side"),
        (F.coalesce(F.col(side).isin(0, 1), F.lit(False)) & has_visible(F.col(talker))).alias("sound"),
        has_visible(F.col(text)).alias("visible"),
        (F.when(has_visible(F.col(text)), F.col(text)) if with_text else F.lit(None).cast("string")).alias("text"),
    )


def stored_buckets(spark: SparkSession, checkpoint: str, wanted: int = BUCKETS) -> int:
    """The number of buckets of the stream with this checkpoint: as it began, else as wanted.

    A room's key mustn't change while its rows are in state, so the number is kept
    beside the checkpoint, whatever the session's settings are at a restart.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}-buckets")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.exists(path):
        return int(spark.read.text(str(path)).first()[0])
    out = store.create(path, False)
    out.write(bytearray(str(wanted).encode()))
    out.close()
    return wanted


def piece(us: np.ndarray, ids: list, side: np.ndarray, sound: np.ndarray, visible: np.ndarray) -> tuple:
    """The PIECE fields from ``sound`` to ``answered`` of rows in order."""
    side, shown = side[visible], np.flatnonzero(visible)
    n = len(shown)
    if not n:
        return bool(sound.all()), 0, 0, None, None, None, None, False, False, False
    users, replies = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    answered = bool(len(users) and len(replies) and users[0] < replies[-1])
    turns = 1 + int((side[1:] != side[:-1]).sum())
    return (
        bool(sound.all()), n, turns, ids[shown[0]], ids[shown[-1]], int(side[0]), int(side[-1]),
        bool(len(users)), bool(len(replies)), answered,
    )


#: Columns of the numbers in state: place of the room, us, whether there is an id, id, side, sound, visible.
_ROOM, _US, _HAS, _ID, _SIDE, _SOUND, _VISIBLE = range(7)


class _Chunk:
    """Rows in state: names of rooms, numbers by the columns above, and texts or None."""

    def __init__(self, rooms: list, data: np.ndarray, texts: np.ndarray | None) -> None:
        self.rooms, self.data, self.texts = rooms, data, texts

    @classmethod
    def of(cls, frame: pd.DataFrame) -> _Chunk:
        codes, rooms = pd.factorize(frame["room"], use_na_sentinel=False)
        ids = frame["id"]
        data = np.column_stack([
            codes, frame["us"], ids.notna(), pd.array(ids, dtype="Int64").fillna(0), frame["side"].fillna(-9), frame["sound"], frame["visible"],
        ]).astype(np.int64)
        texts = frame["text"].to_numpy(object) if frame["text"].notna().any() else None
        return cls([None if pd.isna(r) else r for r in rooms], data, texts)

    @classmethod
    def joined(cls, chunks: list[_Chunk]) -> _Chunk:
        if len(chunks) == 1:
            return chunks[0]
        rooms = list(dict.fromkeys(r for c in chunks for r in c.rooms))
        place = {r: i for i, r in enumerate(rooms)}
        data = np.concatenate([c.data for c in chunks])
        data[:, _ROOM] = np.concatenate([np.array([place[r] for r in c.rooms])[c.data[:, _ROOM]] for c in chunks])
        texts = None
        if any(c.texts is not None for c in chunks):
            texts = np.concatenate([np.full(len(c.data), None, dtype=object) if c.texts is None else c.texts for c in chunks])
        return cls(rooms, data, texts)

    def taken(self, rows: np.ndarray) -> _Chunk:
        return _Chunk(self.rooms, self.data[rows], None if self.texts is None else self.texts[rows])

    def packed(self) -> bytes:
        return pickle.dumps((self.rooms, self.data, self.texts), protocol=5)

    @classmethod
    def unpacked(cls, data: bytes) -> _Chunk:
        return cls(*pickle.loads(data))


def _cut(block: int, chunk: _Chunk, gap_us: int, block_us: int, watermark_us: int) -> tuple[list[tuple], _Chunk | None]:
    """Pieces whose end the watermark has passed by the gap, and the rows that stay."""
    d = chunk.data
    order = np.lexsort((d[:, _ID], d[:, _HAS], d[:, _US], d[:, _ROOM]))
    d = d[order]
    apart = (np.diff(d[:, _US]) > gap_us) | (np.diff(d[:, _ROOM]) != 0)
    starts = np.concatenate(([0], np.flatnonzero(apart) + 1, [len(d)]))
    low, high = block * block_us, (block + 1) * block_us
    out, stay = [], []
    for a, b in zip(starts[:-1], starts[1:]):
        rows = d[a:b]
        first, last = int(rows[0, _US]), int(rows[-1, _US])
        if last + gap_us >= watermark_us:
            stay.append(order[a:b])
            continue
        edge = first - low <= gap_us or high - last <= gap_us
        ids = [int(i) if has else None for i, has in zip(rows[:, _ID].tolist(), rows[:, _HAS].tolist())]
        visible = rows[:, _VISIBLE] == 1
        fields = piece(rows[:, _US], ids, rows[:, _SIDE], rows[:, _SOUND] == 1, visible)
        if edge or (fields[0] and fields[-1]):
            said = None
            if chunk.texts is not None:
                shown = np.flatnonzero(visible).tolist()
                texts = chunk.texts[order[a:b]]
                said = [(int(rows[i, _US]), ids[i], int(rows[i, _SIDE]), texts[i]) for i in shown]
            out.append((chunk.rooms[rows[0, _ROOM]], first, last, edge, *fields, said))
    return out, chunk.taken(np.concatenate(stay)) if stay else None


class _Rebuild(StatefulProcessor):
    def __init__(self, gap_us: int, block_us: int) -> None:
        self.gap_us, self.block_us = gap_us, block_us
        self.names = [f.split()[0] for f in PIECE.split(", ")]

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "chunk binary")

    def _wake(self, last_us: int, watermark_ms: int) -> None:
        """A timer for the end of the last stretch, on a grid of gaps, so that a key is looked through a few times only."""
        gap_ms = max(self.gap_us // 1000, 1)
        due = (max((last_us + self.gap_us) // 1000, watermark_ms) // gap_ms + 1) * gap_ms
        self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if key[0] != _CLOSING and frames:
            chunk = _Chunk.of(frames[0] if len(frames) == 1 else pd.concat(frames))
            self.rows.appendValue((chunk.packed(),))
            self._wake(int(chunk.data[:, _US].max()), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        chunks = [_Chunk.unpacked(bytes(row[0])) for row in self.rows.get()]
        if not chunks:
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        done, stay = _cut(key[1], _Chunk.joined(chunks), self.gap_us, self.block_us, watermark * 1000)
        if done:
            if stay is None:
                self.rows.clear()
            else:
                self.rows.put([(stay.packed(),)])
                self._wake(int(stay.data[:, _US].max()), watermark)
            frame = pd.DataFrame(done, columns=self.names).astype(object)
            yield frame.where(frame.notna(), None)
        elif stay is None:
            self.rows.clear()


def stream_conversations(
    rows: DataFrame, gap_seconds: int = 3600, delay: str = "0 seconds", block_seconds: int = BLOCK_SECONDS, buckets: int = BUCKETS
) -> DataFrame:
    """PIECE rows of a stream of :func:`message_rows`; ``delay`` is how late a row may come.

    Needs the state store of RocksDB, see :func:`with_rocksdb`. ``buckets`` has to
    be the same over restarts, see :func:`stored_buckets`.
    """
    block_us = block_seconds * 1_000_000
    # The processor is also started on the driver, in a process that hasn't got the shipped package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return (
        rows.withWatermark("at", delay)
        .withColumn("bucket", F.when(F.col("bucket") == _CLOSING, F.col("bucket")).otherwise(F.col("bucket") % buckets))
        .withColumn("block", F.floor(F.col("us") / F.lit(float(block_us))).cast("long"))
        .groupBy("bucket", "block")
        .transformWithStateInPandas(_Rebuild(gap_seconds * 1_000_000, block_us), PIECE, "Append", "EventTime")
    )


def with_rocksdb(spark: SparkSession) -> SparkSession:
    """A session of its own with RocksDB as state store, so that the caller's settings stay as they are."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return own


def _near(gap_seconds: int, w) -> Column:
    return F.col("first_us") - F.lag("last_us").over(w) <= gap_seconds * 1_000_000


def _members(pieces: DataFrame, gap_seconds: int) -> tuple[DataFrame, DataFrame]:
    """(edge pieces without texts, with ``__g``, what they belong to, and ``before``: the messages before them; conversations of them)."""
    edges = pieces.where("edge").drop("said", "edge")
    w = Window.partitionBy("room").orderBy("first_us", "last_us")
    edges = edges.withColumn("__brk", F.when(_near(gap_seconds, w), 0).otherwise(1))
    edges = edges.withColumn("__g", F.sum("__brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy("room", "__g").orderBy("first_us", "last_us").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumns({
        "__side": F.last("last_side", ignorenulls=True).over(before),
        "__asked": F.coalesce(F.max("asked").over(before), F.lit(False)),
        "before": F.coalesce(F.sum("n_msgs").over(before), F.lit(0)),
    })
    at = F.struct("first_us", "last_us")
    seen: Column = F.col("n_msgs") > 0
    whole = edges.groupBy("room", "__g").agg(
        F.min_by("first_id", F.when(seen, at)).alias("first_id"),
        F.max_by("last_id", F.when(seen, at)).alias("last_id"),
        F.sum("n_msgs").alias("n_msgs"),
        F.sum(F.col("n_turns") - F.when(F.col("__side") == F.col("first_side"), 1).otherwise(0)).alias("n_turns"),
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.min("sound").alias("__sound"),
        F.max(F.col("answered") | (F.col("__asked") & F.col("replied"))).alias("__answered"),
    )
    return edges, whole.where(F.col("__sound") & F.col("__answered")).drop("__sound", "__answered")


def join_pieces(pieces: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """Conversations from PIECE rows: inner ones as they are, edges put together across blocks."""
    columns = ["room", "first_id", "last_id", "n_msgs", "n_turns", "first_us", "last_us"]
    _, whole = _members(pieces, gap_seconds)
    return pieces.where(~F.col("edge")).select(*columns).unionByName(whole.select(*columns))


def join_messages(pieces: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """``room, first_us, first_id, pos, us, id, role, text`` of each visible message of the conversations, ``pos`` from 1.

    One row a message, so that a conversation of any length is never one row. What
    is put together across blocks are numbers; texts are joined to them by piece.
    """
    edges, whole = _members(pieces, gap_seconds)
    of = whole.select(F.col("room").alias("__r"), F.col("__g").alias("__h"), F.col("first_us").alias("__from"), F.col("first_id").alias("__first"))
    placed = edges.join(of, edges["room"].eqNullSafe(of["__r"]) & (edges["__g"] == of["__h"])).select(
        F.col("room").alias("__room"), F.col("first_us").alias("__us"), "before", "__from", "__first"
    )
    own = pieces.where("edge").select("room", "first_us", "said")
    own = own.join(placed, own["room"].eqNullSafe(placed["__room"]) & (own["first_us"] == placed["__us"])).select(
        "room", F.col("__from").alias("first_us"), F.col("__first").alias("first_id"), "before", "said"
    )
    inner = pieces.where(~F.col("edge")).select("room", "first_us", "first_id", F.lit(0).cast("long").alias("before"), "said")
    said = inner.unionByName(own).select("room", "first_us", "first_id", "before", F.posexplode("said").alias("__k", "m"))
    return said.select(
        "room", "first_us", "first_id", (F.col("before") + F.col("__k") + 1).alias("pos"), "m.us", "m.id",
        F.when(F.col("m.side") == 0, "user").otherwise("assistant").alias("role"), "m.text",
    )


def _pieces(df: DataFrame, gap_seconds: int, block_seconds: int, with_text: bool, **names) -> DataFrame:
    """PIECE rows of a finite table, run through the stream."""
    spark = df.sparkSession
    base = shared_path(spark, "conversations")
    message_rows(df, with_text=with_text, **names).write.parquet(f"{base}/rows")
    rows = spark.read.schema(ROW).parquet(f"{base}/rows")
    later = F.max("at") + F.expr(f"INTERVAL {2 * gap_seconds + 86400} SECONDS")
    size = rows.agg(F.count("*"), F.approx_count_distinct(F.floor(F.col("us") / F.lit(float(block_seconds * 1_000_000))))).first()
    buckets = min(max(size[0] // (max(size[1], 1) * ROWS_A_KEY), 4), 4096)
    end = rows.agg(later.alias("at"), F.lit(_CLOSING).alias("bucket"), F.lit(0).cast("long").alias("us")).where("at IS NOT NULL")
    rows.limit(0).unionByName(end, allowMissingColumns=True).write.mode("append").parquet(f"{base}/rows")
    own = with_rocksdb(spark)
    query = (
        stream_conversations(own.readStream.schema(ROW).parquet(f"{base}/rows"), gap_seconds, block_seconds=block_seconds, buckets=buckets)
        .writeStream.format("parquet")
        .option("path", f"{base}/pieces")
        .option("checkpointLocation", f"{base}/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(PIECE).parquet(f"{base}/pieces")


def rebuild_conversations(df: DataFrame, gap_seconds: int = 3600, block_seconds: int = BLOCK_SECONDS, **names) -> DataFrame:
    """``room, first_id, last_id, n_msgs, n_turns, first_us, last_us`` of each sound conversation.

    In each room, by time and tie, a conversation ends where the next row comes
    more than ``gap_seconds`` later. It stays if all its rows have side 0 or 1 and
    a talker that isn't blank, and if among its rows with something visible one of
    side 0 (user) comes before one of side 1 (assistant). The columns describe the
    visible rows; n_turns counts runs of one side.

    Rows without time are left out; a null room is a room; ties are ordered by
    ``tie``, a null one first and given as null; repeated rows count each; very
    long texts are kept whole; other columns are ignored. An empty table gives an
    empty result.

    A finite table is run through the stream as one micro-batch, for which no
    watermark stands yet, so that no row is late, together with one row, in a
    bucket of its own, that is later than all others; the batch after it sees the
    watermark that row sets, and every timer expires. State is kept by RocksDB,
    outside the heap; input, checkpoint and output lie in the shared folder, so
    that executors may be lost. A live stream is :func:`stream_conversations`.
    """
    return join_pieces(_pieces(df, gap_seconds, block_seconds, False, **names), gap_seconds)


def rebuild_messages(df: DataFrame, gap_seconds: int = 3600, block_seconds: int = BLOCK_SECONDS, **names) -> DataFrame:
    """The messages of :func:`rebuild_conversations` in order and with their roles; columns as of :func:`join_messages`."""
    return join_messages(_pieces(df, gap_seconds, block_seconds, True, **names), gap_seconds)
