"""Activity sessions by occupancy bitmaps.

Each entity's events set bits, one for each second. Inside a block of seconds a
morphological closing with a structuring element as long as the gap, made of
doubling shifts, fills every pause that doesn't end a session; the runs of set
bits are the sessions. Event counts are joined to the runs, and runs are trimmed
to their first and last event. Runs that meet at block edges, or whose pause is
within a second of the gap, are settled by an exact comparison in microseconds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloqua.functions.blanks import has_visible

#: Seconds of a block; its bitmap takes 8 kB.
BLOCK_SECONDS = 1 << 16
#: Ticks whose blocks share a bitmap; sparse blocks take some 2 kB of it, the rest grows with the ticks.
STEP_ROWS = 1 << 12


def close_bitmap(bits: int, reach: int) -> int:
    """Morphological closing: pauses of at most ``reach`` empty positions are filled."""
    grown, done = bits, 1
    while done <= reach:
        step = min(done, reach + 1 - done)
        grown |= grown << step
        done += step
    shrunk, done = grown, 1
    while done <= reach:
        step = min(done, reach + 1 - done)
        shrunk &= shrunk >> step
        done += step
    return shrunk


def bitmap_runs(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of the runs of set bits."""
    raw = np.frombuffer(bits.to_bytes(bits.bit_length() // 8 + 1, "little"), dtype=np.uint8)
    flags = np.unpackbits(raw, bitorder="little").view(np.int8)
    edges = np.flatnonzero(np.diff(flags, prepend=np.int8(0), append=np.int8(0)))
    return edges[::2], edges[1::2] - 1


def occupancy(positions: np.ndarray, size: int) -> int:
    flags = np.zeros(size, dtype=np.uint8)
    flags[positions] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def block_runs(block: np.ndarray, second: np.ndarray, count: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """Places of the first and last tick of each run, and its events.

    Ticks are sorted by block and second. The blocks' stretches lie one after the
    other in one bitmap, with more room between them than the closing fills.
    """
    starts = np.flatnonzero(np.diff(block, prepend=block[:1] - 1))
    base = np.repeat(second[starts], np.diff(np.append(starts, len(block))))
    ends = np.append(starts[1:], len(block)) - 1
    width = second[ends] - second[starts] + 1 + reach + 2
    origin = np.concatenate(([0], np.cumsum(width)))
    at = np.repeat(origin[:-1], np.diff(np.append(starts, len(block)))) + second - base
    first, last = bitmap_runs(close_bitmap(occupancy(at, int(origin[-1])), reach))
    low, high = np.searchsorted(at, first), np.searchsorted(at, last)
    total = np.concatenate(([0], np.cumsum(count)))
    return low, high, total[high + 1] - total[low]


def sessions(
    df: DataFrame, entity: str = "talker", at: str = "create_time", gap_seconds: int = 1800
) -> DataFrame:
    """``entity, start_us, end_us, n_events`` of each session.

    A session is a longest run of an entity's events in which none comes more
    than ``gap_seconds`` after the one before.

    Plan: events are counted for each (entity, second) with map-side combine, so
    a hot entity is spread over its seconds; a block gathers at most
    ``BLOCK_SECONDS`` of those counts; the window that joins runs across blocks
    sees at most time span / gap rows of an entity, whatever its events.

    Rows with a null time or a null or blank entity are left out. Ties and
    repeated rows count as events. Empty tables give an empty result. Extra
    columns are ignored.
    """
    if gap_seconds < 1:
        raise ValueError("gap_seconds must be at least 1")
    # Seconds that differ by up to the gap less one are surely joined. For a gap of one second that's none,
    # so positions are two apart there and neighbouring bits don't touch.
    gap_us, reach, apart = gap_seconds * 1_000_000, max(0, gap_seconds - 2), 2 if gap_seconds == 1 else 1
    events = df.where(F.col(at).isNotNull() & has_visible(F.col(entity))).select(
        F.col(entity).alias("__e"), F.unix_micros(F.col(at).cast("timestamp")).alias("__us")
    )
    ticks = (
        events.withColumn("__s", F.expr("(__us - pmod(__us, 1000000)) div 1000000"))
        .groupBy("__e", "__s")
        .agg(F.count("*").alias("__n"), F.min("__us").alias("__lo"), F.max("__us").alias("__hi"))
    )
    ticks = ticks.withColumn("__b", F.expr(f"(__s - pmod(__s, {BLOCK_SECONDS})) div {BLOCK_SECONDS}"))
    columns = ["__e", "__b", "__s", "__n", "__lo", "__hi"]
    # A number given isn't coalesced: the tasks are bound by Python's work, not by bytes.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ticks = ticks.select(*columns).repartition(tasks, "__e", "__b").sortWithinPartitions("__e", "__b", "__s")

    def found(rows: pa.Table) -> pa.RecordBatch:
        entity_code = rows.column(0).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        block, second, count, lo, hi = (rows.column(i).to_numpy() for i in range(1, 6))
        changes = (np.diff(entity_code) != 0) | (np.diff(block) != 0)
        place = np.concatenate(([0], np.cumsum(changes)))
        low, high, events = block_runs(place, second * apart, count, reach)
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(low)).combine_chunks(), *map(pa.array, (second[low], lo[low], hi[high], events))],
            names=["__e", "s", "lo", "hi", "n"],
        )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks come one after the other; the last of a batch may go on in the next and waits for it.
        waiting: pa.Table | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                rows = pa.Table.from_batches([batch.slice(at, STEP_ROWS)])
                rows = rows if waiting is None else pa.concat_tables([waiting, rows])
                last = rows.slice(rows.num_rows - 1)
                same = pc.and_(pc.equal(rows.column(0), last.column(0)[0]), pc.equal(rows.column(1), last.column(1)[0]))
                whole = rows.num_rows - pc.sum(same).as_py()
                if whole:
                    yield found(rows.slice(0, whole))
                waiting = rows.slice(whole)
        if waiting is not None and waiting.num_rows:
            yield found(waiting)

    kind = df.schema[entity].dataType.simpleString()
    parts = sorted_ticks.mapInArrow(runs, f"__e {kind}, s bigint, lo bigint, hi bigint, n bigint")
    w = Window.partitionBy("__e").orderBy("s")
    parts = parts.withColumn("__brk", F.when(F.col("lo") - F.lag("hi").over(w) <= gap_us, 0).otherwise(1))
    parts = parts.withColumn("__g", F.sum("__brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy("__e", "__g").agg(
        F.min("lo").alias("start_us"), F.max("hi").alias("end_us"), F.sum("n").alias("n_events")
    ).select(F.col("__e").alias(entity), "start_us", "end_us", "n_events")
