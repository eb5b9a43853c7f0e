"""Sinks: per-room CSV, JSON lines, scored tables, one-document JSON."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from colloqua.functions import dialogue as D
from colloqua.operators import scoring
from colloqua.session import staged

_CSV = {"header": True, "quote": '"', "escape": '"', "timestampFormat": "yyyy-MM-dd HH:mm:ss", "quoteAll": True,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
UNIFIED_ORDER = ("id", "MsgSvrID", "type_name", "is_sender", "talker", "msg", "src", "CreateTime", "room_name", "is_forward")


def write_rooms(df: DataFrame, path: str, rows_a_file: int = 1_000_000) -> None:
    """K1: unified CSV, a folder for each room, rows by id.

    A large room is spread over several tasks by its ids and written in files of
    ``rows_a_file`` rows at most; the room stays a column of the files.
    """
    part = F.floor(F.coalesce("id", F.lit(0)) / F.lit(rows_a_file))
    rows = df.select(*UNIFIED_ORDER).withColumn("room", F.col("room_name")).withColumn("__part", part)
    rows = rows.repartition("room", "__part").sortWithinPartitions("room", "__part", "id").drop("__part")
    rows.write.mode("overwrite").partitionBy("room").options(**_CSV, maxRecordsPerFile=rows_a_file).csv(path)


def dialogue_lines(df: DataFrame, prompt: str = "*") -> DataFrame:
    """Dialogues as JSON texts, images only where there are any."""
    record = [D.with_system(F.col("messages"), prompt).alias("messages")]
    if "images" in df.columns:
        record.append(F.when(F.size("images") > 0, F.col("images")).alias("images"))
    return df.select(F.to_json(F.struct(*record)).alias("value"))


def write_chatml(df: DataFrame, path: str, prompt: str = "*") -> None:
    """K2, K8: one dialogue a line."""
    dialogue_lines(df, prompt).write.mode("overwrite").text(path)


def write_scored(df: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """K4: every pair with its score, accepted or not, in input order where ``order`` names its columns."""
    m = F.col("messages")
    rows = df.orderBy(*order) if order else df
    rows = rows.select("id", D.first_content(m, "user").alias("Q"), D.first_content(m, "assistant").alias("A"), "score")
    rows.write.mode("overwrite").options(**_CSV).csv(path)


def write_accepted(df: DataFrame, path: str, accept: int, prompt: str = "*", order: tuple[str, ...] = ("_file", "line_no")) -> None:
    """K3: accepted pairs, role runs merged, in input order: by ``order``, numbers as numbers."""
    rows = scoring.accepted(df, accept).orderBy(*order).withColumn("messages", D.merge_role_runs(F.col("messages")))
    write_chatml(rows, path, prompt)


def score_as_they_come(pairs: DataFrame, judge: scoring.Judge, out: str, checkpoint: str, accept: int, prompt: str = "*", **judging) -> StreamingQuery:
    """K3, K4 batch by batch: a stream of pairs (``id, messages, _file, line_no``) scored and written as it comes.

    Each micro-batch goes to folders of its own number below ``out``, ``accepted``
    and ``scored``; one that is run again after a failure replaces them. The
    query is given, running; what it has written stays when it is stopped.
    """

    def write(batch: DataFrame, number: int) -> None:
        scored = staged(scoring.score_pairs(batch, judge, **judging), "scored")
        write_accepted(scored, f"{out}/accepted/batch={number}", accept, prompt)
        write_scored(scored, f"{out}/scored/batch={number}", ("_file", "line_no"))

    return pairs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _as_array(texts: DataFrame) -> DataFrame:
    """One JSON array of a column of JSON texts, a line for each; one task streams it, holding a batch at a time."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            lines = [("[" if first and i == 0 else ",") + t for i, t in enumerate(batch.column(0).drop_null().to_pylist())]
            first = first and not lines
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"], pa.string())], names=["value"])

    # A row without a text, so that a task runs for an empty table too.
    none = texts.sparkSession.range(1).select(F.lit(None).cast("string").alias("value"))
    return texts.union(none).coalesce(1).mapInArrow(step, "value string")


def write_records(df: DataFrame, path: str, record: str = "record") -> None:
    """JSON texts as lines, or for a path that doesn't end in .jsonl as one array."""
    texts = df.select(F.col(record).alias("value")).where("value IS NOT NULL")
    (texts if path.endswith(".jsonl") else _as_array(texts)).write.mode("overwrite").text(path)


def timed_document(segments: DataFrame) -> DataFrame:
    """K9: the lines of one JSON array of a transcript's segments in order."""
    ordered = segments.orderBy("timestamp.start", F.when(F.col("role") == "user", 0).otherwise(1), "timestamp.end", "content")
    return _as_array(ordered.select(F.to_json(F.struct("role", "content", "timestamp")).alias("value")))


def keep_backup(spark: SparkSession, path: str, now: dt.datetime | None = None) -> str | None:
    """K5: moves what is at ``path`` aside as ``path.TIME.bak``; its new name, or None if nothing was there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old, new = hadoop(path), f"{path}.{(now or dt.datetime.now()):%Y%m%d%H%M%S}.bak"
    store = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(old):
        return None
    store.rename(old, hadoop(new))
    return new


def copy_tree(spark: SparkSession, source: str, target: str) -> None:
    """A copy of a file or folder, between any two file systems Spark knows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)
