"""CSV trees, JSON lines, segments and file listings as sources."""

from __future__ import annotations

import functools
import glob
import operator
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloqua import schemas
from colloqua.functions import dialogue as D
from colloqua.functions import text as T
from colloqua.operators import sets
from colloqua.sources.json_stream import JsonArraySource, Scanner

#: Texts that the table reader of the scoring path takes for missing.
NA_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names anything, in any file system Spark knows."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found)
    return listed is not None and len(listed) > 0


def read_unified(spark: SparkSession, path: str) -> DataFrame:
    """A tree of unified CSV files, or one. Rows that don't parse have their text in ``_corrupt_record``, times that don't are null.

    ``_file`` and ``_seq`` give the order inside a file: the message's own number,
    as Spark may split a file among tasks.
    """
    rows = (
        spark.read.schema(f"{schemas.UNIFIED_CSV}, _corrupt_record string")
        .options(header=True, multiLine=True, quote='"', escape='"', recursiveFileLookup=True, pathGlobFilter="*.csv", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record",
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
    return rows.withColumn("CreateTime", F.try_to_timestamp("CreateTime", F.lit("yyyy-MM-dd HH:mm:ss"))).withColumns(
        {"_file": F.col("_metadata.file_path"), "_seq": F.col("id")}
    )


def read_scoring_rows(spark: SparkSession, path: str) -> DataFrame:
    """S3: unified rows as the scoring path takes them: no missing text or side, nothing else filtered."""
    rows = read_unified(spark, path)
    return rows.where(~F.col("msg").isin(*NA_TEXTS) & F.col("msg").isNotNull() & F.col("is_sender").isNotNull()).where(T.strip(F.col("msg")) != "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``_file, line_no, line`` of text files; lines are numbered from 1 in each file.

    Large files are split: a line's number is its place in its split plus the
    lines of the file's splits before.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("__at"),
        F.col("value").alias("line"), F.monotonically_increasing_id().alias("__i"),
    )
    counts = rows.groupBy("_file", "__at").agg(F.count("*").alias("__n"))
    w = Window.partitionBy("_file").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_file", "__at", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("_file", "__at").orderBy("__i"))
    numbered = rows.withColumn("__place", place).join(before, ["_file", "__at"])
    return numbered.select("_file", (F.col("__before") + F.col("__place")).cast("int").alias("line_no"), "line")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, blank and broken ones left out: ``id`` (file_line) and the fields of any known format."""
    lines = read_lines(spark, path).where(T.strip(F.col("line")) != "")
    parsed = lines.withColumn("r", F.from_json("line", schemas.RECORD)).where(F.try_parse_json("line").isNotNull() & F.col("line").rlike(r"^\s*\{"))
    name = F.element_at(F.split("_file", "/"), -1)
    return parsed.select(F.concat_ws("_", name, F.col("line_no").cast("string")).alias("id"), "_file", "line_no", "r.*")


def read_dialogues(spark: SparkSession, path: str) -> DataFrame:
    """Records as dialogues: ``messages`` or, without, ``conversations``."""
    rows = read_records(spark, path)
    messages = F.coalesce("messages", D.conversations_to_messages(F.col("conversations")))
    return rows.select("id", "_file", "line_no", messages.alias("messages"), "images").where("messages IS NOT NULL")


def read_strict(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines all of which have to parse, or a JSON array, one record a row as JSON text.

    A blank or broken line, or a document that is no array, fails the whole read.
    An array is read by one task as a stream, a record at a time.
    """
    if path.endswith(".jsonl"):
        lines = read_lines(spark, path)
        checked = F.when(F.try_parse_json("line").isNotNull(), F.col("line")).otherwise(
            F.raise_error(F.concat(F.lit("broken record in line "), F.col("line_no").cast("string")))
        )
        return lines.select("_file", "line_no", checked.alias("record"))
    spark.dataSource.register(JsonArraySource)
    rows = spark.read.format("json_array").option("path", path).load()
    return rows.select(F.col("file").alias("_file"), F.col("pos").cast("int").alias("line_no"), "record")


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """Training dialogues; a missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.DIALOGUE)
    return spark.read.schema(schemas.DIALOGUE).json(path)


def read_sft(spark: SparkSession, path: str, eos: str = "", most: int | None = None) -> DataFrame:
    """S10, fn16: training texts; ``most`` stops after that many accepted rows, in line order."""
    rows = read_records(spark, path)
    text = D.sft_text(F.col("messages"), F.col("instruction"), F.col("input"), F.col("output"), F.col("text"), eos)
    out = rows.withColumn("sft", text).where("sft IS NOT NULL")
    if most is not None:
        out = out.orderBy("_file", "line_no").limit(most)
    return out.select(F.col("sft").alias("text"))


def read_segments(spark: SparkSession, path: str, role: str | None = None) -> DataFrame:
    """Timed segments of a transcript, a JSON array; ``role`` names the track."""
    rows = spark.read.schema(schemas.SEGMENT).option("multiLine", True).json(path)
    rows = rows.where(T.strip(F.col("content")) != "")
    return rows if role is None else rows.withColumn("role", F.lit(role))


def merge_tracks(user: DataFrame, assistant: DataFrame, of: list[str] = (), tie: list[str] = (), to: str | None = None) -> DataFrame:
    """U-2, O5: two tracks in one order, user first at equal starts; with ``to``, numbered from 1 in each transcript ``of``.

    The numbers come from one sort by ranges, so that a transcript of any length is many tasks.
    """
    both = user.withColumn("role", F.lit("user")).unionByName(assistant.withColumn("role", F.lit("assistant")))
    order = {"__start": F.col("timestamp.start"), "__side": F.when(F.col("role") == "user", 0).otherwise(1), "__end": F.col("timestamp.end")}
    both, names = both.withColumns(order), [*of, *order, *tie]
    if to is None:
        return both.orderBy(*names).drop(*order)
    rows = sets.numbered(both, names, "__idx")
    if not of:
        return rows.withColumn(to, F.col("__idx") + 1).drop("__idx", *order)
    first = rows.groupBy(*of).agg(F.min("__idx").alias("__least")).withColumnsRenamed({c: f"__of_{c}" for c in of})
    same = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in of])
    return rows.join(first, same).withColumn(to, F.col("__idx") - F.col("__least") + 1).drop("__idx", "__least", *order, *[f"__of_{c}" for c in of])


def audio_streams(probe: DataFrame, text: str = "value") -> DataFrame:
    """The audio streams in a media probe's JSON, with ``unknown`` for what it lacks."""
    rows = probe.select(F.explode(F.from_json(text, schemas.STREAMS)["streams"]).alias("s")).where("s.codec_type = 'audio'")
    known = lambda c: F.coalesce(F.col(f"s.{c}").cast("string"), F.lit("unknown")).alias(c)
    return rows.select("s.index", known("codec_name"), known("channels"), known("sample_rate"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modificationTime`` of a tree; contents aren't read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.select("path", "length", "modificationTime")


def detect_sources(folder: str) -> list[str]:
    """Which messengers' exports a folder holds."""
    from colloqua.sources.telegram import is_export

    found = []
    if glob.glob(os.path.join(folder, "*.db")):
        found.append("qq")
    if any(is_export(p) for p in sorted(glob.glob(os.path.join(folder, "*", "result.json")))):
        found.append("tg")
    if glob.glob(os.path.join(folder, "wechat", "MSG*.db")):
        found.append("wx")
    return found


def read_all(spark: SparkSession, folder: str, prefer: str | None = None, owner_id: str = "", owner_name: str = "", alnum_rule: bool = True,
             failed: list[str] | None = None) -> DataFrame | None:
    """The preferred source if it is there, else the union of all; None without any.

    With a list ``failed``, sources that can't be read are named in it and the others go on; without, they raise.
    """
    from colloqua.sources.sqlite import read_qq, read_wechat
    from colloqua.sources.telegram import read_telegram

    found = detect_sources(folder)
    readers = {
        "qq": lambda: read_qq(spark, os.path.join(folder, "*.db"), owner_id, alnum_rule),
        "tg": lambda: read_telegram(spark, folder, owner_name),
        "wx": lambda: read_wechat(spark, os.path.join(folder, "wechat")),
    }
    chosen = [prefer] if prefer in found else found
    out = None
    for name in chosen:
        try:
            frame = readers[name]()
            frame.isEmpty()
        except Exception:  # noqa: BLE001 - whatever is wrong with one source, the others go on
            if failed is None:
                raise
            failed.append(name)
            continue
        out = frame if out is None else out.unionByName(frame)
    return out


def count_records(spark: SparkSession, path: str) -> int:
    """Records of an extract: lines, elements of an array, or messages of a document that lists them."""
    if path.endswith(".jsonl"):
        return spark.read.text(path).count()
    with open(path.removeprefix("file://"), encoding="utf-8") as file:
        scanner = Scanner(file)
        if scanner.peek() == "[":
            return sum(1 for _ in scanner.items())
        for key in scanner.fields():
            if key == "messages" and scanner.peek() == "[":
                return sum(1 for _ in scanner.items())
            scanner.value()
    return 0


def source_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Each source and whether it is there."""
    found = detect_sources(folder)
    return spark.createDataFrame([(name, name in found) for name in ("qq", "tg", "wx")], "source string, available boolean")
