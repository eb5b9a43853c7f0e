"""Telegram exports: one JSON document for each chat, read as a stream of variants."""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from colloqua import schemas
from colloqua.functions import text as T
from colloqua.sources.json_stream import Scanner

#: Media keys in the order they are looked at, their type and their tag.
MEDIA = (
    ("photo", "image", "[图片]"), ("video", "video", "[视频]"), ("audio", "voice", "[语音]"), ("voice", "voice", "[语音]"),
    ("document", "file", None), ("animation", "image", "[动图]"), ("sticker", "image", None), ("video_message", "video", "[video_message]"),
    ("location", "location", "[位置]"), ("contact", "contact", "[联系人]"), ("poll", "poll", "[投票]"), ("file", "media", "[file]"),
)
#: Message types that stand for themselves.
TYPES = {"message": "text", "service": "system"} | {key: kind for key, kind, _ in MEDIA if key != "file"}
REQUIRED = ("name", "type", "id", "messages")


def header_of(file, whole: bool = True) -> dict | None:
    """The required fields of an export, of ``messages`` whether it is a list; None for what is no export.

    Without ``whole``, reading ends as soon as all fields have been seen.
    """
    found: dict = {}
    scanner = Scanner(file)
    try:
        if scanner.peek() != "{":
            return None
        for key in scanner.fields():
            if key == "messages" and scanner.peek() == "[":
                found[key] = True
                if not whole and all(k in found for k in REQUIRED):
                    return found
                for _ in scanner.items():
                    pass
            else:
                value, _ = scanner.value()
                if key in REQUIRED:
                    found[key] = False if key == "messages" else value
                    if not whole and all(k in found for k in REQUIRED):
                        break
        if whole and scanner.peek():
            return None
    except (ValueError, RecursionError):
        return None
    return found if all(k in found for k in REQUIRED) and found["messages"] else None


def is_export(path: str) -> bool:
    """Whether a file begins like an export: an object with the required keys and a list of messages."""
    try:
        with open(path, encoding="utf-8") as file:
            return header_of(file, whole=False) is not None
    except (OSError, UnicodeDecodeError):
        return False


class _Export(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class TelegramReader(DataSourceReader):
    """One partition for each export, read as a stream of messages, so that an export of any size takes little memory."""

    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_Export(p) for p in sorted(glob.glob(self.options["path"]))] or [_Export("")]

    def read(self, partition: _Export) -> Iterator[tuple]:
        if partition is None or not partition.path:
            return
        try:
            with open(partition.path, encoding="utf-8") as file:
                head = header_of(file)
        except UnicodeDecodeError:
            head = None
        if head is None:
            return
        with open(partition.path, encoding="utf-8") as file:
            scanner = Scanner(file)
            for key in scanner.fields():
                if key == "messages":
                    for pos, text in enumerate(scanner.items()):
                        yield str(head["name"]), str(head["id"]), pos, text
                else:
                    scanner.value()


class TelegramSource(DataSource):
    """``spark.read.format("telegram")`` with path (a glob): a row for each message of each export that parses as a whole."""

    @classmethod
    def name(cls) -> str:
        return "telegram"

    def schema(self) -> str:
        return "chat string, chat_id string, pos bigint, message string"

    def reader(self, schema) -> TelegramReader:
        return TelegramReader(dict(self.options))


def _has(m: Column, key: str) -> Column:
    return F.try_variant_get(m, f"$.{key}", "variant").isNotNull()


def _get(m: Column, key: str) -> Column:
    return F.try_variant_get(m, f"$.{key}", "string")


def flat_text(m: Column) -> Column:
    """The text, be it a string or a list of strings and objects with a text."""
    field = F.try_variant_get(m, "$.text", "variant")
    shown = F.to_json(field)
    part = lambda v: F.when(F.to_json(v).startswith("{"), _get(v, "text")).when(
        F.to_json(v).startswith('"'), F.try_variant_get(v, "$", "string")
    )
    parts = F.transform(F.try_variant_get(m, "$.text", "array<variant>"), part)
    whole = F.when(shown.startswith('"'), _get(m, "text")).when(shown.startswith("["), F.array_join(parts, ""))
    clean = T.double_spaces_to_lines(T.strip(F.coalesce(whole, F.lit(""))))
    return F.when(T.is_chat_export_valid(clean), clean).otherwise("")


def media_tags(m: Column) -> Column:
    """Tags of all media of a message."""
    tags = []
    for key, _, tag in MEDIA:
        if key == "document":
            value = F.concat(F.lit("[文件: "), F.coalesce(_get(m, "file_name"), F.lit("未知文件")), F.lit("]"))
        elif key == "sticker":
            value = F.concat(F.lit("[表情包"), F.coalesce(_get(m, "sticker_emoji"), F.lit("")), F.lit("]"))
        else:
            value = F.lit(tag)
        tags.append(F.when(_has(m, key), value))
    return F.array_join(F.array(*tags), " ")


def message_kind(m: Column) -> Column:
    """P10: by the first media key, else by the type, else text or other."""
    tests = [F.when(_has(m, key), kind) for key, kind, _ in MEDIA]
    by_type = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    kind = F.coalesce(_get(m, "type"), F.lit("message"))
    return F.coalesce(*tests, F.try_element_at(by_type, kind), F.when(F.coalesce(_get(m, "text"), F.lit("")) != "", "text"), F.lit("other"))


def read_telegram(spark: SparkSession, folder: str, owner: str = "") -> DataFrame:
    """Unified messages of ``folder/*/result.json``; files without the required keys are left out."""
    spark.dataSource.register(TelegramSource)
    messages = spark.read.format("telegram").option("path", os.path.join(folder, "*", "result.json")).load()
    rows = messages.where("chat_id IS NOT NULL").withColumn("m", F.try_parse_json("message")).where("m IS NOT NULL")
    m = F.col("m")
    sender = F.coalesce(F.nullif(_get(m, "from"), F.lit("")), F.nullif(F.regexp_replace(_get(m, "from_id"), "^user", ""), F.lit("")), F.lit("unknown"))
    unix = F.try_variant_get(m, "$.date_unixtime", "string").try_cast("bigint")
    at = F.coalesce(F.timestamp_seconds(unix), F.try_to_timestamp(_get(m, "date")))
    content = F.concat_ws(" ", F.nullif(media_tags(m), F.lit("")), F.nullif(flat_text(m), F.lit("")))
    ident = F.coalesce(_get(m, "id"), F.col("pos").cast("string"))
    return rows.where(F.coalesce(_get(m, "type"), F.lit("message")) != "service").select(
        (F.col("pos") + 1).cast("bigint").alias("id"),
        F.concat_ws("_", ident, F.col("chat_id")).alias("MsgSvrID"),
        message_kind(m).alias("type_name"),
        F.when(F.lit(bool(owner)) & (_get(m, "from") == owner), 1).otherwise(0).alias("is_sender"),
        sender.alias("talker"),
        content.alias("msg"),
        F.lit("").alias("src"),
        at.alias("CreateTime"),
        F.concat_ws("_", F.lit("TG"), "chat", F.col("chat_id")).alias("room_name"),
        F.when(_has(m, "forwarded_from"), 1).otherwise(0).alias("is_forward"),
    ).where("msg <> ''")
