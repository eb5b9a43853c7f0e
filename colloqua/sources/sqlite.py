"""SQLite message stores as a Python data source, and the two messengers that use it.

Stores lie where every executor sees them, on a local path in tests and a mounted
folder on a cluster.
"""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterator
from contextlib import closing

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from colloqua import schemas
from colloqua.functions import text as T
from colloqua.operators import bursts as B
from colloqua.sources.wire import best_text, wire_texts

ROWS_A_PARTITION = 500_000
#: Columns any scan can ask for besides those of the table: the store's path and the row's number in it.
FILE, ROWID = "_file", "_rowid"


def _open(path: str):
    return closing(sqlite3.connect(f"file:{os.path.abspath(path)}?mode=ro", uri=True))


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _Part(InputPartition):
    def __init__(self, path: str, low: int | None, high: int | None, keyed: bool) -> None:
        self.path, self.low, self.high, self.keyed = path, low, high, keyed


class SqliteReader(DataSourceReader):
    """One partition for each file and stretch of ``ROWS_A_PARTITION`` rows; a table without row numbers, or a query, is one."""

    def __init__(self, options: dict, schema) -> None:
        self.options, self.schema = options, schema
        self.names = options["columns"].split(",")
        self.skips = options.get("mode", "strict") == "permissive"

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in sorted(glob.glob(self.options["path"])):
            try:
                out += self._parts(path)
            except sqlite3.Error:
                if not self.skips:
                    raise
        return out

    def _parts(self, path: str) -> Iterator[_Part]:
        with _open(path) as store:
            if "query" in self.options:
                store.execute(f"SELECT * FROM ({self.options['query']}) LIMIT 0")
                yield _Part(path, None, None, False)
                return
            table = _quoted(self.options["table"])
            try:
                low = store.execute(f"SELECT min(rowid) FROM {table}").fetchone()[0]
            except sqlite3.OperationalError:
                store.execute(f"SELECT * FROM {table} LIMIT 0")
                yield _Part(path, None, None, False)
                return
            # By numbers of rows, not by ranges of row numbers, which may be keys as far apart as they like.
            step = f"SELECT max(r) FROM (SELECT rowid AS r FROM {table} WHERE rowid >= ? ORDER BY rowid LIMIT {int(self.options.get('rows', ROWS_A_PARTITION))})"
            while low is not None:
                high = store.execute(step, (low,)).fetchone()[0]
                yield _Part(path, low, high, True)
                low = store.execute(f"SELECT min(rowid) FROM {table} WHERE rowid > ?", (high,)).fetchone()[0]

    def read(self, partition: _Part) -> Iterator[tuple]:
        if partition is None:
            return
        own = {FILE: "?", ROWID: "rowid" if partition.keyed else "NULL"}
        wanted = ", ".join(own.get(n, _quoted(n)) for n in self.names)
        given: list = [partition.path] * self.names.count(FILE)
        if "query" in self.options:
            sql = f"SELECT {wanted} FROM ({self.options['query']})"
        else:
            sql = f"SELECT {wanted} FROM {_quoted(self.options['table'])} WHERE ({self.options.get('where') or '1'})"
        if partition.keyed:
            sql += " AND rowid BETWEEN ? AND ? ORDER BY rowid"
            given += [partition.low, partition.high]
        with _open(partition.path) as store:
            yield from store.execute(sql, given)


class SqliteSource(DataSource):
    """``spark.read.format("sqlite")`` with path (a glob), columns (by comma), and table with where, or query; mode permissive
    passes over stores that can't be opened or lack the table, strict fails."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        return ", ".join(f"`{n}` string" for n in self.options["columns"].split(","))

    def reader(self, schema) -> SqliteReader:
        return SqliteReader(dict(self.options), schema)


def _load(spark: SparkSession, path: str, columns: tuple[str, ...], schema: str, **options) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").schema(schema).options(path=path, columns=",".join(columns), **options).load()


def scan(spark: SparkSession, path: str, table: str, columns: tuple[str, ...], schema: str, where: str = "", mode: str = "strict") -> DataFrame:
    """Rows of a table in each file of a glob; ``where`` is evaluated by SQLite."""
    return _load(spark, path, columns, schema, table=table, where=where, mode=mode)


def query(spark: SparkSession, path: str, sql: str, columns: tuple[str, ...], schema: str, mode: str = "strict") -> DataFrame:
    """Rows of any query, evaluated by SQLite in each file of a glob, by one task a file."""
    return _load(spark, path, columns, schema, query=sql, mode=mode)


def broken_stores(path: str, table: str) -> list[tuple[str, str]]:
    """The files of a glob that a permissive scan passes over, and why."""
    out = []
    for found in sorted(glob.glob(path)):
        try:
            with _open(found) as store:
                store.execute(f"SELECT * FROM {_quoted(table)} LIMIT 0")
        except sqlite3.Error as error:
            out.append((found, str(error)))
    return out


def tables_of(path: str) -> list[str]:
    with _open(path) as store:
        return [r[0] for r in store.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]


def columns_of(path: str, table: str) -> list[tuple[str, str]]:
    with _open(path) as store:
        return [(r[1], r[2]) for r in store.execute(f"PRAGMA table_info({_quoted(table)})")]


def peers(spark: SparkSession, path: str) -> DataFrame:
    """``peer``: everybody the stores hold messages with; reduced inside each store first."""
    sql = 'SELECT DISTINCT "40030" AS peer FROM c2c_msg_table WHERE "40030" IS NOT NULL'
    return query(spark, path, sql, ("peer",), "peer bigint").distinct()


def read_qq(spark: SparkSession, path: str, owner_id: str = "", alnum_rule: bool = True, mode: str = "permissive") -> DataFrame:
    """Unified messages of stores with protobuf bodies, in one scan.

    Rows are numbered in their peer's order before the filters: by time, then file
    and row; by blocks of time, so that one peer's rows are many tasks.
    """
    rows = scan(spark, path, "c2c_msg_table", (*schemas.QQ_COLUMNS, FILE, ROWID), f"{schemas.QQ}, {FILE} string, {ROWID} bigint", '"40800" IS NOT NULL', mode)
    rows = rows.where("peer IS NOT NULL").select(
        F.col("peer").alias("room"), (F.coalesce("ts", F.lit(0)) * 1_000_000).alias("us"), F.struct(FILE, ROWID, "sender", F.md5("body")).alias("seq"), "ts", "sender", "body")
    rows = B.row_numbers(rows, "id").withColumn("msg", T.double_spaces_to_lines(T.strip(best_text(wire_texts(F.col("body")), alnum_rule))))
    rows = rows.where(T.is_valid_strict(F.col("msg")) & ~T.is_media(F.col("msg"), alnum_rule))
    mine = F.col("sender") == F.lit(int(owner_id)) if owner_id.isdigit() else F.lit(False)
    return rows.select(
        F.col("id").cast("bigint").alias("id"),
        F.concat_ws("_", F.col("ts").cast("string"), F.col("sender").cast("string")).alias("MsgSvrID"),
        T.message_type(F.col("msg")).alias("type_name"),
        F.when(mine, 1).otherwise(0).alias("is_sender"),
        F.col("sender").cast("string").alias("talker"),
        "msg",
        F.lit("").alias("src"),
        F.timestamp_seconds("ts").alias("CreateTime"),
        F.concat(F.lit("QQ_"), F.col("room").cast("string")).alias("room_name"),
        F.lit(0).alias("is_forward"),
    )


def room_of(talker: Column) -> Column:
    """A room named after the letters and digits of a talker; others are told apart by a part of the name's hash."""
    safe = F.regexp_replace(talker, r"[^\p{L}\p{N}_-]", "")
    return F.concat(F.lit("WX_"), safe, F.when(safe == talker, "").otherwise(F.concat(F.lit("~"), F.substring(F.md5(talker), 1, 6))))


def read_wechat(spark: SparkSession, folder: str, mode: str = "permissive") -> DataFrame:
    """Unified messages of the ``MSG*.db`` stores of a folder; see :func:`broken_stores` for those passed over.

    The room keeps the talker's letters and digits; talkers that differ only in
    other characters keep rooms of their own by a suffix from the talker's hash.
    A talker's messages are numbered store by store, in each by time, then row.
    """
    names = ("MsgSvrID", "IsSender", "CreateTime", "StrTalker", "StrContent", "Type", FILE, ROWID)
    rows = scan(spark, os.path.join(folder, "MSG*.db"), "MSG", names, f"{schemas.WECHAT}, {FILE} string, {ROWID} bigint",
                "Type = 1 AND StrContent IS NOT NULL AND StrContent <> ''", mode)
    rows = rows.where("coalesce(StrTalker, '') <> '' AND NOT endswith(StrTalker, '@chatroom')").withColumn("msg", T.strip(F.col("StrContent"))).where("msg <> ''")
    rows = rows.select(
        F.struct("StrTalker", FILE).alias("room"), (F.coalesce("CreateTime", F.lit(0)) * 1_000_000).alias("us"), F.struct(ROWID, "MsgSvrID", "msg").alias("seq"),
        "MsgSvrID", "IsSender", "CreateTime", "StrTalker", "msg", FILE)
    # As many rows as there are talkers and stores; a talker's stores are few.
    before = Window.partitionBy("talker").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("StrTalker").alias("talker"), F.col(FILE).alias("file")).agg(F.count("*").alias("n"))
    earlier = counts.select("talker", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    placed = B.row_numbers(rows).join(earlier, (F.col("StrTalker") == F.col("talker")) & (F.col(FILE) == F.col("file"))).drop("talker", "file")
    return placed.select(
        (F.col("earlier") + F.col("idx")).cast("bigint").alias("id"), "MsgSvrID", F.lit("text").alias("type_name"), F.col("IsSender").alias("is_sender"),
        F.col("StrTalker").alias("talker"), "msg", F.lit("").alias("src"), F.timestamp_seconds("CreateTime").alias("CreateTime"),
        room_of(F.col("StrTalker")).alias("room_name"), F.lit(0).alias("is_forward"),
    )
