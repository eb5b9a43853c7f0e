"""Message stores and exports as the messengers keep them, written by the tasks that hold the rows.

For tests, and for handing messages back to tools that read these forms. Files lie
in a folder that every executor sees under one path.
"""

from __future__ import annotations

import json
import os
import sqlite3
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def _local(folder: str) -> str:
    if "://" in folder and not folder.startswith("file://"):
        raise ValueError(f"no folder that files can be opened in: {folder}")
    return folder.removeprefix("file://")


def write_sqlite(df: DataFrame, folder: str, table: str, prefix: str = "MSG", key: str | None = None) -> int:
    """One store ``prefix*.db`` for each task, the rows of ``df`` in ``table``; the number of rows written.

    ``key`` names a column to be the primary key. Each store is written aside and
    moved to its place when it is whole, so that a task that is run again leaves
    no half store.
    """
    target, names = _local(folder), df.columns

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        os.makedirs(target, exist_ok=True)
        place = os.path.join(target, f"{prefix}{TaskContext.get().partitionId():06d}.db")
        aside, n = f"{place}.{uuid.uuid4().hex}", 0
        store = sqlite3.connect(aside)
        listed = ", ".join(f'"{c}"' + (" INTEGER PRIMARY KEY" if c == key else "") for c in names)
        store.execute(f'CREATE TABLE "{table}" ({listed})')
        for batch in batches:
            store.executemany(f'INSERT INTO "{table}" VALUES ({", ".join("?" * len(names))})', zip(*(c.to_pylist() for c in batch.columns)))
            n += batch.num_rows
        store.commit()
        store.close()
        os.replace(aside, place)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return df.mapInArrow(step, "n bigint").agg({"n": "sum"}).first()[0] or 0


def write_telegram(df: DataFrame, folder: str, chat_id: int, name: str = "chat", message: str = "message") -> int:
    """One export ``*/result.json`` for each task, of the JSON texts in ``message``; the number of messages written."""
    target = _local(folder)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = os.path.join(target, f"part{TaskContext.get().partitionId():06d}")
        os.makedirs(place, exist_ok=True)
        aside, n = os.path.join(place, uuid.uuid4().hex), 0
        with open(aside, "w", encoding="utf-8") as out:
            out.write(f'{{"name": {json.dumps(name)}, "type": "personal_chat", "id": {chat_id}, "messages": [')
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    out.write((",\n" if n else "\n") + text)
                    n += 1
            out.write("\n]}\n")
        os.replace(aside, os.path.join(place, "result.json"))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return df.select(message).mapInArrow(step, "n bigint").agg({"n": "sum"}).first()[0] or 0
