"""JSON documents read as streams: a value at a time, so that a document of any size takes little memory."""

from __future__ import annotations

import glob
import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_CHUNK = 1 << 20
_BLANK = " \t\r\n"


class Scanner:
    """Walks through a JSON document a value at a time, holding no more than a value and a chunk of it."""

    def __init__(self, file) -> None:
        self.file, self.text, self.at, self.done = file, "", 0, False
        self.decode = json.JSONDecoder().raw_decode

    def _more(self) -> bool:
        chunk = self.file.read(_CHUNK)
        self.text, self.at, self.done = self.text[self.at:] + chunk, 0, not chunk
        return bool(chunk)

    def peek(self) -> str:
        """The next character that isn't blank, or the empty text at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in _BLANK:
                self.at += 1
            if self.at < len(self.text) or not self._more():
                return self.text[self.at : self.at + 1]

    def take(self, expected: str) -> str:
        found = self.peek()
        if not found or found not in expected:
            raise ValueError(f"{expected} expected, {found or 'the end'} found")
        self.at += 1
        return found

    def value(self) -> tuple[object, str]:
        """(the next value, its text)."""
        self.peek()
        while True:
            try:
                found, end = self.decode(self.text, self.at)
            except ValueError:
                if not self._more():
                    raise
                continue
            # A number at the end of a chunk may go on in the next.
            if end < len(self.text) or self.done or not self._more():
                text = self.text[self.at : end]
                self.at = end
                return found, text

    def fields(self) -> Iterator[str]:
        """Keys of the object that comes next; the caller takes each key's value."""
        self.take("{")
        if self.peek() == "}":
            self.take("}")
            return
        while True:
            key, _ = self.value()
            self.take(":")
            yield key
            if self.take(",}") == "}":
                return

    def items(self) -> Iterator[str]:
        """Texts of the elements of the array that comes next."""
        self.take("[")
        if self.peek() == "]":
            self.take("]")
            return
        while True:
            yield self.value()[1]
            if self.take(",]") == "]":
                return


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class JsonArrayReader(DataSourceReader):
    """One partition for each file."""

    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        found = sorted(glob.glob(self.options["path"].removeprefix("file://")))
        if not found:
            raise FileNotFoundError(self.options["path"])
        return [_File(p) for p in found]

    def read(self, partition: _File) -> Iterator[tuple]:
        if partition is None:
            return
        with open(partition.path, encoding="utf-8") as file:
            scanner = Scanner(file)
            if scanner.peek() != "[":
                raise ValueError(f"no JSON array: {partition.path}")
            for pos, text in enumerate(scanner.items(), 1):
                yield partition.path, pos, text
            if scanner.peek():
                raise ValueError(f"more than a JSON array: {partition.path}")


class JsonArraySource(DataSource):
    """``spark.read.format("json_array")`` with path (a glob): a row for each element of each file's array; anything else fails."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return "file string, pos bigint, record string"

    def reader(self, schema) -> JsonArrayReader:
        return JsonArrayReader(dict(self.options))
