"""Texts in schema-less protobuf bodies."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from colloqua.functions import text as T


def read_varint(data: bytes, at: int) -> tuple[int, int] | None:
    """(value, next position); None at the end of data or beyond 64 bits."""
    value = shift = 0
    while at < len(data) and shift < 64:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at += 1
        if byte < 0x80:
            return value, at
        shift += 7
    return None


def payloads(data: bytes) -> list[bytes]:
    """The length-delimited payloads of one level, up to the first thing that's no field."""
    out, at = [], 0
    while at < len(data):
        if (tag := read_varint(data, at)) is None:
            break
        kind, at = tag[0] & 7, tag[1]
        if kind in (1, 5):
            size = 8 if kind == 1 else 4
            if at + size > len(data):
                break
            at += size
        elif kind in (0, 2):
            if (number := read_varint(data, at)) is None:
                break
            at = number[1]
            if kind == 2:
                if at + number[0] > len(data):
                    break
                out.append(data[at : at + number[0]])
                at += number[0]
        else:
            break
    return out


def harvest(body: bytes | None) -> list[str]:
    """Every payload that decodes to a text, outer ones first, nested to any depth (each level takes two bytes at least)."""
    out: list[str] = []
    stack = list(reversed(payloads(bytes(body or b""))))
    while stack:
        data = stack.pop()
        if found := data.decode("utf-8", errors="ignore"):
            out.append(found)
        stack += reversed(payloads(data))
    return out


def wire_texts(body: Column) -> Column:
    """``array<string>`` of a body; a null body gives the empty array."""

    @F.pandas_udf("array<string>")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for bodies in batches:
            yield pd.Series([harvest(b) for b in bodies])

    return decode(body)


def best_text(candidates: Column, alnum_rule: bool = True) -> Column:
    """of the valid texts, cleaned, the best by quality, then length, then place; else the empty text."""
    valid = F.filter(candidates, lambda c: T.is_valid(c, alnum_rule))
    cleaned = F.transform(
        valid, lambda c, i: F.struct(T.text_quality(T.clean_text(c)).alias("q"), F.length(T.clean_text(c)).alias("n"), (-i).alias("i"), T.clean_text(c).alias("t"))
    )
    return F.coalesce(F.array_max(F.filter(cleaned, lambda c: c["n"] > 0))["t"], F.lit(""))
