"""Visually identical text with different characters, brought to one form.

The texts of an Arrow batch are exploded into one array of code points, each with
the place of its text. Tables of decompositions and look-alikes, which Unicode
bounds, are joined to it by code point; combining marks are ordered by their
class within the marks of a letter, recomposed by the table of compositions, and
texts are rebuilt. Each step is an array operation over the whole batch, so that
nothing is sorted or moved but the marks that stand in the wrong order.
"""

from __future__ import annotations

import functools
import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloqua.functions.blanks import has_visible
from colloqua.llm.lookalikes import LOOK_ALIKES
from colloqua.session import staged

#: Texts exploded at a time.
ROWS_AT_A_TIME = 1000
_LINE_BREAKS = "\n\r\v\f\x85\u2028\u2029"
_INVISIBLE = {chr(c) for c in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0)}
_INVISIBLE |= {chr(c) for c in range(0xFE00, 0xFE10)}
_HANGUL = (0xAC00, 0xD7A3)
_LEADS, _VOWELS, _TAILS = (0x1100, 19), (0x1161, 21), (0x11A8, 27)


def _target(c: str) -> str:
    """What a code point stands for, before marks are ordered."""
    if c in _LINE_BREAKS:
        return c
    category = unicodedata.category(c)
    if c in _INVISIBLE or category == "Cf" or (category == "Cc" and c != "\t"):
        return ""
    if c in "\t\u2800" or category == "Zs":
        return " "
    whole = unicodedata.normalize("NFKD", c)
    whole = "".join(" " if unicodedata.category(x) == "Zs" else x for x in whole if x not in _INVISIBLE)
    return "".join(LOOK_ALIKES.get(x, x) for x in whole)


@functools.lru_cache(maxsize=1)
def form_rows() -> list[tuple[str, int, str, int]]:
    """(code point, place, target code point, its combining class) of all that change or are marks.

    Made from the Unicode data; precomposed Hangul is left to the recomposition.
    A code point that vanishes has one row with an empty target.
    """
    rows = []
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if _HANGUL[0] <= code <= _HANGUL[1] or unicodedata.category(c) in ("Cs", "Cn", "Co"):
            continue
        to = _target(c)
        if to != c or unicodedata.combining(c):
            rows += [(c, k, x, unicodedata.combining(x)) for k, x in enumerate(to)] or [(c, 0, "", 0)]
    return rows


@dataclass(frozen=True)
class Tables:
    """What each code point stands for, by code point, and the compositions, by pair.

    ``targets[first[c] : first[c] + count[c]]`` are the code points of c's form,
    ``marks`` the combining classes; ``odd`` tells code points that change, are
    marks, or may merge with what stands before them.
    """

    count: np.ndarray
    first: np.ndarray
    targets: np.ndarray
    marks: np.ndarray
    odd: np.ndarray
    follows: np.ndarray
    pairs: np.ndarray
    composed: np.ndarray


@functools.lru_cache(maxsize=1)
def tables() -> Tables:
    """Made from the Unicode data, once in each worker."""
    size = sys.maxunicode + 1
    count, first = np.ones(size, dtype=np.int32), np.arange(size, dtype=np.int32)
    marks, odd, follows = np.zeros(size, dtype=np.uint8), np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    extra: list[int] = []
    for c, place, x, _ in form_rows():
        code = ord(c)
        odd[code] = True
        if place == 0:
            count[code], first[code] = 0, size + len(extra)
        if x:
            count[code] += 1
            extra.append(ord(x))
    pairs: dict[int, int] = {}
    for code in range(size):
        c = chr(code)
        marks[code] = unicodedata.combining(c)
        parts = unicodedata.decomposition(c).split()
        # Compositions are the canonical decompositions into two that normalisation doesn't undo.
        if len(parts) == 2 and not parts[0].startswith("<") and unicodedata.normalize("NFC", c) == c:
            a, b = (int(x, 16) for x in parts)
            pairs[a << 21 | b] = code
            follows[b] = not unicodedata.combining(chr(b))
    for start, n in (_VOWELS, _TAILS):
        follows[start : start + n] = True
    odd |= (marks > 0) | follows
    keys = np.array(sorted(pairs), dtype=np.int64)
    return Tables(count, first, np.concatenate((np.arange(size), extra)).astype(np.int32), marks, odd, follows, keys,
                  np.array([pairs[k] for k in keys.tolist()], dtype=np.int32))


def _composites(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What two code points make together, 0 for nothing."""
    t = tables()
    key = a.astype(np.int64) << 21 | b.astype(np.int64)
    at = np.minimum(np.searchsorted(t.pairs, key), len(t.pairs) - 1)
    out = np.where(t.pairs[at] == key, t.composed[at], 0)
    lead, vowel, tail = a - _LEADS[0], b - _VOWELS[0], b - _TAILS[0]
    out = np.where((lead >= 0) & (lead < _LEADS[1]) & (vowel >= 0) & (vowel < _VOWELS[1]), _HANGUL[0] + (lead * _VOWELS[1] + vowel) * (_TAILS[1] + 1), out)
    open_end = (a >= _HANGUL[0]) & (a <= _HANGUL[1]) & ((a - _HANGUL[0]) % (_TAILS[1] + 1) == 0)
    return np.where(open_end & (tail >= 0) & (tail < _TAILS[1]), a + tail + 1, out)


def _ordered(codes: np.ndarray, group: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of each group by class, equal classes as they stood; a group is a letter with its marks."""
    wrong = (group[1:] == group[:-1]) & (marks[1:] < marks[:-1])
    if not wrong.any():
        return codes, marks
    at = np.flatnonzero(np.isin(group, group[1:][wrong]))
    order = at[np.lexsort((marks[at], group[at]))]
    codes, marks = codes.copy(), marks.copy()
    codes[at], marks[at] = codes[order], marks[order]
    return codes, marks


def _merged_letters(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters that merge with the letter right before them (parts of Hangul syllables, Indic vowel signs), from the left."""
    follows = tables().follows
    while True:
        at = np.flatnonzero(follows[codes[1:]] & (owner[1:] == owner[:-1])) + 1
        made = _composites(codes[at - 1], codes[at]) if len(at) else at
        at, made = at[made > 0], made[made > 0]
        if not len(at):
            return codes, owner
        free = np.ones(len(at), dtype=bool)
        free[1:] = at[1:] != at[:-1] + 1  # its left neighbour may be taken itself; it waits for the next round
        at, made = at[free], made[free]
        codes = codes.copy()
        codes[at - 1] = made
        codes, owner = np.delete(codes, at), np.delete(owner, at)


def _merged_marks(codes: np.ndarray, owner: np.ndarray, group: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks that merge with their letter: one round for each place in a group, over all groups at once."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(starts, len(codes)))
    # A group that begins with a mark has no letter to merge with.
    open_, sizes = starts[(sizes > 1) & (marks[starts] == 0)], sizes[(sizes > 1) & (marks[starts] == 0)]
    if not len(open_):
        return codes, owner
    codes, gone = codes.copy(), np.zeros(len(codes), dtype=bool)
    last = np.zeros(len(open_), dtype=np.int64)
    for k in range(1, int(sizes.max()) + 1):
        more = sizes > k
        open_, sizes, last = open_[more], sizes[more], last[more]
        if not len(open_):
            break
        here = open_ + k
        made = _composites(codes[open_], codes[here])
        merges = (made > 0) & (last < marks[here])
        codes[open_[merges]] = made[merges]
        gone[here[merges]] = True
        last = np.where(merges, last, marks[here])
    return codes[~gone], owner[~gone]


def _groups(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the letter each code point belongs to, combining classes)."""
    marks = tables().marks[codes].astype(np.int64)
    new = marks == 0
    new[1:] |= owner[1:] != owner[:-1]
    return np.cumsum(new), marks


def one_forms(texts: list[str | None]) -> list[str | None]:
    """The one form of each text; null stays null."""
    t = tables()
    out = list(texts)
    some = [i for i, x in enumerate(texts) if x and not (x.isascii() and x.isprintable())]
    if not some:
        return out
    codes = np.frombuffer("".join([texts[i] for i in some]).encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
    owner = np.repeat(np.arange(len(some)), [len(texts[i]) for i in some])
    changes = np.bincount(owner[t.odd[codes]], minlength=len(some)) > 0
    codes, owner = codes[changes[owner]], owner[changes[owner]]
    # Exploded to what each code point stands for.
    count = t.count[codes]
    source = np.repeat(np.arange(len(codes)), count)
    place = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
    codes, owner = t.targets[t.first[codes[source]] + place], owner[source]
    if len(codes):
        group, marks = _groups(codes, owner)
        codes, _ = _ordered(codes, group, marks)
        codes, owner = _merged_letters(codes, owner)
        group, marks = _groups(codes, owner)
        codes, owner = _merged_marks(codes, owner, group, marks)
        codes, owner = _merged_letters(codes, owner)
    whole = codes.astype("<u4").tobytes().decode("utf-32-le")
    ends = np.cumsum(np.bincount(owner, minlength=len(some))).tolist()
    for k, i in enumerate(some):
        if changes[k]:
            out[i] = whole[ends[k - 1] if k else 0 : ends[k]]
    return out


def one_form(df: DataFrame, text: str = "text", to: str = "form") -> DataFrame:
    """``df`` with ``to``: the one form of all texts that look like ``text``.

    Width and compatibility forms, composed and combining accents, invisible
    characters, kinds of blank and look-alike letters are brought together; case,
    line breaks and everything else stay. Null stays null, a text without
    anything visible becomes its blanks or the empty text. Repeated rows and ties
    keep their rows; empty tables give an empty result; other columns pass
    through, one of the name ``to`` is replaced.

    Plan: one pass in Arrow batches without a shuffle.
    """
    schema = df.withColumn(to, F.lit(None).cast("string")).schema
    place = df.columns.index(text)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_A_TIME):
                batch = whole.slice(at, ROWS_AT_A_TIME)
                columns = dict(zip(batch.schema.names, batch.columns))
                columns[to] = pa.array(one_forms(batch.column(place).to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays([columns[n] for n in schema.names], names=schema.names)

    return df.mapInArrow(step, schema)


def _hash(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


def _hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text_hash, form_hash`` of rows with a key and something visible, 16 bytes each."""
    kind = df.schema[key].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_A_TIME):
                batch = whole.slice(at, ROWS_AT_A_TIME)
                texts = batch.column(1).to_pylist()
                own = [_hash(t) for t in texts]
                shown = [h if f == t else _hash(f) for t, f, h in zip(texts, one_forms(texts), own)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary()), pa.array(shown, pa.binary())], names=["key", "text_hash", "form_hash"])

    rows = df.where(F.col(key).isNotNull() & has_visible(F.col(text))).select(key, text)
    return rows.mapInArrow(step, f"key {kind}, text_hash binary, form_hash binary")


def _shared(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of :func:`_hashed` whose form several different texts have."""
    # Written once, as what follows reads it twice: a key and two hashes a row, no text.
    rows = staged(_hashed(df, key, text), "forms")
    mixed = rows.groupBy("form_hash").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b")).where("a <> b")
    return rows.join(mixed.select("form_hash"), "form_hash")


def same_look_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, class_id, n_texts, n_rows`` of each row whose text looks like another, different text.

    A class is all rows of one form; ``class_id`` is its least key, ``n_texts``
    the number of its different texts. One row for each row of ``df`` in a class,
    whatever its size. Texts without anything visible are left out, as are rows
    with a null text or key; ties and repeated rows count each; empty tables give
    an empty result; other columns are ignored.

    Plan: one pass makes two hashes of each row. Forms of several texts are found
    by an aggregation that is reduced before the shuffle, so that copies, even a
    third of all rows, cost one row a task; only rows of such forms go on.
    """
    rows = _shared(df, key, text)
    texts = rows.groupBy("form_hash", "text_hash").agg(F.count("*").alias("n"), F.min("key").alias("least"))
    classes = texts.groupBy("form_hash").agg(F.min("least").alias("class_id"), F.count("*").alias("n_texts"), F.sum("n").alias("n_rows"))
    return rows.join(classes, "form_hash").select(F.col("key").alias(key), "class_id", "n_texts", "n_rows")


def same_look_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id_a, doc_id_b`` (the smaller first) of rows that look the same and differ in code points.

    Copies of one text make no pair with each other, so a large group of copies
    alone gives no rows; every pair of different texts that look the same is
    given, as no representative may stand for it here. A class of many rows is
    split by adaptive skew join. See :func:`same_look_classes`, whose result
    grows with the rows and not with their pairs, for the rest.
    """
    rows = _shared(df, key, text).distinct()
    a = rows.select(F.col("key").alias("doc_id_a"), F.col("text_hash").alias("__ta"), "form_hash")
    b = rows.select(F.col("key").alias("doc_id_b"), F.col("text_hash").alias("__tb"), F.col("form_hash").alias("__fb"))
    near = (F.col("form_hash") == F.col("__fb")) & (F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("__ta") != F.col("__tb"))
    return a.join(b, near).select("doc_id_a", "doc_id_b").distinct()
