"""Evaluation texts leaking into training text, found by winnowing.

Both sides are reduced to sequences of units, words or single letters and digits.
Of the hashes of all k consecutive units the least in each sliding window is
kept, with its place and the units around it; with a window of ``least - k + 1``
hashes, two texts that share ``least`` consecutive units share a kept hash.
Fingerprints are joined, and each hit is extended to both sides in the units it
carries, so that no text has to be fetched.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloqua.session import staged

#: The filter of item hashes has 2 to this many bits at most, 32 MB; more items make it pass more, not miss any.
FILTER_BITS = 28

_ESCAPES = re.compile(r"\\+(?:u([0-9a-fA-F]{4})|[nrtfbv])")
#: Letters that are words of their own: kana and ideographs.
_ALONE = ((0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_CJK = "".join(f"{chr(a)}-{chr(b)}" for a, b in _ALONE)
_WORD = re.compile(rf"[{_CJK}](?<=[^\W_])|[^\W_{_CJK}]+")
_OTHER = re.compile(r"[\W_]+")
_MARKS = regex.compile(r"[\p{Mn}\p{Me}\p{Cf}]+")
_DECOMPOSED = regex.compile(r"[^\p{ASCII}\p{Han}\p{Common}]")


@dataclass(frozen=True)
class View:
    """Units of a text and the lengths that matter."""

    words: bool
    least: int
    k: int

    @property
    def window(self) -> int:
        return self.least - self.k + 1

    @property
    def around(self) -> int:
        """Units to each side of a kept run that decide whether it lies in a passage."""
        return self.least - self.k


#: 12 consecutive words, or 24 consecutive letters and digits.
WORDS = View(True, 12, 8)
LETTERS = View(False, 24, 16)
#: Languages written without blanks between words.
UNSPACED = {"zh", "ja", "th"}


def view_of(lang: str | None) -> View:
    return LETTERS if lang in UNSPACED else WORDS


def fold(text: str) -> str:
    """Text without escapes, width, case, marks and invisible characters."""
    if "\\" in text:
        text = _ESCAPES.sub(lambda m: chr(int(m[1], 16) or 32) if m[1] else " ", text)
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKC", text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")).casefold()
    if _DECOMPOSED.search(text):
        text = unicodedata.normalize("NFKD", text)
    return _MARKS.sub("", text)


def units(folded: str, view: View) -> Sequence[str]:
    """Words (each ideograph is one), or the letters and digits as one text."""
    return _WORD.findall(folded) if view.words else _OTHER.sub("", folded)


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """For each code point 0, 1 for a letter or digit, 2 for one that is a word of its own."""
    table = np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=np.uint8, count=0x110000)
    for a, b in _ALONE:
        table[a : b + 1] *= 2
    return table


_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * _MIX
    return values ^ (values >> np.uint64(32))


@dataclass(frozen=True)
class Prints:
    """Kept hashes of texts: the text's place, the hash, the place of its run in the text, and the units around it."""

    text: np.ndarray
    hash: np.ndarray
    place: np.ndarray
    context: np.ndarray


def fingerprints(texts: Sequence[str], view: View, passes: np.ndarray | None = None, outside: int = -1) -> Prints:
    """The kept hashes of all texts, by array operations over all of them at once.

    The texts lie one after the other, parted by a code point that no unit has; a
    window counts where it lies within one text. Of equal hashes in a window the
    first is kept; neighbouring windows that keep the same run give it once.
    ``passes`` is a filter of hashes worth giving; ``outside`` stands for units
    beyond a text's ends.
    """
    whole = fold("\0".join(t.replace("\0", " ") for t in texts)) + "\0"
    codes = np.frombuffer(whole.encode("utf-32-le", "replace"), dtype=np.uint32)
    text = np.cumsum(codes == 0) - (codes == 0)
    kinds = _classes()[codes]
    with np.errstate(over="ignore"):
        if view.words:
            before = np.concatenate(([0], kinds[:-1]))
            begins = (kinds == 2) | ((kinds == 1) & (before != 1))
            starts, inside = np.flatnonzero(begins), np.flatnonzero(kinds > 0)
            nth = np.cumsum(begins)[inside] - 1
            weight = np.power(_BASE, (inside - starts[nth]).astype(np.uint64))
            part = _mixed(codes[inside].astype(np.uint64) + np.uint64(1)) * weight
            first = np.searchsorted(inside, starts)
            values = _mixed(np.add.reduceat(part, first)) if len(starts) else np.zeros(0, dtype=np.uint64)
            text = text[starts]
        else:
            values, text = codes[kinds > 0].astype(np.uint64), text[kinds > 0]
        n = len(values) - view.least + 1
        width = view.k + 2 * view.around
        if n <= 0:
            none = np.zeros(0, dtype=np.int64)
            return Prints(none, none, none, np.zeros((0, width), dtype=np.int64))
        hashes = np.zeros(len(values) - view.k + 1, dtype=np.uint64)
        for j in range(view.k):
            hashes = hashes * _BASE + values[j : j + len(hashes)]
        hashes = _mixed(hashes)
    least = hashes[:n].copy()
    for j in range(1, view.window):
        np.minimum(least, hashes[j : j + n], out=least)
    kept = text[:n] == text[view.least - 1 :]
    if passes is not None:
        # Looked up once for each run of windows with one least hash.
        new = np.concatenate(([True], least[1:] != least[:-1]))
        kept &= _passing(least[new], passes)[np.cumsum(new) - 1]
    windows = np.flatnonzero(kept)
    at = windows + np.argmin(hashes[windows[:, None] + np.arange(view.window)], axis=1)
    at = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
    owner = text[at]
    ranks = at[:, None] + np.arange(-view.around, view.k + view.around)
    inside = (ranks >= 0) & (ranks < len(values))
    ranks = np.where(inside, ranks, 0)
    inside &= text[ranks] == owner[:, None]
    context = np.where(inside, values[ranks].view(np.int64), outside)
    return Prints(owner.astype(np.int64), hashes[at].view(np.int64), at - np.searchsorted(text, owner), context)


def _passing(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets pass: those of a set bit, picked by their upper bits."""
    slots = hashes >> np.uint64(64 - (len(words) * 64).bit_length() + 1)
    return (words[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def extended(a: np.ndarray, b: np.ndarray, view: View) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hit, units to the left, units to the right) of pairs of contexts: how far they agree around their kept runs."""
    same = a == b
    left = np.cumprod(same[:, : view.around][:, ::-1], axis=1).sum(axis=1)
    right = np.cumprod(same[:, view.around + view.k :], axis=1).sum(axis=1)
    hit = same[:, view.around : view.around + view.k].all(axis=1) & (left + view.k + right >= view.least)
    return hit, left, right


def shares_run(a: Sequence[str], b: Sequence[str], least: int) -> bool:
    """Whether two unit sequences have ``least`` consecutive units in common."""
    if len(a) < least or len(b) < least:
        return False
    run = (lambda x, i: x[i : i + least]) if isinstance(a, str) else (lambda x, i: tuple(x[i : i + least]))
    runs = {run(a, i) for i in range(len(a) - least + 1)}
    return any(run(b, i) in runs for i in range(len(b) - least + 1))


_PRINT = "v tinyint, h bigint, place int, context array<bigint>"
#: What stands for units beyond the ends of documents and of items: never equal.
_BEYOND_DOC, _BEYOND_ITEM = -1, -2


def _columns(prints: Prints, v: int) -> list[pa.Array]:
    n, width = prints.context.shape
    context = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(prints.context.ravel()))
    return [pa.array(np.full(n, v, dtype=np.int8)), pa.array(prints.hash), pa.array(prints.place.astype(np.int32)), context]


def _doc_prints(df: DataFrame, key: str, text: str, filter_words: np.ndarray) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(filter_words)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(1).to_pylist()
                for v, view in enumerate((WORDS, LETTERS)):
                    prints = fingerprints(texts, view, sent.value, _BEYOND_DOC)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(prints.text)), *_columns(prints, v)], names=["doc", "v", "h", "place", "context"]
                    )

    rows = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text)
    return rows.mapInArrow(step, f"doc {kind}, {_PRINT}")


def _item_prints(items: DataFrame, key: str, lang: str, texts: list[str]) -> DataFrame:
    kind = items.schema[key].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, code in enumerate(batch.column(1).to_pylist()):
                view = view_of(code)
                for column in range(2, batch.num_columns):
                    t = batch.column(column)[i].as_py()
                    if t is None:
                        continue
                    prints = fingerprints([t], view, outside=_BEYOND_ITEM)
                    n = len(prints.hash)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(np.full(n, i))), pa.array([texts[column - 2]] * n, pa.string()),
                         *_columns(prints, 0 if view.words else 1)],
                        names=["item", "field", "v", "h", "place", "context"],
                    )

    rows = items.where(F.col(key).isNotNull()).select(key, lang, *texts)
    return rows.mapInArrow(step, f"item {kind}, field string, {_PRINT}")


def _filter(prints: DataFrame) -> np.ndarray:
    """A bit for each slot of hashes that occurs, as words of 64; its size follows the number of rows up to ``FILTER_BITS``."""
    bits = min(max((prints.count() * 32).bit_length(), 16), FILTER_BITS)
    slot = F.shiftrightunsigned("h", 64 - bits)
    rows = prints.select(F.shiftright(slot, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - bits}) & 63 AS INT))").alias("bit"))
    # At most 2 ** (FILTER_BITS - 6) words come to the driver, whatever the number of items.
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(2 ** (bits - 6), dtype=np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    doc_key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    lang: str = "lang",
    item_texts: tuple[str, ...] = ("input_text", "expected_text"),
) -> DataFrame:
    """``doc, item, field, doc_from, doc_to, item_from``: stretches of at least a passage that document and item share.

    Places count units, words or letters and digits, from 0; ``doc_to`` is
    exclusive. A stretch goes as far as the units around its fingerprint; see
    :func:`find_passages` for whole passages.

    Plan: items are fingerprinted and written once. Their hashes make a filter of
    bounded size, which goes to the workers, so that of the documents' only
    fingerprints that may hit leave the one pass over the texts, each with the
    few units around it (16 words or 32 letters). These and the items' are
    joined on the hash; Spark's size check chooses how, and a hash that many
    documents and items have is split by adaptive skew join. Neither texts nor
    fingerprints of documents without a hit are moved.
    """
    tests = staged(_item_prints(items, item_key, lang, list(item_texts)), "items")
    prints = _doc_prints(docs, doc_key, text, _filter(tests))
    theirs = tests.select("item", "field", "v", "h", F.col("place").alias("item_place"), F.col("context").alias("item_context"))
    doc_kind, item_kind = docs.schema[doc_key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = batch.column(3).to_numpy()
            for v, view in enumerate((WORDS, LETTERS)):
                part = batch.filter(pa.array(views == v))
                a, b = (part.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, view.k + 2 * view.around) for i in (5, 7))
                hit, left, right = extended(a, b, view)
                doc_at, item_at = (part.column(i).to_numpy() for i in (4, 6))
                yield pa.RecordBatch.from_arrays(
                    [x.filter(pa.array(hit)) for x in (
                        part.column(0), part.column(1), part.column(2), pa.array((doc_at - left).astype(np.int32)),
                        pa.array((doc_at + view.k + right).astype(np.int32)), pa.array((item_at - left).astype(np.int32)))],
                    names=["doc", "item", "field", "doc_from", "doc_to", "item_from"],
                )

    near = prints.join(theirs, ["v", "h"]).select("doc", "item", "field", "v", "place", "context", "item_place", "item_context")
    return near.mapInArrow(extend, f"doc {doc_kind}, item {item_kind}, field string, doc_from int, doc_to int, item_from int")


def find_leaks(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """``doc_id, item_id`` of each document that holds a passage of an item.

    A passage is 12 consecutive words, or for languages written without blanks 24
    consecutive letters and digits, of one of the item's texts, apart from case,
    width, blanks, line breaks (escaped ones too), punctuation and marks.

    Null keys and texts, and texts shorter than a passage, give nothing; repeated
    rows and hits count once; empty tables give an empty result; other columns
    are ignored. A null language counts as one with blanks. Words are compared by
    hashes of 64 bits each, twelve of them in a row.
    """
    hits = find_hits(docs, items, **names)
    return hits.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).distinct()


def find_passages(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """``doc_id, item_id, field, doc_from, doc_to, item_from`` of each whole passage of an item in a document.

    Hits on the same offset that overlap are one passage. Places are those of
    :func:`find_hits`. Repeated rows count once.
    """
    line = ["doc", "item", "field", F.col("doc_from") - F.col("item_from")]
    w = Window.partitionBy(*line).orderBy("doc_from", "doc_to")
    hits = find_hits(docs, items, **names).distinct()
    reach = F.max("doc_to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    hits = hits.withColumn("__new", F.when(F.col("doc_from") <= reach, 0).otherwise(1)).withColumn("shift", line[-1])
    hits = hits.withColumn("__n", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    whole = hits.groupBy("doc", "item", "field", "shift", "__n").agg(F.min("doc_from").alias("doc_from"), F.max("doc_to").alias("doc_to"))
    return whole.select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "field", "doc_from", "doc_to", (F.col("doc_from") - F.col("shift")).alias("item_from")
    )
