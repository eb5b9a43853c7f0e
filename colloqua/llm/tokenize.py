"""Encoding by a public byte-level BPE tokenizer through merge replay.

Texts are cut into words by the tokenizer's pattern. The corpus's words are
counted, and the merges are replayed over them in rank order: an inverted index
leads from each token pair to the word positions it stands at, and each merge
touches the neighbours of its positions only. The table of words and ids this
gives goes to the workers, which map texts through it.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloqua.session import staged

#: The pattern that cuts texts into words for this family of vocabularies (fixed value).
WORD_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Words of the corpus's table that go to the workers, the commonest first, and their most bytes: 40 MB at the very most.
TABLE_WORDS, WORD_BYTES = 1 << 17, 64
#: Words the table replays in one shard.
SHARD_WORDS = 1 << 14
#: Other words kept encoded in a Python worker; beyond it the memory starts anew.
MEMO_WORDS = 200_000


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class MergeReplay:
    """A byte-level BPE vocabulary: ``encode_words`` gives the ids of distinct words."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ids = model["vocab"]
        self.of_byte = [ids[letter] for _, letter in sorted(byte_letters().items())]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Replay the merges over all words together, in rank order.

        The words' bytes lie in one array; ``after`` and ``before`` link the live
        tokens of a word. The index holds, for each pair that is a merge, the
        positions where it arose; positions whose tokens have changed since are
        passed over. A merge can only give rise to pairs, so ranks that come up
        below the current one are taken next.
        """
        words = list(dict.fromkeys(words))
        tokens: list[int] = []
        before: list[int] = []
        after: list[int] = []
        starts: list[int] = []
        for word in words:
            raw = word.encode("utf-8")
            first, last = len(tokens), len(tokens) + len(raw) - 1
            starts.append(first)
            tokens.extend(self.of_byte[b] for b in raw)
            before.extend([-1, *range(first, last)])
            after.extend([*range(first + 1, last + 1), -1])
        index: dict[tuple[int, int], list[int]] = defaultdict(list)
        merges = self.merges
        for i, j in enumerate(after):
            if j >= 0 and (pair := (tokens[i], tokens[j])) in merges:
                index[pair].append(i)
        ranks = [(merges[pair][0], pair) for pair in index]
        heapq.heapify(ranks)
        while ranks:
            _, pair = heapq.heappop(ranks)
            left, right = pair
            made = merges[pair][1]
            # Left to right, so that of overlapping pairs (aaa) the first is merged.
            for i in sorted(index.pop(pair, ())):
                j = after[i]
                if tokens[i] != left or j < 0 or tokens[j] != right:
                    continue
                tokens[i], tokens[j] = made, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                for a, b in ((before[i], i), (i, k)):
                    if a >= 0 and b >= 0 and (found := merges.get((tokens[a], tokens[b]))):
                        where = index[tokens[a], tokens[b]]
                        if not where:
                            heapq.heappush(ranks, (found[0], (tokens[a], tokens[b])))
                        where.append(a)
        out = {}
        for word, i in zip(words, starts):
            ids = []
            while i >= 0:
                ids.append(tokens[i])
                i = after[i]
            out[word] = ids
        return out


@functools.lru_cache(maxsize=4)
def _loaded(path: str) -> MergeReplay:
    return MergeReplay(path)


class WordIds:
    """Ids of words in one array, and where each word's lie; words that aren't known are encoded as they come."""

    def __init__(self, path: str, words: pa.Array | None = None, ids: pa.ListArray | None = None) -> None:
        self.path, self.given = path, (words, ids)
        self._start()

    def _start(self) -> None:
        words, ids = self.given
        self.place: dict[str, int] = {} if words is None else {w: i for i, w in enumerate(words.to_pylist())}
        self.table = len(self.place)
        offsets = np.zeros(1, dtype=np.int64) if ids is None else ids.offsets.to_numpy().astype(np.int64)
        self.first, self.size = offsets[:-1], np.diff(offsets)
        self.ids = np.zeros(0, dtype=np.int32) if ids is None else ids.values.to_numpy()

    def _learn(self, new: list[str]) -> None:
        encoded = _loaded(self.path).encode_words(new)
        size = np.array([len(encoded[w]) for w in new], dtype=np.int64)
        ends = len(self.ids) + np.cumsum(size)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.first, self.size = np.concatenate((self.first, ends - size)), np.concatenate((self.size, size))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(encoded[w] for w in new), dtype=np.int32)))

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text; empty and null texts have the empty list."""
        cut = _words(self.path)
        words = [cut(t) if t else [] for t in texts]
        if len(self.place) > self.table + MEMO_WORDS:
            self._start()
        if new := set().union(*words).difference(self.place):
            self._learn(sorted(new))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), dtype=np.int64)
        sizes = self.size[at]
        done = np.concatenate(([0], np.cumsum(sizes)))
        flat = self.ids[np.repeat(self.first[at] - done[:-1], sizes) + np.arange(done[-1])]
        ends = np.cumsum([0, *map(len, words)])
        return pa.ListArray.from_arrays(pa.array(done[ends].astype(np.int32)), pa.array(flat))


@functools.lru_cache(maxsize=1)
def _words(path: str):
    import regex

    return regex.compile(WORD_PATTERN).findall


@functools.lru_cache(maxsize=4)
def _plain(path: str) -> WordIds:
    return WordIds(path)


def encode_texts(texts: list[str | None], path: str = VOCABULARY) -> list[list[int]]:
    """Ids of each text; empty and null texts have the empty list."""
    return _plain(path).encode(texts).to_pylist()


def word_table(df: DataFrame, text: str = "text", path: str = VOCABULARY, most: int = TABLE_WORDS) -> DataFrame:
    """``word, n, ids`` of the ``most`` commonest words of all texts: the merges replayed over the corpus's distinct words.

    Words are counted on the map side first, so that what is shuffled is distinct
    words, not occurrences. Words of more than ``WORD_BYTES`` bytes are left out,
    which bounds the table.
    """
    # The pattern means the same to the JVM with Unicode classes; a word it should cut otherwise would only miss the table.
    cut = F.regexp_extract_all(F.col(text), F.lit(f"(?U){WORD_PATTERN}"), 0)
    words = df.where(F.col(text) != "").select(F.explode(cut).alias("word")).where(F.octet_length("word").between(1, WORD_BYTES))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    common = staged(counted.orderBy(F.col("n").desc(), "word").limit(most), "words")

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = pa.Table.from_batches(list(batches), schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))
        listed = shard["word"].to_pylist()
        ids = _loaded(path).encode_words(listed)
        yield from shard.append_column("ids", pa.array([ids[w] for w in listed], pa.list_(pa.int32()))).to_batches()

    shards = max(1, -(-common.count() // SHARD_WORDS))
    return common.repartition(shards, "word").mapInArrow(replay, "word string, n bigint, ids array<int>")


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, most: int = TABLE_WORDS) -> DataFrame:
    """``key, ids`` of each row: the text's token ids by the vocabulary at ``path``, without special tokens.

    Empty and null texts have the empty list, never null; strings of special
    tokens are ordinary text; white space, line breaks and invisible characters
    are encoded as they are. Repeated rows each come out; empty tables give an
    empty result; other columns are ignored.

    Plan: two passes. The first counts the corpus's words and replays the merges
    over them, shard by shard, see :func:`word_table`; the second maps each text
    through that table, which is of bounded size and sent to the workers, and
    moves nothing. Words outside the table, rare or very long, are replayed where
    they stand, by the same replay, so that the ids don't depend on its size.
    """
    kind = df.schema[key].dataType.simpleString()
    found = word_table(df, text, path, most).select("word", "ids").toArrow()
    sent = df.sparkSession.sparkContext.broadcast((found["word"].combine_chunks(), found["ids"].combine_chunks()))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path, *sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), words.encode(part.column(1).to_pylist())], names=["key", "ids"])

    out = df.select(key, text).mapInArrow(step, f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)


def decode(ids: list[int], path: str = VOCABULARY) -> str:
    """The text of token ids: an exact round trip for valid text."""
    with open(path, encoding="utf-8") as file:
        letters = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
    back = {letter: b for b, letter in byte_letters().items()}
    return bytes(back[c] for i in ids for c in letters[i]).decode("utf-8")


def encode_series(texts: pd.Series, path: str = VOCABULARY) -> pd.Series:
    return pd.Series(encode_texts(texts.tolist(), path))
