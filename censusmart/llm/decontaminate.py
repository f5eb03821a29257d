"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over a window of words; the words at its zeros are ignored, so a substitution there
leaves the hash unchanged. The hashes of the benchmark items meet the hashes of the documents' windows. Around each hit the
alignment without gaps is verified word by word: its best stretch, where a match counts 1 and a substitution -4, must have
``MIN_MATCHED`` equal words. Every such stretch contains a hit: as no end of it scores 0 or less, its equal words after the last
substitution and those between the last two are 9 together at least, 5 of them after it. So it ends either with 7 equal words in a row
(first mask) or with 3 or more, a substitution, and 5 or more (second mask).

Short items have masks of their own, as long as the item. Up to ``SHORT_ITEM`` words a whole copy counts that has the ``needed``
equal words wherever its substitutions are: the words are cut into ``n - needed + 2`` pieces, and each mask keeps two, of which
any accepted substitutions leave some pair whole. Items under ``MIN_ITEM`` words count as exact whole copies only.

The benchmark is searched in blocks of at most ``BLOCK_WORDS`` words, read one after the other, and each block travels to
the tasks that scan the documents; so what is sent has a bound whatever the benchmark's size, and documents are
neither shuffled nor joined.

Defined cases: words are runs of letters and digits in lower case; a null or empty text has none and is never
contaminated; items without words (null texts too) are not searched; an item of one word finds every document with that
word; repeated rows get equal results; an empty benchmark finds nothing. All other columns stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusmart.llm.storage import unused

MASKS = ("1111111", "111011111")
MIN_MATCHED = 10
MIN_ITEM = 8
SHORT_ITEM = 12
PENALTY = 4
BLOCK_WORDS = 200_000
_WORD = re.compile(r"[^\W_]+")
_BITS = 18
MATCHES = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "start", "end", "matched")]))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def needed(item_words: int) -> int:
    """Equal words that an overlap with an item of this length must have."""
    return item_words if item_words < MIN_ITEM else min(MIN_MATCHED, -(-item_words * 4 // 5))


def short_masks(item_words: int) -> list[str]:
    """Masks over a whole short item, of which one fits each accepted copy."""
    if item_words < MIN_ITEM:
        return ["1" * item_words]
    pieces = np.array_split(np.arange(item_words), item_words - needed(item_words) + 2)
    pairs = (np.concatenate(pair) for pair in combinations(pieces, 2))
    return ["".join("1" if i in kept else "0" for i in range(item_words)) for kept in (set(p.tolist()) for p in pairs)]


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(start, end, matched) of the stretch with the highest score; the first of several."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -PENALTY))])
    lowest = np.minimum.accumulate(total)
    end = int(np.argmax(total - lowest))
    start = int(np.argmax(total[:end + 1] == lowest[end]))
    return start, end, int(equal[start:end].sum())


class Block:
    """Seeds of some benchmark items and the search for them."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.ids = [i for i, _ in items]
        vocabulary = sorted({w for _, words in items for w in words})
        self.number = {w: n for n, w in enumerate(vocabulary, 1)}
        self.items = [np.array([self.number[w] for w in words], np.int64) for _, words in items]
        self.factors = np.random.default_rng(7).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.seeds = []
        lengths = {len(x) for x in self.items}
        own = [(mask, n) for n in sorted(lengths) if n <= SHORT_ITEM for mask in short_masks(n)]
        for mask, length in [*((m, None) for m in MASKS), *own]:
            kept = np.array([i for i, c in enumerate(mask) if c == "1"])
            found = [(h, n, at) for n, x in enumerate(self.items) if (len(x) >= max(len(mask), MIN_ITEM) if length is None else len(x) == length)
                     for at, h in enumerate(self._hash(x, kept, len(mask)).tolist())]
            if found:
                found.sort()
                hashes = np.array([f[0] for f in found], np.uint64)
                present = np.zeros(1 << _BITS, bool)
                present[hashes >> np.uint64(64 - _BITS)] = True
                self.seeds.append((kept, len(mask), hashes, np.array([f[1:] for f in found], np.int64), present))

    def _hash(self, numbers: np.ndarray, kept: np.ndarray, span: int) -> np.ndarray:
        n = len(numbers) - span + 1
        total = np.zeros(max(n, 0), np.uint64)
        values = numbers.astype(np.uint64)
        for i in kept.tolist():
            total += values[i:i + n] * self.factors[i]
        return total * self.factors[-1]

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, first word, end, matched words) of each verified overlap, by item and place."""
        words = words_of(text)
        numbers = np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))
        aligned = set()
        for kept, span, hashes, places, present in self.seeds:
            if len(numbers) < span:
                continue
            own = self._hash(numbers, kept, span)
            at = np.flatnonzero(present[own >> np.uint64(64 - _BITS)])
            first = np.searchsorted(hashes, own[at], "left")
            last = np.searchsorted(hashes, own[at], "right")
            for a, f, e in zip(at[last > first].tolist(), first[last > first].tolist(), last[last > first].tolist()):
                for item, offset in places[f:e].tolist():
                    aligned.add((item, a - offset, a))
        found = {}
        for item, shift, at in sorted(aligned):
            if found.get((item, shift), (0, 0, 0))[1] > at:
                continue
            own = self.items[item]
            begin, end = max(shift, 0), min(shift + len(own), len(numbers))
            equal = numbers[begin:end] == own[begin - shift:end - shift]
            start, stop, matched = best_stretch(equal)
            if len(equal) == len(own) <= SHORT_ITEM and matched < needed(len(own)) <= equal.sum():
                start, stop, matched = 0, len(own), int(equal.sum())
            found[item, shift] = (begin + start, begin + stop, matched)
        return sorted({(self.ids[item], *place) for (item, _), place in found.items() if place[2] >= needed(len(self.items[item]))})


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The benchmark's items in blocks of bounded size, streamed partition by partition."""
    held, size = [], 0
    for row in benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t is not null").toLocalIterator():
        words = words_of(row["t"])
        if not words:
            continue
        if held and size + len(words) > BLOCK_WORDS:
            yield Block(held)
            held, size = [], 0
        held.append((-1 if row["i"] is None else row["i"], words))
        size += len(words)
    if held:
        yield Block(held)


def _searched(docs: DataFrame, block: Block, at: int, column: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    names = docs.columns
    place = names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "matched")]))
        for batch in batches:
            rows = [[*(earlier.as_py() or []), *(dict(zip(("item_id", "start", "end", "matched"), m)) for m in shared.value.search(t.as_py()))]
                    for t, earlier in zip(batch.column(at), batch.column(place))]
            columns = list(batch.columns)
            columns[place] = pa.array(rows, kind)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def with_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "matches") -> DataFrame:
    """The documents with a column ``name``: array of (item_id, start, end, matched) in words, empty for clean documents.

    A null item id appears as -1. An existing column of that name raises ValueError.
    """
    if name != unused(name, docs.columns):
        raise ValueError(f"the documents have a column {name}")
    found = docs.withColumn(name, F.array().cast(MATCHES))
    for block in benchmark_blocks(benchmark):
        found = _searched(found, block, docs.columns.index(text), name)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a verified overlap, with their own columns."""
    name = unused("matches", docs.columns)
    return with_matches(docs, benchmark, text, name).where(F.size(name) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
