"""Spelling variants grouped by PartEnum signatures.

A word's letter multiset is a binary vector with one dimension per (letter, occurrence). One replaced letter changes two of its
bits, one inserted or deleted letter changes one. The dimensions are dealt to parts; a signature is a choice of parts with the bits
in them. Vectors of ``PARTS`` parts that differ in two bits agree on some choice of ``PARTS - 2`` parts, and words of
neighbouring lengths, which differ in one bit, on some choice of ``STEP_PARTS - 1`` of ``STEP_PARTS`` parts. So every pair of near words
meets in an equi-join of signatures, and the pairs that meet are verified: first by the halves of the words, of which one edit leaves one
whole, then by the edit distance itself. Signatures and halves travel as hashes, whose collisions only add candidates.

Words are counted inside the tasks before their counts are shuffled, so a frequent word is one row per task. How many words are near one
word is bounded by its length times the alphabet, so no group of a verified pair list grows with the input.

Defined cases: a null or empty text has no words; a null id counts as the text ``null``; repeated rows count each time; words of any length
are handled (a run of 300,000 letters is one word); an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusmart.llm.storage import saved

MIN_LETTERS = 5
MIN_COUNT = 3
DROP_ONE_IN = 97
DOMINANCE = 2
PARTS = 6
STEP_PARTS = 5
FLUSH_WORDS = 300_000
# Letters from frequent to rare, so that the parts get about equal shares; a second occurrence goes to another part.
_RANK = np.arange(256, dtype=np.int64)
_RANK[np.frombuffer(b"etaoinshrdlcumwfgypbvkjxqz", np.uint8)] = np.arange(26)
_OCCURRENCES = 64
_RANDOM = np.random.default_rng(12).integers(1, 1 << 63, (256, _OCCURRENCES), dtype=np.uint64)
_CHOICES = np.random.default_rng(13).integers(1, 1 << 62, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _letters() -> bytes:
    """A translation of Latin-1 bytes: A-Z to a-z, a-z and U+00C0 to U+00FF kept, all others to a blank."""
    kept = [b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)]
    kept[65:91] = range(97, 123)
    return bytes(kept)


_LETTERS = _letters()


def words_of(doc_key: str, text: str, into: Counter, min_letters: int = MIN_LETTERS) -> None:
    """Add a document's words, as Latin-1 bytes, to a counter.

    Where the CRC-32 of ``<doc_key>:<word>`` is a multiple of ``DROP_ONE_IN``, the word loses one letter.
    """
    own = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
    start = zlib.crc32(doc_key.encode() + b":")
    for word, n in own.items():
        if len(word) < min_letters:
            continue
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % DROP_ONE_IN == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < min_letters:
                continue
        into[word] += n


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS) -> DataFrame:
    """(word, n): how often each word of at least ``min_letters`` letters occurs in all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for rows in batches:
            for key, own in zip(rows.column(0), rows.column(1)):
                words_of(key.as_py(), own.as_py(), counts, min_letters)
                if len(counts) >= FLUSH_WORDS:
                    yield batch()
                    counts.clear()
        yield batch()

    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    counted = docs.where(F.col(text).isNotNull()).select(key.alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def part_sums(words: list[bytes], parts: int) -> np.ndarray:
    """(parts, words): a hash of the bits that each word's letter multiset has in each part."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8)
    word = np.repeat(np.arange(len(words)), lengths)
    order = np.argsort(word * 256 + letters, kind="stable")
    letters, word = letters[order], word[order]
    starts = np.flatnonzero(np.r_[True, (letters[1:] != letters[:-1]) | (word[1:] != word[:-1])]) if len(letters) else np.zeros(0, np.int64)
    nth = np.arange(len(letters)) - np.repeat(starts, np.diff(np.r_[starts, len(letters)]))
    part = (_RANK[letters] + 3 * nth) % parts
    bits = _RANDOM[letters, nth % _OCCURRENCES] * (2 * (nth // _OCCURRENCES) + 1).astype(np.uint64)
    sums = np.zeros(parts * len(words), np.uint64)
    np.add.at(sums, part * len(words) + word, bits)
    return sums.reshape(parts, len(words))


def signatures(words: list[bytes], parts: int, distance: int, lengths: np.ndarray) -> np.ndarray:
    """(words, choices): one signed 64-bit signature per choice of ``parts - distance`` parts, salted with the length given."""
    sums = part_sums(words, parts)
    salt = lengths.astype(np.uint64) * _CHOICES[-1]
    found = []
    for nth, chosen in enumerate(combinations(range(parts), parts - distance)):
        total = salt + _CHOICES[200 + 100 * distance + nth]
        for part in chosen:
            total = total + sums[part] * _CHOICES[part]
        found.append((total * _CHOICES[100]) ^ (total >> np.uint64(29)))
    return np.stack(found, axis=1).view(np.int64) if len(words) else np.zeros((0, len(found)), np.int64)


def _signed(crc: int) -> int:
    return crc - (1 << 32) if crc >> 31 else crc


def with_signatures(vocabulary: DataFrame, parts: int = PARTS, step_parts: int = STEP_PARTS) -> DataFrame:
    """(word, same, longer, shorter, halves): signatures among equal lengths, as the longer and as the shorter word of a
    pair, and the halves' hashes [first, second, first as the longer word, second as the longer word]."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.int64())
        for batch in batches:
            words = [w.as_py().encode("latin-1") for w in batch.column(0)]
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            halves = [[_signed(zlib.crc32(part)) for part in (w[:len(w) // 2], w[len(w) // 2:], w[:(len(w) - 1) // 2], w[(len(w) - 1) // 2 + 1:])]
                      for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(s), lists) for s in (
                    signatures(words, parts, 2, lengths), signatures(words, step_parts, 1, lengths), signatures(words, step_parts, 1, lengths + 1))),
                 pa.array(halves, pa.list_(pa.int32()))], names=["word", "same", "longer", "shorter", "halves"])

    return vocabulary.select("word").mapInArrow(run, "word string, same array<long>, longer array<long>, shorter array<long>, halves array<int>")


def near_pairs(vocabulary: DataFrame, parts: int = PARTS, step_parts: int = STEP_PARTS) -> DataFrame:
    """(a, b): every two words of the vocabulary at an edit distance of one, once."""
    signed = saved(with_signatures(vocabulary, parts, step_parts), "signatures")

    def side(signature: str, name: str, half: int) -> DataFrame:
        return signed.select(F.explode(signature).alias("sig"), F.col("word").alias(name), F.col("halves")[half].alias(f"{name}_1"),
                             F.col("halves")[half + 1].alias(f"{name}_2"))

    whole_half = (F.col("a_1") == F.col("b_1")) | (F.col("a_2") == F.col("b_2"))
    one_edit = F.levenshtein("a", "b", 1) == 1
    replaced = side("same", "a", 0).join(side("same", "b", 0), "sig").where(whole_half & (F.col("a") < F.col("b")) & one_edit)
    inserted = side("longer", "a", 2).join(side("shorter", "b", 0), "sig").where(whole_half & one_edit)
    return replaced.select("a", "b").unionByName(inserted.select("a", "b")).distinct()


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, form, root) from (word, form): root is the last word that following forms leads to.

    Forms must not go round in a circle. Each round lets every word jump to where its present root points, so the number of rounds is the
    logarithm of the longest way; one count a round reaches the driver.
    """
    now = saved(forms.select("word", "form", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = saved(now.join(onward, "root", "left").select("word", "form", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                      dominance: int = DOMINANCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word that occurs ``min_count`` times or more.

    A word's form is its most frequent near word (ties: the smallest), if that occurs ``dominance`` times as often as the word or more.
    """
    vocabulary = saved(word_counts(docs, doc_id, text, min_letters).where(F.col("n") >= min_count), "words")
    pairs = saved(near_pairs(vocabulary), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    best = (both.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
            .groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best"))
            .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus")).alias("form_n")))
    placed = saved(vocabulary.join(best, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("long"))
                   .withColumn("has_form", F.coalesce(F.col("form_n") >= dominance * F.col("n"), F.lit(False))), "forms")
    roots = with_roots(placed.where("has_form").select("word", "form"))
    form, form_n = (F.when(F.col("has_form"), F.col(c)).alias(c) for c in ("form", "form_n"))
    return (placed.select("word", form, "n", "n_near", form_n).join(roots.select("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
