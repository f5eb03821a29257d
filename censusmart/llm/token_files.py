"""Token-id files: tokenize documents, write compressed segment files in id order, read them back.

Documents are range-partitioned and sorted by id, so that the files' order (partition, then segment) is
ascending. A task gathers documents until a segment is full and hands it to Spark's writer as one file.

File: header (magic, version, partition, segment, documents, ids, vocabulary size), the documents' ids, null flags and
token counts with a CRC-32, the blocks' ids, words and CRC-32 values (of the ids and the coded block), and the coded blocks, the
first of them after the model that all blocks of the file are coded with.

Defined cases: a null text is an empty one (its only id is the end id); null ids come last; repeated rows are
repeated in the files, in the order of their texts' hashes; an empty table gives no files and no rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusmart.llm import token_codec as codec
from censusmart.llm.running import running_total
from censusmart.llm.storage import read_files, saved, write_files

END_ID = 0
SEGMENT_IDS = 3 << 20  # a file holds up to twice as many, so that a partition leaves no small last one
CACHE_CHUNKS, CACHE_BYTES = 1_500_000, 1 << 26
CHUNKS_JOINED, TEXTS_AT_ONCE = 32, 256
BATCH_CHARS = 1 << 24
MAGIC, VERSION = b"CMTK", 2
_HEADER = struct.Struct("<4sHHIIIQI")
_BLOCK = struct.Struct("<III")

# Fixed value: white space, and characters that some table counts as such.
_BLANK = "\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
_RUN = re.compile(f" (?:[{_BLANK}]|\\Z)")
_WORD_START = re.compile(f" (?=[^{_BLANK}])")
# Chunks of letters and punctuation, by their pieces; other chunks that split alike between zero characters.
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ɏ]+", r"[!-/:-@\[-`{-~]+"
_WORDS = re.compile(f"( {_LETTERS})({_MARKS})?(?:(\n)({_LETTERS})({_MARKS})?)?").fullmatch
_ENCLOSED = re.compile(f" .*[^{_BLANK}]", re.DOTALL).fullmatch


class Tokenizer:
    """Ids of texts from a tokenizer file of byte-level BPE.

    A text is cut into chunks before each space that something other than white space follows: no piece that the library's
    pre-tokenizer finds reaches over such a place or depends on what stands before it, and merges never cross a piece. So the
    library encodes each different chunk once and its ids are reused; the memory of chunks is bounded and starts anew when
    full. A text with a zero character, or with a token that the file adds beside its merges, such as an end mark, goes to
    the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library
        from tokenizers.pre_tokenizers import ByteLevel

        self.library, self.merger = Library.from_file(path), Library.from_file(path)
        self.merger.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        zero = self._ids(self.library, ["\0"])
        # Chunks go to the library joined by zero characters where no merge takes the zero byte, whose id tells them apart again.
        self.zero = zero[0] if len(zero) == 1 and sum("Ā" in token for token in self.library.get_vocab()) == 1 else None
        self.whole = ["\0", *(t.content for t in self.library.get_added_tokens_decoder().values())]
        self.vocabulary = self.library.get_vocab_size()
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @staticmethod
    def _ids(library, texts: list[str]) -> np.ndarray:
        parts = (texts[i:i + TEXTS_AT_ONCE] for i in range(0, len(texts), TEXTS_AT_ONCE))
        encoded = (e for part in parts for e in library.encode_batch_fast(part, add_special_tokens=False))
        return np.fromiter(chain.from_iterable(e.ids for e in encoded), np.uint32)

    def _joined(self, library, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per chunk)."""
        ids = self._ids(library, ["\0".join([*chunks[i:i + CHUNKS_JOINED], ""]) for i in range(0, len(chunks), CHUNKS_JOINED)])
        ends = np.flatnonzero(ids == self.zero)
        return ids[ids != self.zero], np.diff(ends, prepend=-1) - 1

    def _learn(self, chunks: pa.Array) -> np.ndarray:
        """Remember chunks, all different; returns their places."""
        words, pieces, counts, enclosed, others = [], [], [], [], []
        for i, chunk in enumerate(chunks.to_numpy(zero_copy_only=False).tolist()):
            if self.zero is None:
                others.append((i, chunk))
            elif match := _WORDS(chunk):
                parts = [chunk] if match.lastindex == 1 else [p for p in match.groups() if p]
                words.append(i)
                pieces += parts
                counts.append(len(parts))
            elif _ENCLOSED(chunk):
                enclosed.append((i, chunk))
            else:
                others.append((i, chunk))
        each = pa.array(pieces, pa.large_string()).dictionary_encode()
        ids, lengths = self._joined(self.merger, each.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = each.indices.to_numpy()
        ids, lengths = _gathered(ids, np.append(0, np.cumsum(lengths)), at), lengths[at]
        if words:
            lengths = np.add.reduceat(lengths, np.cumsum([0, *counts[:-1]]))
        found = [(ids, lengths), self._joined(self.library, [c for _, c in enclosed])]
        for _, chunk in others:
            ids = self._ids(self.library, [chunk])
            found.append((ids, [len(ids)]))
        order = np.array([*words, *(i for i, _ in enclosed), *(i for i, _ in others)], np.int64)
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(self.known), len(self.known) + len(order))
        self.known = pa.concat_arrays([self.known, chunks.take(pa.array(order))])
        self.flat = np.concatenate([self.flat, *(ids for ids, _ in found)])
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(np.concatenate([lengths for _, lengths in found])))
        return at

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > CACHE_CHUNKS or self.known.nbytes > CACHE_BYTES:
            self._forget()
        marked = [None if any(map(t.__contains__, self.whole)) else _marked(t) for t in texts]
        chunks = pc.split_pattern(pa.array([m or "" for m in marked], pa.large_string()), "\0")
        each = chunks.flatten().dictionary_encode()
        found = pc.index_in(each.dictionary, value_set=self.known)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        if found.null_count:
            at[at < 0] = self._learn(each.dictionary.filter(found.is_null()))
        at, bounds = at[each.indices.to_numpy()], chunks.offsets.to_numpy()
        out = []
        for first in range(0, len(texts), TEXTS_AT_ONCE):
            ends = bounds[first:first + TEXTS_AT_ONCE + 1]
            out += self._gathered(at[ends[0]:ends[-1]], ends - ends[0])
        for i, text in enumerate(texts):
            if marked[i] is None:
                out[i] = self._ids(self.library, [text])
        return out

    def _gathered(self, at: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """Ids of texts, from the places of their chunks and the bounds between texts."""
        upto = np.append(0, np.cumsum(self.ends[at + 1] - self.ends[at]))
        return np.split(_gathered(self.flat, self.ends, at), upto[bounds[1:-1]])


def _gathered(flat: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` from ``ends[i]`` to ``ends[i + 1]`` for the places ``at``, one after the other."""
    starts, lengths = ends[at], ends[at + 1] - ends[at]
    upto = np.cumsum(lengths)
    return flat[np.repeat(starts - upto + lengths, lengths) + np.arange(upto[-1] if len(at) else 0)]


def _marked(text: str) -> str:
    """The text with a zero character before each chunk but the first."""
    return _WORD_START.sub("\0 ", text) if _RUN.search(text) else text.replace(" ", "\0 ")


@lru_cache(maxsize=1)
def worker_tokenizer(path: str) -> Tokenizer:
    """The worker process's tokenizer, kept from task to task with the chunks it knows; a task keeps to its core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer(path)


def pack(partition: int, segment: int, doc_ids: list[int | None], ids: list[np.ndarray], vocabulary: int) -> bytes:
    """One segment file."""
    flat = np.concatenate(ids).astype("<u4", copy=False) if ids else np.zeros(0, "<u4")
    blocks = codec.encode(flat, vocabulary)
    index = b"".join([
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.fromiter(map(len, ids), "<u4", len(ids)).tobytes(),
    ])
    table = b"".join(_BLOCK.pack(len(part), len(block) // 4, zlib.crc32(block, codec.checksum(part)))
                     for block, part in zip(blocks, (flat[i:i + codec.BLOCK] for i in range(0, len(flat), codec.BLOCK))))
    head = _HEADER.pack(MAGIC, VERSION, 0, partition, segment, len(doc_ids), len(flat), vocabulary)
    return b"".join([head, index, struct.pack("<I", zlib.crc32(head + index)), table, *blocks])


def unpack(content: bytes) -> tuple[int, int, list[int | None], list[np.ndarray]]:
    """(partition, segment, document ids, ids per document); raises ValueError on any damage."""
    magic, version, _, partition, segment, n_docs, n_ids, vocabulary = _HEADER.unpack_from(content)
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a token file of this version")
    at = _HEADER.size + 13 * n_docs
    if struct.unpack_from("<I", content, at)[0] != zlib.crc32(content[:at]):
        raise ValueError("the document index is damaged")
    doc_ids = np.frombuffer(content, "<i8", n_docs, _HEADER.size)
    none = np.frombuffer(content, np.uint8, n_docs, _HEADER.size + 8 * n_docs)
    counts = np.frombuffer(content, "<u4", n_docs, _HEADER.size + 9 * n_docs).astype(np.int64)
    if counts.sum() != n_ids:
        raise ValueError("token counts and ids disagree")
    at += 4
    table = [_BLOCK.unpack_from(content, at + i * _BLOCK.size) for i in range(-(-n_ids // codec.BLOCK))]
    at += len(table) * _BLOCK.size
    blocks = []
    for _, words, _ in table:
        blocks.append(content[at:at + 4 * words])
        at += 4 * words
    flat = codec.decode(blocks, n_ids, vocabulary).astype("<u4")
    for i, (n, _, crc) in enumerate(table):
        part = flat[i * codec.BLOCK:(i + 1) * codec.BLOCK]
        if len(part) != n or zlib.crc32(blocks[i], codec.checksum(part)) != crc:
            raise ValueError(f"block {i} is damaged")
    return partition, segment, [None if z else int(d) for d, z in zip(doc_ids, none)], np.split(flat, np.cumsum(counts)[:-1])


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    """(document ids, texts) of a batch, some million characters at a time."""
    numbers, texts, held = [], [], 0
    for small in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
        numbers += small.column(0).to_pylist()
        texts += small.column(1).to_pylist()
        held += sum(map(len, texts[-small.num_rows:]))
        if held >= BATCH_CHARS:
            yield numbers, texts
            numbers, texts, held = [], [], 0
    if texts:
        yield numbers, texts


def write_tokens(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> str:
    """Write all documents; returns the folder of the segment files."""
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
               .withColumn("hash", F.xxhash64("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_last(), F.col("hash"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "hash").drop("hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(tokenizer_path)
        partition, segment, held, doc_ids, ids = TaskContext.get().partitionId(), 0, 0, [], []
        end = np.array([end_id], np.uint32)

        def file(n: int) -> pa.RecordBatch:
            content = pack(partition, segment, doc_ids[:n], ids[:n], tokenizer.vocabulary)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

        for d, part in (document for batch in batches for portion in _portions(batch) for document in zip(portion[0], tokenizer.encode(portion[1]))):
            doc_ids.append(d)
            ids.append(np.append(part, end))
            held += len(ids[-1])
            if held >= 2 * SEGMENT_IDS:
                n = int(np.searchsorted(np.cumsum([len(x) for x in ids]), SEGMENT_IDS)) + 1
                yield file(n)
                segment, doc_ids, ids = segment + 1, doc_ids[n:], ids[n:]
                held = sum(map(len, ids))
        if doc_ids:
            yield file(len(doc_ids))

    return write_files(ordered.mapInArrow(run, "content binary"), "tokens")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(partition, segment, nth, doc_id, n_tokens, ids_crc32) of every document in a folder of token files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                partition, segment, doc_ids, ids = unpack(content.as_py())
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([partition] * n, pa.int64()), pa.array([segment] * n, pa.int64()), pa.array(range(n), pa.int64()),
                    pa.array(doc_ids, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([codec.checksum(x) for x in ids], pa.int64()),
                ], names=["partition", "segment", "nth", "doc_id", "n_tokens", "ids_crc32"])

    return read_files(spark, folder).select("content").mapInArrow(
        run, "partition long, segment long, nth long, doc_id long, n_tokens long, ids_crc32 long")


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): where each document's ids begin in the whole of the files."""
    rows = saved(read_tokens(spark, folder).withColumn("all", F.lit(0)), "token-index")
    order = F.col("partition") * F.lit(1 << 24) + F.col("segment")
    placed = running_total(rows, ["all"], order, ["nth"], "n_tokens", "upto")
    return placed.select("doc_id", (F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
