"""Collocations: frequent phrases of two to four words, counted by direct-address tiling.

Words get ids by falling frequency. A pair of ids is a cell of a square that is cut into tiles of ``SIDE`` by ``SIDE``; inside a task the
pairs of a full tile are counted with one dense ``bincount``, those of the many thin tiles as sorted coordinates (COO) with counts. Spark adds the
tasks' counts. The frequent pairs are ranked and become ids themselves, and (pair, next word) is counted the same way; then (triple, next
word). A phrase can be frequent only if the phrase without its last word and that word are, so nothing frequent is lost.

Ids reach the texts in two ways. The most frequent ``HEAD`` words (of bounded size in bytes) and ``4 * HEAD`` pairs are broadcast. All
frequent keys beyond them are joined: the places of such keys are shuffled by key, and the ids come back by row. A bitmap of
``FILTER_BITS`` bits, of the same size whatever the input, spares keys that surely are not frequent the shuffle; others that it lets
through find no partner. Both ways give the same ids, however small the head is.

Defined cases: a null or empty text has no words; a null language is ``und``, the same as that text; repeated rows count each time; texts of
any length are whole; an empty table gives no rows; other columns are not read. Equal scores are ordered by count, then phrase.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from censusmart.llm.ranking import with_rank
from censusmart.llm.storage import saved

MIN_COUNT = 30
MAX_WORDS = 4
ABSORBED = 80
TOP = 2000
SCALE = 2_000_000
HEAD = 1 << 18
HEAD_BYTES = 64
FILTER_BITS = 1 << 27
SIDE_BITS = 10
DENSE_PAIRS = 1 << 16
CHUNK_PAIRS = 1 << 22
FLUSH_WORDS = 300_000
SLICE_TEXTS = 512
# An item's id and a word's id share one long.
WORD_BITS = 28
_BREAKS = bytes(ord(".") if b in b".,;:!?\n\x0b\x0c\r" else ord(" ") if b in b" \t" else b for b in range(256))


def tokens_of(text: str) -> list[bytes]:
    """The words of a text in UTF-8, A-Z in lower case, with ``.`` where a piece ends."""
    return text.encode().lower().translate(_BREAKS).replace(b".", b" . ").split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) from (lang, text); the row of a null word has the number of all words of the language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def rows() -> pa.RecordBatch:
            langs, words, numbers = [], [], []
            for lang, own in counts.items():
                own.pop(b".", None)
                langs += [lang] * (len(own) + 1)
                words += [None, *(w.decode() for w in own)]
                numbers += [own.total(), *own.values()]
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(numbers, pa.int64())],
                                              names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.setdefault(lang, Counter()).update(tokens_of(text.as_py()))
                if sum(map(len, counts.values())) >= FLUSH_WORDS:
                    yield rows()
                    counts.clear()
        yield rows()

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _place(code: Column) -> Column:
    """A code's bit in the filter; ``_places`` is the same in numpy."""
    return code.bitwiseXOR(F.shiftright(code, 17)).bitwiseXOR(F.shiftright(code, 31)).bitwiseAND(F.lit(FILTER_BITS - 1))


def _places(codes: np.ndarray) -> np.ndarray:
    return (codes ^ (codes >> 17) ^ (codes >> 31)) & (FILTER_BITS - 1)


def _filter(places: DataFrame) -> np.ndarray:
    """One bit per value of a one-column frame of longs below FILTER_BITS, packed; at most FILTER_BITS / 8 bytes reach the driver."""
    # A bitmap has 32768 bits, bit 0 of bitmap 1 stands for 1, and bits are numbered from the lowest in a byte.
    value = F.col(places.columns[0]) + 1
    maps = places.groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in maps:
        bits[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _holds(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _key(lang: str, word: bytes) -> bytes:
    """One key for a word of a language; its length in front keeps different pairs apart."""
    own = lang.encode()
    return b"%d:" % len(own) + own + word


def with_words(texts: DataFrame, vocabulary: DataFrame, head: int) -> DataFrame:
    """(row, words): the ids of each text's words in order, -1 where a piece ends or a word is not frequent."""
    first = vocabulary.where((F.col("id") < head) & (F.octet_length("word") <= HEAD_BYTES)).select("lang", "word", "id").collect()
    tail = vocabulary.where((F.col("id") >= head) | (F.octet_length("word") > HEAD_BYTES))
    keyed = tail.select(F.concat(F.octet_length("lang").cast("string"), F.lit(":"), "lang", "word").alias("key"), "id")
    any_tail = not tail.isEmpty()
    ids: dict[str, dict[bytes, int]] = {}
    for r in first:
        ids.setdefault(r["lang"], {})[r["word"].encode()] = r["id"]
    bits = _filter(keyed.select(F.crc32(F.col("key").cast("binary")).bitwiseAND(F.lit(FILTER_BITS - 1)))) if any_tail else None
    shared = texts.sparkSession.sparkContext.broadcast((ids, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            words, places, keys = [], [], []
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(2)):
                known, tokens = shared.value[0].get(lang, {}), tokens_of(text.as_py())
                tokens.append(b".")
                own = np.fromiter((known.get(t, -1) for t in tokens), np.int32, len(tokens))
                words.append(own)
                at = [i for i in np.flatnonzero(own < 0).tolist() if tokens[i] != b"."] if any_tail else []
                asked = [_key(lang, tokens[i]) for i in at]
                if at:
                    kept = _holds(shared.value[1], np.fromiter(map(zlib.crc32, asked), np.int64, len(asked)) & (FILTER_BITS - 1)).tolist()
                    at, asked = list(compress(at, kept)), list(compress(asked, kept))
                places.append(at)
                keys.append([k.decode() for k in asked])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int32())), pa.array(places, pa.list_(pa.int32())),
                                              pa.array(keys, pa.list_(pa.string()))], names=["row", "words", "places", "keys"])

    found = texts.select("row", "lang", "text").mapInArrow(run, "row long, words array<int>, places array<int>, keys array<string>")
    if not any_tail:
        return saved(found.select("row", "words"), "words")
    return saved(_with_tail(saved(found, "places"), keyed, "words", "int").select("row", "words"), "words")


def _with_tail(found: DataFrame, keyed: DataFrame, column: str, kind: str) -> DataFrame:
    """``found`` with the ids of ``keyed`` (key, id) written to its ``column`` at the ``places`` of their ``keys``."""
    spread = found.select("row", F.explode(F.arrays_zip("places", "keys")).alias("p")).select("row", F.col("p.places").alias("at"), F.col("p.keys").alias("key"))
    hits = spread.join(keyed, "key").groupBy("row").agg(F.collect_list("at").alias("hit_at"), F.collect_list("id").alias("hit_id"))
    both = found.drop("places", "keys").join(hits, "row", "left")
    names = both.columns
    where = names.index(column)
    numpy_kind = np.int32 if kind == "int" else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for values, at, ids in zip(batch.column(where), batch.column(len(names) - 2), batch.column(len(names) - 1)):
                values = np.array(values.values, numpy_kind)
                if at.is_valid:
                    values[np.array(at.values)] = np.array(ids.values)
                own.append(values)
            columns = list(batch.columns)
            columns[where] = pa.array(own, pa.list_(pa.from_numpy_dtype(numpy_kind)))
            yield pa.RecordBatch.from_arrays(columns[:-2], names=names[:-2])

    return both.mapInArrow(run, found.drop("places", "keys").schema)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few texts, so that arrays over a slice stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_TEXTS):
            yield batch.slice(at, SLICE_TEXTS)


def _codes(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, items, words): where an item of ``size`` words is followed by a word, over a batch's texts end to end.

    A text's last word id is -1, and no item reaches over a -1, so no pair crosses the end of a text.
    """
    words = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    items = batch.column(2).flatten().to_numpy(zero_copy_only=False) if batch.num_columns > 2 else words
    if len(words) <= size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((items[:-size] >= 0) & (words[size:] >= 0))
    return at, items[at].astype(np.int64), words[at + size]


def tile_keys(items: np.ndarray, words: np.ndarray, side_bits: int = SIDE_BITS) -> np.ndarray:
    """One long per pair: the pair's tile, then its cell in the tile."""
    cells = 1 << side_bits
    tiles = ((items >> side_bits) << (WORD_BITS - side_bits)) | (words >> side_bits)
    return (tiles << (2 * side_bits)) | ((items & (cells - 1)) << side_bits) | (words & (cells - 1))


def tile_counts(keys: np.ndarray, side_bits: int = SIDE_BITS, dense: int = DENSE_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the different pairs, from keys that are sorted in place; a code is item * 2**WORD_BITS + word."""
    keys.sort()
    cell_bits = 2 * side_bits
    tiles = keys >> cell_bits
    starts = np.flatnonzero(np.r_[True, tiles[1:] != tiles[:-1]]) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(keys)])
    found, counts = [], []
    for a, n in zip(starts[sizes >= dense].tolist(), sizes[sizes >= dense].tolist()):
        cells = np.bincount(keys[a:a + n] & ((1 << cell_bits) - 1), minlength=1 << cell_bits)
        hit = np.flatnonzero(cells)
        found.append((tiles[a] << cell_bits) | hit)
        counts.append(cells[hit])
    thin = keys[np.repeat(sizes < dense, sizes)]
    first = np.flatnonzero(np.r_[True, thin[1:] != thin[:-1]]) if len(thin) else np.zeros(0, np.int64)
    different = np.concatenate([*found, thin[first]])
    tile, cell = different >> cell_bits, different & ((1 << cell_bits) - 1)
    items = ((tile >> (WORD_BITS - side_bits)) << side_bits) | (cell >> side_bits)
    words = ((tile & ((1 << (WORD_BITS - side_bits)) - 1)) << side_bits) | (cell & ((1 << side_bits) - 1))
    return (items << WORD_BITS) | words, np.concatenate([*counts, np.diff(np.r_[first, len(thin)])])


def pair_counts(sequences: DataFrame, size: int) -> DataFrame:
    """(code, n): how often an item of ``size`` words is followed by a word, from (row, words[, items])."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)]
        pairs = 0

        def counted() -> pa.RecordBatch:
            codes, counts = tile_counts(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], names=["code", "n"])

        for batch in _slices(batches):
            _, items, words = _codes(batch, size)
            for a in range(0, len(items), CHUNK_PAIRS):
                held.append(tile_keys(items[a:a + CHUNK_PAIRS], words[a:a + CHUNK_PAIRS]))
                pairs += len(held[-1])
                if pairs >= CHUNK_PAIRS:
                    yield counted()
                    del held[1:]
                    pairs = 0
        yield counted()

    return sequences.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def with_items(sequences: DataFrame, frequent: DataFrame, size: int, head: int) -> DataFrame:
    """(row, words, items): the ids of the frequent items of ``size`` + 1 words at their first words; texts without any are left out."""
    first = frequent.where(F.col("id") < head).select("code", "id").orderBy("code").toPandas()
    tail = frequent.where(F.col("id") >= head)
    any_tail = not tail.isEmpty()
    bits = _filter(tail.select(_place(F.col("code")))) if any_tail else None
    shared = sequences.sparkSession.sparkContext.broadcast((first["code"].to_numpy(np.int64), first["id"].to_numpy(np.int64), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ids, bits = shared.value
        for batch in _slices(batches):
            at, items, words = _codes(batch, size)
            own = (items << WORD_BITS) | words
            found = np.full(len(own), -1, np.int64)
            if len(codes):
                near = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                found = np.where(codes[near] == own, ids[near], -1)
            offsets = np.concatenate([[0], np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))])
            values = np.full(offsets[-1], -1, np.int64)
            values[at] = found
            rest = (found < 0) & _holds(bits, _places(own)) if any_tail else np.zeros(len(at), bool)
            rest_at, rest_codes = at[rest], own[rest]
            cuts = np.searchsorted(rest_at, offsets)
            texts = np.repeat(np.arange(batch.num_rows), np.diff(cuts))
            lists = [pa.ListArray.from_arrays(pa.array(o, pa.int32()), v) for o, v in (
                (offsets, pa.array(values, pa.int64())), (cuts, pa.array(rest_at - offsets[texts], pa.int32())), (cuts, pa.array(rest_codes, pa.int64())))]
            has = np.bincount(np.repeat(np.arange(batch.num_rows), np.diff(offsets))[values >= 0], minlength=batch.num_rows)[:batch.num_rows] > 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["row", "words", "items", "places", "keys"]).filter(
                pa.array(has | (np.diff(cuts) > 0), pa.bool_()))

    found = sequences.mapInArrow(run, "row long, words array<int>, items array<long>, places array<int>, keys array<long>")
    if not any_tail:
        return saved(found.select("row", "words", "items"), "items")
    return saved(_with_tail(saved(found, "places"), tail.select(F.col("code").alias("key"), "id"), "items", "long"), "items")


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """((lang, words, a, phrase) of all frequent phrases of 1 to ``max_words`` words, (lang, n) of all languages); words are ids."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = saved(word_counts(texts).where(F.col("word").isNull() | (F.col("n") >= min_count)), "word-counts")
    totals = counts.where("word is null").select("lang", "n")
    vocabulary = with_rank(counts.where("word is not null"), [F.desc("n"), F.asc("lang"), F.asc("word")], "id")
    levels = [vocabulary.select("lang", F.array("id").alias("words"), F.col("n").alias("a"), F.col("word").alias("phrase"), "id")]
    if vocabulary.where(F.col("id") >= 1 << WORD_BITS).limit(1).count():
        raise ValueError(f"more than 2**{WORD_BITS} frequent words")
    sequences = with_words(texts, vocabulary, head)
    last = vocabulary.select(F.col("id").alias("last"), F.col("word").alias("next"))
    for size in range(1, max_words):
        frequent = with_rank(pair_counts(sequences, size).where(F.col("n") >= min_count), [F.desc("n"), F.asc("code")], "id")
        parts = frequent.select(F.col("id").alias("_id"), F.col("n").alias("_n"), F.shiftright("code", WORD_BITS).alias("id"),
                                F.col("code").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).alias("last"))
        levels.append(saved(parts.join(levels[-1].drop("a"), "id").join(last, "last").select(
            "lang", F.concat("words", F.array("last")).alias("words"), F.col("_n").alias("a"), F.concat_ws(" ", "phrase", "next").alias("phrase"),
            F.col("_id").alias("id")), "phrases"))
        if size + 1 < max_words:
            sequences = with_items(sequences, frequent, size, 4 * head)
    return reduce(DataFrame.unionByName, (level.drop("id") for level in levels)), totals


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 absorbed: int = ABSORBED, top: int = TOP, head: int = HEAD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    A phrase that occurs a times is cut in two; l and r are the counts of the cut's sides, its score floor(2000000 a / (l + r)); the
    cut of the lowest score counts (ties: the first). A phrase inside a longer frequent one that has ``absorbed`` percent of
    its occurrences is left out.
    """
    phrases, totals = frequent_phrases(docs, lang, text, min_count, max_words, head)
    phrases = saved(phrases, "frequent")
    candidates = phrases.where(F.size("words") > 1)
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = candidates.select("words", "a", cut).select(
        "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("left"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    sided = (cuts.join(phrases.select(F.col("words").alias("left"), F.col("a").alias("l")), "left")
             .join(phrases.select(F.col("words").alias("right"), F.col("a").alias("r")), "right"))
    # Decimals, as the product can pass 64 bits; DIV is exact and gives a long.
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = sided.groupBy("words").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    spans = [(i, n) for n in range(2, max_words) for i in range(1, max_words - n + 2)]
    inner = F.filter(F.array(*[F.when(F.size("words") >= i + n - 1, F.slice("words", i, n)) for i, n in spans]), lambda x: x.isNotNull())
    around = (candidates.where(F.size("words") > 2).select(F.col("a").alias("more"), F.col("words").alias("whole"), F.explode(inner).alias("words"))
              .where(F.size("words") < F.size("whole")).groupBy("words").agg(F.max("more").alias("more")))
    wide = "decimal(19,0)"
    inside = F.coalesce(100 * F.col("more").cast(wide) >= absorbed * F.col("a").cast(wide), F.lit(False))
    scored = (candidates.join(around, "words", "left").where(~inside).join(lowest, "words")
              .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
