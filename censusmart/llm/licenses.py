"""License scans: an exact set-similarity join of license templates with blocks of text.

A template is a set of words. A text is cut into blocks of ``width`` words that begin every ``width / 2`` words; a template of at most
half a width's words that stands in a text lies whole in some block. A block is found if it has ``threshold`` of the template's
different words or more. Words outside all templates cannot add to an overlap and are left out of the blocks' sets.

The sets are ordered by how often the words occur in all documents, rarest first, and joined on words: of a template's n words,
of which a block must have t, the first n - t + 1; of a block's b words the first b - t + 1, with the least t of its width. Sets that overlap
enough share such a word. Pairs are dropped by length (b < t) and by position (the words after the shared one, with it, are fewer
than t in either set), then verified by intersection; the pair's first common word alone reports it, so no pair comes twice.

An ``exact`` template (a base phrase) is joined the same way and then looked for word by word in the blocks that have all its words;
a place counts in the block in whose first half it begins, so each place counts once.

Templates are an argument of at most ``MAX_TEMPLATE_WORDS`` words in all, which bounds what is broadcast; documents are never collected.
Blocks without a prefix word of any template leave no row, so the join's input is what texts share with templates.

Defined cases: a null or empty text has no words and no labels (empty strings, score 0); repeated rows and null ids give a row each; texts
of any length are whole, in blocks; an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusmart.llm.storage import saved

MIN_WIDTH = 16
MAX_TEMPLATE_WORDS = 200_000
FLUSH_IDS = 1 << 20
_WORD_BYTES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@dataclass(frozen=True)
class Template:
    """A label, a text of words, the share of its different words that a block must have, and whether it is a phrase to be found word by word."""

    label: str
    text: str
    threshold: str = "0.8"
    exact: bool = False

    @property
    def words(self) -> list[bytes]:
        return words_of(self.text)

    @property
    def needed(self) -> int:
        return ceil(Fraction(self.threshold) * len(set(self.words)))

    @property
    def width(self) -> int:
        return max(MIN_WIDTH, 2 << (len(self.words) - 1).bit_length())


def words_of(text: str) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII in UTF-8, A-Z in lower case."""
    return text.encode().translate(_WORD_BYTES).split()


# The base phrases with their labels, then usual license notices and the opening paragraphs of license texts.
PHRASES = (
    Template("cc-by", "cc by", "1", True),
    Template("gpl", "general public license", "1", True),
    Template("reserved", "all rights reserved", "1", True),
)
NOTICES = (
    Template("mit", "the MIT License", "1"),
    Template("apache-2.0", "Apache License, Version 2.0", "1"),
    Template("gpl-3.0", "GNU General Public License, version 3", "1"),
    Template("gpl-2.0", "GNU General Public License, version 2", "1"),
    Template("lgpl", "GNU Lesser General Public License", "1"),
    Template("mpl-2.0", "Mozilla Public License, version 2.0", "1"),
    Template("cc-by-nc", "licensed under CC BY-NC", "1"),
    Template("cc-by-sa", "licensed under CC BY-SA", "1"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
                    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
                    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                    "furnished to do so, subject to the following conditions"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
                    "that the above copyright notice and this permission notice appear in all copies"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                    "following disclaimer"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                           "http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
                          "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
                          "non-commercial, and by any means"),
)
TEMPLATES = PHRASES + NOTICES


def _checked(templates: tuple[Template, ...]) -> tuple[Template, ...]:
    if sum(len(t.words) for t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} words in all")
    if any(not t.words or not 0 < t.needed for t in templates):
        raise ValueError("a template has no words, or a threshold of nothing")
    return templates


def word_order(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> dict[bytes, int]:
    """The places of the templates' words in the global order: by their number in all documents, rarest first, then by the word."""
    vocabulary = sorted({w for t in templates for w in t.words})
    known = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in batches:
            for own in batch.column(0):
                words = words_of(own.as_py())
                counts += np.bincount(np.fromiter((known.value.get(w, -1) + 1 for w in words), np.int64, len(words)), minlength=len(counts))
        at = np.flatnonzero(counts[1:])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[1:][at], pa.int64())], names=["word", "n"])

    totals = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    often = {r["word"]: r["n"] for r in totals.collect()}  # at most one row per template word
    return {vocabulary[i]: place for place, i in enumerate(sorted(range(len(vocabulary)), key=lambda i: (often.get(i, 0), i)))}


def _index(spark: SparkSession, templates: tuple[Template, ...], order: dict[bytes, int]) -> DataFrame:
    """One row per template and prefix word: the words a template must share one of."""
    rows = []
    for number, t in enumerate(templates):
        own = sorted({order[w] for w in t.words})
        for place, word in enumerate(own[:len(own) - t.needed + 1]):
            rows.append((t.width, word, number, t.label, t.exact, place, len(own), t.needed, own, [order[w] for w in t.words]))
    return spark.createDataFrame(rows, "width int, word int, template int, label string, exact boolean, place int, size int, needed int, "
                                       "members array<int>, phrase array<int>")


class _Blocks:
    """The blocks of a text that hold a prefix word of some template, width by width."""

    def __init__(self, templates: tuple[Template, ...], order: dict[bytes, int]):
        self.order, self.widths = order, []
        for width in sorted({t.width for t in templates}):
            member, prefix = np.zeros(len(order) + 1, bool), np.zeros(len(order) + 1, bool)
            least = min(t.needed for t in templates if t.width == width)
            for t in templates:
                if t.width == width:
                    own = sorted({order[w] for w in t.words})
                    member[own] = True
                    prefix[own[:len(own) - t.needed + 1]] = True
            self.widths.append((width, member, prefix, least))

    def of(self, words: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(width, first word, sorted different ids, ids in order or -1) of each block that may be found."""
        ids = np.fromiter((self.order.get(w, -1) for w in words), np.int32, len(words))
        for width, member, prefix, least in self.widths:
            step = width // 2
            hits = np.flatnonzero(prefix[ids]) // step
            for block in np.union1d(hits, hits[hits > 0] - 1).tolist():
                own = ids[block * step:block * step + width]
                kept = np.unique(own[member[own]])
                if len(kept) >= least:
                    yield width, block * step, kept, own


def _scanned(docs: DataFrame, templates: tuple[Template, ...], order: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """A row (row, doc_id, n_words) per document, and rows (row, width, start, ids, seq) of its blocks that may be found."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(_Blocks(templates, order))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_words", "width", "start", "ids", "seq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            held, none = 0, pa.scalar(None, batch.schema.field(1).type)

            def block_rows() -> pa.RecordBatch:
                columns = list(zip(*found)) if found else [()] * 5
                return pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.repeat(none, len(found)), pa.nulls(len(found), pa.int64()), pa.array(columns[1], pa.int32()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.list_(pa.int32())), pa.array(columns[4], pa.list_(pa.int32()))], names=names)

            counts = []
            for row, own in zip(batch.column(0).to_pylist(), batch.column(2)):
                words = words_of(own.as_py())
                counts.append(len(words))
                for width, start, ids, seq in shared.value.of(words):
                    found.append((row, width, start, ids, seq))
                    held += len(ids) + len(seq)
                    if held >= FLUSH_IDS:
                        yield block_rows()
                        found.clear()
                        held = 0
            yield block_rows()
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                                              pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int32()))], names=names)

    return rows.mapInArrow(run, f"row long, doc_id {kind}, n_words long, width int, start long, ids array<int>, seq array<int>")


def _found(blocks: DataFrame, index: DataFrame, least: dict[int, int]) -> DataFrame:
    """(row, start, width, template, label, exact, containment, places) of every block that meets a template's threshold."""
    fewest = F.element_at(F.create_map(*[F.lit(x) for pair in least.items() for x in pair]), F.col("width"))
    own = F.slice("ids", F.lit(1), F.size("ids") - fewest + 1)
    prefixes = blocks.select("row", "width", "start", "ids", "seq", F.posexplode(own).alias("at", "word"))
    after = F.least(F.col("size") - F.col("place"), F.size("ids") - F.col("at"))
    met = (prefixes.join(index, ["width", "word"]).where((F.size("ids") >= F.col("needed")) & (after >= F.col("needed")))
           .withColumn("common", F.array_intersect("ids", "members"))
           .where((F.size("common") >= F.col("needed")) & (F.array_min("common") == F.col("word"))))
    half = F.least(F.floor(F.col("width") / 2), F.size("seq")).cast("int")
    places = F.when(F.col("exact"), F.filter(F.sequence(F.lit(0), half - 1), lambda i: F.slice(
        F.col("seq"), i + 1, F.size("phrase")) == F.col("phrase"))).otherwise(F.array().cast("array<int>"))
    return met.select("row", "start", "width", "template", "label", "exact", (F.size("common") / F.col("size")).alias("containment"),
                      F.transform(places, lambda i: i + F.col("start")).alias("places")).where(~F.col("exact") | (F.size("places") > 0))


def license_blocks(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((row, doc_id, n_words) of all documents, the blocks found in them); ``row`` numbers the documents' rows."""
    templates = _checked(templates)
    order = word_order(docs, templates, text)
    scanned = saved(_scanned(docs, templates, order, doc_id, text), "license-blocks")
    least = {t.width: min(o.needed for o in templates if o.width == t.width) for t in templates}
    found = _found(scanned.where("width is not null"), _index(docs.sparkSession, templates, order), least)
    return scanned.where("width is null").select("row", "doc_id", "n_words"), found


def scan_documents(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per document.

    n_base counts the places of the exact phrases; labels are those of all templates found; score is the largest containment found.
    """
    rows, found = license_blocks(docs, templates, doc_id, text)
    per_row = found.groupBy("row").agg(
        F.sum(F.size("places")).alias("n_base"), F.min(F.array_min("places")).alias("first_word"), F.max(F.array_max("places")).alias("last_word"),
        F.collect_set(F.when(F.col("exact"), F.col("label"))).alias("base"), F.collect_set("label").alias("all"), F.max("containment").alias("score"))
    joined = {name: F.coalesce(F.array_join(F.array_sort(column), ","), F.lit("")).alias(name) for name, column in (("base_labels", "base"), ("labels", "all"))}
    return (rows.join(per_row, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"),
                    F.col("last_word").cast("long").alias("last_word"), joined["base_labels"], joined["labels"], F.coalesce("score", F.lit(0.0)).alias("score")))
