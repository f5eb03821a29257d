"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in two bits at most exactly if some value lies within one bit of both. So every
fingerprint emits itself and its one-bit variants, and fingerprints that emit the same variant meet.

Distinct fingerprints meet in a variant as one 64-bit mask of flipped positions, a fixed-size aggregate: at most ``bits + 1``
fingerprints can share a variant, however many documents have them, and all of them are within two bits of each other. Documents
are reduced to different fingerprints inside the tasks before anything is shuffled, so a text with a million copies is one row a task.

Defined cases: a null text is an empty one. A text without words has fingerprint zero and is linked like any other; fewer words than
a shingle's make one shingle. Texts of any length are hashed whole, in blocks. A null id is never the smallest one: it counts as the
component's id, or its document stays, only where the whole component has no other. Repeated rows are one component. Extra columns are
carried through untouched. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.llm.components import connected_components
from censusmart.llm.storage import saved, unused

SEED = 42
RADIUS = 2
SHINGLE = 3
_BLOCK = 1 << 15


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z in lower case; bytes.split knows just the six ASCII blanks."""
    return (text or b"").lower().split()


def shingles_of(words: list[bytes], size: int) -> list[bytes]:
    """Runs of ``size`` words with repeats; the whole sequence if there are fewer; none without words."""
    if size == 1 or len(words) <= size:
        return words if size == 1 else [b" ".join(words)] if words else []
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[size - 1:]
    return [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def simhash(features, seed: int = SEED, bits: int = 64) -> int:
    """Fingerprint as an unsigned integer of ``bits`` bits: 1 where over half of the XXH64 values have a 1."""
    counts, n = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(f, seed) for f in features], dtype=">u8")
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at:at + _BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(part)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big") >> (64 - bits)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(docs: DataFrame, text: str, keep: list[Column], shingle: int, seed: int = SEED) -> DataFrame:
    """The ``keep`` columns and ``fp``, the text's fingerprint as a long."""
    kept = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [_signed(simhash(shingles_of(words_of(own.as_py()), shingle), seed)) for own in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints, pa.int64())], names=[*names, "fp"])

    return kept.mapInArrow(run, f"{schema}, fp long")


def fingerprint_links(prints: DataFrame, bits: int = 64) -> DataFrame:
    """(a, b): distinct fingerprints within two bits, each variant's members linked to its smallest member.

    ``prints`` has one column, fp, of distinct values. Every two members of a variant are linked by a path, so
    the components are those of all pairs.
    """
    flipped = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("flip"))
    one = F.lit(1).cast("long")
    flag = F.when(F.col("flip") < bits, F.call_function("shiftleft", one, F.col("flip"))).otherwise(0).cast("long")
    met = (flipped.select(F.col("fp").bitwiseXOR(flag).alias("variant"), flag.alias("mask"), (F.col("flip") == bits).cast("int").alias("centre"))
           .groupBy("variant").agg(F.bit_or("mask").alias("mask"), F.max("centre").alias("centre"))
           .where(F.bit_count("mask") + F.col("centre") > 1))
    present = F.filter(F.sequence(F.lit(0), F.lit(bits)), lambda i: F.when(i < bits, F.call_function(
        "shiftright", F.col("mask"), i).bitwiseAND(one) == 1).otherwise(F.col("centre") == 1))
    members = F.transform(present, lambda i: F.when(i < bits, F.col("variant").bitwiseXOR(F.call_function("shiftleft", one, i))).otherwise(F.col("variant")))
    return (met.select(members.alias("members")).select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
            .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)).distinct())


def fingerprint_roots(prints: DataFrame) -> DataFrame:
    """``prints`` with ``root``, which is the same for all fingerprints that links reach; ``fp`` must be distinct."""
    components = connected_components(fingerprint_links(prints.select("fp")))
    return prints.join(components.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def fingerprint_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; fingerprint in 16 hexadecimal digits.

    component_id is the smallest id among the documents that links of two bits at most reach.
    """
    rows = saved(with_fingerprints(docs, text, [F.col(doc_id).alias("doc_id")], shingle), "fingerprints")
    rooted = fingerprint_roots(saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The input's rows and columns with one row left of each component: the smallest id's.

    Rows of one id with different texts are told apart by 128 bits of hashes of the text; the smallest hashes stay.
    """
    names = [unused(name, docs.columns) for name in ("_h1", "_h2")]
    # Two independent hashes: the second one reads the text behind a salt.
    body = F.coalesce(F.col(text), F.lit(""))
    hashes = [F.xxhash64(body), F.xxhash64(F.lit("second"), body)]
    hashed = docs.select("*", *[h.alias(n) for h, n in zip(hashes, names)])
    rows = saved(with_fingerprints(docs, text, [F.col(doc_id).alias("doc_id"), hashes[0].alias("h1"), hashes[1].alias("h2")], shingle), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")).alias("least")
    rooted = fingerprint_roots(saved(rows.groupBy("fp").agg(least), "distinct"))
    stay = rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.doc_id", "least.h1", "least.h2")
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("h1") == F.col("other_h1")) & (F.col("h2") == F.col("other_h2"))
    repeated = rows.groupBy(*[F.col(c).alias(n) for c, n in (("doc_id", "other_id"), ("h1", "other_h1"), ("h2", "other_h2"))]).count().where("count > 1")
    marked = stay.join(repeated, same, "left").select(*[F.col(c).alias(unused(f"_stay_{c}", docs.columns)) for c in ("doc_id", "h1", "h2")],
                                                      F.col("count").isNotNull().alias(unused("_stay_many", docs.columns)))
    stay_id, stay_h1, stay_h2, many = (F.col(c) for c in marked.columns)
    found = hashed.join(saved(marked, "stay"), (F.col(names[0]) == stay_h1) & (F.col(names[1]) == stay_h2) & F.col(doc_id).eqNullSafe(stay_id))
    # Only rows that occur again, equal in id and text, meet by their hashes: one of them stays. No other text is shuffled for that.
    once = found.where(many).dropDuplicates([marked.columns[1], marked.columns[2]])
    return found.where(~many).unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])
