"""Mixing sources to target weights by weighted fair queueing.

Each source shuffles its documents by a seeded hash and sends them, pass after pass, into one queue. An item's
virtual finish time is the number of words its source has sent with it, divided by the source's target. The
queue is the global order of the finish times, cut where the running total of words reaches the budget. All
of it is DataFrame expressions; group totals go through ``running_total``, so that no source, however large,
is handled by one task.

Defined cases: a null or empty text has size 0; a null source is a source of its own, last in order; rows
equal in id, source and text share one place in the queue, as one item of their joint size; an empty table
gives an empty plan. Ranges of the queue are cut by rows, so that a document with nearly all words of its source, sources
of empty texts and null ids, which share one place in the shuffle, leave no task more rows than others. A text of any
length only has its words counted. Columns other than id, text and source are never looked at, so any names may occur.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from censusmart.llm.running import ranged, running_total
from censusmart.llm.storage import saved, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
SEED = "mix"
KEY_BITS = 60


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, seed: str) -> Column:
    """A place in [0, 2**60) from the first 15 hexadecimal digits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed + "#"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def _row_hash(doc_id: str, source: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.coalesce(F.col(source), F.lit("\0null")), F.col(text))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """Targets of the sources, from (source, source_size, n_rows); one row per source.

    Sources in code-point order, null last, take the ``weights`` in turn and share the total of all sizes.
    No target is above ``max_passes`` times its source's size; the excess is shared by weight again until none
    is above. In closed form: order the sources by limit / weight; a source is at its limit if that ratio is
    not above the level (budget less the limits before it) / (weights from it on); the level at the first source not at
    its limit is the words per unit of weight of all that follow.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = (sizes.withColumn("source_no", F.row_number().over(order) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights)).cast("int") + 1))
              .withColumn("most", F.lit(max_passes) * F.col("source_size")))
    by_ratio = Window.orderBy((F.col("most") / F.col("weight")).asc(), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    levelled = (ranked
                .withColumn("budget", F.sum("source_size").over(everything))
                .withColumn("limits", F.coalesce(F.sum("most").over(before), F.lit(0)))
                .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
                .withColumn("level", (F.col("budget") - F.col("limits")).cast("double") / F.col("left"))
                .withColumn("at_limit", F.col("most") / F.col("weight") <= F.col("level")))
    final = F.min(F.when(~F.col("at_limit"), F.struct("limits", "level"))).over(everything)["level"]
    target = F.when(F.col("at_limit"), F.col("most").cast("double")).otherwise(F.col("weight") * final)
    return levelled.withColumn("target", target).select("source", "source_no", "weight", "source_size", "n_rows", "budget", "target")


def _finish(passes: Column | int, words: Column) -> Column:
    """Virtual finish time of an item whose source sent ``words`` in this pass, after ``passes`` whole ones."""
    sent = (F.lit(passes) if isinstance(passes, int) else passes) * F.col("source_size") + words
    return F.when(F.col("target") > 0, sent.cast("double") / F.col("target")).otherwise(F.lit(0.0))


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES, seed: str = SEED,
                doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per different (id, source, text): doc_id, source, row_hash, rows, size, source_size, target, passes.

    ``passes`` is how often the mix takes the document: 0 to ``max_passes`` times. It depends only on
    ids, sources and sizes, so reruns agree.
    """
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                        _row_hash(doc_id, source, text).alias("row_hash"), word_count(F.col(text)).alias("size"))
    items = saved(sized.groupBy("doc_id", "source", "row_hash", "size").agg(F.count("*").alias("rows"))
                  .withColumn("key", shuffle_key(F.col("doc_id"), seed))
                  .withColumn("words", F.col("size") * F.col("rows")), "mix-items")
    targets = saved(source_targets(items.groupBy("source").agg(F.sum("words").alias("source_size"), F.count("*").alias("n_rows")),
                                   weights, max_passes).coalesce(1), "mix-targets")
    keyed = items.withColumnRenamed("source", "own").join(targets, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    order = ["key", F.col("doc_id").asc_nulls_last(), "row_hash"]
    n_items = items.count()
    placed = ranged(keyed, n_items, ["source_no", *order], "mix-sources")
    queued = saved(running_total(placed, ["source_no"], F.col("_range"), order, "words", "sent").drop("_range"), "mix-queue")

    # The global queue: passes that can begin before virtual time 1, in order of finish time.
    last = F.least(F.lit(max_passes - 1), F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).cast("int")
    queue = (queued.withColumn("pass", F.explode(F.sequence(F.lit(0), last)))
             .select("doc_id", "row_hash", "key", "words", "budget", _finish(F.col("pass"), F.col("sent")).alias("finish"), F.lit(0).alias("queue")))
    in_queue = ranged(queue, n_items * max_passes, ["finish", *order], "mix-finish")
    total = running_total(in_queue, ["queue"], F.col("_range"), ["finish", *order], "words", "running")
    cut = total.where(F.col("running") <= F.col("budget")).agg(
        F.max(F.struct("finish", "key", F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("id"), "row_hash")).alias("cut")).first()["cut"]
    if cut is None:
        passes = F.lit(0)
    else:
        edge = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["key"]).cast("long").alias("key"),
                        F.lit(cut["id"]).cast("long").alias("id"), F.lit(cut["row_hash"]).cast("long").alias("row_hash"))
        taken = [F.when((F.lit(n) <= last) & (F.struct(_finish(n, F.col("sent")).alias("finish"), "key",
                                                       F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("id"), "row_hash") <= edge), 1).otherwise(0)
                 for n in range(max_passes)]
        passes = reduce(Column.__add__, taken)
    return queued.select("doc_id", "source", "row_hash", "rows", "size", "source_size", "target", passes.alias("passes"))


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed documents themselves: the input's columns, each document once per pass that takes it."""
    plan = mixing_plan(docs, doc_id=doc_id, text=text, source=source, **options).where("passes > 0")
    own, plan_id, plan_hash, passes, nth = (unused(name, docs.columns) for name in ("_row", "_plan_id", "_plan_hash", "_passes", "_pass"))
    plan = plan.select(F.col("doc_id").alias(plan_id), F.col("row_hash").alias(plan_hash), F.col("passes").alias(passes))
    hashed = docs.withColumn(own, _row_hash(doc_id, source, text))
    taken = hashed.join(plan, (F.col(own) == F.col(plan_hash)) & F.col(doc_id).eqNullSafe(F.col(plan_id)))
    return taken.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(passes)))).select(*[F.col(f"`{c}`") for c in docs.columns])
