"""Data-quality checks: counts reduced to a status, written as log rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.operators.keys import duplicates
from censusmart.operators.scd2 import version_gaps


@dataclass(frozen=True)
class Rule:
    """Status by count: ``bad`` when the count is out of bounds, else PASS.

    ``at_least`` fails counts below it; ``at_most`` flags counts above it; ``soft_floor`` is a
    second, milder lower bound with status WARN. ``always`` fixes the status.
    """

    bad: str = "FAIL"
    at_least: int | None = None
    at_most: int | None = None
    soft_floor: int | None = None
    always: str | None = None
    severity: str = "CRITICAL"
    detail: str = ""

    def status(self, n: Column, base: Column) -> Column:
        if self.always:
            return F.lit(self.always)
        out = F.when(F.lit(False), "")
        if self.at_least is not None:
            out = out.when(n < self.at_least, self.bad)
        if self.at_most is not None:
            out = out.when(n > self.at_most, self.bad)
        if self.soft_floor is not None:
            out = out.when(n < self.soft_floor, "WARN")
        return out.otherwise("PASS")


@dataclass(frozen=True)
class VarianceRule(Rule):
    """PASS only while count / base stays below ``tolerance``; a base of 0 is not a pass."""

    tolerance: float = 0.01

    def status(self, n: Column, base: Column) -> Column:
        share = n.cast("double") / F.nullif(base, F.lit(0)).cast("double")
        return F.when(share < self.tolerance, "PASS").otherwise(self.bad)


def non_empty(detail: str = "", bad: str = "FAIL", soft_floor: int | None = None) -> Rule:
    return Rule(bad=bad, at_least=1, soft_floor=soft_floor, detail=detail)


def none_allowed(bad: str = "FAIL", detail: str = "", severity: str = "CRITICAL") -> Rule:
    return Rule(bad=bad, at_most=0, detail=detail, severity=severity)


def informative(status: str, detail: str = "") -> Rule:
    return Rule(always=status, detail=detail, severity="INFO")


COUNT_COLUMNS = "check_name string, row_count bigint, base bigint"


def tally(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Counts of rows per predicate, all in one pass over ``df``."""
    counted = df.agg(*[F.count_if(p).alias(f"c{i}") for i, p in enumerate(checks.values())])
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("row_count"),
                 F.lit(None).cast("bigint").alias("base"))
        for i, name in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _counted(name: str, df: DataFrame) -> DataFrame:
    return tally(df, {name: F.lit(True)})


def rows(name: str, df: DataFrame) -> DataFrame:
    return _counted(name, df)


def orphans(name: str, child: DataFrame, column: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Child rows whose reference is missing in the parent; a NULL reference counts as missing.

    The references are reduced to one row per value before they meet the parent, so neither a hot
    value nor the NULLs gather in one join task.
    """
    refs = child.groupBy(F.col(column).alias("_ref")).count()
    lost = refs.join(parent.select(F.col(key).alias("_ref")), "_ref", "left_anti")
    return _summed(name, lost)


def references(child: DataFrame, refs: Mapping[str, tuple[str, DataFrame]], key: str = "id") -> DataFrame:
    """``orphans`` for several ``{check: (column, parent)}`` of one child, in one scan, one shuffle of it and one join.

    Every row sends its references out with their numbers and is reduced to different references inside the tasks; the parents'
    keys are stacked the same way, and one anti join tells all that are missing.
    """
    asked = child.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("_no"), F.col(column).cast("bigint").alias("_ref")) for i, (column, _) in enumerate(refs.values())
    ]))).groupBy("_no", "_ref").count()
    known = reduce(DataFrame.unionByName, [
        parent.select(F.lit(i).alias("_no"), F.col(key).cast("bigint").alias("_ref")) for i, (_, parent) in enumerate(refs.values())
    ])
    lost = asked.join(known, ["_no", "_ref"], "left_anti")
    sums = lost.agg(*[F.coalesce(F.sum(F.when(F.col("_no") == i, F.col("count"))), F.lit(0)).cast("bigint").alias(f"c{i}") for i in range(len(refs))])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("row_count"), F.lit(None).cast("bigint").alias("base"))
        for i, name in enumerate(refs)
    ])))


def _summed(name: str, counted: DataFrame) -> DataFrame:
    return counted.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("row_count")).select(
        F.lit(name).alias("check_name"), F.col("row_count").cast("bigint"),
        F.lit(None).cast("bigint").alias("base"),
    )


def uncovered(
    name: str, rows_: DataFrame, keys: Sequence[str], cover: DataFrame, cover_keys: Sequence[str]
) -> DataFrame:
    """Rows whose key does not occur in ``cover``; keys that are NULL are never covered.

    Like references, the rows are first reduced to their different keys with a count.
    """
    asked = rows_.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).count()
    seen = cover.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(cover_keys)]).distinct()
    on = [F.col(f"_k{i}") == F.col(f"_c{i}") for i in range(len(keys))]
    return _summed(name, asked.join(seen, on, "left_anti"))


def repeated(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _counted(name, duplicates(df, keys))


def gaps(name: str, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _counted(name, version_gaps(dim, keys))


def distinct_values(name: str, df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n")).select(
        F.lit(name).alias("check_name"), F.col("n").alias("row_count"),
        F.lit(None).cast("bigint").alias("base"),
    )


def variance(name: str, loaded: DataFrame, staged: DataFrame) -> DataFrame:
    """Absolute difference of the two row counts, with the staged count as base."""
    sides = loaded.agg(F.count(F.lit(1)).alias("a"), F.lit(0).cast("bigint").alias("b")).unionByName(
        staged.agg(F.lit(0).cast("bigint").alias("a"), F.count(F.lit(1)).alias("b"))
    )
    return sides.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).select(
        F.lit(name).alias("check_name"), F.abs(F.col("a") - F.col("b")).alias("row_count"),
        F.col("b").alias("base"),
    )


def run_checks(
    mart: str, counts: Sequence[DataFrame], rules: Mapping[str, Rule], as_of: date,
    run_id: Column | None = None,
) -> DataFrame:
    """One log row per check: status, count, severity and detail text."""
    all_counts = reduce(DataFrame.unionByName, counts)
    n, base = F.col("row_count"), F.col("base")

    def by_rule(pick) -> Column:
        items = list(rules.items())
        chain = F.when(F.col("check_name") == items[0][0], pick(items[0][1]))
        for name, rule in items[1:]:
            chain = chain.when(F.col("check_name") == name, pick(rule))
        return chain

    status = by_rule(lambda r: r.status(n, base))
    label = by_rule(lambda r: F.lit(r.detail))
    return all_counts.select(
        (run_id if run_id is not None else F.lit(None)).cast("bigint").alias("run_id"),
        F.lit(as_of).alias("run_date"),
        F.lit(mart).alias("mart"),
        "check_name",
        status.alias("status"),
        status.alias("result"),
        "row_count",
        by_rule(lambda r: F.lit(r.severity)).alias("severity"),
        F.concat(label, F.lit(": "), n.cast("string")).alias("detail"),
        label.alias("notes"),
    )


def with_result(log: DataFrame) -> DataFrame:
    """Older log rows carry only ``status``: fill ``result`` from it."""
    return log.withColumn("result", F.coalesce("result", "status"))


def summarise(log: DataFrame) -> DataFrame:
    """Number of checks per result, by day and mart."""
    return log.groupBy("run_date", "mart").agg(
        *[F.count_if(F.col("result").isin(*names)).alias(out) for out, names in RESULT_GROUPS.items()]
    )


# The two log layouts write WARN and WARNING for the same result.
RESULT_GROUPS = {"passed": ["PASS"], "warned": ["WARN", "WARNING"], "failed": ["FAIL"], "info": ["INFO"]}


def raise_on_failure(written_log: DataFrame, mart: str) -> None:
    """Raise if a check of ``mart`` failed. Call it on the log as written, so the rows survive."""
    failed = written_log.filter((F.col("mart") == mart) & (F.col("result") == "FAIL"))
    names = [r.check_name for r in failed.select("check_name").distinct().orderBy("check_name").collect()]
    if names:
        raise RuntimeError(f"{mart}: failed checks {names}")


def reconcile(staged: DataFrame, fact: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """One row: fact rows, staged rows, staged rows whose natural key (``{staged: fact}``) is not loaded."""
    counts = [
        rows("fact_total", fact),
        rows("staged_total", staged),
        uncovered("unresolved", staged, list(keys), fact, list(keys.values())),
    ]
    both = reduce(DataFrame.unionByName, counts)
    return both.agg(
        *[F.sum(F.when(F.col("check_name") == c, F.col("row_count"))).alias(c)
          for c in ("fact_total", "staged_total", "unresolved")]
    )


def differences(
    staged: DataFrame, fact: DataFrame, keys: Mapping[str, str], columns: Mapping[str, str], partition: str, buckets: int = 1024,
) -> DataFrame:
    """Keys whose rows differ between two tables, with ``difference`` missing (from the fact), extra or changed.

    ``keys`` and ``columns`` name what is compared (``{staged: fact}``); ``partition`` is one of the keys. Both tables are
    first reduced to signed sums of row hashes by partition and bucket of the key, which do not depend on any order; only
    buckets whose sums differ are compared key by key, and of the fact only their partitions are read again. Equal
    rows that repeat a different number of times count as changed.
    """
    types = {f.name: f.dataType for f in staged.schema.fields}
    pairs = {**keys, **columns}

    def values(names: Mapping[str, str]) -> list[Column]:
        """The columns and which of them are NULL, as a hash passes over NULLs."""
        return [c for n in names for c in (F.col(n), F.col(n).isNull())]

    def signed(df: DataFrame, names: Mapping[str, str], sign: int) -> DataFrame:
        # Equal values of different types have different hashes.
        same = df.select(*[F.col(source).cast(types[n]).alias(n) for n, source in names.items()])
        return same.select(*keys, F.pmod(F.xxhash64(*values(keys)), F.lit(buckets)).alias("_bucket"),
                           (F.xxhash64(*values(names)).cast("decimal(20,0)") * sign).alias("_row"), F.lit(sign).alias("_sign"))

    both = signed(staged, {n: n for n in pairs}, 1).unionByName(signed(fact, pairs, -1))
    unequal = (F.sum("_row") != 0) | (F.sum("_sign") != 0)
    leaves = both.groupBy(F.col(partition).alias("_part"), F.col("_bucket").alias("_leaf")).agg(unequal.alias("_unequal")).filter("_unequal")
    rest = both.join(leaves, F.col(partition).eqNullSafe(F.col("_part")) & (F.col("_bucket") == F.col("_leaf")), "left_semi")
    counted = rest.groupBy(*keys).agg(
        F.count_if(F.col("_sign") > 0).alias("_staged"), F.count_if(F.col("_sign") < 0).alias("_loaded"), unequal.alias("_unequal")
    )
    kind = F.when(F.col("_loaded") == 0, "missing").when(F.col("_staged") == 0, "extra").otherwise("changed")
    return counted.filter("_unequal").select(*keys, kind.alias("difference"))


class Suite:
    """Checks of one mart, collected check by check and run as one plan."""

    def __init__(self, mart: str):
        self.mart = mart
        self.counts: list[DataFrame] = []
        self.rules: dict[str, Rule] = {}

    def scan(self, df: DataFrame, checks: Mapping[str, tuple[Column, Rule]]) -> Suite:
        """Row-level checks of one frame; they share a single pass over it."""
        self.counts.append(tally(df, {name: test for name, (test, _) in checks.items()}))
        self.rules.update({name: rule for name, (_, rule) in checks.items()})
        return self

    def add(self, name: str, rule: Rule, count, *args) -> Suite:
        """A check by one of the counting functions: ``add(name, rule, orphans, fact, column, dim)``."""
        self.counts.append(count(name, *args))
        self.rules[name] = rule
        return self

    def refer(self, child: DataFrame, refs: Mapping[str, tuple[str, DataFrame, Rule]]) -> Suite:
        """Checks of several references of one frame; they share its scan, its shuffle and the join."""
        self.counts.append(references(child, {name: (column, parent) for name, (column, parent, _) in refs.items()}))
        self.rules.update({name: rule for name, (_, _, rule) in refs.items()})
        return self

    def run(self, as_of: date, run_id: Column | None = None) -> DataFrame:
        return run_checks(self.mart, self.counts, self.rules, as_of, run_id)
