"""Each operator on the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusmart.functions import calendar as cal
from censusmart.functions import labels as lab
from censusmart.functions import numbers as num
from censusmart.operators import asof, distinct, hierarchy, keys, lookup, quality, scd2, shape, upsert
from censusmart.plans import runner
from censusmart.reports.base import largest, smallest
from censusmart.session import cut_lineage
from censusmart.sources import files
from censusmart.streaming.incremental import advance, incremental, last_success
from workload.registry import pct, plain, query, stack

FIRST, SECOND = date(2024, 1, 1), date(2024, 6, 1)

# ----------------------------------------------------------------------------- versions

CUSTOMER_DIM = (
    "id bigint, source_id bigint, name string, nation bigint, segment string, premium boolean, effective_date date, "
    "expiration_date date, is_current boolean, change_hash string, change_reason string, changed_fields string"
)
CUSTOMER_SPEC = dict(
    keys=["source_id"], tracked={"name": "", "nation": "", "segment": "", "premium": "false"},
    reasons=[("name", "Renamed"), ("nation", "Moved")], default_reason="Attribute update", first_fields="ALL",
)


def customer_dim(w, **options):
    spec = scd2.Versioned(**{**CUSTOMER_SPEC, **options})
    empty = files.empty(w.spark, T.StructType.fromDDL(CUSTOMER_DIM))
    first = scd2.scd2_merge(empty, w["snap1"], spec, FIRST)
    return scd2.scd2_merge(first, w["snap2"], spec, SECOND)


HASHED = "md5(concat_ws('|', coalesce(name, ''), coalesce(CAST(nation AS VARCHAR), ''), coalesce(segment, ''), " \
         "coalesce(CAST(premium AS VARCHAR), 'false')))"
CUSTOMER_SQL = f"""
WITH a AS (SELECT *, {HASHED} AS h FROM {{snap1}}), b AS (SELECT *, {HASHED} AS h FROM {{snap2}}),
dim AS (
  SELECT a.source_id, a.name, a.nation, a.segment, a.premium, a.h AS change_hash, DATE '2024-01-01' AS effective_date,
         CASE WHEN b.h <> a.h THEN DATE '2024-05-31' ELSE DATE '9999-12-31' END AS expiration_date,
         coalesce(b.h = a.h, TRUE) AS is_current, 'INITIAL_LOAD' AS change_reason, 'ALL' AS changed_fields
  FROM a LEFT JOIN b USING (source_id)
  UNION ALL
  SELECT b.source_id, b.name, b.nation, b.segment, b.premium, b.h, DATE '2024-06-01', DATE '9999-12-31', TRUE,
         CASE WHEN a.source_id IS NULL THEN 'INITIAL_LOAD' WHEN @name THEN 'Renamed' WHEN @nation THEN 'Moved' ELSE 'Attribute update' END,
         CASE WHEN a.source_id IS NULL THEN 'ALL' ELSE concat_ws(',', CASE WHEN @name THEN 'name' END,
              CASE WHEN @nation THEN 'nation' END @rest) END
  FROM b LEFT JOIN a USING (source_id) WHERE a.source_id IS NULL OR a.h <> b.h)
"""


def customer_sql(tail: str, safe: bool = True) -> str:
    text = CUSTOMER_SQL
    for c in ("name", "nation", "segment", "premium"):
        text = text.replace(f"@{c}", f"a.{c} IS DISTINCT FROM b.{c}" if safe else f"a.{c} <> b.{c}")
    rest = "".join(f", CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in ("segment", "premium")) if safe else ""
    return text.replace("@rest", rest) + tail


VERSION_COLUMNS = [
    "source_id", "name", "nation", "segment", "premium", "effective_date", "expiration_date", "is_current", "change_hash",
    "change_reason", "changed_fields",
]


@query(customer_sql("SELECT * FROM dim"))
def scd2_merge(w):
    return customer_dim(w).select(VERSION_COLUMNS)


@query(customer_sql("SELECT source_id, change_reason, changed_fields FROM dim WHERE effective_date = DATE '2024-06-01'", False))
def scd2_change_reason(w):
    """The literal rule: NULL ↔ value changes expire the row but are not named."""
    dim = customer_dim(w, compat="unsafe", named=["name", "nation"])
    return dim.filter(F.col("effective_date") == F.lit(SECOND)).select("source_id", "change_reason", "changed_fields")


@query(customer_sql("""
SELECT count(*) FILTER (WHERE is_current) AS "current", count(*) FILTER (WHERE expiration_date = DATE '2024-05-31') AS expired, count(*) FILTER (WHERE effective_date = DATE '2024-06-01') AS inserted
FROM dim"""))
def scd2_merge_counts(w):
    return scd2.merge_counts(customer_dim(w), SECOND)


@query(customer_sql("""SELECT total, "current", total - "current" AS historical FROM (
SELECT count(*) AS total, CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) AS "current" FROM dim) AS t"""))
def scd2_version_counts(w):
    return scd2.version_counts(customer_dim(w))


@query(customer_sql("SELECT source_id, effective_date, changed_fields FROM dim WHERE changed_fields LIKE '%segment%'"))
def versions_changing_field(w):
    return scd2.versions_changing(customer_dim(w), "segment").select("source_id", "effective_date", "changed_fields")


@query(customer_sql("SELECT * EXCLUDE (change_hash) FROM dim WHERE source_id = 42"))
def version_history(w):
    return scd2.history_of(customer_dim(w), "source_id", 42).select([c for c in VERSION_COLUMNS if c != "change_hash"])


@query("""
SELECT a.source_id, a.expiration_date, b.effective_date AS next_effective_date FROM {customer_versions} a JOIN {customer_versions} b
ON b.source_id = a.source_id AND b.effective_date > a.effective_date WHERE a.expiration_date + 1 <> b.effective_date""")
def scd2_gap_check(w):
    gaps = scd2.version_gaps(w["customer_versions"], ["source_id"])
    return gaps.select("source_id", "expiration_date", "next_effective_date")


# ----------------------------------------------------------------------------- along time

@query("""
SELECT o.o_orderkey, o.day, v.id AS version_id FROM {order_terms} o JOIN {customer_versions} v
ON v.source_id = o.o_custkey AND o.day >= v.effective_date AND o.day < v.expiration_date""")
def asof_version_join(w):
    role = asof.Role(w["customer_versions"], "o_custkey", "version_id")
    return asof.version_at(w["order_terms"].select("o_orderkey", "o_custkey", "day"), role, "day").select(
        "o_orderkey", "day", "version_id")


@query("""
WITH p1 AS (
  SELECT o.*, c.id AS customer_id, s.id AS supplier_id FROM {order_terms} o
  JOIN {customer_versions} c ON c.source_id = o.o_custkey AND o.day >= c.effective_date AND o.day < c.expiration_date
  JOIN {supplier_versions} s ON s.source_id = o.suppkey AND o.day >= s.effective_date AND o.day < s.expiration_date),
f1 AS (SELECT * FROM p1 QUALIFY row_number() OVER (PARTITION BY o_custkey, suppkey, academic_year, term ORDER BY o_orderkey) = 1),
c1 AS (SELECT source_id, min_by(id, effective_date) AS id FROM {customer_versions} GROUP BY source_id),
s1 AS (SELECT source_id, min_by(id, effective_date) AS id FROM {supplier_versions} GROUP BY source_id),
p2 AS (
  SELECT o.*, c1.id AS customer_id, s1.id AS supplier_id FROM {order_terms} o JOIN c1 ON c1.source_id = o.o_custkey
  JOIN s1 ON s1.source_id = o.suppkey WHERE NOT EXISTS (SELECT 1 FROM f1 WHERE f1.o_custkey = o.o_custkey AND f1.suppkey = o.suppkey
  AND f1.academic_year = o.academic_year AND f1.term = o.term)),
f2 AS (SELECT * FROM p2 QUALIFY row_number() OVER (PARTITION BY o_custkey, suppkey, academic_year, term ORDER BY o_orderkey) = 1)
SELECT o_custkey, suppkey, academic_year, term, o_orderkey, customer_id, supplier_id, CAST(1 AS INTEGER) AS load_phase FROM f1
UNION ALL SELECT o_custkey, suppkey, academic_year, term, o_orderkey, customer_id, supplier_id, CAST(2 AS INTEGER) FROM f2""")
def asof_fallback_fact(w):
    natural = ["o_custkey", "suppkey", "academic_year", "term"]
    roles = [asof.Role(w["customer_versions"], "o_custkey", "customer_id"), asof.Role(w["supplier_versions"], "suppkey", "supplier_id")]
    facts = w["order_terms"].select(*natural, "o_orderkey", "day")
    loaded = asof.version_or_earliest(facts, roles, "day", natural, [F.col("o_orderkey")])
    return loaded.select(*natural, "o_orderkey", "customer_id", "supplier_id", "load_phase")


@query("""
SELECT e.event_id, e.user_id, e.ts, max(h.ts) AS previous_view, CAST(CAST(e.ts AS DATE) - CAST(max(h.ts) AS DATE) AS INTEGER) AS days
FROM {events} e LEFT JOIN {events} h ON h.user_id = e.user_id AND h.event_type = 'view' AND h.ts < e.ts
WHERE e.event_type = 'purchase' GROUP BY e.event_id, e.user_id, e.ts""")
def latest_before(w):
    """Each purchase with the same user's latest earlier view."""
    events = w["events"].filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = w["events"].filter(F.col("event_type") == "view").select("user_id", F.col("ts").alias("seen"))
    found = asof.latest_before(events, views, ["user_id"], "ts", "seen", "previous_view", slice_days=7)
    return found.withColumn("days", cal.days_between(F.col("ts").cast("date"), F.col("previous_view").cast("date")))


# ----------------------------------------------------------------------------- keyed writes

@query("""SELECT o_orderkey, o_orderstatus, 'old' AS origin FROM {orders} WHERE o_totalprice > 250000
UNION ALL SELECT o_orderkey, lower(o_orderstatus), 'new' FROM {orders} WHERE NOT o_totalprice > 250000""")
def insert_absent(w):
    orders = w["orders"]
    target = orders.filter("o_totalprice > 250000").select("o_orderkey", "o_orderstatus", F.lit("old").alias("origin"))
    new = orders.select("o_orderkey", F.lower("o_orderstatus").alias("o_orderstatus"), F.lit("new").alias("origin"))
    return upsert.insert_absent(target, new, ["o_orderkey"])


@query("""
SELECT coalesce(t.p_partkey, n.p_partkey) AS p_partkey, CASE WHEN n.p_partkey IS NULL THEN t.p_name ELSE upper(n.p_name) END AS p_name,
  CASE WHEN t.p_partkey IS NULL THEN n.p_brand ELSE t.p_brand END AS p_brand,
  CASE WHEN n.p_partkey IS NULL THEN t.p_size WHEN n.p_size = 3 THEN NULL ELSE n.p_size + 1 END AS p_size, t.p_type AS kept_type
FROM (SELECT * FROM {part} WHERE p_size > 10) t FULL JOIN (SELECT * FROM {part} WHERE p_size < 30) n ON n.p_partkey = t.p_partkey""")
def upsert_partial(w):
    """Only name and size are refreshed; the brand of known parts stays, new parts bring theirs."""
    part = w["part"]
    target = part.filter("p_size > 10").select("p_partkey", "p_name", "p_brand", "p_size", F.col("p_type").alias("kept_type"))
    new = part.filter("p_size < 30").select(
        "p_partkey", F.upper("p_name").alias("p_name"), "p_brand",
        F.when(F.col("p_size") != 3, F.col("p_size") + 1).alias("p_size"))
    return upsert.upsert(target, new, ["p_partkey"], ["p_name", "p_size"])


# ----------------------------------------------------------------------------- one row per key

@query("""SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM {orders} GROUP BY o_custkey""")
def latest_per_key(w):
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")]
    return keys.first_per_key(w["orders"].select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], order)


@query("SELECT source_id, min_by(id, effective_date) AS id, min(effective_date) AS effective_date FROM {customer_versions} GROUP BY source_id")
def earliest_per_key(w):
    return asof.earliest_version(w["customer_versions"]).select("source_id", "id", "effective_date")


@query("""
WITH s AS (SELECT s_suppkey, nullif(CAST(floor(s_acctbal / 150) AS BIGINT), 3) AS k FROM {supplier})
SELECT * FROM s WHERE k IS NULL OR k IN (SELECT k FROM s WHERE k IS NOT NULL GROUP BY k HAVING count(*) = 1)""")
def unique_or_null_key(w):
    keyed = w["supplier"].select("s_suppkey", F.nullif(F.floor(F.col("s_acctbal") / 150), F.lit(3)).alias("k"))
    return keys.unique_or_null(keyed, "k")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def duplicate_keys(w):
    return keys.duplicates(w["lineitem"], ["l_orderkey", "l_linenumber"])


# ----------------------------------------------------------------------------- hierarchy and lookups

CLIMB_SQL = """
WITH u AS (SELECT * FROM {dw_admin_units_dim} WHERE current_status), d AS (SELECT * FROM u WHERE admin_unit_type = 'District'),
one AS (SELECT x.id, x.admin_unit_type AS t, d.id AS district_id, d.name FROM u x JOIN d ON d.source_id = x.child_id),
two AS (SELECT x.id, x.admin_unit_type AS t, d.id AS district_id, d.name FROM u x JOIN u a ON a.source_id = x.child_id JOIN d ON d.source_id = a.child_id),
three AS (SELECT x.id, x.admin_unit_type AS t, d.id AS district_id, d.name FROM u x JOIN u a ON a.source_id = x.child_id
  JOIN u b ON b.source_id = a.child_id JOIN d ON d.source_id = b.child_id),
reach AS (
  SELECT id, id AS district_id, name FROM d
  UNION ALL SELECT id, district_id, name FROM one WHERE t IN ('County', 'Municipality', 'City')
  UNION ALL SELECT id, district_id, name FROM two WHERE t IN ('Sub County', 'Town Council')
  UNION ALL SELECT id, district_id, name FROM three WHERE t IN ('Parish', 'Ward'))
"""


@query(CLIMB_SQL + """SELECT r.id AS unit_dim_id, r.district_id AS district_dim_id, r.name AS district_name FROM reach r
WHERE r.id IN (SELECT admin_unit_id FROM {dw_schools_dim})""")
def hierarchy_rollup(w):
    """Units that schools belong to, with their districts."""
    used = w["dw.schools_dim"].select(F.col("admin_unit_id").alias("unit_dim_id"))
    return hierarchy.climb(w["dw.admin_units_dim"]).join(used, "unit_dim_id", "left_semi")


@query(CLIMB_SQL + """SELECT v.id AS school_dim_id, r.district_id, r.name AS district_name FROM {dw_schools_dim} v JOIN reach r ON r.id = v.admin_unit_id""")
def school_district_map(w):
    return hierarchy.district_map(w["dw.schools_dim"], hierarchy.climb(w["dw.admin_units_dim"]))


@query(CLIMB_SQL + "SELECT id AS unit_dim_id, count(DISTINCT district_id) AS districts FROM reach GROUP BY id HAVING count(DISTINCT district_id) > 1")
def units_with_several_districts(w):
    return hierarchy.several_districts(hierarchy.climb(w["dw.admin_units_dim"]))


ANCESTORS_SQL = """
SELECT * FROM (WITH RECURSIVE u AS (%s), up(unit_dim_id, unit_type, ancestor_dim_id, ancestor_name, ancestor_type, above, depth) AS (
  SELECT id, admin_unit_type, id, name, admin_unit_type, child_id, 0 FROM u
  UNION ALL SELECT unit_dim_id, unit_type, u.id, u.name, u.admin_unit_type, u.child_id, depth + 1 FROM up JOIN u ON u.source_id = up.above WHERE depth < 3)
SELECT * FROM up) AS t"""


@query(ANCESTORS_SQL % "SELECT * FROM {dw_admin_units_dim} WHERE current_status")
def unit_ancestors(w):
    return hierarchy.ancestors(w["dw.admin_units_dim"])


# Units after a change: a third of the counties move below another district, a tenth of the sub counties get a new version.
MOVED_UNITS = """SELECT CASE WHEN admin_unit_type = 'Sub County' AND source_id % 10 = 1 THEN id + 5000000
  WHEN admin_unit_type = 'County' AND source_id % 3 = 0 THEN id + 6000000 ELSE id END AS id,
  CASE WHEN admin_unit_type = 'County' AND source_id % 3 = 0 THEN child_id + 1 ELSE child_id END AS child_id, source_id, name, admin_unit_type, current_status
  FROM {dw_admin_units_dim} WHERE current_status"""


@query(ANCESTORS_SQL % MOVED_UNITS)
def unit_ancestors_refresh(w):
    """The stored table before the change, refreshed for the units that changed and those below them."""
    moved = (F.col("admin_unit_type") == "County") & (F.col("source_id") % 3 == 0)
    renewed = (F.col("admin_unit_type") == "Sub County") & (F.col("source_id") % 10 == 1)
    units = w["dw.admin_units_dim"].filter("current_status")
    after = units.withColumn("child_id", F.when(moved, F.col("child_id") + 1).otherwise(F.col("child_id"))).withColumn(
        "id", F.when(renewed, F.col("id") + 5000000).when(moved, F.col("id") + 6000000).otherwise(F.col("id")))
    return hierarchy.refreshed_ancestors(cut_lineage(w["dw.unit_ancestor"]), cut_lineage(after))


@query("""
SELECT c_custkey, coalesce((SELECT min(n_name) FROM {nation} WHERE n_nationkey = c_custkey % 40), (SELECT min(n_name) FROM {nation} WHERE n_nationkey = c_nationkey + 20),
 (SELECT min(n_name) FROM {nation} WHERE n_nationkey = c_nationkey AND c_acctbal > 4000)) AS place FROM {customer}""")
def first_available_lookup(w):
    ids = w["customer"].select(
        "c_custkey", (F.col("c_custkey") % 40).alias("a"), (F.col("c_nationkey") + 20).alias("b"),
        F.when(F.col("c_acctbal") > 4000, F.col("c_nationkey")).alias("c"))
    return lookup.first_available(ids, ["a", "b", "c"], w["nation"], "place", "n_nationkey", "n_name").select("c_custkey", "place")


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FILLED' WHEN 'O' THEN 'OPEN' END AS status, CASE o_orderstatus WHEN 'F' THEN 'FILLED' ELSE 'UNKNOWN' END
 AS strict_status, n_name AS nation, r_name AS region FROM {orders} LEFT JOIN {customer} ON c_custkey = o_custkey AND c_acctbal > 1000
 LEFT JOIN {nation} ON n_nationkey = c_nationkey LEFT JOIN {region} ON r_regionkey = n_regionkey""")
def lookup_decode(w):
    decoded = w["orders"].select(
        "o_orderkey", "o_custkey", lab.decode(F.col("o_orderstatus"), {"F": "FILLED", "O": "OPEN"}).alias("status"),
        lab.decode(F.col("o_orderstatus"), {"F": "FILLED"}, "UNKNOWN").alias("strict_status"))
    known = F.when(F.col("c_acctbal") > 1000, F.col("c_custkey")).otherwise(-1 - F.col("c_custkey"))
    named = lookup.lookup(decoded, w["customer"].withColumn("c_custkey", known), "o_custkey", {"c_nationkey": "nk"}, key="c_custkey")
    named = lookup.lookup(named, w["nation"], "nk", {"n_name": "nation", "n_regionkey": "rk"}, key="n_nationkey")
    named = lookup.lookup(named, w["region"], "rk", {"r_name": "region"}, key="r_regionkey")
    return named.drop("o_custkey", "nk", "rk")


@query("""
SELECT c.c_custkey, s.name AS supplier_nation, c2.name AS customer_nation, coalesce(s.k <> c2.k, FALSE) AS crosses
FROM (SELECT c_custkey, c_nationkey AS cn, CASE WHEN c_acctbal > 700 THEN (c_nationkey + c_custkey) % 27 END AS sn FROM {customer}) c
LEFT JOIN (SELECT n_nationkey AS k, n_name AS name FROM {nation}) s ON s.k = c.sn
LEFT JOIN (SELECT n_nationkey AS k, n_name AS name FROM {nation}) c2 ON c2.k = c.cn""")
def role_playing_join(w):
    c = w["customer"].select(
        "c_custkey", F.col("c_nationkey").alias("cn"),
        F.when(F.col("c_acctbal") > 700, (F.col("c_nationkey") + F.col("c_custkey")) % 27).alias("sn"))
    c = lookup.lookup(c, w["nation"], "sn", {"n_nationkey": "k1", "n_name": "supplier_nation"}, key="n_nationkey")
    c = lookup.lookup(c, w["nation"], "cn", {"n_nationkey": "k2", "n_name": "customer_nation"}, key="n_nationkey")
    return c.select("c_custkey", "supplier_nation", "customer_nation", lab.crosses(F.col("k1"), F.col("k2")).alias("crosses"))


# ----------------------------------------------------------------------------- labels

FLAG = "CASE ({}) % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END"


def _three(expr):
    return F.when(expr % 3 == 0, True).when(expr % 3 == 1, False)


@query(f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_nationkey > 15 THEN c_mktsegment END AS owner, {FLAG.format('c_custkey')} AS a, {FLAG.format('c_nationkey')} AS b,
  {FLAG.format('c_custkey + c_nationkey')} AS d FROM {{customer}})
SELECT c_custkey, CASE WHEN owner IS NOT NULL THEN owner WHEN a THEN 'GOVT AIDED' WHEN NOT a THEN 'PRIVATE' END AS owned_or_null,
  CASE WHEN owner IS NOT NULL THEN owner WHEN a THEN 'GOVT AIDED' ELSE 'PRIVATE' END AS owned,
  CASE WHEN a AND b THEN 'MIXED' WHEN b THEN 'FEMALES ONLY' WHEN a THEN 'MALES ONLY' END AS sex,
  CASE WHEN a AND NOT b THEN 'DAY SCHOOL' WHEN NOT a AND b THEN 'FULLY BOARDING' WHEN a AND b THEN 'DAY AND BOARDING' END AS residence,
  CASE WHEN a AND NOT b THEN 'NON RESIDENTIAL' WHEN NOT a AND b THEN 'RESIDENTIAL' WHEN a AND b THEN 'BOTH RES/NON' END AS institution,
  CASE WHEN a AND b THEN 'BOTH DECEASED' WHEN b THEN 'MOTHER DECEASED' WHEN a THEN 'FATHER DECEASED' ELSE 'NOT APPLICABLE' END AS orphan,
  (CASE WHEN a THEN 1 ELSE 0 END + CASE WHEN b THEN 1 ELSE 0 END + CASE WHEN d THEN 1 ELSE 0 END) >= 2 AS several,
  CASE WHEN a THEN 'LANGUAGE' WHEN b THEN 'SCIENCE' ELSE 'ARTS' END AS category,
  CASE WHEN a AND b THEN 'Both O and A Level' WHEN a AND NOT b THEN 'O Level Only' WHEN NOT a AND b THEN 'A Level Only' ELSE 'Primary' END AS level,
  CASE WHEN d THEN 'Yes' ELSE 'No' END AS d_text FROM c""")
def flag_labels(w):
    a, b, d = F.col("a"), F.col("b"), F.col("d")
    c = w["customer"].select(
        "c_custkey", F.when(F.col("c_nationkey") > 15, F.col("c_mktsegment")).alias("owner"), _three(F.col("c_custkey")).alias("a"),
        _three(F.col("c_nationkey")).alias("b"), _three(F.col("c_custkey") + F.col("c_nationkey")).alias("d"))
    return c.select(
        "c_custkey", lab.ownership(F.col("owner"), a, None).alias("owned_or_null"), lab.ownership(F.col("owner"), a, "PRIVATE").alias("owned"),
        lab.sex_composition(a, b).alias("sex"), lab.residence(a, b).alias("residence"),
        lab.residence(a, b, lab.INSTITUTION_RESIDENCE).alias("institution"), lab.orphan_status(a, b).alias("orphan"),
        lab.more_than_one([a, b, d]).alias("several"), lab.subject_category(a, b).alias("category"),
        lab.certificate_level(a, b).alias("level"), lab.yes_no(d).alias("d_text"))


@query("""
SELECT o_orderkey, trim(coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '') || ' ' || coalesce(CASE WHEN o_totalprice > 100000 THEN o_orderpriority END, '')) AS given_name,
  coalesce(CASE WHEN o_orderstatus = 'F' THEN 'KENYA' END, 'UGANDA') AS nationality, upper(coalesce(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END, 'Unknown')) AS level,
  coalesce(upper(CASE WHEN o_orderstatus = 'P' THEN 'transfer' END), 'CONTINUING') AS enrolment_type, CAST(2025 - year(o_orderdate) AS INTEGER) AS age,
  substr(o_orderpriority, 1, 4) AS cut, upper(o_orderpriority) LIKE '%_H%' OR upper(o_orderpriority) LIKE '5%' AS matched FROM {orders}""")
def text_defaults(w):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return w["orders"].select(
        "o_orderkey",
        lab.full_given_name(F.when(status != "P", status), F.when(F.col("o_totalprice") > 100000, priority)).alias("given_name"),
        lab.nationality(F.when(status == "F", "KENYA")).alias("nationality"),
        lab.school_level(F.when(status == "O", priority)).alias("level"),
        lab.enrolment_type(F.when(status == "P", "transfer")).alias("enrolment_type"),
        cal.age_in_year(date(2025, 1, 15), F.col("o_orderdate")).alias("age"),
        lab.cut(priority, 4).alias("cut"), lab.matches_any(priority, ["%_H%", "5%"]).alias("matched"))


# ----------------------------------------------------------------------------- pivots

@query("""
SELECT o_custkey, max(CASE WHEN o_orderpriority LIKE '%URGENT%' OR o_orderpriority LIKE '%HIGH%' THEN o_orderkey END) AS pressing,
 max(CASE WHEN o_orderpriority LIKE '%LOW%' THEN o_orderkey END) AS low FROM {orders} GROUP BY o_custkey""")
def identity_pivot(w):
    kind, value = F.col("o_orderpriority"), F.col("o_orderkey")
    return shape.pivot_max(w["orders"], ["o_custkey"], {
        "pressing": (lab.matches_any(kind, ["%URGENT%", "%HIGH%"]), value), "low": (lab.matches_any(kind, ["%LOW%"]), value)})


@query("""
SELECT o_orderkey, o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) OVER (PARTITION BY o_custkey) AS top_filled,
 max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) OVER (PARTITION BY o_custkey) AS last_open FROM {orders}""")
def window_pivot(w):
    rows = w["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    status = F.col("o_orderstatus")
    return shape.attach_max(rows, ["o_custkey"], {
        "top_filled": (status == "F", F.col("o_totalprice")), "last_open": (status == "O", F.col("o_orderkey"))}).drop("o_orderstatus", "o_totalprice")


@query("""
SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned, bool_or(l_returnflag IN ('A', 'N')) AS kept, bool_or(l_linestatus = 'O') AS open FROM {lineitem} GROUP BY l_orderkey""")
def bool_or_flags(w):
    text = w["lineitem"].select("l_orderkey", F.concat("l_returnflag", F.lit("-"), "l_linestatus").alias("t"))
    return shape.keyword_flags(text, "l_orderkey", "t", {"returned": ["R-%"], "kept": ["A-%", "N-%"], "open": ["%-O"]})


# ----------------------------------------------------------------------------- calendar

@query("""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS system_date, CAST(day(o_orderdate) AS INTEGER) AS "day", CAST(month(o_orderdate) AS INTEGER) AS "month", monthname(o_orderdate) AS month_name,
 upper(substr(monthname(o_orderdate), 1, 3)) AS short_month, CAST(year(o_orderdate) AS INTEGER) AS "year",
 CAST(CASE WHEN month(o_orderdate) > 6 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS INTEGER) AS "FY",
 CASE quarter(o_orderdate) WHEN 1 THEN 'Q3' WHEN 2 THEN 'Q4' WHEN 3 THEN 'Q1' ELSE 'Q2' END AS "Quarter" FROM {orders}""")
def calendar_dim(w):
    """The calendar rows of the order dates; the calendar itself spans the range of the orders."""
    days = w["orders"].select(F.col("o_orderdate").cast("date").alias("system_date")).distinct()
    calendar = cal.calendar_dim(w.spark, date(1992, 1, 1), date(2007, 12, 31)).drop("id")
    return calendar.join(days, "system_date", "left_semi")


@query("""
SELECT count(*) AS days, min(d) AS first_day, max(d) AS last_day, count(DISTINCT year(d)) AS years FROM (
 SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM (SELECT min(CAST(o_orderdate AS DATE))::TIMESTAMP AS lo, max(CAST(o_orderdate AS DATE))::TIMESTAMP AS hi FROM {orders}) AS r) AS t""")
def calendar_span(w):
    """Every day between the first and the last order."""
    span = w["orders"].agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"), F.max(F.col("o_orderdate").cast("date")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    return days.agg(F.count("d").alias("days"), F.min("d").alias("first_day"), F.max("d").alias("last_day"),
                    F.count_distinct(F.year("d")).alias("years"))


@query("""
WITH t AS (SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'F' THEN 'YEAR ' || CAST(year(o_orderdate) AS VARCHAR) WHEN 'O' THEN 'no digits'
   ELSE CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) || '0000000' END AS year_name,
   CASE substr(o_orderpriority, 1, 1) WHEN '4' THEN 'Term 2' WHEN '5' THEN 'X' ELSE substr(o_orderpriority, 1, 1) END AS term_name FROM {orders}),
u AS (SELECT *, CAST(coalesce(TRY_CAST(nullif(regexp_replace(year_name, '[^0-9]', '', 'g'), '') AS INTEGER), year(o_orderdate)) AS INTEGER) AS academic_year,
   CASE WHEN term_name IN ('1', '2', '3') THEN 'TERM ' || term_name WHEN term_name ILIKE 'term%' THEN upper(term_name) ELSE 'TERM 1' END AS term FROM t)
SELECT o_orderkey, academic_year, term, make_date(year(o_orderdate), CASE term WHEN 'TERM 2' THEN 6 WHEN 'TERM 3' THEN 9 ELSE 2 END, 1) AS starts,
   'FY' || CAST(academic_year AS VARCHAR) || ' ' || term AS period FROM u""")
def academic_term(w):
    day, status, priority = F.col("o_orderdate"), F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    year_text = F.year(day).cast("string")
    named = w["orders"].select(
        "o_orderkey", day,
        F.when(status == "F", F.concat(F.lit("YEAR "), year_text)).when(status == "O", "no digits").otherwise(
            F.concat(year_text, F.lit("/"), F.col("o_orderkey").cast("string"), F.lit("0000000"))).alias("year_name"),
        F.when(priority == "4", "Term 2").when(priority == "5", "X").otherwise(priority).alias("term_name"))
    typed = named.withColumn("academic_year", cal.academic_year(F.col("year_name"), day)).withColumn("term", cal.term_label(F.col("term_name")))
    return typed.select("o_orderkey", "academic_year", "term", cal.term_start(F.year(day), F.col("term")).alias("starts"),
                        cal.period_label(F.col("academic_year"), F.col("term")).alias("period"))


@query("""
WITH p AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS academic_year, CASE WHEN month(o_orderdate) >= 9 THEN 'TERM 3' WHEN month(o_orderdate) >= 6 THEN 'TERM 2' ELSE 'TERM 1' END AS term,
   CASE WHEN year(o_orderdate) = 1999 THEN 5 END AS only_nation FROM {orders})
SELECT s_suppkey, academic_year, term, make_date(academic_year, CASE term WHEN 'TERM 2' THEN 6 WHEN 'TERM 3' THEN 9 ELSE 2 END, 1) AS term_start
FROM {supplier} JOIN p ON only_nation IS NULL OR only_nation = s_nationkey""")
def period_expand(w):
    """Every supplier once per term; the terms of 1999 apply to one nation only."""
    rows = w["order_terms"].select("academic_year", "term").distinct()
    periods = rows.select(
        "academic_year", "term", cal.term_start(F.col("academic_year"), F.col("term")).alias("term_start"),
        F.when(F.col("academic_year") == 1999, 5).alias("only_nation"))
    return lookup.expand_periods(w["supplier"].select("s_suppkey", "s_nationkey"), periods, "s_nationkey", "only_nation").drop("s_nationkey")


# ----------------------------------------------------------------------------- ratios

@query("""
WITH c AS (SELECT l_suppkey, count(p_partkey) AS subjects, count(*) FILTER (WHERE p_size > 44) AS science FROM {lineitem}
   LEFT JOIN {part} ON p_partkey = l_partkey AND l_quantity > 49 AND p_retailprice > 950 GROUP BY l_suppkey)
SELECT s_suppkey, subjects, science, CASE WHEN subjects IS NULL OR subjects = 0 THEN NULL WHEN science = subjects THEN 'SCIENCE' WHEN science = 0 THEN 'ARTS' ELSE 'BOTH' END AS discipline,
   CASE WHEN subjects = 0 THEN NULL WHEN science = subjects THEN 'SCIENCE' WHEN science = 0 THEN 'ARTS' ELSE 'BOTH' END AS literal_rule FROM {supplier} LEFT JOIN c ON l_suppkey = s_suppkey""")
def discipline_label(w):
    """Subjects and sciences per school; lines of a small quantity and cheap parts have a key that the other side lacks."""
    known = F.when(F.col("p_retailprice") > 950, F.col("p_partkey")).otherwise(-1 - F.col("p_partkey"))
    parts = w["part"].select(known.alias("key"), "p_partkey", "p_size")
    taught = F.when(F.col("l_quantity") > 49, F.col("l_partkey")).otherwise(0)
    counted = w["lineitem"].select("l_suppkey", taught.alias("key")).join(parts, "key", "left").groupBy("l_suppkey").agg(
        F.count("p_partkey").alias("subjects"), F.count_if(F.col("p_size") > 44).alias("science"))
    rows = w["supplier"].select("s_suppkey").join(counted, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    n, s = F.col("subjects"), F.col("science")
    return rows.select("s_suppkey", n, s, lab.discipline(n, s).alias("discipline"), lab.discipline(n, s, compat=True).alias("literal_rule"))


@query(f"""
SELECT c_nationkey, n, urgent, filled, {pct('n', 'urgent', 2)} AS ger, {pct('urgent', 'n', 2)} AS rate, {pct('n', 'filled', 1, 1)} AS per_filled FROM (
 SELECT c_nationkey, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 480000) AS urgent, count(*) FILTER (WHERE o_orderstatus = 'F') AS filled
 FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey GROUP BY c_nationkey) AS t""")
def indicator_ratio(w):
    rows = w["orders"].join(w["customer"].select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
    counted = rows.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 480000)).alias("urgent"),
        F.count_if(F.col("o_orderstatus") == "F").alias("filled"))
    n, urgent = F.col("n"), F.col("urgent")
    return plain(counted.withColumns({"ger": num.percent(n, urgent, 2), "rate": num.percent(urgent, n, 2),
                                      "per_filled": num.ratio(n, F.col("filled"), 1)}))


STATUS_COUNTS = "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS p, o_orderstatus AS g, count(*) AS n FROM {orders} GROUP BY ALL"


def _status_counts(w):
    return w["orders"].groupBy(F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("g")).agg(
        F.count(F.lit(1)).alias("n"))


@query(f"WITH d AS ({STATUS_COUNTS}) SELECT * FROM d UNION ALL SELECT y, p, 'TOTAL', CAST(sum(n) AS BIGINT) FROM d WHERE g IN ('F', 'P') GROUP BY y, p")
def total_row_union(w):
    return shape.with_totals(_status_counts(w), ["y", "p"], ["n"], "g", members=F.col("g").isin("F", "P"))


@query(f"""
WITH d AS ({STATUS_COUNTS}), a AS (SELECT *, NULL AS gpi FROM d UNION ALL SELECT y, p, 'TOTAL', CAST(sum(n) AS BIGINT), NULL FROM d GROUP BY y, p)
SELECT a.y, a.p, a.g, a.n, CASE WHEN a.g = 'TOTAL' AND m.n > 0 THEN {pct('f.n', 'm.n', 4, 1)} END AS gpi FROM a
LEFT JOIN d m ON m.y = a.y AND m.p = a.p AND m.g = 'O' LEFT JOIN d f ON f.y = a.y AND f.p = a.p AND f.g = 'F'""")
def gender_parity(w):
    totals = shape.with_totals(_status_counts(w), ["y", "p"], ["n"], "g").withColumn("gpi", F.lit(None).cast("decimal(18,4)"))
    return plain(shape.parity(totals, ["y", "p"], "g", {"gpi": "n"}, ["F"], ["O"]))


@query("""
SELECT n_name, sum_n AS total, CAST(floor((sum_n * 55 + 500) / 1000) AS BIGINT) AS pop_age_3_5, CAST(floor((sum_n * 18 + 500) / 1000) AS BIGINT) AS pop_age_6, CAST(floor((sum_n * 125 + 500) / 1000) AS BIGINT) AS pop_age_6_12,
 CAST(floor((sum_n * 68 + 500) / 1000) AS BIGINT) AS pop_age_13_16, CAST(floor((sum_n * 32 + 500) / 1000) AS BIGINT) AS pop_age_17_18 FROM (
 SELECT n_name, count(*) * 1237 AS sum_n FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey GROUP BY n_name) AS t""")
def population_bands(w):
    rows = w["customer"].join(w["nation"], F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_name").agg((F.count(F.lit(1)) * 1237).alias("total"))
    return rows.withColumns(num.age_bands(F.col("total")))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_suppkey, l_partkey, CASE WHEN a IS NULL OR a < 0 OR a > 9999999999999.99 THEN NULL ELSE CAST(floor(a * 8) AS BIGINT) END AS eighths FROM (
 SELECT *, CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN -0.25 WHEN l_quantity = 3 THEN 1e15 ELSE l_quantity + 0.5 END AS a FROM {lineitem}) AS t""")
def status_range_guard(w):
    q = F.col("l_quantity")
    area = F.when(q == 2, -0.25).when(q == 3, 1e15).when(q != 1, q + 0.5)
    kept = num.guarded_area(area)
    return w["lineitem"].select("l_orderkey", "l_linenumber", q, "l_suppkey", "l_partkey", F.floor(kept.cast("double") * 8).alias("eighths"))


@query("""
SELECT CASE WHEN r <= 20 THEN '0-20 (Very Low)' WHEN r <= 40 THEN '21-40 (Low)' WHEN r <= 53 THEN '41-53 (Acceptable)' WHEN r <= 70 THEN '54-70 (High)'
 WHEN r <= 100 THEN '71-100 (Very High)' ELSE '100+ (Critical)' END AS range, count(*) AS n, min(r) AS low FROM (SELECT l_quantity * 5 - 5 AS r FROM {lineitem}) t WHERE r > 0 AND r < 200 GROUP BY 1""")
def range_distribution(w):
    """Ratios from 0 to 245: those in the report's open range fall into all six bands."""
    rows = w["lineitem"].select((F.col("l_quantity") * 5 - 5).alias("r")).filter("r > 0 and r < 200")
    return rows.groupBy(num.ptr_band(F.col("r")).alias("range")).agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("low")).orderBy("low")


# ----------------------------------------------------------------------------- set operations, tops, trends

@query("""SELECT DISTINCT l_suppkey AS person, CAST(n AS VARCHAR) AS subject FROM (SELECT l_suppkey, l_linenumber AS n FROM {lineitem} UNION SELECT l_suppkey, CAST(l_quantity AS INTEGER) % 9 FROM {lineitem}) AS t""")
def subject_union_distinct(w):
    """Two role columns as one list, each pair once: the pairs are exploded from one scan."""
    pairs = w["lineitem"].select("l_suppkey", F.array("l_linenumber", F.col("l_quantity").cast("int") % 9).alias("both"))
    once = pairs.select(F.col("l_suppkey").alias("person"), F.explode(F.array_distinct("both")).alias("subject")).distinct()
    return once.withColumn("subject", F.col("subject").cast("string"))


@query("""SELECT s_suppkey AS source_id, 'A' AS level, s_name AS name FROM {supplier} UNION ALL SELECT n_nationkey, 'B', n_name FROM {nation}""")
def stacked_inserts(w):
    a = w["supplier"].select(F.col("s_suppkey").alias("source_id"), F.lit("A").alias("level"), F.col("s_name").alias("name"))
    b = w["nation"].select(F.col("n_nationkey").cast("bigint").alias("source_id"), F.lit("B").alias("level"), F.col("n_name").alias("name"))
    return stack(a, b)


TOP = "SELECT n_name, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey JOIN {nation} ON n_nationkey = s_nationkey GROUP BY n_name"


def _nations(w):
    per_supplier = w["lineitem"].groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))
    placed = lookup.lookup(per_supplier, w["supplier"], "l_suppkey", {"s_nationkey": "nk"}, key="s_suppkey", how="inner")
    placed = lookup.lookup(placed, w["nation"], "nk", {"n_name": "n_name"}, key="n_nationkey", how="inner")
    return placed.groupBy("n_name").agg(F.sum("n").alias("n"), F.sum("qty").alias("qty"))


@query(f"{TOP} ORDER BY qty DESC, n_name LIMIT 7")
def top_n(w):
    return largest(_nations(w), "qty", "n_name", n=7)


@query(f"{TOP} ORDER BY qty, n_name LIMIT 7")
def bottom_n(w):
    return smallest(_nations(w), "qty", "n_name", n=7)


@query("""SELECT academic_year, term, 'FY' || CAST(academic_year AS VARCHAR) || ' ' || term AS period, count(DISTINCT o_custkey) AS customers, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS filled
FROM {order_terms} GROUP BY academic_year, term""")
def trend_by_period(w):
    per = w["order_terms"].groupBy("academic_year", "term", "o_custkey").agg(F.max(F.col("o_orderstatus") == "F").alias("f"))
    rows = per.groupBy("academic_year", "term").agg(F.count(F.lit(1)).alias("customers"), F.count_if("f").alias("filled"))
    return rows.withColumn("period", cal.period_label(F.col("academic_year"), F.col("term")))


@query(f"""
SELECT n_name, count(DISTINCT l_partkey) AS parts, count(DISTINCT CASE WHEN p_size > 25 THEN l_partkey END) AS large, count(DISTINCT CASE WHEN p_type = 'ECONOMY' THEN l_partkey END) AS economy,
 {pct("count(DISTINCT CASE WHEN p_size > 25 THEN l_partkey END)", "count(DISTINCT l_partkey)", 1)} AS pct_large, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS returned
FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey JOIN {{supplier}} ON s_suppkey = l_suppkey JOIN {{nation}} ON n_nationkey = s_nationkey GROUP BY n_name""")
def leaderboard(w):
    """Many conditional distinct counts: one row per nation and part first, plain counts after."""
    back = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint")).otherwise(F.lit(0))
    per_supplier = w["lineitem"].groupBy("l_suppkey", "l_partkey").agg(F.sum(back).alias("q"))
    placed = lookup.lookup(per_supplier, w["supplier"], "l_suppkey", {"s_nationkey": "nk"}, key="s_suppkey", how="inner")
    placed = lookup.lookup(placed, w["nation"], "nk", {"n_name": "n_name"}, key="n_nationkey", how="inner")
    per_part = placed.groupBy("n_name", "l_partkey").agg(F.sum("q").alias("q"))
    parts = lookup.lookup(per_part, w["part"], "l_partkey", {"p_size": "p_size", "p_type": "p_type"}, key="p_partkey", how="inner")
    large = F.count_if(F.col("p_size") > 25)
    return plain(parts.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("parts"), large.alias("large"), F.count_if(F.col("p_type") == "ECONOMY").alias("economy"),
        num.percent(large, F.count(F.lit(1)), 1).alias("pct_large"), F.sum("q").alias("returned")))


@query("""SELECT o_orderstatus, count(*) AS n, CAST(max(year(o_orderdate)) AS INTEGER) AS y FROM {orders} WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM {orders}) GROUP BY o_orderstatus""")
def latest_year_total(w):
    """The newest year as a date bound, so the filter can skip row groups."""
    newest = w["orders"].agg(F.date_trunc("year", F.max("o_orderdate")).cast("timestamp_ntz")).scalar()
    rows = w["orders"].filter(F.col("o_orderdate") >= newest)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max(F.year("o_orderdate")).alias("y"))


PTR = f"""SELECT s_nationkey, count(DISTINCT l_suppkey) AS schools, count(DISTINCT l_partkey) AS teachers, CAST(sum(learners) AS BIGINT) AS learners, {pct('sum(learners)', 'count(DISTINCT l_partkey)', 1, 1)} AS ptr
FROM {{lineitem}} JOIN {{supplier}} ON s_suppkey = l_suppkey LEFT JOIN (SELECT o_orderkey % 120 AS k, count(*) AS learners FROM {{orders}} GROUP BY 1) e ON e.k = l_suppkey GROUP BY s_nationkey"""


def _learners(w):
    return w["orders"].groupBy((F.col("o_orderkey") % 120).alias("k")).agg(F.count(F.lit(1)).alias("learners"))


@query(PTR)
def ptr_fanout(w):
    """As published: a school's learners count once per teacher row."""
    posts = w["lineitem"].groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("rows"))
    placed = lookup.lookup(posts, w["supplier"], "l_suppkey", {"s_nationkey": "s_nationkey"}, key="s_suppkey", how="inner")
    rows = placed.join(_learners(w), F.col("k") == F.col("l_suppkey"), "left").withColumn("x", F.col("learners") * F.col("rows"))
    return plain(rows.groupBy("s_nationkey").agg(
        F.count_distinct("l_suppkey").alias("schools"), F.count_distinct("l_partkey").alias("teachers"), F.sum("x").alias("learners"),
        num.ratio(F.sum("x"), F.count_distinct("l_partkey"), 1).alias("ptr")))


@query(f"""
WITH t AS (SELECT s_nationkey, count(DISTINCT l_partkey) AS teachers FROM {{lineitem}} JOIN {{supplier}} ON s_suppkey = l_suppkey GROUP BY s_nationkey),
l AS (SELECT s_nationkey, count(*) AS schools, CAST(sum(learners) AS BIGINT) AS learners FROM (SELECT DISTINCT l_suppkey FROM {{lineitem}}) d JOIN {{supplier}} ON s_suppkey = l_suppkey
  LEFT JOIN (SELECT o_orderkey % 120 AS k, count(*) AS learners FROM {{orders}} GROUP BY 1) e ON e.k = l_suppkey GROUP BY s_nationkey)
SELECT s_nationkey, schools, teachers, learners, {pct('learners', 'teachers', 1, 1)} AS ptr FROM t JOIN l USING (s_nationkey)""")
def ptr_dedup(w):
    posts = w["lineitem"].select("l_suppkey", "l_partkey").distinct()
    placed = lookup.lookup(posts, w["supplier"], "l_suppkey", {"s_nationkey": "s_nationkey"}, key="s_suppkey", how="inner")
    schools = placed.select("s_nationkey", "l_suppkey").distinct().join(_learners(w), F.col("k") == F.col("l_suppkey"), "left")
    left = schools.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("schools"), F.sum("learners").alias("learners"))
    right = placed.groupBy("s_nationkey").agg(F.count_distinct("l_partkey").alias("teachers"))
    both = left.join(right, "s_nationkey")
    return plain(both.withColumn("ptr", num.ratio(F.col("learners"), F.col("teachers"), 1)))


@query("SELECT count(DISTINCT c_custkey) AS total, count(DISTINCT CASE WHEN c_acctbal > 5000 THEN c_custkey END) AS rich, count(DISTINCT c_nationkey) AS nations FROM {customer}")
def kpi_counts(w):
    return w["customer"].agg(F.count_distinct("c_custkey").alias("total"), num.distinct_when(F.col("c_acctbal") > 5000, F.col("c_custkey")).alias("rich"),
                             F.count_distinct("c_nationkey").alias("nations"))


DISTINCT_AT = "SELECT '{level}' AS level, CAST({place} AS VARCHAR) AS place, count(DISTINCT l_partkey) AS parts, count(DISTINCT CAST(l_shipdate AS DATE)) AS days, count(*) AS lines FROM {{lineitem}} JOIN {{supplier}} ON s_suppkey = l_suppkey GROUP BY {place}"


@query(" UNION ALL ".join(DISTINCT_AT.format(level=level, place=place) for level, place in {"school": "l_suppkey", "district": "s_nationkey"}.items())
       + " UNION ALL SELECT 'nation', 'all', count(DISTINCT l_partkey), count(DISTINCT CAST(l_shipdate AS DATE)), count(*) FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey")
def distinct_rollup(w):
    """Distinct parts and days per school, district and nation from one set of bitmaps; days are dense by themselves."""
    rows = distinct.numbered(w["lineitem"].select("l_suppkey", "l_partkey", "l_shipdate"), "l_partkey", "part_no", near="l_suppkey")
    placed = lookup.lookup(rows, w["supplier"], "l_suppkey", {"s_nationkey": "s_nationkey"}, key="s_suppkey", how="inner")
    day = F.date_diff(F.col("l_shipdate").cast("date"), F.lit(date(1970, 1, 1))).cast("long")
    maps = distinct.bitmaps(placed, ["l_suppkey", "s_nationkey"], {"parts": F.col("part_no"), "days": day}, {"lines": F.lit(1)})
    levels = {"school": F.col("l_suppkey"), "district": F.col("s_nationkey"), "nation": F.lit("all")}
    return distinct.roll_up(maps, levels, ["parts", "days"], ["lines"])


@query(f"""SELECT {pct("count(DISTINCT CASE WHEN c_acctbal > 5000 THEN c_custkey END)", "count(DISTINCT c_custkey)", 1)} AS pct_rich FROM {{customer}}""")
def kpi_pct(w):
    per = w["customer"].select("c_custkey", (F.col("c_acctbal") > 5000).alias("rich")).distinct()
    return plain(per.agg(num.percent(F.count_if("rich"), F.count("c_custkey"), 1).alias("pct_rich")))


@query("""WITH e AS (SELECT user_id, CASE WHEN event_type = 'error' THEN NULL WHEN value > 100 THEN upper(event_type) ELSE event_type END AS kind FROM {events})
SELECT coalesce(upper(kind), 'Unknown') AS kind, count(DISTINCT user_id) AS users FROM e GROUP BY kind""")
def breakdown_unknown(w):
    """Grouped by the stored value: two spellings of one kind give two rows with one label."""
    e = w["events"].select("user_id", F.when(F.col("event_type") == "error", None).when(F.col("value") > 100, F.upper("event_type")).otherwise(F.col("event_type")).alias("kind"))
    rows = e.groupBy("kind").agg(F.count_distinct("user_id").alias("users"))
    return rows.withColumn("kind", lab.or_label(F.upper("kind")))


@query("""SELECT o_orderstatus, academic_year, max(o_orderkey) AS o_orderkey FROM {order_terms} GROUP BY ALL ORDER BY 3 DESC, o_orderstatus, academic_year LIMIT 9""")
def metric_layer(w):
    """A chart over a dataset: maximum by status, one series per year, nine rows."""
    return shape.apply_metric(w["order_terms"], ["o_orderstatus"], [("MAX", "o_orderkey")], ["academic_year"], 9)


@query("SELECT term, count(DISTINCT o_custkey) AS o_custkey, CAST(sum(o_orderkey) AS DOUBLE) / count(*) AS o_orderkey, min(day) AS day FROM {order_terms} GROUP BY term")
def metric_distinct(w):
    return shape.apply_metric(w["order_terms"], ["term"], [("COUNT_DISTINCT", "o_custkey"), ("AVG", "o_orderkey"), ("MIN", "day")])


# ----------------------------------------------------------------------------- loads and audit

@query("""SELECT (SELECT count(*) FROM {orders} WHERE o_totalprice > 100000) AS fact_total, (SELECT count(*) FROM {orders}) AS staged_total, (SELECT count(*) FROM {orders} WHERE o_totalprice <= 100000) AS unresolved""")
def load_reconcile(w):
    return quality.reconcile(w["orders"], w["orders"].filter("o_totalprice > 100000").select(F.col("o_orderkey").alias("k")), {"o_orderkey": "k"})


WATERMARK = "2024-01-20 12:00:00"


@query(f"SELECT event_id, user_id, ts FROM {{events}} WHERE ts >= TIMESTAMP '{WATERMARK}'")
def incremental_pull(w):
    return incremental(w["events"].select("event_id", "user_id", "ts"), "ts", F.lit(WATERMARK).cast("timestamp_ntz"))


@query("SELECT count(*) AS rows FROM {events} WHERE ts >= (SELECT min(ts) + INTERVAL 10 DAY FROM {events})")
def incremental_from_table(w):
    """The watermark comes from a table as a scalar subquery."""
    marks = w["events"].agg(F.expr("min(ts) + interval 10 days").alias("last_success_ts")).select(
        F.lit("events").alias("source_name"), "last_success_ts")
    return incremental(w["events"], "ts", last_success(marks, "events")).agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT source_name, max(ts) AS last_success_ts, CAST(max(run) AS INTEGER) AS last_run_id FROM (
 SELECT CASE WHEN value < 20 THEN event_type ELSE 'late ' || event_type END AS source_name, ts, 1 AS run FROM {events} UNION ALL SELECT 'click', ts, 2 FROM {events} WHERE event_type = 'click') AS t GROUP BY source_name""")
def watermark_advance(w):
    """The watermark of one source moves to the newest row it read; the others stay."""
    own = F.when(F.col("value") < 20, F.col("event_type")).otherwise(F.concat(F.lit("late "), "event_type"))
    marks = w["events"].groupBy(own.alias("source_name")).agg(
        F.max("ts").cast("timestamp").alias("last_success_ts"), F.lit(1).alias("last_run_id"))
    moved = advance(marks, "click", w["events"].filter(F.col("event_type") == "click"), "ts", 2)
    return moved.withColumn("last_success_ts", F.col("last_success_ts").cast("timestamp_ntz"))


@query("""SELECT run_id, status, CAST(1.5 AS DOUBLE) AS duration_mins FROM {runs} ORDER BY run_id DESC LIMIT 10""")
def audit_recent_runs(w):
    runs = w["runs"].withColumns({c: F.col(c).cast("timestamp") for c in ("start_ts", "end_ts")})
    return runner.recent_runs(runs).select("run_id", "status", "duration_mins")


@query("""SELECT o_custkey AS run_id, o_orderkey AS step_log_id, o_orderstatus AS status FROM {orders} WHERE o_custkey = 7""")
def audit_steps_of_run(w):
    steps = w["orders"].select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("step_log_id"), F.col("o_orderstatus").alias("status"))
    return runner.steps_of(steps, 7)


@query("""SELECT event_type AS check_name, event_id, CAST(ts AS TIMESTAMP) AS logged_at FROM {events} WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'""")
def audit_recent_checks(w):
    checks = w["events"].select(F.col("event_type").alias("check_name"), "event_id", F.col("ts").alias("logged_at"))
    return runner.recent_checks(checks, date(2024, 1, 25))


@query("SELECT user_id, '{{\"n\":' || CAST(count(*) AS VARCHAR) || ',\"top\":' || CAST(max(event_id) AS VARCHAR) || '}}' AS row_counts_json FROM {events} GROUP BY user_id".replace("{{", "{").replace("}}", "}"))
def row_counts_json(w):
    counted = w["events"].groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("top"))
    return counted.select("user_id", F.to_json(F.struct("n", "top")).alias("row_counts_json"))


@query("""SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM {events} WHERE event_type <> 'error'""")
def json_row_copy(w):
    """Rows that travel as JSON text; unreadable ones are set aside."""
    text = F.to_json(F.struct("event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")))
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("{oops"), "props")).otherwise(text)
    parsed = files.parse_json_rows(w["events"].select(broken.alias("t")), "t", _json_schema())
    return files.split_rejects(parsed)[0]


@query("SELECT count(*) FILTER (WHERE event_type <> 'error') AS copied, count(*) FILTER (WHERE event_type = 'error') AS skipped FROM {events}")
def json_copy_counts(w):
    broken = F.when(F.col("event_type") == "error", F.lit("{oops")).otherwise(F.to_json(F.struct("event_id", "user_id")))
    return files.copy_counts(files.parse_json_rows(w["events"].select(broken.alias("t")), "t", _json_schema()))


def _json_schema():
    return T.StructType.fromDDL("event_id bigint, user_id bigint, k bigint")
