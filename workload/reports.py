"""Every report dataset on the derived warehouse tables."""

from __future__ import annotations

from censusmart.reports import DATASETS
from censusmart.reports.charts import CHARTS, chart
from workload.registry import mean, pct, plain, register

MAP = "{dw_school_district_map}"


def live(dim: str) -> str:
    return f"(SELECT * FROM {{{dim}}} WHERE is_current)"


def people_sql(prefix: str, dim: str, fact: str, person: str, noun: str) -> dict[str, str]:
    """The datasets that the teacher and the staff mart share, by their names without prefix."""
    cur = live(dim)
    placed = f"SELECT m.district_name AS d, f.{person} AS p FROM {{{fact}}} f JOIN {MAP} m ON m.school_dim_id = f.school_id"
    per_district = f"SELECT d AS district_name, count(DISTINCT p) AS {noun} FROM ({placed}) AS x GROUP BY d"
    female = "count(*) FILTER (WHERE gender = 'F')"
    return {
        f"{prefix}_kpi_total": f"SELECT count(*) AS {noun} FROM {cur} AS c",
        f"{prefix}_kpi_male": f"SELECT count(*) AS total_male FROM {cur} AS c WHERE gender = 'M'",
        f"{prefix}_kpi_female": f"SELECT count(*) AS total_female FROM {cur} AS c WHERE gender = 'F'",
        f"{prefix}_kpi_pct_female": f"SELECT {pct(female, 'count(*)', 1)} AS pct_female FROM {cur} AS c",
        f"{prefix}_kpi_govt_payroll": f"SELECT count(*) AS on_govt_payroll FROM {cur} AS c WHERE is_on_government_payroll",
        f"{prefix}_top15_districts": f"{per_district} ORDER BY {noun} DESC, district_name LIMIT 15",
        f"{prefix}_bottom15_districts": f"{per_district} ORDER BY {noun}, district_name LIMIT 15",
    }


def breakdown_sql(dim: str, column: str, noun: str, name: str | None = None) -> str:
    return f"SELECT coalesce({column}, 'Unknown') AS {name or column}, count(*) AS {noun} FROM {live(dim)} AS c GROUP BY {column}"


def district_board(fact: str, person: str, dim: str, total: str, tail: str) -> str:
    who = f"SELECT DISTINCT m.district_name, c.* FROM {{{fact}}} f JOIN {live(dim)} c ON c.id = f.{person} JOIN {MAP} m ON m.school_dim_id = f.school_id"
    female = "count(*) FILTER (WHERE gender = 'F')"
    return (f"""SELECT district_name AS "District", count(*) AS "{total}", count(*) FILTER (WHERE gender = 'M') AS "Male", {female} AS "Female", {pct(female, 'count(*)', 1)} AS "% Female", {tail},"""
            f""" count(*) FILTER (WHERE is_on_government_payroll) AS "Govt Payroll" FROM ({who}) AS w GROUP BY district_name""")


SQL: dict[str, str] = {}

# ----------------------------------------------------------------------------- teachers
T, H = "dw_teacher_dim", "dw_hr_fact"
SQL |= people_sql("teachers", T, H, "teacher_id", "total_teachers")
SQL |= {f"teachers_by_{n}": breakdown_sql(T, c, "total_teachers") for n, c in {
    "type": "teacher_type", "gender": "gender", "discipline": "discipline", "qualification": "qualification", "designation": "designation"}.items()}
SQL["teachers_kpi_qualified"] = f"SELECT count(*) AS qualified_teachers FROM {live(T)} AS c WHERE teacher_type = 'QUALIFIED'"
SQL["teachers_trend_over_time"] = f"""
SELECT academic_year, term, 'FY' || CAST(academic_year AS VARCHAR) || ' ' || term AS period, count(DISTINCT c.id) AS total_teachers, count(DISTINCT c.id) FILTER (WHERE gender = 'M') AS male,
 count(DISTINCT c.id) FILTER (WHERE gender = 'F') AS female FROM {{dw_hr_fact}} f JOIN {live(T)} c ON c.id = f.teacher_id GROUP BY academic_year, term"""
SQL["teachers_district_leaderboard"] = district_board(
    H, "teacher_id", T, "Total Teachers", """count(*) FILTER (WHERE teacher_type = 'QUALIFIED') AS "Qualified\"""")
LEARNERS = "(SELECT school_id, count(*) AS k FROM {dw_enrolment_fact} GROUP BY school_id)"
SQL["teachers_ptr_by_district"] = f"""
SELECT m.district_name AS "District", count(DISTINCT f.school_id) AS "Schools", count(DISTINCT f.teacher_id) AS "Teachers", CAST(sum(e.k) AS BIGINT) AS "Learners", {pct('sum(e.k)', 'count(DISTINCT f.teacher_id)', 1, 1)} AS "PTR"
FROM {{dw_hr_fact}} f JOIN {MAP} m ON m.school_dim_id = f.school_id LEFT JOIN {LEARNERS} e ON e.school_id = f.school_id GROUP BY 1"""
SQL["teachers_ptr_by_district_dedup"] = f"""
WITH p AS (SELECT DISTINCT m.district_name, f.school_id, f.teacher_id FROM {{dw_hr_fact}} f JOIN {MAP} m ON m.school_dim_id = f.school_id),
a AS (SELECT district_name, count(*) AS s, CAST(sum(e.k) AS BIGINT) AS l FROM (SELECT DISTINCT district_name, school_id FROM p) q LEFT JOIN {LEARNERS} e USING (school_id) GROUP BY 1),
b AS (SELECT district_name, count(DISTINCT teacher_id) AS t FROM p GROUP BY 1)
SELECT district_name AS "District", s AS "Schools", t AS "Teachers", l AS "Learners", {pct('l', 't', 1, 1)} AS "PTR" FROM a JOIN b USING (district_name)"""

# ----------------------------------------------------------------------------- staff
N, NF = "dw_non_teaching_staff_dim", "dw_non_teaching_staff_fact"
SQL |= people_sql("nts", N, NF, "staff_id", "total_staff")
SQL |= {f"nts_by_{c}": breakdown_sql(N, c, "total_staff") for c in ("category", "gender", "role", "employment_status")}
SQL["nts_by_education_level"] = breakdown_sql(N, "highest_education_level", "total_staff", "education_level")
SQL["nts_kpi_schools"] = "SELECT count(*) AS schools_with_nts FROM (SELECT DISTINCT school_id FROM {dw_non_teaching_staff_fact}) AS s"
SQL["nts_trend_over_time"] = """SELECT academic_year, term, 'FY' || CAST(academic_year AS VARCHAR) || ' ' || term AS period, count(DISTINCT staff_id) AS total_staff FROM {dw_non_teaching_staff_fact} GROUP BY 1, 2"""
SQL["nts_district_leaderboard"] = district_board(
    NF, "staff_id", N, "Total Staff", """count(*) FILTER (WHERE category = 'ADMINISTRATIVE') AS "Administrative", count(*) FILTER (WHERE category = 'SUPPORT') AS "Support\"""")

# ----------------------------------------------------------------------------- infrastructure
I = "(SELECT * FROM {dw_infrastructure_fact} WHERE total_number > 0)"
TYPED = f"{I} f JOIN {{dw_infrastructure_type_dim}} k ON k.id = f.infra_type_id"
PLACED = f"{TYPED} JOIN {MAP} m ON m.school_dim_id = f.school_id"


def total(condition: str = "TRUE") -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN total_number END) AS BIGINT)"


def words(*parts: str) -> str:
    return "(" + " OR ".join(f"contains(lower(k.type_name), '{p}')" for p in parts) + ")"


SQL["infra_kpi_total_records"] = "SELECT count(id) AS total_records FROM {dw_infrastructure_fact}"
SQL["infra_kpi_schools"] = "SELECT count(DISTINCT school_id) AS schools_with_data FROM {dw_infrastructure_fact}"
SQL["infra_kpi_total_structures"] = f"SELECT {total()} AS total_structures FROM {I} AS f"
SQL["infra_kpi_complete"] = f"SELECT {total()} AS complete_structures FROM {I} AS f WHERE lower(completion_status) = 'complete'"
SQL["infra_kpi_permanent"] = f"SELECT {total()} AS permanent_structures FROM {I} AS f WHERE lower(usage_mode) = 'permanent'"
COMPLETE_SUM = "coalesce(sum(CASE WHEN lower(completion_status) = 'complete' THEN total_number END), 0)"
SQL["infra_kpi_pct_complete"] = f"SELECT {pct(COMPLETE_SUM, 'sum(total_number)', 1)} AS pct_complete FROM {I} AS f"
for column, missing in {"completion_status": "Unknown", "usage_mode": "Unknown", "structure_condition": "Not Recorded"}.items():
    SQL[f"infra_by_{column}"] = f"SELECT coalesce(upper(v), '{missing}') AS {column}, s AS total_structures FROM (SELECT {column} AS v, {total()} AS s FROM {I} AS f GROUP BY {column}) AS g"
SQL["infra_by_type"] = f"SELECT k.type_name AS structure_type, {total()} AS total_structures, count(DISTINCT f.school_id) AS schools FROM {TYPED} GROUP BY 1"
for name, (parts, head, schools, average) in {
    "infra_classrooms_by_district": (["classroom"], "Total Classrooms", "Schools", "Avg Classrooms per School"),
    "infra_latrines_by_district": (["latrine"], "Total Latrine Stances", "Schools", "Avg Stances per School"),
    "infra_labs_by_district": (["lab", "science"], "Total Labs", "Schools with Labs", None),
}.items():
    avg = f', {pct("sum(total_number)", "count(DISTINCT f.school_id)", 1, 1)} AS "{average}"' if average else ""
    SQL[name] = f'SELECT m.district_name AS "District", {total()} AS "{head}", count(DISTINCT f.school_id) AS "{schools}"{avg} FROM {PLACED} WHERE {words(*parts)} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20'
SQL["infra_top15_districts"] = f"SELECT m.district_name, count(DISTINCT f.school_id) AS schools_with_infra_data, {total()} AS total_structures FROM {I} f JOIN {MAP} m ON m.school_dim_id = f.school_id GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 15"
HEADS = {"Classrooms": ["classroom"], "Latrines": ["latrine"], "Labs": ["lab", "science"], "Libraries": ["library"], "Computer Labs": ["computer"]}
SQL["infra_full_leaderboard"] = 'SELECT m.district_name AS "District", count(DISTINCT f.school_id) AS "Schools", ' + ", ".join(
    f'coalesce({total(words(*p))}, 0) AS "{h}"' for h, p in HEADS.items()) + f', {total()} AS "Total Structures" FROM {PLACED} GROUP BY 1'

# ----------------------------------------------------------------------------- subjects
S = "{dw_teaching_subject_fact} f JOIN {dw_subject_dim} s ON s.id = f.subject_id"
DT = "count(DISTINCT f.teacher_id)"
SCI = f"{DT} FILTER (WHERE s.is_science_subject)"
SQL["subjects_kpi_total_assignments"] = "SELECT count(id) AS total_assignments FROM {dw_teaching_subject_fact}"
SQL["subjects_kpi_teachers_with_subjects"] = f"SELECT {DT} AS teachers_with_subjects FROM {{dw_teaching_subject_fact}} f"
SQL["subjects_kpi_total_subjects"] = "SELECT count(DISTINCT subject_id) AS total_subjects FROM {dw_teaching_subject_fact} f"
SQL["subjects_kpi_science_teachers"] = f"SELECT {SCI} AS science_teachers FROM {S}"
SQL["subjects_kpi_arts_teachers"] = f"SELECT {DT} FILTER (WHERE NOT s.is_science_subject) AS arts_teachers FROM {S}"
SQL["subjects_kpi_pct_science"] = f"SELECT {pct(SCI, DT, 1)} AS pct_science_teachers FROM {S}"
for name, column in {"subjects_by_category": "subject_category", "subjects_by_level": "subject_level"}.items():
    SQL[name] = f"SELECT coalesce(s.{column}, 'Unknown') AS {column}, {DT} AS total_teachers, count(DISTINCT s.id) AS total_subjects FROM {S} GROUP BY s.{column}" if column == "subject_level" \
        else f"SELECT s.{column}, {DT} AS total_teachers, count(DISTINCT s.id) AS total_subjects FROM {S} GROUP BY 1"
SQL["subjects_top20_by_teachers"] = f"SELECT s.subject_name, s.subject_category AS category, s.subject_level AS level, {DT} AS total_teachers FROM {S} GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 20"
SQL["subjects_science_vs_arts_by_district"] = f"""SELECT m.district_name, {SCI} AS science_teachers, {DT} FILTER (WHERE NOT s.is_science_subject) AS arts_teachers, {DT} AS total_teachers, {pct(SCI, DT, 1)} AS pct_science
FROM {S} JOIN {MAP} m ON m.school_dim_id = f.school_id GROUP BY 1 ORDER BY 5, 1 LIMIT 20"""
SQL["subjects_olevel_alevel_split"] = f"""SELECT CASE WHEN o IS TRUE AND a IS TRUE THEN 'Both O and A Level' WHEN o IS TRUE AND a IS FALSE THEN 'O Level Only' WHEN a IS TRUE AND o IS FALSE THEN 'A Level Only' ELSE 'Primary' END AS level_type,
count(DISTINCT teacher_id) AS total_teachers FROM (SELECT f.teacher_id, s.is_olevel_subject AS o, s.is_alevel_subject AS a FROM {S}) AS x GROUP BY 1"""
SQL["subjects_lab_subjects"] = f"SELECT s.subject_name, s.subject_category AS category, {DT} AS total_teachers FROM {S} WHERE s.has_lab_yn GROUP BY 1, 2"
YES = "CASE coalesce({}, FALSE) WHEN TRUE THEN 'Yes' ELSE 'No' END"
FLAGS = {"is_science_subject": "Science", "has_lab_yn": "Lab Required", "is_mandatory": "Mandatory", "is_examinable": "Examinable"}
SQL["subjects_full_leaderboard"] = 'SELECT subject_name AS "Subject", subject_level AS "Level", subject_category AS "Category", ' + ", ".join(
    f'{YES.format(c)} AS "{h}"' for c, h in FLAGS.items()) + f""", t AS "Teachers" FROM (SELECT s.subject_name, s.subject_level, s.subject_category, {', '.join('s.' + c for c in FLAGS)}, {DT} AS t FROM {S} GROUP BY ALL) AS g"""

# ----------------------------------------------------------------------------- indicators
SI, EI = "{dw_school_indicator_fact}", "{dw_enrolment_indicator_fact}"
OK = "ptr > 0 AND ptr < 200"
SQL["indicators_kpi_avg_ptr"] = f"SELECT {mean('ptr', 2, 1)} AS national_avg_ptr FROM {SI} WHERE {OK}"
SQL["indicators_kpi_avg_qualified_ratio"] = f"SELECT {mean('qualified_teacher_ratio', 2, 1)} AS avg_qualified_ratio FROM {SI} WHERE qualified_teacher_ratio > 0"
SQL["indicators_kpi_avg_pct_female_teachers"] = f"SELECT {mean('pct_female_teachers', 2, 1)} AS avg_pct_female_teachers FROM {SI} WHERE pct_female_teachers >= 0"
SQL["indicators_kpi_schools_with_data"] = f"SELECT count(DISTINCT school_id) AS schools_with_indicators FROM {SI}"
SQL["indicators_kpi_districts_with_data"] = f"SELECT count(DISTINCT district_id) AS districts_with_indicators FROM {EI}"
NEWEST = f"academic_year = (SELECT max(academic_year) FROM {EI})"
SQL["indicators_kpi_total_enrolment"] = f"SELECT CAST(sum(total_enrolment) AS BIGINT) AS total_enrolment FROM {EI} WHERE gender = 'TOTAL' AND {NEWEST}"
AT = f"{SI} s JOIN {MAP} m ON m.school_dim_id = s.school_id"
SQL["indicators_ptr_by_district"] = f"""SELECT district_name AS "District", {mean('ptr', 2, 1)} AS "Avg PTR", {mean('qualified_teacher_ratio', 2, 1)} AS "% Qualified Teachers", {mean('pct_female_teachers', 2, 1)} AS "% Female Teachers",
count(DISTINCT school_id) AS "Schools" FROM {AT} WHERE {OK} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""
SQL["indicators_ptr_distribution"] = f"""SELECT r AS ptr_range, count(*) AS schools FROM (SELECT (SELECT label FROM (VALUES (20, '0-20 (Very Low)'), (40, '21-40 (Low)'), (53, '41-53 (Acceptable)'), (70, '54-70 (High)'), (100, '71-100 (Very High)'), (9999, '100+ (Critical)')) AS b(top, label)
 WHERE s.ptr <= b.top ORDER BY top LIMIT 1) AS r FROM {SI} s WHERE ptr > 0 AND ptr < 500) AS x GROUP BY 1"""
SQL["indicators_enrolment_by_level_gender"] = f"""SELECT upper(trim(l)) AS school_level, gender, n AS total_enrolment, academic_year FROM (SELECT school_level AS l, gender, academic_year, CAST(sum(total_enrolment) AS BIGINT) AS n FROM {EI}
WHERE gender IN ('M', 'F') AND school_level IS NOT NULL AND {NEWEST} GROUP BY 1, 2, 3) AS g"""
SQL["indicators_enrolment_trend"] = f"""SELECT academic_year, upper(trim(l)) AS school_level, n AS total_enrolment FROM (SELECT academic_year, school_level AS l, CAST(sum(total_enrolment) AS BIGINT) AS n FROM {EI} WHERE gender = 'TOTAL' AND school_level IS NOT NULL GROUP BY 1, 2) AS g"""
IN_DISTRICT = f"{EI} e JOIN {{dw_admin_units_dim}} a ON a.id = e.district_id AND a.admin_unit_type = 'District' WHERE e.gender = 'TOTAL'"
SQL["indicators_gpi_by_district"] = f"""SELECT a.name AS "District", e.school_level AS "School Level", {mean('gpi_ger', 4, 2)} AS "GPI (GER)", {mean('gpi_ner', 4, 2)} AS "GPI (NER)", CAST(sum(total_enrolment) AS BIGINT) AS "Total Enrolment"
FROM {IN_DISTRICT} AND e.school_level IS NOT NULL GROUP BY 1, 2 ORDER BY 3 NULLS LAST, 1, 2 LIMIT 30"""
SQL["indicators_sne_by_district"] = f"""SELECT a.name AS "District", CAST(sum(learners_with_disability) AS BIGINT) AS "SNE Learners", CAST(sum(total_enrolment) AS BIGINT) AS "Total Enrolment", {pct('sum(learners_with_disability)', 'sum(total_enrolment)', 2)} AS "SNE Inclusion Rate %"
FROM {IN_DISTRICT} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""
for name, (column, out) in {"indicators_qualified_teacher_by_district": ("qualified_teacher_ratio", "avg_qualified_ratio"),
                            "indicators_female_teachers_by_district": ("pct_female_teachers", "avg_pct_female_teachers")}.items():
    SQL[name] = f"SELECT district_name, {mean(column, 2, 1)} AS {out} FROM {AT} WHERE {column} >= 0 GROUP BY 1 ORDER BY 2, 1 LIMIT 20"
SQL["indicators_ptr_over_time"] = f"""SELECT academic_year, term, 'FY' || CAST(academic_year AS VARCHAR) || ' ' || term AS period, {mean('ptr', 2, 1)} AS avg_ptr, {mean('qualified_teacher_ratio', 2, 1)} AS avg_qualified_ratio,
{mean('pct_female_teachers', 2, 1)} AS avg_pct_female FROM {SI} WHERE {OK} GROUP BY 1, 2"""


for dataset_name, dataset in DATASETS.items():
    register(dataset_name, lambda w, _build=dataset: plain(_build(w)), SQL[dataset_name])


# Row limits of the staff charts, stated here so that a wrong limit in the library shows.
LIMITS = {
    "nts_by_category": 50, "nts_by_gender": 50, "nts_by_employment_status": 50, "nts_by_role": 50,
    "nts_by_education_level": 50, "nts_top15_districts": 15, "nts_bottom15_districts": 15, "nts_trend_over_time": 50,
}


def chart_sql(name: str) -> str:
    spec = CHARTS[name]
    limit = LIMITS.get(name, spec.limit)
    keys = ", ".join(f'"{k}"' for k in [*spec.dims, *spec.series])
    values = ", ".join(
        f'CAST(sum("{c}") AS BIGINT) AS "{c}"' if how == "SUM" else f'max("{c}") AS "{c}"' if how == "MAX"
        else f'sum("{c}") / count("{c}") AS "{c}"' for how, c in spec.metrics)
    tail = f' GROUP BY {keys}' if keys else ""
    order = f' ORDER BY "{spec.metrics[0][1]}" DESC, {keys} LIMIT {limit}' if limit else ""
    return f"SELECT {keys + ', ' if keys else ''}{values} FROM ({SQL[name]}) AS d{tail}{order}"


for chart_name in CHARTS:
    # The averages of one-row groups divide by one: both engines give the value itself.
    register(f"chart_{chart_name}", lambda w, _name=chart_name: plain(chart(w, _name)), chart_sql(chart_name))
