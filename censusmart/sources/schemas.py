"""Declared schemas of the staging, warehouse and audit tables.

Reads never infer types: every file source is opened with one of these.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the warehouse contract.
DDL: dict[str, str] = {
    "stg.learners_raw": """
        person_id BIGINT, lin STRING, surname STRING, given_name STRING, date_of_birth DATE, gender
        STRING, nationality STRING, district_of_birth_id BIGINT, nin STRING, passport_no STRING,
        student_pass_no STRING, work_permit_no STRING, refugee_id STRING, is_flagged_yn BOOLEAN,
        deleted_at TIMESTAMP_NTZ, date_created TIMESTAMP_NTZ, date_updated TIMESTAMP_NTZ""",
    "stg.learner_disabilities_raw": """
        id BIGINT, learner_id BIGINT, disability_type STRING, severity STRING, date_created
        TIMESTAMP_NTZ, date_updated TIMESTAMP_NTZ""",
    "stg.enrolments_raw": """
        id BIGINT, learner_id BIGINT, school_id BIGINT, academic_year_id BIGINT, teaching_period_id
        BIGINT, reporting_status_id BIGINT, learner_promotion_status_id BIGINT,
        learner_transfer_status_id BIGINT, learner_transition_status_id BIGINT,
        learner_registration_number STRING, is_enrolment_active_yn BOOLEAN, date_created
        TIMESTAMP_NTZ, date_updated TIMESTAMP_NTZ""",
    "stg.enrolments_subtype_raw": """
        enrolment_id BIGINT, school_level STRING, education_class_id BIGINT, education_class_name
        STRING, familiar_language_id BIGINT, familiar_language_name STRING, date_created
        TIMESTAMP_NTZ""",
    "stg.learner_promotions_raw": """
        id BIGINT, learner_id BIGINT, school_id BIGINT, academic_year_id BIGINT, from_class_id
        BIGINT, to_class_id BIGINT, promotion_status_id BIGINT, promotion_status_name STRING,
        date_created TIMESTAMP_NTZ, date_updated TIMESTAMP_NTZ""",
    "stg.learner_transitions_raw": """
        id BIGINT, learner_id BIGINT, from_school_id BIGINT, to_school_id BIGINT, academic_year_id
        BIGINT, transition_status_id BIGINT, transition_status_name STRING, date_created
        TIMESTAMP_NTZ, date_updated TIMESTAMP_NTZ""",
    "stg.enrolments_flat": """
        id BIGINT, enrolment_source_id BIGINT, learner_source_id BIGINT, school_source_id BIGINT,
        academic_year INT, term STRING, lin STRING, gender STRING, age INT, nationality STRING, nin
        STRING, passport_no STRING, student_pass_no STRING, work_permit_no STRING, refugee_id
        STRING, orphan_status STRING, is_visual_yn BOOLEAN, is_hearing_yn BOOLEAN, is_walking_yn
        BOOLEAN, is_self_care_yn BOOLEAN, is_remembering_yn BOOLEAN, is_communication_yn BOOLEAN,
        has_multiple_disabilities_yn BOOLEAN, grade STRING, school_level STRING, enrolment_type
        STRING, is_active BOOLEAN, school_emis_number STRING, school_name STRING, school_ownership
        STRING, school_funding_type STRING, school_sex_composition STRING, school_boarding_status
        STRING, school_type STRING, admin_unit_source_id BIGINT, change_hash STRING, change_reason
        STRING, changed_fields STRING""",
    "stg.population_raw": """
        id BIGINT, district_name STRING, district_source_id BIGINT, year INT, sex STRING,
        total_population BIGINT, pop_age_3_5 BIGINT, pop_age_6_12 BIGINT, pop_age_13_16 BIGINT,
        pop_age_17_18 BIGINT, pop_age_6 BIGINT, data_source STRING, date_loaded TIMESTAMP_NTZ""",
    "stg.enrolment_indicator_raw": """
        id BIGINT, district_id BIGINT, district_name STRING, school_level STRING, academic_year INT,
        gender STRING, total_enrolment BIGINT, official_age_enrolment BIGINT, new_entrants_p1
        BIGINT, new_entrants_p1_official_age BIGINT, repeaters BIGINT, learners_with_disability
        BIGINT, school_age_population BIGINT, population_age_6 BIGINT, ger DECIMAL(8,2), ner
        DECIMAL(8,2), gir DECIMAL(8,2), repetition_rate DECIMAL(8,2), sne_inclusion_rate
        DECIMAL(8,2), date_computed TIMESTAMP_NTZ""",
    "stg.school_indicator_raw": """
        id BIGINT, school_source_id BIGINT, school_name STRING, school_type STRING, district_id BIGINT,
        academic_year INT, term STRING, total_learners INT, male_learners INT, female_learners INT,
        total_teachers INT, male_teachers INT, female_teachers INT, qualified_teachers INT,
        trained_teachers INT, ptr DECIMAL(8,2), qualified_teacher_ratio DECIMAL(8,2),
        trained_teacher_ratio DECIMAL(8,2), pct_female_teachers DECIMAL(8,2), gpi_ptr DECIMAL(8,4),
        date_computed TIMESTAMP_NTZ""",
    "stg.infrastructure_raw": """
        id BIGINT, building_status_id BIGINT, school_id BIGINT, school_name STRING, school_type
        STRING, admin_unit_source_id BIGINT, building_id BIGINT, building_name STRING, item_category
        STRING, infrastructure_type_id BIGINT, infrastructure_type_name STRING, is_lab_yn BOOLEAN,
        is_sanitation_yn BOOLEAN, is_area_captured_yn BOOLEAN, gender_usage_yn BOOLEAN,
        user_category_yn BOOLEAN, academic_year INT, term STRING, total_number INT, area
        DECIMAL(15,2), completion_status STRING, usage_mode STRING, structure_condition STRING,
        gender_usage STRING, user_category STRING, date_created TIMESTAMP_NTZ, date_updated
        TIMESTAMP_NTZ""",
    "stg.non_teaching_staff_raw": """
        person_id BIGINT, employee_id BIGINT, nts_employee_id BIGINT, surname STRING, given_name
        STRING, gender STRING, date_of_birth DATE, nationality STRING, nin STRING, category STRING,
        role STRING, is_transfer_appointment BOOLEAN, appointment_date DATE, posting_date DATE,
        current_school_id BIGINT, highest_education_level STRING, employment_status STRING,
        is_on_government_payroll BOOLEAN, ipps_number STRING, hrin STRING, hcm_employee_number
        STRING, date_started DATE, date_ended DATE, is_undergoing_training BOOLEAN, date_created
        TIMESTAMP_NTZ, date_updated TIMESTAMP_NTZ""",
    "stg.non_teaching_staff_school_raw": """
        id BIGINT, employee_id BIGINT, person_id BIGINT, school_id BIGINT, posting_date DATE,
        reporting_date DATE, status SMALLINT, date_created TIMESTAMP_NTZ, date_updated TIMESTAMP_NTZ""",
    "stg.non_teaching_staff_flat": """
        id BIGINT, person_id BIGINT, employee_id BIGINT, school_id BIGINT, academic_year INT, term
        STRING, term_start_date DATE, surname STRING, given_name STRING, gender STRING, age INT,
        nationality STRING, nin STRING, category STRING, role STRING, posting_date DATE,
        highest_education_level STRING, employment_status STRING, is_on_government_payroll BOOLEAN,
        ipps_number STRING, hrin STRING, hcm_employee_number STRING, is_undergoing_training BOOLEAN,
        school_emis_number STRING, school_name STRING, school_type STRING, school_ownership STRING,
        admin_unit_source_id BIGINT, is_primary_school BOOLEAN, change_hash STRING, change_reason
        STRING, changed_fields STRING""",
    "stg.schools_raw": """
        id BIGINT, school_type_id BIGINT, logo STRING, name STRING, old_emis_number STRING,
        emis_number STRING, is_government_owned_yn BOOLEAN, school_ownership_status_id BIGINT,
        legal_ownership_status_id BIGINT, ownership_category_id BIGINT, license_number STRING,
        registration_number STRING, registration_certificate_status SMALLINT, registration_status_id
        BIGINT, licence_certificate_expiry_date DATE, registration_certificate_expiry_date DATE,
        has_license_or_registration_certificate BOOLEAN, is_certificate_system_generated BOOLEAN,
        public_service_school_code STRING, is_public_school BOOLEAN, supply_number STRING,
        physical_address STRING, postal_address STRING, district_id BIGINT, county_id BIGINT,
        sub_county_id BIGINT, parish_id BIGINT, village_id BIGINT, region_id BIGINT,
        local_government_id BIGINT, latitude DOUBLE, longitude DOUBLE, email STRING, phone STRING,
        website STRING, has_health_facility_yn BOOLEAN, health_facility_distance_range_id BIGINT,
        self_examines_yn BOOLEAN, examining_body_id BIGINT, center_number STRING, has_male_students
        BOOLEAN, has_female_students BOOLEAN, founding_body_id BIGINT, year_founded INT,
        funding_source_id BIGINT, school_land_area STRING, land_owner_type_id BIGINT,
        is_operational_yn BOOLEAN, capital_for_establishment STRING, school_closure_reason STRING,
        is_commissioned BOOLEAN, date_commissioned TIMESTAMP_NTZ, date_created TIMESTAMP_NTZ,
        date_updated TIMESTAMP_NTZ, operational_status_id BIGINT, suspension_reason_id BIGINT,
        admin_unit_id BIGINT""",
    "stg.schools_flat": """
        id BIGINT, source_id BIGINT, name STRING, admin_unit_id BIGINT, emis_number STRING, school_type
        STRING, operational_status STRING, ownership_status STRING, funding_type STRING,
        sex_composition STRING, boarding_status STRING, founding_body_type STRING, effective_date
        DATE, expiration_date DATE, is_current BOOLEAN, change_hash STRING, change_reason STRING,
        changed_fields STRING""",
    "stg.admin_units_raw": """
        id BIGINT, parent_id BIGINT, admin_unit_type STRING, name STRING, admin_unit_code STRING,
        voting_code STRING, effective_date DATE, expiration_date DATE, current_status BOOLEAN,
        source_id BIGINT""",
    "stg.school_location_details_raw": """
        id BIGINT, school_id BIGINT, physical_address STRING, postal_address STRING, admin_unit_id
        BIGINT, latitude DECIMAL(10,7), longitude DECIMAL(10,7), effective_date DATE,
        expiration_date DATE, is_current BOOLEAN, date_created DATE""",
    "stg.teachers_raw": """
        person_id BIGINT, employee_id BIGINT, surname STRING, given_name STRING, gender STRING,
        date_of_birth DATE, nationality STRING, nin STRING, passport_no STRING, teacher_type STRING,
        qualification STRING, qualification_category STRING, designation STRING, ipps_number STRING,
        tmis_number STRING, moes_license_number STRING, is_on_government_payroll BOOLEAN,
        first_appointment_date DATE, posting_date DATE, subject_category STRING,
        highest_education_level STRING, employment_status STRING, hrin STRING, hcm_employee_number
        STRING, date_started DATE, date_ended DATE, weekly_teaching_periods SMALLINT,
        is_undergoing_training BOOLEAN, discipline STRING, current_school_id BIGINT, date_created
        TIMESTAMP_NTZ, date_updated TIMESTAMP_NTZ""",
    "stg.teacher_subjects_raw": """
        id BIGINT, employee_id BIGINT, person_id BIGINT, subject_id BIGINT, subject_name STRING,
        is_science_subject BOOLEAN, is_language_subject BOOLEAN, date_created TIMESTAMP_NTZ,
        date_updated TIMESTAMP_NTZ""",
    "stg.teacher_school_raw": """
        employee_id BIGINT, person_id BIGINT, school_id BIGINT, is_transfer_appointment BOOLEAN,
        appointment_date DATE, staff_category STRING, date_created TIMESTAMP_NTZ, date_updated
        TIMESTAMP_NTZ""",
    "stg.teachers_flat": """
        id BIGINT, person_id BIGINT, employee_id BIGINT, school_id BIGINT, academic_year INT, term
        STRING, term_start_date DATE, surname STRING, given_name STRING, gender STRING, age INT,
        nationality STRING, nin STRING, passport_no STRING, teacher_type STRING, qualification
        STRING, qualification_category STRING, designation STRING, discipline STRING, ipps_number
        STRING, tmis_number STRING, moes_license_number STRING, is_on_government_payroll BOOLEAN,
        first_appointment_date DATE, posting_date DATE, highest_education_level STRING,
        employment_status STRING, hrin STRING, hcm_employee_number STRING, weekly_teaching_periods
        SMALLINT, is_undergoing_training BOOLEAN, school_emis_number STRING, school_name STRING,
        school_type STRING, school_ownership STRING, school_level STRING, admin_unit_source_id
        BIGINT, change_hash STRING, change_reason STRING, changed_fields STRING""",
    "stg.teacher_transfers_raw": """
        transfer_id BIGINT, person_id BIGINT, employee_id BIGINT, outgoing_employee_id BIGINT,
        outgoing_school_id BIGINT, incoming_school_id BIGINT, outgoing_school_name STRING,
        incoming_school_name STRING, outgoing_school_type STRING, incoming_school_type STRING,
        outgoing_district_id BIGINT, incoming_district_id BIGINT, outgoing_district_name STRING,
        incoming_district_name STRING, is_inter_district BOOLEAN, posting_date DATE, reporting_date
        DATE, transfer_status STRING, appointment_minute_number STRING, category_id BIGINT,
        days_at_outgoing_station INT, teacher_type STRING, gender STRING, qualification STRING,
        discipline STRING, ipps_number STRING, date_created TIMESTAMP_NTZ, date_updated
        TIMESTAMP_NTZ""",
    "stg.subject_dim_raw": """
        source_id BIGINT, subject_level STRING, subject_name STRING, is_language_subject BOOLEAN,
        is_science_subject BOOLEAN, is_principal_subject BOOLEAN, is_olevel_subject BOOLEAN,
        is_alevel_subject BOOLEAN, is_mandatory BOOLEAN, is_examinable BOOLEAN, has_lab_yn BOOLEAN,
        is_active_yn BOOLEAN, is_archived_yn BOOLEAN, date_created TIMESTAMP_NTZ, date_updated
        TIMESTAMP_NTZ""",
    "stg.teaching_subject_flat": """
        id BIGINT, person_id BIGINT, employee_id BIGINT, subject_id BIGINT, subject_name STRING,
        subject_level STRING, is_science_subject BOOLEAN, is_language_subject BOOLEAN,
        is_principal_subject BOOLEAN, is_olevel_subject BOOLEAN, is_alevel_subject BOOLEAN,
        school_id BIGINT, school_name STRING, school_type STRING, teacher_type STRING, gender
        STRING, qualification STRING, admin_unit_source_id BIGINT, date_created TIMESTAMP_NTZ,
        date_updated TIMESTAMP_NTZ""",
    "dw.date_dim": """
        id BIGINT, system_date DATE, day INT, month INT, month_name STRING, short_month STRING, year
        INT, FY INT, Quarter STRING""",
    "dw.admin_units_dim": """
        id BIGINT, child_id BIGINT, admin_unit_type STRING, name STRING, admin_unit_code STRING,
        voting_code STRING, effective_date DATE, expiration_date DATE, current_status BOOLEAN,
        source_id BIGINT""",
    "dw.schools_dim": """
        id BIGINT, source_id BIGINT, name STRING, admin_unit_id BIGINT, emis_number STRING, school_type
        STRING, operational_status STRING, ownership_status STRING, funding_type STRING,
        sex_composition STRING, boarding_status STRING, founding_body_type STRING, effective_date
        DATE, expiration_date DATE, is_current BOOLEAN, change_hash STRING, change_reason STRING,
        changed_fields STRING""",
    "dw.school_location_details_dim": """
        id BIGINT, school_id BIGINT, physical_address STRING, postal_address STRING, admin_unit_id BIGINT,
        latitude DOUBLE, longitude DOUBLE, effective_date DATE, expiration_date DATE, is_current
        BOOLEAN, date_created DATE""",
    "dw.school_fact": """
        id BIGINT, school_id BIGINT, date_id BIGINT, location_time TIMESTAMP""",
    "dw.learner_dim": """
        id BIGINT, source_id BIGINT, lin STRING, gender STRING, age_at_load INT, nationality STRING,
        orphan_status STRING, nin STRING, passport_no STRING, student_pass_no STRING, work_permit_no
        STRING, refugee_id STRING, is_visual_yn BOOLEAN, is_hearing_yn BOOLEAN, is_walking_yn
        BOOLEAN, is_self_care_yn BOOLEAN, is_remembering_yn BOOLEAN, is_communication_yn BOOLEAN,
        has_multiple_disabilities_yn BOOLEAN, effective_date DATE, expiration_date DATE, is_current
        BOOLEAN, change_hash STRING, change_reason STRING, changed_fields STRING""",
    "dw.grade_dim": """
        id BIGINT, grade_code STRING, grade_name STRING, school_level STRING, sort_order INT""",
    "dw.enrolment_type_dim": """
        id BIGINT, source_id BIGINT, enrolment_type STRING, description STRING""",
    "dw.orphan_type_dim": """
        id BIGINT, orphan_status STRING, description STRING""",
    "dw.disability_type_dim": """
        id BIGINT, disability_code STRING, disability_name STRING, description STRING""",
    "dw.enrolment_fact": """
        id BIGINT, learner_id BIGINT, school_id BIGINT, grade_id BIGINT, date_id BIGINT, enrolment_type_id BIGINT,
        learner_source_id BIGINT, school_source_id BIGINT, enrolment_source_id BIGINT, academic_year
        INT, term STRING, load_time TIMESTAMP""",
    "dw.population_fact": """
        id BIGINT, district_id BIGINT, district_name STRING, year INT, sex STRING, total_population
        BIGINT, pop_age_3_5 BIGINT, pop_age_6_12 BIGINT, pop_age_13_16 BIGINT, pop_age_17_18 BIGINT,
        pop_age_6 BIGINT, data_source STRING, load_time TIMESTAMP""",
    "dw.enrolment_indicator_fact": """
        id BIGINT, district_id BIGINT, date_id BIGINT, school_level STRING, academic_year INT, gender
        STRING, total_enrolment BIGINT, official_age_enrolment BIGINT, new_entrants_p1 BIGINT,
        new_entrants_p1_official_age BIGINT, repeaters BIGINT, learners_with_disability BIGINT,
        school_age_population BIGINT, population_age_6 BIGINT, ger DECIMAL(8,2), ner DECIMAL(8,2),
        gir DECIMAL(8,2), nir DECIMAL(8,2), gpi_ger DECIMAL(8,4), gpi_ner DECIMAL(8,4),
        repetition_rate DECIMAL(8,2), sne_inclusion_rate DECIMAL(8,2), load_time TIMESTAMP""",
    "dw.school_indicator_fact": """
        id BIGINT, school_id BIGINT, date_id BIGINT, school_source_id BIGINT, academic_year INT, term
        STRING, total_learners INT, male_learners INT, female_learners INT, total_teachers INT,
        male_teachers INT, female_teachers INT, qualified_teachers INT, trained_teachers INT, ptr
        DECIMAL(8,2), qualified_teacher_ratio DECIMAL(8,2), trained_teacher_ratio DECIMAL(8,2),
        pct_female_teachers DECIMAL(8,2), gpi_ptr DECIMAL(8,4), load_time TIMESTAMP""",
    "dw.infrastructure_type_dim": """
        id BIGINT, source_id BIGINT, type_name STRING, item_category STRING, is_lab_yn BOOLEAN,
        is_sanitation_yn BOOLEAN, is_area_captured_yn BOOLEAN, gender_usage_yn BOOLEAN,
        user_category_yn BOOLEAN, is_for_pre_primary BOOLEAN, is_for_primary BOOLEAN,
        is_for_secondary BOOLEAN, is_active_yn BOOLEAN, load_time TIMESTAMP""",
    "dw.infrastructure_fact": """
        id BIGINT, school_id BIGINT, infra_type_id BIGINT, date_id BIGINT, school_source_id BIGINT,
        building_source_id BIGINT, academic_year INT, term STRING, total_number INT, area
        DECIMAL(15,2), completion_status STRING, usage_mode STRING, structure_condition STRING,
        gender_usage STRING, user_category STRING, load_time TIMESTAMP""",
    "dw.non_teaching_staff_dim": """
        id BIGINT, source_id BIGINT, employee_id BIGINT, ipps_number STRING, hrin STRING,
        hcm_employee_number STRING, surname STRING, given_name STRING, gender STRING, date_of_birth
        DATE, nationality STRING, nin STRING, category STRING, role STRING, highest_education_level
        STRING, employment_status STRING, is_on_government_payroll BOOLEAN, posting_date DATE,
        effective_date DATE, expiration_date DATE, is_current BOOLEAN, change_hash STRING,
        change_reason STRING, changed_fields STRING""",
    "dw.staff_category_dim": """
        id BIGINT, source_id BIGINT, category_name STRING""",
    "dw.staff_role_dim": """
        id BIGINT, source_id BIGINT, role_name STRING, category_name STRING, category_id BIGINT""",
    "dw.non_teaching_staff_fact": """
        id BIGINT, staff_id BIGINT, school_id BIGINT, date_id BIGINT, person_id BIGINT, school_source_id
        BIGINT, academic_year INT, term STRING, is_primary_school BOOLEAN, is_on_government_payroll
        BOOLEAN, load_time TIMESTAMP""",
    "dw.teacher_dim": """
        id BIGINT, source_id BIGINT, employee_id BIGINT, ipps_number STRING, tmis_number STRING,
        moes_license_number STRING, hrin STRING, hcm_employee_number STRING, surname STRING,
        given_name STRING, gender STRING, date_of_birth DATE, nationality STRING, nin STRING,
        passport_no STRING, teacher_type STRING, qualification STRING, qualification_category
        STRING, designation STRING, highest_education_level STRING, discipline STRING,
        is_on_government_payroll BOOLEAN, first_appointment_date DATE, posting_date DATE,
        effective_date DATE, expiration_date DATE, is_current BOOLEAN, change_hash STRING,
        change_reason STRING, changed_fields STRING""",
    "dw.teacher_type_dim": """
        id BIGINT, source_id BIGINT, teacher_type STRING""",
    "dw.qualification_dim": """
        id BIGINT, source_id BIGINT, qualification_name STRING, qualification_category STRING,
        is_for_pre_primary BOOLEAN, is_for_primary BOOLEAN, is_for_secondary BOOLEAN,
        is_for_certificate BOOLEAN, is_for_diploma BOOLEAN, is_for_degree BOOLEAN""",
    "dw.designation_dim": """
        id BIGINT, source_id BIGINT, designation STRING, school_type STRING""",
    "dw.hr_fact": """
        id BIGINT, teacher_id BIGINT, school_id BIGINT, date_id BIGINT, person_id BIGINT, school_source_id
        BIGINT, academic_year INT, term STRING, load_time TIMESTAMP""",
    "dw.teacher_transfer_fact": """
        id BIGINT, teacher_id BIGINT, out_school_id BIGINT, in_school_id BIGINT, out_district_id BIGINT,
        in_district_id BIGINT, date_id BIGINT, person_id BIGINT, transfer_source_id BIGINT,
        outgoing_school_source_id BIGINT, incoming_school_source_id BIGINT, transfer_status STRING,
        appointment_minute_number STRING, is_inter_district BOOLEAN, days_at_outgoing_station INT,
        days_to_report INT, posting_date DATE, reporting_date DATE, load_time TIMESTAMP""",
    "dw.subject_dim": """
        id BIGINT, source_id BIGINT, subject_level STRING, subject_name STRING, is_language_subject
        BOOLEAN, is_science_subject BOOLEAN, is_principal_subject BOOLEAN, is_olevel_subject
        BOOLEAN, is_alevel_subject BOOLEAN, is_mandatory BOOLEAN, is_examinable BOOLEAN, has_lab_yn
        BOOLEAN, is_active_yn BOOLEAN, subject_category STRING, load_time TIMESTAMP""",
    "dw.teaching_subject_fact": """
        id BIGINT, teacher_id BIGINT, school_id BIGINT, subject_id BIGINT, date_id BIGINT, person_id BIGINT,
        school_source_id BIGINT, subject_source_id BIGINT, subject_level STRING, load_time TIMESTAMP""",
    "dw_audit.etl_run": """
        run_id BIGINT, pipeline STRING, as_of_date DATE, start_ts TIMESTAMP, end_ts TIMESTAMP,
        status STRING, row_counts_json STRING, error_message STRING""",
    "dw_audit.etl_step_log": """
        step_log_id BIGINT, run_id BIGINT, step_name STRING, start_ts TIMESTAMP, end_ts TIMESTAMP,
        status STRING, rows_affected INT, message STRING""",
    "dw_audit.etl_watermark": """
        source_name STRING, last_success_ts TIMESTAMP, last_run_id BIGINT""",
    "dw_audit.etl_error_log": """
        error_id BIGINT, run_id BIGINT, step_name STRING, source_id BIGINT, error_message STRING,
        payload_json STRING, logged_at TIMESTAMP""",
    "dw_audit.dq_check_log": """
        dq_id BIGINT, run_id BIGINT, check_name STRING, status STRING, detail STRING, logged_at
        TIMESTAMP""",
}

# The quality log unites the two layouts the suites write (run/detail and mart/severity).
DDL["dw_audit.dq_check_log"] += """,
        run_date DATE, mart STRING, check_sql STRING, result STRING, row_count BIGINT,
        severity STRING, notes STRING"""
# Two extracts carry columns of their source that the flat step needs; without them it would have to
# join the whole source table again.
DDL["stg.enrolments_raw"] += ", enrolment_type_id BIGINT"
DDL["stg.learners_raw"] += ", is_father_dead BOOLEAN, is_mother_dead BOOLEAN"
DDL["dw.unit_ancestor"] = (
    "unit_dim_id BIGINT, unit_type STRING, ancestor_dim_id BIGINT, ancestor_name STRING, ancestor_type STRING, above BIGINT, depth INT")
DDL["dw.school_district_map"] = "school_dim_id BIGINT, district_id BIGINT, district_name STRING"


def schema(table: str) -> T.StructType:
    """The declared schema of ``table``, e.g. ``schema("dw.schools_dim")``."""
    return T.StructType.fromDDL(DDL[table])
