"""Schemas of raw and processed snapshot rows, and the category vocabulary."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw snapshot record: every field is a nullable string; an absent key reads as null.
RAW_FIELDS = (
    "job_id",
    "agency",
    "posting_type",
    "number_of_positions",
    "business_title",
    "civil_service_title",
    "title_classification",
    "title_code_no",
    "level",
    "job_category",
    "full_time_part_time_indicator",
    "career_level",
    "salary_range_from",
    "salary_range_to",
    "salary_frequency",
    "work_location",
    "division_work_unit",
    "job_description",
    "minimum_qual_requirements",
    "residency_requirement",
    "posting_date",
    "post_until",
    "posting_updated",
    "process_date",
)

RAW = T.StructType([T.StructField(f, T.StringType(), True) for f in RAW_FIELDS])

# Processed row: 28 columns in this order.
PROCESSED = T.StructType(
    [T.StructField("id", T.StringType(), True)]
    + [
        T.StructField(f, T.StringType(), True)
        for f in (
            "job_id",
            "agency",
            "posting_type",
            "number_of_positions",
            "business_title",
            "civil_service_title",
            "title_classification",
            "title_code_no",
            "level",
            "job_category",
            "career_level",
        )
    ]
    + [
        T.StructField("salary_range_from", T.DoubleType(), True),
        T.StructField("salary_range_to", T.DoubleType(), True),
    ]
    + [
        T.StructField(f, T.StringType(), True)
        for f in (
            "full_time_part_time_indicator",
            "salary_frequency",
            "work_location",
            "division_work_unit",
            "job_description",
            "minimum_qual_requirements",
            "residency_requirement",
        )
    ]
    + [
        T.StructField(f, T.DateType(), True)
        for f in ("posted_date", "posted_until_date", "posting_updated_date", "processed_date")
    ]
    + [
        T.StructField("requires_exam", T.BooleanType(), True),
        T.StructField("is_full_time", T.BooleanType(), True),
        T.StructField("job_categories", T.ArrayType(T.StringType(), True), True),
    ]
)

# Long text columns left out of the history table.
LONG_TEXT_COLUMNS = ("job_description", "minimum_qual_requirements", "residency_requirement")

# Columns of the full-text index and of the substring search.
INDEX_COLUMNS = ("business_title", "job_description", "agency", "civil_service_title")
SUBSTRING_COLUMNS = ("business_title", "agency", "job_description")

# The job categories of the source, in the order the reference applies them.
JOB_CATEGORIES = (
    "Communications & Intergovernmental Affairs",
    "Constituent Services & Community Programs",
    "Public Safety, Inspections, & Enforcement",
    "Engineering, Architecture, & Planning",
    "Finance, Accounting, & Procurement",
    "Building Operations & Maintenance",
    "Administration & Human Resources",
    "Technology, Data & Innovation",
    "Policy, Research & Analysis",
    "Social Services",
    "Mental Health",
    "Legal Affairs",
    "Green Jobs",
    "Health",
)

# Flag rules of the transform.
EXAM_CLASSIFICATION = "Competitive-1"
FULL_TIME_INDICATOR = "F"

# Pipeline state record.
STATE = T.StructType(
    [
        T.StructField("source_updated_at", T.TimestampType(), True),
        T.StructField("last_fetched_at", T.TimestampType(), True),
        T.StructField("last_processed_at", T.TimestampType(), True),
        T.StructField("record_count", T.LongType(), True),
        T.StructField("snapshot", T.StringType(), True),
    ]
)
