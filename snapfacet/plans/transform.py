"""G1: one snapshot of raw records -> the 28 typed columns.

A pure DataFrame -> DataFrame function; one projection that Catalyst collapses into a
single codegen stage (no shuffle, no Python).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts
from ..functions.identity import row_hash
from ..functions.phrases import split_known_phrases
from ..schema import EXAM_CLASSIFICATION, FULL_TIME_INDICATOR, JOB_CATEGORIES, LONG_TEXT_COLUMNS

TEXT_KEEP = (
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
TEXT_KEEP_2 = (
    "full_time_part_time_indicator",
    "salary_frequency",
    "work_location",
    "division_work_unit",
    "job_description",
    "minimum_qual_requirements",
    "residency_requirement",
)


def transform_postings(
    raw: DataFrame,
    lenient: bool = False,
    phrase_mode: str = "longest",
    vocabulary: Sequence[str] = JOB_CATEGORIES,
    with_content_id: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Raw snapshot -> processed rows.

    ``lenient``: bad numbers and dates give null instead of failing the job (the strict
    default is the reference's behaviour). ``phrase_mode``: ``longest`` (fixed) or
    ``chained`` (reference behaviour, see ``functions.phrases``). ``carry``: further columns of
    ``raw`` that are handed on beside the 28 (and are not part of the row hash).
    """
    cols = [F.col(c) for c in TEXT_KEEP]
    cols += [
        casts.to_double("salary_range_from", lenient).alias("salary_range_from"),
        casts.to_double("salary_range_to", lenient).alias("salary_range_to"),
    ]
    cols += [F.col(c) for c in TEXT_KEEP_2]
    cols += [
        casts.timestamp_text_to_date("posting_date", lenient).alias("posted_date"),
        casts.parse_dmy("post_until", lenient).alias("posted_until_date"),
        casts.timestamp_text_to_date("posting_updated", lenient).alias("posting_updated_date"),
        casts.timestamp_text_to_date("process_date", lenient).alias("processed_date"),
    ]
    renamed = raw.select(*cols, *carry)
    added = renamed.select(
        "*",
        casts.equals_flag("title_classification", EXAM_CLASSIFICATION).alias("requires_exam"),
        casts.equals_flag("full_time_part_time_indicator", FULL_TIME_INDICATOR).alias("is_full_time"),
        split_known_phrases("job_category", vocabulary, phrase_mode).alias("job_categories"),
    )
    body = [c for c in added.columns if c not in carry]
    out = [row_hash(body, added).alias("id")]
    if with_content_id:
        out.append(row_hash([c for c in body if c != "processed_date"], added).alias("content_id"))
    return added.select(*out, *body, *carry)


def history_columns(df: DataFrame, exclude: Sequence[str] = LONG_TEXT_COLUMNS) -> DataFrame:
    """All columns but the long texts; unknown names are an error (as EXCLUDE is)."""
    missing = [c for c in exclude if c not in df.columns]
    if missing:
        raise ValueError(f"columns to exclude not present: {missing}")
    return df.drop(*exclude)
