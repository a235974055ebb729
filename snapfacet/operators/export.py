"""Export views of result rows: P12 (null defaults), P20 (visible columns), P22 (detail
projection with conditional parts). Spark keeps nulls; these are explicit last steps."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels
from ..functions.casts import to_iso_date
from ..functions.text_format import structure_text


def with_defaults(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strings null -> '', booleans null -> false, dates -> ISO text ('' for null),
    numbers stay null, arrays null -> []; other types unchanged."""
    chosen = set(columns or df.columns)
    out: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name not in chosen:
            out.append(c)
            continue
        dt = f.dataType
        if isinstance(dt, T.StringType):
            out.append(F.coalesce(c, F.lit("")).alias(f.name))
        elif isinstance(dt, T.BooleanType):
            out.append(F.coalesce(c, F.lit(False)).alias(f.name))
        elif isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(to_iso_date(c, "date").alias(f.name))
        elif isinstance(dt, T.ArrayType):
            out.append(F.coalesce(c, F.array().cast(dt)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


# Table columns of the postings page and those shown by default.
TABLE_COLUMNS = (
    "business_title",
    "agency",
    "salary_range_from",
    "posted_date",
    "work_location",
    "career_level",
    "civil_service_title",
    "title_classification",
    "is_full_time",
)
HIDDEN_BY_DEFAULT = ("work_location", "career_level", "civil_service_title", "title_classification", "is_full_time")


def visible_columns(
    df: DataFrame,
    visibility: Mapping[str, bool] | None = None,
    all_columns: Sequence[str] = TABLE_COLUMNS,
    hidden_by_default: Sequence[str] = HIDDEN_BY_DEFAULT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """P20: project to the visible table columns (plus ``keep``, e.g. the id)."""
    vis = {c: c not in hidden_by_default for c in all_columns}
    vis.update(visibility or {})
    cols = list(keep) + [c for c in all_columns if vis.get(c) and c in df.columns]
    return df.select(*cols)


def show_all(all_columns: Sequence[str] = TABLE_COLUMNS) -> dict[str, bool]:
    return {c: True for c in all_columns}


def show_none(all_columns: Sequence[str] = TABLE_COLUMNS) -> dict[str, bool]:
    return {c: False for c in all_columns}


def detail_view(df: DataFrame, link_base: str = "https://example.org/jobs?q=") -> DataFrame:
    """The detail record of a posting with its display parts.

    Missing texts show as ``—`` where the page always shows the field and are null where
    the page leaves the field out; the exam remark only when an exam is required; the
    outside link only for postings that are not Internal."""

    def opt(c: str) -> Column:
        return F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.col(c))

    def dash(c: str) -> Column:
        return F.coalesce(opt(c), F.lit("—"))

    internal = F.coalesce(F.col("posting_type"), F.lit("")) == "Internal"
    return df.select(
        "id",
        F.coalesce(F.col("business_title"), F.lit("")).alias("business_title"),
        F.coalesce(F.col("agency"), F.lit("")).alias("agency"),
        opt("work_location").alias("work_location"),
        F.when(F.col("is_full_time") == F.lit(True), F.lit("Full-time")).otherwise(F.lit("Part-time")).alias("schedule"),
        F.coalesce(F.col("job_categories"), F.array().cast("array<string>")).alias("job_categories"),
        labels.salary_label_long("salary_range_from", "salary_range_to", "salary_frequency").alias("salary"),
        F.when(opt("job_description").isNotNull(), structure_text("job_description")).alias("description_html"),
        F.when(opt("minimum_qual_requirements").isNotNull(), structure_text("minimum_qual_requirements")).alias(
            "qualifications_html"
        ),
        dash("civil_service_title").alias("civil_service_title"),
        F.concat(
            dash("title_classification"),
            F.when(F.col("requires_exam") == F.lit(True), F.lit(" (Exam Required)")).otherwise(F.lit("")),
        ).alias("title_classification"),
        dash("career_level").alias("career_level"),
        dash("number_of_positions").alias("number_of_positions"),
        opt("division_work_unit").alias("division_work_unit"),
        opt("residency_requirement").alias("residency_requirement"),
        labels.date_label_long("posted_date").alias("posted"),
        labels.date_label_long("posted_until_date").alias("post_until"),
        F.when(F.col("posting_updated_date").isNotNull(), labels.date_label_long("posting_updated_date")).alias("last_updated"),
        F.when(~internal, labels.search_link(["business_title", "agency"], link_base)).alias("apply_link"),
        internal.alias("internal_only"),
    )
