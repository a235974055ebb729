"""Typed views of raw text: P2-P5, P10, P14.

Strict forms fail the job on bad text (ANSI mode), as the reference's engine does; the
lenient forms give null instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ColumnOrName, col

# Fixed value: day-month-year format of deadlines such as ``15-JAN-2026``.
DMY_FORMAT = "d-MMM-yyyy"


def to_double(c: ColumnOrName, lenient: bool = False) -> Column:
    """Text -> double."""
    return col(c).try_cast("double") if lenient else col(c).cast("double")


def timestamp_text_to_date(c: ColumnOrName, lenient: bool = False) -> Column:
    """``2026-01-26T00:00:00.000`` -> date."""
    return col(c).try_cast("date") if lenient else col(c).cast("date")


def parse_dmy(c: ColumnOrName, lenient: bool = False) -> Column:
    """``15-JAN-2026`` / ``5-jan-2026`` -> date (month names in any case); null stays
    null; bad text fails (strict) or gives null (lenient)."""
    return F.try_to_date(col(c), DMY_FORMAT) if lenient else F.to_date(col(c), DMY_FORMAT)


def equals_flag(c: ColumnOrName, value: str) -> Column:
    """P5: ``c = value``; null in gives null out."""
    return col(c) == F.lit(value)


def snapshot_timestamp(c: ColumnOrName) -> Column:
    """P10: ``2026-01-26T00:00:00.000`` -> timestamp: fraction dropped, read as UTC."""
    return F.to_timestamp(F.concat(F.substring_index(col(c), ".", 1), F.lit("+00:00")))


def snapshot_key(c: ColumnOrName) -> Column:
    """Key text of a snapshot, ``YYYY-MM-DDTHH:MM:SS+00:00``."""
    return F.date_format(snapshot_timestamp(c), "yyyy-MM-dd'T'HH:mm:ssxxx")


def epoch_number_to_iso_date(n: ColumnOrName) -> Column:
    """P14 numeric branch: above 1e9 the number is milliseconds, otherwise days."""
    v = col(n).cast("double")
    as_ms = F.to_date(F.timestamp_millis(col(n).cast("long")))
    as_days = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(v).cast("int"))
    return F.when(v > F.lit(1e9), as_ms).otherwise(as_days).cast("string")


def text_to_iso_date(s: ColumnOrName) -> Column:
    """P14 text branch: a date or date-time text -> ``YYYY-MM-DD``; unparseable text is
    returned unchanged; null -> ``""``."""
    t = col(s)
    parsed = F.coalesce(t.try_cast("date"), F.to_date(F.try_to_timestamp(t)))
    return F.coalesce(parsed.cast("string"), t, F.lit(""))


def to_iso_date(value: ColumnOrName, dtype: str = "string") -> Column:
    """P14 for a column of a given kind: ``number`` as epoch (ms or days), ``date`` /
    ``timestamp`` by their date, ``string`` parsed; null -> ``""``."""
    if dtype == "number":
        return F.coalesce(epoch_number_to_iso_date(value), F.lit(""))
    if dtype in ("date", "timestamp"):
        return F.coalesce(F.to_date(col(value)).cast("string"), F.lit(""))
    return text_to_iso_date(value)
