"""Small Column helpers shared by the function and operator modules."""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def regex_quote(text: str) -> str:
    """Escape a literal for a Java regex without \\Q..\\E, so that the same pattern text
    also works in RE2 (the oracle engine)."""
    special = set(r"\.^$|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in text)


def like_escape(text: str) -> str:
    """Double the escape character so that Spark's LIKE treats a backslash as a literal
    and leaves ``%`` and ``_`` as wildcards (compat behaviour of substring search)."""
    return text.replace("\\", "\\\\")
