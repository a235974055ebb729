"""Search predicates (F1-F12, F14, F16, F17) and the search request record.

Every filter is a ``Column``; a request becomes one conjunction that Catalyst pushes to
the Parquet scan where it can (``=``, ``IN``, ranges, null tests). Values are always bound
with ``lit`` -- no SQL text is ever assembled from values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.common import ColumnOrName, col, like_escape, lit_or_col

# ---------------------------------------------------------------------------
# Single predicates
# ---------------------------------------------------------------------------


def substring_any(columns: Sequence[ColumnOrName], term: str, mode: str = "literal") -> Column:
    """case-insensitive substring match, OR over columns.

    ``literal`` (default): the term is plain text. ``compat``: ``ILIKE '%term%'`` as the
    reference builds it, so ``%`` and ``_`` in the term act as wildcards.
    """
    if mode == "literal":
        needle = F.lower(F.lit(term))  # the same case mapping on both sides (Spark's)
        preds = [F.contains(F.lower(col(c)), needle) for c in columns]
    elif mode == "compat":
        pattern = "%" + like_escape(term) + "%"
        preds = [col(c).ilike(pattern) for c in columns]
    else:
        raise ValueError(f"unknown substring mode {mode!r}")
    return reduce(lambda a, b: a | b, preds)


def in_list(c: ColumnOrName, values: Sequence) -> Column:
    """Plain IN list (pushed to Parquet as an In filter)."""
    return col(c).isin(list(values))


def contains_any(arr: ColumnOrName, values: Sequence[str]) -> Column:
    """the array column holds at least one of the values.

    Written as ``exists`` rather than ``arrays_overlap`` so that a null element gives
    false (not null), which keeps the predicate two-valued under NOT as well."""
    vals = list(values)
    return F.coalesce(F.exists(col(arr), lambda x: x.isin(vals)), F.lit(False))


def one_of_two(c: ColumnOrName, chosen: Sequence, domain: Sequence) -> Column | None:
    """a facet with two values; filter only when exactly one value is chosen. A single value
    outside ``domain`` is a filter like any other (it matches the rows that hold it, so none in a
    table that keeps to the domain).

    Returns None (= no predicate, null rows pass) when none or all of the domain are chosen."""
    picked = list(dict.fromkeys(chosen))
    if not picked or set(domain) <= set(picked):
        return None
    return col(c).isin(picked)


def tri_state(c: ColumnOrName, want_true: bool, want_false: bool) -> Column | None:
    """Boolean flag with the choices 'true' and 'false'.

    Exactly one choice filters on it; both or none is no predicate at all (so null flags
    pass). ``x OR NOT x`` would not be the same: it drops nulls."""
    if want_true == want_false:
        return None
    return col(c) == F.lit(bool(want_true))


def range_overlap(lo: ColumnOrName, hi: ColumnOrName, min_value=None, max_value=None) -> Column | None:
    """``[lo, hi]`` overlaps ``[min_value, max_value]``; bounds optional, inclusive.
    A null bound column never matches a given bound."""
    preds = []
    if min_value is not None:
        preds.append(col(hi) >= lit_or_col(min_value))
    if max_value is not None:
        preds.append(col(lo) <= lit_or_col(max_value))
    return conjunction(preds) if preds else None


def _as_date(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (dt.date, dt.datetime)):
        return F.lit(v.isoformat()[:10]).cast("date")
    return F.lit(str(v)).cast("date")


def date_range(c: ColumnOrName, date_from=None, date_to=None) -> Column | None:
    """inclusive date range, each end optional."""
    preds = []
    if date_from not in (None, ""):
        preds.append(col(c) >= _as_date(date_from))
    if date_to not in (None, ""):
        preds.append(col(c) <= _as_date(date_to))
    return conjunction(preds) if preds else None


def last_n_days(c: ColumnOrName, days, as_of=None) -> Column | None:
    """``c >= as_of - days``, boundary included. A preset that is not a number
    (e.g. 'custom' or '') gives no predicate. ``as_of`` defaults to today."""
    try:
        n = int(str(days).strip())
    except (TypeError, ValueError):
        return None
    base = F.current_date() if as_of is None else _as_date(as_of)
    return col(c) >= F.date_sub(base, n)


def not_blank(c: ColumnOrName) -> Column:
    """not null and not the empty string."""
    return col(c).isNotNull() & (col(c) != F.lit(""))


def conjunction(preds: Sequence[Column | None]) -> Column:
    """AND of the active predicates; no predicate means all rows."""
    active = [p for p in preds if p is not None]
    if not active:
        return F.lit(True)
    return reduce(lambda a, b: a & b, active)


# ---------------------------------------------------------------------------
# Search request
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SearchSpec:
    """A search request over any table; column names are part of the request.

    Postings-shaped defaults live in :meth:`postings`.
    """

    text: str | None = None
    text_columns: tuple = ()
    text_mode: str = "literal"  # literal | compat | bm25 | auto
    in_lists: Mapping[str, tuple] = field(default_factory=dict)  # column -> allowed values
    any_of: Mapping[str, tuple] = field(default_factory=dict)  # array column -> values
    two_value: Mapping[str, tuple] = field(default_factory=dict)  # column -> (chosen, domain)
    flags: Mapping[str, tuple] = field(default_factory=dict)  # bool column -> (want_true, want_false)
    overlap: tuple | None = None  # (lo_col, hi_col, min, max)
    dates: tuple | None = None  # (col, from, to)
    recent: tuple | None = None  # (col, days, as_of)
    order_by: str | None = None
    descending: bool = True
    limit: int = 25
    offset: int = 0
    tiebreak: str | None = None

    def with_(self, **kw) -> "SearchSpec":
        return replace(self, **kw)

    def predicate(self, include_text: bool = True, skip: Sequence[str] = ()) -> Column:
        """The WHERE clause of the request; ``skip`` leaves out filters on the named
        columns (used for facet counts given the other selections)."""
        preds: list[Column | None] = []
        if include_text and self.text and self.text_mode in ("literal", "compat"):
            preds.append(substring_any(self.text_columns, self.text, self.text_mode))
        for c, values in self.in_lists.items():
            if values and c not in skip:
                preds.append(in_list(c, values))
        for c, values in self.any_of.items():
            if values and c not in skip:
                preds.append(contains_any(c, values))
        for c, (chosen, domain) in self.two_value.items():
            if c not in skip:
                preds.append(one_of_two(c, chosen, domain))
        for c, (want_true, want_false) in self.flags.items():
            if c not in skip:
                preds.append(tri_state(c, want_true, want_false))
        if self.overlap is not None and self.overlap[0] not in skip:
            preds.append(range_overlap(*self.overlap))
        if self.dates is not None and self.dates[0] not in skip:
            preds.append(date_range(*self.dates))
        if self.recent is not None and self.recent[0] not in skip:
            preds.append(last_n_days(*self.recent))
        return conjunction(preds)

    def is_open(self) -> bool:
        """Whether nothing but the text filters."""
        two = any(one_of_two(c, *v) is not None for c, v in self.two_value.items())
        flags = any(a != b for a, b in self.flags.values())
        lists = any(self.in_lists.values()) or any(self.any_of.values())
        return not (two or flags or lists or self.overlap or self.dates or self.recent)

    @classmethod
    def postings(
        cls,
        search: str | None = None,
        use_index: bool = False,
        agencies: Sequence[str] = (),
        categories: Sequence[str] = (),
        civil_service_titles: Sequence[str] = (),
        career_levels: Sequence[str] = (),
        full_time: Sequence[str] = (),
        exam: Sequence[str] = (),
        posting_types: Sequence[str] = (),
        salary_min=None,
        salary_max=None,
        posted_preset: str = "",
        posted_from=None,
        posted_to=None,
        as_of=None,
        order_by: str | None = None,
        descending: bool = True,
        limit: int | None = 25,
        offset: int | None = 0,
        compat_wildcards: bool = False,
    ) -> "SearchSpec":
        """The request of the postings page, option for option (F17 defaults: newest
        first, 25 rows, first page)."""
        dates = recent = None
        if posted_preset == "custom":
            dates = ("posted_date", posted_from, posted_to)
        elif posted_preset:
            recent = ("posted_date", posted_preset, as_of)
        mode = "bm25" if use_index else ("compat" if compat_wildcards else "literal")
        return cls(
            text=search or None,
            text_columns=("business_title", "agency", "job_description"),
            text_mode=mode,
            in_lists={
                "agency": tuple(agencies),
                "civil_service_title": tuple(civil_service_titles),
                "career_level": tuple(career_levels),
            },
            any_of={"job_categories": tuple(categories)},
            two_value={"posting_type": (tuple(posting_types), POSTING_TYPES)},
            flags={
                "is_full_time": ("full_time" in full_time, "part_time" in full_time),
                "requires_exam": ("requires_exam" in exam, "no_exam" in exam),
            },
            overlap=("salary_range_from", "salary_range_to", salary_min, salary_max)
            if (salary_min is not None or salary_max is not None)
            else None,
            dates=dates,
            recent=recent,
            order_by=validate_sort_key(order_by),
            descending=descending,
            limit=limit or 25,
            offset=offset or 0,
            tiebreak="id",
        )

    @classmethod
    def ui_default(cls, **kw) -> "SearchSpec":
        """the page opens with External postings only, newest first."""
        kw.setdefault("posting_types", ("External",))
        return cls.postings(**kw)


# Fixed values of the postings page (must equal the reference's choices).
POSTING_TYPES = ("Internal", "External")
CAREER_LEVELS = ("Entry-Level", "Experienced (non-manager)", "Manager", "Executive")
SORTABLE_COLUMNS = (
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
DEFAULT_SORT = "posted_date"


def validate_sort_key(key: str | None, allowed: Sequence[str] = SORTABLE_COLUMNS, default: str = DEFAULT_SORT) -> str:
    """Sort-key allow list with fallback."""
    return key if key in allowed else default
