"""Display columns: search link (P13), salary labels (P15, P16), date labels (P17),
HTML escaping (P19). All are plain Column expressions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ColumnOrName, col

# Characters that the browser's component encoder leaves as they are but Spark's encoder
# escapes (or the other way round); both sides are put back to the plain character.
_KEEP_PLAIN = (("%21", "!"), ("%7E", "~"), ("%2A", "*"), ("%27", "'"), ("%28", "("), ("%29", ")"))


def search_link(parts: Sequence[ColumnOrName], base: str = "https://example.org/jobs?q=") -> Column:
    """``base`` + percent-encoded ``"part1 part2"`` with whitespace runs as ``_``."""
    joined = F.concat_ws(" ", *[col(p) for p in parts])
    underscored = F.regexp_replace(joined, r"(?U)\s+", "_")
    enc = F.url_encode(underscored)
    for code, plain in _KEEP_PLAIN:
        enc = F.replace(enc, F.lit(code), F.lit(plain))
    return F.concat(F.lit(base), enc)


def _dollars(x: Column) -> Column:
    """``$12,345`` rounded half away from zero (as the browser's currency format does;
    ``format_number`` alone would round half to even)."""
    r = F.round(F.abs(x), 0)
    body = F.concat(F.lit("$"), F.format_number(r, 0))
    return F.when(x < 0, F.concat(F.lit("-"), body)).otherwise(body)


def _is_blank_number(x: Column) -> Column:
    return x.isNull() | (x == 0) | F.isnan(x)


def salary_label_short(lo: ColumnOrName, hi: ColumnOrName, frequency: ColumnOrName) -> Column:
    """``$a - $b/yr``; ``/hr`` for hourly, no unit otherwise; one figure when the upper
    bound is missing, zero or equal; ``—`` when the lower bound is missing or zero."""
    a, b, f = col(lo).cast("double"), col(hi).cast("double"), col(frequency)
    unit = F.when(f == "Annual", F.lit("/yr")).when(f == "Hourly", F.lit("/hr")).otherwise(F.lit(""))
    one = F.concat(_dollars(a), unit)
    two = F.concat(_dollars(a), F.lit(" - "), _dollars(b), unit)
    has_range = ~_is_blank_number(b) & (b != a)
    return F.when(_is_blank_number(a), F.lit("—")).when(has_range, two).otherwise(one)


def salary_label_long(lo: ColumnOrName, hi: ColumnOrName, frequency: ColumnOrName) -> Column:
    """``$a - $b (Frequency)``, frequency defaulting to ``Annual``; ``Not specified``
    when the lower bound is missing or zero."""
    a, b, f = col(lo).cast("double"), col(hi).cast("double"), col(frequency)
    freq = F.when(f.isNull() | (f == ""), F.lit("Annual")).otherwise(f)
    suffix = F.concat(F.lit(" ("), freq, F.lit(")"))
    one = F.concat(_dollars(a), suffix)
    two = F.concat(_dollars(a), F.lit(" - "), _dollars(b), suffix)
    has_range = ~_is_blank_number(b) & (b != a)
    return F.when(_is_blank_number(a), F.lit("Not specified")).when(has_range, two).otherwise(one)


def date_label_short(d: ColumnOrName) -> Column:
    """``Jan 15, 2025``; empty -> ``—``."""
    return F.coalesce(F.date_format(col(d), "MMM d, yyyy"), F.lit("—"))


def date_label_long(d: ColumnOrName) -> Column:
    """``Wednesday, January 15, 2025``; empty -> ``—``."""
    return F.coalesce(F.date_format(col(d), "EEEE, MMMM d, yyyy"), F.lit("—"))


def escape_html(c: ColumnOrName) -> Column:
    """Text -> HTML text node: ``&`` first, then ``<``, ``>`` and no-break space."""
    out = F.replace(col(c), F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    out = F.replace(out, F.lit(">"), F.lit("&gt;"))
    return F.replace(out, F.lit("\u00a0"), F.lit("&nbsp;"))
