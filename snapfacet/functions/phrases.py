"""Split run-together text into known phrases.

Source category fields hold several phrases separated only by blanks, e.g.
``Health Legal Affairs``. Splitting marks the start of every known phrase, splits at the
marks, trims and drops empty parts -- all native Column expressions (one projection,
whole-stage codegen, no Python).

Two modes:

``longest`` (default)
    one regex alternation, longest phrase first, so ``Mental Health`` is never broken into
    ``Mental`` + ``Health``; parts are trimmed before empty ones are dropped.
``chained``
    what the reference does: one literal replace per phrase, each seeing the output of the
    one before, then drop zero-length parts, then trim. A phrase that contains a later one
    is split again (``Mental Health`` -> ``Mental``, ``Health``), and a blank first part
    survives as ``''``.

Null stays null; the empty string gives an empty array.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ColumnOrName, col, regex_quote

MARK = "|"


def split_known_phrases(c: ColumnOrName, vocabulary: Sequence[str], mode: str = "longest") -> Column:
    text = col(c)
    if mode == "chained":
        marked = text
        for phrase in vocabulary:
            marked = F.replace(marked, F.lit(phrase), F.lit(MARK + phrase))
        parts = F.split(marked, regex_quote(MARK))
        parts = F.filter(parts, lambda x: F.length(x) > 0)
        return F.transform(parts, lambda x: F.trim(x))
    if mode == "longest":
        ordered = sorted(dict.fromkeys(vocabulary), key=lambda p: (-len(p), p))
        pattern = "(" + "|".join(regex_quote(p) for p in ordered) + ")"
        marked = F.regexp_replace(text, pattern, MARK.replace("$", "\\$") + "$1")
        parts = F.transform(F.split(marked, regex_quote(MARK)), lambda x: F.trim(x))
        return F.filter(parts, lambda x: F.length(x) > 0)
    raise ValueError(f"unknown mode {mode!r}")


def longest_first_pattern(vocabulary: Sequence[str]) -> str:
    """The alternation used by ``longest`` mode (also usable in RE2 oracle SQL)."""
    ordered = sorted(dict.fromkeys(vocabulary), key=lambda p: (-len(p), p))
    return "(" + "|".join(regex_quote(p) for p in ordered) + ")"
