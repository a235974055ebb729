"""Facet lists and counts: A2, A3, F16, T5, G6, E1.

Distinct values are an aggregate, so Spark de-duplicates inside every partition before
the shuffle (partial aggregation): a value held by a third of all rows costs one row per
partition in the exchange, not a third of the table. Ordering the distinct values is a
sort of the (small) value set only.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .predicates import SearchSpec, not_blank


def _pair_of(facet: str, ok: Column | None = None):
    """A one-argument lambda for ``F.transform`` (a lambda with a second parameter would
    receive the element index there, silently)."""
    if ok is None:
        return lambda x: F.struct(F.lit(facet).alias("f"), x.alias("v"))
    return lambda x: F.struct(F.lit(facet).alias("f"), x.alias("v"), ok.alias("ok"))


def facet_values(df: DataFrame, column: str, alias: str | None = None, drop_empty: bool = True) -> DataFrame:
    """A2: distinct non-null (and by default non-empty) values, ordered."""
    name = alias or column
    v = F.col(column)
    pred = not_blank(v) if drop_empty else v.isNotNull()
    return df.where(pred).select(v.alias(name)).distinct().orderBy(F.col(name).asc())


def facet_array_values(df: DataFrame, column: str, alias: str = "value") -> DataFrame:
    """A3: distinct elements of an array column, ordered (null arrays give no row)."""
    # explode_outer: no inferred size(...) > 0 filter that would compute the array twice
    return (
        df.select(F.explode_outer(F.col(column)).alias(alias))
        .where(F.col(alias).isNotNull())
        .distinct()
        .orderBy(F.col(alias).asc())
    )


def facets(
    df: DataFrame,
    scalar: Sequence[str] = (),
    arrays: Sequence[str] = (),
    facet_col: str = "facet",
    value_col: str = "value",
) -> DataFrame:
    """Several facet lists in one scan: every row becomes (facet, value) pairs, the
    pairs are de-duplicated once. Result: ``facet, value`` ordered by both."""
    pairs = [F.array(F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("v"))) for c in scalar]
    pairs += [F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), _pair_of(c)) for c in arrays]
    # explode_outer: a plain explode would make Spark infer a size(...) > 0 filter that
    # evaluates the pair arrays a second time; null pairs are dropped by the filter below
    exploded = df.select(F.explode_outer(F.concat(*pairs)).alias("p")).select(
        F.col("p.f").alias(facet_col), F.col("p.v").alias(value_col)
    )
    return (
        exploded.where(not_blank(F.col(value_col)))
        .distinct()
        .orderBy(F.col(facet_col).asc(), F.col(value_col).asc())
    )


def facet_search(values: DataFrame, term: str, value_col: str = "value") -> DataFrame:
    """F16: facet values containing the term, case-insensitive."""
    return values.where(F.contains(F.lower(F.col(value_col)), F.lower(F.lit(term))))


def selected_first(values: DataFrame, chosen: Sequence[str], value_col: str = "value", rank_col: str | None = "position") -> DataFrame:
    """T5: chosen values first, then by label (case-folded, then exact).

    With ``rank_col`` the order is also returned as a 1-based column (numbered per sorted
    partition, no single-task window)."""
    keys = [F.col(value_col).isin(list(chosen)).desc(), F.lower(F.col(value_col)).asc(), F.col(value_col).asc()]
    if rank_col is None:
        return values.orderBy(*keys)
    from .ordering import number_rows

    return number_rows(values, keys, rank_col)


def facet_counts(
    df: DataFrame,
    spec: SearchSpec,
    scalar: Sequence[str] = (),
    arrays: Sequence[str] = (),
    facet_col: str = "facet",
    value_col: str = "value",
    count_col: str = "n",
    index=None,
    id_col: str = "id",
) -> DataFrame:
    """For every facet value, the number of rows that match all *other* selections.

    One scan: filters that no facet leaves out (text, salary, dates, ...) are applied to the rows
    first, so they reach the scan; then each row carries, per facet, a flag "passes the request
    without this facet's own filter", rows explode into (facet, value) pairs, keep pairs whose flag
    is set, and one grouped count (with map-side partial aggregation) gives all facets.

    A text search by ``index`` (modes ``bm25`` and ``auto``) counts the rows that have a score;
    without an index both modes are the substring search, as in ``search``."""
    if spec.text and spec.text_mode in ("bm25", "auto"):
        if index is None:
            spec = spec.with_(text_mode="literal")
        else:
            from .text_index import bm25_scores

            spec = spec.with_(text_mode="bm25")
            scored = bm25_scores(index, spec.text).select(F.col(index.id_col).alias(id_col))
            df = df.join(scored, on=id_col, how="left_semi")
    df = df.where(spec.predicate(skip=(*scalar, *arrays)))
    spec = spec.with_(text=None)  # applied above, for all facets
    pieces: list[Column] = []
    for c in scalar:
        ok = spec.predicate(skip=(c,))
        pieces.append(F.array(F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("v"), ok.alias("ok"))))
    for c in arrays:
        ok = spec.predicate(skip=(c,))
        pieces.append(
            F.transform(F.coalesce(F.array_distinct(F.col(c)), F.array().cast("array<string>")), _pair_of(c, ok))
        )
    pairs = df.select(F.explode_outer(F.concat(*pieces)).alias("p")).where(
        F.col("p").isNotNull() & F.col("p.ok") & not_blank(F.col("p.v"))
    )
    return (
        pairs.groupBy(F.col("p.f").alias(facet_col), F.col("p.v").alias(value_col))
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(facet_col), F.col(value_col))
    )


def facet_lists(df: DataFrame, spec_columns: Mapping[str, str]) -> dict[str, DataFrame]:
    """The three lists of the postings page (agency, categories, civil service titles),
    each as its own frame (``kind`` is ``scalar`` or ``array``)."""
    out = {}
    for column, kind in spec_columns.items():
        out[column] = facet_array_values(df, column) if kind == "array" else facet_values(df, column)
    return out


POSTINGS_FACETS = {"agency": "scalar", "job_categories": "array", "civil_service_title": "scalar"}
