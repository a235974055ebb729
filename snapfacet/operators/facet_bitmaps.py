"""Facet counts from stored bitmaps: E1 / G6 without a scan of the rows for each selection.

For every facet value the index holds which rows have it, as bitmaps over row numbers: one of 32768 bits for each
bucket of rows in which the value occurs (Spark's ``bitmap_*`` functions). A request then is set algebra on bitmaps:

* a facet's selection is the OR of the bitmaps of its chosen values;
* the counts of a facet are taken under the selections of all *other* facets: their AND, bucket by bucket, is ANDed
  with each value's bitmaps, and the bits are counted.

Filters that are no facets (ranges, dates, texts) have no bitmaps: their columns are read once and become one more bitmap
that all facets are held against. Without such a filter no row is read at all.

Rows are numbered file by file, so a bucket is a run of neighbouring rows and a value's bitmaps compress well. A value that a third of
all rows have is a third of all bucket rows, 4 KB each at most, and groups are by (facet, value, bucket): no
group holds more than one bucket.

Layout: ``rows`` (the table's columns and ``row``) and ``bitmaps(facet, value, bucket, bits)``, sorted by facet and value.

Defined results: those of ``facets.facet_counts``: null and blank values are not counted (a blank one may be chosen), a null array
has no values, values that no row has under the other selections do not appear.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from .predicates import SearchSpec, not_blank

ROWS = "\u0001rows"  # the facet name of what is not a facet


def _bits() -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits")


def _bucket() -> Column:
    return F.bitmap_bucket_number("row").alias("bucket")


def _text(value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


@dataclass
class FacetBitmaps:
    rows: DataFrame
    bitmaps: DataFrame  # facet, value, bucket, bits
    facets: tuple

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FacetBitmaps":
        facets = tuple(spark.read.parquet(f"{path}/facets").first()["facets"])
        return FacetBitmaps(spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/bitmaps"), facets)

    def values(self) -> DataFrame:
        """(facet, value) of all facets, in order, without a row being read."""
        return self.bitmaps.where(not_blank("value")).select("facet", "value").distinct().orderBy("facet", "value")

    def chosen(self, spec: SearchSpec) -> dict[str, list[str]]:
        """The chosen values of each facet that the request filters by."""
        out = {}
        for c in self.facets:
            if spec.in_lists.get(c):
                out[c] = [_text(v) for v in spec.in_lists[c]]
            elif spec.any_of.get(c):
                out[c] = [_text(v) for v in spec.any_of[c]]
            elif c in spec.two_value and spec.two_value[c][0] and not set(spec.two_value[c][1]) <= set(spec.two_value[c][0]):
                out[c] = [_text(v) for v in spec.two_value[c][0]]
            elif c in spec.flags and spec.flags[c][0] != spec.flags[c][1]:
                out[c] = [_text(bool(spec.flags[c][0]))]
        return out

    def selections(self, spec: SearchSpec) -> tuple[DataFrame | None, list[str]]:
        """(facet, bucket, bits): the rows that each filtering facet lets through, and the facets' names; what is
        not a facet comes as one, ``ROWS``."""
        chosen, parts = self.chosen(spec), []
        for facet, values in chosen.items():
            picked = self.bitmaps.where((F.col("facet") == facet) & F.col("value").isin(values))
            parts.append(picked.groupBy("facet", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")))
        rest = spec.with_(**{k: {c: v for c, v in getattr(spec, k).items() if c not in self.facets} for k in ("in_lists", "any_of", "two_value", "flags")})
        names = list(chosen)
        if _filters(rest):
            found = self.rows.where(rest.predicate()).groupBy(_bucket()).agg(_bits())
            parts.append(found.select(F.lit(ROWS).alias("facet"), "bucket", "bits"))
            names.append(ROWS)
        out = None
        for p in parts:
            out = p if out is None else out.unionByName(p)
        return out, names

    def counts(self, spec: SearchSpec, facet_col: str = "facet", value_col: str = "value", count_col: str = "n") -> DataFrame:
        """For every facet value the number of rows that match all other selections, ordered by facet and value."""
        if spec.text and spec.text_mode in ("bm25", "auto"):
            raise ValueError("text searches by an index are counted by facets.facet_counts")
        found, names = self.selections(spec)
        own = self.bitmaps.where(not_blank("value"))
        free = [f for f in self.facets if not set(names) - {f}]  # nothing else filters
        counted = own.where(F.col("facet").isin(free)).select("facet", "value", F.bitmap_count("bits").alias("n"))
        if len(free) < len(self.facets):
            bound = [f for f in self.facets if f not in free]
            needed = F.create_map(*(F.lit(x) for f in bound for x in (f, len(set(names) - {f}))))
            targets = F.filter(F.array(*(F.lit(f) for f in bound)), lambda t: t != F.col("facet"))
            others = found.select(F.explode(targets).alias("facet"), "bucket", "bits").groupBy("facet", "bucket")
            others = others.agg(F.bitmap_and_agg("bits").alias("others"), F.count(F.lit(1)).alias("k")).where(F.col("k") == F.element_at(needed, F.col("facet")))
            both = own.join(others.drop("k"), ["facet", "bucket"]).select("facet", "value", "bucket", F.explode(F.array("bits", "others")).alias("bits"))
            both = both.groupBy("facet", "value", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
            counted = counted.union(both.select("facet", "value", F.bitmap_count("bits").alias("n")))
        out = counted.groupBy(F.col("facet").alias(facet_col), F.col("value").alias(value_col)).agg(F.sum("n").alias(count_col))
        return out.where(F.col(count_col) > 0).orderBy(facet_col, value_col)

    def total(self, spec: SearchSpec, alias: str = "total") -> DataFrame:
        """A1 of the request: the number of rows that all its filters let through."""
        found, names = self.selections(spec)
        if found is None:
            return self.rows.agg(F.count(F.lit(1)).alias(alias))  # from the files' footers
        every = found.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("k")).where(F.col("k") == len(names))
        return every.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(alias))


def _filters(spec: SearchSpec) -> bool:
    lists = any(spec.in_lists.values()) or any(spec.any_of.values()) or bool(spec.two_value) or bool(spec.flags)
    return bool(lists or spec.text or spec.overlap or spec.dates or spec.recent)


def build_facet_bitmaps(df: DataFrame, scalar: Sequence[str] = (), arrays: Sequence[str] = (), path: str | None = None) -> FacetBitmaps:
    """Store a table with the bitmaps of its facets (``path`` None: in the session's shared scratch folder)."""
    spark = df.sparkSession
    if "row" in df.columns:
        raise ValueError("the table has a column 'row'; rename it")
    path = path or scratch(spark, "bitmaps")
    # numbers from 1 on, as the bitmap functions count
    df.withColumn("row", F.monotonically_increasing_id() + 1).write.mode("overwrite").parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    pair = lambda facet: lambda v: F.struct(F.lit(facet).alias("facet"), v.cast("string").alias("value"))
    pairs = [F.array(pair(c)(F.col(c))) for c in scalar]
    pairs += [F.transform(F.coalesce(F.array_distinct(F.col(c)), F.array().cast("array<string>")), pair(c)) for c in arrays]
    each = stored.select("row", F.explode_outer(F.concat(*pairs) if pairs else F.array().cast("array<struct<facet:string,value:string>>")).alias("p"))
    each = each.select("row", "p.facet", "p.value").where(F.col("value").isNotNull())
    bitmaps = each.groupBy("facet", "value", _bucket()).agg(_bits())
    bitmaps.repartitionByRange("facet", "value", "bucket").sortWithinPartitions("facet", "value", "bucket").write.mode("overwrite").parquet(f"{path}/bitmaps")
    spark.createDataFrame([([*scalar, *arrays],)], "facets array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/facets")
    return FacetBitmaps.load(spark, path)
