"""Registered queries: filters, lookups and facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.identity import lookup_many, lookup_one, row_hash
from ..operators import facets as FC
from ..operators import predicates as P
from ..operators.facet_bitmaps import build_facet_bitmaps
from ..operators.trigram_index import build_trigram_index
from ..session import scratch, table
from ..sources.lookup import read_for_lookup, write_for_lookup
from .registry import register

# ---------------------------------------------------------------------------
# F1 substring search
# ---------------------------------------------------------------------------


@register(
    "substring_search",
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE contains(lower(text), 'ndtion') OR contains(lower(source), 'ndtion') OR contains(lower(lang), 'ndtion')
    """,
)
def substring_search(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    pred = P.substring_any(["text", "source", "lang"], "NDtion", mode="literal")
    return d.where(pred).select("doc_id", "lang", "source", "n_chars")


@register(
    "substring_wildcard",
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE text ILIKE '%nd_ion%' OR source ILIKE '%nd_ion%' OR lang ILIKE '%nd_ion%'
    """,
)
def substring_wildcard(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    pred = P.substring_any(["text", "source", "lang"], "nd_ion", mode="compat")
    return d.where(pred).select("doc_id", "lang", "source", "n_chars")


def _trigrams(spark, sf_dir):
    return build_trigram_index(table(spark, sf_dir, "documents"), ["text", "source", "lang"])


@register(
    "substring_indexed",
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE contains(lower(text), 'ndtion') OR contains(lower(source), 'ndtion') OR contains(lower(lang), 'ndtion')
    """,
)
def substring_indexed(spark, sf_dir):
    """F1 by the trigram index of the whole table, built here: the rows of ``substring_search``."""
    return _trigrams(spark, sf_dir).matching("NDtion").select("doc_id", "lang", "source", "n_chars")


@register(
    "substring_indexed_wildcard",
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE text ILIKE '%ndt_on%the%' OR source ILIKE '%ndt_on%the%' OR lang ILIKE '%ndt_on%the%'
    """,
)
def substring_indexed_wildcard(spark, sf_dir):
    """F1 compat by the index: the pieces between the wildcards have trigrams."""
    return _trigrams(spark, sf_dir).matching("ndt_on%THE", mode="compat").select("doc_id", "lang", "source", "n_chars")


@register(
    "trigram_counts",
    """
    WITH t AS (SELECT doc_id, lower(concat_ws(chr(1), text, source, lang)) AS t FROM documents),
      g AS (SELECT DISTINCT doc_id, substring(t, i, 3) AS gram FROM (SELECT doc_id, t, unnest(range(1, length(t) - 1)) AS i FROM t))
    SELECT gram, count(*) AS n FROM g WHERE NOT contains(gram, chr(1)) GROUP BY gram
    """,
)
def trigram_counts(spark, sf_dir):
    """The index's trigrams with the number of rows that hold each."""
    return _trigrams(spark, sf_dir).grams


# ---------------------------------------------------------------------------
# F6 array contains any
# ---------------------------------------------------------------------------


@register(
    "contains_any",
    """
    SELECT p_partkey, p_name FROM part
    WHERE list_has_any(string_split(p_name, ' '), ['ring', 'bolt'])
    """,
)
def contains_any(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.split("p_name", " ").alias("words"))
    return p.where(P.contains_any("words", ["ring", "bolt"])).select("p_partkey", "p_name")


# ---------------------------------------------------------------------------
# F5 F7 F8 two-value facet and tri-state flags
# ---------------------------------------------------------------------------

_TRI_BASE_SQL = """
    WITH o AS (
      SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS is_final,
             o_orderpriority = '1-URGENT' AS is_urgent,
             CASE WHEN o_orderstatus = 'O' THEN 'Internal' ELSE 'External' END AS kind
      FROM orders)
"""


def _tri_base(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("boolean"))
        .otherwise(F.col("o_orderstatus") == "F")
        .alias("is_final"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_urgent"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Internal")).otherwise(F.lit("External")).alias("kind"),
    )


@register(
    "tri_state_one",
    _TRI_BASE_SQL + "SELECT * FROM o WHERE kind IN ('External') AND is_final = true AND is_urgent = false",
)
def tri_state_one(spark, sf_dir):
    spec = P.SearchSpec(
        two_value={"kind": (("External",), P.POSTING_TYPES)},
        flags={"is_final": (True, False), "is_urgent": (False, True)},
    )
    return _tri_base(spark, sf_dir).where(spec.predicate())


@register("tri_state_both", _TRI_BASE_SQL + "SELECT * FROM o")
def tri_state_both(spark, sf_dir):
    spec = P.SearchSpec(
        two_value={"kind": (("External", "Internal"), P.POSTING_TYPES)},
        flags={"is_final": (True, True), "is_urgent": (False, False)},
    )
    return _tri_base(spark, sf_dir).where(spec.predicate())


# ---------------------------------------------------------------------------
# F9 range overlap, F11 last N days
# ---------------------------------------------------------------------------


@register(
    "range_overlap",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS lo, l_extendedprice AS hi
    FROM lineitem
    WHERE l_extendedprice >= 20000.0 AND l_extendedprice * (1 - l_discount) <= 30000.0
    """,
)
def range_overlap(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("lo"),
        F.col("l_extendedprice").alias("hi"),
    )
    return li.where(P.range_overlap("lo", "hi", 20000.0, 30000.0))


@register(
    "last_n_days",
    """
    SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 90 DAY
    """,
)
def last_n_days(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where(P.last_n_days("o_orderdate", "90", as_of="2001-08-01")).select("o_orderkey", "o_orderdate", "o_orderpriority")


# ---------------------------------------------------------------------------
# F13 lookups by row hash
# ---------------------------------------------------------------------------

_CUSTOMER_ID_SQL = """
    md5(concat_ws(chr(31),
        coalesce(CAST(c_custkey AS VARCHAR), chr(1)),
        coalesce(c_name, chr(1)),
        coalesce(CAST(c_nationkey AS VARCHAR), chr(1)),
        coalesce(CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR), chr(1)),
        coalesce(c_mktsegment, chr(1))))
"""


def _customers_with_id(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return c.select(row_hash(cols, c).alias("id"), *cols)


@register(
    "point_lookup",
    f"""
    WITH c AS (SELECT {_CUSTOMER_ID_SQL} AS id, c_custkey, c_name FROM customer)
    SELECT id, c_custkey, c_name FROM c
    WHERE id = (SELECT id FROM c WHERE c_custkey = 7)
    LIMIT 1
    """,
)
def point_lookup(spark, sf_dir):
    c = _customers_with_id(spark, sf_dir)
    wanted = c.where(F.col("c_custkey") == 7).select("id").scalar()
    return lookup_one(c, "id", wanted).select("id", "c_custkey", "c_name")


@register(
    "stored_lookup",
    f"""
    WITH c AS (SELECT {_CUSTOMER_ID_SQL} AS id, c_custkey, c_name FROM customer)
    SELECT id, c_custkey, c_name FROM c WHERE id = (SELECT min(id) FROM c) OR id = (SELECT max(id) FROM c)
    """,
)
def stored_lookup(spark, sf_dir):
    """F13 on a stored table with bloom filters on the id: the customers with the smallest and largest hash."""
    path = scratch(spark, "customers")
    customers = _customers_with_id(spark, sf_dir)
    write_for_lookup(customers, path)
    ids = customers.agg(F.min("id"), F.max("id")).first()
    return read_for_lookup(spark, path, [*ids, "0" * 32, None]).select("id", "c_custkey", "c_name")


@register(
    "batch_lookup",
    f"""
    WITH c AS (SELECT {_CUSTOMER_ID_SQL} AS id, c_custkey, c_name FROM customer)
    SELECT id, c_custkey, c_name FROM c
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
    """,
)
def batch_lookup(spark, sf_dir):
    c = _customers_with_id(spark, sf_dir)
    keys = table(spark, sf_dir, "orders").where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    )
    return lookup_many(c, "c_custkey", keys, "o_custkey").select("id", "c_custkey", "c_name")


# ---------------------------------------------------------------------------
# Facets
# ---------------------------------------------------------------------------


@register(
    "facet_values",
    """
    SELECT DISTINCT c_mktsegment FROM customer
    WHERE c_mktsegment IS NOT NULL AND c_mktsegment <> ''
    ORDER BY c_mktsegment
    """,
)
def facet_values(spark, sf_dir):
    return FC.facet_values(table(spark, sf_dir, "customer"), "c_mktsegment")


@register(
    "facet_array_values",
    """
    SELECT DISTINCT unnest(string_split(p_name, ' ')) AS value FROM part ORDER BY value
    """,
)
def facet_array_values(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("words"))
    return FC.facet_array_values(p, "words")


@register(
    "facets_one_scan",
    """
    SELECT DISTINCT facet, value FROM (
      SELECT 'o_orderpriority' AS facet, o_orderpriority AS value FROM orders
      UNION ALL
      SELECT 'o_orderstatus' AS facet, o_orderstatus AS value FROM orders
    ) WHERE value IS NOT NULL AND value <> ''
    ORDER BY facet, value
    """,
)
def facets_one_scan(spark, sf_dir):
    return FC.facets(table(spark, sf_dir, "orders"), scalar=["o_orderpriority", "o_orderstatus"])


@register(
    "facet_selected_first",
    """
    WITH v AS (SELECT DISTINCT n_name AS value FROM nation WHERE n_name IS NOT NULL AND n_name <> ''),
    s AS (SELECT value FROM v WHERE contains(lower(value), 'on_1'))
    SELECT value,
           row_number() OVER (ORDER BY value IN ('NATION_17', 'NATION_12') DESC, lower(value), value) AS position
    FROM s
    """,
)
def facet_selected_first(spark, sf_dir):
    values = FC.facet_values(table(spark, sf_dir, "nation"), "n_name", alias="value")
    found = FC.facet_search(values, "ON_1")
    return FC.selected_first(found, ["NATION_17", "NATION_12"])


_FACET_SPEC = P.SearchSpec(
    in_lists={"o_orderpriority": ("1-URGENT", "2-HIGH"), "o_orderstatus": ("F", "O")},
    overlap=("o_totalprice", "o_totalprice", 50000.0, None),
)


_FACET_COUNTS_SQL = """
    SELECT 'o_orderpriority' AS facet, o_orderpriority AS value, count(*) AS n FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 50000.0
      AND o_orderpriority IS NOT NULL AND o_orderpriority <> ''
    GROUP BY 1, 2
    UNION ALL
    SELECT 'o_orderstatus' AS facet, o_orderstatus AS value, count(*) AS n FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 50000.0
      AND o_orderstatus IS NOT NULL AND o_orderstatus <> ''
    GROUP BY 1, 2
    """


@register("facet_counts", _FACET_COUNTS_SQL)
def facet_counts(spark, sf_dir):
    return FC.facet_counts(table(spark, sf_dir, "orders"), _FACET_SPEC, scalar=["o_orderpriority", "o_orderstatus"])


@register("facet_counts_bitmap", _FACET_COUNTS_SQL)
def facet_counts_bitmap(spark, sf_dir):
    """E1 from stored bitmaps of the whole table: the counts of ``facet_counts``."""
    return build_facet_bitmaps(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"]).counts(_FACET_SPEC)


@register(
    "facet_array_counts_bitmap",
    """
    WITH p AS (SELECT p_partkey, p_brand, string_split(p_name, ' ') AS words FROM part)
    SELECT 'p_brand' AS facet, p_brand AS value, count(*) AS n FROM p WHERE list_has_any(words, ['ring', 'bolt']) GROUP BY 2
    UNION ALL
    SELECT 'words', w, count(*) FROM (SELECT DISTINCT p_partkey, unnest(words) AS w FROM p WHERE p_brand = (SELECT min(p_brand) FROM p)) WHERE w <> '' GROUP BY 2
    """,
)
def facet_array_counts_bitmap(spark, sf_dir):
    """E1 from bitmaps with an array facet; no filter but facets, so no row is read."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.split("p_name", " ").alias("words"))
    first = parts.agg(F.min("p_brand")).first()[0]
    spec = P.SearchSpec(in_lists={"p_brand": (first,)}, any_of={"words": ("ring", "bolt")})
    return build_facet_bitmaps(parts, ["p_brand"], ["words"]).counts(spec)
