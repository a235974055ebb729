"""Registered queries: column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import casts, labels
from ..functions.identity import row_hash
from ..functions.phrases import split_known_phrases
from ..functions.text_format import text_items, with_structured_text
from ..operators.export import visible_columns, with_defaults
from ..session import table
from .registry import register

# ---------------------------------------------------------------------------
# P8 known-phrase splitter
# ---------------------------------------------------------------------------

# Vocabulary with two overlapping pairs ("4-NOT SPECIFIED" / "NOT SPECIFIED",
# "2-HIGH" / "HIGH"), longest first as the reference orders its list.
PHRASES = (
    "4-NOT SPECIFIED",
    "AUTOMOBILE",
    "FURNITURE",
    "HOUSEHOLD",
    "MACHINERY",
    "NOT SPECIFIED",
    "1-URGENT",
    "3-MEDIUM",
    "BUILDING",
    "2-HIGH",
    "5-LOW",
    "HIGH",
)

_PHRASE_TEXT_SQL = """
    WITH t AS (
      SELECT o.o_orderkey, concat_ws(' ', o.o_orderstatus, o.o_orderpriority, c.c_mktsegment) AS text
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
"""


def _phrase_text(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select("o_orderkey", F.concat_ws(" ", "o_orderstatus", "o_orderpriority", "c_mktsegment").alias("text"))


def _sql_chained() -> str:
    e = "text"
    for p in PHRASES:
        e = f"replace({e}, '{p}', '|{p}')"
    return f"list_transform(list_filter(string_split({e}, '|'), lambda x: length(x) > 0), lambda x: trim(x))"


def _sql_longest() -> str:
    longest_first = "|".join(sorted(PHRASES, key=len, reverse=True))
    marked = f"regexp_replace(text, '({longest_first})', '|\\1', 'g')"
    return f"list_filter(list_transform(string_split({marked}, '|'), lambda x: trim(x)), lambda x: length(x) > 0)"


@register(
    "split_phrases_longest",
    _PHRASE_TEXT_SQL
    + f"""
    SELECT o_orderkey, text, array_to_string(p, '|') AS phrases, len(p) AS n_phrases
    FROM (SELECT o_orderkey, text, {_sql_longest()} AS p FROM t)
    """,
)
def split_phrases_longest(spark, sf_dir):
    t = _phrase_text(spark, sf_dir).withColumn("p", split_known_phrases("text", PHRASES, "longest"))
    return t.select("o_orderkey", "text", F.array_join("p", "|").alias("phrases"), F.size("p").alias("n_phrases"))


@register(
    "split_phrases_chained",
    _PHRASE_TEXT_SQL
    + f"""
    SELECT o_orderkey, text, array_to_string(p, '|') AS phrases, len(p) AS n_phrases
    FROM (SELECT o_orderkey, text, {_sql_chained()} AS p FROM t)
    """,
)
def split_phrases_chained(spark, sf_dir):
    t = _phrase_text(spark, sf_dir).withColumn("p", split_known_phrases("text", PHRASES, "chained"))
    return t.select("o_orderkey", "text", F.array_join("p", "|").alias("phrases"), F.size("p").alias("n_phrases"))


# ---------------------------------------------------------------------------
# P9 row identity
# ---------------------------------------------------------------------------

_ORDER_COLS_SQL = [
    "CAST(o_orderkey AS VARCHAR)",
    "CAST(o_custkey AS VARCHAR)",
    "o_orderstatus",
    "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)",
    "o_orderpriority",
    "CAST(o_orderdate AS VARCHAR)",
]


def _md5_sql(parts) -> str:
    return "md5(concat_ws(chr(31), " + ", ".join(f"coalesce({p}, chr(1))" for p in parts) + "))"


def _orders_decimal(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")


@register("row_hash", f"SELECT o_orderkey, {_md5_sql(_ORDER_COLS_SQL)} AS id FROM orders")
def row_hash_q(spark, sf_dir):
    o = _orders_decimal(spark, sf_dir)
    return o.select("o_orderkey", row_hash(o.columns, o).alias("id"))


@register("content_hash", f"SELECT o_orderkey, {_md5_sql(_ORDER_COLS_SQL[:-1])} AS content_id FROM orders")
def content_hash(spark, sf_dir):
    o = _orders_decimal(spark, sf_dir)
    cols = [c for c in o.columns if c != "o_orderdate"]
    return o.select("o_orderkey", row_hash(cols, o).alias("content_id"))


# ---------------------------------------------------------------------------
# P2 P3 P5 casts and flags, P4 day-month-year, P10 snapshot key, P14 epoch dates
# ---------------------------------------------------------------------------


@register(
    "cast_and_flags",
    """
    WITH t AS (
      SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS price_text,
             strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS date_text,
             o_orderpriority,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status
      FROM orders)
    SELECT o_orderkey, CAST(price_text AS DOUBLE) AS price, CAST(date_text AS DATE) AS order_date,
           o_orderpriority = '1-URGENT' AS is_urgent, status = 'F' AS is_final
    FROM t
    """,
)
def cast_and_flags(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("price_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("date_text"),
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"),
    )
    return t.select(
        "o_orderkey",
        casts.to_double("price_text").alias("price"),
        casts.timestamp_text_to_date("date_text").alias("order_date"),
        casts.equals_flag("o_orderpriority", "1-URGENT").alias("is_urgent"),
        casts.equals_flag("status", "F").alias("is_final"),
    )


@register(
    "parse_dmy",
    """
    WITH t AS (SELECT o_orderkey, upper(strftime(o_orderdate, '%d-%b-%Y')) AS dmy FROM orders)
    SELECT o_orderkey, dmy, CAST(strptime(dmy, '%d-%b-%Y') AS DATE) AS parsed FROM t
    """,
)
def parse_dmy(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")).alias("dmy"))
    return t.select("o_orderkey", "dmy", casts.parse_dmy("dmy").alias("parsed"))


@register(
    "process_date_key",
    """
    WITH t AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS raw_text FROM events)
    SELECT event_id, raw_text, strftime(CAST(split_part(raw_text, '.', 1) AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS snapshot_key
    FROM t
    """,
)
def process_date_key(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = e.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("raw_text"))
    return t.select("event_id", "raw_text", casts.snapshot_key("raw_text").alias("snapshot_key"))


@register(
    "epoch_dates",
    """
    WITH t AS (
      SELECT event_id,
             CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000 ELSE (epoch_us(ts) // 1000) // 86400000 END AS n
      FROM events)
    SELECT event_id, n,
           CAST(CASE WHEN n > 1000000000 THEN CAST(epoch_ms(n) AS DATE) ELSE DATE '1970-01-01' + CAST(n AS INTEGER) END AS VARCHAR) AS iso_date
    FROM t
    """,
)
def epoch_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    # milliseconds since the epoch, truncated (not rounded) from microseconds
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    n = F.when(F.col("event_id") % 2 == 0, ms).otherwise(F.floor(ms / 86400000).cast("long"))
    t = e.select("event_id", n.alias("n"))
    return t.select("event_id", "n", casts.to_iso_date("n", "number").alias("iso_date"))


# ---------------------------------------------------------------------------
# P13 link, P15 P16 salary labels, P17 date labels
# ---------------------------------------------------------------------------


@register(
    "search_link",
    """
    WITH t AS (SELECT c_custkey, c_name || '!' AS title, '(' || c_mktsegment || ')''s ~*' AS agency FROM customer),
    u AS (SELECT c_custkey, url_encode(regexp_replace(concat_ws(' ', title, agency), '\\s+', '_', 'g')) AS e FROM t)
    SELECT c_custkey,
           'https://example.org/jobs?q=' || replace(replace(replace(replace(replace(replace(e,
             '%21', '!'), '%7E', '~'), '%2A', '*'), '%27', ''''), '%28', '('), '%29', ')') AS link
    FROM u
    """,
)
def search_link(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    t = c.select(
        "c_custkey",
        F.concat("c_name", F.lit("!")).alias("title"),
        F.concat(F.lit("("), "c_mktsegment", F.lit(")'s ~*")).alias("agency"),
    )
    return t.select("c_custkey", labels.search_link(["title", "agency"]).alias("link"))


_SALARY_BASE_SQL = """
    WITH t AS (
      SELECT p_partkey,
             CASE WHEN p_size < 5 THEN NULL WHEN p_size < 8 THEN 0.0 ELSE p_retailprice + 0.5 END AS lo,
             CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN p_retailprice + 0.5
                  ELSE p_retailprice * (1 + p_size / 10.0) END AS hi,
             CASE p_size % 3 WHEN 0 THEN 'Annual' WHEN 1 THEN 'Hourly' ELSE (CASE WHEN p_size > 40 THEN '' ELSE 'Daily' END) END AS freq
      FROM part)
"""


def _dollars_sql(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || '$' || format('{{:,}}', CAST(round(abs({x})) AS BIGINT)))"


def _salary_base(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size, price = F.col("p_size"), F.col("p_retailprice")
    return p.select(
        "p_partkey",
        F.when(size < 5, F.lit(None).cast("double")).when(size < 8, F.lit(0.0)).otherwise(price + 0.5).alias("lo"),
        F.when(size % 4 == 0, F.lit(None).cast("double"))
        .when(size % 4 == 1, price + 0.5)
        .otherwise(price * (1 + size / 10.0))
        .alias("hi"),
        F.when(size % 3 == 0, F.lit("Annual"))
        .when(size % 3 == 1, F.lit("Hourly"))
        .otherwise(F.when(size > 40, F.lit("")).otherwise(F.lit("Daily")))
        .alias("freq"),
    )


@register(
    "salary_label_short",
    _SALARY_BASE_SQL
    + f"""
    SELECT p_partkey,
      CASE WHEN lo IS NULL OR lo = 0 THEN '—'
           WHEN hi IS NOT NULL AND hi <> 0 AND hi <> lo
             THEN {_dollars_sql('lo')} || ' - ' || {_dollars_sql('hi')}
                  || CASE freq WHEN 'Annual' THEN '/yr' WHEN 'Hourly' THEN '/hr' ELSE '' END
           ELSE {_dollars_sql('lo')} || CASE freq WHEN 'Annual' THEN '/yr' WHEN 'Hourly' THEN '/hr' ELSE '' END
      END AS label
    FROM t
    """,
)
def salary_label_short(spark, sf_dir):
    t = _salary_base(spark, sf_dir)
    return t.select("p_partkey", labels.salary_label_short("lo", "hi", "freq").alias("label"))


@register(
    "salary_label_long",
    _SALARY_BASE_SQL
    + f"""
    SELECT p_partkey,
      CASE WHEN lo IS NULL OR lo = 0 THEN 'Not specified'
           WHEN hi IS NOT NULL AND hi <> 0 AND hi <> lo
             THEN {_dollars_sql('lo')} || ' - ' || {_dollars_sql('hi')} || ' (' || coalesce(nullif(freq, ''), 'Annual') || ')'
           ELSE {_dollars_sql('lo')} || ' (' || coalesce(nullif(freq, ''), 'Annual') || ')'
      END AS label
    FROM t
    """,
)
def salary_label_long(spark, sf_dir):
    t = _salary_base(spark, sf_dir)
    return t.select("p_partkey", labels.salary_label_long("lo", "hi", "freq").alias("label"))


@register(
    "date_labels",
    """
    SELECT o_orderkey,
           coalesce(strftime(CAST(d AS DATE), '%b %-d, %Y'), '—') AS short_label,
           coalesce(strftime(CAST(d AS DATE), '%A, %B %-d, %Y'), '—') AS long_label
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS d FROM orders)
    """,
)
def date_labels(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderdate")).cast("date").alias("d"))
    return t.select("o_orderkey", labels.date_label_short("d").alias("short_label"), labels.date_label_long("d").alias("long_label"))


# ---------------------------------------------------------------------------
# P18 P19 text structuring
# ---------------------------------------------------------------------------

_SECTIONS_INPUT_SQL = """
    SELECT doc_id,
      '  Overview:  ' || replace(text, chr(10), '   ')
      || CASE WHEN lang IN ('en', 'fr') THEN '  1. first item; or 2. second item  3. third item' ELSE '' END
      || CASE WHEN lang IN ('de', 'fr') THEN '  Details:  · one & two · three <b>' ELSE '' END AS x
    FROM documents
"""


# Written by hand, apart from the implementation: boundaries are found one after the other in SQL,
# list tags come from the neighbouring rows.
_WS = "[\\t-\\r \\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]"
_ITEMS_SQL = f"""
WITH input AS ({_SECTIONS_INPUT_SQL}),
  a AS (SELECT doc_id, regexp_replace(x, '{_WS}{{2,}}([A-Za-z ]{{1,30}}):{_WS}{{2,}}', chr(1) || '\\1' || chr(2), 'g') AS x FROM input),
  b AS (SELECT doc_id, CASE WHEN regexp_matches(x, '(^{_WS}*|{_WS}{{2,}}|\x02)1\\.{_WS}')
      THEN regexp_replace(x, '(^{_WS}*|{_WS}{{2,}}|;{_WS}+or{_WS}+|\x02)[0-9]+\\.{_WS}', '\\1' || chr(6) || chr(3), 'g') ELSE x END AS x FROM a),
  c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(x, ';{_WS}+or{_WS}+\x06', chr(6), 'g'),
      '[·§•]', chr(6) || chr(4), 'g'), '{_WS}{{3,}}', chr(6) || chr(5), 'g') AS x FROM b),
  s AS (SELECT doc_id, unnest(string_split(x, chr(1))) AS s, generate_subscripts(string_split(x, chr(1)), 1) - 1 AS section_no FROM c),
  t AS (SELECT doc_id, section_no, CASE WHEN section_no > 0 THEN trim(string_split(s, chr(2))[1], ' ') END AS section,
      string_split(CASE WHEN section_no > 0 THEN substr(s, strpos(s, chr(2)) + 1) ELSE s END, chr(6)) AS parts FROM s),
  p AS (SELECT doc_id, section_no, section, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM t),
  q AS (SELECT doc_id, section_no, section, k,
      CASE substr(part, 1, 1) WHEN chr(3) THEN 'numbered' WHEN chr(4) THEN 'bullet' ELSE 'paragraph' END AS kind,
      regexp_replace(regexp_replace(part, '[\x03\x04\x05]', '', 'g'), '^{_WS}+|{_WS}+$', '', 'g') AS text FROM p),
  items AS (SELECT doc_id, section_no, section, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY k) - 1 AS item_no, kind, text
      FROM q WHERE text <> '')
"""
_ESCAPED = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(160), '&nbsp;')"
_HTML_SQL = (
    _ITEMS_SQL
    + f"""
  , tags AS (SELECT *, CASE kind WHEN 'numbered' THEN 'ol' WHEN 'bullet' THEN 'ul' END AS tag,
      lag(kind) OVER w AS before, lead(kind) OVER w AS after FROM items WINDOW w AS (PARTITION BY doc_id, section_no ORDER BY item_no)),
  el AS (SELECT doc_id, section_no, item_no,
      CASE WHEN tag IS NOT NULL AND before IS DISTINCT FROM kind THEN '<' || tag || '>' ELSE '' END
      || CASE WHEN tag IS NULL THEN '<p>' ELSE '<li>' END || {_ESCAPED.format("text")} || CASE WHEN tag IS NULL THEN '</p>' ELSE '</li>' END
      || CASE WHEN tag IS NOT NULL AND after IS DISTINCT FROM kind THEN '</' || tag || '>' ELSE '' END AS h FROM tags
    UNION ALL SELECT doc_id, section_no, -1, '<h4>' || {_ESCAPED.format("section")} || '</h4>' FROM t WHERE section <> ''),
  html AS (SELECT doc_id, string_agg(h, '' ORDER BY section_no, item_no) AS html FROM el GROUP BY doc_id)
SELECT input.doc_id, coalesce(html, '') AS html, length(coalesce(html, '')) AS html_len FROM input LEFT JOIN html USING (doc_id)
"""
)


def _sections_input(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    lang = F.col("lang")
    x = F.concat(
        F.lit("  Overview:  "),
        F.replace(F.col("text"), F.lit("\n"), F.lit("   ")),
        F.when(lang.isin("en", "fr"), F.lit("  1. first item; or 2. second item  3. third item")).otherwise(F.lit("")),
        F.when(lang.isin("de", "fr"), F.lit("  Details:  · one & two · three <b>")).otherwise(F.lit("")),
    )
    return d.select("doc_id", x.alias("x"))


@register("text_sections", _HTML_SQL)
def text_sections(spark, sf_dir):
    staged = with_structured_text(_sections_input(spark, sf_dir), "x", "html")
    return staged.select("doc_id", "html", F.length("html").alias("html_len"))


@register("text_sections_long", _ITEMS_SQL + "SELECT doc_id, section_no, section, item_no, kind, text FROM items")
def text_sections_long(spark, sf_dir):
    return text_items(_sections_input(spark, sf_dir), "doc_id", "x")


# ---------------------------------------------------------------------------
# P12 P20 export defaults and visible columns
# ---------------------------------------------------------------------------


@register(
    "export_defaults",
    """
    WITH t AS (
      SELECT o_orderkey AS business_title_key,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS business_title,
             CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS agency,
             CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS salary_range_from,
             CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS posted_date,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS is_full_time
      FROM orders)
    SELECT business_title_key, coalesce(business_title, '') AS business_title, coalesce(agency, '') AS agency,
           salary_range_from, coalesce(CAST(posted_date AS VARCHAR), '') AS posted_date,
           coalesce(is_full_time, false) AS is_full_time
    FROM t
    """,
)
def export_defaults(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    t = o.select(
        F.col("o_orderkey").alias("business_title_key"),
        F.when(st == "P", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("business_title"),
        F.when(st == "O", F.lit(None)).otherwise(st).alias("agency"),
        F.when(st == "F", F.lit(None)).otherwise(F.col("o_totalprice")).alias("salary_range_from"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderdate").cast("date")).alias("posted_date"),
        F.when(st == "P", F.lit(None).cast("boolean")).otherwise(st == "F").alias("is_full_time"),
    )
    shown = visible_columns(with_defaults(t), {"is_full_time": True}, keep=["business_title_key"])
    return shown
