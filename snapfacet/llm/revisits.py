"""Operator 5, WARC: not-modified revisit records resolved to the response they stand for.

A revisit says that a URL was asked for again and had not changed: it has headers but no body. It
is resolved by an as-of join: among the full responses of the same canonical URL, the latest that
is earlier than the revisit. The validators must agree (strong or weak ETag by value, or the
modification date where the revisit has no ETag); then the revisit's permitted headers replace the
stored ones and the others of the response stay.

The as-of join is a running maximum in two levels, so that no task gets all records of a URL that
holds a third of them: within blocks of time of a URL first, then over one row per block.
Records get a row number that is fixed by a write; the response found joins by it, without its body unless
``body`` is asked for. So record ids may be null or repeated.

Defined results: a record without URL or time resolves to nothing and nothing resolves to it; a
response at the same time is not earlier; of several responses at one time the one with the largest
record id counts, a null id before all others, and of equal ones the last row; header names are compared in lower case, a null header map is empty; a
revisit without validators is 'no_validator'; records of other kinds are left out; repeated rows
are returned as often as they are there; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch, table
from . import blocks as B

#: Headers that a not-modified answer may renew; all others stay as stored.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Query parameters that name where a visitor came from, not the page.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.`` or ``m.``, default port, fragment, tracking parameters and the last slash
    go; host and scheme are compared in lower case; other parameters are sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_extract(bare, "^[^?]*", 0)
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(place, "^[^/]*", 0)), "^(www|m)\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, "/.*$", 0), "/+$", "")
    query = F.regexp_extract(bare, "\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _headers(column: Column) -> Column:
    """The header map with names in lower case (of names that are then equal the last stays)."""
    entries = F.map_entries(F.coalesce(column, F.create_map().cast("map<string,string>")))
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def _etag(headers: Column) -> Column:
    return F.regexp_replace(F.element_at(headers, "etag"), "^W/", "")


def resolve_revisits(
    records: DataFrame,
    id_col: str = "record_id",
    kind_col: str = "kind",
    url_col: str = "url",
    time_col: str = "time",
    headers_col: str = "headers",
    body: str | None = None,
    block: int = 86_400,
) -> DataFrame:
    """One row per revisit: ``record_id``, ``url`` (canonical), ``time``, ``status`` ('resolved',
    'validator_mismatch', 'no_validator', 'no_response'), ``response_id``, ``response_time``,
    ``headers`` (merged where resolved, else the revisit's own) and, with ``body``, the response's
    body. ``time`` is a number (seconds); ``block`` is the width of a time block in its unit."""
    every = records.select(
        B.quoted(id_col).cast("long").alias("record_id"),
        F.lower(B.quoted(kind_col)).alias("kind"),
        canonical_url(B.quoted(url_col)).alias("url"),
        B.quoted(time_col).cast("long").alias("time"),
        _headers(B.quoted(headers_col)).alias("headers"),
        *([B.quoted(body).alias("body")] if body is not None else []),
    ).where(F.col("kind").isin("response", "revisit"))
    every = every.withColumn("block", F.floor(F.col("time") / block)).withColumn("row", F.monotonically_increasing_id())
    path = scratch(records.sparkSession, "records")
    every.write.parquet(path)
    every = records.sparkSession.read.schema(every.schema).parquet(path)
    response = F.when(F.col("kind") == "response", F.struct(F.col("time").alias("t"), F.col("record_id").alias("id"), "row"))
    # within a block: the latest response at a smaller time
    inside = Window.partitionBy("url", "block").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    slim = every.where("url IS NOT NULL AND time IS NOT NULL").select("record_id", "kind", "url", "time", "block", "row")
    asof = slim.withColumn("near", F.max(response).over(inside)).where("kind = 'revisit'")
    # before the block: the latest response of all earlier blocks of the URL, one row a block
    blocks = slim.groupBy("url", "block").agg(F.max(response).alias("last"))
    before = Window.partitionBy("url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("url", "block", F.max("last").over(before).alias("far")).where("far IS NOT NULL")
    asof = asof.join(blocks, ["url", "block"], "left").select(F.col("row").alias("_revisit"), F.coalesce("near", "far").alias("of"))
    asof = asof.where("of IS NOT NULL").select("_revisit", F.col("of.row").alias("_row"), F.col("of.id").alias("response_id"), F.col("of.t").alias("response_time"))
    kept = [F.col("body")] if body is not None else []
    stored = every.where("kind = 'response'").select(F.col("row").alias("_row"), F.col("headers").alias("_stored"), *kept)
    revisits = every.where("kind = 'revisit'").drop("body")
    out = revisits.join(asof, F.col("row") == F.col("_revisit"), "left").join(stored, "_row", "left")
    own, old = F.col("headers"), F.col("_stored")
    has_etag, has_date = _etag(own).isNotNull(), F.element_at(own, "last-modified").isNotNull()
    agree = F.when(has_etag, _etag(own) == _etag(old)).otherwise(F.element_at(own, "last-modified") == F.element_at(old, "last-modified"))
    status = (
        F.when(F.col("_row").isNull(), "no_response")
        .when(~has_etag & ~has_date, "no_validator")
        .when(F.coalesce(agree, F.lit(False)), "resolved")
        .otherwise("validator_mismatch")
    )
    allowed = F.map_filter(own, lambda k, v: k.isin(PERMITTED))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)
    out = out.withColumn("status", status)
    cols = ["record_id", "url", "time", "status", "response_id", "response_time"]
    cols.append(F.when(F.col("status") == "resolved", merged).otherwise(own).alias("headers"))
    if body is not None:
        cols.append(F.when(F.col("status") == "resolved", F.col("body")).alias("body"))
    return out.select(*cols)


def crawl_records(pages: DataFrame) -> DataFrame:
    """Two captures of every page: the response, and a later revisit of the URL in another
    spelling. The validators of every fifth page's revisit are of other content, every seventh has
    only a date, every eleventh none."""
    i = F.col("page_id")
    total = i.cast("long") * 2
    etag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    changed = F.concat(F.lit('W/"'), F.md5(F.concat(F.coalesce("html", F.lit("")), F.lit("!"))), F.lit('"'))
    date = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (i % 300).cast("int")), "yyyy-MM-dd")
    length = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    m = lambda *kv: F.create_map(*(x if isinstance(x, Column) else F.lit(x) for x in kv))
    response = m("Content-Type", "text/html", "Content-Length", length, "ETag", etag, "Last-Modified", date, "Cache-Control", "max-age=60")
    renewed = m("Content-Length", "0", "Cache-Control", "max-age=600", "Expires", date, "Server", "cache")
    weak = F.concat(F.lit("W/"), etag)
    validators = (
        F.when(i % 11 == 0, m().cast("map<string,string>"))
        .when(i % 7 == 0, m("Last-Modified", date))
        .when(i % 5 == 0, m("ETag", changed))
        .otherwise(m("ETag", weak))
    )
    first = pages.select(total.alias("record_id"), F.lit("response").alias("kind"), "url", total.alias("time"), response.alias("headers"))
    again = pages.select(
        (total + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.concat(F.col("url"), F.lit("#again")).alias("url"),
        (total + 1 + (i % 100) * 50).alias("time"),
        F.map_concat(renewed, validators).alias("headers"),
    )
    return first.union(again)


def op5_not_modified_revisits(spark, sf_dir: str) -> DataFrame:
    """All ``pages`` as crawl records (see ``crawl_records``), every revisit resolved."""
    out = resolve_revisits(crawl_records(table(spark, sf_dir, "pages")), block=4096)
    entries = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("record_id", "url", "status", "response_id", "response_time", F.array_join(entries, "; ").alias("headers"))


OP5_SQL = """
WITH p AS (SELECT page_id AS i, url, coalesce(html, '') AS html FROM pages),
  base AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM p),
  parts AS (SELECT *, regexp_extract(bare, '^[^?]*') AS place, regexp_extract(bare, '\\?(.*)$', 1) AS q FROM base),
  canon AS (SELECT i, html,
      regexp_replace(regexp_replace(lower(regexp_extract(place, '^[^/]*')), '^(www|m)\\.', ''), ':(80|443)$', '')
      || regexp_replace(regexp_extract(place, '/.*$'), '/+$', '') AS path,
      list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) AS args,
      strftime(DATE '2024-01-01' + CAST(i % 300 AS INTEGER), '%Y-%m-%d') AS day FROM parts),
  c AS (SELECT i, html, day, path || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS url,
      '"' || md5(html) || '"' AS etag FROM canon),
  responses AS (SELECT 2 * i AS id, 2 * i AS t, url, etag, day, strlen(html) AS n FROM c),
  revisits AS (SELECT 2 * i + 1 AS id, 2 * i + 1 + (i % 100) * 50 AS t, url, day,
      CASE WHEN i % 11 = 0 OR i % 7 = 0 THEN NULL WHEN i % 5 = 0 THEN '"' || md5(html || '!') || '"' ELSE etag END AS etag,
      CASE WHEN i % 11 = 0 OR i % 7 = 0 THEN NULL WHEN i % 5 = 0 THEN 'W/"' || md5(html || '!') || '"' ELSE 'W/' || etag END AS sent,
      CASE WHEN i % 11 <> 0 AND i % 7 = 0 THEN day END AS modified FROM c),
  j AS (SELECT v.*, r.id AS rid, r.t AS rt, r.etag AS retag, r.day AS rday, r.n AS rn,
      row_number() OVER (PARTITION BY v.id ORDER BY r.t DESC NULLS LAST, r.id DESC) AS k
      FROM revisits v LEFT JOIN responses r ON r.url = v.url AND r.t < v.t),
  s AS (SELECT *, CASE WHEN rid IS NULL THEN 'no_response' WHEN etag IS NULL AND modified IS NULL THEN 'no_validator'
      WHEN coalesce(CASE WHEN etag IS NOT NULL THEN etag = retag ELSE modified = rday END, false) THEN 'resolved' ELSE 'validator_mismatch' END AS status FROM j WHERE k = 1)
SELECT id AS record_id, url, status, rid AS response_id, rt AS response_time,
  CASE WHEN status = 'resolved' THEN 'cache-control=max-age=600; content-length=' || CAST(rn AS VARCHAR) || '; content-type=text/html; etag=' || coalesce(sent, retag)
    || '; expires=' || day || '; last-modified=' || coalesce(modified, rday)
  ELSE 'cache-control=max-age=600; content-length=0' || CASE WHEN sent IS NOT NULL THEN '; etag=' || sent ELSE '' END || '; expires=' || day
    || CASE WHEN modified IS NOT NULL THEN '; last-modified=' || modified ELSE '' END || '; server=cache' END AS headers
FROM s
"""
