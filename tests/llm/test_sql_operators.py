"""Operators with a DuckDB version: licences, revisits and top-k search."""

import duckdb
import pytest
from pyspark.sql import functions as F

from snapfacet.llm import hamming_search as H
from snapfacet.llm import license_scan as L
from snapfacet.llm import revisits as R

from .conftest import SF_SMALL

CASES = [
    (L.op3_license_scan, L.OP3_SQL, "documents"),
    (R.op5_not_modified_revisits, R.OP5_SQL, "pages"),
    (H.op6_exact_top_k, H.OP6_SQL, "embeddings"),
]


@pytest.mark.parametrize("query,sql,name", CASES)
def test_query_equals_its_sql(spark, query, sql, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    want = con.execute(sql)
    columns = [d[0] for d in want.description]
    out = query(spark, SF_SMALL)
    assert sorted(out.columns) == sorted(columns)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in out.select(*columns).collect())


def test_licenses_come_from_the_nearest_folder(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/COPYING.txt", "some words\nThis work is licensed under the GNU General Public License, version 3."),
        ("a/b/c/x.py", "print"),
        ("a/d/y.py", None),
        ("a/d/z.py", "# Licensed under the Apache License, Version 2.0\ncode " + "code " * 5000),
        ("e/w.py", "the license of the road"),
        ("top.py", ""),
        (None, "Released under the MIT License."),
        (None, "nothing"),
        ("a/d/y.py", None),
        ("ab/q.py", "q"),
    ]
    files = spark.createDataFrame([(*r, 1) for r in rows], "path string, text string, license int")
    got = [(r[0], r[1], r[2], r[3]) for r in L.scan(files).select("row.path", "license", "origin", "from_folder").collect()]
    want = [
        ("a/LICENSE", "MIT", "own", None), ("a/b/COPYING.txt", "GPL-3.0", "own", None), ("a/b/c/x.py", "GPL-3.0", "inherited", "a/b"),
        ("a/d/y.py", "MIT", "inherited", "a"), ("a/d/y.py", "MIT", "inherited", "a"), ("a/d/z.py", "Apache-2.0", "own", None),
        ("e/w.py", None, None, None), ("top.py", None, None, None), (None, "MIT", "own", None), (None, None, None, None), ("ab/q.py", None, None, None),
    ]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert L.scan(files.where("false")).count() == 0


def test_license_scan_runs_no_python(spark):
    plan = L.op3_license_scan(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_the_test_by_held_words_loses_nothing(spark, odd):
    """With the threshold at 0 every line is scored; what reaches 0.7 is the same."""
    rows = [(i, f"noise {t} {'more ' * (i % 9)}") for i, (_, t) in enumerate(L.TEMPLATES * 4)] + [(99, "license version of the work")]
    files = spark.createDataFrame(rows, "path long, text string")
    all_ = {r[0]: r[1] for r in L.own_licenses(files, threshold=0.0).select("row.path", "own").collect()}
    some = {r[0]: r[1] for r in L.own_licenses(files, threshold=0.7).select("row.path", "own").collect()}
    assert some == {p: (o if o is not None and o["score"] >= 0.7 else None) for p, o in all_.items()}
    assert any(some.values()) and not all(some.values())


def test_wrapped_headers_and_licence_files(spark):
    import textwrap

    gpl = """This file is part of Frob. Frob is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option)
        any later version."""
    wrapped = lambda text, mark: "\n".join(mark + x for x in textwrap.wrap(" ".join(text.split()), 60))
    paragraphs = lambda text: f"Copyright (c) 2020, Jane Doe\nAll rights reserved.\n\n{wrapped(text, '')}\n"
    code = "\n".join(f"value{i} = compute{i}(value{i + 1})" for i in range(200))
    header = lambda text: f"# Copyright 2020 Jane Doe\n#\n{wrapped(text, '# ')}\n#\n\n{code}\n"
    cc = lambda kind: f"{kind} 4.0 International\n\n{'=' * 60}\n\nCreative Commons\n{kind}\n4.0 International Public\nLicense\n\n{code}"
    rows = [
        ("GPL-3.0", header(gpl.format(3))), ("GPL-2.0", header(gpl.format(2))), ("LGPL-3.0", header(gpl.format(3).replace("General", "Lesser General"))),
        ("Apache-2.0", header(L._APACHE)), ("MIT", paragraphs(L._MIT + "\n" + L._MIT_END)), ("ISC", paragraphs(L._ISC)),
        ("BSD-2-Clause", paragraphs(L._BSD + L._BSD_END)), ("BSD-3-Clause", paragraphs(L._BSD + L._BSD_3 + L._BSD_END)),
        ("GPL-3.0", f"   GNU GENERAL PUBLIC LICENSE\r\n   Version 3, 29 June 2007\r\n\r\n{code}"), ("CC-BY-4.0", cc("Attribution")),
        ("CC-BY-NC-SA-4.0", cc("Attribution-NonCommercial-ShareAlike")), ("CC0-1.0", f"CC0\n\n{wrapped(L.TEXTS[12][1], '')}\n\n{code}"), (None, code),
    ]
    files = [(i, f"p{i}/LICENSE", name, text) for i, (name, text) in enumerate(rows)] + [(99, "p6/src/x.c", "BSD-2-Clause", "int x;")]
    out = L.scan(spark.createDataFrame(files, "n int, path string, want string, text string")).select("row.n", "row.want", "license").collect()
    assert len(out) == len(files) and [tuple(r) for r in out if r["want"] != r["license"]] == []


def test_headers_and_bodies_are_those_of_the_sql(spark, tmp_path, monkeypatch):
    """Documents that hold wrapped headers, titles and bodies: the query and its SQL on data that need them."""
    import textwrap

    import duckdb

    rows, code = [], "\n".join(f"value{i} = compute{i}(value{i + 1})" for i in range(30))
    for i, (_, text) in enumerate(L.TEXTS * 3):
        wrapped = textwrap.wrap(" ".join(text.split()), 50 + i % 30)
        kept = wrapped if i % 3 == 0 else [x for j, x in enumerate(wrapped) if j % (2 + i % 5)]  # some with lines left out
        mark = ("", "# ", " * ")[i % 3]
        rows.append((25 * i, f"intro {i}\n\n" * (i % 2) + "\n".join(mark + x for x in kept) + f"\n{mark}\n{code if i % 4 else ''}", f"src{i % 2}"))
    rows += [(25 * len(rows) + i, text, None) for i, (_, text) in enumerate(L.TEMPLATES)] + [(7, None, "src0"), (8, "", "src1"), (9, code, None)]
    path = f"{tmp_path}/sf"
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    got = sorted(map(str, (tuple(r) for r in L.op3_license_scan(spark, path).collect())))
    assert got == sorted(map(str, con.execute(L.OP3_SQL).fetchall()))
    found = {r[2] for r in con.execute(L.OP3_SQL).fetchall()}
    assert {"Apache-2.0", "BSD-3-Clause", "ISC", "MPL-2.0", "GPL-3.0", None} <= found


def test_canonical_urls(spark):
    same = ["http://www.Example.com/A/?utm_source=x#f", "https://example.com:443/A", "example.com/A/", "HTTP://m.example.com/A?ref=1"]
    other = ["http://example.com/a", "http://example.com/A?b=1", "http://example.com/A?a=2&b=1"]
    rows = spark.createDataFrame([(u,) for u in same + other + ["http://example.com/A?b=1&a=2", None]], "u string")
    got = [r[0] for r in rows.select(R.canonical_url(F.col("u"))).collect()]
    assert set(got[:4]) == {"example.com/A"} and len(set(got[4:7])) == 3 and got[7] == got[6] and got[8] is None


def test_revisit_cases(spark):
    rows = [
        (1, "response", "http://a/x", 10, {"ETag": '"1"', "Content-Length": "5", "X-A": "old"}),
        (2, "response", "http://a/x", 20, {"etag": '"2"', "Last-Modified": "d"}),
        (3, "revisit", "http://a/x#f", 20, {"ETag": '"1"', "Date": "new", "Content-Length": "0"}),  # 2 is not earlier
        (4, "revisit", "http://a/x", 500, {"ETag": 'W/"2"', "date": "D", "X-A": "no"}),
        (5, "revisit", "http://a/x", 500, {"ETag": '"1"'}),
        (6, "revisit", "http://a/x", 501, {"Last-Modified": "d"}),
        (7, "revisit", "http://a/x", 502, None),
        (8, "revisit", "http://b/", 5, {"ETag": '"1"'}),
        (9, "revisit", None, 5, {"ETag": '"1"'}),
        (10, "revisit", "http://a/x", None, {"ETag": '"1"'}),
        (11, "metadata", "http://a/x", 1, None),
    ]
    records = spark.createDataFrame(rows, "record_id long, kind string, url string, time long, headers map<string,string>").withColumn("body", F.lit("b"))
    for block in (1, 7, 10**6):
        out = {r["record_id"]: r for r in R.resolve_revisits(records, block=block, body="body").collect()}
        assert {i: (r["status"], r["response_id"]) for i, r in out.items()} == {
            3: ("resolved", 1), 4: ("resolved", 2), 5: ("validator_mismatch", 2), 6: ("resolved", 2), 7: ("no_validator", 2),
            8: ("no_response", None), 9: ("no_response", None), 10: ("no_response", None),
        }
        assert out[3]["headers"] == {"etag": '"1"', "content-length": "5", "x-a": "old", "date": "new"} and out[3]["body"] == "b"
        assert out[4]["headers"] == {"etag": 'W/"2"', "last-modified": "d", "date": "D"} and out[5]["body"] is None
    assert R.resolve_revisits(records.where("false")).count() == 0


def test_revisits_with_null_and_repeated_ids(spark):
    """Records are told apart by their rows: equal ids at other URLs, null ids, rows twice."""
    etag = lambda x: {"ETag": f'"{x}"'}
    rows = [
        (1, "response", "http://a/", 10, etag("a")),
        (1, "response", "http://b/", 10, etag("b")),
        (2, "revisit", "http://a/", 40, etag("a")),
        (2, "revisit", "http://b/", 40, etag("b")),
        (None, "revisit", "http://a/", 40, etag("a")),
        (None, "revisit", "http://b/", 41, etag("x")),
        (None, "response", "http://c/", 10, etag("c")),
        (3, "revisit", "http://c/", 20, etag("c")),
        (3, "revisit", "http://c/", 20, etag("c")),
        (4, "revisit", "http://d/", 20, etag("d")),
    ]
    records = spark.createDataFrame(rows, "record_id long, kind string, url string, time long, headers map<string,string>")
    records = records.withColumn("body", F.col("url"))
    for block in (1, 25, 10**6):
        out = R.resolve_revisits(records, block=block, body="body").collect()
        got = sorted((str(r["record_id"]), r["url"], r["status"], r["response_id"], r["response_time"], r["body"]) for r in out)
        assert got == [
            ("2", "a", "resolved", 1, 10, "http://a/"), ("2", "b", "resolved", 1, 10, "http://b/"), ("3", "c", "resolved", None, 10, "http://c/"),
            ("3", "c", "resolved", None, 10, "http://c/"), ("4", "d", "no_response", None, None, None),
            ("None", "a", "resolved", 1, 10, "http://a/"), ("None", "b", "validator_mismatch", 1, 10, None),
        ]


def test_top_k_is_brute_force(spark):
    import random

    rng = random.Random(5)
    codes = [rng.getrandbits(20) for _ in range(300)] + [7] * 40
    rows = list(enumerate(codes))
    table = spark.createDataFrame(rows, "id long, code long")
    for k, segment, block in ((3, 6, 10**6), (50, 4, 8), (400, 5, 50)):
        out = H.top_k(table, table.where("id % 25 = 0"), bits=20, k=k, segment=segment, block=block)
        want = []
        for q, c in rows[::25]:
            near = sorted(((c ^ d).bit_count(), i) for i, d in rows if i != q)[:k]
            want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
        assert sorted(map(tuple, out.collect())) == sorted(want)


def test_top_k_odd_vectors(spark):
    rows = [(1, [1.0, -1.0]), (2, None), (3, []), (4, [1.0, None]), (5, [1.0, -2.0]), (None, [1.0, 1.0]), (5, [1.0, -2.0]), (6, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    codes = H.sign_codes(table, "vec_id", "embedding", 2)
    out = sorted((r["query_id"], r["id"], r["distance"]) for r in H.top_k(codes, codes, bits=2, k=5, segment=1).collect())
    assert (1, 5, 0) in out and (6, 1, 0) in out and not any(r[1] in (2, 3, 4) for r in out)
    assert H.top_k(codes.where("false"), codes.where("false"), bits=2).count() == 0
