"""Revisit resolution: the given table against SQL, and a brute-force as-of join."""

from __future__ import annotations

import importlib.util
import os
import random

from llm_fixtures import docs, table  # noqa: F401

from adtally.llm import revisits
from adtally.llm.queries import oracle_sql, queries
from pyspark.sql import functions as F

_spec = importlib.util.spec_from_file_location(
    "compare_oracle", os.path.join(os.path.dirname(__file__), "..", "..", "scripts", "compare_oracle.py"))
cmp = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(cmp)
SCHEMA = ("record_id long, kind string, url string, ts long, status int, etag string, last_modified string, "
          "headers map<string,string>, body string, found string")  # ``found`` clashes with an inner name


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    got = queries()["op3_revisits"](spark, d).toPandas()
    want = cmp.duck(d).execute(oracle_sql()["op3_revisits"]).df()
    assert cmp.normalise(got).equals(cmp.normalise(want)) and len(got) > 0
    assert {"etag", "last-modified", "changed", "no-response"} <= set(got.outcome)


def test_canonical_urls(spark):
    urls = {"http://WWW.Example.com:80/a/b/?utm_source=x&b=2&a=1#frag": "example.com/a/b?a=1&b=2", "https://example.com": "example.com",
            "https://example.com/": "example.com", "HTTPS://m.example.com/A?utm_x=1": "m.example.com/A", None: None}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.c for r in df.select("u", revisits.canonical_url(F.col("u")).alias("c")).collect()} == urls


def test_urls_without_scheme_and_host_stay_apart(spark):
    urls = {"dns:a.example": "dns:a.example", " urn:isbn:1#x": "urn:isbn:1", "//a.example/p": "//a.example/p", "a.example/p?b=1": "a.example/p?b=1"}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.c for r in df.select("u", revisits.canonical_url(F.col("u")).alias("c")).collect()} == urls
    rows = [(1, "response", "dns:a.example", 1, 200, None, None, None, "a", "x"), (2, "revisit", "dns:b.example", 2, 304, None, None, None, None, "x")]
    out = revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.record_id, r.outcome, r.body) for r in out] == [(2, "no-response", None)]


def test_asof_equals_brute_force_on_a_hot_url(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        kind = rnd.choice(["response", "revisit", "revisit", "other", None])
        rows.append((i, kind, "http://hot.example/x" if i % 3 else f"http://e{i % 5}.example/", rnd.randint(0, 60), rnd.choice([200, 200, 404]) if kind == "response" else 304,
                     rnd.choice(['"a"', 'W/"a"', '"b"', None]), rnd.choice(["1", "2", None]), {"Date": str(i), "Content-Length": "5"} if i % 2 else None, f"body{i}" if kind == "response" else None, "x"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = {}
    for r in rows:
        if r[1] != "revisit":
            continue
        before = [x for x in rows if x[1] == "response" and x[4] == 200 and x[2] == r[2] and (x[3], x[0]) < (r[3], r[0])]
        if not before:
            want[r[0]] = (None, "no-response", None)
            continue
        x = max(before, key=lambda b: (b[3], b[0]))
        tag = lambda t: t.removeprefix("W/")
        if r[5] and x[5]:
            outcome = "etag" if tag(r[5]) == tag(x[5]) else "changed"
        elif r[6] and x[6]:
            outcome = "last-modified" if r[6] == x[6] else "changed"
        else:
            outcome = "unchecked"
        want[r[0]] = (x[0], outcome, None if outcome == "changed" else x[8])
    for seconds in (1, 7, 86_400):
        got = {r.record_id: (r.response_id, r.outcome, r.body) for r in revisits.resolve(df, slice_seconds=seconds).collect()}
        assert got == want


def test_headers_nulls_repeats_and_empty(spark):
    u = "http://e.example/p"
    rows = [(1, "response", u, 5, 200, '"t"', None, {"Content-Type": "text/html", "ETAG": '"t"', "Date": "5", "Content-Length": "3"}, "abc", None),
            (1, "response", u, 5, 200, '"t"', None, {"Content-Type": "text/html", "ETAG": '"t"', "Date": "5", "Content-Length": "3"}, "abc", None),
            (2, "revisit", u, 9, 304, 'W/"t"', None, {"date": "9", "Content-Length": "0", "X-New": "no", "Expires": "99"}, None, None),
            (2, "revisit", u, 9, 304, 'W/"t"', None, {"date": "9", "Content-Length": "0", "X-New": "no", "Expires": "99"}, None, None),
            (3, "revisit", None, 9, 304, None, None, None, None, None), (4, "revisit", u, None, 304, None, None, None, None, None),
            (None, "revisit", u, 9, 304, None, None, None, None, None), (5, "revisit", u, 10, 304, None, None, None, None, None)]
    out = revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    two = [r for r in out if r.record_id == 2]
    assert len(two) == 2 and all(r.response_id == 1 and r.body == "abc" and r.status == 200 for r in two)
    assert two[0].headers == {"content-type": "text/html", "etag": '"t"', "date": "9", "content-length": "3", "expires": "99"}
    assert {r.record_id: r.outcome for r in out} == {2: "etag", 3: "no-key", 4: "no-key", None: "no-key", 5: "unchecked"}
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_its_sql_on_urls_without_scheme(spark, table):
    import duckdb

    urls = ["dns:a.example", "//b.example/p?x=1", "urn:isbn:1", "b.example/p", " urn:isbn:1 ", "http://", "", None, "http://c.example/p/?b=2&a=1&utm_x=1#f",
            "HTTPS://www.c.example:443/p?a=1&b=2", "dns:a.example#frag", "mailto:x@y"]
    rows = [(i, urls[i % len(urls)], None if i % 11 == 3 else f"<p>{i % 4}") for i in range(120)]
    d = table(pages=spark.createDataFrame(rows, "page_id long, url string, html string"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{d}/pages.parquet/*.parquet')")
    got = queries()["op3_revisits"](spark, d).where("outcome <> 'no-key'")
    want = con.execute(revisits.ORACLE_SQL).df()
    want = want[want["canonical_url"].notna()].reset_index(drop=True)
    got, want = cmp.normalise(got.toPandas()), cmp.normalise(want)
    assert len(got) > 50 and got.equals(want), (got[(got != want).any(axis=1)], want[(got != want).any(axis=1)])
