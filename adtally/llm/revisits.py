"""WARC not-modified revisits: each is resolved by an as-of join, on the
canonical URL, to the latest earlier full response.

Records: (record_id long, kind 'response' or 'revisit', url, ts long, status
int, etag, last_modified, headers map<string,string>, body string).

* Canonical URL: no scheme, fragment, default port, leading ``www.``, trailing
  slash or ``utm_`` parameter; host in lower case; parameters sorted. A URL
  without scheme and host is its own, trimmed and without fragment.
* Latest earlier: the greatest (ts, record_id) before the revisit's among
  responses with status 200. Found as a running maximum cut into time slices
  per URL (``slice_seconds``), so that no task holds all records of one URL;
  only ids travel, the response's content is joined on by id at the end.
* Validators: an entity tag, compared weakly, decides if both sides have one;
  else Last-Modified if both have it; else the revisit is taken as it is.
* Headers: the stored response's, updated by those of the revisit that a
  not-modified answer may change (``PERMITTED``); names in lower case.

``outcome`` is ``etag``, ``last-modified`` or ``unchecked`` for a resolved
revisit, ``changed`` where the validators differ (the earlier response's id is
given, its content isn't merged), ``no-response`` without an earlier response
and ``no-key`` for a null id, URL or time.

Defined results: a null kind or any other kind is ignored; null headers count as
none, a null body as empty; a repeated response id counts once (its greatest
row); repeated revisits are resolved each; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.running import running_sums
from .common import read_table

# Fields that a 304 answer may update in a stored response (RFC 9111, 3.2 and 4.3.4).
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
SLICE_SECONDS = 86_400


def canonical_url(url):
    bare = F.regexp_replace(url, "#.*$", "")
    host = F.lower(F.regexp_extract(bare, "^[a-zA-Z]+://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), ":(80|443)$", "")
    rest = F.regexp_extract(bare, "^[a-zA-Z]+://[^/?]*(.*)$", 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), "/+$", "")
    kept = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.startswith("utm_")))
    full = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(host == "", F.trim(bare)).otherwise(full)


def lower_names(headers):
    """Header map with lower-case names (of names that then coincide, the
    greatest value); null is empty."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    low = F.array_sort(F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    names = F.array_distinct(F.transform(low, lambda e: e["key"]))
    value = lambda n: F.element_at(F.filter(low, lambda e: e["key"] == n), -1)["value"]
    return F.map_from_arrays(names, F.transform(names, value))


def merged_headers(stored, fresh):
    """``stored`` updated by the permitted fields of ``fresh`` (both lower-case)."""
    allowed = F.map_filter(fresh, lambda k, v: k.isin(*PERMITTED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def resolve(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per revisit: (record_id, canonical_url, ts, response_id, outcome,
    status, headers, body); the last three are null unless resolved."""
    r = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("long").alias("ts"), "status",
        "etag", "last_modified", lower_names(F.col("headers")).alias("headers"), F.coalesce("body", F.lit("")).alias("body"))
    usable = F.col("canonical_url").isNotNull() & F.col("ts").isNotNull() & F.col("record_id").isNotNull()
    full = r.where((F.col("kind") == "response") & (F.col("status") == 200) & usable)
    revisit = r.where(F.col("kind") == "revisit")
    events = (full.select("canonical_url", "ts", "record_id", F.lit(0).alias("again"), F.lit(None).cast("string").alias("etag"),
                          F.lit(None).cast("string").alias("last_modified"), F.lit(None).cast("map<string,string>").alias("headers"))
              .union(revisit.where(usable).select("canonical_url", "ts", "record_id", F.lit(1), "etag", "last_modified", "headers"))
              .withColumn("_slice", F.floor(F.col("ts") / slice_seconds)))
    this = F.when(F.col("again") == 0, F.struct("ts", "record_id"))
    placed = (running_sums(events, ["canonical_url"], "_slice", ["ts", "record_id", "again"], {"found": this}, combine="max")
              .where(F.col("again") == 1))
    stored = full.groupBy(F.col("record_id").alias("response_id")).agg(F.max_by(
        F.struct("status", "etag", "last_modified", "headers", "body"),
        F.struct("ts", F.xxhash64("etag", "last_modified", F.to_json("headers"), "body"))).alias("s"))
    weak = lambda c: F.regexp_replace(F.col(c), "^W/", "")
    # revisits without an earlier response match nothing: a key of their own spreads them
    placed = (placed.withColumn("response_id", F.col("found.record_id"))
              .withColumn("_key", F.coalesce("response_id", F.xxhash64("record_id"))))
    stored = stored.withColumnRenamed("response_id", "_stored")
    joined = placed.join(stored, (F.col("_key") == F.col("_stored")) & F.col("response_id").isNotNull(), "left")
    both_tags = F.col("etag").isNotNull() & F.col("s.etag").isNotNull()
    both_times = F.col("last_modified").isNotNull() & F.col("s.last_modified").isNotNull()
    outcome = (F.when(F.col("response_id").isNull(), "no-response")
               .when(both_tags, F.when(weak("etag") == weak("s.etag"), "etag").otherwise("changed"))
               .when(both_times, F.when(F.col("last_modified") == F.col("s.last_modified"), "last-modified").otherwise("changed"))
               .otherwise("unchecked"))
    done = F.col("outcome").isin("etag", "last-modified", "unchecked")
    out = joined.withColumn("outcome", outcome).select(
        "record_id", "canonical_url", "ts", "response_id", "outcome", F.when(done, F.col("s.status")).alias("status"),
        F.when(done, merged_headers(F.col("s.headers"), F.col("headers"))).alias("headers"), F.when(done, F.col("s.body")).alias("body"))
    none = lambda t: F.lit(None).cast(t)
    lost = revisit.where(~usable).select("record_id", "canonical_url", "ts", none("long"), F.lit("no-key"), none("int"),
                                         none("map<string,string>"), none("string"))
    return out.union(lost)


def page_records(pages: DataFrame) -> DataFrame:
    """Crawl records from the pages table by a fixed rule: a response for each
    page at 10 * page_id seconds; a revisit 3 s later for every second page
    (other spelling of the URL, weak tag); a changed response 5 s later for
    every third; a revisit with the first tag (or only a date, every tenth
    page) 7 s later for every fifth; and one 1 s early for every seventh."""
    p = F.col("page_id")
    html = F.coalesce(F.col("html"), F.lit(""))
    tag = lambda text: F.concat(F.lit('"'), F.substring(F.md5(text.cast("binary")), 1, 16), F.lit('"'))
    one, two = html, F.concat(html, F.lit("<!-- 2 -->"))
    when = lambda at: (p * 10 + at).cast("string")
    text = lambda x: x.cast("string")
    none = F.lit(None).cast("string")
    pairs = lambda **kv: F.map_from_arrays(F.array(*[F.lit(k.replace("_", "-")) for k in kv]), F.array(*kv.values()))

    def record(n, kind, url, at, status, etag, modified, headers, body):
        return F.struct((p * 5 + n).alias("record_id"), F.lit(kind).alias("kind"), url.alias("url"), (p * 10 + at).alias("ts"),
                        F.lit(status).alias("status"), etag.alias("etag"), modified.alias("last_modified"),
                        headers.alias("headers"), body.alias("body"))

    def response(n, at, body):
        return record(n, "response", F.col("url"), at, 200, tag(body), when(0), pairs(
            Content_Type=F.lit("text/html"), Content_Length=text(F.length(body)), Etag=tag(body), Cache_Control=F.lit("max-age=60"), Date=when(at)), body)

    def revisit(n, at, url, etag, modified):
        return record(n, "revisit", url, at, 304, etag, modified, pairs(Date=when(at), Cache_Control=F.lit("max-age=120"), Content_Length=F.lit("0")), none)

    other = F.concat(F.regexp_replace(F.col("url"), "^http://", "https://"), F.lit("#again"))
    every = lambda n, r: F.when(p % n == 0, r)
    rows = F.array(response(0, 0, one), every(2, revisit(1, 3, other, F.concat(F.lit("W/"), tag(one)), when(0))),
                   every(3, response(2, 5, two)),
                   every(5, revisit(3, 7, F.col("url"), F.when(p % 10 != 0, tag(one)), when(0))),
                   every(7, revisit(4, -1, F.col("url"), tag(one), none)))
    return pages.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")


def op3_revisits(spark, sf_dir: str) -> DataFrame:
    """Every revisit of the crawl records derived from all of ``pages``."""
    found = resolve(page_records(read_table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("record_id", "canonical_url", "ts", "response_id", "outcome", "status",
                        F.array_join(lines, "; ").alias("headers"), F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
), r AS (
  SELECT page_id * 5 AS record_id, 'response' AS kind, url, page_id * 10 AS ts, '"' || substr(md5(html), 1, 16) || '"' AS etag,
         CAST(page_id * 10 AS VARCHAR) AS lm, html AS body FROM p
  UNION ALL
  SELECT page_id * 5 + 1, 'revisit', regexp_replace(url, '^http://', 'https://') || '#again', page_id * 10 + 3,
         'W/"' || substr(md5(html), 1, 16) || '"', CAST(page_id * 10 AS VARCHAR), NULL FROM p WHERE page_id % 2 = 0
  UNION ALL
  SELECT page_id * 5 + 2, 'response', url, page_id * 10 + 5, '"' || substr(md5(html || '<!-- 2 -->'), 1, 16) || '"',
         CAST(page_id * 10 AS VARCHAR), html || '<!-- 2 -->' FROM p WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 5 + 3, 'revisit', url, page_id * 10 + 7, CASE WHEN page_id % 10 <> 0 THEN '"' || substr(md5(html), 1, 16) || '"' END,
         CAST(page_id * 10 AS VARCHAR), NULL FROM p WHERE page_id % 5 = 0
  UNION ALL
  SELECT page_id * 5 + 4, 'revisit', url, page_id * 10 - 1, '"' || substr(md5(html), 1, 16) || '"', NULL, NULL FROM p WHERE page_id % 7 = 0
), split AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(regexp_replace(url, '#.*$', ''), '^[a-zA-Z]+://([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
         regexp_extract(regexp_replace(url, '#.*$', ''), '^[a-zA-Z]+://[^/?]*(.*)$', 1) AS rest FROM r
), params AS (
  SELECT *, regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/+$', '') AS path,
         list_sort([x FOR x IN string_split(regexp_extract(rest, '\?(.*)$', 1), '&') IF x <> '' AND NOT starts_with(x, 'utm_')]) AS kept FROM split
), c AS (
  SELECT record_id, kind, ts, etag, lm, body,
         CASE WHEN host = '' THEN trim(regexp_replace(url, '#.*$', '')) ELSE host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical_url FROM params
), placed AS (
  SELECT *, max(CASE WHEN kind = 'response' THEN {'ts': ts, 'id': record_id} END)
              OVER (PARTITION BY canonical_url ORDER BY ts, record_id ROWS UNBOUNDED PRECEDING) AS found FROM c
), j AS (
  SELECT v.record_id, v.canonical_url, v.ts, v.found.id AS response_id, v.etag, v.lm, s.etag AS s_etag, s.lm AS s_lm, s.body AS s_body
  FROM placed v LEFT JOIN c s ON s.kind = 'response' AND s.record_id = v.found.id WHERE v.kind = 'revisit'
), o AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no-response'
                 WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = s_etag THEN 'etag' ELSE 'changed' END
                 WHEN lm IS NOT NULL THEN CASE WHEN lm = s_lm THEN 'last-modified' ELSE 'changed' END
                 ELSE 'unchecked' END AS outcome FROM j
)
SELECT record_id, canonical_url, ts, response_id, outcome,
       CASE WHEN outcome IN ('etag', 'last-modified', 'unchecked') THEN 200 END AS status,
       CASE WHEN outcome IN ('etag', 'last-modified', 'unchecked') THEN
         'cache-control: max-age=120; content-length: ' || length(s_body) || '; content-type: text/html; date: ' || ts || '; etag: ' || s_etag END AS headers,
       CASE WHEN outcome IN ('etag', 'last-modified', 'unchecked') THEN sha256(s_body) END AS body_sha256
FROM o
"""
