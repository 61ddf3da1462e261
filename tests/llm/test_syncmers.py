"""Closed syncmers and fingerprints against a literal implementation."""

from __future__ import annotations

import hashlib
import random

from llm_fixtures import docs, table  # noqa: F401

from adtally.llm import syncmers
from adtally.llm.queries import queries
from pyspark.sql import functions as F


def texts():
    rnd = random.Random(6)
    say = lambda n: "".join(rnd.choice("abc dé😀\nf") for _ in range(n))
    rows = [(i, say(n)) for i, n in enumerate([1, 7, 15, 16, 17, 24, 25, 26, 63, 64, 65, 78, 79, 80, 127, 128, 129, 500, 5000])]
    return rows + [(50, "a" * 300), (51, None), (52, ""), (53, rows[17][1])]


def test_anchors_are_the_closed_syncmers(docs, spark):
    k, s = syncmers.K, syncmers.S
    rows = [(i, t) for i, t in texts() if t]
    parts = {t[i:i + s] for _, t in rows for i in range(len(t))} | {t[i:i + k] for _, t in rows for i in range(len(t))}
    hashed = {r.x: (r.h, r.a) for r in spark.createDataFrame([(x,) for x in parts], "x string")
              .select("x", F.hash("x").alias("h"), F.xxhash64("x").alias("a")).collect()}
    want = set()
    for i, t in rows:
        if len(t) < k:
            want.add((i, 0, hashed[t][1]) if t in hashed else (i, 0, None))
            continue
        for p in range(len(t) - k + 1):
            inner = [hashed[t[p + j:p + j + s]][0] for j in range(k - s + 1)]
            if len(t) < 2 * k - s + 1 or min(inner) in (inner[0], inner[-1]):
                want.add((i, p, hashed[t[p:p + k]][1]))
    got = {(r.doc_id, r.pos, r.anchor) for r in syncmers.anchors(docs(rows), ["doc_id"]).collect()}
    whole = {i for i, t in rows if len(t) < k}
    assert {x for x in got if x[0] not in whole} == {x for x in want if x[0] not in whole}
    assert {x[:2] for x in got if x[0] in whole} == {(i, 0) for i in whole}


def test_query_edits_neighbours_and_likeness(docs, table, spark):
    rows = texts()
    got = {r.doc_id: r for r in queries()["op6_syncmers"](spark, table(documents=docs(rows))).collect()}
    down = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    share = lambda a, b: 1.0 if a == b else sum(x == y != "." * 8 for x, y in cells(a, b)) / max(1, sum({x, y} != {"." * 8} for x, y in cells(a, b)))
    cells = lambda a, b: [(a[i:i + 8], b[i:i + 8]) for i in range(0, len(a), 8)]
    for n, (i, t) in enumerate(down):
        nxt = down[(n + 1) % len(down)]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[1][:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - share(r.fingerprint, r.edited_fingerprint)) < 1e-12
        assert abs(r.near_next - share(r.fingerprint, got[nxt[0]].fingerprint)) < 1e-12
    assert got[17].fingerprint == got[53].fingerprint and got[51].fingerprint == got[52].fingerprint == "." * 8 * syncmers.SLOTS
    assert got[18].near_edited > 0.2


def test_fingerprint_of_an_edited_text_equals_its_own(docs, table, spark):
    """The edited text gets the fingerprint it would have as a document."""
    rows = [(1, "first text, somewhat longer than a k-mer"), (2, "second text, which is also rather long, to be edited")]
    a, b = (queries()["op6_syncmers"](spark, table(documents=docs(rows))).orderBy("doc_id").collect())
    edited = rows[1][1][:26] + rows[0][1][:26]
    again = queries()["op6_syncmers"](spark, table(documents=docs([(9, edited)]))).first()
    assert again.fingerprint == b.edited_fingerprint and again.near_next == 1.0  # one document is its own next


def test_repeated_rows_null_ids_many_parts_and_empty(docs, table, spark):
    rows = [(7, "same id, one text of some length"), (7, "same id, another text of some length"), (7, "same id, another text of some length"),
            (None, "no id but a text of some length")] + [(100 + i, f"text number {i} with a few words {i * i}") for i in range(40)]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    got = queries()["op6_syncmers"](spark, table(documents=docs(rows).withColumnRenamed("lang", "part"))).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id and r.doc_id >= 100}
    for i in range(101, 140):
        t, n = rows[4 + i - 100][1], rows[4 + i - 101][1]
        edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        assert by[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    lowest = next(r for r in got if r.doc_id is None)  # its next is the highest id
    t, n = rows[3][1], rows[-1][1]
    assert lowest.edited_sha256 == hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest()
    assert queries()["op6_syncmers"](spark, table(documents=docs([]))).count() == 0


def test_no_python_in_the_plan(spark):
    text = queries()["op6_syncmers"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_anchors_are_found_without_interpreted_lambdas(docs, spark):
    """The hashes of a block are compiled, in methods that the JVM still compiles
    (8000 bytes of code), and equal for texts of one and of more bytes a character."""
    import re
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = syncmers.anchors(docs([(1, "a text of some length, " * 9), (2, "ein längerer Text für alle 😀 " * 9)]), ["doc_id"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "lambdafunction" not in plan and "transform(" not in plan
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize: ?(\d+)", found._jdf.queryExecution().explainString(mode))]
        assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def literal_matches(spark, rows):
    """Spans by plain loops over the listed anchors."""
    k = syncmers.K
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    listed = {}
    for r in syncmers.anchors(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"]).collect():
        if r.anchor is not None:
            listed.setdefault((r.doc_id, r.text), []).append((r.pos, r.anchor))
    first, spans = {}, []
    for row in rows:
        for pos, a in sorted(listed.get(row, [])):
            first.setdefault(a, (row, pos))
    for row in rows:
        lines = {}
        for pos, a in sorted(listed.get(row, [])):
            if first[a] != (row, pos):
                lines.setdefault((first[a][0], pos - first[a][1]), []).append(pos)
        for (source, shift), at in lines.items():
            cut = [0, *[i for i in range(1, len(at)) if at[i] - at[i - 1] > k], len(at)]
            for lo, hi in zip(cut, cut[1:]):
                spans.append((row[0], at[lo], min(at[hi - 1] + k, len(row[1])), source[0], at[lo] - shift, hi - lo))
    return spans


def test_matches_equal_a_literal_matcher(spark, docs):
    rnd = random.Random(8)
    say = lambda n: "".join(rnd.choice("abcdefgh ijklé😀") for _ in range(n))
    passages = [say(300), say(90), "short one"]
    rows = [(i, say(rnd.randint(0, 3000)) + rnd.choice([*passages, ""]) + say(rnd.randint(0, 200)) + rnd.choice(passages)) for i in range(25)]
    rows += [(90, "x" * 500), (91, rows[3][1]), (92, ""), (93, "tiny"), (94, "tiny"), (None, passages[0])]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    want = sorted(literal_matches(spark, rows), key=key)
    for hot in (2, 1024):  # all anchors hot but few, few hot
        got = sorted(map(tuple, syncmers.matches(docs(rows + rows[:3] + [(95, None)]), hot=hot).collect()), key=key)
        assert got == want
    texts = dict(rows)
    assert all(texts[d][a:b] == texts[s][f:f + b - a] for d, a, b, s, f, _ in want)
    assert syncmers.matches(docs([])).count() == 0


def test_matches_find_a_shared_passage_in_long_texts(spark, docs):
    rnd = random.Random(1)
    say = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    passage = say(50)
    rows = [(i, f"{say(4000)} {passage} {say(2000 + i)}") for i in range(6)]
    got = syncmers.matches(docs(rows)).collect()
    slack = 2 * (syncmers.K - syncmers.S)
    for i, text in rows[1:]:
        at = text.index(passage)
        mine = [r for r in got if r.doc_id == i and r.source_id == 0 and r.start <= at + slack and r.end >= at + len(passage) - slack]
        assert len(mine) == 1 and mine[0].source_start - mine[0].start == rows[0][1].index(passage) - at
    plan = syncmers.matches(docs(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
