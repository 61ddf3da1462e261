"""Benchmark decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from llm_fixtures import docs, table  # noqa: F401

from adtally.llm import decontaminate
from adtally.llm.queries import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                k = tuple(w[p:p + n])
                if k in windows:
                    hit.update(range(p, p + n))
                    found |= windows[k]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def cases():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "a", "B2"]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(1, say(40)), (2, say(10)), (3, say(7)), (4, "one two"), (5, "single"), (6, None), (7, "?!"), (8, say(40)), (9, "a a a a a a a a a a a a")]
    items.append((10, items[0][1]))  # a repeated text
    docs = [(i, say(rnd.randint(0, 60))) for i in range(60)]
    for i, (_, text) in enumerate(items):
        w = (text or "").split()
        docs += [(100 + i, say(5) + " " + " ".join(w[:12]).upper() + " " + say(5)), (200 + i, ", ".join(w)), (300 + i, " ".join(w[1:]))]
    docs += [(400, None), (401, ""), (402, "a-a " * 30), (403, "zz " * 2000 + items[7][1]), (403, "zz")]
    return docs, items


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_LIMIT, 3])
def test_equals_brute_force(docs, spark, limit):
    rows, items = cases()
    found = decontaminate.find(docs(rows), spark.createDataFrame(items, "item_id long, text string"), broadcast_limit=limit)
    got = sorted((r.doc_id, r.n_words, sum(1 for p in range(r.n_words) if any(s.start <= p < s.stop for s in r.spans)), len(r.item_ids))
                 for r in found.collect())
    assert got == sorted(b[:4] for b in brute(rows, items))


def test_query_equals_brute_force(docs, table, spark):
    rows, items = cases()
    d = table(documents=docs(rows), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, queries()["op4_decontamination"](spark, d).collect())) == sorted(brute(rows, items))


def test_whole_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows, items = ([tuple(r) for r in spark.read.parquet(f"{d}/{t}.parquet").select(k, "text").collect()]
                   for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted(map(tuple, queries()["op4_decontamination"](spark, d).collect())) == sorted(brute(rows, items))


def test_empty_tables_and_clean(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "the quick brown fox"), (None, "lorem ipsum dolor")], "item_id long, text string")
    assert decontaminate.find(docs([]), some).count() == 0
    assert [r.item_ids for r in decontaminate.find(docs([(1, "the quick brown fox")]), none).collect()] == [[]]
    kept = decontaminate.clean(docs([(1, "a the QUICK brown fox b"), (2, "lorem ipsum dolor"), (3, "fine"), (None, None)]).withColumnRenamed("lang", "spans"), some)
    assert kept.columns == ["doc_id", "text", "spans", "source", "n_chars"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, None]
