"""Substring dedup against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from llm_fixtures import docs  # noqa: F401

from adtally.llm import debruijn as d
from adtally.llm.common import read_table
from adtally.llm.queries import queries

SF = "/root/testdata/sf0.01"


def literal(rows, k=20):
    """[(doc_id, n_words, n_removed, kept_sha256)] of (doc_id, text) in order."""
    seen, out = set(), []
    for doc_id, text in rows:
        words = re.findall(r"[^ \t\n\v\f\r]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - k + 1):
            window = tuple(words[i:i + k])
            if window in seen:
                gone[i:i + k] = [True] * k
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:])


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=key)


def test_query_equals_the_literal_version(spark):
    rows = read_table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = found(queries()["op13_repeats"](spark, SF))
    assert got == literal(rows)
    assert sum(r[2] for r in got) > 1000


def test_small_vocabularies(spark, docs):
    """Few words and short windows: branching, cyclic and self-overlapping paths."""
    rng = random.Random(11)
    for k, letters, n in ((4, "ab", 60), (6, "abc", 60), (20, "ab", 40)):
        rows, pieces = [], [" ".join(rng.choices(letters, k=rng.randint(1, 45))) for _ in range(9)]
        for i in range(n):
            text = " ".join(rng.choice([*pieces, "", rng.choice(letters) * rng.randint(1, 3), "x y  z"]) for _ in range(rng.randint(0, 6)))
            rows.append((i * 3, text if i % 17 else None))
        rows.append((5, "a " * 300))
        rows.append((700, "a " * 90))
        rows.sort()
        assert found(d.without_repeats(docs(rows), k)) == sorted(literal(rows, k), key=key), k


def test_removed_spans_and_extra_columns(spark, docs):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, f"one two {passage} three"), (2, passage), (3, f"{passage}\n\t{passage} end")]
    df = docs(rows).withColumnRenamed("lang", "slice").withColumnRenamed("source", "tie")
    got = {r.doc_id: r.removed for r in d.without_repeats(df).collect()}
    assert got == {1: [], 2: [0, 30], 3: [0, 60]}


def test_null_and_repeated_ids(spark, docs):
    rng = random.Random(2)
    text = [" ".join(f"{c}{i}" for i in range(40)) for c in "abc"]
    rows = [(None, text[0]), (7, text[0]), (7, text[1]), (7, text[1]), (7, text[1]), (8, text[1] + " " + text[2]), (None, text[0]), (None, None), (9, "short"), (9, "short")]
    rng.shuffle(rows)
    got = found(d.without_repeats(docs(rows)))
    empty, first = hashlib.sha256(b"").hexdigest(), lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([(None, 40, 0, first(text[0])), (None, 40, 40, empty), (None, 0, 0, empty), (7, 40, 40, empty), (7, 40, 0, first(text[1])),
                          (7, 40, 40, empty), (7, 40, 40, empty), (8, 80, 40, first(text[2])), (9, 1, 0, first("short")), (9, 1, 0, first("short"))], key=key)


def test_empty_and_long(spark, docs):
    assert d.without_repeats(docs([(1, "x")]).limit(0)).count() == 0
    rng = random.Random(4)
    long = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 10**6)) for _ in range(400_000))
    rows = [(1, long[1000:90_000]), (2, "w" * 3_000_000 + " " + long), (3, "　".join("xyz") + " " * 10_000 + long[:500])]
    assert found(d.without_repeats(docs(rows))) == literal(rows)


def test_copies_with_other_words_are_refused(spark, docs):
    sources = "array<struct<s_slice: long, s_place: long, low: long, high: long>>"
    done = spark.createDataFrame([([(0, 0, 5, 6)],), ([(0, 0, 5, 7), (2, 0, 1, 1)],), ([(2, 0, 1, 1), (0, 3, 1, 1)],)], f"sources {sources}")
    bad = d.refused(done)
    assert [tuple(r) for r in bad.collect()] == [(0, 0)]
    text = " ".join(f"p{j}" for j in range(30))
    rows = d.rows_of(docs([(1, text), (2, text), (3, text)]))
    ranges = d.candidates(d.anchors(rows, 20), 20).select("doc_id", "ranges")
    seen = d.visits(rows.join(ranges, "doc_id").repartition(1).sortWithinPartitions("doc_id"), 20)
    assert sorted(r.n_removed for r in d.cut(seen, d.all_paths(seen), 20).collect()) == [0, 30, 30]
    assert sorted(r.n_removed for r in d.cut(seen, d.all_paths(seen, bad), 20).collect()) == [0, 0, 0]


def test_hashes_do_not_depend_on_the_slice():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(33, 127, rng.integers(1, 12)).astype(np.uint8)) for _ in range(500)]
    whole = d.Slice([b"  ".join(words)]).hashes()
    assert (whole == np.concatenate([d.Slice([None, w, b""]).hashes() for w in words])).all()
    assert len(set(whole.tolist())) == len(set(words))
    x = d.Slice([None, b" a  b ", b"", b"c"])
    assert (x.first.tolist(), x.count.tolist(), x.text(0, 2), x.text(2, 3)) == ([0, 0, 2, 2], [0, 2, 0, 1], b"a b", b"c")
