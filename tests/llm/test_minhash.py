"""Near-duplicate classes against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from llm_fixtures import docs, table  # noqa: F401

from adtally.llm import minhash
from adtally.llm.queries import queries


def sets(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)])


def brute(rows, width):
    found = [(i, sets(t, width)) for i, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, a) in enumerate(found):
        for j, (_, b) in enumerate(found[:i]):
            n = len(a & b)
            if a and b and 100 * n >= 80 * (len(a) + len(b) - n):
                label[max(root(i), root(j))] = min(root(i), root(j))
    smallest = {}
    for i, (doc, _) in enumerate(found):
        r = root(i)
        smallest[r] = min(smallest.get(r, doc), doc)
    return [(doc, len(s), smallest[root(i)], doc == smallest[root(i)]) for i, (doc, s) in enumerate(found)]


def cases():
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(1000 + i, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 80)))) for i in range(60)]
    # a group around one text, edited more and more: some links hold only between edited ones
    base = rnd.choices(vocabulary, k=60)
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((2000 + i, " ".join(w)))
    # a chain, each member near its neighbours alone
    chain = rnd.choices(vocabulary, k=100)
    for i in range(12):
        for k in range(3):
            chain[(i * 8 + k) % 100] = f"n{i}{k}"
        rows.append((3000 + i, " ".join(chain)))
    rows += [(i, rows[65][1].upper().replace(" ", "\n")) for i in range(5)]  # equal sets
    rows += [(10, None), (11, ""), (12, " \t\n"), (13, "one"), (14, "ONE"), (15, "one two"), (16, "x " * 3000)]
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force(docs, width):
    rows = cases()
    got = minhash.classes(docs(rows), width=width, slice_pairs=500)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, width))


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries()["op7_minhash"](spark, d).collect())) == sorted(brute(rows, 2))


def test_keep_one_nulls_repeats_and_empty(docs):
    text = "the same words in this text again"
    rows = [(5, text), (3, text), (3, text), (None, text), (8, None), (9, "")]
    out = minhash.keep_one(docs(rows).withColumnRenamed("lang", "kept"))
    assert out.columns == ["doc_id", "text", "kept", "source", "n_chars"]
    assert sorted({r.doc_id for r in out.collect()}) == [3, 8, 9]
    assert minhash.classes(docs([])).count() == 0
    assert [tuple(r) for r in minhash.classes(docs([(1, None)])).collect()] == [(1, 0, 1, True)]


def test_densified_signature():
    rng = np.random.default_rng(1)
    order = minhash.donors(70)
    values = np.unique(rng.integers(0, 1 << 63, 9).astype(np.uint64))
    sig = minhash.signature(values, 70, order)
    assert set(sig.tolist()) <= set(values.tolist())
    for v in values.tolist():  # a filled bin holds its smallest value
        same = [x for x in values.tolist() if x % 70 == v % 70]
        assert sig[v % 70] == min(same)


def test_sketches_never_deny_a_link():
    rng = np.random.default_rng(3)
    for n in (1, 5, 60, 900, 6000):
        base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        other = np.unique(np.concatenate([base[n // 9:], rng.integers(0, 1 << 63, n // 12).astype(np.uint64)]))
        differing = int(np.bitwise_count((minhash.parity(base) ^ minhash.parity(other)).view(np.uint64)).sum())
        assert differing <= len(np.setxor1d(base, other))


def test_near_copies_that_do_not_link_are_not_paired_squarely(docs, monkeypatch):
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(360):
        w = list(base)
        for k in rnd.sample(range(120), 6):
            w[k] = f"n{i}-{k}"
        rows.append((i, " ".join(w)))
    pairs, confirm = [], minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda p, *a: pairs.append(p.count()) or confirm(p, *a))
    counts = []
    for n in (120, 360):
        pairs.clear()
        got = minhash.classes(docs(rows[:n]), width=2)
        assert sorted(map(tuple, got.collect())) == sorted(brute(rows[:n], 2))
        counts.append(sum(pairs[3:]))
    assert counts[1] <= 4 * counts[0] + 100, counts


def test_new_links_join_known_components(spark):
    rnd = random.Random(4)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(240)]
    pairs = [(min(p), max(p)) for p in pairs if p[0] != p[1]]
    label = {}
    for a, b in pairs:
        a_, b_ = label.get(a, a), label.get(b, b)
        label |= {a: a_, b: b_}
        label = {k: min(a_, b_) if v in (a_, b_) else v for k, v in label.items()}
    made = lambda some: spark.createDataFrame(some, "a long, b long")
    comp = minhash.components(made(pairs[:120]))
    for some in (pairs[120:200], [], pairs[150:]):
        comp = minhash.components(made(some), comp)
    rows = comp.collect()
    assert len(rows) == len(label) and {r.node: r.comp for r in rows} == label


def test_small_tables_are_written_in_few_files(docs, spark, monkeypatch):
    files, write = {}, minhash.materialize

    def counted(df, purpose):
        out = write(df, purpose)
        files[purpose] = max(files.get(purpose, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(minhash, "materialize", counted)
    rows, conf = cases(), {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert sorted(map(tuple, minhash.classes(docs(rows), width=2).collect())) == sorted(brute(rows, 2))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for purpose in ("dup-nodes", "dup-wanted", "dup-sets", "dup-links", "dup-edges", "dup-labels", "dup-open", "dup-info"):
        assert files[purpose] <= 3, purpose
