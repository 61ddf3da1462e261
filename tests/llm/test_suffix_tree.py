"""Suffix tree scores against a literal implementation with dictionaries."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from llm_fixtures import docs, table  # noqa: F401

from adtally.llm import suffix_tree as st
from adtally.llm.common import crc_mod
from adtally.llm.queries import queries


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def brute(rows, hot_words, depth, p_min, min_gain, min_total, discount):
    train = [tokens(t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    c = Counter(x for t in train for x in t)
    total, distinct = sum(c.values()), len(c)
    words = {w: n for w, n in c.items() if w is not None}
    n1, n2 = (sum(n == k for n in words.values()) for k in (1, 2))
    d0 = n1 / max(1, n1 + 2 * n2) or 0.5
    hot = set(sorted(words, key=lambda w: (-words[w], w))[:hot_words])
    sym = lambda x: x if x is None or x in hot else "other"
    p0 = lambda x: (c[x] - d0) / total if c[x] else d0 * distinct / total
    root = {x: p0(x) for x in [*hot, None]}
    root["other"] = max(1e-12, 1 - sum(root.values()))
    least, states = max(2, p_min * total), {}

    def prob(history, x):
        p = root[x]
        for d in range(1, depth + 1):
            s = tuple(history[-d:]) if d <= len(history) else None
            if s not in states:
                break
            own, left = states[s]
            p = own.get(x, 0.0) + left * p
        return p

    texts = [[sym(x) for x in t] for t in train]
    for d in range(1, depth + 1):
        n = defaultdict(Counter)
        for t in texts:
            for i in range(d, len(t)):
                if d == 1 or tuple(t[i - d + 1:i]) in states:
                    n[tuple(t[i - d:i])][t[i]] += 1
        found = {}
        for s, nxt in n.items():
            every = sum(nxt.values())
            kept = {x: k for x, k in nxt.items() if k >= least}
            if every < least or not kept:
                continue
            own = {x: max(k - discount, 0) / every for x, k in kept.items()}
            left = 1 - sum(own.values())
            gain = sum(k * math.log((own[x] + left * prob(s[1:], x)) / prob(s[1:], x)) for x, k in kept.items())
            rest = every - sum(kept.values())
            gain += rest * math.log(left) if rest else 0
            if gain >= min_total and gain >= min_gain * every:
                found[s] = (own, left)
        if not found:
            break
        states.update(found)
    out = {}
    for k, (i, text) in enumerate(rows):
        t = tokens(text)
        base = sum(math.log10((c[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in t)
        s, score = [sym(x) for x in t], 0.0
        for j, x in enumerate(t):
            p = prob(s[:j], s[j])
            if s[j] == "other":
                p *= p0(x) / root["other"]
            score += math.log10(p)
        out[k] = (i, len(t), sum(c[x] > 0 for x in t), total, base, score)
    return out, states


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[4], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want):
        assert math.isclose(g[4], w[4], rel_tol=1e-9) and math.isclose(g[5], w[5], rel_tol=1e-7), (g, w)


def corpus():
    rnd = random.Random(2)
    lines = ["the cat sat on the mat", "a dog ran in the park", "to be or not to be", "of the people by the people"]
    rows = [(i, " ".join(rnd.choice(lines) for _ in range(rnd.randint(1, 6))) + f" rare{rnd.randint(0, 40)}") for i in range(200)]
    return rows + [(300, None), (301, ""), (301, "THE Cat sat"), (302, "unseen words only"), (303, "to " * 5000), (None, "the cat")]


def test_equals_the_literal_tree(docs):
    rows = corpus()
    options = {"depth": 3, "p_min": 0.002, "min_gain": 0.02, "min_total": 5.0, "discount": 0.75}
    want, states = brute(rows, 12, **options)
    assert {len(s) for s in states} == {1, 2, 3}
    got = st.score(docs(rows).withColumnRenamed("lang", "row"), crc_mod("doc_id", 10) != 0, hot_words=12, **options).collect()
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], want.values())


def test_probabilities_sum_to_one(docs):
    rows = corpus()
    held = (i for i in range(10_000, 20_000) if zlib.crc32(str(i).encode()) % 10 == 0)
    train = [tokens(t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    c = Counter(x for t in train for x in t)
    total, n1, n2 = sum(c.values()), *(sum(n == k for w, n in c.items() if w) for k in (1, 2))
    d0 = n1 / max(1, n1 + 2 * n2) or 0.5
    p0 = lambda w: (c[w] - d0) / total if c[w] else d0 * len(c) / total
    words = [w.decode() for w in c if w] + ["neverseen"]
    probes = {next(held): t for w in words for t in (w, f"the {w}")} | {next(held): "the"}
    out = {probes[r.doc_id]: r.score for r in st.score(docs(rows + list(probes.items())), crc_mod("doc_id", 10) != 0, depth=1).collect() if r.doc_id in probes}
    # P(w | the) = P("the w" end) / P0(the) / (P(w end) / P0(w))
    p = {w: 10 ** (out[f"the {w}"] - out[w]) * p0(w.encode()) / p0(b"the") for w in words}
    p[None] = 10 ** out["the"] / p0(b"the")
    assert max(abs(p[w] - p0(w and w.encode())) for w in p) > 0.05  # the context is in the tree
    assert abs(sum(p.values()) - 1) < 1e-9


def test_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want, _ = brute(rows, st.HOT_WORDS, st.DEPTH, st.P_MIN, st.MIN_GAIN, st.MIN_TOTAL, st.DISCOUNT)
    got = queries()["op2_suffix_tree"](spark, d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], want.values())


def test_nothing_to_learn_and_empty(docs, table, spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = queries()["op2_suffix_tree"](spark, table(documents=docs([(held, "a b")]))).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isclose(r.base_score, r.score)
    assert queries()["op2_suffix_tree"](spark, table(documents=docs([]))).count() == 0


def test_passages_seen_a_few_times_are_learned_in_a_large_corpus(docs):
    """The threshold doesn't rise with the number of tokens."""
    rnd = random.Random(5)
    passage = "seldom quoted lines return"
    rows = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(6000))) for i in range(400)]
    learned = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 10][:4]
    rows += [(i, f"{passage} u{max(0, k - 1)}") for k, i in enumerate(learned)]
    want, states = brute(rows, None, st.DEPTH, 0.0, st.MIN_GAIN, st.MIN_TOTAL, st.DISCOUNT)
    assert 2e-6 * next(iter(want.values()))[3] > len(learned) and (b"seldom",) in states
    want = {w[0]: w[5] for w in want.values()}
    got = st.score(docs(rows), crc_mod("doc_id", 10) != 0).collect()
    assert len(got) == len(rows) and all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-7) for r in got)


def test_slices_and_turns_do_not_matter(docs, monkeypatch):
    """Grams that all slices hold, in many buckets and turns; a slice without
    words of its own."""
    rnd = random.Random(9)
    lines = ["the cat sat down", "a cat sat up", "the dog sat up there", "w3 w4 w5 w6"]
    rows = [(i, " ".join(rnd.choice(lines) if rnd.random() < 0.5 else f"w{int(rnd.paretovariate(0.7))}" for _ in range(60))) for i in range(300)]
    rows += [(i, "the cat sat down") for i in range(300, 330)]
    want, states = brute(rows, None, st.DEPTH, 0.0, st.MIN_GAIN, st.MIN_TOTAL, st.DISCOUNT)
    assert {len(s) for s in states} == {1, 2, 3}
    for name, value in (("SLICE", 4_000), ("BUCKET", 2_000), ("SHARES", 3)):
        monkeypatch.setattr(st, name, value)
    got = st.score(docs(rows).repartition(3), crc_mod("doc_id", 10) != 0).collect()
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], want.values())


def test_slices_ask_in_turns(docs, monkeypatch):
    """What the slices of one turn ask is written before the next one's answers
    are shuffled, so that no write holds all slices; the scores are the same."""
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choice(["a b c d", "b c a", "d d e a"]) for _ in range(60)) + f" w{i % 9}") for i in range(120)]
    train = crc_mod("doc_id", 10) != 0
    as_rows = lambda found: [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found.collect()]
    want = as_rows(st.score(docs(rows), train))
    monkeypatch.setattr(st, "SLICE", 2_000)
    written, write = [], st.materialize

    def counted(df, purpose):
        out = write(df, purpose)
        if purpose == "pst-asks":
            written.append({r.slice for r in out.select("slice").distinct().collect()})
        return out

    monkeypatch.setattr(st, "materialize", counted)
    same(as_rows(st.score(docs(rows), train)), want)
    slices = set().union(*written)
    assert len(slices) > 8 and all(0 < len(w) < len(slices) for w in written) and len(written) == 2 * st.DEPTH * st.TURNS


def test_order_of_keys_that_share_their_upper_bits():
    rnd = np.random.default_rng(3)
    for keys in (rnd.integers(0, 1 << 62, 5000), rnd.integers(0, 40, 5000), (rnd.integers(0, 50, 5000) << 20) + rnd.integers(0, 3, 5000), np.empty(0)):
        keys = keys.astype(np.uint64)
        assert (st.order_of(keys) == np.argsort(keys, kind="stable")).all()


def test_only_heavy_contexts_become_rows_of_grams(docs, monkeypatch):
    """Light contexts are judged in their bucket; a frequent one is grouped by
    all tasks. Both give the literal tree."""
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["a b c d", "b c a", "d d e a", "x y z", "x y w"]) for _ in range(60)) + f" w{i % 9}") for i in range(120)]
    want, states = brute(rows, None, st.DEPTH, 0.0, st.MIN_GAIN, st.MIN_TOTAL, st.DISCOUNT)
    pairs, write = [], st.materialize

    def counted(df, purpose):
        out = write(df, purpose)
        if purpose == "pst-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(st, "materialize", counted)
    for bucket, heavy in ((1 << 20, False), (3_000, True)):
        monkeypatch.setattr(st, "BUCKET", bucket)
        pairs.clear()
        got = st.score(docs(rows), crc_mod("doc_id", 10) != 0).collect()
        same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], want.values())
        assert len(pairs) == st.DEPTH and (sum(pairs) > 0) == heavy
