"""Sainte-Lague mixing: targets by brute force, quotas by the literal method."""

from __future__ import annotations

import random

from llm_fixtures import docs, table  # noqa: F401

from adtally.llm import mixing
from adtally.llm.queries import queries
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in names if s not in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / open_ for s in names}
        above = {s for s in names if s not in capped and target[s] >= 2 * sizes[s]}
        if not above:
            return target
        capped |= above
        if len(capped) == len(names):
            return {s: 2.0 * sizes[s] for s in names}


def check(got, rows):
    sizes, taken = {}, {}
    n = lambda t: len((t or "").encode().split())
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, n(t)) for i, t, *_ in rows)
    source = {i: (s[1] if len(s) > 1 else None) for i, t, *s in rows}
    for i, t, *s in rows:
        sizes[source[i]] = sizes.get(source[i], 0) + n(t)
    target = brute_targets(sizes) if rows else {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) <= 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(2 * mixing.BLOCK_WORDS, 0.02 * target[s]), s


def corpus(seed=8):
    rnd = random.Random(seed)
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "Z", "é", None, ""])
        rows.append((i, " \n".join("w" * rnd.randint(1, 5) for _ in range(rnd.randint(0, 200))), "en", source))
    return rows + [(900, None, "en", "a"), (901, "", "en", "empty source"), (902, "long " * 9000, "en", "tiny")]


def test_query_targets_and_reruns(docs, table, spark):
    rows = corpus()
    d = table(documents=docs(rows))
    one = queries()["op8_mixing"](spark, d).collect()
    check(one, rows)
    again = mixing.mix(docs(rows).repartition(7)).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))


def test_many_shards(docs):
    rows = corpus(9)
    got = mixing.mix(docs(rows), shard_docs=7).select("doc_id", "size", "source_size", "target", "taken").collect()
    sources = {}
    for r in got:
        sources.setdefault(r.source_size, [r.target, 0])[1] += r.taken
    for target, taken in sources.values():  # each of some 15 shards is half a block off at most
        assert abs(taken - target) <= 16 * mixing.BLOCK_WORDS


def test_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    check(queries()["op8_mixing"](spark, d).collect(), rows)


def test_apportion_is_sainte_lague(spark):
    rnd = random.Random(3)
    for seats in (0, 1, 7, 100, 1003):
        claims = {f"s{i}": rnd.choice([0.0, 1.0, 1.0, rnd.random() * 10, rnd.random() * 1000]) for i in range(9)}
        want = dict.fromkeys(claims, 0)
        for _ in range(seats):
            best = min((k for k in claims if claims[k]), key=lambda k: (-claims[k] / (2 * want[k] + 1), k))
            want[best] += 1
        df = spark.createDataFrame(list(claims.items()), "k string, claim double")
        got = {r.k: r.quota for r in mixing.apportion(df, ["k"], "claim", F.lit(seats)).collect()}
        assert got == want, seats


def test_nulls_repeats_empty_and_clashing_names(docs, table, spark):
    rows = [(1, "a b c", None, None), (1, "a b c", None, None), (None, "d", None, "x")]
    out = mixing.mix(docs(rows).withColumnRenamed("lang", "shard").withColumnRenamed("n_chars", "size"))
    assert out.count() == 3
    assert queries()["op8_mixing"](spark, table(documents=docs([]))).count() == 0


def test_apply_mix_takes_what_was_dealt(docs):
    rows = [(i, f" {i}a\n{i}b  " + "word " * (i % 90), "en", "hot" if i % 2 else "b") for i in range(80)] + [(99, None, "en", "b")]
    d = docs(rows)
    out = mixing.apply_mix(d)
    assert out.columns == d.columns
    want = {r.doc_id: r.taken for r in mixing.mix(d).collect() if r.taken}
    got = {}
    text = {i: t.split() for i, t, *_ in rows if t}
    for r in out.collect():
        w = r.text.split()
        assert w == text[r.doc_id][:len(w)] and r.n_chars == len(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(w)
    assert got == want
