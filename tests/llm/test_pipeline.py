"""The corpus pipeline: each stage's decisions against its own rule, odd input."""

from __future__ import annotations

import pytest
from llm_fixtures import docs, table  # noqa: F401

import corpus_pipeline
from adtally.llm import decontaminate, minhash, mixing, toxicity
from adtally.llm.common import materialize
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_on_its_input(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    now = read("documents")
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, now, SF), "test-stage")
        assert after.columns == columns
        before_ids, ids = ({r.doc_id for r in d.select("doc_id").collect()} for d in (now, after))
        if name == "toxicity":
            weights = toxicity.fit(toxicity.labelled(now, read("labels"), "toxic"))
            assert ids == {r.doc_id for r in toxicity.score(now, weights).where("score < 0.3").select("doc_id").collect()} and ids < before_ids
            clean = {r.doc_id for r in read("labels").where("toxic = 0").collect()} & before_ids
            assert len(clean & ids) >= 0.98 * len(clean)
        elif name == "near_dedup":
            kept = minhash.classes(now).where("kept").select("doc_id")
            assert ids == {r.doc_id for r in kept.collect()} and ids < before_ids
        elif name == "decontamination":
            assert ids == {r.doc_id for r in decontaminate.find(now, read("benchmark")).where("size(item_ids) = 0").collect()}
        else:
            want = {r.doc_id: r.taken for r in mixing.mix(now).where("taken > 0").collect()}
            got = after.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n"))
            assert {r.doc_id: r.n for r in got.collect()} == want
        now = after
    out = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    assert len(out) == now.count()
    place = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens


@pytest.mark.parametrize("rows", [[], [(None, None), (1, ""), (1, ""), (2, None, None, "s"), (3, "word " * 3000), (4, "a b c d e f g h", "en", None)]])
def test_odd_documents(docs, table, spark, rows):
    y = spark.createDataFrame([(1, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    b = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    d = docs(rows).withColumn("label", F.lit(1)).withColumn("part", F.lit("x")).withColumn("size", F.lit(None).cast("int"))
    folder = table(documents=d, labels=y, benchmark=b)
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    n = {r.doc_id: r.n for r in out.groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    assert set(n) <= {1, 2, 3, 4, None} and (not rows or {3, 4} <= set(n))


def test_null_and_repeated_ids_are_judged_row_by_row(docs, table, spark):
    """A contaminated row doesn't take other rows of its id along, and copies
    under a null or repeated id go, one row of each class staying."""
    say = lambda tag: " ".join(f"{tag}{i}" for i in range(14))
    rows = [(None, "x " + say("leak")), (None, say("fine")), (None, say("good")), (7, say("leak")), (7, say("seven")),
            (None, say("copy")), (4, say("copy")), (5, say("copy")), (6, say("twice")), (6, say("twice")), (None, say("lone")), (None, say("lone")),
            (9, say("first")), (9, say("other")), (8, say("other")), (None, None), (None, "")]
    d = docs(rows).withColumn("part", F.lit("x"))
    folder = table(documents=d, benchmark=spark.createDataFrame([(1, say("leak"))], "item_id long, text string"))
    order = lambda found: sorted(found, key=str)
    after = corpus_pipeline.decontamination_stage(spark, d, folder)
    assert after.columns == d.columns
    assert order((r.doc_id, r.text) for r in after.collect()) == order(r for r in rows if "leak" not in (r[1] or ""))
    kept = corpus_pipeline.near_dedup_stage(spark, d, folder)
    want = [(None, say("fine")), (None, say("good")), (7, say("seven")), (4, say("copy")), (6, say("twice")), (None, say("lone")),
            (9, say("first")), (8, say("other")), (None, None), (None, ""), (7, say("leak"))]
    assert kept.columns == d.columns
    assert order((r.doc_id, r.text) for r in kept.collect()) == order(want)
